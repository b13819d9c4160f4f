"""Exact token counts with a whole-token shortcut.

``proven`` encodes every vocabulary string alone and keeps those that come back as one
token. It also checks what lets texts be cut: no piece but runs of the space mark has
that mark after its first character, and none has a line break. So no merge crosses the start of a
word or a line break, and a text's count is the sum over its pre-tokens. Those that are
proven count 1; the rest are merged by the library, and their counts remembered.

Null and empty texts have 0 tokens. Texts are never cut short. Memory: the counts of
``REMEMBERED`` pre-tokens of at most ``LONGEST`` characters.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from siltbed.llm.common import batches_of, map_batches

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
REMEMBERED = 300_000
LONGEST = 64
MARK = "▁"

_SEGMENTS = re.compile(" +[^ ]*")


@functools.cache
def library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


@functools.cache
def proven(model: str) -> frozenset[str]:
    """Words that are one token after a space: the offline proof, once for each model."""
    own = library(model)
    pieces = [own.id_to_piece(i) for i in range(own.vocab_size())]
    for piece in pieces:
        if MARK in piece.lstrip(MARK) or "\n" in piece or "  " in piece:
            raise ValueError(f"{model}: piece {piece!r} crosses a word; texts can't be cut")
    words = [p[1:] for p in pieces if p[0] == MARK and p[1:] and MARK not in p[1:]]
    return frozenset(w for w, ids in zip(words, own.encode(words)) if len(ids) == 1)


class Counts(dict):
    """Tokens of pre-tokens; one that starts with a line break has no space before it."""

    def __init__(self, model: str):
        super().__init__()
        self.library, self.proven = library(model), proven(model)

    def __missing__(self, word: str) -> int:
        if word in self.proven:
            n = 1
        else:
            n = len(self.library.encode(word)) - word.startswith("\n")
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def of_text(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if "  " in text or " \n" in text or text[0] in " \n" or text[-1] == " ":
            segments = _SEGMENTS.findall(" " + text)
            return sum(self.of_segment(s) for s in segments)
        return sum(map(self.__getitem__, text.replace("\n", " \n").split(" ")))

    def of_segment(self, segment: str) -> int:
        """Tokens of a run of spaces and the word after it; the library adds one space itself."""
        if segment == " ":
            return 1
        if segment[1] in " \n":
            return len(self.library.encode(segment[1:]))
        return sum(map(self.__getitem__, segment[1:].replace("\n", " \n").split(" ")))


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_tokens, over_limit."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(model)
        for batch in batches_of(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            tokens = [counts.of_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs.select("doc_id", "text"), count, schema)
