r"""Fill-in-middle documents, assembled by a secondary sort.

A document is cut into units (white space and the word after it; white space at the end is
one more). Two places, drawn from the SHA-256 of a seed and the document's id, part it into
prefix, middle and suffix; the same digest draws whether it stays plain, or comes out as
``spm`` or ``psm``.

``pieces`` emits a document's parts in chunks of at most ``UNITS`` units, in document order,
each with its place in the output; marks are pieces of their own. ``arranged`` brings each
document's pieces into one partition, sorted by document and place: the repartition and
sort within partitions run as one shuffle whose sort spills, so no document and no group is
collected. ``digests`` streams the sorted pieces into one incremental digest, tells where
each piece belongs from the marks that it reads, and sends the pieces through the same sort
by that place, from which the restored text is digested likewise. Plain documents are in
order already and stream without a shuffle.

Rows are told apart by their place in the input, so repeated rows and repeated or null ids
give a row each; a null id counts as empty text. Such places are the same in a repeated task
if the input is read from files: write a shuffled input first. Null and empty texts are
plain, with no units and empty output. Other columns are left out. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from siltbed.llm.common import map_batches, sized_batches

SEED = "42"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: In a hundred: documents that stay plain begin at FIM_PERCENT, psm at SPM_PERCENT.
FIM_PERCENT, SPM_PERCENT = 50, 80
UNITS = 2048
BATCH_BYTES = 4 << 20
#: Sections in document order; places of one are apart by at least its pieces.
SECTIONS = (PREFIX, MIDDLE, SUFFIX)
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: The first row of a document (place -1) says what it is; the others bring pieces.
_PIECE = "row long, place long, doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, piece string"
_NAMES = ["row", "place", "doc_id", "n", "form", "prefix_chars", "middle_chars", "piece"]


def drawn(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """row, doc_id, text (never null), form and the two numbers h1 and h2 behind the cuts."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(name, 256)

    def number(k: int) -> Column:
        return F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")

    text = F.coalesce("text", F.lit(""))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = (
        F.when((F.col("text") == "") | marked | (number(2) % 100 >= FIM_PERCENT), "plain")
        .when(number(3) % 100 < SPM_PERCENT, "spm")
        .otherwise("psm")
    )
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"), digest.alias("digest"))
    return rows.select("row", "doc_id", "text", form.alias("form"), number(0).alias("h1"), number(1).alias("h2"))


def _sections(text: str, ends: list[int], low: int, high: int, units: int) -> list[list[str]]:
    """The chunks of each section; ``ends`` has 0 and the end of each unit."""
    out = []
    for a, b in ((0, low), (low, high), (high, len(ends) - 1)):
        steps = [*range(a, b, units), b]
        out.append([text[ends[s] : ends[e]] for s, e in zip(steps, steps[1:])])
    return out


def pieces(rows: DataFrame, units: int = UNITS) -> DataFrame:
    """A head row and the pieces of each of ``drawn`` rows, in document order."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", BATCH_BYTES):
            heads, row, place, piece = [], [], [], []
            columns = (batch[c].to_pylist() for c in ("row", "text", "form", "h1", "h2"))
            for i, (own, text, form, h1, h2) in enumerate(zip(*columns)):
                ends = [0, *(m.end() for m in _UNIT.finditer(text))]
                n, plain = len(ends) - 1, form == "plain"
                low, high = (0, 0) if plain else sorted((h1 % (n + 1), h2 % (n + 1)))
                heads.append((len(row), i, n, form, None if plain else ends[low], None if plain else ends[high] - ends[low]))
                row.append(own), place.append(-1), piece.append(None)
                parts = dict(zip(SECTIONS, _sections(text, ends, low, high, units)))
                if plain:
                    places, marks = {SUFFIX: 0}, ()
                else:
                    places, at, marks = {}, 0, ORDERS[form]
                    for mark in marks:
                        places[mark] = at + 1
                        at += 1 + len(parts[mark])
                for mark in SECTIONS:
                    if mark in marks:
                        row.append(own), place.append(places[mark] - 1), piece.append(mark)
                    for k, part in enumerate(parts[mark]):
                        row.append(own), place.append(places[mark] + k), piece.append(part)
            yield _piece_batch(row, place, piece, heads, batch["doc_id"])

    return map_batches(rows, cut, _PIECE.format(kind=dict(rows.dtypes)["doc_id"]))


def _piece_batch(row: list, place: list, piece: list, heads: list[tuple], ids: pa.Array) -> pa.RecordBatch:
    """Rows of pieces; ``heads`` are (place in the lists, place in ids, n, form, prefix, middle)."""
    at: list[int | None] = [None] * len(row)
    fields: list[list] = [[None] * len(row) for _ in range(4)]
    for k, i, *values in heads:
        at[k] = i
        for field, value in zip(fields, values):
            field[k] = value
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row, pa.int64()),
            pa.array(place, pa.int64()),
            ids.take(pa.array(at, pa.int64())),
            *(pa.array(f, k) for f, k in zip(fields, kinds)),
            pa.array(piece, pa.string()),
        ],
        _NAMES,
    )


def arranged(some: DataFrame) -> DataFrame:
    """Pieces by document and place, each document in one partition."""
    return some.repartition("row").sortWithinPartitions("row", "place")


def _returned(outputs: DataFrame) -> DataFrame:
    """Output pieces with the place that the marks before them give in the document.

    After a document's pieces comes a row with its output's digest, at place -2.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, section, count, plain = None, None, 0, 0, True
        for batch in batches:
            row, place, piece, keep = [], [], [], []

            def end() -> None:
                row.append(now), place.append(-2), piece.append(digest.hexdigest()), keep.append(None)

            columns = (batch[c].to_pylist() for c in ("row", "place", "form", "piece"))
            for i, (own, at, form, text) in enumerate(zip(*columns)):
                if own != now:
                    if now is not None:
                        end()
                    now, digest, section, count, plain = own, hashlib.sha256(), 0, 0, form == "plain"
                    row.append(own), place.append(-1), piece.append(None), keep.append(i)
                    continue
                digest.update(text.encode())
                if not plain and text in SECTIONS:
                    # Such a document's own text holds no mark.
                    section, count = SECTIONS.index(text), 0
                    continue
                row.append(own), place.append(section << 40 | count), piece.append(text), keep.append(None)
                count += 1
            yield _with_heads(batch, row, place, piece, keep)
        if now is not None:
            row, place, piece, keep = [], [], [], []
            row.append(now), place.append(-2), piece.append(digest.hexdigest()), keep.append(None)
            yield _with_heads(batch, row, place, piece, keep)

    kind = dict(outputs.dtypes)["doc_id"]
    return map_batches(outputs, read, _PIECE.format(kind=kind))


def _with_heads(batch: pa.RecordBatch, row: list, place: list, piece: list, keep: list) -> pa.RecordBatch:
    at = pa.array(keep, pa.int64())
    columns = [batch[c].take(at) for c in _NAMES[2:7]]
    return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(place, pa.int64()), *columns, pa.array(piece, pa.string())], _NAMES)


def _restored(returned: DataFrame) -> DataFrame:
    """One row a document: its head, the digest that came along, and the one of its pieces.

    Sorted rows bring the digest before the head; streamed ones bring it last.
    """
    names = [*_NAMES[2:7], "output_sha256", "restored_sha256"]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, output, head = None, None, None, None

        def finished(rows: list) -> pa.RecordBatch:
            heads = pa.concat_batches([r[0] for r in rows])
            texts = [pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)]
            return pa.RecordBatch.from_arrays([*heads.columns, *texts], names)

        for batch in batches:
            done = []
            columns = (batch[c].to_pylist() for c in ("row", "place", "piece"))
            for i, (own, at, text) in enumerate(zip(*columns)):
                if own != now:
                    if now is not None:
                        done.append((head, output, digest.hexdigest()))
                    now, digest, output, head = own, hashlib.sha256(), None, None
                if at == -2:
                    output = text
                elif at == -1:
                    head = batch.slice(i, 1).select(_NAMES[2:7])
                else:
                    digest.update(text.encode())
            if done:
                yield finished(done)
        if now is not None:
            yield finished([(head, output, digest.hexdigest())])

    kind = dict(returned.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return map_batches(returned, read, schema)


def digests(docs: DataFrame, seed: str = SEED, units: int = UNITS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    rows = drawn(docs, seed)
    plain, moved = rows.filter("form = 'plain'"), rows.filter("form <> 'plain'")
    again = arranged(_returned(arranged(pieces(moved, units))))
    return _restored(_returned(pieces(plain, units))).unionByName(_restored(again))


def fill_in_middle(docs: DataFrame, seed: str = SEED, units: int = UNITS) -> DataFrame:
    """doc_id, form and the whole output text of each document, for training."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, head = None, [], None

        def finished(rows: list) -> pa.RecordBatch:
            heads = pa.concat_batches([r[0] for r in rows])
            texts = pa.array([r[1] for r in rows], pa.string())
            return pa.RecordBatch.from_arrays([*heads.columns, texts], ["doc_id", "form", "text"])

        for batch in batches:
            done = []
            for i, (own, text) in enumerate(zip(batch["row"].to_pylist(), batch["piece"].to_pylist())):
                if own != now:
                    if now is not None:
                        done.append((head, "".join(parts)))
                    now, parts, head = own, [], batch.slice(i, 1).select(["doc_id", "form"])
                else:
                    parts.append(text)
            if done:
                yield finished(done)
        if now is not None:
            yield finished([(head, "".join(parts))])

    rows = drawn(docs, seed)
    plain, moved = rows.filter("form = 'plain'"), rows.filter("form <> 'plain'")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, form string, text string"
    return map_batches(pieces(plain, units), join, schema).unionByName(
        map_batches(arranged(pieces(moved, units)), join, schema)
    )


ORACLE = r"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), cut AS (
    SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
        ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM doc
), formed AS (
    SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), part AS (
    SELECT *, array_to_string(units[1:low], '') AS p, array_to_string(units[low + 1:high], '') AS m,
        array_to_string(units[high + 1:], '') AS s
    FROM formed
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM part
"""
