"""The queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltbed.llm import (
    decontamination,
    exact_dedup,
    fill_middle,
    language,
    mixing,
    packing,
    pii,
    repeats,
    runs,
    simhash,
    token_counts,
    topk,
    toxicity,
)
from siltbed.llm.common import crc32_of_id, documents, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir, "doc_id", "text")))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir, "doc_id", "text"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir, "doc_id", "text"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir, "doc_id", "text"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir, "doc_id", "source", "text"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir, "doc_id", "text"), kept=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(with_planted_runs(documents(spark, sf_dir, "doc_id", "text")))
    best = F.col("strongest")
    each = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(each, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by the checksum of its id, repeats some words from one place to its end."""
    found = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", crc32_of_id().alias("h"))
    cut = cut.withColumn("words", F.when(F.col("h") % 10 == 0, found))
    planted = F.expr(
        "array_join(transform(sequence(0, size(words) - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')"
    )
    cut = cut.withColumn("a", F.expr("if(size(words) > 0, h div 10 % size(words), null)"))
    cut = cut.withColumn("p", F.expr("1 + (size(words) - a) div (3 + h div 10 % 8)"))
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontamination.contaminated(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(documents(spark, sf_dir, "doc_id", "text"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_best_fit_packing,
        op2_exact_top_k,
        op3_pii,
        op4_token_counts,
        op5_simhash_near_dedup,
        op6_mix_sources,
        op7_exact_dedup,
        op8_language_id,
        op9_suffix_dedup,
        op10_toxicity,
        op11_periodic_runs,
        op12_decontamination,
        op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = {
    "op6_mix_sources": mixing.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op12_decontamination": decontamination.ORACLE,
    "op13_fill_in_middle": fill_middle.ORACLE,
}
