"""Time the headline operators; prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and reports the median of
``$BENCH_RUNS`` warm runs. With ``--compare`` some operators are also timed with one
of their own steps left out: ties left open, output not gathered, nothing written,
no frame shared between writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import siltbed
from siltbed.checks import lake
from siltbed.checks.inputs import CSV_TEXT, orders_by_month, raw_events, table
from siltbed.plans.load import LoadOptions
from siltbed.session import local_session, scratch_path
from siltbed.sinks.lake import write_partitioned
from siltbed.sources.files import raw_subtrees

MONTHS = ["Year", "Month"]
Runs = dict[str, Callable[[], object]]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def items_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumns(
        {"Year": F.year("l_shipdate"), "Month": F.month("l_shipdate")}
    )


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta of the checked upsert."""
    changed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    rows = orders_by_month(spark, sf_dir).filter("Year = 1996").join(changed, "o_orderkey", "left_semi")
    return rows.withColumns({"o_totalprice": F.lit(0.0), "ing": F.lit(2)})


def headline(spark: SparkSession, sf_dir: str, inputs: dict[str, str]) -> Runs:
    raw, items = raw_events(spark, sf_dir), items_by_month(spark, sf_dir)
    events = siltbed.dates_from_path(raw)
    changes = delta(spark, sf_dir)

    def history() -> None:
        siltbed.overwrite_partitions(
            items, inputs["history"], ["l_orderkey", "l_linenumber"], MONTHS, ["l_shipdate"], extra_keys=MONTHS
        )

    # The work that the baseline was measured for: a plain append, without a ledger of loaded files.
    def load(options: LoadOptions = LoadOptions(once=False)) -> None:
        paths = raw_subtrees(spark, inputs["raw"])
        siltbed.load_table(spark, lake.LOAD_SPEC, scratch_path(spark, "load"), paths, None, options)

    return {
        "latest_row_per_key": lambda: consume(siltbed.latest_rows(events, ["user_id", "event_type"])),
        "latest_file_per_partition": lambda: consume(siltbed.latest_files(events, "event_type")),
        "rows_of_latest_file": lambda: consume(siltbed.rows_of_latest_file(raw, "event_type")),
        "recent_partition_upsert": lambda: siltbed.upsert_partitions(
            changes, inputs["curated"], ["o_orderkey"], MONTHS, ["ing"]
        ),
        "history_overwrite_by_date": history,
        "strip_html": lambda: consume(siltbed.strip_html(table(spark, sf_dir, "pages"), ["html"])),
        "csv_multi_file_scan": lambda: consume(siltbed.read_raw(spark, inputs["csv"])),
        "file_inventory": lambda: consume(siltbed.file_inventory(spark, inputs["raw"])),
        "load_table_end_to_end": load,
    }


def variants(spark: SparkSession, sf_dir: str, inputs: dict[str, str]) -> Runs:
    """The same operators with one of their own steps left out."""
    raw, items = raw_events(spark, sf_dir), items_by_month(spark, sf_dir)
    events = siltbed.dates_from_path(raw)
    changes = delta(spark, sf_dir)
    ours = headline(spark, sf_dir, inputs)

    def ungathered() -> None:
        stored = spark.read.parquet(inputs["curated_plain"])
        both = siltbed.union_delta(siltbed.touched_partitions(stored, changes, MONTHS), changes)
        rows = siltbed.latest_rows(both, ["o_orderkey", *MONTHS], order=["ing"])
        dynamic = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dynamic.partitionBy(*MONTHS).parquet(inputs["curated_plain"])

    return {
        "latest_row_per_key": lambda: consume(
            siltbed.latest_rows(events, ["user_id", "event_type"], tie_breakers=[])
        ),
        "recent_partition_upsert": ungathered,
        "history_overwrite_by_date": lambda: consume(
            siltbed.latest_rows(items, ["l_orderkey", "l_linenumber", *MONTHS], order=["l_shipdate"])
        ),
        "load_table_end_to_end": lambda: ours["load_table_end_to_end"](LoadOptions(storage=None, once=False)),
    }


def prepared(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Files that the timed operators read or change."""
    names = ("curated", "curated_plain", "history", "csv")
    inputs = {name: scratch_path(spark, f"bench-{name}") for name in names}
    orders = orders_by_month(spark, sf_dir)
    for name in ("curated", "curated_plain"):
        write_partitioned(orders, inputs[name], MONTHS)
    documents = table(spark, sf_dir, "documents").drop("n_chars")
    documents.repartition(8).write.options(**CSV_TEXT).csv(inputs["csv"])
    inputs["raw"] = lake.event_csv(spark, sf_dir, "bench-raw")
    return inputs


def timed(sets: dict[str, Runs], repeats: int) -> dict[str, dict[str, float]]:
    """Median seconds by set and name, interleaved after a warm-up round.

    Compared runs so meet the same state of the JVM.
    """
    samples = {label: {name: [] for name in runs} for label, runs in sets.items()}
    for lap in range(repeats + 1):
        for name in next(iter(sets.values())):
            # Take turns in going first.
            for label, runs in sorted(sets.items(), reverse=lap % 2 == 0):
                if name not in runs:
                    continue
                start = time.perf_counter()
                runs[name]()
                taken = time.perf_counter() - start
                if lap:
                    samples[label][name].append(taken)
                print(f"{lap} {label} {name}: {taken:.3f}", file=sys.stderr, flush=True)
    return {
        label: {name: round(statistics.median(taken), 3) for name, taken in by_name.items()}
        for label, by_name in samples.items()
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("siltbed-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    inputs = prepared(spark, sf_dir)
    sets = {"queries": headline(spark, sf_dir, inputs)}
    if "--compare" in sys.argv[1:]:
        sets["variants"] = variants(spark, sf_dir, inputs)
    seconds = timed(sets, int(os.environ.get("BENCH_RUNS", "3")))
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds["queries"].values()), 3),
        "unit": "sec",
        **seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
