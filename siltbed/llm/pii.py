r"""Personal data by candidate gradient boosting, in DataFrame functions only.

Rules find the base spans: each kind's pattern, leftmost and without overlaps, and its
test (parts of an address at most 255, the check digit of a card, the digits of a
phone). Generators with high recall propose further spans, which overlap each other and
the base spans: loosely written addresses, groups of digits as phones and as cards, four
groups of digits as network addresses. Boosted trees rate them by format (length, digits,
groups, separators) and context (characters and words beside them), and not by the
rules' own tests. They learn from all documents: a proposal is positive if it overlaps a
base span of its kind. Proposals are counted by feature values first, so training
reads a table whose size depends on the values, not on the corpus. A kind's threshold is the
lowest score whose precision in the other half of the documents is ``PRECISION``.
Proposals at or above it are added, unless they overlap a base span or an added span that
starts before. Base spans always stay.

A document is scanned once where it is read; what is found there is written, exploded,
placed by the lengths of the text between matches, and gathered by document.
Patterns are possessive, so long runs take linear time and no deep stack.

Null text counts as empty: no spans. Repeated documents get the same result each. An
empty table gives an empty result. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltbed.llm.common import written

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with possessive repeats and starts that change no match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: pattern, and the kinds each match is proposed for.
LOOSE = {
    "written": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|[\[(]at[\])])\x20?"
        r"[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)*+",
        ("email",),
    ),
    "quads": (r"(?:\G|(?<![0-9]))[0-9]++(?:[.:_-][0-9]++){3}+", ("ip",)),
    "digits": (r"\+?\(?[0-9](?:[\x20().\x2F-]{0,3}+[0-9])++", ("card", "phone")),
}
#: What a text must contain for a pattern to be worth looking for.
NEEDS = {"email": "@", "written": r"@|[\[(]at[\])]"}
HINTS = {
    "email": r"(?i)mail|contact|write|@", "ip": r"(?i)\bip\b|host|server|addr",
    "card": r"(?i)card|visa|credit|pay|account", "phone": r"(?i)tel|phone|call|mobile|fax",
}
LEFT, RIGHT = 24, 8
PRECISION = 0.95
TREES, DEPTH = 6, 3
FEATURES = ("kind_no", "digits", "letters", "signs", "groups", "longest", "before", "after", "hint")


def matches(text: Column, name: str, pattern: str) -> Column:
    """Matches of a pattern with the length of the text since the last one, and context."""
    need = F.regexp_like(text, F.lit(NEEDS.get(name, "[0-9][^a-zA-Z]*[0-9]")))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def one(match: Column, i: Column) -> Column:
        gap, rest = F.get(between, i), F.get(between, i + 1)
        return F.struct(
            F.length(gap).cast("long").alias("gap"),
            match.alias("match"),
            F.right(gap, F.lit(LEFT)).alias("left"),
            F.left(rest, F.lit(RIGHT)).alias("right"),
        )

    some = F.when(need, found)
    return F.when(F.size(some) > 0, F.transform(some, one))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id and the matches of each pattern; texts are not kept."""
    text = F.coalesce("text", F.lit(""))
    patterns = {**BASE, **{name: pattern for name, (pattern, _) in LOOSE.items()}}
    found = {name: matches(text, name, pattern) for name, pattern in patterns.items()}
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", *[c.alias(n) for n, c in found.items()]
    )


def placed(found: DataFrame, name: str) -> DataFrame:
    """Rows of one pattern: row, start, end, match, left, right."""
    rows = found.filter(F.size(name) > 0).select("row", F.posexplode(name).alias("i", "m"))
    upto = Window.partitionBy("row").orderBy("i")
    length = F.length("m.match").cast("long")
    end = F.sum(F.col("m.gap") + length).over(upto)
    return rows.select(
        "row", (end - length).alias("start"), end.alias("end"), "m.match", "m.left", "m.right"
    )


def valid(kind: str) -> Column:
    """The test of a base match."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return F.regexp_like("match", F.lit(rf"^(?:{part}|0++)(?:\.(?:{part}|0++)){{3}}$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(8, 15)


def base_spans(found: DataFrame) -> DataFrame:
    """row, kind_no, start, end of the base spans."""
    each = [
        placed(found, kind).filter(valid(kind)).select("row", F.lit(i).alias("kind_no"), "start", "end")
        for i, kind in enumerate(KINDS)
    ]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def _side(text: Column, pattern_of: str) -> Column:
    """Class of the character next to a span: none, space, letter, digit, other."""
    at = [("^$", 0), (pattern_of.format(r"\s"), 1), (pattern_of.format(r"\p{L}"), 2), (pattern_of.format("[0-9]"), 3)]
    out = F.lit(4)
    for pattern, value in reversed(at):
        out = F.when(F.regexp_like(text, F.lit(pattern)), value).otherwise(out)
    return out


def proposals(found: DataFrame) -> DataFrame:
    """row, kind_no, start, end and features of the proposed spans."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    groups = F.split("match", "[^0-9]+")
    out = None
    for name, (_, kinds) in LOOSE.items():
        rows = placed(found, name)
        for kind in kinds:
            least, most = {"phone": (7, 15), "card": (13, 19)}.get(kind, (0, 1 << 20))
            own = rows.filter(F.length(digits).between(least, most)).select(
                "row",
                F.lit(KINDS.index(kind)).alias("kind_no"),
                "start",
                "end",
                F.least(F.length(digits), F.lit(20)).alias("digits"),
                F.least(F.length(F.regexp_replace("match", "[^A-Za-z]", "")), F.lit(20)).alias("letters"),
                # A plus is the rule's own test of a phone.
                F.least(F.length(F.regexp_replace("match", "[A-Za-z0-9+]", "")), F.lit(8)).alias("signs"),
                F.least(F.size(F.filter(groups, lambda g: g != "")), F.lit(8)).alias("groups"),
                F.least(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(20)).alias("longest"),
                _side(F.col("left"), "{}$").alias("before"),
                _side(F.col("right"), "^{}").alias("after"),
                F.regexp_like("left", F.lit(HINTS[kind])).cast("int").alias("hint"),
            )
            out = own if out is None else out.unionByName(own)
    return out


def beside(spans: DataFrame, base: DataFrame, same_kind: bool) -> DataFrame:
    """Adds ``overlaps``: whether a span overlaps a base span (of its kind)."""
    keys = ["row", "kind_no"] if same_kind else ["row"]
    one = spans.select("*", F.lit(None).cast("long").alias("b_start"), F.lit(None).cast("long").alias("b_end"))
    two = base.select("row", "kind_no", "start", "end", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    both = one.unionByName(two, allowMissingColumns=True)
    # At equal starts a window range takes in all, so ties need no order.
    before = Window.partitionBy(*keys).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*keys).orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    hit = (F.max("b_end").over(before) > F.col("start")) | (F.min("b_start").over(after) < F.col("end"))
    return both.withColumn("overlaps", F.coalesce(hit, F.lit(False))).filter("b_start is null").drop("b_start", "b_end")


def selected(rated: DataFrame, base: DataFrame) -> DataFrame:
    """row, kind_no, start, end of the proposals that are added."""
    spark = rated.sparkSession
    none = spark.createDataFrame([], "row long, kind_no int, start long, end long")
    fold = F.pmod(F.xxhash64("row"), F.lit(2))
    counted = rated.groupBy(*FEATURES, F.col("overlaps").cast("int").alias("label")).agg(
        F.sum((fold == 0).cast("double")).alias("n_fit"), F.sum((fold == 1).cast("long")).alias("n_check")
    )
    # Aggregated in parallel; the few cells are put together afterwards.
    cells = written(written(counted, "counts").coalesce(1), "cells")
    fit = cells.filter("n_fit > 0")
    if fit.select("label").distinct().count() < 2:
        return none
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(
        labelCol="label", weightCol="n_fit", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1,
        checkpointInterval=-1,
    )
    model = trees.fit(vector.transform(fit).select("features", "label", "n_fit"))

    def score(rows: DataFrame) -> DataFrame:
        rows = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
        return rows.drop("features", "rawPrediction", "probability", "prediction")

    upto = Window.partitionBy("kind_no").orderBy(F.desc("score"))
    right = F.sum(F.col("n_check") * F.col("label")).over(upto)
    good = score(cells).withColumn("precision", F.try_divide(right, F.sum("n_check").over(upto)))
    limits = good.filter(F.col("precision") >= PRECISION).groupBy("kind_no").agg(F.min("score").alias("limit"))
    limit = F.lit(None).cast("double")
    for row in limits.collect():  # one row a kind
        limit = F.when(F.col("kind_no") == row["kind_no"], row["limit"]).otherwise(limit)
    new = score(rated.filter("not overlaps")).filter(F.col("score") >= limit)
    new = beside(new.select("row", "kind_no", "start", "end"), base, same_kind=False).filter("not overlaps")
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(earlier), F.lit(-1))
    return new.filter(~F.col("overlaps")).withColumn("reach", reach).filter("reach <= start").select("row", "kind_no", "start", "end")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind and start."""
    names = F.array(*map(F.lit, KINDS))
    texts = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])
    )
    return F.concat_ws(",", texts)


def find(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_<kind> and base_sha256 of base spans, all spans."""
    found = written(scanned(docs.select("doc_id", "text")), "matches")
    base = written(base_spans(found), "base_spans")
    rated = written(beside(proposals(found), base, same_kind=True), "proposals")
    spans = base.withColumn("base", F.lit(True)).unionByName(selected(rated, base).withColumn("base", F.lit(False)))
    span = F.struct("kind_no", "start", "end")
    each = spans.groupBy("row").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind_no") == i), 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.collect_list(F.when(F.col("base"), span)).alias("own"),
        F.collect_list(span).alias("every"),
    )
    each = written(each, "spans_by_document")
    joined = found.select("row", "doc_id").join(each, "row", "left")
    none = F.array().cast("array<struct<kind_no:int,start:bigint,end:bigint>>")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.coalesce("own", none)).cast("binary"), 256).alias("base_sha256"),
        listed(F.coalesce("every", none)).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "*") -> DataFrame:
    """``docs`` with every character of every span replaced; ids must be unique."""
    spans = find(docs).select("doc_id", F.split("spans", ",").alias("__spans"))
    place = lambda s, i: F.get(F.split(s, ":"), F.lit(i)).cast("int")
    cover = lambda t, s: F.overlay(
        t, F.repeat(F.lit(mask), place(s, 2) - place(s, 1)), place(s, 1) + 1, place(s, 2) - place(s, 1)
    )
    some = F.filter("__spans", lambda s: s != "")
    masked = F.aggregate(some, F.col("text"), cover)
    return docs.join(spans, "doc_id").withColumn("text", masked).select(*docs.columns)
