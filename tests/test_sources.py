"""Finding and reading raw files, and the database readers and writers."""

import datetime as dt

import pytest

from siltbed import (
    copy_to_jdbc,
    dates_from_path,
    file_inventory,
    log_partition_changes,
    raw_subtrees,
    read_jdbc,
    read_raw,
    write_jdbc,
)
from siltbed.sources.files import rows_of_files

MARK = dt.datetime(2021, 4, 6, 3, 7)


def put(root, folder, name, text, encoding="utf-16"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_bytes(text.encode(encoding))


def minute(year, month, day, hour, minute_):
    return f"year={year}/month={month:02}/day={day:02}/hour={hour:02}/minute={minute_:02}"


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "raw"
    put(root, minute(2020, 12, 31, 23, 59), "old_20201231-235900.csv", "a,b\n0,old\n")
    put(root, minute(2021, 4, 6, 3, 0), "hour.csv", "a,b\n1,hour\n")
    put(root, minute(2021, 4, 6, 3, 7), "x_20210406-030102.csv", 'a,b\n2,"say ""hi""\nthere"\n')
    put(root, minute(2021, 4, 6, 3, 8), "y file.csv", "a,b\n3,next\n")
    put(root, minute(2021, 4, 7, 0, 0), "zero.csv", "", "utf-8")
    put(root, minute(2022, 1, 1, 0, 0), "note.txt", "a\n4\n")
    put(root, "loose", "loose.csv", "a,b\n5,loose\n")
    put(root, "_hidden", "hidden.csv", "a,b\n6,hidden\n")
    return root


def names(df):
    return sorted(r["fileName"] for r in df.collect())


def test_inventory_columns_and_times(spark, tree):
    files = file_inventory(spark, str(tree), "*.csv", after=MARK)
    found = {r["fileName"]: r for r in files.collect()}
    assert sorted(found) == ["x_20210406-030102", "y file"]
    stamped = found["x_20210406-030102"]
    assert stamped["ingestionDate"] == MARK
    assert stamped["extractDate"] == dt.datetime(2021, 4, 6, 3, 1, 2)
    assert stamped["DataLakePathRaw"] == str(tree)
    assert stamped["filePath"].endswith("minute=07/x_20210406-030102.csv")
    assert stamped["fileSize"] > 0
    assert found["y file"]["extractDate"] == dt.datetime(2021, 4, 6, 3, 8)


def test_inventory_mark_floor_size_and_bound(spark, tree):
    root = str(tree)
    assert names(file_inventory(spark, root, after=MARK, floor=None)) == ["note", "y file"]
    assert names(file_inventory(spark, root, after=MARK, floor=None, min_size=20)) == ["y file"]
    until = dt.datetime(2021, 12, 31)
    assert names(file_inventory(spark, root, after=MARK, until=until, floor=None)) == ["y file"]
    assert "loose" in names(file_inventory(spark, root))
    with pytest.raises(ValueError):
        file_inventory(spark, root, after=MARK, floor="day")


def test_inventory_of_several_and_nested_roots(spark, tree):
    other = tree.parent / "other"
    put(other, minute(2021, 5, 1, 0, 0), "o.csv", "a\n1\n")
    both = file_inventory(spark, [str(tree), str(other), str(tree / "absent")], "*.csv", after=MARK)
    assert {(r["fileName"], r["DataLakePathRaw"]) for r in both.collect()} == {
        ("x_20210406-030102", str(tree)),
        ("y file", str(tree)),
        ("o", str(other)),
    }
    nested = file_inventory(spark, [str(tree), str(tree / "year=2022")], "*.txt")
    assert {r["DataLakePathRaw"] for r in nested.collect()} == {str(tree), str(tree / "year=2022")}
    assert nested.count() == 2


def test_inventory_of_nothing(spark, tmp_path):
    files = file_inventory(spark, str(tmp_path / "absent"), after=MARK)
    assert files.isEmpty() and files.columns[:2] == ["fileName", "filePath"]


def test_subtrees_open_only_boundaries(spark, tree):
    root = str(tree)
    below = [p.removeprefix(root + "/") for p in raw_subtrees(spark, root, MARK)]
    assert sorted(below) == [
        minute(2021, 4, 6, 3, 8),
        "year=2021/month=04/day=07",
        "year=2022",
    ]
    until = dt.datetime(2021, 4, 6, 3, 7, 30)
    below = [p.removeprefix(root + "/") for p in raw_subtrees(spark, root, None, until, True)]
    assert sorted(below) == [
        "loose",
        "year=2020",
        minute(2021, 4, 6, 3, 0),
        minute(2021, 4, 6, 3, 7),
    ]
    assert raw_subtrees(spark, root) == [root]


def test_csv_text_survives(spark, tree):
    df = read_raw(spark, raw_subtrees(spark, str(tree), MARK.replace(minute=0))[:1])
    row = df.first()
    assert (row["a"], row["b"]) == ("2", 'say "hi"\nthere')
    assert row["path"].endswith("x_20210406-030102.csv")


def test_rows_of_files_joins_across_path_spellings(spark, tree):
    rows = dates_from_path(read_raw(spark, str(tree), options={"pathGlobFilter": "*.csv"}))
    files = file_inventory(spark, str(tree), "*.csv", after=MARK, floor=None)
    assert [r["b"] for r in rows_of_files(rows, files).collect()] == ["next"]


def test_csv_headers_can_be_checked(spark, tmp_path):
    put(tmp_path, "t", "1.csv", "a,b\n1,2\n")
    put(tmp_path, "t", "2.csv", "b,a\n3,4\n")
    assert read_raw(spark, str(tmp_path / "t")).count() == 2
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path / "t"), check_headers=True).collect()


def test_separator_and_encoding(spark, tmp_path):
    put(tmp_path, "t", "1.csv", "a|b\n1|é\n", "utf-8")
    row = read_raw(spark, str(tmp_path / "t"), sep="|", encoding="UTF-8").first()
    assert (row["a"], row["b"]) == ("1", "é")


def test_json_lines_and_documents(spark, tmp_path):
    put(tmp_path, "lines", "1.json", '{"a": 1}\n{"a": 2}\n', "utf-8")
    put(tmp_path, "document", "1.json", '[{"a": 1},\n{"a": 2}]', "utf-8")
    assert read_raw(spark, str(tmp_path / "lines"), "json", "a int").count() == 2
    document = read_raw(spark, str(tmp_path / "document"), "json", "a int", multi_line=True)
    assert sorted(r["a"] for r in document.collect()) == [1, 2]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, str(tmp_path / "document"), "json", "a int").collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_raw(spark, "/x", "xlsx")


class Calls:
    """Stands in for a Spark reader or writer and keeps what it is given."""

    def __init__(self):
        self.given = {}

    def format(self, name):
        self.given["format"] = name
        return self

    def mode(self, name):
        self.given["mode"] = name
        return self

    def option(self, name, value):
        self.given[name] = value
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def load(self):
        return self.given

    save = load


class Holder:
    def __init__(self):
        self.read = self.write = Calls()


# No database is started for these: they check what Spark's reader and writer
# are asked to do.
def test_jdbc_read_options():
    given = read_jdbc(Holder(), "jdbc:x", " SELECT 1 ", {"user": "u"}, alias="t")
    assert given == {"format": "jdbc", "url": "jdbc:x", "dbtable": "(SELECT 1) t", "user": "u"}
    given = read_jdbc(
        Holder(), "jdbc:x", "s.t", partition_column="k", bounds=(0, 9), num_partitions=3
    )
    assert given["dbtable"] == "s.t"
    assert (given["partitionColumn"], given["lowerBound"], given["upperBound"]) == ("k", "0", "9")
    with pytest.raises(ValueError):
        read_jdbc(Holder(), "jdbc:x", "s.t", partition_column="k")


def test_jdbc_write_options():
    frame = Holder()
    write_jdbc(frame, "jdbc:x", "s.t", properties={"user": "u"}, truncate=True, num_partitions=4, batch_size=9)
    assert frame.write.given == {
        "format": "jdbc",
        "mode": "overwrite",
        "url": "jdbc:x",
        "dbtable": "s.t",
        "user": "u",
        "truncate": "true",
        "numPartitions": "4",
        "batchsize": "9",
    }


def test_jdbc_copy_and_log(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(
        "siltbed.sinks.jdbc.write_jdbc",
        lambda df, url, table, *rest, **options: written.append((df.collect(), table, *rest)),
    )
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    copy_to_jdbc(spark, path, "jdbc:x", "s.users")
    assert len(written[0][0]) == 2 and written[0][1] == "s.users"
    df = spark.createDataFrame(
        [(2024, "p", MARK, MARK)],
        "Year int, path string, ingestionDateTime timestamp_ntz, extractDateTime timestamp_ntz",
    )
    log_partition_changes(df, ["Year"], "t", "jdbc:x", "s.log")
    assert written[1][0][0]["PartitionLocation"] == "Year=2024"
    assert written[1][1:3] == ("s.log", "append")


def test_inventory_tasks_follow_the_cluster_not_the_bytes(spark, tmp_path):
    for k in range(60):
        folder = tmp_path / "raw" / minute(2024, 1, 1, 0, k)
        folder.mkdir(parents=True)
        with open(folder / "big.csv", "wb") as sparse:
            sparse.truncate(300 << 20)
    files = file_inventory(spark, str(tmp_path / "raw"))
    assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert files.agg({"fileSize": "sum"}).first()[0] == 60 * (300 << 20)
