"""Thin file-system calls through Hadoop, so every Spark storage scheme works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark's file sources print it."""
    fs, target = _path(spark, path)
    return fs.makeQualified(target).toString()


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names directly below ``path``, with a flag for directories."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)]


def has_data(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds anything Spark would read as a table."""
    return any(not name.startswith(("_", ".")) for name, _ in children(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Delete one file, given as Spark prints paths (percent-encoded)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(target) and not fs.delete(target, False):
        raise OSError(f"could not delete {path}")


def decoded(spark: SparkSession, path: str) -> str:
    """A path that Spark prints percent-encoded, as readers take it."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)).toString()


def first_bytes(spark: SparkSession, path: str, most: int) -> bytes:
    """The start of a file given as Spark prints paths."""
    fs, target = _path(spark, decoded(spark, path))
    stream = fs.open(target)
    try:
        return bytes(stream.readNBytes(most))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, staged: str, text: str, path: str) -> None:
    """Write ``text`` to ``staged`` and make it appear at ``path`` by a rename."""
    fs, first = _path(spark, staged)
    stream = fs.create(first, True)
    try:
        spark._jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
    finally:
        stream.close()
    _rename(fs, first, _path(spark, path)[1])


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path``, named from there."""
    fs, target = _path(spark, path)
    base = fs.makeQualified(target).toString().rstrip("/") + "/"
    found, names = fs.listFiles(target, True), []
    while found.hasNext():
        names.append(found.next().getPath().toString().removeprefix(base))
    return sorted(names)


def move_in(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, unless that was done before."""
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    if fs.exists(old):
        fs.mkdirs(new.getParent())
        _rename(fs, old, new)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    fs, target = _path(spark, path)
    fs.delete(target, True)


def delete_on_exit(spark: SparkSession, folder: str) -> None:
    """Create ``folder`` if need be, and have the JVM remove it when it ends."""
    fs, target = _path(spark, folder)
    # Hadoop only remembers paths that exist.
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def beside(path: str, prefix: str) -> str:
    """A path beside ``path``, hidden from table readers if the prefix starts with ``_``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{prefix}{name}" if parent else f"{prefix}{name}"


def next_version(path: str) -> str:
    """Where the replacement of ``path`` is written; hidden from table readers."""
    return beside(path, "_next_")


def previous_version(path: str) -> str:
    return beside(path, "_previous_")


def recover(spark: SparkSession, path: str) -> None:
    """Undo a swap that stopped between its two renames."""
    fs, target = _path(spark, path)
    _, kept = _path(spark, previous_version(path))
    if not fs.exists(target) and fs.exists(kept):
        _rename(fs, kept, target)


def swap_in(spark: SparkSession, path: str) -> None:
    """Make ``next_version(path)`` the table at ``path``."""
    fs, target = _path(spark, path)
    _, staged = _path(spark, next_version(path))
    _, kept = _path(spark, previous_version(path))
    if fs.exists(target):
        fs.delete(kept, True)
        _rename(fs, target, kept)
    _rename(fs, staged, target)
    fs.delete(kept, True)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source.toString()} to {target.toString()}")
