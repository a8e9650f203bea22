"""Files and folders on any storage that Hadoop's file systems reach, and tables written for later steps."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEME = "^([^/]*):/+"

_own_dir: dict[str, str] = {}
#: File systems with settings of their own.
_systems: dict[tuple, object] = {}
#: What ``materialize`` wrote, for each open ``scratch``.
_open: list[list[tuple[SparkSession, str]]] = []


def _at(spark: SparkSession, path, storage: dict[str, str] | None = None):
    """The file system of a path, and the path. ``storage``: Hadoop settings for this access alone; the session's stay as they are."""
    p, conf = spark._jvm.org.apache.hadoop.fs.Path(str(path)), spark._jsc.hadoopConfiguration()
    if not storage:
        return p.getFileSystem(conf), p
    # one of its own: Hadoop's cache of file systems does not look at settings
    key = (spark.sparkContext.applicationId, p.toUri().getScheme(), p.toUri().getAuthority(), tuple(sorted(storage.items())))
    if key not in _systems:
        conf = spark._jvm.org.apache.hadoop.conf.Configuration(conf)
        for k, v in storage.items():
            conf.set(k, str(v))
        _systems[key] = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(p.toUri(), conf)
    return _systems[key], p


def exists(spark: SparkSession, path, storage: dict[str, str] | None = None) -> bool:
    fs, p = _at(spark, path, storage)
    return fs.exists(p)


def is_folder(spark: SparkSession, path, storage: dict[str, str] | None = None) -> bool:
    fs, p = _at(spark, path, storage)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def children(spark: SparkSession, folder, storage: dict[str, str] | None = None) -> list[tuple[str, bool]]:
    """(name, is a folder) of all that lies in a folder, in order of name; nothing if it is not there."""
    fs, p = _at(spark, folder, storage)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p))


def walk(spark: SparkSession, root, closed=lambda name: False, below: str = "", storage: dict[str, str] | None = None) -> Iterator[str]:
    """Paths, relative to ``root``, of all files below it; a folder whose name is ``closed`` counts as a file."""
    for name, folder in children(spark, f"{root}/{below}", storage):
        if name[:1] in "._":
            continue
        if folder and not closed(name):
            yield from walk(spark, root, closed, f"{below}{name}/", storage)
        else:
            yield below + name


def read_text(spark: SparkSession, path, storage: dict[str, str] | None = None) -> str:
    fs, p = _at(spark, path, storage)
    if not fs.exists(p):
        raise FileNotFoundError(f"there is no {path}")
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path, storage: dict[str, str] | None = None) -> str | None:
    """The first line of a text file that is not blank, unpacked if need be; no more than a buffer of the file is read."""
    fs, p = _at(spark, path, storage)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(p)
    stream = fs.open(p)
    try:
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip("\ufeff \t"):
                return line.lstrip("\ufeff")
        return None
    finally:
        stream.close()


def parquet_schema(spark: SparkSession, path, storage: dict[str, str] | None = None) -> str:
    """The schema in a Parquet file's footer, as text."""
    fs, p = _at(spark, path, storage)
    parquet = spark._jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(p, fs.getConf()))
    try:
        return reader.getFileMetaData().getSchema().toString()
    finally:
        reader.close()


def url(spark: SparkSession, path, storage: dict[str, str] | None = None) -> str:
    """A path as ``read_from`` writes it."""
    fs, p = _at(spark, path, storage)
    return re.sub(_SCHEME, r"\1:/", fs.makeQualified(p).toUri().toString())


def read_from() -> Column:
    """The file that a row was read from; how many slashes follow the scheme is not the same everywhere."""
    return F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, "$1:/")


def write_text(spark: SparkSession, path, parts, storage: dict[str, str] | None = None) -> None:
    """Write a text, or several one after the other."""
    fs, p = _at(spark, path, storage)
    stream = fs.create(p, True)
    try:
        for part in [parts] if isinstance(parts, str) else parts:
            stream.write(bytearray(part.encode()))
    finally:
        stream.close()


def write_lines(lines: DataFrame, path, storage: dict[str, str] | None = None) -> None:
    """One column of text as one file of lines, written by the task that has them all."""
    spark, folder = lines.sparkSession, f"{path}-{uuid.uuid4().hex}"
    lines.write.options(**storage or {}).text(folder, compression="none")
    [part] = [name for name, _ in children(spark, folder, storage) if name.startswith("part-")]
    move(spark, f"{folder}/{part}", path, storage)
    delete(spark, folder, storage)


def visible(spark: SparkSession, path, storage: dict[str, str] | None = None) -> str:
    """A copy in the shared folder of a file whose name Spark's readers leave out; no more than a buffer of it is in memory."""
    fs, p = _at(spark, path, storage)
    if not fs.exists(p):
        raise FileNotFoundError(f"there is no {path}")
    copy = scratch_path(spark, "copy")
    if _open:
        _open[-1].append((spark, copy))
    to, target = _at(spark, copy)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, target, False, fs.getConf())
    return copy


def move(spark: SparkSession, source, target, storage: dict[str, str] | None = None) -> None:
    """Rename a file or folder; folders above the target are made. OSError if the storage refuses."""
    fs, p = _at(spark, source, storage)
    to = spark._jvm.org.apache.hadoop.fs.Path(str(target))
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"{source} cannot be moved to {target}")


def delete(spark: SparkSession, path, storage: dict[str, str] | None = None) -> None:
    """Delete a file or folder with all that is in it, if it is there."""
    fs, p = _at(spark, path, storage)
    fs.delete(p, True)


def literal(path) -> str:
    """A path in which no character is a wildcard to Spark's readers."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", str(path))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; unset, a temporary one in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="chronoweave-")
    return "file://" + _own_dir[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``materialize`` writes inside are deleted at its end."""
    _open.append([])
    try:
        yield
    finally:
        for spark, path in _open.pop():
            delete(spark, path)


def materialize(df: DataFrame, tag: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut and a lost executor costs one reread.

    ``files``: how many files its rows fill at most, from a count that bounds them; many nearly empty files cost more than their rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    if _open:
        _open[-1].append((spark, path))
    (df if files is None else df.coalesce(max(1, files))).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more; others stay."""
    for table in tables:
        if path := getattr(table, "_written_to", None):
            delete(table.sparkSession, path)
