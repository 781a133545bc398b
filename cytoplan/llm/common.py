"""Shared plumbing: tables, the shared folder, materialised stages, bounded broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that may be sent to every executor. Beyond either the same join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: ASCII white space of the text contracts.
WS_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

_made: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A temporary one is made only where none is set and all tasks run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cytoplan-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_dir(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/cytoplan-{uuid.uuid4().hex}/{tag}"
    _made.append((spark, path.rpartition("/")[0]))
    return path


@atexit.register
def _drop_made() -> None:
    for spark, path in _made:
        try:
            sc = spark.sparkContext
            hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)
        except Exception:  # the session is gone: whoever owns the folder clears it
            return


def give_back() -> None:
    """Returns freed memory of the driver's Python to the system, where its allocator can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def brief_plans(spark: SparkSession):
    """Plans that run meanwhile are described in few words: the driver keeps the text of a thousand of them."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_dir(spark, tag)
    with brief_plans(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if a materialised table is within the bounds of rows and bytes, else leave a shuffle join."""
    wide = F.lit(0).cast("long")
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        own = F.octet_length(f.name) if kind in ("string", "binary") else F.size(f.name) * 16 if kind in ("array", "map") else F.lit(16)
        wide += F.coalesce(own, F.lit(0)).cast("long") + 8
    n, most = df.select(wide.alias("b")).limit(rows + 1).agg(F.count("*"), F.sum("b")).first()
    return F.broadcast(df) if n <= rows and (most or 0) <= size else df


def keep_one_row(docs: DataFrame, key: Column, rows: DataFrame) -> DataFrame:
    """docs without the rows whose key is in rows(key, kept) unkept; a kept key keeps one row.

    rows needs to list only keys that lose a row. Texts are shuffled only beyond the broadcast bound."""
    listed = materialize(rows.groupBy("key").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("n > 1 or not kept"), "losing")
    losing, repeated = listed.select("key"), listed.where("kept").select("key")
    own = free_name(docs, "key_of_row")
    marked = docs.withColumn(own, key)
    stay = marked.join(small_side(losing), marked[own].eqNullSafe(losing["key"]), "left_anti")
    one = marked.join(small_side(repeated), marked[own].eqNullSafe(repeated["key"]), "left_semi").dropDuplicates([own])
    return stay.unionByName(one).drop(own)


def free_name(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def drop_ascii_space(c: Column) -> Column:
    for ch in WS_CHARS:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def arrow_rows(spark: SparkSession, rows: int = 512) -> None:
    """Rows of an Arrow batch: texts may be very long, so batches are kept short."""
    spark.conf.set(ARROW_ROWS, str(rows))


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int):
    """Queries that run meanwhile have this many rows to an Arrow batch; those after it what was set before."""
    before = spark.conf.get(ARROW_ROWS)
    arrow_rows(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def local_path(uri: str) -> str | None:
    """The path that open() takes, or None for another file system."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


class SharedFiles:
    """Whole-file access for executors to the shared folder, local or not."""

    def __init__(self, base: str):
        self.base = base

    def _fs(self):
        import pyarrow.fs as pafs

        path = local_path(self.base)
        return (pafs.LocalFileSystem(), path) if path else pafs.FileSystem.from_uri(self.base)

    def create(self, name: str, write) -> None:
        """write(stream) fills an attempt's own file, which a rename then publishes."""
        fs, base = self._fs()
        fs.create_dir(base, recursive=True)
        part = f"{base}/.{name}.{uuid.uuid4().hex}"
        try:
            with fs.open_output_stream(part, compression=None) as out:
                write(out)
            fs.move(part, f"{base}/{name}")
        except BaseException:
            if fs.get_file_info(part).size is not None:
                fs.delete_file(part)
            raise

    def open(self, name: str):
        fs, base = self._fs()
        return fs.open_input_file(f"{base}/{name}")

    def open_stream(self, name: str):
        fs, base = self._fs()
        return fs.open_input_stream(f"{base}/{name}", compression=None)


def unique_name(prefix: str, suffix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
