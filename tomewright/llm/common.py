"""Shared helpers of the corpus operators: work tables, sizing, Arrow access, labelled samples."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a labelled table that a classifier is fitted on at most; the others only get scores.
FIT_ROWS = 20_000
#: Bytes that any broadcast made here may have; larger data take a shuffled way.
BROADCAST_BYTES = 64 << 20

#: Rows of a few numbers each that a broadcast may have; as hash tables they take less than 100 MB.
BROADCAST_ROWS = 1_000_000

_own_dir: list[str] = []
#: Work tables of this process go below one folder, which clear_work removes.
_session = uuid.uuid4().hex


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a local session gets one of its own.

    On a cluster it must be set, as a folder of one machine wouldn't be seen by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        folder = tempfile.TemporaryDirectory(prefix="tomewright-")
        atexit.register(folder.cleanup)
        _own_dir.append(f"file://{folder.name}")
    return _own_dir[0]


def work_table(df: DataFrame, tag: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there, and no executor holds the only copy."""
    path = f"{shared_dir(df.sparkSession)}/work/{_session}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Remove all work tables of this process; results that weren't written before can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/work/{_session}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size; free, as it comes from file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces(df: DataFrame, each: int, factor: int = 1) -> int:
    """How many groups to deal df into so that each has about `each` bytes of text, and factor x spark.sql.shuffle.partitions at least.

    The text is measured, not estimated: a plan over memory or joins has no usable estimate.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * factor
    return max(least, (df.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // each + 1)


def row_hash() -> "F.Column":
    """With the id it tells a row from all others but those of equal id and text."""
    return F.xxhash64("doc_id", "text")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows that gone (doc_id, rid) names by id and row_hash(); a null id is compared like any other.

    gone is written and counted: few rows are broadcast, more are joined by shuffle.
    """
    gone = work_table(gone.select("doc_id", "rid").distinct(), "gone")
    few = gone.count() <= BROADCAST_ROWS
    names, own = docs.columns, "rid"
    while own in names:
        own += "_"
    gone = gone.toDF("gone_id", "gone_rid")
    rows = docs.withColumn(own, row_hash())
    on = (F.col(f"d.{own}") == F.col("g.gone_rid")) & F.col("d.doc_id").eqNullSafe(F.col("g.gone_id"))
    kept = rows.alias("d").join((F.broadcast(gone) if few else gone).alias("g"), on, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one freed memory goes back to the system, as Python workers live on between stages."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column, without a copy where possible; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def slabs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows of these sizes into runs of about `limit` in all; one row may exceed it."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to


def held_out(doc_id) -> "F.Column":
    """True for the rows no model may learn from: crc32 of the id as text, mod 4, is 2. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def labelled(documents: DataFrame, labels: DataFrame, label: str, limit: int = FIT_ROWS, learn_all: bool = False, keep: tuple[str, ...] = ("text",)) -> DataFrame:
    """At most `limit` labelled documents, (doc_id, label, *keep), those first by hash of the id: the same in every run.

    The chosen ids number `limit` at most, so they may be broadcast. Rows with a null id or label are left out; of
    several labels of one id the largest holds. learn_all also takes the held-out rows.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if not learn_all:
        own = own.where(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return documents.select("doc_id", *keep).join(F.broadcast(own), "doc_id")
