"""What several operators share: the cluster's shared folder, checks of columns, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A letter A-Z becomes a letter a-z; no other code point changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names.

    Where none is named, a session without executors of its own, as in tests, uses a temporary folder;
    any other is refused, since its executors could not see such a folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is stored or cut within is removed at the end, but for what is stored with ``keep``."""
    path = f"{shared_folder(spark)}/temporary-{uuid.uuid4().hex}"
    before = _OWNER.set(path)
    try:
        yield
    finally:
        _OWNER.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, with its lineage cut."""
    return stored(df, "cut")


def stored(df: DataFrame, name: str, *, keep: bool = False) -> DataFrame:
    """``df`` written once as a compressed table into the shared folder and read back."""
    owner = None if keep else _OWNER.get()
    path = f"{owner or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows that a task hands to Python at once, whatever the length of its texts.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs within hands rows to Python in batches of ``BATCH_BYTES``, and a row at least; restored at the end.

    A batch is held in the JVM and in Python, and so is what is made of it; in Spark's own 10,000 rows, texts take tens of MB.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """The tables of one operator call, in a folder of its own under the shared one.

    A table that no returned DataFrame reads is dropped as soon as it has been used.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back."""
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lowered and every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Bits of a bitmap of keys: 8 MB, whatever the table. A full one holds nothing back, and no more.
BITS = 1 << 26


def bitmap(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for each value of the one long column of ``keys``; at most ``bits / 64`` rows are collected."""
    key = F.pmod(F.col(keys.columns[0]), F.lit(bits))
    cells = (
        keys.select(F.floor(key / 64).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("long"), (key % 64).cast("int")).alias("bits"))
        .groupBy("cell")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out


def marked(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` may be in the bitmap; one that is in it always is."""
    bit = keys % (len(held) * 64)
    return (held[bit >> 6] >> (bit & 63)) & 1 == 1


def rows_marked(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose long ``column`` may be among ``keys``, so that a join shuffles few others."""
    held = df.sparkSession.sparkContext.broadcast(bitmap(keys))
    at = df.columns.index(column)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(marked(held.value, b.column(at).to_numpy(zero_copy_only=False))))
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(batch, df.schema)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the component's least node.

    Alternating large-star and small-star rounds: each is one minimum per node, combined before its
    shuffle, and one join. No node's neighbours meet in one row, and a hot node's join can be split.
    Null ends and loops link nothing. An empty table gives an empty result.
    """
    now = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(least.withColumnRenamed("m", "v"))
            .distinct()
        )
        now = cut(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
