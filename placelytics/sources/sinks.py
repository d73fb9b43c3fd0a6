"""Partitioned output."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def with_partitions(
    df: DataFrame, *, date: str = "date", place: bool = True, day: bool = True
) -> DataFrame:
    """Add ``place``, ``year``, ``month`` and ``dt``, each row's own, from its keys."""
    if place:
        df = df.withColumn("place", F.col("place_id"))
    df = df.withColumn("year", F.substring(date, 1, 4)).withColumn("month", F.substring(date, 1, 7))
    return df.withColumn("dt", F.col(date)) if day else df


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    sort_by: Sequence[str] = (),
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    scope: Mapping[str, Callable[[str], bool]] | None = None,
) -> None:
    """Write ``df`` partitioned, replacing only the partitions it holds rows for.

    Rows are gathered by partition, so that each partition gets few files, but a partition too
    large for one task is split over several. Rows of a file are ordered by ``sort_by``.

    ``scope`` says, by partition column, which partitions this run is responsible for. Those of them
    that got no rows are removed once the write has succeeded, so a result that is gone is not left
    published; without a scope nothing is removed. Partitions outside the scope are never touched.
    Only folders of files in ``format`` can be withdrawn, not the versions of a transactional table.
    """
    gathered = df.hint("rebalance", *[F.col(name) for name in partition_by])
    written = Observation()
    if scope is not None:
        names = F.struct(*[F.col(name).cast("string").alias(name) for name in partition_by])
        gathered = gathered.observe(written, F.collect_set(names).alias("partitions"))
    if sort_by:
        gathered = gathered.sortWithinPartitions(*partition_by, *sort_by)
    (
        gathered.write.format(format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**(options or {}))
        .partitionBy(*partition_by)
        .save(path)
    )
    if scope is not None:
        kept = {tuple(names) for names in written.get["partitions"]}
        _withdraw(df.sparkSession, path, partition_by, scope, kept)


def publish_device_table(df: DataFrame, table: str, buckets: int, *, path: str | None = None) -> None:
    """A device-level table, bucketed and sorted by device, as a catalog table that it replaces.

    Rows of a device lie in one bucket, so collapsing the table and joining it with visits moves only the
    visits. ``buckets`` should be the number of shuffle partitions of the reports or a multiple of it.
    A device with very many rows makes its bucket large. With ``path`` the files lie there.
    """
    if "adid" not in df.columns:
        raise ValueError("a device table needs the column adid")
    writer = df.repartition(buckets, "adid").write.mode("overwrite").bucketBy(buckets, "adid").sortBy("adid")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def _withdraw(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    scope: Mapping[str, Callable[[str], bool]],
    kept: set[tuple[str, ...]],
) -> None:
    """Remove the partition folders in ``scope`` that are not ``kept``; lists names, reads no data."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(at, values: tuple[str, ...]) -> Iterator[tuple[object, tuple[str, ...]]]:
        if len(values) == len(partition_by):
            yield at, values
            return
        column = partition_by[len(values)]
        for status in files.listStatus(at):
            name, _, value = unquote(status.getPath().getName()).partition("=")
            if status.isDirectory() and name == column and scope.get(column, lambda _: True)(value):
                yield from folders(status.getPath(), (*values, value))

    if files.exists(root):
        for folder, values in list(folders(root, ())):
            if values not in kept:
                files.delete(folder, True)
