"""Exact duplicates by a tree merge of sorted digest runs.

Every partition of the input is one run. In each round the runs of ``FAN_IN`` neighbours meet, cut
into shards of the digest space so that no task ever holds a whole run; Spark sorts what meets by
digest and merges equal digests into one entry with the identifier that stays and the number of
rows. After log(runs) rounds one run is left, still in shards. An entry is a SHA-256, checked at
every level by the length and a second, independent hash of the text: entries merge only if all
three agree. Texts themselves never move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import ascii_lower, require, stored, temporary

#: Runs that meet in one merge.
FAN_IN = 4
#: Recurring texts that are broadcast, by digest: about 100 MB. Beyond, the rows are shuffled.
BROADCAST_TEXTS = 1_000_000
_ENTRY = ["digest", "check", "bytes"]


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, row, digest, check, bytes)`` of every row; A-Z count as a-z and null as empty."""
    require(docs, id, text)
    plain = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(id).alias("id"), plain.alias("plain")).select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2("plain", 256)).alias("digest"),
        F.xxhash64("plain").alias("check"),
        F.octet_length("plain").alias("bytes"),
    )


def merged_runs(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """``(digest, check, bytes, best, size)``, one row per text, by rounds of multiway merges.

    ``best`` is the struct ``(id, row)`` that stays: the largest or smallest id, a null id last of
    all, and of rows with the same id the one with the largest or smallest position.
    """
    pick = F.max if keep == "largest" else F.min
    key = F.struct("id", "row") if keep == "largest" else F.struct(F.col("id").isNull().alias("none"), "id", "row")
    runs = rows.rdd.getNumPartitions()
    shards = max(runs, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    level = rows.select(
        F.spark_partition_id().alias("run"),
        F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"),
        *_ENTRY,
        key.alias("best"),
        F.lit(1).cast("long").alias("size"),
    )
    while True:
        level = (
            level.groupBy("run", "shard", *_ENTRY)
            .agg(pick("best").alias("best"), F.sum("size").alias("size"))
            .withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int"))
        )
        if runs == 1:
            break
        runs = -(-runs // FAN_IN)
    return level.groupBy(*_ENTRY).agg(pick("best").alias("best"), F.sum("size").alias("size"))


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest"
) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` of every row of ``docs``.

    Texts are equal when identical after lowering A-Z; a null counts as empty, so nulls and empty
    texts are one group. Of each group exactly one row is ``kept``: that with the largest id
    (``keep="smallest"``: the smallest), never a null id unless all are null, and of rows that
    repeat the id an arbitrary but single one. An empty table gives an empty result; other columns
    are ignored.
    """
    rows = stored(digests(docs, id, text), "digests")
    best = merged_runs(rows, keep).select(
        *_ENTRY, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "size"
    )
    return rows.join(best, _ENTRY).select(
        F.col("id").alias(id),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest"
) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns.

    Rows that repeat both id and text are one group's rows, so one of them stays, whatever their
    other columns hold. Rows of a text that no other row has, most of a corpus, are not shuffled as long
    as the texts that recur, by digest, are few enough to be broadcast.
    """
    with temporary(docs.sparkSession):
        rows = stored(digests(docs, id, text), "digests")
        best = merged_runs(rows, keep).where("size > 1")
        again = stored(best.select(*(F.col(c).alias(f"__{c}") for c in _ENTRY), F.col("best.id").alias("__id")), "again", keep=True)
    few = again.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
    plain = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    named = docs.withColumns({"__sha": F.unhex(F.sha2(plain, 256)), "__hash": F.xxhash64(plain), "__size": F.octet_length(plain)})
    same = (F.col("__sha") == F.col("__digest")) & (F.col("__hash") == F.col("__check")) & (F.col("__size") == F.col("__bytes"))
    found = named.join(F.broadcast(again) if few else again, same, "left")
    columns = [F.col(c) for c in docs.columns]
    alone = found.where("__digest IS NULL").select(*columns)
    stays = found.where(F.col("__digest").isNotNull() & F.col(id).eqNullSafe(F.col("__id")))
    return alone.unionByName(stays.dropDuplicates(["__sha", "__hash", "__size"]).select(*columns))
