"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text.
A batch of documents is reduced to one row per digest, compared with the index
by a sort-merge anti-join (only the batch moves: the index is already dealt out
by digest), and what is new is appended.

Texts are equal when identical after lower-casing A-Z. A null text is the empty
text, so all null and empty texts form one group. Within a batch the row with
the largest doc_id stays; a null doc_id is smaller than any number. Rows that
repeat both doc_id and text count one by one, and only one of them is kept. A
text that the index already holds keeps its earlier document, and no row of the
batch stays. An empty batch gives no rows. Only the two named columns are read,
so other columns can have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.llm.common import decided_rows, lower_ascii, shuffle_partitions, staged

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, batch STRING"


class DigestIndex:
    """A saved table with one row per distinct text seen so far."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or shuffle_partitions(spark)
        if not spark.catalog.tableExists(table):
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, rows: DataFrame) -> None:
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def add(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None, batch: str | None = None,
    ) -> DataFrame:
        """Take a batch into the index; one decision per row of ``docs``.

        ``batch`` names it. A batch that is added again under its name, because the run died after the
        index had taken it, gets the same decisions: what the index holds under that name is its own.

        Columns: ``doc_id``, ``row`` (tells repeated rows apart), ``digest``,
        ``keep_id``, ``group_size`` (rows of this batch with the text), ``kept``.
        ``row`` names a column of stored, distinct numbers; without it rows are numbered here.
        """
        batch = batch or uuid.uuid4().hex
        rows = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
            _digest(text).alias("digest"))
        rows = staged(rows, "digests")
        groups = rows.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
        groups = staged(groups, "digest-groups")
        fresh = groups.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
        self._append(fresh.select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.lit(batch).alias("batch")))
        self.spark.catalog.refreshTable(self.table)
        # The row that stays by the numbers of this scan; those of an earlier try may be others.
        decided = staged(groups.select("digest", "group_size", F.col("best.row").alias("own_row")).join(
            self.rows().select("digest", "keep_id", "batch"), "digest"), "digest-decided")
        return rows.join(decided, "digest").select(
            "doc_id", "row", "digest", "keep_id", "group_size",
            ((F.col("batch") == batch) & (F.col("row") == F.col("own_row"))).alias("kept"))


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index under a name that no other run uses."""
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(lower_ascii(text), 256))


def keep_first_copies(
    docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text", batch: str | None = None
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    They are found again by doc_id and 64 bits of the digest; rows that share both are copies
    of one another but for their other columns, and one of them stays.
    """
    short = F.xxhash64(_digest(text))
    found = index.add(docs, doc_id, text, batch=batch).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = found.groupBy("doc_id", "digest").agg(F.count("*").alias("times"), F.max("kept").alias("kept")).where("kept")
    kept = staged(kept.select("doc_id", F.xxhash64("digest").alias("short"), "times"), "exact-kept")
    keys = {"doc_id": F.col(f"`{doc_id}`").cast("long"), "short": short}
    return decided_rows(docs, keys, kept).select("doc.*")
