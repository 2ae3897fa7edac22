"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by the digest of the
normalised text. A batch is reduced to one row per digest (merged map-side, so
a text with a third of all rows is no hot key), the digests the index already
has are taken out by a sort-merge anti-join in which the index is read by
bucket and not shuffled, and the rest is appended.

Defined results:

* A NULL text counts as an empty one; all empty texts are equal.
* Of equal texts in one batch the row with the most code points in its original
  text stays, then the smallest id; a NULL id comes after all others. Of rows
  equal in both, exactly one stays.
* Texts the index has already are all dropped; their ``keep_id`` is the one in the index.
* An empty batch gives an empty result and leaves the index as it is.
* Extra columns are carried by ``drop_copies`` and ignored by ``decisions``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import free_name, plain, with_row_id, written

#: Deleted before texts are compared: space and the controls from tab to return.
BLANKS = r"[\x20\x09-\x0D]"

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without blanks, as 32 bytes."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS + "+", "")
    return F.unhex(F.sha2(bare, 256))


def _rank(n_chars: Column, ident: Column, row: Column) -> Column:
    """Largest for the row that stays. The complement reverses the order of ids without overflow."""
    return F.struct(n_chars.alias("c"), F.bitwise_not(ident).alias("i"), row.alias("r"))


@dataclass(frozen=True)
class DigestIndex:
    """Digests of all texts kept so far.

    ``path`` is a folder that all executors share; ``name`` is the table's name
    in the session's catalog. A new session opens an index by the same two and
    the same number of buckets. Size ``buckets`` so that one holds some 10 million digests at most.
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int = 16

    def open(self) -> DigestIndex:
        """Create the table, or attach to the files that are there."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INDEX_SCHEMA)
        where = self.path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            f" LOCATION '{where}'"
        )
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add digests that the index does not have, one file per bucket.

        ``rows`` must come from files of its own. If the job dies, delete nothing:
        ingest the batch again; digests that came through are then found.
        """
        (
            rows.select(*INDEX_SCHEMA.names)
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def _unknown(self, best: DataFrame, digest: str) -> DataFrame:
        """Rows whose digest the index lacks, by a sort-merge anti-join."""
        known = self.read().select(F.col("digest").alias("known_digest")).hint("merge")
        return best.join(known, best[digest] == known["known_digest"], "left_anti")

    def decisions(self, batch: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per row of the batch: id, keep_id, group_size, kept, text_sha256."""
        key, body = plain(batch, [ident, text])
        narrow = batch.select(
            key.cast("long").alias("id"),
            text_digest(body).alias("digest"),
            F.length(F.coalesce(body, F.lit(""))).alias("n_chars"),
        )
        narrow = written(with_row_id(narrow, "row"), "digests")
        best = narrow.groupBy("digest").agg(
            F.max(_rank(F.col("n_chars"), F.col("id"), F.col("row"))).alias("best"),
            F.count("*").alias("group_size"),
        )
        fresh = self._unknown(best, "digest").select(
            "digest",
            F.bitwise_not(F.col("best.i")).alias("keep_id"),
            F.col("best.c").alias("n_chars"),
            F.col("best.r").alias("keep_row"),
        )
        fresh = written(fresh, "fresh-digests")
        seen = self.read().select("digest", F.col("keep_id").alias("index_id"))
        groups = (
            best.select("digest", "group_size")
            .join(fresh.select("digest", "keep_id", "keep_row"), "digest", "left")
            .join(seen, "digest", "left")
            .select(
                "digest",
                "group_size",
                "keep_row",
                F.when(F.col("keep_row").isNull(), F.col("index_id"))
                .otherwise(F.col("keep_id"))
                .alias("keep_id"),
            )
        )
        groups = written(groups, "digest-groups")
        self.append(fresh)
        # A hot digest is one row on the right; adaptive execution splits its rows on the left.
        return narrow.join(groups, "digest").select(
            "id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def drop_copies(self, batch: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows that stay, with all columns of the batch; the index learns their digests."""
        digest, key, row = (free_name(batch, n) for n in ("digest_", "rank_", "row_"))
        columns = plain(batch, batch.columns)
        ident_col, body = plain(batch, [ident, text])
        keyed = batch.select(
            text_digest(body).alias(digest),
            F.struct(
                F.length(F.coalesce(body, F.lit(""))).alias("c"),
                F.bitwise_not(ident_col.cast("long")).alias("i"),
            ).alias(key),
            F.struct(*columns).alias(row),
        )
        best = keyed.groupBy(digest).agg(
            F.max_by(row, key).alias(row), F.max(key).alias(key)
        )
        fresh = written(self._unknown(best, digest), "fresh-texts")
        self.append(
            fresh.select(
                F.col(digest).alias("digest"),
                F.bitwise_not(F.col(f"{key}.i")).alias("keep_id"),
                F.col(f"{key}.c").alias("n_chars"),
            )
        )
        return fresh.select(f"{row}.*")
