"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest, so that new data meets it in a sort-merge
anti-join without reshuffling the index; the digests of what is kept are then appended.  Texts
are equal when identical after each run of white space (``[\\x20\\x09-\\x0D]+``) is replaced by
one space.  A digest is the SHA-256 of the normalised text, so only 32 bytes per distinct text are
kept and shuffled, never the texts.

Defined cases: null text counts as empty; of equal texts the smallest ``doc_id`` stays (a row
with a null id only if its group has no other); when the same ``doc_id`` occurs on several
equal rows one of them stays; an empty table gives an empty result and leaves the index as it is;
other columns, whatever their names, are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from designlab.llm.stored import at_end, new_folder, plain_names

INDEX_BUCKETS = 64


def text_digest(text) -> F.Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)


class DigestIndex:
    """Digests seen so far: table (digest, keep_id), bucketed and sorted by digest.

    ``path`` is a folder that all executors share; opening an existing folder under a new session
    needs only ``create()`` again.  Buckets are fixed when the table is created: choose them so that
    a bucket's digests fit a task's sort (32 bytes each).
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = INDEX_BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def create(self) -> DigestIndex:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                       f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self

    def forget(self) -> None:
        """Take the table out of the session's catalog; its folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, digests: DataFrame) -> DataFrame:
        """Rows of ``digests`` whose digest the index does not hold (sort-merge anti-join)."""
        return digests.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Add (digest, keep_id) rows; one writer per bucket."""
        (rows.select("digest", "keep_id").repartition(self.buckets, "digest")
         .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.name))


def temporary_index(spark: SparkSession) -> DigestIndex:
    """A new, empty index in the shared checkpoint folder."""
    path = new_folder(spark, "digest_index")
    index = DigestIndex(spark, path.rsplit("/", 1)[-1], path).create()
    at_end(index.forget)
    return index


def dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Deduplicate ``docs`` against ``index`` and within themselves; append what is new.

    Returns (doc_id, keep_id, group_size, kept, text_sha256), one row per document: ``keep_id`` is
    the document that stays, an earlier one if the index already held the text; ``group_size``
    counts the rows of ``docs`` with that text.
    """
    spark = docs.sparkSession
    # texts are read once: everything below works on the stored digests
    at = new_folder(spark, "digests")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(text_digest(F.col("text"))).alias("digest"),
                 F.monotonically_increasing_id().alias("tag")).write.parquet(at))
    rows = spark.read.schema("doc_id long, digest binary, tag long").parquet(at)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    groups = (rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
              .select("digest", F.col("first.doc_id").alias("first_id"), F.col("first.tag").alias("first_tag"),
                      "group_size"))
    fresh = index.unseen(groups).select("digest", F.col("first_id").alias("keep_id"))
    index.append(fresh)
    # by now the index holds every digest; a row stays if it is the first of its text and the index names it
    known = index.table().select("digest", "keep_id")
    stay = groups.join(known, "digest").select(
        "digest", "keep_id", "group_size",
        F.when(F.col("first_id").eqNullSafe(F.col("keep_id")), F.col("first_tag")).alias("keep_tag"))
    return rows.join(stay, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("tag").eqNullSafe(F.col("keep_tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``docs`` with one row of each text, all columns unchanged."""
    stay = (dedup(docs.select("doc_id", "text"), index or temporary_index(docs.sparkSession)).where("kept")
            .select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_kept")).distinct())
    rows = plain_names(docs).withColumn("_digest", F.unhex(text_digest(F.col("text"))))
    same = (rows["_digest"] == stay["_kept"]) & rows["doc_id"].eqNullSafe(stay["_id"])
    return rows.join(stay, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).drop("_digest").toDF(*docs.columns)


def op6_report(docs: DataFrame) -> DataFrame:
    return dedup(docs, temporary_index(docs.sparkSession))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
