"""Exact de-duplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch is reduced to one row per digest (with
map-side partial sums), the digests the index already has are removed by a sort-merge anti-join that reads the
bucketed side without a shuffle, and the rest is appended. A batch that is run again appends nothing.

Defined cases: a null text counts as empty; an empty batch returns no rows and leaves the index as it is; rows
that repeat an id and its text are one document (all of them have the same decision); a null id is never the
one that stays unless its group has no other; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import first_per_key, lookup_salted, plain, salt_of, shared_dir, shuffle_partitions, written


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class DigestIndex:
    """Digests seen so far and the id that stays for each, in ``path`` (readable by later sessions)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path
        self.buckets = buckets or shuffle_partitions(spark)
        self.table = f"digest_index_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def append(self, first: DataFrame) -> None:
        """Append the digests of ``first`` (digest, first_id) that the index does not have."""
        fresh = first.select("digest", F.col("first_id").alias("keep_id")).join(
            self.rows().hint("merge"), "digest", "left_anti")
        # dealt out as the table is bucketed: each task writes one sorted bucket file
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Decide a batch and append its new digests.

        Returns one row per input row: ``id``, ``keep_id`` (the id that stays for this text, from this batch or
        an earlier one), ``group_size`` (rows of this batch with this text), ``kept``, ``digest``.
        """
        prints = written(plain(docs, id=id_col, text=text_col).select(
            "id", F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        ).withColumn("salt", salt_of("id")), "digests")
        first = written(first_per_key(prints, "digest", "id"), "first-digests")
        self.append(first)
        decided = first.join(self.rows().hint("merge"), "digest").select("digest", "salts", "keep_id", "n")
        return lookup_salted(prints, decided, "digest").select(
            "id", "keep_id", F.col("n").alias("group_size"),
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Decisions of :meth:`DigestIndex.add`; without ``index``, against a new one in the shared folder."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    index = index or DigestIndex(spark, shared_dir(spark, "digest-index"), id_type=id_type)
    return index.add(docs, id_col, text_col)


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_dedup(docs, index, id_col, text_col).filter("kept").select(F.col("id").alias("__kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__kept_id"]), "left_semi")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays for its text."""
    from cabwh.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                    F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW w AS (PARTITION BY body)
"""
