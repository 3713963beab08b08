"""Importance resampling towards a target: documents whose n-grams the target has more often are drawn first.

1. A pass over the texts counts the hashed 1- to 3-grams of the corpus, another those of the target. Arrow kernels
   do the work: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn a slice of
   texts into word indices; shifted indices form the pairs and triples, only the distinct ones of which get a CRC-32
   (put together from the words' own checksums). A task sends one count per bucket.
2. A bucket's gain is the scaled log ratio of its two shares (``BUCKETS`` numbers, which every task gets).
3. A second pass takes the gains and sums them per document, and adds Gumbel noise that depends on seed and id only,
   so that the highest scores are a sample without replacement in proportion to exp(weight).
4. Ranks need no single task: the rows are range-partitioned by score, numbered inside their partition, and shifted
   by the sizes of the partitions before it.

Defined cases: a null or empty text has no features, weight 0, and is never drawn; rows that repeat an id are
documents of their own (each counts and may be drawn); a null id counts as an empty one in the noise, and comes last
among ties; an empty corpus gives no rows; an empty target leaves gains below or at 0; very long texts are taken
whole; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import plain, shuffle_partitions, table, written
from cabwh.llm.words import Words, bytes_of, crc32_each, crc32_joined, slices, words_of

BUCKETS = 10_000
SEED = 42
PERCENT = 5
MIN_WORDS = 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, the place of each code among them)."""
    found = pa.array(codes).dictionary_encode()
    return (found.dictionary.to_numpy(zero_copy_only=False).astype(np.int64),
            found.indices.to_numpy(zero_copy_only=False).astype(np.int64))


def ngrams(words: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2 and 3 words: (bucket of each distinct run, the run at each place, its document)."""
    first = crc32_each(bytes_of(words.distinct))
    length = pc.binary_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = np.full(len(first), zlib.crc32(b" "), dtype=np.uint32)
    spaced, length = crc32_joined(blank, first, length), length + 1
    doc = np.repeat(np.arange(len(words.count)), words.count)
    out, crc, run, wide = [], first, words.index, max(1, len(first))
    for n in range(1, 4):
        if n > 1:                                        # the run of n - 1 words and the word after it
            inside = doc[n - 1:] == doc[: len(doc) - n + 1]
            code = run[:len(words.index) - n + 1] * wide + words.index[n - 1:]
            inside &= run[:len(code)] >= 0
            known, place = _distinct(code[inside])
            run = np.full(len(code), -1, dtype=np.int64)
            run[inside] = place
            crc = crc32_joined(crc[known // wide], spaced[known % wide], length[known % wide])
        real = run >= 0
        out.append(((crc % np.uint32(BUCKETS)).astype(np.int64), run[real], doc[: len(run)][real]))
    return out


def bucket_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket, n) over all texts; a task sends at most ``BUCKETS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0)):
                for bucket, place, _ in ngrams(words_of(part, SEPARATORS)):
                    np.add.at(total, bucket, np.bincount(place, minlength=len(bucket)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return plain(texts, text=text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def _as_array(counts: DataFrame) -> np.ndarray:
    """At most ``BUCKETS`` rows, whatever the size of the corpus."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in counts.collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) per bucket, in doubles."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(1)):
                words = words_of(part, SEPARATORS)
                features, weight = np.zeros((2, len(part)), dtype=np.int64)
                for bucket, place, doc in ngrams(words):
                    ends = np.searchsorted(doc, np.arange(len(part) + 1))
                    sums = np.concatenate(([0], np.cumsum(gain[bucket][place])))
                    features += np.diff(ends)
                    weight += sums[ends[1:]] - sums[ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(words.count), pa.array(features), pa.array(weight)],
                    ["id", "n_words", "n_features", "weight"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return plain(docs, id=id_col, text=text_col).mapInArrow(
        run, f"id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise from the first 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place`` (1, 2, 3 ...) in the given order, without a task that sees all of them."""
    spark = rows.sparkSession
    parts = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    # the number's upper bits are the partition, the lower 33 the row in it
    parts = written(parts.withColumn("number", F.monotonically_increasing_id()), "by-rank")
    part = F.shiftright("number", 33).alias("part")
    sizes = sorted(map(tuple, parts.groupBy(part).count().collect()))     # one row per partition
    starts, at = [], 0
    for p, n in sizes:
        starts.append((p, at))
        at += n
    before = spark.createDataFrame(starts, "part bigint, before bigint")
    return (parts.withColumn("part", part).join(before, "part")
            .withColumn("place", F.col("before") + F.col("number").bitwiseAND((1 << 33) - 1) + 1)
            .drop("part", "before", "number"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank (of the drawn ones, else null)."""
    gain = gains(_as_array(bucket_counts(docs, text_col)), _as_array(bucket_counts(target, target_text_col)))
    rows = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    # written: the range partitioning reads its rows twice
    rows = written(rows.withColumn("long_enough", F.col("n_words") >= min_words), "weights")
    placed = ranked(rows, F.col("long_enough").desc(), F.col("score").desc(), F.col("id").asc_nulls_last())
    drawn = percent * placed.filter("long_enough").count() // 100
    rank = F.when(F.col("long_enough") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn documents with all their columns."""
    drawn = resample(docs, target, id_col=id_col, **options).filter("rank is not null")
    drawn = drawn.select(F.col("id").alias("__drawn_id")).distinct()
    return docs.join(drawn, docs[id_col].eqNullSafe(drawn["__drawn_id"]), "left_semi")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark texts, and the rank of those drawn."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample(docs, target).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
