"""Benchmark decontamination by spaced seeds.

A fixed mask picks ``WEIGHT`` of ``SPAN`` neighbouring words and ignores the others, so a substituted word spoils
only the windows in which it stands on a picked place. The masks' hashes of all benchmark items are joined with
those of the documents; every hit fixes how a document and an item lie against each other, and the overlap around
it is verified word by word, tolerating substitutions.

A Bloom filter over the benchmark's hashes keeps nearly all document windows from being shuffled. Its size follows
the benchmark (not the documents) up to a fixed bound; a fuller filter only lets more windows through to the
exact join. Windows that pass are merged per document into stretches of word hashes, so the texts stay where they are.

A document is contaminated by an item if an aligned stretch has at least ``min_words`` equal words (or all words of
a shorter item) and at most one word in ``1 + MISMATCH`` differs. Items of fewer words than a mask spans are found
by their whole word sequence.

Defined cases: null and empty texts have no words and are clean; an item without words matches nothing; rows that
repeat an id count as one document (contaminated if any of them is); rows with a null id are one such document;
empty tables give no rows or clean rows; very long texts are searched whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import PLACE, mix64, plain, table, texts_of, word_hashes, written

#: Picked places of each mask; every mask begins and ends with a picked place.
MASKS = ("111010110011", "110110011011", "101101101101", "110011101101")
SPAN = len(MASKS[0])
MIN_WORDS = 12
MISMATCH = 3
FILTER_BITS = (20, 28)           # log2 of the filter's least and largest size
BITS_PER_SEED = 512


_PUNCTUATION = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def _words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of whole texts, in lower case and without ASCII punctuation; null is empty."""
    return word_hashes(t.decode("utf-8", "replace").lower().encode().translate(_PUNCTUATION) for t in texts_of(column))


def _window_hashes(w: np.ndarray, places: list[int], seed: int) -> np.ndarray:
    """Hashes of the picked words of all windows; ``seed`` tells masks (and whole short items) apart."""
    n = len(w) - places[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, seed * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64)
    for k, p in enumerate(places):
        h += w[p: p + n] * PLACE[k]
    return mix64(h)


_PLACES = [[i for i, c in enumerate(m) if c == "1"] for m in MASKS]


def seeds_of(words: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(mask, hashes by place) of an item; an item shorter than a mask has one seed, its whole sequence."""
    n = len(words)
    if 0 < n < SPAN:
        return [(100 + n, _window_hashes(words, list(range(n)), 100 + n))]
    return [(m, _window_hashes(words, places, m)) for m, places in enumerate(_PLACES)] if n else []


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(first place in ``doc``, words, equal words) of the best stretch with item word i against doc word i + diagonal.

    Best: the largest sum of 1 for an equal pair and -MISMATCH for a different one.
    """
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    equal = item[lo:hi] == doc[lo + diagonal: hi + diagonal]
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -MISMATCH))))
    gain = total - np.minimum.accumulate(total)
    end = int(gain.argmax())
    begin = int(total[: end + 1].argmin())
    # the stretch begins at the last place with the least sum before it
    begin = end - int(np.argmin(total[begin: end + 1][::-1])) if end else 0
    return lo + begin + diagonal, end - begin, int(equal[begin:end].sum())


def _item_table(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.view(np.int64) for w in _words(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))],
                                             ["item_id", "item_words"])

    item_type = benchmark.schema[item_col].dataType.simpleString()
    return written(plain(benchmark, item_id=item_col, text=text_col)
                   .mapInArrow(run, f"item_id {item_type}, item_words array<bigint>")
                   .withColumn("item", F.monotonically_increasing_id()), "benchmark-items")


def _seed_table(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for _, h in seeds_of(np.array(words, dtype=np.int64).view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array([item] * len(h), pa.int64()),
                         pa.array(np.arange(len(h)))], ["hash", "item", "item_at"])

    return written(items.select("item", "item_words").mapInArrow(run, "hash bigint, item bigint, item_at bigint"),
                   "benchmark-seeds")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter (two places a hash) as a bit array of at most 2 ** FILTER_BITS[1] bits."""
    n = seeds.select("hash").distinct().count()
    log2 = min(FILTER_BITS[1], max(FILTER_BITS[0], (BITS_PER_SEED * max(1, n) - 1).bit_length()))
    places = seeds.select(F.explode(F.array(
        F.shiftrightunsigned("hash", 64 - log2), F.pmod(F.col("hash"), F.lit(1 << log2)))).alias("p"))
    # one row for each 64 bits of the filter that has any set: at most 2 ** (FILTER_BITS[1] - 6)
    rows = places.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toPandas()
    out = np.zeros(1 << (log2 - 6), dtype=np.uint64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that may be in the filter."""
    log2 = len(bits).bit_length() - 1 + 6
    has = lambda p: (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    hit = np.flatnonzero(has(h >> np.uint64(64 - log2)))
    return hit[has(h[hit] & np.uint64((1 << log2) - 1))]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, first_word, n_words, n_equal): verified overlaps, the longest of each document and item."""
    spark = docs.sparkSession
    items = _item_table(benchmark, item_col, item_text)
    seeds = _seed_table(items)
    lengths = items.agg(F.max(F.size("item_words"))).first()[0] or 0
    short = sorted(r[0] for r in items.filter(f"size(item_words) BETWEEN 1 AND {SPAN - 1}")
                   .select(F.size("item_words")).distinct().collect())          # at most SPAN - 1 lengths
    known = spark.sparkContext.broadcast(_filter(seeds))
    masks = [(m, p) for m, p in enumerate(_PLACES)] + [(100 + n, list(range(n))) for n in short]
    id_type = docs.schema[id_col].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, w in zip(batch.column(0), _words(batch.column(1)), strict=True):
                found = []
                for m, places in masks:
                    h = _window_hashes(w, places, m)
                    at = _passes(known.value, h)
                    found.append(np.stack([at, h[at].view(np.int64)]))
                hits = np.concatenate(found, axis=1)
                if not hits.shape[1]:
                    continue
                hits = hits[:, np.argsort(hits[0], kind="stable")]
                # hits that an item could join lie in one stretch
                for part in np.split(hits, np.flatnonzero(np.diff(hits[0]) > lengths) + 1, axis=1):
                    begin = max(0, int(part[0, 0]) - lengths)
                    rows.append((i.as_py(), begin, w[begin: int(part[0, -1]) + lengths].view(np.int64),
                                 part[0] - begin, part[1]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], batch.column(0).type), pa.array([r[1] for r in rows], pa.int64())]
                    + [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (2, 3, 4)],
                    ["id", "begin", "words", "at", "hashes"])

    stretches = written(plain(docs, id=id_col, text=text_col).mapInArrow(
        search, f"id {id_type}, begin bigint, words array<bigint>, at array<bigint>, hashes array<bigint>")
        .withColumn("stretch", F.monotonically_increasing_id()), "hit-stretches")
    hits = stretches.select("stretch", F.explode(F.arrays_zip("at", "hashes")).alias("h")).select(
        "stretch", F.col("h.at").alias("at"), F.col("h.hashes").alias("hash"))
    aligned = hits.join(seeds, "hash").select("stretch", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    pairs = aligned.join(items, "item").join(stretches.select("stretch", "id", "begin", "words"), "stretch")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                item = np.array(r["item_words"])
                at, n, equal = overlap(np.array(r["words"]), item, r["diagonal"])
                if equal >= min(min_words, len(item)):
                    found.append((r["id"], r["item"], r["begin"] + at, n, equal))
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.column(0).type)] + [pa.array(c, pa.int64()) for c in columns[1:]],
                ["id", "item", "first_word", "n_words", "n_equal"])

    best = pairs.select("id", "item", "begin", "words", "item_words", "diagonal").mapInArrow(
        verify, f"id {id_type}, item bigint, first_word bigint, n_words bigint, n_equal bigint").groupBy("id", "item").agg(
        F.max(F.struct("n_equal", (-F.col("n_words")).alias("m"), (-F.col("first_word")).alias("f"))).alias("b"))
    return best.join(items.select("item", "item_id"), "item").select(
        "id", "item_id", (-F.col("b.f")).alias("first_word"), (-F.col("b.m")).alias("n_words"), "b.n_equal")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document: id, n_items, items (sorted ids), max_equal."""
    return find_overlaps(docs, benchmark, **options).groupBy("id").agg(
        F.count_distinct("item_id").cast("long").alias("n_items"),
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("n_equal").alias("max_equal"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    bad = contaminated(docs, benchmark, id_col=id_col).select(F.col("id").alias("__bad_id"))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad_id"]), "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it overlaps."""
    docs = table(spark, sf_dir, "documents")
    bad = written(contaminated(docs, table(spark, sf_dir, "benchmark")), "contaminated")
    rows = docs.select("doc_id").join(bad, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return rows.select("doc_id", F.col("id").isNotNull().alias("contaminated"), F.col("id").isNull().alias("kept"),
                       F.coalesce("n_items", F.lit(0)).alias("n_items"),
                       F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
                       F.coalesce("max_equal", F.lit(0)).alias("max_equal"))
