"""Quality by compression: a text is good if a dictionary of good text compresses it better than one of bad text.

Two zstandard dictionaries are built from labelled text. Every whole text is compressed with both, in blocks, so
that a dictionary helps the end of a long text as much as its start. The difference of the two sizes per byte of
text, with the text's shortness (little evidence, so nearer the base rate), goes through a logistic calibration
that is fitted on labelled rows the dictionaries have not seen.

What is fitted uses at most ``sample_rows`` labelled rows, chosen by a hash; scoring is one pass over all texts
without a shuffle.

Defined cases: null and empty texts have size difference 0 and get the calibrated score of an empty text; without
labels of both kinds every score is the share of good labels (0.5 without labels); repeated rows score alike;
rows with a null label are ignored; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import plain, table, texts_of, written

SAMPLE_ROWS = 12_000
SAMPLE_BLOCKS = 6_000
BLOCK = 1024
DICT_BYTES = 112_640
FEATURES = 4
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    bad: bytes
    good: bytes
    weights: tuple[float, ...]                 # of the features, in order

    def scorer(self):
        """A function from whole texts (bytes) to scores; compressors are made once."""
        packers = [_compressor(d) for d in (self.bad, self.good)]
        return lambda texts: _logistic(features(texts, *packers) @ np.array(self.weights))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
    if not content:
        return zstandard.ZstdCompressor(**options)
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, **options)


def blocks_of(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def features(texts: list[bytes], bad: zstandard.ZstdCompressor, good: zstandard.ZstdCompressor) -> np.ndarray:
    """Per text: 1, size difference per byte, shortness, and compressed size per byte (repetition leaves little)."""
    rows = np.zeros((len(texts), FEATURES))
    for row, text in zip(rows, texts, strict=True):
        sizes = [(len(bad.compress(b)), len(good.compress(b))) for b in blocks_of(text)]
        b, g = sum(x for x, _ in sizes), sum(x for _, x in sizes)
        short = 1 / (1 + len(text) / 128)
        row[:] = 1, 20 * (b - g) / max(1, len(text)), short, (1 - short) * min(1, 5 * g / max(1, len(text)))
    return rows


def build_dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, their end as raw content."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICT_BYTES:]


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weights of a ridge logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def held_out(id_col: str = "id"):
    """Rows never learnt from: crc32 of the id as text is divisible by 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded(df: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows, those with the smallest hashes; no task sorts more than about twice as many."""
    share = min(1.0, 2 * most / max(1, df.count()))
    order = F.xxhash64(*key)
    return df.filter(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(order, *key).limit(most)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from at most ``sample_rows`` labelled rows that are not held out."""
    known = (plain(labels, lid=label_id, label=label_col).filter("lid IS NOT NULL AND label IS NOT NULL")
             .filter(~held_out("lid")).groupBy("lid").agg(F.min("label").alias("label")))
    # at most sample_rows rows of (id, label): their size is bounded, so the texts need no shuffle
    chosen = written(bounded(known, sample_rows, "lid"), "quality-labels")
    rows = plain(docs, id=id_col, text=text_col).join(F.broadcast(chosen), F.col("id") == F.col("lid")).select(
        F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.col("label").cast("int").alias("label"),
        (F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(4)) == 0).alias("calibrates"))
    rows = written(rows, "quality-sample")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(y, b) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                     for b in blocks_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in pairs], pa.int32()),
                                              pa.array([b for _, b in pairs], pa.binary())], ["label", "block"])

    blocks = rows.filter("NOT calibrates").select("text", "label").mapInArrow(split, "label int, block binary")
    # at most SAMPLE_BLOCKS blocks of BLOCK bytes of either kind come to the driver, which trains on them
    content = [build_dictionary([r[0] for r in bounded(blocks.filter(F.col("label") == y), SAMPLE_BLOCKS, "block")
                                 .select("block").collect()]) for y in (0, 1)]
    share = rows.agg(F.avg("label")).first()[0]
    if share is None or not 0 < share < 1 or not all(content):
        base = 0.0 if share is None else float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return QualityModel(b"", b"", (base,) + (0.0,) * (FEATURES - 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = [_compressor(d) for d in content]
        for batch in batches:
            x = features(batch.column(0).to_pylist(), *packers)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x[:, i]) for i in range(FEATURES))],
                                              ["y", *(f"x{i}" for i in range(FEATURES))])

    ddl = "y int, " + ", ".join(f"x{i} double" for i in range(FEATURES))
    seen = rows.filter("calibrates").select("text", "label").mapInArrow(measure, ddl).collect()
    if len({r.y for r in seen}) < 2:
        seen = rows.select("text", "label").mapInArrow(measure, ddl).collect()
    seen = np.array(sorted(map(tuple, seen)), dtype=float)     # a fixed order: the same sums on every run
    return QualityModel(content[0], content[1], calibrate(seen[:, 1:], seen[:, 0]))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(texts_of(batch.column(1))))],
                                             ["id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return plain(docs, id=id_col, text=text_col).mapInArrow(run, f"id {id_type}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, with all their columns; texts are read once, not shuffled."""
    model = fit(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array(scorer(texts_of(batch.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
