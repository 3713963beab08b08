"""Helpers shared by the training-data operators: tables, shared scratch space, salted lookups, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets that the rows of one key are spread over before they meet the key's small side.
SALTS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path is only ever opened by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is missing, a temporary folder is set for this session, and only if the master is
    local: on a cluster a machine's own folder would not be seen by the others.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe if an executor is lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salt_of(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def first_per_key(rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """(key, salts, first_id, n): the smallest id and the row count of each key, pre-aggregated per (key, salt).

    ``rows`` must have a ``salt`` column (``salt_of``). ``salts`` lists the salts a key occurs with, at most
    ``SALTS`` of them, so that :func:`lookup_salted` can send the result to every salt of a hot key.
    """
    part = rows.groupBy(key, "salt").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n"))
    return part.groupBy(key).agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n"),
                                 F.collect_list("salt").alias("salts"))


def lookup_salted(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Join ``keyed`` (one row per key, with ``salts``) to all ``rows``; a hot key is spread over its salts."""
    return rows.join(keyed.withColumn("salt", F.explode("salts")).drop("salts"), [key, "salt"]).drop("salt")


# --- vectorised word hashing -------------------------------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240117)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]        # words are compared with A-Z lower-cased
#: Odd multipliers for the words of a window, by their place in it.
PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)
_SLICE = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_slice(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start bytes and 64-bit hashes of the white-space separated words of ``data``."""
    global _powers
    a = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[a], [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    length = ends - starts
    longest = int(length.max())
    if longest > len(_powers):
        _powers = np.cumprod(np.full(2 * longest, _STEP, dtype=np.uint64))
    total = int(length.sum())
    base = np.cumsum(length) - length
    place = np.arange(total) - np.repeat(base, length)
    value = _BYTE[a[np.repeat(starts, length) + place]] * _powers[place]
    return starts, mix64(np.add.reduceat(value, base) + length.astype(np.uint64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A very long text in parts cut at white space, so that memory stays bounded."""
    at = 0
    while len(text) - at > 4 * _SLICE:
        cut = at + _SLICE
        while cut < len(text) and not _SPACE[text[cut]]:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_hashes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The 64-bit hashes of each text's words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; whole texts, in order."""
    def flush(group: list[bytes]) -> Iterator[np.ndarray]:
        starts, hashes = _hash_slice(b"\n".join(group))
        ends = np.cumsum([len(t) + 1 for t in group])
        at = 0
        for stop in np.searchsorted(starts, ends):
            yield hashes[at:stop]
            at = stop

    group, size = [], 0
    for t in texts:
        if len(t) > 4 * _SLICE:
            yield from flush(group)
            group, size = [], 0
            yield np.concatenate([_hash_slice(p)[1] for p in _pieces(t)])
            continue
        group.append(t)
        size += len(t) + 1
        if size >= _SLICE:
            yield from flush(group)
            group, size = [], 0
    yield from flush(group)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of all ``width``-word windows; of a shorter text, its whole sequence as one."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    if n < width:
        return mix64(np.atleast_1d((words * PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)))
    h = words[: n - width + 1] * PLACE[0]
    for i in range(1, width):
        h = h + words[i: n - width + 1 + i] * PLACE[i]
    return np.unique(mix64(h))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator works on, under its own names; whatever else the input has cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])
