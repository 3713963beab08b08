"""Tables in hash buckets by key, of which a batch rewrites only the buckets it touches.

A bucket is a part of the table in the :class:`~cabwh.sources.store.Store`; its key is ``<bucket>-<buckets>``. A batch
reads the buckets its keys fall into, writes their new rows into folders of its own, and the commit names those
instead. The files of all other buckets stay as they are, and a failed batch changes nothing.

A batch of k keys touches at most k buckets, so a table wants many more buckets than a daily batch has keys, down to
files of some tens of MB; ``buckets`` is fixed by the first batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabwh.operators.writes import upsert
from cabwh.session import stored
from cabwh.sources.store import Load

BUCKETS = 128
_COLUMN = "_bucket"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class BucketedTable:
    """``name`` with one row per ``keys``, in ``buckets`` buckets by the columns ``by`` (default: the keys)."""

    def __init__(self, name: str, keys: Sequence[str], buckets: int = BUCKETS, by: Sequence[str] | None = None):
        self.name, self.keys, self.buckets = name, list(keys), buckets
        self.by = list(by or keys)

    def _count(self, load: Load) -> int:
        stored = {k.split("-")[1] for k in load.parts(self.name)}
        return int(stored.pop()) if stored else self.buckets

    def bucket(self, load: Load) -> Column:
        n = self._count(load)
        return F.concat(F.pmod(F.hash(*self.by), F.lit(n)).cast("string"), F.lit(f"-{n}"))

    def touched(self, load: Load, rows: DataFrame) -> list[str]:
        """The buckets of ``rows`` (columns ``by``): at most ``buckets`` names."""
        return sorted(r[0] for r in rows.select(self.bucket(load).alias(_COLUMN)).distinct().collect())

    def read(self, load: Load, rows: DataFrame | None = None) -> DataFrame | None:
        """The table, or only the buckets that ``rows`` fall into."""
        if rows is None:
            return load.read(self.name)
        wanted = set(self.touched(load, rows))
        return load.read(self.name, lambda k: k in wanted)

    def merge(self, load: Load, delta: DataFrame, how: Merge) -> DataFrame:
        """Replace the buckets of ``delta`` by ``how(old rows of them, delta)``; returns the delta as stored for that."""
        delta = stored(delta, f"delta-{self.name}")      # read for its buckets and for the merge: computed once
        wanted = self.touched(load, delta)
        old = load.read(self.name, lambda k: k in set(wanted))
        new = delta if old is None else how(old, delta)
        # a given number of partitions: left to itself, a small batch would write all bucket files in one task
        tasks = int(load.store.spark.conf.get("spark.sql.shuffle.partitions"))
        load.replace(self.name, new.withColumn(_COLUMN, self.bucket(load)).repartition(tasks, _COLUMN)
                     .sortWithinPartitions(_COLUMN, *self.keys), _COLUMN, wanted)
        return delta

    def upsert(self, load: Load, delta: DataFrame, update_cols: Sequence[str]) -> DataFrame:
        """New keys are inserted whole; of known ones only ``update_cols`` change (keys of ``delta`` are unique)."""
        return self.merge(load, delta, lambda old, d: upsert(old, d, self.keys, update_cols))

    def add(self, load: Load, delta: DataFrame) -> DataFrame:
        """Add ``delta``'s numbers (all columns but the keys; one or more rows per key) to the stored sums."""
        def summed(old: DataFrame, more: DataFrame) -> DataFrame:
            sums = [F.sum(c).cast(more.schema[c].dataType).alias(c) for c in more.columns if c not in self.keys]
            return old.unionByName(more).groupBy(*self.keys).agg(*sums).select(*more.columns)

        return self.merge(load, delta if load.has(self.name) else summed(delta.limit(0), delta), summed)
