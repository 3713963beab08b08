"""Insert-ignore against a persistent index of the keys a table holds.

The index has a row per key: Parquet files bucketed and sorted by key, one folder per load. A batch is probed by a
sort-merge join that reads the buckets where they are: only the batch is shuffled, never the index, whose cost is one
scan of the key columns. Folders count once a commit of the :class:`~cabwh.sources.store.Store` names them, so keys of
a failed load are not "seen" by its repetition. Every ``MERGE_LOADS`` loads the folders are merged into one, again
without a shuffle, so that a bucket is a bounded number of files.

As with a primary key, a key that the batch repeats is stored once; a NULL key is equal to no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabwh.operators.writes import one_per_key
from cabwh.sources.store import Load

MERGE_LOADS = 32


class KeyIndex:
    """The keys of ``table``; ``buckets`` (default: the session's shuffle partitions) is fixed by the first load."""

    def __init__(self, table: str, keys: Sequence[str], buckets: int | None = None, merge_loads: int = MERGE_LOADS):
        self.name, self.keys, self.buckets, self.merge_loads = f"{table}_keys", list(keys), buckets, merge_loads

    def _catalog(self, load: Load, schema: T.StructType) -> str:
        """The index as a bucketed table of this session's catalog; its files are what is persistent."""
        spark = load.store.spark
        path = f"{load.store.root}/{self.name}"
        name = f"key_index_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        if not spark.catalog.tableExists(name):
            stored = [k for k in load.parts(self.name)]
            buckets = int(stored[0].split("/")[0]) if stored else self.buckets or int(
                spark.conf.get("spark.sql.shuffle.partitions"))
            columns = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in self.keys)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(f"CREATE TABLE {name} ({columns}, load STRING) USING parquet PARTITIONED BY (load) "
                      f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return name

    def _buckets(self, load: Load, name: str) -> int:
        rows = load.store.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
        return int(rows[0].data_type)

    def stored(self, load: Load, schema: T.StructType) -> DataFrame:
        """The keys of committed loads and of this one."""
        spark, name = load.store.spark, self._catalog(load, schema)
        spark.catalog.refreshTable(name)
        loads = [k.split("/")[1] for k in load.parts(self.name)]
        return spark.read.table(name).filter(F.col("load").isin(loads)).select(*self.keys)

    def seen(self, load: Load, candidates: DataFrame) -> DataFrame:
        """The distinct keys of ``candidates`` that the index holds."""
        keys = candidates.select(*self.keys).distinct()
        return keys.join(self.stored(load, keys.schema).hint("merge"), self.keys, "left_semi")

    def unseen(self, load: Load, delta: DataFrame) -> DataFrame:
        """The rows of ``delta`` whose key the index does not hold, one per key."""
        return one_per_key(delta, self.keys).join(self.stored(load, delta.schema).hint("merge"), self.keys, "left_anti")

    def add(self, load: Load, new: DataFrame) -> None:
        """Add the keys of ``new`` (unseen, one row per key)."""
        self._insert(load, new.select(*self.keys), load.id)
        parts = load.parts(self.name)
        if len(parts) > self.merge_loads:
            self._insert(load, self.stored(load, new.schema), f"{load.id}-merged")
            load.drop(self.name, lambda k: k not in parts)

    def _insert(self, load: Load, keys: DataFrame, folder: str) -> None:
        name = self._catalog(load, keys.schema)
        n = self._buckets(load, name)
        # dealt out as the table is bucketed: each task writes one sorted file of one bucket
        keys.repartition(n, *self.keys).withColumn("load", F.lit(folder)).write.insertInto(name)
        load.name(self.name, keys.select(*self.keys).schema, f"{n}/{folder}", f"{self.name}/load={folder}")


def insert_ignore_indexed(load: Load, table: str, delta: DataFrame, keys: Sequence[str], index: KeyIndex | None = None,
                          part: str | None = None, by: str | None = None) -> DataFrame:
    """Append the rows of ``delta`` with keys that ``table`` does not hold; returns them.

    They are written as the part ``part`` (default: the load) or one part per value of the column ``by``.
    """
    index = index or KeyIndex(table, keys)
    new = index.unseen(load, delta).checkpoint()         # written as rows and as keys: computed once
    index.add(load, new)
    load.write(table, new, part or load.id, by)
    return new.drop(by) if by else new
