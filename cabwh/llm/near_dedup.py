"""Near-duplicate classes by MinHash: one-permutation hashing, banded buckets and star-shaped candidate edges.

1. One pass over the texts hashes each document's set of distinct 5-word shingles once. The range of hashes is cut
   into bins whose smallest hashes are the signature; an empty bin borrows from the first filled one in a probing
   order of its own (optimal densification). ``ROWS`` bins make a band, a band's hash a bucket.
2. Documents with the same set are one node from here on (pre-aggregated, so thousands of copies are one row).
3. Each bucket sends edges from a centre to its members only. Every edge is confirmed on the full sets, and
   confirmed ones are merged into components. A bucket whose members are all in one component is done. Otherwise
   its centre has now met everybody and leaves. So does every member that cannot be linked with any other one left:
   shingles that no other one has are missing in each intersection, which bounds the similarity from above. The
   rest chooses new centres, ``CENTRES`` times as many each round: what the first centre did not link is mostly
   linked by none, which has to be shown member by member. Nearly all of these pairs are ruled out without their sets:
   each set's shared shingles are counted on ``PLACES`` places, and two sets share no more than the lesser count of each
   place. So no two members that are still apart and could be linked stay uncompared, while a group around one original
   costs one edge a member.

There are as many bands as it takes for two documents at the wanted similarity to share no bucket with a
probability below ``MISS`` (28 at 0.85, 41 at 0.8).

Defined cases: a null, empty or blank text has no shingles, is a component of its own and is linked with nothing;
a shorter text's whole word sequence is its one shingle; rows that repeat an id and its text get the same
component and are all kept or none; a null id is never a component's id unless the component has no other; an
empty table gives no rows; very long texts are hashed whole; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import (
    PLACE,
    first_per_key,
    lookup_salted,
    mix64,
    plain,
    shingles,
    table,
    texts_of,
    word_hashes,
    written,
)

WIDTH = 5
ROWS = 5
MISS = 1e-7
PERCENT = 80
#: Centres of a bucket: 1 in the first round, then so many times as many in each further one.
CENTRES = 64
#: A set's shingles are counted by this many places (by hash) to bound what two sets share.
PLACES = 64


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


@lru_cache(maxsize=4)
def _tables(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Row i of the first: the order in which empty bin i looks for a filled one; the second tells bands apart."""
    rng = np.random.default_rng(11)
    return (np.argsort(rng.random((ROWS * bands, ROWS * bands)), axis=1),
            rng.integers(1, 2**63, bands, dtype=np.uint64))


def signature(s: np.ndarray, bands: int) -> np.ndarray:
    """The densified one-permutation MinHash of a sorted, non-empty shingle set."""
    size = ROWS * bands
    bins = (((s >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out, filled = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=bool)
    out[bins[first]], filled[bins[first]] = s[first], True
    if len(first) < size:
        empty = np.flatnonzero(~filled)
        probes = _tables(bands)[0][empty]
        out[empty] = out[probes[np.arange(len(empty)), filled[probes].argmax(axis=1)]]
    return out


def band_keys(s: np.ndarray, bands: int) -> np.ndarray:
    sig = signature(s, bands).reshape(bands, ROWS)
    return mix64((sig * PLACE[:ROWS]).sum(axis=1, dtype=np.uint64) + _tables(bands)[1]).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0] + [len(p) for p in parts], dtype=np.int32), pa.array(flat))


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def fingerprints(docs: DataFrame, bands: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, digest, keys) per row: set size, identity of the set, bucket keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(w, WIDTH) for w in word_hashes(texts_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) for s in sets], pa.binary()),
                 _lists([band_keys(s, bands) if len(s) else np.zeros(0, dtype=np.int64) for s in sets])],
                ["id", "n", "digest", "keys"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return plain(docs, id=id_col, text=text_col).mapInArrow(
        run, f"id {id_type}, n bigint, digest binary, keys array<bigint>")


def full_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, shingles) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, ids, size = [], [], 0
            for i, w in zip(batch.column(0), word_hashes(texts_of(batch.column(1))), strict=True):
                s = shingles(w, WIDTH)
                group.append(s)
                ids.append(i.as_py())
                size += len(s)
                if size > 500_000:
                    yield out(ids, group, batch)
                    group, ids, size = [], [], 0
            yield out(ids, group, batch)

    def out(ids: list, group: list[np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.column(0).type), pa.array([_digest(s) for s in group], pa.binary()),
             _lists([s.view(np.int64) for s in group])], ["id", "digest", "shingles"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return plain(docs, id=id_col, text=text_col).mapInArrow(run, f"id {id_type}, digest binary, shingles array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): the smallest node reachable, by alternating star steps."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
                "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        state = now


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (row, comp) after the components that ``links`` (a, b: rows) join are merged."""
    of = lambda c: labels.select(F.col("row").alias(c), F.col("comp").alias(f"{c}_comp"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
    merged = components(edges).withColumnRenamed("comp", "into")
    return written(labels.join(merged, labels["comp"] == merged["node"], "left")
                   .select("row", F.coalesce("into", "comp").alias("comp")), "labels")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= percent * union holds on the full sets."""
    of = lambda c: sets.select(F.col("row").alias(c), F.col("shingles").alias(f"s_{c}"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (pairs.join(of("b"), "b").join(of("a"), "a").withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("s_a") + F.size("s_b") - F.col("both")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable), kept."""
    # row: a number for each input row, fixed by writing it
    prints = written(fingerprints(docs, bands_for(percent), id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "prints")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    classes = written(first_per_key(prints.filter("n > 0").select(
        "digest", order.alias("first"), F.pmod(F.xxhash64("row"), F.lit(256)).cast("int").alias("salt")),
        "digest", "first"), "classes")
    nodes = classes.select(F.col("first_id.row").alias("row"))
    buckets = prints.join(nodes, "row").select("row", "n", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(buckets.join(shared, "key"), "members")
    weight = members.groupBy("row").agg(F.sum("size").alias("weight"))
    candidates = written(weight.join(prints.select("row", "id", "digest"), "row"), "candidates")
    sets = written(_sets_of(docs, candidates, id_col, text_col), "sets")
    labels = candidates.select("row", F.col("row").alias("comp"))
    live = members.join(candidates.select("row", "weight"), "row").select("key", "row", "n", "weight")
    tested, round_no = None, 0
    while True:
        if round_no:
            state = written(_mixed(live.join(labels, "row")), "star-candidates")
            state = _mixed(_linkable(state, sets, percent))
        else:                                            # each member is a component of its own
            state = live.withColumns({"comp": F.col("row"), "common": F.col("n"),
                                      "places": F.lit(None).cast("array<int>")})
        state = written(state, "star-round")
        if state.isEmpty():
            break
        slot = F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(CENTRES ** min(round_no, 10)))
        centres = state.groupBy("key", slot.alias("slot")).agg(F.max(F.struct(
            "weight", (-F.col("row")).alias("minus"), "row", "n", "common", "comp", "places")).alias("c"))
        centres = written(centres.select("key", F.col("c.row").alias("c_row"), F.col("c.n").alias("c_n"),
                                         F.col("c.common").alias("c_common"), F.col("c.comp").alias("c_comp"),
                                         F.col("c.places").alias("c_places")), "centres")
        met = state.join(centres, "key").filter("comp <> c_comp").filter(
            (100 + percent) * F.least("common", "c_common") >= percent * (F.col("n") + F.col("c_n")))
        if round_no:
            # what two sets share on a place is no more than either has there
            most = F.aggregate(F.zip_with("places", "c_places", lambda x, y: F.least(x, y)),
                               F.lit(0).cast("long"), lambda x, y: x + y)
            met = met.filter((100 + percent) * most >= percent * (F.col("n") + F.col("c_n")))
        pairs = met.select(F.least("row", "c_row").alias("a"), F.greatest("row", "c_row").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        links = written(_confirmed(pairs, sets, percent), "links")
        if not links.isEmpty():
            labels = _relabel(labels, links)
        tested = pairs if tested is None else tested.unionByName(pairs)
        live = state.join(centres.select("key", F.col("c_row").alias("row")), ["key", "row"], "left_anti").drop(
            "comp", "common", "places")
        round_no += 1

    named = classes.select("digest", "salts", F.col("first_id.row").alias("row"), F.col("first_id.id").alias("first"))
    named = named.join(labels, "row", "left").withColumn("comp", F.coalesce("comp", "row"))
    lowest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "comp").select("digest", "salts", "component_id")
    full = lookup_salted(prints.filter("n > 0").select(
        "id", "n", "digest", F.pmod(F.xxhash64("row"), F.lit(256)).cast("int").alias("salt")), named, "digest")
    return full.select("id", "n", "component_id").unionByName(
        prints.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))).select(
        "id", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _mixed(state: DataFrame) -> DataFrame:
    """The rows of buckets whose members are in more than one component."""
    mixed = state.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    return state.join(mixed.select("key"), "key", "left_semi")


def _linkable(state: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members that can still be linked with another one of their bucket, with ``common`` and ``places``.

    ``common``: shingles that some other member of ``state`` has too. An intersection is no larger, and with set
    sizes n and m it must reach percent * (n + m) / (100 + percent); m is at least the bucket's least size, and
    at least percent / 100 of n. ``places``: how many of these shingles fall on each of ``PLACES`` places.
    """
    rows = sets.join(state.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"])
    alone = (rows.select("row", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("c")).filter("c = 1")
             .groupBy("row").agg(F.collect_list("shingle").alias("alone")))       # no more than the row's own set
    shared = rows.join(alone, "row", "left").select("row", "shingles", "alone").mapInArrow(
        _places, "row bigint, common bigint, places array<int>")
    least = state.groupBy("key").agg(F.min("n").alias("least"))
    return (state.join(shared, "row").join(least, "key")
            .filter((100 + percent) * F.col("common")
                    >= percent * (F.col("n") + F.greatest("least", F.col("n") * percent / 100)))
            .drop("least"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common, places = [], []
        for own, alone in zip(batch.column(1), batch.column(2), strict=True):
            n = np.zeros(PLACES, dtype=np.int64)
            for sign, part in ((1, own.values), (-1, alone.values)):
                if part is not None:
                    s = part.to_numpy(zero_copy_only=False).view(np.uint64)
                    n += sign * np.bincount((s % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
            common.append(int(n.sum()))
            places.append(n.astype(np.int32))
        flat = np.concatenate(places) if places else np.zeros(0, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(common, pa.int64()),
             pa.ListArray.from_arrays(np.arange(len(places) + 1, dtype=np.int32) * PLACES, pa.array(flat))],
            ["row", "common", "places"])


def _sets_of(docs: DataFrame, candidates: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, shingles) of the candidates, from a second reading of their texts."""
    ids = candidates.select(F.col("id").alias("__candidate")).distinct()
    texts = docs.join(ids, docs[id_col].eqNullSafe(ids["__candidate"]), "left_semi")
    sets = full_sets(texts, id_col, text_col)
    wanted = candidates.select("row", F.col("id").alias("w_id"), F.col("digest").alias("w_digest"))
    return sets.join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("digest") == F.col("w_digest"))).select(
        "row", "shingles")


def keep_one_of_each_group(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = near_duplicates(docs, percent, id_col, text_col).filter("kept").select(F.col("id").alias("__kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__kept_id"]), "left_semi")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked at similarity 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).withColumnRenamed("id", "doc_id")
