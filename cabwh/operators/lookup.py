"""Point-in-time (C7) and interval (J8) joins.

Both are an equi-join plus a closed range predicate. A plain equi-join on the entity key
alone would pair every fact of a busy car with every waybill that car ever had (the
join buffers all of the key's waybills); with a time bucket as a second equi-key each fact
meets only the intervals that touch its own bucket. Intervals are exploded to the buckets they
cover within the facts' time span, so the bucketed join is exact.

The exploded sides are joined by sort-merge, said by a hint: Spark counts an exploded row as one row, takes the side
for small and would send all of it through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabwh.functions import epoch_seconds


def explode_buckets(intervals: DataFrame, start: str, end: str, out: str, width_s: int,
                    lo: Column, hi: Column) -> DataFrame:
    """One row per bucket of ``width_s`` seconds that an interval [start, end] touches within [lo, hi].

    The clip bounds the rows of an interval that never ends. Empty and NULL intervals, and those outside [lo, hi],
    vanish; with a NULL bound (no facts) all do.
    """
    first, last = F.greatest(F.col(start), lo), F.least(F.col(end), hi)
    valid = intervals.filter((F.col(start) <= F.col(end)) & (F.col(start) <= hi) & (F.col(end) >= lo))
    return valid.withColumn(out, F.explode(F.sequence(bucket(first, width_s), bucket(last, width_s))))


def bucket(ts: Column, width_s: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(width_s)).cast("bigint")


#: Width of a bucket: a shift of half a day is one row or two, and a ride meets its car's shifts of a day.
BUCKET_S = 24 * 3600
#: A key with more facts than this is spread over salts, the heaviest ``HOT_KEYS`` of them.
HOT_ROWS = 10_000
HOT_KEYS = 200


def point_in_time_lookup(
    facts: DataFrame,
    intervals: DataFrame,
    fact_id: str,
    fact_key: str,
    fact_ts: str,
    iv_key: str,
    iv_start: str,
    iv_end: str,
    order: Sequence[str],
    take: Sequence[str],
    exclusive: bool = False,
    width_s: int = BUCKET_S,
    times: DataFrame | None = None,
) -> DataFrame:
    """For each fact row, the **first** interval (by ``order``) of the same key that contains ``fact_ts``.

    Returns every fact row (left join) with the ``take`` columns of the chosen interval,
    NULL when none matches, plus ``_matches`` = number of containing intervals.
    Bounds are inclusive (``exclusive=True``: strict on both ends).

    Facts and intervals meet on (key, bucket of ``width_s`` seconds), so a key that holds a third of all facts is
    spread over its buckets. Facts with a NULL key or time match nothing and are spread by their id. Intervals are
    cut to the span of the facts' times; ``times`` may name a cheaper relation whose column ``fact_ts`` covers it.
    """
    iv_cols = [c for c in {*order, *take} if c not in (iv_key, iv_start, iv_end)]
    span = (facts if times is None else times).agg(F.struct(F.min(fact_ts).alias("lo"), F.max(fact_ts).alias("hi"))).scalar()
    iv = explode_buckets(intervals.select(iv_key, iv_start, iv_end, *iv_cols), iv_start, iv_end, "_iv_bucket", width_s,
                         span.getField("lo"), span.getField("hi"))
    iv = iv.withColumnRenamed(iv_key, "_iv_key")
    ts = F.col(fact_ts)
    nowhere = F.col(fact_key).isNull() | ts.isNull()
    f = facts.withColumn("_f_bucket", F.when(nowhere, F.xxhash64(fact_id)).otherwise(bucket(ts, width_s)))

    inside = (ts > F.col(iv_start)) & (ts < F.col(iv_end)) if exclusive else ts.between(F.col(iv_start), F.col(iv_end))
    cond = (F.col(fact_key) == F.col("_iv_key")) & (F.col("_f_bucket") == F.col("_iv_bucket")) & inside
    joined = f.join(iv.hint("merge"), cond, "left")
    # The fact's (key, bucket) decides its join partition; ranking within (key, bucket, id)
    # reuses that hash partitioning instead of shuffling again by id.
    w = Window.partitionBy(fact_key, "_f_bucket", fact_id)
    ranked = (
        joined.withColumn("_rn", F.row_number().over(w.orderBy(*[F.col(c).asc_nulls_last() for c in order])))
        .withColumn("_matches", F.count("_iv_key").over(w))
        .filter(F.col("_rn") == 1)
    )
    keep = [c for c in facts.columns] + [c for c in take if c not in facts.columns]
    return ranked.select(*keep, F.col("_matches").cast("bigint").alias("_matches"))


def hot_keys(rows: DataFrame, key: str) -> Column:
    """The keys of more than ``HOT_ROWS`` rows, at most the ``HOT_KEYS`` heaviest, as an array: a scalar of the plan.

    Any other key holds less than one in ``HOT_KEYS`` of the rows, or at most ``HOT_ROWS``.
    """
    n = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    heaviest = F.sort_array(F.collect_list(F.struct("_n", "_k")), asc=False)
    return n.filter(F.col("_n") > HOT_ROWS).agg(F.slice(heaviest, 1, HOT_KEYS).getField("_k").alias("_hot")).scalar()


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_ts: str,
    ver_key: str,
    ver_start: str,
    ver_end: str,
    how: str = "inner",
    half_open: bool = False,
    splits: int = 16,
) -> DataFrame:
    """Facts joined to the versions of the same key whose [start, end] contains ``fact_ts``.

    Versions per key are few (one per card change); those of the :func:`hot_keys` are copied to ``splits`` salts and
    the facts of such a key are spread over the salts by a hash of the row, so one key with a third of all facts is
    not one task. All other versions are sent once. ``facts`` is read twice, so it should be stored rows. An aggregate
    by key that follows combines before its own shuffle.
    ``half_open=True`` matches [start, end + 1 s) instead: a version then ends where the
    next begins, and a sub-second time inside the 1 s gap still finds its version.
    """
    cols = [*facts.columns, *versions.columns]
    hot = hot_keys(facts, fact_key)
    own = F.pmod(F.xxhash64(*facts.columns), F.lit(splits)).cast("int")
    facts = facts.withColumn("_f_salt", F.when(F.array_contains(hot, F.col(fact_key)), own).otherwise(F.lit(0)))
    salts = F.when(F.array_contains(hot, F.col(ver_key)), F.sequence(F.lit(0), F.lit(splits - 1)))
    versions = versions.withColumn("_v_salt", F.explode(F.coalesce(salts, F.array(F.lit(0)))))
    ts = F.col(fact_ts)
    if half_open:
        inside = (ts >= F.col(ver_start)) & (ts < F.col(ver_end) + F.expr("INTERVAL 1 SECOND"))
    else:
        inside = ts.between(F.col(ver_start), F.col(ver_end))
    same = (F.col(fact_key) == F.col(ver_key)) & (F.col("_f_salt") == F.col("_v_salt"))
    return facts.join(versions.hint("merge"), same & inside, how).select(*cols)
