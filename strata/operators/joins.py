"""Fact-to-dimension joins: current, calendar, as-of (three strategies), unmatched.

Broadcast is only forced for the calendar, whose row count is fixed by its
date range and checked here. Data-sized dimensions are left to the planner:
Spark broadcasts them when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE switches a sort-merge join to
a broadcast (or splits a skewed partition) from the sizes it measures at run
time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scd import END_COL, START_COL, join_on, max_rows_per_key, resolve_bucket

# Largest calendar we force-broadcast: ~2,700 years of days, ~100 bytes a row.
MAX_BROADCAST_CALENDAR_ROWS = 1_000_000


def join_current(fact: DataFrame, dim: DataFrame, keys) -> DataFrame:
    """Inner equi-join on ``keys`` (USING semantics: one copy of each key)."""
    return fact.join(dim, list(keys), "inner")


def join_calendar(fact: DataFrame, cal: DataFrame, date_col: str, cal_rows: int | None = None) -> DataFrame:
    """Inner join to the date spine; facts outside the spine are dropped.

    ``cal_rows`` is the spine's known row count; it is broadcast only under
    ``MAX_BROADCAST_CALENDAR_ROWS``.
    """
    side = F.broadcast(cal) if cal_rows is not None and cal_rows <= MAX_BROADCAST_CALENDAR_ROWS else cal
    return fact.join(side, F.col(date_col).cast("date") == side["date"], "inner")


def unmatched(fact: DataFrame, dim_keys: DataFrame, keys) -> DataFrame:
    """Facts with no dimension row (a NULL key counts as unmatched)."""
    return fact.join(dim_keys.select(*keys), list(keys), "left_anti")


def _probe_time(probe_ts: str, versions: DataFrame, start: str) -> Column:
    return F.col(probe_ts).cast(versions.schema[start].dataType)


def _before(t: Column, end: Column) -> Column:
    """``t`` lies before a version's end; an open version never ends."""
    return end.isNull() | (t < end)


# Versions a key may have before its probes leave the pair-forming join for the sweep.
MAX_VERSIONS_PER_KEY = 256


def _split_hot(probe: DataFrame, versions: DataFrame, keys, limit: int):
    """(cold probes, cold versions, hot probes, hot versions) by versions per key."""
    hot = versions.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys)
    return (probe.join(hot, keys, "left_anti"), versions.join(hot, keys, "left_anti"),
            probe.join(hot, keys, "left_semi"), versions.join(hot, keys, "left_semi"))


def _routed(pairwise, probe, versions, keys, probe_ts, attrs, start, end, limit, **kw) -> DataFrame:
    keys = list(keys)
    if limit is None or (not versions.isStreaming and max_rows_per_key(versions, keys) <= limit):
        return pairwise(probe, versions, keys, probe_ts, attrs, start, end, **kw)
    cp, cv, hp, hv = _split_hot(probe, versions, keys, limit)
    cold = pairwise(cp, cv, keys, probe_ts, attrs, start, end, **kw)
    hot = asof_sweep_join(hp, hv, keys, probe_ts, attrs, start, end, bucket="day")
    return cold.unionByName(hot)


def asof_interval_join(probe: DataFrame, versions: DataFrame, keys, probe_ts: str, attrs,
                       start: str = START_COL, end: str = END_COL,
                       max_versions_per_key: int | None = MAX_VERSIONS_PER_KEY) -> DataFrame:
    """Key equality plus ``start <= t`` and ``t < end`` or an open end (half-open).

    The dimension side is projected to key, attributes and validity first, so
    no column is ambiguous. An equi-join forms (probe, version) candidate pairs
    per key, so keys with more than ``max_versions_per_key`` versions are sent
    to ``asof_sweep_join`` instead (same result, no pairs); ``None`` disables
    the routing. The version count per key is measured first (one number), so
    the split plan is only built when a hot key exists.
    """
    return _routed(_interval, probe, versions, keys, probe_ts, attrs, start, end, max_versions_per_key)


def _interval(probe: DataFrame, versions: DataFrame, keys, probe_ts: str, attrs,
              start: str, end: str) -> DataFrame:
    keys = list(keys)
    v = versions.select(*[F.col(k).alias(f"_v_{k}") for k in keys],
                        F.col(start).alias("_vs"), F.col(end).alias("_ve"), *attrs)
    t = _probe_time(probe_ts, versions, start)
    cond = [probe[k] == v[f"_v_{k}"] for k in keys]
    cond += [t >= v["_vs"], _before(t, v["_ve"])]
    out = probe.join(v, cond, "inner")
    return out.select(*probe.columns, *attrs)


def asof_bucketed_join(probe: DataFrame, versions: DataFrame, keys, probe_ts: str, attrs,
                       start: str = START_COL, end: str = END_COL, bucket: str = "month",
                       max_versions_per_key: int | None = MAX_VERSIONS_PER_KEY) -> DataFrame:
    """Interval join with the candidates cut by time bucket.

    Every version is exploded into the buckets its validity overlaps, clipped at
    both ends to the probes' times (scalar subqueries), so a version dated back
    by a century adds no empty buckets. Probes get the
    bucket of their time, and the equi-join runs on (key, bucket) with the
    range test as residual. Same result as ``asof_interval_join``; keys with
    more than ``max_versions_per_key`` versions go to the sweep.
    """
    return _routed(_bucketed, probe, versions, keys, probe_ts, attrs, start, end, max_versions_per_key,
                   bucket=bucket)


def _bucketed(probe: DataFrame, versions: DataFrame, keys, probe_ts: str, attrs,
              start: str, end: str, bucket: str = "month") -> DataFrame:
    keys = list(keys)
    t = _probe_time(probe_ts, versions, start)
    low, high = probe.select(F.min(t)).scalar(), probe.select(F.max(t)).scalar()
    vstart, vend = F.greatest(F.col(start), low), F.least(F.coalesce(F.col(end), high), high)
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    buckets = F.sequence(F.date_trunc(bucket, vstart), F.date_trunc(bucket, vend), step)
    v = versions.select(*[F.col(k).alias(f"_v_{k}") for k in keys],
                        F.col(start).alias("_vs"), F.col(end).alias("_ve"), *attrs,
                        F.explode(F.when(vstart <= vend, buckets)).alias("_vb"))
    p = probe.withColumn("_pb", F.date_trunc(bucket, t))
    cond = [p[k] == v[f"_v_{k}"] for k in keys] + [p["_pb"] == v["_vb"]]
    cond += [t >= v["_vs"], _before(t, v["_ve"])]
    return p.join(v, cond, "inner").select(*probe.columns, *attrs)


def asof_sweep_join(probe: DataFrame, versions: DataFrame, keys, probe_ts: str, attrs,
                    start: str = START_COL, end: str = END_COL, bucket: str | None = "auto",
                    how: str = "inner", matched_col: str | None = None) -> DataFrame:
    """As-of join without forming candidate pairs.

    Probes and versions are unioned and sorted per (key, time bucket); each
    probe takes the last version that started at or before it (versions sort
    first at equal times, start is inclusive). A probe with no such version in
    its own bucket takes the last version of the key's earlier buckets, read
    from a per-(key, bucket) summary. Work is linear in the input, and a hot
    key is spread over its buckets (``bucket="auto"`` buckets only when a key
    is hot). Same result as ``asof_interval_join`` for versions that do not
    overlap within a key.

    ``how="left"`` keeps every probe (attributes NULL without a version);
    ``matched_col`` then names a boolean column telling which probes matched.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = list(keys)
    t = _probe_time(probe_ts, versions, start)
    ts_type = versions.schema[start].dataType
    pstruct = F.struct(*[probe[c] for c in probe.columns])
    vstruct = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), *[F.col(a) for a in attrs])
    p_type = probe.select(pstruct.alias("x")).schema["x"].dataType
    v_type = versions.select(vstruct.alias("x")).schema["x"].dataType
    key_ok = [F.col(k).isNotNull() for k in keys]
    P = (probe.filter(_all(key_ok)) if how == "inner" else probe).select(
        *keys, t.alias("_t"), F.lit(1).alias("_kind"), pstruct.alias("_p"),
        F.lit(None).cast(v_type).alias("_v"))
    V = versions.filter(_all(key_ok)).select(
        *keys, F.col(start).alias("_t"), F.lit(0).alias("_kind"),
        F.lit(None).cast(p_type).alias("_p"), vstruct.alias("_v"))
    u = P.unionByName(V)
    bucket = resolve_bucket(u, keys, bucket, "_t")
    u = u.withColumn("_b", F.date_trunc(bucket, "_t").cast(ts_type) if bucket else F.lit(0))
    # Of versions that start together the one that lasts longest comes last, so
    # one of no length never hides it.
    win = (Window.partitionBy(*keys, "_b").orderBy("_t", "_kind", F.col("_v.e").asc_nulls_last())
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_cur", F.last("_v", ignorenulls=True).over(win))
    probes = u.filter(F.col("_kind") == 1)
    if bucket:
        # Last version starting in each (key, bucket), carried over later buckets.
        wk = (Window.partitionBy(*keys).orderBy("_b")
                    .rowsBetween(Window.unboundedPreceding, -1))
        summary = (u.groupBy(*keys, "_b")
                    .agg(F.max(F.when(F.col("_kind") == 0, F.struct(
                        "_t", F.col("_v.e").isNull().alias("_open"), F.col("_v.e").alias("_e"), "_v"))).alias("_lv"))
                    .withColumn("_carry", F.last(F.col("_lv._v"), ignorenulls=True).over(wk))
                    .drop("_lv"))
        probes = join_on(probes, summary, [*keys, "_b"])
        hit = F.coalesce(F.col("_cur"), F.col("_carry"))
    else:
        hit = F.col("_cur")
    probes = probes.withColumn("_hit", hit)
    ok = F.coalesce(F.col("_hit").isNotNull() & _before(F.col("_t"), F.col("_hit.e")), F.lit(False))
    probe_cols = [F.col(f"_p.{c}").alias(c) for c in probe.columns]
    if how == "inner":
        return probes.filter(ok).select(*probe_cols, *[F.col(f"_hit.{a}").alias(a) for a in attrs])
    extra = [ok.alias(matched_col)] if matched_col else []
    return probes.select(*probe_cols, *[F.when(ok, F.col(f"_hit.{a}")).alias(a) for a in attrs], *extra)


def _all(conds):
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out
