"""Change application: type 1 (latest row per key) and type 2 (full history).

Both are written so that one hot key cannot pin a single task:

* type 1 is an aggregate (max over a struct led by the sequence), which Spark plans
  with a map-side partial step; a key holding a third of the rows is reduced
  to one row per map task before the shuffle.
* type 2 needs the row order inside a key. With ``bucket`` set (e.g. "day") the
  ordered work is partitioned by (key, time bucket), and the few cross-bucket
  facts (the last value before a bucket, the first version after it) come from
  a small per-(key, bucket) summary, so a hot key is spread over its buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

START_COL = "__START_AT"
END_COL = "__END_AT"
# Rows one key may have before its ordered work is split over time buckets:
# a single sort task handles this comfortably in memory (with spill beyond).
HOT_KEY_ROWS = 5_000_000
BUCKET_UNITS = ("day", "hour", "minute", "second")


def max_rows_per_key(df: DataFrame, keys) -> int:
    """Largest number of rows any key (or key and bucket) has: one aggregate,
    one number to the driver."""
    row = df.groupBy(*keys).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def resolve_bucket(df: DataFrame, keys, bucket: str | None, time_col: str,
                   hot_rows: int = HOT_KEY_ROWS) -> str | None:
    """``"auto"``: no buckets unless some key has more than ``hot_rows`` rows;
    then the coarsest unit of ``BUCKET_UNITS`` under which no (key, bucket)
    holds more than ``hot_rows`` (on a stream, where nothing is known up
    front, "day")."""
    if bucket != "auto":
        return bucket
    if df.isStreaming:
        return BUCKET_UNITS[0]
    if max_rows_per_key(df, keys) <= hot_rows:
        return None
    for unit in BUCKET_UNITS:
        b = F.date_trunc(unit, F.col(time_col)).alias("_unit")
        if max_rows_per_key(df.select(*keys, b), [*keys, "_unit"]) <= hot_rows:
            return unit
    return BUCKET_UNITS[-1]


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on ``keys`` with NULL matching NULL; the left side's keys stay."""
    r = right.select(*[F.col(c).alias(f"_on_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_on_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_on_{k}" for k in keys])


def _orderable(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if not isinstance(df.schema[c].dataType, MapType)]


def scd1(df: DataFrame, keys, sequence, tiebreak=None) -> DataFrame:
    """Latest row per key by ``sequence`` (then ``tiebreak``, then every other
    orderable column, so the survivor never depends on input order)."""
    keys = list(keys)
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)
    tiebreak = list(tiebreak or [])
    payload = [c for c in df.columns if c not in keys]
    rest = [c for c in _orderable(df, payload) if c not in sequence and c not in tiebreak]
    ordered = [*sequence, *tiebreak, *rest]
    if len(ordered) == len(payload):
        # Every payload column is orderable: the max of one struct holding the
        # ordering first carries the whole row (one buffer instead of two).
        picked = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_row"))
    else:
        picked = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(*ordered)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                           for c in df.columns])


OPEN_START = "1900-01-01 00:00:00"


def scd2(df: DataFrame, keys, sequence: str, track, tiebreak=None, bucket: str | None = "auto",
         start_col: str = START_COL, end_col: str = END_COL,
         open_first_version: bool = False) -> DataFrame:
    """Versions ``[start, end)`` per key; a row opens a version when its tracked
    columns differ from the previous row of the key (so a return to an earlier
    value opens a new version, an unchanged re-delivery does not). The last
    version of a key has ``end`` NULL. Input order does not matter.

    ``bucket``: None (one ordered partition per key), a ``date_trunc`` unit
    such as "day" (a key's rows are split over its time buckets), or "auto"
    (buckets only when a key is hot, as fine as needed, see ``resolve_bucket``).
    ``open_first_version`` back-dates each key's first version to
    ``OPEN_START`` (never later than it began), so facts dated before the key's
    first load still match it. A NULL key is a key of its own.
    """
    keys = list(keys)
    bucket = resolve_bucket(df, keys, bucket, sequence)
    floor = F.least(F.lit(OPEN_START).cast(df.schema[sequence].dataType), F.col(sequence))
    order = [F.col(sequence)] + [F.col(c) for c in (tiebreak or [])]
    t = F.struct(*[F.col(c) for c in track])
    x = df.withColumn("_t", t)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        x = x.withColumn("_prev", F.lag("_t").over(w))
        v = x.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.col("_t")))
        v = v.withColumn(end_col, F.lead(sequence).over(w))
        start = F.col(sequence)
        if open_first_version:
            start = F.when(F.col("_prev").isNull(), floor).otherwise(start)
        return v.withColumn(start_col, start).select(*df.columns, start_col, end_col)

    x = x.withColumn("_b", F.date_trunc(bucket, F.col(sequence)))
    wkb = Window.partitionBy(*keys, "_b").orderBy(*order)
    x = x.withColumn("_prev", F.lag("_t").over(wkb))
    inner_change = F.col("_prev").isNotNull() & ~F.col("_prev").eqNullSafe(F.col("_t"))
    # One small summary per (key, bucket) carries the cross-bucket facts: the
    # last tracked value before the bucket, and where the next version starts
    # after it (the first change point of any later bucket).
    ordering = F.struct(*order)
    wk = Window.partitionBy(*keys).orderBy("_b")
    later = wk.rowsBetween(1, Window.unboundedFollowing)
    summary = (x.groupBy(*keys, "_b")
                .agg(F.min_by("_t", ordering).alias("_first_t"),
                     F.max_by("_t", ordering).alias("_last_t"),
                     F.min(sequence).alias("_first_seq"),
                     F.min(F.when(inner_change, F.col(sequence))).alias("_first_inner"))
                .withColumn("_carry", F.lag("_last_t").over(wk)))
    opens = F.col("_carry").isNull() | ~F.col("_carry").eqNullSafe(F.col("_first_t"))
    summary = (summary.withColumn("_change", F.when(opens, F.col("_first_seq")).otherwise(F.col("_first_inner")))
                      .withColumn("_next_bucket", F.first("_change", ignorenulls=True).over(later))
                      .select(*keys, "_b", "_carry", "_next_bucket"))
    x = join_on(x, summary, [*keys, "_b"])
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    v = x.filter(prev.isNull() | ~prev.eqNullSafe(F.col("_t")))
    v = v.withColumn("_next", F.lead(sequence).over(wkb))
    start = F.col(sequence)
    if open_first_version:
        start = F.when(F.col("_prev").isNull() & F.col("_carry").isNull(), floor).otherwise(start)
    return v.select(*df.columns, start.alias(start_col),
                    F.coalesce(F.col("_next"), F.col("_next_bucket")).alias(end_col))


KNOWN_COL = "_known_from"


def scd2_effective(df: DataFrame, keys, effective: str, known: str, track, tiebreak=None, known_at=None,
                   bucket: str | None = "auto", start_col: str = START_COL, end_col: str = END_COL) -> DataFrame:
    """Versions by effective date, as known at a time (``known_at``; None: now).

    Two time axes: ``effective`` says from when a row holds, ``known`` when it
    came in. Of the rows that hold from the same date the one known last counts
    (then ``tiebreak``). So a row that comes in late but holds from within a
    closed version splits it, and one with the date of an older row corrects
    that row; ``known_at`` gives back what was known before. ``KNOWN_COL``
    tells since when a version's opening row has been known.

    Rows without an effective date hold from no time and open no version."""
    keys = list(keys)
    rows = df.filter(F.col(effective).isNotNull())
    if known_at is not None:
        rows = rows.filter(F.col(known) <= F.lit(known_at).cast(df.schema[known].dataType))
    last = scd1(rows, [*keys, effective], known, tiebreak=tiebreak)
    versions = scd2(last, keys, effective, track, bucket=bucket, start_col=start_col, end_col=end_col)
    return versions.withColumn(KNOWN_COL, F.col(known))


def current_rows(history: DataFrame, end_col: str = END_COL) -> DataFrame:
    """The open version of every key."""
    return history.filter(F.col(end_col).isNull())
