"""Row rules: one reject reason per row, valid/quarantine split, replay, backfill.

The reason is computed once as a column (NULL = valid), so the valid rows and
the quarantine are exact complements and one scan feeds both outputs.
Reason order, first match wins: corrupt record, ``missing_*`` (required
fields), ``null_*`` and ``not_finite_*`` (fields a value rule reads), the value
rules in declared order, then the late-arrival policy.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.spec import DatasetSpec, Settings

# Column names and the reasons "corrupt_record", "late_arrival",
# "missing_<field>" for required fields; the rest are declared by each Rule.
REASON_COL = "_reject_reason"
LATE_COL = "_is_late_arrival"
CORRUPT_COL = "_corrupt_record"
LATE_REASON = "late_arrival"
OUTSIDE_WINDOW = "outside_backfill_window"
TAG_COLUMNS = ("_replay_id", "_backfill_id", "_backfill_reason")


def reason_checks(spec: DatasetSpec, columns: list[str], waive_late: bool = False) -> list[tuple[Column, str]]:
    """Ordered (violation condition, reason) pairs for ``spec`` over ``columns``."""
    checks: list[tuple[Column, str]] = []
    if CORRUPT_COL in columns:
        checks.append((F.col(CORRUPT_COL).isNotNull(), "corrupt_record"))
    covered = set()
    for r in spec.rules:
        if r.not_null:
            for f in r.fields:
                checks.append((F.col(f).isNull(), r.reason))
                covered.add(f)
    value_rules = [r for r in spec.rules if not r.not_null]
    seen = []
    for r in value_rules:
        for f in r.fields:
            if f not in covered and f not in seen:
                seen.append(f)
    for f in seen:
        checks.append((F.col(f).isNull(), f"null_{f}"))
    for f in seen:
        if spec.field(f).dtype == "double":
            c = F.col(f)
            checks.append((F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), f"not_finite_{f}"))
    for r in value_rules:
        checks.append((~F.coalesce(F.expr(r.predicate), F.lit(False)), r.reason))
    if not waive_late and LATE_COL in columns:
        checks.append((F.col(LATE_COL).isNull(), "late_arrival_unknown"))
        checks.append((F.col(LATE_COL), LATE_REASON))
    return checks


def reject_reason(checks: list[tuple[Column, str]]) -> Column:
    if not checks:
        return F.lit(None).cast("string")
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def classify(df: DataFrame, spec: DatasetSpec, waive_late: bool = False) -> DataFrame:
    """Add ``_reject_reason`` (NULL for a valid row)."""
    return df.withColumn(REASON_COL, reject_reason(reason_checks(spec, df.columns, waive_late)))


def valid_rows(classified: DataFrame, columns: list[str] | None = None) -> DataFrame:
    out = classified.filter(F.col(REASON_COL).isNull())
    drop = [c for c in (REASON_COL, LATE_COL, CORRUPT_COL) if c in out.columns]
    out = out.drop(*drop)
    return out.select(*columns) if columns else out


def quarantined_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON_COL).isNotNull())


def split(df: DataFrame, spec: DatasetSpec, waive_late: bool = False):
    """(valid, quarantine) from one classification of ``df``."""
    c = classify(df, spec, waive_late)
    return valid_rows(c), quarantined_rows(c)


def with_tags(df: DataFrame, **tags) -> DataFrame:
    """Constant string tags in one projection; missing tag columns become NULL."""
    cols = {t: F.lit(None).cast("string") for t in TAG_COLUMNS if t not in df.columns}
    cols.update({k: F.lit(v).cast("string") for k, v in tags.items()})
    return df.withColumns(cols)


def replay_late(quarantine: DataFrame, settings: Settings,
                replay_log: DataFrame | None = None) -> DataFrame | None:
    """Quarantined late rows, tagged with the replay id; None when replay is off.

    ``replay_log`` (columns ``_record_hash``) lists records replayed before;
    they are anti-joined out so a rebuilt run does not replay them twice.
    """
    if not settings.replay_enabled:
        return None
    if settings.replay_id is None:
        raise ValueError("replay_enabled requires replay_id")
    rows = quarantine.filter(F.col(REASON_COL) == F.lit(LATE_REASON))
    if replay_log is not None:
        rows = rows.join(replay_log.select("_record_hash").distinct(), "_record_hash", "left_anti")
    rows = rows.drop(*[c for c in (REASON_COL, LATE_COL, CORRUPT_COL) if c in rows.columns])
    return with_tags(rows, _replay_id=settings.replay_id)


def backfill_window(staged: DataFrame, settings: Settings,
                    business_date: str = "business_date") -> DataFrame | None:
    """Backfill rows with business date in ``[start, end]`` (both inclusive), tagged."""
    if not settings.backfill_enabled:
        return None
    if settings.backfill_id is None or settings.backfill_reason is None:
        raise ValueError("backfill_enabled requires backfill_id and backfill_reason")
    rows = staged.filter(F.col(business_date).between(
        F.lit(settings.backfill_start).cast("date"), F.lit(settings.backfill_end).cast("date")))
    return with_tags(rows, _backfill_id=settings.backfill_id,
                     _backfill_reason=settings.backfill_reason)


def change_feed(valid: DataFrame, *others: DataFrame | None) -> DataFrame:
    """Union by name of the valid rows and the switched-on extra feeds.

    A switched-off feed (None) is left out of the plan altogether: an empty
    streaming branch would still be polled and checkpointed.
    """
    base = with_tags(valid)
    cols = base.columns
    feeds = [base] + [with_tags(o).select(*cols) for o in others if o is not None]
    return reduce(lambda a, b: a.unionByName(b), feeds)


def feed_from_classified(classified: DataFrame, settings: Settings) -> DataFrame:
    """Valid rows plus (when replay is on) the late rows, tagged, in one pass.

    The same rows as ``change_feed(valid_rows(c), replay_late(quarantined_rows(c)))``
    without a replay log: the two sets are disjoint filters of one
    classification, so one filter and a conditional tag replace a union that
    would compute the classification twice.
    """
    reason = F.col(REASON_COL)
    keep = reason.isNull()
    replay_tag = F.lit(None).cast("string")
    if settings.replay_enabled:
        if settings.replay_id is None:
            raise ValueError("replay_enabled requires replay_id")
        late = reason == F.lit(LATE_REASON)
        keep = keep | late
        replay_tag = F.when(late, F.lit(settings.replay_id))
    rows = classified.filter(keep).withColumn("_replay_id", replay_tag)
    rows = rows.drop(*[c for c in (REASON_COL, LATE_COL, CORRUPT_COL) if c in rows.columns])
    return with_tags(rows)


def carry_replayed(quarantine: DataFrame, replay_log: DataFrame) -> DataFrame:
    """Late rows that an earlier replay let in, tagged with its id again.

    A rebuild of the merged table reads them from here, so a record replayed
    once stays in whatever run comes after it."""
    earlier = replay_log.groupBy("_record_hash").agg(F.min("_replay_id").alias("_earlier"))
    rows = quarantine.filter(F.col(REASON_COL) == F.lit(LATE_REASON)).join(earlier, "_record_hash")
    rows = rows.drop(*[c for c in (REASON_COL, LATE_COL, CORRUPT_COL) if c in rows.columns])
    return with_tags(rows).withColumn("_replay_id", F.col("_earlier")).drop("_earlier")


def replay_again(quarantine: DataFrame, settings: Settings, replay_log: DataFrame) -> DataFrame:
    """Late rows of a later run, carried or replayed now, in one pass.

    The same rows as ``carry_replayed`` and ``replay_late`` with the log: of a late row
    one of them gives it, so one join and a conditional tag replace two joins
    that would move the quarantine and the log twice."""
    if not settings.replay_enabled:
        return carry_replayed(quarantine, replay_log)
    if settings.replay_id is None:
        raise ValueError("replay_enabled requires replay_id")
    earlier = replay_log.groupBy("_record_hash").agg(F.min("_replay_id").alias("_earlier"), F.count(F.lit(1)).alias("_logged"))
    rows = quarantine.filter(F.col(REASON_COL) == F.lit(LATE_REASON)).join(earlier, "_record_hash", "left")
    rows = rows.drop(*[c for c in (REASON_COL, LATE_COL, CORRUPT_COL) if c in rows.columns])
    tag = F.when(F.col("_logged").isNotNull(), F.col("_earlier")).otherwise(F.lit(settings.replay_id))
    return with_tags(rows).withColumn("_replay_id", tag).drop("_earlier", "_logged")


def split_backfill(classified: DataFrame, settings: Settings,
                   business_date: str = "business_date") -> tuple[DataFrame, DataFrame]:
    """(kept, quarantine) of classified backfill rows; both carry the backfill tags.

    A row that passes the rules but whose business date lies outside the window
    is quarantined as ``outside_backfill_window``, so every row ends up in one
    of the two."""
    if settings.backfill_id is None or settings.backfill_reason is None:
        raise ValueError("backfill_enabled requires backfill_id and backfill_reason")
    inside = F.col(business_date).between(F.lit(settings.backfill_start).cast("date"),
                                          F.lit(settings.backfill_end).cast("date"))
    reason = F.when(F.col(REASON_COL).isNotNull(), F.col(REASON_COL)).when(
        ~F.coalesce(inside, F.lit(False)), F.lit(OUTSIDE_WINDOW))
    rows = with_tags(classified.withColumn(REASON_COL, reason), _backfill_id=settings.backfill_id,
                     _backfill_reason=settings.backfill_reason)
    return valid_rows(rows), quarantined_rows(rows)


def backfill_registry(classified: DataFrame, settings: Settings, backfill_log: DataFrame | None = None,
                      business_date: str = "business_date") -> DataFrame:
    """What this run's backfill lets in: one row per valid record inside the window and not in the log yet.

    Columns: _record_hash, _backfill_id, _backfill_reason, _window_start, _window_end, rows."""
    if settings.backfill_id is None or settings.backfill_reason is None:
        raise ValueError("backfill_enabled requires backfill_id and backfill_reason")
    start, end = (F.lit(d).cast("date") for d in (settings.backfill_start, settings.backfill_end))
    fresh = valid_rows(classified).filter(F.col(business_date).between(start, end))
    fresh = fresh.groupBy("_record_hash").agg(F.count(F.lit(1)).alias("rows"))
    if backfill_log is not None:
        fresh = fresh.join(backfill_log.select("_record_hash"), "_record_hash", "left_anti")
    return fresh.select("_record_hash", F.lit(settings.backfill_id).alias("_backfill_id"),
                        F.lit(settings.backfill_reason).alias("_backfill_reason"),
                        start.alias("_window_start"), end.alias("_window_end"), "rows")


def logged_backfill(classified: DataFrame, backfill_log: DataFrame) -> DataFrame:
    """Valid backfill rows that the log lets in, in whatever run, tagged with the id and reason that did.

    The log holds a record once; should a table written by hand hold it again,
    the smallest id counts."""
    log = backfill_log.groupBy("_record_hash").agg(
        F.min(F.struct("_backfill_id", "_backfill_reason")).alias("_by"))
    rows = with_tags(valid_rows(classified)).join(log, "_record_hash")
    return rows.withColumns({c: F.col(f"_by.{c}") for c in ("_backfill_id", "_backfill_reason")}).drop("_by")


def refused_backfill(classified: DataFrame, backfill_log: DataFrame) -> DataFrame:
    """Backfill rows that no run has let in: those that break a rule, then those outside every window so far."""
    rows = classified.join(backfill_log.select("_record_hash").distinct().withColumn("_logged", F.lit(True)),
                           "_record_hash", "left")
    rows = rows.filter(F.col(REASON_COL).isNotNull() | F.col("_logged").isNull()).drop("_logged")
    return rows.withColumn(REASON_COL, F.coalesce(REASON_COL, F.lit(OUTSIDE_WINDOW)))


def replay_registry(replayed: DataFrame) -> DataFrame:
    """Rows to append to the replay log: one per (replay id, record) with its count.

    Pass the accumulated log as ``replay_log`` to ``replay_late`` so a record is
    replayed once, even when the quarantine is rebuilt.
    """
    return replayed.groupBy("_replay_id", "_record_hash").agg(F.count(F.lit(1)).alias("rows"))
