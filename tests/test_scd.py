"""Type 1 / type 2 change application and the as-of joins.

Property tests: type-2 versions of a key neither overlap nor leave a gap,
results do not depend on input order or on the hot-key bucketing, and an
as-of probe matches at most one version.
"""

import datetime as dt
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import joins, scd

CITY_ROWS = [  # FIXTURES 4.2
    ("C1", "Delhi", dt.datetime(2024, 1, 1)),
    ("C1", "New Delhi", dt.datetime(2024, 1, 10)),
    ("C1", "Delhi", dt.datetime(2024, 1, 12)),
    ("C2", "Jaipur", dt.datetime(2024, 1, 5)),
]
SCHEMA = "city_id string, city_name string, seq timestamp_ntz"


def _history(spark, rows, bucket):
    df = spark.createDataFrame(rows, SCHEMA)
    return scd.scd2(df, ["city_id"], "seq", ["city_name"], bucket=bucket)


def _as_tuples(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_type2_history_from_fixture(spark):
    for bucket in (None, "day", "hour"):
        for rows in (CITY_ROWS, list(reversed(CITY_ROWS))):
            h = _as_tuples(_history(spark, rows, bucket), ["city_id", "city_name", "__START_AT", "__END_AT"])
            assert h == [
                ("C1", "Delhi", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10)),
                ("C1", "Delhi", dt.datetime(2024, 1, 12), None),
                ("C1", "New Delhi", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)),
                ("C2", "Jaipur", dt.datetime(2024, 1, 5), None),
            ], (bucket, rows)


def test_unchanged_redelivery_opens_no_version(spark):
    rows = CITY_ROWS + [("C2", "Jaipur", dt.datetime(2024, 1, 20))]
    assert _history(spark, rows, "day").filter(F.col("city_id") == "C2").count() == 1


def test_current_rows(spark):
    cur = scd.current_rows(_history(spark, CITY_ROWS, "day"))
    assert _as_tuples(cur, ["city_id", "city_name"]) == [("C1", "Delhi"), ("C2", "Jaipur")]


def test_asof_fixture_all_strategies(spark):
    versions = _history(spark, CITY_ROWS, "day").select(
        "city_id", F.col("city_name").alias("name_asof"), "__START_AT", "__END_AT")
    probes = spark.createDataFrame(
        [(i, "C1", dt.datetime(2023, 12, 31) + dt.timedelta(days=d)) for i, d in
         enumerate([0, 1, 9, 10, 12])], "pid int, city_id string, t timestamp_ntz")
    expect = [(1, "Delhi"), (2, "Delhi"), (3, "New Delhi"), (4, "Delhi")]
    for fn in (joins.asof_interval_join, joins.asof_bucketed_join, joins.asof_sweep_join):
        got = _as_tuples(fn(probes, versions, ["city_id"], "t", ["name_asof"]), ["pid", "name_asof"])
        assert got == expect, fn.__name__


def test_open_first_version(spark):
    df = spark.createDataFrame(CITY_ROWS, SCHEMA)
    for bucket in (None, "day"):
        h = scd.scd2(df, ["city_id"], "seq", ["city_name"], bucket=bucket, open_first_version=True)
        starts = {(r["city_id"], r["__START_AT"]) for r in h.collect()}
        assert ("C1", dt.datetime(1900, 1, 1)) in starts and ("C2", dt.datetime(1900, 1, 1)) in starts
        assert ("C1", dt.datetime(2024, 1, 10)) in starts


def test_type1_latest_and_order_free(spark):
    rows = [("k1", 1, "a"), ("k1", 3, "c"), ("k1", 2, "b"), ("k2", 5, "x"), ("k2", 5, "y")]
    for r in (rows, list(reversed(rows))):
        df = spark.createDataFrame(r, "k string, seq int, v string")
        got = _as_tuples(scd.scd1(df, ["k"], "seq"), ["k", "seq", "v"])
        assert got == [("k1", 3, "c"), ("k2", 5, "y")]   # tie on seq broken by the other columns


events = st.lists(
    st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 24 * 6), st.sampled_from(["a", "b"])),
    min_size=1, max_size=40, unique_by=lambda e: (e[0], e[1]))


@settings(max_examples=8, deadline=None)
@given(events, st.randoms(use_true_random=False))
def test_type2_properties(spark, rows, rnd):
    base = dt.datetime(2024, 1, 1)
    data = [(u, v, base + dt.timedelta(hours=h)) for u, h, v in rows]
    shuffled = data[:]
    rnd.shuffle(shuffled)
    cols = ["city_id", "city_name", "__START_AT", "__END_AT"]
    plain = _as_tuples(_history(spark, data, None), cols)
    assert _as_tuples(_history(spark, shuffled, "day"), cols) == plain
    by_key = {}
    for k, name, s, e in plain:
        by_key.setdefault(k, []).append((s, e, name))
    for k, vs in by_key.items():
        vs.sort(key=lambda x: x[0])
        for (s1, e1, n1), (s2, _e2, n2) in zip(vs, vs[1:]):
            assert e1 == s2 and n1 != n2      # contiguous, no overlap, real change
        assert vs[-1][1] is None
    # as-of: every probe matches at most one version, all strategies agree
    versions = _history(spark, data, "day").select(
        "city_id", F.col("city_name").alias("n"), "__START_AT", "__END_AT")
    probes = spark.createDataFrame(
        [(i, rnd.choice(["u1", "u2", "u3", "u4"]), base + dt.timedelta(minutes=rnd.randint(-600, 9000)))
         for i in range(30)], "pid int, city_id string, t timestamp_ntz")
    ref = _as_tuples(joins.asof_interval_join(probes, versions, ["city_id"], "t", ["n"]), ["pid", "n"])
    assert len({p for p, _ in ref}) == len(ref)
    for fn in (joins.asof_bucketed_join, joins.asof_sweep_join):
        assert _as_tuples(fn(probes, versions, ["city_id"], "t", ["n"]), ["pid", "n"]) == ref


def test_hot_key_is_split_over_buckets(spark):
    """One key with most of the rows: the bucketed type 2 equals the plain one."""
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", rnd.choice("abc"), base + dt.timedelta(minutes=7 * i)) for i in range(3000)]
    rows += [(f"k{i}", "a", base) for i in range(50)]
    cols = ["city_id", "city_name", "__START_AT", "__END_AT"]
    assert _as_tuples(_history(spark, rows, "day"), cols) == _as_tuples(_history(spark, rows, None), cols)


def test_unmatched_counts_null_keys(spark):
    facts = spark.createDataFrame([("t1", "C1"), ("t2", None), ("t3", "C9")], "trip_id string, city_id string")
    dim = spark.createDataFrame([("C1",)], "city_id string")
    assert sorted(r["trip_id"] for r in joins.unmatched(facts, dim, ["city_id"]).collect()) == ["t2", "t3"]


def test_hot_keys_routed_to_sweep(spark):
    """With a tiny version limit every key is 'hot': results stay identical."""
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["a", "b", "c"]), rnd.choice("xyz"), base + dt.timedelta(minutes=13 * i))
            for i in range(400)]
    versions = _history(spark, rows, "day").select("city_id", F.col("city_name").alias("n"),
                                                   "__START_AT", "__END_AT")
    probes = spark.createDataFrame(
        [(i, rnd.choice(["a", "b", "c", "d"]), base + dt.timedelta(minutes=rnd.randint(-100, 6000)))
         for i in range(200)], "pid int, city_id string, t timestamp_ntz")
    ref = _as_tuples(joins.asof_interval_join(probes, versions, ["city_id"], "t", ["n"],
                                              max_versions_per_key=None), ["pid", "n"])
    for fn in (joins.asof_interval_join, joins.asof_bucketed_join):
        got = _as_tuples(fn(probes, versions, ["city_id"], "t", ["n"], max_versions_per_key=5), ["pid", "n"])
        assert got == ref, fn.__name__


def test_auto_bucket_refines_until_no_bucket_is_hot(spark):
    from strata.operators.scd import resolve_bucket
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", "a", base + dt.timedelta(seconds=30 * i)) for i in range(400)]   # all in ~3 hours
    df = spark.createDataFrame(rows, SCHEMA)
    assert resolve_bucket(df, ["city_id"], "auto", "seq", hot_rows=1000) is None
    assert resolve_bucket(df, ["city_id"], "auto", "seq", hot_rows=300) == "hour"
    assert resolve_bucket(df, ["city_id"], "auto", "seq", hot_rows=50) == "minute"
    assert resolve_bucket(df, ["city_id"], "day", "seq") == "day"


def test_left_sweep_keeps_every_probe(spark):
    versions = _history(spark, CITY_ROWS, "day").select(
        "city_id", F.col("city_name").alias("name_asof"), "__START_AT", "__END_AT")
    probes = spark.createDataFrame(
        [(0, "C1", dt.datetime(2023, 12, 31)), (1, "C1", dt.datetime(2024, 1, 10)),
         (2, None, dt.datetime(2024, 1, 10)), (3, "C9", dt.datetime(2024, 1, 10))],
        "pid int, city_id string, t timestamp_ntz")
    for bucket in (None, "day"):
        got = _as_tuples(joins.asof_sweep_join(probes, versions, ["city_id"], "t", ["name_asof"], bucket=bucket,
                                               how="left", matched_col="m"), ["pid", "name_asof", "m"])
        assert got == [(0, None, False), (1, "New Delhi", True), (2, None, False), (3, None, False)]


def test_asof_strategies_agree_on_ties_and_far_dates(spark):   # J3, X10, B14
    import datetime as dt

    from strata.operators import joins
    d = lambda y, m=1, x=1: dt.datetime(y, m, x)
    versions = spark.createDataFrame(
        [("a", d(2024), d(2024), "none"), ("a", d(2024), d(2025), "one"), ("a", d(2025), None, "two"),
         ("b", d(1890), None, "old"), (None, d(2024), None, "nobody"), ("c", d(2024), d(2024, 6), "gone")],
        "k string, __START_AT timestamp, __END_AT timestamp, v string")
    times = [d(1895), d(2023), d(2024), d(2024, 3), d(2025), d(3001)]
    probes = spark.createDataFrame([(k, t) for k in ("a", "b", "c", None) for t in times], "k string, t timestamp")
    want = sorted([("a", d(2024), "one"), ("a", d(2024, 3), "one"), ("a", d(2025), "two"), ("a", d(3001), "two"),
                   ("c", d(2024), "gone"), ("c", d(2024, 3), "gone")] + [("b", t, "old") for t in times])
    plans = [joins.asof_interval_join(probes, versions, ["k"], "t", ["v"]),
             joins.asof_interval_join(probes, versions, ["k"], "t", ["v"], max_versions_per_key=1),
             joins.asof_bucketed_join(probes, versions, ["k"], "t", ["v"], max_versions_per_key=None)]
    plans += [joins.asof_sweep_join(probes, versions, ["k"], "t", ["v"], bucket=b)
              for b in (None, "auto", "month", "day", "hour", "second")]
    for p in plans:
        assert sorted(tuple(r) for r in p.collect()) == want


def test_scd2_null_key_and_old_first_version_in_every_plan(spark):   # C2
    import datetime as dt

    from strata.operators.scd import scd2
    d = lambda y, x=1: dt.datetime(y, 1, x)
    df = spark.createDataFrame([(None, d(2024), "x"), (None, d(2024, 2), "x"), (None, d(2024, 3), "y"),
                                ("k", d(1850), "p"), ("k", d(2024), "q")], "k string, s timestamp, v string")
    want = None
    for bucket in (None, "auto", "day", "hour", "minute", "second"):
        got = sorted((tuple(r) for r in scd2(df, ["k"], "s", ["v"], bucket=bucket, open_first_version=True)
                      .select("k", "v", "__START_AT", "__END_AT").collect()), key=repr)
        want = want or got
        assert got == want and len(got) == 4
        assert ("k", "p", d(1850), d(2024)) in got and (None, "y", d(2024, 3), None) in got


def test_effective_dates_split_closed_versions(spark):   # C2, B13
    rows = spark.createDataFrame(
        [("a", "2024-01-01", 1, "Agra"), ("a", "2024-03-01", 2, "Goa"),
         ("a", "2024-02-01", 5, "Pune"),                                    # comes late, splits Agra's version
         ("a", "2024-03-01", 6, "Agra"),                                    # corrects Goa
         ("b", "2024-01-01", 1, "x"), ("b", "2024-02-01", 2, "x"), ("b", None, 9, "lost"), (None, "2024-01-01", 1, "n")],
        "k string, eff string, known int, v string").withColumn("eff", F.to_date("eff"))

    def history(known_at=None, bucket=None):
        h = scd.scd2_effective(rows, ["k"], "eff", "known", ["v"], known_at=known_at, bucket=bucket)
        return sorted(((r["k"] or "", str(r["__START_AT"]), str(r["__END_AT"]), r["v"], r["_known_from"]) for r in h.collect()))

    other = [("", "2024-01-01", "None", "n", 1)]
    b = [("b", "2024-01-01", "None", "x", 1)]
    assert history(2) == other + [("a", "2024-01-01", "2024-03-01", "Agra", 1), ("a", "2024-03-01", "None", "Goa", 2)] + b
    assert history(5) == other + [("a", "2024-01-01", "2024-02-01", "Agra", 1), ("a", "2024-02-01", "2024-03-01", "Pune", 5),
                                  ("a", "2024-03-01", "None", "Goa", 2)] + b
    now = other + [("a", "2024-01-01", "2024-02-01", "Agra", 1), ("a", "2024-02-01", "2024-03-01", "Pune", 5),
                   ("a", "2024-03-01", "None", "Agra", 6)] + b
    assert history() == now and history(bucket="day") == now
    assert history(0) == []
