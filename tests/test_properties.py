"""Hypothesis properties: valid ⊎ quarantine = staging with every
quarantined row failing its reason; type 1 independent of input order."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import quality, scd
from strata.spec import DatasetSpec, FieldMap, Rule

SPEC = DatasetSpec(
    name="p",
    fields=(FieldMap("id", "string", nullable=False), FieldMap("amount", "double"), FieldMap("rating", "int")),
    rules=(Rule.required("id"),
           Rule("amount_ok", "amount >= 0", "negative_amount", ("amount",)),
           Rule("rating_ok", "rating BETWEEN 1 AND 5", "rating_out_of_range", ("rating",))),
)

amounts = st.one_of(st.none(), st.sampled_from([float("nan"), float("inf"), -1.5, 0.0, 3.25]))
ratings = st.one_of(st.none(), st.integers(-1, 7))
rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), amounts, ratings),
                min_size=1, max_size=25)


def expected_reason(r):
    i, amount, rating = r
    if i is None:
        return "missing_id"
    if amount is None:
        return "null_amount"
    if rating is None:
        return "null_rating"
    if math.isnan(amount) or math.isinf(amount):
        return "not_finite_amount"
    if not amount >= 0:
        return "negative_amount"
    if not 1 <= rating <= 5:
        return "rating_out_of_range"
    return None


@settings(max_examples=10, deadline=None)
@given(rows)
def test_valid_and_quarantine_partition_the_rows(spark, data):
    df = spark.createDataFrame(data, "id string, amount double, rating int")
    c = quality.classify(df, SPEC)
    got = sorted(((r["id"] or "", repr(r["amount"]), r["rating"] if r["rating"] is not None else -99,
                   r["_reject_reason"] or "") for r in c.collect()))
    want = sorted(((i or "", repr(a), rt if rt is not None else -99, expected_reason((i, a, rt)) or "")
                   for i, a, rt in data))
    assert got == want
    valid, quarantine = quality.split(df, SPEC)
    assert valid.count() + quarantine.count() == len(data)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 5), st.sampled_from("xyz")),
                min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_type1_does_not_depend_on_input_order(spark, data, rnd):
    shuffled = data[:]
    rnd.shuffle(shuffled)
    out = []
    for d in (data, shuffled):
        df = spark.createDataFrame(d, "k string, seq int, v string").repartition(3)
        out.append(sorted(tuple(r) for r in scd.scd1(df, ["k"], "seq").collect()))
    assert out[0] == out[1]
    latest = {}
    for k, s, v in data:
        latest[k] = max(latest.get(k, (s, v)), (s, v))
    assert out[0] == sorted((k, s, v) for k, (s, v) in latest.items())


def test_one_pass_feed_equals_union(spark):
    from strata.spec import Settings
    late = SPEC.__class__(name="l", fields=SPEC.fields + (FieldMap("business_date", "date"),
                                                         FieldMap("_ingest_date", "date")),
                          rules=SPEC.rules, business_date="business_date")
    import datetime as dt
    rows = [("a", 1.0, 3, dt.date(2024, 1, 1), dt.date(2024, 1, 2)),    # valid
            ("b", 1.0, 3, dt.date(2024, 1, 1), dt.date(2024, 2, 1)),    # late
            ("c", -1.0, 3, dt.date(2024, 1, 1), dt.date(2024, 1, 2)),   # negative
            (None, 1.0, 3, dt.date(2024, 1, 1), dt.date(2024, 1, 2))]   # missing id
    df = spark.createDataFrame(rows, "id string, amount double, rating int, business_date date, "
                                     "_ingest_date date")
    from strata.operators.conform import late_flag
    c = quality.classify(df.withColumn("_is_late_arrival", late_flag()), late)
    for s in (Settings(), Settings(replay_enabled=True, replay_id="r")):
        union = quality.change_feed(quality.valid_rows(c), quality.replay_late(quality.quarantined_rows(c), s))
        one = quality.feed_from_classified(c, s)
        key = lambda r: (r["id"] or "", r["_replay_id"] or "")
        assert sorted(map(key, union.collect())) == sorted(map(key, one.select(*union.columns).collect()))
