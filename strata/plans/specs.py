"""Dataset specs for the benchmark tables.

Role mapping: ``orders`` is the fact (order = trip, customer = city, order
date = business date), ``customer`` the type-1 dimension, ``lineitem`` joined
to ``orders`` the late-arrival feed (ship date plays the ingest date), and
``events`` the versioned dimension (event type per user, valid from its
timestamp) plus the rescued JSON (``props``).
"""

from __future__ import annotations

from strata.spec import DatasetSpec, FieldMap, HashPart, Rule, Settings

ORDERS = DatasetSpec(
    name="orders",
    fields=(
        FieldMap("order_id", "string", src="o_orderkey", nullable=False),
        FieldMap("customer_id", "string", src="o_custkey", transforms=("upper",), nullable=False),
        FieldMap("business_date", "date", src="o_orderdate", nullable=False),
        FieldMap("total_price", "double", src="o_totalprice", nullable=False),
        FieldMap("order_priority", "string", src="o_orderpriority", transforms=("lower",)),
        FieldMap("order_status", "string", src="o_orderstatus"),
        FieldMap("ship_priority", "int", src="o_shippriority"),
    ),
    rules=(
        Rule.required("order_id"),
        Rule.required("customer_id"),
        Rule.required("business_date"),
        Rule("total_price_ok", "total_price >= 0", "negative_total_price", ("total_price",)),
    ),
    keys=("order_id",),
    hash_parts=(HashPart("o_orderkey"), HashPart("o_custkey", "key"), HashPart("o_orderdate", "date"),
                HashPart("o_totalprice", "number"), HashPart("o_orderpriority"), HashPart("o_orderstatus")),
    required_columns=("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_shippriority"),
    known_columns=("o_orderstatus",),
    drift_fields=(("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderdate", "date"),
                  ("o_totalprice", "double"), ("o_orderpriority", "int"), ("o_orderstatus", "int")),
    business_date="business_date",
)

CUSTOMER = DatasetSpec(
    name="customer",
    fields=(
        FieldMap("customer_id", "string", src="c_custkey", transforms=("upper",), nullable=False),
        FieldMap("customer_name", "string", src="c_name", transforms=("initcap",), nullable=False),
        FieldMap("nation_key", "int", src="c_nationkey"),
        FieldMap("account_balance", "double", src="c_acctbal"),
        FieldMap("market_segment", "string", src="c_mktsegment", transforms=("lower",)),
    ),
    rules=(
        Rule.required("customer_id"),
        Rule.required("customer_name"),
        Rule("nation_ok", "nation_key BETWEEN 0 AND 24", "nation_out_of_range", ("nation_key",)),
        Rule("balance_ok", "account_balance >= 0", "negative_account_balance", ("account_balance",)),
    ),
    keys=("customer_id",),
    hash_parts=(HashPart("c_custkey", "key"), HashPart("c_name"), HashPart("c_acctbal", "number"),
                HashPart("c_mktsegment")),
    required_columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_phone"),
    known_columns=(),
)

LINES = DatasetSpec(
    name="lines",
    fields=(
        FieldMap("order_id", "string", src="l_orderkey", nullable=False),
        FieldMap("line_number", "int", src="l_linenumber", nullable=False),
        FieldMap("part_id", "string", src="l_partkey"),
        FieldMap("supplier_id", "string", src="l_suppkey"),
        FieldMap("quantity", "double", src="l_quantity"),
        FieldMap("discount", "double", src="l_discount"),
        FieldMap("extended_price", "double", src="l_extendedprice"),
        FieldMap("business_date", "date", src="o_orderdate", nullable=False),
        FieldMap("_ingest_date", "date", src="l_shipdate"),
    ),
    rules=(
        Rule.required("order_id"),
        Rule.required("line_number"),
        Rule.required("business_date"),
        Rule("quantity_ok", "quantity BETWEEN 1 AND 50", "quantity_out_of_range", ("quantity",)),
        Rule("discount_ok", "discount BETWEEN 0 AND 0.1", "discount_out_of_range", ("discount",)),
        Rule("price_ok", "extended_price >= 0", "negative_extended_price", ("extended_price",)),
    ),
    keys=("order_id", "line_number"),
    business_date="business_date",
)

DOCS = DatasetSpec(
    name="documents",
    fields=(
        FieldMap("doc_id", "string", nullable=False),
        FieldMap("lang", "string", transforms=("lower",)),
        FieldMap("source", "string"),
        FieldMap("n_chars", "bigint"),
        FieldMap("quality", "int"),
        FieldMap("toxic", "int"),
    ),
    rules=(
        Rule.required("doc_id"),
        Rule("quality_ok", "quality = 1", "low_quality", ("quality",)),
        Rule("not_toxic", "toxic = 0", "toxic", ("toxic",)),
    ),
    keys=("doc_id",),
)

EVENTS = DatasetSpec(
    name="events",
    fields=(
        FieldMap("event_id", "string", nullable=False),
        FieldMap("user_id", "string", nullable=False),
        FieldMap("event_ts", "timestamp_ntz", src="ts"),
        FieldMap("event_type", "string", transforms=("lower",)),
        FieldMap("amount", "double", src="value"),
    ),
    rules=(Rule.required("event_id"), Rule.required("user_id")),
    keys=("user_id",),
    hash_parts=(HashPart("event_id"), HashPart("user_id", "key"), HashPart("ts"), HashPart("event_type"),
                HashPart("value", "number")),
    drift_fields=(("event_id", "bigint"), ("user_id", "bigint"), ("ts", "timestamp"), ("value", "double")),
    promote=(("k", "int"),),
)

# Every column of a line item, for its content hash.
LINE_CONTENT = (
    HashPart("l_orderkey"), HashPart("l_partkey"), HashPart("l_suppkey"), HashPart("l_linenumber"),
    HashPart("l_quantity", "number"), HashPart("l_extendedprice", "number"), HashPart("l_discount", "number"),
    HashPart("l_tax", "number"), HashPart("l_returnflag"), HashPart("l_linestatus"), HashPart("l_shipdate", "date"),
)

# Fixed run parameters of the benchmark queries.
CALENDAR_START = "1995-01-01"      # of a table without any date
REPLAY = Settings(replay_enabled=True, replay_id="replay-r1")
LATER_REPLAY = Settings(replay_enabled=True, replay_id="replay-r2")
BACKFILL = Settings(backfill_enabled=True, backfill_start="1996-01-01", backfill_end="1996-12-31",
                    backfill_id="bf-1996", backfill_reason="restatement")
LATER_BACKFILL = Settings(backfill_enabled=True, backfill_start="1996-07-01", backfill_end="1998-06-30",
                          backfill_id="bf-1997", backfill_reason="second restatement")
EVENTS_NOW = Settings(now="2024-02-01 00:00:00")
LINES_NOW = Settings(now="2001-06-01 00:00:00")
