"""Driver contract: every query has an oracle and names the SURVEY operators it covers."""

import re

import __spark_entry__ as entry

ID = re.compile(r"\b(?:S|P|F|J|A|D|C|O|U|G|M|W|X)\d+\b")


def test_queries_and_oracles_match():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE)
    assert set(entry.LLM_ORACLE) <= set(entry.LLM_QUERIES)
    assert all(isinstance(v, str) and v.strip() for v in entry.oracle_sql().values())


def test_every_builder_cites_operator_ids():
    missing = [k for k, fn in entry.queries().items()
               if k not in entry.LLM_QUERIES and not ID.search(fn.__doc__ or "")]
    assert not missing, missing
