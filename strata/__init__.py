"""strata: layered (bronze / silver / gold) data pipelines on Spark.

Everything is expressed with the public DataFrame, SQL and Structured
Streaming APIs. Functions take and return lazy DataFrames, so the same code
runs on batch and streaming inputs and Catalyst plans it as one query.
"""

from strata.spec import DatasetSpec, FieldMap, Rule, Settings

__all__ = ["DatasetSpec", "FieldMap", "Rule", "Settings"]
