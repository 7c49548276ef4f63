"""Casts that turn bad input into NULL instead of failing the job.

Spark 4 runs with ANSI mode on, where ``CAST('abc' AS INT)`` raises. The
quarantine and the type-drift counter both rely on a bad value becoming NULL,
so every contract cast goes through ``try_cast`` (for dates this is the same
parser as ``try_to_date`` without a pattern).

``try_cast`` from text to a number or boolean is slow on *bad* input (about
10 microseconds a row, the error path), and drifting columns can be bad on
every row. For text sources the cast is therefore guarded by a full-match
pattern of the grammar Spark accepts (surrounding bytes up to 0x20 are trimmed
by Spark, so the patterns allow them); text outside the pattern is NULL
without calling the cast, text inside it still goes through ``try_cast`` (so
overflow stays NULL). Results are identical to a plain ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

_ALIASES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}

_PAD = r"[\x00-\x20]*"
INTEGRAL_TEXT = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
FRACTIONAL_TEXT = (
    rf"^{_PAD}[+-]?(?:(?i:nan|inf|infinity)"
    r"|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?"
    r"|0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[dDfF]?)"
    rf"{_PAD}$")
BOOLEAN_TEXT = rf"^{_PAD}(?i:t|true|y|yes|1|f|false|n|no|0){_PAD}$"

_GUARDS = {
    "int": INTEGRAL_TEXT, "bigint": INTEGRAL_TEXT, "smallint": INTEGRAL_TEXT, "tinyint": INTEGRAL_TEXT,
    "double": FRACTIONAL_TEXT, "float": FRACTIONAL_TEXT,
    "boolean": BOOLEAN_TEXT,
}


def safe_cast(c: Column, dtype: str, source: DataType | None = None) -> Column:
    """``try_cast`` to ``dtype``; pass the source type to enable the text guard."""
    dtype = _ALIASES.get(dtype, dtype)
    out = c.try_cast(dtype)
    guard = _GUARDS.get(dtype)
    if guard is not None and isinstance(source, StringType):
        out = F.when(c.rlike(guard), out)
    return out
