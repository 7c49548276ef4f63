"""Column-name sanitiser for raw file headers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Fixed values of the header sanitiser: runs of non-word characters become
# "_", runs of "_" collapse to one, edge "_" are stripped, names lower-cased.
_NON_WORD = re.compile(r"[^\w]+")
_UNDERSCORES = re.compile(r"_+")


def sanitize_name(name: str) -> str:
    """Strip, lower-case, turn non-word runs into ``_``, collapse and trim ``_``.

    System columns (leading underscore, e.g. ``_rescued_data``) are kept as they
    are, so the reader's own columns keep their names.
    """
    if name.startswith("_"):
        return name
    out = _NON_WORD.sub("_", name.strip().lower())
    return _UNDERSCORES.sub("_", out).strip("_")


def sanitize_names(names: list[str]) -> list[str]:
    """Sanitise a header; a collision or an empty result raises with the originals."""
    seen: dict[str, str] = {}
    out = []
    for n in names:
        s = sanitize_name(n)
        if not s:
            raise ValueError(f"column {n!r} sanitises to an empty name")
        if s in seen:
            raise ValueError(f"columns {seen[s]!r} and {n!r} both sanitise to {s!r}")
        seen[s] = n
        out.append(s)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column in one projection (no chain of renames)."""
    return df.toDF(*sanitize_names(df.columns))
