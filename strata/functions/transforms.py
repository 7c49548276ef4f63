"""Named text transforms a mapping may apply after the cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRANSFORMS = {
    "upper": F.upper,
    "lower": F.lower,
    "initcap": F.initcap,   # splits on blanks only: "york-city" -> "York-city"
    "trim": F.trim,
}


def apply_transforms(c: Column, transforms) -> Column:
    for t in transforms:
        try:
            c = _TRANSFORMS[t](c)
        except KeyError:
            raise ValueError(f"unknown transform {t!r}") from None
    return c
