"""Column-level helpers: casts, text transforms, hash normalisers, names."""

from strata.functions.casts import safe_cast
from strata.functions.names import sanitize_name, sanitize_columns
from strata.functions.normalize import record_hash
from strata.functions.transforms import apply_transforms

__all__ = [
    "safe_cast", "sanitize_name", "sanitize_columns", "record_hash", "apply_transforms",
]
