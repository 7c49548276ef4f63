"""Silver staging: rescued data, promotion, contract projection, late flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

from strata.functions.casts import safe_cast
from strata.functions.transforms import apply_transforms
from strata.spec import DatasetSpec, FieldMap, Settings

RESCUED_COL = "_rescued_data"


def rescued_values(schema: StructType) -> Column:
    """A row's rescued values as ``map<string,string>``, built from the schema alone.

    The rescued column may be JSON text or a map; NULL, unreadable text and a
    missing column read as no values. Nested values are JSON text."""
    texts = MapType(StringType(), StringType())
    found = {f.name: f.dataType for f in schema.fields}.get(RESCUED_COL)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    if found is None:
        return none
    read = F.col(RESCUED_COL).cast(texts) if isinstance(found, MapType) else F.from_json(RESCUED_COL, texts)
    return F.coalesce(read, none)


def promoted(schema: StructType, registry) -> dict[str, Column]:
    """Columns for registered rescued keys: the typed value and ``_<key>_from_rescued``.

    A value in a column of that name goes before the rescued one; the flag says
    that the rescued value casts to the registered type."""
    types = {f.name: f.dataType for f in schema.fields}
    values, out = rescued_values(schema), {}
    for key, dtype in dict(registry).items():
        rescued = safe_cast(F.try_element_at(values, F.lit(key)), dtype, StringType())
        own = [safe_cast(F.col(key), dtype, types[key])] if key in types else []
        out[key] = F.coalesce(*own, rescued).alias(key)
        out[f"_{key}_from_rescued"] = rescued.isNotNull().alias(f"_{key}_from_rescued")
    return out


def contract_fields(spec: DatasetSpec) -> list[FieldMap]:
    """Contract plus promoted fields and their flags (promotions reach silver)."""
    out = {f.name: f for f in spec.fields}
    for key, dtype in spec.promote:
        out.setdefault(key, FieldMap(key, dtype))
        out[f"_{key}_from_rescued"] = FieldMap(f"_{key}_from_rescued", "boolean")
    return list(out.values())


def apply_contract(df: DataFrame, spec: DatasetSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto the contract in one ``select``; extra ``keep`` columns follow.

    A field reads its mapped column, else a column of its own name, else it is
    NULL; promoted fields read the rescued values in the same projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    extra = promoted(df.schema, spec.promote)

    def column(f: FieldMap) -> Column:
        if f.name in extra:
            return extra[f.name]
        source = next((n for n in (f.source, f.name) if n in types), None)
        value = F.lit(None).cast(f.dtype) if source is None else safe_cast(F.col(source), f.dtype, types[source])
        return (apply_transforms(value, f.transforms) if source == f.source else value).alias(f.name)

    fields = contract_fields(spec)
    names = {f.name for f in fields}
    return df.select(*map(column, fields), *[F.col(k) for k in keep if k in types and k not in names])


def late_flag(business_date: str = "business_date", ingest_date: str = "_ingest_date",
              window_days: int = 7) -> Column:
    """Strictly older than the window: day ``window_days`` itself is on time."""
    return F.col(business_date) < F.date_sub(F.col(ingest_date), window_days)


def conform(df: DataFrame, spec: DatasetSpec, settings: Settings | None = None,
            keep: tuple[str, ...] = ("_corrupt_record",)) -> DataFrame:
    """Bronze rows -> silver staging: project to contract with promotions, flag late rows."""
    settings = settings or Settings()
    out = apply_contract(df, spec, keep=keep)
    if spec.business_date and "_ingest_date" in out.columns:
        out = out.withColumn("_is_late_arrival",
                             late_flag(spec.business_date, "_ingest_date", settings.late_window_days))
    return out
