"""JSON message encoding and decoding.

Decoding uses ``from_json`` with an explicit schema.  Messages produced from
pandas rows can carry the bare token ``NaN`` (not valid JSON); Spark parses it
to the text ``"NaN"`` (with quotes) in a string field and to NaN in a double
field, so both are mapped to null here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode(df: DataFrame, columns: dict[str, str] | None = None, value_col: str = "value") -> DataFrame:
    """S3: add ``value_col`` = compact JSON of the row.

    ``columns`` maps our column names to wire keys (default: every column
    under its own name).  Null fields are omitted, which is how a missing
    value travels instead of ``NaN``.
    """
    cols = columns or {c: c for c in df.columns}
    return df.withColumn(value_col, F.to_json(F.struct(*[F.col(c).alias(k) for c, k in cols.items()])))


def unwrap_double_encoded(value: Column) -> Column:
    """A JSON string literal holding JSON -> the inner text; any other
    value is returned as is."""
    inner = F.get_json_object(F.concat(F.lit("["), value, F.lit("]")), "$[0]")
    return F.when(F.ltrim(value).startswith('"') & inner.isNotNull(), inner).otherwise(value)


def _clean(field: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.when(field == F.lit('"NaN"'), F.lit(None).cast(dtype)).otherwise(field)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(field), F.lit(None).cast(dtype)).otherwise(field)
    return field


def is_text(value: Column, key: str) -> Column:
    """Whether the JSON field is a string, rather than a number, object or
    boolean that a typed decode would turn into one.  True where the type can't
    be told (a message with the bare token ``NaN``): a typed decode handles it."""
    field = F.try_variant_get(F.try_parse_json(unwrap_double_encoded(value)), f"$['{key}']", "variant")
    return F.coalesce(F.schema_of_variant(field) == "STRING", F.lit(True))


def decode(df: DataFrame, schema: T.StructType, value_col: str = "value",
           tolerate_double: bool = True, keep_value: bool = True) -> DataFrame:
    """Parse ``value_col`` into top-level columns of ``schema``.

    Adds ``_json_ok`` (false for null, unparseable or non-object values).
    """
    raw = F.col(value_col)
    text = unwrap_double_encoded(raw) if tolerate_double else raw
    parsed = F.from_json(text, schema)
    probe = F.from_json(text, "map<string,string>")
    out = df.withColumn("_j", parsed).withColumn("_json_ok", probe.isNotNull())
    fields = [_clean(F.col("_j")[f.name], f.dataType).alias(f.name) for f in schema.fields]
    keep = [c for c in df.columns if keep_value or c != value_col]
    return out.select(*keep, *fields, "_json_ok")
