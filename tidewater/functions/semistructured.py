"""JSON and XML columns.

Documents stay text columns; paths are evaluated by JVM expressions per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expressions import col


def json_path(doc: str | Column, path: str) -> Column:
    """value at a JSON path as unquoted text (null when absent)."""
    return F.get_json_object(col(doc), path)


def json_number(doc: str | Column, path: str) -> Column:
    """value at a JSON path as a double; text that is not a number gives null."""
    return json_path(doc, path).try_cast("double")


def json_set(doc: str | Column, schema: T.StructType, field: str, value: Column | object) -> Column:
    """``JSON_SET(COALESCE(doc, JSON_OBJECT()), '$.field', value)`` keeping value types.

    The document's top-level fields are read as variants, so every field keeps its value and type, declared
    or not, null or nested; ``schema`` gives the type of the new value.
    """
    if field not in schema.fieldNames():
        raise ValueError(f"declare {field} in the document schema")
    fields = F.from_json(col(doc), "map<string,variant>")
    v = value if isinstance(value, Column) else F.lit(value)
    new = F.parse_json(F.coalesce(F.get_json_object(F.to_json(F.struct(v.cast(schema[field].dataType).alias("v"))), "$.v"), F.lit("null"))) \
        if not isinstance(schema[field].dataType, T.StringType) else v.cast("string").cast("variant")
    others = F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,variant>")), lambda k, _: k != F.lit(field))
    return F.to_json(F.map_concat(others, F.create_map(F.lit(field), new)))


def xml_field(doc: str | Column, xpath: str) -> Column:
    """text of the first node matching ``xpath`` ('' when there is none)."""
    return F.xpath_string(col(doc), F.lit(xpath))


# The tags of a drug monograph.
MONOGRAPH_TAGS = ("indication", "contraindication", "warning", "risk_level")


def monograph_fields(doc: str | Column, root: str = "drug") -> list[Column]:
    return [xml_field(doc, f"/{root}/{tag}").alias(tag) for tag in MONOGRAPH_TAGS]
