"""JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, strip_nul_json


def nested(c: Column | str) -> Column:
    """The object or list that a JSON text holds; any other text stays a text."""
    c = _col(c)
    return F.coalesce(F.when(c.rlike(r"^\s*[\[{]"), F.try_parse_json(c)), c.cast("variant"))


def metadata_json(**fields: Column | str) -> Column:
    """JSON object that keeps explicit nulls and drops NUL characters."""
    packed = F.struct(*[_col(value).alias(name) for name, value in fields.items()])
    return strip_nul_json(F.to_json(packed, {"ignoreNullFields": "false"}))


def field_equals(c: Column | str, name: str, value: Column | str) -> Column:
    """``c->>name = value``."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.get_json_object(_col(c), f"$.{name}") == value


def present_fields(c: Column | str) -> Column:
    """Names of the fields a JSON object holds, null fields included."""
    return F.json_object_keys(_col(c))
