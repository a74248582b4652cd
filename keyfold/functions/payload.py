"""Reading JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(name: str) -> str:
    """JSON path of a top-level field; in brackets a name may hold dots."""
    return f"$.{name}" if "'" in name else f"$['{name}']"


def field(payload: Column, name: str) -> Column:
    """Text of a top-level payload field, null when it is absent."""
    return F.get_json_object(payload, _path(name))


def json_type(parsed: Column, name: str) -> Column:
    """JSON type of a top-level field of a decoded payload, such as ``STRING``; null if absent.

    A field declared as text must be JSON text: ``from_json`` would turn a number into
    text without complaint, so the check reads the type itself.
    """
    return F.schema_of_variant(F.try_variant_get(parsed, _path(name), "variant"))


def is_json(text: Column) -> Column:
    """Whether the text decodes as JSON."""
    return F.try_parse_json(text).isNotNull()


def is_json_null(text: Column) -> Column:
    """Whether the text is a top-level JSON null, which counts as absence."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)) == "VOID", F.lit(False))
