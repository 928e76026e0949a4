"""JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_USER = "unknown"


def to_json_result(*columns: Column | str) -> Column:
    """One result row as JSON text."""
    return F.to_json(F.struct(*columns))


def kind(value: Column) -> Column:
    """Type name of a variant: VOID for a JSON null, null for a missing field."""
    return F.schema_of_variant(value)


def scalar_text(value: Column) -> Column:
    """Text of a scalar variant; null for a JSON null, an object or a list.

    Only a text that starts like an object or list needs a look at its type.
    """
    text = F.try_variant_get(value, "$", "string")
    plain = ~F.substring(text, 1, 1).isin("{", "[")
    return F.when(plain | ~kind(value).rlike("^(OBJECT|ARRAY)"), text)


def user_key(user_id: Column) -> Column:
    """Text of a JSON user id; anything that is not a scalar is ``'unknown'``."""
    return F.coalesce(scalar_text(user_id), F.lit(UNKNOWN_USER))
