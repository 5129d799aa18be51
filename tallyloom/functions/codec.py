"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def parse_object(value: Column) -> Column:
    """JSON object text as MAP<STRING, VARIANT>; anything else is an empty map."""
    return F.coalesce(
        F.from_json(value, "map<string,variant>"),
        F.expr("cast(map() as map<string,variant>)"),
    )


def read_fields(value: Column, fields: dict[str, str]) -> Column:
    """The named fields of a JSON object as a struct, in one parse.

    Texts that hold no JSON object set the extra ``_corrupt_record`` field.
    """
    layout = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return F.from_json(value, f"{layout}, {CORRUPT} string")


def parse_once(messages: DataFrame, value: str, fields: dict[str, str]) -> DataFrame:
    """Replaces the JSON text by the struct ``_m`` of its fields.

    The one-element explode keeps the optimizer from copying the parse into
    every later filter and projection: a predicate on ``_m`` stays above it.
    """
    kept = [F.col(c) for c in messages.columns if c != value]
    parsed = F.array(read_fields(F.col(value), fields))
    return messages.select(*kept, F.explode(parsed).alias("_m"))


def is_readable(parsed: Column) -> Column:
    """False for null or empty text and for text that is no JSON object."""
    return parsed.isNotNull() & parsed[CORRUPT].isNull()


def encode_json(*columns: Column | str) -> Column:
    """One JSON object per row; nulls stay visible."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def extract_job_id(value: Column) -> Column:
    return F.coalesce(F.get_json_object(value, "$.job_id"), F.lit(""))
