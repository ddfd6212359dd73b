"""Text columns: splitting, blank tests, composite keys and JSON points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewpulse.model import DELIMITER


def split_fields(line: Column | str) -> Column:
    """Fields of a raw line; trailing empty fields are kept."""
    return F.split(line, DELIMITER, -1)


def field_at(fields: Column, position: int) -> Column:
    """Trimmed field at a 0-based position, null past the end."""
    return F.trim(F.try_element_at(fields, F.lit(position + 1)))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(F.trim(text)) == 0)


def lenient_long(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def strict_long(text: Column) -> Column:
    """Long value, null for text that is not a number (the caller rejects the row)."""
    return text.try_cast("bigint")


def session_id(probe_id: Column, part: Column) -> Column:
    """Session ids repeat between boxes, so the box id is put in front."""
    return F.concat(probe_id, part)


def series_key(prefix: str, dims: Sequence[str | Column], period: str = "") -> Column:
    """Export key ``PREFIX[period]#dim#dim``."""
    return F.concat_ws("#", F.lit(prefix + period), *dims)


def split_series_key(key: Column, position: int) -> Column:
    """Part of an export key: 0 is the prefix, then the dimensions."""
    return F.try_element_at(F.split(key, "#", -1), F.lit(position + 1))


def json_point(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def json_points(text: Column, schema: str) -> Column:
    """Decode a JSON list of points; ``schema`` is the DDL of one point."""
    return F.from_json(text, f"array<struct<{schema}>>")
