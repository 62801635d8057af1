"""Text functions of log records, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Variable parts of a message and what stands for them, in the order they are replaced.
VARIABLE_PARTS = (
    (r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "<UUID>"),
    (r"(?iU)\b[0-9a-f]{8,}\b", "<HEX>"),
    (r"(?U)\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "<IP>"),
    (r"(?<![A-Za-z_])(?U)\d+(?![A-Za-z_])", "<N>"),
    (r"(?U)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}[.,]?\d*Z?", "<TS>"),
)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; trim() only takes spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nonempty(c: Column) -> Column:
    """Stripped, null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalised(message: Column) -> Column:
    """A message with placeholders for its variable parts, so that messages of one kind are equal."""
    out = strip(message)
    for pattern, placeholder in VARIABLE_PARTS:
        out = F.regexp_replace(out, pattern, placeholder)
    return out


def message_hash(message: Column) -> Column:
    return F.substring(F.sha2(normalised(message), 256), 1, 16)


def before_first(c: Column, separator: str) -> Column:
    """Part before the first separator; null without one."""
    return F.when(F.contains(c, F.lit(separator)), F.split_part(c, F.lit(separator), F.lit(1)))


def after_first(c: Column, separator: str) -> Column:
    """Part after the first separator; the whole without one."""
    at = F.position(F.lit(separator), c)
    return F.when(at > 0, F.substring(c, at + F.lit(len(separator)), F.length(c))).otherwise(c)


def json_field(c: Column, name: str, kind: str) -> Column:
    """A field of a JSON object by its name at the top; null where the text is no JSON, lacks the field or has another kind of value there."""
    return F.try_variant_get(F.try_parse_json(c), f"$.{name}", kind)
