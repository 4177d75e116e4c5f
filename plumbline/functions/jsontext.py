"""Expressions over JSON text and VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import WHITESPACE

# The address shape of an e-mail field and the legal field name.
EMAIL_PATTERN = rf"^[^@{WHITESPACE}]+@[^@{WHITESPACE}]+\.[^@{WHITESPACE}]+$"
FIELD_NAME_PATTERN = r"^[\p{L}\p{N}_.]+$"
FIELD_NAME_LEGAL = r"[\p{L}\p{N}_.]+"

SCALAR_PATTERN = r"^(s|true|false|null|-?\d+(\.\d+)?([eE][+-]?\d+)?)$"


def skeleton(text: Column) -> Column:
    """JSON text with every string shortened to ``s``, so brackets can be read safely."""
    unescaped = F.regexp_replace(text, r"\\.", "")
    return F.regexp_replace(unescaped, r'"[^"]*"', "s")


def brackets(text: Column) -> Column:
    """The brackets of JSON text in order; a few different ones whatever the number of records."""
    return F.regexp_replace(skeleton(text), r"[^\[\]{}]+", "")


def bracket_walk(text: Column) -> Column:
    """``struct(depth, deepest, closings)``: level after, deepest level, returns to level zero."""
    return folded(brackets(text))


def folded(brackets: Column) -> Column:
    """:func:`bracket_walk` of brackets alone."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("deepest"), F.lit(0).alias("closings"))

    def step(state: Column, char: Column) -> Column:
        opening = char.isin("{", "[")
        closing = char.isin("}", "]")
        depth = state["depth"] + F.when(opening, 1).when(closing, -1).otherwise(0)
        done = F.when(closing & (depth == 0), 1).otherwise(0)
        return F.struct(
            depth.alias("depth"),
            F.greatest(state["deepest"], depth).alias("deepest"),
            (state["closings"] + done).alias("closings"),
        )

    return F.aggregate(F.split(brackets, ""), start, step)


def nesting_depth(text: Column) -> Column:
    """How deep objects and arrays nest: 0 for a scalar, 1 for a flat object or an empty one."""
    return bracket_walk(text)["deepest"]


def is_whole_json(text: Column) -> Column:
    """Whether the text is one JSON value with nothing after it.

    The lenient parser stops at the end of the first value; this reads on.
    """
    value = F.trim(text)
    walk = bracket_walk(value)
    container = value.rlike(r"^[\[{]") & value.rlike(r"[\]}]$") & (walk["closings"] == 1) & (walk["depth"] == 0)
    return container | skeleton(value).rlike(SCALAR_PATTERN)


def parse_whole_json(text: Column) -> Column:
    """Text to VARIANT, null when it is not exactly one JSON value."""
    return F.when(is_whole_json(text), F.try_parse_json(text))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def type_name(schema: Column) -> Column:
    """Name of a JSON value's type from its ``schema_of_variant``; ``null`` for JSON null."""
    return (
        F.when(schema.isNull() | (schema == "VOID"), F.lit("null"))
        .when(schema == "STRING", F.lit("str"))
        .when(schema == "BIGINT", F.lit("int"))
        # Whole numbers beyond 64 bits are held as decimals without a fraction.
        .when(schema.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$"), F.lit("int"))
        .when(schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT"), F.lit("float"))
        .when(schema == "BOOLEAN", F.lit("bool"))
        .when(schema.startswith("ARRAY"), F.lit("list"))
        .when(schema.startswith("OBJECT"), F.lit("dict"))
        .otherwise(F.lower(schema))
    )


def leaf_text(value: Column, schema: Column) -> Column:
    """JSON text of a value that is no object, the same for a whole double as for the integer it equals."""
    number = F.try_variant_get(value, "$", "double")
    whole = (schema == "DOUBLE") & (number == F.floor(number)) & (F.abs(number) < 2.0**53)
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(F.to_json(value))
