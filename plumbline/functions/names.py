"""Predicates over column names and types; they read the schema, never the data."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name parts that give a column its role.
IDENTIFIER_TOKENS = ("id", "key", "uuid", "guid")
NON_NEGATIVE_TOKENS = (
    "price", "cost", "amount", "count", "age",
    "quantity", "duration", "rate", "score", "size",
)
DATE_TOKENS = ("timestamp", "ts", "date", "created", "updated", "modified", "time")
FREE_TEXT_TOKENS = (
    "text", "body", "content", "comment", "description",
    "message", "caption", "post", "review",
)
URL_SUFFIXES = ("_url", "_link")
EMAIL_SUFFIX = "_email"

NUMERIC, STRING, TEMPORAL, OTHER = "numeric", "string", "temporal", "other"


def kind_of(dtype: T.DataType) -> str:
    """Broad class of a Spark type; booleans count as numeric."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return NUMERIC
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return STRING
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TEMPORAL
    return OTHER


def name_has(name: str, tokens: tuple[str, ...], strict: bool = False) -> bool:
    """Whether the lower-cased name contains one of the tokens.

    The default is a substring test ("paid" holds "id"). ``strict`` compares
    whole words of a snake_case or camelCase name.
    """
    if not strict:
        return any(token in name.lower() for token in tokens)
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    words = set(re.split(r"[^a-z0-9]+", spaced.lower()))
    return any(token in words for token in tokens)


def column_has(column: Column, tokens: tuple[str, ...]) -> Column:
    """The same substring test on a column that holds names."""
    lowered = F.lower(column)
    test = F.lit(False)
    for token in tokens:
        test = test | lowered.contains(token)
    return test


def column_ends(column: Column, suffixes: tuple[str, ...]) -> Column:
    lowered = F.lower(column)
    test = F.lit(False)
    for suffix in suffixes:
        test = test | lowered.endswith(suffix)
    return test


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if kind_of(f.dataType) == STRING]


def is_free_text_table(df: DataFrame) -> bool:
    """Whether any header names free text; decided from the schema alone."""
    return any(name_has(name, FREE_TEXT_TOKENS) for name in df.columns)


def quoted(name: str) -> Column:
    """Reference a column whose name may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")
