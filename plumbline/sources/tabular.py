"""Tabular sources: CSV, Parquet and JDBC."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.paths import require_path, suffix_of

# Database URL prefixes and file suffixes.
SQL_PREFIXES = ("postgresql://", "mysql://", "sqlite://", "mssql://", "oracle://")
CSV_SUFFIXES = (".csv",)
PARQUET_SUFFIXES = (".parquet", ".pq")

# Types that a CSV column may have, narrowest first.
CSV_TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp")
# Texts that a cast would take for more than they say: only these forms count.
CSV_FORMS = {"double": r"^[^dDfF]+$|^[+-]?[iI]nf(inity)?$", "boolean": "(?i)^(true|false)$", "date": r"^\d{4}-\d{1,2}-\d{1,2}$"}

# JDBC spelling of each prefix.
JDBC_SCHEMES = {
    "postgresql://": "jdbc:postgresql://",
    "mysql://": "jdbc:mysql://",
    "sqlite://": "jdbc:sqlite:",
    "mssql://": "jdbc:sqlserver://",
    "oracle://": "jdbc:oracle:thin:@//",
}


def load_table(spark: SparkSession, source: str, **jdbc_options: str) -> DataFrame:
    """Read a table by the form of its address: database URL first, then file suffix."""
    if source.startswith((*SQL_PREFIXES, "jdbc:")):
        return read_jdbc(spark, source, **jdbc_options)
    suffix = suffix_of(source)
    if suffix in CSV_SUFFIXES:
        return read_csv(spark, require_path(spark, source))
    if suffix in PARQUET_SUFFIXES:
        return spark.read.parquet(require_path(spark, source))
    require_path(spark, source)
    raise ValueError(f"unsupported file type {suffix!r}: {source}")


def csv_header(spark: SparkSession, path: str) -> DataFrame:
    """The columns of a CSV file as text; nothing but its first line is looked at for them."""
    return spark.read.options(header=True, escape='"').csv(path)


# Fields that stand for a missing value.
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, multiline: bool = True) -> DataFrame:
    """CSV with a header; empty fields and the usual spellings of "missing" are null.

    Without a schema every column is read as text once, nulls are taken out, and
    the narrowest of whole number, number, truth value and instant that fits
    all of its values is its type. ``multiline`` allows line breaks inside
    quotes, for which a file is one task; without it large files are split.
    """
    reader = spark.read.options(header=True, multiLine=multiline, escape='"', nullValue="", emptyValue="")
    if schema:
        return reader.schema(schema).csv(path)
    text = reader.option("inferSchema", False).csv(path)
    columns = [f.name for f in text.schema.fields]
    missing = {c: F.when(~F.col(f"`{c}`").isin(*NULL_SPELLINGS), F.col(f"`{c}`")).alias(c) for c in columns}
    if not columns:
        return text
    fits = []
    for position, c in enumerate(columns):
        value = missing[c]
        filled = F.count(value)
        for kind in CSV_TYPES:
            cast = F.when(value.rlike(CSV_FORMS.get(kind, "")), value.try_cast(kind))
            fits.append((F.count(cast) == filled).alias(f"{position}_{kind}"))
        fits.append((filled > 0).alias(f"{position}_any"))
    row = text.agg(*fits).first()
    typed = []
    for position, c in enumerate(columns):
        kind = next((k for k in CSV_TYPES if row[f"{position}_any"] and row[f"{position}_{k}"]), "string")
        typed.append(missing[c].cast(kind).alias(c) if kind != "string" else missing[c])
    return text.select(*typed)


def split_sql_source(source: str) -> tuple[str, str]:
    """``url|table`` or ``url|SELECT ...`` as the URL and a query."""
    if "|" not in source:
        raise ValueError(f"a SQL source needs '|' and a table or query after its URL: {source}")
    url, target = (part.strip() for part in source.split("|", 1))
    if not target:
        raise ValueError("the table or query after '|' is empty")
    query = target if re.match(r"select\b", target, re.IGNORECASE) else f"SELECT * FROM {target}"
    return url, query


def jdbc_url(url: str) -> tuple[str, dict[str, str]]:
    """A database URL in JDBC spelling, with its credentials as options."""
    if url.startswith("jdbc:"):
        return url, {}
    prefix = next(p for p in SQL_PREFIXES if url.startswith(p))
    rest = url[len(prefix):]
    options = {}
    if prefix == "sqlite://":
        return JDBC_SCHEMES[prefix] + rest.removeprefix("/"), options
    if "@" in rest:
        credentials, rest = rest.rsplit("@", 1)
        user, _, password = credentials.partition(":")
        options = {"user": user, **({"password": password} if password else {})}
    if prefix == "mssql://":
        host, _, database = rest.partition("/")
        return f"{JDBC_SCHEMES[prefix]}{host}" + (f";databaseName={database}" if database else ""), options
    return JDBC_SCHEMES[prefix] + rest, options


def jdbc_reader_options(source: str, **extra: str) -> dict[str, str]:
    """Reader options for a SQL source.

    Spark forbids ``query`` beside ``partitionColumn``, so a partitioned read
    passes the query as a derived table.
    """
    address, query = split_sql_source(source)
    url, credentials = jdbc_url(address)
    target = {"dbtable": f"({query}) source"} if "partitionColumn" in extra else {"query": query}
    return {"url": url, **credentials, **target, **extra}


def read_jdbc(spark: SparkSession, source: str, **extra: str) -> DataFrame:
    """Read a SQL source.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read a large table in parallel.
    """
    return spark.read.format("jdbc").options(**jdbc_reader_options(source, **extra)).load()
