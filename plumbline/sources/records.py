"""Semi-structured sources as one VARIANT column ``v``, one row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.jsontext import is_object, parse_whole_json
from plumbline.sources.paths import require_path, suffix_of

# What counts as white space around a line.
BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Format of each suffix.
RECORD_FORMATS = {".json": "json", ".jsonl": "jsonl", ".xml": "xml", ".log": "log"}


def as_record(value: Column) -> Column:
    """Objects as they are; any other value under the key ``value``."""
    return F.when(is_object(value), value).otherwise(F.to_variant_object(F.struct(value.alias("value"))))


def _json_keys(spark: SparkSession, path: str) -> list[str] | None:
    """Keys of the objects in a JSON source, None where it holds anything else or keys alike but for case."""
    sensitive = "spark.sql.caseSensitive"
    before = spark.conf.get(sensitive)
    spark.conf.set(sensitive, "true")
    try:
        keys = spark.read.json(path, multiLine=True).columns
    finally:
        spark.conf.set(sensitive, before)
    alike = len({key.lower() for key in keys}) < len(keys)
    return None if alike or not keys or "_corrupt_record" in keys or any("`" in key for key in keys) else keys


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document per file: an array gives a record per element, an object one record.

    Arrays of objects of any size are read element by element. A file with other
    elements, or with keys that differ in case alone, is parsed as one value of
    at most 128 MiB.
    """
    keys = _json_keys(spark, path)
    if keys is not None:
        columns = spark.read.schema(", ".join(f"`{key}` variant" for key in keys)).json(path, multiLine=True)
        pairs = [part for key in keys for part in (F.lit(key), F.col(f"`{key}`"))]
        # A key that is absent is a null column, a null under a key is a null variant.
        given = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
        return columns.select(F.to_variant_object(given).alias("v"))
    files = spark.read.text(path, wholetext=True)
    documents = files.select(F.parse_json("value").alias("document"))
    is_array = F.schema_of_variant("document").startswith("ARRAY")
    singles = documents.where(~is_array).select(as_record(F.col("document")).alias("v"))
    arrays = documents.where(is_array)
    elements = arrays.lateralJoin(spark.tvf.variant_explode(F.col("document").outer()))
    return singles.unionByName(elements.select(as_record(F.col("value")).alias("v")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.btrim("value", F.lit(BLANK)).alias("line")).where(F.col("line") != "")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A record per line; lines that are not one JSON value are dropped (see ``malformed_lines``)."""
    parsed = _lines(spark, path).select(parse_whole_json(F.col("line")).alias("v"))
    return parsed.where(F.col("v").isNotNull()).select(as_record(F.col("v")).alias("v"))


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: how many non-blank lines a JSON-lines source holds and how many it drops."""
    parsed = _lines(spark, path).select(parse_whole_json(F.col("line")).alias("v"))
    return parsed.agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if(F.col("v").isNull()).alias("malformed_count")
    )


def log_record(line: Column, parsed: Column) -> Column:
    """The parsed JSON of a log line, or the line itself under ``raw_line``."""
    raw = F.to_variant_object(F.struct(line.alias("raw_line")))
    return F.when(parsed.isNull(), raw).otherwise(as_record(parsed))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A record per line: JSON where it parses, ``raw_line`` where it does not."""
    parsed = _lines(spark, path).select("line", parse_whole_json(F.col("line")).alias("parsed"))
    return parsed.select(log_record(F.col("line"), F.col("parsed")).alias("v"))


XML_OPTIONS = {"attributePrefix": "", "valueTag": "_text", "nullValue": ""}
XML_NAME = r"<([A-Za-z_][\w.:-]*)"


def read_xml(spark: SparkSession, path: str, row_tag: str | None = None) -> DataFrame:
    """A record per element: a typed one per ``row_tag``, or every direct child of the root as ``v``.

    Attributes become keys, the text of an element with attributes ``_text``, and
    repeated children arrays. Without a tag the files are read whole, one task
    each; with it they are split.
    """
    if row_tag is not None:
        return spark.read.format("xml").options(rowTag=row_tag, **XML_OPTIONS).load(path)
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", XML_NAME, 1).alias("root"))
    roots = [row["root"] for row in files.where("root <> ''").distinct().collect()]
    records = None
    for root in roots:
        whole = spark.read.format("xml").options(rowTag=root, **XML_OPTIONS).load(path)
        for child in whole.columns:
            column = F.col(f"`{child}`")
            kind = whole.schema[child].dataType.typeName()
            each = whole.select((F.explode(column) if kind == "array" else column).alias("child")).where("child IS NOT NULL")
            shaped = F.col("child") if each.schema["child"].dataType.typeName() == "struct" else F.struct(F.col("child").alias(child))
            part = each.select(F.to_variant_object(shaped).alias("v"))
            records = part if records is None else records.unionByName(part)
    return spark.sql("SELECT parse_json(NULL) AS v").where("false") if records is None else records


def load_records(spark: SparkSession, path: str, row_tag: str | None = None) -> tuple[DataFrame, str]:
    """Read by suffix; the records and the name of their format."""
    suffix = suffix_of(path)
    require_path(spark, path)
    if suffix not in RECORD_FORMATS:
        raise ValueError(f"unsupported file type {suffix!r}: {path}")
    kind = RECORD_FORMATS[suffix]
    if kind == "xml":
        return read_xml(spark, path, row_tag), kind
    return {"json": read_json, "jsonl": read_jsonl, "log": read_log}[kind](spark, path), kind
