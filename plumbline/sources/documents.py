"""Text sources as a documents table: ``doc_id, text, source_path, modified_at, format``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import names
from plumbline.sources.paths import path_stem, require_path, suffix_of
from plumbline.sources.tabular import read_csv

# Format of each suffix.
TEXT_FORMATS = {".txt": "txt", ".eml": "eml", ".csv": "csv"}


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 when they are valid UTF-8, as Latin-1 otherwise."""
    valid = F.is_valid_utf8(content.cast("string"))
    return F.when(valid, F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def any_case(suffix: str) -> str:
    """A file-name glob for a suffix in upper or lower case."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _files(spark: SparkSession, path: str, below: str | None = None) -> DataFrame:
    """The files of a path, or with ``below`` all files of that suffix in a folder and its subfolders."""
    reader = spark.read.format("binaryFile")
    if below is not None:
        reader = reader.options(recursiveFileLookup=True, pathGlobFilter=any_case(below))
    return reader.load(path)


def _document(text: Column, kind: str) -> list[Column]:
    return [
        path_stem(F.col("path")).alias("doc_id"),
        text.alias("text"),
        F.col("path").alias("source_path"),
        F.col("modificationTime").alias("modified_at"),
        F.lit(kind).alias("format"),
    ]


def read_text(spark: SparkSession, path: str, below: str | None = None) -> DataFrame:
    """A document per file."""
    return _files(spark, path, below).select(*_document(decoded(F.col("content")), "txt"))


def read_email(spark: SparkSession, path: str, below: str | None = None) -> DataFrame:
    """A document per message: the subject, then every plain-text part.

    The stdlib parser runs in Arrow batches where the files are read.
    """

    def parse(batches: Iterator) -> Iterator:
        for batch in batches:
            batch["text"] = [message_text(content) for content in batch["content"]]
            yield batch[["path", "modificationTime", "text"]]

    parsed = (
        _files(spark, path, below)
        .select("path", "modificationTime", "content")
        .mapInPandas(parse, "path string, modificationTime timestamp, text string")
    )
    return parsed.select(*_document(F.col("text"), "eml"))


def message_text(content: bytes) -> str:
    """Subject line and plain-text bodies of one message.

    A charset that nobody knows is read as UTF-8; what does not decode becomes
    replacement characters, which the document's own checks then find.
    """
    import email

    message = email.message_from_bytes(content)
    lines = [f"Subject: {message['Subject']}"] if message["Subject"] else []
    for part in message.walk():
        # A message of a single part is read whatever its type.
        if part.is_multipart() or (message.is_multipart() and part.get_content_type() != "text/plain"):
            continue
        body = part.get_payload(decode=True)
        if body:
            try:
                lines.append(body.decode(part.get_content_charset() or "utf-8", errors="replace"))
            except LookupError:
                lines.append(body.decode("utf-8", errors="replace"))
    return "\n".join(lines)


def rows_as_documents(df: DataFrame, key: str | None = None) -> DataFrame:
    """A document per row: its string columns joined by spaces, nulls left out."""
    strings = [names.quoted(c) for c in names.string_columns(df) if c != key]
    text = F.concat_ws(" ", *strings) if strings else F.lit("")
    doc_id = names.quoted(key) if key else F.monotonically_increasing_id()
    return df.select(doc_id.cast("string").alias("doc_id"), text.alias("text"))


def read_csv_documents(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    rows = read_csv(spark, path)
    meta = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_time"))
    strings = [names.quoted(c) for c in names.string_columns(rows)]
    row_id = names.quoted(key).cast("string") if key else F.monotonically_increasing_id().cast("string")
    return meta.select(
        F.concat_ws("#", path_stem(F.col("_path")), row_id).alias("doc_id"),
        (F.concat_ws(" ", *strings) if strings else F.lit("")).alias("text"),
        F.col("_path").alias("source_path"),
        F.col("_time").alias("modified_at"),
        F.lit("csv").alias("format"),
    )


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read by suffix."""
    suffix = suffix_of(path)
    require_path(spark, path)
    readers = {"txt": read_text, "eml": read_email, "csv": read_csv_documents}
    if suffix not in TEXT_FORMATS:
        raise ValueError(f"unsupported file type {suffix!r}: {path}")
    return readers[TEXT_FORMATS[suffix]](spark, path)
