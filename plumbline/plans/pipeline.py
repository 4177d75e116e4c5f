"""From a folder of files, or named tables, to appended result records."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import QualityConfig, as_of_column
from plumbline.functions.names import is_free_text_table
from plumbline.operators.documents import text_features
from plumbline.operators.records import flatten_records
from plumbline.plans.isolation import failed_records, reason_of
from plumbline.plans.records import isolated_records
from plumbline.plans.structured import validate_structured
from plumbline.plans.text import validate_features
from plumbline.session import settled
from plumbline.sources.documents import read_csv_documents, read_email, read_text
from plumbline.sources.inventory import list_files
from plumbline.sources.records import load_records
from plumbline.sources.results import replace_run, replace_run_checks
from plumbline.sources.tabular import csv_header, load_table

log = logging.getLogger(__name__)


def failed_result(
    spark: SparkSession, dataset_name: str, data_type: str, error: Exception, config: QualityConfig, as_of=None,
    run_id: str = "", source_path: str = "",
) -> DataFrame:
    """A record of score zero that says why a dataset could not be checked."""
    one = spark.createDataFrame(
        [(dataset_name, source_path, reason_of(error))], "dataset_name string, source_path string, reason string"
    )
    return failed_records(one, data_type, config, as_of, run_id)


def run_folder(
    spark: SparkSession,
    folder: str,
    results_path: str,
    run_id: str,
    as_of=None,
    config: QualityConfig = QualityConfig(),
    at_once: int = 4,
) -> int:
    """Check every file of a folder and its subfolders and store the records; how many failed.

    Tables and record files are data sets: their paths, a small row each, come to
    the driver and ``at_once`` of them are checked side by side. Text files, messages and rows of
    free-text tables are documents, read where they lie and checked together, so
    likely duplicates are found across formats. Suffixes count in any case; a
    file that is routed but cannot be read gets a record that says so. What
    fails in reading or checking is recorded and does not stop the others; a
    failure to store is raised. Storing a ``run_id`` again replaces it.
    """
    listing = settled(list_files(spark, folder).select("path", "stem", "suffix", "data_type"))
    sets = listing.where(F.col("data_type").isin("structured", "semi_structured")).orderBy("path").collect()
    counts = {r["suffix"]: r["count"] for r in listing.where("data_type = 'text'").groupBy("suffix").count().collect()}

    def checked(f) -> tuple[DataFrame, DataFrame | None, bool]:
        """(records, failed checks kept as rows, whether it went well)."""
        try:
            if f["data_type"] == "structured":
                table = load_table(spark, f["path"])
                done = validate_structured(
                    table, f["stem"], as_of, config, run_id=run_id, source_path=f["path"], isolate=True
                )
                return done, None, True
            records, kind = load_records(spark, f["path"])
            return *isolated_records(records, f["stem"], as_of, config, run_id, f["path"], kind), True
        except Exception as error:  # noqa: BLE001 - any failure of one data set is reported as its result
            log.exception("data set failed")
            return failed_result(spark, f["stem"], f["data_type"], error, config, as_of, run_id, f["path"]), None, False

    with ThreadPoolExecutor(at_once) as pool:
        outcomes = list(pool.map(checked, sets))
    parts = [records for records, _, _ in outcomes]
    checks = [rows for _, rows, _ in outcomes if rows is not None]
    failures = sum(not good for _, _, good in outcomes)

    readable = {".txt": read_text, ".eml": read_email}
    sources = [(f"*{suffix}", partial(read, spark, folder, suffix)) for suffix, read in readable.items() if suffix in counts]
    for f, (_, _, good) in zip(sets, outcomes, strict=True):
        if good and f["suffix"] == ".csv" and is_free_text_table(csv_header(spark, f["path"])):
            sources.append((f["stem"], partial(read_csv_documents, spark, f["path"])))
    documents, failed = _documents(spark, folder, sources, as_of, config, run_id)
    parts += documents
    failures += failed

    unread = listing.where("data_type = 'text'").where(~F.col("suffix").isin(*readable))
    reasons = unread.select(
        F.col("stem").alias("dataset_name"),
        F.col("path").alias("source_path"),
        F.concat(F.lit("unsupported file type '"), "suffix", F.lit("'")).alias("reason"),
    )
    parts.append(failed_records(reasons, "text", config, as_of, run_id))
    failures += sum(n for suffix, n in counts.items() if suffix not in readable)
    replace_run(reduce(DataFrame.unionByName, parts), results_path)
    if checks:
        replace_run_checks(reduce(DataFrame.unionByName, checks), results_path)
    return failures


def _documents(spark, folder, sources, as_of, config: QualityConfig, run_id: str) -> tuple[list[DataFrame], int]:
    """Records of all documents, checked together; (records, how many sources failed)."""
    good, parts, failures = [], [], 0
    for name, read in sources:
        try:
            good.append(settled(text_features(read(), "text", config.text)))
        except Exception as error:  # noqa: BLE001 - one unreadable source does not stop the others
            log.exception("documents failed")
            parts.append(failed_result(spark, name, "text", error, config, as_of, run_id, folder))
            failures += 1
    if good:
        features = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), good)
        parts.append(
            validate_features(
                features, "doc_id", as_of, "modified_at", config, unique_names=False, run_id=run_id, source_path="source_path",
                isolate=True,
            )
        )
    return parts, failures


# -- staging ------------------------------------------------------------------


def stage_table(df: DataFrame, path: str) -> None:
    """Keep a raw table for the check stage, typed."""
    df.write.mode("overwrite").parquet(path)


def stage_records(records: DataFrame, path: str) -> None:
    """Keep the flattened leaves of VARIANT records: ``record_id, path, value``.

    Leaves of one record share its number, so the record can be put together again.
    """
    numbered = records.select(F.monotonically_increasing_id().alias("record_id"), "v")
    leaves = flatten_records(numbered)
    leaves.select("record_id", "path", F.col("node").cast("string").alias("value")).write.mode("overwrite").parquet(path)


def stage_features(docs: DataFrame, path: str, run_id: str, extracted_at=None) -> None:
    """Keep the text features of a run in its own partition."""
    features = text_features(docs).withColumn("extracted_at", as_of_column(extracted_at))
    (
        features.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
