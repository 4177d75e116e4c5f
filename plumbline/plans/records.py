"""The six quality dimensions of semi-structured records.

The number of paths depends on the data (a map keyed by user id has as many as
there are users), so checks stay a distributed table. Scores come from sums and
never depend on how many checks failed. One named record may carry its checks
in an array; a run keeps them as ranked rows beside the records instead.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DIMENSIONS, QualityConfig, RecordRules, as_of_column
from plumbline.functions import names
from plumbline.functions.dates import age_days, two_zone_decay
from plumbline.functions.jsontext import FIELD_NAME_LEGAL, FIELD_NAME_PATTERN, nesting_depth
from plumbline.functions.scoring import percent, percent_text
from plumbline.operators.records import (
    duplicate_records,
    field_metrics,
    measured_levels,
    typed_duplicate_records,
    typed_field_metrics,
)
from plumbline.plans.isolation import by_dimension
from plumbline.plans.results import check_rows, checks_of, failed_alone, ordered_failures, result_record
from plumbline.session import settled
from plumbline.types import CHECK_COLUMNS, CHECK_TYPE

log = logging.getLogger(__name__)


def derived_fields(fields: DataFrame, as_of, rules: RecordRules) -> DataFrame:
    filled = F.col("non_null")
    dated = (F.col("dates") > 0) & (F.col("dates") >= rules.date_parse_ratio * filled)
    return (
        fields.withColumn(
            "null_rate",
            F.coalesce(F.try_divide(F.col("record_count") - filled, F.col("record_count")), F.lit(0.0)),
        )
        .withColumn("mix_rate", F.coalesce(F.try_divide(filled - F.col("majority_count"), filled), F.lit(0.0)))
        .withColumn("is_mixed", F.col("mix_rate") > rules.type_mix_warn)
        .withColumn("is_unexpected", filled < rules.sparse_share * F.col("record_count"))
        .withColumn("is_bad_name", ~F.col("path").rlike(FIELD_NAME_PATTERN))
        .withColumn("is_date", dated)
        .withColumn("age_days", F.when(dated, age_days(as_of_column(as_of), F.col("latest"))))
        .withColumn("is_stale", F.coalesce(F.col("age_days") > rules.recent_days, F.lit(False)))
        .withColumn("is_url", names.column_ends(F.col("path"), names.URL_SUFFIXES))
        .withColumn("is_email", names.column_ends(F.col("path"), (names.EMAIL_SUFFIX,)))
    )


def _severity(is_error: Column) -> Column:
    return F.when(is_error, F.lit("error")).otherwise(F.lit("warning"))


def _bad_characters(path: Column) -> Column:
    # Keep only illegal characters, then list each once, quoted, in order.
    only_bad = F.regexp_replace(path, FIELD_NAME_LEGAL, "")
    chars = F.array_sort(F.array_distinct(F.split(only_bad, "")))
    return F.array_join(F.transform(chars, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", ")


def field_checks(rules: RecordRules, dimensions: Iterable[str] = DIMENSIONS) -> Column:
    """Array of the failed checks of one derived field row."""
    check = checks_of(dimensions)
    path = F.col("path")
    share = lambda bad: F.col(bad) / F.greatest(F.col("non_null"), F.lit(1))
    return failed_alone(
        check(
            "completeness", path, 0, F.col("null_rate") > rules.null_warn,
            "null_rate", path,
            f"null_rate <= {percent_text(rules.null_warn)}",
            percent("null_rate"),
            _severity(F.col("null_rate") > rules.null_error),
        ),
        check(
            "accuracy", path, 0, F.col("is_mixed"),
            "type_inconsistency", path,
            f"<= {percent_text(rules.type_mix_warn)} minority-type values",
            F.concat(
                percent("mix_rate", 1), F.lit(" of values are "), F.col("minority_types"),
                F.lit(" (majority: "), F.col("majority_type"), F.lit(")"),
            ),
            _severity(F.col("mix_rate") > rules.type_mix_error),
        ),
        check(
            "consistency", path, 0, F.col("is_unexpected"),
            "unexpected_key", path,
            f"field present in >= {percent_text(rules.sparse_share)} of records",
            f"field present in < {percent_text(rules.sparse_share)} of records",
            "warning",
        ),
        check(
            "consistency", path, 1, F.col("is_bad_name"),
            "invalid_field_name", path,
            "field name with only letters, digits, _ or .",
            F.concat(F.lit("contains invalid character(s): "), _bad_characters(path)),
            "error",
        ),
        check(
            "freshness", path, 0, F.col("is_stale"),
            "stale_data", path,
            f"most recent value within {rules.recent_days} days",
            F.format_string(
                "most recent value is %s (%d days ago)", F.to_date("latest").cast("string"), F.col("age_days")
            ),
            _severity(F.col("age_days") >= rules.stale_days),
        ),
        check(
            "validity", path, 1, F.col("is_url") & (F.col("bad_urls") > 0),
            "invalid_url", path,
            "values starting with http:// or https://",
            F.format_string("%d value(s) do not start with http", "bad_urls"),
            _severity(share("bad_urls") >= rules.bad_share_error),
        ),
        check(
            "validity", path, 2, F.col("is_email") & (F.col("bad_emails") > 0),
            "invalid_email", path,
            "values matching <local>@<domain>.<tld>",
            F.format_string("%d value(s) do not match email pattern", "bad_emails"),
            _severity(share("bad_emails") >= rules.bad_share_error),
        ),
    )


def dataset_checks(rules: RecordRules, dimensions: Iterable[str] = DIMENSIONS) -> Column:
    """Array of the failed checks that concern the whole set, from the totals row."""
    check = checks_of(dimensions)
    return failed_alone(
        check(
            "freshness", "", 0, F.col("date_fields") == 0,
            "no_date_fields", "dataset",
            "at least one date or timestamp field", "none found", "warning",
        ),
        check(
            "uniqueness", "", 0, F.col("duplicate_rate") > rules.duplicate_warn,
            "duplicate_records", "dataset",
            f"duplicate_rate <= {percent_text(rules.duplicate_warn)}",
            F.format_string("%s (%d record(s))", percent("duplicate_rate"), F.col("duplicate_count")),
            _severity(F.col("duplicate_rate") > rules.duplicate_error),
        ),
        check(
            "validity", "", 0, F.col("max_nesting_depth") > rules.max_depth,
            "excessive_nesting_depth", "dataset",
            f"max_nesting_depth <= {rules.max_depth}",
            F.format_string("max_nesting_depth = %d", "max_nesting_depth"),
            "error",
        ),
    )


def named_checks(ranked: DataFrame, dataset_name: str, run_id: str) -> DataFrame:
    """Ranked checks as rows of the table of a run."""
    named = ranked.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset_name).alias("dataset_name"),
        "dimension_order",
        "position",
        "seq",
        "dimension",
        "failed.*",
    )
    return named.select(*CHECK_COLUMNS)


class RecordPlan:
    """The shared parts of one data set's checks, scores and result record.

    ``records`` is either a table with one VARIANT column ``v`` or any table
    with a known schema. ``only`` leaves out all but one dimension; its parts
    are then not settled, so the planner drops what that one does not read.
    """

    def __init__(
        self, records: DataFrame, as_of=None, config: QualityConfig = QualityConfig(), levels=None, only: str | None = None
    ):
        self.dimensions = DIMENSIONS if only is None else (only,)
        self.config, self.rules, self.as_of = config, config.records, as_of
        if records.columns == ["v"]:
            # One measuring pass; its number sizes the walk and is itself a metric.
            depth = measured_levels(records)
            levels = depth if levels is None else levels
            fields, duplicates = field_metrics(records, levels), duplicate_records(records, levels)
            depth = F.lit(depth)
        else:
            fields, duplicates = typed_field_metrics(records), typed_duplicate_records(records)
            depth = records.select(F.struct("*").alias("r")).agg(
                F.coalesce(F.max(nesting_depth(F.to_json("r"))), F.lit(0)).alias("d")
            ).scalar()
        # One row per path and one row of totals: settled, so that scores and
        # checks do not each scan the records again.
        keep = settled if only is None else lambda df: df
        self.fields = keep(derived_fields(fields, as_of, self.rules))
        self.totals = keep(self._totals(duplicates, depth))

    def _totals(self, duplicates: DataFrame, depth: Column) -> DataFrame:
        bad_link = (F.col("is_url") & (F.col("bad_urls") > 0)).cast("int")
        bad_mail = (F.col("is_email") & (F.col("bad_emails") > 0)).cast("int")
        totals = self.fields.agg(
            F.count(F.lit(1)).alias("field_count"),
            F.avg(1 - F.col("null_rate")).alias("filled_share"),
            F.count_if("is_mixed").alias("mixed_fields"),
            F.count_if("is_unexpected").alias("unexpected_fields"),
            F.count_if("is_bad_name").alias("bad_names"),
            F.count_if("is_date").alias("date_fields"),
            F.max(F.when(F.col("is_stale"), F.col("age_days"))).alias("worst_age"),
            F.coalesce(F.sum(F.col("is_url").cast("int") + F.col("is_email").cast("int")), F.lit(0)).alias("formats"),
            F.coalesce(F.sum(bad_link + bad_mail), F.lit(0)).alias("bad_formats"),
        )
        pair = duplicates.select(F.struct("*").alias("d")).scalar()
        return (
            totals.withColumn("duplicates", pair)
            .withColumn("max_nesting_depth", depth.cast("bigint"))
            .withColumn("record_count", F.col("duplicates.row_count"))
            .withColumn("duplicate_count", F.col("duplicates.duplicate_count"))
            .withColumn("duplicate_rate", F.col("duplicates.duplicate_rate"))
            .drop("duplicates")
        )

    def scores(self) -> DataFrame:
        rules = self.rules
        no_fields = F.col("field_count") == 0
        penalty = rules.name_penalty * (F.col("unexpected_fields") + F.col("bad_names"))
        decay = two_zone_decay(F.coalesce("worst_age", F.lit(0)), rules.recent_days, rules.stale_days)
        too_deep = (F.col("max_nesting_depth") > rules.max_depth).cast("int")
        applicable = F.lit(1) + F.col("formats")
        return self.totals.select(
            "*",
            F.when(no_fields, F.lit(0.0)).otherwise(F.col("filled_share") * 100).alias("completeness"),
            F.when(no_fields, F.lit(100.0))
            .otherwise((1 - F.try_divide("mixed_fields", "field_count")) * 100)
            .alias("accuracy"),
            F.greatest(F.lit(0.0), 100.0 - penalty).alias("consistency"),
            F.when(F.col("date_fields") == 0, F.lit(rules.no_date_score)).otherwise(decay).alias("freshness"),
            ((1 - F.col("duplicate_rate")) * 100).alias("uniqueness"),
            ((applicable - too_deep - F.col("bad_formats")) / applicable * 100).alias("validity"),
        )

    def ranked_checks(self) -> DataFrame:
        per_field = self.fields.select(F.inline(field_checks(self.rules, self.dimensions)))
        return per_field.unionByName(self.totals.select(F.inline(dataset_checks(self.rules, self.dimensions))))

    def part(self, dimension: str) -> tuple[DataFrame, DataFrame]:
        """Score and metadata of one dimension, and its failed checks."""
        known = {"completeness": ("field_count",), "uniqueness": ("record_count",), "validity": ("max_nesting_depth",)}
        entries = [x for key in known.get(dimension, ()) for x in (F.lit(key), F.col(key).cast("string"))]
        metadata = F.create_map(*entries).cast("map<string,string>").alias("metadata")
        return self.scores().select(dimension, metadata), self.ranked_checks()

    def checks(self) -> DataFrame:
        """Every failed check as a row, however many there are."""
        return check_rows(self.ranked_checks())

    def run_checks(self, dataset_name: str, run_id: str = "") -> DataFrame:
        """Every failed check with the keys that put it into report order, for the table of a run."""
        return named_checks(self.ranked_checks(), dataset_name, run_id)

    def result(
        self, dataset_name: str, run_id: str = "", source_path: str = "", format: str = "unknown", inline: bool = True
    ) -> DataFrame:
        """The scored record. ``inline`` puts all failed checks into its one row, for a single record
        that is to be shown; without it they stay rows (:meth:`run_checks`), as in a run.
        """
        if inline:
            ranked = self.ranked_checks()
            gathered = ranked.agg(F.collect_list(F.struct(*ranked.columns)).alias("ranked")).scalar()
            scored = self.scores().withColumn("ranked", gathered)
            failures = ordered_failures(F.col("ranked"))
        else:
            scored, failures = self.scores(), F.array().cast(f"array<{CHECK_TYPE}>")
        finished = (
            scored.withColumn("failed_checks", failures)
            .withColumn(
                "metadata",
                F.create_map(
                    F.lit("record_count"), F.col("record_count").cast("string"),
                    F.lit("field_count"), F.col("field_count").cast("string"),
                    F.lit("max_nesting_depth"), F.col("max_nesting_depth").cast("string"),
                    F.lit("format"), F.lit(format),
                ),
            )
        )
        return result_record(
            finished, "semi_structured", self.config, dataset_name, as_of_column(self.as_of), run_id, source_path
        )


def record_checks(records: DataFrame, as_of=None, config: QualityConfig = QualityConfig()) -> DataFrame:
    return RecordPlan(records, as_of, config).checks()


def record_scores(records: DataFrame, as_of=None, config: QualityConfig = QualityConfig()) -> DataFrame:
    return RecordPlan(records, as_of, config).scores()


def validate_records(
    records: DataFrame,
    dataset_name: str,
    as_of=None,
    config: QualityConfig = QualityConfig(),
    run_id: str = "",
    source_path: str = "",
    format: str = "unknown",
) -> DataFrame:
    """All six dimensions, the failed checks and the weighted score as one result record."""
    return RecordPlan(records, as_of, config).result(dataset_name, run_id, source_path, format)


def isolated_records(
    records: DataFrame,
    dataset_name: str,
    as_of=None,
    config: QualityConfig = QualityConfig(),
    run_id: str = "",
    source_path: str = "",
    format: str = "unknown",
) -> tuple[DataFrame, DataFrame]:
    """The record without inline checks, and its failed checks as rows, both computed now.

    Should that fail, each dimension is computed alone; one that fails again scores zero with
    the reason, and the others keep their scores and checks.
    """
    try:
        plan = RecordPlan(records, as_of, config)
        done = settled(plan.result(dataset_name, run_id, source_path, format, inline=False))
        return done, settled(plan.run_checks(dataset_name, run_id))
    except Exception:  # noqa: BLE001 - each dimension reports its own failure below
        log.exception("data set failed as a whole")
    scored, ranked = by_dimension(
        records.sparkSession, lambda dimension: RecordPlan(records, as_of, config, only=dimension).part(dimension)
    )
    finished = scored.withColumn("failed_checks", F.array().cast(f"array<{CHECK_TYPE}>")).withColumn(
        "metadata", F.map_concat("metadata", F.create_map(F.lit("format"), F.lit(format)))
    )
    done = result_record(
        finished, "semi_structured", config, dataset_name, as_of_column(as_of), run_id, source_path
    )
    return settled(done), settled(named_checks(ranked, dataset_name, run_id))
