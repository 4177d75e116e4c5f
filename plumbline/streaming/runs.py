"""A full quality run on every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.config import QualityConfig
from plumbline.plans.structured import validate_structured
from plumbline.sources.results import replace_run


def quality_stream(
    stream: DataFrame,
    dataset_name: str,
    results_path: str,
    checkpoint: str,
    as_of=None,
    config: QualityConfig = QualityConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Check each micro-batch and store its record under the batch's own run id.

    ``trigger`` are the arguments of the writer's trigger, by default all that is available.

    A batch replayed after a failure replaces its partition, so every batch is
    counted once.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.limit(1).count() == 0:
                return
            run_id = f"{dataset_name}-{batch_id:012d}"
            replace_run(
                validate_structured(batch, dataset_name, as_of, config, run_id=run_id), results_path
            )
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_stream_scores(results: DataFrame) -> DataFrame:
    """The score of each batch in order."""
    return results.select("dataset_name", "run_id", F.col("overall_score")).orderBy("run_id")
