"""plumbline: data quality profiling and scoring as Spark DataFrame queries."""

from plumbline.config import QualityConfig, load_config
from plumbline.plans.pipeline import run_folder
from plumbline.plans.records import record_checks, validate_records
from plumbline.plans.scoring import run_summary, score_results
from plumbline.plans.structured import structured_checks, validate_structured
from plumbline.plans.text import validate_documents
from plumbline.session import configure

__all__ = [
    "QualityConfig",
    "configure",
    "load_config",
    "record_checks",
    "run_folder",
    "run_summary",
    "score_results",
    "structured_checks",
    "validate_documents",
    "validate_records",
    "validate_structured",
]
