"""Registered query plans: ``name -> (spark, sf_dir) -> DataFrame`` plus
the DuckDB oracle SQL of each.  Importing this package fills the registry."""

from . import (answer_plans, boundary_plans, chunk_plans, dataset_plans, feedback_plans, metric_plans,  # noqa: F401
               model_plans, retrieval_plans, source_plans, stream_plans, text_plans)
from .common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
