"""Registered queries: each pairs a Spark plan with an independent SQL check."""

from importlib import import_module

MODULES = ["text_queries", "ingest_queries", "area_queries", "score_queries", "report_queries", "file_queries", "pipeline_queries"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"arealens.plans.{name}")
