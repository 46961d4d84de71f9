"""The audit of a run.

``register`` exposes the current images (scan rows with the statuses and
values of later phases) as a view, for a user's own ``spark.sql``; ``run``
gives one of the reports of ``operators.reports`` over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import reports
from . import pipeline

REPORTS = {
    "statuses": reports.status_summary,
    "years": reports.images_by_year,
    "categories": reports.category_distribution,
    "large_clusters": reports.clusters_larger_than,
    "near_duplicates": reports.near_dup_paths,
}


def register(spark: SparkSession, tables_dir: str, name: str = "images") -> DataFrame:
    view = pipeline.current(spark, tables_dir)
    view.createOrReplaceTempView(name)
    return view


def run(images: DataFrame, report: str) -> DataFrame:
    return REPORTS[report](images)
