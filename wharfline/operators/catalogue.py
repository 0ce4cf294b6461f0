"""Topics that are needed against topics that exist."""

from __future__ import annotations

from pyspark.sql import DataFrame


def needed_topics(routed: DataFrame, column: str = "topic") -> DataFrame:
    return routed.select(column).distinct()


def missing_topics(routed: DataFrame, catalogue: DataFrame, column: str = "topic") -> DataFrame:
    """Needed topics that do not exist yet, each once."""
    return needed_topics(routed, column).join(catalogue, column, "left_anti")


def present_topics(routed: DataFrame, catalogue: DataFrame, column: str = "topic") -> DataFrame:
    """Needed topics that exist already, each once."""
    return needed_topics(routed, column).join(catalogue, column, "left_semi")
