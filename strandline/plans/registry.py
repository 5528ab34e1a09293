"""Every registered query of the engine's own operators, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.plans import base, breaks, events, fragments, intervals, layout, matching, models, overlap, phasing, reads, records, scalars, sessions, sinks, statistics, support, targets, tracks  # noqa: F401  each registers its queries


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules by gap sessions."""
    return sessions.session_molecules(spark, sf_dir)
