"""Whole jobs: read the source tables, write the feature table, score what was written, write the results.

Each job stores its steps in a run folder that is removed at the end, and returns the names of the tables it wrote.
``tables`` names the source tables by their part in the job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from leadloom.plans import conversion, lead, topup
from leadloom.plans.outputs import write_results
from leadloom.session import run_folder
from leadloom.sources.tables import read_table, write_table


def prepared(features: DataFrame, target: Mapping[str, str], name: str) -> DataFrame:
    """Write a feature table and read it back, so that scores rest on what is stored."""
    write_table(features, target, name)
    return read_table(features.sparkSession, target, name)


def _job(spark: SparkSession, target: Mapping[str, str], prefix: str, make: Callable[[], DataFrame], score: Callable[[DataFrame], object]) -> list[str]:
    name = f"{prefix}_features"
    with run_folder(spark):
        table = prepared(make(), target, name)
        return [name, *write_results(score(table), target, prefix)]


def _event_sources(spark: SparkSession, source: Mapping[str, str], tables: Mapping[str, str]) -> list[DataFrame]:
    return [read_table(spark, source, tables[part]) for part in ("contacts", "meetings", "calls")]


def lead_job(
    spark: SparkSession, source: Mapping[str, str], target: Mapping[str, str], tables: Mapping[str, str], as_of: datetime,
    cfg: lead.LeadConfig, prefix: str = "lead", **scoring,
) -> list[str]:
    """Score the leads of the tables ``contacts``, ``meetings`` and ``calls``; ``scoring`` goes to ``lead_scores``."""
    return _job(
        spark, target, prefix,
        lambda: lead.lead_features(*_event_sources(spark, source, tables), as_of, cfg),
        lambda table: lead.lead_scores(table, as_of, cfg.key, **scoring),
    )


def conversion_job(
    spark: SparkSession, source: Mapping[str, str], target: Mapping[str, str], tables: Mapping[str, str], as_of: datetime,
    cfg: conversion.ConversionConfig, prefix: str = "conversion", **scoring,
) -> list[str]:
    """Score the prospects of the tables ``contacts``, ``meetings`` and ``calls``; ``scoring`` goes to ``conversion_scores``."""
    return _job(
        spark, target, prefix,
        lambda: conversion.conversion_features(*_event_sources(spark, source, tables), as_of, cfg),
        lambda table: conversion.conversion_scores(table, as_of, cfg.key, **scoring),
    )


def topup_job(
    spark: SparkSession, source: Mapping[str, str], target: Mapping[str, str], tables: Mapping[str, str], as_of: datetime,
    instruction: str, prefix: str = "topup", segments: int = 4, restarts: int = 10, **scoring,
) -> list[str]:
    """Score the clients of the table ``clients``, which also describes them; ``scoring`` goes to ``topup_scores``."""
    clients = read_table(spark, source, tables["clients"])
    return _job(
        spark, target, prefix,
        lambda: topup.topup_features(clients, as_of, segments, restarts),
        lambda table: topup.topup_scores(table, clients, instruction, **scoring),
    )
