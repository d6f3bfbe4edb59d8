"""Profile a train/test pair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from labelloom.operators import profile
from labelloom.operators.quality import quality_checks
from labelloom.sources.writers import write_stats_csv
from labelloom.storage import cut_lineage


@dataclass(frozen=True)
class Profile:
    checks: DataFrame
    stats: DataFrame
    imbalance: DataFrame
    lengths: DataFrame
    histogram: DataFrame
    distribution: DataFrame
    longest_classes: DataFrame


def run_eda(pair: DataFrame, out_dir: str | None = None, top_n: int = 20) -> Profile:
    """All reports over ``(text, category, split)``.

    The texts are read twice: once for the length table, which is materialised
    and feeds every report but one, and once for the comparison keys of the
    quality checks.
    """
    table = cut_lineage(profile.length_table(pair))
    stats = profile.per_class_stats(table)
    if out_dir is not None:
        write_stats_csv(stats, f"{out_dir.rstrip('/')}/eda_summary.csv")
    return Profile(
        checks=quality_checks(pair),
        stats=stats,
        imbalance=profile.imbalance(table),
        lengths=profile.length_summary(table),
        histogram=profile.length_histogram(table),
        distribution=profile.class_distribution(table, ascending=True),
        longest_classes=profile.top_classes_by_length(table, top_n, ascending=True),
    )
