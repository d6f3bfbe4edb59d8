"""Classification metrics from logits.

``confusion`` is the only step over row-level data: it counts rows and sums
losses per (groups, label, prediction). Its output has at most one row per
pair of classes, so phases and splits are judged together in one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.types import ArrayType, StructType

from labelloom.functions.arrays import argmax, cross_entropy
from labelloom.storage import cut_lineage

# The names under which the metrics are reported.
METRIC_NAMES = (
    "accuracy",
    "f1_macro",
    "f1_weighted",
    "precision_macro",
    "recall_macro",
    "loss",
)


def first_logits(df: DataFrame, logits_col: str) -> Column:
    """The logit vector. A model may return several outputs per row, as a struct
    or as a list of vectors; the first one holds the logits."""
    kind = df.schema[logits_col].dataType
    column = F.col(logits_col)
    if isinstance(kind, StructType):
        return column[kind.names[0]]
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
        return F.get(column, F.lit(0))
    return column


def confusion(
    df: DataFrame,
    groups: Sequence[str] = ("phase", "split"),
    logits_col: str = "logits",
    label_col: str = "label",
) -> DataFrame:
    """``(groups, label, prediction, n, loss_sum, n_loss)``. Null logits fail the
    job; a row whose label is none of the logits has no loss."""
    logits = first_logits(df, logits_col)
    logits = F.when(logits.isNull(), F.raise_error(F.lit("logits must not be null"))).otherwise(logits)
    return (
        df.select(
            *groups,
            F.col(label_col).cast("int").alias("label"),
            argmax(logits).alias("prediction"),
            cross_entropy(logits, label_col).alias("loss"),
        )
        .groupBy(*groups, "label", "prediction")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss_sum"), F.count("loss").alias("n_loss"))
    )


def class_scores(cells: DataFrame, groups: Sequence[str] = ("phase", "split")) -> DataFrame:
    """Support, predictions, hits, precision, recall and F1 per class.

    Classes are those seen as a label or as a prediction. A score whose
    denominator is 0 is 0.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    roles = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)

    support, predicted, hits = F.col("support"), F.col("predicted"), F.col("hits")
    return (
        cells.select(*groups, F.inline(roles))
        .groupBy(*groups, "class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
        .withColumns(
            {
                "precision": ratio(hits, predicted),
                "recall": ratio(hits, support),
                "f1": ratio(2 * hits, support + predicted),
            }
        )
    )


def metric_table(
    cells: DataFrame, groups: Sequence[str] = ("phase", "split"), with_loss: bool = True
) -> DataFrame:
    """``(groups, metric, value)`` in long form."""
    scores = class_scores(cells, groups).groupBy(*groups).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )
    table = scores.unpivot(list(groups), list(METRIC_NAMES[:5]), "metric", "value")
    if with_loss:
        outside = F.raise_error(F.lit("the loss is undefined: some labels are none of the logits"))
        mean = F.sum("loss_sum") / F.sum("n_loss")
        loss = cells.groupBy(*groups).agg(
            F.when(F.sum("n_loss") < F.sum("n"), outside).otherwise(mean).alias("loss")
        )
        table = table.unionByName(loss.unpivot(list(groups), ["loss"], "metric", "value"))
    return table


def compute_metrics(
    df: DataFrame, logits_col: str = "logits", label_col: str = "label"
) -> DataFrame:
    """The five scores of one set of predictions, as ``(metric, value)``."""
    tagged = df.withColumn("all", F.lit(1))
    cells = confusion(tagged, ["all"], logits_col, label_col)
    return metric_table(cells, ["all"], with_loss=False).drop("all")


def evaluate_splits(
    predictions: DataFrame,
    splits: Sequence[str] = ("validation", "test"),
    max_eval_samples: int | None = None,
    id_col: str = "row_id",
    logits_col: str = "logits",
    label_col: str = "label",
) -> DataFrame:
    """``(phase, split, metric, value)`` for the named splits, which must exist.

    All phases and splits share one pass and one aggregation. Its result, at
    most one row per pair of classes, is materialised: the check for absent
    splits and the metrics read that, not the predictions.
    """
    wanted = predictions.where(F.col("split").isin(list(splits)))
    if max_eval_samples is not None:
        wanted = first_rows_per_group(wanted, max_eval_samples, ("phase", "split"), id_col)
    cells = cut_lineage(confusion(wanted, ("phase", "split"), logits_col, label_col))
    present = {row["split"] for row in cells.select("split").distinct().collect()}
    for name in splits:
        if name not in present:
            raise KeyError(f"no predictions for split {name!r}")
    return metric_table(cells)


def first_rows_per_group(
    df: DataFrame, n: int, groups: Sequence[str], id_col: str = "row_id"
) -> DataFrame:
    """First ``n`` rows of each group. The rank is cut before the shuffle too, so
    a task passes on at most ``n`` rows of a group."""
    order = Window.partitionBy(*groups).orderBy(id_col)
    return df.withColumn("place_in_group", F.row_number().over(order)).where(
        F.col("place_in_group") <= n
    ).drop("place_in_group")


def clean_metric_names(metrics: DataFrame) -> DataFrame:
    """Drop metrics without a numeric value and remove ``<split>_`` from the
    names, wherever it occurs in them."""
    return metrics.where(F.col("value").isNotNull()).withColumn(
        "metric", F.replace("metric", F.concat("split", F.lit("_")), F.lit(""))
    )


def compare_evaluations(
    metrics: DataFrame,
    baseline: str = "baseline",
    after: str = "after_lora",
    primary_metric: str = "f1_macro",
) -> DataFrame:
    """``after - baseline`` for each split and metric present in both phases."""
    before = metrics.where(F.col("phase") == baseline).select(
        "split", "metric", F.col("value").alias("baseline")
    )
    later = metrics.where(F.col("phase") == after).select(
        "split", "metric", F.col("value").alias("after")
    )
    return before.join(later, ["split", "metric"]).select(
        "split",
        "metric",
        "baseline",
        "after",
        (F.col("after") - F.col("baseline")).alias("delta"),
        (F.col("metric") == primary_metric).alias("is_primary"),
    )
