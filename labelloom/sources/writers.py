"""Writing splits, label maps and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_COLUMNS = ("text", "category", "label")
SPLIT_FOLDER = "splits"
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_splits(
    df: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    layout: str | None = None,
    columns: Sequence[str] = SPLIT_COLUMNS,
) -> None:
    """Write the columns of each split, with its ``row_id`` if it has one.

    ``partitioned``, the default for parquet, writes ``splits/split=<name>``
    folders in one pass over the data; other files of ``out_dir`` stay.
    ``per_split``, the default for CSV, writes ``<name>.<fmt>`` for readers that
    expect one path per split; it costs one pass per split.
    """
    if layout is None:
        layout = "partitioned" if fmt == "parquet" else "per_split"
    columns = [*[c for c in ("row_id",) if c in df.columns], *columns]
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    if layout == "partitioned" and fmt != "parquet":
        raise ValueError("the partitioned layout is parquet only; use per_split for CSV")
    if layout == "partitioned":
        df.select(*columns, "split").write.mode("overwrite").partitionBy("split").parquet(
            f"{out_dir.rstrip('/')}/{SPLIT_FOLDER}"
        )
    elif layout == "per_split":
        for row in df.select("split").distinct().orderBy("split").toLocalIterator():
            name = row["split"]
            part = df.where(F.col("split") == name).select(*columns)
            path = f"{out_dir.rstrip('/')}/{name}.{fmt}"
            if fmt == "csv":
                write_csv(part, path)
            else:
                part.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """CSV with a header, doubled quotes, and texts as they are: Spark would
    trim them by default."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", quote_all)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_label_map(dim: DataFrame, path: str) -> None:
    """``{"label2id": {name: id}, "id2label": {"id": name}}`` on one line.

    The vocabulary has one entry per class and becomes one row.
    """
    pairs = F.array_sort(F.collect_list(F.struct("label", "category")))
    entries = dim.coalesce(1).agg(pairs.alias("p"))
    maps = entries.select(
        F.map_from_entries(
            F.transform("p", lambda x: F.struct(x["category"], x["label"]))
        ).alias("label2id"),
        F.map_from_entries(
            F.transform("p", lambda x: F.struct(x["label"].cast("string"), x["category"]))
        ).alias("id2label"),
    )
    maps.write.mode("overwrite").json(path)


def write_stats_csv(stats: DataFrame, path: str) -> None:
    """Per-class statistics as one CSV file (one row per class)."""
    write_csv(stats.coalesce(1), path)


def comparison_document(
    metrics: DataFrame,
    delta: DataFrame,
    model_id: str,
    num_labels: int,
    baseline: str = "baseline",
    after: str = "after_lora",
) -> DataFrame:
    """One row ``{model_id, num_labels, baseline, after_lora, delta}`` with
    ``split -> metric -> value`` maps, from long metric tables of a few rows."""
    rows = metrics.where(F.col("phase").isin(baseline, after)).select(
        F.when(F.col("phase") == baseline, "baseline").otherwise("after_lora").alias("part"),
        "split",
        "metric",
        "value",
    )
    rows = rows.unionByName(
        delta.select(F.lit("delta").alias("part"), "split", "metric", F.col("delta").alias("value"))
    )
    per_split = rows.groupBy("part", "split").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("m")
    )
    split_map = F.array_sort(
        F.collect_list(F.struct("part", "split", "m")),
        lambda a, b: F.when(a["split"] < b["split"], -1).when(a["split"] > b["split"], 1).otherwise(0),
    )

    def section(name: str):
        mine = F.filter("all", lambda x: x["part"] == name)
        return F.map_from_entries(F.transform(mine, lambda x: F.struct(x["split"], x["m"]))).alias(name)

    return per_split.agg(split_map.alias("all")).select(
        F.lit(model_id).alias("model_id"),
        F.lit(num_labels).alias("num_labels"),
        section("baseline"),
        section("after_lora"),
        section("delta"),
    )


def write_comparison(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").json(path)


def write_eval_log(log: DataFrame, path: str, phase_col: str = "phase") -> None:
    """Append an evaluation log as JSON lines, a folder a phase: question,
    response, time and model version of every answer."""
    log.write.mode("append").option("timestampNTZFormat", LOG_TIME).partitionBy(phase_col).json(path)


def write_stage(df: DataFrame, base: str, stage: str, domain_col: str = "domain") -> None:
    """Parquet under ``base/stage``, a folder a domain. The domains of ``df``
    replace what their folders held; the folders of others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(domain_col).parquet(f"{base.rstrip('/')}/{stage}")
