"""Reading raw and processed labelled tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.labels import DEFAULT_LABELS, label_dim
from labelloom.operators.guards import require_columns
from labelloom.operators.ranking import first_rows
from labelloom.sources.writers import LOG_TIME
from labelloom.operators.sizing import broadcast_if_small
from labelloom.schema import LABEL_MAP, SPLITS


def with_row_id(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Add a unique, increasing id to rows that have no key of their own.

    Ids follow the scan order, so within one file they follow the file. They
    depend on how the scan is cut into partitions: land the table once
    (``land_raw``) and read the ids back to fix them for good.
    """
    return df if id_col in df.columns else df.withColumn(id_col, F.monotonically_increasing_id())


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool = True,
    strict: bool = False,
) -> DataFrame:
    """CSV with a header. All columns are strings, header names are trimmed,
    and quotes inside a quoted field are doubled.

    Empty fields, quoted or not, are null. ``strict`` skips blanks after the
    delimiter and makes them empty strings. ``multi_line``
    lets a quoted text contain line breaks, at the price of one task per file;
    turn it off for large files without such texts. A row with too few or too
    many fields fails the job.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", strict)
    )
    df = reader.csv(path if isinstance(path, str) else list(path))
    df = df.toDF(*[c.strip() for c in df.columns])
    if strict:
        df = df.select([F.coalesce(c, F.lit("")).alias(c) for c in df.columns])
    return with_row_id(df)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if there is none or only the remains of
    an unfinished write."""
    try:
        return spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the write of the table at ``path`` ended: its marker is there."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(marker.getFileSystem(conf).exists(marker))


def land_raw(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet unless a whole table is there already, and read
    it back. What a broken write has left is written anew.

    Texts are parsed once and row ids are fixed; later runs start from columns.
    """
    spark = df.sparkSession
    if not is_complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def locate_splits(
    spark: SparkSession, data_dir: str, splits: Sequence[str] = SPLITS
) -> dict[str, DataFrame]:
    """Each split under ``data_dir``: ``<split>.parquet``, else ``<split>.csv``,
    else the partition folder ``splits/split=<split>``. A split found nowhere is an
    error."""
    found: dict[str, DataFrame] = {}
    base = data_dir.rstrip("/")
    for name in splits:
        for path, fmt in (
            (f"{base}/{name}.parquet", "parquet"),
            (f"{base}/{name}.csv", "csv"),
            (f"{base}/splits/split={name}", "parquet"),
            (f"{base}/split={name}", "parquet"),
        ):
            df = read_if_present(spark, path, fmt)
            if df is not None:
                found[name] = df
                break
        else:
            raise FileNotFoundError(
                f"no {name} split in {data_dir}: looked for {name}.parquet, {name}.csv "
                f"and split={name}, which the preprocess job writes"
            )
    return found


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """``(label, category)`` from a label map in JSON; ids are cast to
    integers. A missing file gives the default vocabulary."""
    try:
        raw = spark.read.schema(LABEL_MAP).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return label_dim(spark)
    dim = raw.select(F.explode("label2id").alias("category", "label")).select("label", "category")
    names = raw.select(F.explode("id2label").alias("id", "name"))
    # A few rows per map; a map without the second part is taken as it is.
    differs = dim.join(names, F.col("id").cast("long") == F.col("label"), "full").where(
        ~F.col("category").eqNullSafe(F.col("name"))
    )
    if not names.isEmpty() and not differs.isEmpty():
        raise ValueError(f"label2id and id2label of {path} disagree")
    return broadcast_if_small(dim)


def load_processed(
    spark: SparkSession,
    data_dir: str,
    label_mapping_file: str = "label_mapping.json",
    max_train_samples: int | None = None,
    expected_labels: int | None = len(DEFAULT_LABELS),
) -> tuple[DataFrame, DataFrame, int]:
    """All splits as one table with a ``split`` column, the label dimension
    and the number of labels.

    Checks that each split has a text and a label and that the map has the
    expected size (None: any size).
    """
    tables = locate_splits(spark, data_dir)
    dim = read_label_map(spark, f"{data_dir.rstrip('/')}/{label_mapping_file}")
    n_labels = dim.count()
    stacked: DataFrame | None = None
    for name, df in tables.items():
        require_columns(df, ("label", "text"), name)
        df = with_row_id(df).select(
            F.lit(name).alias("split"),
            F.col("row_id").cast("long").alias("row_id"),
            "text",
            *[c for c in ("category",) if c in df.columns],
            F.col("label").cast("long").alias("label"),
        )
        if name == "train":
            df = first_rows(df, max_train_samples)
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    if expected_labels is not None and n_labels != expected_labels:
        raise ValueError(f"the label map has {n_labels} labels, not {expected_labels}")
    return stacked, dim, n_labels


EVAL_LOG = "question_id long, question string, response string, asked_at timestamp_ntz, model_version string, phase string"


def read_eval_log(spark: SparkSession, path: str, schema: str = EVAL_LOG) -> DataFrame:
    """An evaluation log of JSON lines; the phase is read from the folder."""
    return spark.read.schema(schema).option("timestampNTZFormat", LOG_TIME).json(path)


def read_stage(spark: SparkSession, base: str, stage: str, domain_col: str = "domain", domain: str | None = None) -> DataFrame:
    """The table of a stage; with ``domain`` only that folder is listed."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{stage}")
    return df if domain is None else df.where(F.col(domain_col) == domain)


def read_captured(spark: SparkSession, path: str, schema) -> DataFrame:
    """Captured requests and responses as JSON lines. A line that doesn't fit
    the schema fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
