"""Train a text classifier and compare it with an untrained one.

The large-model fine-tuning loop has no place on Spark; what is kept is the
shape of the job: judge before, train on the train split, judge after on the
same splits, and report the differences.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.metrics import compare_evaluations, evaluate_splits
from labelloom.operators.tokens import tokenize
from labelloom.sources.writers import comparison_document, write_comparison
from labelloom.storage import cut_lineage, write_table

MODEL_ID = "tfidf-logistic-regression"


@dataclass(frozen=True)
class Comparison:
    metrics: DataFrame  # phase, split, metric, value
    delta: DataFrame
    model: PipelineModel | NaiveBayes


def prior_logits(train: DataFrame, num_labels: int) -> list[float]:
    """Log of the share of each class in train: the logits of a predictor that
    has not read any text, and always names the largest class. One number per
    class, like the intercepts of the model itself."""
    counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    outside = sorted(k for k in counts if k is None or not 0 <= k < num_labels) if None not in counts else [None]
    if outside:
        raise ValueError(f"labels outside 0..{num_labels - 1} in train: {outside}")
    total = sum(counts.values()) + num_labels
    return [math.log((counts.get(i, 0) + 1) / total) for i in range(num_labels)]


def fit_text_classifier(
    train: DataFrame, num_features: int = 1 << 16, max_iter: int = 20, reg: float = 0.01
) -> PipelineModel:
    """TF-IDF and multinomial logistic regression over ``(input_ids, label)``.

    Both fits read the term counts, so these are kept; a lost block is counted
    again from its tokens.
    """
    terms = HashingTF(inputCol="input_ids", outputCol="tf", numFeatures=num_features)
    counted = terms.transform(train).select("tf", "label").persist()
    try:
        idf = IDF(inputCol="tf", outputCol="features").fit(counted)
        regression = LogisticRegression(
            featuresCol="features",
            labelCol="label",
            family="multinomial",
            maxIter=max_iter,
            regParam=reg,
        ).fit(idf.transform(counted))
    finally:
        counted.unpersist()
    return PipelineModel([terms, idf, regression])


@dataclass(frozen=True)
class NaiveBayes:
    """Multinomial naive Bayes with add-one smoothing, in closed form.

    ``words`` holds ``(token, logs)``, a value per class; tokens that train
    lacks say nothing.
    """

    priors: list[float]
    words: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``logits``. Tokens are counted per row before they are
        joined, and scores are summed before they are shuffled by row."""
        k = len(self.priors)
        counted = df.select("row_id", F.explode("input_ids").alias("token")).groupBy("row_id", "token").agg(
            F.count(F.lit(1)).alias("n")
        )
        sums = [F.sum(F.col("n") * F.col("logs")[i]).alias(f"s{i}") for i in range(k)]
        scores = counted.join(self.words, "token").groupBy("row_id").agg(*sums)
        logits = F.array(*[F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(p) for i, p in enumerate(self.priors)])
        return df.join(scores, "row_id", "left").withColumn("logits", logits).drop(*[f"s{i}" for i in range(k)])

    def save(self, path: str) -> None:
        spark = self.words.sparkSession
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        priors = spark.createDataFrame([(self.priors,)], "priors array<double>")
        priors.write.mode("overwrite").parquet(f"{path}/priors")


def fit_naive_bayes(train: DataFrame, num_labels: int) -> NaiveBayes:
    """From ``(input_ids, label)``. Token counts combine before the shuffle; a
    row per token is kept, a number per class reaches the driver."""
    tokens = train.select(F.explode("input_ids").alias("token"), F.col("label").cast("int").alias("label"))
    per_class = [F.count_if(F.col("label") == i) for i in range(num_labels)]
    counts = write_table(tokens.groupBy("token").agg(F.array(*per_class).alias("counts")), "token_counts")
    sizes = counts.agg(F.count(F.lit(1)), *[F.sum(F.col("counts")[i]) for i in range(num_labels)]).first()
    vocabulary, totals = sizes[0], [s or 0 for s in sizes[1:]]
    logs = F.array(
        *[F.log((F.col("counts")[i] + 1.0) / F.lit(float(t + vocabulary or 1))) for i, t in enumerate(totals)]
    )
    return NaiveBayes(prior_logits(train.withColumn("label", F.col("label").cast("int")), num_labels), counts.select("token", logs.alias("logs")))


def baseline_predictions(splits: DataFrame, judged: DataFrame, num_labels: int) -> DataFrame:
    """The rows of ``judged`` with the same prior logits in each."""
    priors = prior_logits(splits.where(F.col("split") == "train"), num_labels)
    return judged.select(
        "row_id", "split", "label", F.lit(priors).alias("logits"), F.lit("baseline").alias("phase")
    )


def train_and_compare(
    splits: DataFrame,
    num_labels: int,
    eval_splits: Sequence[str] = ("validation", "test"),
    max_eval_samples: int | None = None,
    max_length: int | None = None,
    run_baseline: bool = True,
    primary_metric: str = "f1_macro",
    fit: Callable[[DataFrame], PipelineModel | NaiveBayes] = fit_text_classifier,
    out_dir: str | None = None,
    comparison_filename: str = "evaluation_comparison.json",
) -> Comparison:
    """``splits`` holds ``(row_id, text, label, split)`` with labels 0..K-1.

    ``fit`` gets ``(input_ids, label)`` of the train split and returns a model
    that adds a ``rawPrediction`` vector or ``logits``. Labels outside the
    range fail the job. Texts are whole unless ``max_length``
    asks for the first tokens only.
    """
    judged = splits.where(F.col("split").isin(list(eval_splits)))
    tokenized = tokenize(splits, max_length)
    model = fit(
        tokenized.where(F.col("split") == "train").select(
            "input_ids", F.col("label").cast("double")
        )
    )
    judged_by = model.transform(tokenized.where(F.col("split").isin(list(eval_splits))))
    logits = F.col("logits") if "logits" in judged_by.columns else vector_to_array("rawPrediction")
    predictions = judged_by.select(
        "row_id",
        "split",
        "label",
        logits.alias("logits"),
        F.lit("after_lora").alias("phase"),
    )
    if run_baseline:
        predictions = predictions.unionByName(baseline_predictions(splits, judged, num_labels))
    # A few dozen rows; materialised so that the model is applied once.
    metrics = cut_lineage(evaluate_splits(predictions, eval_splits, max_eval_samples))
    delta = compare_evaluations(metrics, primary_metric=primary_metric)
    if out_dir is not None:
        base = out_dir.rstrip("/")
        if isinstance(model, NaiveBayes):
            model.save(f"{base}/model")
        else:
            model.write().overwrite().save(f"{base}/model")
        document = comparison_document(metrics, delta, MODEL_ID, num_labels)
        write_comparison(document, f"{base}/{comparison_filename}")
    return Comparison(metrics, delta, model)
