"""

Every query reads a whole table; the SQL beside it states the same result
independently for DuckDB.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, str(Path(__file__).resolve().parent))

from labelloom.functions.arrays import argmax  # noqa: E402
from labelloom.functions.labels import decode_labels, encode_labels, label_dim  # noqa: E402
from labelloom.functions.text import clean_text, compare_key, word_count  # noqa: E402
from labelloom.operators import (  # noqa: E402
    cache,
    clusters,
    dedup,
    guardrails,
    guards,
    metrics,
    monitoring,
    prepare,
    profile,
    quality,
    ranking,
    similarity,
    splitting,
    tokens,
)
from labelloom.config import JobConfig  # noqa: E402
from labelloom.plans.batches import evaluation_batches  # noqa: E402
from labelloom.plans.eda import run_eda  # noqa: E402
from labelloom.plans.load import load_labelled_pair, stack_splits  # noqa: E402
from labelloom.plans.preprocess import preprocess  # noqa: E402
from labelloom.plans.train import baseline_predictions, fit_naive_bayes, train_and_compare  # noqa: E402
from labelloom.plans.views import (  # noqa: E402
    LANGS,
    labelled_documents,
    predictions,
    quality_splits,
)
from labelloom.sources import readers, writers  # noqa: E402
from labelloom.storage import scratch_path, write_table  # noqa: E402
from labelloom.streaming.drift import drift_per_batch  # noqa: E402
from labelloom.streaming.landing import land_checked, land_new_files, stream_files  # noqa: E402
from labelloom.streaming.windows import land_closed_windows, windowed_stats  # noqa: E402

try:  # the one optional part of the library
    llm_queries = importlib.import_module("labelloom.llm.queries")
except ModuleNotFoundError as missing:
    if missing.name not in ("labelloom.llm", "labelloom.llm.queries"):
        raise  # it is there, but broken
    llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

VAL_SIZE, SEED = 0.1, 42
PARTIAL_VOCABULARY = ("en", "fr", "it")  # lacks de and es, has an unused name
FIRST_N = 250
MAX_TOKENS = 64
LARGE_VALUE = 20
FEEDBACK_SECONDS = 4 * 3_600
REWRITTEN = "fr"
BATCH = 8


def by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(spark, sf_dir, "source")


def by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(spark, sf_dir, "lang")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_labels(by_lang(spark, sf_dir), label_dim(spark, LANGS))


def cleaned_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = encoded(spark, sf_dir).where(F.col("split") == "train").drop("split")
    return train.withColumn("text", clean_text("text"))


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_table(by_source(spark, sf_dir))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_table(by_source(spark, sf_dir))


def round6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- text, labels, guards -------------------------------------------------


def q_clean_text(spark, sf):
    return by_source(spark, sf).select("row_id", clean_text("text").alias("clean"))


def q_compare_key(spark, sf):
    return by_source(spark, sf).select("row_id", compare_key("text").alias("key"))


def q_word_count(spark, sf):
    return by_source(spark, sf).select("row_id", word_count("text").cast("long").alias("n_words"))


def q_label_encode(spark, sf):
    return encoded(spark, sf).select("row_id", "category", "label")


def q_label_decode(spark, sf):
    dim = label_dim(spark, LANGS)
    ids = encoded(spark, sf).select("row_id", "label")
    return decode_labels(ids, dim).select("row_id", "label", "category")


def q_training_columns(spark, sf):
    return encoded(spark, sf).select("text", "category", "label")


def q_unknown_labels(spark, sf):
    return guards.unknown_labels(by_lang(spark, sf), label_dim(spark, PARTIAL_VOCABULARY))


def q_missing_labels(spark, sf):
    dim = label_dim(spark, PARTIAL_VOCABULARY)
    return guards.missing_labels(
        encode_labels(by_lang(spark, sf), dim), dim, ("train", "validation", "test")
    )


def q_label_coverage(spark, sf):
    return guards.label_coverage(
        by_lang(spark, sf), label_dim(spark, PARTIAL_VOCABULARY), ("train", "test")
    )


def q_text_problems(spark, sf):
    return guards.text_problems(by_source(spark, sf))


# --- de-duplication, splits, first rows -------------------------------------


def q_dedup_exact(spark, sf):
    return dedup.deduplicate(cleaned_train(spark, sf)).select("row_id", "text", "label")


def q_dedup_removed(spark, sf):
    return dedup.duplicate_count(cleaned_train(spark, sf))


def q_stratified_split(spark, sf):
    # Ids and labels only; read several times by the split, so materialised.
    rows = write_table(dedup.first_ids(cleaned_train(spark, sf)), "firsts")
    return splitting.stratified_split(rows, VAL_SIZE, SEED).select("row_id", "label", "split")


def q_split_summary(spark, sf):
    return splitting.split_summary(q_stratified_split(spark, sf))


def q_split_quotas(spark, sf):
    rows = encoded(spark, sf).where(F.col("split") == "train")
    return splitting.validation_cutoffs(rows, VAL_SIZE, SEED).select("label", "n", "n_val")


def q_first_n(spark, sf):
    train = by_source(spark, sf).where(F.col("split") == "train")
    return ranking.first_rows(train, FIRST_N).select("row_id", "text")


def q_preview_head(spark, sf):
    return ranking.preview(by_source(spark, sf)).select("row_id", "text", "category")


def q_stack_splits(spark, sf):
    documents = by_source(spark, sf)
    parts = {s: documents.where(F.col("split") == s).drop("split") for s in ("train", "test")}
    return stack_splits(**parts)


# --- profile ----------------------------------------------------------------


def q_per_class_stats(spark, sf):
    return profile.per_class_stats(lengths(spark, sf))


def q_quality_checks(spark, sf):
    return quality.quality_checks(by_source(spark, sf))


def q_split_sizes(spark, sf):
    return profile.split_sizes(classes(spark, sf))


def q_class_distribution(spark, sf):
    return profile.class_distribution(classes(spark, sf))


def q_imbalance(spark, sf):
    return round6(profile.imbalance(classes(spark, sf)), "imbalance_ratio")


def q_length_summary(spark, sf):
    return round6(
        profile.length_summary(lengths(spark, sf)), "mean_words", "median_words", "p95_words"
    )


def q_length_histogram(spark, sf):
    return round6(profile.length_histogram(lengths(spark, sf)), "bin_start", "bin_end")


def q_top_classes_by_length(spark, sf):
    return round6(profile.top_classes_by_length(lengths(spark, sf), 10), "avg_words")


def q_eda_report(spark, sf):
    """The whole profile job; its reports in one long table."""
    report = run_eda(by_source(spark, sf), top_n=10)
    stats = F.array(
        *[
            F.struct(F.lit(f"stats {name}").alias("report"), F.col(name).cast("double").alias("value"))
            for name in report.stats.columns
            if name != "category"
        ]
    )
    bin_name = F.concat_ws(" ", "split", F.col("bin").cast("string"))
    lengths_of = F.array(
        *[
            F.struct(F.lit(f"length {name}").alias("report"), F.round(F.col(f"{name}_words").cast("double"), 6).alias("value"))
            for name in ("mean", "median", "p95", "max")
        ]
    )
    ends = F.array(
        F.struct(F.lit("largest").alias("report"), F.col("largest_class").alias("item"), F.col("largest_count").cast("double").alias("value")),
        F.struct(F.lit("smallest").alias("report"), F.col("smallest_class").alias("item"), F.col("smallest_count").cast("double").alias("value")),
        F.struct(F.lit("ratio").alias("report"), F.lit("imbalance").alias("item"), F.round("imbalance_ratio", 6).alias("value")),
    )
    parts = [
        report.checks.select(
            F.lit("checks").alias("report"), F.col("check").alias("item"),
            F.col("value").cast("double").alias("value"),
        ),
        report.distribution.select(
            F.lit("distribution"), F.col("category"), F.col("n_rows").cast("double")
        ),
        report.longest_classes.select(F.lit("longest"), "category", F.round("avg_words", 6)),
        report.lengths.select("split", F.inline(lengths_of)).select("report", "split", "value"),
        report.stats.select("category", F.inline(stats)).where("value IS NOT NULL").select("report", "category", "value"),
        report.histogram.select(F.lit("histogram"), bin_name, F.col("n_rows").cast("double")),
        report.imbalance.select(F.inline(ends)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


# --- metrics ------------------------------------------------------------------


def q_confusion(spark, sf):
    cells = metrics.confusion(predictions(spark, sf))
    return cells.select(
        "phase", "split", "label", "prediction", "n", F.round("loss_sum", 6).alias("loss_sum")
    )


def q_class_scores(spark, sf):
    scores = metrics.class_scores(metrics.confusion(predictions(spark, sf)))
    return round6(scores, "precision", "recall", "f1")


def q_eval_metrics(spark, sf):
    both = predictions(spark, sf)
    tables = [
        metrics.compute_metrics(both.where(F.col("phase") == phase)).withColumn("phase", F.lit(phase))
        for phase in ("baseline", "after_lora")
    ]
    return round6(tables[0].unionByName(tables[1]), "value")


def q_eval_loss(spark, sf):
    table = metrics.metric_table(metrics.confusion(predictions(spark, sf)))
    return round6(table.where(F.col("metric") == "loss"), "value")


def q_evaluate_splits(spark, sf):
    return round6(metrics.evaluate_splits(predictions(spark, sf)), "value")


def q_evaluate_first_rows(spark, sf):
    table = metrics.evaluate_splits(predictions(spark, sf), max_eval_samples=100)
    return round6(table, "value")


def q_clean_metric_names(spark, sf):
    table = metrics.evaluate_splits(predictions(spark, sf))
    raw = table.withColumn("metric", F.concat_ws("_", "split", "metric"))
    timed = raw.unionByName(
        raw.withColumns({"metric": F.lit("note"), "value": F.lit(None).cast("double")})
    )
    return round6(metrics.clean_metric_names(timed), "value")


def q_compare_evals(spark, sf):
    table = metrics.evaluate_splits(predictions(spark, sf))
    return round6(metrics.compare_evaluations(table), "baseline", "after", "delta")


# --- tokens ---------------------------------------------------------------------


def q_tokenize(spark, sf):
    out = tokens.tokenize(encoded(spark, sf), max_length=None)
    return out.select(
        "row_id",
        "labels",
        F.array_join("input_ids", " ").alias("tokens"),
        F.size("attention_mask").cast("long").alias("n_tokens"),
    )


def q_truncate_tokens(spark, sf):
    out = tokens.tokenize(encoded(spark, sf), max_length=MAX_TOKENS)
    return out.select(
        "row_id",
        F.array_join("input_ids", " ").alias("tokens"),
        F.size("input_ids").cast("long").alias("n_tokens"),
    )


def word_lengths(texts: list[str]) -> list[list[int]]:
    """A stand-in tokenizer with checkable ids."""
    return [[len(word) for word in text.split()] for text in texts]


def q_tokenize_custom(spark, sf):
    out = tokens.tokenize(encoded(spark, sf), max_length=None, tokenizer=word_lengths)
    return out.select("row_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"))


def q_pad_batches(spark, sf):
    whole = tokens.tokenize(encoded(spark, sf), max_length=None)
    out = tokens.pad_batches(whole.select("row_id", "input_ids"), BATCH, "[PAD]")
    return out.select(
        "row_id",
        "batch_id",
        F.array_join("input_ids", " ").alias("tokens"),
        F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("mask"),
    )


def q_pad_batches_left(spark, sf):
    whole = tokens.tokenize(encoded(spark, sf), max_length=None)
    inputs = whole.select("row_id", "input_ids")
    out = tokens.pad_batches(inputs, BATCH, "[PAD]", side="left")
    return out.select("row_id", "batch_id", F.array_join("input_ids", " ").alias("tokens"))


def q_evaluation_batches(spark, sf):
    splits = encoded(spark, sf)
    config = JobConfig(padding_side="left", eval_splits=("train", "test"))
    out = evaluation_batches(splits, config, max_length=None)
    return out.select("row_id", "split", "batch_id", F.array_join("input_ids", " ").alias("tokens"))


# --- sources, sinks and whole jobs --------------------------------------------------


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(by_source(spark, sf).select("text", "category"), path)
    return readers.read_csv(spark, path).select("text", "category")


def q_csv_strict(spark, sf):
    path = scratch_path(spark, "csv-quoted")
    writers.write_csv(by_source(spark, sf).select("text", "category"), path, quote_all=True)
    return readers.read_csv(spark, path, strict=True).select("text", "category")


def q_land_raw(spark, sf):
    """Landing twice gives the first table: the second source is not written."""
    path = scratch_path(spark, "raw")
    readers.land_raw(by_source(spark, sf).select("row_id", "text"), path)
    changed = by_source(spark, sf).select("row_id", F.lit("changed").alias("text"))
    return readers.land_raw(changed, path)


def q_load_labelled_pair(spark, sf):
    base = scratch_path(spark, "pair")
    documents = by_lang(spark, sf)
    for split in ("train", "test"):
        part = documents.where(F.col("split") == split)
        headed = part.select(F.col("text").alias(" text"), F.col("category").alias("category "))
        writers.write_csv(headed, f"{base}/{split}")
    pair = load_labelled_pair(
        spark, f"{base}/train", f"{base}/test", cache_dir=f"{base}/raw", labels=LANGS
    )
    return pair.select("text", "category", "label", "split")


def q_label_map_roundtrip(spark, sf):
    names = spark.read.parquet(f"{sf}/documents.parquet").select("source").distinct()
    # One row per class.
    dim = names.select(
        (F.row_number().over(Window.orderBy("source")) - 1).cast("long").alias("label"),
        F.col("source").alias("category"),
    )
    path = scratch_path(spark, "label_mapping.json")
    writers.write_label_map(dim, path)
    return readers.read_label_map(spark, path)


def q_preprocess_job(spark, sf):
    """Clean, de-duplicate, split, check, save - and read the saved splits back."""
    out = scratch_path(spark, "processed")
    preprocess(encoded(spark, sf), VAL_SIZE, SEED, out, labels=LANGS)
    splits, _, _ = readers.load_processed(spark, out, expected_labels=len(LANGS))
    return splits.select("text", "category", "label", "split")


def q_preprocess_summary(spark, sf):
    return preprocess(encoded(spark, sf), VAL_SIZE, SEED, labels=LANGS).summary


def q_preprocess_no_dedupe(spark, sf):
    done = preprocess(encoded(spark, sf), VAL_SIZE, SEED, dedupe=False, labels=LANGS)
    return done.splits.select("row_id", "label", "split")


def q_stats_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "eda_summary.csv")
    stats = profile.per_class_stats(lengths(spark, sf))
    writers.write_stats_csv(stats, path)
    return spark.read.schema(stats.schema).option("header", True).csv(path)


def q_comparison_json(spark, sf):
    """The comparison document written and read back, its sections as rows."""
    path = scratch_path(spark, "evaluation_comparison.json")
    table = metrics.evaluate_splits(predictions(spark, sf))
    document = writers.comparison_document(
        table, metrics.compare_evaluations(table), "fixture", 10
    )
    writers.write_comparison(document, path)
    back = spark.read.schema(document.schema).json(path)
    return back.select(
        "model_id", F.col("num_labels").cast("long").alias("num_labels"),
        F.explode(
            F.create_map(*[x for name in ("baseline", "after_lora", "delta") for x in (F.lit(name), F.col(name))])
        ).alias("section", "splits"),
    ).select(
        "model_id", "num_labels", "section", F.explode("splits").alias("split", "m")
    ).select(
        "model_id", "num_labels", "section", "split", F.explode("m").alias("metric", "value")
    ).withColumn("value", F.round("value", 6))


def q_untrained_baseline(spark, sf):
    """The first half of the next query: metrics of the predictor that only
    knows the class shares."""
    splits = quality_splits(spark, sf)
    judged = splits.where(F.col("split").isin("validation", "test"))
    table = metrics.evaluate_splits(baseline_predictions(splits, judged, 2))
    return round6(table, "value")


def q_train_text_classifier(spark, sf):
    result = train_and_compare(
        quality_splits(spark, sf), num_labels=2, fit=lambda train: fit_naive_bayes(train, 2)
    )
    return round6(result.delta, "baseline", "after", "delta")


def q_load_first_n(spark, sf):
    """Saved splits read back, with the first rows of train only."""
    path = scratch_path(spark, "processed")
    preprocess(encoded(spark, sf), VAL_SIZE, SEED, path, labels=LANGS)
    splits, _, _ = readers.load_processed(spark, path, max_train_samples=FIRST_N, expected_labels=len(LANGS))
    return splits.select("row_id", "split", "text", "category", "label")


def q_stream_landing(spark, sf):
    """Two runs over the same folder: the second finds nothing new."""
    base = scratch_path(spark, "stream")
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    files = stream_files(spark, sf, schema, pattern="documents.parquet")
    rows = files.select(F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("category"))
    dim = label_dim(spark, LANGS)
    for _ in range(2):
        landed = land_new_files(rows, dim, f"{base}/table", f"{base}/checkpoint")
    return landed.select("row_id", "text", "category", "label")


def q_stream_quarantine(spark, sf):
    """Every row of the stream: landed, or set apart with a reason."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    files = stream_files(spark, sf, schema, pattern="documents.parquet")
    rows = files.select(F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("category"))
    base = scratch_path(spark, "quarantine")
    done = land_checked(rows, label_dim(spark, PARTIAL_VOCABULARY), f"{base}/table", f"{base}/checkpoint")
    landed = done.landed.withColumn("reason", F.lit(None).cast("string"))
    return landed.unionByName(done.rejected).select("row_id", "text", "category", "label", "reason")


# --- examples for training ------------------------------------------------------------


def table_of(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def q_token_length_filter(spark, sf):
    return prepare.token_length_filter(by_lang(spark, sf), 100, 500).select("row_id", "n_tokens")


def q_sample_exact(spark, sf):
    return prepare.sample_exact(by_lang(spark, sf), 300, SEED).select("row_id", "text")


def q_stratified_sample(spark, sf):
    return prepare.stratified_sample(encoded(spark, sf), VAL_SIZE, SEED).select("row_id", "label")


def q_format_instruction(spark, sf):
    return prepare.format_instruction(table_of(spark, sf, "conversations"))


def q_format_chat(spark, sf):
    return prepare.format_chat(table_of(spark, sf, "conversations"))


def q_format_by_dataset(spark, sf):
    formats = {
        "en": lambda text: F.concat(F.lit("Question: "), text),
        "fr": lambda text: F.upper(F.trim(text)),
    }
    rows = by_lang(spark, sf).withColumn("dataset", F.col("category"))
    return prepare.format_by_dataset(rows, formats).select("row_id", "dataset", "text")


def q_dedup_by_hash(spark, sf):
    return prepare.dedup_by_hash(by_lang(spark, sf))


def q_near_duplicates(spark, sf):
    return similarity.near_duplicate_classes(by_lang(spark, sf))


# --- guardrails -------------------------------------------------------------------------

DISCLAIMERS = {"en": "This is not advice.", "fr": "Ceci n'est pas un conseil.", "de": "Dies ist kein Rat."}


def q_pii_redact(spark, sf):
    counts = [f"n_{kind}" for kind, _ in guardrails.PII_RULES]
    return guardrails.pii_counts(by_lang(spark, sf)).select("row_id", *counts, "redacted")


def q_blocklist_hits(spark, sf):
    hits = guardrails.blocklist_hits("text")
    return by_lang(spark, sf).select("row_id", F.array_join(hits, ",").alias("hits"))


def q_format_rules(spark, sf):
    return by_lang(spark, sf).select("row_id", F.array_join(guardrails.rule_hits("text"), ",").alias("hits"))


def q_disclaimer(spark, sf):
    """Applied twice: the second time adds nothing."""
    rows = by_lang(spark, sf)
    once = guardrails.with_disclaimer(rows, DISCLAIMERS, "category")
    return guardrails.with_disclaimer(once, DISCLAIMERS, "category").select("row_id", "text")


def q_guardrail_chain(spark, sf):
    """Documents as answers, their first line as the question."""
    rows = by_lang(spark, sf).select(
        "row_id",
        F.col("category").alias("domain"),
        F.substring_index("text", "\n", 1).alias("question"),
        F.col("text").alias("answer"),
    )
    out = guardrails.guardrail_chain(rows, DISCLAIMERS)
    return out.select("row_id", "answer", F.array_join("flags", ",").alias("flags"))


# --- monitoring -------------------------------------------------------------------------


def q_response_stats(spark, sf):
    stats = monitoring.response_stats(table_of(spark, sf, "conversations"), "role")
    return round6(stats, *[c for c in stats.columns if c not in ("role", "n")])


def q_response_drift(spark, sf):
    """Profiles of two halves of the conversations, the first saved and read back."""
    turns, path = table_of(spark, sf, "conversations"), scratch_path(spark, "profile")
    monitoring.response_profile(turns.where("conv_id % 2 = 0"), "role").write.parquet(path)
    live = monitoring.response_profile(turns.where("conv_id % 2 = 1"), "role")
    found = monitoring.response_drift(spark.read.parquet(path), live)
    return round6(found, "mean", "p50", "p95", "baseline_mean", "baseline_sd", "z")


def q_rolling_response_stats(spark, sf):
    daily = monitoring.daily_stats(table_of(spark, sf, "events"), "event_type")
    rolling = monitoring.rolling_stats(daily, "event_type").withColumn("day", F.col("day").cast("string"))
    return round6(rolling, "rolling_mean")


def q_flag_rate(spark, sf):
    events = table_of(spark, sf, "events")
    rates = monitoring.flag_rate(events, F.col("event_type") == "error")
    return round6(rates, "rate").withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm"))


def q_flag_rate_by_rule(spark, sf):
    flags = F.array_compact(
        F.array(
            F.when(F.col("event_type") == "error", F.lit("error")),
            F.when(F.col("value") > LARGE_VALUE, F.lit("large")),
            F.when(F.col("props").rlike(r"\b9[0-9]\b"), F.lit("ninety")),
        )
    )
    rates = monitoring.flag_rate_by_rule(table_of(spark, sf, "events"), flags)
    return round6(rates, "rate").withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm"))


def q_feedback_rate(spark, sf):
    """Views play the responses, clicks of the same user the feedback."""
    kind = F.col("event_type")
    rates = monitoring.feedback_rate(table_of(spark, sf, "events"), kind == "view", kind == "click", within=FEEDBACK_SECONDS)
    return round6(rates, "rate").withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def q_top_user_questions(spark, sf):
    return monitoring.top_questions(monitoring.user_questions(table_of(spark, sf, "conversations")), "domain")


def q_top_questions(spark, sf):
    return monitoring.top_questions(table_of(spark, sf, "conversations"), "role")


def evaluation_log(spark, sf):
    """Question, response, time, model version and phase of every judged row:
    the document's first line plays the question, the event's time the time."""
    asked = table_of(spark, sf, "documents").select(
        F.col("doc_id").alias("question_id"), F.substring_index("text", "\n", 1).alias("question")
    )
    times = table_of(spark, sf, "events").select(F.col("event_id").alias("question_id"), F.col("ts").alias("asked_at"))
    answers = predictions(spark, sf).select(
        F.col("row_id").alias("question_id"),
        "phase",
        argmax("logits").cast("string").alias("response"),
        F.lit("v1").alias("model_version"),
    )
    return answers.join(asked, "question_id", "left").join(times, "question_id", "left")


def q_eval_log_roundtrip(spark, sf):
    """The log as JSON lines, a folder a phase, read back by its schema."""
    path = scratch_path(spark, "evaluation_log")
    writers.write_eval_log(evaluation_log(spark, sf), path)
    return readers.read_eval_log(spark, path).withColumn("asked_at", F.date_format("asked_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def q_compare_answers(spark, sf):
    return monitoring.compare_answers(evaluation_log(spark, sf), "baseline", "after_lora")


def q_domain_layout_roundtrip(spark, sf):
    """Stage and domain folders; one domain is rewritten, and the others stay."""
    base = scratch_path(spark, "store")
    rows = by_lang(spark, sf)
    writers.write_stage(rows, base, "processed", "category")
    again = readers.read_stage(spark, base, "processed", "category", domain=REWRITTEN)
    marked = write_table(again.withColumn("text", F.concat(F.lit("v2 "), "text")), "rewritten")
    writers.write_stage(marked, base, "processed", "category")
    back = readers.read_stage(spark, base, "processed", "category")
    return back.select("row_id", "category", "text")


def q_captured_traffic(spark, sf):
    """Requests captured as JSON lines, as a source with a fixed schema."""
    path = scratch_path(spark, "captured")
    events = table_of(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    events.write.json(path)
    back = readers.read_captured(spark, path, events.schema)
    k = F.get_json_object("props", "$.k").cast("long")
    return back.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))


def embedding_sides(spark, sf):
    vectors = table_of(spark, sf, "embeddings")
    return vectors.where("vec_id % 2 = 0"), vectors.where("vec_id % 2 = 1")


def q_embedding_centroid_drift(spark, sf):
    return round6(monitoring.centroid_drift(*embedding_sides(spark, sf), "label"), "cosine")


# The given vectors are spread out, so a hit is looser than a real cache's 0.9.
CACHE_THRESHOLD = 0.4


def q_semantic_cache_lookup(spark, sf):
    vectors = table_of(spark, sf, "embeddings")
    return round6(cache.cache_lookup(vectors, F.col("vec_id") % 50 == 0, CACHE_THRESHOLD), "cosine")


CLUSTERS, CLUSTER_ROUNDS = 10, 5
ARRIVALS = 3


def q_embedding_psi(spark, sf):
    baseline, live = embedding_sides(spark, sf)
    return round6(monitoring.stability_index(baseline, live, CLUSTERS, CLUSTER_ROUNDS), "p", "q", "psi")


def q_drift_per_batch(spark, sf):
    """Live rows arrive in three deliveries; after each the stream takes what
    is new as one batch."""
    baseline, live = embedding_sides(spark, sf)
    base = scratch_path(spark, "drift")
    clusters.save_baseline(baseline, f"{base}/baseline", CLUSTERS, CLUSTER_ROUNDS)
    for k in range(ARRIVALS):
        live.where(F.expr(f"vec_id div 2 % {ARRIVALS} = {k}")).write.mode("append").parquet(f"{base}/arrived")
        stream = stream_files(spark, f"{base}/arrived", live.schema)
        found = drift_per_batch(stream, f"{base}/baseline", f"{base}/drift", f"{base}/checkpoint")
    return round6(found, "psi", "cosine")


def q_windowed_stats_stream(spark, sf):
    """Closed hours of the event stream, as a batch job would give them."""
    base = scratch_path(spark, "windows")
    schema = table_of(spark, sf, "events").schema
    stream = stream_files(spark, sf, schema, pattern="events.parquet")
    stats = windowed_stats(stream, F.col("event_type") == "error")
    landed = land_closed_windows(stats, f"{base}/table", f"{base}/checkpoint")
    return round6(landed, "mean_value").withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm"))


def queries() -> dict[str, Query]:
    """Every ``q_<name>`` above under ``<name>``, and those of the optional part."""
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    return own | (llm_queries.QUERIES if llm_queries else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-class statistics, train beside test."""
    return q_per_class_stats(spark, "/root/testdata/sf0.001")


# --- the same results in SQL ---------------------------------------------------------

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
_TOKEN = r"[\p{L}\p{M}\p{N}_]+|[\p{P}\p{S}]"

_DOCS = rf"""
d AS (
  SELECT doc_id AS row_id, text, source, lang,
         CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '4' THEN 'test' ELSE 'train' END AS split,
         trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS clean,
         lower(regexp_replace(regexp_replace(text, '^{_SPACE}', ''), '{_SPACE}$', '')) AS key
  FROM documents
),
vocab(label, category) AS (
  VALUES (0::BIGINT, 'en'), (1::BIGINT, 'fr'), (2::BIGINT, 'de'), (3::BIGINT, 'es')
),
e AS (SELECT d.*, vocab.label FROM d LEFT JOIN vocab ON d.lang = vocab.category)"""

_WORDS = _DOCS + """,
w AS (
  SELECT row_id, source AS category, split,
         CASE WHEN clean = '' THEN 0 ELSE len(string_split(clean, ' ')) END::BIGINT AS n_words
  FROM d
)"""

_KEPT = _DOCS + """,
kept AS (
  SELECT row_id, clean AS text, lang AS category, label FROM (
    SELECT *, row_number() OVER (PARTITION BY clean, label ORDER BY row_id) AS rn
    FROM e WHERE split = 'train'
  ) WHERE rn = 1
)"""


def _split_ctes(source: str) -> str:
    """Largest-remainder quotas and md5 order over ``source(row_id, label)``."""
    return f"""
size AS (SELECT count(*) AS n_all, CAST(ceil({VAL_SIZE}::DOUBLE * count(*)) AS BIGINT) AS n_val_all FROM {source}),
shares AS (
  SELECT label, n, n_all, n_val_all,
         (n::HUGEINT * (n_all - n_val_all)) // n_all AS base,
         (n::HUGEINT * (n_all - n_val_all)) % n_all AS remainder
  FROM (SELECT label, count(*) AS n FROM {source} GROUP BY label), size
),
quotas AS (
  SELECT label, n,
         CAST(n - base - CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)
              <= (n_all - n_val_all) - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n_val
  FROM shares
),
assigned AS (
  SELECT row_id, s.label, CASE WHEN rn <= n_val THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT row_id, label, row_number() OVER (
          PARTITION BY label ORDER BY md5('{SEED}:' || CAST(row_id AS VARCHAR)), row_id) AS rn
        FROM {source}) s JOIN quotas q ON s.label = q.label
)"""


_SPLIT = _KEPT + "," + _split_ctes("kept")

_PREDICTIONS = """
flat AS (
  SELECT vec_id AS row_id, label, substr(md5(CAST(vec_id AS VARCHAR)), 1, 1) AS digit, phase, logits
  FROM (
    SELECT vec_id, label, 'baseline' AS phase, embedding[1:10]::DOUBLE[] AS logits FROM embeddings
    UNION ALL
    SELECT vec_id, label, 'after_lora', embedding[11:20]::DOUBLE[] FROM embeddings
  )
),
p AS (
  SELECT row_id, phase, label,
         CASE WHEN digit < '4' THEN 'test' WHEN digit < '8' THEN 'validation' ELSE 'train' END AS split,
         list_position(logits, list_max(logits)) - 1 AS prediction,
         ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))))
           + list_max(logits) - logits[label + 1] AS loss
  FROM flat
)"""


def _metric_ctes(source: str) -> str:
    """Long metric table over ``source(phase, split, label, prediction, loss)``."""
    return f"""
roles AS (
  SELECT phase, split, label AS class, 1 AS support, 0 AS predicted,
         CASE WHEN label = prediction THEN 1 ELSE 0 END AS hits FROM {source}
  UNION ALL
  SELECT phase, split, prediction, 0, 1, 0 FROM {source}
),
scores AS (
  SELECT phase, split, class, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted,
         sum(hits)::BIGINT AS hits,
         CASE WHEN sum(predicted) = 0 THEN 0.0::DOUBLE ELSE sum(hits)::DOUBLE / sum(predicted) END AS precision,
         CASE WHEN sum(support) = 0 THEN 0.0::DOUBLE ELSE sum(hits)::DOUBLE / sum(support) END AS recall,
         CASE WHEN sum(support) + sum(predicted) = 0 THEN 0.0::DOUBLE
              ELSE 2 * sum(hits)::DOUBLE / (sum(support) + sum(predicted)) END AS f1
  FROM roles GROUP BY phase, split, class
),
wide AS (
  SELECT phase, split, sum(hits)::DOUBLE / sum(support) AS accuracy, avg(f1) AS f1_macro,
         sum(f1 * support) / sum(support) AS f1_weighted, avg(precision) AS precision_macro,
         avg(recall) AS recall_macro
  FROM scores GROUP BY phase, split
),
table5 AS (
  SELECT phase, split, 'accuracy' AS metric, accuracy AS value FROM wide
  UNION ALL SELECT phase, split, 'f1_macro', f1_macro FROM wide
  UNION ALL SELECT phase, split, 'f1_weighted', f1_weighted FROM wide
  UNION ALL SELECT phase, split, 'precision_macro', precision_macro FROM wide
  UNION ALL SELECT phase, split, 'recall_macro', recall_macro FROM wide
),
table6 AS (
  SELECT * FROM table5
  UNION ALL SELECT phase, split, 'loss', avg(loss) FROM {source} GROUP BY phase, split
)"""


_EVAL = _PREDICTIONS + ", judged AS (SELECT * FROM p WHERE split IN ('validation', 'test'))," + _metric_ctes("judged")
_EVAL_ALL = _PREDICTIONS + "," + _metric_ctes("p")

_DELTA = """
delta AS (
  SELECT b.split, b.metric, b.value AS baseline, a.value AS after, a.value - b.value AS delta
  FROM table6 b JOIN table6 a ON a.split = b.split AND a.metric = b.metric
  WHERE b.phase = 'baseline' AND a.phase = 'after_lora'
)"""

_STATS = _WORDS + """,
tr AS (SELECT category, count(*) AS c, avg(n_words) AS a, max(n_words) AS m FROM w WHERE split = 'train' GROUP BY category),
te AS (SELECT category, count(*) AS c, avg(n_words) AS a, max(n_words) AS m FROM w WHERE split = 'test' GROUP BY category)
SELECT coalesce(tr.category, te.category) AS category,
       tr.c AS train_count, round_even(tr.a * 100, 0) / 100 AS train_avg_words, tr.m AS train_max_words,
       te.c AS test_count, round_even(te.a * 100, 0) / 100 AS test_avg_words, te.m AS test_max_words,
       round_even((100 * tr.c / (SELECT sum(c) FROM tr)::DOUBLE) * 100, 0) / 100 AS "train_share_%"
FROM tr FULL OUTER JOIN te ON tr.category = te.category"""

_CHECKS = _DOCS + """,
tk AS (SELECT key, count(*) AS n, count(DISTINCT source) AS cats FROM d WHERE split = 'train' GROUP BY key),
sk AS (SELECT key, count(*) AS n FROM d WHERE split = 'test' GROUP BY key),
checks AS (
  SELECT 'train_rows' AS "check", count(*) FILTER (split = 'train') AS value FROM d
  UNION ALL SELECT 'test_rows', count(*) FILTER (split = 'test') FROM d
  UNION ALL SELECT 'n_intents_train', count(*) FROM (SELECT DISTINCT source FROM d WHERE split = 'train')
  UNION ALL SELECT 'n_intents_test', count(*) FROM (SELECT DISTINCT source FROM d WHERE split = 'test')
  UNION ALL SELECT 'duplicate_texts_train', CAST(sum(n - 1) AS BIGINT) FROM tk
  UNION ALL SELECT 'duplicate_texts_test', CAST(sum(n - 1) AS BIGINT) FROM sk
  UNION ALL SELECT 'train_test_overlap_texts', count(*) FROM d WHERE split = 'test' AND key IN (SELECT key FROM tk)
  UNION ALL SELECT 'label_conflicts_train', count(*) FROM tk WHERE cats > 1
  UNION ALL SELECT 'empty_texts_train', count(*) FROM d WHERE split = 'train' AND key = ''
  UNION ALL SELECT 'empty_texts_test', count(*) FROM d WHERE split = 'test' AND key = ''
)"""

_TOP = """
SELECT category, round(avg(n_words), 6) AS avg_words FROM w WHERE split = 'train'
GROUP BY category ORDER BY avg(n_words) DESC, category LIMIT 10"""

_HISTOGRAM = """
WITH r AS (SELECT split, min(n_words)::DOUBLE AS lo, max(n_words)::DOUBLE AS hi FROM w GROUP BY split),
            bins AS (
              SELECT split, lo, hi, k + 1 AS bin, k * ((hi - lo) / 40.0::DOUBLE) + lo AS bin_start,
                     CASE WHEN k = 39 THEN hi ELSE (k + 1) * ((hi - lo) / 40.0::DOUBLE) + lo END AS bin_end
              FROM r, range(40) AS g(k))
            SELECT b.split, b.bin, round(b.bin_start, 6) AS bin_start, round(b.bin_end, 6) AS bin_end,
                   count(w.row_id) AS n_rows
            FROM bins b LEFT JOIN w ON w.split = b.split AND w.n_words >= b.bin_start
              AND (w.n_words < b.bin_end OR (b.bin = 40 AND w.n_words <= b.bin_end))
            GROUP BY b.split, b.bin, b.bin_start, b.bin_end"""

_IMBALANCE = """
WITH c AS (
              SELECT source AS category, count(*) AS n FROM d WHERE split = 'train' GROUP BY source)
            SELECT (SELECT category FROM c ORDER BY n DESC, category LIMIT 1) AS largest_class,
                   max(n) AS largest_count,
                   (SELECT category FROM c ORDER BY n, category LIMIT 1) AS smallest_class,
                   min(n) AS smallest_count, round(max(n)::DOUBLE / min(n), 6) AS imbalance_ratio
            FROM c"""

_TOKENS = _DOCS + f""",
t AS (SELECT row_id, label, regexp_extract_all(text, '{_TOKEN}') AS tokens FROM e)"""

_PADDED = _TOKENS + f""",
cut AS (SELECT row_id, tokens,
               (row_number() OVER (ORDER BY row_id) - 1) // {BATCH} AS batch_id FROM t),
sized AS (SELECT *, max(len(tokens)) OVER (PARTITION BY batch_id) - len(tokens) AS gap FROM cut),
padded AS (SELECT *, list_transform(range(gap), lambda i: '[PAD]') AS filler FROM sized)"""


_NORMAL = "' ' || regexp_replace(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"


def _hits(text: str) -> str:
    words = _NORMAL.format(text)
    listed = ", ".join(f"CASE WHEN contains({words}, ' {p} ') THEN '{p}' END" for p in guardrails.BLOCKLIST)
    return f"list_filter([{listed}], lambda x: x IS NOT NULL)"


def _rules(text: str) -> str:
    listed = ", ".join(
        f"CASE WHEN regexp_matches({text}, '{p}') THEN '{name}' END" for name, p in guardrails.FORMAT_RULES
    )
    return f"list_filter([{listed}], lambda x: x IS NOT NULL)"


def _redacted(text: str, upto: int = len(guardrails.PII_RULES)) -> str:
    for kind, pattern in guardrails.PII_RULES[:upto]:
        text = f"regexp_replace({text}, '{pattern}', '[{kind}]', 'g')"
    return text


def _disclaimed(text: str, domain: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in DISCLAIMERS.items())
    known = f"(CASE {domain} {cases} END)"
    return f"CASE WHEN {known} IS NULL OR contains({text}, {known}) THEN {text} ELSE {text} || chr(10) || {known} END"


_LOG = _PREDICTIONS + """,
log AS (SELECT row_id AS question_id, phase, prediction::INTEGER::VARCHAR AS response, 'v1' AS model_version FROM p)"""


def _preparation_sql() -> dict[str, str]:
    counts = ", ".join(
        f"len(regexp_extract_all({_redacted('text', i)}, '{p}'))::BIGINT AS n_{kind}"
        for i, (kind, p) in enumerate(guardrails.PII_RULES)
    )
    return {
        "load_first_n": f"""WITH {_SPLIT}, every AS (
              SELECT k.row_id, a.split, k.text, k.category, k.label FROM kept k JOIN assigned a ON a.row_id = k.row_id
              UNION ALL SELECT row_id, 'test', clean, lang, label FROM e WHERE split = 'test')
            SELECT row_id, split, text, category, label FROM (
              SELECT *, row_number() OVER (PARTITION BY split ORDER BY row_id) AS rn FROM every)
            WHERE split <> 'train' OR rn <= {FIRST_N}""",
        "train_text_classifier": f"""WITH q AS (
              SELECT doc_id, quality::BIGINT AS label, regexp_extract_all(text, '{_TOKEN}') AS tokens,
                     CASE WHEN digit < '3' THEN 'test' WHEN digit < '5' THEN 'validation' ELSE 'train' END AS split
              FROM (SELECT doc_id, quality, text, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) AS digit
                    FROM documents JOIN labels USING (doc_id))),
            prior AS (
              SELECT ln((count(*) FILTER (label = 0) + 1)::DOUBLE / (count(*) + 2)) AS l0,
                     ln((count(*) FILTER (label = 1) + 1)::DOUBLE / (count(*) + 2)) AS l1
              FROM q WHERE split = 'train'),
            tok AS (SELECT doc_id, split, label, unnest(tokens) AS token FROM q),
            cnt AS (SELECT token, count(*) FILTER (label = 0) AS c0, count(*) FILTER (label = 1) AS c1
                    FROM tok WHERE split = 'train' GROUP BY token),
            size AS (SELECT count(*) AS v, sum(c0) AS n0, sum(c1) AS n1 FROM cnt),
            logs AS (SELECT token, ln((c0 + 1)::DOUBLE / (n0 + v)) AS g0, ln((c1 + 1)::DOUBLE / (n1 + v)) AS g1 FROM cnt, size),
            sums AS (SELECT doc_id, sum(g0) AS s0, sum(g1) AS s1 FROM tok JOIN logs USING (token) WHERE split <> 'train' GROUP BY doc_id),
            scored AS (SELECT split, label, coalesce(s0, 0) + l0 AS a, coalesce(s1, 0) + l1 AS b, l0, l1
                       FROM q LEFT JOIN sums USING (doc_id), prior WHERE split <> 'train'),
            judged AS (
              SELECT 'baseline' AS phase, split, label, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS prediction,
                     ln(exp(l0) + exp(l1)) - CASE WHEN label = 0 THEN l0 ELSE l1 END AS loss FROM scored
              UNION ALL
              SELECT 'after_lora', split, label, CASE WHEN b > a THEN 1 ELSE 0 END,
                     greatest(a, b) + ln(exp(a - greatest(a, b)) + exp(b - greatest(a, b))) - CASE WHEN label = 0 THEN a ELSE b END
              FROM scored),
            {_metric_ctes("judged")}, {_DELTA} SELECT split, metric, round(baseline, 6) AS baseline,
            round(after, 6) AS after, round(delta, 6) AS delta, metric = 'f1_macro' AS is_primary FROM delta""",
        "token_length_filter": f"""WITH {_TOKENS} SELECT row_id, len(tokens)::BIGINT AS n_tokens FROM t
            WHERE len(tokens) BETWEEN 100 AND 500""",
        "sample_exact": f"""WITH {_DOCS} SELECT row_id, text FROM d
            ORDER BY md5('{SEED}:' || CAST(row_id AS VARCHAR)), row_id LIMIT 300""",
        "stratified_sample": f"""WITH {_DOCS}, every AS (SELECT row_id, label FROM e), {_split_ctes("every")}
            SELECT row_id, label FROM assigned WHERE split = 'validation'""",
        "format_instruction": """WITH s AS (SELECT conv_id, arg_min(text, turn) AS context FROM conversations
              WHERE role = 'system' GROUP BY conv_id)
            SELECT u.conv_id, u.turn, '### Instruction:' || chr(10) || u.text || chr(10) || chr(10)
                   || CASE WHEN trim(coalesce(context, '')) <> '' THEN '### Input:' || chr(10) || context || chr(10) || chr(10) ELSE '' END
                   || '### Response:' || chr(10) || a.text AS example
            FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
              AND a.role = 'assistant' LEFT JOIN s ON s.conv_id = u.conv_id WHERE u.role = 'user'""",
        "format_chat": """SELECT conv_id, count(*) AS n_turns,
            string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS chat
            FROM conversations GROUP BY conv_id""",
        "format_by_dataset": f"""WITH {_DOCS} SELECT row_id, lang AS dataset, CASE lang WHEN 'en' THEN 'Question: ' || text
            WHEN 'fr' THEN upper(trim(text)) ELSE text END AS text FROM d""",
        "dedup_by_hash": f"""WITH {_DOCS} SELECT sha256(key) AS content_hash, min(row_id) AS row_id, count(*) AS copies
            FROM d GROUP BY key""",
        "near_duplicates": f"""WITH RECURSIVE {_DOCS},
            firsts AS (SELECT min(row_id) AS row_id, key FROM d GROUP BY key),
            ws AS (SELECT row_id, list_filter(string_split_regex(key, '\\s+'), lambda w: w <> '') AS ws FROM firsts),
            sets AS (SELECT row_id, list_distinct(CASE WHEN len(ws) >= 5
                       THEN list_transform(range(1, len(ws) - 3), lambda i: md5(array_to_string(ws[i:i + 4], ' ')))
                       WHEN len(ws) > 0 THEN [md5(array_to_string(ws, ' '))] ELSE [] END) AS sh FROM ws),
            one AS (SELECT row_id, len(sh) AS n, unnest(sh) AS s FROM sets),
            common AS (SELECT a.row_id AS x, b.row_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
                       FROM one a JOIN one b ON a.s = b.s AND a.row_id <> b.row_id GROUP BY a.row_id, b.row_id),
            links AS (SELECT x, y FROM common WHERE 100 * c >= 80 * (n + m - c)),
            reach AS (SELECT row_id AS x, row_id AS y FROM firsts UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
            least AS (SELECT x AS set_id, min(y) AS least FROM reach GROUP BY x)
            SELECT d.row_id, len(sh) AS n_shingles, CASE WHEN len(sh) = 0 THEN d.row_id ELSE least END AS component_id
            FROM d JOIN firsts f ON d.key IS NOT DISTINCT FROM f.key JOIN sets ON sets.row_id = f.row_id
            JOIN least ON set_id = f.row_id""",
        "pii_redact": f"WITH {_DOCS} SELECT row_id, {counts}, {_redacted('text')} AS redacted FROM d",
        "blocklist_hits": f"WITH {_DOCS} SELECT row_id, array_to_string({_hits('text')}, ',') AS hits FROM d",
        "format_rules": f"WITH {_DOCS} SELECT row_id, array_to_string({_rules('text')}, ',') AS hits FROM d",
        "disclaimer": f"WITH {_DOCS} SELECT row_id, {_disclaimed('text', 'lang')} AS text FROM d",
        "guardrail_chain": f"""WITH {_DOCS},
            q AS (SELECT row_id, lang, string_split(text, chr(10))[1] AS question, text FROM d),
            screened AS (SELECT row_id, lang, len({_hits('question')}) > 0 AS blocked,
                                {_redacted('question')} <> question AS pii, text FROM q),
            formatted AS (SELECT row_id, blocked, pii, CASE WHEN NOT blocked THEN {_disclaimed('text', 'lang')} END AS answer FROM screened)
            SELECT row_id, {_redacted('answer')} AS answer, array_to_string(list_filter([
                CASE WHEN blocked THEN 'input:blocklist' END, CASE WHEN pii THEN 'input:pii' END,
                CASE WHEN {_redacted('answer')} <> answer THEN 'output:pii' END,
                CASE WHEN len({_hits('answer')}) > 0 THEN 'output:blocklist' END,
                CASE WHEN len({_rules('answer')}) > 0 THEN 'output:format' END], lambda x: x IS NOT NULL), ',') AS flags
            FROM formatted""",
        "response_stats": f"""WITH c AS (SELECT role, text,
                lower(regexp_replace(regexp_replace(text, '^{_SPACE}', ''), '{_SPACE}$', '')) AS key,
                trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS clean FROM conversations),
            w AS (SELECT role, length(text) AS chars,
                CASE WHEN clean = '' THEN 0 ELSE len(string_split(clean, ' ')) END AS words,
                len(string_split(text, chr(10))) AS lines, len(regexp_extract_all(text, '[.!?]')) AS sentences,
                list_filter(string_split_regex(key, '\\s+'), lambda x: x <> '') AS ws FROM c)
            SELECT role, count(*) AS n, round(avg(chars), 6) AS mean_chars, round(stddev_samp(chars), 6) AS sd_chars,
                round(avg(words), 6) AS mean_words, round(avg(lines), 6) AS mean_lines,
                round(avg(sentences), 6) AS mean_sentences,
                round(avg(len(list_distinct(ws))::DOUBLE / greatest(len(ws), 1)), 6) AS distinct_ratio
            FROM w GROUP BY role""",
        "rolling_response_stats": """WITH daily AS (SELECT event_type, ts::DATE AS day, count(*) AS n, sum(value) AS total
              FROM events GROUP BY event_type, ts::DATE)
            SELECT event_type, day::VARCHAR AS day, (sum(n) OVER w)::BIGINT AS rolling_n, round(sum(total) OVER w / sum(n) OVER w, 6) AS rolling_mean
            FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "flag_rate": """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS period, count(*) AS n,
            count(*) FILTER (event_type = 'error') AS n_flagged,
            round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 6) AS rate FROM events GROUP BY 1""",
        "flag_rate_by_rule": f"""WITH e AS (
              SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS period,
                event_type = 'error' AS error, value > {LARGE_VALUE} AS large, regexp_matches(props, '\\b9[0-9]\\b') AS ninety FROM events),
            totals AS (SELECT period, count(*) AS n FROM e GROUP BY period),
            r AS (SELECT period, 'error' AS rule FROM e WHERE error UNION ALL SELECT period, 'large' FROM e WHERE large
                  UNION ALL SELECT period, 'ninety' FROM e WHERE ninety),
            k AS (SELECT period, rule, count(*) AS n_flagged FROM r GROUP BY ALL)
            SELECT period, rule, n, n_flagged, round(n_flagged / n::DOUBLE, 6) AS rate FROM k JOIN totals USING (period)""",
        "feedback_rate": f"""WITH r AS (SELECT event_id, ts, EXISTS (
                SELECT 1 FROM events f WHERE f.event_type = 'click' AND f.user_id = e.user_id AND f.ts > e.ts
                AND f.ts <= e.ts + INTERVAL {FEEDBACK_SECONDS} SECOND) AS followed FROM events e WHERE event_type = 'view')
            SELECT strftime(ts, '%Y-%m-%d') AS period, count(*) AS n, count(*) FILTER (followed) AS n_followed,
                round(count(*) FILTER (followed) / count(*)::DOUBLE, 6) AS rate FROM r GROUP BY 1""",
        "top_user_questions": f"""WITH guided AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'),
            c AS (SELECT CASE WHEN g.conv_id IS NULL THEN 'open' ELSE 'guided' END AS domain,
                lower(regexp_replace(regexp_replace(text, '^{_SPACE}', ''), '{_SPACE}$', '')) AS key
                FROM conversations c LEFT JOIN guided g USING (conv_id) WHERE role = 'user'),
            n AS (SELECT domain, key, count(*) AS n FROM c GROUP BY domain, key)
            SELECT domain, key, n, rank::INTEGER AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY domain ORDER BY n DESC, key) AS rank FROM n) WHERE rank <= 5""",
        "response_drift": f"""WITH c AS (SELECT conv_id % 2 AS side, role, text,
                lower(regexp_replace(regexp_replace(text, '^{_SPACE}', ''), '{_SPACE}$', '')) AS key,
                trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS clean FROM conversations),
            w AS (SELECT side, role, length(text)::DOUBLE AS chars,
                CASE WHEN clean = '' THEN 0 ELSE len(string_split(clean, ' ')) END::DOUBLE AS words,
                len(string_split(text, chr(10)))::DOUBLE AS lines, len(regexp_extract_all(text, '[.!?]'))::DOUBLE AS sentences,
                list_filter(string_split_regex(key, '\\s+'), lambda x: x <> '') AS ws FROM c),
            m AS (SELECT side, role, chars, words, lines, sentences,
                len(list_distinct(ws))::DOUBLE / greatest(len(ws), 1) AS distinct_ratio FROM w),
            u AS (UNPIVOT m ON chars, words, lines, sentences, distinct_ratio INTO NAME statistic VALUE x),
            s AS (SELECT side, role, statistic, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd,
                CASE WHEN statistic = 'words' THEN quantile_cont(x, 0.5) END AS p50,
                CASE WHEN statistic = 'words' THEN quantile_cont(x, 0.95) END AS p95 FROM u GROUP BY side, role, statistic)
            SELECT a.role, a.statistic, a.n, round(a.mean, 6) AS mean, round(a.p50, 6) AS p50, round(a.p95, 6) AS p95,
                round(b.mean, 6) AS baseline_mean, round(b.sd, 6) AS baseline_sd,
                round((a.mean - b.mean) / b.sd * sqrt(a.n), 6) AS z
            FROM s a LEFT JOIN s b ON b.side = 0 AND b.role = a.role AND b.statistic = a.statistic WHERE a.side = 1""",
        "stream_quarantine": f"""SELECT doc_id AS row_id, CASE WHEN lang IN {PARTIAL_VOCABULARY} AND text IS NOT NULL
                THEN trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) ELSE text END AS text, lang AS category,
            list_position({list(PARTIAL_VOCABULARY)}, lang) - 1::BIGINT AS label,
            nullif(concat_ws(', ', CASE WHEN text IS NULL THEN 'null text' END,
                CASE WHEN lang IS NULL OR lang NOT IN {PARTIAL_VOCABULARY} THEN 'unknown category' END), '') AS reason FROM documents""",
        "top_questions": f"""WITH c AS (SELECT role,
                lower(regexp_replace(regexp_replace(text, '^{_SPACE}', ''), '{_SPACE}$', '')) AS key FROM conversations),
            n AS (SELECT role, key, count(*) AS n FROM c GROUP BY role, key)
            SELECT role, key, n, rank::INTEGER AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY role ORDER BY n DESC, key) AS rank FROM n) WHERE rank <= 5""",
        "windowed_stats_stream": """WITH w AS (SELECT date_trunc('hour', ts) AS start, count(*) AS n,
              count(*) FILTER (event_type = 'error') AS n_flagged, round(avg(value), 6) AS mean_value
              FROM events GROUP BY 1)
            SELECT strftime(start, '%Y-%m-%d %H:%M') AS period, n, n_flagged, mean_value FROM w
            WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
        "eval_log_roundtrip": f"""WITH {_LOG} SELECT log.*, string_split(text, chr(10))[1] AS question,
            strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS asked_at
            FROM log LEFT JOIN documents ON doc_id = question_id LEFT JOIN events ON event_id = question_id""",
        "compare_answers": f"""WITH {_LOG} SELECT b.question_id, b.response AS before, a.response AS after,
            b.response <> a.response AS changed FROM log b JOIN log a USING (question_id)
            WHERE b.phase = 'baseline' AND a.phase = 'after_lora'""",
        "domain_layout_roundtrip": f"""SELECT doc_id AS row_id, lang AS category,
            CASE WHEN lang = '{REWRITTEN}' THEN 'v2 ' || text ELSE text END AS text FROM documents""",
        "captured_traffic": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value,
            (props::JSON->>'$.k')::BIGINT AS k FROM events""",
        "embedding_centroid_drift": """WITH x AS (SELECT vec_id % 2 AS side, label, generate_subscripts(embedding, 1) AS pos,
                unnest(embedding)::DOUBLE AS x FROM embeddings),
            m AS (SELECT side, label, pos, avg(x) AS x FROM x GROUP BY ALL)
            SELECT a.label, round(sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)), 6) AS cosine
            FROM m a JOIN m b ON b.label = a.label AND b.pos = a.pos AND a.side = 0 AND b.side = 1 GROUP BY a.label""",
        "semantic_cache_lookup": f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
            scored AS (SELECT q.vec_id AS query_id, x.vec_id,
                list_inner_product(q.v, x.v) / sqrt(list_inner_product(q.v, q.v) * list_inner_product(x.v, x.v)) AS cosine
                FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
            SELECT query_id, arg_max(vec_id, (round(cosine, 12), -vec_id)) AS vec_id, round(max(cosine), 6) AS cosine
            FROM scored GROUP BY query_id HAVING max(cosine) >= {CACHE_THRESHOLD}""",
        "embedding_psi": f"""WITH {_clusters()}, n AS (
                SELECT cluster, count(side) FILTER (side = 0) AS b, count(side) FILTER (side = 1) AS l
                FROM book_{CLUSTER_ROUNDS} LEFT JOIN (SELECT vec_id % 2 AS side, best.cluster AS cluster FROM near_all) USING (cluster)
                GROUP BY cluster),
            pq AS (SELECT cluster, greatest(b / (sum(b) OVER ())::DOUBLE, 0.0001::DOUBLE) AS p,
                          greatest(l / (sum(l) OVER ())::DOUBLE, 0.0001::DOUBLE) AS q FROM n)
            SELECT cluster::INTEGER AS cluster, round(p, 6) AS p, round(q, 6) AS q, round((q - p) * ln(q / p), 6) AS psi FROM pq""",
        "drift_per_batch": f"""WITH {_clusters()},
            placed AS (SELECT best.cluster AS cluster, CASE WHEN vec_id % 2 = 1 THEN vec_id // 2 % {ARRIVALS} END AS batch_id FROM near_all),
            every AS (SELECT batch_id, cluster FROM (SELECT unnest(range({ARRIVALS})) AS batch_id), book_{CLUSTER_ROUNDS}),
            b AS (SELECT cluster, count(*) / sum(count(*)) OVER ()::DOUBLE AS p FROM placed WHERE batch_id IS NULL GROUP BY cluster),
            l AS (SELECT batch_id, cluster, count(*) AS n FROM placed WHERE batch_id IS NOT NULL GROUP BY ALL),
            shares AS (SELECT batch_id, coalesce(l.n, 0) AS n, greatest(coalesce(p, 0), 0.0001::DOUBLE) AS p,
                greatest(coalesce(l.n, 0) / sum(l.n) OVER (PARTITION BY batch_id)::DOUBLE, 0.0001::DOUBLE) AS q
                FROM every LEFT JOIN b USING (cluster) LEFT JOIN l USING (batch_id, cluster)),
            psi AS (SELECT batch_id, sum(n)::BIGINT AS n, round(sum((q - p) * ln(q / p)), 6) AS psi FROM shares GROUP BY batch_id),
            x AS (SELECT CASE WHEN vec_id % 2 = 0 THEN -1 ELSE vec_id // 2 % {ARRIVALS} END AS batch_id,
                generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
            m AS (SELECT batch_id, pos, avg(x) AS x FROM x GROUP BY ALL),
            cosines AS (SELECT a.batch_id, round(sum(a.x * o.x) / sqrt(sum(a.x * a.x) * sum(o.x * o.x)), 6) AS cosine
                FROM m a JOIN m o USING (pos) WHERE a.batch_id >= 0 AND o.batch_id = -1 GROUP BY a.batch_id)
            SELECT batch_id, n, psi, cosine FROM psi JOIN cosines USING (batch_id)""",
    }


def _clusters() -> str:
    """Lloyd's rounds over the even rows, then the nearest center of all rows."""
    apart = "list_inner_product(c, c) - 2 * list_inner_product(v, c)"

    def near(name: str, rows: str, k: int) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT vec_id, any_value(v) AS v, min({{'d': {apart}, 'cluster': cluster}}) AS best
            FROM vectors, book_{k} {rows} GROUP BY vec_id)"""

    steps = [
        "vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL)",
        f"""book_0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, list_transform(v, lambda x: round(x, 6)) AS c
            FROM vectors WHERE vec_id % 2 = 0 ORDER BY vec_id LIMIT {CLUSTERS})""",
    ]
    for k in range(CLUSTER_ROUNDS):
        steps.append(near(f"near_{k}", "WHERE vec_id % 2 = 0", k))
        steps.append(f"""book_{k + 1} AS MATERIALIZED (
            SELECT cluster, coalesce(m.c, o.c) AS c FROM book_{k} o LEFT JOIN (
                SELECT cluster, list(round(x, 6) ORDER BY pos) AS c FROM (
                    SELECT cluster, pos, avg(x) AS x FROM (
                        SELECT best.cluster AS cluster, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM near_{k}
                    ) GROUP BY ALL) GROUP BY cluster) m USING (cluster))""")
    return ", ".join([*steps, near("near_all", "", CLUSTER_ROUNDS)])


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_text": f"WITH {_DOCS} SELECT row_id, clean FROM d",
        "compare_key": f"WITH {_DOCS} SELECT row_id, key FROM d",
        "word_count": f"WITH {_WORDS} SELECT row_id, n_words FROM w",
        "label_encode": f"WITH {_DOCS} SELECT row_id, lang AS category, label FROM e",
        "label_decode": f"WITH {_DOCS} SELECT row_id, label, lang AS category FROM e",
        "training_columns": f"WITH {_DOCS} SELECT text, lang AS category, label FROM e",
        "unknown_labels": f"WITH {_DOCS} SELECT DISTINCT split, lang AS category FROM d WHERE lang NOT IN ('en', 'fr', 'it')",
        "missing_labels": f"""WITH {_DOCS},
            small(label, category) AS (VALUES (0::BIGINT, 'en'), (1::BIGINT, 'fr'), (2::BIGINT, 'it')),
            names(split) AS (VALUES ('train'), ('validation'), ('test'))
            SELECT split, label FROM names, small
            EXCEPT SELECT d.split, small.label FROM d JOIN small ON d.lang = small.category""",
        "label_coverage": f"""WITH {_DOCS},
            small(category) AS (VALUES ('en'), ('fr'), ('it')),
            names(split) AS (VALUES ('train'), ('test'))
            SELECT split, 'absent' AS problem, category FROM (
              SELECT split, category FROM names, small EXCEPT SELECT split, lang FROM d)
            UNION ALL
            SELECT DISTINCT split, 'unknown', lang FROM d WHERE lang NOT IN (SELECT category FROM small)""",
        "text_problems": f"""WITH {_DOCS} SELECT split, count(*) AS n_rows,
            count(*) FILTER (text IS NULL) AS null_texts, count(*) FILTER (key = '') AS empty_texts
            FROM d GROUP BY split""",
        "dedup_exact": f"WITH {_KEPT} SELECT row_id, text, label FROM kept",
        "dedup_removed": f"""WITH {_KEPT}, n AS (
            SELECT (SELECT count(*) FROM e WHERE split = 'train') AS n_before,
                   (SELECT count(*) FROM kept) AS n_after)
            SELECT n_before, n_after, n_before - n_after AS n_removed FROM n""",
        "stratified_split": f"WITH {_SPLIT} SELECT row_id, label, split FROM assigned",
        "split_summary": f"""WITH {_SPLIT} SELECT split, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_labels,
            min(n) AS min_per_class, max(n) AS max_per_class
            FROM (SELECT split, label, count(*) AS n FROM assigned GROUP BY split, label) GROUP BY split""",
        "split_quotas": f"""WITH {_DOCS}, base_rows AS (SELECT row_id, label FROM e WHERE split = 'train'),
            {_split_ctes("base_rows")} SELECT label, n, n_val FROM quotas""",
        "first_n": f"WITH {_DOCS} SELECT row_id, text FROM d WHERE split = 'train' ORDER BY row_id LIMIT {FIRST_N}",
        "preview_head": f"WITH {_DOCS} SELECT row_id, text, source AS category FROM d ORDER BY row_id LIMIT 5",
        "stack_splits": f"WITH {_DOCS} SELECT row_id, text, source AS category, split FROM d",
        "per_class_stats": f"WITH {_STATS}",
        "stats_csv_roundtrip": f"WITH {_STATS}",
        "quality_checks": f'WITH {_CHECKS} SELECT "check", value FROM checks',
        "split_sizes": f"""WITH {_DOCS} SELECT split, count(*) AS n_rows,
            count(DISTINCT source) AS n_categories FROM d GROUP BY split""",
        "class_distribution": f"""WITH {_DOCS} SELECT source AS category, count(*) AS n_rows
            FROM d WHERE split = 'train' GROUP BY source""",
        "imbalance": f"WITH {_DOCS} SELECT * FROM ({_IMBALANCE})",
        "length_summary": f"""WITH {_WORDS} SELECT split, round(avg(n_words), 6) AS mean_words,
            round(quantile_cont(n_words::DOUBLE, 0.5), 6) AS median_words,
            round(quantile_cont(n_words::DOUBLE, 0.95), 6) AS p95_words, max(n_words) AS max_words
            FROM w GROUP BY split""",
        "length_histogram": f"WITH {_WORDS} SELECT * FROM ({_HISTOGRAM})",
        "top_classes_by_length": f"WITH {_WORDS} {_TOP}",
        "eda_report": f"""WITH {_CHECKS},
            w AS (SELECT row_id, source AS category, split,
                  CASE WHEN clean = '' THEN 0 ELSE len(string_split(clean, ' ')) END::BIGINT AS n_words FROM d)
            SELECT 'checks' AS report, "check" AS item, value::DOUBLE AS value FROM checks
            UNION ALL SELECT 'distribution', category, count(*)::DOUBLE FROM w WHERE split = 'train' GROUP BY category
            UNION ALL SELECT 'longest', category, avg_words FROM ({_TOP})
            UNION ALL SELECT 'length mean', split, round(avg(n_words), 6) FROM w GROUP BY split
            UNION ALL SELECT 'length median', split, round(quantile_cont(n_words::DOUBLE, 0.5), 6) FROM w GROUP BY split
            UNION ALL SELECT 'length p95', split, round(quantile_cont(n_words::DOUBLE, 0.95), 6) FROM w GROUP BY split
            UNION ALL SELECT 'length max', split, max(n_words)::DOUBLE FROM w GROUP BY split
            UNION ALL SELECT 'stats ' || name, category, value FROM (
              UNPIVOT (SELECT category, train_count::DOUBLE AS train_count, train_avg_words, train_max_words::DOUBLE AS train_max_words,
                              test_count::DOUBLE AS test_count, test_avg_words, test_max_words::DOUBLE AS test_max_words, "train_share_%"
                       FROM (WITH {_STATS}))
              ON COLUMNS(* EXCLUDE category) INTO NAME name VALUE value) WHERE value IS NOT NULL
            UNION ALL SELECT 'histogram', split || ' ' || bin, n_rows::DOUBLE FROM ({_HISTOGRAM})
            UNION ALL SELECT unnest(['largest', 'smallest', 'ratio']), unnest([largest_class, smallest_class, 'imbalance']),
                             unnest([largest_count::DOUBLE, smallest_count::DOUBLE, imbalance_ratio]) FROM ({_IMBALANCE})""",
        "confusion": f"""WITH {_PREDICTIONS} SELECT phase, split, label, prediction::INTEGER AS prediction,
            count(*) AS n, round(sum(loss), 6) AS loss_sum FROM p GROUP BY phase, split, label, prediction""",
        "class_scores": f"""WITH {_EVAL_ALL} SELECT phase, split, class::INTEGER AS class, support, predicted, hits,
            round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM scores""",
        "eval_metrics": f"""WITH {_PREDICTIONS},
            one AS (SELECT phase, 'all' AS split, label, prediction, loss FROM p),
            {_metric_ctes("one")} SELECT phase, metric, round(value, 6) AS value FROM table5""",
        "eval_loss": f"""WITH {_PREDICTIONS} SELECT phase, split, 'loss' AS metric, round(avg(loss), 6) AS value
            FROM p GROUP BY phase, split""",
        "evaluate_splits": f"WITH {_EVAL} SELECT phase, split, metric, round(value, 6) AS value FROM table6",
        "evaluate_first_rows": f"""WITH {_PREDICTIONS},
            few AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY phase, split ORDER BY row_id) AS rn FROM p)
                    WHERE rn <= 100 AND split IN ('validation', 'test')),
            {_metric_ctes("few")} SELECT phase, split, metric, round(value, 6) AS value FROM table6""",
        "clean_metric_names": f"WITH {_EVAL} SELECT phase, split, metric, round(value, 6) AS value FROM table6",
        "compare_evals": f"""WITH {_EVAL}, {_DELTA} SELECT split, metric, round(baseline, 6) AS baseline,
            round(after, 6) AS after, round(delta, 6) AS delta, metric = 'f1_macro' AS is_primary FROM delta""",
        "comparison_json": f"""WITH {_EVAL}, {_DELTA} SELECT 'fixture' AS model_id, 10::BIGINT AS num_labels,
            section, split, metric, round(value, 6) AS value FROM (
              SELECT phase AS section, split, metric, value FROM table6
              UNION ALL SELECT 'delta', split, metric, delta FROM delta)""",
        "tokenize": f"""WITH {_TOKENS} SELECT row_id, label AS labels, array_to_string(tokens, ' ') AS tokens,
            len(tokens) AS n_tokens FROM t""",
        "truncate_tokens": f"""WITH {_TOKENS} SELECT row_id, array_to_string(tokens[1:{MAX_TOKENS}], ' ') AS tokens,
            len(tokens[1:{MAX_TOKENS}]) AS n_tokens FROM t""",
        "tokenize_custom": f"""WITH {_DOCS} SELECT row_id, array_to_string(list_transform(
            string_split(clean, ' '), lambda x: length(x)::VARCHAR), ' ') AS ids FROM d""",
        "pad_batches": f"""WITH {_PADDED} SELECT row_id, batch_id, array_to_string(list_concat(tokens, filler), ' ') AS tokens,
            repeat('1', len(tokens)) || repeat('0', gap) AS mask FROM padded""",
        "pad_batches_left": f"""WITH {_PADDED} SELECT row_id, batch_id,
            array_to_string(list_concat(filler, tokens), ' ') AS tokens FROM padded""",
        "evaluation_batches": f"""WITH {_DOCS},
            cut AS (SELECT row_id, split, regexp_extract_all(text, '{_TOKEN}') AS tokens,
                           (row_number() OVER (PARTITION BY split ORDER BY row_id) - 1) // {BATCH} AS batch_id FROM d),
            sized AS (SELECT *, max(len(tokens)) OVER (PARTITION BY split, batch_id) - len(tokens) AS gap FROM cut)
            SELECT row_id, split, batch_id, array_to_string(
              list_concat(list_transform(range(gap), lambda i: '[PAD]'), tokens), ' ') AS tokens FROM sized""",
        "csv_roundtrip": "SELECT text, source AS category FROM documents",
        "csv_strict": "SELECT text, source AS category FROM documents",
        "land_raw": "SELECT doc_id AS row_id, text FROM documents",
        "load_labelled_pair": f"WITH {_DOCS} SELECT text, lang AS category, label, split FROM e",
        "label_map_roundtrip": """SELECT row_number() OVER (ORDER BY source) - 1 AS label, source AS category
            FROM (SELECT DISTINCT source FROM documents)""",
        "preprocess_job": f"""WITH {_SPLIT}
            SELECT k.text, k.category, k.label, a.split FROM kept k JOIN assigned a ON a.row_id = k.row_id
            UNION ALL SELECT clean, lang, label, 'test' FROM e WHERE split = 'test'""",
        "preprocess_summary": f"""WITH {_SPLIT}, every AS (
              SELECT split, label FROM assigned UNION ALL SELECT split, label FROM e WHERE split = 'test')
            SELECT split, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_labels,
                   min(n) AS min_per_class, max(n) AS max_per_class
            FROM (SELECT split, label, count(*) AS n FROM every GROUP BY split, label) GROUP BY split""",
        "preprocess_no_dedupe": f"""WITH {_DOCS}, base_rows AS (SELECT row_id, label FROM e WHERE split = 'train'),
            {_split_ctes("base_rows")} SELECT row_id, label, split FROM assigned
            UNION ALL SELECT row_id, label, split FROM e WHERE split = 'test'""",
        "untrained_baseline": f"""WITH q AS (
              SELECT doc_id, quality::BIGINT AS label, CASE WHEN digit < '3' THEN 'test'
                     WHEN digit < '5' THEN 'validation' ELSE 'train' END AS split
              FROM (SELECT doc_id, quality, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) AS digit
                    FROM documents JOIN labels USING (doc_id))),
            prior AS (
              SELECT ln((count(*) FILTER (label = 0) + 1)::DOUBLE / (count(*) + 2)) AS l0,
                     ln((count(*) FILTER (label = 1) + 1)::DOUBLE / (count(*) + 2)) AS l1
              FROM q WHERE split = 'train'),
            judged AS (
              SELECT 'baseline' AS phase, split, label, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS prediction,
                     ln(exp(l0) + exp(l1)) - CASE WHEN label = 0 THEN l0 ELSE l1 END AS loss
              FROM q, prior WHERE split <> 'train'),
            {_metric_ctes("judged")} SELECT phase, split, metric, round(value, 6) AS value FROM table6""",
        "stream_landing": f"WITH {_DOCS} SELECT row_id, clean AS text, lang AS category, label FROM e",
    }
    return sql | _preparation_sql() | (llm_queries.ORACLES if llm_queries else {})
