import json

import pytest
from pyspark.sql import functions as F

from labelloom import __main__ as cli
from labelloom.config import CONFIG_ENV, JobConfig
from labelloom.functions.labels import encode_labels, label_dim
from labelloom.operators.guards import MissingLabelError, NullTextError, UnknownLabelError
from labelloom.plans.eda import run_eda
from labelloom.plans.load import load_labelled_pair, stack_splits
from labelloom.plans.preprocess import preprocess
from labelloom.plans.train import train_and_compare
from labelloom.storage import scratch_path, shared_dir

LABELS = ("refund", "card", "Loan?")
WORDS = {"refund": "money back please", "card": "lost my plastic", "Loan?": "borrow cash now"}


def rows(n):
    return [(f"{WORDS[LABELS[i % 3]]}  number {i % (n - 4)}", LABELS[i % 3]) for i in range(n)]


@pytest.fixture
def files(tmp_path):
    def write(name, data):
        path = tmp_path / name
        path.write_text("text,category\n" + "".join(f'"{t}","{c}"\n' for t, c in data))
        return str(path)

    return write("train.csv", rows(60)), write("test.csv", rows(30))


def test_load_pair(spark, files, tmp_path):
    train, test = files
    pair = load_labelled_pair(spark, train, test, str(tmp_path / "raw"), labels=LABELS)
    assert {r["split"]: r["count"] for r in pair.groupBy("split").count().collect()} == {"train": 60, "test": 30}
    assert {(r["category"], r["label"]) for r in pair.select("category", "label").distinct().collect()} == {
        (c, i) for i, c in enumerate(LABELS)
    }
    with pytest.raises(UnknownLabelError):
        load_labelled_pair(spark, train, test, labels=LABELS[:2])
    with pytest.raises(MissingLabelError):
        load_labelled_pair(spark, train, test, labels=(*LABELS, "never"))
    raw = load_labelled_pair(spark, train, test, labels=("x",), encode=False, validate=False)
    assert "label" not in raw.columns
    empty = tmp_path / "empty.csv"
    empty.write_text("text,category\n,card\n")
    with pytest.raises(NullTextError):
        load_labelled_pair(spark, train, str(empty), labels=LABELS)


def test_preprocess_invariants(spark, files, tmp_path):
    pair = load_labelled_pair(spark, *files, cache_dir=str(tmp_path / "raw"), labels=LABELS)
    done = preprocess(pair, 0.2, 7, str(tmp_path / "out"), labels=LABELS)
    splits = done.splits.toPandas()
    train = splits[splits.split != "test"]
    # i % 56 repeats 0..3 with i = 56..59; the labels repeat only if 56 % 3 == 0.
    source = pair.where("split = 'train'").toPandas()
    source["text"] = source.text.str.split().str.join(" ")
    unique = source.sort_values("row_id").drop_duplicates(["text", "label"])
    assert done.removed == len(source) - len(unique)
    assert set(train.row_id) == set(unique.row_id)
    assert not train.duplicated(["text", "label"]).any() and train.row_id.is_unique
    assert (splits.split == "test").sum() == 30
    assert not splits.text.str.contains("  ").any()
    summary = {r["split"]: r["n_rows"] for r in done.summary.collect()}
    assert summary == splits.groupby("split").size().to_dict()
    assert summary["validation"] == -(-len(unique) // 5)
    written = spark.read.parquet(str(tmp_path / "out" / "splits" / "split=train"))
    assert written.columns == ["row_id", "text", "category", "label"] and written.count() == summary["train"]

    again = preprocess(pair.repartition(5), 0.2, 7, labels=LABELS).splits.toPandas()
    key = ["row_id", "split"]
    assert set(map(tuple, again[key].values)) == set(map(tuple, splits[key].values))


def test_preprocess_without_dedupe_and_missing_label(spark, files):
    pair = load_labelled_pair(spark, *files, labels=LABELS)
    done = preprocess(pair, 0.2, 7, dedupe=False, labels=LABELS)
    assert done.removed == 0 and done.splits.count() == 90
    with pytest.raises(MissingLabelError, match="never"):
        load_labelled_pair(spark, *files, labels=(*LABELS, "never"))
    no_card = pair.where("split = 'train' or category <> 'card'")
    with pytest.raises(MissingLabelError, match="test"):
        preprocess(no_card, 0.2, 7, labels=LABELS)


def test_hot_text_and_hot_class(spark):
    """A third of the rows share one text, nearly all rows share one class."""
    n = 9000
    df = spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("t "), F.col("id"))).alias("text"),
        F.when(F.col("id") % 1000 == 1, "b").otherwise("a").alias("category"),
    )
    test = df.limit(0).unionByName(
        spark.createDataFrame([(0, "x", "a"), (1, "y", "b")], "row_id long, text string, category string")
    )
    pair = encode_labels(stack_splits(train=df, test=test), label_dim(spark, ["a", "b"]))
    done = preprocess(pair, 0.25, 1, labels=("a", "b"))
    sizes = {r["split"]: r["n_rows"] for r in done.summary.collect()}
    hot = df.where("id % 3 = 0" if "id" in df.columns else "row_id % 3 = 0").select("category").distinct().count()
    kept = 6000 + hot
    assert done.removed == n - kept
    assert sizes["train"] + sizes["validation"] == kept and sizes["validation"] == -(-kept // 4)


def test_eda(spark, files, tmp_path):
    pair = load_labelled_pair(spark, *files, labels=LABELS)
    report = run_eda(pair, str(tmp_path / "eda"), top_n=2)
    assert report.checks.count() == 10
    assert report.longest_classes.count() == 2
    assert report.histogram.groupBy("split").count().where("count <> 40").isEmpty()
    (part,) = (tmp_path / "eda" / "eda_summary.csv").glob("part-*")
    header = part.read_text().splitlines()[0]
    assert header == (
        "category,train_count,train_avg_words,train_max_words,"
        "test_count,test_avg_words,test_max_words,train_share_%"
    )


def test_training_beats_the_untrained_predictor(spark, tmp_path):
    data = [(i, f"{WORDS[LABELS[i % 3]]} {i}", i % 3, ("train", "train", "validation", "test")[i // 3 % 4]) for i in range(240)]
    splits = spark.createDataFrame(data, "row_id long, text string, label long, split string")
    result = train_and_compare(splits, 3, out_dir=str(tmp_path / "run"))
    value = {(r["phase"], r["split"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert value["after_lora", "test", "accuracy"] == 1.0
    assert value["baseline", "test", "accuracy"] < 0.5
    assert value["after_lora", "test", "loss"] < value["baseline", "test", "loss"]
    assert result.delta.where("is_primary").count() == 2
    (part,) = (tmp_path / "run" / "evaluation_comparison.json").glob("part-*")
    assert set(json.loads(part.read_text())) == {"model_id", "num_labels", "baseline", "after_lora", "delta"}
    alone = train_and_compare(splits, 3, run_baseline=False)
    assert alone.delta.count() == 0 and alone.metrics.count() == 12


def test_command_line(spark, files, tmp_path, capsys, monkeypatch):
    labels = tmp_path / "labels.txt"
    labels.write_text("\n".join(LABELS) + "\n")
    monkeypatch.setattr(cli, "build_session", lambda *_: spark)
    common = ["--train", files[0], "--test", files[1], "--labels", str(labels)]
    cli.main(["preprocess", *common, "--out", str(tmp_path / "p"), "--val-size", "0.2", "--layout", "per_split"])
    assert (tmp_path / "p" / "validation.parquet" / "_SUCCESS").exists()
    cli.main(["eda", *common, "--out", str(tmp_path / "e")])
    cli.main(
        ["train", "--data-dir", str(tmp_path / "p"), "--output-dir", str(tmp_path / "t"), "--expected-labels", "3"]
    )
    assert (tmp_path / "t" / "evaluation_comparison.json" / "_SUCCESS").exists()
    assert "duplicate_texts_train" in capsys.readouterr().out


def test_config(tmp_path, monkeypatch):
    file = tmp_path / "c.json"
    file.write_text(
        json.dumps(
            {
                "paths": {"data_dir": "data", "output_dir": "s3a://bucket/out", "cache_dir": "ignored"},
                "model": {"max_length": 128, "padding_side": "left", "model_id": "ignored"},
                "training": {"seed": 1, "max_train_samples": 5, "per_device_eval_batch_size": 3},
                "evaluation": {"splits": ["test"], "run_baseline_before_training": False},
            }
        )
    )
    config = JobConfig.load(str(file))
    assert config.data_dir == f"{tmp_path}/data" and config.output_dir == "s3a://bucket/out"
    assert (config.max_length, config.padding_side, config.seed) == (128, "left", 1)
    assert config.eval_splits == ("test",) and not config.run_baseline and config.eval_batch_size == 3
    assert config.override(seed=9, data_dir=None) == JobConfig.load(str(file)).override(seed=9)
    monkeypatch.setenv(CONFIG_ENV, str(file))
    assert JobConfig.load() == config
    monkeypatch.delenv(CONFIG_ENV)
    assert JobConfig.load() == JobConfig()
    with pytest.raises(FileNotFoundError):
        JobConfig.load(str(tmp_path / "none.json"))
    for bad in ({"max_length": 31}, {"max_length": 4097}, {"padding_side": "top"}, {"val_size": 0.0},
                {"eval_splits": ()}, {"max_train_samples": 0}, {"eval_batch_size": 0}):
        with pytest.raises(ValueError):
            JobConfig(**bad)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a").startswith(configured) and scratch_path(spark, "a") != scratch_path(spark, "a")
