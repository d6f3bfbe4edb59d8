import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import metrics

SCHEMA = "row_id long, phase string, split string, label int, logits array<float>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(labels, logits):
    labels = np.array(labels)
    logits = np.array(logits, dtype=np.float32).astype(float)
    pred = logits.argmax(axis=1)
    classes = sorted(set(labels) | set(pred))
    p, r, f, s = [], [], [], []
    for c in classes:
        tp = ((labels == c) & (pred == c)).sum()
        n_pred, n_true = (pred == c).sum(), (labels == c).sum()
        p.append(tp / n_pred if n_pred else 0.0)
        r.append(tp / n_true if n_true else 0.0)
        f.append(2 * tp / (n_pred + n_true))
        s.append(n_true)
    top = logits.max(axis=1)
    loss = np.log(np.exp(logits - top[:, None]).sum(axis=1)) + top - logits[np.arange(len(labels)), labels]
    return {
        "accuracy": (labels == pred).mean(),
        "f1_macro": np.mean(f),
        "f1_weighted": np.average(f, weights=s),
        "precision_macro": np.mean(p),
        "recall_macro": np.mean(r),
        "loss": loss.mean(),
    }


def random_rows(seed, phases=("baseline", "after_lora"), splits=("validation", "test"), n=40):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for split in splits:
        for _ in range(n):
            label = int(rng.integers(0, 4))  # class 4 is never a label
            for phase in phases:
                rows.append((i, phase, split, label, [float(x) for x in rng.normal(size=5).round(3)]))
            i += 1
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_all_metrics_match_brute_force(spark, seed):
    rows = random_rows(seed)
    got = metrics.evaluate_splits(frame(spark, rows).repartition(5))
    table = {(r["phase"], r["split"], r["metric"]): r["value"] for r in got.collect()}
    assert len(table) == 2 * 2 * 6
    for phase in ("baseline", "after_lora"):
        for split in ("validation", "test"):
            mine = [r for r in rows if r[1] == phase and r[2] == split]
            for name, value in brute([r[3] for r in mine], [r[4] for r in mine]).items():
                assert table[phase, split, name] == pytest.approx(value, abs=1e-12)


def test_first_rows_per_split(spark):
    rows = random_rows(3)
    got = metrics.evaluate_splits(frame(spark, rows), ("test",), max_eval_samples=7)
    table = {(r["phase"], r["metric"]): r["value"] for r in got.collect()}
    mine = sorted(r for r in rows if r[1] == "baseline" and r[2] == "test")[:7]
    want = brute([r[3] for r in mine], [r[4] for r in mine])
    for name, value in want.items():
        assert table["baseline", name] == pytest.approx(value, abs=1e-12)
    everything = metrics.evaluate_splits(frame(spark, rows), ("test",), max_eval_samples=10_000)
    assert everything.count() == 12


def test_first_rows_with_other_ids_per_phase(spark):
    rows = [r for r in random_rows(4) if r[1] == "baseline" or r[0] % 2]
    got = metrics.evaluate_splits(frame(spark, rows), ("test",), max_eval_samples=9)
    table = {(r["phase"], r["metric"]): r["value"] for r in got.collect()}
    for phase in ("baseline", "after_lora"):
        mine = sorted(r for r in rows if r[1] == phase and r[2] == "test")[:9]
        want = brute([r[3] for r in mine], [r[4] for r in mine])
        assert {n: table[phase, n] for n in want} == pytest.approx(want)


def test_several_model_outputs(spark):
    plain = frame(spark, random_rows(5))
    want = sorted(map(tuple, metrics.confusion(plain).collect()))
    other = F.array(F.lit(9.0).cast("float"))
    for packed in (F.struct(F.col("logits").alias("z"), other), F.array(F.col("logits"), other)):
        assert sorted(map(tuple, metrics.confusion(plain.withColumn("logits", packed)).collect())) == want


def test_unknown_split_is_an_error(spark):
    with pytest.raises(KeyError, match="holdout"):
        metrics.evaluate_splits(frame(spark, random_rows(0)), ("test", "holdout"))


def test_compute_metrics_of_one_set(spark):
    rows = [(i, "p", "s", y, z) for i, (y, z) in enumerate([(0, [1.0, 1.0]), (1, [0.0, 2.0]), (1, [3.0, 2.0])])]
    got = {r["metric"]: r["value"] for r in metrics.compute_metrics(frame(spark, rows)).collect()}
    want = brute([r[3] for r in rows], [r[4] for r in rows])
    want.pop("loss")
    assert got == pytest.approx(want)


def test_names_are_cleaned_everywhere_in_them(spark):
    df = spark.createDataFrame(
        [("p", "test", "test_loss", 1.0), ("p", "test", "test_x_test_y", 2.0), ("p", "test", "test_note", None)],
        "phase string, split string, metric string, value double",
    )
    got = {r["metric"]: r["value"] for r in metrics.clean_metric_names(df).collect()}
    assert got == {"loss": 1.0, "x_y": 2.0}


def test_comparison_keeps_common_pairs_only(spark):
    df = spark.createDataFrame(
        [
            ("baseline", "test", "f1_macro", 0.25), ("after_lora", "test", "f1_macro", 0.75),
            ("baseline", "test", "accuracy", 0.5), ("after_lora", "test", "accuracy", 0.25),
            ("baseline", "test", "old", 1.0), ("after_lora", "test", "new", 1.0),
            ("baseline", "dev", "f1_macro", 1.0), ("after_lora", "extra", "f1_macro", 1.0),
        ],
        "phase string, split string, metric string, value double",
    )
    got = {(r["split"], r["metric"]): (r["delta"], r["is_primary"]) for r in metrics.compare_evaluations(df).collect()}
    assert got == {("test", "f1_macro"): (0.5, True), ("test", "accuracy"): (-0.25, False)}


def test_one_shuffle_for_all_phases_and_splits(spark):
    cells = metrics.confusion(frame(spark, random_rows(0)))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    assert cells.where(F.col("n") > 0).count() == cells.count()


def test_null_logits_fail_and_undefined_losses_fail_the_loss_only(spark):
    rows = [(1, "p", "test", 0, [2.0, 1.0]), (2, "p", "test", 1, None)]
    with pytest.raises(Exception, match="must not be null"):
        metrics.confusion(spark.createDataFrame(rows, SCHEMA)).collect()
    rows = [(1, "p", "test", 0, [2.0, 1.0]), (2, "p", "test", 5, [0.0, 1.0])]
    cells = metrics.confusion(spark.createDataFrame(rows, SCHEMA))
    assert metrics.metric_table(cells, with_loss=False).count() == 5
    with pytest.raises(Exception, match="the loss is undefined"):
        metrics.metric_table(cells).collect()
