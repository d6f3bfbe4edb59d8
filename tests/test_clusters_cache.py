"""Centers, drift by batch and the semantic cache against plain versions."""

import glob
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import cache, clusters, monitoring
from labelloom.streaming.drift import batch_drift, drift_per_batch
from labelloom.streaming.landing import stream_files

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def random_rows(seed, n, d=8):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(size=d)]) for i in range(n)]


def plain_centers(rows, k, rounds):
    x = np.array([v for _, v in sorted(rows)], dtype=np.float64)
    c = x[:k].round(6)
    for _ in range(rounds):
        own = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[own == e].mean(axis=0).round(6) if (own == e).any() else c[e] for e in range(len(c))])
    return c


def test_centers_do_not_depend_on_layout(spark):
    rows = random_rows(1, 300)
    expected = plain_centers(rows, 6, 4)
    for parts in (1, 7):
        got = clusters.fit_centers(vectors(spark, rows).repartition(parts), 6, 4)
        assert np.allclose(got, expected, atol=1e-6)
    assert clusters.fit_centers(vectors(spark, rows).limit(0), 6) == []
    assert len(clusters.fit_centers(vectors(spark, rows[:3] + [(9, None)]), 6)) == 3


def test_empty_clusters_count(spark, tmp_path):
    base = vectors(spark, [(0, [0.0, 0.0]), (1, [10.0, 0.0]), (2, [0.0, 10.0]), (3, [0.0, 10.1])])
    live = vectors(spark, [(0, [0.1, 0.0]), (1, None), (2, [9.0, 0.5])])
    got = {r["cluster"]: (r["p"], r["q"]) for r in monitoring.stability_index(base, live, k=3, path=str(tmp_path / "b")).collect()}
    assert got == {0: (0.25, 0.5), 1: (0.25, 0.5), 2: (0.5, 1e-4)}
    saved = spark.read.parquet(str(tmp_path / "b"))
    assert saved.count() == 3 and saved.agg(F.sum("n")).first()[0] == 4
    with pytest.raises(ValueError):
        clusters.save_baseline(base.limit(0), str(tmp_path / "none"), 3)


def test_drift_per_batch_equals_batch_and_survives_replay(spark, tmp_path):
    base = vectors(spark, random_rows(2, 200))
    path = str(tmp_path / "baseline")
    clusters.save_baseline(base, path, 5)
    known = clusters.read_baseline(spark, path)
    arrived, out, checkpoint = (str(tmp_path / n) for n in ("arrived", "out", "checkpoint"))

    def run():
        stream = stream_files(spark, arrived, base.schema)
        return {r["batch_id"]: r for r in drift_per_batch(stream, path, out, checkpoint).collect()}

    parts = [random_rows(3, 60), [(i, [x + 2 for x in v]) for i, v in random_rows(4, 40)], [(1, None)]]
    for k, rows in enumerate(parts):
        live = vectors(spark, rows)
        live.write.mode("append").parquet(arrived)
        got = run()
        assert sorted(got) == list(range(k + 1))
        alone = batch_drift(live, known).first()
        assert got[k]["n"] == alone["n"] == sum(v is not None for _, v in rows)
        assert got[k]["psi"] == alone["psi"] and got[k]["cosine"] == alone["cosine"]
    index = monitoring.stability_rows(vectors(spark, parts[1]), known[0], known[1])
    assert got[1]["psi"] == pytest.approx(index.agg(F.sum("psi")).first()[0])
    assert got[1]["psi"] > got[0]["psi"] and got[2]["psi"] is None and got[2]["cosine"] is None
    drift = monitoring.centroid_drift(base, vectors(spark, parts[1]), "label").first()
    assert got[1]["cosine"] == pytest.approx(drift["cosine"])
    # The last batch was written but not committed.
    os.remove(max(glob.glob(f"{checkpoint}/commits/[0-9]*")))
    for crc in glob.glob(f"{checkpoint}/commits/.*.crc"):
        os.remove(crc)
    assert run() == got


def brute(rows, threshold, every):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every:
            continue
        scored = [(round(float(q @ x / np.linalg.norm(q) / np.linalg.norm(x)), 12), -j) for j, x in good if j != i]
        if scored and max(scored)[0] >= threshold:
            out[i] = (-max(scored)[1], max(scored)[0])
    return out


def lookup(df, threshold, every, **options):
    found = cache.cache_lookup(df, F.col("vec_id") % every == 0, threshold, **options).collect()
    assert len({r["query_id"] for r in found}) == len(found)
    return {r["query_id"]: (r["vec_id"], round(r["cosine"], 12)) for r in found}


def test_few_entries_are_all_looked_at(spark):
    rows = random_rows(5, 250)
    assert lookup(vectors(spark, rows), 0.5, 5) == brute(rows, 0.5, 5)


def test_recall_among_many_entries_and_a_hot_bucket(spark):
    """A third of the entries nearly alike, more than a block of them."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.05 if i % 3 == 0 else rng.normal(size=16)).astype(np.float32).tolist()) for i in range(15_000)]
    for i in range(1, 15_000, 500):  # pairs just above the threshold
        other = rng.normal(size=16)
        v = np.array(rows[i][1])
        other -= v * (other @ v) / (v @ v)
        w = 0.82 * v / np.linalg.norm(v) + math.sqrt(1 - 0.82**2) * other / np.linalg.norm(other)
        rows[i + 1] = (i + 1, w.astype(np.float32).tolist())
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asks = np.arange(0, 15_000, 50)
    scores = x[asks] @ x.T
    scores[np.arange(len(asks)), asks] = -2
    expected = {int(i): int(s.argmax()) for i, s in zip(asks, scores, strict=True) if s.max() >= 0.8}
    got = lookup(vectors(spark, rows), 0.8, 50)
    assert set(got) <= set(expected)
    assert sum(got.get(i, (None,))[0] == j for i, j in expected.items()) / len(expected) >= 0.9


def test_cache_odd(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [2.0, 0.1]), (7, [2.0, 0.1]), (10, None), (15, [0.0, 0.0]), (20, [float("nan"), 1.0]), (25, [1.0]), (None, [1.0, 0.0])]
    got = lookup(vectors(spark, rows), 0.9, 5)
    assert {k: v[0] for k, v in got.items()} == {0: 5, 5: 7}
    assert lookup(vectors(spark, rows).limit(0), 0.9, 5) == {}


def test_tables_follow_from_the_recall_wanted():
    for n, threshold in ((100_000, 0.9), (10_000_000, 0.8)):
        buckets = cache.plan_buckets(n, 64, threshold, 0.95)
        tables, bits, _ = buckets.planes.shape
        met = cache.chance_to_meet(bits, threshold)
        assert 1 - (1 - met) ** tables >= 0.95 > 1 - (1 - met) ** (tables - 1)
        assert n / 2**bits < 2 * cache.BUCKET_ROWS
