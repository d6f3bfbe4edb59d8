"""Classes of similar texts against all pairs; components against a plain search."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import similarity
from labelloom.operators.components import component_labels


def plain_classes(rows, words=5, num=80, den=100):
    sets, sizes = {}, {}
    for i, text in rows:
        w = (text or "").strip().lower().split()
        runs = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets[i], sizes[i] = runs, len(runs)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        common = len(sets[i] & sets[j])
        if common and den * common >= num * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: (sizes[i], root(i)) for i in sets}


def classes(spark, rows, parts=5, **options):
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(parts)
    out = similarity.near_duplicate_classes(df, **options).collect()
    assert len(out) == len(rows)
    return {r["row_id"]: (r["n_shingles"], r["component_id"]) for r in out}


def changed(rng, words, n):
    own = list(words)
    for _ in range(n):
        own[rng.randrange(len(own))] = f"e{rng.random()}"
    return " ".join(own)


@pytest.mark.parametrize("crowd", [2, 24])
def test_shared_passages_and_near_copies(spark, crowd):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"u{k}_{j}" for j in range(rng.choice([2, 8, 40]))]) for k in range(30)]
    for k in range(10):
        base = passage + [f"w{k}_{j}" for j in range(60)]
        texts += [changed(rng, base, rng.choice([1, 2, 3])) for _ in range(6)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = classes(spark, rows, crowd=crowd)
    assert got == plain_classes(rows)
    assert 30 < len({c for _, c in got.values()}) < len(rows)


def test_crowd_of_near_copies_and_a_chain(spark):
    """A third of the rows alike; a chain whose ends are unlike; one crowd that
    falls into classes which its leaders don't all see."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    texts = [changed(rng, base, rng.choice([0, 1, 2, 4, 6, 9])) for _ in range(150)]
    chain = [f"c{i}" for i in range(100)]
    for k in range(60):
        chain[k] = f"d{k}"
        texts.append(" ".join(chain))
    texts += [" ".join(base[:60] + [f"x{k % 9}_{j}" for j in range(30)] + [f"y{k}"]) for k in range(60)]
    texts += [" ".join(f"z{rng.randrange(4000)}" for _ in range(30)) for _ in range(100)]
    rows = list(enumerate(texts))
    assert classes(spark, rows, crowd=8) == plain_classes(rows)


def test_odd_rows(spark):
    long_text = " ".join(f"w{i % 5000}_{i % 7}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one two "), (6, "one two three"), (7, long_text), (8, long_text + " end"), (9, "a a a a a a a")]
    assert classes(spark, rows) == plain_classes(rows)
    empty = spark.createDataFrame([], "row_id long, text string")
    assert similarity.near_duplicate_classes(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b", 1, "x")], "row_id long, text string, n_shingles int, shingle string")
    assert similarity.near_duplicate_classes(clash).collect() == [(1, 1, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    links += [(500, 600 + i) for i in range(50)] + [(7, 7)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = component_labels(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["label"] for r in got.collect()} == {x: root(x) for x in parent}
    assert component_labels(got.limit(0).select(F.col("node").alias("a"), F.col("label").alias("b"))).count() == 0
