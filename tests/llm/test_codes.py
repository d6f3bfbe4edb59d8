"""Vector codes against plain loops over whole numbers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

import oracle
from labelloom.llm import codes, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, key string"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector, label), all of one length."""
    kept = [(i, [math.floor(1024 * x) for x in v], y) for i, v, y in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in order] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for row in cut:
                members.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            for e, own in members.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, y), e in zip(kept, errors, strict=True):
        by_label[y] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in f), error, by_label[y], digest)
        for (i, _, y), f, error in zip(kept, found, errors, strict=True)
    )


def as_rows(spark, rows):
    return spark.createDataFrame([(i, v, y, "c", "k") for i, v, y in rows], SCHEMA)


def found(df, **options):
    return Counter(tuple(r) for r in codes.compress(df, **options).collect())


@pytest.mark.parametrize("spread", [1, 30, 4_000_000])
def test_search_equals_all_distances(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (90, 5))
    entries[40:60] = entries[10:30]  # equal entries: the smaller index
    vectors = rng.integers(-spread, spread + 1, (700, 5))
    lists = codes.sorted_lists(entries)
    apart = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
    for start in (None, rng.integers(0, 90, 700)):
        best, distance = codes.orchard_search(vectors, lists, start)
        assert (best == apart.argmin(axis=1)).all()
        assert (distance == apart.min(axis=1)).all()


def test_search_looks_at_few_entries_of_clusters():
    """Lists stop early where entries are in clusters."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-50_000, 50_000, (32, 4))
    entries = np.repeat(centres, 8, axis=0) + rng.integers(-20, 20, (256, 4))
    vectors = centres[rng.integers(0, 32, 500)] + rng.integers(-20, 20, (500, 4))
    lists = codes.sorted_lists(entries)
    best, distance = codes.orchard_search(vectors, lists)
    reach = (lists.gaps[best] <= 4 * distance[:, None]).sum(axis=1)
    assert reach.mean() < 20
    assert (distance == ((vectors[:, None] - entries[None]) ** 2).sum(axis=2).min(axis=1)).all()


def test_codes_equal_plain_loops(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i) * 3 % 401, rng.normal(size=8).tolist(), int(i) % 3 or None) for i in range(401)]
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]
    assert found(as_rows(spark, rows).repartition(5), entries=20) == plain_codes(rows, entries=20)


def test_third_of_rows_equal_and_one_label(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [0.5, -0.25] * 4 if i % 3 == 0 else [float(np.float32(x)) for x in rng.normal(size=8)], 1 if i % 3 else None) for i in range(300)]
    assert found(as_rows(spark, rows).repartition(5), entries=16) == plain_codes(rows, entries=16)


def test_codes_odd(spark):
    good = [(k, [float(k), -1.5, 0.0, 2.25], None if k % 2 else k) for k in range(3)]
    good += [(None, [9.0, 9.0, 9.0, 9.0], 1), (1, [1.0, -1.5, 0.0, 2.25], 1), (1, [1.0, -1.5, 0.0, 2.25], 1)]
    bad = [
        (10, None, 1),
        (11, [], 1),
        (12, [1.0, None, 1.0, 1.0], 1),
        (13, [1.0, float("nan"), 1.0, 1.0], 1),
        (14, [1.0, float("inf"), 1.0, 1.0], 1),
        (15, [1.0, 1.0, 1.0], 1),
        (16, [1.0] * 8, 1),
    ]
    docs = as_rows(spark, good + bad)
    assert found(docs) == plain_codes(good)
    assert found(docs, entries=2) == plain_codes(good, entries=2)
    assert found(docs.limit(0)) == Counter()
    assert found(docs.where("vec_id > 9 AND size(embedding) < 4")) == Counter()
    huge = as_rows(spark, [(1, [3e38, 0.0, 0.0, 0.0], 1), (2, [-3e38, 0.0, 0.0, 0.0], 1)])
    assert sorted(r[1:3] for r in found(huge)) == [("00000000", 0), ("01000000", 0)]


def test_query_equals_plain_loops_and_sql(spark):
    df = queries.op12_codes(spark, SF)
    con, sql = oracle.connect(SF), queries.ORACLES["op12_codes"]
    assert oracle.spark_rows(df) == oracle.sql_rows(con, sql)
    assert oracle.type_mismatches(df, con, sql) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert Counter(tuple(r) for r in df.collect()) == plain_codes(rows)
