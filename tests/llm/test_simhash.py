"""SimHash fingerprints and their groups against plain versions."""

import random
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest
import xxhash

from labelloom.llm import queries, simhash

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, code long, component_id string, part string"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """items: (id, value); the smallest id of each item's component."""
    parent = list(range(len(items)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in combinations(range(len(items)), 2):
        if linked(items[i][1], items[j][1]):
            parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(items):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(items))]


def plain_groups(rows):
    codes = [(i, plain_fingerprint(t)) for i, t in rows]
    groups = components(codes, lambda a, b: (a ^ b).bit_count() <= 2)
    return Counter((i, f"{c:016x}", g) for (i, c), g in zip(codes, groups, strict=True))


def groups_of(docs, **options):
    return Counter(tuple(r) for r in simhash.near_duplicates(docs, **options).collect())


def as_docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "c", "p") for i, t in rows], SCHEMA)


def random_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 40, 200]))) for _ in range(n)]
    for i in range(0, n, 3):  # near copies, some with one word changed
        base = texts[i - i % 30].split()
        base[rng.randrange(len(base))] = rng.choice(words)
        texts[i] = " ".join(base)
    return list(enumerate(texts))


@pytest.mark.parametrize("parts", [2, 3, 4])
@pytest.mark.parametrize("crowded", [1, 128])
def test_groups_equal_all_pairs(spark, parts, crowded):
    rows = random_texts(parts, 260)
    assert groups_of(as_docs(spark, rows), parts=parts, crowded=crowded) == plain_groups(rows)


def test_third_of_rows_near_copies(spark):
    rng = random.Random(1)
    base = [f"t{rng.randrange(90)}" for _ in range(400)]
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(400)] = f"u{i}"
        rows.append((i, " ".join(own)))
    rows += [(300 + i, "the same text of every copy here") for i in range(300)]
    rows += [(600 + i, " ".join(rng.choices([f"x{k}" for k in range(500)], k=30))) for i in range(200)]
    docs = as_docs(spark, rows).repartition(7)
    assert groups_of(docs, crowded=16) == plain_groups(rows)


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op13_simhash(spark, SF).collect()) == plain_groups(rows)


def test_links_among_all_points_near_one(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    codes = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(400)}
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    items = [(c, c % (1 << 64)) for (c,) in signed]
    expected = dict(zip([c for c, _ in items], components(items, lambda a, b: (a ^ b).bit_count() <= 2), strict=True))
    for crowded in (2, 1_000):
        links = simhash.fingerprint_links(spark.createDataFrame(signed, "code long"), crowded, 3).collect()
        assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 2 for r in links)
        linked = {frozenset((r["a"], r["b"])) for r in links}
        parent = {c: c for c in expected}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for pair in linked:
            a, b = sorted(map(root, pair))
            parent[b] = a
        assert {c: root(c) for c in parent} == expected


def test_thresholds_are_cheapest(spark):
    rng = np.random.default_rng(2)
    costs = rng.random((40, 3, 4)).cumsum(axis=2)
    got = simhash.allocate(costs, 0)
    for k in range(40):
        assert got[k].sum() == 0
        all_of = {t: sum(costs[k, p, t[p] + 1] for p in range(3)) for t in product(range(-1, 3), repeat=3) if sum(t) == 0}
        assert all_of[tuple(got[k])] == pytest.approx(min(all_of.values()))


def test_estimates_count_exactly_where_halves_are_independent(spark):
    codes = [(a | b << 16,) for a in range(16) for b in range(0, 256, 5)]
    groups = [list(range(0, 32)), list(range(32, 64))]
    known = simhash.estimate(spark.createDataFrame(codes, "code long"), len(codes), groups)
    values = np.array([c for (c,) in codes], dtype=np.uint64)
    got = known.candidates(values, 0)
    for k, e in product(range(0, len(codes), 37), range(3)):
        assert got[k, e] == pytest.approx(sum((codes[k][0] ^ c).bit_count() <= e for (c,) in codes))


def test_correlated_bits_stand_together():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (4_000, 64))
    for k in range(1, 16):
        bits[:, 4 * k] = bits[:, 0]  # every fourth bit is the same
    groups = simhash.group_bits(4_000, bits.T @ bits, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(set(range(0, 64, 4)) <= set(g) for g in groups)


def test_simhash_odd(spark):
    long_text = " ".join(f"word{i % 977}" for i in range(90_000))
    rows = [(None, "a b c d"), (None, None), (1, ""), (1, ""), (2, " \n\t"), (3, long_text), (4, long_text), (5, "Ä b"), (6, "ä b"), (7, "A B")]
    docs = as_docs(spark, rows)
    assert groups_of(docs) == plain_groups(rows)
    assert groups_of(docs.limit(0)) == Counter()
    assert groups_of(docs.where("doc_id = 3")) == plain_groups([(3, long_text)])
