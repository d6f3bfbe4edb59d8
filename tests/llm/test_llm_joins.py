"""Shards, mixtures, similarity, neighbours, leaks and the pipeline against plain versions."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from labelloom.llm import ann, decontamination, mixing, ngram_join, queries, sharding
from labelloom.llm.graph import connected_components
from labelloom.llm.settings import OTHER_WEIGHT, SOURCE_WEIGHTS
from labelloom.llm.words import find_words, powers

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, n string"


def rows_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, 0, "x", "y") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- shards


def check_shards(placed, n):
    rows = placed.collect()
    for s in range(n):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    return rows


def test_shards_are_near_equal_and_keep_copies(spark):
    rows = check_shards(queries.op2_shards(spark, "/root/testdata/sf0.01"), 8)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) / min(sizes.values()) < 1.1
    places = {}
    for r in rows:
        places.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(p) == 1 for p in places.values())


def test_hot_group_is_subdivided(spark):
    docs = rows_of(spark, [(i, "same text" if i % 3 else f"text {i}") for i in range(3_000)])
    sizes = Counter(r["shard"] for r in check_shards(sharding.shard_documents(docs, 4, ranges_per_shard=8), 4))
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def test_shards_odd(spark, empty):
    docs = rows_of(spark, [(None, None), (None, None), (1, ""), (1, ""), (2, "é" * 100_000)])
    rows = check_shards(sharding.shard_documents(docs, 8), 8)
    assert sorted(r["size"] for r in rows) == [1, 1, 1, 1, 200_001]
    assert sharding.shard_documents(empty, 8).count() == 0


def test_shards_end_when_no_range_can_be_cut(spark, monkeypatch):
    # A large row and a small one: by sizes, such a range is cut before its first row.
    docs = rows_of(spark, [(i, f"{i} " + "x" * (10 if i % 2 else 900)) for i in range(60)])
    narrow = docs.select(F.col("doc_id").alias("position"), sharding.text_size("text").alias("size"))
    rounds, range_of = [], sharding.range_of
    monkeypatch.setattr(sharding, "range_of", lambda s: rounds.append(list(s)) or range_of(s))
    placed = sharding.assign_shards(
        narrow, 4, F.col("position"), F.lit(0), F.col("size"), keep=("position",), ranges_per_shard=8
    )
    assert len(rounds) < 10
    assert sorted(r["position"] for r in check_shards(placed, 4)) == list(range(60))


def test_ranges_are_found_once_a_row(spark):
    """Twice in a task takes two workers, which the executor keeps."""
    keyed = rows_of(spark, [(i, "x") for i in range(9)]).selectExpr("doc_id group_key", "0L tie_key", "0L uid")
    ranged = keyed.withColumn("range", sharding.range_of([(3, 0, 0), (6, 0, 0)])).where("range = 1")
    assert [r["group_key"] for r in ranged.collect()] == [3, 4, 5]
    assert ranged._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_write_shards(spark, tmp_path):
    docs = rows_of(spark, [(i, "word " * (i + 1)) for i in range(40)]).select("doc_id", "text")
    sharding.write_shards(docs, sharding.shard_documents(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and back.select("shard").distinct().count() == 4


# --- mixtures


@pytest.mark.parametrize("weights", [[1], [1, 1], [3, 2, 1], [20, 10, 10, 8, 8, 4, 4, 2, 1], [7, 5, 3, 2]])
def test_cycle_stays_within_one_block(weights):
    order, total = mixing.pfair_cycle(weights), sum(weights)
    seen = Counter()
    for slot, source in enumerate(order, 1):
        seen[source] += 1
        for i, a in enumerate(weights):
            assert abs(seen[i] - a * slot / total) < 1
    assert [seen[i] for i in range(len(weights))] == weights


def plain_mix(rows, weights, other, block_rows, seed=42):
    """The stream slot by slot from queues of blocks."""
    import hashlib

    names = [*weights, None]
    queues = {n: [] for n in names}
    key = lambda i: hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    for i, s in sorted(rows, key=lambda r: (key(r[0]), r[0] is not None, r[0] or 0)):
        queues[s if s in weights else None].append(i)
    order = mixing.pfair_cycle([*weights.values(), other])
    stream, slot = [], 0
    while any(queues.values()):
        q = queues[names[order[slot % len(order)]]]
        stream += [(i, slot) for i in q[:block_rows]]
        del q[:block_rows]
        slot += 1
    return stream


def test_mix_equals_plain_stream(spark):
    rows = [(i, ["a", "b", "c", "z", None][min(4, i % 7)]) for i in range(900)]
    docs = spark.createDataFrame([(i, s, "x") for i, s in rows], "doc_id long, source string, slot string")
    weights = {"a": 5, "b": 3, "c": 1}
    got = mixing.mix(docs, weights, 2, block_rows=4).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(900))
    assert [(r["doc_id"], r["slot"]) for r in got] == plain_mix(rows, weights, 2, 4)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    full = [r for r in got if r["on_target"]]
    slots = max(r["slot"] for r in full) + 1
    blocks = Counter({n: len({r["block"] for r in full if r["mix_source"] == n}) for n in weights})
    assert all(abs(blocks[n] - a * slots / 11) < 1 for n, a in weights.items())


def test_mix_query_equals_plain_stream(spark):
    rows = [(r["doc_id"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op6_mix(spark, SF).orderBy("position").collect()
    assert [(r["doc_id"], r["slot"]) for r in got] == plain_mix(rows, SOURCE_WEIGHTS, OTHER_WEIGHT, mixing.BLOCK_ROWS)


def test_mix_query_equals_sql(spark):
    con = oracle.connect(SF)
    df, sql = queries.op6_mix(spark, SF), queries.ORACLES["op6_mix"]
    assert oracle.spark_rows(df) == oracle.sql_rows(con, sql)
    assert oracle.type_mismatches(df, con, sql) == []


def test_mix_plan_stays_small(spark, empty):
    """The cycle's places are a few constants and no literal each, which the
    driver would hold for every column and step of planning."""
    fields = "spark.sql.debug.maxToStringFields"
    spark.conf.set(fields, "1000000")
    try:
        plan = mixing.mix(empty, SOURCE_WEIGHTS, OTHER_WEIGHT)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset(fields)
    assert len(plan) < 60_000


def test_mix_odd(spark, empty):
    docs = rows_of(spark, [(None, None), (1, "a"), (1, "a"), (2, "")], source=None)
    assert sorted(r["position"] for r in mixing.mix(docs, {"a": 1}).collect()) == [0, 1, 2, 3]
    assert mixing.mix(empty, {"a": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})
    assert mixing.in_mixed_order(docs, {"a": 1}).columns == docs.columns


# --- components and similarity


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (100, 102), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def shingles(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if a and b and min(len(a), len(b)) * rule.den >= max(len(a), len(b)) * rule.num:
            if rule.den * len(a & b) >= rule.num * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_similar_documents_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_components(rows, ngram_join.Similarity(4, 85, 100))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op7_ngram_join(spark, SF).collect()}
    assert got == want


def edited(rng, base, share):
    words = list(base)
    for k in np.flatnonzero(rng.random(len(words)) < share):
        words[k] = f"w{rng.integers(1 << 30)}"
    return " ".join(words)


@pytest.mark.parametrize("words,num,cold", [(4, 85, 2), (5, 80, 24), (2, 60, 4)])
def test_similar_families_equal_all_pairs(spark, monkeypatch, words, num, cold):
    """Large groups of near copies, short texts and common passages; small
    limits, so that families, bands and blocks all occur."""
    monkeypatch.setattr(ngram_join, "COLD", cold)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = np.random.default_rng(words)
    base = [f"v{k}" for k in range(120)]
    passage = [f"p{k}" for k in range(25)]
    texts = [edited(rng, base, s) for s in np.repeat([0.0, 0.005, 0.01, 0.02, 0.05], 24)]
    texts += [edited(rng, base[:60], 0.01) for _ in range(20)]
    texts += [" ".join(passage + [f"q{k}_{j}" for j in range(rng.integers(0, 60))]) for k in range(60)]
    texts += ["", None, "a", "A", "a b", "a  b\n", "b a", "x y z w", "x y z w v"]
    rows = list(enumerate(texts))
    rule = ngram_join.Similarity(words, num, 100)
    docs = rows_of(spark, rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(docs, rule).collect()}
    assert got == plain_components(rows, rule)


def plain_links(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    different = {frozenset(s) for s in sets.values() if s}
    return {
        i: sum(s != o and rule.den * len(s & o) >= rule.num * len(s | o) for o in different) if s else 0
        for i, s in sets.items()
    }


def test_common_passages_make_no_families(spark, monkeypatch):
    """Texts that share passages of many texts are compared by what else they
    share; only copies that have nothing else are compared in blocks."""
    monkeypatch.setattr(ngram_join, "COLD", 4)
    monkeypatch.setattr(ngram_join, "COMPARED_AT_ONCE", 4, raising=False)
    placed = []
    links = ngram_join._family_links
    monkeypatch.setattr(ngram_join, "_family_links", lambda members, *rest: placed.append(members.count()) or links(members, *rest))
    rng = np.random.default_rng(4)
    passages = [[f"p{k}_{j}" for j in range(7)] for k in range(10)]
    texts = []
    for k in range(60):
        own = [f"w{k}_{j}" for j in range(70)]
        for x in rng.choice(10, 4, replace=False):
            at = int(rng.integers(0, len(own)))
            own[at:at] = passages[x]
        texts += [" ".join(own), edited(rng, own, 0.01)] if k % 4 else [" ".join(own)]
    groups = [f"g{j}" for j in range(100)]
    texts += [edited(rng, groups, 0.01) for _ in range(9)]
    rows = list(enumerate(texts))
    rule = ngram_join.Similarity(5, 80, 100)
    got = ngram_join.similar_documents(rows_of(spark, rows), rule, frequent=0).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows, rule)
    assert {r["doc_id"]: r["n_links"] for r in got} == plain_links(rows, rule)
    assert placed[0] <= 9


def test_similar_odd(spark, empty):
    docs = rows_of(spark, [(None, "one two three four five six"), (7, "one two three four five six"), (7, "one two three four five six"), (3, None), (None, "")])
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["n_links"]) for r in ngram_join.similar_documents(docs).collect())
    assert got == [(-1, 0, -1, 0), (-1, 2, 7, 0), (3, 0, 3, 0), (7, 2, 7, 0), (7, 2, 7, 0)]
    assert ngram_join.similar_documents(empty).count() == 0
    long_text = " ".join(f"t{i}" for i in range(60_000))
    docs = rows_of(spark, [(1, long_text), (2, long_text + " end"), (3, "short")])
    assert {r["doc_id"] for r in ngram_join.keep_one(docs).collect()} == {1, 3}


def test_keep_one_with_repeated_and_null_ids(spark):
    text, other = "one two three four five six", "a b c d e f g"
    docs = rows_of(spark, [(2, text), (1, text), (None, text), (1, text), (None, text), (None, other), (None, other), (5, ""), (5, ""), (None, None)])
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in ngram_join.keep_one(docs.repartition(3)).collect())
    assert got == [(0, ""), (0, other), (1, text), (5, ""), (5, "")]
    assert ngram_join.keep_one(docs).columns == docs.columns


# --- neighbours


def plain_nearest(vectors, asked, k):
    found = {}
    for q in asked:
        scored = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        found[q] = [i for _, i in scored[:k]]
    return found


def test_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    vectors = {i: v for i, v in enumerate(rng.normal(size=(3_000, 16)).astype(np.float32).astype(np.float64))}
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    got = ann.nearest_neighbours(docs, F.col("vec_id") % 50 == 0, k=10)
    lists = {}
    for r in got.orderBy("query_id", "rank").collect():
        lists.setdefault(r["query_id"], []).append(r["vec_id"])
        assert np.isclose(r["score"], np.dot(vectors[r["query_id"]], vectors[r["vec_id"]]), rtol=1e-12)
    want = plain_nearest(vectors, range(0, 3_000, 50), 10)
    assert np.mean([len(set(lists[q]) & set(want[q])) / 10 for q in want]) > 0.95


def test_neighbours_recall_in_a_group_of_near_copies(spark):
    """A third of all rows; byte-rounded scores cannot tell them apart."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(1_800, 16))
    rows[:600] = rows[0] + 1e-3 * rng.normal(size=(600, 16))
    vectors = {i: v for i, v in enumerate(rows.astype(np.float32).astype(np.float64))}
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    lists = {}
    for r in ann.nearest_neighbours(docs, (F.col("vec_id") % 20 == 0) & (F.col("vec_id") < 600), k=20).collect():
        lists.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = plain_nearest(vectors, range(0, 600, 20), 20)
    assert np.mean([len(lists[q] & set(want[q])) / 20 for q in want]) > 0.95


def test_neighbours_query(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    want = plain_nearest(vectors, [i for i in vectors if i % 20 == 0], 20)
    lists = {}
    for r in queries.op1_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        lists.setdefault(r["query_id"], []).append(r["vec_id"])
    assert lists == want


def test_neighbours_odd(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)]
    rows += [(100, None), (120, [0.0, 0.0]), (140, [1.0, None]), (160, [float("nan"), 1.0]), (180, [float("inf"), 1.0]), (200, [1.0]), (None, [1.0, 1.0])]
    rows += [(220, [0.5, 0.5])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in ann.nearest_neighbours(docs, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4], 220: [0, 1, 2, 3, 4]}
    one = ann.nearest_neighbours(docs.where("vec_id = 0"), F.lit(True), k=5)
    assert one.count() == 0
    assert ann.nearest_neighbours(docs.limit(0), F.lit(True), k=5).count() == 0


# --- leaks


def test_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 12))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontamination.common_subsequence(a, b) == table[-1, -1]


def held_items(text, bench):
    """Items whose words all stand in the text one after the other."""
    words = lambda t: " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) + " "
    return {i for i, t in bench if words(t) in words(text)}


def test_leak_query_finds_every_copy(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i in held_items(t, bench)}
    got = {(r["doc_id"], r["item_id"]): r for r in queries.op10_decontamination(spark, sf).collect()}
    assert want and want <= set(got)
    # What is found beyond is near, not whole.
    assert len(set(got) - want) <= 0.2 * len(want)


def test_recall_of_paraphrases(spark):
    """Items with words left out, replaced and put in, within other texts."""
    rng = np.random.default_rng(8)
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(300).collect()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = [t for t in texts if t and len(t.split()) < 400]
    pool = [w for t in clean for w in t.split()]
    made, docs = {}, [(i, t) for i, t in enumerate(clean)]
    for r in items:
        words = r["text"].split()
        for left_out, put_in in ((0.0, 0.0), (0.1, 0.1), (0.2, 0.1), (0.25, 0.2)):
            own = []
            for w in words:
                if rng.random() >= left_out:
                    own.append(w)
                if rng.random() < put_in:
                    own.append(pool[rng.integers(len(pool))])
            doc = 10_000 + len(made)
            around = clean[rng.integers(len(clean))].split()
            at = rng.integers(len(around) + 1)
            made[doc] = (r["item_id"], left_out)
            docs.append((doc, " ".join(around[:at] + own + around[at:])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(table, bench).collect()}
    hit = {doc: (doc, item) in found for doc, (item, _) in made.items()}
    assert all(hit[d] for d, (_, share) in made.items() if share == 0)
    assert sum(hit.values()) / len(hit) >= 0.9


def test_leaks_in_paraphrases_and_odd_rows(spark, empty):
    rng = np.random.default_rng(6)
    word = lambda k: f"n{k}"
    items = [[word(k) for k in rng.integers(0, 3_000, 40)] for _ in range(12)]
    filler = lambda n: [word(k) for k in rng.integers(0, 3_000, n)]
    changed = list(items[3])
    for k in range(0, 32, 4):
        changed[k] = "other"
    texts = {
        1: filler(300),
        2: filler(100) + items[1] + filler(50),
        3: filler(7) + changed + filler(90),
        4: items[2],
        5: items[4][:10] + filler(200),
    }
    rows = [(i, " ".join(t)) for i, t in texts.items()] + [(6, None), (7, ""), (None, " ".join(items[5]))]
    docs = rows_of(spark, rows)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, bench).collect()}
    assert got == {(2, 1), (3, 3), (4, 2), (None, 5)}
    kept = {r["doc_id"] for r in decontamination.without_leaks(docs, bench).collect()}
    assert kept == {1, 5, 6, 7}
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(docs, bench.limit(0)).count() == 0


def test_no_leaks_takes_no_rows_made_in_python(spark):
    """They would start workers of another kind, which executors keep."""
    docs, bench = rows_of(spark, [(1, "some words")]), spark.range(0).selectExpr("id item_id", "'a' text")
    none = decontamination.find_leaks(docs, bench)
    assert none.count() == 0 and dict(none.dtypes)["doc_id"] == "bigint"
    assert "RDD" not in none._jdf.queryExecution().analyzed().toString()


def test_leak_whose_copies_are_a_third_of_all_rows(spark):
    """All words of the item are frequent then; so are those of a passage that
    many different documents share."""
    rng = np.random.default_rng(8)
    filler = lambda n: [f"n{k}" for k in rng.integers(0, 4_000, n)]
    items = [[f"a{k}" for k in range(20)], [f"b{k}" for k in range(30)], filler(40)]
    leak = " ".join(filler(50) + items[0] + filler(30))
    texts = [leak] * 200 + [" ".join(filler(120) + items[1] + filler(60)) for _ in range(150)]
    texts += [" ".join(filler(180)) for _ in range(250)] + [" ".join(filler(90) + items[i] + filler(90)) for i in range(3)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(rows_of(spark, list(enumerate(texts))), bench).collect()}
    assert got == {(i, 0) for i in range(200)} | {(i, 1) for i in range(200, 350)} | {(600, 0), (601, 1), (602, 2)}


def test_benchmark_items_with_null_ids(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(f"n{k}" for k in rng.integers(0, 3_000, 40)) for _ in range(3)]
    docs = rows_of(spark, [(i, f"some other words {t} and more") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(None, texts[0]), (5, texts[1])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, bench).collect()}
    assert got == {(0, None), (1, 5)}


def test_sums_of_latent_rows():
    rng = np.random.default_rng(3)
    # Factors of a decomposition lie column by column: each take from such a table copies all of it.
    table = decontamination.latent_table(np.ones(50), np.asfortranarray(rng.normal(size=(50, 6))))
    assert table.flags.c_contiguous and table.dtype == np.float32
    sizes = [1, 3, 900, 2, 64, 65, 1] + rng.integers(1, 9, 1_500).tolist()
    rows = rng.integers(0, 50, sum(sizes))
    first = np.cumsum([0, *sizes[:-1]])
    want = np.add.reduceat(table[rows].astype(float), first, axis=0)
    assert np.allclose(decontamination._sums(table, rows, first), want, rtol=1e-5, atol=1e-4)
    assert decontamination._sums(table, rows[:900], np.array([0])).shape == (1, 6)


def test_word_numbers_with_shared_slots():
    low = np.arange(1, 4_000, dtype=np.uint64)
    vocabulary = np.sort(np.concatenate([low, low[::3] + np.uint64(1 << 40), low[::5] + np.uint64(1 << 50)]))
    asked = np.concatenate([vocabulary, low + np.uint64(1 << 60), np.array([0, 1 << 40], dtype=np.uint64)])
    numbers = decontamination.WordNumbers(vocabulary).find(asked)
    place = {v: i for i, v in enumerate(vocabulary.tolist())}
    assert numbers.tolist() == [place.get(v, -1) for v in asked.tolist()]
    assert decontamination.WordNumbers(vocabulary[:0]).find(low).max() == -1


def test_word_hashes_keep_little_memory():
    """A long text leaves no large tables behind, and its words hash as alone."""
    texts = ["x" * 400_000, "é " * 100_000, None, "a b"]
    found = find_words([*texts, "x" * 400_000 + " é"])
    assert found.hash[0] == found.hash[-2] and len(set(found.hash[1:100_001].tolist())) == 1
    assert found.hash[1] == found.hash[-1] == find_words(["é"]).hash[0]
    assert found.counts(5).tolist() == [1, 100_000, 0, 2, 2]
    assert max(len(p) for p in powers(1)) < 100_000


# --- pipeline


def test_pipeline_equals_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = corpus_pipeline.run(spark, SF).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "mixing sources to target weights",
        "sharding",
    ]
    good = corpus_pipeline.drop_low_quality(spark, docs, SF)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in good.collect()]
    groups = plain_components([r[:2] for r in rows], corpus_pipeline.NEAR_DUPLICATE)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(i, s) for i, t, s in rows if groups[i][1] == i and not held_items(t, bench)]
    stream = [i for i, _ in plain_mix(left, SOURCE_WEIGHTS, OTHER_WEIGHT, mixing.BLOCK_ROWS)]
    got = sorted(done, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in got] == stream
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and set(docs.columns) < set(done[0].asDict())


def test_stages_keep_columns_and_take_odd_rows(spark, empty):
    docs = rows_of(spark, [(None, None), (1, ""), (2, "some words in a line."), (2, "some words in a line."), (3, "x " * 50_000)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, empty, SF).count() == 0
    last = corpus_pipeline.cut_shards(spark, docs, SF)
    assert last.count() == 5 and corpus_pipeline.cut_shards(spark, empty, SF).count() == 0
