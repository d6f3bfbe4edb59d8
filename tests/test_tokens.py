import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import tokens


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id long, text string, label int")


def test_native_tokens(spark):
    df = frame(spark, [(0, "Où est l'été_2? 3.5€", 1), (1, "", 0), (2, "a b\tc", 1), (3, None, 0)])
    out = tokens.tokenize(df.withColumn("other", F.lit(1)), max_length=6)
    assert out.columns == ["row_id", "text", "label", "input_ids", "attention_mask", "labels"]
    got = {r["row_id"]: r for r in out.collect()}
    assert got[0]["input_ids"] == ["Où", "est", "l", "'", "été_2", "?"]
    assert got[0]["attention_mask"] == [1] * 6 and got[0]["labels"] == 1
    assert got[1]["input_ids"] == [] and got[1]["attention_mask"] == []
    assert got[2]["input_ids"] == ["a", "b", "c"]
    assert got[3]["input_ids"] is None


def test_custom_tokenizer_gets_batches(spark):
    def vowels(texts):
        return [[ord(c) for c in t if c in "aeiou"] for t in texts]

    df = frame(spark, [(i, "banana" * (i % 3), 0) for i in range(50)])
    out = tokens.tokenize(df, max_length=4, tokenizer=vowels)
    for row in out.collect():
        assert row["input_ids"] == ([97] * (3 * (row["row_id"] % 3)))[:4]
        assert len(row["attention_mask"]) == len(row["input_ids"])


def test_custom_tokenizer_gets_bounded_batches(spark):
    limit = 500_000

    def sizes(texts):
        total = sum(len(t.encode()) for t in texts if t is not None)
        assert total <= limit or len([t for t in texts if t]) == 1, total
        return [None if t is None else [len(t)] for t in texts]

    lengths = {i: (None if i % 7 == 3 else 600_000 if i == 20 else 1_000 * (i % 40)) for i in range(200)}
    df = spark.createDataFrame(list(lengths.items()), "row_id long, n int").coalesce(1)
    df = df.select("row_id", F.expr("repeat('é', n)").alias("text"), F.lit(0).alias("label"))
    out = tokens.tokenize(df, max_length=None, tokenizer=sizes)
    got = {r["row_id"]: r["input_ids"] for r in out.select("row_id", "input_ids").collect()}
    assert got == {i: None if n is None else [n] for i, n in lengths.items()}


@pytest.mark.parametrize("side", ["right", "left"])
@pytest.mark.parametrize("ids", ["dense", "sparse"])
def test_padding_matches_brute_force(spark, side, ids):
    rng = random.Random(5)
    # One far outlier: positions must not depend on how ids are spread.
    keys = list(range(103)) if ids == "dense" else sorted(rng.sample(range(10**6), 102)) + [2**61]
    sizes = {k: rng.randint(0, 9) for k in keys}
    data = [(k, " ".join(["w"] * n), 0) for k, n in sizes.items()]
    rng.shuffle(data)
    df = tokens.tokenize(frame(spark, data).repartition(6), max_length=8)
    out = {r["row_id"]: r for r in tokens.pad_batches(df, 4, "_", side).collect()}
    assert len(out) == len(keys)
    for position, key in enumerate(keys):
        batch = keys[position // 4 * 4 : position // 4 * 4 + 4]
        longest = max(min(sizes[k], 8) for k in batch)
        n = min(sizes[key], 8)
        fill, mask = ["_"] * (longest - n), [0] * (longest - n)
        row = out[key]
        assert row["batch_id"] == position // 4
        assert row["input_ids"] == (["w"] * n + fill if side == "right" else fill + ["w"] * n)
        assert row["attention_mask"] == ([1] * n + mask if side == "right" else mask + [1] * n)


@pytest.mark.parametrize("per_part", [1, 40, 10**6])
def test_stretches_and_groups(spark, per_part):
    """Batches do not depend on how many stretches there are; groups, one of
    them null, are batched apart, and no list goes through a join."""
    rng = random.Random(7)
    rows = [(rng.randrange(-(2**40), 2**62), [1] * rng.randrange(6) if rng.random() < 0.9 else None, rng.choice(["a", "b", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "row_id long, input_ids array<int>, split string").repartition(5)
    padded = tokens.pad_batches(df, 3, 0, group_col="split", tokens_per_part=per_part)
    assert "Join" not in padded._jdf.queryExecution().executedPlan().toString()
    got = {(r["split"], r["row_id"]): r for r in padded.collect()}
    assert len(got) == 400
    for name in ("a", "b", None):
        own = sorted((r for r in rows if r[2] == name), key=lambda r: r[0])
        for k, (i, ids, _) in enumerate(own):
            length = max(len(r[1] or []) for r in own[k // 3 * 3 : k // 3 * 3 + 3])
            row, n = got[name, i], len(ids or [])
            assert row["batch_id"] == k // 3
            assert row["input_ids"] == [1] * n + [0] * (length - n)
            assert row["attention_mask"] == [1] * n + [0] * (length - n)


def test_range_number(spark):
    starts = sorted(random.Random(1).sample(range(10_000), 300))
    df = spark.range(0, 10_000, 7)
    for some in (starts, starts[:1], starts[:64], starts[:65], []):
        got = df.select("id", tokens.range_number(F.col("id"), some).alias("n")).collect()
        assert all(r["n"] == sum(s <= r["id"] for s in some) for r in got)


def test_padding_of_an_empty_table(spark):
    df = tokens.tokenize(frame(spark, []), max_length=8)
    assert tokens.pad_batches(df, 4, "_").count() == 0


def test_padding_side_is_checked(spark):
    df = tokens.tokenize(frame(spark, [(0, "a", 0)]), max_length=8)
    with pytest.raises(ValueError, match="side"):
        tokens.pad_batches(df, 4, "_", side="top")
