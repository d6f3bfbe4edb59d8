import hashlib
import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.operators import dedup, ranking, splitting


def test_keep_first(spark):
    data = [
        (5, "a", 0), (3, "a", 0), (4, "a", 1), (1, "A", 0), (2, "a ", 0),
        (7, None, 0), (6, None, 0), (9, "b", None), (8, "b", None),
    ]
    df = spark.createDataFrame(data, "row_id long, text string, label int").repartition(3)
    kept = {r["row_id"] for r in dedup.deduplicate(df).collect()}
    pdf = pd.DataFrame(data, columns=["row_id", "text", "label"]).sort_values("row_id")
    assert kept == set(pdf.drop_duplicates(["text", "label"], keep="first")["row_id"])
    assert tuple(dedup.duplicate_count(df).first()) == (9, 6, 3)
    # The way beyond the broadcast bound.
    firsts = dedup.first_ids(df).persist()
    beyond = dedup.keep_first(df, firsts, max_broadcast=0)
    assert {r["row_id"] for r in beyond.collect()} == kept
    assert beyond.columns == dedup.deduplicate(df).columns == df.columns
    again = dedup.deduplicate(dedup.deduplicate(df))
    assert {r["row_id"] for r in again.collect()} == kept


def test_dedup_of_a_hot_text_ships_one_row_per_task(spark):
    df = spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(0).alias("label"),
    )
    plan = dedup.first_ids(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_min" in plan
    assert dedup.deduplicate(df).count() == 2001


def brute_quotas(counts, val_size):
    total = sum(counts.values())
    n_val = math.ceil(val_size * total)
    n_train = total - n_val
    base = {c: n * n_train // total for c, n in counts.items()}
    order = sorted(counts, key=lambda c: (-(counts[c] * n_train % total), c))
    for c in order[: n_train - sum(base.values())]:
        base[c] += 1
    return {c: counts[c] - base[c] for c in counts}


def brute_split(ids_by_class, val_size, seed):
    quotas = brute_quotas({c: len(v) for c, v in ids_by_class.items()}, val_size)
    chosen = set()
    for c, ids in ids_by_class.items():
        ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        chosen |= set(ranked[: quotas[c]])
    return chosen


@pytest.mark.parametrize("sizes, val_size", [([400, 30, 7, 2], 0.1), ([9, 9, 9], 0.34), ([50, 50], 0.05), ([1000, 2], 0.002)])
def test_split_matches_brute_force(spark, sizes, val_size):
    ids, by_class = 0, {}
    for label, size in enumerate(sizes):
        by_class[label] = list(range(ids, ids + size))
        ids += size
    data = [(i, c) for c, v in by_class.items() for i in v]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "row_id long, label int")
    for parts in (1, 5):
        out = splitting.stratified_split(df.repartition(parts), val_size, seed=7)
        assert out.count() == ids
        got = {r["row_id"] for r in out.where("split = 'validation'").collect()}
        assert got == brute_split(by_class, val_size, 7)


def test_split_and_dedup_without_any_broadcast(spark, monkeypatch):
    """The way beyond the size bound: everything is a shuffle join."""
    monkeypatch.setattr(splitting, "broadcast_rows", lambda df, rows: df)
    monkeypatch.setattr(splitting, "broadcast_if_small", lambda df: df)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        by_class = {0: list(range(900)), 1: list(range(900, 960)), 2: [960, 961]}
        data = [(i, c, f"t{i}") for c, v in by_class.items() for i in v]
        df = spark.createDataFrame(data, "row_id long, label int, text string")
        out = splitting.stratified_split(df, 0.2, seed=3)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r["row_id"] for r in out.where("split = 'validation'").collect()}
        assert got == brute_split(by_class, 0.2, 3)
        twice = df.unionByName(df.withColumn("row_id", F.col("row_id") + 5000))
        assert {r["row_id"] for r in dedup.deduplicate(twice).collect()} == set(range(962))
    finally:
        spark.conf.unset(threshold)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_quotas_do_not_overflow(spark):
    counts = {0: 3 * 10**12, 1: 2 * 10**12 + 1, 2: 17}
    df = spark.createDataFrame(list(counts.items()), "label int, n long")
    total = sum(counts.values())
    n_val = math.ceil(0.1 * total)
    got = {r["label"]: r["n_val"] for r in splitting.class_quotas(df, total, n_val).collect()}
    assert sum(got.values()) == n_val
    assert got == brute_quotas(counts, 0.1)


def test_split_errors(spark):
    def frame(sizes):
        return spark.createDataFrame(
            [(i * 1000 + j, i) for i, n in enumerate(sizes) for j in range(n)], "row_id long, label int"
        )

    with pytest.raises(ValueError, match="at least 2 rows"):
        splitting.stratified_split(frame([10, 1]))
    with pytest.raises(ValueError, match="cannot cover"):
        splitting.stratified_split(frame([5, 5, 5]), val_size=0.1)
    with pytest.raises(ValueError, match="strictly between"):
        splitting.stratified_split(frame([5, 5]), val_size=1.0)
    with pytest.raises(ValueError, match="null labels"):
        splitting.stratified_split(frame([5, 5]).withColumn("label", F.lit(None).cast("int")))


def test_split_moves_no_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("label"))
    cutoffs = splitting.validation_cutoffs(df, 0.1)
    plan = splitting.assign_split(df, cutoffs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_split_summary(spark):
    df = spark.createDataFrame(
        [("a", 0), ("a", 0), ("a", 1), ("b", 5)], "split string, label int"
    )
    got = {r["split"]: tuple(r)[1:] for r in splitting.split_summary(df).collect()}
    assert got == {"a": (3, 2, 1, 2), "b": (1, 1, 1, 1)}


def test_first_rows_filter_reaches_the_scan(spark, tmp_path):
    spark.range(1000).withColumnRenamed("id", "row_id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = ranking.first_rows(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(row_id), LessThanOrEqual(row_id,9)]" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    ids=st.sets(st.integers(0, 2**62), min_size=1, max_size=60),
    n=st.integers(1, 70),
)
def test_nth_smallest(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    want = sorted(ids)[n - 1] if n < len(ids) else None
    assert ranking.nth_smallest(df, n) == want
    assert {r[0] for r in ranking.first_rows(df, n).collect()} == set(sorted(ids)[:n])


def test_first_rows(spark):
    df = spark.range(50).withColumnRenamed("id", "row_id")
    assert ranking.first_rows(df, None) is df
    assert ranking.first_rows(df, 50) is df
    assert ranking.first_rows(df, 0).count() == 0
    assert ranking.nth_smallest(df.where("row_id < 0"), 3) is None
    assert [r[0] for r in ranking.preview(df.repartition(4)).collect()] == [0, 1, 2, 3, 4]
    assert "Exchange" not in ranking.first_rows(df, 7)._jdf.queryExecution().executedPlan().toString()
