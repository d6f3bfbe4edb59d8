import pytest
from pyspark.sql import functions as F

from labelloom.functions.labels import (
    DEFAULT_LABELS,
    decode_labels,
    encode_labels,
    label_dim,
    label_maps,
)
from labelloom.operators import guards
from labelloom.operators.sizing import broadcast_if_small


def rows(spark, data):
    return spark.createDataFrame(data, "split string, text string, category string")


def test_default_vocabulary():
    name_to_id, id_to_name = label_maps()
    assert len(DEFAULT_LABELS) == 77 == len(set(DEFAULT_LABELS))
    # Case-insensitive order with a question mark in one name.
    assert list(DEFAULT_LABELS) == sorted(DEFAULT_LABELS, key=str.lower)
    assert name_to_id["Refund_not_showing_up"] == 51
    assert id_to_name[53] == "reverted_card_payment?"
    assert name_to_id["activate_my_card"] == 0 and id_to_name[76].startswith("wrong_exchange")


def test_dim_keeps_order_beyond_the_literal_size(spark):
    names = [f"n{i:05d}" for i in range(1500, 0, -1)]
    for labels in (names, names[:10]):
        got = {r["category"]: r["label"] for r in label_dim(spark, labels).collect()}
        assert got == {n: i for i, n in enumerate(labels)}
    with pytest.raises(ValueError, match="unique"):
        label_dim(spark, ["a", "a"])


def test_encode_and_decode(spark):
    dim = label_dim(spark, ["z?", "A", "m"])
    df = rows(spark, [("train", "t", "A"), ("train", "t", "z?"), ("train", "t", "a"), ("train", "t", None)])
    encoded = encode_labels(df, dim)
    assert {(r["category"], r["label"]) for r in encoded.collect()} == {
        ("A", 1), ("z?", 0), ("a", None), (None, None)
    }
    back = decode_labels(encoded.select("label"), dim).collect()
    assert {(r["label"], r["category"]) for r in back} == {(1, "A"), (0, "z?"), (None, None)}


def test_unknown_labels(spark):
    dim = label_dim(spark, ["a", "b"])
    good = rows(spark, [("train", "t", "a"), ("test", "t", "b")])
    assert guards.require_known_labels(good, dim) is good
    bad = rows(spark, [("train", "t", "a"), ("test", "t", "x"), ("test", "t", None), ("test", "u", "x")])
    assert {tuple(r) for r in guards.unknown_labels(bad, dim).collect()} == {("test", "x"), ("test", None)}
    with pytest.raises(guards.UnknownLabelError, match="test: "):
        guards.require_known_labels(bad, dim)


def test_missing_labels_and_coverage(spark):
    dim = label_dim(spark, ["a", "b"])
    df = encode_labels(rows(spark, [("train", "t", "a"), ("train", "t", "b"), ("test", "t", "a")]), dim)
    guards.require_coverage(df, dim, ("train",))
    guards.require_all_labels(df, dim, ("train",))
    assert [tuple(r) for r in guards.missing_labels(df, dim, ("train", "test")).collect()] == [("test", 1)]
    with pytest.raises(guards.MissingLabelError, match=r"test: \[1\]"):
        guards.require_all_labels(df, dim, ("train", "test"))
    with pytest.raises(guards.MissingLabelError, match="absent"):
        guards.require_coverage(df, dim, ("test",))
    # A split without any row lacks every label.
    assert guards.missing_labels(df, dim, ("validation",)).count() == 2


def test_text_guards(spark):
    df = rows(spark, [("train", "t", "a"), ("train", "  ", "a"), ("test", None, "a")])
    got = {r["split"]: tuple(r)[1:] for r in guards.text_problems(df).collect()}
    assert got == {"train": (2, 0, 1), "test": (1, 1, 0)}
    with pytest.raises(guards.NullTextError, match="test"):
        guards.require_text(guards.category_summary(df))
    guards.require_text(guards.category_summary(df.where("split = 'train'")))
    with pytest.raises(guards.MissingColumnError, match="label"):
        guards.require_columns(df, ("text", "label"), "train")


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10).withColumn("s", F.lit("x"))
    assert "ResolvedHint" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString()
    for df in (broadcast_if_small(small, max_rows=5), broadcast_if_small(small, max_bytes=5)):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_many_offenders_are_counted_and_kept(spark):
    many = spark.range(500).selectExpr("'train' AS split", "concat('c', id) AS category", "'t' AS text")
    dim = spark.createDataFrame([(0, "known")], "label long, category string")
    with pytest.raises(guards.UnknownLabelError, match="500 in all") as error:
        guards.require_known_labels(many, dim)
    path = str(error.value).rsplit(": ", 1)[1]
    assert spark.read.parquet(path).count() == 500
