import json

import pytest
from pyspark.sql import functions as F

from labelloom.functions.labels import DEFAULT_LABELS, label_dim
from labelloom.operators.guards import MissingColumnError
from labelloom.sources import readers, writers

TRICKY = [
    ('He said "hi", twice', "a"),
    ("line one\nline two", "b"),
    ("back\\slash, and comma", "c?"),
    ("NA", "null"),
    ("  padded  ", "a"),
]


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def csv_file(path, rows, header=" text , category "):
    lines = [header] + [",".join(quoted(v) for v in row) for row in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_reads_what_was_meant(spark, tmp_path):
    df = readers.read_csv(spark, csv_file(tmp_path / "t.csv", TRICKY))
    assert df.columns == ["text", "category", "row_id"]
    got = [(r["text"], r["category"]) for r in df.orderBy("row_id").collect()]
    assert got == TRICKY


def test_csv_column_order_and_empty_fields(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('category,text\na,\nb,""\nc,NA\n')
    df = readers.read_csv(spark, str(path))
    got = {r["category"]: r["text"] for r in df.select("text", "category").collect()}
    assert got == {"a": None, "b": None, "c": "NA"}


def test_csv_with_a_broken_row_fails(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("text,category\na,b\nc,d,e\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(path)).collect()


def test_strict_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('"text", "category"\n"one, two",   "a"\n"", "b"\n')
    got = [(r["text"], r["category"]) for r in readers.read_csv(spark, str(path), strict=True).orderBy("row_id").collect()]
    assert got == [("one, two", "a"), ("", "b")]


def test_land_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = readers.land_raw(readers.read_csv(spark, csv_file(tmp_path / "t.csv", TRICKY)), path)
    ids = {r["text"]: r["row_id"] for r in first.collect()}
    second = readers.land_raw(spark.createDataFrame([("other", "x", 9)], "text string, category string, row_id long"), path)
    assert {r["text"]: r["row_id"] for r in second.repartition(3).collect()} == ids


def test_csv_written_is_csv_read(spark, tmp_path):
    df = spark.createDataFrame([*TRICKY, (None, "n")], "text string, category string")
    for quote_all in (False, True):
        path = str(tmp_path / f"c{quote_all}")
        writers.write_csv(df.coalesce(1), path, quote_all)
        back = readers.read_csv(spark, path).orderBy("row_id")
        assert [(r["text"], r["category"]) for r in back.collect()] == [*TRICKY, (None, "n")]


def test_landing_replaces_an_unfinished_write(spark, tmp_path):
    (tmp_path / "raw" / "_temporary").mkdir(parents=True)
    df = spark.createDataFrame([("t", 1)], "text string, row_id long")
    assert readers.land_raw(df, str(tmp_path / "raw")).count() == 1


def splits_frame(spark):
    data = [(s, f"{s} {i}", "ab"[i % 2], i % 2) for s in ("train", "validation", "test") for i in range(4)]
    return spark.createDataFrame(data, "split string, text string, category string, label long")


@pytest.mark.parametrize("layout, fmt", [("partitioned", "parquet"), ("per_split", "parquet"), ("per_split", "csv")])
def test_splits_roundtrip(spark, tmp_path, layout, fmt):
    out = str(tmp_path / "out")
    df = splits_frame(spark)
    writers.write_splits(df, out, fmt, layout)
    writers.write_label_map(label_dim(spark, ["a", "b"]), f"{out}/label_mapping.json")
    stacked, dim, n = readers.load_processed(spark, out, expected_labels=2)
    assert n == 2 and {tuple(r) for r in dim.collect()} == {(0, "a"), (1, "b")}
    columns = ["split", "text", "category", "label"]
    assert sorted(map(tuple, stacked.select(columns).collect())) == sorted(map(tuple, df.select(columns).collect()))
    assert stacked.schema["label"].dataType.typeName() == "long"
    few, _, _ = readers.load_processed(spark, out, max_train_samples=3, expected_labels=2)
    counts = {r["split"]: r["count"] for r in few.groupBy("split").count().collect()}
    assert counts == {"train": 3, "validation": 4, "test": 4}


def test_parquet_is_preferred_and_absence_is_an_error(spark, tmp_path):
    out = str(tmp_path / "out")
    df = splits_frame(spark)
    writers.write_splits(df.withColumn("text", F.lit("csv")), out, "csv", "per_split")
    with pytest.raises(FileNotFoundError, match="no holdout split"):
        readers.locate_splits(spark, out, ("holdout",))
    writers.write_splits(df.where("split = 'train'"), out, "parquet", "per_split")
    found = readers.locate_splits(spark, out)
    assert found["train"].where("text = 'csv'").isEmpty()
    assert found["test"].where("text = 'csv'").count() == 4


def test_required_columns_and_vocabulary_size(spark, tmp_path):
    out = str(tmp_path / "out")
    writers.write_splits(splits_frame(spark), out, columns=("text", "category"))
    with pytest.raises(MissingColumnError, match="label"):
        readers.load_processed(spark, out, expected_labels=2)
    good = str(tmp_path / "good")
    writers.write_splits(splits_frame(spark), good)
    writers.write_label_map(label_dim(spark, ["a", "b"]), f"{good}/label_mapping.json")
    with pytest.raises(ValueError, match="has 2 labels, not 77"):
        readers.load_processed(spark, good)
    with pytest.raises(ValueError, match="parquet only"):
        writers.write_splits(splits_frame(spark), out, fmt="csv", layout="partitioned")
    with pytest.raises(ValueError, match="layout"):
        writers.write_splits(splits_frame(spark), out, layout="other")
    with pytest.raises(ValueError, match="format"):
        writers.write_splits(splits_frame(spark), out, fmt="xml")


def test_label_map_files(spark, tmp_path):
    pretty = tmp_path / "map.json"
    pretty.write_text(json.dumps({"label2id": {"b?": 0, "A": 1}, "id2label": {"0": "b?", "1": "A"}}, indent=2))
    assert {tuple(r) for r in readers.read_label_map(spark, str(pretty)).collect()} == {(0, "b?"), (1, "A")}
    default = readers.read_label_map(spark, str(tmp_path / "none.json"))
    assert [r["category"] for r in default.orderBy("label").collect()] == list(DEFAULT_LABELS)

    out = tmp_path / "written.json"
    writers.write_label_map(label_dim(spark), str(out))
    (part,) = out.glob("part-*")
    data = json.loads(part.read_text())
    assert data["label2id"] == {n: i for i, n in enumerate(DEFAULT_LABELS)}
    assert data["id2label"] == {str(i): n for i, n in enumerate(DEFAULT_LABELS)}


def test_comparison_document(spark, tmp_path):
    table = spark.createDataFrame(
        [("baseline", "test", "loss", 2.0), ("after_lora", "test", "loss", 1.5), ("after_lora", "dev", "loss", 1.0)],
        "phase string, split string, metric string, value double",
    )
    from labelloom.operators.metrics import compare_evaluations

    document = writers.comparison_document(table, compare_evaluations(table), "m", 3)
    writers.write_comparison(document, str(tmp_path / "cmp"))
    (part,) = (tmp_path / "cmp").glob("part-*")
    assert json.loads(part.read_text()) == {
        "model_id": "m",
        "num_labels": 3,
        "baseline": {"test": {"loss": 2.0}},
        "after_lora": {"dev": {"loss": 1.0}, "test": {"loss": 1.5}},
        "delta": {"test": {"loss": -0.5}},
    }


def test_land_raw_writes_a_broken_table_anew(spark, tmp_path):
    path = tmp_path / "raw"
    df = spark.range(10).selectExpr("id AS row_id", "'t' AS text")
    df.repartition(4).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    for part in sorted(path.glob("part-*"))[1:]:
        part.unlink()
    assert readers.land_raw(df, str(path)).count() == 10
    assert (path / "_SUCCESS").exists()


def test_label_map_parts_must_agree(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text('{"label2id": {"a": 0, "b": 1}, "id2label": {"0": "b", "1": "a"}}')
    with pytest.raises(ValueError, match="disagree"):
        readers.read_label_map(spark, str(path))


def test_splits_as_csv_need_no_layout(spark, tmp_path):
    rows = [(1, "a", "x", 0, "train"), (2, "b", "x", 0, "test")]
    df = spark.createDataFrame(rows, "row_id long, text string, category string, label long, split string")
    writers.write_splits(df, str(tmp_path / "out"), "csv")
    assert (tmp_path / "out" / "train.csv").exists()
