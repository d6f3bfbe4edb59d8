import glob
import os

from labelloom.functions.labels import encode_labels, label_dim
from labelloom.functions.text import clean_text
from labelloom.streaming.landing import land_checked, land_new_files, stream_files


def test_landing_takes_each_file_once_and_equals_batch(spark, tmp_path):
    schema = "row_id long, text string, category string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    dim = label_dim(spark, ["b", "a"])

    def add(data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)

    def run():
        frame = spark.read.schema(schema).parquet(source)
        return land_new_files(stream_files(spark, source, frame.schema), dim, out, state)

    add([(0, " one  two ", "a"), (1, "three", "b")])
    assert run().count() == 2
    assert run().count() == 2
    add([(2, "four\tfive", "x")])
    landed = run()
    batch = encode_labels(
        spark.read.schema(schema).parquet(source).withColumn("text", clean_text("text")), dim
    )
    columns = ["row_id", "text", "category", "label"]
    assert sorted(map(tuple, landed.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))


def test_csv_stream(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('text,category\n"say ""hi""\nthere",a\n')
    schema = spark.createDataFrame([], "text string, category string").schema
    stream = stream_files(spark, str(folder), schema, fmt="csv", pattern="*.csv")
    landed = land_new_files(stream, label_dim(spark, ["a"]), str(tmp_path / "o"), str(tmp_path / "s"))
    assert [(r["text"], r["label"]) for r in landed.collect()] == [('say "hi" there', 0)]


def test_rejected_rows_are_set_apart_once(spark, tmp_path):
    schema = "row_id long, text string, category string, note string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    dim = label_dim(spark, ["b", "a"])

    def run(data):
        if data:
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        stream = stream_files(spark, source, spark.createDataFrame([], schema).schema)
        return land_checked(stream, dim, out, state)

    run([(0, " one  two ", "a", "x"), (1, None, "b", "x"), (2, " three ", "zz", "x"), (3, None, None, "x")])
    run([(4, "", "b", "y")])
    done = run([])
    assert [tuple(r) for r in done.landed.orderBy("row_id").collect()] == [(0, "one two", "a", "x", 1), (4, "", "b", "y", 0)]
    assert [tuple(r) for r in done.rejected.orderBy("row_id").collect()] == [
        (1, None, "b", "x", 0, "null text"),
        (2, " three ", "zz", "x", None, "unknown category"),
        (3, None, None, "x", None, "null text, unknown category"),
    ]
    counts = [tuple(r) for r in done.counts.orderBy("batch_id").collect()]
    assert counts == [(0, 4, 1, 2, 2), (1, 1, 1, 0, 0)]
    # The last batch was written but not committed.
    for name in glob.glob(f"{state}/commits/1") + glob.glob(f"{state}/commits/.1.crc"):
        os.remove(name)
    again = run([])
    assert again.landed.count() == 2 and again.rejected.count() == 3
    assert [tuple(r) for r in again.counts.orderBy("batch_id").collect()] == counts


def test_nothing_arrived(spark, tmp_path):
    schema = spark.createDataFrame([], "text string, category string").schema
    (tmp_path / "in").mkdir()
    done = land_checked(stream_files(spark, str(tmp_path / "in"), schema), label_dim(spark, ["a"]), str(tmp_path / "o"), str(tmp_path / "s"))
    assert (done.landed.count(), done.rejected.count(), done.counts.count()) == (0, 0, 0)
