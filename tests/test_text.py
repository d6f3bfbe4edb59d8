import random
import re

import numpy as np
from pyspark.sql import functions as F

from labelloom.functions.arrays import argmax, cross_entropy, pad, truncate
from labelloom.functions.rounding import round_scaled
from labelloom.functions.text import WHITESPACE_CHARS, clean_text, compare_key, digest, word_count

TEXTS = [
    "plain words here",
    "  lead and trail  ",
    "tab\tand\nline\r\nbreaks",
    "no break   em space",
    "unit\x1fseparator\x1c\x1d\x1e",
    "\x85next line\x0b\x0c",
    "",
    "   ",
    "　 ",
    "Keeps CASE, and punctuation?!",
    "zero​width stays",
    None,
]


def test_white_space_follows_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("i", clean_text("t"), compare_key("t"), word_count("t")).orderBy("i").collect()
    for (_, clean, key, words), text in zip(rows, TEXTS, strict=True):
        if text is None:
            assert clean is None and key is None and words is None
            continue
        assert clean == re.sub(r"\s+", " ", text.strip())
        assert key == text.strip().lower()
        assert words == len(text.split())


def test_random_texts_follow_python(spark):
    rng = random.Random(11)
    alphabet = list(WHITESPACE_CHARS) + list("aÉßñΣσİ.,?_-0\u200b\ufeff\u0301😀") + [" "] * 8
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = {r["i"]: r for r in df.select("i", clean_text("t").alias("c"), word_count("t").alias("n"), F.btrim("t", F.lit(WHITESPACE_CHARS)).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert got[i]["c"] == re.sub(r"\s+", " ", text.strip())
        assert got[i]["n"] == len(text.split())
        assert got[i]["s"] == text.strip()


def test_lower_case_beyond_ascii(spark):
    texts = ["ÉCOLE", "ΟΔΟΣ", "STRASSE ß", "Ǆ", "ÀÖØ"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(compare_key("t")).collect()] == [t.lower() for t in texts]


def test_white_space_set_is_complete():
    assert all(c.isspace() for c in WHITESPACE_CHARS)
    assert [c for c in map(chr, range(0x110000)) if c.isspace()] == sorted(WHITESPACE_CHARS)


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(clean_text("t").alias("t"))
    assert df.where(~F.col("t").eqNullSafe(clean_text("t"))).count() == 0


def test_digest_distinguishes_texts(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select(digest("t").alias("d"))
    assert got.distinct().count() == len(TEXTS)
    assert got.where("d is null").count() == 1


def test_rounding_matches_numpy(spark):
    values = [9.425, 12.425, 10.475, 12.925, 1.005, -2.675, 0.0, 5.344999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_scaled("v")).collect()]
    assert got == [float(np.round(v, 2)) for v in values]
    assert got[:4] == [9.43, 12.42, 10.48, 12.92]


def test_argmax_ties_and_nan(spark):
    rows = [([1.0, 3.0, 3.0],), ([float("nan"), 9.0],), ([1.0, float("nan"), float("nan")],), ([-1.0],)]
    df = spark.createDataFrame(rows, "a array<float>")
    got = [r[0] for r in df.select(argmax("a")).collect()]
    assert got == [int(np.argmax(r[0])) for r in rows]


def test_cross_entropy_is_stable(spark):
    rows = [([1.0, 2.0, 3.0], 2), ([1000.0, 0.0], 1), ([-1000.0, -1000.0], 0)]
    df = spark.createDataFrame(rows, "a array<double>, y int")
    got = [r[0] for r in df.select(cross_entropy("a", "y")).collect()]
    for value, (logits, label) in zip(got, rows, strict=True):
        a = np.array(logits)
        want = np.log(np.exp(a - a.max()).sum()) + a.max() - a[label]
        assert abs(value - want) < 1e-9


def test_pad_and_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<int>")
    right = [r[0] for r in df.select(pad("a", F.lit(4), F.lit(0))).collect()]
    left = [r[0] for r in df.select(pad("a", F.lit(4), F.lit(0), "left")).collect()]
    short = [r[0] for r in df.select(truncate("a", 2)).collect()]
    assert right == [[1, 2, 3, 0], [0, 0, 0, 0]]
    assert left == [[0, 1, 2, 3], [0, 0, 0, 0]]
    assert short == [[1, 2], []]
