"""Quality, secrets, licences, languages and tokens on small and odd inputs."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelloom.llm import langid, licenses, quality, secret_scan, tokens
from labelloom.llm.common import text_slices

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, uid string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank and very long texts, repeated rows, a null id, clashing columns."""
    long_text = "the quick brown fox " * 20_000
    rows = [
        (1, None, "x", "u"),
        (2, "", "x", "u"),
        (3, "\n\n", None, "u"),
        (4, long_text, "x", None),
        (5, "one line of words.", "x", "u"),
        (5, "one line of words.", "x", "u"),
        (None, "no id here", "x", "u"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- quality


def test_line_features_follow_lines():
    features, length, lines = quality.line_features(["ab cd\nEF!!", "", None, "x\n"])
    assert lines.tolist() == [2, 0, 0, 2]
    assert length.tolist() == [5, 4, 1, 0]
    assert features.shape == (4, quality.N_FEATURES)
    assert features[1, 0] == 1.0 and features[0, 0] == 0.0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    field = quality.LineField(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)), 0.5)
    scores = rng.normal(size=(1, 4, 2))
    states, _, total = field.marginals(scores, np.ones((1, 4), dtype=bool))
    paths = [[(k >> t) & 1 for t in range(4)] for k in range(16)]
    weight = np.array(
        [
            np.exp(sum(scores[0, t, p[t]] for t in range(4)) + sum(field.steps[p[t], p[t + 1]] for t in range(3)))
            for p in paths
        ]
    )
    assert np.isclose(np.log(weight.sum()), total[0])
    for t in range(4):
        good = sum(w for w, p in zip(weight, paths, strict=True) if p[t]) / weight.sum()
        assert np.isclose(states[0, t, 1], good)


def test_padding_changes_no_marginal():
    texts = ["a b c.\nJUNK!! JUNK!!\nmore words here", "short", "x\ny\nz\nw\nv"]
    field = quality.train(texts, [1, 0, 1], epochs=3)
    together = quality.score_texts(field, texts)
    alone = [quality.score_texts(field, [t])[0] for t in texts]
    assert np.allclose(together, alone)


def test_quality_held_out(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    field = quality.fit_quality_model(docs, labels.where("doc_id % 2 = 0"))
    scored = quality.score_quality(docs.select("doc_id", "text"), field)
    right = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert right.first()[0] > 0.95


def test_quality_odd(spark, odd, empty):
    field = quality.train(["good words here.", "BAD!! BAD!!"], [1, 0])
    rows = quality.score_quality(odd, field).collect()
    assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"] == field.prior
    assert quality.score_quality(empty, field).count() == 0
    assert quality.train([], []).prior == 0.5
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_quality_model(odd, none).prior == 0.5


def test_quality_leaves_other_columns_as_they_are(spark):
    """Only texts go to Python, and each is scored once, also below a filter."""
    field = quality.train(["good words here.", "BAD!! BAD!!"], [1, 0])
    # Neither a long beyond 2^53 among nulls nor a map gets through a pandas frame unchanged.
    rows = [(None, {"a": 1}, "good words here."), (2**53 + 1, None, None), (3, {}, "BAD!!\nBAD!! words")]
    docs = spark.createDataFrame(rows, "doc_id long, more map<string, long>, text string").coalesce(1)
    scored = quality.score_quality(docs, field)
    got = scored.collect()
    assert [tuple(r)[:3] for r in got] == rows
    want = quality.score_texts(field, [r[2] for r in rows])
    assert np.allclose([r["score"] for r in got], want) and [r["predicted"] for r in got] == [int(w >= 0.5) for w in want]
    plan = scored.where("predicted = 1").select("score")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "InPandas" not in plan


def test_text_slices():
    texts = pa.array(["ab", None, "é" * 9, "", "abc", "d"])
    assert list(text_slices(texts, 4)) == [["ab", None], ["é" * 9], ["", "abc", "d"]]
    assert list(text_slices(texts[2:], 4)) == [["é" * 9], ["", "abc", "d"]]
    assert list(text_slices(texts[:0], 4)) == []


# --- secrets


def brute_spans(text):
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    names = "|".join([*map(letters, ("password", "passwd", "secret", "token"))] + ["[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])
    assign = re.compile(f"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_spans_equal_plain_scan():
    rng = random.Random(3)
    parts = ["token", "TOKEN", "ſecret", "api_key", "ApiKey", ":", "=", " ", '"', "abcdef", "x", "AKIA" + "A1" * 9, "AKIA", "0f" * 14, "é", "\n", "tokKen"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert secret_scan.base_spans(text) == brute_spans(text), text


def test_markov_tells_random_from_ordinary():
    words = ["configuration", "international", "get_user_by_name", "maxRetryCountValue", "serialization_format", "default-connection-pool"]
    ordinary = [a + "_" + b for a in words for b in words]
    model = secret_scan.MarkovRatio.from_counts(
        secret_scan.pair_counts(secret_scan.random_strings(seed=1)), secret_scan.pair_counts(ordinary)
    )
    held_out = secret_scan.random_strings(400, seed=2)
    assert np.mean([model.score(s) > secret_scan.THRESHOLD for s in held_out]) > 0.97
    assert np.mean([model.score(b + "-" + a) > secret_scan.THRESHOLD for a in words for b in words]) < 0.03


def test_find_secrets(spark, odd, empty):
    docs = documents(spark).select("doc_id", "text")
    model = secret_scan.fit_markov(docs)
    key = "Xq7Zr2Lm9Kt4Vb8Wn3Jd6Hs5Pc1"
    rows = spark.createDataFrame([(1, f"é {key} and internationalisation_of_words", "token = abcdef1")], "doc_id long, text string, secrets string")
    found = secret_scan.find_secrets(rows, model).first()["secrets"]
    assert [(s["kind"], s["start"], s["end"]) for s in found] == [("markov", 2, 2 + len(key))]
    assert all(r["secrets"] == [] for r in secret_scan.find_secrets(odd, model).collect())
    assert secret_scan.find_secrets(empty, model).count() == 0
    assert secret_scan.mask_secrets("a KEY b", [("hex", 2, 5), ("assign", 2, 4)]) == "a <secret> b"


def test_secret_query(spark):
    from labelloom.llm.queries import op4_secrets

    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    for r in op4_secrets(spark, SF).collect():
        want = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(secret_scan.joined(want).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in want) for k in ("assign", "access", "hex"))


# --- licences


def brute_detections(words, table):
    """Every rule everywhere, then the inner ones dropped."""
    found = []
    for i, r in enumerate(table):
        if r.keyword in words:
            found += [(m.start(), -m.end(), r.priority, i, r.label) for m in re.finditer(r.pattern, words)]
    kept = []
    for s, e, p, i, label in sorted(found):
        if not any(q <= p and a <= s and -e <= b for a, b, q, *_ in kept):
            kept.append((s, -e, p, i, label))
    return kept


def test_license_detections(spark):
    table = licenses.rules()
    assert len(table) > 200
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License); MIT License. MIT license!",
        "SPDX-License-Identifier: GPL-3.0-or-later\nGNU General Public License v3 or any later version",
        "cc by-nc 4.0, CC BY. All rights reserved. Copyright (c) 2019 by someone",
        "Mozilla Public Licence version 2.0 " * 30,
        "mit dem Wort; nothing to see",
        "",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    words = licenses.license_words("text")
    rows = docs.select(words.alias("w"), licenses.detections(words, table).alias("d")).collect()
    for r in rows:
        assert [tuple(d) for d in r["d"]] == brute_detections(r["w"], table)
    assert {d["label"] for d in rows[0]["d"]} == {"apache-2.0", "mit"}


def sample(pattern, rng):
    """A random text that the pattern matches."""
    from re import _parser as parser

    def made(part):
        out = []
        for op, value in part:
            name = str(op)
            if name == "LITERAL":
                out.append(chr(value))
            elif name == "IN":
                kind, x = rng.choice(value)
                out.append(chr(x) if str(kind) == "LITERAL" else chr(rng.randint(*x)) if str(kind) == "RANGE" else "1")
            elif name == "BRANCH":
                out.append(made(rng.choice(value[1])))
            elif name == "SUBPATTERN":
                out.append(made(value[3]))
            elif name == "MAX_REPEAT":
                out += [made(value[2]) for _ in range(rng.randint(value[0], min(int(value[1]), value[0] + 1)))]
            else:
                assert name == "ASSERT_NOT"
        return "".join(out)

    return made(parser.parse(pattern))


def test_license_keywords_stand_in_every_match(spark):
    import random

    rng = random.Random(3)
    for rule in licenses.rules():
        for _ in range(200):
            text = sample(rule.pattern, rng)
            assert re.fullmatch(rule.pattern, text) and rule.keyword in text, (rule, text)
    texts = ["do what the heck you want to public license", "Berkeley Software Distribution License", "PSF licensed", "Open Data Commons Database License"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs).collect()}
    assert got == {0: ["wtfpl"], 1: ["bsd"], 2: ["python"], 3: ["odbl"]}


IDENTIFIERS = {
    "0BSD": "0bsd",
    "AGPL-3.0-only": "agpl",
    "Apache-1.1": "apache-1.1",
    "Apache-2.0": "apache-2.0",
    "Artistic-2.0": "artistic-2.0",
    "BSD-2-Clause": "bsd-2-clause",
    "BSD-3-Clause": "bsd-3-clause",
    "BSD-4-Clause": "bsd-4-clause",
    "BSL-1.0": "boost",
    "CC-BY-4.0": "cc-by-4.0",
    "CC-BY-SA-4.0": "cc-by-sa",
    "CC0-1.0": "cc0",
    "CDDL-1.0": "cddl",
    "EPL-2.0": "epl",
    "GPL-2.0-only": "gpl-2.0",
    "GPL-3.0-or-later": "gpl-3.0",
    "ISC": "isc",
    "LGPL-2.1-only": "lgpl",
    "MIT": "mit",
    "MIT-0": "mit-0",
    "MPL-2.0": "mpl-2.0",
    "OFL-1.1": "ofl",
    "PostgreSQL": "postgresql",
    "Unlicense": "unlicense",
    "WTFPL": "wtfpl",
    "Zlib": "zlib",
}


def test_every_identifier_gives_its_license(spark):
    names = sorted(IDENTIFIERS)
    docs = spark.createDataFrame([(i, f"// SPDX-License-Identifier: {n}\nint x;") for i, n in enumerate(names)], "doc_id int, text string")
    # The phrase "cc by" has a label of its own wherever it stands.
    got = {names[r["doc_id"]]: [x for x in r["labels"] if x != "cc-by"] for r in licenses.scan_licenses(docs).collect()}
    assert {n: labels for n, labels in got.items() if labels != [IDENTIFIERS[n]]} == {}


def test_samples_do_not_depend_on_layout(spark):
    from labelloom.llm.common import bounded_sample

    df = spark.range(20_000).withColumnRenamed("id", "k")
    samples = [sorted(r["k"] for r in bounded_sample(df.repartition(n), 20_000, 500, "k").collect()) for n in (1, 7, 23)]
    assert len(samples[0]) == 500 and samples[0] == samples[1] == samples[2]
    assert bounded_sample(df, 20_000, 30_000, "k").count() == 20_000


def test_license_query_counts(spark, odd, empty):
    from labelloom.llm.queries import op5_licenses

    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    lower = {c: c + 32 for c in range(65, 91)}
    for r in op5_licenses(spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(lower))
        places = [
            (k, label)
            for phrase, label in licenses.BASE_PHRASES
            for p in [phrase.split()]
            for k in range(len(words) - len(p) + 1)
            if words[k : k + len(p)] == p
        ]
        starts = [k for k, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
    got = licenses.scan_licenses(odd).collect()
    assert [r["n_words"] for r in got] == [0, 0, 0, 80_000, 4, 4, 3]
    assert all(r["n_base"] == 0 and r["labels"] == [] and r["score"] == 0 for r in got)
    assert licenses.scan_licenses(empty).count() == 0


def test_license_odd_places(spark):
    text = "x MIT License mit license é Apache LICENSE"
    docs = spark.createDataFrame([(1, text, "z")], "doc_id int, text string, n_words string")
    r = licenses.scan_licenses(docs).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (8, 3, 1, 6)
    assert [(d["first"], d["last"], d["label"]) for d in r["detections"]] == [(1, 2, "mit"), (3, 4, "mit"), (6, 7, "apache")]


# --- languages


def test_language_held_out(spark, odd, empty):
    docs = documents(spark)
    net = langid.fit_language_model(docs.where("doc_id % 2 = 0"), sample_rows=400)
    rows = langid.predict_language(docs.where("doc_id % 2 = 1").select("doc_id", "lang", "text"), net)
    assert rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    got = langid.predict_language(odd, net).collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3
    assert got[3]["lang_pred"] in net.labels and 0 < got[3]["score"] <= 1
    assert langid.predict_language(empty, net).count() == 0


def test_language_without_labels(spark, odd):
    none = odd.select("text", F.lit(None).cast("string").alias("lang"))
    net = langid.fit_language_model(none)
    assert {r["lang_pred"] for r in langid.predict_language(odd, net).collect()} == {"und"}


def test_pair_tables_equal_single_lookups():
    net = langid.train(["abc def" * 60, "xyz uvw" * 60], ["a", "b"], epochs=1)
    windows, owner, lengths = langid.windows_of([b"x" * 300, b"yz"])
    assert owner.tolist() == [0, 0, 1] and lengths.tolist() == [256, 44, 2]
    pooled = []
    for w, f in net.filters.items():
        total = sum(f[k][windows[:, k : k + 256 - w + 1]] for k in range(w))
        pooled.append(total.max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    assert np.allclose(net.answers(windows, net.tables()), hidden @ net.out + net.out_bias, atol=1e-4)


# --- tokens


def test_pretokens_count_as_whole_texts():
    model = tokens.load_tokenizer(tokens.tokenizer_path())
    count = tokens.piece_counter(model)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab  \n\t.é1▁\r日<s>") for _ in range(rng.randint(0, 14))) for _ in range(2_000)]
    texts += ["  a  b ", "a\n\n b\t c", " ", "\n", "", "x <s> y</s>"]
    for text in texts:
        words, others, feeds = tokens.pretokens(text)
        got = sum(count([tokens.SPACE + w for w in words])) + sum(count(others)) + feeds * count(["\n"])[0]
        assert got == len(model.encode(text)), repr(text)


@pytest.mark.parametrize("frequent", [0, 50, 200_000])
def test_token_counts(spark, odd, empty, frequent):
    model = tokens.load_tokenizer(tokens.tokenizer_path())
    docs = odd.unionByName(spark.createDataFrame([(9, "  two  spaces\nand a line ", "x", "u")], SCHEMA))
    got = tokens.count_tokens(docs, tokens.tokenizer_path(), frequent)
    want = sorted((r["doc_id"] or 0, len((r["text"] or "").encode()), len(model.encode(r["text"] or ""))) for r in docs.collect())
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert tokens.count_tokens(empty, tokens.tokenizer_path(), frequent).count() == 0
