"""Edge cases of the preparation, guardrail and monitoring operators."""

import hashlib
import random
import statistics

from pyspark.sql import functions as F

from labelloom.operators import guardrails, monitoring, prepare
from labelloom.sources import readers, writers


def test_templates(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "open"), (2, 0, "user", "x"), (2, 1, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["example"] for r in prepare.format_instruction(turns).collect()}
    assert got[1, 1] == "### Instruction:\nq\n\n### Input:\nbe brief\n\n### Response:\na"
    assert got[2, 0] == "### Instruction:\nx\n\n### Response:\ny" and len(got) == 2
    chat = {r["conv_id"]: r["chat"] for r in prepare.format_chat(turns.repartition(3)).collect()}
    assert chat[2] == "<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n"


def test_samples_and_filters(spark):
    df = spark.range(50).selectExpr("id AS row_id", "concat('w ', id) AS text", "id % 2 AS label")
    assert prepare.sample_exact(df, 7).count() == 7 and prepare.sample_exact(df, 80).count() == 50
    again = prepare.sample_exact(df.repartition(9), 7).collect()
    assert {r["row_id"] for r in again} == {r["row_id"] for r in prepare.sample_exact(df, 7).collect()}
    assert prepare.stratified_sample(df, 0.2).groupBy("label").count().collect() == prepare.stratified_sample(df.repartition(5), 0.2).groupBy("label").count().collect()
    texts = spark.createDataFrame([(1, None), (2, "a b"), (3, "a, b")], "row_id long, text string")
    assert [(r["row_id"], r["n_tokens"]) for r in prepare.token_length_filter(texts, 0, 2).orderBy("row_id").collect()] == [(1, 0), (2, 2)]


def test_templates_keep_turns_with_nulls(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, None, "r")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = prepare.format_chat(turns).first()
    pieces = ["user\nq", "assistant\n", "unknown\nr"]
    assert row["n_turns"] == 3
    assert row["chat"] == "".join(f"<|im_start|>{p}<|im_end|>\n" for p in pieces)
    assert prepare.format_instruction(turns).first()["example"] == "### Instruction:\nq\n\n### Response:\n"


def test_dedup_by_hash(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "A b "), (3, None)], "row_id long, text string")
    assert {r["row_id"]: r["copies"] for r in prepare.dedup_by_hash(df).collect()} == {1: 2, 3: 1}


def test_guardrails(spark):
    rows = [
        (1, "en", "hello you IDIOT!", "fine"),
        (2, "en", "mail a.b@c.org", "take 20 mg. This is not advice."),
        (3, "xx", None, None),
        (4, "en", "ok", "from 10.0.0.1"),
    ]
    df = spark.createDataFrame(rows, "row_id long, domain string, question string, answer string")
    out = {r["row_id"]: (r["answer"], r["flags"]) for r in guardrails.guardrail_chain(df, {"en": "This is not advice."}).collect()}
    assert out[1] == (None, ["input:blocklist"])
    assert out[2] == ("take 20 mg. This is not advice.", ["input:pii", "output:format"])
    assert out[3] == (None, [])
    assert out[4] == ("from [ip]\nThis is not advice.", ["output:pii"])
    hits = df.select(guardrails.blocklist_hits("question").alias("h")).collect()
    assert [r["h"] for r in hits] == [["idiot"], [], [], []]


def test_monitoring(spark):
    log = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (2, "b", "x"), (2, "a", "x"), (3, "b", "x")], "question_id long, phase string, response string")
    got = {r["question_id"]: r["changed"] for r in monitoring.compare_answers(log, "b", "a").collect()}
    assert got == {1: True, 2: False}
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0])], "label int, embedding array<double>")
    drift = monitoring.centroid_drift(vectors, vectors, "label").collect()
    assert all(abs(r["cosine"] - 1) < 1e-12 for r in drift)
    rows = vectors.withColumn("vec_id", F.monotonically_increasing_id())
    same = monitoring.stability_index(rows, rows, k=2)
    assert same.agg(F.sum("psi")).first()[0] == 0


def test_disclaimers_with_clashing_columns(spark):
    df = spark.createDataFrame([("en", "x", 1, 2), ("en", None, 1, 2), (None, "y", 1, 2)], "domain string, text string, disclaimer int, domain_name int")
    out = guardrails.with_disclaimer(df, {"en": "D."})
    assert out.columns == df.columns
    assert [r["text"] for r in out.collect()] == ["x\nD.", None, "y"]


def test_pii_is_found_exactly_where_redaction_changes_a_text(spark):
    texts = ["a.b@c.org", "10.0.0.1x", "from 10.0.0.1", "1234 5678 9012 3456", "+49 123 4567", "nothing", "", None, "1.2.3.4@x.yy 12345678901234567"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(guardrails.has_pii("t").alias("has"), (guardrails.redact("t") != F.col("t")).alias("changed")).collect()
    assert [r["has"] for r in rows] == [r["changed"] for r in rows]
    assert rows[0]["has"] and not rows[5]["has"] and rows[7]["has"] is None


def test_guardrails_rewrite_each_text_once(spark):
    df = spark.createDataFrame([], "row_id long, domain string, question string, answer string")
    plan = guardrails.guardrail_chain(df, {"en": "D."})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"[{guardrails.PII_RULES[0][0]}]") == 1 and "Join" not in plan


def test_sample_of_any_size_moves_no_row(spark):
    df = spark.range(3_000).selectExpr("id * 7 AS row_id", "'t' AS text").repartition(4)
    order = sorted(range(3_000), key=lambda i: hashlib.md5(f"42:{i * 7}".encode()).hexdigest())
    for n in (1, 2, 1_500, 2_999, 3_000, 9_999, 0):
        got = prepare.sample_exact(df, n)
        assert {r["row_id"] for r in got.collect()} == {i * 7 for i in order[:n]}
    plan = prepare.sample_exact(df.repartition(1), 1_500)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_profiles_add_up_and_drift(spark):
    rows = [("a", "one two.\nthree"), ("a", ""), ("a", None), ("a", "x x x x!"), ("b", "solo")]
    df = spark.createDataFrame(rows, "role string, text string")
    whole = monitoring.response_profile(df, "role")
    parts = monitoring.merge_profiles(
        monitoring.response_profile(df.limit(2), "role"), monitoring.response_profile(df.exceptAll(df.limit(2)), "role")
    )
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    got = {(r["role"], r["statistic"]): r for r in monitoring.profile_summary(whole).collect()}
    assert len(got) == 10
    words = got["a", "words"]
    assert (words["n"], words["mean"], words["p50"]) == (4, 7 / 4, 1.5)
    assert abs(words["sd"] - statistics.stdev([3, 0, 0, 4])) < 1e-12
    assert got["a", "sentences"]["mean"] == 0.5 and got["b", "words"]["sd"] is None and got["a", "lines"]["p50"] is None
    live = monitoring.response_profile(spark.createDataFrame([("a", "w " * 9), ("c", "new")], df.schema), "role")
    drift = {(r["role"], r["statistic"]): r for r in monitoring.response_drift(whole, live).collect()}
    row = drift["a", "words"]
    assert abs(row["z"] - (9 - 7 / 4) / statistics.stdev([3, 0, 0, 4])) < 1e-12 and row["p95"] == 9
    assert drift["c", "words"]["z"] is None and drift["c", "words"]["baseline_mean"] is None


def test_flag_rates_by_rule_and_user_questions(spark):
    events = spark.createDataFrame([(0, ["a", "a"]), (1, ["a", "b"]), (2, []), (30_000, ["b"]), (30_001, None)], "s long, flags array<string>")
    events = events.withColumn("ts", F.timestamp_seconds("s"))
    got = [(r["rule"], r["n"], r["n_flagged"]) for r in monitoring.flag_rate_by_rule(events, F.col("flags")).orderBy("period", "rule").collect()]
    assert got == [("a", 3, 2), ("b", 3, 1), ("b", 2, 1)]
    turns = spark.createDataFrame(
        [(1, "system", "s"), (1, "user", "Q "), (1, "assistant", "a"), (2, "user", "q"), (2, "user", "q"), (2, "user", "r")],
        "conv_id long, role string, text string",
    )
    top = monitoring.top_questions(monitoring.user_questions(turns), "domain", k=1).collect()
    assert sorted((r["domain"], r["key"], r["n"]) for r in top) == [("guided", "q", 1), ("open", "q", 2)]


def test_rewriting_a_domain_leaves_the_others(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "domain string, x int")
    writers.write_stage(df, str(tmp_path), "raw")
    writers.write_stage(df.where("domain = 'b'").withColumn("x", F.lit(9)), str(tmp_path), "raw")
    got = readers.read_stage(spark, str(tmp_path), "raw").select("domain", "x").collect()
    assert {tuple(r) for r in got} == {("a", 1), ("b", 9), (None, 3)}
    assert readers.read_stage(spark, str(tmp_path), "raw", domain="b").count() == 1


def test_feedback_is_found_in_time(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(4_000), rng.choice(["r", "f", "x"])) for _ in range(500)]
    events = spark.createDataFrame(rows, "user_id long, s long, kind string").withColumn("ts", F.timestamp_seconds("s"))
    for within in (1, 7, 100, 10_000):
        got = monitoring.feedback_rate(events, F.col("kind") == "r", F.col("kind") == "f", within=within).collect()
        asked = [(u, s) for u, s, k in rows if k == "r" and u is not None]
        followed = sum(any(k == "f" and v == u and 0 < t - s <= within for v, t, k in rows) for u, s in asked)
        assert [(r["n"], r["n_followed"]) for r in got] == [(len(asked), followed)]
    assert monitoring.feedback_rate(events.limit(0), F.col("kind") == "r", F.col("kind") == "f").count() == 0
