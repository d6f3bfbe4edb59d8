"""Statistics over answers, events and embeddings in the course of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.functions.text import compare_key, word_count
from labelloom.operators.clusters import cluster_counts, dot, mean_vectors, read_baseline, save_baseline
from labelloom.storage import scratch_path


def response_stats(df: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """Length, structure and vocabulary of the texts of each group."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(compare_key(text), r"\s+"), lambda w: w != "")
    ratio = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    return (
        df.select(
            group_col,
            F.length(text).alias("chars"),
            word_count(text).alias("words"),
            (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("lines"),
            F.regexp_count(text, F.lit("[.!?]")).alias("sentences"),
            ratio.alias("distinct_ratio"),
        )
        .groupBy(group_col)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("chars").alias("mean_chars"),
            F.stddev_samp("chars").alias("sd_chars"),
            F.avg("words").alias("mean_words"),
            F.avg("lines").alias("mean_lines"),
            F.avg("sentences").alias("mean_sentences"),
            F.avg("distinct_ratio").alias("distinct_ratio"),
        )
    )


STATISTICS = ("chars", "words", "lines", "sentences", "distinct_ratio")


def response_profile(df: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """``(group, length, n, s_<statistic>, q_<statistic>)``: rows, sums and sums of
    squares by group and number of words. Profiles of disjoint sets of answers
    add up (``merge_profiles``), so one can be saved as a baseline and another
    kept up from day to day. Null texts count as empty ones."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(compare_key(text), r"\s+"), lambda w: w != "")
    measured = df.select(
        group_col,
        F.length(text).cast("double").alias("chars"),
        word_count(text).cast("double").alias("words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double").alias("lines"),
        F.regexp_count(text, F.lit("[.!?]")).cast("double").alias("sentences"),
        words.alias("ws"),
    ).withColumn("distinct_ratio", F.size(F.array_distinct("ws")) / F.greatest(F.size("ws"), F.lit(1)))
    sums = [f(c) for c in STATISTICS for f in (lambda c: F.sum(c).alias(f"s_{c}"), lambda c: F.sum(F.col(c) ** 2).alias(f"q_{c}"))]
    return measured.groupBy(group_col, F.col("words").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"), *sums)


def merge_profiles(one: DataFrame, two: DataFrame) -> DataFrame:
    """The profile of both sets of answers together."""
    group_col = one.columns[0]
    return one.unionByName(two).groupBy(group_col, "length").agg(*[F.sum(c).alias(c) for c in one.columns[2:]])


def profile_summary(profile: DataFrame) -> DataFrame:
    """``(group, statistic, n, mean, sd, p50, p95)``, a row per statistic; the
    percentiles are those of the number of words, exact, and null for others."""
    group_col = profile.columns[0]
    totals = profile.groupBy(group_col).agg(
        F.sum("n").alias("n"),
        *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for c in STATISTICS for k in "sq"],
        *[F.percentile("length", p, F.col("n")).alias(name) for name, p in (("p50", 0.5), ("p95", 0.95))],
    )
    n = F.col("n")

    def row(c: str) -> Column:
        s, q = F.col(f"s_{c}"), F.col(f"q_{c}")
        # Below zero only by rounding.
        variance = F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1)
        ranks = [(F.col(p) if c == "words" else F.lit(None).cast("double")).alias(p) for p in ("p50", "p95")]
        return F.struct(F.lit(c).alias("statistic"), n.alias("n"), (s / n).alias("mean"), F.when(n > 1, F.sqrt(variance)).alias("sd"), *ranks)

    return totals.select(group_col, F.inline(F.array(*[row(c) for c in STATISTICS])))


def response_drift(baseline: DataFrame, live: DataFrame) -> DataFrame:
    """``(group, statistic, n, mean, p50, p95, baseline_mean, baseline_sd, z)``
    of two profiles: how many standard errors the live mean is away from the
    baseline's. Groups that the baseline lacks have no z, nor have those whose
    baseline does not vary."""
    group_col = live.columns[0]
    now = profile_summary(live).drop("sd")
    then = profile_summary(baseline).select(group_col, "statistic", F.col("mean").alias("baseline_mean"), F.col("sd").alias("baseline_sd"))
    z = F.when(F.col("baseline_sd") > 0, (F.col("mean") - F.col("baseline_mean")) / F.col("baseline_sd") * F.sqrt("n"))
    # A few rows per group on either side.
    return now.join(then, [group_col, "statistic"], "left").withColumn("z", z)


def daily_stats(events: DataFrame, group_col: str, ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """Rows and sum of values per group and day."""
    return events.groupBy(group_col, F.to_date(ts_col).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("total")
    )


def rolling_stats(daily: DataFrame, group_col: str, days: int = 7) -> DataFrame:
    """Mean value over a day and the days before it that have rows, at most
    ``days`` of them. The window runs over days, not over rows."""
    recent = Window.partitionBy(group_col).orderBy("day").rowsBetween(1 - days, 0)
    return daily.select(
        group_col,
        "day",
        F.sum("n").over(recent).alias("rolling_n"),
        (F.sum("total").over(recent) / F.sum("n").over(recent)).alias("rolling_mean"),
    )


def flag_rate(events: DataFrame, flagged: Column, ts_col: str = "ts", period: str = "6 hours") -> DataFrame:
    """Share of flagged rows per period."""
    return (
        events.groupBy(F.window(F.col(ts_col).cast("timestamp_ntz"), period)["start"].alias("period"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(flagged).alias("n_flagged"))
        .withColumn("rate", F.col("n_flagged") / F.col("n"))
    )


def flag_rate_by_rule(events: DataFrame, flags: Column, ts_col: str = "ts", period: str = "6 hours") -> DataFrame:
    """``(period, rule, n, n_flagged, rate)``: for every rule that flagged any row
    of a period, the share of the period's rows that it flagged. ``flags`` is an
    array of rule names; a name given twice for a row counts once."""
    start = F.window(F.col(ts_col).cast("timestamp_ntz"), period)["start"]
    # A row per period and combination of flags.
    counted = events.groupBy(start.alias("period"), F.array_sort(F.array_distinct(flags)).alias("flags")).agg(F.count(F.lit(1)).alias("k"))
    totals = counted.groupBy("period").agg(F.sum("k").alias("n"))
    by_rule = counted.select("period", F.explode("flags").alias("rule"), "k").groupBy("period", "rule").agg(F.sum("k").alias("n_flagged"))
    return by_rule.join(totals, "period").select("period", "rule", "n", "n_flagged", (F.col("n_flagged") / F.col("n")).alias("rate"))


def feedback_rate(
    events: DataFrame,
    is_response: Column,
    is_feedback: Column,
    user_col: str = "user_id",
    ts_col: str = "ts",
    within: int = 3_600,
    period: str = "1 day",
) -> DataFrame:
    """``(period, n, n_followed, rate)``: responses, and those that the same user
    gave feedback on later, at most ``within`` seconds after.

    A response looks for the first feedback behind it in its own stretch of
    ``within`` seconds, and takes the first of the next stretch otherwise, so no
    response meets more than two rows, and a user with very many events is as
    many groups as there are stretches. Rows without user or time are left out.
    """
    length = within * 1_000_000
    at = F.unix_micros(F.col(ts_col).cast("timestamp")).alias("at")
    rows = events.select(F.col(user_col).alias("user"), at, is_response.alias("response"), is_feedback.alias("feedback"))
    rows = rows.where(F.col("user").isNotNull() & F.col("at").isNotNull() & (F.col("response") | F.col("feedback")))
    rows = rows.withColumn("stretch", F.floor(F.col("at") / length).cast("long"))
    given = F.when(F.col("feedback"), F.col("at"))
    behind = Window.partitionBy("user", "stretch").orderBy("at").rangeBetween(1, length)
    own = rows.withColumn("next", F.min(given).over(behind)).where("response")
    first = rows.where("feedback").groupBy("user", (F.col("stretch") - 1).alias("stretch")).agg(F.min("at").alias("first"))
    followed = F.coalesce(F.coalesce("next", "first") - F.col("at") <= length, F.lit(False))
    start = F.window(F.timestamp_micros("at").cast("timestamp_ntz"), period)["start"]
    return (
        own.join(first, ["user", "stretch"], "left")
        .groupBy(start.alias("period"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(followed).alias("n_followed"))
        .withColumn("rate", F.col("n_followed") / F.col("n"))
    )


def user_questions(turns: DataFrame) -> DataFrame:
    """The user's turns with the ``domain`` of their conversation: its system
    text decides whether it is ``guided`` or ``open``."""
    guided = turns.where("role = 'system'").select("conv_id").distinct().withColumn("domain", F.lit("guided"))
    asked = turns.where("role = 'user'").join(guided, "conv_id", "left")
    return asked.withColumn("domain", F.coalesce("domain", F.lit("open")))


def top_questions(df: DataFrame, group_col: str, k: int = 5, text_col: str = "text") -> DataFrame:
    """The ``k`` most frequent texts of each group, by their comparison key;
    ties go to the smaller key. Counts combine before the shuffle, and ranks
    are cut before it."""
    counted = df.groupBy(group_col, compare_key(text_col).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group_col).orderBy(F.desc("n"), "key")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def compare_answers(log: DataFrame, before: str, after: str, key: str = "question_id") -> DataFrame:
    """``(key, before, after, changed)`` of the questions answered in both phases
    of an evaluation log ``(question_id, phase, response)``."""
    one = log.where(F.col("phase") == before).select(key, F.col("response").alias("before"))
    two = log.where(F.col("phase") == after).select(key, F.col("response").alias("after"))
    return one.join(two, key).withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def centroid_drift(baseline: DataFrame, live: DataFrame, group_col: str, vector_col: str = "embedding") -> DataFrame:
    """Cosine between the baseline's and the live centroid of each group."""
    one = mean_vectors(baseline, F.col(group_col), vector_col)
    two = mean_vectors(live, F.col(group_col), vector_col).withColumnRenamed("center", "live")
    return one.join(two, "group").select(F.col("group").alias(group_col), cosine(F.col("center"), F.col("live")).alias("cosine"))


def stability_rows(
    live: DataFrame, centers: Sequence[Sequence[float]], counts: Sequence[int], vector_col: str = "embedding", floor: float = 1e-4
) -> DataFrame:
    """``(cluster, baseline, live, p, q, psi)`` for every center: rows and shares
    on both sides, and its part of the population stability index. ``counts``
    are the baseline's. Shares below ``floor``, empty clusters among them, count
    as ``floor``."""
    spark = live.sparkSession
    saved = spark.createDataFrame(list(enumerate(int(n) for n in counts)), "cluster int, baseline long")
    both = saved.join(F.broadcast(cluster_counts(live, centers, vector_col).withColumnRenamed("n", "live")), "cluster")
    # One row per center.
    every = Window.partitionBy()

    def share(count: str) -> Column:
        return F.greatest(F.col(count) / F.greatest(F.sum(count).over(every), F.lit(1)), F.lit(floor))

    shares = both.select("cluster", "baseline", "live", share("baseline").alias("p"), share("live").alias("q"))
    return shares.withColumn("psi", (F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p")))


def stability_index(
    baseline: DataFrame,
    live: DataFrame,
    k: int = 10,
    rounds: int = 5,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    path: str | None = None,
) -> DataFrame:
    """``(cluster, p, q, psi)`` over clusters fitted on the baseline. The centers
    are saved under ``path`` and read back, so that later batches can be held
    against the same."""
    spark = baseline.sparkSession
    path = path or scratch_path(spark, "baseline_clusters")
    save_baseline(baseline, path, k, rounds, vector_col, id_col)
    centers, counts, _ = read_baseline(spark, path)
    return stability_rows(live, centers, counts, vector_col).select("cluster", "p", "q", "psi")
