"""Classes of similar texts: an exact Jaccard self-join on word shingles.

Shingles are ordered, frequent ones last. Two sets of sizes n and m that are
similar enough share a shingle among the first ``n - need(n) + 1`` of each, so
only sets that meet there are compared, by their exact intersection.

Where a shingle stands in few prefixes, all pairs of their sets are compared.
In a crowded one, which copies with small changes make, every set is first
compared with the same few leaders. What they connect needs no comparison
within; the sets left over, few of the crowd, are compared with all that they
are not yet connected with. So no link between classes is missed, and a large
group costs a few comparisons a member.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import compare_key, digest
from labelloom.operators.components import component_labels
from labelloom.operators.sizing import broadcast_if_small, broadcast_rows, collect_longs, most_frequent_rows
from labelloom.storage import write_table

CROWD = 24  # prefixes with a shingle, above which leaders come first
LEADERS = 3
FREQUENT = 500_000  # shingles whose frequency orders prefixes, 16 bytes each
COUNTED_AT_ONCE = 4_000_000
MAX_BROADCAST_COPIES = 500_000


@dataclass(frozen=True)
class Alike:
    """``shared / union >= num / den`` over runs of ``words`` words."""

    words: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n: int) -> int:
        """How many shingles of a set of ``n`` are looked at for partners."""
        return n - -(-self.num * n // self.den) + 1

    def holds(self, common: Column, n: Column, m: Column) -> Column:
        return common * self.den >= (n + m - common) * self.num

    def possible(self, n: Column, m: Column) -> Column:
        """Whether sets of these sizes can be similar."""
        return (n * self.den >= m * self.num) & (m * self.den >= n * self.num)


def shingle_hashes(df: DataFrame, text: Column, words: int) -> DataFrame:
    """``df`` with ``shingles``, the distinct 64-bit hashes of the runs of
    ``words`` words; a text with fewer is one run, one without words has none."""
    listed = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    hashed = df.withColumn("word_hashes", F.transform(listed, lambda w: F.xxhash64(w)))
    size, h = F.size("word_hashes"), F.col("word_hashes")
    runs = F.transform(
        F.sequence(F.lit(0), size - words), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)])
    )
    short = F.array(F.xxhash64(h, size))
    none = F.array().cast("array<bigint>")
    made = F.when(size >= words, F.array_distinct(runs)).when(size > 0, short).otherwise(none)
    return hashed.withColumn("shingles", made).drop("word_hashes")


def frequent_shingles(sets: DataFrame, bound: int = FREQUENT) -> dict[str, np.ndarray]:
    """``(shingle, met)`` of those that batches of texts hold repeatedly, the most
    frequent, ``bound`` at most. Only the order of prefixes depends on it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[np.ndarray] = []
        held = 0

        def repeated() -> pd.DataFrame:
            values, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pd.DataFrame({"shingle": values[counts > 1], "met": counts[counts > 1]})

        for frame in frames:
            for s in frame["shingles"]:
                waiting.append(s)
                held += len(s)
                if held > COUNTED_AT_ONCE:
                    yield repeated()
                    waiting, held = [], 0
        if held:
            yield repeated()

    counted = sets.select("shingles").mapInPandas(run, "shingle long, met long")
    summed = write_table(counted.groupBy("shingle").agg(F.sum("met").alias("met")), "frequent_shingles")
    return collect_longs(most_frequent_rows(summed, "met", bound), "shingle", "met")


def prefix_entries(sets: DataFrame, frequent: dict[str, np.ndarray], rule: Alike) -> DataFrame:
    """``(shingle, set_id, n, pos)``: the prefix of each set in the global order."""
    order = np.argsort(frequent["shingle"])
    known = sets.sparkSession.sparkContext.broadcast((frequent["shingle"][order], frequent["met"][order]))
    id_type = sets.schema["set_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values, met = known.value
        for frame in frames:
            parts = []
            for set_id, s in zip(frame["set_id"], frame["shingles"], strict=True):
                count = np.zeros(len(s), dtype=np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                    count = np.where(values[at] == s, met[at], 0)
                first = s[np.lexsort((s, count))][: rule.prefix(len(s))]
                parts.append((set_id, len(s), first))
            lengths = [len(p[2]) for p in parts]
            if not parts:
                continue
            yield pd.DataFrame(
                {
                    "shingle": np.concatenate([p[2] for p in parts]),
                    "set_id": np.repeat([p[0] for p in parts], lengths),
                    "n": np.repeat([p[1] for p in parts], lengths),
                    "pos": np.concatenate([np.arange(k) for k in lengths]),
                }
            )

    return sets.select("set_id", "shingles").mapInPandas(run, f"shingle long, set_id {id_type}, n long, pos long")


def _sides(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(
        df.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "shingle"])
        for side, df in (("a", a), ("b", b))
    )


def _met(a: DataFrame, b: DataFrame, rule: Alike, condition: Column) -> DataFrame:
    """Pairs ``(a, b)`` that meet in a shingle and can still be similar: what
    they share begins at their first meeting, and one entry of each pair is it."""
    one, two = _sides(a, b)
    left = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    reach = rule.holds(left, F.col("n_a"), F.col("n_b"))
    met = one.join(two, "shingle").where(condition & rule.possible(F.col("n_a"), F.col("n_b")) & reach)
    return met.select(F.least("set_id_a", "set_id_b").alias("a"), F.greatest("set_id_a", "set_id_b").alias("b")).distinct()


def _similar(pairs: DataFrame, sets: DataFrame, rule: Alike) -> DataFrame:
    one = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    alike = rule.holds(common, F.size("s_a"), F.size("s_b"))
    return pairs.join(one, "a").join(two, "b").where(alike).select("a", "b")


def similar_links(sets: DataFrame, rule: Alike, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` between similar sets ``(set_id, shingles)``: enough that
    their components are those of all similar pairs."""
    entries = prefix_entries(sets, frequent_shingles(sets), rule)
    entries = write_table(entries, "prefix_entries")
    counts = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    posting = write_table(entries.join(counts, "shingle"), "shared_entries")

    few = posting.where(F.col("met") <= crowd).drop("met")
    pairs = write_table(_met(few, few, rule, F.col("set_id_a") < F.col("set_id_b")), "pairs")
    links = write_table(_similar(pairs, sets, rule), "links_of_few")

    many = posting.where(F.col("met") > crowd).drop("met")
    if many.isEmpty():
        return links
    # The same sets lead in all shingles that they share.
    member = F.struct("set_id", "n", "pos")
    best = [F.min_by(member, F.xxhash64(F.lit(k), "set_id")).alias(f"leader_{k}") for k in range(LEADERS)]
    chosen = many.groupBy("shingle").agg(*best)
    listed = F.explode(F.array(*[f"leader_{k}" for k in range(LEADERS)]))
    leaders = chosen.select("shingle", listed.alias("leader")).select("shingle", "leader.*").distinct()
    leaders = broadcast_if_small(write_table(leaders, "leaders"))
    led = write_table(_met(many, leaders, rule, F.col("set_id_a") != F.col("set_id_b")), "pairs_with_leaders")
    links = links.unionByName(write_table(_similar(led, sets, rule), "links_of_leaders"))

    labels = component_labels(links).withColumnsRenamed({"node": "set_id"})
    named = many.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    named = write_table(named, "named_entries")
    by_label = named.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("k"))
    tops = by_label.groupBy("shingle").agg(F.max_by("label", "k").alias("top"), F.count(F.lit(1)).alias("labels"))
    open_shingles = write_table(tops.where("labels > 1").select("shingle", "top"), "open_shingles")
    rest = named.join(broadcast_if_small(open_shingles), "shingle").withColumn("minor", F.col("label") != F.col("top")).drop("top")
    apart = (F.col("label_a") != F.col("label_b")) & (~F.col("minor_b") | (F.col("set_id_a") < F.col("set_id_b")))
    others = write_table(_met(rest.where("minor"), rest, rule, apart), "pairs_of_the_rest")
    return links.unionByName(write_table(_similar(others, sets, rule), "links_of_the_rest"))


def near_duplicate_classes(
    df: DataFrame,
    rule: Alike | None = None,
    text_col: str = "text",
    id_col: str = "row_id",
    crowd: int = CROWD,
) -> DataFrame:
    """``(row_id, n_shingles, component_id)`` for every row: the number of its
    different shingles, and the smallest id that it is connected with by
    similar pairs.

    Texts are compared by their comparison keys, in words between ASCII white
    space; equal keys are one set. Null and blank texts have no shingles and
    are a class of their own each. ``crowd`` changes the cost only. Shingles
    are 64-bit hashes; everything else is exact.
    """
    rule = rule or Alike()
    keys = write_table(df.select(F.col(id_col).alias("row_id"), digest(compare_key(text_col)).alias("digest")), "key_digests")
    firsts = keys.groupBy("digest").agg(F.min("row_id").alias("set_id"))
    classes = write_table(keys.join(firsts, keys["digest"].eqNullSafe(firsts["digest"])).select("row_id", "set_id"), "copies")
    copies = classes.where("row_id <> set_id").select(F.col("row_id").alias("set_id"))
    texts = df.select(F.col(id_col).alias("set_id"), compare_key(text_col).alias("key"))
    first_texts = texts.join(broadcast_rows(copies, copies.count(), MAX_BROADCAST_COPIES), "set_id", "left_anti")
    sets = shingle_hashes(first_texts, F.col("key"), rule.words).select("set_id", "shingles")
    sets = write_table(sets, "shingle_sets")
    labels = component_labels(similar_links(sets.where(F.size("shingles") > 0), rule, crowd))
    sizes = sets.select("set_id", F.size("shingles").cast("long").alias("n_shingles"))
    found = classes.join(sizes, "set_id").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("row_id")).otherwise(F.coalesce("label", "set_id"))
    return found.select(F.col("row_id").alias(id_col), "n_shingles", own.alias("component_id"))
