"""Jaccard self-join of texts on word shingles with adaptive multi-match prefixes.

All sets are ordered by one global order, rare shingles first. Two sets that
are similar enough share at least L shingles among the first n - need(n) + L of
each, for every L. A document whose prefix would meet many others takes a
larger L: its prefix is longer, but a partner has to share L of it before the
two sets are compared.

1. Texts with the same set are one class; classes stand for their members.
2. Shingles met often are counted where the texts are; the most frequent, in a
   table of bounded size, come last in the order. Only speed depends on it.
3. Prefix entries are counted by shingle. Those in few sets are joined with
   each other to pairs, which count their matches and are verified.
4. Shingles in many prefixes would make all pairs of a group. A set with h of
   them takes an L that is larger by as many: its partners then share as many
   others with it as before, and are found over these alone.
5. Sets whose longest prefix doesn't hold enough others, mostly copies of each
   other, are families with those that share such shingles, directly or in a
   chain. A family is cut by set size into bands, a band into blocks, and each
   pair of blocks that can hold similar sets is compared in memory by one task,
   which gives back the links needed to connect them and numbers of links, not
   the pairs.
6. Components over both kinds of links.

Sets are compared exactly, on 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import most_frequent, slices
from labelloom.llm.graph import connected_components
from labelloom.llm.words import find_words, mix64, shingle_sets
from labelloom.operators.sizing import broadcast_if_small, broadcast_rows, collect_longs
from labelloom.storage import release_shuffles, write_table

SLICE_CHARS = 500_000
COUNTED_AT_ONCE = 2_000_000
LISTED_AT_ONCE = 50_000  # repeated shingles in one row
FREQUENT = 1_000_000  # shingles with a known frequency, 16 bytes each
MEMBERSHIP_BITS = 24
LEAST_LEVEL = 2  # one shared shingle happens by chance, as the square of the texts
COSTS = (32, 256, 2_048)  # estimated candidates above which L grows by one
MAX_LEVEL = 12  # L of a set with shingles in many prefixes, at most
COLD = 24  # prefixes a shingle may be in and still be joined pair by pair
COMPARED_AT_ONCE = 256
BLOCK = 1_024  # sets of a block at most
BLOCK_SHINGLES = 1 << 19  # and their shingles, if there are more than COMPARED_AT_ONCE sets
MAX_BROADCAST_SETS = 1_000_000
_ROW = "__row_number"


@dataclass(frozen=True)
class Similarity:
    """``shared / union >= num / den`` over shingles of ``words`` words."""

    words: int = 5
    num: int = 80
    den: int = 100

    def need(self, n: np.ndarray | int) -> np.ndarray | int:
        """The shingles that a set of ``n`` shares at least with a similar one."""
        return -(-self.num * n // self.den)


def set_ids(sets: list[np.ndarray]) -> list[bytes | None]:
    """A 128-bit fingerprint of each set; none for an empty one."""
    ids: list[bytes | None] = []
    for s in sets:
        if len(s):
            mixed = mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            total = np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(mixed)) ^ np.uint64(len(s))])
            ids.append(total.astype(">u8").tobytes())
        else:
            ids.append(None)
    return ids


def document_sets(docs: DataFrame, rule: Similarity, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, set_id, often, met)``: a row per document, and rows without set
    or size whose ``often`` lists shingles that a batch of texts holds
    repeatedly, and ``met`` their numbers."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[np.ndarray] = []
        held = 0

        def repeated() -> Iterator[pd.DataFrame]:
            shingles = np.concatenate(waiting)
            waiting.clear()
            shingles.sort()
            first = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
            counts = np.diff(np.append(first, len(shingles)))
            shingles, counts = shingles[first[counts > 1]].view(np.int64), counts[counts > 1]
            for start in range(0, len(shingles), LISTED_AT_ONCE):
                part = slice(start, start + LISTED_AT_ONCE)
                rest = {"id": [None], "n": pd.array([None], dtype="Int64"), "set_id": [None]}
                yield pd.DataFrame(rest | {"often": [shingles[part]], "met": [counts[part]]})

        for frame in slices(frames, text_col, SLICE_CHARS):
            sets = shingle_sets(find_words(frame[text_col].tolist()), len(frame), rule.words)
            yield pd.DataFrame(
                {"id": frame[id_col].to_numpy(), "n": [len(s) for s in sets], "set_id": set_ids(sets), "often": None, "met": None}
            )
            for s in sets:
                waiting.append(s)
                held += len(s)
                if held > COUNTED_AT_ONCE:
                    yield from repeated()
                    held = 0
        if held:
            yield from repeated()

    schema = f"id {id_type}, n long, set_id binary, often array<long>, met array<long>"
    return docs.select(id_col, text_col).mapInPandas(run, schema)


def level_of(cost: int) -> int:
    """L by the estimated number of candidates."""
    return LEAST_LEVEL + sum(cost > c for c in COSTS)


def prefixes(docs: DataFrame, frequent: dict[str, np.ndarray], rule: Similarity, text_col: str) -> DataFrame:
    """``(set_id, n, level, prefix)``: the first shingles of each document's set
    in the global order, as many as the highest level asks for. A task gives
    each set once, however many copies of it it meets."""
    known = docs.sparkSession.sparkContext.broadcast((frequent["shingle"], frequent["met"]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, met = known.value
        shingles = shingles.view(np.uint64)
        by_value = np.argsort(shingles)
        shingles, met = shingles[by_value], met[by_value]
        low = np.uint64((1 << MEMBERSHIP_BITS) - 1)
        maybe = np.zeros(1 << MEMBERSHIP_BITS, dtype=bool)
        maybe[(shingles & low).astype(np.int64)] = True

        def frequency(values: np.ndarray) -> np.ndarray:
            counts = np.zeros(len(values), dtype=np.int64)
            at = np.flatnonzero(maybe[(values & low).astype(np.int64)])
            if len(at):
                place = np.minimum(np.searchsorted(shingles, values[at]), len(shingles) - 1)
                hit = shingles[place] == values[at]
                counts[at[hit]] = met[place[hit]]
            return counts

        seen: set[bytes] = set()
        for frame in slices(frames, text_col, SLICE_CHARS):
            sets = shingle_sets(find_words(frame[text_col].tolist()), len(frame), rule.words)
            counts = frequency(np.concatenate(sets) if sets else np.zeros(0, np.uint64))
            rows, place = [], 0
            for s, key in zip(sets, set_ids(sets), strict=True):
                n = len(s)
                own = counts[place : place + n]
                place += n
                if key is None or key in seen:
                    continue
                seen.add(key)
                # Sets are sorted by value; a stable sort keeps that among equals.
                if own.any():
                    by_count = np.argsort(own, kind="stable")
                    s, own = s[by_count], own[by_count]
                need = rule.need(n)
                cost = int(own[: n - need + 1].sum())
                level = min(level_of(cost), need)
                rows.append((key, n, level, s[: n - need + min(MAX_LEVEL, need)].view(np.int64)))
            yield pd.DataFrame(rows, columns=["set_id", "n", "level", "prefix"])

    schema = "set_id binary, n long, level int, prefix array<long>"
    return docs.select(text_col).mapInPandas(run, schema)


def wanted_sets(docs: DataFrame, wanted: DataFrame, rule: Similarity, id_col: str, text_col: str) -> DataFrame:
    """``(set_id, n, shingles)`` of the classes in ``wanted``, ``(set_id, id)``
    with a member of each; classes without any id are looked for among the
    rows that have none. Where ids repeat, a class may come more than once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "text", SLICE_CHARS):
            sets = shingle_sets(find_words(frame["text"].tolist()), len(frame), rule.words)
            rows = [(k, len(s), s.view(np.int64)) for k, s in zip(set_ids(sets), sets, strict=True) if k]
            yield pd.DataFrame(rows, columns=["set_id", "n", "shingles"])

    ids = wanted.select("id").where(F.col("id").isNotNull()).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(broadcast_rows(ids, ids.count(), MAX_BROADCAST_SETS), "id", "left_semi")
    if not wanted.where(F.col("id").isNull()).isEmpty():
        found = found.unionByName(texts.where(F.col("id").isNull()))
    return found.select("text").mapInPandas(run, "set_id binary, n long, shingles array<long>")


def verify_block(left: pd.DataFrame, right: pd.DataFrame | None, rule: Similarity) -> tuple[list, dict]:
    """Compare all sets of ``left`` with all of ``right``, or with each other:
    ``(edges, links)``, enough edges to connect what is linked, and how many
    links each set has here."""
    whole = left if right is None else pd.concat([left, right], ignore_index=True)
    ids, sizes = whole["set_id"].tolist(), whole["n"].to_numpy(np.int64)
    k, m = len(left), len(whole)
    flat = np.concatenate(whole["shingles"].tolist())
    owner = np.repeat(np.arange(m), [len(s) for s in whole["shingles"]])
    _, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[place] > 1
    owner, column = owner[shared], np.unique(place[shared], return_inverse=True)[1]
    rows, cols = (slice(0, k), slice(0, k)) if right is None else (slice(0, k), slice(k, m))
    common = np.zeros((k, k if right is None else m - k), dtype=np.float32)
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((m, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        common += part[rows] @ part[cols].T
    common = common.astype(np.int64)
    union = sizes[rows][:, None] + sizes[cols][None, :] - common
    linked = rule.den * common >= rule.num * union
    if right is None:
        np.fill_diagonal(linked, False)
        i, j = np.nonzero(np.triu(linked))
        number = linked.sum(axis=1)
        links = {ids[x]: int(number[x]) for x in np.flatnonzero(number)}
    else:
        i, j = np.nonzero(linked)
        j = j + k
        links = {ids[x]: int(v) for x, v in enumerate(linked.sum(axis=1)) if v}
        links |= {ids[k + x]: int(v) for x, v in enumerate(linked.sum(axis=0)) if v}
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[b] = a
            edges.append((ids[x], ids[y]))
    return edges, links


def verify_parts(left: pd.DataFrame, right: pd.DataFrame | None, rule: Similarity) -> Iterator[tuple[list, dict]]:
    """The same, a bounded part against a part at a time."""
    cut = [
        None if side is None else [side.iloc[i : i + COMPARED_AT_ONCE].reset_index(drop=True) for i in range(0, len(side), COMPARED_AT_ONCE)]
        for side in (left, right)
    ]
    for k, part in enumerate(cut[0]):
        if right is None:
            yield verify_block(part, None, rule)
        for other in cut[0][k + 1 :] if right is None else cut[1]:
            yield verify_block(part, other, rule)


def need_of(rule: Similarity) -> Column:
    return F.expr(f"({rule.num}L * n + {rule.den - 1}L) div {rule.den}L")


def _hot_sets(hot: DataFrame, rule: Similarity) -> DataFrame:
    """``(uid, n, least, hot, reach)`` of the sets in ``hot``, entries of
    shingles in many prefixes: how many a set has, and the level at which its
    prefix holds ``level`` others. Where no level does, ``reach`` is beyond all.

    Two similar sets share at least L of their prefixes at any L that both
    need. At its ``reach`` a set can share all but ``level`` of them in hot
    shingles, so it shares ``level`` others with any that reaches as far."""
    held = hot.groupBy("uid").agg(
        F.first("n").alias("n"),
        F.first("level").alias("level"),
        F.min("shingle").alias("least"),
        F.count(F.lit(1)).cast("int").alias("hot"),
        *[F.count_if(F.col("entry_level") <= k).alias(f"hot_{k}") for k in range(1, MAX_LEVEL + 1)],
    )
    fits = [
        F.when((F.lit(k) <= need_of(rule)) & (F.lit(k) - F.col(f"hot_{k}") >= F.col("level")), F.lit(k))
        for k in range(1, MAX_LEVEL + 1)
    ]
    return held.select("uid", "n", "least", "hot", F.coalesce(*fits, F.lit(MAX_LEVEL + 1)).alias("reach"))


def _cold_pairs(cold: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs ``(a, b)`` of uids whose sets share enough of their prefixes, and no family.
    ``cold`` has entries of shingles in few prefixes, up to each set's reach."""
    own = cold.select("shingle", "uid", "n", "level", "reach", "hot", "entry_level", "pos", "family")
    a = own.select("shingle", *[F.col(c).alias(f"{c}_a") for c in own.columns[1:]])
    b = own.select("shingle", *[F.col(c).alias(f"{c}_b") for c in own.columns[1:]])
    reach = F.least("reach_a", "reach_b")
    # What the set of the lower reach asks for, or both.
    level = F.greatest(
        F.when(F.col("reach_a") <= F.col("reach_b"), F.col("level_a")),
        F.when(F.col("reach_b") <= F.col("reach_a"), F.col("level_b")),
    )
    return (
        a.join(b, "shingle")
        .where(F.col("uid_a") < F.col("uid_b"))
        .where(
            (F.col("n_a") * rule.num <= F.col("n_b") * rule.den) & (F.col("n_b") * rule.num <= F.col("n_a") * rule.den)
        )
        .where((F.col("entry_level_a") <= reach) & (F.col("entry_level_b") <= reach))
        .where(F.col("family_a").isNull() | F.col("family_b").isNull() | (F.col("family_a") != F.col("family_b")))
        .groupBy(F.col("uid_a").alias("a"), F.col("uid_b").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.min(level).alias("level"),
            # Behind the last match, and of hot ones, at most so many more are shared.
            F.least(F.first("n_a") - F.max("pos_a"), F.first("n_b") - F.max("pos_b")).alias("behind"),
            F.least(F.first("hot_a"), F.first("hot_b")).alias("hot"),
            (F.first("n_a") + F.first("n_b")).alias("sizes"),
        )
        .where(F.col("matches") >= F.col("level"))
        .where(
            (F.col("matches") + F.col("behind") + F.col("hot") - 1) * (rule.num + rule.den) >= F.col("sizes") * rule.num
        )
        .select("a", "b")
    )


def _verified(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    one = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return pairs.join(one, "a").join(two, "b").where(common * rule.den >= union * rule.num).select("a", "b").distinct()


def _family_links(members: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """Edges ``(a, b, links)`` from within families; rows without ``b`` carry
    the number of links of ``a`` found by one task."""
    # Similar sets are in the same or neighbouring bands.
    width = math.log(rule.den / rule.num) if rule.num < rule.den else 1e-9
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width * (1 + 1e-9)))
    banded = members.withColumn("band", band)
    number = F.count(F.lit(1))
    by_shingles = F.least(F.ceil(number / F.lit(COMPARED_AT_ONCE)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)))
    counts = banded.groupBy("family", "band").agg(
        F.greatest(F.ceil(number / F.lit(BLOCK)), by_shingles).cast("long").alias("blocks")
    )
    near = counts
    for shift, name in ((-1, "blocks_above"), (1, "blocks_below")):
        near = near.join(
            counts.select("family", (F.col("band") + shift).alias("band"), F.col("blocks").alias(name)),
            ["family", "band"],
            "left",
        )
    # Each member goes to every pair of blocks that its own block is part of.
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    task = "struct<lower:long,i:long,j:long,side:int,same:int>"
    within = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda o: F.struct(
            F.col("band").alias("lower"),
            F.least(o, F.col("block")).alias("i"),
            F.greatest(o, F.col("block")).alias("j"),
            F.when(F.col("block") <= o, 0).otherwise(1).alias("side"),
            F.lit(1).alias("same"),
        ).cast(task),
    )

    def beside(number: Column, lower: Column, own_first: bool) -> Column:
        def make(o: Column) -> Column:
            i, j = (F.col("block"), o) if own_first else (o, F.col("block"))
            return F.struct(
                lower.alias("lower"), i.alias("i"), j.alias("j"), F.lit(0 if own_first else 1).alias("side"), F.lit(0).alias("same")
            ).cast(task)

        made = F.transform(F.sequence(F.lit(0).cast("long"), number - 1), make)
        return F.when(number.isNull(), F.array().cast(f"array<{task}>")).otherwise(made)

    tasks = F.concat(
        within,
        beside(F.col("blocks_above"), F.col("band"), True),
        beside(F.col("blocks_below"), F.col("band") - 1, False),
    )
    placed = (
        banded.join(broadcast_if_small(near), ["family", "band"])
        .withColumn("block", block)
        .select("set_id", "n", "family", F.inline(tasks))
        .join(sets.select("set_id", "shingles"), "set_id")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("set_id")
        left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
        alone = bool(frame["same"].iloc[0]) and frame["i"].iloc[0] == frame["j"].iloc[0]
        if not len(left) or (not alone and not len(right)):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        rows = []
        for edges, links in verify_parts(left, None if alone else right, rule):
            rows += [(a, b, 0) for a, b in edges] + [(a, None, n) for a, n in links.items()]
        return pd.DataFrame(rows, columns=["a", "b", "links"])

    return placed.groupBy("family", "lower", "i", "j", "same").applyInPandas(compare, "a binary, b binary, links long")


def similar_documents(
    docs: DataFrame,
    rule: Similarity | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, n_links)`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``n_links`` the
    number of different other sets that the row's own set is linked with.
    Words are runs without ASCII white space, A-Z lower-cased. Texts without
    words, and null ones, have an empty set, are linked with nothing and are
    their own component. Rows with a null id take part; their component is the
    smallest id that is not null, if any. Equal rows are returned each.
    """
    rule = rule or Similarity()
    stage = write_table(document_sets(docs, rule, id_col, text_col), "document_sets")
    members = stage.where(F.col("n").isNotNull()).select("id", "n", "set_id")
    # Bounded by ``frequent``.
    listed = stage.where(F.col("n").isNull()).select(F.inline(F.arrays_zip(F.col("often").alias("shingle"), "met")))
    counted = listed.groupBy("shingle").agg(F.sum("met").alias("met"))
    often = collect_longs(most_frequent(write_table(counted, "frequent_shingles"), "met", frequent), "shingle", "met")

    # One row stands for each class. Its entries are known by its uid, half as
    # long as the id of the set.
    found = write_table(
        prefixes(docs, often, rule, text_col).withColumn("uid", F.monotonically_increasing_id()), "set_prefixes"
    )
    # A set that several tasks gave: all but one of its rows are left out.
    uids = found.select("set_id", "uid")
    several = uids.groupBy("set_id").agg(F.min("uid").alias("kept"), F.count(F.lit(1)).alias("k")).where("k > 1")
    extra = write_table(uids.join(several, "set_id").where("uid <> kept").select("uid"), "extra_rows")
    entry_level = F.greatest(F.lit(1), F.col("pos") + 1 - (F.col("n") - need_of(rule))).cast("int")
    entries = (
        found.join(broadcast_rows(extra, extra.count(), MAX_BROADCAST_SETS), "uid", "left_anti")
        .select("uid", "n", "level", F.posexplode("prefix").alias("pos", "shingle"))
        .select("shingle", "uid", "n", "level", "pos", entry_level.alias("entry_level"))
    )
    met = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    posting = write_table(entries.join(met, "shingle"), "prefix_entries")
    release_shuffles(docs.sparkSession)

    # Families over shingles in many prefixes, of sets that have few others.
    hot = posting.where(F.col("met") > COLD)
    marked = write_table(_hot_sets(hot, rule), "hot_sets")
    least = marked.where(F.col("reach") > MAX_LEVEL)
    chains = connected_components(
        hot.join(least.select("uid", "least"), "uid").select("least", "shingle").distinct(), "least", "shingle"
    )
    families = write_table(
        least.join(chains, least["least"] == chains["node"])
        .select("uid", "n", F.col("component").alias("family"))
        .join(uids, "uid"),
        "set_families",
    )
    marks = marked.select("uid", "hot", "reach").join(families.select("uid", "family"), "uid", "left")
    cold = (
        posting.where(F.col("met") <= COLD)
        .join(broadcast_if_small(marks), "uid", "left")
        .withColumn("reach", F.coalesce("reach", "level"))
        .withColumn("hot", F.coalesce("hot", F.lit(0)))
        .where(F.col("entry_level") <= F.col("reach"))
    )
    met_twice = write_table(_cold_pairs(cold, rule), "candidate_pairs")
    one, two = (uids.select(F.col("uid").alias(c), F.col("set_id").alias(f"set_{c}")) for c in "ab")
    named = met_twice.join(one, "a").join(two, "b").select(F.col("set_a").alias("a"), F.col("set_b").alias("b"))
    pairs = write_table(named, "named_pairs")
    release_shuffles(docs.sparkSession)

    classes = members.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("id").alias("id"))
    compared = (
        pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).union(families.select("set_id")).distinct()
    )
    wanted = write_table(classes.join(compared, "set_id"), "compared_classes")
    sets = write_table(wanted_sets(docs, wanted, rule, id_col, text_col), "compared_sets")
    links = write_table(
        _verified(pairs, sets, rule)
        .withColumn("links", F.lit(None).cast("long"))
        .unionByName(_family_links(families, sets, rule)),
        "set_links",
    )
    release_shuffles(docs.sparkSession)

    edges = links.where(F.col("b").isNotNull()).select("a", "b")
    single = links.where(F.col("links").isNull())  # each a link by itself
    numbers = (
        single.select(F.col("a").alias("set_id"), F.lit(1).cast("long").alias("n_links"))
        .union(single.select("b", F.lit(1).cast("long")))
        .union(links.where(F.col("b").isNull()).select("a", "links"))
        .groupBy("set_id")
        .agg(F.sum("n_links").alias("n_links"))
    )
    linked = connected_components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("group"))
    own = classes.join(linked, "set_id", "left").withColumn("group", F.coalesce("group", "set_id"))
    smallest = own.groupBy("group").agg(F.min("id").alias("component_id"))
    named = own.join(smallest, "group").join(numbers, "set_id", "left")
    named = named.select("set_id", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return members.join(named, "set_id", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, rule: Similarity | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id, and
    of rows with equal ids any one; rows with a null id come after all others.
    Rows without words stay.

    Where ids repeat or are null, the rows get numbers in a table that is
    written first, and are compared under these.
    """
    ids = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if ids.where((F.col("n") > 1) | F.col(id_col).isNull()).isEmpty():
        groups = similar_documents(docs, rule, id_col, text_col)
        dropped = groups.where(F.col("component_id") < F.col(id_col)).select(id_col)
        dropped = write_table(dropped, "dropped_ids")
        return docs.join(broadcast_rows(dropped, dropped.count(), MAX_BROADCAST_SETS), id_col, "left_anti")
    numbered = write_table(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered_rows")
    groups = similar_documents(numbered, rule, _ROW, text_col).select(_ROW, "component_id")
    named = groups.join(numbered.select(_ROW, F.col(id_col).alias("own_id")), _ROW)
    best = F.min(F.struct(F.col("own_id").isNull().alias("last"), "own_id", _ROW))
    kept = named.groupBy("component_id").agg(best.alias("best")).select(F.col(f"best.{_ROW}").alias("kept"))
    rest = write_table(named.join(kept, named[_ROW] == kept["kept"], "left_anti").select(_ROW), "dropped_rows")
    return numbered.join(broadcast_rows(rest, rest.count(), MAX_BROADCAST_SETS), _ROW, "left_anti").drop(_ROW)
