"""Approximate nearest neighbours: a graph by NN-descent, greedy search on it.

The graph begins with neighbours found within random cells and is improved
round by round: what two neighbours of a node, or nodes that have it as a
neighbour, say about each other is joined, scored and offered to both. A search
walks the graph from a node that is known to be near, always from the best
nodes not yet visited, until its list of best nodes holds no such node. Rounds
of both are Spark joins over all nodes or queries at once.

Vectors travel in the precision in which they are given, and all scores are
taken in double precision: among many slightly different vectors, rounded ones
would leave it to chance which are found. Equal vectors are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import unit_hash
from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

NEIGHBOURS = 32
REVERSE = 24  # expected number of nodes met because they have a node as neighbour
OFFERS = 12  # by one meeting to one node
TREES = 6
CELL = 384
ROUNDS = 4
BEAM = 256
STEP = 64  # nodes a search visits in one round
MAX_STEPS = 40
RESCORED = 60
LOWEST = float(np.finfo(np.float64).min)

_NODE = "struct<id:long,code:binary,width:int,worst:double>"


def usable(vector: Column, dimension: int) -> Column:
    """Of the right length, without null or non-finite components, not zero."""
    return (
        (F.size(vector) == dimension)
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _decode(codes: list[bytes], widths) -> np.ndarray:
    flat = np.frombuffer(b"".join(codes), dtype=f"f{int(widths[0])}").reshape(len(codes), -1)
    return flat.astype(np.float64)


def encoded(nodes: DataFrame) -> DataFrame:
    """``(id, code, width)`` of ``(id, vector)``: the bytes of a vector, and how
    many a component has."""
    width = 4 if nodes.schema["vector"].dataType.elementType.simpleString() == "float" else 8

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                codes = np.stack(frame["vector"].tolist()).astype(f"f{width}")
                yield pd.DataFrame({"id": frame["id"], "code": [c.tobytes() for c in codes], "width": width})

    return nodes.mapInPandas(run, "id long, code binary, width int")


def _cells(codes: DataFrame, nodes: int, dimension: int, trees: int, cell: int, seed: int) -> DataFrame:
    """``(tree, key, id, code, width)``: the side of some random planes on which
    each node lies."""
    bits = max(0, math.ceil(math.log2(max(1, nodes / cell))))
    planes = np.random.default_rng(seed).normal(size=(trees, dimension, max(1, bits))).astype(np.float64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = _decode(frame["code"].tolist(), frame["width"].to_numpy())
                for tree in range(trees):
                    side = ((x @ planes[tree]) > 0).astype(np.int64)
                    key = side @ (1 << np.arange(side.shape[1])) if bits else np.zeros(len(x), np.int64)
                    yield frame.assign(tree=tree, key=key)[["tree", "key", "id", "code", "width"]]

    return codes.mapInPandas(run, "tree int, key long, id long, code binary, width int")


_LISTS = "id long, nbrs array<long>, scores array<double>"


def _first_lists(codes: DataFrame, nodes: int, dimension: int, k: int, trees: int, cell: int, seed: int) -> DataFrame:
    """Each node's best ``k`` within each of its cells; large cells are dealt
    out further by a hash."""
    placed = _cells(codes, nodes, dimension, trees, cell, seed)
    counts = placed.groupBy("tree", "key").agg(F.ceil(F.count(F.lit(1)) / F.lit(2.0 * cell)).cast("long").alias("parts"))
    split = placed.join(broadcast_if_small(counts), ["tree", "key"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "tree"), "parts")
    )
    grouped = split.groupBy("tree", "key", "part").agg(F.collect_list(F.struct("id", "code", "width")).alias("members"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for members in frame["members"]:
                ids = np.array([m["id"] for m in members], dtype=np.int64)
                n = min(k, len(ids) - 1)
                if n < 1:
                    continue
                x = _decode([m["code"] for m in members], [m["width"] for m in members])
                scores = x @ x.T
                np.fill_diagonal(scores, -np.inf)
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                yield pd.DataFrame(
                    {"id": ids, "nbrs": list(ids[best]), "scores": list(np.take_along_axis(scores, best, axis=1))}
                )

    return grouped.select("members").mapInPandas(run, _LISTS)


def _best(lists: DataFrame, k: int) -> DataFrame:
    """The best ``k`` different neighbours of each node over all its lists."""
    grouped = lists.groupBy("id").agg(F.collect_list(F.struct("nbrs", "scores")).alias("lists"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for node, parts in zip(frame["id"], frame["lists"], strict=True):
                nbrs = np.concatenate([np.asarray(p["nbrs"], dtype=np.int64) for p in parts])
                scores = np.concatenate([np.asarray(p["scores"], dtype=np.float64) for p in parts])
                nbrs, first = np.unique(nbrs, return_index=True)
                scores = scores[first]
                best = np.argsort(-scores, kind="stable")[:k]
                rows.append((node, nbrs[best], scores[best]))
            yield pd.DataFrame(rows, columns=["id", "nbrs", "scores"])

    return grouped.mapInPandas(run, _LISTS)


def _offers(codes: DataFrame, graph: DataFrame, k: int, reverse: int, offers: int, turn: int) -> DataFrame:
    """What the nodes around each node offer each other: lists to be merged
    with the graph, of scores better than a node's worst."""
    edges = graph.select("id", F.explode("nbrs").alias("nbr"))
    popular = edges.groupBy("nbr").agg(F.count(F.lit(1)).alias("n"))
    back = edges.join(popular, "nbr").where(unit_hash("id", "nbr", seed=turn) < reverse / F.col("n"))
    around = edges.select(F.col("id").alias("center"), F.col("nbr").alias("id")).union(back.select("nbr", "id"))
    worst = F.when(F.size("scores") >= k, F.element_at("scores", -1)).otherwise(F.lit(LOWEST)).cast("double")
    nodes = codes.join(graph.select("id", worst.alias("worst")), "id", "left").fillna({"worst": LOWEST})
    met = (
        around.join(nodes, "id")
        .groupBy("center")
        .agg(F.collect_list(F.struct("id", "code", "width", "worst").cast(_NODE)).alias("members"))
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            to, nbrs, values = [], [], []
            for members in frame["members"]:
                members = list({m["id"]: m for m in members}.values())  # some are met both ways
                n = min(offers, len(members) - 1)
                if n < 1:
                    continue
                ids = np.array([m["id"] for m in members], dtype=np.int64)
                x = _decode([m["code"] for m in members], [m["width"] for m in members])
                limit = np.array([m["worst"] for m in members], dtype=np.float64)
                scores = x @ x.T
                np.fill_diagonal(scores, -np.inf)
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                found = np.take_along_axis(scores, best, axis=1)
                good = found > limit[:, None]
                for i in np.flatnonzero(good.any(axis=1)):
                    to.append(ids[i])
                    nbrs.append(ids[best[i][good[i]]])
                    values.append(found[i][good[i]])
            yield pd.DataFrame({"id": to, "nbrs": nbrs, "scores": values})

    return met.select("members").mapInPandas(run, _LISTS)


def build_graph(
    codes: DataFrame,
    nodes: int,
    dimension: int,
    k: int = NEIGHBOURS,
    reverse: int = REVERSE,
    offers: int = OFFERS,
    trees: int = TREES,
    cell: int = CELL,
    rounds: int = ROUNDS,
    seed: int = 42,
) -> DataFrame:
    """``(id, nbrs, scores)``: each node's ``k`` nearest found, nearest first."""
    graph = write_table(_best(_first_lists(codes, nodes, dimension, k, trees, cell, seed), k), "graph")
    if nodes <= cell:
        return graph  # one cell has compared all with all
    for turn in range(rounds):
        graph = write_table(_best(graph.unionByName(_offers(codes, graph, k, reverse, offers, turn)), k), "graph")
    return graph


_BEAM = "query long, code binary, width int, ids array<long>, scores array<double>, visited array<boolean>"


def search(
    codes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM, step: int = STEP, max_steps: int = MAX_STEPS
) -> DataFrame:
    """``(query, ids, scores)``: the ``beam`` best nodes found for each node in
    ``queries (query)``, itself left out, by greedy search from its neighbours.

    A round visits the ``step`` best unvisited nodes of every list; their
    neighbours come with their codes, are scored where they lie, and those
    better than the list's worst are merged into it.
    """
    far = codes.select(F.col("id").alias("nbr"), "code", "width")
    beside = write_table(
        graph.select("id", F.explode("nbrs").alias("nbr"))
        .join(far, "nbr")
        .groupBy("id")
        .agg(F.collect_list(F.struct("nbr", "code", "width")).alias("around")),
        "neighbour_codes",
    )
    own = queries.join(codes, queries["query"] == codes["id"]).join(graph, "id")
    lists = own.select(
        "query", "code", "width", F.col("nbrs").alias("ids"), "scores", F.transform("nbrs", lambda _: F.lit(False)).alias("visited")
    )
    state = write_table(lists, "search_lists")

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for query, code, width, worst, around in frame.itertuples(index=False):
                ids = np.array([a["nbr"] for a in around], dtype=np.int64)
                scores = _decode([a["code"] for a in around], [a["width"] for a in around]) @ _decode([code], [width])[0]
                good = (scores > worst) & (ids != query)
                if good.any():
                    out.append((query, ids[good], scores[good]))
            yield pd.DataFrame(out, columns=["query", "nbrs", "scores"])

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                ids, scores = np.asarray(r.ids, dtype=np.int64), np.asarray(r.scores, dtype=np.float64)
                visited = np.asarray(r.visited, dtype=bool)
                # Those visited in this round are the first unvisited ones.
                visited[np.flatnonzero(~visited)[:step]] = True
                found = r.found if r.found is not None else []
                all_ids = np.concatenate([ids, *[np.asarray(f["nbrs"], dtype=np.int64) for f in found]])
                all_scores = np.concatenate([scores, *[np.asarray(f["scores"], dtype=np.float64) for f in found]])
                _, first = np.unique(all_ids, return_index=True)
                best = first[np.argsort(-all_scores[first], kind="stable")][:beam]
                known = np.concatenate([visited, np.zeros(len(all_ids) - len(ids), dtype=bool)])
                rows.append((r.query, r.code, r.width, all_ids[best], all_scores[best], known[best]))
            yield pd.DataFrame(rows, columns=["query", "code", "width", "ids", "scores", "visited"])

    pairs = F.zip_with("ids", "visited", lambda i, v: F.when(~v, i))
    worst = F.when(F.size("ids") >= beam, F.element_at("scores", -1)).otherwise(F.lit(LOWEST)).cast("double")
    for _ in range(max_steps):
        front = state.select(
            "query", "code", "width", worst.alias("worst"), F.explode(F.slice(F.array_compact(pairs), 1, step)).alias("id")
        )
        if front.isEmpty():
            break
        seen = beside.join(broadcast_if_small(front), "id").select("query", front["code"], front["width"], "worst", "around")
        found = seen.mapInPandas(look, "query long, nbrs array<long>, scores array<double>")
        gathered = found.groupBy("query").agg(F.collect_list(F.struct("nbrs", "scores")).alias("found"))
        state = write_table(state.join(gathered, "query", "left").mapInPandas(merge, _BEAM), "search_lists")
    return state.select("query", "ids", "scores")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    **options: int,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row with ``is_query`` the
    ``k`` rows with the largest inner product found, itself left out.

    ``score`` is exact, in double precision; ties go to the smaller id. Null
    ids, and vectors that are null, zero, of another length than most, or hold
    null or non-finite components, take no part. Of a vector that many rows
    share, the rows with the ``k + 1`` smallest ids can be answers; every one
    of them can be a query. Ids are taken to be unique.
    """
    sized = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    usual = sized.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = usual["d"] if usual else 0
    rows = write_table(
        sized.where(usable(F.col(vector_col), dimension)).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asked")
        ),
        "vectors",
    )
    # Limited before the shuffle, so a vector that fills the table is no hot key.
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    copies = write_table(
        rows.select("id", "vector").withColumn("copy", copy).where(F.col("copy") <= k + 1), "vector_copies"
    )
    nodes = copies.where("copy = 1").select("id", "vector")
    asked = (
        rows.where("asked")
        .select(F.col("id").alias("query_id"), "vector")
        .join(nodes.select(F.col("id").alias("query"), "vector"), "vector")
    )
    asked = write_table(asked.select("query_id", "query", "vector"), "queries")
    codes = write_table(encoded(nodes), "codes")
    graph_options = {o: v for o, v in options.items() if o not in ("beam", "step", "max_steps")}
    graph = build_graph(codes, codes.count(), dimension, **graph_options)
    searching = {o: v for o, v in options.items() if o in ("beam", "step", "max_steps")}
    lists = search(codes, graph, asked.select("query").distinct(), **searching)

    # The best nodes of each list with their copies, and the copies of the query itself.
    best = lists.select("query", F.explode(F.slice("ids", 1, RESCORED)).alias("node"))
    best = best.union(asked.select("query", "query").distinct())
    first = nodes.select(F.col("id").alias("node"), F.col("vector").alias("node_vector"))
    target = asked.select("query", F.col("vector").alias("query_vector")).dropDuplicates(["query"])
    scored = (
        best.join(first, "node")
        .join(target, "query")
        .select("query", "node_vector", inner_product(F.col("query_vector"), F.col("node_vector")).alias("score"))
    )
    nearest = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    kept = (
        scored.join(copies.select("id", F.col("vector").alias("node_vector")), "node_vector")
        .select("query", "id", "score")
        .withColumn("near", nearest)
        .where(F.col("near") <= k + 1)
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        asked.select("query_id", "query")
        .join(kept, "query")
        .where(F.col("id") != F.col("query_id"))
        .withColumn("rank", rank.cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
