"""Product quantisation of vectors in whole numbers, by Orchard search.

A vector is cut into parts, and every part is coded by the nearest entry of its
codebook. The search keeps, for every entry, all others sorted by their distance
from it. It begins at some entry, goes along its list and, at the first entry
that is nearer to the vector, jumps to that entry's list. Entries looked at are
marked and not looked at again. It stops where the list is beyond twice the
distance of the vector from the entry: by the triangle inequality nothing
behind can be nearer, nor as near. The result is the nearest entry itself.

Rows go through the search a block at a time, each with its own place in its
own list. Codebooks are of fixed size and sent to all tasks; a round returns
sums by part and entry, combined by Spark, and no row leaves its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
ROWS_AT_ONCE = 2_048
AHEAD = 8  # entries of a list looked at in one step


# --- search


@dataclass(frozen=True)
class Lists:
    """``order[e]``: all entries by their distance from entry e, ties by index;
    ``gaps[e]``: these distances, squared."""

    entries: np.ndarray  # (entries, width)
    order: np.ndarray
    gaps: np.ndarray


def sorted_lists(entries: np.ndarray) -> Lists:
    """The neighbour lists of the entries of one codebook."""
    apart = np.stack([((entries - e) ** 2).sum(axis=1) for e in entries])
    order = np.argsort(apart, axis=1, kind="stable")
    return Lists(entries, order, np.take_along_axis(apart, order, axis=1))


def orchard_search(vectors: np.ndarray, lists: Lists, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each vector, ties to the smaller index, and its
    squared distance. ``start``: where each search begins."""
    rows, size = len(vectors), len(lists.entries)
    best = np.zeros(rows, dtype=np.int64) if start is None else start.astype(np.int64)
    distance = ((vectors - lists.entries[best]) ** 2).sum(axis=1)
    marked = np.zeros((rows, size), dtype=bool)
    marked[np.arange(rows), best] = True
    place = np.zeros(rows, dtype=np.int64)
    active = np.arange(rows)
    step = np.arange(AHEAD)
    while len(active):
        at = place[active][:, None] + step
        inside = at < size
        at = np.minimum(at, size - 1)
        own = best[active][:, None]
        ahead = lists.order[own, at]
        within = inside & (lists.gaps[own, at] <= 4 * distance[active][:, None])
        look = within & ~marked[active[:, None], ahead]
        r, c = np.nonzero(look)
        seen = ahead[r, c]
        marked[active[r], seen] = True
        found = ((vectors[active[r]] - lists.entries[seen]) ** 2).sum(axis=1)
        # The best of what was looked at: nearest first, then the smaller index.
        by_row = np.lexsort((seen, found, r))
        first = by_row[np.unique(r[by_row], return_index=True)[1]] if len(r) else by_row
        who, entry, near = active[r[first]], seen[first], found[first]
        better = (near < distance[who]) | ((near == distance[who]) & (entry < best[who]))
        jumped = np.zeros(rows, dtype=bool)
        jumped[who[better]] = True
        best[who[better]], distance[who[better]] = entry[better], near[better]
        # A jump begins the new list; the others go on until theirs is beyond reach.
        place[active] += AHEAD
        place[jumped] = 0
        goes_on = jumped[active] | within[:, -1]
        active = active[goes_on]
    return best, distance


# --- tables


def whole_numbers(vector: Column, bound: int) -> Column:
    """``floor(1024 x)`` of every component, held within ``bound``."""
    limit = float(bound)
    return F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * SCALE))).cast("int"),
    )


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> tuple[DataFrame, int]:
    """``(id, label, vector)`` of the rows that take part, and the dimension."""
    vector = F.col(vector_col)
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = df.where(vector.isNotNull() & finite & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    # One row per length.
    sizes = good.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    dimension = most["d"] if most else 0
    # Squared distances must fit 62 bits.
    bound = 1 << min(30, (62 - max(1, dimension).bit_length()) // 2 - 1)
    rows = good.where(F.size(vector) == dimension).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole_numbers(vector, bound).alias("vector")
    )
    return write_table(rows, "code_vectors"), dimension


def _matrix(column: pd.Series, parts: int) -> np.ndarray:
    """``(parts, rows, width)``. In 32 bits where squared distances fit."""
    whole = np.stack(column.to_list()).astype(np.int64)
    width = whole.shape[1] // parts
    return whole.reshape(len(whole), parts, width).transpose(1, 0, 2)


def _narrow(largest: int, width: int) -> type:
    return np.int32 if width * (2 * largest) ** 2 * 4 < 1 << 31 else np.int64


class _Coder:
    """Codes blocks of vectors; lists are sorted once in a task."""

    def __init__(self, books: np.ndarray) -> None:
        self.books = books
        self.lists: dict[type, list[Lists]] = {}

    def code(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(parts, rows)`` entries and squared distances."""
        largest = int(max(np.abs(block).max(initial=0), np.abs(self.books).max(initial=0)))
        kind = _narrow(largest, block.shape[2])
        if kind not in self.lists:
            self.lists[kind] = [sorted_lists(b.astype(kind)) for b in self.books]
        pairs = [orchard_search(v.astype(kind), own) for v, own in zip(block, self.lists[kind], strict=True)]
        return np.stack([p[0] for p in pairs]), np.stack([p[1].astype(np.int64) for p in pairs])


def _blocks(frames: Iterator[pd.DataFrame], parts: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for start in range(0, len(frame), ROWS_AT_ONCE):
            block = frame.iloc[start : start + ROWS_AT_ONCE]
            yield block, _matrix(block["vector"], parts)


def next_codebooks(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of the mean of its parts; entries that
    are nearest to none stay."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _Coder(shared.value)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for _, block in _blocks(frames, parts):
            codes, _ = coder.code(block)
            for p in range(parts):
                np.add.at(sums[p], codes[p], block[p])
                counts[p] += np.bincount(codes[p], minlength=entries)
        part, entry = np.nonzero(counts)
        if len(part):
            yield pd.DataFrame(
                {"part": part, "entry": entry, "n": counts[part, entry], "sums": list(sums[part, entry])}
            )

    found = rows.select("vector").mapInPandas(run, "part int, entry int, n long, sums array<long>")
    totals = found.select("part", "entry", "n", F.posexplode("sums").alias("k", "total"))
    totals = totals.groupBy("part", "entry", "k").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    new = books.copy()
    # As many numbers as the codebooks hold.
    means = totals.groupBy("part", "entry").agg(
        F.array_sort(F.collect_list(F.struct("k", F.expr("total div n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END").alias("x")))).alias("c")
    )
    for r in means.collect():
        new[r["part"], r["entry"]] = [c["x"] for c in r["c"]]
    return new


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """``(parts, entries, width)``: begins with the vectors of the smallest ids,
    null ids last, equal ids by vector."""
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").toPandas()
    books = np.ascontiguousarray(_matrix(first["vector"], parts))
    for _ in range(rounds):
        books = next_codebooks(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, code, error)`` for every row."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _Coder(shared.value)
        for frame, block in _blocks(frames, len(shared.value)):
            codes, distances = coder.code(block)
            yield pd.DataFrame(
                {
                    "key": frame["key"].to_numpy(),
                    "code": ["".join(f"{c:02x}" for c in row) for row in codes.T.tolist()],
                    "error": distances.sum(axis=0),
                }
            )

    # Ids and labels go as text: pandas has no whole numbers beside nulls.
    key = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label")))
    coded = rows.select(key.alias("key"), "vector").mapInPandas(run, "key string, code string, error long")
    own = F.from_json("key", "id string, label string")
    return coded.select(own["id"].cast(id_type).alias("id"), own["label"].cast(label_type).alias("label"), "code", "error")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(id_col, code, error, label_error, codebooks_sha256)`` for every vector
    that takes part.

    Null and empty vectors, those with null or non-finite components, and those
    whose length is not a multiple of ``parts`` take no part, nor do those of
    another length than most have (the longer, if two are as frequent).
    Components beyond what squared distances can hold in a long (2**26 in whole
    numbers, of 64 components) count as that bound. Rows with a null id come after all others in
    choosing the first entries; rows with equal ids are returned each.
    """
    rows, dimension = kept_vectors(df, id_col, vector_col, label_col, parts)
    if not dimension:
        books = np.zeros((parts, 0, 0), dtype=np.int64)
        coded = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    else:
        books = fit_codebooks(rows, parts, entries, rounds)
        coded = write_table(encode(rows, books), "codes")
    key = F.coalesce(F.concat(F.lit("l"), F.col("label").cast("string")), F.lit("n"))
    coded = coded.withColumn("key", key)
    # Combined before the shuffle: a row per label and task.
    errors = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    return coded.join(broadcast_if_small(errors), "key").select(
        F.col("id").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"),
    )
