"""Tokenising, truncating and padding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.functions.arrays import pad, truncate
from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

# Words (letters, marks, digits, underscore) or single punctuation and symbols.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+|[\p{P}\p{S}]"

TOKENS_PER_PART = 4_000_000  # of a task that pads
BYTES_AT_ONCE = 500_000  # for a tokenizer

Tokenizer = Callable[[list[str]], list[list[int]]]


def text_slices(texts: pa.Array, size: int = BYTES_AT_ONCE) -> Iterator[list[str | None]]:
    """The texts in order, about ``size`` bytes at a time; none is cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(before + size, side="right")))
        yield texts[start:stop].to_pylist()
        start = stop


def tokenize(
    df: DataFrame,
    max_length: int | None = 256,
    text_col: str = "text",
    label_col: str = "label",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """``text`` and ``label`` plus ``input_ids``, ``attention_mask`` and
    ``labels``; every other column except ``row_id`` and ``split`` is dropped.

    Without a ``tokenizer`` the tokens are strings cut out by a built-in
    pattern in the JVM. A ``tokenizer`` maps a batch of texts to lists of ids;
    it gets some texts of an Arrow batch at a time, ``BYTES_AT_ONCE`` bytes
    unless a single one is longer, and their ids leave Python's lists at once.
    """
    if tokenizer is None:
        tokens = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), F.lit(0))
    else:

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            kind = pa.list_(pa.int32())
            parts = [pa.array(list(tokenizer(some)), kind, from_pandas=True) for some in text_slices(texts)]
            return pa.concat_arrays([pa.array([], kind), *parts])

        tokens = encode(F.col(text_col))
    kept = [c for c in ("row_id", "split") if c in df.columns]
    out = df.select(
        *kept,
        F.col(text_col).alias("text"),
        F.col(label_col).alias("label"),
        tokens.alias("input_ids"),
    )
    if max_length is not None:
        out = out.withColumn("input_ids", truncate("input_ids", max_length))
    return out.withColumns(
        {
            "attention_mask": F.array_repeat(F.lit(1), F.size("input_ids")),
            "labels": F.col("label"),
        }
    )


def row_positions(df: DataFrame, group_col: str, id_col: str = "row_id") -> DataFrame:
    """``(group, id, position)``: the place from 0 of each row within its group,
    in id order.

    Meant for narrow rows. They are range-partitioned and sorted, which balances
    partitions for any distribution of ids, and materialised, so that places
    within partitions are fixed. A position is the place plus the number of the
    group's rows in earlier partitions.
    """
    ordered = write_table(
        df.select(group_col, id_col)
        .repartitionByRange(group_col, id_col)
        .sortWithinPartitions(group_col, id_col)
        .withColumn("place", F.monotonically_increasing_id()),
        "ordered",
    )
    # The id function numbers the rows of partition p from p * 2^33.
    part = F.shiftright("place", 33).alias("part")
    runs = ordered.groupBy(group_col, part).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy(group_col).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition and group.
    shift = (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    runs = broadcast_if_small(runs.select(F.col(group_col).alias("run_group"), "part", shift))
    same = F.col(group_col).eqNullSafe(F.col("run_group")) & (F.shiftright("place", 33) == F.col("part"))
    placed = ordered.join(runs, same)
    return placed.select(group_col, id_col, (F.col("place") + F.col("shift")).alias("position"))


def range_number(value: Column, starts: Sequence[int], step: int = 64) -> Column:
    """How many of the sorted ``starts`` are not above ``value``, found in two
    steps among literals."""
    if not starts:
        return F.lit(0)
    blocks = [list(starts[i : i + step]) for i in range(0, len(starts), step)]

    def literal(values: Sequence[int]) -> str:
        return "array(" + ",".join(f"{v}L" for v in values) + ")"

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda s: s <= value))

    block = F.greatest(reached(F.expr(literal([b[0] for b in blocks]))) - 1, F.lit(0))
    own = F.get(F.expr("array(" + ",".join(map(literal, blocks)) + ")"), block)
    return block * step + reached(own)


def pad_batches(
    df: DataFrame,
    batch_size: int,
    pad_value: int | str,
    side: str = "right",
    id_col: str = "row_id",
    tokens_col: str = "input_ids",
    group_col: str | None = None,
    tokens_per_part: int = TOKENS_PER_PART,
) -> DataFrame:
    """Pad the tokens of each batch to its longest member and mask the padding.

    Adds ``batch_id``; batches are consecutive rows in the order of the unique
    whole ``id_col``, in each group of ``group_col`` by themselves, whose names
    are few. A null list counts as an empty one.

    The token lists are materialised once, as cutting them costs more than
    reading them back, so ``df`` should hold no other wide column. Stretches of
    whole batches are laid out on the ids alone; their first ids are known to
    every task, so the lists go to their stretch in one shuffle, where places
    and lengths follow from the sort, without a join.
    """
    group = group_col or "pad_group"
    rows = df if group_col else df.withColumn(group, F.lit(0))
    empty = F.array().cast(df.schema[tokens_col].dataType)
    tokens = rows.drop("attention_mask").withColumn(tokens_col, F.coalesce(tokens_col, empty))
    stored = write_table(tokens.withColumn("size", F.size(tokens_col)), "tokens")
    # A row a group.
    totals = stored.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("t")).orderBy(group).collect()
    per_token = max(1.0, sum(r["t"] for r in totals) / max(1, sum(r["n"] for r in totals)))
    stretch = max(1, int(tokens_per_part / per_token / batch_size)) * batch_size
    starts = (
        row_positions(stored, group, id_col).where(F.col("position") % stretch == 0).orderBy(group, id_col).collect()
    )  # a row a stretch
    number, first, parts = F.lit(0), F.lit(0), 0
    for r in totals:
        own = [s[id_col] for s in starts if s[group] == r[group]]
        here = F.col(group).eqNullSafe(F.lit(r[group]))
        number = F.when(here, F.lit(parts) + range_number(F.col(id_col), own[1:])).otherwise(number)
        first = F.when(here, F.lit(parts)).otherwise(first)
        parts += len(own)

    laid = stored.withColumn("stretch", number).withColumn("first", first).repartition(max(1, parts), "stretch")
    in_stretch = Window.partitionBy("stretch")
    position = (F.col("stretch") - F.col("first")).cast("long") * stretch + F.row_number().over(in_stretch.orderBy(id_col)) - 1
    placed = laid.withColumn("batch_id", F.floor(position / batch_size).cast("long"))
    length = F.max("size").over(Window.partitionBy("stretch", "batch_id"))
    ones = F.array_repeat(F.lit(1), F.col("size"))
    padded = placed.withColumn("batch_length", length).withColumns(
        {
            "attention_mask": pad(ones, F.col("batch_length"), F.lit(0), side),
            tokens_col: pad(tokens_col, F.col("batch_length"), F.lit(pad_value), side),
        }
    )
    return padded.drop("batch_length", "size", "stretch", "first", *([] if group_col else [group]))
