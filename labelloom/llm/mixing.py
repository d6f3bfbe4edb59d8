"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` rows. With weight ``a`` out of
``Q``, block ``j`` (from 0) of a source may be placed in the slots from its
release ``floor(j Q / a)`` up to its deadline ``ceil((j + 1) Q / a)``, exclusive.
Earliest deadline first fills one slot after the other and keeps every source
within less than one block of its share at every slot.

The schedule repeats after ``Q`` slots, when every source has exactly its
share, so only one cycle has to be scheduled. From it, a row's slot and its
place in the whole stream follow from its rank within its source alone: no row
of the stream is sorted or windowed beyond a small hash bucket of one source.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.operators.sizing import broadcast_if_small

BLOCK_ROWS = 16
ROWS_PER_BUCKET = 2_000
MAX_BUCKET_BITS = 20


def pfair_cycle(weights: Sequence[int]) -> list[int]:
    """The source of each slot of one cycle of ``sum(weights)`` slots: among
    the released blocks the one with the earliest deadline, then the earlier
    source."""
    cycle = sum(weights)
    waiting = [(0, i, 0) for i, a in enumerate(weights) if a > 0]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    order = []
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            _, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * cycle // weights[source]), source, block))
        _, source, block = heapq.heappop(ready)
        order.append(source)
        if block + 1 < weights[source]:
            heapq.heappush(waiting, ((block + 1) * cycle // weights[source], source, block + 1))
    return order


def _longs(values: Sequence[int]) -> Column:
    """An array of longs, as a text that the optimiser turns into one constant.
    A literal for each value would be copied by every step of planning."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def mix(
    df: DataFrame,
    weights: Mapping[str, int],
    default_weight: int = 1,
    block_rows: int = BLOCK_ROWS,
    seed: int = 42,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """``df`` with ``mix_source``, ``block``, ``release``, ``deadline``, ``slot``,
    ``position`` and ``on_target``.

    ``weights`` are whole numbers; all sources not named, null among them,
    share ``default_weight`` as one source (``mix_source`` null), which must be
    positive. A source is taken in the order of a hash of seed and id. Every
    row gets a place: when a source ends, its slots stay empty and the others
    go on in proportion; ``position`` counts rows without gaps, and
    ``on_target`` tells whether the slot comes before the first empty one.
    Rows equal in id and source are in no particular order. Columns of ``df``
    with one of the new names are replaced.
    """
    names = [*weights, None]
    shares = [*weights.values(), default_weight]
    if any(not isinstance(a, int) or a < 1 for a in shares):
        raise ValueError("weights must be positive whole numbers")
    cycle, order = sum(shares), pfair_cycle(shares)
    source = F.lit(len(weights))
    for i, name in enumerate(weights):
        source = F.when(F.col(source_col) == name, i).otherwise(source)
    made = ["mix_source", "block", "release", "deadline", "slot", "position", "on_target"]
    df = df.drop(*made)

    # One row per source.
    counts = {r["s"]: r["n"] for r in df.groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = [counts.get(i, 0) for i in range(len(shares))]
    bits = min(MAX_BUCKET_BITS, max(0, (max(totals) // ROWS_PER_BUCKET).bit_length()))

    own = df.columns
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    first_bits = F.conv(F.substring("mix_key", 1, 5), 16, 10).cast("long")
    keyed = df.withColumns({"mix_s": source, "mix_key": key}).withColumn(
        "mix_bucket", F.shiftright(first_bits, 20 - bits)
    )
    # At most 2^bits rows per source.
    earlier = Window.partitionBy("mix_s").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("mix_s", "mix_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("mix_s", "mix_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_before"))
    )
    bucket = Window.partitionBy("mix_s", "mix_bucket").orderBy("mix_key", id_col)
    ranked = (
        keyed.withColumn("mix_place", F.row_number().over(bucket))
        .join(broadcast_if_small(offsets), ["mix_s", "mix_bucket"])
        .withColumn("mix_rank", F.col("mix_before") + F.col("mix_place") - 1)
        .withColumn("block", F.expr(f"mix_rank div {block_rows}L"))
    )

    slots = [[t for t, s in enumerate(order) if s == i] for i in range(len(shares))]
    begins = [sum(shares[:i]) for i in range(len(shares))]  # of each source's slots, laid end to end
    # Of each source, the number of its slots before each slot.
    before = [[bisect_left(own_slots, t) for t in range(cycle)] for own_slots in slots]
    share = F.get(_longs(shares), F.col("mix_s"))
    ends = []  # the first empty slot of each source
    for i, (rows, a) in enumerate(zip(totals, shares, strict=True)):
        blocks = -(-rows // block_rows)
        ends.append(blocks // a * cycle + slots[i][blocks % a])
    turn = F.get(_longs(begins), F.col("mix_s")) + F.col("block") % F.col("mix_share")
    placed = (
        ranked.withColumn("mix_share", share)
        .withColumn("mix_turn", F.get(_longs([t for own_slots in slots for t in own_slots]), turn))
        .withColumn("slot", F.expr("block div mix_share") * cycle + F.col("mix_turn"))
    )
    earlier_rows = F.lit(0).cast("long")
    for i, (rows, a) in enumerate(zip(totals, shares, strict=True)):
        blocks = F.expr(f"block div mix_share") * a + F.get(_longs(before[i]), F.col("mix_turn"))
        earlier_rows = earlier_rows + F.least(F.lit(rows).cast("long"), blocks * block_rows)
    names_col = F.get(F.array(*[F.lit(n) for n in names]), F.col("mix_s"))
    return placed.select(
        *own,
        names_col.alias("mix_source"),
        "block",
        F.expr(f"block * {cycle}L div mix_share").alias("release"),
        F.expr(f"((block + 1) * {cycle}L + mix_share - 1) div mix_share").alias("deadline"),
        "slot",
        (earlier_rows + F.col("mix_rank") % block_rows).alias("position"),
        (F.col("slot") < min(ends)).alias("on_target"),
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, int], **options: int) -> DataFrame:
    """The rows and columns of ``docs``, stored in mixed order when written."""
    mixed = mix(docs, weights, **options)
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(docs.columns)
