"""Near duplicates by SimHash fingerprints and the generalised pigeonhole rule.

The 64 bits are grouped into parts so that correlated bits stand together. If
the thresholds of the parts sum up to RADIUS - parts + 1, two fingerprints
within RADIUS bits are within the threshold of some part; a threshold of -1
leaves a part out. Each fingerprint gets the thresholds that cost it least, by
dynamic programming over the estimated numbers of candidates: few where its
part is frequent, more where it is rare. It probes the parts for all values
within their thresholds, and what it meets is verified.

1. Texts with one fingerprint are one class; classes stand for their members.
2. Bits set together are counted, and the parts follow. Values of half a part
   are counted, and the estimates follow from these tables of fixed size.
3. Part values are joined with probes, and pairs verified.
4. Values in very many fingerprints would make all pairs of a group. Their
   fingerprints, and those that would probe them, are linked through common
   points instead: two fingerprints differ in at most two bits exactly if some
   value is within one bit of both. The fingerprints around a value form a
   star, whose size is at most 65.
5. Components over both kinds of links.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.graph import connected_components
from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

BITS = 64
RADIUS = 2
WORDS = 3
SEED = 42
CROWDED = 128  # fingerprints with one part value, above which no pairs are made
PROBE_COST = 1.0  # of a probe, in candidates
MOST_PARTS, LEAST_PARTS = 4, 2
SHINGLES_AT_ONCE = 1 << 16
_BLOCK = 4_096


# --- fingerprints


def shingle_hashes(text: str | None, words: int = WORDS) -> Iterator[np.ndarray]:
    """XXH64 of the runs of ``words`` words, repeats included, some at a time.
    A text with fewer words is one run; one without words has none."""
    found = text.encode().lower().split() if text else []
    if not found:
        return
    joined = b" ".join(found)
    starts = [0]
    for word in found:
        starts.append(starts[-1] + len(word) + 1)
    runs = max(1, len(found) - words + 1)
    size = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    for first in range(0, runs, SHINGLES_AT_ONCE):
        last = min(runs, first + SHINGLES_AT_ONCE)
        own = [digest(joined[starts[i] : starts[i + size] - 1], SEED) for i in range(first, last)]
        yield np.array(own, dtype=np.uint64)


def bit_matrix(values: np.ndarray) -> np.ndarray:
    """``(values, 64)`` of 0 and 1; column b is the bit worth 2**b."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def fingerprint(text: str | None) -> int:
    """A bit is 1 if more than half of the hashes have it; 0 without words."""
    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingle_hashes(text):
        total += len(hashes)
        ones += bit_matrix(hashes).sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > total))


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, code)`` for every row; the fingerprint as a signed long."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            codes = np.array([fingerprint(t) for t in part], dtype=np.uint64)
            yield pd.Series(codes.view(np.int64))

    of_text = F.pandas_udf(run, "long")
    return docs.select(F.col(id_col).alias("id"), of_text(F.col(text_col)).alias("code"))


# --- parts


def bit_counts(codes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and of those that have bits i and j."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for frame in frames:
            for start in range(0, len(frame), _BLOCK):
                bits = bit_matrix(frame["code"].to_numpy(np.int64)[start : start + _BLOCK].view(np.uint64)).astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
            # A row per batch; summed over all of them by Spark.
            i, j = np.nonzero(total)
            yield pd.DataFrame({"i": i, "j": j, "n": total[i, j]})
            total[:] = 0

    number = codes.count()
    both = np.zeros((BITS, BITS), dtype=np.int64)
    for r in codes.mapInPandas(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r["i"], r["j"]] = r["n"]  # 64 x 64 at most
    return number, both


def group_bits(number: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near equal size. A group begins with the bit
    that is most correlated with the others left, and takes the bit with the
    largest sum of absolute correlations with it until it is full."""
    share = np.diag(both) / max(1, number)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(both / max(1, number) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    for g in range(parts):
        size = BITS // parts + (g < BITS % parts)
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            nearest = max(left, key=lambda b: (related[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def number_of_parts(number: int) -> int:
    """As many as leave a part about as many values as there are fingerprints."""
    width = max(BITS // MOST_PARTS, int(number).bit_length())
    return max(LEAST_PARTS, BITS // width)


def part_values(codes: np.ndarray, group: Sequence[int]) -> np.ndarray:
    """The bits of ``group``, packed."""
    out = np.zeros(len(codes), dtype=np.int64)
    for k, b in enumerate(group):
        out |= ((codes >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


# --- thresholds


@dataclass(frozen=True)
class Estimate:
    """``near[p][h][value, e]``: the fingerprints whose half ``h`` of part ``p``
    is at a distance of exactly ``e`` of ``value``; all tables together have
    one entry per value of half a part."""

    number: int
    groups: list[list[int]]
    near: list[list[np.ndarray]]

    def candidates(self, codes: np.ndarray, part: int) -> np.ndarray:
        """``(codes, RADIUS + 1)``: about how many are within 0, 1, 2 of each,
        the halves taken as independent."""
        low, high = (
            table[part_values(codes, half)] for table, half in zip(self.near[part], _halves(self.groups[part]), strict=True)
        )
        exact = np.zeros((len(codes), RADIUS + 1))
        for e in range(RADIUS + 1):
            for a in range(e + 1):
                exact[:, e] += low[:, a] * high[:, e - a]
        return np.cumsum(exact, axis=1) / max(1, self.number)


def _halves(group: list[int]) -> list[list[int]]:
    """A part cut into pieces of a bounded table each."""
    middle = len(group) // 2
    return [group[:middle], group[middle:]]


def estimate(codes: DataFrame, number: int, groups: list[list[int]]) -> Estimate:
    """From the counts of the values of half a part, at most 2**16 each."""
    counted = None
    for p, group in enumerate(groups):
        for h, half in enumerate(_halves(group)):
            value = _packed(half).alias("value")
            part = codes.select(F.lit(p).alias("p"), F.lit(h).alias("h"), value)
            counted = part if counted is None else counted.unionByName(part)
    rows = counted.groupBy("p", "h", "value").agg(F.count(F.lit(1)).alias("n")).toPandas()
    near = []
    for p, group in enumerate(groups):
        tables = []
        for h, half in enumerate(_halves(group)):
            own = rows[(rows["p"] == p) & (rows["h"] == h)]
            at = np.zeros(1 << len(half))
            at[own["value"].to_numpy(np.int64)] = own["n"].to_numpy(np.float64)
            tables.append(np.stack(_exact_distances(at, len(half)), axis=1))
        near.append(tables)
    return Estimate(number, groups, near)


def _exact_distances(at: np.ndarray, bits: int) -> list[np.ndarray]:
    """For every value, the counts at a distance of exactly 0, 1 and 2. After
    each bit, ``by[e]`` counts what differs in e of the bits so far and is
    equal in the others."""
    order = np.arange(len(at))
    by = [at, np.zeros_like(at), np.zeros_like(at)]
    for b in range(bits):
        over = order ^ (1 << b)
        by = [by[0], by[1] + by[0][over], by[2] + by[1][over]]
    return by


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Thresholds ``(codes, parts)`` from -1 to RADIUS that sum up to ``budget``
    at the least cost. ``costs`` is ``(codes, parts, RADIUS + 2)``, its last
    axis by threshold from -1."""
    n, parts, steps = costs.shape
    lowest = -parts
    width = budget - lowest + 1
    best = np.full((n, width), np.inf)
    best[:, 0] = 0  # index s: thresholds sum up to lowest + s, unset parts at -1
    choice = np.zeros((parts, n, width), dtype=np.int8)
    for p in range(parts):
        nxt = np.full((n, width), np.inf)
        for t in range(steps):  # threshold t - 1
            for s in range(t, width):
                cost = best[:, s - t] + costs[:, p, t]
                better = cost < nxt[:, s]
                nxt[better, s] = cost[better]
                choice[p, better, s] = t
        best = nxt
    out = np.zeros((n, parts), dtype=np.int64)
    state = np.full(n, width - 1)
    rows = np.arange(n)
    for p in reversed(range(parts)):
        t = choice[p, rows, state]
        out[:, p] = t - 1
        state = state - t
    return out


def flips(width: int, distance: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``distance`` ones."""
    if distance < 0:
        return np.zeros(0, dtype=np.int64)
    ones = [1 << b for b in range(width)]
    made = [0]
    if distance >= 1:
        made += ones
    if distance >= 2:
        made += [a | b for i, a in enumerate(ones) for b in ones[i + 1 :]]
    return np.array(made, dtype=np.int64)


def probes(codes: DataFrame, estimated: Estimate) -> DataFrame:
    """``(code, part, value)``: what each fingerprint probes."""
    shared = codes.sparkSession.sparkContext.broadcast(estimated)
    groups = estimated.groups
    budget = RADIUS - len(groups) + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        masks = [[flips(len(g), t) for t in range(-1, RADIUS + 1)] for g in groups]
        for frame in frames:
            for start in range(0, len(frame), _BLOCK):
                signed = frame["code"].to_numpy(np.int64)[start : start + _BLOCK]
                own = signed.view(np.uint64)
                costs = np.zeros((len(own), len(groups), RADIUS + 2))
                for p in range(len(groups)):
                    costs[:, p, 1:] = known.candidates(own, p) + PROBE_COST * np.array([len(m) for m in masks[p][1:]])
                thresholds = allocate(costs, budget)
                for p, group in enumerate(groups):
                    values = part_values(own, group)
                    for t in range(RADIUS + 1):
                        at = np.flatnonzero(thresholds[:, p] == t)
                        step = max(1, (1 << 18) // len(masks[p][t + 1]))
                        for k in range(0, len(at), step):
                            some = at[k : k + step]
                            probed = values[some][:, None] ^ masks[p][t + 1][None, :]
                            yield pd.DataFrame(
                                {"code": np.repeat(signed[some], probed.shape[1]), "part": p, "value": probed.ravel()}
                            )

    return codes.select("code").mapInPandas(run, "code long, part int, value long")


# --- links


def _packed(group: Sequence[int]):
    value = F.lit(0).cast("long")
    for k, b in enumerate(group):
        value = value.bitwiseOR(F.shiftleft(F.shiftright("code", b).bitwiseAND(F.lit(1).cast("long")), k))
    return value


def fingerprint_links(codes: DataFrame, crowded: int = CROWDED, parts: int | None = None) -> DataFrame:
    """Links ``(a, b)`` between fingerprints, ``(code)`` without repeats, whose
    components are those of all pairs that differ in at most two bits."""
    number, both = bit_counts(codes)
    groups = group_bits(number, both, parts or number_of_parts(number))
    probed = write_table(probes(codes, estimate(codes, number, groups)), "simhash_probes")
    values = F.array(*[F.struct(F.lit(p).alias("part"), _packed(g).alias("value")) for p, g in enumerate(groups)])
    index = codes.select("code", F.inline(values))

    large = index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > crowded).drop("k")
    large = broadcast_if_small(write_table(large, "simhash_crowded"))
    # Each link is met by the probes of both its ends; the larger end's count.
    few = index.join(large, ["part", "value"], "left_anti")
    found = few.withColumnRenamed("code", "a").join(probed.withColumnRenamed("code", "b"), ["part", "value"])
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = found.where("a < b").where(differ <= RADIUS).select("a", "b").distinct()

    dense = index.join(large, ["part", "value"], "left_semi").select("code")
    dense = dense.unionByName(probed.join(large, ["part", "value"], "left_semi").select("code")).distinct()
    near = F.array(F.col("code"), *[F.col("code").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)])
    around = dense.select("code", F.explode(near).alias("point"))
    stars = around.groupBy("point").agg(F.min("code").alias("a"), F.collect_list("code").alias("rest"))
    starred = stars.where(F.size("rest") > 1).select("a", F.explode("rest").alias("b")).where("a <> b").distinct()
    return pairs.unionByName(starred)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
    parts: int | None = None,
) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased; null and blank
    texts have the fingerprint zero and are linked like any other. Rows link if
    their fingerprints differ in at most two bits; ``component_id`` is the
    smallest id reachable. Rows with a null id take part; their component is
    the smallest id that is not null, if any. Equal rows are returned each.
    ``crowded`` and ``parts`` change the cost only.
    """
    marked = write_table(fingerprints(docs, id_col, text_col), "simhash_codes")
    classes = write_table(marked.groupBy("code").agg(F.min("id").alias("id")), "simhash_classes")
    links = write_table(fingerprint_links(classes.select("code"), crowded, parts), "simhash_links")
    linked = connected_components(links).select(F.col("node").alias("code"), F.col("component").alias("group"))
    own = classes.join(linked, "code", "left").withColumn("group", F.coalesce("group", "code"))
    smallest = own.groupBy("group").agg(F.min("id").alias("component_id"))
    named = own.join(smallest, "group").select("code", "component_id")
    return marked.join(named, "code", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
