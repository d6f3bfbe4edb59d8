"""Merkle manifest of a table of documents, kept as postorder append logs.

Every source is a tree whose runs of three nodes have one parent, and the roots
of the sources are the leaves of one more such tree. Leaves are numbered within
their source by range partitions. An aligned builder takes 3**7 neighbouring
leaves and appends nodes to its log in the order in which they are completed;
the roots of the builders are the leaves of the next tier, until one is left.

Where a node stands in a log follows from the sizes of the subtrees before it
(``postorder_position``), so logs hold digests and nothing else, and siblings
of a leaf are read at computed places. A document's proof is what its builder's
log gives, then the path of that builder in the tiers above, one row a builder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

FAN = 3
LEVELS = 7  # of one builder, which holds FAN**LEVELS nodes of its lowest level
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- logs and paths, of one builder


def node_digest(children: list[bytes]) -> bytes:
    """The parent of a run of nodes; digests go in as hex text."""
    return sha256(b"".join(children).hex().encode()).digest()


def levels_above(units: int) -> int:
    """How often a row of ``units`` nodes is grouped until one is left."""
    levels = 0
    while units > 1:
        units, levels = -(-units // FAN), levels + 1
    return levels


def postorder_position(level: int, index: int, units: int, levels: int) -> int:
    """Place in the log of node ``index`` of ``level``, in a tree of ``levels``
    levels over ``units`` leaves: the number of nodes completed before it."""
    end = min((index + 1) * FAN**level, units)
    below = sum(-(-end // FAN**m) for m in range(level))
    above = sum(index // FAN ** (m - level) for m in range(level + 1, levels + 1))
    return below + index + above


def append_log(units: list[bytes], levels: int) -> list[bytes]:
    """All nodes over ``units`` in the order in which they are completed; the
    last is the root."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def put(level: int, digest: bytes) -> None:
        log.append(digest)
        waiting[level].append(digest)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        put(level + 1, node_digest(run))

    for unit in units:
        put(0, unit)
        level = 0
        while level < levels and len(waiting[level]) == FAN:
            close(level)
            level += 1
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def unit_path(log: bytes, unit: int, units: int, levels: int) -> bytes:
    """The siblings of a leaf up to the root of its log: for each level the
    numbers of siblings to the left and right, and their digests."""
    parts, index, width = [], unit, units
    for level in range(levels):
        first = index - index % FAN
        last = min(first + FAN, width)
        parts.append(bytes([index - first, last - index - 1]))
        for sibling in range(first, last):
            if sibling != index:
                at = DIGEST * postorder_position(level, sibling, units, levels)
                parts.append(log[at : at + DIGEST])
        index, width = index // FAN, -(-width // FAN)
    return b"".join(parts)


def path_steps(path: bytes) -> Iterator[tuple[str, str]]:
    """Hex text left and right of the node, level by level."""
    at = 0
    while at < len(path):
        left, right = path[at] * DIGEST, path[at + 1] * DIGEST
        at += 2
        yield path[at : at + left].hex(), path[at + left : at + left + right].hex()
        at += left + right


def fold(leaf: str, steps: list[tuple[str, str]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for left, right in steps:
        leaf = sha256((left + leaf + right).encode()).hexdigest()
    return leaf


# --- tables


@dataclass(frozen=True)
class Forest:
    """``tiers[t]`` has a row per builder: ``(tree, seg, units, segs, levels,
    log)``, the lowest also ``ids`` and ``changed`` if its leaves have them;
    ``roots`` is ``(tree, root)``."""

    tiers: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    documents: Forest
    sources: Forest
    trees: DataFrame  # (tree, source, n)
    root: str | None  # none without any row


def _numbered(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` with ``at``, the place from 0 among those of the same ``key``
    in ``order``, and ``n``, their number. No task holds more than a range."""
    ranges = write_table(
        rows.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("row", F.monotonically_increasing_id()),
        "manifest_ranges",
    )
    part = F.shiftright("row", 33).alias("part")
    # A row per key and partition; a key is in neighbouring partitions.
    runs = ranges.groupBy(key, part).agg(F.count(F.lit(1)).alias("k"), F.min("row").alias("first"))
    whole = Window.partitionBy(key)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        key,
        "part",
        (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("k").over(whole).alias("n"),
    )
    placed = ranges.withColumn("part", part).join(broadcast_if_small(write_table(runs, "manifest_runs")), [key, "part"])
    return placed.withColumn("at", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def _builder(levels: int, extra: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    span = FAN**levels

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        n = int(frame["n"].iloc[0])
        own = levels if n > span else levels_above(n)
        row = {
            "tree": frame["tree"].iloc[0],
            "seg": int(frame["at"].iloc[0]) // span,
            "units": len(frame),
            "segs": -(-n // span),
            "levels": own,
            "log": b"".join(append_log(frame["digest"].tolist(), own)),
        }
        if "id" in extra:
            row["ids"] = frame["id"].tolist()
        if "changed" in extra:
            row["changed"] = b"".join(frame["changed"])
        return pd.DataFrame([row])

    return build


def _build(leaves: DataFrame, levels: int) -> Forest:
    """Builders over ``(tree, at, n, digest)`` with ``at`` from 0 to n - 1 in
    each tree; columns ``id`` and ``changed`` are kept beside the lowest."""
    tiers: list[DataFrame] = []
    roots: list[DataFrame] = []
    while True:
        extra = [c for c in ("id", "changed") if c in leaves.columns]
        schema = "tree long, seg long, units int, segs long, levels int, log binary"
        schema += "".join({"id": ", ids array<string>", "changed": ", changed binary"}[c] for c in extra)
        seg = F.expr(f"at div {FAN**levels}L")
        built = leaves.withColumn("seg", seg).groupBy("tree", "seg").applyInPandas(_builder(levels, extra), schema)
        tier = write_table(built, f"manifest_tier_{len(tiers)}")
        tiers.append(tier)
        tops = tier.select("tree", "seg", "segs", F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("digest"))
        roots.append(tops.where("segs = 1").select("tree", F.col("digest").alias("root")))
        more = tops.where("segs > 1")
        if more.isEmpty():
            break
        leaves = more.select("tree", F.col("seg").alias("at"), F.col("segs").alias("n"), "digest")
    whole = roots[0]
    for other in roots[1:]:
        whole = whole.unionByName(other)
    return Forest(tiers, whole)


def _unit_paths(tier: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """``(tree, seg, path)`` of the nodes that the builders of ``tier`` stand on."""
    span = FAN**levels

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                made = [unit_path(row.log, u, row.units, row.levels) + row.path for u in range(row.units)]
                units = range(row.seg * span, row.seg * span + row.units)
                yield pd.DataFrame({"tree": row.tree, "seg": list(units), "path": made})

    joined = tier.select("tree", "seg", "units", "levels", "log").join(paths, ["tree", "seg"])
    return joined.mapInPandas(run, "tree long, seg long, path binary")


def _builder_paths(forest: Forest, above: DataFrame, levels: int) -> DataFrame:
    """``(tree, seg, path)`` of the lowest builders, from their roots to the end
    of ``above``, ``(tree, path)``."""
    paths = None
    for t in reversed(range(len(forest.tiers))):
        own = forest.tiers[t].where("segs = 1").select("tree", "seg").join(above, "tree")
        if paths is not None:
            own = own.unionByName(_unit_paths(forest.tiers[t + 1], paths, levels))
        paths = write_table(own, f"manifest_paths_{t}")
    return paths


def _leaf(text: Column) -> Column:
    fields = [F.col(c).cast("string") for c in FIELDS[:-1]] + [text]
    sized = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*sized), 256))


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(key, id, digest, changed)``: the leaf of each row, and that of the row
    with the text ``tampered``. ``key`` orders sources, null first."""
    changed = F.when(tampered.eqNullSafe(F.col("text")), F.lit(None)).otherwise(_leaf(tampered))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    rows = docs.select(
        key.alias("key"), F.col("doc_id"), F.col("doc_id").cast("string").alias("id"), _leaf(F.col("text")).alias("digest"), changed.alias("changed")
    )
    return rows.withColumn("changed", F.coalesce("changed", "digest"))


def build_manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> Manifest:
    """Trees over the rows of ``docs``, by source, and over the sources.

    Leaves ascend by ``doc_id``, null ids first; rows with one id go by their
    digest. Null is a source of its own and the first. ``tampered`` is a text
    column kept beside the leaves for ``verify``.
    """
    text = F.col("text") if tampered is None else tampered
    leaves = write_table(document_leaves(docs, text), "manifest_leaves")
    placed = _numbered(leaves, "key", "doc_id", "digest")
    counts = write_table(leaves.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "manifest_sources")
    ranked = _numbered(counts.select(F.lit(0).cast("long").alias("all"), F.col("key"), F.col("n").alias("rows")), "all", "key")
    trees = write_table(
        ranked.select(
            F.col("at").alias("tree"),
            "key",
            F.when(F.col("key") != "n", F.expr("substring(key, 2)")).alias("source"),
            F.col("rows").alias("n"),
        ),
        "manifest_trees",
    )
    own = placed.join(broadcast_if_small(trees.select("key", "tree")), "key")
    documents = _build(own.select("tree", "at", "n", "id", "digest", "changed"), levels)
    number = trees.count()
    tops = documents.roots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(number).cast("long").alias("n"), F.col("root").alias("digest")
    )
    sources = _build(tops, levels)
    top = sources.roots.first()  # one row for the whole table
    return Manifest(documents, sources, trees.drop("key"), bytes(top["root"]).hex() if top else None)


def log_entries(manifest: Manifest, levels: int = LEVELS) -> DataFrame:
    """``(source, position, level, node, digest)``: the append log of each
    source's tree as a whole, every node at its place in postorder."""
    made = None
    for t, tier in enumerate(manifest.documents.tiers):

        def run(frames: Iterator[pd.DataFrame], t: int = t) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    whole, out, width = levels_above(row.n), [], row.units
                    for level in range(row.levels + 1):
                        if level or not t:  # a builder's leaves are in the tier below
                            for i in range(width):
                                at = DIGEST * postorder_position(level, i, row.units, row.levels)
                                node = row.seg * FAN ** (levels - level) + i
                                place = postorder_position(t * levels + level, node, row.n, whole)
                                out.append((row.tree, place, t * levels + level, node, row.log[at : at + DIGEST].hex()))
                        width = -(-width // FAN)
                    yield pd.DataFrame(out, columns=["tree", "position", "level", "node", "digest"])

        sized = tier.select("tree", "seg", "units", "levels", "log").join(manifest.trees.select("tree", "n"), "tree")
        part = sized.mapInPandas(run, "tree long, position long, level int, node long, digest string")
        made = part if made is None else made.unionByName(part)
    return made.join(manifest.trees.select("tree", "source"), "tree").drop("tree")


def verify(manifest: Manifest, id_type: str = "bigint", levels: int = LEVELS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for
    every row: its leaf, the roots above, the digest of all its siblings, and
    the root that its tampered leaf and these siblings lead to."""
    spark = manifest.trees.sparkSession
    root = manifest.root
    start = spark.createDataFrame([(0, b"")], "tree long, path binary")
    outer = _builder_paths(manifest.sources, start, levels)
    above = _unit_paths(manifest.sources.tiers[0], outer, levels).select(F.col("seg").alias("tree"), "path")
    above = write_table(above, "manifest_source_paths")
    paths = _builder_paths(manifest.documents, above, levels)
    paths = write_table(paths.join(manifest.documents.roots, "tree"), "manifest_paths")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                upper = list(path_steps(row.path))
                out = []
                for u in range(row.units):
                    at = DIGEST * postorder_position(0, u, row.units, row.levels)
                    steps = list(path_steps(unit_path(row.log, u, row.units, row.levels))) + upper
                    proof = sha256("".join(left + right for left, right in steps).encode()).hexdigest()
                    changed = row.changed[u * DIGEST : (u + 1) * DIGEST].hex()
                    out.append((row.ids[u], row.log[at : at + DIGEST].hex(), proof, fold(changed, steps)))
                made = pd.DataFrame(out, columns=["doc_id", "leaf", "proof_sha256", "folded_root"])
                made["subroot"] = row.root.hex()
                yield made

    lowest = manifest.documents.tiers[0].select("tree", "seg", "units", "levels", "log", "ids", "changed")
    found = lowest.join(broadcast_if_small(paths), ["tree", "seg"]).mapInPandas(
        run, "doc_id string, leaf string, proof_sha256 string, folded_root string, subroot string"
    )
    return found.select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def without_line_feeds(id_col: str = "doc_id") -> Column:
    """The text that loses its line feeds where 2 divides the CRC-32 of the id
    as text; a null id has none and keeps its text."""
    hit = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    return F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
