"""Connected components by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.storage import write_table

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges``, the
    component being its smallest node.

    Each round a component takes the smallest label next to it, follows labels
    twice, and drops the edges within components; labels and edges are written
    between rounds. Minima combine before the shuffle, so a node with very many
    edges is no hot key. Null ends are left out.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    left = write_table(both.where("x <> y").distinct(), "component_edges")
    labels = write_table(
        pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct().withColumn("component", F.col("node")),
        "component_labels",
    )
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            return labels
        # Over components, not nodes: where each hooks to.
        hook = left.groupBy("x").agg(F.min("y").alias("least")).select("x", F.least("x", "least").alias("to"))
        hook = write_table(hook, "component_hooks")
        for _ in range(2):
            up = hook.select(F.col("x").alias("to"), F.col("to").alias("further"))
            hook = hook.join(up, "to", "left").select("x", F.coalesce("further", "to").alias("to"))
        hook = write_table(hook, "component_roots")
        moved = labels.join(hook, labels["component"] == hook["x"], "left")
        labels = write_table(
            moved.select("node", F.coalesce("to", "component").alias("component")), "component_labels"
        )
        end = hook.select(F.col("x").alias("y"), F.col("to").alias("to_y"))
        left = write_table(
            left.join(hook, "x")
            .join(end, "y")
            .select(F.col("to").alias("x"), F.col("to_y").alias("y"))
            .where("x <> y")
            .distinct(),
            "component_edges",
        )
    raise RuntimeError("components did not settle")
