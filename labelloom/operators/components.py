"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.storage import write_table

MAX_ROUNDS = 100


def component_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every end of a link, the label being the smallest
    node that it is connected with.

    A round lets every label take the smallest label that it is linked with,
    shortens the chains that this makes to their ends, and puts the result in
    place of the labels in the links; links within a label go. Minima combine
    before the shuffle, so a node with very many links is no hot key. Tables
    are written between rounds.
    """
    open_links = write_table(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    ends = links.select(F.col(a).alias("node")).union(links.select(b))
    labels = write_table(ends.distinct().withColumn("label", F.col("node")), "labels")
    for _ in range(MAX_ROUNDS):
        if open_links.isEmpty():
            return labels
        sides = open_links.unionByName(open_links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        down = sides.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to"))
        down = write_table(down, "label_steps")
        while True:
            # ``to`` of ``to``; smallest neighbours never lead in a circle.
            next_step = down.select(F.col("u").alias("to"), F.col("to").alias("end"))
            down = write_table(down.join(next_step, "to").select("u", F.col("to"), "end"), "label_steps")
            moved = down.where("to <> end").isEmpty()
            down = down.select("u", F.col("end").alias("to"))
            if moved:
                break
        named = labels.join(down, labels["label"] == down["u"], "left")
        labels = write_table(named.select("node", F.coalesce("to", "label").alias("label")), "labels")
        other = down.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        open_links = write_table(
            open_links.join(down, "u").join(other, "v").select(F.col("to").alias("u"), F.col("to_v").alias("v")).where("u <> v").distinct(),
            "links",
        )
    raise RuntimeError("the components did not settle")
