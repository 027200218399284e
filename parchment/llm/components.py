"""Connected components of a distributed set of links, by hooking and contraction.  Nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, discard


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp) for every id that isn't itself the least of its component; comp is that least id.

    In each round every vertex hooks onto its least neighbour, hooks are shortened, and links are carried over
    to the hooked vertices; links inside one vanish.  A star round its least id takes one round, and a chain
    shrinks to a quarter or less.  Each round is written out; links should be a written table already.
    """
    edges, held, labels = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v"), None, None
    while True:
        hook = edges.groupBy("u").agg(F.min("v").alias("to"))
        for _ in range(2):
            up = hook.select(F.col("u").alias("to"), F.col("to").alias("up"))
            hook = hook.join(up, "to", "left").select("u", F.coalesce("up", "to").alias("to"))
        hook = cut(hook, "hooks")
        older = labels
        if labels is None:
            labels = cut(hook.select(F.col("u").alias("id"), F.col("to").alias("comp")), "labels")
        else:
            moved = labels.join(hook.withColumnRenamed("u", "comp"), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
            labels = cut(moved.union(hook.join(labels, hook["u"] == labels["id"], "left_anti").select("u", "to")), "labels")
        at_v = hook.select(F.col("u").alias("v"), F.col("to").alias("tv"))
        ends = edges.join(hook, "u").join(at_v, "v", "left").select(F.col("to").alias("x"), F.coalesce("tv", "v").alias("y"))
        edges = cut(ends.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
        discard(hook, older, held)
        held = edges
        if edges.isEmpty():
            discard(edges)
            return labels
