"""Connected components and least spanning forests of an edge table by contraction: nodes join, and what is left between the joined is done again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import written


def connected_components(edges: DataFrame) -> DataFrame:
    """From (u, v): (node, component), the smallest node reached.

    The first turn orders nodes by themselves, so that stars round their smallest node are done at once; later turns order
    them by a hash of the turn, which shortens chains by a constant share. A component's last node in that order is nobody's
    least neighbour, so each turn has fewer nodes and the turns end by themselves. Minima come from partial aggregation; no
    neighbour list is gathered.
    """
    live = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    turns: list[DataFrame] = []
    while not turns or not live.isEmpty():
        order = lambda node: F.struct(F.xxhash64(node, F.lit(len(turns))).alias("h") if turns else F.lit(0).alias("h"), F.col(node).alias("id"))  # noqa: E731, B023
        both = live.unionAll(live.select("v", "u"))
        joined = both.select("u", order("v").alias("near")).groupBy("u").agg(F.min("near").alias("near"))
        joined = written(joined.select(F.col("u").alias("node"), F.least("near", order("u")).getField("id").alias("joins")))
        turns.append(joined)
        ends = live.join(joined.toDF("u", "a"), "u").join(joined.toDF("v", "b"), "v")
        live = written(ends.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    found = turns[-1].toDF("node", "component")
    for joined in reversed(turns[:-1]):
        found = joined.join(found.toDF("joins", "component"), "joins", "left").select("node", F.coalesce("component", "joins").alias("component"))
    if len(turns) == 1:
        return found
    least = found.groupBy("component").agg(F.min("node").alias("least"))
    return found.join(least, "component").select("node", F.col("least").alias("component"))


def spanning_forest(edges: DataFrame) -> DataFrame:
    """From (u, v, weight): the edges of a forest of least weight, equal weights in the order of their ends.

    Borůvka's turns: every component takes its least edge to another one, the components that these edges link become one,
    and of the edges between two new ones the least stays. Each turn leaves half of the components at most. Cut at a
    weight, the forest has the components that all edges up to this weight have.
    """
    rank = F.struct("weight", "u", "v").alias("edge")
    ends = edges.where("u IS NOT NULL AND v IS NOT NULL AND weight IS NOT NULL AND u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "weight")
    live = written(ends.groupBy("u", "v").agg(F.min("weight").alias("weight")).select("u", "v", rank))
    turns: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionAll(live.select("v", "u", "edge"))
        least = written(both.groupBy("u").agg(F.min_by("v", "edge").alias("v"), F.min("edge").alias("edge")))
        turns.append(least.select("edge.*").distinct())
        # two components that take the same edge are the only circle that their choices have: the smaller one is the root
        back = least.select(F.col("u").alias("v"), F.col("v").alias("back"))
        roots = written(least.join(back, "v").select("u", F.when((F.col("back") == F.col("u")) & (F.col("u") < F.col("v")), F.col("u")).otherwise(F.col("v")).alias("root")))
        moved = True
        while moved:
            roots = written(roots.join(roots.toDF("root", "next"), "root").select("u", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved")))
            moved, roots = not roots.where("moved").isEmpty(), roots.select("u", "root")
        ends = live.join(roots.toDF("u", "a"), "u").join(roots.toDF("v", "b"), "v").where("a <> b")
        live = written(ends.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.min("edge").alias("edge")))
    taken = live.select("edge.*")
    for least in turns:
        taken = taken.unionAll(least)
    return taken.select("u", "v", "weight")


def components_at(forest: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(weight, node, component): the components of the edges (u, v, weight) up to each of some weights.

    Those up to a greater weight are linked from those up to the one before, so each edge is looked at once.
    """
    out, named, before = [], None, None
    for weight in sorted(map(float, set(weights))):
        edges = forest.where(F.col("weight") <= weight) if before is None else forest.where((F.col("weight") > before) & (F.col("weight") <= weight))
        if named is None:
            named = written(connected_components(edges.select("u", "v")))
        else:
            at = lambda end: edges.select("u", "v").join(named.toDF("node", end), F.col("node") == F.col({"a": "u", "b": "v"}[end]), "left").drop("node")  # noqa: E731, B023
            nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(named.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
            ends = at("a").join(at("b").select("u", "v", "b"), ["u", "v"]).select(F.coalesce("a", "u").alias("u"), F.coalesce("b", "v").alias("v"))
            linked = connected_components(ends).toDF("component", "least")
            named = written(named.unionAll(nodes).join(linked, "component", "left").select("node", F.coalesce("least", "component").alias("component")))
        out.append(named.select(F.lit(weight).alias("weight"), "node", "component"))
        before = weight
    found = out[0]
    for more in out[1:]:
        found = found.unionAll(more)
    return found
