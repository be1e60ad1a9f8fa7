"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every step is one aggregate and
one join over the edges, written to the shared folder, until the edges stop
changing (then each component is a star around its smallest node).  The driver
sees one row of counts a step, never an edge or a label.

A node with very many neighbours would have all its edges in one task of the
join.  The smallest neighbours of such hubs are broadcast instead: a hub has
over ``HUB`` edges and over one in ``HUBS`` of all edge ends, so there are fewer
than ``HUBS`` of them whatever the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table

#: Edges of a hub at least, and hubs at most.
HUB = 100_000
HUBS = 100_000


def _star(both: DataFrame, ends: int) -> DataFrame:
    """(u, v) with m, the smallest of u and what ``both``, of ``ends`` rows at most, links to it."""
    hub = F.col("n") > max(HUB, ends // HUBS)
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), hub.alias("hub"))
    hubs = least.where("hub").select(F.col("u").alias("of"), F.col("m").alias("hub_m"))
    marked = both.join(F.broadcast(hubs), F.col("u") == F.col("of"), "left").drop("of")
    rest = marked.where("hub_m is null").drop("hub_m").join(least.where("not hub").drop("hub"), "u")
    return rest.unionByName(marked.where("hub_m is not null").withColumnRenamed("hub_m", "m"))


def _large(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both, 2 * n).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    """``edges`` point from the larger node ``u`` to a smaller ``v``."""
    s = _star(edges, n)
    return (s.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges``: long columns ``u``, ``v``.  Returns ``node``, ``root`` (the smallest node of its
    component) for every node that an edge names.  Loops and repeated edges do no harm; an empty
    table gives an empty result."""
    now = stage_table(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen, n = None, now.count()
    while True:
        now = stage_table(_small(_large(now, n), n), "edges")  # a large star has at most as many edges as it is given
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen, n = state, state[0]
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
