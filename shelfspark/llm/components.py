"""Connected components of links, as joins: each round every node moves to its least neighbour and links contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a``, ``b`` (longs); nodes of one component share their root.

    A round halves the nodes that still have links, at least, so the rounds grow with the logarithm of the nodes.
    Each round's tables are written to the shared folder: a lost executor costs one round's work.  An empty table
    gives no rows; self-links and repeated links are harmless; links with a null are dropped.
    """
    moves: list[DataFrame] = []
    # a link's order carries no meaning; hashes as ids make the least neighbour a random one
    links = stored(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root"))
        move = stored(move, "moves")
        moves.append(move)
        to = move.select(F.col("node").alias("a"), F.col("root").alias("a2"))
        at = move.select(F.col("node").alias("b"), F.col("root").alias("b2"))
        moved = links.join(to, "a").join(at, "b").where("a2 <> b2")
        links = stored(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    # follow the moves back from the last round; a node without a later move has arrived
    out = moves.pop()
    while moves:
        later = out.select(F.col("node").alias("root"), F.col("root").alias("last"))
        out = moves.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return stored(out, "components")
