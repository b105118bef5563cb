"""Connected components of links between numbered nodes, without gathering links or nodes anywhere.

Large-star and small-star steps alternate: every node is linked to the smallest node it sees, until all
links of a component go to its smallest node. A step counts the minima of neighbours on the map side and
joins them back; both sides of that join are read from files, so a node with any share of the links is
split by adaptive execution. Each step is written to the shared folder, which ends the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, first: str = "a", second: str = "b") -> DataFrame:
    """``node, component`` for every node that has a link; ``component`` is the smallest node reachable.

    ``links`` has two bigint columns, in any order and with repeats; a link with a NULL end, or of a node
    with itself, says nothing. Without links the result is empty.
    """
    a, b = F.col(f"`{first}`").cast("long"), F.col(f"`{second}`").cast("long")
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    pairs = scratch.save(pairs.where(a.isNotNull() & b.isNotNull()).where("a <> b").distinct(), "links")
    state = _checksum(pairs)
    while True:
        pairs, old = _small_star(_large_star(pairs, scratch), scratch), pairs
        scratch.drop(old)
        new_state = _checksum(pairs)
        if new_state == state:
            break
        state = new_state
    # Every node but the smallest of its component now has one link, to that one.
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return scratch.save(pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), "components")


def _checksum(pairs: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and the sum of their hashes."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node among its neighbours and itself."""
    both = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ("ab", "ba")]
    ends = pairs.select(F.inline(F.array(*both)))
    least = scratch.save(
        ends.groupBy("node").agg(F.min("other").alias("seen")).select("node", F.least("node", "seen").alias("low")),
        "least",
    )
    larger = ends.where("other > node").join(least, "node")
    out = scratch.save(larger.select(F.col("other").alias("a"), F.col("low").alias("b")).distinct(), "large")
    scratch.drop(least)
    return out


def _small_star(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = scratch.save(pairs.groupBy("a").agg(F.min("b").alias("low")), "least")
    smaller = pairs.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = least.select("a", F.col("low").alias("b"))
    out = scratch.save(smaller.unionByName(own).distinct(), "small")
    scratch.drop(least)
    scratch.drop(pairs)
    return out
