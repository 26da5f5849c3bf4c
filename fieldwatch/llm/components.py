"""Connected components of a link table by repeated contraction.

Each round every node takes its smallest neighbour (or itself) as parent, looks
one step further up, and links are rewritten between parents. A node that is not
smaller than all its neighbours disappears, so the number of nodes with links at
least halves each round and the links shrink with it. Every round is a few
equality joins on written tables; nothing is collected but a row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); roots are nodes, one for
    each component. Loops are ignored; duplicates and both directions are fine."""
    pairs = links.filter("a <> b").select("a", "b")
    edges = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                        "edges")
    member = None
    while not edges.isEmpty():
        parent = materialise(edges.groupBy("a").agg(F.min("b").alias("b"))
                             .select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        # every parent is itself a node of this round, so the inner join keeps all
        parent = materialise(parent.join(above, "up").select("node", F.col("top").alias("root")), "parents")
        if member is None:
            member = parent
        else:
            step = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            member = materialise(member.join(step, "root", "left")
                                 .select("node", F.coalesce("next", "root").alias("root")), "members")
        to = lambda col: parent.select(F.col("node").alias(col), F.col("root").alias(f"to_{col}"))
        edges = materialise(edges.join(to("a"), "a").join(to("b"), "b")
                            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
                            .filter("a <> b").distinct(), "edges")
    if member is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return member
