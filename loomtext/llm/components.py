"""Connected components by alternating large-star and small-star rewrites of the edge list.

Every round is two aggregations and two joins over the edges; nothing is collected but two
numbers a round. Each round's edges are written to the shared folder, so lineage stays short and a
lost executor costs one round at most; the round before is deleted then.

The centre of a big component has all its edges at one key. Aggregations are partial before their
shuffle; joins deal the edges of a node by ``SALTS`` numbers and repeat its smallest neighbour, a narrow row, for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import discard, stored

SALTS = 8


def _toward(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Rewire each node's neighbours to the smallest node seen from it.

    Large star (``both_ways``): larger neighbours are rewired. Small star: smaller ones and the
    node itself. ``edges`` has u > v.
    """
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    spread = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    joined = seen.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(spread, ["u", "salt"])
    if both_ways:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u > v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node long, component_id long)`` for every node of an edge; component_id is its smallest node.

    Nulls in either end, self-loops, direction and repeats of edges don't matter. An empty edge
    list gives no rows.
    """
    spark, paths = edges.sparkSession, []
    cur = stored(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .distinct(),
        "edges",
        paths,
    )
    mark = None
    for _ in range(max_rounds):
        cur = stored(_toward(_toward(cur, True), False), "edges", paths)
        row = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(spark, paths.pop(0))
        now = (row[0], row[1])
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("connected components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    )
