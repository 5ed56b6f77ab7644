"""Connected components of an edge table by alternating large and small stars.

A star joins each node's edges with the node's least neighbour. A node that very many edges touch is
not one key there: its edges are salted by their other end, the minimum is taken by (node, salt), then
by node, and handed back by (node, salt). Only salts that occur are rows, so salting costs nothing
for nodes of few edges. Each round is written to the shared folder and the round before it removed.

The rounds end when every component is a star about its least node; their number grows with the square
of the logarithm of the nodes at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import discard, materialised

EDGES_A_SALT = 1 << 16  #: salts of a node grow with the edges, so that about this many of a hub's edges meet in a task
LEAST_SALTS = 64


def _star(e: DataFrame, large: bool, salts: int) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
    both = both.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).repartition("u", "s")
    run = Window.partitionBy("u", "s")
    heads = both.withColumns({"m": F.min("v").over(run), "n": F.row_number().over(run.orderBy("v"))}).filter("n = 1")  # a row for each salt of a node
    known = heads.select(F.col("u").alias("_u"), F.col("s").alias("_s"), F.least("u", F.min("m").over(Window.partitionBy("u"))).alias("_m"))
    joined = both.join(known.hint("merge"), (F.col("u") == F.col("_u")) & (F.col("s") == F.col("_s")))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("_m").alias("v")), F.struct(F.col("v").alias("u"), F.col("_m").alias("v")))).alias("x")).select("x.*")
    return out.filter("u <> v")


def _is_forest_of_stars(e: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node of the component) for all nodes of edges (a, b)."""
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, path = materialised(e, "edges")
    while not _is_forest_of_stars(e):
        old, salts = path, max(LEAST_SALTS, e.count() // EDGES_A_SALT)
        e, path = materialised(_star(_star(e, True, salts), False, salts).distinct(), "edges")  # a large star has no more edges than came in
        discard(spark, old)
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
