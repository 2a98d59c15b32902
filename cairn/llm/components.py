"""Connected components of a link table by alternating large-star and small-star steps.

Both steps are a partial aggregate (least neighbour) and a join back, so neither a large component
nor a node with many neighbours is ever gathered in one task, and the number of rounds grows with
the logarithm of the diameter.  Each round is written to the shared folder to cut the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairn.llm import storage


def _star(pairs: DataFrame) -> DataFrame:
    """For every (u, v): (v, least of u and its neighbours), least rows apart."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return pairs.join(least, pairs["u"] == least["c"]).select("u", "v", "m")


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for the nodes of ``links(a, b)``.

    Links with a null end and links of a node to itself are ignored.  The result is read from the
    shared folder; without links it is empty."""
    spark = links.sparkSession
    edges_path = storage.write_table(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u <> v").distinct(), "links")
    state = None
    while True:
        edges = storage.read(spark, edges_path)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _star(large.distinct())  # here v < u
        nxt = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(small.select("u", F.col("m").alias("v")))
               .where("u <> v").distinct())
        path = storage.write_table(nxt, "links")
        out = storage.read(spark, path)
        now = out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        storage.drop_table(spark, edges_path)
        edges_path = path
        if now == state:
            break
        state = now
    nodes = storage.read(spark, edges_path)
    out = nodes.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        nodes.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out._table_path = edges_path
    return out
