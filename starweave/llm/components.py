"""Connected components of an edge table, by alternating star contraction.

A round points every vertex's larger neighbours at its smallest neighbour
(large star), then every vertex and its smaller neighbours at the smallest of
them (small star).  When a round changes nothing the edges are stars around
the smallest vertex of each component.  Rounds grow with the logarithm of the
component size.  Each round is a minimum per vertex (partial aggregation
first) and a join, so a vertex with many edges is never gathered in one task,
and is written to the shared folder, so nothing is recomputed after a loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("v", "m")
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.shiftright(h, 8).cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).unionAll(
        edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
    least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("least"))
    return both.where("w > u").join(least, "u").select(
        F.col("w").alias("v"), F.col("least").alias("m")).where("v <> m").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge runs from v to a smaller m: v's smaller neighbours are its m's.
    least = edges.groupBy("v").agg(F.min("m").alias("least"))
    moved = edges.join(least, "v").where("m <> least").select(
        F.col("m").alias("v"), F.col("least").alias("m"))
    return moved.unionAll(least.select("v", F.col("least").alias("m"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(doc, component): every document that occurs in ``links`` (a, b) and
    the smallest document it reaches.  No links give no rows; a link of a
    document with itself and repeated links change nothing; links with a null
    end are left out."""
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct()
    edges = written(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        before, edges = edges, written(_small_star(_large_star(edges)), "edges")
        forget(before)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("v").alias("doc"), F.col("m").alias("component"))
    centres = edges.select(F.col("m").alias("doc"), F.col("m").alias("component")).distinct()
    return stars.unionAll(centres)


def extended(joined: DataFrame | None, links: DataFrame) -> DataFrame:
    """``components`` of all links so far, from those before (``joined``, or None) and
    new ones: only what the new links join is contracted."""
    if joined is None:
        return components(links)
    named = links
    for end in ("a", "b"):
        named = named.join(joined.toDF(end, f"c{end}"), end, "left") \
            .withColumn(end, F.coalesce(f"c{end}", end)).drop(f"c{end}")
    moved = components(named.select("a", "b")).toDF("component", "now")
    known = joined.join(moved, "component", "left").select(
        "doc", F.coalesce("now", "component").alias("component"))
    new = moved.toDF("doc", "component").join(joined.select("doc"), "doc", "left_anti")
    return known.unionByName(new)
