"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the vertex's smallest neighbour or itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its neighbours below are tied to the smallest of them."""
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """No vertex has two links to smaller ones, or links on both sides: the stars are the components."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    sides = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sides.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> Staged:
    """(u, v): each linked vertex u that isn't the smallest of its component, and that smallest
    vertex v. Minima are found by partial aggregation and joined back, so a vertex with very many
    links is never gathered in a task. Each round is written to the shared folder; links that are stars take none."""
    now = Staged(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    while not _settled(now.rows):
        after = Staged(_small_star(_large_star(now.rows)), "stars")
        now.drop()
        now = after
    return now


def contracted(stars: Staged, links: DataFrame) -> Staged:
    """``stars`` of ``components`` with links (u, v) between their centres, or vertices that are in none."""
    joined = components(links)
    onto = joined.rows.select(F.col("u").alias("v"), F.col("v").alias("_onto"))
    moved = stars.rows.join(onto, "v", "left").select("u", F.coalesce("_onto", "v").alias("v"))
    out = Staged(moved.union(joined.rows), "stars")
    joined.drop()
    stars.drop()
    return out
