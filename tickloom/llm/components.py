"""Connected components of a large graph, as rounds of joins: no part of the graph is ever in one place."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise
from tickloom.operators import spread

# Edges of one node that a join task handles.
ROWS_PER_SLICE = 1_000_000


def _tied(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every edge (u, v) as (v, smallest neighbour of u)."""
    tied = spread.attach_per_key(edges, least, ["u"], "n", rows_per_slice=ROWS_PER_SLICE)
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _tied_by_broadcast(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The same for a table of smallest neighbours that fits a broadcast; no edge is shuffled."""
    return edges.join(F.broadcast(least.select("u", "m")), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the component is its smallest node.

    Alternates two steps until all edges form stars. In the first, each node ties its larger neighbours to the
    smallest one it knows; in the second, its smaller ones. Both keep components. A node with very many
    neighbours is reduced before it is shuffled. Where the smallest neighbours fit a broadcast, a round writes
    two tables and shuffles only sums and new edges; otherwise ``attach_per_key`` divides the rows of such a
    node over several tasks by their number.
    """
    stars = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    stars = materialise(stars, "edges")
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        known = both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"), F.count_if(F.expr("v < u")).alias("smaller")
        )
        known = materialise(known, "known")
        # Stars are done: a node with a smaller neighbour has no other one.
        if not known.agg(F.count_if(F.expr("smaller > 0 AND n > 1"))).first()[0]:
            break
        least = known.select("u", "m", "n")
        if spread.fits_broadcast(least):
            tied, large = _tied_by_broadcast, _tied_by_broadcast(both.filter("v > u"), least).filter("u <> v")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
        else:
            tied, large = _tied, _tied(both.filter("v > u"), least).filter("u <> v").distinct()
            large = materialise(large, "large")
            least = materialise(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        # Every edge now runs from the larger to the smaller node.
        small = tied(large, least).unionByName(least.select("u", F.col("m").alias("v")))
        stars = materialise(small.filter("u <> v").distinct(), "stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
