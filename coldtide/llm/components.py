"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.session import drop_path, scratch_path


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that links of (a, b) longs can reach.

    Rounds of large-star and small-star rewiring: every node points its larger
    neighbours, then its smaller ones and itself, to its least neighbour. A
    round at most halves the depth of chains; the state is a written table, and
    the rounds end when one changes nothing. Only sums reach the driver.
    """
    spark = links.sparkSession
    kept: list[str] = []

    def write(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "links")
        df.write.parquet(path)
        kept.append(path)
        return spark.read.schema(df.schema).parquet(path)

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        else:
            both = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        wide = both.where("v > u") if large else both
        out = wide.join(least, wide["u"] == least["w"]).select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    state = write(links.where("a <> b").select("a", "b").distinct())
    told = None
    while True:
        state = write(star(star(state, True), False))
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if len(kept) > 2:
            drop_path(spark, kept.pop(0))
        if tuple(now) == told:
            break
        told = tuple(now)
    found = state.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.union(found.select("label", "label").distinct())
