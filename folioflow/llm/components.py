"""Connected components of a table of links."""

from pyspark.sql import DataFrame, functions as F

from .scratch import discard, written


def components(links: DataFrame, a="a", b="b") -> DataFrame:
    """``(node, label)`` for every node of a link; the label is the smallest node reachable.

    Alternates two rewritings of the links until they are stars: every larger neighbour of a node
    is tied to its smallest neighbour, then every smaller one. Rounds grow with the logarithm of a
    component's width. Each round is written to the shared folder and the one before removed. A hub
    costs one row per task in the minima, and its links are only joined, never gathered.
    """
    spark = links.sparkSession
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, path = written(pairs, "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after, after_path = written(small.select("e.*").where("u <> v").distinct(), "links")
        before, mark = mark, _mark(after)
        discard(spark, path)
        now, path = after, after_path
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    one = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return one["n"], one["s"]
