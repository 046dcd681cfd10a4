"""Written intermediate tables, and connected components over them."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.session import shared_dir


def written(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, as a table in the shared folder: a lost executor costs no earlier step.

    Spark removes shuffle files of a step when the JVM collects what refers to them. So the frame is
    made in here and let go before the JVM is asked to collect; a moment later what the first request
    has set free goes too.
    """
    df, folder = make(), shared_dir(spark)
    schema = df.schema
    df.write.parquet(folder)
    del df
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    return spark.read.schema(schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b: long): the smallest node of the component.

    Alternating stars: each node links its larger neighbours to its smallest one, then all smaller
    neighbours to the smallest, until nothing changes. A node with many neighbours is aggregated
    before the shuffle and its join may be split, so none has to fit in a task.
    """
    spark = edges.sparkSession
    edges = written(spark, lambda: edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        edges = written(spark, lambda: _round(edges))
        state = edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    large = both.join(low, F.expr("a = n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    joined = large.join(low, F.expr("a = n"))
    small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
    return small.where("a <> b").distinct()
