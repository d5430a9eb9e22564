"""Tables between the steps of an operator, in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The plan is cut there: a lost executor costs the tasks it ran and not the
    steps before, and Spark knows the table's size when it plans the next join.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name (in whatever case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): (node, component), the smallest node of each.

    Alternating large and small star steps: each round hangs every node's
    neighbours on the smallest one, first the larger neighbours, then the
    smaller, until nothing changes (a logarithmic number of rounds).  Minima are
    pre-aggregated and joined back, so no neighbour list is ever gathered.
    Nodes without an edge are not returned; nulls are ignored.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    edges = table(edges)
    before = state(edges)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("u"), "m")
        hung = large.join(least, F.col("b") == F.col("u"))
        edges = table(
            hung.where("a <> m")
            .select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .distinct()
        )
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
