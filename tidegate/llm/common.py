"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.numbering import number_rows
from tidegate.runtime import materialize

__all__ = ["back_to_rows", "components", "lower_ascii", "materialize", "read_table", "small_batches", "text_or_empty", "unique_keys"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def unique_keys(df: DataFrame, id_col: str, text: Column) -> tuple[DataFrame, DataFrame | None]:
    """(key, text) with one row per key, and what leads from rows back to keys.

    ``text`` may be a column of another type that has a string form.

    Where every id is there once, the key is the id and the second value is None.  Otherwise
    rows equal in id and text are one document, and the keys number the distinct
    (id, digest of the text) in that order, nulls first; the second value has one row
    (id, key) for each input row.
    """
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    odd = ids.groupBy("id").count().where("id IS NULL OR count > 1")
    if odd.isEmpty():
        return df.select(F.col(id_col).cast("long").alias("key"), text.alias("text")), None
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn(
        "digest", F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit("")))
    numbered = materialize(number_rows(
        rows.select("id", "digest").distinct(), ["id", "digest"], F.lit(-1), "key"), "keys")
    same = rows["id"].eqNullSafe(numbered["id"]) & (rows["digest"] == numbered["digest"])
    keyed = rows.join(numbered, same).select(rows["id"], "key", "text")
    return keyed.dropDuplicates(["key"]).select("key", "text"), keyed.select("id", "key")


def back_to_rows(result: DataFrame, rows: DataFrame | None, id_col: str) -> DataFrame:
    """The result of each key for every input row, under the id."""
    if rows is None:
        return result.withColumnRenamed("key", id_col)
    return rows.join(result, "key").drop("key").withColumnRenamed("id", id_col)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for nodes that have a link.

    ``edges`` has two long columns.  Alternating star contraction: every node hands its larger,
    then its smaller neighbours to the smallest of them, until nothing changes.  Each round
    is a partly aggregated minimum and a join, and is stored.
    """
    a, b = edges.columns
    stars = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct()
    stars, seen = _stored(stars)
    while True:
        both = stars.unionAll(stars.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).withColumn("m", F.least("m", "hi"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        # A node without a larger neighbour keeps its link to its smallest one.
        large = large.unionAll(least.where("m < hi").select("hi", F.col("m").alias("lo"))).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.where("hi > lo").unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()
        stars, now = _stored(small)
        if now == seen:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
                stars.select("lo", "lo").distinct())
        seen = now


def _stored(stars: DataFrame) -> tuple[DataFrame, tuple]:
    kept = materialize(stars, "stars")
    return kept, tuple(kept.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
