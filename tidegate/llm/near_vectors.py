"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample makes balanced binary codes.  Parts of the code are the
keys of several hash tables; a vector is looked up under its key and all keys one bit away, so
two vectors whose keys differ in up to two bits meet.  What meets is reranked with
the original vectors in double precision.

Vectors within half the linking angle of one vector are all linked with each other.  They form a
cell, and tables hold cells instead of vectors, so a large group of near-equal vectors
is counted without listing its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import components, materialize, unique_keys

COSINE = 0.9
SAMPLE = 20_000  # vectors that the rotation is learned from, at most
ROUNDS = 30
RECALL = 0.995  # expected share of pairs at exactly the least cosine that the tables find
MARGIN = 1e-7  # of angles, for rounding


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Rotate principal axes so that signs lose least (iterative quantisation)."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    rotated = sample @ axes
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(rotated @ turn >= 0, 1.0, -1.0).T @ rotated)
        turn = v.T @ u.T
    return axes @ turn


def table_plan(n: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a table's key, tables) for ``n`` vectors."""
    bits = min(48, max(8, math.ceil(math.log2(max(n, 2)))))
    p = math.acos(cosine) / math.pi
    found = sum(math.comb(bits, d) * p**d * (1 - p) ** (bits - d) for d in range(3))
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def _coded(sent, bits: int, tables: int):
    def run(batches):
        turn = sent.value
        for batch in batches:
            unit = _matrix(batch["vec"])
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            # Cut at zero: a cut at the middle value would run through a group of most vectors.
            signs = unit @ turn[:, : bits * tables] > 0
            weights = 1 << np.arange(bits, dtype=np.int64)
            keys = signs.reshape(len(unit), tables, bits) @ weights
            padded = np.zeros((len(unit), -(-bits * tables // 64) * 64), dtype=np.uint8)
            padded[:, : bits * tables] = signs
            words = np.packbits(padded, axis=1).view(np.int64)
            yield pd.DataFrame({"key": batch["key"], "vec": batch["vec"], "keys": list(keys), "words": list(words)})

    return run


def _cosines(batches):
    """Adds the cosine of va and vb and drops the vectors."""
    for batch in batches:
        if len(batch):
            a, b = _matrix(batch["va"]), _matrix(batch["vb"])
            cosine = np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
        else:
            cosine = np.zeros(0)
        yield batch.drop(columns=["va", "vb"]).assign(cosine=cosine)


def _with_cosine(pairs: DataFrame, vectors: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` and the cosine of the vectors that columns ``a`` and ``b`` name."""
    both = pairs.join(vectors.select(F.col("key").alias(a), F.col("vec").alias("va")), a)
    both = both.join(vectors.select(F.col("key").alias(b), F.col("vec").alias("vb")), b)
    columns = [*pairs.columns, "va", "vb"]
    kinds = dict(both.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in pairs.columns) + ", cosine double"
    return both.select(*columns).mapInPandas(_cosines, schema)


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))


def _cells(coded: DataFrame, half: float) -> DataFrame:
    """(key, cell, angle): the vector at a cell's centre is within ``half`` of all in it."""
    at = coded.select("key", F.posexplode("keys").alias("table", "tkey"))
    pivots = at.groupBy("table", "tkey").agg(F.min("key").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    asked = at.join(pivots, ["table", "tkey"]).where("pivot < key").select("key", "pivot").distinct()
    vectors = coded.select("key", "vec")

    def nearest(asked: DataFrame) -> DataFrame:
        found = _with_cosine(asked, vectors, "key", "pivot").withColumn("angle", _angle(F.col("cosine")))
        return found.where(F.col("angle") <= half - MARGIN).groupBy("key").agg(
            F.min(F.struct("pivot", "angle")).alias("best")).select("key", "best.pivot", "best.angle")

    leader = materialize(nearest(asked), "leaders")
    for _ in range(2):  # to the leader's leader, where that is near enough
        further = leader.alias("a").join(leader.select(F.col("key").alias("pivot"), F.col("pivot").alias("next")), "pivot")
        moved = nearest(further.select("key", F.col("next").alias("pivot")))
        leader = materialize(leader.unionByName(moved).groupBy("key").agg(
            F.min(F.struct("pivot", "angle")).alias("best")).select("key", "best.pivot", "best.angle"), "leaders")
    return coded.select("key").join(leader, "key", "left").select(
        "key", F.coalesce("pivot", "key").alias("cell"), F.coalesce("angle", F.lit(0.0)).alias("angle"))


def near_vectors(
    df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = SAMPLE, seed: int = 11,
) -> DataFrame:
    """Links between vectors with a cosine of at least ``cosine``, counted, and what they connect.

    Returns id, n_links (other vectors linked directly), component_id (smallest id that links
    reach) and kept (the id is the component's).  One row for each input row.  Every link that is
    counted has been verified or follows from the triangle inequality of angles; the tables
    miss some pairs near the least cosine (at most about 1 - ``RECALL`` of them).

    Vectors that are null, zero or hold null or non-finite components link with nothing, and
    vectors only with vectors of their length.  Rows equal in id and vector are one vector; rows that share only the id are
    vectors of their own.  Null ids count as the smallest.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    named, rows = unique_keys(df, id_col, F.col(vector_col).cast("array<double>"))
    named = named.withColumnRenamed("text", "vec")
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # A vector beyond the range of double squares is scaled first.
    top = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    valid = named.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(sound).where(top > 0).withColumn(
        "vec", F.transform("vec", lambda x: x / top))
    # A length of one vector has no link.
    lengths = valid.groupBy(F.size("vec").alias("size")).count().where("count > 1").orderBy("size").collect()
    half = math.acos(cosine) / 2
    links = spark.createDataFrame([], "key long, n_links long, component long")
    if len(lengths) > 1:
        valid = materialize(valid, "valid")
    for length in lengths:  # each with a rotation of its own
        own = valid.where(F.size("vec") == length["size"])
        links = links.unionByName(_linked(own, length["size"], length["count"], cosine, half, sample, seed))
    result = named.select("key").join(links, "key", "left").select(
        "key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "key").alias("component"))
    if rows is None:
        return result.select(
            F.col("key").alias(id_col), "n_links", F.col("component").alias("component_id"),
            (F.col("key") == F.col("component")).alias("kept"))
    names = rows.distinct().select(F.col("key").alias("component"), F.col("id").alias("component_id"))
    return rows.join(result, "key").join(names, "component").select(
        F.col("id").alias(id_col), "n_links", "component_id", (F.col("key") == F.col("component")).alias("kept"))


def _linked(valid: DataFrame, size: int, n: int, cosine: float, half: float, sample: int, seed: int) -> DataFrame:
    spark = valid.sparkSession
    bits, tables = table_plan(n, cosine)
    share = min(1.0, sample / n)
    chosen = valid.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * share)).limit(sample)
    learned = _matrix(pd.Series([r["vec"] for r in chosen.select("vec").collect()] or [[1.0] * size]))
    learned /= np.linalg.norm(learned, axis=1, keepdims=True)
    turn = np.concatenate(
        [learn_rotation(learned, seed + i) for i in range(-(-bits * tables // size))], axis=1)
    sent = spark.sparkContext.broadcast(turn)  # vector length by code length
    n_words = -(-bits * tables // 64)
    coded = materialize(valid.mapInPandas(
        _coded(sent, bits, tables), "key long, vec array<double>, keys array<long>, words array<long>"), "codes")
    member = materialize(_cells(coded, half), "cells")
    vectors = coded.select("key", "vec")

    cells = member.groupBy("cell").agg(F.count("*").alias("size"), F.max("angle").alias("radius"))
    words = [F.col("words")[i].alias(f"w{i}") for i in range(n_words)]
    cells = materialize(
        cells.join(coded.select(F.col("key").alias("cell"), *words), "cell"), "centres")
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(bits)]).cast("array<long>")
    asked = coded.join(member.select("key", "cell"), "key").select(
        "cell", F.posexplode("keys").alias("table", "own")).select(
        "cell", "table", "own", F.explode(flips).alias("flip")).select(
        "cell", "table", F.col("own").bitwiseXOR(F.col("flip")).alias("tkey")).distinct()
    held = asked.join(cells, "cell")
    a = held.select("table", "tkey", *[F.col(c).alias("a_" + c) for c in cells.columns])
    b = held.select("table", "tkey", *[F.col(c).alias("b_" + c) for c in cells.columns])
    apart = sum(
        (F.bit_count(F.col(f"a_w{i}").bitwiseXOR(F.col(f"b_w{i}"))) for i in range(1, n_words)),
        F.bit_count(F.col("a_w0").bitwiseXOR(F.col("b_w0"))))
    p = F.least((F.col("a_radius") + F.col("b_radius") + 2 * half) / math.pi, F.lit(0.5))
    most = bits * tables * p + 4 * F.sqrt(bits * tables * p * (1 - p))
    # The whole code must be near too; cells of one vector (radius 0) leave few pairs here.
    met = a.alias("a").join(b.alias("b"), (
        (F.col("a.table") == F.col("b.table")) & (F.col("a.tkey") == F.col("b.tkey"))
        & (F.col("a_cell") < F.col("b_cell")) & (apart <= most)
    )).select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b"))
    # A centre that went to another cell keeps its cell and that one together.
    strayed = member.where("cell != key").join(cells.select(F.col("cell").alias("key")), "key").select(
        F.least("key", "cell").alias("a"), F.greatest("key", "cell").alias("b"))
    pairs = met.unionAll(strayed).distinct()

    facts = cells.select("cell", "size", "radius")
    judged = _with_cosine(pairs, vectors, "a", "b")
    judged = judged.join(facts.select(F.col("cell").alias("a"), F.col("size").alias("a_size"), F.col("radius").alias("a_r")), "a")
    judged = judged.join(facts.select(F.col("cell").alias("b"), F.col("size").alias("b_size"), F.col("radius").alias("b_r")), "b")
    angle, whole = _angle(F.col("cosine")), 2 * half
    exact = (F.col("a_r") == 0) & (F.col("b_r") == 0)
    judged = materialize(judged.withColumn("verdict", F.when(
        exact, F.when(F.col("cosine") >= cosine, 1).otherwise(0)
    ).when(angle + F.col("a_r") + F.col("b_r") <= whole - MARGIN, 1).when(
        angle - F.col("a_r") - F.col("b_r") > whole + MARGIN, 0).otherwise(2)), "judged")
    full = judged.where("verdict = 1")
    # Undecided: members of the larger cell against the centre of the smaller, then each pair left.
    swap = F.col("a_size") < F.col("b_size")
    open_ = judged.where("verdict = 2").select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("big"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("small"),
        F.when(swap, F.col("a_r")).otherwise(F.col("b_r")).alias("r"), F.least("a_size", "b_size").alias("n"))
    tried = _with_cosine(open_.join(member.select(F.col("cell").alias("big"), "key"), "big"), vectors, "key", "small")
    tried = materialize(tried.withColumn("verdict", F.when(
        _angle(F.col("cosine")) + F.col("r") <= whole - MARGIN, 1).when(
        _angle(F.col("cosine")) - F.col("r") > whole + MARGIN, 0).otherwise(2)), "tried")
    near = tried.where("verdict = 1")
    each = tried.where("verdict = 2").select("big", "small", "key").join(
        member.select(F.col("cell").alias("small"), F.col("key").alias("other")), "small")
    each = materialize(_with_cosine(each, vectors, "key", "other").where(F.col("cosine") >= cosine), "each")

    by_cell = full.select(F.col("a").alias("cell"), F.col("b_size").alias("n")).unionAll(
        full.select("b", "a_size")).unionAll(near.groupBy("small").count()).groupBy("cell").agg(F.sum("n").alias("by_cell"))
    by_key = near.select("key", "n").unionAll(each.groupBy("key").count()).unionAll(
        each.groupBy("other").count()).groupBy("key").agg(F.sum("n").alias("by_key"))
    edges = full.select("a", "b").unionAll(near.select("big", "small")).unionAll(each.select("big", "small")).distinct()
    joined = components(edges).select(F.col("node").alias("cell"), "component")
    placed = member.join(facts.select("cell", "size"), "cell").join(by_cell, "cell", "left").join(joined, "cell", "left")
    placed = placed.withColumn("component", F.coalesce("component", "cell"))
    least = placed.groupBy("component").agg(F.min("key").alias("least"))
    return placed.join(least, "component").join(by_key, "key", "left").select(
        "key", (F.col("size") - 1 + F.coalesce("by_cell", F.lit(0)) + F.coalesce("by_key", F.lit(0))).alias("n_links"),
        F.col("least").alias("component"))
