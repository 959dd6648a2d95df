"""Merkle manifest against a tree built with hashlib alone."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import sha_kernels as sha
from tidegate.llm.merkle import leaf_hash, merkle_manifest

SCHEMA = "doc_id long, lang string, leaf string, claimed string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + arity])) for i in range(0, len(last), arity)])
    return levels


def brute_force(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in order}
    trees = {g: tree([r[2] for r in leaves[g]], arity) for g in order}
    top = tree([trees[g][-1][0] for g in order], arity)
    found = []
    for place, g in enumerate(order):
        for i, row in enumerate(leaves[g]):
            siblings, now = [], row[3] or row[2]
            for levels, at in ((trees[g], i), (top, place)):
                for level in levels[:-1]:
                    first = at // arity * arity
                    run, slot = level[first:first + arity], at - first
                    siblings += run[:slot] + run[slot + 1:]
                    now = digest("".join([*run[:slot], now, *run[slot + 1:]]))
                    at //= arity
            found.append((row[0], row[2], trees[g][-1][0], top[-1][0], digest("".join(siblings)), now))
    return sorted(found, key=repr)


def test_states_resume():
    data = [os.urandom(32) for _ in range(50)]
    block = sha.hex_block(sha.from_bytes(b"".join(data)))
    state, n = sha.starts(50), np.zeros(50, np.int64)
    for times in range(4):
        wanted = [digest(d.hex() * times) for d in data]
        assert sha.to_hex(sha.finish(state, n)) == wanted
        state, n = sha.absorb(sha.from_bytes(sha.to_bytes(state)), block), n + 1


@pytest.mark.parametrize(("arity", "block", "n"), [(2, 4, 60), (3, 9, 60), (2, 1024, 40), (2, 2, 25), (5, 3, 30)])
def test_against_hashlib(spark, arity, block, n):
    pick = random.Random(arity * 100 + n)
    rows = []
    for i in range(n):
        leaf = digest(str(pick.randint(0, n)))
        rows.append((
            pick.choice([None, pick.randint(0, 40)]) if pick.random() < 0.3 else i,
            pick.choice([None, "en", "en", "en", "de", "", "é", "fr", "=", "\U0001f600", "￿"]),
            leaf, digest("x" + leaf) if pick.random() < 0.2 else pick.choice([None, leaf])))
    df = spark.createDataFrame(rows, SCHEMA)
    manifest = merkle_manifest(df, F.col("leaf"), F.col("claimed"), arity=arity, block=block)
    wanted = brute_force(rows, arity)
    assert sorted((tuple(r) for r in manifest.folded().collect()), key=repr) == wanted
    assert manifest.root() == wanted[0][3]


def test_leaf_hash(spark):
    df = spark.createDataFrame([(1, "é", None), (None, "", "x" * 3_000_000)], "a long, b string, c string")
    got = [r[0] for r in df.select(leaf_hash([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [digest("1:12:é-"), digest("-0:3000000:" + "x" * 3_000_000)]


def test_edges(spark):
    empty = merkle_manifest(spark.createDataFrame([], SCHEMA), F.col("leaf"))
    assert empty.root() is None and empty.folded().count() == 0
    leaf = digest("a")
    one = spark.createDataFrame([(5, None, leaf, None)], SCHEMA)
    assert [tuple(r) for r in merkle_manifest(one, F.col("leaf")).folded().collect()] == [
        (5, leaf, leaf, leaf, digest(""), leaf)]
    rows = [(1, "en", leaf, None)] * 3 + [(1, "de", leaf, None)]
    clashing = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", key string, grp int, place int")
    got = merkle_manifest(clashing, F.col("leaf")).folded()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows, 2)
    with pytest.raises(ValueError):
        merkle_manifest(one, F.col("leaf"), arity=1)
