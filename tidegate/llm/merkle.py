"""Merkle manifest of a dataset whose parents keep their hash states.

Rows are leaves of one tree per group, and the groups' roots are leaves of one more tree.  A parent hashes
the hex texts of its children, one after another, and keeps a copy of the state before each of them.  To
fold a changed leaf, the state before its slot is resumed with the new hash and the right siblings only.

Levels are built in blocks of neighbours: a block is one row and one task's work, whatever
group it belongs to, and its root is a leaf of the blocks above.  Going down again, each block hands its
children the slots, siblings and states on their way to the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm import sha_kernels as sha
from tidegate.llm.common import materialize
from tidegate.operators.keys import unique_lookup
from tidegate.operators.numbering import number_rows

BLOCK = 1024  # leaves of a block at most, unless a parent has more children
_BLOCKS = (
    "grp long, block long, size long, ids array<{id}>, leaves binary, claimed binary, "
    "nodes array<binary>, states array<binary>, root binary"
)
_PATHS = "grp long, block long, path array<binary>, subroot binary, top binary"


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for null, else byte count, ``:`` and the value as text."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _levels(size: int, arity: int) -> int:
    found = 0
    while size > 1:
        size, found = -(-size // arity), found + 1
    return found


def _depth(arity: int, block: int) -> int:
    depth = 1
    while arity ** (depth + 1) <= block:
        depth += 1
    return depth


def _parents(children: np.ndarray, counts: np.ndarray, arity: int):
    """(digests of the parents, parents per block, states before slots 1.. of each parent)."""
    parents = -(-counts // arity)
    block = np.repeat(np.arange(len(counts)), parents)
    nth = np.arange(parents.sum()) - np.repeat(np.cumsum(parents) - parents, parents)
    first = (np.cumsum(counts) - counts)[block] + nth * arity
    present = np.minimum(arity, counts[block] - nth * arity)
    state, kept = sha.starts(len(block)), []
    for slot in range(arity):
        there = np.flatnonzero(present > slot)
        if slot:
            kept.append(state.copy())
        state[:, there] = sha.absorb(state[:, there], sha.hex_block(children[:, first[there] + slot]))
    return sha.finish(state, present), parents, kept


def _binaries(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.to_pylist()]


def _build(arity: int, depth: int, done: int, kind: pa.DataType):
    """Blocks of (ids, leaves) with their nodes and states; ``done`` levels lie below them."""
    def run(batches):
        for batch in batches:
            leaves = _binaries(batch["leaves"])
            n = len(leaves)
            if not n:
                continue
            counts = np.array([len(x) // 32 for x in leaves])
            left = np.array([min(depth, _levels(s, arity) - done) for s in batch["size"].to_pylist()])
            nodes: list[list[bytes]] = [[] for _ in range(n)]
            states: list[list[bytes]] = [[] for _ in range(n)]
            active = np.arange(n)
            level, height = sha.from_bytes(b"".join(leaves)), 0
            roots = [b""] * n
            while len(active):
                ending = left[active] == height
                ends = np.cumsum(counts)
                for b, e in zip(active[ending], ends[ending], strict=True):
                    roots[b] = sha.to_bytes(level[:, e - 1:e])
                if ending.any():
                    level = level[:, np.repeat(~ending, counts)]
                    active, counts = active[~ending], counts[~ending]
                    if not len(active):
                        break
                level, counts, kept = _parents(level, counts, arity)
                ends = np.cumsum(counts)
                digests, kept = sha.to_bytes(level), [sha.to_bytes(k) for k in kept]
                for b, e, c in zip(active, ends, counts, strict=True):
                    part = slice((e - c) * 32, e * 32)
                    nodes[b].append(digests[part])
                    states[b].append(b"".join(k[part] for k in kept))
                height += 1
            yield pa.record_batch({
                "grp": batch["grp"], "block": batch["block"], "size": batch["size"],
                "ids": batch["ids"].cast(pa.list_(kind)), "leaves": batch["leaves"], "claimed": batch["claimed"],
                "nodes": pa.array(nodes, pa.list_(pa.binary())), "states": pa.array(states, pa.list_(pa.binary())),
                "root": pa.array(roots, pa.binary()),
            })

    return run


class _Steps:
    """Slots, siblings and states on the way of each leaf of one block to the block's root."""

    def __init__(self, leaves: bytes, nodes: list[bytes], states: list[bytes], arity: int):
        self.arity = arity
        self.count = len(leaves) // 32
        self.levels = [sha.from_bytes(leaves), *map(sha.from_bytes, nodes)]
        self.states = [sha.from_bytes(s) for s in states]

    def level(self, height: int):
        """(slot, parent, children of it, digests below, states before slots 1..) for each leaf."""
        at = np.arange(self.count) // self.arity ** height
        below = self.levels[height]
        parent = at // self.arity
        present = np.minimum(self.arity, below.shape[1] - parent * self.arity)
        return at % self.arity, parent, present, below, self.states[height]

    def paths(self) -> list[list[bytes]]:
        """For each leaf and level: slot, state before it (32 bytes), other children left to right."""
        found: list[list[bytes]] = [[] for _ in range(self.count)]
        for height in range(len(self.states)):
            slots, parents, present, below, states = self.level(height)
            digests, kept = sha.to_bytes(below), sha.to_bytes(states)
            width = self.levels[height + 1].shape[1]
            for leaf, (slot, parent, n) in enumerate(zip(slots, parents, present, strict=True)):
                first = parent * self.arity
                state = sha.to_bytes(sha.START) if slot == 0 else kept[32 * ((slot - 1) * width + parent):][:32]
                found[leaf].append(
                    bytes([slot]) + state + digests[32 * first:32 * (first + slot)]
                    + digests[32 * (first + slot + 1):32 * (first + n)])
        return found


def _hand_down(arity: int, depth: int, subroots: bool):
    """The paths of each block's children: their steps in the block, then the block's own."""
    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                steps = _Steps(r["leaves"], r["nodes"], r["states"], arity)
                for i, path in enumerate(steps.paths()):
                    place, own = r["block"] * arity ** depth + i, r["subroot"]
                    if subroots:
                        own = r["leaves"][32 * i:32 * (i + 1)]
                    rows.append((r["grp"], place, [*path, *(r["path"] or [])], own, r["top"]))
            grp, block, path, own, top = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            yield pa.record_batch({
                "grp": pa.array(grp, pa.int64()), "block": pa.array(block, pa.int64()),
                "path": pa.array(path, pa.list_(pa.binary())),
                "subroot": pa.array(own, pa.binary()), "top": pa.array(top, pa.binary()),
            })

    return run


def _fold(arity: int, kind: pa.DataType):
    """Every leaf of a block folded to the root from its claimed hash, and the hash of its proof."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                steps = _Steps(r["leaves"], r["nodes"], r["states"], arity)
                now = sha.from_bytes(r["claimed"])
                proof, taken = sha.starts(steps.count), np.zeros(steps.count, np.int64)
                for height in range(len(steps.states)):
                    slots, parents, present, below, states = steps.level(height)
                    width = steps.levels[height + 1].shape[1]
                    state = sha.starts(steps.count)
                    late = np.flatnonzero(slots)
                    state[:, late] = states[:, (slots[late] - 1) * width + parents[late]]
                    state = sha.absorb(state, sha.hex_block(now))
                    for slot in range(arity):
                        right = np.flatnonzero((slot > slots) & (slot < present))
                        if len(right):
                            block = sha.hex_block(below[:, parents[right] * arity + slot])
                            state[:, right] = sha.absorb(state[:, right], block)
                        other = np.flatnonzero((slot != slots) & (slot < present))
                        if len(other):
                            block = sha.hex_block(below[:, parents[other] * arity + slot])
                            proof[:, other] = sha.absorb(proof[:, other], block)
                            taken[other] += 1
                    now = sha.finish(state, present)
                # Above the block all its leaves have the same siblings.
                for step in r["path"] or []:
                    slot, others = step[0], sha.from_bytes(step[33:])
                    state = np.repeat(sha.from_bytes(step[1:33]), steps.count, axis=1)
                    state = sha.absorb(state, sha.hex_block(now))
                    for i in range(others.shape[1]):
                        block = sha.hex_block(others[:, i:i + 1])
                        proof = sha.absorb(proof, block)
                        if i >= slot:
                            state = sha.absorb(state, block)
                    taken += others.shape[1]
                    now = sha.finish(state, np.full(steps.count, others.shape[1] + 1))
                n = steps.count
                yield pa.record_batch({
                    "id": pa.array(r["ids"], kind),
                    "leaf": pa.array(sha.to_hex(sha.from_bytes(r["leaves"]))),
                    "subroot": pa.array([r["subroot"].hex()] * n), "root": pa.array([r["top"].hex()] * n),
                    "proof_sha256": pa.array(sha.to_hex(sha.finish(proof, taken))),
                    "folded_root": pa.array(sha.to_hex(now)),
                })

    return run


def _blocks(rows: DataFrame, arity: int, depth: int, done: int, kind: str) -> DataFrame:
    """Rows (grp, pos, size, id, leaf, claimed), the hashes as bytes, in stored blocks of neighbours."""
    row = F.struct("pos", "id", "leaf", "claimed")
    width = arity ** depth
    grouped = rows.groupBy("grp", F.floor(F.col("pos") / width).alias("block"), "size").agg(
        F.sort_array(F.collect_list(row)).alias("rows"))

    def joined(value) -> Column:
        return F.unhex(F.array_join(F.transform("rows", lambda r: F.hex(value(r))), ""))

    packed = grouped.select(
        "grp", "block", "size", F.col("rows.id").alias("ids"), joined(lambda r: r["leaf"]).alias("leaves"),
        joined(lambda r: F.coalesce(r["claimed"], r["leaf"])).alias("claimed"))
    arrow = rows.select("id").limit(0).toArrow().schema.field("id").type
    return materialize(packed.mapInArrow(_build(arity, depth, done, arrow), _BLOCKS.format(id=kind)), "merkle")


def _climb(rows: DataFrame, arity: int, depth: int, kind: str) -> list[DataFrame]:
    """Blocks of leaves, blocks of their roots, and so on until every group has one block."""
    width = arity ** depth
    largest = rows.agg(F.max("size")).first()[0] or 0
    stories, covered = [], 1
    while True:
        stories.append(_blocks(rows, arity, depth, len(stories) * depth, kind))
        covered *= width
        if largest <= covered:
            return stories
        kind = "long"
        rows = stories[-1].where(F.col("size") > covered).select(
            "grp", F.col("block").alias("pos"), "size", F.lit(None).cast("long").alias("id"),
            F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("claimed"))


@dataclass(frozen=True)
class Manifest:
    """Stored blocks with their states: of the groups' trees and of the tree above them, lowest first."""

    arity: int
    depth: int
    kind: str
    stories: list[DataFrame]
    top: list[DataFrame]

    def root(self) -> str | None:
        """Lowercase hex root of the dataset; None if it has no rows."""
        found = self.top[-1].select(F.lower(F.hex("root"))).first()
        return None if found is None else found[0]

    def _handed_down(self, story: DataFrame, paths: DataFrame, subroots: bool) -> DataFrame:
        met = unique_lookup(story.drop("ids", "claimed", "size"), paths, ["grp", "block"], left_is_unique=True)
        return materialize(met.mapInArrow(_hand_down(self.arity, self.depth, subroots), _PATHS), "paths")

    def folded(self) -> DataFrame:
        """One row per leaf: id, leaf, subroot, root, proof_sha256, folded_root (all lowercase hex)."""
        paths = self.top[-1].select(
            "grp", "block", F.array().cast("array<binary>").alias("path"), F.lit(None).cast("binary").alias("subroot"),
            F.col("root").alias("top"))
        for story in reversed(self.top):
            paths = self._handed_down(story, paths, story is self.top[0])
        # A leaf of the top tree is a group's only block at the group's highest story.
        single = paths.select(F.col("block").alias("grp"), F.lit(0).cast("long").alias("block"), "path", "subroot", "top")
        covered = [self.arity ** (self.depth * (i + 1)) for i in range(len(self.stories))]
        waiting: DataFrame | None = None
        for height in range(len(self.stories) - 1, -1, -1):
            story = self.stories[height]
            ending = story.where(F.col("size") <= covered[height]).select("grp", "block")
            here = single.join(ending, ["grp", "block"], "left_semi")
            paths = here if waiting is None else here.unionByName(waiting)
            if height:
                waiting = self._handed_down(story, materialize(paths, "paths"), False)
        paths = materialize(paths, "paths")
        met = unique_lookup(self.stories[0].drop("size", "root"), paths, ["grp", "block"], left_is_unique=True)
        arrow = self.stories[0].select(F.explode("ids").alias("id")).limit(0).toArrow().schema.field("id").type
        return met.mapInArrow(
            _fold(self.arity, arrow),
            f"id {self.kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def merkle_manifest(
    df: DataFrame, leaf: Column, claimed: Column | None = None, group_col: str = "lang", id_col: str = "doc_id",
    arity: int = 2, block: int = BLOCK,
) -> Manifest:
    """The manifest of all rows, with ``arity`` (2 to 255) children per parent, fewer in a level's last one.

    ``leaf`` is the hex hash of a row (see ``leaf_hash``); ``claimed``, where not null, the hash that a row is
    said to have and that ``folded`` starts from.  In each group leaves ascend by id and leaf, nulls first, so
    repeated ids and repeated rows have a fixed place.  Groups ascend by the bytes of their text, null first;
    a group of one row is its own subroot.  An empty table has no root.  The text itself is hashed where it is
    read and never moves; what moves is about a hundred bytes per row.
    """
    if not 2 <= arity <= 255:
        raise ValueError("a parent has 2 to 255 children")
    depth = _depth(arity, block)
    kind = df.schema[id_col].dataType.simpleString()
    group = F.col(f"`{group_col}`").cast("string")
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    hashed = df.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("key"), F.col(f"`{id_col}`").alias("id"),
        leaf.alias("leaf"), claimed.alias("claimed"))
    changed = F.when(F.col("claimed") != F.col("leaf"), F.unhex("claimed"))
    # Stored before sorting, so that the texts are hashed once.
    narrow = materialize(
        hashed.select("key", "id", F.unhex("leaf").alias("leaf"), changed.alias("claimed")), "leaves")
    placed = number_rows(narrow, ["key", "id", "leaf"], F.lit(-1), "place")
    sizes = placed.groupBy("key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    groups = materialize(number_rows(sizes, ["key"], F.lit(-1), "grp"), "groups")
    rows = unique_lookup(placed, groups, ["key"]).select(
        "grp", (F.col("place") - F.col("first")).alias("pos"), "size", "id", "leaf", "claimed")
    stories = _climb(rows, arity, depth, kind)
    width = arity ** depth
    subroots = None
    for i, story in enumerate(stories):
        alone = F.col("size") <= width ** (i + 1)
        found = story.where(alone if i == 0 else alone & (F.col("size") > width ** i)).select("grp", "root")
        subroots = found if subroots is None else subroots.unionByName(found)
    top = subroots.select(
        F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.lit(groups.count()).cast("long").alias("size"),
        F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("claimed"))
    return Manifest(arity, depth, kind, stories, _climb(top, arity, depth, "long"))
