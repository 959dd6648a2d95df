"""Repeated byte strings across documents, by a recursive external sort of sampled suffixes.

Suffixes are sampled where the hashed name of their first bytes is a local minimum (the LMS
rule on names instead of bytes), about one in 35.  Spark sorts the sampled tuples (name,
common prefix class, document, place) externally; the order of equal neighbours is then
induced for all the suffixes between two samples at once: a run of windows that has the same
covering string as an earlier run is repeated as a whole.  Runs that share the name but not the
covering string go to the next level with a finer sample, down to single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import back_to_rows, materialize, text_or_empty, unique_keys
from tidegate.llm.suffix_kernels import BASES, Hasher, mixed, territories

LENGTH = 100  # bytes of a string that counts as repeated
NAME = 24  # bytes of a suffix that its name is made of
STEP = 12  # windows of a run of the second level
PIECE = 2_000_000  # bytes that are hashed at once

TUPLE = "core long, cover long, flag byte, key long, code long"


def _code(start: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Place of a run of windows: first start, then distance to the sampled suffix and count."""
    return (start << 16) | (anchor << 8) | count


def _spread(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mixed(key.astype(np.uint64) * np.uint64(BASES[0]) + code.astype(np.uint64))


def _tuples(core, cover, key, code) -> pd.DataFrame:
    """Tuples to sort, after what is known within these rows is settled.

    flag 1: an earlier row here has the same cover, so the run is repeated.  flag 2: rows here
    have the core with other covers, so the run goes to the next level; the first two of
    those stay unflagged, for the rows elsewhere to meet.  Flagged rows get a core of their
    own, so that a frequent core sends two rows from here and not all.
    """
    order = np.lexsort((code, key, cover, core))
    core, cover, key, code = core[order], cover[order], key[order], code[order]
    new_core = np.ones(len(core), dtype=bool)
    new_core[1:] = core[1:] != core[:-1]
    new_cover = new_core.copy()
    new_cover[1:] |= cover[1:] != cover[:-1]
    covers = np.cumsum(new_cover)
    nth = covers - covers[np.flatnonzero(new_core)][np.cumsum(new_core) - 1] if len(core) else covers
    flag = np.where(~new_cover, 1, np.where(nth >= 2, 2, 0)).astype(np.int8)
    own = flag > 0
    core[own] = _spread(key[own], code[own])
    return pd.DataFrame({
        "core": core.view(np.int64), "cover": cover.view(np.int64), "flag": flag, "key": key, "code": code,
    })


def _pieces(keys: list[int], texts: list[bytes], length: int) -> Iterator[tuple]:
    """(keys, offset in the text, bytes) in pieces of bounded size; long texts overlap."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for key, text in zip(keys, texts, strict=True):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1]
            if size and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((key, at, part))
            size += len(part)
    if held:
        yield held


def _joined(held) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(x[2] for x in held), dtype=np.uint8)
    bounds = np.zeros(len(held) + 1, dtype=np.int64)
    np.cumsum([len(x[2]) for x in held], out=bounds[1:])
    return data, bounds, np.array([x[0] for x in held], dtype=np.int64), np.array([x[1] for x in held], dtype=np.int64)


def _first_level(length: int, name: int):
    def run(batches):
        for batch in batches:
            for held in _pieces(batch["key"].tolist(), [t.encode() for t in batch["text"]], length):
                data, bounds, keys, ats = _joined(held)
                text, first, last, anchor, names, cover = territories(data, bounds, length, name)
                code = _code(first - bounds[text] + ats[text], anchor - first, last - first + 1)
                yield _tuples(names, cover, keys[text], code)

    return run


def _packed(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pd.DataFrame({"key": batch["key"], "packed": [pack(t.encode()) for t in batch["text"]]})


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bytes(packed))


def _pending(batch: pd.DataFrame, length: int) -> Iterator[tuple]:
    """(data, key, start, anchor, count) of runs in pieces, starts relative to the data."""
    for key, packed, codes in zip(batch["key"], batch["packed"], batch["codes"], strict=True):
        codes = np.sort(np.asarray(codes, dtype=np.int64))
        start, anchor, count = codes >> 16, codes >> 8 & 255, codes & 255
        text = np.frombuffer(_unpacked(packed), dtype=np.uint8)
        begin = 0
        while begin < len(codes):
            base = start[begin]
            end = int(np.searchsorted(start, base + PIECE))
            # the runs, their windows and the sampled suffix's name all lie in here
            part = text[base : base + PIECE + 2 * length + 512]
            yield part, key, int(base), start[begin:end] - base, anchor[begin:end], count[begin:end]
            begin = end


def _second_level(length: int, name: int, step: int):
    """Runs cut at fixed distances from their sampled suffix.

    The core is what all windows of a whole such run share, the cover what these windows
    cover: a window can be repeated only if its core is there twice.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for part, key, base, start, anchor, count in _pending(batch, length):
                which = np.repeat(np.arange(len(start)), anchor // step - (anchor - count + 1) // step + 1)
                top = anchor[which] // step
                new = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
                nth = top - (np.arange(len(which)) - np.repeat(new, np.diff(np.r_[new, len(which)])))
                at = start[which] + anchor[which]
                far = np.minimum(nth * step + step - 1, anchor[which])  # the distances of these windows
                near = np.maximum(nth * step, anchor[which] - count[which] + 1)
                end = at - np.minimum(nth * step + step - 1, length - name) + length
                core = Hasher(part, BASES[0]).at(at - nth * step, end) + nth.astype(np.uint64)
                cover = Hasher(part, BASES[1]).at(at - far, at - near + length)
                rows.append((core, cover, np.full(len(at), key), _code(at - far + base, far, far - near + 1)))
            if rows:
                yield _tuples(*map(np.concatenate, zip(*rows, strict=True)))

    return run


def _last_level(length: int):
    """Single windows, named by two hashes of the whole window."""

    def run(batches):
        for batch in batches:
            rows = []
            for part, key, base, start, _, count in _pending(batch, length):
                ends = np.cumsum(count)
                at = np.repeat(start - (ends - count), count) + np.arange(ends[-1])
                core = Hasher(part, BASES[0]).at(at, at + length)
                cover = Hasher(part, BASES[1]).at(at, at + length)
                rows.append((core, cover, np.full(len(at), key), _code(at + base, np.zeros_like(at), np.ones_like(at))))
            if rows:
                yield _tuples(*map(np.concatenate, zip(*rows, strict=True)))

    return run


def _sorted_out(tuples: DataFrame) -> DataFrame:
    """(key, repeated, open): codes of runs repeated as a whole, and of runs for the next level.

    One shuffle and one external sort by (core, cover, document, place).
    """
    same = Window.partitionBy("core", "cover").orderBy("key", "code")
    core = Window.partitionBy("core")
    found = (
        tuples.repartition("core")
        .withColumn("nth", F.row_number().over(same))
        .withColumn("varied", F.min("cover").over(core) != F.max("cover").over(core))
    )
    repeated = (F.col("flag") == 1) | (F.col("nth") > 1)
    still = ~repeated & ((F.col("flag") == 2) | F.col("varied"))
    return found.where(repeated | still).groupBy("key").agg(
        F.collect_list(F.when(repeated, F.col("code"))).alias("repeated"),
        F.collect_list(F.when(still, F.col("code"))).alias("open"),
    )


def _assembled(length: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for packed, *lists in zip(batch["packed"], batch["r1"], batch["r2"], batch["r3"], strict=True):
                text = _unpacked(packed)
                codes = [np.asarray(x, dtype=np.int64) for x in lists if x is not None and len(x)]
                kept, spans = text, 0
                if codes:
                    codes = np.concatenate(codes)
                    begin, end = codes >> 16, (codes >> 16) + (codes & 255) - 1 + length
                    edge = np.zeros(len(text) + 1, dtype=np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, end, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            out.insert(0, "key", batch["key"].to_numpy())
            yield out if keep_text else out.drop(columns="kept")

    return run


def suffix_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    name: int = NAME, keep_text: bool = False,
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier.

    Earlier is a smaller id, or a smaller start in the same document; strings overlap and are
    judged on the input.  Returns id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, with ``keep_text``, kept (binary: bytes cut within a character may not
    be text).  ``length`` is at most 200 and at least ``name`` + 8.

    A null text is empty.  Null ids come first.  Rows with the same id are ordered by the
    digest of their texts; rows equal in id and text are one document and get the same
    result.  Empty texts and tables give zero counts and no rows.  Other columns are ignored.
    """
    if not name + 8 <= length <= 200:
        raise ValueError("length must be from name + 8 to 200")
    docs, rows = unique_keys(df, id_col, text_or_empty(text_col))
    first = materialize(_sorted_out(docs.mapInPandas(_first_level(length, name), TUPLE)), "runs")
    # Joined by key three times in one plan: Spark writes this shuffle once.
    packed = docs.mapInPandas(_packed, "key long, packed binary").repartition("key")

    def deeper(found: DataFrame, level) -> DataFrame:
        waiting = found.where(F.size("open") > 0).select("key", F.col("open").alias("codes"))
        return _sorted_out(packed.join(waiting, "key").mapInPandas(level, TUPLE))

    second = deeper(first, _second_level(length, name, STEP))
    third = deeper(second, _last_level(length))
    whole = packed
    for n, found in enumerate((first, second, third), 1):
        whole = whole.join(found.select("key", F.col("repeated").alias(f"r{n}")), "key", "left")
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    result = whole.mapInPandas(_assembled(length, keep_text), schema + ", kept binary" * keep_text)
    return back_to_rows(result, rows, id_col)
