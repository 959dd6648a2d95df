"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the number of their shingles; the partition fixes how many of an item's
least hashes (its bottom-k MinHash sketch) are indexed: so many that a document which holds a
share ``threshold`` of the item holds at least one of them.  Documents, however long, look all
their shingles up in that index, and candidates are verified by exact shingle containment.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import materialize, text_or_empty
from tidegate.llm.word_kernels import PUNCTUATION, by_text, grouped, shingles, word_hashes

WORDS = 5  # of a shingle
THRESHOLD = 0.8
BLOCK = 1_000_000  # shingles of the items that one pass over the documents looks for


def _item_sets(n: int):
    """Distinct shingles; an item of fewer words is one shingle of all its words."""

    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words, at = word_hashes([text.encode()], PUNCTUATION)
                if len(words):
                    size = min(n, len(words))
                    found = np.unique(shingles(words, at, size)[0])
                    out.append((item, size, len(found), found.tobytes()))
            yield pd.DataFrame(out, columns=["item", "words", "n", "hashes"])

    return run


def sketch_size(low: int, high: int, threshold: float) -> int:
    """Least hashes to index for items of ``low`` to ``high`` shingles, without a miss."""
    return max(n - math.ceil(threshold * n - 1e-9) + 1 for n in range(low, high + 1))


class Index:
    """Sketches of items by words of a shingle, for a lookup of sorted hashes."""

    def __init__(self, items: list[tuple], threshold: float):
        self.threshold = threshold
        self.sets = [np.frombuffer(x[3], dtype=np.uint64) for x in items]
        self.ids = [x[0] for x in items]
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({x[1] for x in items}):
            hashes, owners = [], []
            for i, x in enumerate(items):
                if x[1] == size:
                    part = x[2].bit_length()  # partition: sizes from 2^(part-1) to 2^part - 1
                    k = sketch_size(1 << part - 1, min((1 << part) - 1, x[2]), threshold)
                    hashes.append(self.sets[i][:k])
                    owners.append(np.full(len(hashes[-1]), i))
            hashes, owners = np.concatenate(hashes), np.concatenate(owners)
            order = np.argsort(hashes, kind="stable")
            self.tables[size] = hashes[order], owners[order]

    def found(self, words: np.ndarray, text: np.ndarray, n: int):
        """(number of the text, item number, shared shingles)."""
        for size, (hashes, owners) in self.tables.items():
            mine, at = shingles(words, text, size)
            first = np.searchsorted(hashes, mine)
            hit = (first < len(hashes)) & (hashes[np.minimum(first, len(hashes) - 1)] == mine)
            if not hit.any():
                continue
            docs = np.unique(at[hit])
            inside = np.isin(at, docs)
            own = by_text(mine[inside], np.searchsorted(docs, at[inside]), len(docs))
            for d, have in zip(docs, own, strict=True):
                left, right = np.searchsorted(hashes, have), np.searchsorted(hashes, have, side="right")
                spans = [owners[a:b] for a, b in zip(left, right, strict=True) if b > a]
                for i in np.unique(np.concatenate(spans)):
                    want = self.sets[i]
                    place = np.minimum(np.searchsorted(have, want), len(have) - 1)
                    shared = int((have[place] == want).sum())
                    if shared >= self.threshold * len(want) - 1e-9:
                        yield int(d), int(i), shared


def _search(sent):
    def run(batches):
        index = sent.value
        for batch in batches:
            texts = [t.encode() for t in batch["text"]]
            for part in grouped(texts):
                words, at = word_hashes(texts[part], PUNCTUATION)
                ids = batch["id"].iloc[part]
                out = [
                    (ids.iloc[d], index.ids[i], shared, len(index.sets[i]))
                    for d, i, shared in index.found(words, at, len(ids))
                ]
                yield pd.DataFrame(out, columns=["id", "item", "n_shared", "n_item"])

    return run


def _indexes(items: DataFrame, threshold: float, words: int, item_col: str, item_text_col: str, block: int):
    """Broadcast indexes of blocks of items, of about ``block`` hashes each."""
    spark = items.sparkSession
    named = items.select(F.col(item_col).cast("long").alias("item"), text_or_empty(item_text_col).alias("text"))
    sets = materialize(
        named.mapInPandas(_item_sets(words), "item long, words int, n long, hashes binary"), "items")
    total = sets.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block))
    sets = sets.withColumn("block", F.pmod(F.xxhash64("item", "hashes"), F.lit(blocks)))
    for b in range(blocks if total else 0):
        held = [tuple(r) for r in sets.where(F.col("block") == b).select("item", "words", "n", "hashes").collect()]
        if held:
            yield spark.sparkContext.broadcast(Index(held, threshold))


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``threshold`` of the shingles.

    A word is a run of letters, digits and other non-ASCII characters, with A-Z lower-cased; a
    shingle is ``words`` of them, in an item of fewer words all its words.  Returns id, item id,
    n_shared, n_item (distinct shingles of the item) and containment, a row for each
    document row and item row.  Null, empty and wordless texts are in no pair.

    Each pass over the documents takes a block of items with about ``block`` shingles (8 bytes
    each), so what is broadcast does not grow with the benchmark; more items, more passes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, item long, n_shared long, n_item long"
    found = spark.createDataFrame([], schema)
    for sent in _indexes(items, threshold, words, item_col, item_text_col, block):
        found = found.unionAll(rows.mapInPandas(_search(sent), schema))
    return found.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_shared", "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def _clear(sent, text_col: str):
    def run(batches):
        index = sent.value
        for batch in batches:
            texts = [(t or "").encode() for t in batch[text_col]]
            keep = np.ones(len(texts), dtype=bool)
            for part in grouped(texts):
                hashes, at = word_hashes(texts[part], PUNCTUATION)
                keep[[part.start + d for d, _, _ in index.found(hashes, at, part.stop - part.start)]] = False
            yield batch[keep]

    return run


def without_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """The rows, with all their columns, that contain no item as ``contained_items`` finds them."""
    kept = docs
    for sent in _indexes(items, threshold, words, item_col, item_text_col, block):
        kept = kept.mapInPandas(_clear(sent, text_col), docs.schema)
    return kept
