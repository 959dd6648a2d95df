"""Similarity join of documents on word n-grams: a grouped prefix join.

Documents with the same shingle set are one class.  Of each class the prefix is taken: so many of
its shingles, rarest first, that two similar sets share one.  Classes with the same prefix and
size form one group; groups that share a prefix shingle are paired and filtered, then expanded
to members, which are verified on their whole sets.  Members are first compared with one
pivot, so that in a large group of copies most pairs are known to be connected
before pairs are listed at all.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import components, materialize, text_or_empty, unique_keys
from tidegate.llm.suffix_kernels import mixed
from tidegate.llm.word_kernels import SPACES, by_text, grouped, shingles, word_hashes

WORDS = 5
SIMILARITY = 80  # per cent
MOST_FREQUENT = 100_000  # entries of the table of frequent shingles; it only sets an order
COUNTED = 2_000_000  # shingles that are counted together in a task
SEEN = 3  # a shingle found so often among them goes to that table
SKETCH = 8  # 64-bit words


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words, all words as one shingle."""
    hashes, text = word_hashes(texts, SPACES)
    values, at = shingles(hashes, text, words)
    count = np.bincount(text, minlength=len(texts))
    for size in range(1, words):
        few = np.flatnonzero(count == size)
        if len(few):
            inside = np.isin(text, few)
            more, there = shingles(hashes[inside], text[inside], size)
            values, at = np.concatenate([values, more + np.uint64(size)]), np.concatenate([at, there])
    return by_text(values, at, len(texts))


def _digests(found: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = mixed(found + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
        b = mixed(found ^ np.uint64(0x8EBC6AF09C88C6E3)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _often(held: list[np.ndarray]):
    """Rows with n = -1 of shingles of several texts and their counts, a thousand in each."""
    values, counts = np.unique(np.concatenate(held), return_counts=True)
    many = counts >= SEEN
    values, counts = values[many].view(np.int64), counts[many]
    for i in range(0, len(values), 50_000):
        cuts = range(i, min(i + 50_000, len(values)), 1_000)
        yield pd.DataFrame({
            "key": 0, "n": -1, "d1": 0, "d2": 0,
            "often": [values[c : c + 1_000] for c in cuts], "times": [counts[c : c + 1_000] for c in cuts]})


def _profiles(words: int):
    """(key, n, d1, d2) of each text, and rows of ``_often``."""

    def run(batches):
        columns = ["key", "n", "d1", "d2", "often", "times"]
        none = np.zeros(0, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            texts = [t.encode() for t in batch["text"]]
            rows = []
            for part in grouped(texts):
                sets = shingle_sets(texts[part], words)
                held += sets
                size += sum(map(len, sets))
                rows += [(len(s), *_digests(s), none, none) for s in sets]
                if size > COUNTED:
                    yield from _often(held)
                    held, size = [], 0
            out = pd.DataFrame(rows, columns=columns[1:])
            out.insert(0, "key", batch["key"].to_numpy())
            yield out
        if held:
            yield from _often(held)

    return run


def prefix_length(n: int, similarity: int) -> int:
    """Sets of at least this similarity share one of so many first shingles, in any common order."""
    return n - -(-similarity * n // 100) + 1


def _prefixes(sent, words: int, similarity: int):
    def run(batches):
        known, frequency = sent.value
        for batch in batches:
            texts = [t.encode() for t in batch["text"]]
            keys = batch["key"].tolist()
            for part in grouped(texts):
                rows = []
                for key, own in zip(keys[part], shingle_sets(texts[part], words), strict=True):
                    n = len(own)
                    if not n:
                        continue
                    times = np.zeros(n, dtype=np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        times = np.where(known[at] == own, frequency[at], 0)
                    order = np.lexsort((own, times))[: prefix_length(n, similarity)]
                    first = own[order]
                    bits = mixed(own)
                    size = 1 << max(64 * SKETCH - 1, n - 1).bit_length()
                    flips = (np.bincount((bits % np.uint64(size)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
                    wide = np.packbits(flips)
                    sketch = np.packbits(np.bitwise_xor.reduce(flips.reshape(-1, 64 * SKETCH))).view(np.int64)
                    rows.append((key, n, int((times == 0).sum()), *_digests(first), first.view(np.int64), wide.tobytes(), *sketch))
                yield pd.DataFrame(rows, columns=[
                    "key", "n", "rare", "p1", "p2", "prefix", "wide", *(f"s{i}" for i in range(SKETCH))])

    return run


def _packed(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pd.DataFrame({"key": batch["key"], "packed": [pack(t.encode()) for t in batch["text"]]})


def _verified(words: int, similarity: int):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keys = pd.unique(pd.concat([batch["a"], batch["b"]]))
            texts = dict(zip(batch["a"], batch["ta"], strict=True)) | dict(zip(batch["b"], batch["tb"], strict=True))
            sets, raw = {}, [unpack(bytes(texts[k])) for k in keys]
            for part in grouped(raw):
                sets |= dict(zip(keys[part], shingle_sets(raw[part], words), strict=True))
            rows = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                x, y = sets[a], sets[b]
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                if 100 * shared >= similarity * (len(x) + len(y) - shared):
                    rows.append((a, b))
            yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

    return run


def _near_wide(similarity: int):
    """Pairs that sketches of about a bit for each shingle do not tell apart either.

    The wider of two sketches is folded: a part's parity is that of its parts.
    """

    def run(batches):
        for batch in batches:
            keep = []
            for total, x, y in zip(batch["total"], batch["wa"], batch["wb"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                size = min(len(x), len(y))
                x, y = (np.bitwise_xor.reduce(v.reshape(-1, size)) for v in (x, y))
                bits = int(np.bitwise_count(x ^ y).sum())
                keep.append(bits * (100 + similarity) <= total * (100 - similarity))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return run


def _sized(a: Column, b: Column, similarity: int) -> Column:
    return (100 * F.least(a, b)) >= (similarity * F.greatest(a, b))


def _near(left: str, right: str, similarity: int) -> Column:
    """No proof that the sets differ in too many shingles.

    A sketch is the parity of shingles by bit, so two sets differ in at least as many
    shingles as their sketches do in bits.
    """
    bits = reduce(lambda x, y: x + y, [
        F.bit_count(F.col(f"{left}s{i}").bitwiseXOR(F.col(f"{right}s{i}"))) for i in range(SKETCH)])
    total = F.col(f"{left}n") + F.col(f"{right}n")
    return bits * (100 + similarity) <= total * (100 - similarity)


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def similar_documents(
    df: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Connected groups of documents whose shingle sets have a Jaccard similarity of ``similarity`` per cent.

    A word is `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, a shingle ``words`` of them; a text of fewer words
    has one shingle of all its words.  Returns id, n_shingles and component_id, the smallest id that
    links reach, one row for each input row.

    Null, empty and wordless texts have no shingle and are linked with nothing: their component is
    their id.  Null ids count as the smallest.  Rows equal in id and text are one document.
    An empty table gives an empty result.
    """
    spark = df.sparkSession
    docs, rows = unique_keys(df, id_col, text_or_empty(text_col))
    profiles = materialize(docs.mapInPandas(
        _profiles(words), "key long, n long, d1 long, d2 long, often array<long>, times array<long>"), "profiles")
    classes = materialize(
        profiles.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("key").alias("class")), "classes")
    often = profiles.where("n = -1").select(F.explode(F.arrays_zip("often", "times")).alias("x")).groupBy(
        F.col("x.often").alias("shingle")).agg(F.sum("x.times").alias("n"))
    profiles = profiles.where("n >= 0").drop("often", "times")
    # As Arrow columns: a task picks the most frequent ones, and the driver gets 16 bytes an entry and no row objects.
    often = often.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).toArrow()
    known, frequency = often["shingle"].to_numpy().view(np.uint64), often["n"].to_numpy()
    order = np.argsort(known)
    sent = spark.sparkContext.broadcast((known[order], frequency[order]))
    sketch = ", ".join(f"s{i} long" for i in range(SKETCH))
    prefixes = docs.mapInPandas(
        _prefixes(sent, words, similarity),
        f"key long, n long, rare long, p1 long, p2 long, prefix array<long>, wide binary, {sketch}")
    # Sets this small are similar only if equal, and equal sets are one class.
    least = next(n for n in range(1, 10_000) if 100 * n >= similarity * (n + 1))
    prefixes = prefixes.where(F.col("n") >= least).join(
        classes.select(F.col("class").alias("key")), "key", "left_semi")
    members = materialize(prefixes, "prefixes")

    # Groups: the same prefix and size.  The pivot has fewest rare shingles: the least edited.
    groups = members.groupBy("n", "p1", "p2").agg(
        F.min(F.struct("rare", "key")).alias("pivot"), F.count("*").alias("size"), F.min("key").alias("group"))
    of_group = materialize(
        members.drop("prefix", "wide").join(groups, ["n", "p1", "p2"]).withColumn("pivot_rare", F.col("pivot.rare"))
        .withColumn("pivot", F.col("pivot.key")).drop("p1", "p2"), "groups")
    tokens = members.select("key", F.explode("prefix").alias("token")).join(
        of_group.where("key = group").select("key", "n", "pivot", "pivot_rare"), "key")
    first = tokens.groupBy("token").agg(
        F.count("*").alias("groups"), F.min(F.struct("pivot_rare", "pivot")).alias("best")).where("groups > 1")
    shared = materialize(tokens.join(first, "token").select(
        "token", F.col("key").alias("group"), "n", F.col("best.pivot").alias("pivot")), "tokens")

    facts = of_group.select("key", "n", *(f"s{i}" for i in range(SKETCH)))
    ways = shared.select("group", "pivot").unionAll(
        of_group.where("size > 1 AND key = group").select("group", "pivot")).distinct()
    pairs = of_group.select("group", "key").join(ways, "group").where("key != pivot").select("key", "pivot").distinct()
    pairs = pairs.join(_renamed(facts, "a_"), F.col("key") == F.col("a_key")).join(
        _renamed(facts, "b_"), F.col("pivot") == F.col("b_key"))
    bits = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(SKETCH)])
    pairs = pairs.where(_sized(F.col("a_n"), F.col("b_n"), similarity) & _near("a_", "b_", similarity))
    pairs = materialize(pairs.groupBy("key").agg(F.min(F.struct(bits.alias("bits"), "pivot")).alias("best")).select(
        F.col("key").alias("a"), F.col("best.pivot").alias("b")), "pairs")

    wanted = shared.select("group").distinct().join(of_group.select("group", "key"), "group").select("key").unionAll(
        of_group.where("size > 1").select("key")).distinct()
    texts = materialize(
        docs.mapInPandas(_packed, "key long, packed binary").join(wanted, "key", "left_semi"), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(texts.select(F.col("key").alias("a"), F.col("packed").alias("ta")), "a")
        sides = sides.join(texts.select(F.col("key").alias("b"), F.col("packed").alias("tb")), "b")
        return materialize(sides.select("a", "b", "ta", "tb").mapInPandas(
            _verified(words, similarity), "a long, b long"), "links")

    links = verified(pairs)
    connected = materialize(components(links), "connected")
    placed = of_group.join(connected.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")).drop("rare", "pivot", "pivot_rare")
    placed = materialize(placed, "placed")

    # Groups that share a prefix shingle and may hold members of different components.
    span = placed.groupBy("group").agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
    face = placed.where("key = group").drop("component", "key").join(span, "group")
    index = shared.select("token", "group").join(face, "group")
    # A token all of whose groups are in one component needs no pairs.
    open_tokens = index.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l != h").select("token")
    index = materialize(index.join(open_tokens, "token"), "open")
    a, b = _renamed(index, "a_"), _renamed(index, "b_")
    apart = (F.col("a_low") != F.col("b_high")) | (F.col("a_high") != F.col("b_low"))
    single = (F.col("a_size") == 1) & (F.col("b_size") == 1)
    group_pairs = a.join(b, (
        (F.col("a_token") == F.col("b_token")) & (F.col("a_group") < F.col("b_group")) & apart
        & _sized(F.col("a_n"), F.col("b_n"), similarity) & (~single | _near("a_", "b_", similarity))
    )).select("a_group", "b_group").distinct()
    within = span.where("low != high").select(F.col("group").alias("a_group"), F.col("group").alias("b_group"))
    who = placed.select("group", "key", "component", "n", *(f"s{i}" for i in range(SKETCH)))
    expanded = group_pairs.unionAll(within).join(_renamed(who, "a_"), "a_group").join(_renamed(who, "b_"), "b_group")
    expanded = expanded.where(
        (F.col("a_component") != F.col("b_component")) & _near("a_", "b_", similarity)
        & ((F.col("a_group") != F.col("b_group")) | (F.col("a_key") < F.col("b_key"))))
    more = expanded.select(F.col("a_key").alias("a"), F.col("b_key").alias("b"), (F.col("a_n") + F.col("b_n")).alias("total"))
    wide = members.select("key", "wide")
    more = more.join(wide.select(F.col("key").alias("a"), F.col("wide").alias("wa")), "a").join(
        wide.select(F.col("key").alias("b"), F.col("wide").alias("wb")), "b")
    more = more.select("a", "b", "total", "wa", "wb").mapInPandas(_near_wide(similarity), "a long, b long")
    more = more.join(pairs, ["a", "b"], "left_anti")
    more = verified(materialize(more, "pairs"))

    nodes = connected if more.isEmpty() else components(links.unionAll(more))
    nodes = nodes.withColumnRenamed("node", "class")
    result = profiles.join(classes, ["n", "d1", "d2"], "left").join(nodes, "class", "left").select(
        "key", F.col("n").alias("n_shingles"), F.coalesce("component", "class", "key").alias("component"))
    if rows is None:
        return result.select(F.col("key").alias(id_col), "n_shingles", F.col("component").alias("component_id"))
    names = rows.distinct().select(F.col("key").alias("component"), F.col("id").alias("component_id"))
    return rows.join(result, "key").join(names, "component").select(
        F.col("id").alias(id_col), "n_shingles", "component_id")


def one_of_each(
    df: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows, with all their columns, of the smallest id of each connected group.

    Rows equal in id and text are one document, of which one row stays.
    """
    numbered, rows = unique_keys(df, id_col, text_or_empty(text_col))
    if rows is None:
        found = similar_documents(df, words, similarity, id_col, text_col)
        kept = found.where(F.col(id_col) == F.col("component_id")).select(id_col)
        return df.join(kept, id_col, "left_semi").select(df.columns)
    kept = similar_documents(numbered, words, similarity, "key", "text").where("key = component_id")
    chosen = numbered.join(kept.select("key"), "key", "left_semi").join(rows.distinct(), "key").select(
        F.col("id").alias("_id"), F.sha2("text", 256).alias("_digest"))
    marked = df.withColumn("_digest", F.sha2(text_or_empty(text_col), 256))
    same = marked[id_col].cast("long").eqNullSafe(chosen["_id"]) & (marked["_digest"] == chosen["_digest"])
    return marked.join(chosen, same, "left_semi").dropDuplicates([id_col, "_digest"]).select(df.columns)
