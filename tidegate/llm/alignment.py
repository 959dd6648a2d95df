"""Alignment of two tokenizers over the bytes of the same texts.

Both token sequences of a text are rows of an incidence matrix over its bytes.  The product A x B^T has
an element for each pair of tokens that overlap: the links.  Offsets where tokens of both end cut the text into
groups; products of the incidences with groups pair the tokens that share one.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import materialize
from tidegate.llm.incidence import Rows, product, terms
from tidegate.operators.keys import unique_lookup

WINDOW = 1 << 20  # bytes of text whose matrices are held at a time, unless a group is longer
_ID_BITS = 20  # of a token id within a pair
_DOC_BITS = 62 - 2 * _ID_BITS
# Characters whose classes are the same in every version of Unicode that a tokenizer library may
# carry, and runs that a byte-pair table would take long over.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏΑ-ΡΣ-ωА-я–-”€]")
_LONG_RUN = re.compile(r"\s{256}|\S{2048}")


def _byte_of_letter() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return dict(zip([*map(chr, printable), *(chr(256 + i) for i in range(len(others)))], [*printable, *others], strict=True))


class ByteLevel:
    """A byte-level vocabulary file: texts to ids, and the bytes of each id."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        known = json.loads(spec)
        model, letters = known["model"], _byte_of_letter()
        special = {x["content"] for x in known.get("added_tokens") or []}
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, number in vocabulary.items():
            self.bytes[number] = bytes(letters[c] for c in piece)
        self.quick = self._table(known, vocabulary)

    def _table(self, known: dict, vocabulary: dict[str, int]):
        """The same vocabulary as byte-pair ranks, if merges come in the order of the ids they make."""
        model, pre = known["model"], known.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and not known.get("normalizer") and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not plain:
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocabulary.get(a + b, -1) for a, b in merges]
        if made != sorted(made) or made and made[0] < 256 or len(vocabulary) != 256 + len(made):
            return None
        import public_tokenizers
        import tiktoken

        ranks = {self.bytes[n]: n for n in vocabulary.values()}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.quick is None or _OTHER.search(text) or _LONG_RUN.search(text):
                slow.append(i)
            else:
                found[i] = np.asarray(self.quick.encode_to_numpy(text), np.int32)
        for i in slow:  # one at a time: the library's objects are large
            found[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
        return found


class Pieces:
    """A sentencepiece model: texts to ids, and the bytes of each id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


class Aligner:
    """Two vocabularies with what is looked up by id."""

    def __init__(self, first, second):
        self.first, self.second = first, second
        if max(len(first.bytes), len(second.bytes)) > 1 << _ID_BITS:
            raise ValueError(f"vocabularies of up to {1 << _ID_BITS} ids are supported")
        self.lengths = [np.array([len(x) for x in v.bytes] or [0], np.int32) for v in (first, second)]
        numbers = [str(i) for i in range(max(len(first.bytes), len(second.bytes)))]
        # An id first in its text, and after each kind of separator.
        self.written = np.array([mark + n for n in numbers for mark in ("", ",", "|", ";")], object)

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by both vocabularies; none where their bytes are not the text's."""
        none = np.zeros(0, np.int32)
        marked = [" " + t for t in texts]
        pairs = []
        for text, whole, a, b in zip(
            texts, marked, self.first.encode(marked), self.second.encode(texts), strict=True,
        ):
            data = whole.encode()
            if not text or any(b"".join(map(v.bytes.__getitem__, ids.tolist())) != data
                               for v, ids in ((self.first, a), (self.second, b))):
                a = b = none
            pairs.append((a, b))
        return pairs

    def align(self, texts: list[str], window: int = WINDOW) -> dict[str, object]:
        """Counts, group digests and the multiset of linked id pairs of each text."""
        pairs = self.encoded(texts)
        n = len(pairs)
        sizes_a, sizes_b = (np.array([len(p[i]) for p in pairs], np.int64) for i in (0, 1))
        out = {
            "n_a": sizes_a, "n_b": sizes_b, "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64),
            "n_shared": np.zeros(n, np.int64), "digest": [""] * n, "pairs": [[] for _ in range(n)],
        }
        at = 0
        while at < n:
            # Neighbouring texts share a window; one that is longer is cut at its groups.
            stop, held = at, 0
            while stop < n and (stop == at or held + len(texts[stop]) <= window):
                held += len(texts[stop])
                stop += 1
            docs = np.arange(at, stop)
            a, b = (np.concatenate([pairs[d][i] for d in docs]) for i in (0, 1))
            doc_a = np.repeat(docs, sizes_a[docs])
            self._align(a, b, doc_a, window, out)
            at = stop
        return out

    def _align(self, a, b, doc_a, window, out) -> None:
        len_a, len_b = self.lengths[0][a], self.lengths[1][b]
        ends_a, ends_b = np.cumsum(len_a, dtype=np.int64), np.cumsum(len_b, dtype=np.int64)
        total = int(ends_a[-1]) if len(ends_a) else 0
        ending = np.zeros((2, total + 1), bool)
        ending[0, ends_a] = ending[1, ends_b] = True
        last_a, last_b = ending[1, ends_a], ending[0, ends_b]  # tokens that end their group
        stops_a, stops_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        bounds = ends_a[stops_a - 1]
        sums: dict[int, object] = {}
        g = 0
        while g < len(bounds):
            done = bounds[g - 1] if g else 0
            h = max(g + 1, int(np.searchsorted(bounds, done + window, "right")))
            from_a, from_b = (stops_a[g - 1], stops_b[g - 1]) if g else (0, 0)
            part_a, part_b = slice(from_a, stops_a[h - 1]), slice(from_b, stops_b[h - 1])
            self._window(
                a[part_a], b[part_b], len_a[part_a], len_b[part_b], last_a[part_a], last_b[part_b], doc_a[part_a], out, sums)
            g = h
        for doc, digest in sums.items():
            out["digest"][doc] = digest.hexdigest()

    def _window(self, a, b, len_a, len_b, last_a, last_b, doc_a, out, sums) -> None:
        group_a, group_b = (np.cumsum(last) - last for last in (last_a, last_b))
        n_groups = int(group_a[-1]) + 1
        in_bytes_a, in_bytes_b = Rows.of_runs(len_a), Rows.of_runs(len_b)
        row, column, _ = product(in_bytes_a, in_bytes_b.transposed(int(in_bytes_b.starts[-1])))
        shared = terms(Rows.of_labels(group_a), Rows.of_labels(group_b).transposed(n_groups))

        first_a = np.flatnonzero(np.concatenate([[True], last_a[:-1]]))
        doc_of_group = doc_a[first_a]
        docs, starts = np.unique(doc_a, return_index=True)
        link_docs = doc_a[row]
        low = docs[0]
        width = int(docs[-1] - low) + 1

        def counted(values: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(values - low, weights, width)[docs - low].astype(np.int64)

        out["n_groups"][docs] += counted(doc_of_group)
        out["n_links"][docs] += counted(link_docs)
        out["n_shared"][docs] += counted(doc_a, shared)

        pair = a[row].astype(np.int64) << _ID_BITS | b[column]
        keys, times = np.unique((link_docs - low).astype(np.int64) << 2 * _ID_BITS | pair, return_counts=True)
        cuts = np.searchsorted(keys, np.append(docs - low, width).astype(np.int64) << 2 * _ID_BITS)
        keys &= (1 << 2 * _ID_BITS) - 1
        for doc, start, end in zip(docs, cuts[:-1], cuts[1:], strict=True):
            out["pairs"][doc].append((keys[start:end], times[start:end]))

        # Tokens in the order they are written: those of A, then those of B, group by group.
        stops_a, stops_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        before_b = np.concatenate([[0], stops_b[:-1]])
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + stops_a[group_b]
        mark_a, mark_b = np.ones(len(a), np.int32), np.ones(len(b), np.int32)
        mark_a[first_a] = 3
        mark_b[before_b] = 2
        for doc, start in zip(docs, starts, strict=True):
            if doc not in sums:
                sums[doc] = hashlib.sha256()
                mark_a[start] = 0
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = a * np.int64(4) + mark_a, b * np.int64(4) + mark_b
        words = self.written[order]
        doc_ends = np.append(place_a[starts[1:]], len(order))
        for doc, start, end in zip(docs, place_a[starts], doc_ends, strict=True):
            sums[doc].update("".join(words[start:end]).encode())


@lru_cache(maxsize=2)
def _aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(ByteLevel(spec), Pieces(model))


def _aligned(spec, model):
    def run(batches):
        aligner = _aligner(spec.value, model.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            found = aligner.align(texts)
            lists = []
            for parts in found["pairs"]:
                if len(parts) > 1:  # a text of several windows
                    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                    times = np.bincount(at, np.concatenate([t for _, t in parts])).astype(np.int64)
                    lists.append((keys, times))
                else:
                    lists.append(parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k, _ in lists])]), pa.int32())
            none = [np.zeros(0, np.int64)]
            keys, times = (np.concatenate([x[i] for x in lists] or none) for i in (0, 1))
            yield pa.record_batch({
                "id": batch["id"],
                **{c: pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared")},
                "groups_sha256": pa.array(found["digest"], pa.string()),
                "pairs": pa.ListArray.from_arrays(offsets, pa.array(keys, pa.int64())),
                "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
            })

    return run


def align_tokens(
    df: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of the alignment of whole texts by two tokenizers.

    A is a byte-level vocabulary file over a space and the text, B a sentencepiece model over the text, to
    which it adds the space; strings of special tokens are plain text.  Texts that are null or empty, or whose
    tokens of A or B do not make up the space and the text byte by byte, have no tokens, zeros and '' as digest.

    documents has one row per input row, with ids as they are: n_a, n_b, n_groups, n_links, n_shared (pairs of an A and
    a B token in one group), n_best, count_sum and groups_sha256.  pairs has one row for each pair of ids
    that a link holds: a_id, b_id, n (links of the corpus), best (no pair of the same B id has more; ties are all best).
    Texts are encoded once; a text's links are stored as its distinct pairs with their numbers.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    with open(byte_level_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # vocabulary files: a few MB, whatever the corpus
    with open(pieces_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = materialize(texts.mapInArrow(
        _aligned(spec, model),
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, "
        "pairs array<long>, times array<long>",
    ).withColumn("row", F.monotonically_increasing_id()), "aligned")
    linked = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counts = materialize(linked.groupBy("pair").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("texts")), "pairs")
    ids = counts.select("pair", "n", F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("b_id"))
    most = ids.groupBy("b_id").agg(F.max("n").alias("most"))
    marked = materialize(
        unique_lookup(ids, most, ["b_id"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"), "b_id"), "best")
    met = unique_lookup(
        linked, marked.select("pair", "n", "best"), ["pair"], frequency=counts.select("pair", F.col("texts").alias("n")))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    documents = found.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_shared",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    pairs = marked.select(F.shiftright("pair", _ID_BITS).alias("a_id"), "b_id", "n", "best")
    return documents, pairs
