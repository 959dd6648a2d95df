"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import text_or_empty
from tidegate.operators.keys import unique_lookup
from tidegate.runtime import HOT_ROWS, scratch_path

LIMIT = 512  # tokens
CACHE = "digest binary, n_tokens long"
# Characters whose classes are the same in every version of Unicode that a tokenizer
# library may carry: ASCII, Latin, Greek and Cyrillic letters and common punctuation.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏΑ-ΡΣ-ωА-я–-”€]")
_LONG_RUN = re.compile(r"\s{256}|\S{2048}")


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _encoder(spec: str):
    """Counts tokens of texts: a byte-pair table where it gives the same, else the library."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.no_padding()
    library.no_truncation()
    known = json.loads(spec)
    special = [x["content"] for x in known.get("added_tokens") or []]
    model, quick = known["model"], None
    letters = _byte_letters()
    pre = known.get("pre_tokenizer") or {}
    plain = (
        model["type"] == "BPE" and not known.get("normalizer") and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if plain:
        import tiktoken

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
        ranks = {bytes(letters[c] for c in k): v for k, v in vocabulary.items()}
        # A merge must come in the order of the id it makes, after the single bytes.
        made = [vocabulary.get(a + b, -1) for a, b in merges]
        if made == sorted(made) and (not made or made[0] >= 256) and len(ranks) == 256 + len(made):
            # Fixed value: the split pattern of this kind of vocabulary.
            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            quick = tiktoken.Encoding("quick", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(texts: list[str]) -> list[int]:
        slow = [
            i for i, t in enumerate(texts)
            if quick is None or _OTHER.search(t) or _LONG_RUN.search(t) or any(s in t for s in special)
        ]
        found = [0] * len(texts)
        for i, x in zip(slow, library.encode_batch([texts[i] for i in slow], add_special_tokens=False), strict=True):
            found[i] = len(x.ids)
        taken = set(slow)
        for i, t in enumerate(texts):
            if i not in taken:
                found[i] = len(quick.encode_ordinary(t))
        return found

    return count


def _contents(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        found = {}
        for text in batch["text"]:
            data = text.encode()
            digest = hashlib.sha256(data).digest()
            if digest not in found:
                found[digest] = pack(data)
        yield pd.DataFrame({"digest": list(found), "packed": list(found.values())})


def _counted(spec):
    def run(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        count = _encoder(spec.value)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [unpack(bytes(p)).decode() for p in batch["packed"]]
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": count(texts)})

    return run


def token_counts(
    df: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = LIMIT,
    id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Token counts of whole texts, each content encoded once for each tokenizer version.

    ``cache_path`` is a Parquet folder of (tokenizer, digest, n_tokens); it may be new.  The
    content is the text's UTF-8 bytes, its digest SHA-256; the tokenizer version is the digest
    of its file.  Contents that the cache lacks are encoded, once each, and appended.
    Tokens at the begin or end are not added, texts are neither cut nor padded, and special
    strings inside texts are what the library makes of them by default.

    Counts go back to the rows by a broadcast if they are few (measured); else by a join in which digests of
    more than ``hot_rows`` rows are set apart, see ``operators.keys.unique_lookup``.

    Returns id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), one row for each
    input row.  Null and empty texts have no tokens; null and repeated ids stay as they are.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    version = hashlib.sha256(spec.encode()).hexdigest()
    path = f"{cache_path or scratch_path(spark, 'token-cache')}/tokenizer={version}"
    docs = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    contents = docs.select("text").mapInPandas(_contents, "digest binary, packed binary")
    try:
        known = spark.read.schema(CACHE).parquet(path)
    except Exception as error:  # a new cache has no folder yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known = spark.createDataFrame([], CACHE)
    misses = contents.groupBy("digest").agg(F.first("packed").alias("packed")).join(known, "digest", "left_anti")
    sent = spark.sparkContext.broadcast(spec)  # a vocabulary file: a few MB, whatever the corpus
    misses.mapInPandas(_counted(sent), CACHE).write.mode("append").parquet(path)
    # Two runs at a time may both append a digest; their counts are the same.
    counts = spark.read.schema(CACHE).parquet(path).groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    digests = docs.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("digest"))
    # A text may be a third of all rows: its digest must not meet them in one task.
    return unique_lookup(digests, counts, ["digest"], hot_rows=hot_rows).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
