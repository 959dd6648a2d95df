"""Secrets in text: patterns, and character Markov models of random and ordinary strings.

DataFrame functions only.  Two models of character pairs are trained from labelled strings, the
values that the patterns find (random) and the other long words (ordinary).  A long
string outside the patterns' spans is a secret when the models' log-likelihood ratio, per pair,
is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import materialize, text_or_empty

KINDS = ("assign", "access", "hex", "random")
# The patterns of the three base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
VALUE_LENGTH = 12
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WORD = "[A-Za-z][A-Za-z0-9_-]{7,}"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
CLASSES = len(LETTERS) + 1  # one more for all other characters
MIN_RATIO = 0.2  # log-likelihood ratio per pair of characters
SPAN = "struct<start:int,stop:int,kind:int,value:string>"
GROUP = 64  # numbers that one fold takes


def _no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _held(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, join, first: Column) -> Column:
    """For each of the whole numbers what ``join`` makes of ``first`` and those before it, by one fold."""
    def add(state, x):
        return F.struct(join(state["at"], x).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, state, add, lambda s: s["out"])


def _running(values: Column, join) -> Column:
    """What ``join`` (a sum or maximum of numbers from 0 on) makes of the values before each.

    A fold copies its state at every step, so an array in it costs the square of its length.  Values
    are folded in groups of ``GROUP``: over the groups, then inside each.
    """
    zero = F.lit(0)

    def grouped(all_):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(GROUP)),
                           lambda i: F.slice(all_, i, GROUP))

    def prefixes(groups):
        heads = _before(F.transform(groups, lambda g: F.aggregate(g, zero, join)), join, zero)
        return F.flatten(F.transform(
            F.arrays_zip(groups.alias("group"), heads.alias("head")), lambda z: _before(z["group"], join, z["head"])))

    return _held(values, lambda all_: _held(grouped(all_), prefixes))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _located(text: Column, pattern: str, kind: int, group: int | None = None) -> Column:
    """All leftmost non-overlapping matches as (start, stop, kind, value), in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.transform(
        F.arrays_zip(F.split(text, pattern).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), x["value"].alias("value")),
    )

    def span(z):
        part = z["part"]
        start = z["at"] + part["gap"]
        return F.struct(start.alias("start"), (start + part["hit"]).alias("stop"), F.lit(kind).alias("kind"), part["value"].alias("value"))

    def spans(parts):
        # The last part is what follows the last match.
        parts = F.filter(parts, lambda p: p["hit"].isNotNull())
        at = _running(F.transform(parts, lambda p: p["gap"] + p["hit"]), _sum)
        return F.transform(F.arrays_zip(parts.alias("part"), at.alias("at")), span)

    return F.when(text.rlike(pattern), _held(parts, spans)).otherwise(_no_spans())


def _base(text: Column) -> Column:
    assign = F.filter(_located(text, ASSIGN, 0, 1), lambda s: F.length(s["value"]) >= VALUE_LENGTH)
    return F.array_sort(F.concat(assign, _located(text, ACCESS, 1), _located(text, HEX, 2)))


def _listed(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kind, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _class(char: Column) -> Column:
    return F.pmod(F.instr(F.lit(LETTERS), char) - 1, F.lit(CLASSES))


def _pair(value: Column, i: Column) -> Column:
    return _class(F.substring(value, i, F.lit(1))) * CLASSES + _class(F.substring(value, i + 1, F.lit(1)))


def _pair_counts(strings: DataFrame) -> dict[int, float]:
    """Occurrences of each pair of characters; ``strings`` has value and times."""
    pairs = strings.where(F.length("value") > 1).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: _pair(F.col("value"), i))).alias("pair"),
        "times")
    # At most CLASSES^2 rows, whatever the corpus.
    return {r["pair"]: float(r["n"]) for r in pairs.groupBy("pair").agg(F.sum("times").alias("n")).collect()}


def ratios(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """log P(next | character) of the random model less that of the ordinary one, by pair."""

    def model(counts: dict[int, float]) -> list[float]:
        out = []
        for a in range(CLASSES):
            row = [counts.get(a * CLASSES + b, 0.0) + 0.5 for b in range(CLASSES)]
            out += [math.log(x / sum(row)) for x in row]
        return out

    return [r - o for r, o in zip(model(_pair_counts(random)), model(_pair_counts(ordinary)), strict=True)]


def _is_kind(kind: int):
    return lambda span: span["kind"] == kind


def _ratio(value: Column, table: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0),
        lambda sum_, i: sum_ + F.get(table, _pair(value, i)))
    return total / (F.length(value) - 1)


def _long(text: Column) -> Column:
    return _located(text, CANDIDATE, 3)


def _apart(base: Column, long: Column) -> Column:
    """The spans of ``long`` that meet none of ``base``; long spans do not meet each other.

    In order of the starts, a span meets an earlier one if the furthest stop so far lies behind its start,
    and a later one only if the next one is such.
    """
    def free(z):
        span, after = z["span"], z["after"]
        return (span["kind"] == 3) & (span["start"] >= z["reach"]) & (
            after.isNull() | (after["kind"] == 3) | (after["start"] >= span["stop"]))

    def kept(spans):
        reach = _running(F.transform(spans, lambda s: F.when(s["kind"] == 3, 0).otherwise(s["stop"])), _larger)
        beside = F.arrays_zip(spans.alias("span"), reach.alias("reach"), F.slice(spans, 2, F.size(spans)).alias("after"))
        return F.transform(F.filter(beside, free), lambda z: z["span"])

    return _held(F.array_sort(F.concat(base, long)), kept)


def _table(values: DataFrame, texts: DataFrame) -> Column | None:
    """The trained ratios by pair as one array, or None where no base value is found.

    ``values`` has an array of base values, ``texts`` the whole texts.
    """
    random = values.select(F.explode("value").alias("value")).groupBy("value").agg(F.count("*").cast("double").alias("times"))
    if random.isEmpty():
        return None
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("value"))
    words = words.groupBy("value").agg(F.count("*").cast("double").alias("times"))
    # What a base pattern may find is no ordinary string.
    odd = F.col("value").rlike(f"{ACCESS}|{HEX}") | F.col("value").rlike("[0-9]") & (F.length("value") >= VALUE_LENGTH)
    found = ratios(random, words.where(~odd))
    return F.split(F.lit(",".join(f"{r:.6g}" for r in found)), ",").cast("array<double>")


def _with_random(base: Column, long: Column, table: Column | None, min_ratio: float) -> Column:
    """Base spans and the long strings apart from them that the models call random."""
    if table is None:
        return base
    apart = F.when(F.size(base) > 0, _apart(base, long)).otherwise(long)
    added = F.filter(apart, lambda c: _ratio(c["value"], table) >= min_ratio)
    return F.when(F.size(long) > 0, F.array_sort(F.concat(base, added))).otherwise(base)


def scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """Find the secrets of whole texts.

    Returns id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:stop by start, then kind, in
    code points, stop exclusive) and found, the same as an array of (start, stop, kind number,
    value).  The base patterns' spans always stay; the Markov models add spans of kind random that
    do not meet them.  The words of all documents train the ordinary model, the base values of all
    documents the random one.

    Null and empty texts have no span and the digest of ''.  Where no base value is found there is
    nothing to learn from, and no span is added.  One row for each input row, whatever its id.
    """
    text = F.col("text")
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found = materialize(rows.select("id", _base(text).alias("base"), _long(text).alias("long")), "secrets")
    table = _table(found.select("base.value"), rows.select("text"))
    whole = found.select("id", "base", _with_random(F.col("base"), F.col("long"), table, min_ratio).alias("found"))
    count = [F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return whole.select(
        F.col("id").alias(id_col), *count, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"), "found")


def redacted(text: Column, found: Column, mask: str = "[secret]") -> Column:
    """The text with each span, spans that meet taken together, replaced by ``mask``.

    What lies between is cut from the text's UTF-32 form, where a code point's place is known, so time is
    linear in text and spans.  The byte order mark put before each piece is what the decoder takes off.
    """
    def cut(wide, piece):
        return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), F.substring(
            wide, piece["at"] * 4 + 1, (piece["start"] - piece["at"]) * 4)), "UTF-32")

    def pieces(spans):
        at = _running(F.transform(spans, lambda s: s["stop"]), _larger)
        gaps = F.arrays_zip(spans["start"].alias("start"), at.alias("at"))
        # A span that begins inside those before it has no piece before it.
        gaps = F.filter(gaps, lambda g: g["start"] >= g["at"])
        return _held(F.encode(text, "UTF-32"), lambda wide: F.transform(gaps, lambda g: cut(wide, g)))

    end = F.struct(F.length(text).alias("start"), F.length(text).alias("stop"))
    places = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    whole = F.array_join(_held(F.concat(places, F.array(end)), pieces), mask)
    return F.when(F.size(found) > 0, whole).otherwise(text)


def redact(
    df: DataFrame, text_col: str = "text", min_ratio: float = MIN_RATIO, mask: str = "[secret]",
) -> DataFrame:
    """The rows, with all their columns, and each secret that ``scan`` finds in the text masked."""
    texts = df.select(text_or_empty(text_col).alias("text"))
    values = materialize(texts.select(_base(F.col("text"))["value"].alias("value")).where(F.size("value") > 0), "values")
    table = _table(values, texts)
    text = F.col(text_col)
    spans = _with_random(_base(text), _long(text), table, min_ratio)
    some = text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}|{CANDIDATE}")
    return df.withColumn(text_col, F.when(some, redacted(text, spans, mask)).otherwise(text))
