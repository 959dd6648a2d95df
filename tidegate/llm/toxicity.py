"""Toxicity by multiple-instance learning: sentence scores from document labels."""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import text_or_empty

THRESHOLD = 0.7
MAX_TOXIC = 1_200  # labelled documents of each class that a fit reads at most
MAX_CLEAN = 2_400
MAX_BYTES = 16 << 20  # of their texts together
EPOCHS = 200
PREFIXES = (3, 4, 5, 6, 7)
L2 = 1e-5
RATE = 0.2  # largest change of a weight in one step
FLOOR = 1e-3
CACHED = 100_000  # words whose value a task keeps; beyond that it starts anew
MIN_DOCUMENTS = 3  # a feature is learned from that many training documents at least

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class _Values(dict):
    """The sum of each word's feature weights, worked out when first asked for."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        self[word] = found = sum(self.weights.get(f, 0.0) for f in features(word))
        return found


@dataclass
class Model:
    """Weights of features and a bias; a sentence's score is the logistic of their sum."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        """A function from a text to (score, [(start, end, sentence score), ...])."""
        bias, value = self.bias, _Values(self.weights)

        floor = 1 / (1 + np.exp(-bias))

        def score(text: str) -> tuple[float, list[tuple[int, int, float]]]:
            if len(value) > CACHED:
                value.clear()
            lower = text.lower()
            places = [m.span() for m in _SENTENCE.finditer(text)]
            if len(lower) == len(text):
                parts = [lower[a:b] for a, b in places]
            else:  # some letters get longer in lower case
                parts = [text[a:b].lower() for a, b in places]
            logits = [sum(map(value.__getitem__, set(_WORD.findall(p)))) for p in parts]
            if not places:
                return 0.0, []
            chance = 1 / (1 + np.exp(-np.clip(np.array(logits) + bias, -40, 40)))
            # A sentence without evidence adds nothing: long documents stay clean.
            chance = np.maximum(0.0, chance - floor) / (1 - floor)
            return float(-np.expm1(np.log1p(-np.minimum(chance, 1 - 1e-12)).sum())), [
                (*p, float(c)) for p, c in zip(places, chance, strict=True) if c >= 0.5
            ]

        return score


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, l2: float = L2) -> Model:
    """Learn sentence scores whose noisy-or explains the document labels."""
    words: dict[str, int] = {}
    token_word, sentence_start, sentence_doc = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for m in _SENTENCE.finditer(text):
            own = set(_WORD.findall(m[0].lower()))
            if own:
                sentence_start.append(len(token_word))
                sentence_doc.append(d)
                token_word.extend(words.setdefault(w, len(words)) for w in own)
    if not sentence_start or len(set(labels)) < 2:
        return Model({}, -6.0)
    token_word = np.asarray(token_word)
    starts, doc = np.asarray(sentence_start), np.asarray(sentence_doc)
    sentence = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, len(token_word)]))
    names: dict[str, int] = {}
    pairs = [(i, names.setdefault(f, len(names))) for w, i in words.items() for f in features(w)]
    of_word, of_feature = np.array(pairs, dtype=np.int32).T
    del pairs
    # Documents that hold each feature, document by document.
    order = np.argsort(of_word, kind="stable")
    sorted_features = of_feature[order]
    first = np.searchsorted(of_word[order], np.arange(len(words) + 1))
    documents = np.zeros(len(names), dtype=np.int32)
    token_doc = doc[sentence]
    cuts = np.searchsorted(token_doc, np.arange(len(texts) + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = np.unique(token_word[a:b])
        if len(own):
            documents[np.unique(np.concatenate([sorted_features[first[w] : first[w + 1]] for w in own]))] += 1
    frequent = documents >= MIN_DOCUMENTS
    use = frequent[of_feature]
    of_word, of_feature = of_word[use], of_feature[use]
    y = np.array(labels, dtype=float)
    weight = np.zeros(len(names))
    bias = -3.0
    m1 = np.zeros(len(names) + 1)
    n_docs = len(texts)
    for _ in range(epochs):
        value = np.bincount(of_word, weight[of_feature], minlength=len(words))
        logit = np.bincount(sentence, value[token_word], minlength=len(starts)) + bias
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.bincount(doc, np.log1p(-np.minimum(chance, 1 - 1e-9)), minlength=n_docs)
        p = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        # d loss / d logit of a sentence: the noisy-or's derivative is chance * (1 - p) / p.
        slope = np.where(y == 1, -(1 - p) / p, 1.0)[doc] * chance / n_docs
        back = np.bincount(token_word, slope[sentence], minlength=len(words))
        gradient = np.r_[np.bincount(of_feature, back[of_word], minlength=len(names)) + l2 * weight, slope.sum()]
        # One step size for all features: with a step of its own for each, as many rare words
        # of the training documents as common insults would explain the labels.
        m1 = 0.9 * m1 + 0.1 * gradient
        move = RATE * m1 / max(np.abs(m1).max(), FLOOR)
        weight -= move[:-1]
        bias -= move[-1]
    return Model({f: float(weight[i]) for f, i in names.items() if frequent[i] and abs(weight[i]) > 1e-3}, float(bias))


def held_out(id_col: str) -> Column:
    """Rows that no fit reads: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES,
) -> Model:
    """Fit on a bounded sample of labelled rows that are not held out.

    At most ``max_toxic`` and ``max_clean`` documents, those first by hash of the id, as far as
    their texts stay within ``max_bytes``.  A document labelled twice is toxic if one label says so.
    """
    marked = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y")).where(~held_out("id"))
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sizes = texts.select("id", F.octet_length("text").alias("size")).join(marked, "id").groupBy("id", "y").agg(F.max("size").alias("size"))
    chosen, left = [], max_bytes
    for y, most in ((1, max_toxic), (0, max_clean)):
        share = left // 2 if y else left
        for row in sizes.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most).collect():
            if row.size <= share:
                share -= row.size
                left -= row.size
                chosen.append((row.id, y))
    if not chosen:
        return Model({}, -6.0)
    sample = docs.sparkSession.createDataFrame(chosen, "id long, y int")
    rows = texts.join(F.broadcast(sample), "id").dropDuplicates(["id", "text"]).collect()
    rows.sort(key=lambda r: (r.id, r.text))
    return fit([r.text for r in rows], [r.y for r in rows])


def _scored(model):
    def run(batches):
        score = model.value.scorer()
        for batch in batches:
            found = [score(t) for t in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "score": [s for s, _ in found],
                "offending": [[{"start": a, "stop": b, "score": c} for a, b, c in x] for _, x in found],
            })

    return run


def toxicity(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Score whole texts and locate offending sentences.

    Returns id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``) and offending,
    the sentences (start, stop in code points, score) with a score of 0.5 or more.  One row for each
    input row; texts that are null or hold no sentence score 0.  Only the text counts: labels, ids
    and other columns are never inputs of a score.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # features of a bounded sample
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInPandas(
        _scored(sent), f"id {kind}, score double, offending array<struct<start:long,stop:long,score:double>>")
    return found.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "offending",
    )


def _kept(model, threshold: float, text_col: str):
    def run(batches):
        score = model.value.scorer()
        for batch in batches:
            yield batch[[score(t or "")[0] < threshold for t in batch[text_col]]]

    return run


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose whole text scores below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInPandas(_kept(sent, threshold, text_col), docs.schema)
