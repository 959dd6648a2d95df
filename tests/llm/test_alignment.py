"""Alignment of two tokenizers against pairwise comparison of byte ranges."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegate.llm.alignment import Aligner, ByteLevel, Pieces, align_tokens
from tidegate.llm.incidence import Rows, product

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
BITS = [
    "hello", "world ", " ", "\n", "é", "日本語", "\U0001f600", "ab", "  ", "1234", "<s>", "<|endoftext|>", "don't", " ",
    "Ünïcode", "\t", "ﬁ", "x" * 50, "  \n ", "<0x41>", "Привет",
]


def reference_spans(text):
    """(start, end, id) of the tokens of A and B by the libraries alone."""
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a = [(i, bytes(byte_of[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    found = []
    for side in (a, b):
        at, spans = 0, []
        for i, data in side:
            spans.append((at, at + len(data), i))
            at += len(data)
        found.append(spans)
    return found


def brute_force(text):
    a, b = reference_spans(text)
    links = Counter((i, j) for s, e, i in a for t, f, j in b if s < f and t < e)
    cuts, groups, shared, before = sorted({e for _, e, _ in a} & {e for _, e, _ in b}), [], 0, 0
    for cut in cuts:
        of_a, of_b = ([i for _, e, i in side if before < e <= cut] for side in (a, b))
        shared += len(of_a) * len(of_b)
        groups.append(",".join(map(str, of_a)) + "|" + ",".join(map(str, of_b)))
        before = cut
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
    return (len(a), len(b), len(cuts), sum(links.values()), shared, digest), links


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, encoding="utf-8") as spec, open(B_PATH, "rb") as model:
        return Aligner(ByteLevel(spec.read()), Pieces(model.read()))


@given(st.data())
@settings(max_examples=40, deadline=None)
def test_product_equals_dense(data):
    n, m, k = (data.draw(st.integers(1, 6)) for _ in range(3))
    dense = [np.array(data.draw(st.lists(st.lists(st.booleans(), min_size=c, max_size=c), min_size=r, max_size=r))).astype(int).reshape(r, c)
             for r, c in ((n, m), (m, k))]
    a, b = (Rows(np.concatenate([[0], np.cumsum(d.sum(1))]), np.nonzero(d)[1]) for d in dense)
    row, column, value = product(a, b)
    out = np.zeros((n, k), int)
    out[row, column] = value
    assert (out == dense[0] @ dense[1]).all() and (value > 0).all()
    turned = b.transposed(k)
    back = np.zeros((k, m), int)
    back[np.repeat(np.arange(k), np.diff(turned.starts)), turned.columns] = 1
    assert (back == dense[1].T).all()


@pytest.mark.parametrize("window", [16, 200, 1 << 20])
def test_kernel(aligner, window):
    pick = random.Random(window)
    texts = ["", "▁ a", *["".join(pick.choice(BITS) for _ in range(pick.randint(1, 20))) for _ in range(60)]]
    out = aligner.align(texts, window)
    for i, text in enumerate(texts):
        wanted, links = brute_force(text)
        assert tuple(out[c][i] for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared", "digest")) == wanted
        got = Counter()
        for keys, times in out["pairs"][i]:
            for key, n in zip(keys.tolist(), times.tolist(), strict=True):
                got[key >> 20, key & (1 << 20) - 1] += n
        assert got == links


@given(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=60))
@settings(max_examples=100, deadline=None)
def test_ids_are_the_librarys(aligner, text):
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    assert aligner.first.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_corpus_counts(spark):
    pick = random.Random(5)
    texts = ["".join(pick.choice(BITS) for _ in range(pick.randint(1, 12))) for _ in range(40)]
    texts += [texts[0]] * 15 + [None, "", "▁", "<s></s> [INST]"]
    ids = [*range(len(texts) - 2), None, 3]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, row int, pairs string")
    documents, pairs = align_tokens(df, A_PATH, B_PATH)
    found = [brute_force(t or "") for t in texts]
    counts = sum((links for _, links in found), Counter())
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    wanted = [
        (i, *numbers[:5], sum(n for p, n in links.items() if counts[p] == most[p[1]]),
         sum(n * counts[p] for p, n in links.items()), numbers[5])
        for i, (numbers, links) in zip(ids, found, strict=True)]
    assert sorted(map(tuple, documents.collect()), key=repr) == sorted(wanted, key=repr)
    assert {(r.a_id, r.b_id): (r.n, r.best) for r in pairs.collect()} == {
        p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_edges(spark, aligner):
    empty = align_tokens(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH)
    assert empty[0].count() == empty[1].count() == 0
    started = time.monotonic()
    long = ["word <b> " * 300_000, "a" * 300_000, " " * 100_000]
    out = aligner.align(long)
    for i, text in enumerate(long):
        a, b = aligner.encoded([text])[0]
        assert (out["n_a"][i], out["n_b"][i]) == (len(a), len(b)) and len(a)
    assert time.monotonic() - started < 60
