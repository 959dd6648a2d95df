"""Hot digests, and the byte-pair table against the library on random texts."""

import random

import public_tokenizers
import pytest

from tidegate.llm.token_counts import _encoder, token_counts

SCRIPTS = (
    [chr(c) for c in range(32, 127)], [chr(c) for c in range(0xC0, 0x250)],
    [chr(c) for c in (*range(0x391, 0x3A2), *range(0x3A3, 0x3CA))], [chr(c) for c in range(0x410, 0x450)],
    list("  \n\t'’“”–—…€0123456789"),
)


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_text_of_many_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr("tidegate.operators.keys.fits_broadcast", lambda df: broadcast or "_hot" in df.columns)
    texts = ["one hot text"] * 40 + [None, ""] * 5 + [f"text {i % 7}" for i in range(20)]
    df = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = token_counts(df, public_tokenizers.path("byte_bpe_50k.json"), hot_rows=4).collect()
    want = token_counts(df.limit(0).unionAll(df).coalesce(1), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(got) == len(texts) and sorted(got) == sorted(want)
    assert {r.doc_id for r in got} == {i // 2 for i in range(len(texts))}


def test_random_texts_count_as_in_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(5)
    with open(path, encoding="utf-8") as file:
        count = _encoder(file.read())
    texts = []
    for _ in range(3_000):
        letters = [c for s in rng.sample(SCRIPTS, rng.randint(1, len(SCRIPTS))) for c in s]
        texts.append("".join(rng.choice(letters) + " " * (rng.random() < 0.15) for _ in range(rng.randint(0, 120))))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert list(count(texts)) == want
