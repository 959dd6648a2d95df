"""The similarity join against all pairs."""

import random
import re

from tidegate.llm.ngram_join import prefix_length, similar_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, percent):
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {r: (len(s), rows[find(i)][0]) for i, (r, s) in enumerate(zip(rows, sets))}


def check(spark, rows, k=3, percent=90):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, component string").repartition(3)
    got = [tuple(r) for r in similar_documents(df, k, percent).collect()]
    wanted = brute(rows, k, percent)
    assert sorted(got, key=repr) == sorted(((i, *wanted[(i, t)]) for i, t in rows), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_copies_edits_and_shared_passages(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 30, 60, 200]))]
        for _ in range(12):
            words = edited(rng, base, rng.choice([0, 0, 1, 1, 2, 4]))
            if rng.random() < 0.3:
                words = words[rng.randrange(3) :]
            if g % 4 == 3:
                words = words + passage
            rows.append((rng.randrange(10**7) * 500 + len(rows), " ".join(words).upper() if rng.random() < 0.2 else "\n".join(words)))
    check(spark, rows)
    check(spark, rows, 5, 80)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"u{rng.randrange(900)}" for _ in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 5)))) for i in range(150)]
    check(spark, rows)


def test_nulls_short_texts_ties_and_repeats(spark):
    rows = [
        (1, None), (2, ""), (3, " \t"), (4, "a"), (5, "A"), (6, "a b"), (7, "a\nb"), (8, "b a"), (9, "a b c"), (None, "a b c"),
        (None, "other words here now"), (9, "a b c"), (10, "x y z a b c d e f g h i"), (10, "x y z a b c d e f g h i j"), (11, "é a b"),
    ]
    check(spark, rows)
    assert similar_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_prefix_length():
    assert [prefix_length(n, 90) for n in (1, 9, 10, 11, 100)] == [1, 1, 2, 2, 11]


def test_sample_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, rows)
    check(spark, rows, 5, 80)


def test_driver_gets_no_rows_and_components_are_found_once(spark, monkeypatch):
    from tidegate.llm import ngram_join

    found, runs, kind = [], [], type(spark.range(1))
    collect, components = kind.collect, ngram_join.components

    def collected(df):
        rows = collect(df)
        found.append(len(rows))
        return rows

    def counted(edges):
        runs.append(edges)
        return components(edges)

    rows = [(i, " ".join(f"w{i % 5}x{j}" for j in range(60)) + ("" if i < 5 else f" end{i}")) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(kind, "collect", collected)
    monkeypatch.setattr(ngram_join, "components", counted)
    result = similar_documents(df, 3, 90)
    monkeypatch.undo()
    assert {(r.doc_id, r.component_id) for r in result.collect()} == {(i, i % 5) for i in range(20)}
    assert max(found, default=0) <= 1 and len(runs) == 1
