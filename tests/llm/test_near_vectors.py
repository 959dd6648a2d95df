"""Vector links against all pairs."""

import numpy as np

from tidegate.llm.near_vectors import near_vectors


def brute(ids, vectors, least=0.9):
    """(n_links, component) by row; ids are distinct."""
    n = len(ids)
    sound = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = np.zeros((n, n), dtype=bool)
    at = [i for i in range(n) if sound[i]]
    unit = np.array([vectors[i] for i in at], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links[np.ix_(at, at)] = unit @ unit.T >= least
    np.fill_diagonal(links, False)
    component = np.array(ids)
    while True:
        new = np.array([min([component[i], *component[links[i]]]) for i in range(n)])
        if (new == component).all():
            return links.sum(1), component
        component = new


def run(spark, ids, vectors, schema="vec_id long, embedding array<float>"):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)], schema)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df.repartition(3)).collect()}


def clustered(seed, groups, size, spread, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            noise = rng.standard_normal(dim)
            out.append((centre + spread * rng.random() * noise / np.linalg.norm(noise)).astype(np.float32).tolist())
    return out


def test_links_and_components(spark):
    vectors = clustered(1, 30, 12, 0.45) + clustered(2, 1, 150, 0.2) + clustered(3, 1, 60, 0.7)
    vectors += [vectors[0], vectors[0], None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [2.0] * 32]
    ids = np.random.default_rng(5).permutation(10_000)[: len(vectors)].tolist()
    got = run(spark, ids, vectors)
    n_links, component = brute(ids, vectors)
    assert len(got) == len(ids)
    found = np.array([got[i][0] for i in ids])
    assert (found <= n_links).all()  # no link below the least cosine
    assert found.sum() >= 0.98 * n_links.sum()
    assert np.mean([got[i][1] == c for i, c in zip(ids, component)]) >= 0.97
    assert all(got[i][2] == (got[i][1] == i) for i in ids)


def test_each_length_has_its_links(spark):
    long, short, single = clustered(4, 6, 10, 0.3), clustered(6, 4, 10, 0.3, dim=16), [[1.0] * 5]
    ids = np.random.default_rng(2).permutation(1_000)[: len(long) + len(short) + 1].tolist()
    got = run(spark, ids, long + short + single)
    assert len(got) == len(ids) and got[ids[-1]] == (0, ids[-1], True)
    for own, vectors in ((ids[: len(long)], long), (ids[len(long) : -1], short)):
        n_links, component = brute(own, vectors)
        found = np.array([got[i][0] for i in own])
        assert (found <= n_links).all() and found.sum() >= 0.98 * n_links.sum() > 0
        assert np.mean([got[i][1] == c for i, c in zip(own, component)]) >= 0.97


def test_repeated_rows_other_lengths_and_empty(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (1, [0.0, 1.0], "c"), (None, [1.0, 0.01], "d"), (7, [1.0], "e"), (8, [], "f"), (9, [1e300, 0.0], "g")],
        "vec_id long, embedding array<double>, key string")
    got = sorted(map(tuple, near_vectors(df).collect()), key=repr)
    assert got == sorted(
        [(1, 2, None, False)] * 2 + [(1, 0, 1, True), (None, 2, None, True), (7, 0, 7, True), (8, 0, 8, True), (9, 2, None, False)], key=repr)
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_sample_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r[0] for r in rows], [r[1] for r in rows]
    got = run(spark, ids, vectors)
    n_links, component = brute(ids, vectors)
    found = np.array([got[i][0] for i in ids])
    assert (found <= n_links).all() and found.sum() >= 0.99 * n_links.sum()
    assert np.mean([got[i][1] == c for i, c in zip(ids, component)]) >= 0.99
