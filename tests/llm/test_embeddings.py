import numpy as np

from hitroll.llm import embedding_dedup as E
from tests.llm.edge import rows_of, save

SCHEMA = "vec_id long, embedding array<float>, label int, node string, keys int"
COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def frame(spark, vectors):
    return spark.createDataFrame(
        [(k, None if v is None else [None if x is None else float(x) for x in v], 0, "n", 1)
         for k, v in vectors], SCHEMA)


def brute(vectors, threshold=0.95):
    n = len(vectors)
    links, root = [0] * n, list(range(n))
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
            and any(v) for _, v in vectors]
    x = [np.asarray(v, np.float32).astype(float) if g else None for g, (_, v) in zip(good, vectors)]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= threshold * np.sqrt(
                    (x[i] @ x[i]) * (x[j] @ x[j])):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), vectors[i][0]), vectors[i][0])
    return sorted(((vectors[i][0], links[i], low[find(i)], low[find(i)] == vectors[i][0])
                   for i in range(n)), key=repr)


def group(rng, centre, n, noise):
    x = centre + noise * rng.normal(size=(n, len(centre))) / np.sqrt(len(centre))
    return [v for v in x]


def test_against_brute_force(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    vectors = [v for v in rng.normal(size=(300, 64))]
    for size, noise in ((2, .1), (5, .2), (40, .25), (30, .32)):
        c = rng.normal(size=64)
        vectors += group(rng, c / np.linalg.norm(c), size, noise)
    vectors += [vectors[0]] * 30 + [vectors[1] * 2, vectors[1] * 1e30, vectors[1] * 1e-30]
    vectors += [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63,
                [float("inf")] * 64, [0.0] * 64, vectors[0][:10], vectors[0][:10], [1.0], [3.0], [-1.0]]
    order = rng.permutation(len(vectors))
    rows = [(int(k), vectors[i]) for k, i in enumerate(order)]
    folder = save(frame(spark, rows).repartition(4), tmp_path, "embeddings")
    got = rows_of(E.op9_embedding_near_dedup(spark, folder), *COLUMNS)
    want = brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.995 * there and all(g[1] <= w[1] for g, w in zip(got, want))
    if found == there:
        assert got == want


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(12)
    rows = [(k, v) for k, v in enumerate(group(rng, np.ones(16), 120, .4))]
    got = rows_of(E.near_duplicate_vectors(frame(spark, rows)), *COLUMNS)
    assert got == brute(rows)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9501 * x + np.sqrt(1 - 0.9501 ** 2) * z
    a, b = E.bucket_keys(x), E.bucket_keys(y)
    met = np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert met.mean() > 0.998


def test_empty_table(spark, tmp_path):
    folder = save(frame(spark, []), tmp_path, "embeddings")
    assert E.op9_embedding_near_dedup(spark, folder).collect() == []
