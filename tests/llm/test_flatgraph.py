import numpy as np

from helioframe.llm import flatgraph as fg


def brute(rows, radius):
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    x = []
    for _, label, v in rows:
        ok = label is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    for i in range(n):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][1] == rows[j][1] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= radius:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted(((r[0], links[i], least.get(root(i))) for i, r in enumerate(rows)), key=str)


def fixture_rows():
    rng = np.random.default_rng(5)
    rows = [(1000, 1, None), (1001, 1, [0.0] * 8), (1002, 1, [None] + [1.0] * 7), (1003, 1, [float("nan")] + [1.0] * 7),
            (1004, 1, [float("inf")] + [1.0] * 7), (1005, None, [1.0] * 8), (1006, 1, []), (1007, 1, [1.0] * 4), (1008, 1, [2.0] * 4)]
    k = 0
    for label in (1, 2):
        for spread, size in ((0.02, 120), (0.05, 60), (0.3, 80)):
            center = rng.normal(size=8)
            for _ in range(size):
                rows.append((k, label, [float(np.float32(c)) for c in center + rng.normal(size=8) * spread]))
                k += 1
    return rows + rows[-4:] + rows[20:23] + [(None, 1, rows[30][2]), (2000, 2, [2 * c for c in rows[200][2]])]


def test_links_and_components(spark):
    rows = fixture_rows()
    vectors = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, label int, embedding array<float>, cluster string, n_links int")
    for shard in (1000, 60):
        out = fg.near_duplicates(vectors, radius=0.98, shard=shard, overlap=0.4).cache()
        got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=str)
        assert got == brute(rows, 0.98)
        assert fg.recall(out) == 1.0
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.collect())


def test_recall_on_a_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert fg.recall(fg.near_duplicates(vectors)) >= 0.9
    assert fg.near_duplicates(vectors.limit(0)).count() == 0


def test_robust_prune_keeps_the_nearest_and_drops_what_it_covers():
    x = np.array([[1, 0], [0.999, 0.0447], [0.995, 0.0998], [0, 1.0]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = fg.robust_prune(x[:1], x, np.array([[1, 2, 3]]), most=3)
    assert kept.tolist() == [[True, False, False]] or kept.tolist() == [[True, False, True]]
    assert not fg.robust_prune(x[:1], x, np.array([[-1, -1, -1]]), most=3).any()


def planted(rank, n=4000, seed=3):
    """Vectors of low rank, so that many lie at cluster borders, and a partner of cosine 0.981 for every fourth."""
    rng = np.random.default_rng(seed)
    space = np.linalg.qr(rng.normal(size=(64, rank)))[0].T
    x = rng.normal(size=(n, rank))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(n // 4, rank))
    away -= (away * x[::4]).sum(axis=1, keepdims=True) * x[::4]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    x, y = x @ space, (0.981 * x[::4] + np.sqrt(1 - 0.981**2) * away) @ space
    return x, y


def test_linked_vectors_share_a_shard():
    for rank in (4, 16):
        x, y = planted(rank)
        c = fg.centroids(x, 18)
        margin = fg.margins(c, 0.98)

        def joined(v):
            near = v @ c.T
            best = near.argmax(axis=1)
            return near >= near.max(axis=1)[:, None] - margin[best]

        assert (joined(x[::4]) & joined(y)).any(axis=1).all()


def test_recall_of_planted_pairs_with_defaults(spark):
    x, y = planted(4, 8000)
    rows = [(i, 1, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    out = fg.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    got = {r["vec_id"]: r["n_links"] for r in out.select("vec_id", "n_links").collect()}
    z = np.concatenate([x, y])
    want = (z @ z.T >= 0.98).sum(axis=1) - 1
    found = sum(min(got[i], int(w)) for i, w in enumerate(want))
    print("recall", found, int(want.sum()))
    assert found >= 0.999 * want.sum()


def test_large_shards_are_compared_in_cells(spark):
    rows = fixture_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    for shard in (1000, 60):
        out = fg.near_duplicates(vectors, shard=shard, largest=40)
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=str) == brute(rows, 0.98)


def test_hot_group_is_spread_over_cells(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=64) + rng.normal(size=(6000, 64)) * 0.11
    rows = [(i, 1, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    whole, cells = fg.split(vectors.selectExpr("vec_id as nid", "label", "64L as dim", "0L as cluster"))
    assert whole.count() == 0
    assert max(r["count"] for r in cells.groupBy(*fg.CELL).count().collect()) <= 1.1 * fg.LARGEST
    got = {r["vec_id"]: r["n_links"] for r in fg.near_duplicates(vectors).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert want.sum() > 1_000_000
    assert [got[i] for i in range(len(x))] == want.tolist()
