import numpy as np

from textquarry.llm import lattice, queries

SCHEMA = "vec_id long, embedding array<float>, label int, node string, least string"


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    steps = lattice.minimal_vectors()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(axis=1), 2) and len({tuple(s) for s in steps}) == 240
    x = rng.normal(scale=3, size=(2000, 8))
    p = lattice.decode(x)
    doubled = np.rint(2 * p)
    assert (doubled == 2 * p).all() and (p.sum(axis=1) % 2 == 0).all()
    assert ((doubled % 2 == 0).all(axis=1) | (doubled % 2 == 1).all(axis=1)).all()
    own = ((x - p) ** 2).sum(axis=1)
    # Covering radius 1, and no neighbour is closer.
    assert own.max() <= 1 + 1e-9
    assert (((x[:, None] - p[:, None] - steps) ** 2).sum(axis=2) >= own[:, None] - 1e-9).all()


def brute(rows, cosine):
    """Links counted and connected by all cosines."""
    usable = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and None not in v:
            x = np.array(v, dtype=np.float32).astype(np.float64)
            if len(x) and np.isfinite(x).all() and x.any():
                usable[i] = x
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, x in usable.items():
        for j, y in usable.items():
            if j < i and rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted((r[0], links[i], least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows))


def result(df):
    return sorted(tuple(r) for r in df.collect())


def cases():
    rng = np.random.default_rng(3)
    rows = []
    for size in (70, 20, 5, 1, 1):
        centre = rng.normal(size=24)
        rows += [((centre + rng.normal(scale=0.08, size=24)).tolist(), int(size % 2)) for _ in range(size)]
    rows += [([0.0] * 24, 1), (None, 1), ([float("nan")] + [1.0] * 23, 1), ([None] + [1.0] * 23, 1), ([float("inf")] * 24, 1), (rows[0][0], None), ([], 1)]
    rows += [rows[0], rows[0], (rows[1][0][:12], rows[1][1]), ((np.array(rows[2][0]) * 1e-20).tolist(), rows[2][1])]
    ids = rng.permutation(500)[: len(rows)].tolist()
    rows = [(i, *r) for i, r in zip(ids, rows)]
    return rows + [rows[5]]


def test_against_brute_force(spark, monkeypatch):
    rows = cases()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    want = brute(rows, 0.98)
    # Coarse cells and several tables: nothing is missed here.
    assert result(lattice.near_vectors(df, scale=0.3, tables=8)) == want
    monkeypatch.setattr(lattice, "SIDE", 8)
    assert result(lattice.near_vectors(df, scale=0.3, tables=8)) == want


def test_empty_and_unkeyed(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lattice.near_vectors(empty).count() == 0
    rows = [(None, [1.0, 2.0], 1, "x", "y"), (4, [1.0, 2.0], 1, "x", "y"), (None, [1.0], 1, "x", "y")]
    got = {tuple(r) for r in lattice.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(None, 1, 4, False), (4, 1, 4, True), (None, 0, None, False)}


def test_query_recall(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        x, z = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        c = rng.uniform(0.975, 0.99)
        rows += [(2 * i, x.tolist(), i % 3), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * z).tolist(), i % 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want, got = brute(rows, 0.98), result(queries.QUERIES["op8_lattice"](spark, str(tmp_path)))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want) > 400
