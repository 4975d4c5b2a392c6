"""Density clustering against a brute-force version."""

from __future__ import annotations

import numpy as np
import pytest

from reviewmill.operators import density


def brute_force(vectors, eps, min_samples):
    v = np.asarray(vectors, dtype=float)
    norm = np.linalg.norm(v, axis=1)
    unit = v / np.where(norm > 0, norm, 1)[:, None]
    near = (1 - unit @ unit.T) <= eps
    np.fill_diagonal(near, True)
    core = near.sum(axis=1) >= min_samples
    labels = np.full(len(v), -1)
    cluster = 0
    for i in range(len(v)):
        if not core[i] or labels[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] >= 0:
                continue
            labels[j] = cluster
            if core[j]:
                stack += [k for k in np.flatnonzero(near[j]) if labels[k] < 0]
        cluster += 1
    return labels, core, near.sum(axis=1)


def blobs(seed, copies=0, zeros=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 6))
    points = [centres[rng.integers(5)] + rng.normal(scale=0.25, size=6) for _ in range(150)]
    points += [rng.normal(size=6) for _ in range(60)]
    points += [points[0]] * copies + [np.zeros(6)] * zeros
    return [[float(np.float32(x)) for x in p] for p in points]


def run(spark, points, eps, **options):
    rows = list(enumerate(points))
    frame = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r.id: (r.cluster, r.is_core) for r in density.dbscan(frame, "id", "v", eps, 5, **options).collect()}
    return np.array([got[i][0] for i in range(len(rows))]), np.array([got[i][1] for i in range(len(rows))])


@pytest.mark.parametrize(
    "eps, options, extra",
    [
        (0.02, {}, {}),
        (0.1, {"pivots": 7, "block": 20}, {"copies": 90}),
        (0.3, {"pivots": 3, "block": 40}, {"zeros": 7}),
        (1.0, {"pivots": 16}, {"copies": 20, "zeros": 3}),
    ],
)
def test_dbscan(spark, eps, options, extra):
    points = blobs(11, **extra)
    labels, core, _ = brute_force(points, eps, 5)
    got_labels, got_core = run(spark, points, eps, **options)
    assert (got_core == core).all()
    assert (got_labels == labels).all()


def test_neighbour_counts(spark):
    points = blobs(4, copies=30)
    _, _, counts = brute_force(points, 0.2, 5)
    frame = spark.createDataFrame(list(enumerate(points)), "id long, v array<float>")
    got = {
        r.id: r.neighbours
        for r in density.neighbour_counts(frame, "id", "v", 0.2, pivots=9, block=25).collect()
    }
    assert [got[i] for i in range(len(points))] == counts.tolist()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = {r.node: r.root for r in density.connected_components(frame).collect()}
    assert all(roots[i] == 0 for i in range(61)) and roots[101] == 100
    assert density.connected_components(frame.limit(0)).count() == 0


def test_empty_input(spark):
    frame = spark.createDataFrame([], "id long, v array<float>")
    assert density.dbscan(frame, "id", "v").count() == 0


def test_hot_joins_inside_dbscan(spark, monkeypatch):
    from reviewmill.operators import skew

    monkeypatch.setattr(skew.hot_key_join, "__defaults__", ("inner", 20))
    points = blobs(8, copies=60)
    labels, core, _ = brute_force(points, 0.1, 5)
    got_labels, got_core = run(spark, points, 0.1, pivots=5, block=30)
    assert (got_core == core).all() and (got_labels == labels).all()


def test_blocks_grow_with_the_data_within_a_bound(spark):
    """A point meets as many blocks however many points there are, while vectors fit a block."""

    def reps(count, size):
        return spark.range(count).select(density.F.array_repeat(density.F.lit(0.0), size).alias("vec"))

    for count in (8 * 1024, 40_000):
        assert -(-count // density._block_of(reps(count, 6))) == density.BLOCKS
    assert density._block_of(reps(40_000, 20_000)) == density.BLOCK_BYTES // 160_000
    assert density._block_of(reps(0, 6)) >= 1


def block(vectors, first=0):
    ids = np.arange(first, first + len(vectors))
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    return density.pd.DataFrame({"rep": ids, "w": 1, "vec": list(unit), "part": ids})


def tested_pairs(monkeypatch):
    sizes, call = [], density._Near.__call__

    def counted(self, rows, columns):
        sizes.append(len(rows) * len(columns))
        return call(self, rows, columns)

    monkeypatch.setattr(density._Near, "__call__", counted)
    return sizes


def test_joined_points_are_not_tested_again(monkeypatch):
    monkeypatch.setattr(density, "COLUMNS", 50)
    draw = np.random.default_rng(2)
    q = block(np.concatenate([draw.normal(size=(1000, 4)) + 4, draw.normal(size=(20, 4)) - 4]))
    sizes = tested_pairs(monkeypatch)
    edges = density._edge_kernel(0.3)(q, q)
    root = np.arange(len(q))
    for a, b in zip(edges["a"], edges["b"], strict=True):
        root[root == root[a]] = root[b]
    labels, _, _ = brute_force(np.stack(q["vec"]), 0.3, 1)
    assert len({*zip(root, labels, strict=True)}) == len(set(root)) == len(set(labels)) > 1
    assert sum(sizes) < len(q) ** 2 / 4


def test_core_points_leave_a_block_early(monkeypatch):
    monkeypatch.setattr(density, "COLUMNS", 50)
    draw = np.random.default_rng(3)
    q = block(np.concatenate([draw.normal(size=(1000, 4)) + 4, draw.normal(size=(20, 4))]))
    _, _, counts = brute_force(np.stack(q["vec"]), 0.05, 5)
    sizes = tested_pairs(monkeypatch)
    found = density._neighbour_kernel(0.05, 5)(q, q)
    n = found.dropna(subset="n").set_index("q")["n"]
    assert ((n >= 5).to_numpy() == (counts >= 5)).all() and (n[counts < 5] == counts[counts < 5]).all()
    assert found.dropna(subset="x").groupby("q").size().to_dict() == {i: c for i, c in enumerate(counts) if c < 5}
    assert sum(sizes) < len(q) ** 2 / 2
    exact = density._neighbour_kernel(0.05, 0)(q, q)
    assert (exact["n"].to_numpy() == counts).all()


def test_hashed_embedding_has_a_place_for_every_count(spark):
    from hashlib import md5

    from reviewmill.operators import embedding

    texts = ["a b b", "", None, "a\u3000a\u001cb", " ".join(f"w{i}" for i in range(5000))]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    vectors = embedding.embed_hashing(frame, "t", "id", 16)
    assert "transform(" not in vectors._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r.id: list(r.embedding) for r in vectors.collect()}
    for i, text in enumerate(texts):
        n = np.zeros(16)
        for word in (text or "").split():
            n[int(md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        assert got[i] == list((n / max(1.0, np.sqrt((n * n).sum()))).astype("float32"))


def test_what_the_ring_settles_meets_no_other_block(spark, monkeypatch):
    draw = np.random.default_rng(5)
    points = np.concatenate([draw.normal(size=(400, 3)) + 4, draw.normal(size=(20, 3))]).astype("float32").tolist()
    asked, meet = [], density._meet
    monkeypatch.setattr(density, "_meet", lambda q, *rest: asked.append(q.count()) or meet(q, *rest))
    labels, core, _ = brute_force(points, 0.02, 5)
    got_labels, got_core = run(spark, points, 0.02, pivots=1, block=100)
    assert (got_core == core).all() and (got_labels == labels).all()
    assert len(asked) == 2 and max(asked) < len(points) / 3


def test_no_point_is_copied_for_the_blocks_that_it_meets(spark, monkeypatch):
    """However many blocks there are, a point leaves its task once; blocks stay within their bound."""
    points = blobs(6, copies=5)
    frame = spark.createDataFrame(list(enumerate(points)), "id long, v array<float>")
    met, meet = [], density._meet
    monkeypatch.setattr(density, "_meet", lambda *options: met.append(meet(*options)) or met[-1])
    got = {r.id: r.neighbours for r in density.neighbour_counts(frame, "id", "v", 1.5, pivots=5, block=10).collect()}
    assert [got[i] for i in range(len(points))] == brute_force(points, 1.5, 5)[2].tolist()
    plan = met[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "Exchange" not in plan
    kernel_sizes = [r.n for r in met[0].filter("n IS NOT NULL").groupBy("q").agg(density.F.count("q").alias("n")).collect()]
    assert min(kernel_sizes) >= len({tuple(p) for p in points}) // 10  # a row per block that a point meets


def test_texts_are_counted_where_they_are_read(spark, monkeypatch):
    """No token is a row: a text leaves its task once. Rows of one id are one text, and long texts come in parts."""
    from hashlib import md5

    from reviewmill.operators import embedding

    monkeypatch.setattr(embedding, "CHARS_AT_ONCE", 12)
    texts = ["a b b", "", None, "  \n ", "b c\x1fd e", " ".join(f"w{i} é" for i in range(60)), "x" * 40]
    rows = [*enumerate(texts), (0, "a z"), (None, "n m"), (None, "n")]
    frame = spark.createDataFrame(rows, "id long, t string")
    vectors = embedding.embed_hashing(frame, "t", "id", 16)
    assert "Generate" not in vectors._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: list(r.embedding) for r in vectors.collect()}
    whole = dict(enumerate(texts)) | {0: "a b b a z", None: "n m n"}
    assert len(got) == len(whole)
    for i, text in whole.items():
        n = np.zeros(16)
        for word in (text or "").split():
            n[int(md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        assert got[i] == list((n / max(1.0, np.sqrt((n * n).sum()))).astype("float32"))
    (count,) = embedding._places(embedding.pa.array(["b a b"]), 1 << 31)
    assert count[0].tolist() == [0, 0, 0] and count[1][0] == count[1][2] != count[1][1]


def test_the_sample_settles_dense_points_before_blocks_meet(spark, monkeypatch):
    """Points of several dense clusters are proven without a neighbour outside the sample."""
    draw = np.random.default_rng(9)
    centres = np.eye(8)[:4] * 9
    points = np.concatenate([c + draw.normal(size=(150, 8)) for c in centres] + [draw.normal(size=(12, 8))])
    points = points.astype("float32").tolist()
    met, compared = [], density._compared
    monkeypatch.setattr(density, "_compared", lambda q, *rest: met.append(q.count()) or compared(q, *rest))
    labels, core, _ = brute_force(points, 0.3, 5)
    got_labels, got_core = run(spark, points, 0.3, block=50)
    assert (got_core == core).all() and (got_labels == labels).all()
    assert max(met[:2]) <= (~core).sum() + 5  # counts: what is sparse, not three quarters of all points


def test_pairs_at_the_radius_are_decided_exactly(monkeypatch):
    """Four words against four, two of them shared, or 256 words against 6: similarity 0.5 whatever the order of sums."""
    monkeypatch.setattr(density, "COLUMNS", 7)
    draw = np.random.default_rng(4)
    q = np.zeros((300, 64))
    for row in q:
        row[draw.choice(64, draw.choice([4, 8, 12, 16]), replace=False)] = 1
    unit = (q / np.sqrt((q * q).sum(axis=1))[:, None]).astype("float32").astype("float64")
    dots, n = q @ q.T, (q * q).sum(axis=1)
    frame = density.pd.DataFrame({"rep": np.arange(300), "w": 1, "vec": list(q), "part": density._NO_PART})
    near = density._neighbour_kernel(0.5, 0)(frame, frame)["n"].to_numpy()
    assert (near == (2 * dots >= np.sqrt(np.outer(n, n))).sum(axis=1)).all()
    norms = (unit * unit).sum(axis=1)
    frame["vec"] = list(unit)
    near = density._neighbour_kernel(0.5, 0)(frame, frame)["n"].to_numpy()
    assert (near == (1 - np.clip(unit @ unit.T / np.sqrt(np.outer(norms, norms)), -1, 1) <= 0.5).sum(axis=1)).all()
