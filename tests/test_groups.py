"""Merging, ranking, first rows, top words, topics."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reviewmill.functions.constants import FOOD_TOPICS
from reviewmill.operators import compare, merging, skew
from reviewmill.operators import words as wd
from reviewmill.operators.keywords import first_rows
from reviewmill.operators.ranking import rank_cafes
from reviewmill.plans import jobs


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    rows = []
    for i in range(500):
        shop = "hot" if rng.random() < 0.5 else f"s{rng.randrange(20)}"
        rows.append((i * 3, "u", shop, f"w{i} " + "x" * rng.randrange(30)))
    return rows


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(
        texts, "review_id long, university_name string, shop_name string, t string"
    )


@pytest.mark.parametrize("bounds", [{}, {"slice_rows": 10, "part_chars": 100}])
def test_parts_hold_the_whole_text(frame, texts, bounds):
    parts = merging.merge_text(frame, ["shop_name"], "t", "review_id", **bounds).collect()
    whole = {}
    for _, _, shop, text in texts:
        whole.setdefault(shop, []).append(text)
    got = {}
    for r in sorted(parts, key=lambda r: r.part_no):
        got.setdefault(r.shop_name, []).append(r.merged_text)
    assert {k: " ".join(v) for k, v in got.items()} == {k: " ".join(v) for k, v in whole.items()}
    assert (max(len(v) for v in got.values()) > 1) == bool(bounds)


BOUNDS = [{}, {"slice_rows": 5, "part_chars": 60}, {"slice_rows": 2, "part_chars": 1}, {"slice_rows": 100, "part_chars": 7}]


def _shops(frame, keyword, regex, **bounds):
    kept = jobs.merge_shop_text(frame, "t", keyword, "shop", regex, keys=("shop_name",), **bounds)
    return {r.shop_name for r in kept.select("shop_name").distinct().collect()}


def test_literal_across_reviews_at_any_cut(frame, texts):
    whole = {}
    for _, _, shop, text in texts:
        whole.setdefault(shop, []).append(text)
    whole = {shop: " ".join(t) for shop, t in whole.items()}
    hot = [t for _, _, s, t in texts if s == "hot"]
    for phrase in (hot[20][-3:] + " " + hot[21][:4], f"{hot[5]} {hot[6]} {hot[7]}", " ", "w1", "xx w", "none"):
        want = {shop for shop, text in whole.items() if phrase in text}
        for bounds in BOUNDS[1:3]:
            assert _shops(frame, phrase, False, **bounds) == want, (phrase, bounds)


def test_regex_sees_one_review_at_any_cut(spark):
    rows = [(1, "a", "alpha x"), (2, "a", "x beta"), (3, "b", "beta"), (4, "c", "alpha"), (5, "d", "alpha beta")]
    frame = spark.createDataFrame(rows, "review_id long, shop_name string, t string")
    for bounds in BOUNDS:
        assert _shops(frame, "^beta", True, **bounds) == {"b"}
        assert _shops(frame, "alpha$", True, **bounds) == {"c"}
        assert _shops(frame, "alpha.*beta", True, **bounds) == {"d"}


def test_parts_are_bounded_in_characters(spark):
    rows = [(i, "s", "y" * size) for i, size in enumerate([5, 90_000, 5, 5, 120_000, 3] + [10] * 300)]
    frame = spark.createDataFrame(rows, "review_id long, shop_name string, t string")
    parts = {r.part_no: r.merged_text for r in merging.merge_text(frame, ["shop_name"], "t", "review_id", part_chars=1_000).collect()}
    assert " ".join(parts[n] for n in sorted(parts)) == " ".join(t for _, _, t in rows)
    longest = {max(map(len, p.split(" "))) for p in parts.values()}
    assert longest == {90_000, 120_000, 10}
    assert all(len(p) <= 1_000 + max(map(len, p.split(" "))) for p in parts.values())


def test_first_rows(frame, texts):
    want = {}
    for row in texts:
        want.setdefault(row[2], row)
    got = {r.shop_name: tuple(r) for r in first_rows(frame, ["shop_name"], "review_id").collect()}
    assert got == want


def test_ranking_orders_and_nulls(spark):
    rng = random.Random(5)
    rows = [
        (f"u{i % 3}", f"c{i % 40:02d}", rng.choice([None, 1.5, 4.72, 3.0]), rng.randrange(9), rng.choice([None, 1, 7]))
        for i in range(150)
    ]
    core = spark.createDataFrame(
        rows, "university string, cafeName string, avgRating float, reviewerCount int, visitCount int"
    )
    from reviewmill.operators.ranking import aggregate_cafes

    cafes = [tuple(r) for r in aggregate_cafes(core).collect()]
    ranked = rank_cafes(core, 4).collect()
    for category, signs in [
        ("high_rating_low_visit_high_review_cafes", (1, -1, 1)),
        ("low_rating_high_visit_low_review_cafes", (-1, 1, -1)),
    ]:
        for university in ("u0", "u1", "u2"):
            mine = [c for c in cafes if c[0] == university]

            def key(c, signs=signs):
                values = (c[2], c[4], c[3])
                out = []
                for value, sign in zip(values, signs, strict=True):
                    out += [0 if value is not None else sign, -sign * (value or 0)]
                return (*out, c[1])

            want = [c[1] for c in sorted(mine, key=key)][:4]
            got = sorted(
                (r.rank, r.cafeName)
                for r in ranked
                if r.category == category and r.university == university
            )
            assert [name for _, name in got] == want


def test_float_average_keeps_single_precision_digits(spark):
    core = spark.createDataFrame(
        [("u", "c", 4.72, 1, 1)],
        "university string, cafeName string, avgRating double, reviewerCount int, visitCount int",
    )
    assert rank_cafes(core, 1).first().avgRating == 4.71999979019165


def test_topics_first_wins():
    table = dict(wd.topic_table(FOOD_TOPICS))
    assert table["초코"] == "디저트" and table["타르트"] == "디저트" and table["베이글"] == "특수음식"


def test_topic_profile(spark):
    top = spark.createDataFrame(
        [("a", "초코", 3, 1), ("a", "커피", 2, 2), ("b", "원두", 5, 1)],
        "u string, word string, n long, rank int",
    )
    got = {r.u: r.asDict() for r in wd.topic_profile(top, "u").collect()}
    assert got["a"]["디저트"] == 3 and got["a"]["기타"] == 2 and got["a"]["음료"] == 0
    assert got["b"]["음료"] == 5


def test_salted_join_matches_plain_join(spark):
    left = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    right = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert sorted(map(str, skew.salted_join(left, right, ["k"], how, 5).collect())) == plain


def test_hot_key_join_matches_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id") % 50)
        .alias("k"),
        "id",
    )
    right = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = sorted(map(str, left.join(right, ["k"], how).collect()))
        got = skew.hot_key_join(left, right, ["k"], how, hot_rows=100)
        assert sorted(map(str, got.collect())) == plain


def test_fits_broadcast(spark):
    small = spark.createDataFrame([("a",), ("bb",)], "word string")
    assert skew.fits_broadcast(small)
    assert not skew.fits_broadcast(small, rows=1)
    assert not skew.fits_broadcast(small, chars=2)


def test_cosine_blocks_do_not_change_the_result(spark):
    rng = random.Random(1)
    rows = [(f"g{g}", f"w{w}", rng.randrange(1, 9)) for g in range(12) for w in rng.sample(range(15), 6)]
    top = spark.createDataFrame(rows, "g string, word string, n long")
    results = []
    for blocks in (1, 4):
        pairs = compare.cosine_similarity(top, "g", blocks=blocks).collect()
        results.append(sorted((r.g1, r.g2, round(r.cosine, 9)) for r in pairs))
    assert results[0] == results[1]
    vectors = {}
    for g, w, n in rows:
        vectors.setdefault(g, {})[w] = n
    for g1, g2, cosine in results[0]:
        dot = sum(n * vectors[g2].get(w, 0) for w, n in vectors[g1].items())
        norm = lambda v: sum(n * n for n in v.values()) ** 0.5
        assert cosine == pytest.approx(dot / norm(vectors[g1]) / norm(vectors[g2]), abs=1e-8)


def test_outliers_beyond_one_block_of_centres(spark):
    import numpy as np

    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(2_600, 3)).round(3)
    rows = [(i, i // 2, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, v array<double>")
    frame = frame.unionByName(frame.filter("vec_id = 7"))  # a row that repeats stays twice
    members = {}
    for r in frame.collect():
        members.setdefault(r.label, []).append(r.v)
    centres = np.array([np.mean(m, axis=0) for m in members.values()])
    want = np.sqrt(((vectors[:, None] - centres[None]) ** 2).sum(2)).min(1)
    every = np.append(want, want[7])
    limit = every.mean() + every.std(ddof=1)
    found = compare.centroid_outliers(frame, "v", "label")
    assert found.columns == ["vec_id", "label", "v", "distance_to_center", "is_noise"]
    got = found.collect()
    assert sorted(r.vec_id for r in got) == sorted([*range(2_600), 7])
    for r in got:
        assert r.distance_to_center == pytest.approx(want[r.vec_id], abs=1e-9)
        assert r.is_noise == (want[r.vec_id] > limit)


def test_part_offsets_without_rejoining(spark):
    import hashlib

    draw = random.Random(8)
    rows = [(i, "ab"[i % 7 == 0], "".join(draw.choices("xyü😀 ", k=draw.randrange(0, 30)))) for i in range(400)]
    frame = spark.createDataFrame(rows, "review_id long, shop_name string, t string")
    parts = jobs.merge_shop_text(frame, "t", keys=("shop_name",), slice_rows=4, part_chars=50)
    found = merging.part_offsets(parts, ["shop_name"], "merged_text", block_parts=3).collect()
    for shop in "ab":
        whole = " ".join(t for _, s, t in rows if s == shop)
        mine = sorted((r for r in found if r.shop_name == shop), key=lambda r: r.part_no)
        assert len(mine) > 9
        for r in mine:
            assert r.digest == hashlib.md5(whole[r.begin : r.begin + r.n_chars].encode()).hexdigest()
        ends = [r.begin + r.n_chars for r in mine]
        assert [r.begin for r in mine] == [0, *(e + 1 for e in ends[:-1])] and ends[-1] == len(whole)


def _plane(rows):
    """Two components of the centred matrix, by singular values, and the centred matrix."""
    import numpy as np

    groups = sorted({g for g, _, _ in rows})
    words = {w: i for i, w in enumerate(sorted({w for _, w, _ in rows}))}
    matrix = np.zeros((len(groups), len(words)))
    for g, w, n in rows:
        matrix[groups.index(g), words[w]] = n
    matrix -= matrix.mean(axis=0)
    u, s, _ = np.linalg.svd(matrix, full_matrices=False)
    want = u[:, :2] * s[:2]
    longest = want[np.abs(want).argmax(axis=0), range(want.shape[1])]
    return groups, want * np.where(longest < 0, -1, 1), matrix


def test_principal_components_match_numpy(spark):
    import numpy as np

    rng = random.Random(2)
    few = [(f"g{g}", f"w{w}", rng.randrange(1, 90)) for g in range(9) for w in rng.sample(range(14), 6)]
    # 120 groups, and more than 5,000 words, most of them in one group only
    many = [(f"g{g}", f"w{int(12_000 * rng.random() ** 2)}", rng.randrange(1, 90)) for g in range(120) for _ in range(90)]
    many = list({(g, w): (g, w, n) for g, w, n in many}.values())
    assert len({w for _, w, _ in many}) > 4_096
    for rows in (few, many):
        top = spark.createDataFrame(rows, "g string, word string, n long")
        groups, want, _ = _plane(rows)
        placed = {r.g: r.pc for r in compare.principal_components(top, "g").collect()}
        assert sorted(placed) == groups
        assert np.allclose([placed[g] for g in groups], want, atol=1e-6)


def test_two_clusters_by_loops(spark):
    import numpy as np

    rng = random.Random(4)
    rows = [(f"g{g}", f"w{rng.randrange(12) + 8 * (g % 3 == 0)}", rng.randrange(1, 9)) for g in range(40) for _ in range(6)]
    rows = list({(g, w): (g, w, n) for g, w, n in rows}.values())
    top = spark.createDataFrame(rows, "g string, word string, n long")
    groups, want, matrix = _plane(rows)
    side = (want[:, 0] > 0).astype(int)
    while True:
        far = np.array([((matrix - matrix[side == c].mean(axis=0)) ** 2).sum(1) for c in (0, 1)])
        nearer = (far[1] < far[0]).astype(int)
        if (nearer == side).all():
            break
        side = nearer
    placed = compare.principal_components(top, "g")
    found = {r.g: r.cluster for r in compare.two_clusters(top, placed, "g").collect()}
    assert [found[g] for g in groups] == side.tolist()


def test_components_of_few_groups(spark):
    schema = "g string, word string, n long"
    for rows in ([], [("a", "x", 1)], [("a", "x", 1), ("b", "x", 1)]):
        top = spark.createDataFrame(rows, schema)
        placed = compare.principal_components(top, "g")
        assert sorted((r.g, *r.pc) for r in placed.collect()) == [(g, 0, 0) for g in sorted({g for g, _, _ in rows})]
        assert {r.cluster for r in compare.two_clusters(top, placed, "g").collect()} <= {0}
    flagged = jobs.compare_universities(spark.createDataFrame([("a", "x", 1, 1), ("b", "x", 3, 1)], schema + ", rank int"), "g")
    got = sorted((r.g, round(abs(r.pc1), 9), r.cluster) for r in flagged.collect())
    assert [(g, p) for g, p, _ in got] == [("a", 1), ("b", 1)] and sorted(c for *_, c in got) == [1, 2]



@pytest.mark.parametrize("spread", [0.5, 30.0])
def test_nearest_of_very_many_centres(spark, spread):
    """20,000 centres: exact; a point is copied less than half as often as there are blocks of 1,024
    centres, and compared with less than a tenth of the centres."""
    import numpy as np

    draw = np.random.default_rng(6)
    middles = draw.normal(scale=20, size=(100, 2))
    centres = np.concatenate([m + draw.normal(scale=spread, size=(200, 2)) for m in middles])
    centres[7] = centres[8]
    points = draw.normal(scale=30, size=(2_000, 2))
    means = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "c int, m array<double>")
    rows = [(i, p.tolist(), 1) for i, p in enumerate(points)] + [(-1, None, 1), (0, points[0].tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>, cell int")
    got = compare._nearest_in_cells(frame, "v", means, len(centres), 1024).collect()
    assert sorted(r.vec_id for r in got) == [-1, 0, *range(2_000)]
    want = np.sqrt(((points[:, None] - centres[None]) ** 2).sum(2)).min(1)
    for r in got:
        assert r.distance_to_center == (None if r.vec_id < 0 else pytest.approx(want[r.vec_id], abs=1e-9))
    cells, members = compare.centre_cells(means, len(centres), 1024)
    assert members.selectExpr("sum(size(_centres))").first()[0] == len(centres)
    asked = compare.cells_asked(frame, "v", cells)
    assert asked.count() < 10 * len(rows)
    compared = asked.join(members, "_cell").selectExpr("sum(size(_centres))").first()[0]
    assert compared < 0.1 * len(rows) * len(centres)


@pytest.mark.parametrize("seed", [1, 2])
def test_combiner_holds_a_batch_and_one_key(spark, seed):
    from reviewmill.operators import hooks

    draw = random.Random(seed)
    rows = [(f"k{i}", "x", 1) for i in range(3_000)]  # a key of its own per row
    rows += [("hot", draw.choice(["x", None]), 2) for _ in range(3_000)] + [(None, "x", 3)] * 500
    draw.shuffle(rows)

    def total(batch):
        assert len(batch) <= 101
        return batch.groupby(["a", "b"], as_index=False, dropna=False)["n"].sum()

    schema = "a string, b string, n long"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 100)
    try:
        got = [tuple(r) for r in hooks.combine_by_key(frame, ["a", "b"], total, schema).collect()]
    finally:
        spark.conf.set(setting, before)
    want = {}
    for a, b, n in rows:
        want[a, b] = want.get((a, b), 0) + n
    assert len(got) == len(want) and {(a, b): n for a, b, n in got} == want
    assert hooks.combine_by_key(frame.limit(0), ["a", "b"], total, schema).collect() == []


def test_places_of_all_rows(spark):
    from reviewmill.operators import ordering

    draw = random.Random(9)
    rows = [(i, draw.choice([None, 1, 2, 3]), draw.choice("aéZ日"), "r") for i in range(1_000)]
    frame = spark.createDataFrame(rows, "id int, n int, word string, row string").repartition(7)
    got = ordering.with_place(frame, ["-n", "word", "id"]).collect()
    assert frame.columns + ["place"] == got[0].__fields__
    want = sorted(rows, key=lambda r: (-(r[1] or 0), r[2].encode(), r[0]))
    assert [tuple(r)[:4] for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 1_001))
    assert ordering.with_place(frame.limit(0), ["id"]).collect() == []


def test_tagger_output_comes_in_bounded_batches(spark, monkeypatch):
    import pyarrow as pa

    from reviewmill.operators import hooks

    def tagger(text):
        return [(w, w.upper(), "Noun") for w in text.split()]

    monkeypatch.setattr(hooks, "TAG_TOKENS", 4)
    texts = ["a b c", "", "d e f g h i j k l", "m"]
    rows = pa.RecordBatch.from_arrays([pa.array([7, 8, 9, 10]), pa.array(texts)], ["id", "t"])
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    found = list(hooks._token_batches(tagger, rows, types))
    assert [b.num_rows for b in found] == [4, 4, 4, 1]
    want = [(i, n, w, w.upper(), "Noun") for i, t in zip([7, 8, 9, 10], texts, strict=True) for n, w in enumerate(t.split())]
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == want
    frame = spark.createDataFrame([(1, "x y"), (2, None), (None, "z"), (3, "")], "review_id long, t string")
    got = hooks.tag_with(frame, "t", "review_id", lambda: tagger).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "x", "X", "Noun"), (1, 1, "y", "Y", "Noun")]
