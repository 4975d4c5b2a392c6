"""Comparing groups by their top words: similarity, clustering, outliers.

Input is the long table ``group, word, n`` of the top words of each group, that is a sparse
group-by-term matrix with at most k entries per group.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.skew import cut_lineage, lookup_join

# columns that an iteration of the principal components adds, and how exact these are
BLOCK = 22
EXACT = 1e-11
# a share of the table's sum of squares that rounding alone can make up
NOISE = 1e-12
CENTRE_BLOCK = 1024
# what rounding can take from a bound between distances
CELL_SLACK = 1e-9
PAIR_BLOCKS = 8


def cosine_similarity(
    top: DataFrame, key: str, value: str = "n", blocks: int = PAIR_BLOCKS
) -> DataFrame:
    """Non-zero cosine similarities ``g1, g2, cosine``; a pair that is missing has 0.

    Groups meet through the words they share, never through a cross product of groups. Each
    unordered pair is formed once; a word shared by very many groups is spread over
    ``blocks * blocks`` tasks.
    """
    entries = F.collect_list(F.struct("word", F.col(value).cast("double").alias("n")))
    grouped = top.groupBy(key).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"), entries.alias("e"))
    # at most k rows per group, written once: both sides of the join read it
    unit = cut_lineage(
        grouped.select(F.col(key).alias("g"), "norm", F.explode("e").alias("e")).select(
            "g",
            "e.word",
            (F.col("e.n") / F.col("norm")).alias("w"),
            F.pmod(F.xxhash64("g"), F.lit(blocks)).cast("int").alias("own"),
        )
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = unit.select(F.col("g").alias("g1"), "word", F.col("w").alias("w1"), F.col("own").alias("b1"))
    right = unit.select(F.col("g").alias("g2"), "word", F.col("w").alias("w2"), F.col("own").alias("b2"))
    left = left.withColumn("b2", every)
    right = right.withColumn("b1", every)
    half = (
        left.join(right, ["word", "b1", "b2"])
        .filter("g1 < g2")
        .groupBy("g1", "g2")
        .agg(F.sum(F.col("w1") * F.col("w2")).alias("cosine"))
    )
    mirrored = half.select(
        F.explode(
            F.array(
                F.struct(F.col("g1"), F.col("g2")),
                F.struct(F.col("g2").alias("g1"), F.col("g1").alias("g2")),
            )
        ).alias("p"),
        "cosine",
    ).select("p.g1", "p.g2", "cosine")
    diagonal = unit.select(F.col("g").alias("g1"), F.col("g").alias("g2")).distinct()
    diagonal = diagonal.withColumn("cosine", F.lit(1.0))
    return mirrored.unionByName(diagonal)


def similarity_matrix(pairs: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Wide matrix: one row and one column per group, absent pairs 0.

    Without ``groups`` the column names are looked up, which Spark limits to 10,000.
    """
    return pairs.groupBy("g1").pivot("g2", groups).agg(F.first("cosine")).fillna(0.0)


def _times(rows: Column, matrix: np.ndarray) -> Column:
    """Row vectors times a small matrix of the driver."""
    columns = F.from_json(F.lit(json.dumps(matrix.T.tolist())), "array<array<double>>")
    return F.transform(columns, lambda c: _inner(rows, c))


def _inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def _products(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the columns of ``q`` and of ``y`` with those of ``y``, over all groups."""
    outer = F.transform(F.concat("q", "y"), lambda a: F.transform("y", lambda b: a * b))
    total = state.agg(
        F.max(F.size("q")).alias("known"),
        F.max(F.size("y")).alias("new"),
        Summarizer.sum(array_to_vector(F.flatten(outer))).alias("s"),
    ).first()
    found = total["s"].toArray().reshape(total["known"] + total["new"], total["new"])
    return found[: total["known"]], found[total["known"] :]


def _extended(state: DataFrame, least: float) -> tuple[DataFrame | None, np.ndarray, np.ndarray]:
    """``g, q, y`` to ``g, q`` with the part of ``y`` outside ``q`` as further orthonormal columns
    (None if nothing longer than ``least`` is left); the products of ``q`` and ``y``, and those of
    the part outside with itself. Projected twice, as once is not orthogonal to the last digits."""
    first, _ = _products(state)
    state = cut_lineage(state.withColumn("y", _minus(F.col("y"), _times(F.col("q"), first))))
    second, rest = _products(state)
    rest = rest - second.T @ second
    lengths, axes = np.linalg.eigh((rest + rest.T) / 2)
    kept = lengths > least**2
    if not kept.any():
        return None, first + second, rest
    scaled = axes[:, kept] / np.sqrt(lengths[kept])
    outside = _minus(F.col("y"), _times(F.col("q"), second))
    grown = state.select("g", "q", outside.alias("y")).select("g", F.concat("q", _times(F.col("y"), scaled)).alias("q"))
    return cut_lineage(grown), first + second, rest


def _multiplied(entries: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """``state`` with ``y``: matrix times its transpose times the last ``width`` columns of ``q``."""
    last = F.slice("q", -width, width)
    places = [f"y{i}" for i in range(width)]
    known = state.select("g", *[F.get(last, F.lit(i)).alias(c) for i, c in enumerate(places)])
    sums = [F.sum(F.col("x") * F.col(c)).alias(c) for c in places]
    by_word = entries.join(known, "g").groupBy("word").agg(*sums)
    by_group = entries.join(by_word, "word").groupBy("g").agg(*sums)
    return cut_lineage(state.join(by_group.select("g", F.array(*places).alias("y")), "g"))


def principal_components(top: DataFrame, key: str, value: str = "n", k: int = 2) -> DataFrame:
    """``key, pc``: centred projection of the groups on their first k principal components.

    The sparse table stays a table: a block Lanczos iteration multiplies ``BLOCK`` columns per
    group by the matrix and its transpose (two joins), and the driver sees inner products of
    columns only, so neither words nor groups are limited. A constant first column centres
    the groups. It ends when the components are exact to ``EXACT`` of the largest singular
    value squared, or when no further direction is left. Of each component the coordinate that
    is largest in absolute value is positive. Missing components are 0, as for a single group, and
    so are those below ``NOISE`` of the sum of squares.
    """
    entries = cut_lineage(top.select(F.col(key).alias("g"), "word", F.col(value).cast("double").alias("x")))
    groups = cut_lineage(entries.select("g").distinct())
    count = groups.count()
    if count == 0:
        return groups.select(F.col("g").alias(key), F.array().cast("array<double>").alias("pc"))
    noise = NOISE * entries.agg(F.sum(F.col("x") * F.col("x"))).first()[0]
    width = min(BLOCK + k, count)
    start = [F.xxhash64("g", F.lit(i)) / F.lit(2.0**63) for i in range(width)]
    constant = F.array(F.lit(1 / np.sqrt(count))).alias("q")
    state = groups.select("g", constant)
    added, _, _ = _extended(cut_lineage(state.withColumn("y", F.array(*start))), 1e-9)
    known = np.zeros((0, 0))
    values, axes = np.zeros(0), np.zeros((0, 0))
    size = 0
    while added is not None:
        state = added
        width = state.select(F.size("q")).first()[0] - 1 - size
        size += width
        added, products, rest = _extended(_multiplied(entries, state, width), noise)
        grown = np.zeros((size, size))
        grown[: size - width, : size - width] = known
        grown[:, size - width :] = products[1:]
        grown[size - width :] = products[1:].T
        known = grown
        values, axes = np.linalg.eigh((known + known.T) / 2)
        ends = axes[size - width :, -k:]
        left = np.sqrt(np.maximum(np.einsum("ik,ij,jk->k", ends, rest, ends), 0))
        if size >= k and (left <= max(EXACT * values.max(), noise)).all():
            break
    found = np.zeros((size + 1, k))
    for i in range(min(k, size)):
        found[1:, i] = axes[:, -1 - i] * np.sqrt(values[-1 - i] if values[-1 - i] > noise else 0.0)
    placed = cut_lineage(state.select("g", _times(F.col("q"), found).alias("pc")))
    one = [F.get("pc", F.lit(i)) for i in range(k)]
    signs = placed.agg(*[F.max_by(c, F.abs(c)).alias(f"s{i}") for i, c in enumerate(one)]).first()
    turned = [c * F.lit(-1.0 if s < 0 else 1.0) for c, s in zip(one, signs, strict=True)]
    return placed.select(F.col("g").alias(key), F.array(*turned).alias("pc"))


def two_clusters(top: DataFrame, placed: DataFrame, key: str, value: str = "n", rounds: int = 100) -> DataFrame:
    """``key, cluster``: groups in two clusters, 0 and 1, of small squared distances to their means.

    ``placed`` is the result of ``principal_components``: the sign of the first one (positive
    is 1) begins, then groups move to the nearer mean (equally near: 0) until none moves. Means
    stay a table by word. All groups are in cluster 0 if they don't differ.
    """
    entries = cut_lineage(top.select(F.col(key).alias("g"), "word", F.col(value).cast("double").alias("x")))
    side = (F.get("pc", F.lit(0)) > 0).cast("int").alias("c")
    state = cut_lineage(placed.select(F.col(key).alias("g"), side))
    for _ in range(rounds):
        sizes = {r["c"]: r["count"] for r in state.groupBy("c").count().collect()}
        if len(sizes) < 2:
            break
        own = entries.join(state, "g")
        mean = {c: F.coalesce(F.sum(F.when(F.col("c") == c, F.col("x"))), F.lit(0.0)) / sizes[c] for c in sizes}
        means = cut_lineage(own.groupBy("word").agg(mean[0].alias("m0"), mean[1].alias("m1")))
        apart = means.agg(F.sum(F.col("m1") * F.col("m1") - F.col("m0") * F.col("m0"))).first()[0]
        toward = F.sum(F.col("x") * (F.col("m1") - F.col("m0")))
        moved = own.join(means, "word").groupBy("g", F.col("c").alias("before")).agg(
            (toward > F.lit(apart / 2)).cast("int").alias("c")
        )
        moved = cut_lineage(moved)
        state = moved.select("g", "c")
        if moved.filter("c <> before").isEmpty():
            break
    return state.select(F.col("g").alias(key), F.col("c").alias("cluster"))


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def centroid_outliers(
    points: DataFrame,
    vector: str,
    cluster: str,
    std_factor: float = 1.0,
    block: int = CENTRE_BLOCK,
) -> DataFrame:
    """Distance of every point to the nearest cluster centre (of any cluster) and a flag for
    distances above mean + ``std_factor`` sample standard deviations.

    ``vector`` is an array of numbers. Up to ``block`` centres are a scalar subquery. More of
    them stay a table of cells, and a point meets only the cells that can hold its nearest centre.
    """
    arrays = points.withColumn("_v", F.col(vector).cast("array<double>"))
    means = arrays.groupBy(cluster).agg(Summarizer.mean(array_to_vector("_v")).alias("m"))
    means = cut_lineage(means.select(F.col(cluster).alias("c"), vector_to_array("m").alias("m")))
    found = means.count()
    if found <= block:
        collected = means.agg(F.sort_array(F.collect_list(F.struct(F.col("c").cast("string"), "m"))).alias("c"))
        centres = collected.select(F.transform("c", lambda s: s["m"]).alias("m")).scalar()
        measured = arrays.withColumn("_centres", centres)
        measured = measured.withColumn("distance_to_center", _nearest(F.col("_v"), F.col("_centres")))
        measured = measured.drop("_centres", "_v")
    else:
        measured = _nearest_in_cells(points, vector, means, found, block)
    limit = measured.agg(
        (F.avg("distance_to_center") + std_factor * F.stddev_samp("distance_to_center")).alias("t")
    ).scalar()
    return measured.withColumn("is_noise", F.col("distance_to_center") > limit)


def _nearest(point: Column, centres: Column) -> Column:
    return F.array_min(F.transform(centres, lambda c: _distance(point, c)))


def centre_cells(means: DataFrame, found: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The ``found`` centres ``c, m`` in cells around some of them: rows ``cell, m, radius``, and rows
    ``_cell, _centres`` of at most about ``block`` members each, several for a large cell.

    The middles are the first by a hash, as many as the square root of all, at most ``block``; a
    centre belongs to its nearest one."""
    middles = means.orderBy(F.xxhash64("c"), F.col("c").cast("string")).limit(min(block, math.isqrt(found - 1) + 1))
    middles = cut_lineage(middles.select("c", "m"))
    kept = middles.agg(F.sort_array(F.collect_list(F.struct(F.col("c").cast("string"), "m"))).alias("c"))
    kept = cut_lineage(kept.select(F.transform("c", lambda s: s["m"]).alias("m")))
    apart = F.transform("_middles", lambda x: _distance(F.col("m"), x))
    near = means.withColumn("_middles", kept.select("m").scalar()).withColumn("_apart", apart)
    near = near.select(
        "c", "m", F.array_min("_apart").alias("d"), (F.array_position("_apart", F.array_min("_apart")) - 1).alias("_cell")
    )
    near = cut_lineage(near.filter("_cell IS NOT NULL"))
    sizes = near.groupBy("_cell").agg(F.max("d").alias("radius"), F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    numbered = kept.select(F.posexplode("m").alias("_cell", "m")).withColumn("_cell", F.col("_cell").cast("long"))
    cells = numbered.join(sizes, "_cell").select(F.col("_cell").alias("cell"), "m", "radius")
    part = F.pmod(F.xxhash64("c"), F.col("parts")).alias("part")
    members = near.join(sizes, "_cell").select("_cell", part, "m").groupBy("_cell", "part")
    return cut_lineage(cells), cut_lineage(members.agg(F.collect_list("m").alias("_centres")).drop("part"))


def cells_asked(points: DataFrame, vector: str, cells: DataFrame) -> DataFrame:
    """Rows of ``points`` with ``_cell``, one per cell that can hold the nearest centre: a centre of
    a cell is at least the distance to its middle less its radius away, and some middle (a centre
    itself) is no farther than the nearest one."""
    known = cells.agg(F.sort_array(F.collect_list(F.struct("cell", "m", "radius"))).alias("k")).select("k").scalar()
    measured = points.withColumn("_cells", known).withColumn(
        "_reach",
        F.transform("_cells", lambda s: F.struct(s["cell"], s["radius"].alias("r"), _distance(F.col(vector), s["m"]).alias("d"))),
    )
    measured = measured.withColumn("_best", F.array_min(F.transform("_reach", lambda s: s["d"])))
    within = F.filter("_reach", lambda s: s["d"] <= F.col("_best") + s["r"] + (s["d"] + s["r"]) * CELL_SLACK)
    chosen = F.explode(F.transform(within, lambda s: s["cell"])).alias("_cell")
    return measured.select(*points.columns, chosen)


def _nearest_in_cells(points: DataFrame, vector: str, means: DataFrame, found: int, block: int) -> DataFrame:
    """``points`` with ``distance_to_center``, the smallest over all ``found`` centres; null where the
    vector is null. Points are numbered and written once, as they are read for the distances and
    for the rows; only the smallest distances are shuffled."""
    numbered = cut_lineage(points.withColumn("_id", F.monotonically_increasing_id()))
    cells, members = centre_cells(means, found, block)
    asked = cells_asked(numbered.select("_id", F.col(vector).cast("array<double>").alias("_v")), "_v", cells)
    near = lookup_join(asked, members, ["_cell"]).select("_id", _nearest(F.col("_v"), F.col("_centres")).alias("_d"))
    nearest = near.groupBy("_id").agg(F.min("_d").alias("distance_to_center"))
    return numbered.join(nearest, "_id", "left").drop("_id")
