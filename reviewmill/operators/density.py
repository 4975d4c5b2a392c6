"""Exact density clustering (DBSCAN) of embeddings under cosine distance.

No pair of points is ever a row. Points are tested against each other as blocks of vectors
inside tasks, and only neighbour counts, the few neighbours of sparse points and spanning
edges leave a task. What keeps the work small:

1. Copies of a vector are one weighted point.
2. A sample, known to every task, settles most of a dense data set: a point with enough
   weight of the sample in reach is certainly core, and it belongs to the cluster of any certain
   core point of the sample in its reach. Pairs inside the largest such cluster need no test.
3. What is left ("queries") meets a small share of the points by hash first, and leaves as soon
   as it is proven to be core. The rest visits only the cells (points by nearest pivot, the first
   of the sample) that the triangle inequality on angles cannot rule out.
4. Small cells are packed together and large ones cut, into blocks of bounded size. A block is
   written once; the tasks that compare it read it from there. A few queries are known to every
   task instead, and no point is written for them.
5. Similarities are computed in single precision; the pairs that its rounding leaves open, and
   only those, are computed again in double precision.

Steps 2 to 4 only skip pairs whose outcome is already proven.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.operators.skew import cut_lineage, fits_broadcast, hot_key_join

MIN_PIVOTS, MAX_PIVOTS = 64, 2048
BLOCKS, LEAST_BLOCK, BLOCK_BYTES = 8, 1024, 1 << 23
CHUNK_PAIRS, COLUMNS, SPARSE = 1 << 20, 1024, 16
MET_BLOCKS, MET_SHARE = 2, 16
MAX_SAMPLE, SAMPLE_BYTES = 8192, 1 << 24
FEW_QUERIES, QUERY_BYTES = 8192, 1 << 24
_ANGLE_SLACK = 1e-6
_NO_PART = -(1 << 63)

_POINT = "rep long, w long, vec binary, cell int, angle double, proven boolean, open boolean, part long"
_FOUND, _EDGES = "q long, x long, n long, part long", "a long, b long"


def _unit(df: DataFrame, row_id: str, vector: str, eps: float) -> DataFrame:
    """``id, code, vec, alone``: vectors as the bytes of their values and a 128-bit digest of them,
    written once so that no embedding is made twice. A power of two keeps values from overflowing;
    it does not round them, so similarities are those of the given values.

    A zero vector stays zero. It has distance 1 to everything, its own copies included, so
    below that radius ``alone`` keeps it from being merged with its copies.
    """

    def normalize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, held = batch.columns
            sizes = set(pc.list_value_length(held).to_pylist())
            if len(sizes) > 1 or None in sizes:
                raise ValueError("vectors are null or differ in length")
            raw = held.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(ids), -1)
            largest = np.abs(raw).max(axis=1, initial=0.0)
            held = _bytes(np.ldexp(raw, -np.frexp(largest)[1][:, None]) + 0.0)  # no negative zeros
            codes = [blake2b(x, digest_size=16).digest() for x in held]
            alone = pc.if_else(pa.array((largest == 0) & (eps < 1)), ids, pa.scalar(-1, pa.int64()))
            columns = [ids, pa.array(codes, pa.binary()), pa.array(held, pa.binary()), alone]
            yield pa.RecordBatch.from_arrays(columns, ["id", "code", "vec", "alone"])

    rows = df.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vec"))
    return cut_lineage(rows.mapInArrow(normalize, "id long, code binary, vec binary, alone long"))


def _representatives(points: DataFrame) -> DataFrame:
    return cut_lineage(
        points.groupBy("code", "vec", "alone").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")
        )
    )


class _Pivots:
    """Pivot vectors, the first of the sample, and the sample (``rep, w, vec, part``), of which the
    certain core points have a part; small, sent to every task."""

    def __init__(self, sample: pd.DataFrame, count: int, eps: float):
        self.sample, self.eps = sample, eps
        self.reps = sample["rep"].to_numpy("int64")[:count]
        self.vectors = _units(sample["vec"].iloc[:count])

    def similarity(self, vectors: np.ndarray) -> np.ndarray:
        if not len(vectors):
            return np.zeros((0, len(self.reps)))
        return np.clip(vectors @ self.vectors.T, -1.0, 1.0)


def _matrix(column: pd.Series) -> np.ndarray:
    """A row per vector, which is a list of numbers or the bytes of its values."""
    if not len(column):
        return np.zeros((0, 0))
    if isinstance(column.iloc[0], bytes):
        return np.frombuffer(b"".join(column)).reshape(len(column), -1)
    return np.stack(column.to_numpy()).astype("float64", copy=False)


def _units(column: pd.Series) -> np.ndarray:
    vectors = _matrix(column)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(norm > 0, norm, 1.0)[:, None]


def _bytes(vectors: np.ndarray) -> list[bytes]:
    return [v.tobytes() for v in vectors]


def _choose_pivots(reps: DataFrame, count: int | None, eps: float) -> _Pivots:
    """A deterministic sample, the lowest hashes, and how many of it are pivots. Their number grows
    with the root of the data; both have bounds that keep them small on every machine."""
    total, most = reps.count(), count
    if count is None:
        count = min(MAX_PIVOTS, max(MIN_PIVOTS, math.isqrt(total) // 16))
        size = reps.select(_size(reps).alias("n")).first()
        most = max(count, min(MAX_SAMPLE, SAMPLE_BYTES // (8 * max(size["n"] if size else 1, 1))))
    code = F.xxhash64("rep")
    share = min(1 << 30, -(-(2 * most + 64) * (1 << 30) // max(total, 1)))  # twice as many as needed
    some = reps.filter(F.pmod(code, F.lit(1 << 30)) < share)
    lowest = some.orderBy(F.pmod(code, F.lit(1 << 30)), "rep").limit(most)
    rows = lowest.select("rep", "w", "vec").collect()
    sample = pd.DataFrame(
        {"rep": [r["rep"] for r in rows], "w": [r["w"] for r in rows], "vec": [bytes(r["vec"]) for r in rows], "part": _NO_PART}
    )
    return _Pivots(sample, count, eps)


def _sample_parts(pivots: _Pivots, min_samples: int) -> None:
    """Points of the sample that others of it prove to be core, and which of those are in one
    cluster. A part is named by its smallest point."""
    sample = pivots.sample
    n = _neighbour_kernel(pivots.eps, min_samples)(sample, sample)["n"].dropna().to_numpy("int64")
    sure = sample[n >= min_samples]
    sure = sure.assign(part=sure["rep"])
    edges = _edge_kernel(pivots.eps)(sure, sure)
    root = dict(zip(edges["a"], edges["b"], strict=True))
    sample.loc[sure.index, "part"] = [root.get(r, r) for r in sure["rep"]]


def _place(reps: DataFrame, pivots: _Pivots, min_samples: int) -> DataFrame:
    """Add cell, angle to its pivot, certain core flag, certain part (_NO_PART: none), and whether
    a point is open: neither certainly core nor, as a zero vector, certainly without neighbours.
    Without ``min_samples`` no point is proven."""
    kernel = _neighbour_kernel(pivots.eps, min_samples)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vectors = _units(b["vec"])
            similarity = pivots.similarity(vectors)
            cell = similarity.argmax(axis=1)
            proven, part = np.zeros(len(b), dtype=bool), np.full(len(b), _NO_PART)
            if min_samples:
                found = kernel(b, pivots.sample).iloc[: len(b)]
                n = found["n"].to_numpy("int64") + np.where(b["rep"].isin(pivots.sample["rep"]), 0, b["w"])
                proven = n >= min_samples
                part = np.where(proven, found["part"].to_numpy("int64"), _NO_PART)
            lone = (pivots.eps < 1) & ~vectors.any(axis=1)
            yield pd.DataFrame(
                {
                    "rep": b["rep"],
                    "w": b["w"],
                    "vec": b["vec"],
                    "cell": cell,
                    "angle": np.arccos(similarity[np.arange(len(b)), cell]),
                    "proven": proven,
                    "open": ~proven & ~lone,
                    "part": part,
                }
            )

    return cut_lineage(reps.select("rep", "w", "vec").mapInPandas(place, _POINT))


def _size(reps: DataFrame) -> Column:
    """Dimensions of a point's vector, which is bytes or a list of numbers."""
    size = F.length("vec") / 8 if dict(reps.dtypes)["vec"] == "binary" else F.size("vec")
    return size.cast("long")


def _block_of(reps: DataFrame) -> int:
    """Points of a block: an eighth of all, but within BLOCK_BYTES of vectors, whatever a task's
    memory has to hold at once."""
    count, longest = reps.agg(F.count(F.lit(1)), F.max(_size(reps))).first()
    return max(1, min(max(LEAST_BLOCK, -(-count // BLOCKS)), BLOCK_BYTES // (8 * max(longest or 1, 1))))


class _Reach:
    """Which cells (points by nearest pivot) may hold neighbours of a vector, and an order in which
    neighbouring cells stand together."""

    def __init__(self, points: DataFrame, pivots: _Pivots):
        self.pivots = pivots
        radius = np.full(len(pivots.reps), -10.0)
        for cell, r in points.groupBy("cell").agg(F.max("angle")).collect():  # at most one row per pivot
            radius[cell] = r
        widest = np.arccos(np.clip(1.0 - pivots.eps, -1.0, 1.0))
        self.limit = widest + radius + _ANGLE_SLACK
        order = np.argsort(-pivots.similarity(pivots.vectors)[:, 0], kind="stable")
        self.place = np.argsort(order)

    def __call__(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """A row per vector, a column per cell."""
        similarity = np.clip(vectors @ self.pivots.vectors[cells].T, -1.0, 1.0)
        return np.arccos(similarity) <= self.limit[cells]


_POINT_LONGS = ("rep", "w", "part")
_PACKED = (*_POINT_LONGS, "vec")


def _pack(points: DataFrame, reach: _Reach, block: int) -> DataFrame:
    """A row for each block of at most ``block`` points, written once: the points' columns as
    numbers, the cells they are in, and the cells that may hold neighbours of theirs."""
    place = F.element_at(F.lit([int(x) for x in reach.place]), F.col("cell") + 1)
    count = max(1, -(-points.count() // block))
    dealt = points.select(*_PACKED, "cell").repartitionByRange(count, place, F.xxhash64("rep"))
    cells = np.arange(len(reach.place))

    def packed(held: list[list[np.ndarray]]) -> pd.DataFrame:
        *columns, home, near = zip(*held, strict=True)
        row = {n: [np.concatenate(c).tobytes()] for n, c in zip(_PACKED, columns, strict=True)}
        return pd.DataFrame(row | {"cells": [np.unique(np.concatenate(home))], "near": [np.unique(np.concatenate(near))]})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            while len(b):
                some, b = b.iloc[: block - size], b.iloc[block - size :]
                vectors = _matrix(some["vec"])
                longs = [some[c].to_numpy("int64") for c in _POINT_LONGS]
                near = cells[reach(_units(some["vec"]), cells).any(axis=0)]
                held.append([*longs, vectors, some["cell"].to_numpy(), near])
                size += len(some)
                if size == block:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    schema = ", ".join(f"{c} binary" for c in _PACKED) + ", cells array<int>, near array<int>"
    return cut_lineage(dealt.mapInPandas(pack, schema))


def _unpack(row: list[pa.Scalar]) -> pd.DataFrame:
    *longs, vectors = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, ("i8", "i8", "i8", "f8"), strict=True))
    points = pd.DataFrame(dict(zip(_POINT_LONGS, longs, strict=True)))
    return points.assign(vec=list(vectors.reshape(len(points), -1)))


def _meet(
    queries: DataFrame, points: DataFrame, pivots: _Pivots, block: int, kernel, schema: str
) -> DataFrame:
    """``_compared`` with all points that no earlier step has compared."""
    return _compared(queries, points, pivots, block, kernel, schema)


def _compared(
    queries: DataFrame, points: DataFrame, pivots: _Pivots, block: int, kernel, schema: str
) -> DataFrame:
    """Run ``kernel(queries, points)`` on every pair of blocks that may hold neighbours.

    Each block is written once. A task reads the two blocks that it compares from there, so no
    point is copied, shuffled or written again for the blocks that it meets. Queries that are few
    are sent to every task, and the points are read where they are.
    """
    columns = pa.schema([(name, pa.int64()) for name in StructType.fromDDL(schema).names])
    few = min(block, FEW_QUERIES, QUERY_BYTES // (8 * max(1, pivots.vectors.shape[1])))
    if queries is not points and queries.count() <= few:
        return _compared_few(queries, points, kernel, schema)
    reach = _Reach(points, pivots)
    p = _pack(points, reach, block)
    q = p if queries is points else _pack(queries, reach, block)
    q = q.select("near", *[F.col(c).alias(f"q_{c}") for c in _PACKED])
    p = p.select("cells", *[F.col(c).alias(f"p_{c}") for c in _PACKED])
    # a Cartesian product reads both sides where they lie
    pairs = q.join(p.hint("shuffle_replicate_nl"), F.arrays_overlap("near", "cells"))
    pairs = pairs.select("cells", *[f"{side}_{c}" for side in "qp" for c in _PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                cells, asked, met = np.array(row[0].as_py()), _unpack(row[1:5]), _unpack(row[5:])
                parts = (asked.iloc[a : a + 1_000] for a in range(0, len(asked), 1_000))
                asked = pd.concat([part[reach(_units(part["vec"]), cells).any(axis=1)] for part in parts])
                yield pa.RecordBatch.from_pandas(kernel(asked, met), columns, preserve_index=False)

    return pairs.mapInArrow(run, schema)


def _compared_few(queries: DataFrame, points: DataFrame, kernel, schema: str) -> DataFrame:
    asked = pd.DataFrame(
        [(r["rep"], r["w"], r["part"], bytes(r["vec"])) for r in queries.select(*_PACKED).collect()], columns=_PACKED
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield kernel(asked, b)

    points = points if len(asked) else points.limit(0)
    return points.select(*_PACKED).mapInPandas(run, schema)


def _met_early(points: DataFrame, blocks: int) -> Column:
    """Which points all queries meet first: a share of them by hash, at least MET_BLOCKS blocks."""
    return F.pmod(F.xxhash64("rep"), F.lit(blocks)) < max(MET_BLOCKS, blocks // MET_SHARE)


def _enough(found: DataFrame, min_samples: int) -> DataFrame:
    """``rep`` of the queries whose counted neighbours make them core points, and a part (or null)
    that one of those neighbours is certainly in."""
    weights = found.filter("n IS NOT NULL").groupBy(F.col("q").alias("rep"))
    weights = weights.agg(F.sum("n").alias("n"), F.max("part").alias("reached"))
    return weights.filter(F.col("n") >= min_samples).select("rep", "reached")


class _Near:
    """Which points of a block of queries and a block of points are neighbours."""

    def __init__(self, q: pd.DataFrame, p: pd.DataFrame, eps: float):
        self.qv, self.pv, self.eps = _matrix(q["vec"]), _matrix(p["vec"]), eps
        (self.qn, self.q4), (self.pn, self.p4) = self.unit(self.qv), self.unit(self.pv)
        # what rounding of unit vectors and of their sums can come to
        self.slack = np.float32((self.qv.shape[1] + 8) * 2.0**-23)
        ids, others = q["rep"].to_numpy(), p["rep"].to_numpy()
        order = np.argsort(others)
        place = np.minimum(np.searchsorted(others, ids, sorter=order), len(others) - 1)
        self.itself = np.where(others[order[place]] == ids, order[place], -1)  # among the points

    def __call__(self, rows: np.ndarray, columns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Neighbour masks of some of the rows, CHUNK_PAIRS pairs at a time; ``columns`` ascend."""
        points = self.p4[columns].T
        least = np.float32(1.0 - self.eps)
        step = max(1, CHUNK_PAIRS // max(1, len(columns)))
        for start in range(0, len(rows) if len(columns) else 0, step):
            part = rows[start : start + step]
            similarity = self.q4[part] @ points
            near = similarity >= least - self.slack
            if np.count_nonzero(near) * SPARSE > near.size:
                unsure = np.flatnonzero(near & (similarity < least + self.slack))
            else:
                some = np.flatnonzero(near)
                unsure = some[similarity.ravel()[some] < least + self.slack]
            if len(unsure):
                r, c = (np.unique(x) for x in np.divmod(unsure, len(columns)))
                near[np.ix_(r, c)] = self.exact(part[r], columns[c])
            at = np.minimum(np.searchsorted(columns, self.itself[part]), len(columns) - 1)
            own = np.flatnonzero(columns[at] == self.itself[part])
            near[own, at[own]] = True
            yield part, near

    @staticmethod
    def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lengths, and unit vectors in single precision."""
        squares, units = np.einsum("ij,ij->i", vectors, vectors), np.empty(vectors.shape, dtype="float32")
        length = np.sqrt(np.where(squares > 0, squares, 1.0))[:, None]
        return squares, np.divide(vectors, length, out=units, casting="same_kind")

    def exact(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        norms = np.sqrt(self.qn[rows][:, None] * self.pn[columns])
        similarity = self.qv[rows] @ self.pv[columns].T / np.where(norms > 0, norms, 1.0)
        return (1.0 - np.clip(similarity, -1.0, 1.0)) <= self.eps


def _neighbour_kernel(eps: float, min_samples: int):
    """Neighbour weight of each query, and its neighbours where they are few.

    With ``min_samples`` the weight is counted until it reaches that: what is beyond it does not
    matter, so a query leaves the block as soon as it is known to be core. Without, it is exact.
    ``part`` is one that a counted neighbour is certainly in, or _NO_PART.
    """

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if q.empty or p.empty:
            return pd.DataFrame({"q": [], "x": [], "n": [], "part": []}).astype("Int64")
        ids, others, weights = q["rep"].to_numpy(), p["rep"].to_numpy(), p["w"].to_numpy().astype("float64")
        parts = p["part"].to_numpy("int64")
        near_of = _Near(q, p, eps)
        n, open_rows = np.zeros(len(q), dtype="int64"), np.arange(len(q))
        reached = np.full(len(q), _NO_PART)
        row, col = [np.zeros(0, dtype="int64")], [np.zeros(0, dtype="int64")]
        for first in range(0, len(p), COLUMNS):
            columns = np.arange(first, min(first + COLUMNS, len(p)))
            known = np.flatnonzero(parts[columns] != _NO_PART)
            for part, near in near_of(open_rows, columns):
                if np.count_nonzero(near) * SPARSE > near.size:
                    n[part] += (near @ weights[columns]).astype("int64")
                    r, c = np.nonzero(near & (n[part] < min_samples)[:, None])
                    if min_samples and len(known):
                        some = near[:, known]
                        best = np.where(some.any(axis=1), parts[columns[known[some.argmax(axis=1)]]], _NO_PART)
                        reached[part] = np.maximum(reached[part], best)
                else:
                    r, c = np.divmod(np.flatnonzero(near), len(columns))
                    n[part] += np.bincount(r, weights[columns[c]], len(part)).astype("int64")
                    if min_samples and len(known):
                        np.maximum.at(reached, part[r], parts[columns[c]])
                    few = n[part[r]] < min_samples
                    r, c = r[few], c[few]
                row.append(part[r])
                col.append(columns[c])
            if min_samples:
                open_rows = open_rows[n[open_rows] < min_samples]
        row, col = np.concatenate(row), np.concatenate(col)
        few = n[row] < min_samples
        counted = pd.DataFrame({"q": ids, "x": None, "n": n, "part": reached}).astype("Int64")
        listed = pd.DataFrame({"q": ids[row[few]], "x": others[col[few]], "n": None, "part": None}).astype("Int64")
        return pd.concat([counted, listed])

    return run


def _join(root: np.ndarray, one: np.ndarray, two: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Roots after the nodes ``one`` (rows) and ``two`` (columns) are joined where they are near."""
    some = near.any(axis=1)
    one, near = one[some], near[some]
    while True:
        mine, theirs = root[one], root[two]
        low = np.minimum(mine, np.where(near, theirs[None, :], len(root)).min(axis=1, initial=len(root)))
        down = np.minimum(theirs, np.where(near, low[:, None], len(root)).min(axis=0, initial=len(root)))
        if np.array_equal(low, mine) and np.array_equal(down, theirs):
            return root
        np.minimum.at(root, mine, low)
        np.minimum.at(root, theirs, down)
        while not np.array_equal(root, root[root]):
            root = root[root]


def _edge_kernel(eps: float):
    """Spanning edges between the nodes of two blocks of core points.

    Points that are joined already need no test. Only the component that holds most points is
    left out: its rows meet the columns outside it, the other rows meet all columns.
    """

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if q.empty or p.empty:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        nodes, code = np.unique(
            np.concatenate([q["part"].to_numpy(), p["part"].to_numpy()]), return_inverse=True
        )
        qc, pc = code[: len(q)], code[len(q) :]
        near_of = _Near(q, p, eps)
        root = np.arange(len(nodes))
        for first in range(0, len(p), COLUMNS):
            columns = np.arange(first, min(first + COLUMNS, len(p)))
            most = np.bincount(root[code]).argmax()
            inside, met = root[qc] == most, root[pc[columns]] == most
            for rows, others in ((np.flatnonzero(~inside), columns), (np.flatnonzero(inside), columns[~met])):
                for part, near in near_of(rows, others):
                    root = _join(root, qc[part], pc[others], near)
        moved = root != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for undirected edges ``a, b``; the root is the smallest node.

    Rounds of smallest-neighbour propagation with pointer jumping. Every round is written to
    the shared checkpoint folder, so neither lineage nor a lost executor costs earlier rounds.
    """
    both = edges.filter("a <> b").select(
        F.explode(
            F.array(
                F.struct(F.col("a"), F.col("b")),
                F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
            )
        ).alias("e")
    )
    both = cut_lineage(both.select("e.a", "e.b").distinct())
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("root"))
    )
    while True:
        # a star centre is a hot node here, a large component a hot root below
        seen = hot_key_join(both.withColumnRenamed("b", "node"), labels, ["node"])
        lowest = (
            seen.select(F.col("a").alias("node"), "root")
            .unionByName(labels)
            .groupBy("node")
            .agg(F.min("root").alias("root"))
        )
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = hot_key_join(cut_lineage(lowest), jump, ["root"], "left").select(
            "node", F.least(F.col("root"), F.coalesce("next", "root")).alias("root")
        )
        updated = cut_lineage(jumped)
        moved = updated.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old")
        done = moved.isEmpty()
        labels = updated
        if done:
            return labels


def _numbered(roots: DataFrame) -> DataFrame:
    """``root, cluster``: clusters numbered from 0 by their smallest core id.

    Roots are range-sorted into partitions and written; only one count per partition meets in
    a single task.
    """
    ordered = roots.select("root").distinct().repartitionByRange("root")
    parts = cut_lineage(ordered.withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("root"))
    return parts.join(before, "part").select("root", (F.col("before") + inside - 1).alias("cluster"))


def _of_copies(points: DataFrame, found: DataFrame) -> DataFrame:
    """All points with what was found for their vector, which its digest stands for."""
    return hot_key_join(points.select("id", "code", "alone"), found, ["code", "alone"])


def _largest(cores: DataFrame) -> int:
    """The part of most core points."""
    most = cores.groupBy("part").count().orderBy(F.desc("count"), "part").first()
    return int(most["part"]) if most else _NO_PART


def neighbour_counts(
    df: DataFrame, row_id: str, vector: str, eps: float, pivots: int | None = None, block: int | None = None
) -> DataFrame:
    """Exact number of points within ``eps`` cosine distance of each point, itself included."""
    points = _unit(df, row_id, vector, eps)
    reps = _representatives(points)
    chosen = _choose_pivots(reps, pivots, eps)
    placed = _place(reps, chosen, 0)
    block = block or _block_of(reps)
    found = _meet(placed, placed, chosen, block, _neighbour_kernel(eps, 0), _FOUND)
    counts = cut_lineage(found.groupBy(F.col("q").alias("rep")).agg(F.sum("n").alias("neighbours")))
    members = cut_lineage(_of_copies(points, reps.select("code", "alone", "rep")).select("id", "rep"))
    # very many copies of a vector are one hot key
    return hot_key_join(members, counts, ["rep"]).select(F.col("id").alias(row_id), "neighbours")


def dbscan(
    df: DataFrame,
    row_id: str,
    vector: str,
    eps: float = 1.0,
    min_samples: int = 5,
    pivots: int | None = None,
    block: int | None = None,
) -> DataFrame:
    """``row_id, cluster, is_core``. Noise is cluster -1; clusters are numbered by their
    smallest core id; a border point joins the lowest-numbered cluster in reach."""
    min_samples = max(min_samples, 1)  # a point is in its own reach
    points = _unit(df, row_id, vector, eps)
    reps = _representatives(points)
    chosen = _choose_pivots(reps, pivots, eps)
    if not len(chosen.reps):
        return df.select(
            F.col(row_id), F.lit(-1).cast("long").alias("cluster"), F.lit(False).alias("is_core")
        )
    _sample_parts(chosen, min_samples)
    placed = _place(reps, chosen, min_samples)
    block = block or _block_of(reps)

    blocks = -(-reps.count() // block)
    early = _met_early(placed, blocks) if blocks > MET_BLOCKS else F.lit(False)  # else no less than all

    # counts for points that the sample did not prove to be core
    open_points, others = placed.filter("open"), placed
    kernel, first = _neighbour_kernel(eps, min_samples), None
    if blocks > MET_BLOCKS:
        first = cut_lineage(_compared(open_points, placed.filter(early), chosen, block, kernel, _FOUND))
        sure = _enough(first, min_samples).select("rep")
        open_points = cut_lineage(open_points.join(sure, "rep", "left_anti"))
        others = placed.filter(~early)
    found = cut_lineage(_meet(open_points, others, chosen, block, kernel, _FOUND))
    found = first.unionByName(found) if first is not None else found

    # a node is a certain part, named by a core point of the sample, or a single core point
    late = placed.filter("open").join(_enough(found, min_samples), "rep")
    late = late.withColumn("part", F.coalesce("reached", F.lit(_NO_PART)))
    columns = ["rep", "w", "vec", "cell", "angle", "part"]
    cores = placed.filter("proven").select(*columns).unionByName(late.select(*columns))
    cores = cores.withColumn("part", F.when(F.col("part") != _NO_PART, F.col("part")).otherwise(F.col("rep")))
    cores = cut_lineage(cores)
    if blocks > MET_BLOCKS:
        outside = cores.filter(F.col("part") != _largest(cores))
        near = _compared(outside, cores.filter(early), chosen, block, _edge_kernel(eps), _EDGES)
        near = connected_components(cut_lineage(near))
        nodes = cores.withColumnRenamed("part", "node")
        few = fits_broadcast(near)
        named = nodes.join(F.broadcast(near), "node", "left") if few else hot_key_join(nodes, near, ["node"], "left")
        cores = cut_lineage(named.withColumn("part", F.coalesce("root", "node")).drop("node", "root"))
    outside = cores.filter(F.col("part") != _largest(cores))
    edges = cut_lineage(_meet(outside, cores, chosen, block, _edge_kernel(eps), _EDGES))
    components = connected_components(edges)
    # one cluster may hold most points: these joins meet a hot node, root or core point
    nodes = cores.select("rep", F.col("part").alias("node"))
    rooted = cut_lineage(
        hot_key_join(nodes, components, ["node"], "left").select(
            "rep", F.coalesce("root", "node").alias("root")
        )
    )
    lowest = cut_lineage(rooted.groupBy("root").agg(F.min("rep").alias("low")))
    ranked = lowest.join(_numbered(lowest.select(F.col("low").alias("root"))).withColumnRenamed("root", "low"), "low")
    numbered = cut_lineage(
        hot_key_join(rooted, ranked.select("root", "cluster"), ["root"]).select("rep", "cluster")
    )

    # points below min_samples keep their neighbours: the lowest core cluster among them
    listed = found.filter("x IS NOT NULL").select("q", "x")
    borders = (
        hot_key_join(listed, numbered.withColumnRenamed("rep", "x"), ["x"])
        .groupBy(F.col("q").alias("rep"))
        .agg(F.min("cluster").alias("near"))
    )
    labels = (
        reps.select("rep", "code", "alone")
        .join(numbered, "rep", "left")
        .join(borders, "rep", "left")
        .select(
            "code",
            "alone",
            F.coalesce("cluster", "near", F.lit(-1)).alias("cluster"),
            F.col("cluster").isNotNull().alias("is_core"),
        )
    )
    return _of_copies(points, labels).select(
        F.col("id").alias(row_id), "cluster", "is_core"
    )
