"""Vector code compression: each vector as eight one-byte codes of learned entries.

Components become integers, vectors are cut into equal consecutive parts, and every part
position has a codebook of 16 entries that a few exact rounds of assignment and averaging
improve. All arithmetic is on integers, so results do not depend on how rows are dealt out.

The nearest entry is found through memoised grid cells. A part lies in a cell of side ``side``
in every direction. For a cell met for the first time the smallest and the largest distance
between its box and each entry are computed; an entry whose smallest distance exceeds the
least of the largest ones is farther than another entry from every point of the box and is
left out. What remains is cached under the cell, and only these entries are evaluated exactly
for the parts in it. The cache of a task is emptied when it holds MOST_CELLS cells.

Spark deals out the rows; a task returns sums and counts for its 16 entries of each part, so a
round moves at most ``16 * (dimensions + parts)`` numbers per task, and the codebooks (the same
number) are all that the driver sees.

Defined results: a row whose vector is null or holds null or non-finite components is dropped;
components beyond ``LIMIT / SCALE`` (8,192) either way are held there; a vector shorter than
the longest, or of a length that the number of parts does not divide, counts as if zeros
followed, an empty one as zeros; a null ``vec_id`` is kept and comes after all others when the
first entries are chosen; repeated rows and ids count as often as they occur; with fewer than
16 rows there are as many entries; equal labels are summed together, nulls as one label; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import join_classes, stored

SCALE = 4_096
LIMIT = 1 << 25
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL_SIDE = 256
MOST_CELLS = 100_000
BATCH_NUMBERS = 1 << 19
LONG_MAX = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str, parts: int) -> DataFrame:
    """Kept rows ``vec_id, label, x`` with integer components, all of one length that ``parts``
    divides; written once."""
    at = F.col(embedding)

    def good(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def whole(x):
        held = F.least(F.greatest(x.cast("double") * SCALE, F.lit(-LIMIT)), F.lit(LIMIT))
        return F.floor(held).cast("int")

    kept = vectors.filter(at.isNotNull() & F.coalesce(F.forall(at, good), F.lit(False)))
    kept = stored(
        kept.select(
            F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.transform(at, whole).alias("x")
        ),
        "codes-vectors",
    )
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    size = -(-longest // parts) * parts
    zeros = F.array_repeat(F.lit(0), F.lit(size) - F.size("x"))
    return kept.withColumn("x", F.concat("x", zeros))


class Cells:
    """Nearest entries of one codebook, through cells met before."""

    def __init__(self, entries: np.ndarray, side: int = CELL_SIDE) -> None:
        self.entries = entries.astype(np.int64)
        self.side = side
        self.known: dict[bytes, int] = {}
        self.bits = 1 << np.arange(len(entries))
        self.evaluated = 0

    def _remaining(self, cells: np.ndarray) -> np.ndarray:
        """One bit for each entry that may be nearest somewhere in the cell's box."""
        low = (cells * self.side)[:, None]
        high = low + (self.side - 1)
        nearest = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        farthest = np.maximum(np.abs(low - self.entries), np.abs(high - self.entries))
        least = (nearest * nearest).sum(2)
        most = (farthest * farthest).sum(2)
        return (least <= most.min(1)[:, None]) @ self.bits

    def _masks(self, cells: np.ndarray) -> np.ndarray:
        keys = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
        names = [k.tobytes() for k in distinct]
        if len(self.known) + len(names) > MOST_CELLS:
            self.known.clear()
        new = [i for i, name in enumerate(names) if name not in self.known]
        step = max(1, BATCH_NUMBERS // self.entries.size)
        for a in range(0, len(new), step):
            some = new[a : a + step]
            masks = self._remaining(cells[first[some]])
            self.known.update(zip([names[i] for i in some], masks.tolist(), strict=True))
        return np.array([self.known[name] for name in names])[place.ravel()]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower one of equals) and its squared distance."""
        count = len(points)
        if not count or not points.shape[1]:
            return np.zeros(count, np.int64), np.zeros(count, np.int64)
        masks = self._masks(points // self.side)
        rows, entries = np.nonzero(masks[:, None] & self.bits)
        self.evaluated += len(rows)
        far = np.empty(len(rows), np.int64)
        step = max(1, BATCH_NUMBERS // points.shape[1])
        for a in range(0, len(rows), step):
            gap = points[rows[a : a + step]] - self.entries[entries[a : a + step]]
            far[a : a + step] = (gap * gap).sum(1)
        begins = np.searchsorted(rows, np.arange(count))
        best = np.minimum.reduceat(far, begins)
        hits = np.flatnonzero(far == best[rows])
        first = hits[np.searchsorted(rows[hits], np.arange(count))]
        return entries[first], best


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as a matrix."""
    step = max(1, BATCH_NUMBERS // max(size, 1))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            flat = part.column(part.schema.get_field_index("x")).flatten().to_numpy()
            yield part, flat.astype(np.int64).reshape(part.num_rows, size)


def assigned_sums(kept: DataFrame, books: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the parts nearest to each entry, and their number."""
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, side) for book in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, x in _blocks(batches, parts * width):
            for p in range(parts):
                points = x[:, p * width : (p + 1) * width]
                index, _ = cells[p].nearest(points)
                np.add.at(sums[p], index, points)
                counts[p] += np.bincount(index, minlength=entries)
        numbers = np.concatenate([counts.ravel(), sums.ravel()])
        at = np.flatnonzero(numbers)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(numbers[at])], ["at", "value"])

    found = kept.select("x").mapInArrow(add_up, "at long, value long").groupBy("at").agg(F.sum("value").alias("value"))
    numbers = np.zeros(parts * entries * (1 + width), np.int64)
    for at, value in found.collect():
        numbers[at] = value
    return numbers[parts * entries :].reshape(books.shape), numbers[: parts * entries].reshape(parts, entries)


def learn_codebooks(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, side: int = CELL_SIDE
) -> np.ndarray | None:
    """Entries by part, entry and position; None without rows."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not first:
        return None
    start = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1 if len(first[0].x) else 0)
    books = start.transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums, counts = assigned_sums(kept, books, side)
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]
    return books


def encode(kept: DataFrame, books: np.ndarray, side: int = CELL_SIDE) -> DataFrame:
    """Rows ``vec_id, label, code, error``."""
    parts, _, width = books.shape
    schema = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, side) for book in books]
        for part, x in _blocks(batches, parts * width):
            index, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                index[:, p], far = cells[p].nearest(x[:, p * width : (p + 1) * width])
                error += far
            codes = [row.tobytes().hex() for row in index]
            columns = [part.column("vec_id"), part.column("label"), pa.array(codes, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return kept.mapInArrow(code, schema)


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    side: int = CELL_SIDE,
) -> DataFrame:
    """Rows ``vec_id, code, error, label_error, codebooks_sha256``."""
    kept = integer_vectors(vectors, vec_id, embedding, label, parts)
    books = learn_codebooks(kept, parts, entries, rounds, side)
    if books is None:
        nothing = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], nothing)
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-"))
    coded = stored(encode(kept, books, side).select("vec_id", key.alias("digest"), "code", "error"), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy("digest").agg(
        F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"),
        F.count(F.lit(1)).alias("copies"),
    )
    return join_classes(coded, labels, coded.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
assigned{n} AS MATERIALIZED (
  SELECT rid, part, min(far * 16 + entry) AS best FROM (
    SELECT rid, part, entry, sum((v - c) * (v - c))::BIGINT AS far
    FROM parts JOIN book{n} USING (part, pos) GROUP BY rid, part, entry)
  GROUP BY rid, part
)""")
        if n < ROUNDS:
            steps.append(f"""
book{n + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{n} LEFT JOIN (
    SELECT part, best % 16 AS entry, pos, sum(v)::BIGINT AS s, count(*) AS n
    FROM parts JOIN assigned{n} USING (rid, part) GROUP BY ALL) USING (part, entry, pos)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS rid, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, (place - 1) * {PARTS} // size AS part, (place - 1) % (size // {PARTS}) AS pos,
         floor({SCALE} * value::DOUBLE)::BIGINT AS v
  FROM (SELECT rid, len(embedding) AS size, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS place FROM kept)
), book0 AS (SELECT part, rid AS entry, pos, v AS c FROM parts WHERE rid < {ENTRIES}),{",".join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', best % 16), '' ORDER BY part) AS code, sum(best // 16)::BIGINT AS error
  FROM assigned{ROUNDS} GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest
"""


SQL = _sql()
