"""Near duplicates on word shingles by DartMinHash.

A document is the weighted set of its runs of five words; a run's weight is how often it
occurs. Darts lie in the plane of weight and rank, at one per unit of area, at places that
only the run's hash decides. The plane is cut into regions of unit area (a doubling band of
weight by a strip of rank) whose darts are drawn when a document needs them. A document sees
the darts below its weights, and keeps the earliest one of each of K coordinates. Rank is cut
where about ``K ln K + 2 K`` darts are to be expected; a document that leaves a coordinate
empty looks twice as far. Two documents agree in a coordinate with the probability of their
weighted Jaccard similarity.

BANDS bands of ROWS coordinates make the candidates (a pair of similarity 0.8 meets in one
with probability 0.99993). Two bits of every coordinate rule out candidates that lie 5.5 standard
deviations below the threshold (one in 10**7 of the rest); every link is verified on the whole runs. Copies (equal words) are
one node. Groups are not paired up: a bucket offers its smallest node to the others first,
and pairs within one component are never looked at again. What is left between components is
paired in buckets of at most PAIRED_NODES nodes; larger ones are compared as a whole in tiles
of bounded size, which send only the links that connect components.

Defined results: null counts as empty; all texts without a word are copies of each other;
fewer than five words are one run; rows that share an id are one node; a row without an id is
alone and has no class; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import components, join_classes, normal_text, stored, with_running_sums

SHINGLE = 5
BANDS = 24
ROWS = 5
COORDINATES = BANDS * ROWS
SIMILARITY = 0.8
PAIRED_NODES = 50
TILE_NODES = 1_500
TILE_RUNS = 1_000_000
TILE_COLUMNS = 4_096
CHUNK_WORDS = 150_000
CHUNK_DOCS = 256

BIT_LONGS = COORDINATES // 30
BITS = [f"bits_{i}" for i in range(BIT_LONGS)]

SKETCH = f"doc_id long, digest string, weight long, {', '.join(f'{b} long' for b in BITS)}, buckets array<long>"
RUNS = "node long, runs array<long>"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _U(0xD1B54A32D192ED03)
# how many darts a region of unit area holds: Poisson with mean one, as 64-bit thresholds
_CHANCES = np.cumsum(np.exp(-1) / np.cumprod(np.append(1.0, np.arange(1.0, 15))))
_THRESHOLDS = np.minimum(_CHANCES * 2.0**64, 2.0**64 - 2.0**11).astype(_U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, count: int) -> np.ndarray:
    """base**0 ... base**(count-1), kept between calls."""
    kept = _powers.get(str(base))
    if kept is None or len(kept) < count:
        kept = np.full(max(count, 1 << 17), base, _U)
        kept[0] = 1
        kept = _powers[str(base)] = np.cumprod(kept, dtype=_U)
    return kept[:count]


def run_hashes(text: str | None) -> tuple[str, np.ndarray]:
    """Digest of the words, and a hash of every run in order."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    digest = hashlib.sha256(b" ".join(data.split())).hexdigest()
    if not len(starts):
        return digest, np.zeros(0, _U)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * _power(_BASE, len(raw)), out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(raw))[starts] + (ends - starts).astype(_U))
    length = min(SHINGLE, len(words))
    runs = np.zeros(len(words) - length + 1, _U)
    for i in range(length):
        runs = runs * _STEP + words[i : i + len(runs)]
    return digest, mix(runs + _U(length))


def signatures(documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of COORDINATES dart numbers per weighted set (elements, weights)."""
    result = np.zeros((len(documents), COORDINATES), _U)
    expected = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
    open_ = np.array([i for i, (elements, _) in enumerate(documents) if len(elements)], np.int64)
    reach = np.array([expected / w.sum() if len(w) else 0.0 for _, w in documents])
    while len(open_):
        owner = np.repeat(open_, [len(documents[i][0]) for i in open_])
        elements = np.concatenate([documents[i][0] for i in open_])
        weights = np.concatenate([documents[i][1] for i in open_]).astype(np.float64)
        # bands of weight: [0, 1), [1, 2), [2, 4), [4, 8), ... as far as the weight reaches
        bands = 1 + np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)
        first = np.cumsum(bands) - bands
        source = np.repeat(np.arange(len(bands)), bands)
        band = np.arange(len(source)) - first[source]
        owner, weights = owner[source], weights[source]
        low = np.where(band == 0, 0.0, 2.0 ** (band - 1))
        width = np.maximum(low, 1.0)
        plane = mix(elements[source] + _STEP * band.astype(_U))
        # strips of rank, each of unit area within its band
        strips = np.ceil(reach[owner] * width).astype(np.int64)
        first = np.cumsum(strips) - strips
        source = np.repeat(np.arange(len(strips)), strips)
        strip = np.arange(len(source)) - first[source]
        region = mix(plane[source] + _BASE * (strip + 1).astype(_U))
        darts = np.searchsorted(_THRESHOLDS, region, "right")
        first = np.cumsum(darts) - darts
        at = np.repeat(np.arange(len(darts)), darts)
        number = np.arange(len(at)) - first[at]
        dart = mix(region[at] + _STEP * (number + 1).astype(_U))
        within, source = source[at], at
        other = mix(dart ^ _BASE)
        rank = (strip[source] + _unit(other)) / width[within]
        height = low[within] + width[within] * _unit(mix(other))
        owner = owner[within]
        seen = (height < weights[within]) & (rank < reach[owner])
        owner, rank, dart = owner[seen], rank[seen], dart[seen]
        place = np.searchsorted(open_, owner) * COORDINATES + (dart % _U(COORDINATES)).astype(np.int64)
        fine = np.minimum(rank / reach[owner] * 2.0**36, 2.0**36 - 1).astype(_U)
        order = np.argsort((place.astype(_U) << _U(36)) | fine)
        place, dart = place[order], dart[order]
        earliest = np.append(True, place[1:] != place[:-1]) if len(place) else np.zeros(0, bool)
        found = np.zeros(len(open_) * COORDINATES, _U)
        found[place[earliest]] = dart[earliest]
        filled = np.zeros(len(open_) * COORDINATES, bool)
        filled[place[earliest]] = True
        result[open_] = found.reshape(-1, COORDINATES)
        open_ = open_[~filled.reshape(-1, COORDINATES).all(axis=1)]
        reach[open_] *= 2
    return result


def buckets(signature: np.ndarray) -> np.ndarray:
    """BANDS bucket numbers per signature."""
    bands = signature.reshape(len(signature), BANDS, ROWS)
    mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), bands.shape[:2]).copy()
    for i in range(ROWS):
        mixed = mix(mixed * _STEP + bands[:, :, i])
    return mixed.view(np.int64)


def low_bits(signature: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, 30 coordinates to a number."""
    two = (signature >> _U(60)) & _U(3)
    shifts = _U(2) * np.arange(30, dtype=_U)
    return (two.reshape(len(two), BIT_LONGS, 30) << shifts).sum(axis=2, dtype=_U).view(np.int64)


def _sketched(ids: list, documents: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
    sets = [np.unique(runs, return_counts=True) for _, runs in documents]
    signature = signatures(sets)
    flat, bits = buckets(signature), low_bits(signature)
    present = np.array([len(runs) > 0 for _, runs in documents], bool)
    offsets = np.append(0, np.cumsum(present * BANDS)).astype(np.int32)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([digest[:32] for digest, _ in documents]),
        pa.array([len(runs) for _, runs in documents], pa.int64()),
        *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(BIT_LONGS)],
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[present].ravel())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "weight", *BITS, "buckets"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, documents, words = [], [], 0
    for batch in batches:
        for i, text in zip(*batch.columns, strict=True):
            ids.append(i.as_py())
            documents.append(run_hashes(text.as_py()))
            words += len(documents[-1][1])
            if words >= CHUNK_WORDS or len(ids) >= CHUNK_DOCS:
                yield _sketched(ids, documents)
                ids, documents, words = [], [], 0
    if ids:
        yield _sketched(ids, documents)


def _tagged_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text as a set: an occurrence beyond the first is an element of its own."""
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            part, found = batch.slice(first, 64), []
            for text in part.column(1):
                runs = np.sort(run_hashes(text.as_py())[1])
                index = np.arange(len(runs))
                new = np.append(True, runs[1:] != runs[:-1])[: len(runs)]
                again = index - np.maximum.accumulate(np.where(new, index, 0)) if len(runs) else index
                found.append(np.where(again > 0, mix(runs + _BASE * again.astype(_U)), runs).view(np.int64))
            offsets = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["node", "runs"])


def _similarity() -> Column:
    shared = F.size(F.array_intersect("runs_a", "runs_b")).cast("double")
    return shared / (F.size("runs_a") + F.size("runs_b") - shared)


def _verified(pairs: DataFrame, runs: DataFrame, name: str) -> DataFrame:
    """``a, b, similarity`` of the pairs, on the whole texts."""
    left = runs.select(F.col("node").alias("a"), F.col("runs").alias("runs_a"))
    right = runs.select(F.col("node").alias("b"), F.col("runs").alias("runs_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return stored(both.select("a", "b", _similarity().alias("similarity")), name)


def _may_link(left: str, right: str, similarity: float) -> Column:
    """Whether sizes and low bits of two nodes (columns with these endings) allow a link."""
    sizes = F.least(f"weight{left}", f"weight{right}") >= similarity * F.greatest(f"weight{left}", f"weight{right}")
    chance = 0.75 * (1 - similarity)
    most = COORDINATES * chance + 5.5 * (COORDINATES * chance * (1 - chance)) ** 0.5
    differing = F.lit(0)
    for name in BITS:
        bits = F.col(f"{name}{left}").bitwiseXOR(F.col(f"{name}{right}"))
        pairs = bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differing = differing + F.bit_count(pairs)
    return sizes & (differing <= most)


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, digest, weight, buckets``: one scan, no shuffle."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_sketch, SKETCH)


def text_digest(text: str) -> Column:
    """The digest of a sketch: words with one space between them."""
    return F.substring(F.sha2(F.trim(normal_text(text)), 256), 1, 32)


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows ``doc_id, copy_of, class_id, kept``: the smallest id with equal words, the smallest
    id that links reach, and whether that is the row's own. Texts that share an id are apart."""
    return _labelled_rows(docs, similarity, doc_id, text).drop("digest")


def _labelled_rows(docs: DataFrame, similarity: float, doc_id: str, text: str) -> DataFrame:
    sketched = stored(sketches(docs, doc_id, text), "dart-sketches")
    classes = sketched.groupBy("digest").agg(F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("copies"))
    # a node is a text, not an id; numbers follow the ids, so the smallest node has the smallest id
    order = [F.col("copy_of").asc_nulls_last(), F.col("digest").asc()]
    classes = with_running_sums(classes, order, {}, "dart-texts").withColumnRenamed("row_index", "node")
    classes = stored(classes, "dart-nodes")
    own = classes.select("digest", F.col("copy_of").alias("doc_id"), "node")
    nodes = sketched.join(own, ["digest", "doc_id"]).select(
        "node", "weight", *BITS, F.explode("buckets").alias("bucket")
    )
    nodes = nodes.dropDuplicates(["bucket", "node"])
    shared = nodes.groupBy("bucket").agg(
        F.min(F.struct("node", "weight", *BITS)).alias("pivot"), F.count(F.lit(1)).alias("n")
    )
    members = stored(
        nodes.join(shared.filter("n > 1"), "bucket").select(
            "bucket",
            "node",
            "weight",
            *BITS,
            F.col("pivot.node").alias("pivot"),
            *[F.col(f"pivot.{c}").alias(f"{c}_pivot") for c in ("weight", *BITS)],
        ),
        "dart-members",
    )
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_digest(text).alias("digest"), F.col(text).alias("text")
    )
    wanted = own.join(members.select("node").distinct(), "node", "left_semi")
    wanted = texts.join(wanted, ["doc_id", "digest"]).select("node", "text")
    runs = stored(wanted.mapInArrow(_tagged_runs, RUNS).dropDuplicates(["node"]), "dart-runs")
    reached = _linked_nodes(members, runs, similarity)
    firsts = classes.select(F.col("node").alias("component"), F.col("copy_of").alias("first"))
    reached = reached.join(firsts, "component").select("of", "first")
    labelled = classes.join(reached, classes.node == reached.of, "left").select(
        "digest", "copies", "copy_of", F.coalesce("first", "copy_of").alias("class")
    )
    rows = sketched.select("doc_id", "digest")
    found = join_classes(rows, stored(labelled, "dart-classes"), rows.count())
    known = F.col("doc_id").isNotNull()
    return found.select(
        "doc_id",
        "digest",
        F.when(known, F.col("copy_of")).alias("copy_of"),
        F.when(known, F.col("class")).alias("class_id"),
        F.coalesce(F.col("doc_id") == F.col("class"), F.lit(True)).alias("kept"),
    )


def _linked_nodes(members: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """``of, component`` of all nodes that have a verified link."""
    star = stored(
        members.filter((F.col("node") != F.col("pivot")) & _may_link("", "_pivot", similarity))
        .groupBy(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .agg(F.count(F.lit(1)).alias("bands")),
        "dart-star",
    )
    # first the pivot that each node shares most bands with
    best = star.groupBy("b").agg(F.max_by("a", "bands").alias("a"))
    tested = _verified(best, runs, "dart-best")
    linked = tested.filter(F.col("similarity") >= similarity)

    # then the other pivots, where they are still apart
    label = _labels(linked)
    rest = _apart(star.join(tested, ["a", "b"], "left_anti"), label)
    more = _verified(rest, runs, "dart-rest")
    new = more.filter(F.col("similarity") >= similarity)
    tested, linked = tested.unionByName(more), linked.unionByName(new)
    if not new.isEmpty():
        label = _labels(linked)

    # last the pairs without a pivot, in buckets that still hold several components
    labelled = members.join(label, members.node == label.of, "left").select(
        "bucket", "node", "weight", *BITS, "pivot", F.coalesce("component", "node").alias("component")
    )
    mixed = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.sum("weight").alias("runs_in_all"),
    )
    several = mixed.filter("low < high AND n > 2").select(
        "bucket", "n", F.greatest(F.ceil(F.col("n") / TILE_NODES), F.ceil(F.col("runs_in_all") / TILE_RUNS)).alias("blocks")
    )
    left_over = stored(labelled.join(several, "bucket"), "dart-left")
    few = left_over.filter((F.col("n") <= PAIRED_NODES) & (F.col("node") != F.col("pivot")))
    ends = ("node", "weight", "component", *BITS)
    x = few.select("bucket", *[F.col(c).alias(f"{c}_a") for c in ends])
    y = few.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ends])
    possible = (
        (x.node_a < y.node_b) & (x.component_a != y.component_b) & _may_link("_a", "_b", similarity)
    )
    pairs = x.join(y, (x.bucket == y.bucket) & possible).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b")
    )
    pairs = pairs.distinct().join(tested, ["a", "b"], "left_anti")
    last = _verified(pairs, runs, "dart-last").filter(F.col("similarity") >= similarity).select("a", "b")
    many = _tiled(left_over.filter(F.col("n") > PAIRED_NODES), runs, similarity)
    new = stored(last.unionByName(many), "dart-new")
    if new.isEmpty():
        return label
    return _labels(linked.select("a", "b").unionByName(new))


def _tiled(left_over: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between components inside large buckets, as a spanning forest per tile.

    A bucket is cut into blocks of bounded nodes and runs, and every two blocks make a tile.
    No pair leaves a task: the runs that several nodes of the tile share make an incidence
    matrix, whose product with itself is all intersections at once.
    """
    blocks = left_over.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    spread = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = spread.select(
        "bucket", "node", "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        links = tile_links(rows["runs"].tolist(), rows["component"].to_numpy(), similarity)
        nodes = rows["node"].to_numpy()
        return pd.DataFrame([(nodes[i], nodes[j]) for i, j in links], columns=["a", "b"])

    joined = tiles.join(runs, "node")
    return joined.groupBy("bucket", "low", "high").applyInPandas(tile, "a long, b long").distinct()


def tile_links(sets: list[np.ndarray], component: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links that connect the components of some sets of runs, few enough to span them.

    Only rows outside the most common component are multiplied, with all rows.
    """
    names, label, counts = np.unique(component, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    asked = np.flatnonzero(label != counts.argmax())
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(uses > 1) - 1
    wanted = uses[column] > 1
    owner, column = owner[wanted], shared[column[wanted]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(asked), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, TILE_COLUMNS):
        part = slice(*np.searchsorted(column, [first, first + TILE_COLUMNS]))
        matrix = np.zeros((len(sets), TILE_COLUMNS), np.float32)
        matrix[owner[part], column[part] - first] = 1
        common += matrix[asked] @ matrix.T
    alike = common >= similarity * (sizes[asked][:, None] + sizes[None, :] - common) - 1e-9
    parent = list(range(len(names)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    links = []
    for row, j in zip(*np.nonzero(alike & (label[asked][:, None] != label[None, :])), strict=True):
        i = asked[row]
        x, y = root(label[i]), root(label[j])
        if x != y:
            parent[x] = y
            links.append((int(min(i, j)), int(max(i, j))))
    return links


def _labels(links: DataFrame) -> DataFrame:
    return components(links, "a", "b", "dart-labels").select(F.col("node").alias("of"), "component")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components so far."""
    a = label.select(F.col("of").alias("a"), F.col("component").alias("component_a"))
    b = label.select(F.col("of").alias("b"), F.col("component").alias("component_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    apart = F.coalesce("component_a", "a") != F.coalesce("component_b", "b")
    return joined.filter(apart).select("a", "b")


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class, all columns whatever their names. A
    row goes by its id and its text, so another text under the same id stays."""
    gone = _labelled_rows(docs, SIMILARITY, doc_id, text).filter(~F.col("kept")).select("doc_id", "digest")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        text_digest(text).alias("digest"),
    )
    return rows.join(gone.distinct(), ["doc_id", "digest"], "left_anti").select("row.*")


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), copies AS (
  SELECT doc_id, w, min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) AS copy_of FROM texts
), nodes AS (
  SELECT doc_id AS node, w FROM copies WHERE doc_id = copy_of AND len(w) > 0
), places AS (
  SELECT node, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM nodes
), runs AS (
  SELECT node, array_to_string(w[i:i + 4], ' ') AS run, count(*) AS n FROM places GROUP BY ALL
), sizes AS (
  SELECT node, sum(n) AS n FROM runs GROUP BY node
), shared AS (
  SELECT a.node AS a, b.node AS b, sum(least(a.n, b.n)) AS n
  FROM runs AS a JOIN runs AS b ON a.run = b.run AND a.node < b.node GROUP BY ALL
), near AS (
  SELECT shared.a, shared.b FROM shared JOIN sizes AS x ON x.node = a JOIN sizes AS y ON y.node = b
  WHERE shared.n / (x.n + y.n - shared.n) >= 0.8
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), lowest AS (
  SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a
)
SELECT doc_id, copy_of, coalesce(class_id, copy_of) AS class_id, doc_id = coalesce(class_id, copy_of) AS kept
FROM copies LEFT JOIN lowest ON lowest.a = copy_of
"""
