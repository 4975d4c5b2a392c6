"""Near-duplicate embeddings through binary codes of randomly rotated vectors.

A unit vector is rotated at random and keeps the signs of its coordinates: the code. With it
goes the correction factor, the exact inner product of the vector and its own code. Code times
another rotated vector, divided by the factor, is an unbiased estimate of the cosine. Two
bounds on its error decide whether a pair needs the exact cosine: the confidence radius of the
estimate at SIGMAS deviations, and the angle bound (vector and code lie a known angle apart, so
a link can turn the other vector by no more than the threshold's angle). What passes both is
recomputed from the vectors in double precision.

Pairs to estimate come from buckets of equal code bits. Vectors of one label are cut into
bands of bits, as many bits as leave about BUCKET_ROWS vectors to a bucket, and as many bands
as miss a pair right at the threshold with a chance of MISSED at most. A pair counts in the
first band it shares and nowhere else, so tasks send counts and a spanning forest instead of
pairs. Equal vectors are one weighted class. A bucket above TILE_ROWS is cut into blocks and
worked off as tiles, two blocks each.

Defined results: a vector that is null, zero or has a null or non-finite component, and one
whose label or id is null, links with nothing and is its own component; vectors of different
length don't link; a repeated row is another vector, and so is a repeated id with another
vector; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import components, stored

COSINE = 0.98
BUCKET_ROWS = 64
TILE_ROWS = 2_000
PART = 256
MISSED = 1e-5
SIGMAS = 6.0
MOST_BITS = 24

FOUND = "a long, b long, links long"


@lru_cache(64)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation that depends on its size and number alone."""
    draw = np.random.default_rng([size, number, 97]).standard_normal((size, size))
    q, r = np.linalg.qr(draw)
    return q * np.sign(np.diag(r))


def units(vectors: list) -> np.ndarray:
    matrix = np.array([np.asarray(v, np.float64) for v in vectors])
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes (bool) and correction factors under the first rotation."""
    turned = unit @ rotation(unit.shape[1], 0).T
    return turned > 0, np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def candidates(codes: np.ndarray, factors: np.ndarray, unit: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Whether code i and vector j may reach the cosine, for all i and j."""
    size = unit.shape[1]
    turned = unit @ rotation(size, 0).T
    product = (np.where(codes, 1.0, -1.0) / np.sqrt(size)) @ turned.T
    factor = np.clip(factors, 1e-9, 1)[:, None]
    radius = SIGMAS * np.sqrt((1 - factor**2) / factor**2 / max(size - 1, 1))
    estimate = product / factor
    farthest = np.cos(np.minimum(np.arccos(factor) + np.arccos(cosine), np.pi))
    return (estimate + radius >= cosine) & (product >= farthest - 1e-9)


def bits_for(rows: int, cosine: float = COSINE) -> tuple[int, int]:
    """Bits of a band and number of bands for a label of ``rows`` classes."""
    bits = int(np.clip(np.ceil(np.log2(max(rows, 1) / BUCKET_ROWS)), 0, MOST_BITS))
    agree = (1 - np.arccos(cosine) / np.pi) ** bits
    bands = 1 if agree >= 1 else int(np.ceil(np.log(MISSED) / np.log1p(-agree)))
    return bits, bands


def band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The bucket of every vector in every band."""
    size = unit.shape[1]
    signs = [unit @ rotation(size, n).T > 0 for n in range(max(1, -(-bits * bands // size)))]
    used = np.hstack(signs)[:, : bits * bands].reshape(len(unit), bands, bits)
    return (used << np.arange(bits)).sum(axis=2).astype(np.int64)


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for (size, rows), part in batch.groupby(["size", "label_rows"]):
            unit = units(part["embedding"].tolist())
            codes, factors = encode(unit)
            keys = band_keys(unit, *bits_for(int(rows)))
            yield part[["group", "rep", "copies", "embedding"]].assign(
                code=[c.tobytes() for c in np.packbits(codes, axis=1)], factor=factors, keys=list(keys)
            )


def _exact(unit: np.ndarray, first: int, mask: np.ndarray) -> np.ndarray:
    """Which pairs of ``mask`` (rows from ``first`` on, all columns) reach the cosine, by a
    product over the rows and columns that have candidates at all."""
    rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    linked = np.zeros_like(mask)
    if len(rows):
        linked[np.ix_(rows, columns)] = unit[first + rows] @ unit[columns].T >= COSINE
    return linked & mask


def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Link counts and a spanning forest of the links of one tile. Pairs are bits of a mask of
    PART rows at a time, so memory does not depend on how many of them are near."""
    rows = rows.sort_values("rep", ignore_index=True)
    count, band = len(rows), int(key[1])
    unit = units(rows["embedding"].tolist())
    codes = np.unpackbits(
        np.array([np.frombuffer(c, np.uint8) for c in rows["code"]]), axis=1, count=unit.shape[1]
    ).astype(bool)
    factors, bands = rows["factor"].to_numpy(), np.array(rows["keys"].tolist())
    block, reps, copies = rows["block"].to_numpy(), rows["rep"].to_numpy(), rows["copies"].to_numpy()
    links, root = np.zeros(count, np.int64), np.arange(count)
    edges = []
    for first in range(0, count, PART):
        part = slice(first, first + PART)
        mask = candidates(codes[part], factors[part], unit)
        mask &= np.arange(count) > np.arange(count)[part, None]
        if key[3] != key[4]:
            mask &= block[part, None] != block
        for earlier in range(band):  # such a pair counts there
            mask &= bands[part, None, earlier] != bands[:, earlier]
        mask = _exact(unit, first, mask)
        links[part] += mask @ copies
        links += copies[part] @ mask
        for a in np.flatnonzero(mask.any(axis=1)):
            met = np.unique(root[np.append(np.flatnonzero(mask[a]), first + a)])
            if len(met) > 1:
                edges += [(reps[met[0]], reps[other]) for other in met[1:]]
                root[np.isin(root, met)] = met[0]
    some = np.flatnonzero(links)
    found = pd.DataFrame({"a": reps[some], "b": reps[some], "links": links[some]})
    joined = pd.DataFrame(edges, columns=["a", "b"]).assign(links=0)
    return pd.concat([found, joined]) if len(joined) else found


def _usable(vec_id: str, label: str, embedding: str) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    present = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull()
    return F.coalesce(present & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding"
) -> DataFrame:
    """Rows ``vec_id, n_links, component_id, kept``, one per vector."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).alias("embedding"),
    ).withColumn("usable", _usable("vec_id", "label", "embedding"))
    usable = rows.filter("usable").withColumn("group", F.struct("label", F.size("embedding").alias("size")))
    classes = usable.groupBy("group", "embedding").agg(
        F.min("vec_id").alias("smallest"), F.count(F.lit(1)).alias("copies")
    )
    # classes go by a number of their own: an id may be repeated with another vector
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    sizes = classes.groupBy("group").agg(F.count(F.lit(1)).alias("label_rows"))
    kind = dict(vectors.dtypes)[embedding]
    encoded = stored(
        classes.join(sizes, "group")
        .select("*", F.col("group.size").alias("size"))
        .withColumn("group", F.to_json("group"))
        .mapInPandas(
            _encoded,
            f"group string, rep long, copies long, embedding {kind}, code binary, factor double, keys array<long>",
        ),
        "vector-codes",
    )
    spread = encoded.select("*", F.posexplode("keys").alias("band", "key"))
    place = ["group", "band", "key"]
    filled = spread.groupBy(*place).count().filter("count > 1")
    tiled = spread.join(
        filled.select(*place, F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("blocks")), place
    ).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiled.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = stored(tiles.groupBy(*place, "low", "high").applyInPandas(_tile, FOUND), "vector-links")
    reached = components(found.filter("links = 0"), "a", "b", "vector-components")
    links = found.filter("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    placed = (
        classes.join(links, "rep", "left")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    smallest = placed.groupBy("component").agg(F.min("smallest").alias("component_id"))
    known = placed.join(smallest, "component").select(
        "group",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    linked = usable.join(known, ["group", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = linked.unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e)
        >= 0.98 * sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = e.vec_id), e.vec_id)) AS kept
FROM embeddings AS e
"""
