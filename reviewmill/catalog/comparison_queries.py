"""Similarity, clustering, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog import inputs as inp
from reviewmill.catalog import sql_parts as sq
from reviewmill.catalog.registry import register
from reviewmill.operators import compare, density, embedding, similar
from reviewmill.operators import tokens as tk
from reviewmill.operators import words as wd
from reviewmill.operators.skew import cut_lineage, scratch_path
from reviewmill.plans import jobs
from reviewmill.sources import writers

_TOP = f"""
WITH {inp.REVIEWS_SQL},
toks AS (
  SELECT university_name || '/' || shop_name AS g, unnest({sq.split_space('review_text')}) AS word FROM reviews),
counts AS (SELECT g, word, count(*) AS n FROM toks WHERE length(word) > 1 GROUP BY ALL),
top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, word) <= 10),
norms AS (SELECT g, sqrt(sum(n * n)) AS norm FROM top GROUP BY g),
pairs AS (
  SELECT a.g AS g1, b.g AS g2, sum(a.n * b.n) AS dot FROM top a JOIN top b USING (word) GROUP BY ALL),
cosines AS (
  SELECT g1, g2, round(dot / (x.norm * y.norm), 9) AS cosine
  FROM pairs JOIN norms x ON x.g = g1 JOIN norms y ON y.g = g2)
"""


def _top(spark, sf_dir):
    docs = inp.reviews(spark, sf_dir).withColumn(
        "g", F.concat_ws("/", "university_name", "shop_name")
    )
    tokens = tk.explode_tokens(docs, "review_text", ["g"], min_length=2)
    return wd.top_words_by_group(tokens, ["g"], 10)


@register("cosine_university", f"{_TOP} SELECT g1, g2, cosine FROM cosines")
def cosine_university(spark, sf_dir):
    pairs = compare.cosine_similarity(_top(spark, sf_dir), "g")
    return pairs.withColumn("cosine", F.round("cosine", 9))


_EXACT = """,
exact AS (
  SELECT g1, g2, dot / (x.norm * y.norm) AS cosine
  FROM pairs JOIN norms x ON x.g = g1 JOIN norms y ON y.g = g2 WHERE g1 <> g2)
"""


@register(
    "similar_groups",
    f"{_TOP}{_EXACT} SELECT g1, g2, round(cosine, 9) AS cosine FROM exact WHERE g1 < g2 AND cosine >= 0.75",
)
def similar_groups(spark, sf_dir):
    pairs = similar.similar_groups(_top(spark, sf_dir), "g", 0.75)
    return pairs.withColumn("cosine", F.round("cosine", 9))


@register(
    "most_similar_groups",
    f"""{_TOP}{_EXACT}
SELECT g1, g2, round(cosine, 9) AS cosine, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY g1 ORDER BY cosine DESC, g2) AS rank FROM exact) WHERE rank <= 3""",
)
def most_similar_groups(spark, sf_dir):
    near = similar.most_similar_groups(_top(spark, sf_dir), "g", 3)
    return near.withColumn("cosine", F.round("cosine", 9))


_LANGS = ["de", "en", "es", "fr"]


@register(
    "similarity_matrix_wide",
    _TOP.replace("university_name || '/' || shop_name AS g", "university_name AS g")
    + "SELECT g1, "
    + ", ".join(f"coalesce(max(cosine) FILTER (g2 = '{g}'), 0) AS {g}" for g in _LANGS)
    + " FROM cosines GROUP BY g1",
)
def similarity_matrix_wide(spark, sf_dir):
    tokens = tk.explode_tokens(
        inp.reviews(spark, sf_dir), "review_text", ["university_name"], min_length=2
    )
    top = wd.top_words_by_group(tokens, ["university_name"], 10)
    pairs = compare.cosine_similarity(top, "university_name")
    return compare.similarity_matrix(pairs.withColumn("cosine", F.round("cosine", 9)), _LANGS)


def _power_sql(name: str, matrix: str) -> str:
    """The largest eigenvector ``v`` of a matrix, the longest coordinate positive, and the square
    root ``s`` of its eigenvalue."""
    return f"""
{name}_power(step, v) AS (
  SELECT 0, list_transform(rows, lambda r, i: sin(i)) FROM {matrix}
  UNION ALL
  SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w)))
  FROM (SELECT step, list_transform(rows, lambda r: list_inner_product(r, v)) AS w
        FROM {name}_power, {matrix} WHERE step < 1500)),
{name} AS MATERIALIZED (
  SELECT list_transform(v, lambda x: CASE WHEN list_max(v) < -list_min(v) THEN -x ELSE x END) AS v, s
  FROM (SELECT v, list_transform(rows, lambda r: list_inner_product(r, v)) AS w, sqrt(sqrt(list_inner_product(w, w))) AS s
        FROM {name}_power, {matrix} WHERE step = 1500))"""


_PLANE = f"""{_TOP.replace("WITH", "WITH RECURSIVE", 1)},
ids AS (SELECT g, row_number() OVER (ORDER BY g) AS i FROM norms),
gram AS (
  SELECT x.i, y.i AS j, CAST(coalesce(dot, 0) AS DOUBLE) AS d
  FROM ids x CROSS JOIN ids y LEFT JOIN pairs ON g1 = x.g AND g2 = y.g),
centred AS (
  SELECT i, j, d - avg(d) OVER (PARTITION BY i) - avg(d) OVER (PARTITION BY j) + avg(d) OVER () AS d FROM gram),
k1 AS MATERIALIZED (
  SELECT list(r ORDER BY i) AS rows FROM (SELECT i, list(d ORDER BY j) AS r FROM centred GROUP BY i)),
{_power_sql("one", "k1")},
k2 AS MATERIALIZED (
  SELECT list_transform(rows, lambda r, i: list_transform(r, lambda x, j: x - s * s * v[i] * v[j])) AS rows
  FROM k1, one),
{_power_sql("two", "k2")},
plane AS (SELECT g, one.s * one.v[i] AS pc1, two.s * two.v[i] AS pc2, i FROM ids, one, two),
walk(step, c) AS (
  SELECT 0, list_transform(v, lambda x: CASE WHEN x > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END) FROM one
  UNION ALL
  SELECT step + 1,
         list_transform(a1, lambda x, i: CASE WHEN x - q1 / 2 > a0[i] - q0 / 2 THEN CAST(1 AS DOUBLE) ELSE 0 END)
  FROM (SELECT *, list_inner_product(c, a1) / n1 AS q1, list_inner_product(b, a0) / n0 AS q0
        FROM (SELECT *, list_transform(rows, lambda r: list_inner_product(r, c) / n1) AS a1,
                     list_transform(rows, lambda r: list_inner_product(r, b) / n0) AS a0
              FROM (SELECT step, c, list_transform(c, lambda x: 1 - x) AS b, list_sum(c) AS n1,
                           len(c) - list_sum(c) AS n0 FROM walk WHERE step < 60), k1))),
clusters AS (SELECT g, CAST(c[i] AS INTEGER) AS cluster FROM ids, walk WHERE step = 60)
"""


@register("bisecting_clusters", f"{_PLANE} SELECT g, cluster FROM clusters")
def bisecting_clusters(spark, sf_dir):
    top = cut_lineage(_top(spark, sf_dir))
    return compare.two_clusters(top, compare.principal_components(top, "g"), "g")


@register("pca2", f"{_PLANE} SELECT g, round(pc1, 4) AS pc1, round(pc2, 4) AS pc2 FROM plane")
def pca2(spark, sf_dir):
    placed = compare.principal_components(_top(spark, sf_dir), "g")
    return placed.select("g", *[F.round(F.get("pc", F.lit(i)), 4).alias(f"pc{i + 1}") for i in range(2)])


@register(
    "compare_universities",
    f"""{_PLANE},
points AS (SELECT g, pc1, pc2, cluster + 1 AS cluster FROM plane JOIN clusters USING (g)),
centres AS (SELECT avg(pc1) AS x, avg(pc2) AS y FROM points GROUP BY cluster),
near AS (SELECT g, min(sqrt((pc1 - x) ** 2 + (pc2 - y) ** 2)) AS d FROM points, centres GROUP BY g),
lim AS (SELECT avg(d) + stddev_samp(d) AS t FROM near)
SELECT g, round(pc1, 4) AS pc1, round(pc2, 4) AS pc2, cluster, round(d, 4) AS distance_to_center, d > t AS is_noise
FROM points JOIN near USING (g) CROSS JOIN lim""",
)
def compare_universities(spark, sf_dir):
    found = jobs.compare_universities(cut_lineage(_top(spark, sf_dir)), "g")
    return found.withColumns({c: F.round(c, 4) for c in ("pc1", "pc2", "distance_to_center")})


@register(
    "similarity_matrix_csv",
    _TOP.replace("university_name || '/' || shop_name AS g", "university_name AS g")
    + "SELECT g1, g2, cosine FROM cosines UNION ALL "
    + "SELECT a.g, b.g, 0 FROM norms a CROSS JOIN norms b WHERE (a.g, b.g) NOT IN (SELECT (g1, g2) FROM cosines)",
)
def similarity_matrix_csv(spark, sf_dir):
    """The wide matrix as a CSV file with the group as first column, read back as pairs."""
    path = scratch_path(spark, "similarities")
    writers.write_csv(similarity_matrix_wide(spark, sf_dir), path, single_file=True)
    schema = ", ".join(["g1 string", *[f"{g} double" for g in _LANGS]])
    back = spark.read.option("header", True).schema(schema).csv(path)
    return back.unpivot("g1", _LANGS, "g2", "cosine")


@register(
    "centroid_outliers",
    """
WITH dims AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings),
centres AS (SELECT label AS c, d, avg(x) AS m FROM dims GROUP BY ALL),
dist AS (
  SELECT vec_id, c, sqrt(sum((x - m) * (x - m))) AS dist FROM dims JOIN centres USING (d) GROUP BY ALL),
nearest AS (SELECT vec_id, min(dist) AS dist FROM dist GROUP BY vec_id),
lim AS (SELECT avg(dist) + stddev_samp(dist) AS t FROM nearest)
SELECT vec_id, label, round(dist, 6) AS distance_to_center, dist > t AS is_noise
FROM nearest JOIN embeddings USING (vec_id) CROSS JOIN lim""",
)
def centroid_outliers(spark, sf_dir):
    points = inp.table(spark, sf_dir, "embeddings")
    return compare.centroid_outliers(points, "embedding", "label").select(
        "vec_id", "label", F.round("distance_to_center", 6).alias("distance_to_center"), "is_noise"
    )


def _dbscan_sql(eps: float, vectors: str = "embeddings", before: str = "") -> str:
    return f"""
WITH RECURSIVE {before} unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM {vectors}),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a, unit b
  WHERE a.vec_id = b.vec_id OR 1 - list_cosine_similarity(a.v, b.v) <= {eps}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
edges AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
walk(id, root) AS (
  SELECT id, id FROM core
  UNION
  SELECT e.b, w.root FROM walk w JOIN edges e ON e.a = w.id WHERE w.root < e.b),
roots AS (SELECT id, min(root) AS root FROM walk GROUP BY id),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM roots),
border AS (
  SELECT a AS id, min(cluster) AS cluster FROM near JOIN numbered ON numbered.id = near.b
  WHERE a NOT IN (SELECT id FROM core) GROUP BY a)
SELECT vec_id, CAST(coalesce(n.cluster, b.cluster, -1) AS BIGINT) AS cluster,
       n.cluster IS NOT NULL AS is_core
FROM {vectors} LEFT JOIN numbered n ON n.id = vec_id LEFT JOIN border b ON b.id = vec_id"""


@register("dbscan_cosine", _dbscan_sql(0.68))
def dbscan_cosine(spark, sf_dir):
    return density.dbscan(inp.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.68, 5)


@register("dbscan_default_radius", _dbscan_sql(1.0))
def dbscan_default_radius(spark, sf_dir):
    return density.dbscan(inp.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1.0, 5)


@register(
    "neighbour_counts",
    """
SELECT a.vec_id, count(*) AS neighbours FROM embeddings a JOIN embeddings b
ON a.vec_id = b.vec_id OR 1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) <= 0.68
GROUP BY a.vec_id""",
)
def neighbour_counts(spark, sf_dir):
    return density.neighbour_counts(
        inp.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.68
    )


def _hashed_sql(dimensions: int) -> str:
    return f"""
reviews AS ({inp.REVIEWS_SQL.removeprefix("reviews AS (")[:-1]}),
words AS (
  SELECT review_id, unnest(regexp_extract_all(coalesce(review_text, ''), '[^ \\t\\n\\v\\f\\r]+')) AS w FROM reviews),
places AS (
  SELECT review_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dimensions} AS place, count(*) AS n FROM words GROUP BY ALL),
shares AS (
  SELECT review_id, place, n / sqrt(sum(n * n) OVER (PARTITION BY review_id)) AS value FROM places),
hashed AS (
  SELECT review_id AS vec_id,
         (SELECT list(coalesce(value, 0)::FLOAT ORDER BY i) FROM range({dimensions}) AS r(i)
          LEFT JOIN shares ON shares.place = i AND shares.review_id = reviews.review_id) AS embedding
  FROM reviews)"""


@register(
    "embed_texts",
    f"""WITH {_hashed_sql(64)}
SELECT review_id, place AS dimension, round(value::FLOAT::DOUBLE, 5) AS value FROM shares""",
)
def embed_texts(spark, sf_dir):
    """The non-zero coordinates of the hashed text vectors."""
    vectors = embedding.embed_hashing(inp.reviews(spark, sf_dir), "review_text", "review_id", 64)
    long = vectors.select("review_id", F.posexplode("embedding").alias("dimension", "value"))
    return long.filter("value <> 0").select(
        "review_id",
        F.col("dimension").cast("long").alias("dimension"),
        F.round(F.col("value").cast("double"), 5).alias("value"),
    )


@register(
    "cluster_texts",
    _dbscan_sql(0.5, "hashed", _hashed_sql(256) + ",").replace("SELECT vec_id, CAST(coalesce", "SELECT vec_id AS review_id, CAST(coalesce"),
)
def cluster_texts(spark, sf_dir):
    return jobs.cluster_texts(inp.reviews(spark, sf_dir), eps=0.5)


@register(
    "encoded_batches",
    """SELECT vec_id AS id, len(embedding) AS n_values, round(list_sum(embedding), 3) AS total
FROM (SELECT review_id AS vec_id, [length(review_text)::DOUBLE, 1.0] AS embedding
      FROM (SELECT doc_id AS review_id, coalesce("text", '') AS review_text FROM documents))""",
)
def encoded_batches(spark, sf_dir):
    """A batch encoder loaded once per task, here one that measures the text."""
    import numpy as np

    def load():
        return lambda texts: np.array([[len(t), 1] for t in texts])

    found = embedding.embed_batches(inp.reviews(spark, sf_dir), "review_text", "review_id", load)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return found.select(
        F.col("review_id").alias("id"),
        F.size("embedding").cast("long").alias("n_values"),
        F.round(total, 3).alias("total"),
    )
