"""Audit of how sources diverge within a language, by exact integer term shares.

Terms of all documents go through Spark ML's ``CountVectorizer`` (``minDF`` of three documents,
the largest vocabulary size there is). What it turns into sparse vectors is, for each group and
slice of documents, the list of the distinct terms that occur equally often there: a vector times
that number, summed, is the sum of the documents' own vectors. A term carries its language as a prefix, so the vocabularies of all languages are fitted
at once and stay apart. The vocabulary of a fit lives on the driver and in a broadcast, so terms
are first dealt by hash into as many slices as keep a fit below ``SLICE_TERMS`` distinct terms
(estimated before from hashes of the terms, at a margin of three standard errors); each slice is read by its own fit only.

Sparse vectors are summed per language and source inside a task; sums leave it as one row for each
``BUCKETS``-th of the terms and are added up where all rows of a bucket meet. A pair of
sources is compared over all kept terms without visiting those that neither has: the sum over
terms that both lack is a product, terms that one has are summed against the other's share of an
absent term, and terms that both have correct these sums. The three sums come from blocks of
terms; a block holds all sources of its terms and sends one number per pair of sources. Blocks of
a language with very many sources are cut into tiles of rows of the pair matrix.

Defined results: null text, lang and source count as ''; rows that repeat are documents of their
own; a group without terms has count 0 everywhere; a language without kept terms gives pairs of
value 0 and no terms; equal values are ordered by the item's UTF-8 bytes; a source alone in its
language has no pairs; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import byte_table, stored, text_slices, tokens_of, with_running_sums
from reviewmill.operators.skew import lookup_join, scratch_path

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
NARROW = 9_000_000_000
SLICE_TERMS = 3_000_000
SLICE_BYTES = 1 << 20
COUNTED_BYTES = 1 << 21
VECTOR_ENTRIES = 1 << 21
BUCKETS = 1 << 12
POWER = np.uint64(0x9E3779B97F4A7C15)
BLOCK_ENTRIES = 1 << 16
TILE_PAIRS = 1 << 21
STEP = 1 << 18
INTEGER_MAX = (1 << 31) - 1
DISTINCT_ERROR = 0.02

# Letters of ASCII and everything beyond it.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def numbered_groups(docs: DataFrame) -> DataFrame:
    """One row ``lang, source, gid`` per occurring language and source."""
    found = docs.select("lang", "source").distinct()
    return with_running_sums(found, [F.col("lang").asc(), F.col("source").asc()], {}, "divergence-groups").select(
        "lang", "source", F.col("row_index").alias("gid")
    )


IN_TERM = byte_table([*range(65), *range(91, 97), *range(123, 128)])


def terms_of(batch: pa.RecordBatch, most: int = 0) -> tuple[pa.Array, np.ndarray]:
    """All terms of a batch ``gid, lang, text``, each after its language and a zero character, and
    where each row's terms begin (and the last ones end). With ``most`` a row's distinct terms, and
    a term of a language in the first ``most`` rows only that hold it: more can't tell whether it
    occurs in that many."""
    terms, begins = tokens_of(batch.column("text"), IN_TERM)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(begins))
    if most:
        coded, langs = terms.dictionary_encode(), batch.column("lang").dictionary_encode().indices.to_numpy()
        size = max(1, len(coded.dictionary))
        distinct = pa.array(owner * size + coded.indices.to_numpy()).unique().to_numpy()  # still row by row
        key = langs[distinct // size].astype(np.int64) * size + distinct % size
        order = np.argsort(key, kind="stable")
        key = key[order]
        earlier = np.zeros(len(key), bool)  # as many rows before it hold the term
        earlier[most:] = key[most:] == key[:-most]
        distinct = distinct[np.sort(order[~earlier])]
        terms, owner = coded.dictionary.take(pa.array(distinct % size)), distinct // size
        begins = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    return pc.binary_join_element_wise(batch.column("lang").take(pa.array(owner)), terms, "\0"), begins


def repeats_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows ``gid, times, terms`` of a batch ``gid, lang, text``: a group's distinct terms that occur
    ``times`` times in its rows, each after its language and a zero character."""
    terms, begins = tokens_of(batch.column("text"), IN_TERM)
    coded = terms.dictionary_encode()
    size = max(1, len(coded.dictionary))
    gids, first, group = np.unique(batch.column("gid").to_numpy(), return_index=True, return_inverse=True)
    key = np.repeat(group.astype(np.int64), np.diff(begins)) * size + coded.indices.to_numpy()
    key, times = np.unique(key, return_counts=True)
    order = np.lexsort((times, key // size))
    group, term, times = key[order] // size, key[order] % size, times[order]
    starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (times[1:] != times[:-1])][: len(key)])
    langs = batch.column("lang").take(pa.array(first[group]))
    named = pc.binary_join_element_wise(langs, coded.dictionary.take(pa.array(term)), "\0")
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(key)), pa.int32()), named)
    columns = [pa.array(gids[group[starts]], pa.int64()), pa.array(times[starts], pa.int64()), lists]
    return pa.RecordBatch.from_arrays(columns, ["gid", "times", "terms"])


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when a task is done with them, its worker gives unused memory back."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()


def term_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """A number of 64 bits for each distinct pair of a term and its language, from its bytes alone."""
    terms, begins = tokens_of(batch.column("text"), IN_TERM)
    if not len(terms):
        return np.zeros(0, np.int64)
    starts = np.frombuffer(terms.buffers()[1], np.int32)[: len(terms) + 1].astype(np.int64)
    sizes = np.diff(starts)
    powers = np.cumprod(np.full(int(sizes.max()), POWER))
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
    found = np.add.reduceat(powers[place] * np.frombuffer(terms.buffers()[2], np.uint8)[: starts[-1]], starts[:-1])
    langs = batch.column("lang").dictionary_encode()
    seeds = [zlib.crc32(x.encode()) << 32 | zlib.adler32(x.encode()) for x in langs.dictionary.to_pylist()]
    found ^= np.repeat(np.array(seeds, np.uint64)[langs.indices.to_numpy()] * POWER, np.diff(begins))
    found.sort()
    return found[np.r_[True, found[1:] != found[:-1]]].view(np.int64)


def distinct_terms(docs: DataFrame) -> int:
    """More terms than there are, by an estimate and three times its standard error."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(released(batches), COUNTED_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(term_hashes(batch))], ["term"])

    found = docs.mapInArrow(distinct, "term long").agg(F.approx_count_distinct("term", DISTINCT_ERROR)).first()[0]
    return int(found * (1 + 3 * DISTINCT_ERROR))


def term_slices(docs: DataFrame, least: int, slice_terms: int) -> list[tuple[DataFrame, DataFrame]]:
    """Rows in slices by a hash of the term, each of a bounded vocabulary: ``terms`` for a fit, which
    needs to see a term once per row and in ``least`` rows of a batch, and ``gid, times, terms`` for
    the vectors, which need a group's term of a batch once and how often it occurs."""
    count = max(1, -(-distinct_terms(docs) // slice_terms))

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(released(batches), SLICE_BYTES):
            yield repeats_of(batch)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(released(batches), COUNTED_BYTES):
            terms, begins = terms_of(batch, max(1, least))
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), terms)
            yield pa.RecordBatch.from_arrays([lists], ["terms"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(released(batches), SLICE_BYTES):
            terms, begins = terms_of(batch)
            coded = terms.dictionary_encode()
            of_term = [zlib.crc32(t.encode()) % count for t in coded.dictionary.to_pylist()]
            dealt = np.array(of_term, np.int64)[coded.indices.to_numpy()]
            place = dealt * batch.num_rows + np.repeat(np.arange(batch.num_rows), np.diff(begins))
            order = np.argsort(place, kind="stable")
            rows, sizes = np.unique(place, return_counts=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), terms.take(pa.array(order)))
            own = batch.column("gid").take(pa.array(rows % batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [own, lists, pa.array(rows // batch.num_rows, pa.int32())], ["gid", "terms", "slice"]
            )

    if count == 1:
        terms = "terms array<string>"
        return [(docs.mapInArrow(distinct, terms), docs.mapInArrow(repeats, f"gid long, times long, {terms}"))]
    dealt = docs.mapInArrow(deal, "gid long, terms array<string>, slice int")
    dealt = stored(dealt.sortWithinPartitions("slice"), "divergence-slices")  # a fit reads its pages only
    once = F.lit(1).cast("long").alias("times")
    parts = [dealt.filter(F.col("slice") == k).select("gid", once, "terms") for k in range(count)]
    return [(part, part) for part in parts]


def added_up(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(key)
    key = key[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    return key[begins], np.add.reduceat(count[order], begins) if len(begins) else count


def bucket_of(key: np.ndarray) -> np.ndarray:
    return ((key >> 32) % BUCKETS).astype(np.uint16)


def bucket_rows(key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Rows ``bucket, keys, counts``: numbers of the terms of each bucket, 8 bytes each."""
    bucket = bucket_of(key)
    order = np.argsort(bucket, kind="stable")
    found, sizes = np.unique(bucket, return_counts=True)
    offsets = pa.py_buffer((np.append(0, np.cumsum(sizes)) * 8).astype(np.int32))
    columns = [pa.Array.from_buffers(pa.binary(), len(found), [None, offsets, pa.py_buffer(x[order])]) for x in (key, count)]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *columns], ["bucket", "keys", "counts"])


def numbers_in(column: pa.Array) -> np.ndarray:
    """All numbers of 8 bytes of the rows of a binary column."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    return np.frombuffer(held, np.uint8)[ends[0] : ends[-1]].copy().view(np.int64) if held is not None else np.zeros(0, np.int64)


def add_vectors(vectors: DataFrame) -> DataFrame:
    """Rows ``gid, at, count, of_lang``: the sparse vectors ``v``, each ``times`` times, summed per
    group, and summed over all groups. A key is the term's number before the group's, 32 bits each."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in released(batches):
            filled = pc.list_value_length(pc.struct_field(whole.column("v"), "indices"))
            ends = np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)
            last = 0
            while last < whole.num_rows:
                first, done = last, ends[last - 1] if last else 0
                last = max(first + 1, int(np.searchsorted(ends, done + VECTOR_ENTRIES)))
                batch = whole.slice(first, last - first)
                indices, values = (pc.struct_field(batch.column("v"), n) for n in ("indices", "values"))
                sizes = pc.list_value_length(indices).to_numpy(zero_copy_only=False).astype(np.int64)
                gid, times = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("gid", "times"))
                key = indices.flatten().to_numpy().astype(np.int64) << 32 | gid
                yield bucket_rows(*added_up(key, values.flatten().to_numpy().astype(np.int64) * times))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            at = key >> 32
            begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
            of_lang = np.repeat(np.add.reduceat(count, begins), np.diff(np.append(begins, len(at)))) if len(at) else count
            columns = [key & 0xFFFFFFFF, at, count, of_lang]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gid", "at", "count", "of_lang"])

        key = count = np.zeros(0, np.int64)
        for batch in released(batches):
            if batch.num_rows:
                more = numbers_in(batch.column("keys")), numbers_in(batch.column("counts"))
                key, count = added_up(np.append(key, more[0]), np.append(count, more[1]))
                waits = bucket_of(key) == batch.column("bucket")[-1].as_py()  # more rows may follow
                yield summed(key[~waits], count[~waits])
                key, count = key[waits], count[waits]
        yield summed(key, count)

    rows = vectors.mapInArrow(add_up, "bucket int, keys binary, counts binary")
    met = rows.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(merge, "gid long, at long, count long, of_lang long")


def fitted_terms(model: CountVectorizerModel) -> DataFrame:
    """Rows ``at, lang, term`` of a fitted vocabulary, by way of the shared folder (the driver's
    Python never holds it)."""
    spark = SparkSession.active()
    path = scratch_path(spark, "divergence-vocabulary")
    model.write().save(path)
    keys = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("at", "key"))
    return keys.select(
        F.col("at").cast("long").alias("at"),
        F.expr("left(key, length(key) - length(substring_index(key, '\\0', -1)) - 1)").alias("lang"),
        F.substring_index("key", "\0", -1).alias("term"),
    )


def group_counts(docs: DataFrame, least: int, slice_terms: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``gid, lang, term, count, of_lang`` of the kept terms that occur in a group (and their
    count in the language), written once; and the number of kept terms by language."""
    found, sizes = [], []
    for once, part in term_slices(docs, least, slice_terms):
        model = CountVectorizer(inputCol="terms", outputCol="v", minDF=float(least), vocabSize=INTEGER_MAX).fit(once)
        vocabulary = stored(fitted_terms(model), "divergence-terms")
        sizes.append(vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary")))
        sums = add_vectors(model.transform(part).select("gid", "times", "v")).join(vocabulary, "at")
        found.append(stored(sums.select("gid", "lang", "term", "count", "of_lang"), "divergence-counts"))
    kept = reduce(DataFrame.unionByName, sizes).groupBy("lang").agg(F.sum("vocabulary").alias("vocabulary"))
    return reduce(DataFrame.unionByName, found), kept


def share(count: str, total: str, size: str) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + size))`` in exact integers; null for an empty
    vocabulary. Counts that would not fit are multiplied as decimals."""
    wide = f"(CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))) div CAST({total} + {size} AS DECIMAL(20,0))"
    narrow = f"({UNIT}L * ({count} + 1)) div ({total} + {size})"
    return F.expr(f"CASE WHEN {size} > 0 THEN 1 + CASE WHEN {count} < {NARROW}L THEN {narrow} ELSE {wide} END END")


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pair_matrix(source: np.ndarray, term: np.ndarray, p: np.ndarray, absent: np.ndarray, first: int, last: int) -> np.ndarray:
    """What the present terms of a block add to the sums of the pairs (row, column), for the rows
    ``first`` to ``last``, beyond the value of a term that both lack."""
    size = len(absent)
    total = np.zeros((last - first, size), np.int64)
    neither = _gap(absent[first:last, None], absent)
    # terms of the row's source against an absent one, and the other way round
    pairs, n = np.unique(np.stack([source, p], 1), axis=0, return_counts=True)
    step = max(1, STEP // size)
    for a in range(0, len(pairs), step):
        s, v, times = pairs[a : a + step, 0], pairs[a : a + step, 1], n[a : a + step, None]
        mine = (s >= first) & (s < last)
        rows = _gap(v[mine, None], absent) - neither[s[mine] - first]
        np.add.at(total, s[mine] - first, rows * times[mine])
        columns = _gap(absent[first:last], v[:, None]) - neither[:, s].T
        np.add.at(total.T, s, columns * times)
    # terms of both
    order = np.argsort(term, kind="stable")
    source, p = source[order], p[order]
    begins = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0]) if len(term) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[begins, len(term)])
    flat = total.ravel()
    for g in np.unique(sizes[sizes > 1]):
        chosen = begins[sizes == g]
        step = max(1, STEP // (g * g))
        width = max(1, min(g, STEP // g))
        for a in range(0, len(chosen), step):
            at = chosen[a : a + step, None] + np.arange(g)
            s, v = source[at], p[at]
            zero = absent[s]
            for b in range(0, g, width):
                s1, v1, z1 = s[:, b : b + width, None], v[:, b : b + width, None], zero[:, b : b + width, None]
                s2, v2, z2 = s[:, None], v[:, None], zero[:, None]
                more = _gap(v1, v2) - _gap(v1, z2) - _gap(z1, v2) + _gap(z1, z2)
                inside = np.broadcast_to((s1 >= first) & (s1 < last), more.shape)
                place = np.broadcast_to((s1 - first) * size + s2, more.shape)
                np.add.at(flat, place[inside], more[inside])
    return total


def compare_pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows ``lang, s, t, value`` for every two groups of a language. ``entries`` has ``lang, s,
    term, p`` of present terms; ``groups`` has ``lang, s, source, absent, vocabulary``."""
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    step = F.greatest(F.lit(1), F.least(F.col("sources"), F.expr(f"{TILE_PAIRS} div sources")))
    layout = entries.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).join(langs, "lang")
    layout = stored(
        layout.select(
            "lang",
            F.ceil(F.col("n") / BLOCK_ENTRIES).cast("int").alias("blocks"),
            step.cast("int").alias("step"),
            F.ceil(F.col("sources") / step).cast("int").alias("tiles"),
        ),
        "divergence-layout",
    )
    tiles = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    placed = lookup_join(entries, layout, ["lang"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    left = placed.select("lang", block, tiles, "step", "s", "term", "p")
    right = lookup_join(groups.select("lang", "s", "absent"), layout, ["lang"])
    right = right.select("lang", blocks, "tiles", "s", "absent").select("lang", "block", tiles, "s", "absent")
    right = right.toDF("of_lang", "of_block", "of_tile", "number", "absent")  # names of their own for the cogroup

    def compare(rows: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"lang": [], "s": [], "t": [], "value": []})
        absent = np.zeros(len(sources), np.int64)
        absent[sources["number"].to_numpy()] = sources["absent"].to_numpy()
        first = int(rows["tile"].iloc[0]) * int(rows["step"].iloc[0])
        last = min(len(absent), first + int(rows["step"].iloc[0]))
        total = pair_matrix(
            rows["s"].to_numpy(np.int64), pd.factorize(rows["term"])[0], rows["p"].to_numpy(np.int64), absent, first, last
        )
        s, t = np.nonzero(total)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "s": s + first, "t": t, "value": total[s, t]})

    sides = left.groupBy("lang", "block", "tile").cogroup(right.groupBy("of_lang", "of_block", "of_tile"))
    found = sides.applyInPandas(compare, "lang string, s int, t int, value long")
    found = found.groupBy("lang", "s", "t").agg(F.sum("value").alias("more"))
    one = groups.select("lang", "s", F.col("absent").alias("p"), "vocabulary")
    two = groups.select("lang", F.col("s").alias("t"), F.col("absent").alias("q"))
    both = one.join(two, "lang").filter("s <> t")
    apart = F.expr("vocabulary * ((p - q) * (p - q) div q)")
    value = F.coalesce(apart, F.lit(0)) + F.coalesce(F.col("more"), F.lit(0))
    return both.join(found, ["lang", "s", "t"], "left").select("lang", "s", "t", value.cast("long").alias("value"))


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank``: parts ``pair`` (the other sources) and
    ``term`` (the first ``top`` terms that a source uses more than its language does)."""
    columns = ((lang, "lang"), (source, "source"), (text, "text"))
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in columns])
    groups = numbered_groups(rows)
    groups = stored(groups, "divergence-names")
    texts = lookup_join(rows, groups, ["lang", "source"]).select("gid", "lang", "text")
    counts, kept = group_counts(texts, least, slice_terms)
    totals = counts.groupBy("gid").agg(F.sum("count").alias("total"))
    groups = groups.join(totals, "gid", "left").join(kept, "lang", "left").fillna(0, ["total", "vocabulary"])
    whole = F.sum("total").over(Window.partitionBy("lang"))
    groups = groups.withColumn("lang_total", whole)
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumns({"s": numbered, "absent": share("0L", "total", "vocabulary")})
    groups = stored(groups, "divergence-groups")

    facts = groups.select("gid", "source", "s", "total", "lang_total", "vocabulary")
    entries = lookup_join(counts, facts, ["gid"]).withColumn("p", share("count", "total", "vocabulary"))
    pairs = compare_pairs(entries.select("lang", "s", "term", "p"), groups)
    names = groups.select("lang", "s", "source")
    others = groups.select("lang", F.col("s").alias("t"), F.col("source").alias("item"))
    pairs = lookup_join(lookup_join(pairs, names, ["lang", "s"]), others, ["lang", "t"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    ranked = entries.withColumn("q", share("of_lang", "lang_total", "vocabulary"))
    ranked = ranked.filter("p > q").select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").alias("item"),
        F.expr("(p - q) * (p - q) div q").alias("value"),
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = ranked.withColumn("rank", place).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(ranked)


SQL = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS terms
  FROM documents
), counted AS MATERIALIZED (
  SELECT lang, source, d, term, count(*) AS n FROM (SELECT lang, source, d, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}
), sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), found AS MATERIALIZED (
  SELECT lang, source, term, sum(counted.n) AS n FROM counted JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS n FROM groups LEFT JOIN found USING (lang, source) GROUP BY ALL
), shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS count,
         (1 + {UNIT}::HUGEINT * (coalesce(f.n, 0)::HUGEINT + 1) // (g.n::HUGEINT + s.v))::BIGINT AS p,
         (1 + {UNIT}::HUGEINT * (k.n::HUGEINT + 1) // (s.n::HUGEINT + s.v))::BIGINT AS of_lang
  FROM totals g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - of_lang) * (p - of_lang) // of_lang)::BIGINT
  FROM shares WHERE count > 0 AND p > of_lang
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
