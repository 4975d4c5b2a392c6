"""Readers. Schemas are declared; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.functions.constants import REVIEW_COLUMNS, REVIEW_COLUMNS_KO
from reviewmill.functions import text as tx
from reviewmill.operators.skew import cut_lineage, lookup_join
from reviewmill.session import local_table

REVIEW_SCHEMA = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)
CORE_SCHEMA = (
    "university string, cafeName string, avgRating float, reviewerCount int, visitCount int"
)
RANKING_SCHEMA = (
    "university string, cafeName string, avgRating double, "
    "totalReviewerCount long, totalVisitCount long"
)
LEXICON_SCHEMA = "word string, polarity int"
SPREAD_SPLITS = 64
EMBEDDING_SCHEMA = "id long, embedding array<float>"


def without_bom(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "^﻿", "")


def read_reviews(
    spark: SparkSession, path: str | list[str], multiline: bool = True, add_id: bool = True
) -> DataFrame:
    """Review CSV with a header: eight positional columns under their English names.

    Quoted commas and line breaks are honoured; a quote inside a quoted field is doubled.
    Counts and the rating are typed, text such as "no rating" becoming null. ``add_id`` adds the
    integer ``review_id`` of ``stable_ids``, at the price of a first scan that counts rows.
    ``multiline=False`` lets one large file be split.
    """
    raw = (
        spark.read.schema(REVIEW_SCHEMA)
        .option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )
    typed = raw.withColumns(
        {
            "shop_avg_rating": F.col("shop_avg_rating").try_cast("float"),
            "reviewer_review_count": F.col("reviewer_review_count").try_cast("int"),
            "shop_visit_count": F.col("shop_visit_count").try_cast("int"),
        }
    )
    return stable_ids(typed, "review_id") if add_id else typed


def stable_ids(rows: DataFrame, name: str) -> DataFrame:
    """Rows read from files with integers from 0, by file path and by place in the file.

    They depend on the files alone, not on how these are split or packed into tasks. Rows are
    counted per split first; a row's number is the count of the rows in earlier files and splits
    and its place in its split. Should the splits differ between the count and the use (a setting
    changed in between), the job fails instead of repeating or losing a number.
    """
    placed = rows.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_split": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    splits = placed.groupBy("_file", "_split").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    splits = cut_lineage(splits)
    earlier = (Window.unboundedPreceding, -1)
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n"))
    of_files = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(*earlier)), F.lit(0))
    in_file = F.sum("_n").over(Window.partitionBy("_file").orderBy("_split").rowsBetween(*earlier))
    starts = splits.withColumn("_before", F.coalesce(in_file, F.lit(0)))
    starts = starts.join(files.select("_file", of_files.alias("_start")), "_file")
    starts = cut_lineage(starts.withColumn("_start", F.col("_start") + F.col("_before")).drop("_before"))
    at = F.col("_row") - F.col("_first")
    changed = F.raise_error(F.lit("the files are split otherwise than when their rows were counted"))
    number = F.when((at >= 0) & (at < F.col("_n")), F.col("_start") + at).otherwise(changed.cast("long"))
    numbered = lookup_join(placed, starts, ["_file", "_split"], "left")
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], number.alias(name))


def english_names(df: DataFrame) -> DataFrame:
    """Korean or alternative header names to the English ones; names are trimmed."""
    aliases = dict(zip(REVIEW_COLUMNS_KO, REVIEW_COLUMNS, strict=True))
    aliases |= {"university": "university_name", "review": "review_text"}
    trimmed = df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
    return trimmed.withColumnsRenamed({k: v for k, v in aliases.items() if k in trimmed.columns})


def positional_names(df: DataFrame) -> DataFrame:
    return df.toDF(*REVIEW_COLUMNS)


def read_delimited(
    spark: SparkSession, path: str, schema: str, separator: str = ",", quoted: bool = False
) -> DataFrame:
    """Headerless delimited text under a declared schema. Fields that do not parse are null;
    with ``quoted=False`` quotes are ordinary characters."""
    reader = spark.read.schema(schema).option("sep", separator).option("mode", "PERMISSIVE")
    if not quoted:
        reader = reader.option("quote", "")
    return reader.csv(path)


def read_core(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, CORE_SCHEMA)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a sortable position, also when a file is read in several splits."""
    position = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return spark.read.text(path).select(without_bom("value").alias("value"), position.alias("at"))


def _lexicon_fields(lines: DataFrame) -> DataFrame:
    fields = F.split(tx.strip("value"), "\t")
    return lines.select(
        "value",
        "at",
        F.size(fields).alias("arity"),
        F.get(fields, F.lit(0)).alias("word"),
        F.get(fields, F.lit(1)).try_cast("int").alias("polarity"),
    )


def last_wins(entries: DataFrame, at: str = "at") -> DataFrame:
    """One row per word; of several entries the last in file order counts."""
    return entries.groupBy("word").agg(F.max_by("polarity", at).alias("polarity"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Strict lexicon: a malformed line fails the job as soon as the lexicon is used."""
    fields = _lexicon_fields(_numbered_lines(spark, path))
    checked = fields.withColumn(
        "polarity",
        F.when(
            (F.col("arity") != 2) | F.col("polarity").isNull(),
            F.raise_error(F.concat(F.lit("malformed lexicon line: "), "value")).cast("int"),
        ).otherwise(F.col("polarity")),
    )
    return last_wins(checked)


def split_lexicon_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lenient parsing of ``value, at`` lines: good entries and rejected lines."""
    fields = _lexicon_fields(lines)
    good = (F.col("arity") == 2) & F.col("polarity").isNotNull()
    return (
        fields.filter(good).select("word", "polarity", "at"),
        fields.filter(~good).select("value"),
    )


def read_lexicon_lenient(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lexicon from the well-formed lines, and the rejected lines."""
    entries, rejects = split_lexicon_lines(_numbered_lines(spark, path))
    return last_wins(entries), rejects


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop words, one per line."""
    words = spark.read.text(path).select(without_bom("value").alias("word"))
    return words.filter(F.col("word") != "").distinct()


def join_word_lists(first: DataFrame, *others: DataFrame) -> DataFrame:
    merged = first.select("word")
    for other in others:
        merged = merged.union(other.select("word"))
    return merged.distinct()


def word_list(spark: SparkSession, words: list[str]) -> DataFrame:
    return local_table(spark, [(w,) for w in words], "word string").distinct()


def read_result_parts(
    spark: SparkSession, paths: list[str], schema: str = RANKING_SCHEMA
) -> DataFrame:
    """Headerless result directories as one table; missing directories are skipped and
    text fields trimmed."""
    found = None
    for path in paths:
        try:
            part = spark.read.schema(schema).csv(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    text = [f.name for f in found.schema.fields if f.dataType.typeName() == "string"]
    return found.withColumns({c: tx.strip(c) for c in text})


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per file: ``file_id`` (the full path) and ``text``."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("file_id"), F.col("value").alias("text"))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EMBEDDING_SCHEMA).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when a small input has fewer splits than the session has cores.

    A file with one large row group is one task however many cores there are. The shuffle
    this costs is bounded by ``SPREAD_SPLITS`` splits; larger inputs are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < min(cores, SPREAD_SPLITS)
    return df.repartition(cores) if few else df


# ---- records inside text lines --------------------------------------------


def comma_records(
    lines: DataFrame, min_fields: int, names: dict[int, str], keep: list[str] | None = None
) -> DataFrame:
    """Unquoted comma records: lines with fewer than ``min_fields`` fields are dropped,
    ``names`` maps field positions to columns."""
    fields = F.split(tx.strip("value"), ",")
    rows = lines.select(*(keep or []), fields.alias("_f")).filter(F.size("_f") >= min_fields)
    return rows.select(
        *(keep or []), *[F.get("_f", F.lit(i)).alias(name) for i, name in names.items()]
    )


def tab_records(lines: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Tab records with exactly as many fields as names; other lines are dropped."""
    fields = F.split(tx.strip("value"), "\t")
    rows = lines.select(*(keep or []), fields.alias("_f")).filter(F.size("_f") == len(names))
    return rows.select(
        *(keep or []), *[F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )
