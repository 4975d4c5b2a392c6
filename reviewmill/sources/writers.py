"""Writers. Output is a folder of part files; one file only on request."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def safe_name(*parts: str) -> str:
    """File name from parameters: spaces and slashes become underscores."""
    return "_".join(p.replace(" ", "_").replace("/", "_") for p in parts)


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", single_file: bool = False
) -> None:
    """CSV in UTF-8 without a byte-order mark.

    ``single_file`` is for reports: the last step runs in one task, which streams the rows to
    the file and holds none of them, so it takes long for large output but does not fail.
    """
    out = df
    if single_file:
        out = df.repartition(1)
    out.write.mode(mode).option("header", header).option("escape", '"').csv(path)


def store_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    """Headerless delimited output; an existing target is an error."""
    df.write.mode("errorifexists").option("sep", separator).csv(path)


def write_text_lines(df: DataFrame, column: str, path: str) -> None:
    """One line per row, nulls dropped."""
    df.select(column).dropna().write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder per value of ``by``, as Parquet."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Compute once: reuse the table stored at ``path``, or store it there first.

    A folder without the commit marker was left by an interrupted write and is replaced.
    """
    spark = df.sparkSession
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_embeddings(df: DataFrame, path: str) -> None:
    df.select("id", F.col("embedding").cast("array<float>")).write.mode("overwrite").parquet(path)
