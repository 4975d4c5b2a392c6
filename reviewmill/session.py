"""Session settings that the operators are written for."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "reviewmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small literal table. An Arrow table is a local relation of known size whatever the session's
    settings; rows or pandas would need Python workers where ``arrow.pyspark.enabled`` is off."""
    kind = StructType.fromDDL(schema)
    cells = [dict(zip(kind.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(cells, to_arrow_schema(kind)), kind)
