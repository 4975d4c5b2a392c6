"""Joins that stay balanced when one key holds a third of all rows, and scratch tables."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 16_000_000
SALTS = 32
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000


def fits_broadcast(
    small: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS
) -> bool:
    """Measure a lookup table: at most ``rows`` rows, and ``chars`` characters or bytes in
    columns of no fixed width (nested ones as JSON).

    The scan stops after ``rows + 1`` rows, so the check is cheap for any input size. A local
    table came from the driver and is only counted by the planner, without a job.
    """
    local = _local_rows(small)
    if local is not None:
        return local <= rows
    kinds = {f.name: f.dataType.typeName() for f in small.schema.fields}
    sized = [F.length(n) for n, kind in kinds.items() if kind in ("string", "binary")]
    nested = [n for n, kind in kinds.items() if kind in ("array", "map", "struct")]
    sized += [F.length(F.to_json(F.struct(n))) for n in nested]
    size = sum((F.coalesce(c, F.lit(0)) for c in sized), F.lit(0))
    measured = small.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("c")
    )
    n, c = measured.first()
    return n <= rows and c <= chars


def _local_rows(df: DataFrame) -> int | None:
    """Most rows of a plan over one local relation without a join; None for any other."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if leaves.size() != 1 or leaves.apply(0).getClass().getSimpleName() != "LocalRelation":
        return None
    if any(word in plan.toString() for word in ("Generate", "Expand")):
        return None
    return leaves.apply(0).data().size()


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join that spreads every left key over ``salts`` tasks, for sessions without
    adaptive execution. The salt is a hash of the row, so rows should differ in some column:
    count equal rows first.

    ``right`` must hold few rows per key (a lookup or a per-group table): it is copied once
    per salt. Supports inner, left, left_semi and left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do {how!r}")
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    salted_left = left.withColumn("_salt", spread)
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def hot_key_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join two large tables when a few keys of ``left`` may be very frequent.

    Keys that hold more than ``hot_rows`` rows and more than one part in ``HOT_KEYS`` of
    ``left`` are looked up in a broadcast of their rows of ``right`` (unique per key), so at
    most ``HOT_KEYS`` rows; all other keys are joined plainly. Nothing is copied per salt.
    ``left`` should be a stored table: its keys are counted first.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"hot_key_join cannot do {how!r}")
    total = left.count()
    if total <= hot_rows:
        return left.join(right, on, how)
    limit = max(hot_rows, total // HOT_KEYS)
    frequent = left.groupBy(*on).count().filter(F.col("count") > limit).select(*on)
    frequent = F.broadcast(cut_lineage(frequent))
    few = F.broadcast(right.join(frequent, on, "left_semi"))
    hot = left.join(frequent, on, "left_semi").join(few, on, how)
    cold = left.join(frequent, on, "left_anti").join(right, on, how)
    return hot.unionByName(cold)


def lookup_join(
    left: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join against a lookup: broadcast when its measured size is bounded. Otherwise a shuffled
    join, whose hot partitions adaptive execution splits on the left without copying the whole
    lookup; where that is switched off, a salted one."""
    if fits_broadcast(small):
        return left.join(F.broadcast(small), on, how)
    conf = left.sparkSession.conf
    splits = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if all(conf.get(name) == "true" for name in splits):
        return left.join(small, on, how)
    return salted_join(left, small, on, how, salts)


def list_lookup(small: DataFrame, key: str) -> Callable[[Column], Column] | None:
    """``lookup_join`` for words inside lists: a function from a word to its row of ``small`` (a
    struct without the key, null for unknown words), so that lists need not become rows. The table
    is a constant of the plan, dealt into maps by hash. None where it is too large to be broadcast,
    where a key repeats, or where its columns are no strings or integers; then rows have to be joined.
    """
    values = [f for f in small.schema.fields if f.name != key]
    kinds = {f.dataType.simpleString() for f in values}
    if not kinds <= {"string", "tinyint", "smallint", "int", "bigint"} or not fits_broadcast(small):
        return None
    rows = [r for r in small.withColumn("_hash", F.hash(key)).collect() if r[key] is not None]
    if len({r[key] for r in rows}) < len(rows):
        return None
    count = max(1, len(rows) // 4)
    maps: list[dict] = [{} for _ in range(count)]
    for r in rows:
        maps[r["_hash"] % count][r[key]] = {f.name: r[f.name] for f in values} | {"_known": True}
    fields = ", ".join([*(f"`{f.name}`: {f.dataType.simpleString()}" for f in values), "_known: boolean"])
    # a constant expression: the optimizer reads the text once
    table = F.from_json(F.lit(json.dumps(maps, ensure_ascii=False)), f"array<map<string, struct<{fields}>>>")
    return lambda word: F.try_element_at(F.get(table, F.pmod(F.hash(word), F.lit(count))), word)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder: the setting, or else the folder the context was
    given; a temporary one only for a local master that has neither."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


_LOCAL_FOLDER: list[str] = []


def _local_folder() -> str:
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        atexit.register(shutil.rmtree, _LOCAL_FOLDER[0], ignore_errors=True)
    return _LOCAL_FOLDER[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives the loss of any executor,
    computes the plan once (a checkpoint computes it twice) and keeps columns prunable."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
