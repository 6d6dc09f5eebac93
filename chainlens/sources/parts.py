"""Stored tables in parts by key range, of which a commit rewrites the touched ones.

A table is a folder::

    data/v=N/part=K/*.parquet    rows of part K as version N wrote them
    changes/v=N/*.parquet        the change feed (old, new) of version N
    version=N[-batch=B]/         the schema, and the parts of version N: part, low, folder, rows

A part holds a range of keys (``low`` up to the next part's low), so the rows of
one account, whose keys or ARNs sort together, lie in few parts, and a large
account in many.  An upsert reads the parts that its batch's keys fall into,
writes them anew under its own version and then the list of parts.  The list is
what readers go by and its _SUCCESS marker is written last: a write that fails, or
is tried again, leaves what was readable.  A part that grew beyond twice
``part_rows`` is split by range.  One writer at a time.

The list has one row for each part (``part_rows`` rows of data), the size of a
file listing, and is the only thing the driver holds.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chainlens.operators.upsert import upsert_feed
from chainlens.schemas import UpsertSpec
from chainlens.session import releasing
from chainlens.sources.store import _folders, _fs

PART_ROWS = 1_000_000


LIST = "place long, part long, low string, folder string, rows long"
_SCHEMA = -1  # the place of the row that holds the table's schema


def _list(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, StructType, list[dict]]:
    """(version, schema, its parts in key order); the newest committed version by default."""
    done = [(v, folder) for v, _, folder, ok in _folders(spark, root) if ok and version in (None, v)]
    if not done:
        raise FileNotFoundError(f"no committed version {'' if version is None else version} under {root}")
    v, folder = done[-1]
    rows = sorted((r.asDict() for r in spark.read.schema(LIST).parquet(folder).collect()), key=lambda r: r["place"])
    return v, StructType.fromJson(json.loads(rows[0]["low"])), [r | {"low": json.loads(r["low"])} for r in rows[1:]]


def _next_version(spark: SparkSession, root: str) -> int:
    folders = _folders(spark, root)
    return folders[-1][0] + 1 if folders else 0


def _read_parts(spark: SparkSession, root: str, schema: StructType, parts: list[dict]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p['folder']}" for p in parts])


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version (the newest by default)."""
    return _read_parts(spark, root, *_list(spark, root, version)[1:])


def _feed(spark: SparkSession, root: str, schema: StructType, version: int) -> DataFrame:
    return spark.read.schema(StructType([StructField("old", schema), StructField("new", schema)])).parquet(f"{root}/changes/v={version}")


def changes(spark: SparkSession, root: str, version: int) -> DataFrame:
    """(old, new) of the keys that a version touched."""
    return _feed(spark, root, _list(spark, root, version)[1], version)


def _counted(spark: SparkSession, path: str, key: list[str], schema: StructType) -> list:
    """(part, its least key, rows) of the part folders under ``path``."""
    fs, folder, jvm = _fs(spark, path)
    if not fs.exists(folder) or not fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, "part=*")):
        return []
    rows = spark.read.schema(StructType([schema[k] for k in key]).add("part", "long")).parquet(path)
    return rows.groupBy("part").agg(F.min(F.struct(*key)).alias("low"), F.count("*").alias("rows")).collect()


def _deal(rows: DataFrame, key: list[str], parts: int, root: str, folder: str, first: int) -> list[dict]:
    """Write rows as ``parts`` key ranges, numbered from ``first``; the parts' list."""
    dealt = rows.repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id() + first).sortWithinPartitions("part", *key)
    with releasing(rows.sparkSession):
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{root}/{folder}")
    got = [{"part": r.part, "low": list(r.low), "folder": f"{folder}/part={r.part}", "rows": r.rows}
           for r in _counted(rows.sparkSession, f"{root}/{folder}", key, rows.schema)]
    return sorted(got, key=lambda p: p["part"])  # numbered in key order


def _commit(spark: SparkSession, root: str, version: int, schema: StructType, parts: list[dict], batch_id: int | None) -> int:
    rows = [(_SCHEMA, None, schema.json(), None, 0)]
    rows += [(n, p["part"], json.dumps(p["low"]), p["folder"], p["rows"]) for n, p in enumerate(parts)]
    name = f"{root}/version={version}" + ("" if batch_id is None else f"-batch={batch_id}")
    spark.createDataFrame(rows, LIST).coalesce(1).write.mode("errorifexists").parquet(name)
    return version


def create(rows: DataFrame, root: str, spec: UpsertSpec, part_rows: int = PART_ROWS, batch_id: int | None = None) -> int:
    """Store ``rows`` as a new table; its version."""
    spark, key = rows.sparkSession, list(spec.key)
    version = _next_version(spark, root)
    # counted on what is stored, as rows may be costly: one pass writes them, another deals them
    with releasing(spark):
        rows.write.mode("overwrite").parquet(f"{root}/changes/v={version}-given")
    given = spark.read.schema(rows.schema).parquet(f"{root}/changes/v={version}-given")
    parts = _deal(given, key, max(1, math.ceil(given.count() / part_rows)), root, f"data/v={version}", 0)
    return _commit(spark, root, version, rows.schema, parts, batch_id)


def part_of(key: list[str], parts: list[dict]) -> Column:
    """The number of the part that holds a key: the last whose low is not above it.
    Lows are searched in groups, so a row compares twice the root of their number."""
    size = max(1, math.isqrt(len(parts)))
    low = lambda p: F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(key, p["low"])])
    mine = F.struct(*[F.col(k).cast("string").alias(k) for k in key])
    groups = [parts[k:k + size] for k in range(0, len(parts), size)]
    not_above = lambda lows: F.size(F.filter(lows, lambda x: x <= mine))
    group = F.greatest(not_above(F.array(*[low(g[0]) for g in groups])), F.lit(1))
    inside = F.element_at(F.array(*[F.array(*[low(p) for p in g]) for g in groups]), group)
    numbers = F.array(*[F.array(*[F.lit(p["part"]) for p in g]) for g in groups])
    return F.element_at(F.element_at(numbers, group), F.greatest(not_above(inside), F.lit(1))).cast("long")


def upsert(spark: SparkSession, root: str, batch: DataFrame, spec: UpsertSpec, as_of=None, seq: str | list[str] | None = "_seq",
           batch_id: int | None = None, part_rows: int = PART_ROWS, new_schema: StructType | None = None) -> int:
    """Upsert ``batch`` (B-1 ... B-8) into the table: a new version, in which only
    the parts that the batch's keys fall into are written.  A batch id that was
    committed before changes nothing.  A table that does not exist yet begins empty,
    with ``new_schema``.  Returns the version."""
    done = [v for v, b, _, ok in _folders(spark, root) if ok and batch_id is not None and b == batch_id]
    if done:
        return done[-1]
    key = list(spec.key)
    begun = new_schema is None or any(ok for *_, ok in _folders(spark, root))
    schema, parts = _list(spark, root)[1:] if begun else (new_schema, [])
    version = _next_version(spark, root)
    touched = {r.part for r in batch.select(part_of(key, parts).alias("part")).distinct().collect()} if parts else set()
    current = _read_parts(spark, root, schema, [p for p in parts if p["part"] in touched])
    with releasing(spark):
        upsert_feed(current, batch, spec, as_of, seq).write.mode("overwrite").parquet(f"{root}/changes/v={version}")
    new = _feed(spark, root, schema, version).select("new.*").select(*schema.names)
    if not parts:
        dealt = _deal(new, key, max(1, math.ceil(new.count() / part_rows)), root, f"data/v={version}", 0)
        return _commit(spark, root, version, schema, dealt, batch_id)
    rows = current.join(new.select(*key), key, "left_anti").select(*schema.names).unionByName(new)
    folder = f"data/v={version}"
    # a task for each part, which holds its rows and no more than part_rows allow
    with releasing(spark):
        (rows.withColumn("part", part_of(key, parts)).repartition("part").sortWithinPartitions("part", *key)
         .write.mode("overwrite").partitionBy("part").parquet(f"{root}/{folder}"))
    counted = {r.part: r.rows for r in _counted(spark, f"{root}/{folder}", key, schema)}
    after, number = [], max(p["part"] for p in parts) + 1
    for p in parts:
        if p["part"] not in touched:
            after.append(p)
            continue
        n, own = counted.get(p["part"], 0), f"{folder}/part={p['part']}"
        if n > 2 * part_rows:
            split = _deal(spark.read.schema(schema).parquet(f"{root}/{own}"), key, math.ceil(n / part_rows), root, f"{folder}-of-{p['part']}", number)
            number += math.ceil(n / part_rows)
            after += [split[0] | {"low": p["low"]}, *split[1:]]
        else:
            after.append(p | {"folder": own, "rows": n})
    return _commit(spark, root, version, schema, after, batch_id)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what none of the newest ``keep`` committed versions refers to; the
    folders deleted."""
    done = [(v, folder) for v, _, folder, ok in _folders(spark, root) if ok]
    stay = done[-max(1, keep):]
    held = {p["folder"] for v, _ in stay for p in _list(spark, root, v)[2]}
    fs, _, jvm = _fs(spark, root)
    path = jvm.org.apache.hadoop.fs.Path
    gone = []
    for st in fs.globStatus(path(f"{root}/data/*/part=*")) or []:
        name = "/".join(st.getPath().toString().split("/")[-3:])
        if name not in held:
            gone.append(f"{root}/{name}")
    gone += [folder for v, folder in done if (v, folder) not in stay]
    for st in fs.globStatus(path(f"{root}/changes/v=*")) or []:
        v = st.getPath().getName()[2:].split("-")[0]
        if int(v) < stay[0][0]:
            gone.append(f"{root}/changes/{st.getPath().getName()}")
    for folder in gone:
        fs.delete(path(folder), True)
    return gone
