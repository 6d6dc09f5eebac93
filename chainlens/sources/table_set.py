"""Several stored tables that move together: one commit record for a batch.

A set is a folder with one table of parts (``sources.parts``) for each name and
``sets/version=N-batch=B``, the record of batch B: for each table its version
and the sync-log row (B-9) of its step.  The record is written last, in one
step with its _SUCCESS marker, and readers go by the newest record: they never see
one table of a night with another of the night before.  A batch that died between
two tables is run again under its id: tables that have it are left as they are,
and the log rows appear once, with the record.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.operators.changes import CHAIN_COLUMNS, chain_changes, signed
from chainlens.schemas import UpsertSpec
from chainlens.sources import parts
from chainlens.sources.store import SYNC_LOG_SCHEMA, _folders

RECORD = "version long, " + SYNC_LOG_SCHEMA


def records(spark: SparkSession, root: str) -> list[tuple[int, int, str]]:
    """(version, batch id, folder) of the committed records, oldest first."""
    return [(v, b, folder) for v, b, folder, ok in _folders(spark, f"{root}/sets") if ok]


def versions(spark: SparkSession, root: str, version: int | None = None) -> dict[str, int]:
    """Table name -> its version in a record (the newest by default); empty before the first."""
    found = [f for v, _, f in records(spark, root) if version in (None, v)]
    return {r.table_name: r.version for r in spark.read.schema(RECORD).parquet(found[-1]).collect()} if found else {}


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    return parts.read(spark, f"{root}/{table}", versions(spark, root, version)[table])


def sync_log(spark: SparkSession, root: str) -> DataFrame:
    """B-9: the log of all batches, one row for each table that a batch had rows for."""
    found = [f for _, _, f in records(spark, root)]
    rows = spark.read.schema(RECORD).parquet(*found) if found else spark.createDataFrame([], RECORD)
    return rows.where(F.col("status").isNotNull()).drop("version")


def commit(spark: SparkSession, root: str, batch_id: int, batches: dict[str, Callable[[], DataFrame]], specs: dict[str, UpsertSpec],
           as_of=None, on_error: str = "log", part_rows: int = parts.PART_ROWS, order: dict[str, str | list[str]] | None = None) -> int:
    """Apply one batch to its tables (name -> a function that gives its rows, so that
    a step that fails is one table's) and write the record; the record's version.

    A step that fails keeps its table as it was and is logged, as in a nightly run
    over all scanners; ``on_error="raise"`` lets it end the batch without a record.
    The first batch of a table creates it.  ``order`` names what decides between rows
    of a key (``upsert.upsert``'s seq) where it is not the batch's ``_seq``."""
    for v, b, _ in records(spark, root):
        if b == batch_id:
            return v
    now = versions(spark, root)
    rows = {name: (v, None, None, None, None, None) for name, v in now.items()}
    for name, give in batches.items():
        t0, path = time.time(), f"{root}/{name}"
        try:
            batch = give()
            empty = batch.drop("_seq")
            if specs[name].stamp not in empty.columns:
                empty = empty.withColumn(specs[name].stamp, F.lit(None).cast("timestamp"))
            version = parts.upsert(spark, path, batch, specs[name], as_of, (order or {}).get(name, "_seq"), batch_id=batch_id, part_rows=part_rows,
                                   new_schema=empty.schema)
            n = parts.changes(spark, path, version).count()
            rows[name] = (version, n, int((time.time() - t0) * 1000), "success", None, None)
        except Exception as exc:
            if on_error == "raise":
                raise
            rows[name] = (now.get(name), 0, int((time.time() - t0) * 1000), "error", str(exc)[:2000], None)
    out = [(v, None, None, name, n, ms, status, error) for name, (v, n, ms, status, error, _) in sorted(rows.items())]
    last = records(spark, root)
    every = _folders(spark, f"{root}/sets")
    number = every[-1][0] + 1 if every else 0
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    df = spark.createDataFrame(out, RECORD).withColumn("synced_at", F.when(F.col("status").isNotNull(), stamp))
    df.coalesce(1).write.parquet(f"{root}/sets/version={number}-batch={batch_id}")
    return number if not last or number > last[-1][0] else last[-1][0]


def chains_of_batch(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The attack chains that the record's batch added and withdrew (``chain_changes``),
    from the change feeds of its tables and the tables before and after it."""
    all_ = records(spark, root)
    v = all_[-1][0] if version is None else version
    earlier = [x for x, _, _ in all_ if x < v]
    after = versions(spark, root, v)
    before = versions(spark, root, earlier[-1]) if earlier else {}
    path = lambda t: f"{root}/{t}"
    new = {t: parts.read(spark, path(t), after[t]) for t in CHAIN_COLUMNS}
    old = {t: parts.read(spark, path(t), before[t]) if before.get(t) is not None else new[t].limit(0) for t in CHAIN_COLUMNS}
    moved = [t for t in CHAIN_COLUMNS if before.get(t) != after[t]]
    return chain_changes(old, new, {t: signed(parts.changes(spark, path(t), after[t]), CHAIN_COLUMNS[t]) for t in moved})
