"""Composed jobs: one scan run over many accounts.

The original runs one child process per account and scanner; here the
account is a column and every step is one Spark job over all accounts.  A
failed step is logged and the run goes on, as in the original.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens import schemas as SCH
from chainlens.operators.normalize import PROJECTIONS, serialize_nested
from chainlens.operators.upsert import upsert
from chainlens.session import scratch_path
from chainlens.sources import store

# inventory table -> (stored table name, upsert spec)
INVENTORY_TARGETS = {
    "instances": ("instances", SCH.INSTANCES_SPEC),
    "s3": ("buckets", SCH.BUCKETS_SPEC),
    "iam": ("iam_users", SCH.IAM_USERS_SPEC),
    "security_groups": ("security_groups", SCH.SECURITY_GROUPS_SPEC),
    "vpcs": ("vpcs", SCH.VPCS_SPEC),
}


def sync_counts(table: str, rows: DataFrame, status: str = "success", error: str | None = None,
                duration_ms: int = 0) -> DataFrame:
    """B-9 rows for one synced table: one log row per account with its row count
    (a partial aggregate; nothing is collected)."""
    return rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows_synced")).select(
        F.current_timestamp().alias("synced_at"), "account_id", F.lit(table).alias("table_name"), "rows_synced",
        F.lit(duration_ms).cast("long").alias("duration_ms"), F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error_msg"))


def sync_inventory(spark: SparkSession, raw: dict[str, DataFrame], root: str,
                   tables: list[str] | None = None, projected: bool = False, as_of=None,
                   log_root: str | None = None, accounts: Sequence[str] | None = None) -> DataFrame:
    """A-6 / C-12 … C-16 / B-3 … B-7: project each raw inventory table (or take
    already projected rows, the bundle form of A-5), upsert it into its stored
    table under ``root`` and return the sync log rows of this run, which are also
    appended to the log at ``log_root``.  Of a key that a sync holds twice the
    greatest row wins, whatever the order of rows.

    A batch is written to the scratch folder before it is used, so a live source
    is read once and the table and its log row hold the same rows.

    ``tables`` is the per-table subset (default: all given).  ``accounts`` are the
    accounts of the run: a failed table is logged for each of them (without
    them, in one row of no account)."""
    logs = []
    for name in tables or list(raw):
        if name not in raw:
            continue
        target, spec = INVENTORY_TARGETS[name]
        t0 = time.time()
        path = f"{root.rstrip('/')}/{target}"
        try:
            rows = _landed(serialize_nested(raw[name] if projected else PROJECTIONS[name](raw[name])), target)
            current = store.read_latest(spark, path, empty_like=rows.withColumn(spec.stamp, F.current_timestamp()))
            new = upsert(current, rows, spec, as_of=as_of, strategy="merge")
            store.commit(new, path, sort_by=list(spec.key))
            logs.append(sync_counts(target, rows, duration_ms=int((time.time() - t0) * 1000)))
        except Exception as exc:  # a failed step is logged, the run goes on
            logs.append(spark.createDataFrame(
                [(a, target, 0, int((time.time() - t0) * 1000), "error", str(exc)) for a in accounts or [None]],
                "account_id string, table_name string, rows_synced long, duration_ms long, status string, "
                "error_msg string").select(F.current_timestamp().alias("synced_at"), "*"))
    out = logs[0]
    for df in logs[1:]:
        out = out.unionByName(df)
    if log_root:
        store.append_sync_log(out, log_root)
        return spark.read.parquet(log_root)
    return out


def _landed(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, f"sync-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def run_steps(steps: dict[str, Callable[[], DataFrame]]) -> tuple[dict, dict[str, str]]:
    """Run named steps in order; return results and the error texts of failed steps."""
    results, failed = {}, {}
    for name, fn in steps.items():
        try:
            results[name] = fn()
        except Exception as exc:  # noqa: BLE001 - a failed step is reported, the run goes on
            failed[name] = str(exc)
    return results, failed
