"""One incremental ingest for all scanners.

A landing folder holds what the scanners leave, under one folder a kind::

    findings/...json                                 concatenated arrays and objects (A-1)
    cves/account_id=A/region=R/<instance>.json       one report a file (A-4)
    iam/account_id=A/region=R/...json                path lists (A-7)
    inventory/...json                                {table: [rows]} bundles (A-5)

One file stream reads all of it, so one micro-batch holds a night's files of every
kind and its id stands for all tables.  Each batch is split, normalised and
committed as one record of a table set (``sources.table_set``): readers never see one
table's new night with another's old one, a batch that is run again under its id
changes nothing twice, and its sync-log rows are part of the record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens import schemas as SCH
from chainlens.operators.normalize import instance_id_from_file, normalize_cves, normalize_findings, normalize_iam_paths
from chainlens.sources import table_set
from chainlens.sources.files import _documents_of, unreadable

KINDS = ("findings", "cves", "iam", "inventory")
#: Column types of a bundle's rows; the others are text, and nested values stay JSON text.
_BOOLEAN = {"public_access_blocked", "versioning_enabled", "logging_enabled", "encryption_enabled", "mfa_enabled", "has_console_access",
            "has_access_keys", "allows_all_ingress", "allows_ssh_public", "allows_rdp_public", "is_default"}
_TIME = {"launch_time", "creation_date", "password_last_used", "access_key_last_used", "create_date"}
#: Bundle name of a table -> stored table and its columns.
BUNDLES = {"instances": ("instances", SCH.INSTANCES), "s3": ("buckets", SCH.BUCKETS), "iam": ("iam_users", SCH.IAM_USERS),
           "security_groups": ("security_groups", SCH.SECURITY_GROUPS), "vpcs": ("vpcs", SCH.VPCS)}


def _from_path(name: str) -> Column:
    found = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return F.when(found != "", found)


def _kind() -> Column:
    return F.regexp_extract("path", f"/({'|'.join(KINDS)})/", 1)


def _bundle_rows(files: DataFrame, name: str) -> DataFrame:
    columns = [c for c in BUNDLES[name][1] if c not in ("synced_at", "raw_json")]
    kind = {c: "boolean" if c in _BOOLEAN else "timestamp" if c in _TIME else "string" for c in columns}
    rows = F.from_json(F.get_json_object("value", f"$.{name}"), "array<struct<" + ", ".join(f"{c}: {kind[c]}" for c in columns) + ">>")
    # with each row its text, which also tells later from earlier rows of a key
    texts = F.from_json(F.get_json_object("value", f"$.{name}"), "array<string>")
    x = files.select("path", F.posexplode(F.arrays_zip(rows.alias("row"), texts.alias("raw_json"))).alias("pos", "x"))
    return x.select("x.row.*", "x.raw_json", F.struct("path", "pos").alias("_seq"))


def tables_of(files: DataFrame, batch_id: int) -> dict[str, Callable[[], DataFrame]]:
    """Stored table -> a function that gives a batch's normalised rows for it, of the
    kinds that the batch has files of.  ``files`` has path and value."""
    held = [F.bool_or(F.get_json_object("value", f"$.{name}[0]").isNotNull()).alias(name) for name in BUNDLES]
    kinds = {r.kind: r for r in files.groupBy(_kind().alias("kind")).agg(*held).collect()}
    of = lambda kind: files.where(_kind() == kind)

    def readable(kind: str) -> DataFrame:
        stop = F.raise_error(F.concat(F.lit("not a JSON document: "), F.col("path")))
        return of(kind).withColumn("value", F.when(unreadable(), stop).otherwise(F.col("value")))

    def findings():
        docs = of("findings").select(F.lit(0).alias("arg"), "path", "value").mapInPandas(_documents_of, "arg int, path string, pos long, raw string")
        return normalize_findings(docs.select(F.struct(F.lit(batch_id).alias("batch"), "path", "pos").alias("_seq"), "raw"))

    def cves():
        return normalize_cves(readable("cves").select(
            instance_id_from_file(F.col("path")).alias("instance_id"), _from_path("account_id").alias("account_id"),
            _from_path("region").alias("region"), F.col("value").alias("doc")))

    def iam():
        items = F.coalesce(F.from_json("value", "struct<findings: array<string>>").getField("findings"), F.from_json("value", "array<string>"))
        x = readable("iam").select("path", _from_path("account_id").alias("_acct"), _from_path("region").alias("_region"),
                                   F.posexplode(items).alias("pos", "item"))
        return normalize_iam_paths(x.withColumnRenamed("path", "file"), account_col="_acct", region_col="_region").drop("file", "pos")

    out: dict[str, Callable[[], DataFrame]] = {}
    for kind, table, give in (("findings", "findings", findings), ("cves", "cves", cves), ("iam", "iam_risks", iam)):
        if kind in kinds:
            out[table] = give
    if "inventory" in kinds:
        bundled = [n for n in BUNDLES if kinds["inventory"][n]]  # tables that are absent or empty are passed over
        for name in bundled or list(BUNDLES)[:1]:  # an unreadable bundle fails as the first table's step
            out[BUNDLES[name][0]] = lambda name=name: _bundle_rows(readable("inventory"), name)
    return out


def apply_batch(files: DataFrame, batch_id: int, root: str, as_of=None, on_error: str = "log") -> int:
    """foreachBatch body: one record for the batch; its version."""
    return table_set.commit(files.sparkSession, root, batch_id, tables_of(files, batch_id), SCH.SPECS, as_of=as_of, on_error=on_error)


def start_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str, as_of=None, max_files_per_trigger: int | None = None):
    """Ingest what has landed and stop (the nightly run); the StreamingQuery."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing).select(F.col("_metadata.file_path").alias("path"), "value")
    return (files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, root, as_of)).start())
