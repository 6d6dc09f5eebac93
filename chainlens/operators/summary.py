"""Aggregations.

All are hash aggregates with partial (map-side) combine, so a hot key is
pre-reduced in every task before the shuffle.  Multi-scalar summaries take their
scalars from the keyed aggregates that also give the factors of the chain
counts, so findings and CVEs are read once; one-row results are combined without
a cross join by a global aggregate over their union.

Counting attack chains never builds the chain rows: the chain count of an
instance is (#failed findings) x (#open severe CVEs) x max(1, #matching paths),
so the count is a sum of per-instance products over three small aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.functions.scalar import fmt_minute_utc, profile_role
from chainlens.operators.correlate import FAIL, failed, open_severe, role_risk_matches, running


def severity_summary(findings: DataFrame) -> DataFrame:
    """G-1 ``v_severity_summary``."""
    return findings.groupBy("account_id", "severity").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "FAIL").alias("failures")
    )


def cve_summary(cves: DataFrame) -> DataFrame:
    """G-2 ``v_cve_summary``."""
    return cves.groupBy("account_id", "instance_id", "severity").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "OPEN").alias("open_count")
    )


def severity_totals(findings: DataFrame) -> DataFrame:
    """G-3: per severity, all time."""
    return findings.groupBy("severity").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "FAIL").alias("failures")
    )


def open_cve_counts(cves: DataFrame) -> DataFrame:
    """G-4."""
    return cves.where(F.col("status") == "OPEN").groupBy("severity").agg(F.count(F.lit(1)).alias("total"))


def iam_risk_summary(iam_risks: DataFrame) -> DataFrame:
    """G-5."""
    return iam_risks.groupBy("severity").agg(
        F.count(F.lit(1)).alias("paths"), F.count_if(F.col("target_is_admin")).alias("to_admin")
    )


def severity_breakdown(findings: DataFrame) -> DataFrame:
    """G-10: failures per severity."""
    return failed(findings).groupBy("severity").agg(F.count(F.lit(1)).alias("total"))


def services_breakdown(findings: DataFrame, n: int = 10) -> DataFrame:
    """G-11: failures per non-empty service, top n (ties by service name)."""
    f = failed(findings).where(F.col("service").isNotNull() & (F.col("service") != ""))
    g = f.groupBy("service").agg(F.count(F.lit(1)).alias("failures"))
    return g.orderBy(F.col("failures").desc(), F.col("service").asc()).limit(n)


def last_scan(findings: DataFrame) -> DataFrame:
    """G-12: newest ingest stamp, formatted '%Y-%m-%d %H:%M UTC' (NULL when empty)."""
    return findings.agg(fmt_minute_utc(F.max("ingested_at")).alias("last_scan"))


# -- attack-chain counts without the fan-out -----------------------------------------

def chain_totals(instances, findings, cves, iam_risks) -> DataFrame:
    """One row: the scalars of findings, open severe CVEs and running instances,
    and the number of chains and of chains whose path reaches an admin.

    Findings and CVEs are read once: one aggregate by resource and one by
    instance carry the scalars and the factors of the chains.  A chain count is a
    product over an instance, so it is summed by resource as failures of the
    resource times the weight (CVEs times paths) of the instances that have it.
    Keys without a partner stay (full outer joins), for the scalars."""
    inst = running(instances).select("instance_id", "account_id", "resource_arn", "iam_instance_profile", F.col("public_ip").isNotNull().alias("public"))
    m = role_risk_matches(instances, iam_risks).groupBy("_acct", "_role").agg(
        F.count(F.lit(1)).alias("nm"), F.count_if(F.col("target_is_admin") == F.lit(True)).alias("nadm"))
    # paths of all rows of an instance id; rn marks one of them
    w = Window.partitionBy("instance_id")
    paths = inst.join(m, (inst["account_id"] == m["_acct"]) & (profile_role(inst["iam_instance_profile"]) == m["_role"]), "left").select(
        "instance_id", "resource_arn", "public",
        F.sum(F.greatest(F.coalesce("nm", F.lit(0)), F.lit(1))).over(w).alias("paths"), F.sum(F.coalesce("nadm", F.lit(0))).over(w).alias("admin"),
        F.row_number().over(w.orderBy("resource_arn")).alias("rn"))
    severe = open_severe(cves).groupBy("instance_id").agg(F.count(F.lit(1)).alias("nc"))
    weight = severe.join(paths, "instance_id", "full_outer").groupBy("resource_arn").agg(
        F.sum(F.col("nc") * F.col("paths")).alias("chains"), F.sum(F.col("nc") * F.col("admin")).alias("admin"),
        F.sum(F.when(F.coalesce("rn", F.lit(1)) == 1, F.col("nc"))).alias("nc"),
        F.count("rn").alias("running"), F.count_if("public").alias("public"))
    fail, sev = F.col("status") == FAIL, F.col("severity")
    by_resource = findings.groupBy("resource_arn").agg(
        F.count_if(fail).alias("nf"), F.count_if(fail & (sev == "CRITICAL")).alias("critical"), F.count_if(fail & (sev == "HIGH")).alias("high"),
        F.max("ingested_at").alias("last"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return by_resource.join(weight, "resource_arn", "full_outer").agg(
        total("nf").alias("failures"), total("critical").alias("critical_findings"), total("high").alias("high_findings"),
        fmt_minute_utc(F.max("last")).alias("last_scan"), total("nc").alias("critical_cves"),
        total("running").alias("running_instances"), total("public").alias("public_instances"),
        total(F.col("nf") * F.col("chains")).alias("chains"), total(F.col("nf") * F.col("admin")).alias("admin_chains"))


def _one_row(**parts: tuple[DataFrame, str]) -> DataFrame:
    """Combine one-row aggregates into one row without a cross join.

    ``parts`` maps output name -> (one-row DataFrame, column).  Each distinct
    aggregate DataFrame becomes ONE union branch carrying all its columns
    (NULL for the others), so every base table is scanned once; a global
    aggregate then takes the single non-NULL value of each column.
    """
    names = list(parts)
    types = {n: df.schema[c].dataType for n, (df, c) in parts.items()}
    groups: list[tuple[DataFrame, dict]] = []
    for n, (df, c) in parts.items():
        for g_df, cols in groups:
            if g_df is df:
                cols[n] = c
                break
        else:
            groups.append((df, {n: c}))
    rows = None
    for df, cols in groups:
        r = df.select(*[(F.col(cols[n]) if n in cols else F.lit(None)).cast(types[n]).alias(n) for n in names])
        rows = r if rows is None else rows.unionByName(r)
    return rows.agg(*[F.max(n).alias(n) for n in names])


def _admin_paths(iam_risks: DataFrame) -> DataFrame:
    return iam_risks.agg(F.count_if(F.col("target_is_admin") == F.lit(True)).alias("v"))


def admin_path_counts(iam_risks, instances, findings, cves) -> DataFrame:
    """G-6: admin paths; chains whose path reaches an admin."""
    c = chain_totals(instances, failed(findings), cves, iam_risks)
    return _one_row(admin_paths=(_admin_paths(iam_risks), "v"), admin_chains=(c, "admin_chains"))


def inventory_counts(instances, buckets, users, groups, vpcs) -> DataFrame:
    """G-7: one (label, rows) row per inventory table."""
    # The reference's table labels.
    labelled = [("EC2 Instances", instances), ("S3 Buckets", buckets), ("IAM Users", users),
                ("Security Groups", groups), ("VPCs", vpcs)]
    out = None
    for label, df in labelled:
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("label"), "rows")
        out = r if out is None else out.unionByName(r)
    return out


def posture_summary(findings, cves, iam_risks, instances, buckets) -> DataFrame:
    """G-8: the dashboard's 11 scalars."""
    t = chain_totals(instances, findings, cves, iam_risks)
    ba = buckets.agg(
        F.count(F.lit(1)).alias("s3_buckets"),
        F.count_if(F.col("public_access_blocked") == F.lit(False)).alias("public_buckets"),
    )
    return _one_row(
        failures=(t, "failures"), critical_findings=(t, "critical_findings"), high_findings=(t, "high_findings"),
        critical_cves=(t, "critical_cves"), admin_paths=(_admin_paths(iam_risks), "v"), attack_chains=(t, "chains"),
        running_instances=(t, "running_instances"), public_instances=(t, "public_instances"),
        s3_buckets=(ba, "s3_buckets"), public_buckets=(ba, "public_buckets"), last_scan=(t, "last_scan"),
    )


def report_counts(findings, cves, iam_risks, instances) -> DataFrame:
    """G-9: the report's 5 scalars."""
    t = chain_totals(instances, failed(findings), cves, iam_risks)
    return _one_row(failures=(t, "failures"), critical_cves=(t, "critical_cves"), admin_paths=(_admin_paths(iam_risks), "v"),
                    public_instances=(t, "public_instances"), full_attack_chains=(t, "chains"))


def step_summary(sync_log: DataFrame) -> DataFrame:
    """G-14: accounts, steps run, steps failed over a whole run."""
    return sync_log.agg(
        F.count_distinct("account_id").alias("accounts"),
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("status") == "error").alias("failed_steps"),
    )


def ingest_stats(checked: DataFrame, key=("account_id", "resource_arn", "check_id")) -> DataFrame:
    """G-13: loaded / parsed / skipped for one findings batch.

    ``checked`` is the output of ``normalize_findings_checked``.  As in the
    original, "parsed" counts rows left after the in-batch de-duplication, so
    "skipped" covers both unparseable rows and duplicates.
    """
    keys = [F.col(k) for k in key]
    agg = checked.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_distinct(*[F.when(F.col("_parsed"), k) for k in keys]).alias("parsed"),
    )
    return agg.select("loaded", "parsed", (F.col("loaded") - F.col("parsed")).alias("skipped"))
