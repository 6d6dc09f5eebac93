"""Sorted views and top-k lists.

NULL order is always stated: the reference sorts ASC NULLS LAST and
DESC NULLS FIRST unless told otherwise, Spark the opposite.  Every limited
list gets a deterministic tie-break on its remaining output columns, so the
set of rows returned is a function of the data alone; the full sorts get it
too, so that a sort on few distinct values still has range boundaries inside a
value.  ``orderBy().limit(n)``
plans as TakeOrderedAndProject: each partition keeps its own top n and only
n x partitions rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.functions.scalar import fmt_minute, sev_rank
from chainlens.operators.correlate import failed, open_severe


def _tiebreak(df: DataFrame, used: list[str]) -> list[Column]:
    out = []
    for f in df.schema.fields:
        if f.name in used:
            continue
        if f.dataType.typeName() in ("array", "map", "struct"):
            out.append(F.to_json(F.col(f.name)).asc_nulls_last())
        else:
            out.append(F.col(f.name).asc_nulls_last())
    return out


def top_k(df: DataFrame, order: list[Column], n: int | None, used: list[str] = ()) -> DataFrame:
    ordered = df.orderBy(*order, *_tiebreak(df, list(used)))
    return ordered.limit(n) if n is not None else ordered


# -- sorted views --------------------------------------------------------------------
# The *_COLS lists and the ``cols`` of each list below are the output
# columns of SURVEY §2.14, in its order.

OPEN_FAILURE_COLS = ["account_id", "region", "service", "severity", "check_title", "resource_arn",
                     "description", "recommendation", "ingested_at"]


def open_failures(findings: DataFrame) -> DataFrame:
    """H-1 ``v_open_failures``: FAIL, 5 named levels ELSE 6, newest first."""
    f = failed(findings).select(*OPEN_FAILURE_COLS)
    return top_k(f, [sev_rank("severity", 5).asc(), F.col("ingested_at").desc_nulls_first()], None, ["ingested_at"])


OPEN_CVE_COLS = ["account_id", "region", "instance_id", "resource_arn", "severity", "cvss_score", "cve_id",
                 "package_name", "installed_version", "fixed_version", "title", "primary_url", "ingested_at"]


def open_cves(cves: DataFrame) -> DataFrame:
    """H-2 ``v_open_cves``: OPEN, 4 named levels ELSE 5, cvss DESC NULLS LAST."""
    c = cves.where(F.col("status") == "OPEN").select(*OPEN_CVE_COLS)
    c = c.withColumn("cvss_score", F.col("cvss_score").cast("double"))
    return top_k(c, [sev_rank("severity", 4).asc(), F.col("cvss_score").desc_nulls_last()], None, ["cvss_score"])


ADMIN_PATH_COLS = ["account_id", "source_name", "source_type", "target_name", "path", "hops", "methods",
                   "severity", "description"]


def admin_escalation_paths(iam_risks: DataFrame) -> DataFrame:
    """H-3 ``v_admin_escalation_paths``: admin targets, 3 levels ELSE 4, hops ASC."""
    r = iam_risks.where(F.col("target_is_admin") == F.lit(True)).select(*ADMIN_PATH_COLS)
    return top_k(r, [sev_rank("severity", 3).asc(), F.col("hops").asc_nulls_last()], None, ["hops"])


# -- dashboard lists -----------------------------------------------------------------

CHAIN_LIST_COLS = ["instance_id", "name_tag", "public_ip", "region", "misconfiguration", "misconfig_severity",
                   "cve_id", "cvss_score", "package_name", "fixed_version", "escalation_path", "escalates_to",
                   "target_is_admin", "risk_score"]


def top_attack_chains(chains: DataFrame, n: int = 20) -> DataFrame:
    """H-4: the 14 dashboard columns, risk_score DESC NULLS LAST, LIMIT n."""
    c = chains.select(*CHAIN_LIST_COLS)
    return top_k(c, [F.col("risk_score").desc_nulls_last()], n, ["risk_score"])


def critical_findings_top(findings: DataFrame, n: int = 50) -> DataFrame:
    """H-5: FAIL and CRITICAL/HIGH, CRITICAL first, newest first; time as '%Y-%m-%d %H:%M'."""
    cols = ["check_title", "severity", "resource_arn", "region", "service", "description", "recommendation",
            "ingested_at"]
    f = failed(findings).where(F.col("severity").isin("CRITICAL", "HIGH")).select(*cols)
    order = [F.when(F.col("severity") == "CRITICAL", 1).otherwise(2).asc(), F.col("ingested_at").desc_nulls_first()]
    top = top_k(f, order, n, ["severity", "ingested_at"])
    return top.withColumn("ingested_at", fmt_minute("ingested_at"))


def cves_top(cves: DataFrame, n: int = 50) -> DataFrame:
    """H-6: open severe CVEs by cvss DESC NULLS LAST."""
    cols = ["instance_id", "cve_id", "severity", "cvss_score", "package_name", "installed_version",
            "fixed_version", "title"]
    c = open_severe(cves).select(*cols).withColumn("cvss_score", F.col("cvss_score").cast("double"))
    return top_k(c, [F.col("cvss_score").desc_nulls_last()], n, ["cvss_score"])


def iam_risks_top(iam_risks: DataFrame, n: int = 30) -> DataFrame:
    """H-7: CASE severity CRITICAL 1, HIGH 2, ELSE 3; LIMIT n."""
    cols = ["source_name", "source_type", "target_name", "target_type", "target_is_admin", "hops", "severity", "path"]
    r = iam_risks.select(*cols)
    return top_k(r, [sev_rank("severity", 2).asc()], n, ["severity"])


def instances_top(instances_sg: DataFrame, n: int = 50) -> DataFrame:
    """H-8: E-7 rows ordered by public_ip NULLS LAST, LIMIT n."""
    return top_k(instances_sg, [F.col("public_ip").asc_nulls_last()], n, ["public_ip"])


RISK_SCORE_THRESHOLD = 12  # fixed value: alert threshold of the reference


# A chain's identity for de-duplicating alerts across runs.
CHAIN_ALERT_KEY = ["instance_id", "misconfiguration", "cve_id", "package_name", "escalation_path"]


def alert_chains(chains: DataFrame, threshold: float = RISK_SCORE_THRESHOLD, n: int = 10,
                 already_sent: DataFrame | None = None) -> DataFrame:
    """H-9 / D-07: chains above the threshold or reaching an admin, top n by risk.

    By default every qualifying chain is alerted on each run, as in the
    original (X-5).  ``already_sent`` (a log of earlier alerts with the
    ``CHAIN_ALERT_KEY`` columns) drops chains alerted before, via a null-safe
    anti-join, so only new chains are reported."""
    c = chains.where((F.col("risk_score") > threshold) | (F.col("target_is_admin") == F.lit(True)))
    if already_sent is not None:
        sent = already_sent.select(*[F.col(k).alias(f"_s_{k}") for k in CHAIN_ALERT_KEY]).distinct()
        cond = None
        for k in CHAIN_ALERT_KEY:
            e = c[k].eqNullSafe(sent[f"_s_{k}"])
            cond = e if cond is None else cond & e
        c = c.join(sent, cond, "left_anti")
    return top_attack_chains(c, n)


def alert_risks(risks: DataFrame, n: int = 10) -> DataFrame:
    """H-10: E-1 rows by cvss DESC NULLS LAST, LIMIT n."""
    cols = ["resource_arn", "exposure", "network_severity", "cve_id", "cvss_score", "package_name", "cve_title"]
    return top_k(risks.select(*cols), [F.col("cvss_score").desc_nulls_last()], n, ["cvss_score"])


# -- report context lists ------------------------------------------------------------

def report_critical_risks(risks: DataFrame, n: int = 20) -> DataFrame:
    """H-11: E-1 LIMIT n (the view's order restated: cvss DESC NULLS LAST)."""
    return top_k(risks, [F.col("cvss_score").desc_nulls_last()], n, ["cvss_score"])


def report_public_s3(s3_findings: DataFrame, n: int = 10) -> DataFrame:
    """H-12: E-5 projected, in the view's order (3 levels, ELSE 3), LIMIT n."""
    cols = ["bucket_name", "region", "public_access_blocked", "encryption_enabled", "check_title", "severity"]
    return top_k(s3_findings.select(*cols), [sev_rank("severity", 2, else_=3).asc()], n, ["severity"])


def report_risky_iam(iam_findings: DataFrame, n: int = 10) -> DataFrame:
    """H-13: E-4 projected, in the view's order, LIMIT n."""
    cols = ["user_name", "mfa_enabled", "has_access_keys", "password_last_used", "check_title", "severity"]
    return top_k(iam_findings.select(*cols), [sev_rank("severity", 2, else_=3).asc()], n, ["severity"])


def report_findings(findings: DataFrame, status: str = "NEW", n: int = 15) -> DataFrame:
    """H-14: status (default 'NEW', X-3) and CRITICAL/HIGH, ORDER BY severity, check_title (text order)."""
    cols = ["check_title", "severity", "resource_arn", "risk", "recommendation"]
    f = findings.where((F.col("status") == status) & F.col("severity").isin("CRITICAL", "HIGH")).select(*cols)
    return top_k(f, [F.col("severity").asc_nulls_last(), F.col("check_title").asc_nulls_last()], n,
                 ["severity", "check_title"])


def report_cves(cves: DataFrame) -> DataFrame:
    """H-15: open severe CVEs, cvss DESC with the reference's default NULLS FIRST."""
    cols = ["instance_id", "cve_id", "severity", "cvss_score", "package_name", "installed_version",
            "fixed_version", "title"]
    c = open_severe(cves).select(*cols).withColumn("cvss_score", F.col("cvss_score").cast("double"))
    return top_k(c, [F.col("cvss_score").desc_nulls_first()], None, ["cvss_score"])


def report_buckets(buckets: DataFrame) -> DataFrame:
    """H-16: bucket posture projection."""
    return buckets.select("bucket_name", "public_access_blocked", "versioning_enabled", "encryption_enabled")


def report_escalations(iam_risks: DataFrame) -> DataFrame:
    """H-17: H-3 in full."""
    return admin_escalation_paths(iam_risks)
