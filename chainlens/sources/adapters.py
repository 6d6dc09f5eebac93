"""Security tables derived from the driver's TPC-H-style parquet tables.

The driver data is not security data; each security table is a deterministic
projection of it (FIXTURES.md §2.1).  ``chainlens.oracle.ADAPTER_CTES`` states
the same projections in SQL so an independent engine can check every query.

Only columns that a query reads are pruned through to the parquet scan; the
projections are plain expressions, so Catalyst folds them into the scans.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Rows of a driver table that one task widens to inventory rows, about.
TASK_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """The same rows in tasks of about TASK_ROWS.  A driver table is narrow and
    packed, so one of its splits holds far more rows than a task can hold widened."""
    tasks = -(-df.count() // TASK_ROWS)
    return df.repartition(tasks, *df.columns) if tasks > 1 else df


def _s(c: str):
    return F.col(c).cast("string")


def _cat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _instance_cols():
    key, nat = _s("c_custkey"), _s("c_nationkey")
    return dict(
        instance_id=_cat("i-", key),
        account_id=_cat("acct-", nat),
        region=_cat("NATION_", nat),
        resource_arn=_cat("arn:aws:ec2:", nat, ":instance/i-", key),
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key, nat = _s("c_custkey"), _s("c_nationkey")
    cols = _instance_cols()
    return c.select(
        cols["instance_id"].alias("instance_id"),
        cols["account_id"].alias("account_id"),
        cols["region"].alias("region"),
        cols["resource_arn"].alias("resource_arn"),
        F.when(F.col("c_mktsegment") == "BUILDING", "stopped").otherwise("running").alias("instance_state"),
        _cat("t3.", (F.col("c_custkey") % 4).cast("string")).alias("instance_type"),
        _cat("vpc-", (F.col("c_custkey") % 50).cast("string")).alias("vpc_id"),
        F.when(F.col("c_acctbal") > 5000, _cat("10.0.0.", key)).alias("public_ip"),
        F.when(
            F.col("c_custkey") % 5 != 0,
            _cat("arn:aws:iam::", nat, ":instance-profile/Role-", (F.col("c_custkey") % 20).cast("string"), "-x"),
        ).alias("iam_instance_profile"),
        F.col("c_name").alias("name_tag"),
        F.create_map(F.lit("Name"), F.col("c_name")).alias("tags"),
    )


_SEVERITY_BY_PRIORITY = (
    ("1-URGENT", "CRITICAL"),
    ("2-HIGH", "HIGH"),
    ("3-MEDIUM", "MEDIUM"),
    ("4-NOT SPECIFIED", "LOW"),
)


def findings(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    if dealt:  # by ranges of account and resource, before the rows are widened
        j = j.repartitionByRange("c_nationkey", F.col("o_orderkey") % 3, "c_custkey", "o_orderkey")
    ok, key, nat = F.col("o_orderkey"), _s("c_custkey"), _s("c_nationkey")
    arn = (
        F.when(ok % 3 == 0, _cat("arn:aws:ec2:", nat, ":instance/i-", key))
        .when(ok % 3 == 1, _cat("arn:aws:s3:::bucket-", key))
        .otherwise(_cat("arn:aws:iam::", nat, ":user/user-", key))
    )
    sev = None
    for prio, name in _SEVERITY_BY_PRIORITY:
        cond = F.col("o_orderpriority") == prio
        sev = F.when(cond, name) if sev is None else sev.when(cond, name)
    sev = sev.otherwise("INFORMATIONAL")
    check = (ok % 40).cast("string")
    return j.select(
        ok.alias("finding_id"),
        _cat("acct-", nat).alias("account_id"),
        _cat("NATION_", nat).alias("region"),
        arn.alias("resource_arn"),
        _cat("check_", check).alias("check_id"),
        _cat("Check ", check).alias("check_title"),
        F.when(ok % 17 == 0, F.lit(None).cast("string"))
        .when(ok % 19 == 0, F.lit(""))
        .otherwise(_cat("svc-", (ok % 13).cast("string")))
        .alias("service"),
        sev.alias("severity"),
        F.when(F.col("o_orderstatus") == "F", "FAIL")
        .when(F.col("o_orderstatus") == "O", "PASS")
        .otherwise("MANUAL")
        .alias("status"),
        _cat("Finding ", ok.cast("string")).alias("description"),
        _cat("Risk ", (ok % 7).cast("string")).alias("risk"),
        F.when(ok % 11 == 0, F.lit("")).otherwise(_cat("Remediate check ", check)).alias("recommendation"),
        F.col("o_orderdate").alias("ingested_at"),
    )


def cves(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                                "l_linestatus", "l_shipdate")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # the orders meet their customers first, so the line items are exchanged once for both
    j = li.join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), li.l_orderkey == o.o_orderkey)
    if dealt:  # by ranges of account and instance, before the rows are widened
        j = j.drop("l_orderkey", "o_orderkey", "o_custkey").repartitionByRange("c_nationkey", "c_custkey", "l_partkey")
    q = F.col("l_quantity")
    cols = _instance_cols()
    ln = F.col("l_linenumber")
    return j.select(
        cols["resource_arn"].alias("resource_arn"),
        cols["instance_id"].alias("instance_id"),
        cols["account_id"].alias("account_id"),
        cols["region"].alias("region"),
        _cat("CVE-", _s("l_partkey")).alias("cve_id"),
        F.when(q <= 5, "CRITICAL").when(q <= 15, "HIGH").when(q <= 35, "MEDIUM").otherwise("LOW").alias("severity"),
        F.when(
            F.col("l_tax") >= 0.005, F.round(F.abs(F.col("l_discount")) * 100, 0).cast("decimal(4,1)")
        ).alias("cvss_score"),
        _cat("pkg-", _s("l_suppkey")).alias("package_name"),
        _cat("1.", ln.cast("string")).alias("installed_version"),
        F.when(ln % 3 == 0, F.lit("")).otherwise(_cat("1.", (ln + 1).cast("string"))).alias("fixed_version"),
        _cat("Vulnerability in pkg-", _s("l_suppkey")).alias("title"),
        _cat("https://nvd.example.org/CVE-", _s("l_partkey")).alias("primary_url"),
        F.when(F.col("l_linestatus") == "O", "OPEN").otherwise("FIXED").alias("status"),
        F.col("l_shipdate").alias("ingested_at"),
    )


def iam_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    nat, key = _s("s_nationkey"), _s("s_suppkey")
    role = _cat("Role-", (F.col("s_suppkey") % 20).cast("string"), "-x")
    src = _cat("arn:aws:iam::", nat, ":role/", role)
    tgt = _cat("arn:aws:iam::", nat, ":role/Target-", key)
    hops = (F.col("s_suppkey") % 4 + 1).cast("int")
    admin = F.col("s_acctbal") > 5000
    return s.select(
        _cat("acct-", nat).alias("account_id"),
        _cat("NATION_", nat).alias("region"),
        src.alias("source_arn"),
        F.lit("role").alias("source_type"),
        role.alias("source_name"),
        tgt.alias("target_arn"),
        F.lit("role").alias("target_type"),
        _cat("Target-", key).alias("target_name"),
        admin.alias("target_is_admin"),
        _cat(src, " -> ", tgt).alias("path"),
        hops.alias("hops"),
        F.when(hops > 1, F.array(F.lit("sts:AssumeRole"), F.lit("iam:PassRole")))
        .otherwise(F.array(F.lit("sts:AssumeRole")))
        .alias("methods"),
        F.when(admin & (hops <= 2), "CRITICAL").when(admin, "HIGH").otherwise("MEDIUM").alias("severity"),
        _cat("Path to Target-", key).alias("description"),
    )


def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    key, size = _s("p_partkey"), F.col("p_size")
    acct = (F.col("p_partkey") % 25).cast("string")
    return p.select(
        _cat("bucket-", key).alias("bucket_name"),
        _cat("acct-", acct).alias("account_id"),
        _cat("NATION_", acct).alias("region"),
        _cat("arn:aws:s3:::bucket-", key).alias("resource_arn"),
        F.when(size % 7 != 0, size % 2 == 0).alias("public_access_blocked"),
        (size % 5 == 0).alias("versioning_enabled"),
        (F.col("p_partkey") % 2 == 0).alias("logging_enabled"),
        (size % 3 == 0).alias("encryption_enabled"),
    )


def iam_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key, nat = _s("c_custkey"), _s("c_nationkey")
    return c.select(
        _cat("user-", key).alias("user_name"),
        _cat("acct-", nat).alias("account_id"),
        _cat("AIDA", key).alias("user_id"),
        _cat("arn:aws:iam::", nat, ":user/user-", key).alias("resource_arn"),
        (F.col("c_acctbal") > 0).alias("mfa_enabled"),
        (F.col("c_custkey") % 3 == 0).alias("has_console_access"),
        (F.col("c_custkey") % 2 == 0).alias("has_access_keys"),
        F.lit(None).cast("timestamp_ntz").alias("password_last_used"),
    )


def sg_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingress rule (one port range, one CIDR) per part row."""
    p = read(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    null_port = k % 11 == 0
    return p.select(
        _cat("sg-", (k % 20).cast("string")).alias("group_id"),
        F.when(~null_port, ((size - 1) * 100).cast("int")).alias("from_port"),
        F.when(~null_port, ((size - 1) * 100 + 50 + (k % 7) * 100).cast("int")).alias("to_port"),
        F.when(k % 3 == 0, "0.0.0.0/0").otherwise("10.0.0.0/8").alias("cidr"),
    )


def sg_flags(rules: DataFrame) -> DataFrame:
    """Per-group ingress flags from flat rules: a partial (map-side) aggregate.

    Equal to the nested EXISTS of C-15 over the group's rule array, without
    ever collecting a group's rules into one row.
    """
    open_ = F.col("cidr") == "0.0.0.0/0"

    def port(p):
        return F.coalesce(open_ & (F.col("from_port") <= p) & (F.col("to_port") >= p), F.lit(False))

    return rules.groupBy("group_id").agg(
        F.bool_or(open_).alias("allows_all_ingress"),
        F.bool_or(port(22)).alias("allows_ssh_public"),
        F.bool_or(port(3389)).alias("allows_rdp_public"),
    )


def security_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    nat, key = _s("s_nationkey"), _s("s_suppkey")
    groups = s.select(
        _cat("sg-", key).alias("group_id"),
        _cat("group-", key).alias("group_name"),
        _cat("acct-", nat).alias("account_id"),
        _cat("NATION_", nat).alias("region"),
        _cat("vpc-", (F.col("s_suppkey") % 50).cast("string")).alias("vpc_id"),
    )
    flags = sg_flags(sg_rules(spark, sf_dir))
    j = groups.join(flags, "group_id", "left")
    return j.select(
        "group_id", "group_name", "account_id", "region", "vpc_id",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("allows_all_ingress", "allows_ssh_public", "allows_rdp_public")],
    )


def vpcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    key = _s("n_nationkey")
    return n.select(
        _cat("vpc-", key).alias("vpc_id"),
        _cat("acct-", key).alias("account_id"),
        _cat("NATION_", key).alias("region"),
        _cat("10.", key, ".0.0/16").alias("cidr_block"),
        (F.col("n_nationkey") == 0).alias("is_default"),
        F.lit("available").alias("state"),
    )


def online_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instance ids the agent service reports online (E-10 input): customers
    with a non-negative balance."""
    c = read(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") >= 0).select(_cat("i-", _s("c_custkey")).alias("instance_id"))


TABLES = {
    "instances": instances,
    "findings": findings,
    "cves": cves,
    "iam_risks": iam_risks,
    "buckets": buckets,
    "iam_users": iam_users,
    "security_groups": security_groups,
    "sg_rules": sg_rules,
    "vpcs": vpcs,
    "online_agents": online_agents,
}


# Stored layout of each derived table: (partition columns, sort columns within files).
# Partitioning by account gives directory pruning for per-account reads; sorting by
# the join / lookup key gives parquet min-max skipping for key lookups.
LAYOUT = {
    "instances": (["account_id"], ["instance_id"]),
    "findings": (["account_id"], ["resource_arn", "check_id"]),
    "cves": (["account_id"], ["instance_id", "cve_id"]),
    "iam_risks": (["account_id"], ["source_arn"]),
    "buckets": (["account_id"], ["resource_arn"]),
    "iam_users": (["account_id"], ["resource_arn"]),
    "security_groups": (["account_id"], ["vpc_id"]),
}

#: Large tables that are exchanged as driver rows, which are a fraction of the widened ones.
DEALT = (findings, cves)

_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table ``name`` as a stored parquet table.

    Production tables are stored (the upsert's versioned layout), not
    recomputed from relational sources on every query; the first use in a
    Spark application derives the table and writes it under the checkpoint
    folder, later queries scan it with filter pushdown, column pruning and
    partition pruning.  Small tables without an account column are derived
    on the fly."""
    if name not in LAYOUT:
        return TABLES[name](spark, sf_dir)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    path = _STORED.get(key)
    df = TABLES[name](spark, sf_dir)
    if path is None:
        from chainlens.session import releasing, scratch_path

        part, order = LAYOUT[name]
        path = scratch_path(spark, f"table-{name}")
        # by ranges of (account, key): a large account is written and read by many tasks
        make = TABLES[name]
        rows = make(spark, sf_dir, dealt=True) if make in DEALT else df.repartitionByRange(*part, *order)
        with releasing(spark):
            rows.sortWithinPartitions(*part, *order).write.partitionBy(*part).parquet(path)
        _STORED[key] = path
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [stored(spark, sf_dir, n) for n in names]
