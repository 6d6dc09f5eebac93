"""Correlation joins.

All joins are equi-joins the optimizer can plan as broadcast-hash (when AQE
measures a side under the broadcast threshold at run time) or sort-merge with
AQE skew splitting.  No operator forces a broadcast of a table that grows with
the data.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlens.functions.scalar import PUBLIC_IP_POINTS, profile_role, risk_score, severity_points, substring_match
from chainlens.operators.role_match import match_roles, running_roles

FAIL = "FAIL"
OPEN = "OPEN"
SEVERE = ("CRITICAL", "HIGH")

HOT_INSTANCE_CVES = 1_000_000   # open severe CVE rows above which an instance's fan-out is split
HOT_KEY_ROWS = 1_000_000        # rows per key above which other many-to-many joins are split
HOT_SALT_BUCKETS = 64
FAN_OUT_ROWS = 10_000           # rows of a VPC above which they are spread before they meet its security groups
ROW_BYTES = 16                  # a stored row of the joined tables takes more than that (ids, titles, versions)


def failed(findings: DataFrame) -> DataFrame:
    """D-01."""
    return findings.where(F.col("status") == FAIL)


def open_severe(cves: DataFrame) -> DataFrame:
    """D-02."""
    return cves.where((F.col("status") == OPEN) & F.col("severity").isin(*SEVERE))


def running(instances: DataFrame) -> DataFrame:
    """D-12 strengthened to the views' filter: state = 'running' (NULL drops)."""
    return instances.where(F.col("instance_state") == "running")


def public_running(instances: DataFrame) -> DataFrame:
    """D-03."""
    return running(instances).where(F.col("public_ip").isNotNull())


def critical_risks(findings: DataFrame, cves: DataFrame, hot_threshold: int | None = HOT_KEY_ROWS) -> DataFrame:
    """E-1 ``v_critical_risks``: failed findings x open severe CVEs on the resource
    (many-to-many; a resource with over ``hot_threshold`` CVEs is split)."""
    f = failed(findings).select(
        "account_id", "region", "resource_arn",
        F.col("check_title").alias("exposure"), F.col("severity").alias("network_severity"),
    )
    c = open_severe(cves).select(
        "resource_arn", "cve_id", F.col("cvss_score").cast("double").alias("cvss_score"),
        "package_name", "installed_version", "fixed_version", F.col("title").alias("cve_title"), "primary_url",
    )
    return split_hot_join(f, c, "resource_arn", hot_threshold).select(
        "account_id", "region", "resource_arn", "exposure", "network_severity", "cve_id", "cvss_score",
        "package_name", "installed_version", "fixed_version", "cve_title", "primary_url",
    )


def public_instances_with_findings(instances: DataFrame, findings: DataFrame) -> DataFrame:
    """E-2: running public instances x their failed findings."""
    i = public_running(instances).select(
        "instance_id", "name_tag", "instance_type", "public_ip", "iam_instance_profile", "region", "resource_arn"
    )
    f = failed(findings).select(
        "resource_arn", F.col("check_title").alias("finding"), F.col("severity").alias("finding_severity"),
        "recommendation",
    )
    return i.join(f, "resource_arn").drop("resource_arn")


def exposed_vulnerable_instances(instances: DataFrame, cves: DataFrame) -> DataFrame:
    """E-3: running public instances x open severe CVEs on instance_id."""
    i = public_running(instances).select("instance_id", "name_tag", "public_ip", "iam_instance_profile", "region")
    c = open_severe(cves).select(
        "instance_id", "cve_id", F.col("cvss_score").cast("double").alias("cvss_score"), "package_name",
        "fixed_version", F.col("title").alias("cve_title"),
    )
    return i.join(c, "instance_id")


def risky_iam_users(users: DataFrame, findings: DataFrame) -> DataFrame:
    """E-4: users x failed findings (faithfully no MFA predicate, X-6)."""
    u = users.select("resource_arn", "user_name", "mfa_enabled", "has_access_keys", "password_last_used")
    f = failed(findings).select("resource_arn", "check_title", "severity", "description")
    return u.join(f, "resource_arn").drop("resource_arn")


def public_s3_findings(buckets: DataFrame, findings: DataFrame) -> DataFrame:
    """E-5: buckets with public_access_blocked = FALSE (NULL excluded) x failed findings."""
    b = buckets.where(F.col("public_access_blocked") == F.lit(False)).select(
        "resource_arn", "bucket_name", "region", "public_access_blocked", "encryption_enabled"
    )
    f = failed(findings).select("resource_arn", "check_title", "severity", "recommendation")
    return b.join(f, "resource_arn").drop("resource_arn")


PLAIN_PAIRS = 500_000_000        # pairs of an instance and a path that may be compared one by one: seconds of one core's time
PATH_COLS = ["path", "hops", "target_name", "target_is_admin"]


def role_risk_matches(instances: DataFrame, iam_risks: DataFrame, strategy: str = "auto") -> DataFrame:
    """R-5: match each *distinct* (account, role) of running instances to the
    escalation paths whose source_arn contains the role (LIKE '%role%').

    The condition is evaluated on distinct roles and distinct source ARNs, not
    once per instance or per chain row; instances then pick their matches up
    through a plain equi-join on (account_id, role).

    ``strategy``:
      "trigram"    roles meet ARNs under their rarest trigram (``role_match``), so
                   an account with many roles and paths is no product; paths
                   follow their ARN through an equi-join;
      "plain"      an equi-join on the account with the match as its condition:
                   every role of an account meets every path of it;
      "auto"       plain where the files of both tables are too small for more
                   than ``PLAIN_PAIRS`` pairs, whatever the accounts; else trigram.
    """
    if strategy == "auto":
        pairs = (stored_bytes(instances) // ROW_BYTES) * (stored_bytes(iam_risks) // ROW_BYTES)
        strategy = "plain" if pairs <= PLAIN_PAIRS else "trigram"
    roles = running_roles(running(instances))
    r = iam_risks.select("account_id", "source_arn", *PATH_COLS, F.col("severity").alias("iam_severity"))
    if strategy == "plain":
        cond = (r["account_id"] == roles["_acct"]) & substring_match(r["source_arn"], roles["_role"])
        return r.join(roles, cond, "inner").drop("account_id", "source_arn")
    if strategy != "trigram":
        raise ValueError(f"unknown strategy {strategy!r}")
    r = r.withColumnsRenamed({"account_id": "_acct", "source_arn": "_arn"})
    return r.join(role_arn_pairs(instances, iam_risks), ["_acct", "_arn"]).drop("_arn")


def role_arn_pairs(instances: DataFrame, iam_risks: DataFrame) -> DataFrame:
    """Distinct (_acct, _role, _arn) of running instances' roles and the source ARNs
    of their account that hold them, by the trigram index."""
    arns = iam_risks.select(F.col("account_id").alias("_acct"), F.col("source_arn").alias("_arn"))
    return match_roles(running_roles(running(instances)), arns.where(F.col("_arn").isNotNull()).distinct())


def stored_bytes(df: DataFrame) -> int:
    """The size of what ``df`` reads, by the optimizer's statistics: the bytes of
    its files, and "very large" for sources that do not say."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def split_hot_join(left: DataFrame, right: DataFrame, key: str, hot_threshold: int | None,
                   buckets: int = HOT_SALT_BUCKETS, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` that spreads hot keys over ``buckets`` tasks.

    ``how="inner"``: a key is hot when ``right`` holds more than
    ``hot_threshold`` rows for it; those right rows get a salt from a hash of
    the row and the key's left rows are repeated once per salt.
    ``how="left"``: a key is hot when ``left`` holds more than the threshold;
    the left rows are salted and the right rows repeated, so every left row
    still appears exactly once when it has no partner.
    The hot-key set has at most rows / ``hot_threshold`` entries, a proven
    bound, so it is broadcast.  Other keys keep salt 0: their join is the
    plain equi-join.  Input files too small to hold that many rows for a key
    (``ROW_BYTES`` each) are joined without counting.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    split, repeat = (right, left) if how == "inner" else (left, right)
    if hot_threshold is None or stored_bytes(split) < hot_threshold * ROW_BYTES:
        return left.join(right, key, how)
    hot = (split.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_threshold)
           .select(key, F.lit(True).alias("_hot")))
    salted = split.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*split.columns), F.lit(buckets))).otherwise(F.lit(0))
        .cast("int")).drop("_hot")
    repeated = repeat.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    if how == "inner":
        return repeated.join(salted, [key, "_salt"]).drop("_salt")
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def attack_chains(
    instances: DataFrame,
    findings: DataFrame,
    cves: DataFrame,
    iam_risks: DataFrame,
    instance_id: str | None = None,
    hot_threshold: int | None = HOT_INSTANCE_CVES,
) -> DataFrame:
    """E-6 ``v_full_attack_chains`` (flagship).

    running instance x failed finding on its arn x open severe CVE on its id,
    left-joined to escalation paths whose source_arn LIKE '%' || role || '%'
    in the same account; role = split_part(profile, '/', 2).

    Plan shape (R-5): the LIKE join runs on distinct roles before any fan-out;
    instances, their findings and their CVEs are joined on their keys, and the
    escalation paths, which every instance of a role repeats, come last: no exchange
    holds instances x paths, so what is shuffled grows with the tables.
    The optional ``instance_id`` filter (D-08) is pushed into every input.
    An instance with more than ``hot_threshold`` open severe CVEs has its
    fan-out split over many tasks (``split_hot_join``); None turns this off.
    """
    inst, matches, found, cves = _chain_sides(instances, findings, cves, iam_risks, instance_id)
    product = split_hot_join(inst.join(found, "instance_id"), cves, "instance_id", hot_threshold)
    return _chain_rows(_with_paths(product, matches))


INSTANCE_COLS = ["instance_id", "name_tag", "public_ip", "instance_type", "region", "iam_instance_profile", "account_id", "resource_arn"]


def _chain_factors(instances: DataFrame, findings: DataFrame, cves: DataFrame, iam_risks: DataFrame,
                   instance_id: str | None = None, strategy: str = "auto") -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a chain is the product of, each keyed by instance_id: the running
    instance with its escalation paths (or none), its failed findings, its open
    severe CVEs."""
    inst, matches, found, severe = _chain_sides(instances, findings, cves, iam_risks, instance_id, strategy)
    return _with_paths(inst, matches), found, severe


def _with_paths(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of instances, once for each escalation path of the role, or once without."""
    same = (rows["account_id"] == matches["_acct"]) & (profile_role(rows["iam_instance_profile"]) == matches["_role"])
    return rows.join(matches, same, "left").drop("_acct", "_role", "account_id", "resource_arn")


def _chain_sides(instances: DataFrame, findings: DataFrame, cves: DataFrame, iam_risks: DataFrame,
                 instance_id: str | None = None, strategy: str = "auto") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The running instances, the paths of their roles, their failed findings and open severe CVEs."""
    inst = running(instances)
    if instance_id is not None:
        inst = inst.where(F.col("instance_id") == instance_id)
        cves = cves.where(F.col("instance_id") == instance_id)
        strategy = "plain"  # one role
    matches = role_risk_matches(inst, iam_risks, strategy)
    inst = inst.select(*INSTANCE_COLS)
    found = (
        failed(findings)
        .select("resource_arn", F.col("check_title").alias("misconfiguration"),
                F.col("severity").alias("misconfig_severity"), F.col("recommendation").alias("misconfig_fix"))
        .join(inst.select("resource_arn", "instance_id"), "resource_arn")
        .drop("resource_arn")
    )
    severe = open_severe(cves).select(
        "instance_id", "cve_id", "cvss_score", "package_name", "fixed_version", F.col("title").alias("cve_title")
    )
    return inst, matches, found, severe


def _chain_rows(product: DataFrame) -> DataFrame:
    return product.select(
        "instance_id", "name_tag", "public_ip", "instance_type", "region", "iam_instance_profile",
        "misconfiguration", "misconfig_severity", "misconfig_fix",
        "cve_id", F.col("cvss_score").cast("double").alias("cvss_score"), "package_name", "fixed_version", "cve_title",
        F.col("path").alias("escalation_path"), F.col("hops").alias("escalation_hops"),
        F.col("target_name").alias("escalates_to"), "target_is_admin", "iam_severity",
        risk_score("cvss_score", "misconfig_severity", "iam_severity", "public_ip").alias("risk_score"),
    )


def _best(df: DataFrame, n: int, by: list[str], first: list, then: list[str]) -> DataFrame:
    """The n first rows of each ``by`` in the order ``first``, then the columns
    ``then`` ascending with NULLs last.  The limit is applied in every task
    before the shuffle."""
    order = [*first, *[F.col(c).asc_nulls_last() for c in then]]
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def chain_bounds(instances: DataFrame, findings: DataFrame, cves: DataFrame, iam_risks: DataFrame) -> DataFrame:
    """One row per running instance that has a chain: its columns, best (the score
    of its best chain, NULL if no CVE of it has a score), admin (whether a path of
    it reaches an admin), best_admin (the best of those) and the number of its
    findings, CVEs and paths.  The score is a sum over the factors of a chain, so
    the best chain is the best of every factor: one partial aggregate a table, no
    fan-out."""
    rows = F.count(F.lit(1))
    f = failed(findings).groupBy("resource_arn").agg(F.max(severity_points("severity")).alias("_f"), rows.alias("n_found"))
    c = open_severe(cves).groupBy("instance_id").agg(F.max("cvss_score").alias("_c"), rows.alias("n_severe"))
    is_admin, points = F.col("target_is_admin") == F.lit(True), severity_points("iam_severity")
    m = role_risk_matches(instances, iam_risks).groupBy(F.col("_acct").alias("account_id"), "_role").agg(
        F.max(points).alias("_p"), F.max(F.when(is_admin, points)).alias("_a"), rows.alias("n_paths"))
    inst = running(instances).select(*INSTANCE_COLS, profile_role("iam_instance_profile").alias("_role"))
    each = inst.join(f, "resource_arn").join(c, "instance_id").join(m, ["account_id", "_role"], "left")
    base = F.col("_c") + F.col("_f") + F.when(F.col("public_ip").isNotNull(), F.lit(PUBLIC_IP_POINTS)).otherwise(F.lit(0))
    return each.select(*INSTANCE_COLS, (base + F.coalesce("_p", F.lit(0))).alias("best"), F.col("_a").isNotNull().alias("admin"),
                       (base + F.col("_a")).alias("best_admin"), "n_found", "n_severe", F.coalesce("n_paths", F.lit(0)).alias("n_paths"))


def leading_instances(bounds: DataFrame, n: int) -> pa.Table:
    """The instances that can hold one of the ``n`` best chains of all, or of those
    that reach an admin: the n first by (best chain's score DESC NULLS LAST,
    instance_id), of either kind.  Each of them has a chain with that score, so n
    chains come before any chain of another instance.  The driver gets 2n rows
    (more only if an instance_id is stored twice); each task keeps n of a kind
    before they are exchanged."""
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("best").alias("score")),
                    F.struct(F.when(F.col("admin"), F.lit(1)).alias("kind"), F.col("best_admin").alias("score")))
    each = bounds.select(*INSTANCE_COLS, "n_found", "n_severe", "n_paths", F.inline(kinds)).where(F.col("kind").isNotNull())
    w = Window.partitionBy("kind").orderBy(F.col("score").desc_nulls_last(), F.col("instance_id"))
    got = each.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n).drop("_rank", "score").toArrow()
    first = set(got.filter(pc.equal(got["kind"], 0))["instance_id"].to_pylist())
    again = pa.array([k == 1 and i in first for k, i in zip(got["kind"].to_pylist(), got["instance_id"].to_pylist())], pa.bool_())
    return got.filter(pc.invert(again)).drop_columns(["kind"])


def _leaders(df: DataFrame, n: int, by: list[str], points: Column, then: list[str]) -> DataFrame:
    """The rows that are among the n first of their ``by`` by points, then the
    columns ``then`` (_scored), or by the columns alone (_plain)."""
    order = [F.col(c).asc_nulls_last() for c in then]
    rank = lambda *first: F.row_number().over(Window.partitionBy(*by).orderBy(*first, *order)) <= n
    out = df.withColumn("_points", points).withColumn("_scored", rank(F.col("_points").desc())).withColumn("_plain", rank())
    return out.where(F.col("_scored") | F.col("_plain")).drop("_points")


DIRECT_ROWS = 1_000_000  # chains of the leading instances up to which they are joined without ranking their factors


def best_chains(instances: DataFrame, findings: DataFrame, cves: DataFrame, iam_risks: DataFrame, n: int,
                direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Chain rows that hold the ``n`` best of E-6 by (risk_score DESC NULLS LAST,
    the dashboard list's columns ASC NULLS LAST), also among the chains that
    reach an admin.

    A first job finds the instances that can hold one (``leading_instances``);
    their keys are pushed into the scans of the factors.  If they have few chains
    (counted by that job), these are joined as they are, the counted factors
    broadcast.  Else n rows of each factor are joined, never the fan-out: the score
    is a sum over the factors and the tie-break compares their columns, so a row
    among the n best only uses rows that are among the n best of their factor.  A
    chain whose CVE has no score has no score itself; points do not matter there,
    and every factor is ranked by its columns alone.
    """
    spark = instances.sparkSession
    leading = leading_instances(chain_bounds(instances, findings, cves, iam_risks), n)
    held = lambda c: leading[c].unique().drop_null().to_pylist()
    inst = spark.createDataFrame(leading.select(INSTANCE_COLS)).withColumn("instance_state", F.lit("running"))
    chains = sum(f * c * max(p, 1) for f, c, p in zip(*(leading[k].to_pylist() for k in ("n_found", "n_severe", "n_paths"))))
    paths, found, severe = _chain_factors(
        F.broadcast(inst), findings.where(F.col("resource_arn").isin(held("resource_arn"))),
        cves.where(F.col("instance_id").isin(held("instance_id"))), iam_risks.where(F.col("account_id").isin(held("account_id"))), strategy="plain")
    if chains <= direct_rows:
        return _chain_rows(severe.join(F.broadcast(found), "instance_id").join(F.broadcast(paths), "instance_id"))
    # dealt by instance once: the windows and the joins below find their rows in place
    paths, found, severe = (x.repartition("instance_id") for x in (paths, found, severe))
    p = _leaders(paths.withColumn("_admin", F.coalesce("target_is_admin", F.lit(False))), n, ["instance_id", "_admin"],
                 severity_points("iam_severity"), ["name_tag", "public_ip", "region", "path", "target_name", "target_is_admin"]).drop("_admin")
    f = _leaders(found, n, ["instance_id"], severity_points("misconfig_severity"), ["misconfiguration", "misconfig_severity"])
    c = _best(severe.withColumn("_has", F.col("cvss_score").isNotNull()), n, ["instance_id", "_has"], [F.col("cvss_score").desc()],
              ["cve_id", "cvss_score", "package_name", "fixed_version"])
    f = f.withColumnsRenamed({"_scored": "_f_scored", "_plain": "_f_plain"})
    fits = F.when(F.col("_has"), F.col("_scored") & F.col("_f_scored")).otherwise(F.col("_plain") & F.col("_f_plain"))
    return _chain_rows(p.join(f, "instance_id").join(c, "instance_id").where(fits))


def best_critical_risks(findings: DataFrame, cves: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """E-1 rows that hold the ``n`` best by (cvss_score DESC NULLS LAST, the other
    ``columns`` ASC NULLS LAST): of every resource the n first findings and the
    n first CVEs are joined, never the fan-out."""
    named = {"exposure": "check_title", "network_severity": "severity", "cve_title": "title"}
    own = lambda df, skip: [named.get(c, c) for c in columns if named.get(c, c) in df.columns and c not in skip]
    f, c = failed(findings), open_severe(cves)
    finding_cols = own(f.select("account_id", "region", "resource_arn", "check_title", "severity"), ())
    cve_cols = own(c.drop("account_id", "region", "resource_arn", "severity"), ("cvss_score",))
    f = _best(f, n, ["resource_arn"], [], finding_cols)
    c = _best(c, n, ["resource_arn"], [F.col("cvss_score").desc_nulls_last()], cve_cols)
    return critical_risks(f, c, hot_threshold=None)


def instances_with_sg(instances: DataFrame, groups: DataFrame,
                      hot_threshold: int | None = FAN_OUT_ROWS) -> DataFrame:
    """E-7: running instances left-joined to every security group of their VPC
    (a VPC with over ``hot_threshold`` instances is split, as there are few VPCs and
    each of its rows becomes as many as it has groups).  Of a group only two flags
    are kept, so groups of a VPC with equal flags are joined as one counted row and
    the copies are made in place, not in the join."""
    i = running(instances).select(
        "instance_id", "name_tag", "instance_type", "instance_state", "public_ip", "region",
        "iam_instance_profile", "vpc_id",
    )
    g = groups.groupBy("vpc_id", "allows_all_ingress", "allows_ssh_public").agg(F.count(F.lit(1)).alias("_n"))
    j = split_hot_join(i, g, "vpc_id", hot_threshold, how="left").drop("vpc_id")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(1)).cast("long")))
    return j.select("*", copies.alias("_copy")).drop("_n", "_copy")


def scannable_instances(instances: DataFrame, online: DataFrame) -> DataFrame:
    """E-10: running instances the agent service reports online (semi-join);
    name = Name tag or the instance id."""
    i = running(instances)
    return i.join(online.select("instance_id"), "instance_id", "left_semi").select(
        "instance_id",
        F.coalesce(F.try_element_at(F.col("tags"), F.lit("Name")), F.col("instance_id")).alias("name"),
        "region",
    )


def alerts_gate(risks: DataFrame, chains: DataFrame) -> DataFrame:
    """E-9: the risk rows, only when ``chains`` is empty (uncorrelated NOT
    EXISTS).  The gate belongs on the alert list (``ranking.alert_chains``).

    A left-anti join against a one-row "any chain" flag: the chain side is
    reduced to at most one row (limit 1) before the join, so nothing grows.
    """
    any_chain = chains.select(F.lit(1).alias("_one")).limit(1)
    return risks.withColumn("_one", F.lit(1)).join(F.broadcast(any_chain), "_one", "left_anti").drop("_one")
