"""What an upsert changed, and what follows from it.

``signed`` turns a change feed (``upsert.upsert_feed``) into signed rows: the
old row of a changed key with sign -1, the new one with +1.  Counts are sums, so
a stored summary is kept up to date by adding the signed sums (``maintain``);
attack chains are a product of four factors, so a batch's added and withdrawn
chains come from the counts of each factor's rows before and after it
(``chain_changes``).  Neither reads what the batch did not touch, but for the
rows that the changes join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.functions.scalar import profile_role, risk_score
from chainlens.operators.correlate import PATH_COLS, failed, open_severe, role_arn_pairs, role_risk_matches, running
from chainlens.session import stored

SIGN = "_sign"


def signed(feed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the sign of every row of the feed whose columns differ."""
    side = lambda name: F.struct(*[F.col(f"{name}.{c}").alias(c) for c in columns])
    rows = feed.select(F.col("old").isNotNull().alias("_was"), side("old").alias("_old"), side("new").alias("_new"))
    rows = rows.where(~F.col("_was") | ~F.col("_old").eqNullSafe(F.col("_new")))
    both = F.array(F.struct(F.when(F.col("_was"), F.lit(-1)).alias(SIGN), F.col("_old").alias("row")),
                   F.struct(F.lit(1).alias(SIGN), F.col("_new").alias("row")))
    return rows.select(F.inline(both)).where(F.col(SIGN).isNotNull()).select("row.*", SIGN)


def narrowed(feed: DataFrame, columns: list[str]) -> DataFrame:
    """The feed with only ``columns`` of its rows."""
    side = lambda name: F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in columns])).alias(name)
    return feed.select(side("old"), side("new"))


def net(rows: DataFrame) -> DataFrame:
    """Equal rows added up; rows whose signs cancel go."""
    cols = [c for c in rows.columns if c != SIGN]
    return rows.groupBy(*cols).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)


# -- maintained summaries -------------------------------------------------------------------

@dataclass(frozen=True)
class Summary:
    """Counts by ``keys``: name -> which rows count.  A group exists while its
    first count is not 0."""

    keys: tuple[str, ...]
    counts: dict
    columns: tuple[str, ...]  # that the signed rows need


def _always() -> Column:
    return F.lit(True)


def _fails() -> Column:
    return F.col("status") == "FAIL"


def _open() -> Column:
    return F.col("status") == "OPEN"


#: G-1, G-2, G-3, G-4 and G-10.
SUMMARIES = {
    "severity_summary": Summary(("account_id", "severity"), {"total": _always, "failures": _fails}, ("account_id", "severity", "status")),
    "cve_summary": Summary(("account_id", "instance_id", "severity"), {"total": _always, "open_count": _open},
                           ("account_id", "instance_id", "severity", "status")),
    "severity_totals": Summary(("severity",), {"total": _always, "failures": _fails}, ("severity", "status")),
    "open_cve_counts": Summary(("severity",), {"total": _open}, ("severity", "status")),
    "severity_breakdown": Summary(("severity",), {"total": _fails}, ("severity", "status")),
}


def _sums(summary: Summary, rows: DataFrame) -> DataFrame:
    return rows.select(*summary.keys, *[F.when(test(), F.col(SIGN)).otherwise(0).cast("long").alias(c) for c, test in summary.counts.items()])


def _added(summary: Summary, parts: DataFrame) -> DataFrame:
    out = parts.groupBy(*summary.keys).agg(*[F.sum(c).alias(c) for c in summary.counts])
    return out.where(F.col(next(iter(summary.counts))) != 0)


def summarise(name: str, table: DataFrame) -> DataFrame:
    """The summary of a whole table, to start from."""
    return _added(SUMMARIES[name], _sums(SUMMARIES[name], table.withColumn(SIGN, F.lit(1))))


def maintain(name: str, stored: DataFrame, feed: DataFrame) -> DataFrame:
    """The summary after an upsert, from the stored one and the upsert's feed."""
    s = SUMMARIES[name]
    change = _sums(s, signed(feed, list(s.columns)))
    return _added(s, stored.select(*change.columns).unionByName(change))


# -- maintained attack chains ------------------------------------------------------------------

INSTANCE = ["instance_id", "name_tag", "public_ip", "instance_type", "region", "iam_instance_profile", "account_id", "resource_arn", "instance_state"]
FINDING = ["resource_arn", "check_title", "severity", "recommendation", "status"]
CVE = ["instance_id", "cve_id", "cvss_score", "package_name", "fixed_version", "title", "severity", "status"]
RISK = ["account_id", "source_arn", "path", "hops", "target_name", "target_is_admin", "severity"]
#: The columns of each table that chains are made of.
CHAIN_COLUMNS = {"instances": INSTANCE, "findings": FINDING, "cves": CVE, "iam_risks": RISK}


def _found(findings: DataFrame, *more: str) -> DataFrame:
    return failed(findings).select("resource_arn", F.col("check_title").alias("misconfiguration"), F.col("severity").alias("misconfig_severity"),
                                   F.col("recommendation").alias("misconfig_fix"), *more)


def _severe(cves: DataFrame, *more: str) -> DataFrame:
    return open_severe(cves).select("instance_id", "cve_id", "cvss_score", "package_name", "fixed_version", F.col("title").alias("cve_title"), *more)


def _roles(instances: DataFrame) -> DataFrame:
    return instances.withColumn("_role", profile_role("iam_instance_profile"))


def chain_changes(old: dict[str, DataFrame], new: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """The attack chains (E-6) that a batch added and withdrew: the chain columns and
    ``change``, how often the row was added (above 0) or withdrawn (below).

    ``old`` and ``new`` hold instances, findings, cves and iam_risks before and after
    the batch, ``changed`` the signed rows (CHAIN_COLUMNS) of the tables that changed.
    An instance_id is stored once.

    A chain is a product of four rows: instance, finding, CVE and escalation path (or
    none).  Equal rows of each are counted first, before and after the batch, so a
    chain's change is the difference of two products of counts and every chain is made
    once: nothing is netted after the product.  The paths, which every instance of a
    role repeats, come last, so no exchange holds instances x paths.  Of the instances
    that changed, and of those with a role that a changed path's ARN holds, all
    products are made; of others those with a changed finding, and those of an
    unchanged finding and a changed CVE.
    """
    table = lambda side, name: side[name].select(*CHAIN_COLUMNS[name])
    i_old, i_new, r_old, r_new = table(old, "instances"), table(new, "instances"), table(old, "iam_risks"), table(new, "iam_risks")
    none = lambda name: table(new, name).limit(0).withColumn(SIGN, F.lit(1))
    delta = {name: changed.get(name, none(name)) for name in CHAIN_COLUMNS}

    ids = delta["instances"].select("instance_id")
    if "iam_risks" in changed:
        every = i_old.unionByName(i_new)
        roles = role_arn_pairs(every, delta["iam_risks"]).select(F.col("_acct").alias("account_id"), "_role").distinct()
        ids = ids.union(_roles(running(every)).join(roles, ["account_id", "_role"], "left_semi").select("instance_id"))
    ids = ids.distinct()
    some = lambda rows, keys, on, how="left_semi": rows.join(keys, on, how)
    d_found, d_severe = net(_found(delta["findings"], SIGN)), net(_severe(delta["cves"], SIGN))

    up = lambda rows: running(rows).drop("instance_state")
    touched = _counted(some(up(i_old), ids, "instance_id"), some(up(i_new), ids, "instance_id")).withColumn("_whole", F.lit(True))
    if "findings" in changed or "cves" in changed:
        near = some(up(i_new), d_found.select("resource_arn").distinct(), "resource_arn").select("instance_id")
        near = near.union(d_severe.select("instance_id")).distinct()
        rest = some(some(up(i_new), near, "instance_id"), ids, "instance_id", "left_anti")
        touched = touched.unionByName(_counted(rest, rest).withColumn("_whole", F.lit(False)))
    touched = stored(touched, "changed-instances")
    # rows of an instance that moved (account, ARN) are alike in a chain: theirs alone must be added up
    moved = touched.groupBy("instance_id").agg(F.countDistinct(F.struct("account_id", "resource_arn")).alias("places")).where(F.col("places") > 1)
    moved = stored(moved.select("instance_id"), "moved-instances")

    found = _after(some(_found(old["findings"]), touched.select("resource_arn").distinct(), "resource_arn"), d_found)
    severe = _after(some(_severe(old["cves"]), touched.select("instance_id").distinct(), "instance_id"), d_severe)
    found, severe = found.withColumnsRenamed({"_o": "_fo", "_n": "_fn"}), severe.withColumnsRenamed({"_o": "_co", "_n": "_cn"})
    whole, rest = touched.where("_whole"), touched.where("NOT _whole")
    terms = [whole.join(found, "resource_arn").join(severe, "instance_id")]
    if "findings" in changed:
        terms.append(rest.join(found.where("_fo <> _fn"), "resource_arn").join(severe, "instance_id"))
    if "cves" in changed:
        terms.append(rest.join(severe.where("_co <> _cn"), "instance_id").join(found.where("_fo = _fn"), "resource_arn"))
    product = reduce(DataFrame.unionByName, terms).withColumn("_o", F.expr("_o * _fo * _co")).withColumn("_n", F.expr("_n * _fn * _cn"))
    product = product.where("_o <> 0 OR _n <> 0").drop("_fo", "_fn", "_co", "_cn", "_whole")

    paths = _paths_of_roles(touched.withColumn("instance_state", F.lit("running")), r_old, r_new)

    def chains(product: DataFrame) -> DataFrame:
        same = (product["account_id"] == paths["_acct"]) & (profile_role(product["iam_instance_profile"]) == paths["_role"])
        change = F.col("_n") * F.coalesce("_pn", F.lit(1)) - F.col("_o") * F.coalesce("_po", F.lit(1))
        return product.join(paths, same, "left").select(
            "instance_id", "name_tag", "public_ip", "instance_type", "region", "iam_instance_profile",
            "misconfiguration", "misconfig_severity", "misconfig_fix",
            "cve_id", F.col("cvss_score").cast("double").alias("cvss_score"), "package_name", "fixed_version", "cve_title",
            F.col("path").alias("escalation_path"), F.col("hops").alias("escalation_hops"),
            F.col("target_name").alias("escalates_to"), "target_is_admin", "iam_severity",
            risk_score("cvss_score", "misconfig_severity", "iam_severity", "public_ip").alias("risk_score"), change.alias(SIGN)).where(F.col(SIGN) != 0)

    if moved.isEmpty():
        out = chains(product)
    else:
        out = chains(some(product, moved, "instance_id", "left_anti")).unionByName(net(chains(some(product, moved, "instance_id"))))
    return out.withColumnRenamed(SIGN, "change")


def _counted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Equal rows once: how often the sides hold them, _o and _n."""
    sides = [side.withColumns({"_o": F.lit(o).cast("long"), "_n": F.lit(n).cast("long")}) for side, o, n in ((old, 1, 0), (new, 0, 1))]
    return sides[0].unionByName(sides[1]).groupBy(*old.columns).agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n"))


def _after(old: DataFrame, change: DataFrame) -> DataFrame:
    """``_counted`` from the rows before a batch and its signed rows."""
    both = old.withColumns({"_o": F.lit(1).cast("long"), "_n": F.lit(1).cast("long")}).unionByName(
        change.select(*old.columns, F.lit(0).cast("long").alias("_o"), F.col(SIGN).cast("long").alias("_n")))
    return both.groupBy(*old.columns).agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n")).where("_o <> 0 OR _n <> 0")


def _paths_of_roles(instances: DataFrame, r_old: DataFrame, r_new: DataFrame) -> DataFrame:
    """The escalation paths of the instances' roles, counted before and after (_po, _pn).  A
    role that has none on one side alone has a row without a path there; one that has
    none on both has no row."""
    of = lambda risks: role_risk_matches(instances, risks).select("_acct", "_role", *PATH_COLS, "iam_severity")
    paths = stored(_counted(of(r_old), of(r_new)), "changed-paths")
    held = paths.groupBy("_acct", "_role").agg(F.max("_o").alias("_o"), F.max("_n").alias("_n")).where("_o = 0 OR _n = 0")
    without = held.select("_acct", "_role", *[F.lit(None).cast(paths.schema[c].dataType).alias(c) for c in (*PATH_COLS, "iam_severity")],
                          *[F.when(F.col(c) == 0, 1).otherwise(0).cast("long").alias(c) for c in ("_o", "_n")])
    return paths.unionByName(without).withColumnsRenamed({"_o": "_po", "_n": "_pn"})


def added_chains(changes: DataFrame) -> DataFrame:
    """The added chains, each as often as it was added: the input of ``ranking.alert_chains``."""
    copies = changes.where(F.col("change") > 0).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("change"))).alias("_copy"))
    return copies.drop("change", "_copy")
