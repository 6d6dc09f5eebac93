"""Scanner output folders written by Spark from the driver's tables.

Test inputs for the file readers.  Every file is written by the task that holds
its rows, so files and tasks grow with the tables and nothing passes through
the driver.  A file holds the rows of one range of keys, of at most BLOCK keys,
so no account, instance or source is gathered into one row.  Where a file's name
matters it is a folder ``scan=<name>``, the form in which a Spark job leaves
a named file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.session import scratch_path
from chainlens.sources import adapters as A

#: Keys of a table whose rows share a file.
BLOCK = 4096


def block(key: str) -> Column:
    return F.floor(F.col(key) / BLOCK)


def _list(items: str) -> Column:
    return F.concat(F.lit("["), F.array_join(F.collect_list(items), ","), F.lit("]"))


def _id(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def write_cve_reports(spark: SparkSession, sf_dir: str) -> str:
    """Reports of each supplier (the instance), of about BLOCK line items at most,
    named ``i-<supplier>.b<number>.json``; odd numbers are bare lists, even ones
    objects.  A supplier has as many as its line items ask for.  They are packed
    into archives, as a file or folder for each would be more than a store can list."""
    line = A.read(spark, sf_dir, "lineitem")
    score = F.when(F.col("l_linenumber") % 2 == 0, F.struct(F.struct((F.col("l_linenumber") / 2).alias("V3Score")).alias("nvd")))
    item = F.to_json(F.struct(
        F.concat_ws("-", F.lit("CVE"), "l_orderkey", "l_linenumber").alias("VulnerabilityID"),
        F.when(F.col("l_linenumber") == 1, "high").otherwise("LOW").alias("Severity"),
        _id("pkg-", "l_partkey").alias("PkgName"), score.alias("CVSS")))
    held = line.groupBy(F.col("l_suppkey").alias("_supp")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = line.join(held, F.col("l_suppkey").eqNullSafe(F.col("_supp")))
    # every other supplier begins with an odd number
    number = F.col("l_suppkey") + F.pmod(F.xxhash64(*line.columns), F.col("parts"))
    number = F.when(F.col("l_orderkey").isNotNull(), F.coalesce(number, F.lit(0)))
    reports = dealt.select("l_suppkey", number.alias("block"), item.alias("item")).groupBy("l_suppkey", "block").agg(_list("item").alias("items"))
    results = F.concat(F.lit('[{"Vulnerabilities":'), "items", F.lit('},{"Vulnerabilities":null}]'))
    doc = F.when(F.col("block") % 2 == 1, results).otherwise(F.concat(F.lit('{"Results":'), results, F.lit("}")))
    name = F.concat(_id("i-", "l_suppkey"), F.lit(".b"), F.col("block").cast("string"), F.lit(".json"))
    path = scratch_path(spark, "cve-reports")
    reports.select(name.alias("scan"), doc.alias("value")).write.parquet(path)
    return path


def write_bundles(spark: SparkSession, sf_dir: str) -> str:
    """Inventory bundles, of about BLOCK rows of a table at most, with an empty table
    in each.  An account has as many as its largest table asks for."""
    def rows(table: str, source: str, account: Column, key: str, prefix: str, key_name: str, name: str) -> DataFrame:
        item = F.to_json(F.struct(_id(prefix, key).alias(key_name), F.col(name).alias("name")))
        source = A.read(spark, sf_dir, source).withColumn("account", account)
        held = source.groupBy(F.col("account").alias("_account")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
        dealt = source.join(held, F.col("account").eqNullSafe(F.col("_account")))
        number = F.pmod(F.xxhash64(*source.columns), F.col("parts"))
        return dealt.select("account", number.alias("block"), F.lit(table).alias("table"), item.alias("item"))

    every = (rows("instances", "customer", F.col("c_nationkey"), "c_custkey", "i-", "instance_id", "c_name")
             .unionByName(rows("s3", "part", F.col("p_partkey") % 25, "p_partkey", "bucket-", "bucket_name", "p_name"))
             .unionByName(rows("vpcs", "supplier", F.col("s_nationkey"), "s_suppkey", "vpc-", "vpc_id", "s_name")))
    tables = every.groupBy("account", "block", "table").agg(_list("item").alias("items"))
    member = F.concat(F.lit('"'), "table", F.lit('":'), "items")
    body = F.array_join(F.collect_list(member), ",")
    bundles = tables.groupBy("account", "block").agg(F.concat(F.lit('{"iam":[],'), body, F.lit("}")).alias("value"))
    path = scratch_path(spark, "bundles")
    bundles.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_accounts(spark: SparkSession, sf_dir: str) -> str:
    """An account registry of one entry for each customer, in YAML files of one block each."""
    nation = A.read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    customer = A.read(spark, sf_dir, "customer")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    entry = F.concat(F.lit("  - "), F.to_json(F.struct(_id("acct-", "c_custkey").alias("id"), F.col("c_name").alias("name"), "region")))
    files = rows.select(block("c_custkey").alias("block"), entry.alias("entry")).groupBy("block").agg(
        F.concat(F.lit("accounts:\n"), F.array_join(F.collect_list("entry"), "\n")).alias("value"))
    path = scratch_path(spark, "accounts")
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_scans(spark: SparkSession, sf_dir: str) -> str:
    """Scan files of one block of orders each, a folder ``scan=<block>`` for
    each; that of the last block is written when the others are finished."""
    orders = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", block("o_orderkey").alias("scan"))
    last = orders.agg(F.max("scan").alias("last"))
    marked = orders.join(F.broadcast(last), F.col("scan") <= F.col("last"))
    path = scratch_path(spark, "scans")
    for now in (F.col("scan") < F.col("last"), F.col("scan") == F.col("last")):
        part = marked.where(now).drop("last")
        part.repartition("scan").write.mode("append").partitionBy("scan").json(path)
    return path


def write_reports(spark: SparkSession, sf_dir: str) -> str:
    """Two reports with a line for each order, as folders of lines; the second has the open orders only."""
    root = scratch_path(spark, "reports")
    orders = A.read(spark, sf_dir, "orders")
    line = F.concat_ws(" ", F.lit("- order"), "o_orderkey", "o_orderstatus")
    orders.select(line.alias("value")).write.text(f"{root}/security_report_1.md")
    orders.where(F.col("o_orderstatus") == "O").select(line.alias("value")).write.text(f"{root}/security_report_2.md")
    return root
