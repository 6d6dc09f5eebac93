"""The substring join of instance roles and escalation paths.

``source_arn LIKE '%' || role || '%'`` inside an account has no key to join on,
and comparing every role of an account with every path is quadratic in the
account.  Here the distinct source ARNs of an account are indexed by the
trigrams they hold.  A text that matches a role holds every trigram of the
role's literal parts (the parts between LIKE wildcards), so a role only has to
meet the ARNs under one of its trigrams, and it takes the rarest one; LIKE then
decides.  A role with a trigram that no ARN of the account holds meets none.

Roles without a trigram (literal parts of at most two characters, as '' or
'ab', or a backslash before a wildcard, where LIKE itself says what is meant)
meet every ARN of the account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.functions.scalar import profile_role, substring_match

GRAM = 3


def grams(text: Column) -> Column:
    """The distinct trigrams of a text, as an array; empty for shorter texts."""
    every = F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def role_grams(role: Column) -> Column:
    """The distinct trigrams of a LIKE pattern's literal parts; empty where the
    pattern escapes something."""
    parts = F.split(role, "[_%]")
    every = F.array_distinct(F.flatten(F.transform(parts, grams)))
    return F.when(role.contains("\\"), F.array().cast("array<string>")).otherwise(every)


def running_roles(running_instances: DataFrame) -> DataFrame:
    """Distinct (_acct, _role) of the instances."""
    return (running_instances.where(F.col("iam_instance_profile").isNotNull())
            .select(F.col("account_id").alias("_acct"), profile_role("iam_instance_profile").alias("_role")).distinct())


def match_roles(roles: DataFrame, arns: DataFrame) -> DataFrame:
    """(_acct, _role, _arn): the distinct pairs of a role and an ARN of its account
    that holds it.  ``roles`` has distinct (_acct, _role), ``arns`` distinct
    (_acct, _arn)."""
    index = arns.select("_acct", "_arn", F.explode(grams(F.col("_arn"))).alias("_gram"))
    held = index.groupBy("_acct", "_gram").agg(F.count(F.lit(1)).alias("_n"))
    asked = roles.withColumn("_grams", role_grams(F.col("_role")))
    parts = asked.where(F.size("_grams") > 0).select("_acct", "_role", F.size("_grams").alias("_size"), F.explode("_grams").alias("_gram"))
    rarest = (parts.join(held, ["_acct", "_gram"]).groupBy("_acct", "_role")
              .agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"), F.count(F.lit(1)).alias("_found"), F.max("_size").alias("_size"))
              .where(F.col("_found") == F.col("_size")))  # else the account has no ARN with all of them
    by_gram = index.join(rarest.select("_acct", "_gram", "_role"), ["_acct", "_gram"])
    short = asked.where((F.size("_grams") == 0) & F.col("_role").isNotNull()).select("_acct", "_role")
    every = arns.join(short, "_acct")
    cols = ["_acct", "_role", "_arn"]
    met = by_gram.select(*cols).unionByName(every.select(*cols))
    return met.where(substring_match(F.col("_arn"), F.col("_role")))
