"""The substring join of roles and paths: the trigram index against LIKE on all pairs."""

import random

from pyspark.sql import functions as F

from chainlens.operators import correlate as E
from chainlens.operators import role_match as R


def tables(spark, seed):
    """Accounts of random roles and ARNs; one account holds a third of the paths."""
    rng = random.Random(seed)
    letters = "abcA-/:_%"
    word = lambda n: "".join(rng.choice(letters[:-2]) for _ in range(n))
    roles = ["", "a", "ab", "_", "%", "a_c", "a_b-A%c", "%%", "abc", "cab-", "zzz", "a%", "__a", "-_-", "ab_", "Ab%cA", "é", "aéb"]
    roles += ["".join(rng.choice(letters) for _ in range(rng.randrange(7))) for _ in range(60)]
    hosts = [(f"i-{k}", f"acct-{k % 4}" if k % 9 else None, "running" if k % 7 else "stopped",
              None if k % 13 == 0 else f"arn:x/{rng.choice(roles)}" + rng.choice(["", "/more"])) for k in range(500)]
    hosts += [("i-x", "acct-0", "running", "noslash")]
    paths = [("acct-0" if k % 3 == 0 else f"acct-{rng.randrange(5)}", None if k % 17 == 0 else word(rng.randrange(25)) + rng.choice(["", "aéb"]),
              f"p{k}", k % 5, f"t{k}", k % 2 == 0, "HIGH") for k in range(400)]
    i = spark.createDataFrame(hosts, "instance_id string, account_id string, instance_state string, iam_instance_profile string")
    r = spark.createDataFrame(paths, "account_id string, source_arn string, path string, hops int, target_name string, "
                                     "target_is_admin boolean, severity string")
    return i, r


def test_trigram_index_equals_like_on_all_pairs(spark):
    for seed in range(3):
        i, r = tables(spark, seed)
        rows = lambda s: sorted(str(tuple(x)) for x in E.role_risk_matches(i, r, strategy=s).select(  # noqa: B023, E731
            "_acct", "_role", *E.PATH_COLS, "iam_severity").collect())
        plain = rows("plain")
        assert plain == rows("trigram") and len(plain) > 500
    assert E.role_risk_matches(i.limit(0), r, "trigram").count() == 0 and E.role_risk_matches(i, r.limit(0), "trigram").count() == 0


def test_a_role_meets_few_paths(spark):
    """Candidates before LIKE decides: near the matches, not every role times every path."""
    n = 400
    i = spark.range(n).select(F.concat(F.lit("i-"), "id").alias("instance_id"), F.lit("a").alias("account_id"), F.lit("running").alias("instance_state"),
                              F.concat(F.lit("arn/Role-"), F.format_string("%05d", F.col("id") * 17), F.lit("-x")).alias("iam_instance_profile"))
    r = spark.range(n).select(F.lit("a").alias("account_id"), F.concat(F.lit("arn:role/Role-"), F.format_string("%05d", F.col("id") * 17), F.lit("-x")).alias("source_arn"))
    kept = R.substring_match
    try:
        R.substring_match = lambda text, pattern: text.isNotNull() & pattern.isNotNull()
        met = E.role_arn_pairs(i, r).count()
    finally:
        R.substring_match = kept
    assert E.role_arn_pairs(i, r).count() == n and met < n * n / 10


def test_plan_is_an_equi_join_on_a_trigram(spark):
    i, r = tables(spark, 1)
    plan = E.role_risk_matches(i, r, "trigram")._jdf.queryExecution().optimizedPlan().toString()
    assert "_gram" in plan and "Cartesian" not in plan
    joins = [x for x in plan.split("\n") if "Join Inner" in x and "_gram" in x]
    assert joins, plan
