"""Property checks named in SURVEY §5: the R-5 rewrite equals the naive plan,
and the LIKE fast path equals LIKE."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlens.functions.scalar import like_substring, profile_role, risk_score, substring_match
from chainlens.operators import correlate as E
from chainlens.sources import adapters as A
from tests.conftest import SF_MID

ALPHABET = "ab_%-1\\\\"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(ALPHABET, max_size=6), st.one_of(st.none(), st.text(ALPHABET, max_size=3))),
                min_size=1, max_size=20))
def test_substring_match_equals_like(spark, pairs):
    df = spark.createDataFrame(pairs, "t string, p string")
    safe = df.where(~F.col("p").contains("\\") | F.col("p").isNull())   # LIKE rejects a dangling escape
    a = safe.select(substring_match("t", "p").alias("x")).collect()
    b = safe.select(like_substring("t", "p").alias("x")).collect()
    assert a == b


def test_rewrite_equals_naive_plan(spark):
    """The reference's join order (findings and CVEs first, LIKE join last) gives
    the same chains as the rewritten plan."""
    i, f, c, r = A.load(spark, SF_MID, "instances", "findings", "cves", "iam_risks")
    ii = i.where(F.col("instance_state") == "running").alias("i")
    ff = f.where(F.col("status") == "FAIL").alias("p")
    cc = c.where((F.col("status") == "OPEN") & F.col("severity").isin("CRITICAL", "HIGH")).alias("t")
    rr = r.alias("r")
    naive = (ii.join(ff, F.col("p.resource_arn") == F.col("i.resource_arn"))
             .join(cc, F.col("t.instance_id") == F.col("i.instance_id"))
             .join(rr, (F.col("r.account_id") == F.col("i.account_id"))
                   & like_substring(F.col("r.source_arn"), profile_role(F.col("i.iam_instance_profile"))), "left"))
    naive = naive.select(
        F.col("i.instance_id"), F.col("p.check_title"), F.col("t.cve_id"), F.col("t.package_name"),
        F.col("r.path"),
        risk_score(F.col("t.cvss_score"), F.col("p.severity"), F.col("r.severity"), F.col("i.public_ip")).alias("s"))
    fast = E.attack_chains(i, f, c, r).select(
        "instance_id", F.col("misconfiguration").alias("check_title"), "cve_id", "package_name",
        F.col("escalation_path").alias("path"), F.col("risk_score").alias("s"))
    assert naive.exceptAll(fast).count() == 0 and fast.exceptAll(naive).count() == 0
    assert fast.count() == 8964


KEYS = st.sampled_from(["a", "b", "c", None])
ROW = st.tuples(KEYS, st.sampled_from(["FAIL", "PASS"]), st.sampled_from(["LOW", "HIGH"]), st.text("xy", max_size=2))


@settings(max_examples=10, deadline=None)
@given(st.lists(ROW, max_size=8), st.lists(ROW, max_size=8), st.sampled_from([["a"], ["a", "b"], ["c"]]))
def test_upsert_split_and_strategy_invariance(spark, cur_rows, batch_rows, first_keys):
    """Upserting a batch in two parts that split it by key equals upserting it
    whole, applying it twice equals applying it once, and both strategies
    agree (SURVEY §5 property tests).  A split that puts rows of one new key in
    both parts is not invariant: the first part inserts the key, so its kept
    columns come from the first part, as two separate scans would do."""
    from chainlens import schemas as SCH
    from chainlens.operators.upsert import dedup_last, upsert

    schema = "account_id string, resource_arn string, check_id string, status string, severity string, " \
             "check_title string, ingested_at timestamp"
    cur = spark.createDataFrame([("A", k, "c", s, v, t, None) for k, s, v, t in cur_rows], schema)
    cur = dedup_last(cur.withColumn("_o", F.monotonically_increasing_id()),
                     ["account_id", "resource_arn", "check_id"], "_o").drop("_o")
    bat = spark.createDataFrame([(i, "A", k, "c", s, v, t) for i, (k, s, v, t) in enumerate(batch_rows)],
                                "_seq long, account_id string, resource_arn string, check_id string, status string, "
                                "severity string, check_title string")

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    whole = upsert(cur, bat, SCH.FINDINGS_SPEC, as_of="2021-01-01 00:00:00")
    in_first = F.col("resource_arn").isin(*first_keys)
    parts = upsert(upsert(cur, bat.where(in_first), SCH.FINDINGS_SPEC, as_of="2021-01-01 00:00:00"),
                   bat.where(~in_first | F.col("resource_arn").isNull()), SCH.FINDINGS_SPEC,
                   as_of="2021-01-01 00:00:00")
    touched = upsert(cur, bat, SCH.FINDINGS_SPEC, as_of="2021-01-01 00:00:00", strategy="touched")
    keyed = bat.where(F.col("resource_arn").isNotNull())
    twice = upsert(upsert(cur, keyed, SCH.FINDINGS_SPEC, as_of="2021-01-01 00:00:00"), keyed, SCH.FINDINGS_SPEC,
                   as_of="2021-01-01 00:00:00")
    once = upsert(cur, keyed, SCH.FINDINGS_SPEC, as_of="2021-01-01 00:00:00")
    assert rows(whole) == rows(parts) == rows(touched)
    assert rows(twice) == rows(once)
