"""op11, op12 and op13: brute force on small inputs, edge cases, digests."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlens.llm import queries, runs, secrets, whitening
from tests.llm.helpers import SCHEMA, corpus, with_clashing

# --- op11 --------------------------------------------------------------------------------------


def all_runs(words):
    """Every maximal repetition by comparing each distance, smallest period only."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def longest_lyndon(s):
    """The length of the longest Lyndon word at each place: up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


unit = st.lists(st.integers(0, 2), min_size=1, max_size=5)
texts = st.lists(st.tuples(unit, st.integers(1, 9)), max_size=5).map(lambda us: [x for u, k in us for x in u * k])


@given(texts)
@settings(max_examples=400, deadline=None)
def test_lyndon_lengths_and_runs_match_brute_force(s):
    assert runs.lyndon_lengths(s, 3) == longest_lyndon(s)
    assert runs.lyndon_lengths([2 - x for x in s], 3) == longest_lyndon([2 - x for x in s])
    assert runs.find_runs([f"w{x}" for x in s]) == all_runs(s)


def test_runs_of_long_texts():
    rng = random.Random(3)
    base = [f"v{rng.randrange(3000)}" for _ in range(4000)]
    assert runs.find_runs(base * 5) == [(0, 20000, 4000)]
    assert runs.find_runs(["x"] * 50000) == [(0, 50000, 1)]
    fib, nxt = ["a"], ["a", "b"]
    while len(nxt) < 2000:
        fib, nxt = nxt, nxt + fib
    assert runs.find_runs(nxt[:300]) == all_runs(nxt[:300])
    assert runs.find_runs((["a", "b", "a"] * 3 + ["c"]) * 6) == all_runs((["a", "b", "a"] * 3 + ["c"]) * 6)


def test_a_chain_of_cuts_is_given_up_without_losing_runs():
    s = []  # each word holds the next one together: a pass cuts one word
    for k in range(200):
        s += [k, k + 1, k, k + 1, k]
    s += ["x", "y"] * 5
    assert runs.find_runs([str(x) for x in s]) == all_runs([str(x) for x in s])


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_op11_digests(spark, tmp_path):
    rows = [r for r in corpus() if len(r[1] or "") < 5000]
    rng = random.Random(2)
    rows += [(2000 + i, " ".join(["l"] * 3 + [f"r{rng.randrange(3)}" for _ in range(3)] * rng.randrange(1, 9) + ["é ß"] * rng.randrange(9)), None, None, 0)
             for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    with_clashing(docs).write.parquet(f"{tmp_path}/documents.parquet")
    cols = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in queries.op11(spark, str(tmp_path)).select(cols).collect()), key=str)
    assert got == sorted((expected_runs(r[0], r[1]) for r in rows), key=str)
    assert sum(r[2] > 0 for r in got) > 20
    plain = runs.run_table(docs, ["doc_id", "lang"])  # no rewriting, texts kept
    for r in plain.where("doc_id >= 2000").collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        assert [tuple(x) for x in r.runs] == all_runs(text.split(" ")) and len(r.collapsed.split(" ")) <= r.n_words
    assert runs.run_digests(runs.run_table(docs.limit(0), ["doc_id"])).count() == 0


# --- op12 --------------------------------------------------------------------------------------

AKIA = "AKIA" + "Q7" * 9
MIXED = "aB3" * 9
SECRET_TEXTS = [
    None, "", "nothing to see", "token = \"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\" and so on",
    f"id {AKIA} then {MIXED} here",                                        # a weak key beside an identifier
    f"only {MIXED} here",                                                  # alone: nothing
    f"{MIXED}" + " x" * 99 + f" {AKIA}",                                   # 200 characters apart at most
    f"{MIXED}" + " x" * 99 + f"   {AKIA}",                                 # one too many
    f"see https://db.example.com/x?y user: root PassWord: hunter2secret",  # endpoint, identifier, secret
    "https://db.example.com/x user: root",                                 # no secret: none of them
    f"user = bob {MIXED}", f"é é ü user = bob\n{MIXED} https://host/{MIXED}",
    "secret=token:abcdefgh", "PASSWD='x' api-key: abcdef apikey==abcdef api_key: \"ab cdefgh\"", "toKen = abcdefgh paſsword = abcdefgh",
    "a" * 23 + " " + "b" * 24 + "G", "AKIA AKIAAKIA " + AKIA[:19] + " x" + AKIA, "token=" + AKIA,
    (f"login: u{AKIA}\n" + "word " * 30) * 200, f"{MIXED} " * 3000 + AKIA, "a1B" * 30000 + " " + AKIA,
]


def expected_spans(text, reach=200):
    """The stated rules, on all pairs of parts."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    free = list(base)
    for kind, pattern in ((3, secrets.ENDPOINT), (4, secrets.IDENT), (5, secrets.KEY)):
        new = [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.I | re.A if kind == 4 else 0)]
        if kind == 5:
            new = [x for x in new if all(re.search(c, text[x[0]:x[2]]) for c in ("[a-z]", "[A-Z]", "[0-9]"))]
        free += [x for x in new if not any(t[0] < x[2] and x[0] < t[2] for t in free)]
    role = {0: "s", 2: "s", 5: "s", 1: "i", 4: "i", 3: "e"}
    out = list(base)
    for x in free:
        if x[1] < 3:
            continue
        near = {role[o[1]] for o in free if 0 <= o[0] - x[2] <= reach or 0 <= x[0] - o[2] <= reach}
        if {"s": "i" in near or "e" in near, "i": "s" in near, "e": {"s", "i"} <= near}[role[x[1]]]:
            out.append(x)
    say = lambda spans: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return (*(sum(k == q for _, q, _ in base) for k in range(3)), hashlib.sha256(say(base).encode()).hexdigest(), say(out), len(out) - len(base))


def test_op12_brute_force_and_oracle(spark, tmp_path):
    rng = random.Random(8)
    words = ["token", "= ", ": ", AKIA, MIXED, "https://a.b/c", "user=ann", "0123456789abcdef" * 2, "plain", "\n", "é", "login", "'x'", "word " * 45]
    made = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(150)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(SECRET_TEXTS + made)] + [(3, SECRET_TEXTS[4], None, None, 0), (None, SECRET_TEXTS[4], "en", None, 1)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    with_clashing(docs).write.parquet(f"{tmp_path}/documents.parquet")
    cols = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"]
    got = sorted((tuple(r) for r in queries.op12(spark, str(tmp_path)).select(cols).collect()), key=str)
    assert got == sorted(((r[0], *expected_spans(r[1])) for r in rows), key=str)
    assert sum(r[-1] > 0 for r in got) > 30
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    said = db.sql(queries.LLM_ORACLE["op12_secret_scan"]).select(", ".join(cols)).fetchall()
    assert sorted(said, key=str) == got
    assert secrets.secret_report(secrets.find_secrets(docs.limit(0))).count() == 0


# --- op13 --------------------------------------------------------------------------------------


def test_bit_planes_give_exact_cross_products():
    rng = np.random.default_rng(4)
    for rows, dims, top in ((1, 1, 1), (63, 3, 2), (64, 2, 1 << 20), (200, 7, 1 << 31), (65, 4, 1 << 32)):
        y = rng.integers(0, top, (rows, dims)).astype(np.uint64)
        planes = whitening.bit_planes(y, 40)
        assert planes.shape == (dims, 40, -(-rows // 64))
        exact = y.astype(object).T @ y.astype(object)
        for i, row in enumerate(whitening.cross_products(y)):
            assert list(row) == list(exact[i, i:])


def vectors(seed=5, n=300, dims=6):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) + 1).astype(np.float32)
    rows = [(i, x.tolist(), i) for i, x in enumerate(v)]
    rows += [(1000, rows[0][1], 0), (0, rows[0][1], 0), (None, rows[1][1], 0)] + [(2000 + i, rows[2][1], 0) for i in range(500)]
    rows += [(3000, None, 0), (3001, [1.0] * 5 + [None], 0), (3002, [float("nan")] + [0.0] * 5, 0), (3003, [float("inf")] * 6, 0), (3004, [], 0),
             (3005, [1.0, 2.0], 0), (3006, [3e38] * 6, 0)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def test_op13_against_numpy(spark, tmp_path):
    rows = vectors()
    with_clashing(spark.createDataFrame(rows, VECTORS).drop("label")).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op13(spark, str(tmp_path)).collect()
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v, _ in rows
            if v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) and abs(x) < 1e6 for x in v)]
    fit = np.unique(np.array([x for _, x in good]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    off = fit - s / n
    e, u = np.linalg.eigh(off.T @ off / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(out) == 4 * len(good) and {r.n for r in out} == {n}
    sign = {}
    by_row = {}
    for i, x in good:
        by_row.setdefault(i, []).append(x)
    for r in out:
        x = by_row[r.vec_id][0]
        k = r.component - 1
        assert r.deviation == int(((n * x - s).astype(object) ** 2).sum())
        want = (x - s / n) @ u[:, k] / np.sqrt(e[k])
        sign.setdefault(k, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(sign[k] * want, rel=1e-8, abs=1e-9)
        assert r.explained == pytest.approx(e[k] / e.sum(), rel=1e-9) and r.identity_error < 1e-9
    assert sorted(str(r.vec_id) for r in out) == sorted(str(i) for i, _ in good for _ in range(4))


def test_whitening_edge_cases(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(make([(1, [1.0, 2.0])] * 3)).count() == 0          # no variance
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make([]).limit(0)).count() == 0
    two = whitening.whiten(make([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])]))  # rank one
    got = two.collect()
    assert {r.component for r in got} == {1} and len(got) == 4 and got[0].n == 3 and got[0].explained == pytest.approx(1.0)
    assert sorted(round(abs(r.whitened), 6) for r in got) == [0.0, 0.0, *[round(1.5 ** 0.5, 6)] * 2]
    wide = whitening.whiten(make([(1, [8e6, 0.0]), (2, [-8e6, 1.0]), (3, [7e6, 2.0])]), components=2).collect()  # deviation beyond a long
    assert all(r.deviation is None or r.deviation == int(r.deviations) for r in wide) and all(r.deviations for r in wide)
    with pytest.raises(ValueError):
        whitening.fit(make([(1, [1.0])]).select(F.col("embedding").alias("x")), whitening.MOST_DIMENSIONS + 1, 4)
