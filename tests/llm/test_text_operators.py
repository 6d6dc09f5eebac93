"""op1, op2, op3, op8 against brute force on a small corpus with planted cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chainlens.llm import line_dedup, lm_score, near_dedup, suffix_dedup
from tests.llm.helpers import SCHEMA, corpus, with_clashing


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return with_clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5).cache()


def tokens(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["<end> "]


def test_lm_base_score_exact_and_model_normalised(spark, rows, docs):
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    out = lm_score.score_documents(docs, train).collect()
    learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    count = Counter(w for i, t, *_ in rows if learns(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t, *_ in rows:
        tk = tokens(t)
        want[i, len(tk), sum(count[w] > 0 for w in tk), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tk), 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in out)
    # the near copies' pairs are in the model: it must beat the unigram base on them by far
    by_id = {r.doc_id: r for r in out}
    copies = [i for i, t, *_ in rows if t and t.count("changed") and learns(i)]
    assert copies and all(by_id[i].score > 0.5 * by_id[i].base_score for i in copies)


def test_lm_counts_read_back_from_the_filter():
    import numpy as np

    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2 ** 63, 5000).astype(np.uint64)
    counts = rng.integers(1, 10_000, 5000)
    q = lm_score.levels(counts)
    size, body = lm_score.segment(keys, q)
    bits = np.frombuffer(body, np.uint8)
    read = lm_score.probe(bits, size, keys)
    assert (read >= q).all() and (read == q).mean() > 0.8  # never less, and rarely by more than a level
    assert (read - q).mean() < 0.25
    other = rng.integers(0, 2 ** 63, 5000).astype(np.uint64)
    assert (lm_score.probe(bits, size, other) > 0).mean() < 0.01
    ratio = lm_score.level_count(q) / counts
    assert ratio.min() > 0.84 and ratio.max() < 1.19


def model_scores(rows, learns):
    """The stated model with exact counts in place of probes: no filter, no segments."""
    word, pair, taken = Counter(), Counter(), Counter()
    for i, t, *_ in rows:
        if learns(i):
            tk = tokens(t)
            word.update(tk)
            pair.update(zip(["<end> ", *tk], tk))
    held = lambda c: 2 ** ((1 + math.floor(2 * math.log2(c) + 1e-9) - 0.5) / 2) if c else 0.0
    z = sum(map(held, word.values())) + len(word) + 1
    for (a, _), c in pair.items():
        taken[a] += held(c) - 0.75
    out = []
    for i, t, *_ in rows:
        total, before = 0.0, "<end> "
        for w in tokens(t):
            share = min(taken[before] / held(word[before]), 0.99) if taken[before] else 0.0
            gain = share / taken[before] if taken[before] else 0.0
            p = gain * max(held(pair[before, w]) - 0.75, 0) + (1 - share) * (held(word[w]) + 1) / z
            total += math.log10(min(p, 1.0))
            before = w
        out.append((str(i), len(tokens(t)), total))
    return sorted(out)


@pytest.mark.parametrize("broadcast_bytes", [0, lm_score.BROADCAST_BYTES])
def test_lm_scores_are_the_stated_model_on_all_pairs(spark, rows, broadcast_bytes, monkeypatch):
    """With a filter that hardly ever errs; probes sent to segments, and segments broadcast."""
    monkeypatch.setattr(lm_score, "ROOM", 200)
    some = [r for r in rows if len(r[1] or "") < 20000] + [(500 + k, "the the " * k + "w1x the w2x", None, None, 0) for k in range(40)]  # a word of a large share
    docs = spark.createDataFrame(some, SCHEMA).repartition(3)
    learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    got = lm_score.score_documents(docs, train, broadcast_bytes).collect()
    got, want = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got), model_scores(some, learns)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-5, abs=1e-5)  # weights are kept in single precision


def test_lm_both_ways_agree_to_the_last_bit(spark, docs):
    sort = lambda b: sorted(map(str, lm_score.score_documents(docs, F.lit(True), b).collect()))
    assert sort(0) == sort(1 << 30)


def test_lm_empty_table_and_no_training(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.score_documents(empty, F.lit(True)).count() == 0
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in lm_score.score_documents(some, F.lit(False)).collect()}
    assert out[1].n_tokens == 3 and out[2].n_tokens == 1 and out[1].n_known == 0 and out[1].train_tokens == 0 and out[1].base_score == 0


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4)))


def test_near_dedup_groups_equal_brute_force(spark, rows, docs):
    out = near_dedup.find_groups(docs).collect()
    assert len(out) == len(rows)
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if len(x & y) / len(x | y) >= 0.8:
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(sets)):
        groups[root(k)].append(sets[k][0])
    want = Counter()
    for g in groups.values():
        least = min((i for i in g if i is not None), default=None)
        for i in g:
            want[i, least, len(g)] += 1
    assert Counter((r.doc_id, r.group_id, r.group_size) for r in out) == want
    assert sum(r.kept for r in out) == len(groups)
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_prob_minhash_estimates_probability_jaccard():
    import numpy as np

    rng = np.random.default_rng(4)
    common, a, b = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (300, 60, 90))
    sa, sb = np.sort(np.r_[common, a]), np.sort(np.r_[common, b])
    wa, wb = rng.integers(1, 4, len(sa)).astype(float), rng.integers(1, 4, len(sb)).astype(float)
    exact, plain = near_dedup.similarity(sa, wa, sb, wb)
    # the definition, term by term
    da, db = dict(zip(sa.tolist(), wa)), dict(zip(sb.tolist(), wb))
    want = sum(1 / sum(max(da.get(y, 0) / da[x], db.get(y, 0) / db[x]) for y in set(da) | set(db)) for x in set(da) & set(db))
    assert abs(exact - want) < 1e-9 and abs(plain - 300 / 450) < 1e-9
    agree = []
    for k in range(30):  # relabel the elements for fresh processes
        turn = lambda s: near_dedup.mixed(s + np.uint64(k * 7919 + 1))
        doc = np.r_[np.zeros(len(sa), int), np.ones(len(sb), int)]
        who = near_dedup.signatures(doc, np.r_[turn(sa), turn(sb)], np.r_[wa, wb], 2)
        agree.append((who[0] == who[1]).mean())
    assert abs(np.mean(agree) - exact) < 0.03


def test_near_dedup_links_beside_the_first_class(spark):
    # a chain in one band: the first is near neither of the two others, which are near each other
    import random

    rng = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    x, y = list(words), list(words)
    for k in range(0, 300, 14):
        x[k] = f"x{k}"  # about 0.64 from the first
    y = list(x)
    y[151] = "yy"
    texts = [" ".join(words), " ".join(x), " ".join(y), " ".join(rng.choice(words) for _ in range(50))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.group_id for r in near_dedup.find_groups(docs).collect()}
    assert out == {0: 0, 1: 1, 2: 1, 3: 3}


def test_near_dedup_band_of_texts_below_the_threshold(spark, monkeypatch):
    # texts that share bands, each but 0.6 or so from the others; a few have a near copy of their own
    import random

    rng = random.Random(21)
    base = [f"v{i}" for i in range(240)]
    texts, n = [], 150
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(240), 6):
            words[k] = f"x{i}y{k}"
        texts.append(" ".join(words))
    for i in range(0, n, 15):
        words = texts[i].split()
        words[119] = f"z{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked, verify = [], near_dedup._linked
    monkeypatch.setattr(near_dedup, "_linked", lambda pairs, *more: (asked.append(pairs.count()), verify(pairs, *more))[1])
    out = {r.doc_id: r.group_id for r in near_dedup.find_groups(docs).collect()}

    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert out == {k: root(k) for k in range(len(texts))}
    assert len(set(out.values())) > n / 2
    # not all pairs, of which there are 12,720: the centres' and few more
    assert sum(asked) < 20 * len(texts)


def test_near_dedup_links_apart_from_the_centre_are_all_asked_for(spark):
    # weighted sets around a centre, each labelled on its own or with the centre
    import random

    import numpy as np

    rng = random.Random(5)
    parts, sets, labels = [], [], []
    pool = [rng.getrandbits(64) for _ in range(40)]
    for k in range(90):
        held = pool if not k else rng.sample(pool, rng.randrange(28, 41)) + [rng.getrandbits(64) for _ in range(rng.randrange(4))]
        s = np.sort(np.array(held, np.uint64))
        w = np.array([rng.choice([1, 1, 1, 5]) if k % 2 else 1 for _ in s], np.int32)
        sets.append((s, w.astype(float)))
        labels.append(k if k % 3 else 0)
        parts.append((k, len(s), bytearray(s.tobytes()), bytearray(near_dedup.pa.compress(w.tobytes(), codec="zstd", asbytes=True))))
    named = [(k % 2 + 10 * b, 0, k, labels[k]) for k in range(90) for b in range(2)] + [(1, 0, 0, 0)]
    pairs = near_dedup._apart(spark.createDataFrame(named, "band long, centre long, node long, label long"),
                              spark.createDataFrame(parts, near_dedup.SETS), 0.8).collect()
    got = {(r.a, r.b) for r in pairs}
    assert len(got) == len(pairs) and all(a < b and (a - b) % 2 == 0 and labels[a] != labels[b] for a, b in got)
    links = {(a, b) for b in range(90) for a in range(1, b) if (a - b) % 2 == 0 and labels[a] != labels[b]
             and max(near_dedup.similarity(*sets[a], *sets[b])) >= 0.8}
    assert len(links) > 20 and links <= got
    assert len(got) < 1500  # of 2,400 or so


def test_near_dedup_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dedup.find_groups(empty).count() == 0 and near_dedup.deduplicate(empty).count() == 0


def brute_repeats(rows):
    texts = [((1 << 63) - 1 if i is None else i, i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for rank, _, b in texts:
        for s in range(len(b) - 49):
            first[b[s:s + 50]] = min(rank, first.get(b[s:s + 50], rank))
    out = Counter()
    for rank, i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s:s + 50]] < rank:
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_dedup_equals_brute_force(spark, rows, docs):
    out = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == brute_repeats(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out)


def test_suffix_dedup_overlaps_zero_bytes_and_low_entropy(spark):
    a = "x" * 300
    rows = [(1, a), (2, "x" * 120 + "é" * 60), (3, "é" * 60 + "\0" * 90), (4, "\0" * 95 + "ab" * 60), (5, "ab" * 40 + "é" * 30 + "x" * 49),
            (6, "q" + "ab" * 25 + "z" + "é" * 25), (7, None), (8, "x" * 50), (9, "x" * 49)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(docs.where("doc_id < 0")).count() == 0


def test_loser_tree_merges_with_prefixes():
    import random

    rng = random.Random(5)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(50)) for _ in range(rng.randrange(0, 40))) for _ in range(7)]
    lcp = lambda x, y: next((k for k in range(50) if x[k] != y[k]), 50)
    fronts = [[0] + [lcp(r[k - 1], r[k]) for k in range(1, len(r))] if r else [] for r in runs]
    order, prefixes = suffix_dedup.merge_runs([[int.from_bytes(s, "big") for s in r] for r in runs], fronts)
    at = [0] * 7
    merged = []
    for w in order:
        merged.append(runs[w][at[w]])
        at[w] += 1
    assert merged == sorted(x for r in runs for x in r)
    assert prefixes[1:] == [lcp(x, y) for x, y in zip(merged, merged[1:])]


def norm(line):
    return " ".join(x for x in line.lower().translate({ord(c): " " for c in "\t\r\x0b\x0c"}).split(" ") if x)


def test_line_dedup_exact_and_fuzzy(spark, rows, docs):
    lines = line_dedup.duplicate_lines(docs).collect()
    occurrences = defaultdict(list)
    for k, r in enumerate(lines):
        occurrences[r.group].append(k)
    # one occurrence of each group stays, the first
    for g in occurrences.values():
        stay = [lines[k] for k in g if not lines[k].removed]
        assert len(stay) == 1
        assert min(((1 << 63) - 1 if lines[k].doc_id is None else lines[k].doc_id) for k in g) == (
            (1 << 63) - 1 if stay[0].doc_id is None else stay[0].doc_id)
    # equal normalised lines are never in two groups; the near copies are one group
    text = {i: t for i, t, *_ in rows}
    of = defaultdict(set)
    for r in lines:
        of[norm(text[r.doc_id].split("\n")[r.line_no])].add(r.group)
    assert all(len(g) == 1 for g in of.values())
    out = line_dedup.remove_lines(docs, line_dedup.duplicate_lines(docs))
    assert out.columns == docs.columns and out.count() == len(rows)
    got = out.collect()
    assert sum(r.text is None for r in got) == 1
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    left = [norm(x) for r in got if r.text for x in r.text.split("\n") if norm(x)]
    assert len(left) == len(set(left)) == len(occurrences)


def test_line_dedup_links_by_edit_similarity(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word7 ", "word7x ")
    far = " ".join(reversed(base.split()))  # the same words: equal SimHash, far in edits
    docs = spark.createDataFrame([(1, base + "\nalone"), (2, near), (3, far), (4, "")], "doc_id long, text string")
    out = {(r.doc_id, r.line_no): r for r in line_dedup.duplicate_lines(docs).collect()}
    assert out[2, 0].removed and not out[3, 0].removed and not out[1, 0].removed and not out[1, 1].removed
    assert out[1, 0].group == out[2, 0].group != out[3, 0].group
    assert line_dedup.duplicate_lines(docs.where("doc_id > 9")).count() == 0


def planted_line_pairs(spark, pairs, seed=5):
    """(kind, length): share of pairs at edit similarity 0.8 or more that are in one group."""
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    vocab = [word() for _ in range(5000)]

    def edited(kind, line):
        words = line.split()
        if kind in ("one word", "fifth of words"):
            for at in rng.sample(range(len(words)), 1 if kind == "one word" else max(1, len(words) // 5)):
                words[at] = rng.choice(vocab)
            return " ".join(words)
        out = list(line)
        for at in sorted(rng.sample(range(len(out)), max(1, int(len(out) * {"1 in 20 letters": 0.05, "1 in 10 letters": 0.1}[kind]))), reverse=True):
            out[at:at + 1] = rng.choice(([], ["q"], [out[at], "z"]))
        return "".join(out)

    cases = []
    for kind in ("one word", "fifth of words", "1 in 20 letters", "1 in 10 letters"):
        for n in (3, 6, 10, 27, 60, 100):
            for _ in range(pairs):
                a = " ".join(rng.choice(vocab) for _ in range(n))
                cases.append((len(cases), kind, n, a, edited(kind, a)))
    for kind in ("1 in 20 letters", "1 in 10 letters"):  # a script without spaces
        for _ in range(pairs):
            a = "".join(rng.choice(vocab) for _ in range(10))
            cases.append((len(cases), kind, 1, a, edited(kind, a)))
    df = spark.createDataFrame(cases, "k long, kind string, n int, a string, b string")
    norm = lambda c: F.array_join(line_dedup.line_words(F.col(c)), " ")
    most = F.floor(F.greatest(F.length(norm("a")), F.length(norm("b"))) * 0.2 + 1e-9)
    near = df.where(F.levenshtein(norm("a"), norm("b")) <= most).select("k", "kind", "n").collect()
    lines = [(2 * c[0], c[3]) for c in cases] + [(2 * c[0] + 1, c[4]) for c in cases]
    group = {r.doc_id: r.group for r in line_dedup.duplicate_lines(spark.createDataFrame(lines, "doc_id long, text string")).collect()}
    found = defaultdict(list)
    for r in near:
        found[r.kind, r.n].append(group[2 * r.k] == group[2 * r.k + 1])
    return {k: (sum(v) / len(v), len(v)) for k, v in found.items()}


def test_line_dedup_recall_against_edit_similarity(spark):
    recall = planted_line_pairs(spark, 40)
    assert all(recall["one word", n][0] >= 0.9 for n in (6, 10, 27, 60, 100))
    assert all(recall["fifth of words", n][0] >= 0.85 for n in (6, 10, 27, 60, 100))
    assert all(recall["1 in 20 letters", n][0] >= 0.85 for n in (1, 3, 6))
    assert all(recall["1 in 20 letters", n][0] >= 0.6 for n in (10, 27, 60, 100))


def test_line_dedup_lines_of_one_separator(spark, monkeypatch):
    import random

    rng = random.Random(3)
    cell = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(5, 10)))
    tables = [[cell() for _ in range(14)] for _ in range(200)]
    lines = [" | ".join(t) for t in tables] + [" | ".join([*t[:5], cell(), *t[6:]]) for t in tables[:40]]  # every second word is the separator
    words = [cell() for _ in range(40)]
    lines += [" ".join([w] * 30) for w in words] + [" ".join([w] * 20 + [w[:2] + "q" + w[3:]] + [w] * 9) for w in words]
    asked, verify = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *more: (asked.append(pairs.count()), verify(pairs, *more))[1])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    group = {r.doc_id: r.group for r in line_dedup.duplicate_lines(docs).collect()}
    assert sum(asked) < 3 * len(lines)  # with SimHashes of all occurrences every pair of table rows of like length was asked for
    assert sum(group[k] == group[200 + k] for k in range(40)) >= 36
    assert sum(group[240 + k] == group[280 + k] for k in range(40)) >= 36  # one word in 30 changed, all others the same word
    assert len({group[k] for k in range(200)}) == 200 and len({group[240 + k] for k in range(40)}) == 40


def test_simhash_equals_definition(spark, monkeypatch):
    import random

    monkeypatch.setattr(line_dedup, "LANE_WORDS", 200)  # several runs without a huge line

    rng = random.Random(1)
    texts = [[f"w{rng.randrange(50)}" for _ in range(n)] for n in (1, 2, 5, 126, 127, 253, 1000)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, words array<string>")
    hashes = {r.k: r.h for r in df.select("k", F.transform("words", lambda w: F.xxhash64(w)).alias("h")).collect()}
    got = {r.k: r.sim for r in line_dedup.simhashes(df, ["k"]).collect()}
    for k, h in hashes.items():
        want = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))
        assert got[k] == (want - (1 << 64) if want >> 63 else want)


def test_line_dedup_is_native(spark, docs):
    lines = line_dedup.line_table(docs)
    for df in (lines, line_dedup.class_table(docs, lines), line_dedup.piece_table(docs), line_dedup.duplicate_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
