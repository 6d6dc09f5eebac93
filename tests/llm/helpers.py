"""Small corpora with planted cases, and brute-force statements of the operators."""

import random

WORDS = [f"w{i}x" for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside, as extra columns of an input.
CLASHING = ["row", "node", "label", "run", "bucket", "start", "size", "group", "sim", "score", "lang_pred", "removed", "part", "target",
            "kept_id", "kept_hash", "kept_hash_", "kept_place_", "gone_", "gone_id", "gone_hash", "gone_copy", "line_hash_", "line_copy_", "own_id", "doc"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars) rows: prose, exact and near copies,
    shared passages, null, empty and blank texts, one very long text."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(3, 120)) for _ in range(n)]
    passage = prose(rng, 30)
    for i in range(0, n, 7):
        texts[i] = texts[i] + "\n" + passage + "\n" + prose(rng, 4)
    base = prose(rng, 200)
    for _ in range(6):  # near copies: one word of 200
        words = base.split()
        words[rng.randrange(200)] = "changed"
        texts.append(" ".join(words))
    texts += [texts[3], texts[3], texts[3].upper(), None, "", " \n\t ", "one", "one", prose(rng, 9000), "a\nb\na"]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    rows.append((None, "no id here at all", None, None, 17))
    rng.shuffle(rows)
    return rows


def with_clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("extra") for c in CLASHING})
