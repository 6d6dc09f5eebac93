"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (elastic net)
and calibrated with a temperature.

Document frequencies are counted over every training document, one fixed-size
vector per task, added up in slices.  The weights are fitted on a bounded
sample (about ``per_label`` labelled documents of each language, by a hash of
doc_id and text; a fifth of it is kept for the temperature), in one task, from feature vectors of
fixed size.  Prediction reads every whole text where it lies.

Defined results: null or letterless text gives ``und`` with score 0; documents
with null lang are never learned from; ties between languages go to the first
in code-point order; an empty training set predicts ``und`` everywhere; only
the text is an input of a prediction, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlens.llm.common import by_value

by_value(__name__)

BITS = 15
DIM = 1 << BITS
SLICES = 16
#: Code points of a text that are hashed at a time; every text is read whole.
CHUNK = 1 << 20


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed character n-grams, n = 1, 2, 3, of the lower-cased text."""
    counts = np.zeros(DIM, dtype=np.int32)
    low = text.lower()
    for at in range(0, len(low), CHUNK):
        c = np.frombuffer(low[max(0, at - 2):at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        seen = min(at, 2)  # code points of the chunk before
        h1 = c * np.uint32(0x9E3779B1)
        h2 = (h1[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
        h3 = (h2[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        for h in (h1[seen:], h2[max(0, seen - 1):], h3):
            counts += np.bincount(h >> np.uint32(32 - BITS), minlength=DIM).astype(np.int32)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each feature) over all rows; the driver gets
    one number per feature."""
    def count(batches):
        df, n = np.zeros(DIM, dtype=np.int64), 0
        for b in batches:
            for t in b.column(0):
                t = t.as_py()
                if has_letter(t):
                    df += ngram_counts(t) > 0
                    n += 1
        part = df.reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "n": pa.array([n] * SLICES, pa.int64()),
                                          "df": pa.array([x.tobytes() for x in part], pa.binary())})

    def add(batches):
        total = {}
        for b in batches:
            for s, n, x in zip(*(c.to_pylist() for c in b.columns)):
                m, y = total.get(s, (0, 0))
                total[s] = (m + n, y + np.frombuffer(x, dtype=np.int64))
        if total:
            yield pa.RecordBatch.from_pydict({"slice": pa.array(list(total), pa.int32()), "n": pa.array([v[0] for v in total.values()], pa.int64()),
                                              "df": pa.array([v[1].tobytes() for v in total.values()], pa.binary())})

    kind = "slice int, n long, df binary"
    rows = texts.select("text").mapInArrow(count, kind).repartition(SLICES, "slice").mapInArrow(add, kind).collect()
    df = np.zeros((SLICES, DIM // SLICES), dtype=np.int64)
    for r in rows:
        df[r.slice] = np.frombuffer(bytes(r.df), dtype=np.int64)
    return max((r.n for r in rows), default=0), df.ravel()


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and unit-length values of log-scaled counts times idf."""
    i = np.flatnonzero(counts)
    v = np.log1p(counts[i]) * idf[i]
    norm = np.sqrt((v ** 2).sum())
    return i, v / norm if norm else v


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(xs: list, ys: np.ndarray, classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 1e-3, seed: int = 5) -> np.ndarray:
    """Weights (classes x DIM + bias column) by FTRL-proximal over the documents in hashed order."""
    z = np.zeros((classes, DIM + 1))
    n = np.zeros_like(z)
    rng = np.random.default_rng(seed)

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for d in rng.permutation(len(xs)):
            i, v = xs[d]
            i, v = np.append(i, DIM), np.append(v, 0.1)
            zi, ni = z[:, i], n[:, i]
            w = weights(zi, ni)
            p = softmax(w @ v)
            p[ys[d]] -= 1
            g = p[:, None] * v[None, :]
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[:, i] = zi + g - sigma * w
            n[:, i] = ni + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, ys: np.ndarray) -> float:
    """The temperature of least log loss (golden-section search on its logarithm)."""
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(ys)), ys] + 1e-300).mean()
    lo, hi, g = np.log(0.01), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(labelled: DataFrame, per_label: int = 2000) -> dict | None:
    """Fit on rows (text, lang).  None if there is nothing to learn from.
    doc_id, where there is one, only spreads the sample over equal texts."""
    place = F.col("doc_id") if "doc_id" in labelled.columns else F.lit(0)
    labelled = labelled.where(F.col("lang").isNotNull()).select("text", "lang", place.alias("place"))
    n, df = document_frequencies(labelled)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    # about per_label rows of every language, by a hash of the row: no row moves for it
    lettered = labelled.where(F.col("text").rlike(r"\p{L}"))
    # (share has one row per language, as the model itself has)
    share = lettered.groupBy("lang").agg((F.lit(float(per_label)) / F.count("*")).alias("share"))
    spot = F.pmod(F.xxhash64("place", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = lettered.join(F.broadcast(share), "lang").where(spot < F.col("share"))

    def features(batches):
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1)):
                i, v = tfidf(ngram_counts(t.as_py()), idf)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang.as_py()]), "i": pa.array([i.astype(np.int32).tobytes()], pa.binary()),
                                                  "v": pa.array([v.astype(np.float32).tobytes()], pa.binary())})

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "v"], kind="stable")
        langs = sorted(rows.lang.unique(), key=lambda s: s.encode())
        ys = rows.lang.map({x: k for k, x in enumerate(langs)}).to_numpy()
        xs = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32).astype(float)) for i, v in zip(rows.i, rows.v)]
        kept = np.random.default_rng(11).random(len(xs)) < 0.2
        if kept.all() or not kept.any():
            kept[:] = False
        w = fit_ftrl([x for x, k in zip(xs, kept) if not k], ys[~kept], len(langs))
        t = 1.0
        if kept.any():
            logits = np.array([w[:, i] @ v + 0.1 * w[:, DIM] for (i, v), k in zip(xs, kept) if k])
            t = fit_temperature(logits, ys[kept])
        return pd.DataFrame({"langs": [langs], "w": [w.astype(np.float64).tobytes()], "t": [t]})

    vectors = sample.select("text", "lang").mapInArrow(features, "lang string, i binary, v binary").withColumn("all", F.lit(0))
    model = vectors.groupBy("all").applyInPandas(lambda rows: fit(rows[["lang", "i", "v"]]), "langs array<string>, w binary, t double").first()
    if model is None:
        return None
    w = np.frombuffer(bytes(model.w), dtype=np.float64).reshape(len(model.langs), DIM + 1)
    return {"langs": list(model.langs), "w": w, "t": model.t, "idf": idf}


def _answers(texts, m: dict | None) -> tuple[list[str], list[float]]:
    """(language, probability) of every text of an Arrow column."""
    pred, score = [], []
    for t in texts:
        t = t.as_py()
        if m is None or not has_letter(t):
            pred.append("und"), score.append(0.0)
            continue
        i, v = tfidf(ngram_counts(t), m["idf"])
        p = softmax((m["w"][:, i] @ v + 0.1 * m["w"][:, DIM]) / m["t"])
        k = int(p.argmax())
        pred.append(m["langs"][k]), score.append(float(p[k]))
    return pred, score


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with lang_pred and score (calibrated probability of the
    predicted language); columns of these names are replaced."""
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    kind = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: languages x features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = _answers(b.column(at), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "score"])
    return docs.mapInArrow(run, kind)


def accept(docs: DataFrame, model: dict | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all its columns) whose language is told with a
    probability of at least ``least``; texts without letters go."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = _answers(b.column(at), shared.value)
            yield b.filter(pa.array([p != "und" and s >= least for p, s in zip(pred, score)], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, is_training: Column, per_label: int = 2000) -> DataFrame:
    """Learn from the rows where ``is_training`` holds, predict all rows."""
    return predict(docs, train(docs.where(is_training), per_label))
