"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over the words of
a text; each model also sees the log-odds of the categories before it.  While
training, those earlier probabilities are predicted out of fold, so a later model
learns from probabilities as good as it will meet in texts that nobody labelled.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillwork.llm.common import add_columns

#: Labelled texts (about) that the models are fitted on, and folds.
TRAIN_ROWS = 4_000
FOLDS = 4
#: A word counts as a feature if its share differs between the classes by so many standard errors; most features.
LEAST_SCORE = 5.0
MOST_FEATURES = 500
LEAST_TEXTS = 5
ROUNDS, PENALTY = 300, 1e-3

#: Lengths in bytes of the beginnings of longer words that are features too.
BEGINNINGS = (5, 6, 7, 8)
#: Everything in ASCII that is no letter or digit separates words.
BLANKED = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def vocabulary(text: bytes | None) -> set[bytes]:
    """The different words of a whole text in lower case (A to Z), and beginnings of words, marked."""
    words = set((text or b"").lower().translate(BLANKED).split())
    out = set(words)
    for n in BEGINNINGS:
        out.update([b"^" + w[:n] for w in words if len(w) > n])
    return out


class Sample:
    """Labelled texts as lists of feature numbers; features of fewer than ``LEAST_TEXTS`` texts are left out."""

    def __init__(self, texts: Sequence[bytes | None]):
        counts = Counter()
        for t in texts:
            counts.update(vocabulary(t))
        self.features = sorted(f for f, n in counts.items() if n >= LEAST_TEXTS)
        self.at = {f: i for i, f in enumerate(self.features)}
        at = self.at
        self.rows = [
            np.array(sorted(at[f] for f in vocabulary(t) if f in at), dtype=np.int32) for t in texts
        ]

    def chosen(self, inside: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Features whose share of texts differs most clearly between the two classes."""
        n1, n0 = int(y.sum()), int(len(y) - y.sum())
        if not n1 or not n0:
            return np.zeros(0, dtype=np.int64)
        width = len(self.features)

        def count(rows):
            return np.bincount(np.concatenate([self.rows[i] for i in rows]), minlength=width)

        a, b = count(inside[y == 1]), count(inside[y == 0])
        p = (a + b) / (n1 + n0)
        spread = np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
        z = np.abs(a / n1 - b / n0) / spread
        order = np.lexsort((np.arange(width), -z))
        return np.sort(order[: min(MOST_FEATURES, int((z >= LEAST_SCORE).sum()))])

    def matrix(self, rows: np.ndarray, chosen: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """One column per chosen feature, one per earlier category, and a constant."""
        x = np.zeros((len(rows), len(chosen) + earlier.shape[1] + 1))
        for i, row in enumerate(rows):
            x[i, np.flatnonzero(np.isin(chosen, self.rows[row], assume_unique=True))] = 1.0
        x[:, len(chosen) : -1] = earlier
        x[:, -1] = 1.0
        return x


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by accelerated gradient steps."""
    w = v = np.zeros(x.shape[1])
    # Largest eigenvalue of x'x / n bounds the curvature; a few power steps find it.
    u = np.ones(x.shape[1])
    for _ in range(20):
        u = x.T @ (x @ u) / len(x)
        u /= np.linalg.norm(u)
    step = 1 / (0.25 * 1.1 * float(u @ (x.T @ (x @ u))) / len(x) + PENALTY)
    for i in range(ROUNDS):
        gradient = x.T @ (sigmoid(x @ v) - y) / len(x) + PENALTY * np.append(v[:-1], 0.0)
        new = v - step * gradient
        v = new + i / (i + 3) * (new - w)
        w = new
    return w


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The probability above which a text counts as positive: best F1 of the predictions."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(len(y)) + 1 + max(y.sum(), 1))
    # Only between different probabilities can a limit lie.
    last = np.append(np.diff(p[order]) != 0, True)
    k = int(np.where(last, f1, -1).argmax())
    low = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + low) / 2)


def train_chain(
    texts: Sequence[bytes | None], labels: np.ndarray, folds: np.ndarray, names: Sequence[str]
) -> list[dict]:
    """The chain's models; ``labels`` has a column per category in the chain's order."""
    sample, every = Sample(texts), np.arange(len(texts))
    chain = []
    earlier = np.zeros((len(texts), 0))
    for k, name in enumerate(names):
        y = labels[:, k].astype(float)
        out_of_fold = np.zeros(len(texts))
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
            if not len(outside) or not len(inside):
                continue
            chosen = sample.chosen(inside, y[inside])
            w = fit(sample.matrix(inside, chosen, earlier[inside]), y[inside])
            out_of_fold[outside] = sigmoid(sample.matrix(outside, chosen, earlier[outside]) @ w)
        chosen = sample.chosen(every, y)
        w = fit(sample.matrix(every, chosen, earlier), y) if len(texts) else np.zeros(k + 1)
        chain.append(
            {
                "name": name,
                "words": {sample.features[i].decode("latin-1"): float(c) for i, c in zip(chosen, w)},
                "earlier": [float(c) for c in w[len(chosen) : -1]],
                "constant": float(w[-1]),
                "limit": best_limit(out_of_fold, y) if len(texts) else 1.0,
            }
        )
        earlier = np.column_stack([earlier, log_odds(out_of_fold)])
    return chain


def train(docs: DataFrame, labels: DataFrame, names: Sequence[str], id: str, text: str) -> list[dict]:
    """Fit the chain on about ``TRAIN_ROWS`` labelled documents, chosen by a hash of the id.

    ``labels`` has the id and a 0/1 column per category; rows with a null are left
    out.  The sample is bounded, so one task fits the models; what reaches the
    driver is at most ``MOST_FEATURES`` weights per category.
    """
    full = labels.dropna(subset=[id, *names])
    share = min(1.0, TRAIN_ROWS / max(full.count(), 1))
    drawn = F.pmod(F.xxhash64(F.lit(1), F.col(id)), F.lit(1 << 30)) < int((1 << 30) * share)
    sample = full.filter(drawn).select(F.col(id).alias("_id"), *[F.col(n).cast("int").alias(f"_{i}") for i, n in enumerate(names)])
    # The sample is bounded by ``TRAIN_ROWS``.
    rows = docs.select(F.col(id).alias("doc"), F.col(text).cast("binary").alias("text")).join(
        F.broadcast(sample), F.col("doc") == F.col("_id")
    )

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table["doc"]), kind="stable")
        texts = [table["text"][int(i)].as_py() for i in order]
        y = np.column_stack([np.array(table[f"_{i}"])[order] for i in range(len(names))])
        folds = np.arange(len(order)) % FOLDS
        return pa.table({"chain": [json.dumps(train_chain(texts, y, folds, list(names)))]})

    made = rows.groupBy(F.lit(0).alias("one")).applyInArrow(run, "chain string").collect()
    if made:
        return json.loads(made[0].chain)
    return train_chain([], np.zeros((0, len(names))), np.zeros(0), names)


def score(df: DataFrame, chain: list[dict], text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``p_<category>`` and ``is_<category>`` for every category of the chain.

    Whole texts are scored; null and empty texts have no words and get the
    probabilities of the constants; repeated rows score alike; an empty table stays
    empty; input columns with the names of new ones are replaced.
    """
    fields: list[tuple[str, T.DataType]] = []
    for m in chain:
        fields += [(f"p_{m['name']}", T.DoubleType()), (f"is_{m['name']}", T.BooleanType())]

    def make():
        models = [
            ({w.encode("latin-1"): c for w, c in m["words"].items()}, m["earlier"], m["constant"], m["limit"])
            for m in chain
        ]
        wanted = set().union(*[m[0].keys() for m in models])

        starts = {n: {w[1:] for w in wanted if w[:1] == b"^" and len(w) == n + 1} for n in BEGINNINGS}

        def row(value):
            words = set((value or b"").lower().translate(BLANKED).split())
            here = words & wanted
            for n, known in starts.items():
                if known:
                    here |= {b"^" + w for w in {w[:n] for w in words if len(w) > n} & known}
            here = sorted(here)
            odds, out = [], []
            for weights, earlier, constant, limit in models:
                z = constant + sum(weights.get(w, 0.0) for w in here) + sum(a * b for a, b in zip(earlier, odds))
                p = float(sigmoid(z))
                odds.append(float(log_odds(np.float64(p))))
                out += [p, p > limit]
            return tuple(out)

        return row

    return add_columns(df, [text], fields, make, [] if keep_text else [text])
