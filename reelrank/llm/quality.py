"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text (counts, lengths, shares, repetition) are cut into at most 64 bins by the
quantiles of the training sample. Trees of a fixed depth are grown level by level from histograms of
gradients and flattened into arrays (feature, cut, leaf value), so numpy walks a batch through all
trees at once. The fit sees at most ``SAMPLE`` labelled documents, those of least id hash; the scores
are computed where the documents lie.

Defined results: a null text is an empty one and is scored like any other. Labels without doc_id or
quality are ignored; of several labels of a document the lowest counts. Without labels, or with labels
of one class only, the score is that class's smoothed share. Repeated documents are repeated rows.
Extra columns are ignored, never inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import in_small_batches

#: Bound of the fit: labelled documents used.
SAMPLE = 20_000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
SMOOTHING = 5.0
#: Documents that score below are rejected.
ACCEPT = 0.3

_BYTE = np.arange(256)
_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_STOP = np.isin(_BYTE, [ord(c) for c in ".,;:!?'\"()-"])
_WIDE = _BYTE >= 128
_MARK = ~(_LETTER | _DIGIT | _SPACE | _STOP | _WIDE)
_CLASSES = np.stack([_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _WIDE, _MARK]).astype(float)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.bincount(raw, minlength=256).astype(float)
    size = max(1.0, counts.sum())
    shares = counts[counts > 0] / size
    words, lines = text.split(), text.split("\n")
    n, lens = max(1, len(words)), np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    seen = Counter(words)
    line_lens = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    common = sum(c for _, c in seen.most_common(5))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        float(lens.mean()) if words else 0.0,
        float(lens.std()) if words else 0.0,
        float(lens.max(initial=0)),
        len(seen) / n,
        len(seen) / n**0.7,
        max(seen.values(), default=0) / n,
        common / n,
        sum(map(eq, words, words[1:])) / n,
        sum(1 for c in seen.values() if c == 1) / n,
        *(_CLASSES @ counts / size),
        float(-(shares * np.log2(shares)).sum()) if len(raw) else 0.0,
        float(shares.max(initial=0)),
        float(line_lens.mean()),
        float(line_lens.std()),
        float(np.log1p(line_lens.max())),
        len(set(lines)) / len(lines),
        sum(l[-1:] in ".!?" for l in lines) / len(lines),
        sum(l[:1] in "-*|#<{[" for l in lines) / len(lines),
        counts[ord(".")] / n,
        counts[ord(",")] / n,
        counts[ord("|")] / n,
        sum(w[:1].isupper() for w in words) / n,
        sum(w.isupper() for w in seen) / max(1, len(seen)),
        sum(not w.isalpha() for w in seen) / max(1, len(seen)),
    ]


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), -1)


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node i of tree t sends x right where x[feature[t, i]] > cut[t, i]."""

    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-margin))


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, trees: int = TREES, rate: float = RATE) -> Trees:
    """Fit by Newton boosting of the logistic loss on binned features."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        none = np.zeros((0, inner))
        return Trees(base, none.astype(np.int64), none, np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, width = binned.shape
    places = binned + np.arange(width) * BINS
    margin = np.full(n, base)
    out = Trees(base, np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            wide = 2**level
            first = wide - 1
            at = ((node - first)[:, None] * (width * BINS) + places).ravel()
            g, h = (
                np.bincount(at, np.repeat(v, width), wide * width * BINS).reshape(wide, width, BINS).cumsum(axis=2)
                for v in (gradient, hessian)
            )
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + SMOOTHING) + (g_all - g) ** 2 / (h_all - h + SMOOTHING) - g_all**2 / (h_all + SMOOTHING)
            gain[(h < 1.0) | (h_all - h < 1.0)] = 0
            flat = gain.reshape(wide, -1)
            for k, place in enumerate(flat.argmax(axis=1)):
                f, b = divmod(int(place), BINS)
                if flat[k, place] > 1e-6 and b < len(edges[f]):
                    out.feature[t, first + k], out.cut[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t][node]] > out.cut[t][node])
        node -= inner
        g, h = np.bincount(node, gradient, inner + 1), np.bincount(node, hessian, inner + 1)
        out.leaf[t] = -rate * g / (h + SMOOTHING)
        margin += out.leaf[t][node]
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for ``labels`` (doc_id, quality) of ``docs`` (doc_id, text), from at most ``sample`` documents."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows, so the texts need not move.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def measured(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": list(_matrix(batch["text"]))})

    # A doc_id that many rows repeat still gives one training row.
    found = in_small_batches(rows).mapInPandas(measured, "doc_id long, label double, x array<double>")
    found = found.groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("doc_id", "r.*").toPandas()
    found = found.sort_values("doc_id", ignore_index=True)
    width = len(statistics(""))
    return grow(np.array(found["x"].tolist(), dtype=float).reshape(-1, width), found["label"].to_numpy(dtype=float))


def scorer(trees: Trees) -> Callable[[Column], Column]:
    """A column function: text -> score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(trees.score(_matrix(texts)))

    return score


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


__all__ = ["Trees", "fit", "grow", "held_out", "scorer", "statistics"]
