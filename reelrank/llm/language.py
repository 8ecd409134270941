"""Language identification by string kernels.

A text is its lower-case letters, everything between them one space. Its grams are the stretches of 1 to ``WIDEST``
characters; a gram counts once however often it stands there (presence, blended spectrum). The kernel of two texts is
the number of grams they share over the root of the product of their numbers of grams. Grams are hashed to ``PLACES``
places. So that long and short texts compare, a text is cut into windows of at most ``WINDOW`` characters, each
overlapping the one before by a gram, and the text's features are the mean of its windows'.

Nystroem: ``LANDMARKS`` windows of labelled documents, spread evenly over the languages, stand for all texts. With K
their kernel matrix, a window's features are its kernel row times K^(-1/2). Kernel ridge regression on these features, one
language against the rest, is one linear system for all languages. A batch of windows is scored by two matrix
products: presence times landmarks, and kernel rows times weights.

The fit sees at most ``SAMPLE`` labelled documents, evenly over the languages, those of least hash; tasks send one row of
features of each to the driver. All else is computed where the documents lie. No shuffle of texts.

Defined results: a text that is null or has no letter is ``und`` with score 0. Very long texts are scored whole, window
by window. Equal scores go to the language first in order. Labelled rows without a letter teach nothing; repeated rows are
repeated samples. Without labelled rows every text is ``und`` with score 0; with one language every text with a
letter is that one. No rows: no rows. Extra columns are ignored, never inputs.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.frames import sent
from reelrank.session import materialize

#: Bounds of the fit: labelled documents used, and windows that stand for all texts.
SAMPLE = 3_000
LANDMARKS = 120
WIDEST = 4
WINDOW = 4096
PLACES = 1 << 15
RIDGE = 1e-3
#: How sharply scores become shares.
SHARPNESS = 6.0
#: Windows multiplied at once.
ROWS = 64
UNKNOWN = "und"

_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@cache
def _kinds() -> np.ndarray:
    """For every code point 2 if it is a letter, 1 if a mark on one, else 0."""
    kind = {"L": 2, "M": 1}
    return np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def symbols(text: str | None) -> np.ndarray:
    """Code points of the lower-case letters and marks, one space between words and at both ends; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    kinds = _kinds()[codes]
    if not (kinds == 2).any():
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate([[0], np.where(kinds > 0, codes, 0), [0]])
    first_gap = np.append(True, (padded[1:] > 0) | (padded[:-1] > 0))
    return np.where(padded == 0, 32, padded)[first_gap].astype(np.uint64)


def windows(codes: np.ndarray) -> list[np.ndarray]:
    """The symbols in windows of about equal length; no gram falls between two."""
    n = max(1, -(-len(codes) // WINDOW))
    cuts = [len(codes) * i // n for i in range(n + 1)]
    return [codes[low : high + WIDEST - 1] for low, high in zip(cuts, cuts[1:])]


def grams(window: np.ndarray) -> np.ndarray:
    """Places of all grams of a window, with repetitions."""
    found, h = [], np.zeros(len(window), dtype=np.uint64)
    for n in range(1, WIDEST + 1):
        if len(window) < n:
            break
        h = (h[: len(window) - n + 1] + window[n - 1 :] + np.uint64(n)) * _MIX
        mixed = (h ^ (h >> np.uint64(29))) * _TURN
        found.append((mixed >> np.uint64(64 - (PLACES.bit_length() - 1))).astype(np.int64))
    return np.concatenate(found)


def presence(some: list[np.ndarray]) -> np.ndarray:
    """windows x places: 1 where a window has a gram, divided by the root of its number of grams."""
    x = np.zeros((len(some), PLACES), dtype=np.float32)
    for row, window in zip(x, some, strict=True):
        row[grams(window)] = 1
    return x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))


def features(texts: list[str | None], landmarks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean kernel row of every text's windows against the landmarks (places x landmarks), and whether it has a letter.

    ``ROWS`` windows are held at a time, beside the symbols of one text.
    """
    out, counts = np.zeros((len(texts), landmarks.shape[1])), np.zeros(len(texts), dtype=np.int64)
    owners: list[int] = []
    held: list[np.ndarray] = []

    def multiply() -> None:
        np.add.at(out, owners, presence(held) @ landmarks)
        owners.clear()
        held.clear()

    for k, text in enumerate(texts):
        codes = symbols(text)
        for window in windows(codes) if len(codes) else []:
            counts[k] += 1
            owners.append(k)
            held.append(window)
            if len(held) == ROWS:
                multiply()
    if held:
        multiply()
    return out / np.maximum(1, counts)[:, None], counts > 0


@dataclass(frozen=True)
class Model:
    """``landmarks`` (places x landmarks, normed presence) and ``weights`` (landmarks x languages) with ``bias``."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def shares(self, kernel: np.ndarray) -> np.ndarray:
        """Share of every language, from kernel rows."""
        margin = SHARPNESS * (kernel @ self.weights + self.bias)
        e = np.exp(margin - margin.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        if not self.languages:
            return pd.DataFrame({"lang": UNKNOWN, "score": np.zeros(len(texts))})
        kernel, known = features(texts, self.landmarks)
        shares = self.shares(kernel)
        best = shares.argmax(axis=1)
        names = np.array(self.languages, dtype=object)[best]
        score = np.where(known, np.clip(shares[np.arange(len(best)), best], 0, 1), 0.0)
        return pd.DataFrame({"lang": np.where(known, names, UNKNOWN), "score": score})


def solve(kernel: np.ndarray, labels: np.ndarray, languages: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of ridge regression, one language against the rest.

    ``kernel`` rows of the samples against the landmarks, ``labels`` their languages by number, ``among`` the landmarks'
    own kernel matrix. Every language weighs the same, however many samples it has.
    """
    values, vectors = np.linalg.eigh(among)
    good = values > values.max() * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])  # K^(-1/2) up to a rotation, which changes no inner product
    x = kernel @ root
    y = np.where(labels[:, None] == np.arange(languages), 1.0, -1.0)
    weight = 1.0 / np.maximum(1, np.bincount(labels, minlength=languages))[labels]
    weight = weight / weight.sum()
    mean, target = weight @ x, weight @ y
    x, y = x - mean, y - target
    a = np.linalg.solve(x.T @ (weight[:, None] * x) + RIDGE * np.eye(x.shape[1]), x.T @ (weight[:, None] * y))
    return root @ a, target - mean @ a


def _evenly(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, as even over the languages as they allow, by least hash.

    Of a language with many rows only a share of the hashes is looked at, some one and a half times ``most`` rows, so
    what meets in one window does not grow with the rows. The rows themselves are not dealt out by language.
    """
    share = materialize(labelled.groupBy("lang").agg((1.5 * most / F.count(F.lit(1))).alias("_share")))
    some = labelled.join(sent(share, share.count()), "lang").where(F.pmod("_h", F.lit(1 << 40)) < F.col("_share") * (1 << 40))
    by_hash = Window.partitionBy("lang").orderBy("_h", "_t")
    placed = some.withColumn("_place", F.row_number().over(by_hash)).where(F.col("_place") <= most)
    return placed.orderBy("_place", "lang", "_h", "_t").limit(most)


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """A model from ``docs`` (doc_id, text, lang): from at most ``sample`` rows with a language, a doc_id and a letter."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    keys = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"), F.xxhash64("text").alias("_t"))
    chosen = materialize(_evenly(keys, sample).withColumn("_nth", F.monotonically_increasing_id()))
    # At most ``sample`` rows, so the texts need not move; a text is told by its hash, equal ones are one sample.
    held = F.broadcast(chosen.groupBy("doc_id", "lang", "_t").agg(F.min("_nth").alias("_nth")))
    texts = known.withColumn("_t", F.xxhash64("text")).join(held, ["doc_id", "lang", "_t"]).select("doc_id", "text", "lang", "_nth")

    def middle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [windows(symbols(t)) for t in batch["text"]]
            places = [np.unique(grams(c[len(c) // 2])) for c in cut]
            yield pd.DataFrame({"nth": batch["_nth"], "lang": batch["lang"], "places": places})

    # One window of each landmark document: a few thousand numbers.
    first = texts.join(F.broadcast(chosen.orderBy("_nth").limit(landmarks).select("_nth")), "_nth", "left_semi")
    marks = first.mapInPandas(middle, "nth long, lang string, places array<int>").toPandas()
    marks = marks.sort_values("nth").drop_duplicates("nth", ignore_index=True)
    normed = np.zeros((PLACES, len(marks)), dtype=np.float32)
    for k, places in enumerate(marks["places"]):
        normed[np.asarray(places, dtype=np.int64), k] = 1 / np.sqrt(max(1, len(places)))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kernel, _ = features(batch["text"].tolist(), normed)
            yield pd.DataFrame({"nth": batch["_nth"], "lang": batch["lang"], "kernel": list(kernel)})

    rows = texts.mapInPandas(measured, "nth long, lang string, kernel array<double>").toPandas()
    rows = rows.sort_values("nth").drop_duplicates("nth", ignore_index=True)
    languages = sorted(rows["lang"].unique())
    if not languages:
        return Model([], normed, np.zeros((0, 0)), np.zeros(0))
    labels = rows["lang"].map(languages.index).to_numpy(dtype=np.int64)
    weights, bias = solve(np.array(rows["kernel"].tolist()), labels, len(languages), normed.T.astype(float) @ normed)
    return Model(languages, normed, weights, bias)


def predictor(model: Model) -> Callable[[Column], Column]:
    """A column function: text -> struct(lang, score)."""

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return model.predict(texts.tolist())

    return predict


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


__all__ = ["Model", "features", "fit", "grams", "held_out", "predictor", "presence", "solve", "symbols", "windows"]
