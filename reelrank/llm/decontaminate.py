"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as words (letters and digits, lower case). An item of n words may differ from a
passage in ``floor(RATE * n)`` words (put in, left out or replaced); one of fewer than EDIT_WORDS words in none. Cut into one piece more than that, at
least one piece stands in the passage unchanged, so exact hits of pieces (Aho-Corasick) find every
passage within the budget. Around each hit Myers' bit-parallel algorithm computes the least distance of the item
to any stretch of words there.

Items are taken in blocks of bounded size, and every block meets all documents.

Defined results: null texts are empty; an item without a word stands nowhere. Very long texts are searched whole. Items that
repeat a text match each under its own id. ``contaminated`` reports items that have an id, ``clean`` looks for those without one
too. Of places of equal distance the first counts. Repeated documents give repeated rows. No rows: no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import blocks, in_small_batches

RATE = 0.2
#: Words from which an item may differ from a passage.
EDIT_WORDS = 8
#: Characters of the items that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000

_words = re.compile(r"[^\W_]+").findall
MATCHES = "array<struct<item_id:bigint,distance:int,word:bigint>>"


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def least_distance(pattern: list[str], text: list[str]) -> int:
    """Least edit distance, in words, of ``pattern`` to any stretch of ``text``: Myers' bit vectors."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = {}
    for i, w in enumerate(pattern):
        places[w] = places.get(w, 0) | 1 << i
    up, down, score, least = full, 0, m, m
    for w in text:
        eq = places.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        gain, loss = (down | ~(diagonal | up)) & full, up & diagonal
        score += bool(gain & top) - bool(loss & top)
        # A stretch may begin anywhere, so nothing enters from above.
        gain, loss = gain << 1 & full, loss << 1 & full
        vertical = eq | down
        up, down = (loss | ~(vertical | gain)) & full, gain & vertical
        least = min(least, score)
    return least


def budget_of(words: list[str], rate: float = RATE) -> int:
    """Words in which a passage may differ from an item."""
    return int(rate * len(words)) if len(words) >= EDIT_WORDS else 0


class Items:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        import ahocorasick

        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            budget, k = budget_of(words, rate), len(self.items)
            cuts = np.linspace(0, len(words), budget + 2).astype(int)
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(f" {' '.join(words[a:b])} ", []).append((k, int(a)))
            self.items.append((item_id, words, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.automaton.add_word(piece, (len(piece), at))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, least distance, word at which it was found) of the items within their budget."""
        if self.empty or not text:
            return []
        words = words_of(text)
        joined = f" {' '.join(words)} "
        best: dict[int, tuple[int, int]] = {}
        starts, seen = None, set()
        for end, (length, at) in self.automaton.iter(joined):
            if starts is None:
                lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
                starts = np.cumsum(lengths) - lengths
            word = int(np.searchsorted(starts, end - length + 1))
            for k, offset in at:
                item_id, pattern, budget = self.items[k]
                first = word - offset
                if (k, first) in seen or best.get(k, (1,))[0] == 0:
                    continue
                seen.add((k, first))
                stretch = words[max(0, first - budget) : max(0, first + len(pattern) + budget)]
                distance = least_distance(pattern, stretch)
                if distance <= budget and distance < best.get(k, (budget + 1,))[0]:
                    best[k] = (distance, max(0, first))
        found = [(self.items[k][0], d, w) for k, (d, w) in best.items()]
        return sorted(found, key=lambda m: (m[0] is not None, m[0] or 0, m[1:]))


def matcher(items: list[tuple[int | None, str]], rate: float = RATE) -> Callable[[Column], Column]:
    """A column function: text -> the items of this block that stand in it."""

    @F.pandas_udf(MATCHES)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searched = Items(items, rate)
        for texts in batches:
            yield pd.Series(
                [[{"item_id": i, "distance": d, "word": w} for i, d, w in searched.matches(t)] for t in texts], dtype=object
            )

    return found


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS, unnamed: bool = False) -> Iterator[list[tuple[int | None, str]]]:
    """The items (item_id, text), with those without an id if ``unnamed``, in blocks of about ``chars`` characters, one
    block at a time."""
    items = benchmark.where(F.col("text").isNotNull() & (F.lit(unnamed) | F.col("item_id").isNotNull()))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = blocks(int(total), chars)
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        found = [(r["item_id"], r["text"]) for r in block.collect()]
        yield sorted(found, key=lambda item: (item[0] is not None, item[0] or 0, item[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, word: every item found within its budget in every document."""
    kept, out = in_small_batches(docs).select("doc_id", "text"), None
    for block in item_blocks(benchmark, chars):
        rows = kept.select("doc_id", F.explode(matcher(block, rate)(F.col("text"))).alias("m")).select("doc_id", "m.*")
        out = rows if out is None else out.unionAll(rows)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which an item stands."""
    in_small_batches(docs)
    for block in item_blocks(benchmark, chars, unnamed=True):
        docs = docs.where(F.size(matcher(block, rate)(F.col("text"))) == 0)
    return docs


__all__ = ["Items", "budget_of", "clean", "contaminated", "least_distance", "words_of"]
