"""Periodic runs of words, by maximal pairs.

A run is a stretch of words that repeats itself with a smallest period q, at least ``times`` times q long, and
that no neighbouring word continues. Places i < j of a text are a maximal pair if the words from both on
agree for exactly L words and the words before them differ. With d = j - i, a maximal pair with L >= (times - 1) * d
spans words i .. j + L - 1, which repeat with period d and are continued on neither side: it is a run as it
stands, and nothing needs extending. A run shows itself once for every multiple of its period that is short enough, so
the least distance of a span is its smallest period.

The pairs come from the suffixes of a text. Suffixes are sorted by prefix doubling, all texts of a batch at once
(words of different texts never compare equal); places whose prefix is unique drop out, so ordinary prose is done
after three rounds. Stretches of sorted suffixes with common prefixes long enough for a run are walked bottom-up as an
LCP-interval tree. A node keeps its places in order, and again by the word to their left. Where a child joins its
node, the places of the smaller side look for places of other left words within L / (times - 1) words.
A place has few of them: occurrences that near to each other overlap in one run and all but the run's first have
the same word to their left, so the work stays near the number of places whatever the text repeats.

Every text is done where it lies, in one task; a batch holds about ``BATCH_WORDS`` words or one longer text. No
shuffle.

Defined results: a null or empty text, or one of white space, has no words, no runs and collapses to ''. Texts of
any length are taken whole; memory follows the longest. Rows that repeat a doc_id, and rows without one, keep
each its own result. Runs of equal start are ordered by period. No rows: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least words of a run, and least multiple of its period.
LEAST = 6
TIMES = 4
BATCH_WORDS = 200_000
#: Places of the smaller side from which two lists are sorted together instead of put in one by one.
MANY = 16

Run = tuple[int, int, int]  # start, length, period


def _starts(new: np.ndarray) -> np.ndarray:
    """For every place of a sorted list the place where its group begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _changes(sorted_keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])


def suffix_ranks(codes: np.ndarray, shared: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of all places by their first 1, 2, 4, ... codes, and the places that share their first ``shared``
    codes (a power of two) with another place, in the order of their suffixes.

    The last code, and the last of every text, must be unique.
    """
    n, width, kept = len(codes), 1, np.zeros(0, dtype=np.int64)
    rank, active, key, levels = np.zeros(n, dtype=np.int64), np.arange(n), codes, []
    while len(active):
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        new, old = _changes(key), rank[active]
        rank[active] = old + _starts(new) - _starts(_changes(old))
        levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        active = active[~(new & np.append(new[1:], True))]
        if width == shared:
            kept = active
        # Tied places agree for ``width`` codes, which end before their text's last.
        key = rank[active] * n + rank[np.minimum(active + width, n - 1)]
        width *= 2
    return levels, kept[np.argsort(rank[kept], kind="stable")]


def common_prefixes(levels: list[np.ndarray], places: np.ndarray) -> np.ndarray:
    """Number of codes that each place shares with the one before it in the list; 0 for the first."""
    a, b = places[:-1].copy(), places[1:].copy()
    common = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        common, a, b = common + step, a + step, b + step
    return np.concatenate([[0], common])


class _Places:
    """Places of a node of the interval tree: in order, and by the word to their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int) -> None:
        self.all, self.by_left = [place], {left: [place]}

    def near(self, place: int, left: int, reach: int, left_of: dict[int, int]) -> list[int]:
        """Places within ``reach`` whose left word is another; by the shorter of the two ways."""
        low, high = bisect_left(self.all, place - reach), bisect_right(self.all, place + reach)
        if high - low <= len(self.by_left):
            return [p for p in self.all[low:high] if left_of[p] != left]
        return [
            p
            for word, held in self.by_left.items()
            if word != left
            for p in held[bisect_left(held, place - reach) : bisect_right(held, place + reach)]
        ]

    def take(self, other: _Places) -> None:
        _into(self.all, other.all)
        for word, held in other.by_left.items():
            _into(self.by_left.setdefault(word, []), held)


def _into(held: list[int], more: list[int]) -> None:
    if len(more) < MANY:
        for p in more:
            insort(held, p)
    else:  # two sorted stretches, which the sort merges
        held.extend(more)
        held.sort()


def spans(places: list[int], common: list[int], left_of: dict[int, int], least: int, times: int) -> dict[tuple[int, int], int]:
    """(first word, word after the last) -> smallest period, for one stretch of sorted suffixes.

    ``common[k]`` is the common prefix of places k - 1 and k.
    """
    found: dict[tuple[int, int], int] = {}

    def joined(a: _Places, b: _Places, length: int) -> _Places:
        """Two children of the interval of common prefix ``length`` as one."""
        if len(a.all) < len(b.all):
            a, b = b, a
        reach = length // (times - 1)
        for p in b.all:
            for r in a.near(p, left_of[p], reach, left_of):
                distance = abs(p - r)
                if length + distance >= least:
                    span = (min(p, r), max(p, r) + length)
                    found[span] = min(distance, found.get(span, distance))
        a.take(b)
        return a

    open_: list[tuple[int, _Places]] = []
    done = _Places(places[0], left_of[places[0]])
    for place, length in zip(places[1:], common[1:], strict=True):
        while open_ and open_[-1][0] > length:
            above, node = open_.pop()
            done = joined(node, done, above)
        if open_ and open_[-1][0] == length:
            done = joined(open_.pop()[1], done, length)
        open_.append((length, done))
        done = _Places(place, left_of[place])
    while open_:
        above, node = open_.pop()
        done = joined(node, done, above)
    return found


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """The runs of every text, a list of words, by start and period."""
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    # The shortest common prefix that a run of the least length needs.
    prefix = next(n for n in range(1, least * times) if n >= times - 1 and n + n // (times - 1) >= least)
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    ids = [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
    vocabulary = len(numbers) + 1
    # Words are numbered apart in every text, and a text ends with a code that no other place has.
    codes = np.concatenate([np.append(own, vocabulary - 1) + k * vocabulary for k, own in enumerate(ids)] or [np.zeros(0, dtype=np.int64)])
    ends = np.cumsum([len(own) + 1 for own in ids])
    levels, places = suffix_ranks(codes, 1 << (prefix.bit_length() - 1))
    out: list[list[Run]] = [[] for _ in texts]
    if not len(places):
        return out
    common = common_prefixes(levels, places)
    left = codes[places - 1]  # before the first word of all stands the last code
    cuts = np.flatnonzero(common < prefix)
    sizes = np.diff(np.append(cuts, len(places)))
    for low, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        some = places[low : low + size].tolist()
        found = spans(some, common[low : low + size].tolist(), dict(zip(some, left[low : low + size].tolist())), least, times)
        for (start, end), period in found.items():
            text = int(np.searchsorted(ends, start, side="right"))
            first = int(ends[text - 1]) if text else 0
            out[text].append((start - first, end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words that no run repeats, joined by a space."""
    if found:
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in found:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words)


def _batches(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """Words of the texts, some texts at a time. ``bytes.split`` cuts at the six ASCII white-space characters."""
    held, size = [], 0
    for text in texts:
        held.append((text or b"").split())
        size += len(held[-1])
        if size >= BATCH_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed text, for all ``docs``."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            low = 0
            for texts in _batches(batch.column("body").to_pylist()):
                found = runs_of(texts, least, times)
                rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in found]
                kept = [collapsed(words, own).decode("utf-8", "replace") for words, own in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, len(texts)),
                        pa.array(map(len, texts), pa.int64()),
                        pa.array(rows, kind),
                        pa.array(kept, pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                low += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("body"))
    return rows.mapInArrow(rows_of, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start, then period; null where there is none."""
    ordered = F.transform(runs, lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"), r.alias("run")))
    return F.array_min(ordered)["run"]


__all__ = ["collapsed", "common_prefixes", "longest", "periodic_runs", "runs_of", "suffix_ranks"]
