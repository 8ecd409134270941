"""Secret scans by grammar inference.

Exact patterns give the base spans, which are the labelled credentials of three kinds. From a bounded sample
of each kind a prefix tree over character classes is built and its statistically compatible states are
merged (ALERGIA: a Hoeffding bound on every transition and ending) into a probabilistic automaton; another one is
learnt from a sample of tokens that are no credentials. Every candidate token of all documents is scored by its mean
log-likelihood under each kind's automaton less that under the plain one. Candidates that score like all the
kind's credentials that were not learnt from are added; base spans always stay.

One pass over the texts finds spans and candidates; the scores read only those.

Defined results: a null or empty text has no spans. Null or repeated doc_ids are rows like any other. A kind
with fewer than SUPPORT distinct credentials adds nothing. Positions are code points, end exclusive. Extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import floor, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import in_small_batches
from reelrank.session import materialize

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
#: Bounds of the fit: distinct strings per automaton; fewer than SUPPORT teach nothing.
SAMPLE, SUPPORT = 400, 20
#: Plain tokens learnt from, drawn by occurrence, so that a name met often weighs as often.
PLAIN = 2_000
#: Confidence of the compatibility test, and the probability given to what an automaton has never seen.
ALPHA, UNSEEN = 0.05, 1e-4
#: Share of held-out credentials that a threshold may miss.
MISSED = 0.01
#: Bins a unit of score when held-out credentials are counted.
BINS = 1_000

SPAN = "struct<start:bigint,kind:int,end:bigint>"
FOUND = f"doc_id long, base array<{SPAN}>, values array<string>, candidates array<struct<start:bigint,end:bigint,value:string>>"


def symbols(value: str) -> str:
    """Character classes: digit, a-f, other lower, A-F, other upper; marks as they are."""
    return re.sub("[0-9]", "0", re.sub("[a-f]", "a", re.sub("[g-z]", "z", re.sub("[A-F]", "A", re.sub("[G-Z]", "Z", value)))))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential), sorted."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYS):
        out += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Tokens of the credential alphabet that lie on no base span."""
    out, at = [], 0
    ends = sorted((s, e) for s, _, e, _ in base)
    for m in CANDIDATE.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        clear = all(s >= m.end() or e <= m.start() for s, e in ends[at : at + 4])
        if clear:
            out.append((m.start(), m.end(), m.group()))
    return out


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base spans and their credentials, candidate tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: dict[str, list] = {"base": [], "values": [], "candidates": []}
            for text in batch["text"]:
                base = base_spans(text or "")
                rows["base"].append([{"start": s, "kind": k, "end": e} for s, k, e, _ in base])
                rows["values"].append([v for *_, v in base])
                rows["candidates"].append([{"start": s, "end": e, "value": v} for s, e, v in candidates(text or "", base)])
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, **rows})

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_small_batches(kept).mapInPandas(run, FOUND)


class Automaton:
    """A probabilistic automaton inferred from strings of symbols."""

    def __init__(self, strings: list[str], alpha: float = ALPHA) -> None:
        # State 0 is the root of the prefix tree: visits, endings, next state and its count by symbol.
        self.visits, self.ends, self.next, self.counts = [0], [0], [{}], [{}]
        self.bound = sqrt(0.5 * log(2 / alpha))
        for s in strings:
            self._insert(s)
        self._merge_all()

    def _insert(self, string: str) -> None:
        state = 0
        self.visits[0] += 1
        for c in string:
            if c not in self.next[state]:
                self.next[state][c], self.counts[state][c] = len(self.visits), 0
                self.visits.append(0)
                self.ends.append(0)
                self.next.append({})
                self.counts.append({})
            self.counts[state][c] += 1
            state = self.next[state][c]
            self.visits[state] += 1
        self.ends[state] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / sqrt(n1) + 1 / sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.visits[a], self.visits[b]
            if self._differ(self.ends[a], na, self.ends[b], nb):
                return False
            for c in self.counts[a].keys() | self.counts[b].keys():
                if self._differ(self.counts[a].get(c, 0), na, self.counts[b].get(c, 0), nb):
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree of ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, child in self.next[b].items():
                n = self.counts[b][c]
                if c in self.next[a]:
                    self.counts[a][c] += n
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c], self.counts[a][c] = child, n

    def _merge_all(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            blue = sorted({p for p in blue if self.next[p[0]].get(p[1]) not in red}, key=lambda p: -self.counts[p[0]][p[1]])
            if not blue:
                break
            source, symbol = blue.pop(0)
            state = self.next[source][symbol]
            for r in red:
                if self._compatible(r, state):
                    self.next[source][symbol] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
            blue = [(r, c) for r in red for c in self.next[r] if self.next[r][c] not in red]

    def mean_log(self, string: str) -> float:
        """Mean log-likelihood of the string's symbols and its end."""
        state, total = 0, 0.0
        for c in string:
            n = self.counts[state].get(c, 0)
            total += log(n / self.visits[state]) if n else log(UNSEEN)
            state = self.next[state].get(c, state)
        end = self.ends[state] / self.visits[state] if self.visits[state] else 0.0
        return (total + log(max(end, UNSEEN))) / (len(string) + 1)


class Grammars:
    """The automata of the kinds and of plain tokens, and, calibrated, the score each kind asks for."""

    def __init__(self, credentials: list[list[str]], plain: list[str]) -> None:
        self.plain = Automaton([symbols(v) for v in plain]) if len(plain) >= SUPPORT else None
        self.kinds, self.learnt, self.bars = {}, {}, {}
        for kind, values in enumerate(credentials):
            if len(values) < SUPPORT:
                continue
            self.kinds[kind] = Automaton([symbols(v) for v in values[::2]])
            self.learnt[kind] = set(values[::2])

    def held_out(self, kind: int, value: str) -> int | None:
        """The bin of a labelled credential's score, none if its kind's automaton has learnt from it."""
        if kind not in self.kinds or value in self.learnt[kind]:
            return None
        return floor(self._score(kind, symbols(value)) * BINS)

    def calibrate(self, bins: list[tuple[int, int, int]]) -> None:
        """Bars from (kind, bin, number) of all held-out credentials: the edge below all but MISSED of them."""
        for kind in self.kinds:
            own = sorted((b, n) for k, b, n in bins if k == kind)
            left = int(MISSED * sum(n for _, n in own))
            for b, n in own:
                if left < n:
                    self.bars[kind] = max(0.0, b / BINS)
                    break
                left -= n

    def _score(self, kind: int, string: str) -> float:
        # Without plain tokens every symbol is as likely as any other of the 64.
        against = self.plain.mean_log(string) if self.plain else -log(64)
        return self.kinds[kind].mean_log(string) - against

    def kind_of(self, value: str) -> int | None:
        """The kind the value's format is most likely of, if it scores as credentials do."""
        string = symbols(value)
        scores = {k: self._score(k, string) for k in self.kinds}
        passed = {k: s for k, s in scores.items() if k in self.bars and s >= self.bars[k]}
        return max(passed, key=lambda k: (passed[k], -k)) if passed else None


def fit(found: DataFrame, sample: int = SAMPLE) -> Grammars:
    """Automata from at most ``sample`` distinct strings of each kind and PLAIN tokens of a stored ``find`` result, bars from all."""

    def drawn(values: DataFrame) -> list[str]:
        first = values.distinct().orderBy(F.xxhash64("value"), "value").limit(sample)
        return [r["value"] for r in first.collect()]

    labelled = found.select(F.explode(F.arrays_zip("base", "values")).alias("z"))
    labelled = labelled.select(F.col("z.base.kind").alias("kind"), F.col("z.values").alias("value"))
    plain = found.select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.start", "c.value")
    plain = plain.orderBy(F.xxhash64("doc_id", "start", "value"), "value").limit(PLAIN)
    tokens = [r["value"] for r in plain.select("value").collect()]
    grammars = Grammars([drawn(labelled.where(F.col("kind") == k).select("value")) for k in range(len(KINDS))], tokens)

    @F.pandas_udf("long")
    def binned(kinds: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([grammars.held_out(k, v) for k, v in zip(kinds, values, strict=True)], dtype="Int64")

    # All distinct credentials but the learnt ones; the driver gets counts of bins only.
    counted = labelled.distinct().select("kind", binned("kind", "value").alias("bin")).where("bin is not null")
    grammars.calibrate([(r["kind"], r["bin"], r["n"]) for r in counted.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n")).collect()])
    return grammars


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans, array<struct<start, kind, end>> each, sorted; one row per row of ``docs``."""
    found = materialize(find(docs))
    grammars = fit(found)

    @F.pandas_udf(f"array<{SPAN}>")
    def added(columns: pd.Series) -> pd.Series:
        out = []
        for tokens in columns:
            kinds = ((t["start"], grammars.kind_of(t["value"]), t["end"]) for t in tokens)
            out.append([{"start": s, "kind": k, "end": e} for s, k, e in kinds if k is not None])
        return pd.Series(out, dtype=object)

    return found.select("doc_id", "base", added("candidates").alias("added"))


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


__all__ = ["KINDS", "Automaton", "Grammars", "find", "fit", "secrets", "written"]
