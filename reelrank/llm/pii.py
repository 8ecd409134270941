"""Personal data by candidate gradient boosting, with Spark expressions only.

Exact patterns with their checks give the base spans. Generators of high recall propose further,
overlapping spans: addresses with spelt-out signs, digit groups with other separators or without a
plus, dotted numbers. Boosted trees score each candidate by its format and its surroundings; they learn
from candidates on base spans (personal data) against the others, without seeing how the base patterns tell
them apart (check digit, leading plus, spelt-out signs).

A candidate on no base span is not false but unlabelled: the base patterns may have missed it. Candidates that fail their
kind's check whatever their spelling (check digit, parts of an address, number of digits) are false and never added. Among the
others a share c of the true ones is labelled. c is estimated per kind, on all documents kept out of the fit, as the
mean over the labelled ones of the labelled share at their score (Elkan & Noto 2008); the true ones at a score are
the labelled ones over c. The threshold of a kind is the least score above which PRECISION of the candidates are
true by that count. Candidates above it are added; base spans always stay. Where c is under LEAST_SHARE the base patterns say
too little about the kind, and nothing is added to it.

One pass over the texts finds spans and candidates per document as arrays; nothing is shuffled by
document. The trees become CASE expressions, evaluated where the candidates lie.

Defined results: a null or empty text has no spans. Null or repeated doc_ids are rows like any other.
Without candidates of both classes nothing is added, nor to a kind with fewer than SUPPORT labelled candidates
kept out of the fit. Very long texts are searched whole; candidates with one score share its bin. No rows: no rows. Positions are code points, end exclusive. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import STRIDE, running_sums
from reelrank.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: The given patterns, written so that no text makes them backtrack: a run of characters is entered at its start only.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[](?:at|AT|@)[)\]]\x20?)[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[(\[](?:dot|DOT|\.)[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:[.,:]\x20?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,20}(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9])",
}
#: Words near personal data of each kind.
CONTEXT = {
    "email": "mail|contact|write|reply",
    "ip": "ip|host|server|addr|ping",
    "card": "card|visa|pay|credit|account|iban",
    "phone": "tel|phone|call|fax|mobile|dial",
}
BEFORE, AFTER = 24, 8
#: Bounds of the fit: candidates used, trees and their depth.
SAMPLE, TREES, DEPTH = 20_000, 10, 3
#: Share of true candidates wanted above a threshold, labelled candidates needed to calibrate one, and the least share of
#: the true ones that must be labelled.
PRECISION, SUPPORT, LEAST_SHARE = 0.95, 20, 0.4
BINS = 50
def _placed(values: Column, gaps: Column) -> Column:
    """array<struct<start, end, value>> of matches, from the matched strings and what is known of the text between."""
    lengths = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: g["n"] + F.length(v))
    gap = lambda i: F.get(gaps, i)["n"]
    placed = F.zip_with(values, running_sums(lengths), lambda v, s: F.struct(s.alias("s"), v.alias("v")))
    return F.transform(
        placed,
        lambda m, i: F.struct(
            (m["s"] + gap(i)).alias("start"), (m["s"] + gap(i) + F.length(m["v"])).alias("end"), m["v"].alias("value")
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits)))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda t, x: t + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        small = lambda p: (F.length(part(p)) <= 3) & (F.substr(part(p), F.lit(1), F.lit(3)).cast("int") <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _plain(kind: str, value: Column) -> Column:
    """The value without the spelling that hides it from the base pattern."""
    if kind != "email":
        return value
    sign = F.regexp_replace(value, r"\x20?[(\[](?:at|AT|@)[)\]]\x20?", "@")
    return F.regexp_replace(sign, r"\x20?[(\[](?:dot|DOT|\.)[)\]]\x20?", ".")


def _possible(kind: str, value: Column) -> Column:
    """Whether the value passes its kind's check, however it is spelt."""
    if kind == "email":
        return _plain(kind, value).rlike(r"@[A-Za-z0-9-]++\.")
    if kind == "ip":
        return _valid(kind, F.regexp_replace(value, r"[.,:]\x20?", "."))
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _valid(kind, value)
    return _valid(kind, value)


#: Names of a candidate's features, in the order of the fitted model.
FEATURES = [
    "chars", "digits", "letters", "others", "groups", "longest", "first_group", "dots", "brackets", "upper",
    "joined_before", "joined_after", "line_start", "digits_before", "sign_before", "stop_after",
    *(f"near_{k}" for k in KINDS), *(f"is_{k}" for k in KINDS),
]


def _features(kind: str, value: Column, before: Column, after: Column) -> list[Column]:
    value = _plain(kind, value)
    before = F.regexp_replace(before, r"\+$", "") if kind == "phone" else before
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.length)
    digits, letters = F.length(_digits(value)), F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    made = [
        F.length(value),
        digits,
        letters,
        F.length(value) - digits - letters,
        F.size(groups),
        F.coalesce(F.array_max(sizes), F.lit(0)),
        F.coalesce(F.get(sizes, 0), F.lit(0)),
        F.length(F.regexp_replace(value, r"[^.]", "")),
        F.length(F.regexp_replace(value, r"[^()\[\]]", "")),
        F.length(F.regexp_replace(value, "[^A-Z]", "")),
        before.rlike(r"[\p{L}\p{N}_=/]$"),
        after.rlike(r"^[\p{L}\p{N}_=/]"),
        before.rlike(r"(^|\n)\s*$"),
        F.length(_digits(before)),
        before.rlike(r"[#$€:]\s*$"),
        after.rlike(r"^[.,;!?]?(\s|$)"),
        *(before.rlike(rf"(?i)\b(?:{words})") for words in CONTEXT.values()),
        *(F.lit(k == kind) for k in KINDS),
    ]
    return [c.cast("double").alias(n) for n, c in zip(FEATURES, made, strict=True)]


def _base_spans(number: int, kind: str) -> Column:
    kept = F.filter(f"b_{kind}", lambda m: _valid(kind, m["value"]))
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))


def _candidates(number: int, kind: str) -> Column:
    between = F.col(f"gg_{kind}")

    def proposed(m: Column, i: Column) -> Column:
        features = _features(kind, m["value"], F.get(between, i)["tail"], F.get(between, i + 1)["head"])
        possible = _possible(kind, m["value"]).alias("possible")
        return F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), *features, possible)

    return F.transform(f"g_{kind}", proposed)


def _in_blocks(base: Column) -> Column:
    """Sorted spans in blocks with their first start and last end, so that a search skips most of them."""
    last = F.greatest(F.lit(0), F.floor((F.size(base) - 1) / STRIDE).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(base, b * STRIDE + 1, STRIDE))
    low = lambda b: F.array_min(F.transform(b, lambda s: s["start"]))
    high = lambda b: F.array_max(F.transform(b, lambda s: s["end"]))
    return F.transform(cut, lambda b: F.struct(low(b).alias("low"), high(b).alias("high"), b.alias("spans")))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base array<struct<start, kind, end>>, the same in blocks, candidates array<struct<start, kind, end, features...>>.

    ``kind`` is the place in KINDS, so an array sorts by start and then kind. A candidate's surroundings reach to
    the next match of its generator at most; they are taken from the text between matches, so the work is linear.
    """
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    signs = F.contains("text", F.lit("@")) | F.col("text").rlike(r"[(\[](?:at|AT)[)\]]")
    df = df.withColumns({"digit": F.col("text").rlike("[0-9]"), "sign": signs})
    patterns = {("b", k): p for k, p in BASE.items()} | {("g", k): p for k, p in GENERATORS.items()}
    raw = {}
    for (role, kind), pattern in patterns.items():
        gate = F.col("sign" if kind == "email" else "digit")
        none = F.array().cast("array<string>")
        found = F.when(gate, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none)
        between = F.transform(
            F.when(gate, F.split("text", pattern, -1)).otherwise(none),
            lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(BEFORE)).alias("tail"), F.left(g, F.lit(AFTER)).alias("head")),
        )
        raw |= {f"{role}v_{kind}": found, f"{role}g_{kind}": between}
    df = df.withColumns(raw)
    df = df.withColumns({f"{r}_{k}": _placed(F.col(f"{r}v_{k}"), F.col(f"{r}g_{k}")) for r, k in patterns})
    base = [_base_spans(number, kind) for number, kind in enumerate(KINDS)]
    candidates = [_candidates(number, kind) for number, kind in enumerate(KINDS)]
    df = df.select("doc_id", F.array_sort(F.concat(*base)).alias("base"), F.concat(*candidates).alias("candidates"))
    return df.select("doc_id", "base", _in_blocks(F.col("base")).alias("blocks"), "candidates")


def _on_base(candidate: Column, blocks: Column) -> Column:
    meets = lambda s: (s["start"] < candidate["end"]) & (s["end"] > candidate["start"])
    same = lambda s: (s["kind"] == candidate["kind"]) & meets(s)
    near = lambda b: (b["low"] < candidate["end"]) & (b["high"] > candidate["start"])
    return F.exists(blocks, lambda b: near(b) & F.exists(b["spans"], same))


@dataclass(frozen=True)
class Model:
    """Trees as nested (feature, cut, low, high) tuples with leaf values, and the threshold of each kind."""

    trees: tuple
    thresholds: dict[int, float]

    def score(self, features: Callable[[str], Column]) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, cut, low, high = node
            return F.when(features(name) <= F.lit(cut), value(low)).otherwise(value(high))

        margin = F.lit(0.0)
        for tree in self.trees:
            margin = margin + value(tree)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * margin))

    def accepts(self, candidate: Column) -> Column:
        bar = F.lit(2.0)
        for kind, threshold in self.thresholds.items():
            bar = F.when(candidate["kind"] == kind, F.lit(threshold)).otherwise(bar)
        return self.score(lambda name: candidate[name]) >= bar


def _nested(node, weight: float):
    """A fitted tree as tuples; the model's own nodes are read once on the driver (2**DEPTH of them)."""
    if "Leaf" in node.getClass().getSimpleName():
        return float(node.prediction()) * weight
    split = node.split()
    low, high = _nested(node.leftChild(), weight), _nested(node.rightChild(), weight)
    return FEATURES[split.featureIndex()], float(split.threshold()), low, high


def fit(found: DataFrame, sample: int = SAMPLE) -> Model:
    """Trees from at most ``sample`` candidates of a stored ``find`` result, thresholds from all that are kept out of the fit.

    Each kind and label gives as many candidates at most, so that none takes another's place.
    """
    rows = found.select("doc_id", "blocks", F.explode("candidates").alias("c"))
    rows = rows.select(
        F.xxhash64("doc_id").alias("h"), "c.*", _on_base(F.col("c"), F.col("blocks")).cast("double").alias("label")
    )
    place = F.xxhash64("h", "start", "kind").alias("place")
    rows = materialize(rows.select(place, "kind", *FEATURES, "possible", "label", (F.pmod("h", F.lit(10)) < 7).alias("learn")))
    share = sample // (2 * len(KINDS))
    drawn = [
        rows.where(F.col("learn") & (F.col("kind") == kind) & (F.col("label") == label)).orderBy("place", *FEATURES).limit(share)
        for kind in range(len(KINDS))
        for label in (0.0, 1.0)
    ]
    learnt = materialize(reduce(DataFrame.unionAll, drawn).select(*FEATURES, "label").coalesce(1))
    if learnt.select("label").distinct().count() < 2:
        return Model((), {})
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(learnt)
    booster = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7)
    fitted = booster.fit(vectors.select("features", "label"))
    trees = tuple(_nested(t._java_obj.rootNode(), w) for t, w in zip(fitted.trees, fitted.treeWeights, strict=True))
    model = Model(trees, {})
    scored = rows.where(~F.col("learn") & F.col("possible")).withColumn("bin", F.floor(model.score(F.col) * BINS).cast("int"))
    bins = scored.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("labelled")).collect()
    own = {kind: [(r["bin"], r["n"], r["labelled"]) for r in bins if r["kind"] == kind] for kind in range(len(KINDS))}
    return Model(trees, {kind: bar for kind, found in own.items() if (bar := threshold(found)) is not None})


def labelled_share(bins: list[tuple[int, int, float]]) -> float:
    """Share of the true candidates that is labelled, from (bin, candidates, labelled ones): the labelled share at a score,
    averaged over the labelled ones."""
    labelled = sum(t for _, _, t in bins)
    return sum(t * t / n for _, n, t in bins) / labelled if labelled else 0.0


def threshold(bins: list[tuple[int, int, float]]) -> float | None:
    """Least score from which on PRECISION of the candidates are true; None where there is none."""
    share = labelled_share(bins)
    if share < LEAST_SHARE:
        return None
    bar, n, labelled = None, 0, 0.0
    for place, own, hits in sorted(bins, reverse=True):
        n, labelled = n + own, labelled + hits
        if labelled >= SUPPORT and min(n, labelled / share) >= PRECISION * n:
            bar = place / BINS
    return bar


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans, array<struct<start, kind, end>> each, sorted; one row per row of ``docs``."""
    found = materialize(find(docs))
    model = fit(found)
    fresh = lambda c: c["possible"] & model.accepts(c) & ~_on_base(c, F.col("blocks"))
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    added = F.transform(F.filter("candidates", fresh), span)
    return found.select("doc_id", "base", F.array_sort(added).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span of a sorted array replaced by its kind in brackets; overlaps go with the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        taken = F.struct(F.concat(acc["out"], between, F.get(names, s["kind"])).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= acc["at"], taken).otherwise(
            F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
        )

    rest = lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int")))
    return F.aggregate(spans, begin, step, rest)


__all__ = ["KINDS", "Model", "count_of", "find", "fit", "luhn", "personal_data", "redacted", "written"]
