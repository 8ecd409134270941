"""Near-duplicate lines by a deletion-neighbourhood join over words.

A line is the sequence of its words. Two lines are alike when they are equal or, from NEAR_WORDS words on,
when one word put in, left out or replaced makes them equal. Leaving out any one word of a line gives its
variants; two lines are within one edit exactly when they share a variant made at the same place (a word
replaced) or when a variant of one is the other (a word put in). Lines and variants are hashed and equal
hashes joined, with minima in place of pairs: a key carries the earliest line that has it.

Before any variant is made, lines that cannot have a partner go: an edit leaves the front or the back half
of a line as it is, so only lines that share a hashed half with another line (of the fitting length) emit
variants. What the join finds is verified on the words. Of alike lines the earliest stays, by (doc_id,
hash of the text, line number); a line goes if any earlier line, kept or not, is alike.

Defined results: a null text stays null and has no lines. Blank lines are left alone, and lines of fewer
words than ``min_words`` (MIN_WORDS: every line with a word is compared). Rows of one doc_id and one text are one document, their lines judged alike; null doc_ids come last. A
document all of whose lines go keeps its row, with an empty text. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import fresh, in_small_batches, sent
from reelrank.session import materialize

MIN_WORDS = 1
NEAR_WORDS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
LINE = ["doc", "body", "line"]


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda w: w != "")


def _identity(doc_id: str, text: str) -> list[Column]:
    """What a document is known by: its id (nulls last) and the hash of its text."""
    last = F.lit(2**63 - 1)
    return [F.coalesce(F.col(doc_id).cast("long"), last).alias("doc"), F.xxhash64(text).alias("body")]


def _hashed_lines(batches: Iterator[pd.DataFrame], min_words: int) -> Iterator[pd.DataFrame]:
    """One row per line that counts: its place, 128 bits of hash of its words, and hashes of its halves.

    Halves are hashed for partners as long or one word longer (of ``n``), and one word shorter (of ``n - 1``).
    """
    whole, half = xxhash.xxh3_128_digest, xxhash.xxh3_64_digest
    for batch in batches:
        at, line, lines, halves = [], [], [], []
        for row, text in enumerate(batch["text"]):
            for number, raw in enumerate(text.encode("utf-8", "replace").split(b"\n")):
                words = raw.split()
                n = len(words)
                if n < max(1, min_words):
                    continue
                at.append(row)
                line.append(number)
                lines.append(whole(b" ".join(words)))
                if n < NEAR_WORDS:
                    halves.append(bytes(32))
                    continue
                for length in (n, n - 1):
                    front = length // 2
                    halves.append(half(b"<%d " % length + b" ".join(words[:front])))
                    halves.append(half(b">%d " % length + b" ".join(words[n - length + front :])))
        hashes = np.frombuffer(b"".join(lines), dtype="<i8").reshape(-1, 2)
        keys = np.frombuffer(b"".join(halves), dtype="<i8").reshape(-1, 4)
        yield pd.DataFrame({
            "doc": batch["doc"].to_numpy()[at] if at else np.zeros(0, dtype=np.int64),
            "body": batch["body"].to_numpy()[at] if at else np.zeros(0, dtype=np.int64),
            "line": np.array(line, dtype=np.int32),
            "h": hashes[:, 0],
            "g": hashes[:, 1],
            **{f"k{i}": keys[:, i] for i in range(4)},
        })


#: Halves of a line, zeros where it has too few words to have near lines.
HALVES = ["k0", "k1", "k2", "k3"]


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc, body, line, two hashes of the words (h, g) and the halves, for every line that counts."""
    rows = docs.where(F.col(text).isNotNull()).select(*_identity(doc_id, text), F.col(text).alias("text"))
    schema = "doc long, body long, line int, h long, g long, k0 long, k1 long, k2 long, k3 long"
    return in_small_batches(rows).mapInPandas(lambda batches: _hashed_lines(batches, min_words), schema)


def _partnered(distinct: DataFrame) -> DataFrame:
    """The distinct lines that share a half with another one."""
    keyed = distinct.where("k0 <> 0").select("h", "g", F.explode(F.array(*HALVES)).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("key")
    return keyed.join(shared, "key").select("h", "g").distinct()


def _per_document(lines: DataFrame) -> DataFrame:
    """``lines`` (doc, body, line) as one row per document with ``numbers``, stored, sent whole if small."""
    listed = materialize(lines.groupBy("doc", "body").agg(F.collect_set("line").alias("numbers")))
    return sent(listed, listed.agg(F.sum(F.size("numbers"))).first()[0] or 0)


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, body, line, words of the lines in ``wanted`` (doc, body, line)."""
    texts = docs.select(*_identity("doc_id", "text"), F.col("text")).where(F.col("text").isNotNull())
    held = texts.join(_per_document(wanted), ["doc", "body"]).dropDuplicates(["doc", "body"])
    rows = held.select("doc", "body", F.split("text", "\n").alias("all"), F.explode("numbers").alias("line"))
    return rows.select(*LINE, _words(F.get("all", F.col("line"))).alias("words"))


def variants(words: list[str]) -> np.ndarray:
    """Hash of the sequence of words, then of the sequence without word 0, 1, ...: sums of word hashes by place."""
    n = len(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in words), dtype=np.uint64, count=n)
    power = np.ones(n, dtype=np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power)
    here = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power)])
    moved = np.concatenate([[np.uint64(0)], np.cumsum(hashes[1:] * power[:-1])])  # of words 1.. one place to the front
    without = here[:-1] + (moved[-1] - moved)
    return np.concatenate([here[-1:], without]).view(np.int64)


def _neighbourhood(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [variants(list(w)) for w in batch["words"]]
        times = [len(m) for m in made]
        at = np.repeat(np.arange(len(batch)), times)
        place = np.concatenate([np.arange(-1, t - 1) for t in times]) if times else np.zeros(0, dtype=np.int64)
        yield pd.DataFrame({
            "key": np.concatenate(made) if made else np.zeros(0, dtype=np.int64),
            "place": place,
            **{c: batch[c].to_numpy()[at] for c in LINE},
        })


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word put in, left out or replaced makes the lists equal."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    front = next((i for i in range(n) if a[i] != b[i]), n)
    return list(a[front + 1 :]) == list(b[front + (len(a) == len(b)) :]) if len(a) >= len(b) else within_one(b, a)


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        kept = [within_one(list(a), list(b)) for a, b in zip(batch["words"], batch["other"], strict=True)]
        yield batch.loc[np.array(kept, dtype=bool), LINE]


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h, g of the distinct lines that have an earlier line within one edit.

    ``distinct``: h, g, first (struct of doc, body, line) and the halves, stored.
    """
    live = materialize(distinct.join(_partnered(distinct), ["h", "g"]).select("h", "g", "first.*"))
    texts = materialize(_fetched(docs, live))
    keys = materialize(texts.mapInPandas(_neighbourhood, "key long, place int, doc long, body long, line int"))
    at = F.struct(*LINE)
    # One row per key and place; a line is the whole of itself at place -1 only.
    places = keys.groupBy("key", "place").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    whole, cut = F.col("place") < 0, F.col("place") >= 0
    both = places.groupBy("key").agg(
        F.min(F.when(whole, F.col("first"))).alias("whole"), F.min(F.when(cut, F.col("first"))).alias("cut")
    )
    replaced = places.where(cut & (F.col("first") < F.col("last"))).select("key", "place", F.col("first").alias("keeper"))
    longer = both.where("whole is not null and cut is not null")
    hits = keys.join(replaced, ["key", "place"]).select(*LINE, "keeper")
    joined = keys.join(longer, "key").withColumn("keeper", F.when(cut, F.col("whole")).otherwise(F.col("cut")))
    hits = hits.unionAll(joined.select(*LINE, "keeper")).where(F.col("keeper") < at).distinct()
    other = texts.select(F.struct(*LINE).alias("keeper"), F.col("words").alias("other"))
    pairs = hits.join(texts, LINE).join(other, "keeper").select(*LINE, "words", "other")
    dropped = pairs.mapInPandas(_verified, "doc long, body long, line int").distinct()
    return live.join(dropped, LINE, "left_semi").select("h", "g")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, body, line of every line that goes."""
    lines = materialize(lines_of(docs, min_words=min_words))
    first = F.min(F.struct(*LINE)).alias("first")
    distinct = lines.groupBy("h", "g").agg(first, F.count(F.lit(1)).alias("n"), *[F.max(k).alias(k) for k in HALVES])
    distinct = materialize(distinct)
    near = materialize(near_lines(docs, distinct)).withColumn("near", F.lit(True))
    judged = distinct.join(near, ["h", "g"], "left").where("n > 1 or near").select("h", "g", "first", "near")
    found = lines.select("h", "g", *LINE).join(judged, ["h", "g"])
    return found.where(F.col("near").isNotNull() | (F.struct(*LINE) != F.col("first"))).select(*LINE)


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the later of alike lines taken out of ``text``, and two counts.

    Added: ``lines`` and ``dropped_lines`` (underscores before a name that is taken).
    """
    doc, body, numbers = fresh(docs, "doc"), fresh(docs, "body"), fresh(docs, "numbers")
    lines, dropped = fresh(docs, "lines"), fresh(docs, "dropped_lines")
    gone = _per_document(repeated_lines(docs, min_words)).withColumnsRenamed({"doc": doc, "body": body, "numbers": numbers})
    identity = _identity("doc_id", "text")
    named = docs.withColumns({doc: identity[0], body: identity[1]})
    # The hint stays with the small side.
    joined = named.join(gone, [doc, body], "left")
    touched = F.col(numbers).isNotNull()
    # A column of its own, or every line would split the text anew.
    cut = fresh(joined, "cut")
    joined = joined.withColumn(cut, F.when(touched, F.split("text", "\n")))
    places = F.sequence(F.lit(0), F.size(cut) - 1)
    kept = F.array_join(F.transform(F.array_except(places, F.col(numbers)), lambda i: F.get(F.col(cut), i)), "\n")
    counted = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    out = joined.withColumns({
        lines: F.coalesce(counted, F.lit(0)).cast("long"),
        dropped: F.when(touched, F.size(numbers)).otherwise(0).cast("long"),
    })
    return out.withColumn("text", F.when(touched, kept).otherwise(F.col("text"))).select(*docs.columns, lines, dropped)


__all__ = ["dedupe_lines", "repeated_lines", "variants", "within_one"]
