import random

import pytest

from reelrank.llm import decontaminate as dc


def least(pattern, text):
    """Edit distance of ``pattern`` to any stretch of ``text``, by the table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != w), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_vectors_like_the_table():
    rng = random.Random(5)
    for _ in range(300):
        pattern = [rng.choice("abc") for _ in range(rng.randint(1, 70))]
        text = [rng.choice("abcd") for _ in range(rng.randint(0, 90))]
        assert dc.least_distance(pattern, text) == least(pattern, text)


@pytest.fixture(scope="module")
def case(prose):
    rng = random.Random(2)
    items = [(i, prose(1000 + i, 10 + i)) for i in range(12)] + [(90, "too short"), (91, None), (None, prose(5, 20))]
    items += [(92, items[0][1]), (93, "Short one, of 5!"), (94, "quite"), (95, "five of seven words may not differ"), (96, " - ")]
    rows = []
    for d in range(120):
        words = prose(d, 60).split(" ")
        item = items[d % 12][1].split(" ")
        for _ in range(rng.randint(0, 5)):
            at, what = rng.randrange(len(item)), rng.randrange(3)
            item = item[:at] + ["odd"] * (what < 2) + item[at + (what > 0) :]
        text = " ".join(words[:20] + item + words[20:])
        rows.append((d, text.upper().replace(" ", ", ") if d % 3 else text))
    rows += [(200, "it is TOO -- short"), (201, "too long, short"), (202, "a short one of 5 words"), (203, "short one of 6")]
    rows += [(204, "Quite."), (205, "quiet"), (206, "five of eight words may not differ"), (207, f"x {prose(5, 20)} y")]
    return items, rows


def test_finds_every_passage_within_the_budget(spark, make_docs, case):
    items, rows = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, text in rows:
        for i, item in items:
            words = dc.words_of(item)
            distance = least(words, dc.words_of(text)) if words else None
            if i is not None and words and distance <= (int(dc.RATE * len(words)) if len(words) >= 8 else 0):
                want[(d, i)] = distance
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.contaminated(make_docs(rows), benchmark).collect()}
    assert got == want and len(set(want.values())) > 2
    # In several blocks of items the rows are the same.
    split = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.contaminated(make_docs(rows), benchmark, chars=300).collect()}
    assert split == want
    kept = {r["doc_id"] for r in dc.clean(make_docs(rows), benchmark, chars=300).collect()}
    # Documents that hold the item without an id go too.
    nameless = next(dc.words_of(item) for i, item in items if i is None)
    unnamed = {d for d, text in rows if least(nameless, dc.words_of(text)) <= int(dc.RATE * len(nameless))}
    assert 207 in unnamed and 207 not in {d for d, _ in want}
    assert kept == {d for d, _ in rows} - {d for d, _ in want} - unnamed
    assert {(200, 90), (202, 93), (204, 94)} <= set(want) and not {d for d, _ in want} & {201, 203, 205, 206}


def test_odd_rows(spark, make_docs, odd_rows):
    item = " ".join(next(t for i, t in odd_rows if i == 5).split()[4000:4020])
    benchmark = spark.createDataFrame([(1, item), (2, ""), (None, None)], "item_id long, text string")
    docs = make_docs(odd_rows)
    assert [(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark).collect()] == [(5, 1)]
    cleaned = dc.clean(docs, benchmark)
    assert cleaned.columns == docs.columns and cleaned.count() == len(odd_rows) - 1
    assert dc.clean(docs, benchmark.limit(0)).count() == len(odd_rows)
    assert dc.contaminated(docs.limit(0), benchmark).count() == 0


def test_planted_passages(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark).collect()}
    items = [(r["item_id"], f" {' '.join(dc.words_of(r['text']))} ") for r in benchmark.collect()]
    texts = [(r["doc_id"], f" {' '.join(dc.words_of(r['text']))} ") for r in docs.collect()]
    assert {(d, i) for d, t in texts for i, item in items if item in t} <= got
