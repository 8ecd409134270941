import pytest

from reelrank.llm import line_dedup


def near(a, b):
    return a == b or min(len(a), len(b)) >= line_dedup.NEAR_WORDS and line_dedup.within_one(a, b)


def brute(rows):
    """Kept lines per row by comparing every line with every earlier one."""
    order = {}
    for doc_id, text in rows:
        if text is not None:
            for i, line in enumerate(text.split("\n")):
                words = line.split()
                if len(words) >= line_dedup.MIN_WORDS:
                    order[(doc_id, i)] = words
    places = sorted(order)
    gone = {p for k, p in enumerate(places) if any(near(order[p], order[q]) for q in places[:k])}
    kept = {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    return kept, len(gone)


@pytest.fixture(scope="module")
def rows(prose):
    lines = [prose(i, 8 + i % 9) for i in range(12)] + ["short line", "", "one two three four", "a b c d e f g"]
    out = []
    for d in range(40):
        own = []
        for k in range(6):
            words = lines[(d * 7 + k * 5) % len(lines)].split(" ")
            edit = (d + k) % 5
            at = (d * 3 + k) % len(words)
            if edit == 1:
                words[at] = f"new{d}"
            elif edit == 2:
                words.insert(at, f"in{d}")
            elif edit == 3 and len(words) > 1:
                words.pop(at)
            own.append("  ".join(words) if edit == 4 else " ".join(words))
        out.append((d, "\n".join(own)))
    return out


def test_like_comparing_all_lines(make_docs, rows):
    want, gone = brute(rows)
    got = line_dedup.dedupe_lines(make_docs(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert sum(r["_dropped_lines"] for r in got) == gone > 0


def test_same_rows_when_nothing_is_sent_whole(make_docs, rows, monkeypatch):
    from reelrank.llm import frames

    monkeypatch.setattr(frames, "SENT", -1)
    got = line_dedup.dedupe_lines(make_docs(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == brute(rows)[0]


def test_variants_meet_exactly_within_one_edit(prose):
    a = prose(3, 12).split(" ")
    for i in range(12):
        swapped, longer, shorter = a[:i] + ["other"] + a[i + 1 :], a[:i] + ["other"] + a[i:], a[:i] + a[i + 1 :]
        va, vs, vl = line_dedup.variants(a), line_dedup.variants(swapped), line_dedup.variants(longer)
        assert va[i + 1] == vs[i + 1] and vl[i + 1] == va[0] and va[i + 1] == line_dedup.variants(shorter)[0]
        assert all(line_dedup.within_one(a, x) and line_dedup.within_one(x, a) for x in (swapped, longer, shorter))
    assert not line_dedup.within_one(a, a[1:] + a[:1]) and not line_dedup.within_one(a, a[2:])


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = line_dedup.dedupe_lines(docs)
    assert got.columns == [*docs.columns, "_lines", "_dropped_lines"]
    out = got.collect()
    assert len(out) == len(odd_rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    assert by_id[1] == [None] and by_id[2] == [""]
    assert sorted(by_id[4]) == sorted(t for i, t in odd_rows if i == 4)  # repeated rows are one document
    assert all(r["doc"] == "own doc" for r in out)
    assert line_dedup.dedupe_lines(docs.limit(0)).count() == 0


def test_document_that_loses_all_lines_stays(make_docs):
    got = line_dedup.dedupe_lines(make_docs([(2, "a b c d e"), (1, "a b  c d e"), (None, "a b c d e\nx")], clashing=False)).collect()
    assert {r["doc_id"]: (r["text"], r["lines"], r["dropped_lines"]) for r in got} == {1: ("a b  c d e", 1, 0), 2: ("", 1, 1), None: ("x", 2, 1)}


def test_short_lines_repeat_too(make_docs):
    rows = [(1, "Les.\nsee more\n\n\n一行沒有空格的文字"), (2, "Les.\n  see  more \n\n\n一行沒有空格的文字\nLes!"), (3, "see\nLes.")]
    got = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in line_dedup.dedupe_lines(make_docs(rows, clashing=False)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\n\nLes!", 3), 3: ("see", 1)}
    kept = line_dedup.dedupe_lines(make_docs(rows), 4).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == dict(rows)
