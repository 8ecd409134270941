import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelrank.llm import packing, queries, token_codes, tokens

FILES = {"word_bpe_49k.json": tokens.WORDS, "byte_bpe_50k.json": tokens.BYTES}


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    return tokens.Encoder(path, FILES[request.param]), Tokenizer.from_file(path)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from(" \n\t\r'sSdlLtTrevm.,;!?0123_-\"éÉßñŒž~ab\\/#$İſΣ½Ⅷ̇ \U0001f600")))
def test_ids_are_the_librarys(both, text):
    encoder, library = both
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == ids(library, text)


ADDED = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "endoftext", "|>", " ", "\n", "a", "'s", "1", ".", "é", "Σ"]


@settings(max_examples=400, deadline=None)
@given(text=st.lists(st.sampled_from(ADDED)).map("".join))
def test_added_tokens_are_the_librarys(both, text):
    encoder, library = both
    for t in (text, f"a {text}<|endoftext|> b<|startoftext|>"):
        assert np.frombuffer(encoder.ids([t])[0], "<u4").tolist() == ids(library, t)


def test_whole_documents_and_long_words(both, spark, sf_dir, odd_rows):
    encoder, library = both
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [t for _, t in odd_rows]
    for text, raw in zip(texts, encoder.ids(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == ids(library, text)


def test_forgetting_changes_nothing(both, spark, sf_dir, monkeypatch):
    encoder, library = both
    monkeypatch.setattr(encoder, "remembered", 50)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20).collect():
        assert np.frombuffer(encoder.ids([r["text"]])[0], "<u4").tolist() == ids(library, r["text"])


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 4097, 600), rng.integers(1, 60, 3000), np.full(50, 4096)])
    capacity = packing.Capacity(4096, 24, 9_000_000, rule=rule)
    fits = lengths[lengths**2 <= capacity.attention]
    number, offset = packing.best_fit(fits, capacity)
    for s in np.unique(number):
        own = fits[number == s]
        assert own.sum() <= 4096 and len(own) <= 24 and (own**2).sum() <= 9_000_000
        starts = np.sort(offset[number == s])
        assert starts[0] == 0 and sorted(starts) == sorted(np.cumsum(own[np.argsort(offset[number == s])]) - own[np.argsort(offset[number == s])])
    plain, _ = packing.best_fit(lengths, packing.Capacity(rule=rule))
    assert len(np.unique(plain)) <= 1.02 * np.ceil(lengths.sum() / 4096) + 1


def test_packing_query(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole = {r["doc_id"]: [*ids(library, r["text"]), 1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op9_packing(spark, sf_dir).toPandas()
    assert len(rows) == sum(-(-len(v) // 4096) for v in whole.values())
    for r in rows.itertuples():
        own = whole[r.doc_id][r.start : r.start + 4096]
        assert r.start == 4096 * r.piece and r.length == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 4096 and (s.offset == s.length.cumsum() - s.length).all()
    assert rows.sequence_id.nunique() <= 1.01 * -(-rows.length.sum() // 4096) + 1


def test_packing_odd_rows_and_sequences(make_docs, odd_rows):
    path, docs = public_tokenizers.path("word_bpe_49k.json"), make_docs(odd_rows)
    library = Tokenizer.from_file(path)
    capacity = packing.Capacity(tokens=512, attention=512 * 512)
    cut = packing.pieces(docs, path, tokens.WORDS, 1, 512, keep_ids=True).cache()
    packed = packing.pack(cut, capacity, group=20).cache()
    want = sorted(len(ids(library, t)) + 1 for _, t in odd_rows)
    assert sum(want) == packed.agg({"length": "sum"}).first()[0]
    assert packed.where("doc_id = 1").select("length", "offset").first()["length"] == 1
    made = packing.sequences(cut.where("doc_id = 5"), packed.where("doc_id = 5")).collect()
    assert sorted(i for r in made for i in r["ids"]) == sorted([*ids(library, dict(odd_rows)[5]), 1])
    assert all(len(r["ids"]) <= 512 for r in made)
    assert packing.pack_documents(docs.limit(0), path, tokens.WORDS, 1, capacity).count() == 0


@settings(max_examples=100, deadline=None)
@given(values=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_random_access(values):
    codes = token_codes.Codes(token_codes.encoded(np.array(values, dtype=np.uint32)))
    assert codes.all().tolist() == values and len(codes) == len(values)
    for i in range(0, len(values), 37):
        assert codes.at(i) == values[i]


def test_token_files(spark, make_docs, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_codes, "PART_DOCS", 4)
    monkeypatch.setattr(token_codes, "BLOCK_IDS", 100)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    token_codes.write(make_docs(odd_rows), f"file://{tmp_path}/a", path, tokens.BYTES, 0)
    got = token_codes.read(spark, f"file://{tmp_path}/a").collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for doc_id, text in order:
        own = [*ids(library, text), 0]
        want.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    token_codes.write(make_docs(odd_rows).limit(0), f"file://{tmp_path}/b", path, tokens.BYTES, 0)
    assert token_codes.read(spark, f"file://{tmp_path}/b").count() == 0


def test_token_files_query(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r["doc_id"]: tuple(r) for r in queries.op10_token_codes(spark, sf_dir).collect()}
    start = 0
    for doc_id, text in docs:
        own = [*ids(library, text), 0]
        assert got[doc_id] == (doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    assert len(got) == len(docs)
