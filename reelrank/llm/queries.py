"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import chat, decontaminate, language, line_dedup, merkle, packing, pii, quality, runs, secrets, simhash, token_codes, tokens, topk
from reelrank.llm.frames import sha256_of
from reelrank.session import materialize, shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base spans, and all spans."""
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    everything = pii.written(F.array_sort(F.concat("base", "added")))
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), everything.alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier line equals or nearly equals."""
    made = line_dedup.dedupe_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "lines", "dropped_lines", F.sha2("text", 256).alias("text_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that stands in a document, and how far from its words."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for each vector whose id is divisible by 50."""
    vectors = topk.quantized(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return topk.top_k(vectors.where(F.col("id") % 50 == 0), vectors, 5)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learnt from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    trees = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    scored = docs.withColumn("score", quality.scorer(trees)(F.col("text")))
    predicted = (F.col("score") >= quality.ACCEPT).cast("int")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), simhash.WIDTH, simhash.BITS)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


CONTROL_CONVERSATION = """
    SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
    FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
"""


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(CONTROL_CONVERSATION))
    made = chat.format_conversations(turns)
    read = made.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss_text": chat.loss_text(F.col("formatted"), F.col("loss"))})
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_of(lines).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: base spans, and all spans."""
    found = secrets.secrets(_table(spark, sf_dir, "documents"))
    counts = [secrets.count_of("base", k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)]
    everything = secrets.written(F.array_sort(F.concat("base", "added")))
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), everything.alias("spans"))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, word_tokenizer(), tokens.WORDS, 1, packing.Capacity(tokens=4096))


def op10_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    path = f"{shared_folder(spark)}/token-codes-{uuid.uuid4().hex}"
    token_codes.write(_table(spark, sf_dir, "documents"), path, byte_tokenizer(), tokens.BYTES, 0)
    return token_codes.read(spark, path)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    found = docs.withColumn("found", language.predictor(model)(F.col("text")))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by source, and the proof of every document, of half of them tampered with."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in docs.columns]
    altered = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.withColumn("digest", merkle.digest(*fields)).select(
        "doc_id", "source", "digest", F.when(tampered, merkle.digest(*fields[:-1], altered)).otherwise(F.col("digest")).alias("given")
    )
    found = merkle.proofs(merkle.manifest(materialize(leaves), "source", ["doc_id"]))
    made = found.withColumns({"proof_sha256": merkle.path_digest(F.col("path")), "folded_root": merkle.folded(F.col("given"), F.col("path"))})
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return made.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", verified)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where crc32(doc_id) ends in 0 with words from some place on repeating a shorter stretch."""
    h = F.crc32(F.col("doc_id").cast("string"))
    numbers = docs.withColumn("_h", h).withColumn("_w", F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    sized = numbers.withColumn("_n", F.size("_w").cast("long")).withColumn("_g", F.expr("_h div 10"))
    placed = sized.withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n")))
    placed = placed.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    made = F.expr("""array_join(concat(slice(_w, 1, int(_a)),
        slice(flatten(array_repeat(slice(_w, int(_a + 1), int(_p)), int((_n - _a) div _p + 1))), 1, int(_n - _a))), ' ')""")
    return placed.select("doc_id", F.when(F.expr("_h % 10 = 0 AND _n > 0"), made).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, and their texts without the repetitions."""
    found = runs.periodic_runs(with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    written = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(written, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", runs.longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_topk": op4_topk,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_secrets": op7_secrets,
    "op8_chat": op8_chat,
    "op9_packing": op9_packing,
    "op10_token_codes": op10_token_codes,
    "op11_language": op11_language,
    "op12_merkle": op12_merkle,
    "op13_runs": op13_runs,
}
