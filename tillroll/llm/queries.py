"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    bpe, chat, crossent, fmindex, lexical, linejoin, quality, sigtree, suffixes, tokenio, toxicity, unigram,
    whitening,
)
from tillroll.llm.common import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality ledger of all documents: measurements, failure bits, verdict."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.apply_policy(quality.quality_ledger(docs))
    return judged.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        f"(fail_bits & {quality.BASE_MASK}L) <> 0 AS base_failed", "kept", "n_lines", "fail_bits",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, trained on labelled rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = toxicity.fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, fitted)
    return scored.selectExpr("doc_id", f"{toxicity.HELD_OUT} AS held_out", "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that an earlier line matches, by exact set-similarity join."""
    return linejoin.line_digest(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss difference of all documents between the model of the documents labelled
    as good (for those: of the others among them) and the model of all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    wanted = read_table(spark, sf_dir, "labels").where("quality = 1")
    vocab = crossent.vocabulary(docs)
    return crossent.score(docs, crossent.fit(docs, wanted, vocab), vocab, leave_out=True)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases found in all documents by one FM-index per shard."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fmindex.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.selectExpr(
        "doc_id", "n_words", "n_hit", "CAST(size(item_ids) AS BIGINT) AS n_items",
        "sha2(array_join(item_ids, ','), 256) AS items_sha256", "n_hit > 0 AS contaminated",
    )


# a conversation whose texts consist of control strings of a common template
CONTROL_CONVERSATION = (
    "SELECT inline(array(named_struct('conv_id', -7L, 'turn', 0L, 'role', 'user', 'text', '</s>[INST] ok [/INST]'), "
    "named_struct('conv_id', -7L, 'turn', 1L, 'role', 'assistant', 'text', '</s>[INST] ok [/INST]')))"
)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back from the formatted segments."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.union(spark.sql(CONTROL_CONVERSATION))))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-byte strings of all documents that also start in an earlier document."""
    return suffixes.dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingle similarity of 0.9."""
    return sigtree.jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, share=90)


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as id segments with Elias-Fano boundaries, read back from the files."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenio.write_tokens(docs, _tokenizer("byte_bpe_50k.json"))
    return tokenio.read_tokens(spark, path)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to piece ids by unigram Viterbi and decoded again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram.encode_digest(docs, _tokenizer("piece_bpe_32k.model"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened coordinates of all usable embeddings."""
    packed = whitening.pack(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    fitted = whitening.fit(packed, components=4)
    shares = ", ".join(f"CAST({v / fitted.trace!r} AS DOUBLE)" for v in fitted.values.tolist())
    rows = whitening.whiten(packed, fitted).selectExpr("vec_id", "deviation", "posexplode(whitened) AS (at, whitened)")
    return rows.selectExpr(
        "vec_id", "at + 1 AS component", f"CAST({fitted.n} AS BIGINT) AS n", "deviation", "whitened",
        f"array({shares or 'CAST(NULL AS DOUBLE)'})[at] AS explained", f"CAST({fitted.identity_error!r} AS DOUBLE) AS identity_error")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"), places=20)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to byte-level BPE ids by pair occurrences and decoded again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_and_decode(docs, _tokenizer("byte_bpe_50k.json"))
    return coded.selectExpr(
        "doc_id", "n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(CAST(decoded AS BINARY), 256) AS decoded_sha256")


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_toxicity, op3_line_dedup, op4_cross_entropy, op5_decontamination, op6_substring_dedup,
    op7_jaccard_join, op8_token_ids, op9_chat_format, op10_sentencepiece,
    op11_whitening, op12_lexical_search, op13_bpe,
)}
