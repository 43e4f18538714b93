"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import bpe, convnet, decontaminate, fim, hmm, language, neardup, notices, packing, pii, resample, rules, substring
from lakestrata.llm.common import remainder, table
from lakestrata.llm.sql import ORACLE  # noqa: F401  (registered beside QUERIES)

#: The vocabulary of the tokenizer queries.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The tokenizer of the packing query.
PACKED_VOCABULARY = "word_bpe_49k.json"


def vocabulary(spark: SparkSession) -> tuple[dict[bytes, int], str]:
    import public_tokenizers
    return bpe.read_ranks(spark, public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    ranks, pattern = vocabulary(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.with_token_digests(docs, ranks, pattern).select("doc_id", "bpe.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learnt where crc32(doc_id) mod 7 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hmm.score(docs, remainder("doc_id", 7) != 2).select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows that a smaller id has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.without_repeats(docs).select(
        "doc_id", "unrepeated.n_words", "unrepeated.n_removed",
        F.sha2(F.col("unrepeated.kept_text"), 256).alias("kept_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.classes(table(spark, sf_dir, "documents"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the pattern spans of every document, and all spans found."""
    docs = table(spark, sf_dir, "documents")
    tagged = pii.with_spans(docs.select("doc_id", "text"), pii.train(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return tagged.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"),
                         pii.listed(F.col("spans")).alias("spans"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    samples = language.learn(docs.where(remainder("doc_id", 4) != 2))
    return (language.with_language(docs.select("doc_id", "text"), samples)
            .select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "language.*"))


def op8_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the phrases in every document, and the labels of these and of the notices found."""
    found = notices.with_notices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans, base = F.col("notices.spans"), F.filter("notices.spans", lambda s: s["base"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id", "notices.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["similarity"])), F.lit(0.0)).alias("score"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the place of their best overlap."""
    return decontaminate.leaky_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt where crc32(doc_id) mod 5 is not 0."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = convnet.train(docs, labels.where(remainder("doc_id", 5) != 0))
    return (convnet.with_quality(docs, model)
            .select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= convnet.THRESHOLD).cast("int").alias("predicted")))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document in its fill-in-the-middle form, and of the text restored from it."""
    return fim.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    import public_tokenizers
    tokenizer = packing.read_tokenizer(spark, public_tokenizers.path(PACKED_VOCABULARY))
    return (packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer, keep_ids=False)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document towards the benchmark's words, and the rank of those drawn."""
    return (resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


QUERIES = {
    "op1_bpe_roundtrip": op1_bpe_roundtrip,
    "op2_quality_rules": op2_quality_rules,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_pii": op6_pii,
    "op7_language": op7_language,
    "op8_notices": op8_notices,
    "op9_decontamination": op9_decontamination,
    "op10_quality_net": op10_quality_net,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_importance_resampling": op13_importance_resampling,
}
