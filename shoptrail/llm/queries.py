"""The queries of the training-data operators, over whole tables, and their SQL oracles."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import (
    decontaminate, fingerprints, hard_negatives, language_model, manifest, mixing, near_dups, quality, sentence_pieces,
    surrogates, token_counts, toxicity, url_filter,
)
from shoptrail.llm.common import remainder
from shoptrail.llm.oracles import ORACLES as ORACLES

KEY = "registered-query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_recurrent_lm(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = language_model.score(docs, *language_model.fit(docs.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_template_decontamination(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_offset_token_counts(spark, sf_dir):
    """Tokens of every line of every document; a token that crosses lines goes to the line it starts in."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op4_piecewise_fingerprints(spark, sf_dir):
    return fingerprints.against_next(_table(spark, sf_dir, "documents"))


def op5_hash_threshold_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


# The rules of the query's contract: host, path, verdict.
URL_RULES = [
    ("net", "/", url_filter.BLOCK),
    ("example.net", "/en/", url_filter.ALLOW),
    ("example.com", "/de/", url_filter.BLOCK),
    ("org", "/fr/", url_filter.ALLOW),
]


def op6_url_ngrams(spark, sf_dir):
    """There is no table of labelled URLs: the pages that a rule fits, with its verdict, are the labelled rows."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    ruled = pages.select("url", url_filter.longest_rule(host, path, URL_RULES)["verdict"].alias("verdict"))
    return url_filter.judged(pages, URL_RULES, url_filter.fit(ruled))


def op7_pii_surrogates(spark, sf_dir):
    return surrogates.pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op8_weak_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op9_tensored_minhash(spark, sf_dir):
    """Sets of four-word shingles, as the query's contract asks; the operator's own default is five."""
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op10_additive_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_documents(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op11_sentence_pieces(spark, sf_dir):
    """``agrees``: the sentencepiece library gives the same ids and the same text."""
    done = sentence_pieces.round_trip(_table(spark, sf_dir, "documents"), sentence_pieces.read_model())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    digests = F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), *digests, "agrees")


def op12_inverted_multi_index(spark, sf_dir):
    return hard_negatives.hard_negatives(hard_negatives.prepared(_table(spark, sf_dir, "embeddings")))


def op13_merkle_manifest(spark, sf_dir):
    return manifest.manifest(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [
    op1_recurrent_lm,
    op2_template_decontamination,
    op3_offset_token_counts,
    op4_piecewise_fingerprints,
    op5_hash_threshold_mix,
    op6_url_ngrams,
    op7_pii_surrogates,
    op8_weak_toxicity,
    op9_tensored_minhash,
    op10_additive_quality,
    op11_sentence_pieces,
    op12_inverted_multi_index,
    op13_merkle_manifest,
    pipeline,
]
