"""One thin query per operator: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.sources.tables import read_table


def tokenizer(name: str) -> str:
    """A public tokenizer's JSON (the path is a parameter of the query)."""
    import public_tokenizers

    from reviewlake.llm.tokens import tokenizer_json
    return tokenizer_json(public_tokenizers.path(name))


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as binary shards and read back."""
    from reviewlake.llm.token_binary import read_tokens, write_token_ids
    folder, manifest = write_token_ids(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"),
                                       end_id=2, n_ids=49_408)
    return read_tokens(spark, folder, manifest)


def op2_cap_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at a cosine of 0.95 or more."""
    from reviewlake.llm.cap_neardup import embedding_near_duplicates
    return embedding_near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose repeated sentence spans: what stays, what was
    removed and which documents keep it."""
    from reviewlake.llm.sentence_spans import remove_repeats
    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), changed_only=True)
    return out.select("doc_id", "text", "removed", "first_ids")


def op4_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose repeated passages of 50 words or more: what stays,
    what was removed and which documents keep it."""
    from reviewlake.llm.sparse_suffix import changed_texts
    out = changed_texts(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "text", "removed", "first_ids")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's shingles."""
    from reviewlake.llm.decontaminate import contaminated
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), threshold=0.8)


#: verdict, host, path
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op6_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    from reviewlake.llm.url_filter import judge_urls, rules_table
    return judge_urls(read_table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    from reviewlake.llm.packing import Limits, pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0,
                          limits=Limits(tokens=1024, segments=512, loss=1024))


def op8_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 3 bits."""
    from reviewlake.llm.simhash_vp import simhash_components
    return simhash_components(read_table(spark, sf_dir, "documents"), words=3, max_distance=3)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    from reviewlake.llm.quality import fit, score_documents
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, read_table(spark, sf_dir, "labels")), threshold=0.3)


def op10_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from reviewlake.llm.pii import find_pii
    return find_pii(read_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in every order."""
    from reviewlake.llm.filter_audit import audit_filters
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    from reviewlake.llm.kd_shards import place
    placed = place(read_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_ptolemy_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all usable embeddings after ten rounds."""
    from reviewlake.llm.ptolemy_clusters import cluster, with_inertia
    assigned, centroids = cluster(read_table(spark, sf_dir, "embeddings"), k=8, rounds=10)
    return with_inertia(assigned, centroids).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                                                    "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_binary, op2_cap_neardup, op3_sentence_spans, op4_sparse_suffix, op5_decontaminate, op6_url_redirects,
        op7_vector_packing, op8_simhash_vp, op9_quality, op10_pii_anchors, op11_filter_audit, op12_kd_shards,
        op13_ptolemy_clusters,
    )
}
