"""Training-data pipeline over ``documents``.

Stages, in order: quality classifier, SimHash near-dedup, benchmark
decontamination, PII redaction, packing.  Each is written as Parquet in the
shared checkpoint folder and read back as the next one's input, so a lost
executor costs tasks, not stages.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlake.llm.common import stage
from reviewlake.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    from reviewlake.llm.quality import filter_quality, fit
    return filter_quality(docs, fit(docs, read_table(spark, sf_dir, "labels")), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each SimHash component."""
    from reviewlake.llm.simhash_vp import near_duplicates
    return near_duplicates(docs, words=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from reviewlake.llm.decontaminate import drop_contaminated
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), threshold=0.8)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    from reviewlake.llm.pii import redact
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    from reviewlake.llm.packing import Limits, pack_documents
    from reviewlake.llm.queries import tokenizer
    return pack_documents(docs, tokenizer("byte_bpe_50k.json"), end_id=0, limits=Limits(tokens=1024, segments=512, loss=1024))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("pii", redact_pii),
    ("packing", pack),
]

#: The first stage is a trained network, which SQL cannot express; the
#: pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return stage(STAGES[-1][1](spark, docs, sf_dir), "packed")
