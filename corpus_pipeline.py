"""From raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir) over all rows that its
predecessor kept.  Every stage's rows are written as Parquet and read again,
so a lost executor repeats one stage at most.  All stages but the last return
the columns of ``documents``:

quality          documents that the classifier rejects go
near_dedup       one document of each group of near copies stays
decontaminate    documents with a benchmark passage go
pii              personal data is masked by its kind
pack             pieces of sequences of 2048 tokens

Stages that keep or drop rows keep their columns, whatever extra ones there
are and however they are named.  Null texts are empty ones: the classifier
scores them, no near copy or passage is found in them, masking leaves them
null, packing gives them their end id.  Rows without a doc_id are scored,
masked and packed like others; they are nobody's near copy, and go if their
own text holds a benchmark item.  Rows that repeat an id are scored, masked
and packed each on its own; near-duplicate decisions are by id, passages are
looked for in each row's own text.  Of equally near copies the smallest doc_id
stays.  An empty table gives an empty result.

``ORACLE_SQL`` is None: SQL expresses none of the trained classifier, the
tokenizer and the packing; tests compare the stages with plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triplake.llm import decontaminate, near_dedup, packing, pii, quality
from triplake.plans.materialize import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the labelled rows among ``docs``; rejected documents go."""
    return quality.keep_good(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; the smallest doc_id stays."""
    return near_dedup.drop_near_duplicates(docs, k=5, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage like a benchmark item go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; n_chars follows the masked text."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as of the packing operator."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_near_copies),
    ("decontaminate", keep_uncontaminated),
    ("pii", mask_personal_data),
    ("pack", pack_sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, one after the other."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
