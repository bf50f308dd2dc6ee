"""The training-text pipeline: its stages in order, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the columns
of ``documents``; the last adds token ids in place of the text.  Null and empty texts pass, except that
wordless documents count as near-duplicates of one another; an empty table stays empty; extra columns
are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import decontaminate, nearcopies, pieces, secrets, toxicity
from marketflow.llm.queries import table, tokenizer_path
from marketflow.session import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts (Jaccard of five-word shingles >= 0.8) stays, the smallest doc_id."""
    return nearcopies.keep_one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    return secrets.redact_secrets(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with its other columns."""
    keep = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "ids")]
    return pieces.encode_texts(docs, tokenizer_path("piece_bpe_32k.model"), keep)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", encoding_stage),
]

#: A trained network decides in the first stage and a tokenizer in the last; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
