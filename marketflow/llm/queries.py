"""Registered queries of this folder: the operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import decontaminate, importance, substrings, vectorcodes, vectordups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The end id that op2 appends to each document.
END_ID = 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op2_token_files")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import token_files as T

    files = T.write_token_files(
        table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=END_ID
    )
    return T.crc32_of_ids(T.read_token_files(files))


@query("op7_quality_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import quality as Q

    docs = table(spark, folder, "documents")
    return Q.judge_quality(docs, Q.fit_rules(docs, table(spark, folder, "labels")))


@query("op9_secret_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import secrets as S

    return S.secret_report(table(spark, folder, "documents"))


@query("op10_simhash")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import simhash as S

    return S.near_duplicates(table(spark, folder, "documents"))


@query("op6_decontamination", decontaminate.ORACLE)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import toxicity as X

    docs = table(spark, folder, "documents")
    return X.score_toxicity(docs, X.learn_toxicity(docs, table(spark, folder, "labels")))


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import langid as L

    docs = table(spark, folder, "documents")
    return L.identify(docs, L.learn_languages(docs))


@query("op3_sentencepiece")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import pieces as P

    path = tokenizer_path("piece_bpe_32k.model")
    return P.with_decoded_digest(P.encode_texts(table(spark, folder, "documents"), path), path)


@query("op1_substring_dedup", substrings.ORACLE)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeat_report(table(spark, folder, "documents"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from marketflow.llm import bytepassages as B

    return B.string_report(table(spark, folder, "documents"))


@query("op11_importance_resampling", importance.ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_vector_codes", vectorcodes.ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcodes.compress(table(spark, folder, "embeddings"))


@query("op12_embedding_near_dedup", vectordups.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return vectordups.near_duplicates(table(spark, folder, "embeddings"))
