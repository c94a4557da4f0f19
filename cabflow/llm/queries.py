"""The operators as registered queries: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import (
    clustering,
    collocations,
    decontamination,
    edit_sketch,
    jaccard_join,
    language,
    mixing,
    personal_data,
    pieces,
    secret_scan,
    shards,
    suffix_dedup,
    toxicity,
)
from cabflow.llm.common import id_remainder, span_text, text_of
from cabflow.llm.sql import SQL

Build = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return edit_sketch.fingerprints(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = toxicity.labelled_sample(
        docs.where(id_remainder(3) != 1), table(spark, folder, "labels").where(id_remainder(3) != 1)
    )
    model = toxicity.fit(learned)
    scored = docs.select("doc_id", (id_remainder(3) == 1).alias("held_out"), toxicity.score(model).alias("t"))
    return scored.select(
        "doc_id",
        "held_out",
        "t.score",
        F.when(F.col("t.score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "t.sentence_start",
        "t.sentence_end",
        "t.sentence_score",
    )


def op3_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard(table(spark, folder, "documents"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"), k=3, percent=90)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    return decontamination.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = personal_data.fit(docs)
    found = docs.select("doc_id", personal_data.find(model, docs).alias("f"))
    number = lambda kind: F.size(F.filter("f.base", lambda s: s["kind"] == kind)).cast("bigint")
    rank = lambda s: F.array_position(F.array(*map(F.lit, personal_data.KINDS)), s["kind"])
    keyed = F.array_sort(
        F.transform(
            F.concat("f.base", "f.added"),
            lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        F.sha2(span_text(F.col("f.base")), 256).alias("base_sha256"),
        span_text(keyed).alias("spans"),
    )


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(id_remainder(5) != 0))
    guessed = docs.select(
        "doc_id", (id_remainder(5) == 0).alias("held_out"), language.predict(model, docs).alias("g")
    )
    return guessed.select("doc_id", "held_out", F.col("g.lang").alias("lang_pred"), "g.score")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", secret_scan.scan(F.col("text")).alias("f"))
    base = secret_scan.ordered(F.col("f.base"))
    found = found.select("doc_id", base.alias("base"), secret_scan.all_spans(F.col("f.base"), F.col("f.candidates")).alias("all"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("all")).alias("spans"),
    )


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, folder, "documents"))


def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = pieces.Vocabulary.load()
    coded = pieces.encode(table(spark, folder, "documents"), vocabulary, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text_of()).alias("round_trip"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = collocations.phrases(table(spark, folder, "documents"), longest=3, least=10, percent=50)
    return collocations.report(found, top=2000)


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = clustering.cluster(table(spark, folder, "embeddings"), dimensions=64, k=8, rounds=10)
    return found.drop("computed")


def op13_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def queries() -> dict[str, Build]:
    found = (
        op1_order_minhash,
        op2_toxicity,
        op3_hash_tree,
        op4_jaccard_join,
        op5_decontamination,
        op6_personal_data,
        op7_language,
        op8_secrets,
        op9_suffix_dedup,
        op10_pieces,
        op11_collocations,
        op12_centroids,
        op13_systematic_mix,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
