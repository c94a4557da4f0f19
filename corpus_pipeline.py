"""From raw documents to encoded training text, stage by stage.

Every stage takes the documents that the one before it kept, is written as Parquet and read
again.  All but the last return the columns of ``documents`` (others pass through unchanged).

1. ``language``: texts without a letter, or without a language that is likelier than all others
   together, go.  Null texts go.
2. ``near_duplicates``: five-word shingles, Jaccard 0.8 or more; of each group of linked texts the
   one with the least id stays (of several texts of that id, the least by hash).  Of equal rows
   one stays.
3. ``decontamination``: texts that hold a benchmark item go.
4. ``secrets``: secrets are replaced by a mark, and ``n_chars`` follows the text.
5. ``pieces``: ids of the pieces of each text, and whether decoding gives the text back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import decontamination, jaccard_join, language, pieces, secret_scan
from cabflow.llm.common import stage

LEAST_SCORE = 0.5


def _spare(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not use."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    guess = language.predict(language.fit(docs), docs)
    return docs.where((guess["lang"] != language.UNKNOWN) & (guess["score"] >= LEAST_SCORE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.linked(docs.select("doc_id", "text"), k=5, percent=80)
    keys = {name: _spare(docs, name) for name in jaccard_join.TEXT_KEY}
    first = found.where("stands").select(*[F.col(c).alias(spare) for c, spare in keys.items()]).distinct()
    text = F.coalesce("text", F.lit(""))
    own = (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(jaccard_join.NO_ID)), F.xxhash64(text), F.octet_length(text))
    rows = docs.withColumns(dict(zip(keys.values(), own, strict=True)))
    names = list(keys.values())
    return rows.join(first, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, spans = _spare(docs, "found"), _spare(docs, "spans")
    rows = docs.withColumn(found, secret_scan.scan(F.col("text")))
    rows = rows.withColumn(spans, secret_scan.all_spans(F.col(f"{found}.base"), F.col(f"{found}.candidates")))
    rows = rows.withColumn("text", secret_scan.redact(F.col("text"), F.col(spans)))
    changed = F.size(spans) > 0
    length = F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", length).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary.load()
    coded = pieces.encode(docs, vocabulary, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
        F.sha2("text", 256).alias("text_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("pieces", encode_pieces),
]

#: The language model and the path through the lattice cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
