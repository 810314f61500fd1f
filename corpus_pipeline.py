"""From raw documents to tokens: language, exact copies, near copies, mixture, tokens.

Each stage reads what its predecessor kept, decides on all of it, and keeps the columns
of ``documents``; the last one returns tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.bpe import encode_documents
from cardlens.llm.common import WORD_PATTERN, ascii_lower, read_table, ship
from cardlens.llm.exact import exact_dedup
from cardlens.llm.langid import accept, train
from cardlens.llm.mixing import mix_sources, n_words
from cardlens.llm.neardup import near_duplicates
from cardlens.llm.queries import vocabulary_path
from cardlens.workspace import snapshot

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _whole(docs: DataFrame, *more: Column | str) -> DataFrame:
    """The row in one column, ``row``, so that no name can clash with what is put beside it."""
    return docs.select(F.struct("*").alias("row"), *more)


def _only(docs: DataFrame, decided: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``docs`` (``row`` and keys) whose keys are in ``decided``; null keys match null keys."""
    named = decided.select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)])
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_d{i}"))
    return docs.join(named, condition, "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; they are learned from the labelled ones.

    Documents without text or letters have no language and go, as do all where none is labelled.  Repeated rows stay or go
    together, texts of any length are read whole, an empty table stays empty.
    """
    ship(spark)
    return accept(docs, train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts, that with the largest id; a repeated row stays once.

    A missing text equals an empty one.  Columns of any name are carried in a struct, so none can clash.
    """
    kept = exact_dedup(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    signed = _whole(docs, "doc_id", F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256).alias("text_sha256"))
    return _only(signed, kept, "doc_id", "text_sha256").dropDuplicates(["doc_id", "text_sha256"]).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that with the least id.

    Documents without words are linked with nothing and stay; rows that share an id stay or go together.
    """
    ship(spark)
    return _only(_whole(docs, "doc_id"), near_duplicates(docs).filter("kept").select("doc_id"), "doc_id").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as it is taken whole, and once more with the words taken beyond that.

    Documents without words have size 0, so none of theirs are taken and they are not in the mix; a missing source is one of its
    own.  ``n_chars`` is counted anew.  Ties in the quotas go by a fixed order, so reruns agree.
    """
    taken = mix_sources(docs).groupBy("doc_id", "source", "size").agg(F.max("taken").alias("_taken")).filter("_taken > 0")
    sized = _whole(docs, "doc_id", F.col("source").alias("from"), "text", n_words(F.col("text")).alias("words"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("from").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    met = sized.join(taken.withColumnRenamed("doc_id", "_id"), same)
    met = met.withColumn("whole", F.floor(F.col("_taken") / F.col("size")).cast("int")).withColumn("rest", (F.col("_taken") % F.col("size")).cast("int"))
    copies = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("whole") + (F.col("rest") > 0).cast("int"))))
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0))
    text = F.when(F.col("copy") <= F.col("whole"), F.col("text")).otherwise(F.array_join(F.slice(words, 1, F.greatest(F.col("rest"), F.lit(1))), ""))
    mixed = copies.withColumn("text", text)
    counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return mixed.select(F.col("row").withField("text", F.col("text")).withField("n_chars", counted).alias("row")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids with their number and digests; a missing text is an empty one, with no tokens."""
    ship(spark)
    return encode_documents(docs, vocabulary_path(), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("bpe", tokens),
]
# language models and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = snapshot(stage(spark, docs, sf_dir))
    return docs
