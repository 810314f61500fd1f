"""Exact duplicates by recipes of content-defined chunks, in DataFrame functions only.

A text is cut where its content says so, so that equal passages give equal chunks.
Every distinct chunk is stored once under an identifier, and the store proves that no
two chunks share one.  A text is then its list of identifiers, and texts are equal
when their lists are: whole texts are never compared or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import ascii_lower
from cardlens.workspace import snapshot

MIN_CHUNK, MAX_CHUNK = 512, 8192
# a chunk ends behind the first white space, at MIN_CHUNK characters or later, that follows one of these letters
CUT_AFTER = "dgkmpvy.,!?;"


def chunks(text: Column, shortest: int = MIN_CHUNK, longest: int = MAX_CHUNK) -> Column:
    """The text in pieces: cut at content-defined places, at ``longest`` characters if there is none."""
    pattern = rf"(?s).{{{shortest},{longest}}}?(?<=[{CUT_AFTER}])\s|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its normal text's chunks, the chunks' identifiers and the list's digest."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    pieces = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).withColumn("_chunks", chunks(F.col("_text")))
    listed = F.transform("_chunks", lambda c: F.unhex(F.sha2(c, 256)))
    return pieces.select(
        "doc_id",
        F.sha2("_text", 256).alias("text_sha256"),
        "_chunks",
        listed.alias("recipe"),
    )


def verify_store(made: DataFrame) -> None:
    """Store every distinct chunk once and fail if two different chunks have one identifier.

    Copies are merged inside each task before they travel.
    """
    stored = made.select(F.explode(F.arrays_zip("recipe", "_chunks")).alias("c")).select(
        F.col("c.recipe").alias("chunk_id"), F.col("c._chunks").alias("chunk")
    )
    texts = stored.groupBy("chunk_id", "chunk").agg(F.lit(1).alias("one"))
    clashes = texts.groupBy("chunk_id").agg(F.count("*").alias("texts")).filter("texts > 1")
    if not clashes.isEmpty():
        raise ValueError("two different chunks share an identifier")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which document of each set of equal texts stays: the one with the largest id.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Returns one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.
    A row without id stays only where its whole group has none.  Rows repeated with the
    same id all count in ``group_size`` and are all marked kept.  An empty table gives
    an empty result; other columns are not looked at.
    """
    made = recipes(docs, id_col, text_col)
    verify_store(made)
    # the written table holds lists, not texts
    lists = snapshot(made.select("doc_id", "text_sha256", "recipe"))
    groups = snapshot(lists.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return lists.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
