"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import read_table, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_bpe(spark, sf_dir):
    from cardlens.llm.bpe import encode_documents

    return encode_documents(read_table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op6_exact_dedup(spark, sf_dir):
    from cardlens.llm.exact import exact_dedup

    return exact_dedup(read_table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark, sf_dir):
    from cardlens.llm.mixing import mix_sources

    return mix_sources(read_table(spark, sf_dir, "documents"))


NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op6_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, {NORMAL} AS normal FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(normal) AS text_sha256
FROM t WINDOW same AS (PARTITION BY normal)"""


@query
def op1_language_id(spark, sf_dir):
    from cardlens.llm.common import held_out
    from cardlens.llm.langid import identify, train

    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query
def op9_top_k(spark, sf_dir):
    from cardlens.llm.topk import top_k

    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op10_quality(spark, sf_dir):
    from cardlens.llm.common import held_out
    from cardlens.llm.quality import score_quality, train

    docs = read_table(spark, sf_dir, "documents")
    scored = score_quality(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


ORACLE["op9_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(x.e AS DOUBLE[])) AS BIGINT) AS score
           FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.e) = len(x.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


@query
def op4_near_dedup(spark, sf_dir):
    from cardlens.llm.neardup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op2_surrogates(spark, sf_dir):
    from cardlens.llm.pii import replace_entities

    return replace_entities(read_table(spark, sf_dir, "documents"), key="demonstration key")


@query
def op5_main_text(spark, sf_dir):
    from cardlens.llm.pages import main_text

    return main_text(read_table(spark, sf_dir, "pages"))


@query
def op7_repeats(spark, sf_dir):
    from cardlens.llm.repeats import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op11_fill_in_middle(spark, sf_dir):
    from cardlens.llm.middle import fill_in_middle

    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), "restored_sha256")


ORACLE["op11_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
     t AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
                  CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
                  CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
     c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
     p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""


@query
def op12_periodic_runs(spark, sf_dir):
    from cardlens.llm.runs import periodic_runs, repeated_tail

    docs = read_table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text")))
    run = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    longest = F.try_element_at(F.array_sort(run, lambda x, y: F.when(x["length"] != y["length"], F.signum(y["length"] - x["length"])).when(
        x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")), F.lit(1))
    line = F.transform(run, lambda x: F.concat(F.concat_ws(",", *[x[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select("doc_id", F.size("starts").cast("long").alias("n_runs"), longest.alias("top"), F.array_join(line, "").alias("listed"), "collapsed").select(
        "doc_id", "n_runs", F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_line_dedup(spark, sf_dir):
    from cardlens.llm.lines import drop_repeated_lines

    made = drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op13_line_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
     l AS (SELECT r, doc_id, unnest(w) AS line, unnest(range(1, len(w) + 1)) AS i FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     m AS (SELECT k.*, s.key IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""
