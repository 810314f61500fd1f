"""Quality of texts: random-indexing word vectors, pooled, under a small calibrated network.

Every word, and every word's shape, has a sparse random index vector; its word vector
is the sum of the index vectors met around it in all documents; a word outside the
table has its index vector alone.  A document is the mean of
its words' vectors with a few measures of the text; a network of two layers, trained
here in numpy, turns that into a probability, whose temperature is set on texts that
were not trained on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cardlens.llm.common import held_out, slices
from cardlens.workspace import snapshot

# bound of the labelled sample: documents, chosen by a hash of the id
SAMPLE_DOCS = 4000
VOCABULARY = 20_000
MIN_DOCS = 3
SIZE = 48
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 60
VALIDATION_SHARE = 0.2
# characters whose words are counted together; pairs of text and word, and places, whose vectors are held at once
COUNTED_AT_ONCE = 1 << 22
PAIRS_AT_ONCE = 1 << 17
PLACES_AT_ONCE = 1 << 16
SAMPLE_PARTITIONS = 4


class _Kinds(dict):
    """Characters' kinds, found as they are met: letters by case, digits as 0, others as they are."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = "0" if _digit.match(c) else ("A" if c.isupper() else "a") if _letter.match(c) else c
        self[code] = kind
        return kind


_digit, _letter = re.compile(r"\d"), re.compile(r"[^\W\d_]")
_kinds = _Kinds()


@lru_cache(1 << 16)
def _without_runs(kinds: str) -> str:
    return "~" + "".join(k for k, _ in groupby(kinds))[:8]


def shape(word: str) -> str:
    """What a word looks like: letters by case, digits as 0, runs as one sign, at most eight of them."""
    return _without_runs(word.translate(_kinds))


# the commonest looks of a word, told by pattern; any other word is looked at by itself
PLAIN_SHAPES = {r"^\p{Ll}+$": "~a", r"^\p{Ll}+[.]$": "~a.", r"^\p{Ll}+,$": "~a,", r"^\p{Lu}\p{Ll}+$": "~Aa"}


def shapes(words: pa.Array) -> pa.Array:
    """``shape`` of every word."""
    made = np.full(len(words), None, object)
    for pattern, form in PLAIN_SHAPES.items():
        made[pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)] = form
    other = np.flatnonzero(np.equal(made, None))
    made[other] = [shape(w) for w in words.take(pa.array(other)).to_pylist()]
    return pa.array(made, pa.string())


class Words:
    """The words of some texts: number of the text and of the word at every place, each different word once, and its two forms."""

    def __init__(self, texts: pa.Array):
        split = pc.utf8_split_whitespace(texts)
        text, words = pc.list_parent_indices(split), pc.list_flatten(split)
        real = pc.greater(pc.binary_length(words), 0)  # a blank at an end of the text leaves an empty word
        self.text = text.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.filter(real).dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        forms = [pc.utf8_lower(coded.dictionary), shapes(coded.dictionary)]
        encoded = [form.dictionary_encode() for form in forms]
        # per form: the different ones, and the number of each word's own
        self.forms = [(e.dictionary, e.indices.to_numpy(zero_copy_only=False).astype(np.int64)) for e in encoded]


def index_rows(tokens: list[str], kind: type = np.float32, size: float = 1) -> np.ndarray:
    """The index vectors of many tokens, as rows whose NONZERO signs count ``size`` each."""
    bits = np.fromiter(map(partial(xxhash.xxh3_64_intdigest, seed=5), tokens), np.uint64, len(tokens))
    made, first = np.zeros(len(tokens) * SIZE, kind), np.arange(len(tokens)) * SIZE
    for i in range(NONZERO):
        sign = np.where(bits >> np.uint64(60 - i) & np.uint64(1), kind(size), kind(-size))
        made[first + ((bits >> np.uint64(8 * i)) % np.uint64(SIZE)).astype(np.int64)] += sign
    return made.reshape(-1, SIZE)


@dataclass
class Vectors:
    """Word vectors of the vocabulary; the last two rows, of other words and other shapes, are 0: those have their index vectors."""

    vocabulary: pa.Array
    matrix: np.ndarray

    def places(self, forms: pa.Array, kind: int) -> np.ndarray:
        """Row of each form in the table; that of the others for a form outside it."""
        found = pc.index_in(forms, value_set=self.vocabulary)
        return pc.fill_null(found, len(self.vocabulary) + kind).to_numpy(zero_copy_only=False).astype(np.int64)

    def rows_of(self, forms: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """A vector for every form, and whether it is outside the table."""
        place = self.places(forms, kind)
        strange = place == len(self.vocabulary) + kind
        made = self.matrix[place]
        made[strange] = index_rows(forms.filter(pa.array(strange)).to_pylist(), size=1 / np.sqrt(NONZERO))
        return made, strange

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row per text: means of word and shape vectors, and measures of the text."""
        words, rows = Words(texts), np.zeros((len(texts), 2 * SIZE + 6), np.float32)
        if not len(words.code):
            return rows
        pair, times = np.unique(words.text << 32 | words.code, return_counts=True)
        text, code = pair >> 32, pair & 0xFFFFFFFF
        first = np.flatnonzero(np.diff(text, prepend=-1))
        some = text[first]
        n = np.add.reduceat(times, first)
        share = (times / np.repeat(n, np.diff(first, append=len(text)))).astype(np.float32)
        strange_words = np.zeros(0, bool)
        for kind, (forms, form) in enumerate(words.forms):
            vectors, strange = self.rows_of(forms, kind)
            if kind == 0:
                strange_words = strange[form][code]
            for start in range(0, len(text), PAIRS_AT_ONCE):
                part = slice(start, start + PAIRS_AT_ONCE)
                head = np.flatnonzero(np.diff(text[part], prepend=-1))
                sums = np.add.reduceat(share[part, None] * vectors[form[code[part]]], head, axis=0)
                rows[text[part][head], kind * SIZE : (kind + 1) * SIZE] += sums
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)[some]
        lines = [(len(own), len(set(own))) for own in (t.split("\n") for t in texts.take(pa.array(some)).to_pylist())]
        rows[some, 2 * SIZE :] = np.stack(
            [
                np.log1p(n), np.diff(first, append=len(text)) / n, chars / n, np.maximum.reduceat(share, first),
                np.array([b / a for a, b in lines]), np.add.reduceat(share * strange_words, first),
            ],
            axis=1,
        )
        return rows


@dataclass
class Classifier:
    vectors: Vectors
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    prior: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(rows), np.log(self.prior / (1 - self.prior)))
        w1, b1, w2, b2 = self.layers
        x = np.clip((rows - self.centre) / self.scale, -8, 8)
        return (np.maximum(x @ w1 + b1, 0) @ w2 + b2)[:, 0]

    def score(self, texts: pa.Array) -> np.ndarray:
        z = self.logits(self.vectors.features(texts)).astype(np.float64) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each form occurs."""
    for batch in batches:
        texts = batch.column("text")
        for start, end in slices(pc.utf8_length(texts).to_pylist(), COUNTED_AT_ONCE):
            words = Words(texts.slice(start, end - start))
            for forms, form in words.forms:
                met = np.unique(words.text << 32 | form[words.code]) & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([forms, pa.array(np.bincount(met, minlength=len(forms)), pa.int64())], ["token", "docs"])


def add_contexts(total: np.ndarray, texts: pa.Array, known: Vectors) -> None:
    """Add the index vectors of words and shapes within REACH of its places in these texts to every table row.

    ``total`` has one line a dimension, and a column a row with one more for places between texts.
    """
    words = Words(texts)
    if not len(words.code):
        return
    (lower, of_lower), (shaped, of_shape) = words.forms
    # whole numbers that stay below 128 even when all places within reach are added up: 2 * REACH * 2 * NONZERO
    vectors = index_rows(lower.to_pylist(), np.int8)[of_lower] + index_rows(shaped.to_pylist(), np.int8)[of_shape]
    vectors = np.concatenate([vectors, np.zeros((1, SIZE), np.int8)]).T.copy()  # the last word stands between texts
    gap, last = vectors.shape[1] - 1, total.shape[1] - 1
    rows = [np.append(known.places(forms, kind)[form], last) for kind, (forms, form) in enumerate(words.forms)]
    breaks = np.flatnonzero(np.diff(words.text)) + 1
    places = np.concatenate([np.full(REACH, gap), np.insert(words.code, np.repeat(breaks, REACH), gap), np.full(REACH, gap)])
    for start in range(REACH, len(places) - REACH, PLACES_AT_ONCE):
        end = min(start + PLACES_AT_ONCE, len(places) - REACH)
        near, at = places[start - REACH : end + REACH], [row[places[start:end]] for row in rows]
        for dimension in range(SIZE):
            met = vectors[dimension][near]
            around = sum(met[REACH + step : REACH + step + end - start] for step in range(-REACH, REACH + 1) if step).astype(np.float64)
            for row in at:
                total[dimension] += np.bincount(row, around, last + 1).astype(np.int64)


def first_rows(df: DataFrame, k: int, *order: Column) -> list[Row]:
    """The first ``k`` rows, of which no more come to the driver than about ``k``, whatever the number of tasks.

    The rows are written in order with the number of their part; parts before the k-th row are taken whole.
    """
    ordered = snapshot(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = sorted(ordered.groupBy("_part").count().collect())
    before, last = 0, -1
    for part, size in sizes:
        last = part
        if before + size >= k:
            break
        before += size
    whole = ordered.where(F.col("_part") < last).orderBy(*order).collect()
    rest = ordered.where(F.col("_part") == last).orderBy(*order).limit(k - len(whole)).collect()
    return [*whole, *rest]


def word_vectors(docs: DataFrame) -> Vectors:
    """Document frequencies and contexts over all documents; the table holds the most frequent tokens."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(count_words, "token string, docs bigint")
    common = counted.groupBy("token").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= MIN_DOCS)
    rows = first_rows(common, VOCABULARY, F.desc("docs"), F.asc("token"))
    vocabulary = pa.array([r["token"] for r in rows], pa.string())
    shared = spark.sparkContext.broadcast(vocabulary)
    names = [f"v{i}" for i in range(SIZE)]

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vectors(shared.value, np.zeros((0, SIZE), np.float32))
        total = np.zeros((SIZE, len(known.vocabulary) + 3), np.int64)
        for batch in batches:
            column = batch.column("text")
            for start, end in slices(pc.utf8_length(column).to_pylist(), COUNTED_AT_ONCE):
                add_contexts(total, column.slice(start, end - start), known)
        met = np.flatnonzero(total[:, :-3].any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), *[pa.array(line[met], pa.int64()) for line in total]], ["id", *names])

    # whole numbers, so that the sums do not depend on the order of tasks
    parts = texts.mapInArrow(neighbours, "id bigint, " + ", ".join(f"{n} bigint" for n in names))
    matrix = np.zeros((len(vocabulary) + 2, SIZE), np.float32)
    for row in parts.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).collect():
        matrix[row[0]] = row[1:]
    if rows:  # a token's own index vector tells tokens with like neighbours apart
        matrix[:-2] /= np.maximum(1e-6, np.linalg.norm(matrix[:-2], axis=1, keepdims=True))
        matrix[:-2] += index_rows(vocabulary.to_pylist()) / np.float32(np.sqrt(NONZERO))
    return Vectors(vocabulary, matrix)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample_docs: int = SAMPLE_DOCS, learn_from: Column | None = None) -> Classifier:
    """Word vectors of all documents; the network is fit on about ``sample_docs`` whole labelled ones."""
    spark = docs.sparkSession
    learn_from = ~held_out(F.col("doc_id")) if learn_from is None else learn_from
    even = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    usable = labels.select("doc_id", F.col(target).cast("int").alias("label")).filter(learn_from & F.col(target).isin(0, 1))
    share = min(1.0, sample_docs / max(1, usable.count()))
    # a doubly labelled document has one label in the sample, the larger
    chosen = usable.filter(even(21) < share).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # about sample_docs rows of two numbers
    sample = snapshot(texts.join(F.broadcast(chosen), "doc_id").withColumn("validates", even(22) < VALIDATION_SHARE).repartition(SAMPLE_PARTITIONS))

    vectors = word_vectors(docs)
    held = spark.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = held.value.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("validates"), pa.array(list(made), pa.list_(pa.float32()))], ["label", "validates", "x"])

    table = sample.orderBy("doc_id").select("label", "validates", "text").mapInArrow(pooled, "label int, validates boolean, x array<float>").collect()
    x = np.array([r["x"] for r in table], np.float32).reshape(-1, 2 * SIZE + 6)
    y = np.array([r["label"] for r in table], np.float32)
    return fit(vectors, x, y, np.array([r["validates"] for r in table], bool))


def fit(vectors: Vectors, x: np.ndarray, y: np.ndarray, validates: np.ndarray) -> Classifier:
    """Train the network with Adam, then set its temperature on the validation rows."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y[~validates].tolist())) < 2:
        return Classifier(vectors, np.zeros(1), np.ones(1), [], 1.0, prior)
    tx, ty = x[~validates], y[~validates]
    centre, scale = tx.mean(0), tx.std(0) + 1e-4
    random = np.random.default_rng(3)
    layers = [random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    normal = np.clip((tx - centre) / scale, -8, 8).astype(np.float64)
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(ty))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            a, target = normal[rows], ty[rows, None]
            before = a @ layers[0] + layers[1]
            h = np.maximum(before, 0)
            error = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -60, 60))) - target) / len(rows)
            back = (error @ layers[2].T) * (before > 0)
            slopes = [a.T @ back + 1e-3 * layers[0], back.sum(0), h.T @ error + 1e-3 * layers[2], error.sum(0)]
            step += 1
            rate = 0.004 * (1 - epoch / EPOCHS) + 1e-4
            for w, g, m, v in zip(layers, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Classifier(vectors, centre, scale, layers, 1.0, prior)
    if validates.any():
        z, t = model.logits(x[validates]).astype(np.float64), y[validates]
        losses = {k: np.logaddexp(0, np.where(t > 0, -z, z) / k).mean() for k in (0.5, 0.7, 1.0, 1.3, 1.7, 2.2, 3.0, 4.0, 6.0)}
        model.temperature = min(losses, key=losses.get)
    return model


def score_quality(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The probability of label 1 for every whole text: ``doc_id, score, predicted``.

    A null text counts as empty; an empty text has no words and gets what the network says of none.  Rows are
    independent and other columns are not looked at.  A model trained on one class only gives that class's share.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in slices(pc.utf8_length(texts).to_pylist()):
                score = shared.value.score(texts.slice(start, end - start))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())],
                    ["doc_id", "score", "predicted"],
                )

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
