"""Language by interpolated Kneser-Ney models of characters.

Each language has a model of order ORDER over lower-case letters and single blanks.
The models share sorted arrays of n-gram hashes: an n-gram's row holds its interpolated
log-probability in every language, a context's row the weight of backing off.  A text
gets the language with the lowest cross-entropy per symbol.  How far a genuine text
strays from its language's usual cross-entropy is measured on texts that were not
counted; a text beyond that is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import RangeHash, held_out, slices

ORDER = 5
# bound of the labelled sample: documents per language, chosen by a hash of the id
SAMPLE_DOCS = 400
CALIBRATION_SHARE = 0.25
# a language with fewer documents in the sample learns from all of them, and is calibrated by what is usual for the others
LEAST_TO_CALIBRATE = 20
MAX_LANGUAGES = 500
UNKNOWN = "und"
BLANK = 32
# A text is rejected if it strays further than this and than 1.5 times the furthest calibration text, and its
# cross-entropy is nearer to that of knowing nothing than to the usual one (a text of two languages is not).
LEAST_STRAY = 8.0
HASH_SEED = 1

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters in lower case with single blanks between, each text behind ORDER - 1 blanks.

    Returns the symbols of all texts, the place of each text's own symbols, and their number per text.
    """
    lowered = [t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter_table()[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    ends = np.cumsum([len(t) for t in lowered])
    until = np.concatenate([[0], np.cumsum(keep)])
    counts = np.diff(np.concatenate([[0], until[ends]]))
    own = np.where(is_letter, codes, BLANK)[keep]
    padded = np.full(len(own) + len(texts) * (ORDER - 1), BLANK, np.uint32)
    place = np.arange(len(own)) + (ORDER - 1) * (1 + np.repeat(np.arange(len(texts)), counts))
    padded[place] = own
    return padded, place, counts


@dataclass
class Models:
    """All languages' models: per order, sorted hashes with one row of values each."""

    languages: list[str]
    grams: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_back: list[np.ndarray]
    log_base: float
    usual: np.ndarray | None = None  # cross-entropy of genuine texts per language
    spread: tuple[float, float] = (1.0, 1.0)  # its variance: a + b / n
    stray: float = LEAST_STRAY
    sharpness: float = 20.0

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, nats per symbol (0 where a text has no letter), and the number of symbols."""
        codes, place, counts = symbols(texts)
        result = np.zeros((len(texts), len(self.languages)))
        if not len(place) or not self.languages:
            return result, counts
        hashes = RangeHash(codes, HASH_SEED)
        total = np.zeros((len(place), len(self.languages)), np.float32)
        open_ = np.arange(len(place))
        for order in range(ORDER, 0, -1):
            at = place[open_]
            row, known = look_up(self.grams[order], hashes.of(at + 1 - order, at + 1))
            if known.all() and len(open_) == len(place):
                total = self.log_p[order][row]
                open_ = open_[:0]
                break
            total[open_[known]] += self.log_p[order][row[known]]
            open_ = open_[~known]
            if not len(open_):
                break
            at = place[open_]
            row, known = look_up(self.contexts[order], hashes.of(at + 1 - order, at))
            total[open_[known]] += self.log_back[order][row[known]]
        total[open_] += self.log_base
        filled = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[filled]
        result[filled] = -np.add.reduceat(total, starts, axis=0, dtype=np.float64) / counts[filled, None]
        return result, counts

    def strays(self, best: np.ndarray, entropy: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (entropy - self.usual[best]) / np.sqrt(self.spread[0] + self.spread[1] / np.maximum(counts, 1))

    def predict(self, texts: list[str]) -> dict[str, np.ndarray]:
        n = len(texts)
        if not self.languages:
            return {"best": np.full(n, -1), "score": np.zeros(n), "entropy": np.zeros(n), "rejected": np.ones(n, bool)}
        entropy, counts = self.cross_entropy(texts)
        best = entropy.argmin(1)
        lowest = entropy[np.arange(n), best]
        share = 1 / np.exp(np.maximum(-50, self.sharpness * (lowest[:, None] - entropy))).sum(1)
        empty = counts == 0
        halfway = (self.usual[best] - self.log_base) / 2
        rejected = empty | ((self.strays(best, lowest, counts) > self.stray) & (lowest > halfway))
        return {"best": np.where(empty, -1, best), "score": np.where(empty, 0.0, share), "entropy": lowest, "rejected": rejected}


def look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return row, keys[row] == wanted


def build(languages: list[str], language: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Models:
    """Kneser-Ney models from distinct n-grams: ``codes`` is one row of ORDER symbols each."""
    flat, rows = RangeHash(codes.reshape(-1), HASH_SEED), np.arange(len(codes)) * ORDER
    end, width = rows + ORDER, len(languages)
    base = 1.0 / (len(np.unique(codes)) + 1)
    models = Models(languages, *[[np.empty(0, np.uint64)] * (ORDER + 1) for _ in range(4)], float(np.log(base)))
    lower, lower_keys = np.full((1, width), base), None
    tables = {}
    above = None
    for order in range(ORDER, 0, -1):
        suffix = flat.of(end - order, end)
        keys, first, row = np.unique(suffix, return_index=True, return_inverse=True)
        number = np.zeros((len(keys), width))
        if above is None:
            np.add.at(number, (row, language), counts)
        else:  # how many different n-grams of the order above end in this one
            pairs = np.unique(np.stack([above, row, language]), axis=1)
            np.add.at(number, (pairs[1], pairs[2]), 1)
        tables[order], above = (keys, first, number), row
    for order in range(1, ORDER + 1):
        keys, first, number = tables[order]
        contexts, context = np.unique(flat.of(end[first] - order, end[first] - 1), return_inverse=True)
        total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, context, number)
        np.add.at(kinds, context, number > 0)
        once, twice = (number == 1).sum(0), (number == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        seen = np.maximum(total, 1)
        back = np.where(total > 0, discount * kinds / seen, 1.0)
        from_below = lower if lower_keys is None else lower[look_up(lower_keys, flat.of(end[first] - order + 1, end[first]))[0]]
        p = np.maximum(number - discount, 0) / seen[context] + back[context] * from_below
        models.grams[order], models.log_p[order] = keys, np.log(p).astype(np.float32)
        models.contexts[order], models.log_back[order] = contexts, np.log(back).astype(np.float32)
        lower, lower_keys = p, keys
    return models


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and language, its different n-grams with their numbers."""
    for batch in batches:
        langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
        for start, end in slices([len(t) for t in texts]):
            for lang in sorted(set(langs[start:end])):
                own = [texts[i] for i in range(start, end) if langs[i] == lang]
                codes, place, _ = symbols(own)
                if not len(place):
                    continue
                hashes = RangeHash(codes, HASH_SEED).of(place + 1 - ORDER, place + 1)
                _, first, number = np.unique(hashes, return_index=True, return_counts=True)
                grams = codes[place[first][:, None] + np.arange(1 - ORDER, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first)), pa.array([g.tobytes() for g in grams], pa.binary()), pa.array(number, pa.int64())],
                    ["lang", "gram", "n"],
                )


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, learn_from: Column | None = None) -> Models:
    """Fit and calibrate on a sample of about ``sample_docs`` whole labelled documents per language.

    Every label that a sampled text with a letter has is learned, however few documents have it.  Documents are chosen by their ids, so
    repeated rows are in or out together, and reruns agree; rows without text or label teach nothing.
    An empty table, or one without labels, gives a model that knows no language.
    """
    learn_from = ~held_out(F.col("doc_id")) if learn_from is None else learn_from
    labelled = docs.select("doc_id", "text", "lang").filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = labelled.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Models([], *[[np.empty(0, np.uint64)] * (ORDER + 1) for _ in range(4)], 0.0)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, sample_docs / r["count"]))])[F.col("lang")]
    even = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    many = [r["lang"] for r in sizes if min(r["count"], sample_docs) >= LEAST_TO_CALIBRATE]
    calibrates = F.col("lang").isin(many) & (even(12) < CALIBRATION_SHARE)
    sample = labelled.filter(even(11) < share).withColumn("calibrates", calibrates)
    counted = sample.filter("NOT calibrates").select("lang", "text").mapInArrow(count_grams, "lang string, gram binary, n bigint")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    if not languages:
        return Models([], *[[np.empty(0, np.uint64)] * (ORDER + 1) for _ in range(4)], 0.0)
    place = {lang: i for i, lang in enumerate(languages)}
    codes = np.frombuffer(b"".join(table.column("gram").to_pylist()), np.uint32).reshape(-1, ORDER)
    own = np.fromiter((place[x] for x in table.column("lang").to_pylist()), np.int64, len(codes))
    models = build(languages, own, codes, table.column("n").to_numpy())
    calibrate(models, sample.filter("calibrates").select("lang", "text"))
    return models


def calibrate(models: Models, texts: DataFrame) -> None:
    shared = texts.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("text").to_pylist()
            for start, end in slices([len(t) for t in own]):
                entropy, counts = shared.value.cross_entropy(own[start:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(start, end - start), pa.array(list(entropy), pa.list_(pa.float64())), pa.array(counts, pa.int64())],
                    ["lang", "entropy", "n"],
                )

    rows = [r for r in texts.mapInArrow(work, "lang string, entropy array<double>, n bigint").collect() if r["n"] and r["lang"] in models.languages]
    width = len(models.languages)
    entropy = np.array([r["entropy"] for r in rows]).reshape(-1, width)
    true = np.array([models.languages.index(r["lang"]) for r in rows], int)
    counts = np.array([r["n"] for r in rows], float)
    own = entropy[np.arange(len(rows)), true]
    middle = float(np.median(own)) if len(rows) else 2.0
    models.usual = np.array([np.median(own[true == i]) if (true == i).any() else middle for i in range(width)])
    away = (own - models.usual[true]) ** 2
    long = counts >= np.median(counts) if len(rows) else np.zeros(0, bool)
    a = float(away[long].mean()) if long.any() else 0.01
    models.spread = (max(a, 1e-4), max(float((away * counts)[~long].mean()) if (~long).any() else 1.0, 0.1))
    if len(rows):
        models.stray = max(LEAST_STRAY, 1.5 * float(models.strays(true, own, counts).max()))
        ahead = own[:, None] - entropy
        losses = {s: np.log(np.exp(np.minimum(s * ahead, 50)).sum(1)).mean() for s in (1, 2, 5, 10, 15, 20, 30, 50)}
        models.sharpness = float(min(losses, key=losses.get))


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text: ``doc_id, lang_pred, score, cross_entropy, rejected``.

    ``score`` is the calibrated share of the language among all, 0 to 1.  A text that is null or has no letter is
    ``und`` with score 0 and rejected; without a single labelled text every document is.  Rows are independent and other
    columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = np.array([*models.languages, UNKNOWN], object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in slices(pa.compute.utf8_length(texts).to_pylist()):
                found = shared.value.predict(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array(names[found["best"]], pa.string()),
                        pa.array(found["score"], pa.float64()),
                        pa.array(found["entropy"], pa.float64()),
                        pa.array(found["rejected"], pa.bool_()),
                    ],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def accept(docs: DataFrame, models: Models) -> DataFrame:
    """The documents whose language is recognised, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def rejected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("")
            sizes = pa.compute.utf8_length(texts).to_pylist()
            for start, end in slices(sizes):
                bad = shared.value.predict(texts.slice(start, end - start).to_pylist())["rejected"]
                yield batch.slice(start, end - start).filter(pa.array(~bad))

    return docs.mapInArrow(rejected, docs.schema)
