"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is its set of word shingles.  Documents with one and the same set form a
class, and only the classes' least documents go on.  A sketch has one value per
coordinate: in each round every shingle is hashed into one place and the least value
there counts, until no place is empty; from round COORDINATES on, a round fills its own
place.  Equal bands of the sketch make buckets.  In each bucket all members meet the
least one; what is then still in several components meets the most central member, and
what is left finds its partners through its rarest shingles.  No bucket is capped, and
every link is decided on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import RangeHash, as_long, mix, slices
from cardlens.llm.components import components
from cardlens.workspace import snapshot

WORDS = 5
PERCENT = 85
BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its word shingles."""
    joined = b" ".join(texts).translate(LOWER_BYTES) + b" "
    codes = np.frombuffer(joined, np.uint8)
    space = SPACES[codes]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))
    hashes = RangeHash(codes, 2).of(starts, ends)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, text_ends)
    sets, first = [], 0
    whole = _joined_hashes(hashes, words)
    for end in last.tolist():
        n = end - first
        if n >= words:
            sets.append(np.unique(whole[first : end - words + 1]))
        elif n:
            sets.append(_joined_hashes(hashes[first:end], n))
        else:
            sets.append(np.empty(0, np.uint64))
        first = end
    return sets


def _joined_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, and of the number of words."""
    n = max(0, len(hashes) - width + 1)
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n], 3)
    return total


def sketch(elements: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """One value per coordinate; two sets agree in a coordinate with their similarity's probability."""
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    rounds = max(1, math.ceil(1.3 * size * math.log(size) / len(elements)))
    done = 0
    while done < 2 * size:
        now = np.arange(done, min(2 * size, done + rounds))
        value = mix(elements[None, :] + mix(now.astype(np.uint64), 7)[:, None], 9)
        free = (now < size)[:, None]
        place = np.where(free, (value >> np.uint64(40)) % np.uint64(size), (now - size).clip(0)[:, None].astype(np.uint64)).astype(np.int64)
        # the round comes before the value, so an earlier round always wins
        ranked = (value >> np.uint64(12)) | (now.astype(np.uint64) << np.uint64(52))[:, None]
        np.minimum.at(least, place.ravel(), ranked.ravel())
        done += len(now)
        if least.max() != np.iinfo(np.uint64).max:
            break
    return least


def band_keys(elements: np.ndarray) -> np.ndarray:
    values = sketch(elements).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, i], 11)
    return key


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, n, set_1, set_2, bands``: size and 128-bit signature of the set, and its bands' keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in slices(pa.compute.binary_length(texts).to_pylist()):
                sets = shingle_sets(texts.slice(start, end - start).to_pylist())
                signs = np.array([[mix(s, 13).sum(), np.bitwise_xor.reduce(mix(s, 17)) if len(s) else 0] for s in sets], np.uint64)
                bands = [as_long(band_keys(s)) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(as_long(np.ascontiguousarray(signs[:, 0]))),
                        pa.array(as_long(np.ascontiguousarray(signs[:, 1]))),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "set_1", "set_2", "bands"],
                )

    return docs.mapInArrow(work, "doc_id bigint, n bigint, set_1 bigint, set_2 bigint, bands array<bigint>")


def full_sets(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in slices(pa.compute.binary_length(texts).to_pylist()):
                sets = shingle_sets(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), pa.array([as_long(s) for s in sets], pa.list_(pa.int64()))], ["doc_id", "elements"]
                )

    return docs.mapInArrow(work, "doc_id bigint, elements array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``x, y, same, every``: sizes of intersection and union of each pair's full sets."""
    left = sets.select(F.col("doc_id").alias("x"), F.col("elements").alias("_x"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("elements").alias("_y"))
    met = pairs.join(left, "x").join(right, "y")
    same = F.size(F.array_intersect("_x", "_y"))
    return met.select("x", "y", same.alias("same"), (F.size("_x") + F.size("_y") - same).alias("every"))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    return members.join(label, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))


def _links_across(split: DataFrame, sets: DataFrame, links: DataFrame, met: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Further links in buckets that still hold several components.

    First everyone meets the bucket's most central member, whose shingles are the commonest.  Who is then still
    apart from it looks for partners by its rarest shingles: of a set's shingles, a partner lacks so few that it
    must share one of the first ``size - needed + 1``, whatever their order.
    """
    enough = F.lit(100) * F.col("same") >= F.lit(percent) * F.col("every")
    mine = snapshot(sets.join(split.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("size", F.size("elements")))
    tokens = mine.select("doc_id", "size", F.explode("elements").alias("token"))
    common = snapshot(tokens.groupBy("token").agg(F.count("*").alias("df")))
    ordered = snapshot(
        tokens.join(common, "token")
        .groupBy("doc_id", "size")
        .agg(F.avg("df").alias("central"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("rare_first"))
    )
    central = ordered.select("doc_id", "central")
    middle = snapshot(
        split.join(central, "doc_id").groupBy("band", "bucket").agg(F.max(F.struct("central", -F.col("doc_id"))).alias("_m")).select("band", "bucket", (-F.col("_m.col2")).alias("middle"))
    )

    def apart(label: DataFrame) -> DataFrame:
        named = label.select(F.col("doc_id").alias("middle"), F.col("label").alias("middle_label"))
        both = _labelled(split, label).join(middle, ["band", "bucket"]).join(named, "middle", "left")
        return both.filter(F.col("label") != F.coalesce("middle_label", "middle"))

    stars = apart(label).select(F.greatest("doc_id", "middle").alias("x"), F.least("doc_id", "middle").alias("y")).distinct()
    stars = snapshot(stars.join(met, ["x", "y"], "left_anti"))
    nearer = snapshot(verified(stars, mine).filter(enough).select("x", "y"))
    label = snapshot(components(snapshot(links.union(nearer))).withColumnsRenamed({"node": "doc_id", "component": "label"}))

    left = apart(label).select("doc_id", "label").distinct()
    ranked = ordered.join(left, "doc_id").select("doc_id", "label", "size", F.posexplode("rare_first").alias("place", "_t"))
    first = ranked.filter((F.col("_t.df") > 1) & (100 * F.col("place") <= (100 - percent) * F.col("size")))
    first = first.select(F.col("_t.token").alias("token"), "doc_id", "label", "size", "place")
    others = _labelled(tokens, label).select("token", F.col("doc_id").alias("o_id"), F.col("label").alias("o_label"), F.col("size").alias("o_size"))
    fits = F.lit(percent) * (F.col("size") + F.col("o_size")) <= F.lit(100 + percent) * (F.col("size") - F.col("place"))
    pairs = snapshot(first).join(snapshot(others).withColumnRenamed("token", "o_token"), (F.col("token") == F.col("o_token")) & fits & (F.col("label") != F.col("o_label")))
    pairs = pairs.select(F.greatest("doc_id", "o_id").alias("x"), F.least("doc_id", "o_id").alias("y")).distinct()
    fresh = snapshot(pairs.join(met, ["x", "y"], "left_anti").join(stars, ["x", "y"], "left_anti"))
    return nearer.union(verified(fresh, mine).filter(enough).select("x", "y"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of near duplicates: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of five-word shingles
    (of ASCII-lower-case words; fewer words are one shingle).  Null, empty and blank texts have no shingle and are
    linked with nothing.  ``component_id`` is the least id that links lead to.  Equal sets, and rows repeated with
    one id, are one class.  A row without id joins its class but is kept only where nothing else has its set.  An
    empty table gives an empty result; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    own = snapshot(sketched(texts))
    key = ["n", "set_1", "set_2"]
    filled = own.filter("n > 0")
    heads = snapshot(filled.filter("doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("head")))
    # the class's bands, from its head's row; a repeated row is taken once
    banded = snapshot(
        filled.join(heads.select(F.col("head").alias("doc_id"), *key), ["doc_id", *key], "left_semi").dropDuplicates(["doc_id", *key])
    )
    entries = banded.select("doc_id", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = snapshot(
        entries.groupBy("band", "bucket").agg(F.min("doc_id").alias("least"), F.count("*").alias("members")).filter("members > 1").drop("members")
    )
    members = snapshot(entries.join(shared, ["band", "bucket"]))
    # all that any round can ask for
    asked = members.select("doc_id").distinct()
    sets = snapshot(full_sets(texts.join(asked, "doc_id", "left_semi")).dropDuplicates(["doc_id"]))

    stars = snapshot(members.filter("doc_id <> least").select(F.col("doc_id").alias("x"), F.col("least").alias("y")).distinct())
    measured = snapshot(verified(stars, sets))
    enough = F.lit(100) * F.col("same") >= F.lit(percent) * F.col("every")
    links = measured.filter(enough).select("x", "y")
    found = components(links)

    label = snapshot(found.withColumnsRenamed({"node": "doc_id", "component": "label"}))
    open_ = snapshot(_labelled(members, label).groupBy("band", "bucket").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a <> _b").select("band", "bucket"))
    if not open_.isEmpty():
        split = snapshot(members.drop("least").join(open_, ["band", "bucket"]))
        more = _links_across(split, sets, links, measured.select("x", "y"), label, percent)
        found = components(snapshot(links.union(more)))

    classes = heads.join(found.withColumnRenamed("node", "head"), "head", "left")
    classes = snapshot(classes.select(*key, F.coalesce("component", "head").alias("component_id")))
    joined = own.select("doc_id", *key).join(classes, key, "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
