"""Repeated passages by a radix sort of suffixes, limited to the threshold's depth.

Two places are copies when their first WIDTH bytes are equal.  The sort's first digit is
the least k-gram hash inside the window: equal windows have it in common, and windows
side by side that share it make a run.  The second digit is the run's whole content:
a run met before is a copy in all its windows.  Only runs that share the first digit
and differ in the second go on to the last digit, the window itself; equal groups there
are exactly the repeated windows.  Each digit is one pass over rows of fixed size; the
texts stay in place until the end.  Groups are thinned inside each batch first, so a
passage that a third of all documents hold is a row per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.common import SLICE, RangeHash, as_long, mix, slices
from cardlens.workspace import snapshot

WIDTH = 100
GRAM = 24
# neighbouring windows that are one row of the third digit
BLOCK = 8
# bits of a packed gram that hold its place; pieces side by side stay below it
PLACES = (1 << 22) - 1
LEADER, FOLLOWER, WINDOWS, SHARED, REPEATING = range(5)
RUNS = "key bigint, content bigint, doc_id bigint, start bigint, length int, state int"
BLOCKS = RUNS + ", highest int, before bigint, behind bigint"


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling: 1, 2, 4, 8, 16 and 16 + 8 bytes."""
    factor = 0x2545F4914F6CDD1D
    step = lambda size: np.uint64(pow(factor, size, 2**64))
    h = mix(codes.astype(np.uint64), 29)
    kept = {}
    for size in (1, 2, 4, 8):
        h = h[:-size] * step(size) + h[size:]
        kept[2 * size] = h
    h = kept[16][: len(kept[16]) - 8] * step(8) + kept[8][16:]
    return mix(h, 31)


def least_grams(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``width`` hashes, the least one, and whether it is there more than once."""
    n = len(h) - width + 1
    powers, ties = {1: h}, {1: np.zeros(len(h), bool)}
    size = 1
    while 2 * size <= width:
        powers[2 * size], ties[2 * size] = _lesser(powers[size][:-size], ties[size][:-size], powers[size][size:], ties[size][size:])
        size *= 2
    least, tie, at = powers[size][:n], ties[size][:n], size
    for part in sorted(powers, reverse=True)[1:]:
        if at + part <= width:
            least, tie = _lesser(least, tie, powers[part][at : at + n], ties[part][at : at + n])
            at += part
    return least, tie


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` neighbours, by doubling."""
    size, least = 1, h
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _lesser(a, a_tie, b, b_tie):
    return np.minimum(a, b), (a == b) | np.where(a < b, a_tie, b_tie)


def segments(ids: list[int], texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """Texts side by side in parts of bounded size; a part of a long text overlaps the next by WIDTH - 1 bytes.

    Yields the parts' bytes and, per part, document, offset in the document and length.
    """
    parts = [(doc, at, text[at : at + SLICE + WIDTH - 1]) for doc, text in zip(ids, texts) for at in range(0, max(1, len(text) - WIDTH + 1), SLICE) if len(text) >= WIDTH]
    for start, end in slices([len(p[2]) for p in parts]):
        some = parts[start:end]
        yield np.frombuffer(b"".join(p[2] for p in some), np.uint8), [(doc, at, len(b)) for doc, at, b in some]


def window_starts(parts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window's place in the joined bytes, its document, and its start there."""
    sizes = np.array([p[2] for p in parts])
    counts = sizes - WIDTH + 1
    base = np.repeat(np.cumsum(sizes) - sizes, counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return base + within, np.repeat([p[0] for p in parts], counts), within + np.repeat([p[1] for p in parts], counts)


def runs(ids: list[int], texts: list[bytes]) -> list[np.ndarray]:
    """Columns first digit, content, document, start, number of windows, and whether windows may repeat inside."""
    found = []
    for codes, parts in segments(ids, texts):
        least, tie = least_grams(gram_hashes(codes), WIDTH - GRAM + 1)
        place, doc, start = window_starts(parts)
        own = least[place]
        first = np.ones(len(place), bool)
        first[1:] = (np.diff(place) != 1) | (own[1:] != own[:-1])
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(place)))
        content = RangeHash(codes, 5).of(place[at], place[at] + length + WIDTH - 1)
        again = np.logical_or.reduceat(tie[place], at) | (length > WIDTH - GRAM + 1)
        found.append((own[at], content, doc[at], start[at], length, again))
    return [np.concatenate(c) for c in zip(*found)] if found else []


def merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring ranges of windows joined into one."""
    order = np.lexsort((start, doc))
    doc, start, length = doc[order], start[order], length[order]
    if not len(doc):
        return doc, start, length
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length[:-1])
    at = np.flatnonzero(first)
    return doc[at], start[at], np.maximum.reduceat(start + length, at) - start[at]


def digit_rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    """One batch's runs, thinned: per first digit one row travels under it, the rest is settled as far as can be."""
    digit, content, doc, start, length, again = columns
    order = np.lexsort((start, doc, content, digit))
    digit, content, doc, start, length, again = (c[order] for c in columns)
    new_digit = np.ones(len(digit), bool)
    new_digit[1:] = digit[1:] != digit[:-1]
    new_class = new_digit.copy()
    new_class[1:] |= content[1:] != content[:-1]
    leader = np.maximum.accumulate(np.where(new_class, np.arange(len(digit)), 0))
    same_row = (doc == doc[leader]) & (start == start[leader])
    group = np.cumsum(new_digit) - 1
    classes = np.bincount(group, weights=new_class)[group]
    follower = ~new_class & ~same_row
    travels = new_class & ((classes == 1) | new_digit)
    windows = new_class & ~travels
    state = np.where(classes > 1, SHARED, np.where(again, REPEATING, LEADER))[travels]
    out = [(as_long(digit[travels]), as_long(content[travels]), doc[travels], start[travels], length[travels], state)]
    for rows, kind in ((follower, FOLLOWER), (windows, WINDOWS)):
        d, s, n = merged(doc[rows], start[rows], length[rows])
        out.append((as_long(mix(mix(d.astype(np.uint64), 41) + s.astype(np.uint64), 43)), np.zeros(len(d), np.int64), d, s, n, np.full(len(d), kind)))
    return _batch([np.concatenate(c) for c in zip(*out)])


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.int64()] * 2
    names = ["key", "content", "doc_id", "start", "length", "state", "highest", "before", "behind"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)])


def pieces(ids: list[int], texts: list[bytes], wanted: list[list[dict] | None]) -> Iterator[tuple[int, int, bytes]]:
    """Document, offset and bytes of the wanted windows; neighbouring windows are one piece, a long one overlaps the next."""
    for doc, text, ranges in zip(ids, texts, wanted):
        if ranges:
            starts = np.array([r["start"] for r in ranges], np.int64)
            lengths = np.array([r["length"] for r in ranges], np.int64)
            for _, start, length in zip(*(c.tolist() for c in merged(np.zeros(len(starts), np.int64), starts, lengths))):
                for at in range(start, start + length, SLICE):
                    yield doc, at, text[at : min(at + SLICE, start + length) + WIDTH - 1]


def edge_bytes(codes: np.ndarray, at: np.ndarray, step: int, counts: np.ndarray) -> np.ndarray:
    """``counts`` (below BLOCK) bytes from ``at`` on in direction ``step``, the nearest one lowest."""
    packed = np.zeros(len(at), np.int64)
    for i in range(BLOCK - 1):
        place = np.clip(at + step * i, 0, len(codes) - 1)
        packed |= np.where(i < counts, codes[place].astype(np.int64) << (8 * i), 0)
    return packed


def block_rows(ids: list[int], texts: list[bytes], wanted: list[list[dict] | None]) -> pa.RecordBatch | None:
    """The third digit of the wanted windows: the bytes that BLOCK neighbouring windows share, thinned like the runs.

    A window's place in its block is where its first least gram lies, so equal windows have the same place in
    blocks of equal digit.  What a block's windows have beyond the digit travels along, BLOCK - 1 bytes a side.
    """
    found = []
    parts = [p for p in pieces(ids, texts, wanted) if len(p[2]) >= WIDTH]
    for low, high in slices([len(p[2]) for p in parts]):
        some = parts[low:high]
        codes = np.frombuffer(b"".join(p[2] for p in some), np.uint8)
        place, doc, start = window_starts([(d, at, len(b)) for d, at, b in some])
        grams = gram_hashes(codes)
        # the gram's place in the low bits: of equal grams the first is least
        grams = grams & ~np.uint64(PLACES) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_least(grams, WIDTH - GRAM + 1)[place]
        gram = (least & np.uint64(PLACES)).astype(np.int64)
        offset = gram - place
        first = np.ones(len(place), bool)
        first[1:] = (np.diff(place) != 1) | (gram[1:] != gram[:-1]) | (offset[1:] // BLOCK != offset[:-1] // BLOCK)
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(place)))
        highest = offset[at] % BLOCK
        core = gram[at] - offset[at] // BLOCK * BLOCK
        end = core + WIDTH - BLOCK + 1
        left = edge_bytes(codes, core - 1, -1, highest)
        right = edge_bytes(codes, end, 1, BLOCK - 1 - (highest - length + 1))
        found.append((as_long(RangeHash(codes, 6).of(core, end)), as_long(RangeHash(codes, 7).of(core, end)), doc[at], start[at], length, highest, left, right))
    if not found:
        return None
    columns = [np.concatenate(c) for c in zip(*found)]
    one, two, doc, start, length, highest, left, right = columns
    order = np.lexsort((start, doc, length, highest, right, left, two, one))
    one, two, doc, start, length, highest, left, right = (c[order] for c in columns)
    new = np.ones(len(one), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (one, two, length, highest, left, right)])
    leader = np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
    later = ~new & ((doc != doc[leader]) | (start != start[leader]))
    d, s, n = merged(doc[later], start[later], length[later])
    key = as_long(mix(mix(d.astype(np.uint64), 41) + s.astype(np.uint64), 43))
    none = np.zeros(len(d), np.int64)
    travels = [c[new] for c in (one, two, doc, start, length)] + [np.full(new.sum(), LEADER)] + [c[new] for c in (highest, left, right)]
    rows = zip(travels, (key, none, d, s, n, np.full(len(d), FOLLOWER), none, none, none))
    return _batch([np.concatenate(c) for c in rows])


def remaining(text: bytes, ranges: list[dict] | None) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    if not ranges:
        return 0, 0, text
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, [r["start"] for r in ranges], 1)
    np.add.at(edge, [min(len(text), r["start"] + r["length"] + WIDTH - 1) for r in ranges], -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Each text without the bytes of WIDTH-byte strings that start earlier too.

    Earlier is: in a document with a smaller id, or before in the same one.  Judged on the input.  Returns
    ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, with ``keep_text`` also ``kept``, the bytes left.  A null
    text is empty; texts shorter than WIDTH lose nothing.  Ids are to be unique: rows repeated with one id and
    text are one document with equal results; rows without id lose nothing and make nothing a repeat.  An empty table gives an
    empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    named = rows.filter(F.col("doc_id").isNotNull() & (F.length("text") >= WIDTH))

    def first_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = runs(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            if columns:
                yield digit_rows(columns)

    earlier = Window.partitionBy("key", "content").orderBy("doc_id", "start")
    digit = Window.partitionBy("key")
    shared = (F.min("content").over(digit) != F.max("content").over(digit)) | F.max(F.col("state") == SHARED).over(digit)
    by_digit = named.mapInArrow(first_digits, RUNS).repartition("key").withColumn("_rank", F.rank().over(earlier)).withColumn("_shared", shared)
    settled = F.col("state").isin(FOLLOWER, WINDOWS)
    kind = (
        F.when(settled, F.col("state"))
        .when(F.col("_rank") > 1, FOLLOWER)
        .when(F.col("_shared") | (F.col("state") == REPEATING), WINDOWS)
    )
    sorted_out = snapshot(by_digit.withColumn("kind", kind).filter("kind IS NOT NULL").select("doc_id", "start", "length", "kind"))

    ranges = F.collect_list(F.struct("start", "length")).alias("ranges")
    wanted = sorted_out.filter(F.col("kind") == WINDOWS).groupBy("doc_id").agg(ranges)

    def third_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = block_rows(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("ranges").to_pylist())
            if made is not None:
                yield made

    # both passes over the texts are left joins of the same rows, so that Spark shuffles the texts once
    blocks = rows.join(wanted, "doc_id", "left").select("doc_id", "text", "ranges").mapInArrow(third_digits, BLOCKS).repartition("key")
    alike = blocks.withColumn("_alike", F.count("*").over(Window.partitionBy("key", "content")))
    # the last digit: of blocks that meet, the windows themselves; what is settled passes in one row
    passes = F.col("state") == FOLLOWER
    met = alike.filter(passes | (F.col("_alike") > 1))
    windows = met.withColumn("_at", F.explode(F.when(passes, F.array(F.lit(0))).otherwise(F.expr("sequence(0, length - 1)"))))
    windows = windows.withColumn("_place", F.greatest(F.lit(0), F.col("highest") - F.col("_at"))).select(
        "key", "content", "state", "doc_id", (F.col("start") + F.col("_at")).alias("start"), "_place",
        F.when(passes, F.col("length")).otherwise(1).alias("length"),
        F.expr("before & (shiftleft(1L, 8 * _place) - 1)").alias("_before"),
        F.expr(f"behind & (shiftleft(1L, 8 * ({BLOCK - 1} - _place)) - 1)").alias("_behind"),
    )
    equal = Window.partitionBy("key", "content", "_place", "_before", "_behind").orderBy("doc_id", "start")
    copies = windows.withColumn("_rank", F.rank().over(equal)).filter(passes | (F.col("_rank") > 1)).select("doc_id", "start", "length")
    removed = sorted_out.filter(F.col("kind") == FOLLOWER).select("doc_id", "start", "length").union(copies).groupBy("doc_id").agg(ranges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = [remaining(t, r) for t, r in zip(texts, batch.column("ranges").to_pylist())]
            columns = [
                batch.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([m[0] for m in made], pa.int64()),
                pa.array([m[1] for m in made], pa.int64()),
                pa.array([hashlib.sha256(m[2]).hexdigest() for m in made], pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([m[2] for m in made], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_text else "")
    return rows.join(removed, "doc_id", "left").select("doc_id", "text", "ranges").mapInArrow(cut, schema)
