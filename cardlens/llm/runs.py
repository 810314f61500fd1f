"""Periodic runs of words, found in a grammar of the text.

Re-Pair replaces the most frequent pairs of neighbouring symbols by nonterminals, round by round.  In one round every
pair goes that is more frequent than the pairs it overlaps; of equal ones a hash of the pair decides, and in a chain
of one pair every second place is taken.  Each replacement is kept with its place, so the derivation positions of a
nonterminal are known without expanding anything.  What is left of a text is hung under a balanced tree.

A run lies within some lowest node of that derivation and crosses the cut between the node's two halves.  So for each
nonterminal, once, and for each node of the tree, the runs that cross the cut are computed: for every period up to a quarter
of the node, the words behind or before the cut are compared with those one period on, and the match is extended within the node.
The runs of a nonterminal are carried to all of its positions, those with an equal period that overlap are merged, and
what was found by hashes is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import WORD_PATTERN, RangeHash, mix, slices

GAP = r"[\x20\x09-\x0D]+"
# pairs of a cut and a period that one pass works on
PAIRS_AT_ONCE = 1 << 20


class Grammar(NamedTuple):
    """Replacements in order of their nonterminal (id, first word, cut, end), what is left of the sequence, and how often each pair of words occurs."""

    ids: np.ndarray
    starts: np.ndarray
    cuts: np.ndarray
    ends: np.ndarray
    top: np.ndarray
    times: np.ndarray


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every key, equal for equal keys, and how often that key occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number, first = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(first, append=len(keys))
    group, times = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    group[order], times[order] = number, sizes[number]
    return group, times


def re_pair(words: np.ndarray, least: int = 2) -> Grammar:
    """The grammar of a sequence of word ids; a pair that occurs fewer than ``least`` times is never replaced.

    A place whose pair is that rare can never be part of a frequent one again, since replacing only makes pairs
    rarer; symbols between two such places are done and leave the working sequence.
    """
    n = len(words)
    symbol, start, stop = words.astype(np.int64), np.arange(n), np.arange(1, n + 1)
    dead, fresh = np.zeros(n, bool), int(words.max(initial=-1)) + 1
    dead[-1:] = True
    times_of_words, made, done = np.zeros(n, np.int64), [], []
    first_round = True
    while len(live := np.flatnonzero(~dead)):
        group, times = _groups(symbol[live] << 32 | symbol[live + 1])
        if first_round:
            times_of_words[live], first_round = times, False
        often = times >= least
        dead[live[~often]] = True
        live, group, times = live[often], group[often], times[often]
        if len(live):
            # frequency first, then a hash of the pair; a place next to a better one waits
            rank = np.zeros(len(symbol) + 2, np.uint64)
            worth = (times.astype(np.uint64) << np.uint64(32)) | (mix(group.astype(np.uint64), 29) >> np.uint64(33)) + np.uint64(1)
            rank[live + 1] = worth
            opens = np.ones(len(live), bool)
            opens[1:] = (np.diff(live) != 1) | (worth[1:] != worth[:-1])
            chain, first = np.cumsum(opens) - 1, np.flatnonzero(opens)
            last = np.append(first[1:], len(live)) - 1
            best = (rank[live[first]] < worth[first]) & (rank[live[last] + 2] < worth[first])
            at = live[best[chain] & ((np.arange(len(live)) - first[chain]) % 2 == 0)]
            number = np.zeros(len(symbol), np.int64)
            number[live] = group
            made.append((fresh + number[at], start[at], start[at + 1], stop[at + 1]))
            symbol[at], stop[at], dead[at] = fresh + number[at], stop[at + 1], dead[at + 1]
            fresh += int(group.max()) + 1
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, start, stop, dead = symbol[keep], start[keep], stop[keep], dead[keep]
        alone = dead.copy()
        alone[1:] &= dead[:-1]
        done.append(start[alone])
        symbol, start, stop, dead = symbol[~alone], start[~alone], stop[~alone], dead[~alone]
    ids, starts, cuts, ends = (np.concatenate(parts) if made else np.zeros(0, np.int64) for parts in (zip(*made) if made else [()] * 4))
    order = np.argsort(ids, kind="stable")
    top = np.sort(np.concatenate([*done, start])) if n else np.zeros(0, np.int64)
    return Grammar(ids[order], starts[order], cuts[order], ends[order], top, times_of_words)


def tree_nodes(top: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, cut and end of the nodes of a balanced tree over the symbols left of each text.

    The j-th symbol's front is the cut of a node as wide, on either side, as the greatest power of two that divides j.
    """
    text = np.searchsorted(firsts, top, side="right") - 1
    head = np.searchsorted(top, firsts)  # the first symbol of each text; empty texts have none
    size = np.diff(np.append(head, len(top)))
    j = np.arange(len(top)) - head[text]
    inner = j > 0
    place, j, text = np.flatnonzero(inner), j[inner], text[inner]
    reach = j & -j
    after = j + reach
    over = after >= size[text]
    end = np.where(over, ends[text], top[np.where(over, 0, head[text] + after)])
    return top[place - reach], top[place], end


class Runs(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


class RunFinder:
    """All maximal runs of a sequence of texts' word ids; ids differ between texts, so none crosses their border."""

    def __init__(self, words: np.ndarray, firsts: np.ndarray, ends: np.ndarray, times: int, least: int, seed: int = 3):
        self.words, self.firsts, self.ends, self.times, self.least = words, firsts, ends, times, least
        self.hash = RangeHash(words, seed)

    def crossing(self, left: np.ndarray, cut: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, Runs]:
        """The runs within each node that touch its cut, with the number of their node.

        A run holds every pair of neighbouring words ``times - 1`` times at least, so a cut between words that
        meet less often is crossed by none.
        """
        possible = np.flatnonzero((pairs[cut - 1] >= self.times - 1) & (right - left >= self.least))
        periods = (right[possible] - left[possible]) // self.times
        found: list[tuple[np.ndarray, ...]] = []
        for a, b in slices(periods.tolist(), PAIRS_AT_ONCE):
            node = np.repeat(possible[a:b], periods[a:b])
            q = np.arange(len(node)) - np.repeat(np.cumsum(periods[a:b]) - periods[a:b], periods[a:b]) + 1
            found.append(self._extended(left, cut, right, node, q))
        node, start, end, q = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
        # multiples of a period give the same words; the smallest stays
        order = np.lexsort((q, end, start, node))
        node, start, end, q = node[order], start[order], end[order], q[order]
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        return node[new], Runs(start[new], end[new], q[new])

    def _extended(self, left: np.ndarray, cut: np.ndarray, right: np.ndarray, node: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
        """The longest runs of period ``q`` at each cut, one on either side; a run with four periods has two of them on one side."""
        words, of, c = self.words, self.hash.of, cut[node]
        ahead = c + 2 * q <= right[node]
        ahead &= words[c] == words[np.where(ahead, c + q, c)]
        some = np.flatnonzero(ahead)
        ahead = some[of(c[some], c[some] + q[some]) == of(c[some] + q[some], c[some] + 2 * q[some])]
        behind = c - 2 * q >= left[node]
        behind &= words[c - 1] == words[np.where(behind, c - 1 - q, c - 1)]
        some = np.flatnonzero(behind)
        behind = some[of(c[some] - 2 * q[some], c[some] - q[some]) == of(c[some] - q[some], c[some])]
        at = np.concatenate([c[ahead], c[behind] - q[behind]])
        some = np.concatenate([ahead, behind])
        node, q = node[some], q[some]
        more = self._reach(at, at + q, right[node] - at - q, 1)
        less = self._reach(at, at + q, at - left[node], -1)
        start, end = at - less, at + q + more
        enough = end - start >= np.maximum(self.least, self.times * q)
        return node[enough], start[enough], end[enough], q[enough]

    def _reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words agree from two places on, forwards or backwards, by bisection over hashes."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.hash.of(a, a + half) == self.hash.of(b, b + half) if way > 0 else self.hash.of(a - half, a) == self.hash.of(b - half, b)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def runs(self) -> Runs:
        """Every maximal run, by text, start and period."""
        g = re_pair(self.words)
        first = np.ones(len(g.ids), bool)
        first[1:] = g.ids[1:] != g.ids[:-1]
        head = np.flatnonzero(first)
        node, own = self.crossing(g.starts[head], g.cuts[head], g.ends[head], g.times)
        # from the nonterminal's first position to all of them
        count = np.diff(head, append=len(g.ids))[node]
        each = np.repeat(np.arange(len(node)), count)
        at = np.repeat(head[node], count) + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        moved = g.starts[at] - g.starts[head[node]][each]
        left, cut, right = tree_nodes(g.top, self.firsts, self.ends)
        _, upper = self.crossing(left, cut, right, g.times)
        start = np.concatenate([own.start[each] + moved, upper.start])
        end = np.concatenate([own.end[each] + moved, upper.end])
        period = np.concatenate([own.period[each], upper.period])
        return self._checked(self._merged(start, end, period))

    def _merged(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
        """Maximal intervals of one period; two parts of one run overlap by a period or more."""
        text = np.searchsorted(self.firsts, start, side="right") - 1
        order = np.lexsort((-end, start, period, text))
        start, end, period, text = start[order], end[order], period[order], text[order]
        if not len(start):
            return Runs(start, end, period)
        group = np.zeros(len(start), np.int64)
        group[1:] = np.cumsum((text[1:] != text[:-1]) | (period[1:] != period[:-1]))
        span = len(self.words) + 1
        reach = np.maximum.accumulate(end + group * span) - group * span
        new = np.ones(len(start), bool)
        new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - period[1:])
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(start)) - 1
        start, end, period = start[head], reach[last], period[head]
        order = np.lexsort((period, start))
        return Runs(start[order], end[order], period[order])

    def _checked(self, runs: Runs) -> Runs:
        """The runs, after comparing the words themselves; a collision of hashes is an error, met by another seed."""
        for start, end, q in zip(*(x.tolist() for x in runs)):
            same = np.array_equal(self.words[start : end - q], self.words[start + q : end])
            if not same:
                raise HashCollision
        return runs


class HashCollision(Exception):
    pass


def find_runs(words: np.ndarray, firsts: np.ndarray, ends: np.ndarray, times: int = 4, least: int = 6) -> Runs:
    for seed in range(3, 19):
        try:
            return RunFinder(words, firsts, ends, times, least, seed).runs()
        except HashCollision:
            continue
    raise HashCollision


def _words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of some texts, with the first and the end of each text's own."""
    split = pc.split_pattern_regex(texts, GAP)
    text, words = pc.list_parent_indices(split), pc.list_flatten(split)
    real = pc.greater(pc.binary_length(words), 0)
    text, words = text.filter(real).to_numpy(zero_copy_only=False), words.filter(real)
    number = np.arange(len(texts))
    return words, np.searchsorted(text, number), np.searchsorted(text, number, side="right")


def _numbered(words: pa.Array, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word ids that are equal within a text only."""
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(firsts)), ends - firsts)
    return _groups(text << 32 | code)[0]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


RESULT = "doc_id {id}, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"


def periodic_runs(docs: DataFrame, times: int = 4, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The periodic runs of every whole text, and the text with one period of each.

    A run is a longest stretch of words with smallest period q and at least ``max(least, times * q)`` of them;
    ``times`` is 4 or more.  Returns ``doc_id, n_words, starts, lengths, periods, collapsed``: runs by start, then
    period, in words, and the words that no run holds after its first q, joined by a blank.  A null or empty text has no
    words, no runs and an empty result; rows are independent, so repeated rows give repeated results and an empty table an
    empty one.  A text longer than a slice is worked on alone, at a few hundred bytes a word.  Other columns are not looked at.
    """
    if times < 4:
        raise ValueError("a run is told by two periods on one side of a cut, so times is 4 or more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "starts", "lengths", "periods", "collapsed"]
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column("text")).to_pylist()):
                words, firsts, ends = _words_of(batch.column("text").slice(a, b - a))
                found = find_runs(_numbered(words, firsts, ends), firsts, ends, times, least)
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, found.start + found.period, 1)
                np.add.at(gone, found.end, -1)
                keep = np.cumsum(gone[:-1]) == 0
                kept_before = np.concatenate([[0], np.cumsum(keep)])
                offsets = pa.array(np.append(kept_before[firsts], kept_before[-1]), pa.int32())
                collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(keep))), " ")
                bounds = np.append(np.searchsorted(found.start, firsts), len(found.start))
                first = firsts[np.searchsorted(firsts, found.start, side="right") - 1] if len(found.start) else found.start
                columns = [found.start - first, found.end - found.start, found.period]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(ends - firsts, pa.int64()), *(_lists(x, bounds) for x in columns), collapsed], names
                )

    return rows.mapInArrow(work, RESULT.format(id=kind))


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of the ids with a period planted into its end: from word a on, the words are those of a period p over and over.

    With h = crc32 of the decimal id and g = h / 10: where h % 10 = 0, a = g % n and p = 1 + (n - a) / (3 + g % 8).  Rows
    without id, or without words, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    sized = F.named_struct(F.lit("w"), words, F.lit("n"), F.size(words), F.lit("a"), (g % F.size(words)).cast("int"))

    def planted(x: Column) -> Column:
        w, n, a = x["w"], x["n"], x["a"]
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    has_words = text.rlike(WORD_PATTERN)
    made = F.transform(F.array(sized), planted)
    return F.when((h % 10 == 0) & has_words, F.get(made, F.lit(0))).otherwise(text)
