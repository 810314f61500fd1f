"""Fill in the middle: a text is cut at two of its token boundaries and laid out as prefix, suffix, middle.

The places of the cuts are ranks among the text's tokens, and the text is stored in code points, so both are
counted at once in an indexable skip list.  Its bottom lane is the text itself.  Every token has a height drawn from
its number; each express lane holds the tokens of at least that height, and says for each how many units (tokens)
and how many code points lie between it and the next one of its lane.  A search goes along the highest lane
while the units passed do not exceed the wanted rank, then one lane down, adding up both widths; the last steps go
through the few tokens of the text itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import SLICE, mix, slices

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")
MARKS = ("<P>", "<S>", "<M>")
# a token is in the first express lane with a chance of 1 to 2 ** LIFT, in each further one likewise
LIFT = 4


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)


class SkipList:
    """The tokens of one text, found by rank; lanes take about a sixteenth of an entry per token."""

    def __init__(self, text: str, piece: int = SLICE):
        self.text = text
        ranks, places, self.size, in_word = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0, False
        for start in range(0, len(text), piece):
            signs = code_points(text[start : start + piece])
            letter = ((signs | 32) >= 97) & ((signs | 32) <= 122)
            opens = np.ones(len(signs), bool)
            opens[1:] = ~(letter[1:] & letter[:-1])
            opens[0] = not (letter[0] and in_word)
            in_word = bool(letter[-1])
            at = np.flatnonzero(opens)
            numbers = np.arange(self.size, self.size + len(at))
            tall = self.heights(numbers) > 0
            ranks.append(numbers[tall])
            places.append(at[tall] + start)
            self.size += len(at)
        rank, place = np.concatenate(ranks), np.concatenate(places)
        keep = np.ones(len(rank), bool)
        keep[1:] = rank[1:] > 0  # the head, token 0, stands in every lane
        rank, place = rank[keep], place[keep]
        height = self.heights(rank)
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        level = 1
        while True:
            here = np.flatnonzero((height >= level) | (rank == 0))
            # per node: units and code points up to the next node of the lane, and its place in the lane below
            units, points = np.diff(rank[here], append=self.size), np.diff(place[here], append=len(text))
            down = here if level == 1 else np.searchsorted(below, here)  # noqa: F821
            self.lanes.append((units, points, down))
            if len(here) <= 1:
                break
            below, level = here, level + 1

    @staticmethod
    def heights(numbers: np.ndarray) -> np.ndarray:
        """How many express lanes a token is in: drawn from its number, so equal texts have equal lists."""
        bits = mix(numbers.astype(np.uint64), 11) | np.uint64(1 << 60)
        low = bits & (~bits + np.uint64(1))
        return (np.log2(low.astype(np.float64)).astype(np.int64)) // LIFT

    def place(self, rank: int) -> int:
        """Code points before the token of this rank; all of them for the number of tokens."""
        if not 0 <= rank <= self.size:
            raise IndexError(rank)
        if rank == self.size:
            return len(self.text)
        node = units = points = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            wide, long, down = self.lanes[lane]
            while node < len(wide) and units + wide[node] <= rank:
                units, points, node = units + int(wide[node]), points + int(long[node]), node + 1
            if lane:
                node = int(down[node])
        while units < rank:
            points, units = TOKEN.match(self.text, points).end(), units + 1
        return points


def lay_out(text: str, first: int, second: int, form: str) -> str:
    """The text in its form: ``psm``, ``spm``, or as it is."""
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return f"<P>{prefix}<S>{suffix}<M>{middle}"
    if form == "spm":
        return f"<S>{suffix}<P>{prefix}<M>{middle}"
    return text


def restore(output: str, form: str) -> str:
    """The text that was laid out; its parts hold no mark, so the first one of each kind is the real one."""
    if form == "plain":
        return output
    inner = "<S>" if form == "psm" else "<P>"
    cut = output.index(inner, 3)
    end = output.index("<M>", cut + 3)
    one, two, middle = output[3:cut], output[cut + 3 : end], output[end + 3 :]
    return one + middle + two if form == "psm" else two + middle + one


def draws(doc_id: Column) -> list[Column]:
    """Four numbers below 2 ** 32 for a document, from its id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored_sha256"]
OUT = "doc_id {id}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored_sha256 string"


def fill_in_middle(
    docs: DataFrame, plain_percent: int = 10, suffix_first_percent: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every whole text laid out for training to fill in its middle.

    Returns ``doc_id, n, form, prefix_chars, middle_chars, output, restored_sha256``: the number of tokens, ``psm``,
    ``spm`` or ``plain``, code points of the first two parts (null for plain texts), the new text, and
    the digest of the text rebuilt from that alone.  A null or empty text is plain and stays empty, as does a text that
    holds a mark.  What happens to a row hangs on its id and text only: repeated rows give repeated results, a null id
    draws like an empty one, equal cut ranks give an empty middle, and an empty table an empty result.  Long
    texts are worked on in pieces.  Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.array(*draws(F.col(id_col))).alias("draws"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def laid_out(text: str, drawn: list[int]) -> tuple:
        h1, h2, h3, h4 = drawn
        tokens = SkipList(text)
        if not text or any(mark in text for mark in MARKS) or h3 % 100 >= 100 - plain_percent:
            return tokens.size, "plain", None, None, text
        form = "spm" if h4 % 100 < suffix_first_percent else "psm"
        first, second = map(tokens.place, sorted((h1 % (tokens.size + 1), h2 % (tokens.size + 1))))
        return tokens.size, form, first, second - first, lay_out(text, first, second, form)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            ids, texts, drawn = (batch.column(c) for c in ("doc_id", "text", "draws"))
            for start, end in slices(pa.compute.binary_length(texts).to_pylist()):
                made = [laid_out(t, d) for t, d in zip(texts.slice(start, end - start).to_pylist(), drawn.slice(start, end - start).to_pylist())]
                made = [(*row, hashlib.sha256(restore(row[4], row[1]).encode("utf-8")).hexdigest()) for row in made]
                columns = [pa.array(list(values), kind) for values, kind in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([ids.slice(start, end - start), *columns], NAMES)

    return rows.mapInArrow(work, OUT.format(id=kind))
