"""Byte-level BPE with a public vocabulary: encoding, decoding and their digests.

A text is cut into words; a word is looked up in a bounded memory of earlier words or
merged anew.  A short word is merged in a contiguous rank array: its parts and the rank of
every adjacent pair stand side by side, the lowest rank is found by scanning, its
boundary is deleted and the two neighbouring ranks are looked up again; many words
go through these rounds together.  A long word takes a heap, whose cost does not grow with the square of length.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import RangeHash, slices

SHORT_WORD = 96
# what the words remembered by one worker may take, and about what an entry takes besides its text and ids
MEMORY_BYTES = 72 << 20
ENTRY_BYTES = 180
# white space in the sense of Unicode, spelled out: Python's own \s also holds four separators that Rust's lacks
WHITE = "\t-\r \x85\xa0  -     　"
# the word pattern of this vocabulary (fixed value)
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+|[" + WHITE + r"]+(?![^" + WHITE + r"])|[" + WHITE + r"]+"
)
# white space and what follows it; no word reaches over the end of such a piece
PIECES = re.compile("[" + WHITE + "]*[^" + WHITE + "]+|[" + WHITE + "]+")
NO_RANK = (1 << 31) - 1
WIDTHS = (6, 9, 12, 16, 24, 48, SHORT_WORD)
ROWS_AT_ONCE = 4096


def visible_bytes() -> dict[str, int]:
    """The printable stand-in of every byte: itself where Latin-1 prints it, else a letter from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    table = {chr(b): b for b in shown}
    for place, b in enumerate(b for b in range(256) if b not in set(shown)):
        table[chr(256 + place)] = b
    return table


class Tokenizer:
    """Vocabulary, merge ranks and special strings of one tokenizer file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        byte_of = visible_bytes()
        ids = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        rank: dict[int, int] = {}
        made = []
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = (bytes(byte_of[c] for c in part) for part in (left, right))
            rank.setdefault(ids[a] << 32 | ids[b], place)
            made.append(ids[a + b])
        self.made = np.array(made, np.int32)
        self.single = [ids[bytes([b])] for b in range(256)]
        self.single_ids = np.array(self.single, np.int32)
        # the pairs in order, with a last one that nothing equals
        pairs = sorted(rank.items())
        self.pairs = np.array([p for p, _ in pairs] + [2**62], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [NO_RANK], np.int32)
        self.byte_ranks = self._ranks(np.repeat(self.single_ids, 256), np.tile(self.single_ids, 256)).reshape(256, 256)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remembered = 0

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, four bytes each; short words of like length are merged side by side."""
        made = [b""] * len(words)
        rows: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > SHORT_WORD:
                made[i] = np.array(self._merge_heap([self.single[b] for b in word]), np.uint32).tobytes()
            elif word:
                rows.setdefault(next(w for w in WIDTHS if len(word) <= w), []).append(i)
        for width, own in rows.items():
            for start in range(0, len(own), ROWS_AT_ONCE):
                some = own[start : start + ROWS_AT_ONCE]
                for i, parts in zip(some, self._merge_arrays([words[i] for i in some], width)):
                    made[i] = parts
        return made

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        place = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[place] == pair, self.pair_ranks[place], NO_RANK)

    def _merge_arrays(self, words: list[bytes], width: int) -> Iterator[bytes]:
        """One row per word: its parts, and the rank of every adjacent pair, side by side.

        Each round scans every row for its lowest rank, deletes that boundary, and looks the two neighbouring
        ranks up again; rows without a rank are done.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        parts = self.single_ids[raw]
        ranks = np.full((len(words), width), NO_RANK, np.int32)
        ranks[:, :-1] = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
        ranks[np.arange(width) >= (sizes - 1)[:, None]] = NO_RANK
        left, rows, columns = sizes.copy(), np.arange(len(words)), np.arange(width - 1)
        done_parts = parts.copy()
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            best = ranks[here, at]
            going = best != NO_RANK
            if not going.all():
                done_parts[rows[~going]] = parts[~going]
                rows, parts, ranks, at, best = rows[going], parts[going], ranks[going], at[going], best[going]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            left[rows] -= 1
            behind = columns >= at[:, None]
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            parts[:, :-1] = np.where(behind, parts[:, 1:], parts[:, :-1])
            parts[here, at] = self.made[best]
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self._ranks(parts[some, at[some] - 1], parts[some, at[some]])
            some = np.flatnonzero(at + 1 < left[rows])
            ranks[some, at[some]] = self._ranks(parts[some, at[some]], parts[some, at[some] + 1])
            some = np.flatnonzero(at + 1 >= left[rows])
            ranks[some, at[some]] = NO_RANK
        raw, step = done_parts.astype(np.uint32).tobytes(), 4 * width
        for row, size in enumerate(left.tolist()):
            yield raw[row * step : row * step + 4 * size]

    def _merge_heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        at = np.array(parts, np.int64)
        first_ranks = self._ranks(at[:-1], at[1:]).tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        def known(left: int, right: int) -> int:
            place = int(np.searchsorted(self.pairs, left << 32 | right))
            return int(self.pair_ranks[place]) if self.pairs[place] == left << 32 | right else NO_RANK

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (best := known(parts[i], parts[after[i]])) != NO_RANK:
                heapq.heappush(heap, (best, i, parts[i], parts[after[i]]))

        heap = [(best, i, parts[i], parts[i + 1]) for i, best in enumerate(first_ranks) if best != NO_RANK]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one side has been merged meanwhile
            parts[i], parts[j] = int(self.made[best]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces not met lately; the short ones are remembered, in two generations of bounded size."""
        older, ids, split, words = self.older.get, {}, {}, {}
        for text in pieces:
            if (found := older(text)) is not None:
                ids[text] = found
            else:
                split[text] = own = WORDS.findall(text)
                words.update(dict.fromkeys(own))
        known = self.memory.get
        for word in words:
            words[word] = known(word) or older(word)
        fresh = [word for word, found in words.items() if found is None]
        words.update(zip(fresh, self.merge([word.encode("utf-8") for word in fresh])))
        for text, own in split.items():
            ids[text] = words[own[0]] if len(own) == 1 else b"".join(map(words.__getitem__, own))
        for source in (words, ids):
            for text, found in source.items():
                if len(text) <= SHORT_WORD and text not in self.memory:
                    self._remember(text, found)
        return ids

    def _remember(self, text: str, found: bytes) -> None:
        """Half of the memory is the younger generation; when it is full it becomes the older one, and the older is dropped."""
        self.remembered += ENTRY_BYTES + 2 * len(text) + len(found)
        if self.remembered > MEMORY_BYTES // 2:
            self.older, self.memory, self.remembered = self.memory, {}, 0
        self.memory[text] = found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; special strings inside it are their special ids."""
        sections = [self.special_split.split(text) if self.special_split else [text] for text in texts]
        pieces = [[[s] if s in self.special else PIECES.findall(s) for s in own] for own in sections]
        found = [list(map(self.memory.get, chain.from_iterable(own))) for own in pieces]
        unknown = {p for own, ids in zip(pieces, found) if None in ids for p, i in zip(chain.from_iterable(own), ids) if i is None}
        special = {text: np.uint32(i).tobytes() for text, i in self.special.items()}
        learned = self._learn(unknown - special.keys()) | special if unknown else {}
        made = []
        for own, ids in zip(pieces, found):
            if None in ids:
                ids = [learned[p] if i is None else i for p, i in zip(chain.from_iterable(own), ids)]
            made.append(np.frombuffer(b"".join(ids), np.uint32))
        return made

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become the replacement sign."""
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


_loaded: dict[str, Tokenizer] = {}


def tokenizer(name: str) -> Tokenizer:
    """The tokenizer of a file that the driver has handed out, one per worker process."""
    if name not in _loaded:
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            _loaded[name] = Tokenizer(file.read())
    return _loaded[name]


RESULT = "doc_id {id}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean{more}"


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Encode every whole text, decode it again, and return counts and digests.

    ``vocabulary`` is the path of a byte-level BPE file on the driver; Spark hands it to the executors.  Returns
    ``doc_id, n_tokens, ids_sha256, decoded_sha256, exact``, with ``keep_ids`` also the ids; ``exact`` tells that
    decoding gives the text back.  A null text is empty: no tokens.  Rows are independent, so repeated rows give
    repeated results and an empty table an empty one; other columns are not looked at.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        RangeHash.forget()  # of an earlier stage in this worker
        encoder = tokenizer(name)
        collecting = gc.isenabled()
        gc.disable()  # millions of small objects, none in a cycle
        try:
            yield from encoded(encoder, batches)
        finally:
            if collecting:
                gc.enable()

    def encoded(encoder: Tokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for start, end in slices(pa.compute.binary_length(texts).to_pylist()):
                counts, codes, back, exact, lists = [], [], [], [], []
                some = texts.slice(start, end - start).to_pylist()
                for text, made in zip(some, encoder.encode(some)):
                    again = encoder.decode(made)
                    counts.append(len(made))
                    codes.append(hashlib.sha256(made.astype("<u4").tobytes()).hexdigest())
                    back.append(hashlib.sha256(again.encode("utf-8")).hexdigest())
                    exact.append(again == text)
                    if keep_ids:
                        lists.append(made.astype(np.int32))
                columns = [ids.slice(start, end - start), pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(back, pa.string()), pa.array(exact, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"]
                if keep_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, RESULT.format(id=kind, more=", ids array<int>" if keep_ids else ""))
