"""Cuts by rank, periodic runs and shared lines against brute force, with odd ids, odd texts and empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import lines, middle, runs
from cardlens.llm.queries import QUERIES
from test_llm import LOWER, SMALL, WORDS, documents

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_ranks_are_found_exactly(piece):
    rnd = random.Random(piece)
    for n in (0, 1, 2, 40, 700, 5000):
        text = "".join(rnd.choice("abZ é1\n𝄞") for _ in range(n))
        tokens, found = TOKEN.findall(text), middle.SkipList(text, piece)
        assert found.size == len(tokens)
        for rank in {0, len(tokens), *(rnd.randint(0, len(tokens)) for _ in range(20))}:
            assert found.place(rank) == len("".join(tokens[:rank]))
        with pytest.raises(IndexError):
            found.place(len(tokens) + 1)


def test_lanes_say_how_much_they_skip():
    text = "word, " * 30_000
    found = middle.SkipList(text)
    assert len(found.lanes) >= 3
    for units, points, _ in found.lanes:
        assert units.sum() == found.size and points.sum() == len(text)
    sizes = [len(units) for units, _, _ in found.lanes]
    assert sizes[0] < found.size / 8 and all(b < a / 4 for a, b in zip(sizes, sizes[1:-1]))


def fim(doc_id, text):
    text = text or ""
    tokens, h = TOKEN.findall(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    one, two, three = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    return len(tokens), form, len(one), len(two), f"<P>{one}<S>{three}<M>{two}" if form == "psm" else f"<S>{three}<P>{one}<M>{two}"


def test_fill_in_middle(make):
    rows = [r[:2] for r in documents()] + [(2001 + i, f"ab<P{'>' * (i % 2)} <S <<S cd <M " * (i + 1)) for i in range(60)] + [(None, "no id"), (7, "é" * 90_000 + "z")]
    got = middle.fill_in_middle(make(rows)).collect()
    want = [(i, *fim(i, t), digest(t or "")) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_parts_with_halves_of_marks(form):
    for text in ("<", "<<S", "<S<P", "P><S", "a<M", "<P<S<M"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                assert middle.restore(middle.lay_out(text, a, b, form), form) == text


# ---- periodic runs


def runs_of(words, times=4, least=6):
    """Every maximal stretch of every period, the smallest first, so that a multiple finds its stretch taken."""
    found, taken = [], set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, times * q) and (start, i + q) not in taken:
                taken.add((start, i + q))
                found.append((start, i + q - start, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rnd, n, letters):
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 3))
            b = rnd.randint(a, n)
            words[a:b] = [words[a + (i - a) % p] for i in range(a, b)]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(8)
    for _ in range(250):
        texts = [periodic(rnd, rnd.choice([0, 1, 6, 30, 250]), rnd.choice([1, 2, 3, 30])) for _ in range(rnd.randint(1, 6))]
        ends = np.cumsum([len(t) for t in texts])
        firsts = ends - [len(t) for t in texts]
        found = runs.find_runs(np.array([100 * d + x for d, t in enumerate(texts) for x in t], np.int64), firsts, ends)
        for text, a, b in zip(texts, firsts, ends):
            own = (found.start >= a) & (found.start < b)
            assert list(zip((found.start[own] - a).tolist(), (found.end - found.start)[own].tolist(), found.period[own].tolist())) == runs_of(text)


def test_grammar_derives_its_text():
    rnd = random.Random(2)
    for _ in range(200):
        words = np.array(periodic(rnd, rnd.randint(1, 80), 3), np.int64)
        g = runs.re_pair(words)
        left, cut, right = runs.tree_nodes(g.top, np.array([0]), np.array([len(words)]))
        assert sorted([*g.cuts, *cut]) == list(range(1, len(words)))  # each gap between words is the cut of one node
        spans = defaultdict(set)
        for i, a, c, b in zip(g.ids, g.starts, g.cuts, g.ends):
            spans[int(i)].add((tuple(words[a:b]), c - a))
        assert all(len(s) == 1 for s in spans.values())
    even = runs.re_pair(np.zeros(4096, np.int64))
    assert len(set(even.ids.tolist())) <= 12  # a power of two of equal words is a grammar of one rule a level


def test_a_collision_of_hashes_is_met_by_another_seed(monkeypatch):
    real, tried = runs.RunFinder.runs, []

    def bad(self):
        tried.append(self.hash.seed)
        found = real(self)
        return self._checked(runs.Runs(found.start, found.end + 1, found.period)) if len(tried) == 1 else found

    monkeypatch.setattr(runs.RunFinder, "runs", bad)
    words = np.array([1] * 8 + [2, 3], np.int64)
    assert runs.find_runs(words, np.array([0]), np.array([10])).end.tolist() == [8] and len(tried) == 2


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = WORDS.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_operator_on_odd_texts(make):
    rows = [r[:2] for r in documents()] + [(3000, "x " * 30_000), (3001, "a b " * 9 + "\x1c a b " * 9), (None, "q q q q q q q")]
    got = sorted(map(repr, map(tuple, runs.periodic_runs(make(rows)).collect())))
    want = []
    for i, text in rows:
        words = WORDS.findall(text or "")
        found = runs_of(words) if i != 3000 else [(0, 30_000, 1)]
        want.append((i, len(words), *[[r[k] for r in found] for k in range(3)], collapsed(words, found)))
    assert got == sorted(map(repr, want))
    with pytest.raises(ValueError):
        runs.periodic_runs(make(rows), times=3)


def test_query_of_runs(workers, make, tmp_path):
    rows = [(r[0], r[1]) for r in workers.read.parquet(f"{SMALL}/documents.parquet").collect()] + [(i, "tick tock " * (i % 40)) for i in range(5000, 5060)]
    rows += [(None, "a " * 12), (6000, None), (6001, " \n ")] + rows[:2]
    make(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, text in rows:
        words = planted(i, text)
        found = runs_of(words)
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
        shown = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want.append((i, len(found), *shown, digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(collapsed(words, found))))
    got = list(map(tuple, QUERIES["op12_periodic_runs"](workers, str(tmp_path)).collect()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(1 for w in want if w[1]) > 20


# ---- shared lines


def without_lines(rows, least=20, enough=3):
    key = lambda line: line.strip("\t\n\x0b\x0c\r ").translate(LOWER)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, text in rows:
        split = (text or "").split("\n")
        keep = [x for x in split if len(key(x)) < least or len(holders[key(x)]) < enough or max(holders[key(x)]) == (-1 if i is None else i)]
        out.append((i, len(split), len(split) - len(keep), "\n".join(keep)))
    return sorted(map(repr, out))


def shared_lines(seed, n):
    rnd = random.Random(seed)
    often = ["All rights reserved by someone", " all RIGHTS reserved by someone\t", "short", "É" * 20, "é" * 20, "x" * 19, "y" * 20]
    rows = [(rnd.randrange(n), "\n".join(rnd.choice(often + [f"line number {rnd.randrange(n)} of the book"]) for _ in range(rnd.randint(0, 6)))) for _ in range(n)]
    return rows + [(None, "y" * 20 + "\n\n" + often[0]), (None, often[0]), (n, None), (n + 1, ""), (n + 2, "\n" * 5), rows[0]]


@pytest.mark.parametrize("batches, fan", [(1, 2), (4, 2), (5, 3)])
def test_lines_equal_brute_force(make, batches, fan):
    rows = shared_lines(batches, 150)
    got = lines.drop_repeated_lines(make(rows), batches=batches, fan=fan)
    assert sorted(map(repr, map(tuple, got.collect()))) == without_lines(rows)


def test_lines_of_one_id_and_of_none(make):
    same = [(5, "a line of twenty signs or more")] * 4
    assert sorted(map(repr, map(tuple, lines.drop_repeated_lines(make(same)).collect()))) == without_lines(same)
    many = [(i % 3, "a line of twenty signs or more\n" * i) for i in range(9)] + [(None, "a line of twenty signs or more")]
    assert sorted(map(repr, map(tuple, lines.drop_repeated_lines(make(many)).collect()))) == without_lines(many)


def test_runs_are_merged_level_by_level(workers, tmp_path):
    kept = lines.LineRuns(workers, str(tmp_path), enough=3, fan=2)
    shapes = []
    for top in range(9, 2, -1):
        kept.add(workers.createDataFrame([("settled", 3, top), ("slow", 1, top), (f"own {top}", 1, top)], "key string, docs long, top long"))
        shapes.append([len(level) for level in kept.levels])
    assert shapes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]]
    assert sorted(map(tuple, kept.repeated().collect())) == [("settled", 9), ("slow", 9)]
    rows = workers.read.parquet(*[p for level in kept.levels for p in level])
    assert rows.where("key = 'settled'").agg(F.sum("docs")).head()[0] == 3  # the key was settled by the first batch
    assert len([p for p in tmp_path.rglob("run=*")]) == 3  # what was merged is gone
    with pytest.raises(ValueError):
        lines.LineRuns(workers, str(tmp_path), enough=3, fan=1)


def test_empty_tables_of_all_three(make):
    docs = make([])
    assert middle.fill_in_middle(docs).count() == runs.periodic_runs(docs).count() == lines.drop_repeated_lines(docs).count() == 0
