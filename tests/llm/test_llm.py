"""Every operator against brute force, with nulls, empty and long texts, ties, repeated rows and empty tables.

The made documents carry extra columns with names that the operators use inside.
"""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardlens.llm import bpe, exact, langid, mixing, neardup, pages, pii, quality, repeats, topk
from cardlens.llm.common import held_out
from cardlens.llm.queries import ORACLE, QUERIES, vocabulary_path
from checks.compare import differences, oracle_frame, spark_frame

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(seed=1, n=120):
    """Copies, near copies, shared passages, nulls, blanks and one long text."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    base, passage = prose(150), prose(60)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            words = base.split()
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            text = " ".join(words)
        elif kind == 1:
            text = prose(rnd.randint(1, 40)) + "\n" + passage + " " + prose(10)
        elif kind == 2:
            text = base.upper() if rnd.random() < 0.5 else base
        else:
            text = prose(rnd.randint(1, 120))
        rows.append((i * 3 + 1, text, "x" if i % 2 else "y", f"s{i % 4}" if i % 7 else None, len(text)))
    rows += [(1000, None, None, None, None), (1001, "", None, "s0", 0), (1002, " \t\n", "x", "s9", 3), (1003, "É", "x", "s1", 1), (1004, "é", "x", "s1", 1)]
    rows += [(1005, "one two", "x", "s1", 7), (1006, "ONE  two", "x", "s1", 8), (1007, prose(9000), "y", "s2", 1), (1008, "ab" * 400, "x", "s2", 800)]
    rows.append(rows[3])
    return rows


def sets_of(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components_of(texts):
    sets = {k: sets_of(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= 85 * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def without_repeats(texts):
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(workers, name):
    assert differences(spark_frame(QUERIES[name](workers, SMALL)), oracle_frame(SMALL, ORACLE[name])) is None


def test_empty_tables(make):
    docs = make([])
    assert exact.exact_dedup(docs).count() == neardup.near_duplicates(docs).count() == repeats.remove_repeats(docs).count() == 0
    assert mixing.mix_sources(docs).count() == pii.replace_entities(docs, "k").count() == 0
    assert bpe.encode_documents(docs, vocabulary_path()).count() == langid.identify(docs, langid.train(docs)).count() == 0
    labels = make([], "doc_id bigint, quality int")
    assert quality.score_quality(docs, quality.train(docs, labels)).count() == 0
    vectors = make([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(vectors, vectors).count() == 0
    assert pages.main_text(make([], "page_id bigint, url string, html string")).count() == 0


def test_language_of_held_out_texts(workers, make):
    docs = workers.read.parquet(f"{SMALL}/documents.parquet")
    models = langid.train(docs)
    found = langid.identify(docs, models).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out(F.col("doc_id")))
    assert found.filter("lang_pred = lang").count() >= 0.95 * found.count()
    odd = make([(1, None), (2, ""), (3, "12 34 !!"), (4, "the " * 200_000), (4, "the"), (5, "qxzjv wqkxzj vvxqzk " * 30)])
    rows = [tuple(r)[:3] for r in langid.identify(odd, models).collect()]
    assert [r[1] for r in rows[:3]] == ["und"] * 3 and all(0 <= r[2] <= 1 for r in rows)
    assert {r["doc_id"] for r in langid.accept(odd, models).collect()} == {4}
    assert langid.accept(docs, models).count() >= 0.99 * docs.count()


def test_language_models_are_distributions(make):
    docs = make([(i, t, "x" if i % 2 else "y") for i, t in enumerate(["abab ab", "ba ba", "abc", "bca"] * 20)])
    models = langid.train(docs, learn_from=F.lit(True))
    symbols = sorted({c for g in ("abc ",) for c in g})
    for lang in range(len(models.languages)):
        total = 0.0
        for s in symbols:
            hashes = langid.RangeHash(np.array([ord("a"), ord("b"), ord(s)], np.uint32), langid.HASH_SEED)
            for order in (3, 2, 1):
                row, known = langid.look_up(models.grams[order], hashes.of(np.array([3 - order]), np.array([3])))
                if known[0]:
                    back = 0.0
                    for above in range(order + 1, 4):
                        at, has = langid.look_up(models.contexts[above], hashes.of(np.array([3 - above]), np.array([2])))
                        back += float(models.log_back[above][at[0], lang]) if has[0] else 0.0
                    total += np.exp(back + float(models.log_p[order][row[0], lang]))
                    break
        assert 0.5 < total < 1.01  # the rest is kept for unknown symbols


def test_surrogates(make):
    rows = [
        (1, "Mr. John Smith met Mrs Anna Smith; a@b.co A@B.CO 4111 1111 1111 1111, GB82 WEST 1234 5698 7654 32, 10.1.2.3"),
        (2, "Mr. Smith wrote to a@b.co from 4111-1111-1111-1111 or c@b.co, (212) 555-1234, token = \"" + "ab12" * 10 + '"'),
        (3, None), (4, ""), (None, "at 10.1.2.3 now"), (5, "no data here"), (5, "no data here"), (6, "x " * 100_000 + "a@b.co"),
    ]
    got = pii.replace_entities(make(rows), "k").collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["text"] for r in got}
    one, two = by_id[1], by_id[2]
    for secret in ("John", "Smith", "Anna", "b.co", "4111", "10.1.2.3", "5698", "555-1234", "ab12ab12"):
        assert not any(secret in (t or "") for t in by_id.values())
    mails = re.findall(r"\S+@\S+?(?=[ ,;]|$)", one)
    assert mails[0] == mails[1] and mails[0] in two and mails[0] in by_id[6]
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", one)[0]
    assert card.replace(" ", "-") in two
    digits = [int(c) for c in card if c.isdigit()][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    family = re.search(r"Mr\. \w+ (\w+)", one)[1]
    assert f"Mr. {family} " in two and re.search(r"Mrs (\w+)", one)[1] in pii.GIVEN["flatin"]
    iban = re.search(r"GB\d\d [A-Z0-9 ]+", one)[0].replace(" ", "").rstrip(",")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert by_id[5] == "no data here" and by_id[3] is None and by_id[4] == ""
    assert pii.replace_entities(make(rows), "other").filter("doc_id = 1").first()["text"] != one


def test_surrogates_keep_gender_script_and_form(make):
    texts = [
        "Dr Mary Anne Smith and Mrs Mary Anne Smith", "Prof. Mary Anne Smith alone", "Mr John Q. Public, MR. JOHN",
        "Mr Παπαδόπουλος Γιώργος, Г-жа Анна Петрова, Dr Արամ Սարգսյան", "call +49 30 1234567 or 030 1234567",
        "call +1 555 123 4567 or (555) 123-4567 or 555-123-4567", "at 2001:db8::8a2e:7334 and 2001:DB8::8A2E:7334 not 12:30:45 or std::vector",
        "ann@firm.example, bob@firm.example, eve@other.example", "Mr Kim Lee met Mrs Kim Lee and Dr Kim Lee", "Mr Smith and Mrs Smith",
        "token=" + "aB3_" * 3000, "Dr Xyq Abcde, Mr J.R.R. Tolkien, Frau Prof. Dr. Ludwiga van Beethoven",
    ]
    rows = make([(i, t) for i, t in enumerate(texts)])
    out = {r["doc_id"]: r["text"] for r in pii.replace_entities(rows, "k").collect()}
    one = re.fullmatch(r"Dr (\w+ \w+ \w+) and Mrs (\w+ \w+ \w+)", out[0])
    assert one[1] == one[2] and set(one[1].split()[:2]) <= set(pii.GIVEN["flatin"]) and out[1] == f"Prof. {one[1]} alone"
    john = re.fullmatch(r"Mr (\w+) ([A-Z])\. \w+, MR\. (\w+)", out[2])
    assert john is None or john[1] in pii.GIVEN["mlatin"]
    assert re.match(r"Mr [Α-Ωά-ώ]+ [Α-Ω][α-ω]+, Г-жа [А-Я][а-я]+ [А-Я][а-я]+, Dr [Ա-Ֆ][ա-ֆև]+ [Ա-Ֆ][ա-ֆև]+$", out[3]), out[3]
    assert re.search("Г-жа (\\w+)", out[3])[1] in pii.GIVEN["fcyrillic"] and re.search("Dr (\\w+)", out[3])[1] in pii.GIVEN["marmenian"]
    assert re.fullmatch(r"call \+49 3\d \d{7} or 03\d \d{7}", out[4]) and "1234567" not in out[4]
    far, bracketed, dashed = re.fullmatch(r"call \+(1 \d{3} \d{3} \d{4}) or (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", out[5]).groups()
    only = lambda t: re.sub(r"\D", "", t)
    assert only(far) == "1" + only(bracketed) == "1" + only(dashed) and only(far) != "15551234567"
    six = re.fullmatch(r"at ([0-9a-f:]+) and ([0-9A-F:]+) not 12:30:45 or std::vector", out[6])
    assert six and six[1].upper() == six[2] != "2001:DB8::8A2E:7334" and [len(g) for g in six[1].split(":")] == [4, 3, 0, 4, 4]
    mails = [m.split("@") for m in out[7].split(", ")]
    assert mails[0][1] == mails[1][1] != mails[2][1] and len({m[0] for m in mails}) == 3
    kim = re.fullmatch(r"Mr (\w+ \w+) met Mrs (\w+ \w+) and Dr (\w+ \w+)", out[8]).groups()
    assert kim[0] != kim[1] and kim[0].split()[0] in pii.GIVEN["mlatin"] and kim[1].split()[0] in pii.GIVEN["flatin"]
    smith = re.fullmatch(r"Mr (\w+) and Mrs (\w+)", out[9])
    assert smith[1] == smith[2] == one[1].split()[2]
    assert len(out[10]) == len(texts[10]) and "aB3_" not in out[10]
    last = re.fullmatch(r"Dr (\w+) \w+, Mr (\w\.){3} \w+, Frau Prof\. Dr\. (\w+) van \w+", out[11])
    assert last and last[1] in pii.GIVEN["ulatin"] and last[3] in pii.GIVEN["flatin"], out[11]


def test_stand_ins_are_distinct(make):
    names = make([(f"{g} {s}",) for g in ("anna", "berta", "cora", "dora") for s in [f"n{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100)]], "normal string")
    entities = names.select(F.lit("person").alias("kind"), "normal", F.lit("flatin").alias("traits"))
    cores = pii.assign(entities, "k")
    assert cores.count() == cores.select("core").distinct().count() == 400


def test_tokens_equal_the_library(make):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    rnd = random.Random(3)
    letters = "ab \n\t\x1c\x1f\x85\xa0é'sñ1٣²!€😀　﻿\x00ſ"
    texts = ["", " a", "a  b\n\n c", "x" * 3000, "ab" * 2000, "<|endoftext|>", "a<|endoftext|> b", "don't 'S 'll", None, "日本語" * 60]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    rows = make([(i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in bpe.encode_documents(rows, vocabulary_path(), keep_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        back = library.decode(ids, skip_special_tokens=False)
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(make, seed):
    rows = documents(seed)
    want = components_of({r[0]: r[1] for r in rows})
    got = neardup.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
    assert sum(1 for k, v in want.items() if v[1] != k) > 10


def test_near_duplicates_around_one_text(make):
    """Many different copies near the limit: most pairs are linked only through others."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(200)] = f"n{rnd.randrange(40)}"
        rows.append((i, " ".join(words)))
    rnd.shuffle(rows)
    want = components_of(dict(rows))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(make(rows)).collect()} == want
    assert len({v[1] for v in want.values()}) > 2


def test_sketches_fill_and_agree():
    a, b = np.arange(1, 401, dtype=np.uint64), np.arange(101, 501, dtype=np.uint64)
    x, y = neardup.sketch(neardup.mix(a), 640), neardup.sketch(neardup.mix(b), 640)
    assert x.max() < np.iinfo(np.uint64).max and abs((x == y).mean() - 0.6) < 0.08
    assert neardup.sketch(np.array([7], np.uint64)).max() < np.iinfo(np.uint64).max


def test_exact_copies_equal_brute_force(make):
    rows = documents(4)
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    got = exact.exact_dedup(make(rows)).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == Counter(
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids
    )


def test_chunks_join_to_the_text(make):
    rows = make([(r[0], r[1]) for r in documents(5) if r[1]])
    joined = rows.select("text", exact.chunks(F.col("text"), 40, 200).alias("c"))
    assert joined.filter(F.array_join("c", "") != F.col("text")).count() == 0 and joined.filter(F.size("c") > 5).count() > 0


@pytest.mark.parametrize("seed", [1, 7])
def test_repeats_equal_brute_force(make, seed):
    rows = documents(seed)
    rnd = random.Random(seed)
    parts = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(60, 300))) for _ in range(9)]
    rows += [(2000 + i, "".join(rnd.choice(parts + ["".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 90)))] * 6) for _ in range(6))) for i in range(80)]
    rows += [(3000, "a" * 400), (3001, "a" * 99), (3002, "a" * 100), (3003, ("0123456789" * 7) * 9), (3004, "é" * 120)]
    want = without_repeats({r[0]: r[1] for r in rows})
    for r in repeats.remove_repeats(make(rows)).collect():
        assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]


def test_mixture(make):
    rows = documents(6)
    docs = make(rows)
    got = mixing.mix_sources(docs).toPandas()
    words = {r[0]: len(WORDS.findall(r[1] or "")) for r in rows}
    assert len(got) == len(rows) and all(words[r.doc_id] == r.size for r in got.itertuples())
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    sizes = {s if s is None else str(s): 0 for s in {r[3] for r in rows}}
    for r in rows:
        sizes[r[3]] += words[r[0]]
    order = sorted(k for k in sizes if k is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    target |= {s: weight[s] * level for s in free}
    for source, own in got.groupby(got.source.fillna("?")):
        name = None if source == "?" else source
        assert abs(own.target.iloc[0] - target[name]) < 1e-6
        assert abs(own.taken.sum() - target[name]) <= mixing.BLOCK_WORDS * 2
    again = mixing.mix_sources(docs.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, got[key].values)) == sorted(map(tuple, again[key].values))


def test_top_k_equals_brute_force(make):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(0, 1, 24)]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(40)] + [(500, None), (501, [1.0, None]), (502, [float("nan")] * 24), (503, []), (504, [1.0, 2.0]), (550, [float("inf")] * 24), (600, [0.5, 1.0])]
    vectors = make(rows, "vec_id bigint, embedding array<float>, score int")
    good = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all()}
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    want = []
    for q in sorted(k for k in good if k % 50 == 0):
        scored = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert got == want


def test_top_k_prunes_clusters(make, monkeypatch):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(0, 1, (40, 64))
    rows = [(i, [float(x) for x in centres[i % 40] + rnd.normal(0, 0.1, 64)]) for i in range(2000)]
    vectors = make(rows, "vec_id bigint, embedding array<double>")
    asked = vectors.filter("vec_id % 50 = 0")
    by_level = {r["segments"]: r for r in topk.pruning(vectors, asked).collect()}
    assert sorted(by_level) == [4, 8, 16, 32] and by_level[4]["met"] == 40 * 1999
    assert all(by_level[s]["left"] == by_level[2 * s]["met"] for s in (4, 8, 16))
    assert by_level[32]["left"] < 0.2 * by_level[4]["met"]
    # small blocks, so that thresholds are carried on, and many passes
    want = topk.top_k(vectors, asked).orderBy("query_id", "rank").collect()
    for name, value in {"QUERY_BLOCK": 8, "VECTOR_BLOCK": 50, "PASS_BYTES": 10_000}.items():
        monkeypatch.setattr(topk, name, value)
    again = topk.top_k(vectors, asked)
    assert again.orderBy("query_id", "rank").collect() == want
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows}
    for q in (0, 50, 1950):
        scored = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert [(r["vec_id"], -r["score"]) for r in want if r["query_id"] == q] == [(i, s) for s, i in scored]


def test_quality_on_held_out_texts(workers, make):
    docs = workers.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = workers.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    odd = quality.score_quality(make([(1, None), (2, ""), (3, "x " * 100_000), (3, "x")]), model).collect()
    assert len(odd) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in odd)


def test_main_text(make):
    def story(i):
        return (
            f"<html><head><title>t{i}</title></head><body><div id=top>Site</div><header>Head</header><div class='wrap'><div class=story><h2>Story {i}</h2>"
            f"<p>Word{i} number {i * 7} of text &amp; more <b>bo</b>ld.<p>Second {'x' * i} part</div><div class=comments>bad {i}</div><div class='box'>Subscribe</div></div><footer>f{i}</footer>"
        )

    rows = [(i, f"http://h.example/{i}", story(i)) for i in range(8)]
    rows += [(99, None, None), (98, "http://h.example/z", ""), (97, "odd", "<p>lone &lt;text&gt;<script>x<1</script>"), (96, "odd", "<div>" * 3000 + "deep"), (95, "odd", "a < b <")]
    rows.append(rows[2])
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.main_text(make(rows, "page_id bigint, url string, html string, host string, wrapper string")).collect()}
    for i in range(8):
        assert got[i][0] == f"Story {i} Word{i} number {i * 7} of text & more bold. Second {'x' * i + ' ' if i else ''}part"
    assert got[99] == got[98] == ("", 0) and got[97] == ("lone <text>", 11) and got[96][0] == "deep" and got[95][0] == "a < b <"


def test_main_text_of_articles(workers):
    table = workers.read.parquet(f"{SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in pages.main_text(table).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article[1])).split())


def test_simple_tree_matching():
    a, b = pages.parse("<div><p>x</p><p>y</p><ul><li>1</ul></div>"), pages.parse("<div><p>z</p><ul><li>2<li>3</ul></div>")
    pairs = []
    assert pages.match(a, b, pairs) == 5 == len(pairs)


def texts_of(sources):
    """Main texts of the pages of one host, as main_text goes about it, without Spark."""
    pivot = pages.json.dumps(pages.skeleton(pages.parse(sources[0])))
    sums = defaultdict(lambda: [0, 0, 0])
    for source in sources:
        for mark, *seen in pages.observed(pivot, source):
            sums[mark] = [a + b for a, b in zip(sums[mark], [1, *seen])]
    wrapper = pages.wrapper_of(pivot, [(m, *v) for m, v in sorted(sums.items())])
    return [pages.extract(s, wrapper) for s in sources]


def test_labels_do_not_drop_the_content():
    for begin, end in [("<div class='content with-sidebar'>", "</div>"), ("<div class='widget-area'>", "</div>"), ("<div class=widget>", "</div>"), ("<form id=aspnetForm>", "</form>")]:
        story = lambda i: f"<h2 id=related-work>Work {i}</h2><h3 id=search>Search</h3><p id=ad-hoc-networks>Ad {i}</p><div class=related>no</div>"  # noqa: E731,B023
        for open_, close in (("<article>", "</article>"), ("<div><div>", "</div></div>")):
            made = [f"<body><ul class=menu><li>Home</ul>{begin}{open_}{story(i)}{close}{end}" for i in range(6)]
            alone = f"<body><div class=menu>Home</div>{begin}{open_}{story(0)}{close}{end}"
            assert pages.extract(alone, None) == "Work 0 Search Ad 0", (begin, open_)
            assert [t.replace("Search ", "") for t in texts_of(made)] == [f"Work {i} Ad {i}" for i in range(6)], (begin, open_)
    # labels still decide where declared content is elsewhere
    assert pages.extract("<body><article>yes</article><div class=related><article>no</article></div>", None) == "yes"


def test_leaves_are_compared_to_their_end():
    lead = "The same standing words open every page. " * 10
    made = [f"<body><ul><li>Home</ul><div><pre>{lead}Then story {i}</pre><div>Terms</div></div>" for i in range(6)]
    assert texts_of(made) == [f"{lead}Then story {i}" for i in range(6)]


def test_wrapper_decides_inside_declared_content():
    made = [f"<body><main><h1>Story {i}</h1><article><div>Get our paper</div><p>First {i}</p></article><article><p>Second part {i}</p></article><p>Beside {i}</p><div>Terms</div></main>" for i in range(6)]
    assert texts_of(made) == [f"Story {i} First {i} Second part {i} Beside {i}" for i in range(6)]
    assert pages.extract("<body><article>one</article><p>between</p><article>two, longer</article>", None) == "one two, longer"
    # a small declared part beside or within the slot does not replace it
    made = [f"<body><div><div><p>Long story number {i} with many words</p><p>And more {i}</p></div><article>Box {i}</article></div>" for i in range(6)]
    assert texts_of(made) == [f"Long story number {i} with many words And more {i} Box {i}" for i in range(6)]
    assert texts_of(["<body><div>" + f"x{i}</div><article><p>Same</p></article>" for i in range(6)]) == ["Same"] * 6


def test_flat_pages_are_aligned_to_the_end():
    made = []
    for i in range(6):
        words = "".join(f"<br><p>Word {i} {k}</p><hr>" for k in range(70 + 5 * i))
        more = "".join(f"<h3>Head {i} {k}</h3><p>Text {i} {k}</p>" for k in range(40))
        made.append(f"<body><p>Top</p>{words}<p>Get our paper</p>{more}<div><div><p>Late {i}</p><b>{i}</b></div></div><p>Terms</p>")
    for i, text in enumerate(texts_of(made)):
        assert text.startswith(f"Word {i} 0 ") and text.endswith(f"Text {i} 39 Late {i} {i}") and "paper" not in text
        assert text.count("Word") == 70 + 5 * i
    slot_behind = ["<body>" + "<ul><li>Home</ul><table><td>x</table>" * 40 + f"<div><div><p>Story {i}</p><p>Part {i}</p></div></div>" for i in range(6)]
    assert texts_of(slot_behind) == [f"Story {i} Part {i}" for i in range(6)]


def test_every_layout_has_its_wrapper(make):
    one = lambda i: f"<body><div class=top>Menu</div><div class=box><p>First story {i}</p><p>more {i}</p></div><div class=low>Terms</div>"
    two = lambda i: f"<body><table class=bar><td>Other menu</table><section class=post><h2>Second {i}</h2><p>text {i}</p></section><section class=end>Imprint</section>"
    rows = [(0, "http://h.example/", "<body><p>Page not found</p>")] + [(i, f"http://h.example/{i}", (one if i % 2 else two)(i)) for i in range(1, 13)]
    got = {r["page_id"]: r["text"] for r in pages.main_text(make(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {0: "Page not found"} | {i: f"First story {i} more {i}" if i % 2 else f"Second {i} text {i}" for i in range(1, 13)}


def test_stand_ins_do_not_run_out(make, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {"latin": ["ba"], "cyrillic": ["ба"]})
    names = make([(f"n{i}",) for i in range(10)] + [(f"anna n{i}",) for i in range(10, 15)], "normal string")
    entities = names.select(F.lit("person").alias("kind"), "normal", F.lit("flatin").alias("traits"))
    cores = pii.assign(entities, "k").collect()
    assert len(cores) == len({r["core"] for r in cores}) == 15 and all(r["core"].count(" ") == r["normal"].count(" ") for r in cores)


def test_whole_names_and_their_mentions(make):
    names = ["Mrs Mary Anne Smith", "Mr John Q. Public", "Mr. Smith-Jones", "Dr. McDonald", "Mr. O'Brien", "Herr Dr. Karl von Moor", "Mr J.R. Ewing", "Prof. D’Arcy"]
    rows = [(i, f"We met {n}. Then {n.split('. ' if '.' in n[:5] else ' ', 1)[1]} left, with {n.split()[-1]}'s dog.") for i, n in enumerate(names)]
    rows += [(20, "Mr John Smith and Mrs Anna Smith; John Smith saw Anna and a Smithy. John is not Johnny."), (21, "John Smith alone")]
    got = {r["doc_id"]: r for r in pii.replace_entities(make(rows), "k").collect()}
    for i, n in enumerate(names):
        text = got[i]["text"]
        for part in re.findall(r"[^\W\d_]{2,}", re.sub(r"^((Mrs|Mr|Dr|Prof|Herr)\.? )+", "", n)):
            assert part not in text or part == "von", (n, text)
        surname = re.match(r"We met (?:(?:Mrs|Mr|Dr|Prof|Herr)\.? )+(?:[\w.]+ )*(\w+)\. Then", text)[1]
        assert text.endswith(f"{surname} left, with {surname}'s dog."), text
    text = got[20]["text"]
    given, family = re.match(r"Mr (\w+) (\w+) and Mrs", text).groups()
    assert f"; {given} {family} saw " in text and text.endswith(f" and a Smithy. {given} is not Johnny.") and "Anna" not in text
    assert got[20]["n_entities"] == 5 and got[21]["text"] == "John Smith alone"


def test_word_vectors_cover_all_documents(make):
    docs = make([(i, "common words here") for i in range(40)] + [(100 + i, "rare tongue speaks") for i in range(4)])
    labels = make([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    vectors = quality.train(docs, labels).vectors
    assert {"common", "words", "here", "rare", "tongue", "speaks"} <= set(vectors.vocabulary.to_pylist())
    own = lambda t: quality.index_rows([t])[0]
    want = sum(own(t) for t in ("tongue", "speaks")) + 2 * own("~a")
    assert np.allclose(vectors.matrix[vectors.vocabulary.to_pylist().index("rare")], want / np.linalg.norm(want) + own("rare") / 2, atol=1e-5)
    one, two = vectors.features(pa.array(["unmet", "unseen"]))
    assert not np.allclose(one[: quality.SIZE], two[: quality.SIZE])


def test_vectors_and_features_equal_a_loop(make, monkeypatch):
    """Counts, context sums and pooled rows word by word; pieces are small, so that texts reach over several."""
    for name in ("PLACES_AT_ONCE", "PAIRS_AT_ONCE"):
        monkeypatch.setattr(quality, name, 7)
    texts = [r[1] or "" for r in documents(n=30)][:34] + ["One Two, three. 4x5 --- Öl ÖL", " lead and trail \u00a0 "]
    column = pa.array(texts)
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    counted = Counter()
    for made in quality.count_words([batch]):
        counted.update(dict(zip(made["token"].to_pylist(), made["docs"].to_pylist())))
    want = Counter(form for t in texts for form in {w.lower() for w in t.split()} | {quality.shape(w) for w in t.split()})
    assert counted == want

    table = sorted(want, key=lambda w: (-want[w], w))[:40]
    known = quality.Vectors(pa.array(table), np.zeros((42, quality.SIZE), np.float32))
    total = np.zeros((quality.SIZE, 43), np.int64)
    quality.add_contexts(total, column, known)
    own = {form: quality.index_rows([form])[0] for form in want}
    sums = np.zeros((42, quality.SIZE))
    row = {form: i for i, form in enumerate(table)}
    for t in texts:
        words = t.split()
        for i, w in enumerate(words):
            around = sum((own[x.lower()] + own[quality.shape(x)] for x in words[max(0, i - 2) : i] + words[i + 1 : i + 3]), np.zeros(quality.SIZE))
            sums[row.get(w.lower(), 40)] += around
            sums[row.get(quality.shape(w), 41)] += around
    assert np.array_equal(total[:, :42].T, sums)

    known.matrix[:40] = sums[:40]
    got = known.features(column)
    for t, line in zip(texts, got):
        words = t.split()
        if not words:
            assert not line.any()
            continue
        parts = [[known.matrix[row[f]] if f in row else own[f] / 2 for f in forms] for forms in ([w.lower() for w in words], [quality.shape(w) for w in words])]
        lines, n = t.split("\n"), len(words)
        tail = [np.log1p(n), len(set(words)) / n, len(t) / n, max(Counter(words).values()) / n, len(set(lines)) / len(lines), sum(w.lower() not in row for w in words) / n]
        assert np.allclose(line, np.concatenate([*(np.mean(p, axis=0) for p in parts), tail]), rtol=1e-4, atol=1e-4)


def test_first_rows_come_in_order_from_any_number_of_parts(make):
    docs = make([(i, str(i * 7919 % 1000)) for i in range(1000)]).repartition(13)
    for k in (0, 1, 5, 400, 1000, 2000):
        assert [r["doc_id"] for r in quality.first_rows(docs.select("doc_id"), k, F.desc("doc_id"))] == list(range(999, 999 - min(k, 1000), -1))
    assert quality.first_rows(docs.limit(0), 5, F.asc("doc_id")) == []


BOILERPLATE_CLASSES = (
    "comments-area", "reader-comments", "user-comments", "comment-list", "comment-thread", "ad-slot", "ad-container", "google-ad",
    "advert-box", "adsbygoogle", "cookie-notice-bar",
)


def test_one_word_of_a_compound_class_names_boilerplate():
    for name in BOILERPLATE_CLASSES:
        own = f"<div class='{name}'><p>Somebody says something else here.</p></div>"
        assert pages.extract(f"<body><article><p>The text of it.</p>{own}</article></body>", None) == "The text of it.", name
        sources = [f"<body><div class=top>Host</div><div class=post><p>{'story ' * 30}{i}</p>{own.replace('here', str(i))}</div><div class=end>Imprint</div></body>" for i in range(8)]
        root = pages.parse(sources[0])
        pivot = pages.json.dumps(pages.skeleton(root))
        stats = defaultdict(lambda: [0, 0, 0])
        for s in sources:
            for mark, same, length in pages.observed(pivot, s):
                stats[mark] = [a + b for a, b in zip(stats[mark], (1, same, length))]
        wrapper = pages.wrapper_of(pivot, [(m, *v) for m, v in sorted(stats.items())])
        assert pages.extract(sources[3], wrapper) == "story " * 30 + "3", name


def test_a_labelled_node_with_the_content_stays():
    for name in ("content with-sidebar", "no-comments", "ad-free", "comments-area", "related-work"):
        assert pages.extract(f"<body><div class='{name}'><article><p>The text of it.</p></article></div></body>", None) == "The text of it.", name
    assert pages.extract("<body><div id=main><div class=ad-free>First part.</div><p id=comments>Second part.</p></div></body>", None) == "First part. Second part."


def test_every_labelled_language_is_learned(spark):
    """Forty languages of one document each beside a large one: none is lost to the calibration."""
    letters = [chr(0x4E00 + 50 * i) + chr(0x4E01 + 50 * i) for i in range(40)]
    small = spark.createDataFrame([(10_000 + i, " ".join([w] * 30), f"x{i}") for i, w in enumerate(letters)], "doc_id long, text string, lang string")
    large = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    models = langid.train(large.unionByName(small), learn_from=F.lit(True))
    assert {f"x{i}" for i in range(40)} <= set(models.languages)
    found = langid.identify(small, models).join(small.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)
    alone = langid.train(small, learn_from=F.lit(True))
    assert len(alone.languages) == 40 and langid.identify(small, alone).filter("lang_pred LIKE 'x%'").count() == 40


def test_pages_of_any_depth():
    for depth in (10, 149, 400, 60_000):
        deep = "<div>" * depth + "<nav>One</nav>text<p>Menu?</p><footer>Imprint</footer><div class=comments>bad</div><aside>Advert</aside>" + "</div>" * depth + "<p>after</p>"
        assert pages.extract(f"<body>{deep}</body>", None) == "text Menu? after", depth
        assert pages.extract(f"<body><article>{deep}</article></body>", None) == "text Menu? after", depth
    # a template below the depth that is aligned: the host's pages still give their own text
    sources = ["<body><div>Site</div>" + "<div>" * 200 + f"<p>Story {i} of its own</p>" + "</div>" * 200 + "</body>" for i in range(6)]
    pivot = pages.json.dumps(pages.skeleton(pages.parse(sources[0])))
    sums = {}
    for source in sources:
        for mark, same, length in pages.observed(pivot, source):
            total = sums.setdefault(mark, [0, 0, 0])
            total[0], total[1], total[2] = total[0] + 1, total[1] + same, total[2] + length
    wrapper = pages.wrapper_of(pivot, [(m, *v) for m, v in sorted(sums.items())])
    assert [pages.extract(x, wrapper) for x in sources] == [f"Story {i} of its own" for i in range(6)]
    # end tags without a begin, deep in open elements
    assert pages.extract("<div>" * 20_000 + "x</p></b></li>" * 20_000, None) == "x" * 20_000


def test_index_vectors_as_small_numbers_and_scaled():
    tokens = [f"w{i}" for i in range(500)]
    whole = quality.index_rows(tokens)
    small = quality.index_rows(tokens, np.int8)
    assert small.dtype == np.int8 and (small == whole).all() and np.abs(small).max() <= quality.NONZERO
    assert (quality.index_rows(tokens, size=0.5) == whole / 2).all()
    assert 2 * quality.REACH * 2 * quality.NONZERO < 128  # what is added up for one place
