"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Every detected entity gets a stand-in of its own type: a card number of the same
length, network and check digit, a person's name of the same gender and script, a
number in the same layout.  The stand-in follows from a key and the entity's normal
form, so one entity has one stand-in everywhere.  The table of distinct entities is
checked: no two may share a stand-in, and none may be what another entity really is;
who clashes is drawn again.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.workspace import snapshot

STALLED = 24  # rounds in which a form of fixed length found no free stand-in at all
# titles, given names, syllables, small words of names, and the telephone codes of countries (fixed values)
MALE_TITLES = "Mr Mister Sir Lord Herr Herrn Monsieur Señor Sr Signor Господин Г-н Пан Κύριος Κος".split()
FEMALE_TITLES = "Mrs Ms Miss Madam Lady Dame Frau Madame Mme Mlle Señora Señorita Sra Srta Signora Госпожа Г-жа Пани Κυρία Κα".split()
OTHER_TITLES = "Dr Prof Professor Доктор Профессор Δρ".split()
# m, f: by gender; u: of either, or initials
GIVEN = {
    "mlatin": "Adam Bruno Carl Daniel Edgar Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul David Erik Frank Henry James John Jack Luis Mark Michael Peter Robert Simon Thomas Victor William".split(),
    "flatin": "Alice Berta Clara Diana Emma Flora Greta Helena Irene Julia Klara Laura Marta Nina Olga Paula Anna Barbara Carmen Elizabeth Eva Hannah Jane Katherine Linda Lucy Maria Mary Rosa Sarah Sophie Susan".split(),
    "ulatin": "Alex Casey Charlie Jamie Jordan Kim Morgan Noa Quinn Riley Robin Rowan Sam Sascha Skyler Taylor".split(),
    "mcyrillic": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
    "fcyrillic": "Анна Вера Галина Дарья Елена Жанна Ирина Ксения".split(),
    "ucyrillic": "Саша Женя Валя Слава".split(),
    "mgreek": "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σπύρος Χρήστος".split(),
    "fgreek": "Άννα Βασιλική Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    "ugreek": "Α. Γ. Δ. Ε. Κ. Μ. Ν. Σ.".split(),
    "marmenian": "Արամ Գագիկ Հայկ Տիգրան Վահան Կարեն Սուրեն Գևորգ".split(),
    "farmenian": "Անահիտ Գոհար Լուսինե Մարիամ Նարե Շուշան Սիրան Տաթև".split(),
    "uarmenian": "Ա. Գ. Հ. Կ. Մ. Ն. Ս. Տ.".split(),
}
SYLLABLES = {
    "latin": "ba den fol gar hin jor kel lom mar nev ost per rin sol tav wen".split(),
    "cyrillic": "ба ден фол гар хин жор кел лом мар нев ост пер рин сол тав вен".split(),
    "greek": "βα δεν φολ γαρ χιν ζορ κελ λομ μαρ νεφ οστ περ ριν σολ ταν βεν".split(),
    "armenian": "բա դեն ֆոլ գար հին ջոր կել լոմ մար նեվ օստ պեր րին սոլ տավ վեն".split(),
}
COUNTRY_CODE = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_title = "|".join(sorted({*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES}, key=len, reverse=True))
# one or more titles; then words with inner capitals, hyphens or apostrophes (no genitive), initials, and small words between them
HEAD = rf"(?:(?:{_title})\.? )+"
_word = r"(?:(?:\p{Lu}\.-?)+(?=[ \p{Lu}])|\p{Lu}(?:[\p{L}\p{M}]|-(?=\p{L})|['’](?!s(?!\p{L}))(?=\p{L}))*)"
_small = r"(?:van|von|vom|zu|de|der|den|del|della|di|da|do|dos|du|la|le|bin|ibn|al|el|ter|af|av)"
NAME = rf"(?:{_small} ){{0,3}}{_word}(?: ?(?: {_small}){{0,3}} {_word}|(?<=\.){_word})*"
_hex = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63})+",
    "secret": r"(?i:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+-]{16,}|\b[0-9a-fA-F]{32,}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?![\d]|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]*\d)(?:(?:{_hex}:){{7}}{_hex}|(?:{_hex}:){{1,6}}(?::{_hex}){{1,6}})(?![\w:])",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "phone": r"(?<!\d)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?(?:\d{2,4}[ .-]?){1,4}\d{2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|(?<![.,-])0\d{1,4}[ /-](?:\d{5,9}|\d{3,4}(?:[ -]\d{2,4}){1,2}))(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "person": rf"(?<!\p{{L}}){HEAD}{NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# whatever holds none of these holds no entity
HINT = rf"\d|@|(?i:token|secret|passw|api[_-]?key)|[0-9a-fA-F]{{32}}|(?:{_title})\.? \p{{L}}"
NATIONAL = r"^(?:\(\d{3}\) ?|[1-9]\d{2}[.-])\d{3}[ .-]\d{4}$"
VALUE = r"[A-Za-z0-9_/+-]{16,}$"


def _digest(key: str, *parts: Column) -> Column:
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


def _number(digest: Column, start: int, below: int | Column) -> Column:
    return (F.conv(F.substring(digest, start, 8), 16, 10).cast("long") % below).cast("int")


def _listed(table: dict[str, list[str]], which: Column) -> Column:
    """The list that a table of fixed words has under a name."""
    return F.element_at(F.create_map(*[c for name, words in table.items() for c in (F.lit(name), F.array(*map(F.lit, words)))]), which)


def _pick(digest: Column, words: Column, never: Column | None = None) -> Column:
    """One of the words; the next one where it would be ``never``."""
    at = _number(digest, 1, F.size(words))
    word = F.element_at(words, at + 1)
    return word if never is None else F.when(F.lower(word) == never, F.element_at(words, (at + 1) % F.size(words) + 1)).otherwise(word)


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10, over an array of digits with the check digit last."""
    pairs = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(pairs, F.lit(0), lambda a, d: a + d) % 10


def _digits_of(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: c.cast("int"))


def _iban_rest(country_and_body: Column) -> Column:
    """98 - remainder of the code with check digits 00, two places."""
    moved = F.concat(F.substr(country_and_body, F.lit(5)), F.substring(country_and_body, 1, 2), F.lit("00"))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def classified(found: DataFrame) -> DataFrame:
    """Adds type, normal form and traits to a column ``entity``; the first pattern that fits decides, as when matching."""
    e = F.col("entity")
    kind = reduce(lambda rest, k: F.when(e.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(rest), reversed(PATTERNS), F.lit("person"))
    titles = F.split(F.replace(F.regexp_extract(e, f"^{HEAD}", 0), F.lit("."), F.lit("")), " ")
    has = lambda some: F.arrays_overlap(titles, F.array(*map(F.lit, some)))
    name = F.regexp_replace(e, rf"^{HEAD}", "")
    several = F.size(F.split(name, " ")) > 1
    # a lone surname is the same for all who bear it
    gender = F.when(~several, "u").when(has(FEMALE_TITLES), "f").when(has(MALE_TITLES), "m").otherwise("?")
    script = reduce(lambda rest, s: F.when(name.rlike(rf"\p{{Is{s}}}"), s.lower()).otherwise(rest), ("Armenian", "Greek", "Cyrillic"), F.lit("latin"))
    bare = F.regexp_replace(e, r"\D", "")
    normal = (
        F.when(F.col("kind") == "email", F.lower(e))
        .when(F.col("kind") == "secret", F.regexp_extract(e, VALUE, 0))
        .when(F.col("kind") == "iban", F.regexp_replace(e, " ", ""))
        .when(F.col("kind") == "ip", e)
        .when(F.col("kind") == "ip6", F.lower(e))
        .when(F.col("kind") == "person", F.lower(name))
        # three, three and four digits are the national form of a number with the code 1
        .when((F.col("kind") == "phone") & e.rlike(NATIONAL), F.concat(F.lit("1"), bare))
        .otherwise(bare)
    )
    traits = F.when(F.col("kind") == "person", F.concat(gender, script)).when((F.col("kind") == "phone") & normal.rlike("^[1-9]"), F.lit("code"))
    return found.withColumn("kind", kind).withColumn("normal", normal).withColumn("traits", F.coalesce(traits, F.lit("")))


def with_gender(met: DataFrame) -> DataFrame:
    """Persons whose titles leave their gender open take that of the same name: in the document, else anywhere, else the given name's.

    Where a name is borne by both, or by none of known gender and with an unlisted given name, it stays of either ("u").
    """
    open_ = (F.col("kind") == "person") & F.col("traits").startswith("?")
    known = met.filter((F.col("kind") == "person") & F.col("traits").rlike("^[mf]")).select("doc_id", "normal", F.substring("traits", 1, 1).alias("g"))
    sure = F.when(F.min("g") == F.max("g"), F.min("g")).otherwise("u")
    here = known.groupBy(F.col("doc_id").alias("_d"), F.col("normal").alias("_n")).agg(sure.alias("here"))
    anywhere = known.groupBy(F.col("normal").alias("_m")).agg(sure.alias("anywhere"))
    first = F.element_at(F.split("normal", " "), 1)
    listed = lambda g: first.isin([w.lower() for k, words in GIVEN.items() if k[0] == g for w in words])
    given = F.when(listed("f"), "f").when(listed("m"), "m").otherwise("u")
    asked = met.filter(open_).join(here, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("normal") == F.col("_n")), "left")
    asked = asked.join(anywhere, F.col("normal") == F.col("_m"), "left")
    gender = F.coalesce("here", "anywhere", given)
    settled = asked.withColumn("traits", F.concat(gender, F.substr("traits", F.lit(2)))).select(*met.columns)
    return met.filter(~open_).unionByName(settled)


def _filled(layout: Column, source: Column) -> Column:
    """The layout with its digits and letters replaced, in order, by the characters of ``source``."""
    start = F.struct(F.lit("").alias("made"), F.lit(1).alias("at"))
    def step(a, c):
        fits = c.rlike("[0-9A-Za-z]")
        return F.struct(F.concat(a["made"], F.when(fits, F.substr(source, a["at"], F.lit(1))).otherwise(c)).alias("made"), (a["at"] + F.when(fits, 1).otherwise(0)).alias("at"))
    return F.aggregate(F.split(layout, ""), start, step, lambda a: a["made"])


def stand_in(key: str, draw: int) -> Column:
    """The stand-in's normal form, from ``kind, normal, traits``."""
    kind, normal = F.col("kind"), F.col("normal")
    d = _digest(key, kind, normal, F.lit(str(draw)))
    long_hex = F.concat(d, *[_digest(key, kind, normal, F.lit(f"{draw}-{i}")) for i in (1, 2, 3)])
    digits = F.translate(long_hex, "abcdef", "240579")
    rest = F.concat(F.substring(normal, 1, 1), F.substr(digits, F.lit(1), F.length(normal) - 1))
    body = F.substr(rest, F.lit(1), F.length(rest) - 1)
    check = (10 - _luhn(_digits_of(F.concat(body, F.lit("0"))))) % 10
    valid = _luhn(_digits_of(normal)) == 0
    card = F.when(valid, F.concat(body, check.cast("string"))).otherwise(rest)
    letters = F.translate(long_hex, "0123456789abcdef", "GHIJKLMNOPQRSTUV")
    iban_body = F.array_join(
        F.transform(F.split(normal, ""), lambda c, i: F.when(i < 2, c).when(i < 4, F.lit("0")).when(c.rlike(r"\d"), F.substr(digits, i + 1, F.lit(1))).otherwise(F.substr(letters, i + 1, F.lit(1)))), ""
    )
    iban = F.concat(F.substring(iban_body, 1, 2), _iban_rest(iban_body), F.substr(iban_body, F.lit(5)))
    ip = F.concat_ws(".", (_number(d, 1, 222) + 1).cast("string"), *[_number(d, s, 256).cast("string") for s in (9, 17)], (_number(d, 25, 254) + 1).cast("string"))
    letters_of = lambda digest, n: F.translate(F.substring(digest, 1, n), "0123456789", "ghijklmnop")
    # who shares a domain still does
    domain = letters_of(_digest(key, F.lit("domain"), F.substring_index(normal, "@", -1)), 16)
    email = F.concat(letters_of(d, 12), F.lit("@"), domain, F.lit(".example.net"))
    long_text = F.repeat(long_hex, (F.length(normal) / 256 + 1).cast("int"))
    code = F.regexp_extract(normal, f"^({COUNTRY_CODE})", 1)
    phone = F.when(F.col("traits") == "code", F.concat(code, F.substr(normal, F.length(code) + 1, F.lit(1)), F.substr(digits, F.lit(1), F.length(normal) - F.length(code) - 1))).otherwise(
        F.concat(F.substring(normal, 1, 2), F.substr(digits, F.lit(1), F.length(normal) - 2))
    )
    ip6 = _filled(normal, F.translate(long_hex, "0", "c"))
    secret = F.when(normal.rlike("^[0-9a-f]+$"), F.substr(long_text, F.lit(1), F.length(normal))).otherwise(
        F.substr(F.translate(long_text, "0123456789abcdef", "Ab3dEf7hJk2mNp9q"), F.lit(1), F.length(normal))
    )
    parts = F.split(normal, " ")
    # the surname follows from the surname alone, so that it is the same with and without a given name; every fourth
    # draw of a whole name and every draw of a lone surname is a new one, a syllable longer, so that there is no last one
    alone = F.size(parts) == 1
    turn = F.when(alone, F.lit(draw)).otherwise(F.lit(draw // 4))
    script = F.substr("traits", F.lit(2))
    pieces = F.transform(
        F.sequence(F.lit(1), 4 + turn), lambda i: _pick(_digest(key, F.lit("surname"), F.element_at(parts, -1), turn.cast("string"), i.cast("string")), _listed(SYLLABLES, script))
    )
    surname = F.initcap(F.array_join(pieces, ""))
    names = _listed(GIVEN, F.col("traits"))

    def given(word: Column) -> Column:
        """Another name for a given name, other initials for initials; small words stay."""
        drawn = lambda *more: _pick(_digest(key, F.lit("given"), word, F.lit(str(draw)), *more), names, word)
        initials = F.transform(F.filter(F.split(word, r"\.-?"), lambda c: c != ""), lambda c, i: F.concat(F.upper(F.substring(drawn(i.cast("string")), 1, 1)), F.lit(".")))
        return F.when(word.rlike(rf"^{_small}$"), word).when(word.rlike(r"^(\p{L}\.-?)+$"), F.array_join(initials, "")).otherwise(drawn())

    person = F.when(alone, surname).otherwise(F.concat_ws(" ", F.array_join(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), given), " "), surname))
    return (
        F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "iban", iban).when(kind == "ip", ip)
        .when(kind == "person", person).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ip6", ip6).otherwise(rest)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """One stand-in per entity, all different and none of them an entity's own form: ``kind, normal, traits, core``.

    Draws again for those that clash; each round is written, and only its emptiness is looked at.
    """
    # a person's form has capitals, their normal form none
    real = entities.select(F.col("kind").alias("_k"), F.col("normal").alias("_n")).distinct()
    pending, settled, stalled = entities, None, 0
    for draw in count():
        drawn = pending.withColumn("core", stand_in(key, draw)).join(real, (F.col("kind") == F.col("_k")) & (F.lower("core") == F.lower("_n")), "left")
        drawn = drawn.withColumn("_real", F.col("_n").isNotNull()).drop("_k", "_n")
        if settled is not None:
            used = settled.select(F.col("kind").alias("_k"), F.col("core").alias("_c"))
            drawn = drawn.join(used, (F.col("kind") == F.col("_k")) & (F.col("core") == F.col("_c")), "left").withColumn("_real", F.col("_real") | F.col("_c").isNotNull()).drop("_k", "_c")
        first = drawn.filter(~F.col("_real")).groupBy("kind", "core").agg(F.min(F.struct("normal", "traits")).alias("_w"))
        first = first.select("kind", F.col("_w.normal").alias("normal"), F.col("_w.traits").alias("traits"), "core")
        done = snapshot(first)
        settled = done if settled is None else snapshot(settled.union(done))
        pending = snapshot(pending.join(done.select("kind", "normal", "traits"), ["kind", "normal", "traits"], "left_anti"))
        if pending.isEmpty():
            return settled
        # persons' names grow with the draw; only numbers, whose length is kept, can run out
        stalled = stalled + 1 if done.isEmpty() else 0
        if stalled == STALLED:
            raise ValueError("more numbers of one form than that form has stand-ins")


def _mentions(persons: DataFrame) -> DataFrame:
    """How a document's persons are named again without a title: ``_of, _known, _again``, map and pattern per document.

    The whole name stands first, then the surname, then the given name, if that is no initial.
    """
    bare = lambda c: F.regexp_replace(c, rf"^{HEAD}", "")
    name, made = F.split(bare(F.col("entity")), " "), F.split(bare(F.col("made")), " ")
    whole = F.struct(F.lit(0).alias("rank"), F.array_join(name, " ").alias("said"), F.array_join(made, " ").alias("put"))
    last = F.struct(F.lit(1).alias("rank"), F.element_at(name, -1).alias("said"), F.element_at(made, -1).alias("put"))
    first = F.struct(F.lit(2).alias("rank"), F.element_at(name, 1).alias("said"), F.element_at(made, 1).alias("put"))
    ways = persons.select(F.col("doc_id").alias("_of"), F.explode(F.when(F.size(name) > 1, F.array(whole, last, first)).otherwise(F.array(whole))).alias("w"))
    ways = ways.filter(r"w.said RLIKE '^\\p{Lu}.*\\p{L}\\p{L}' OR w.rank = 0 AND length(w.said) > 1")
    one = ways.groupBy("_of", F.col("w.said").alias("said")).agg(F.min(F.struct("w.rank", "w.put")).alias("w"))
    # the longest first, so that a name is not taken for its first word
    listed = F.sort_array(F.collect_list(F.struct((-F.length("said")).alias("n"), "said")))
    pattern = F.array_join(F.transform(listed, lambda x: F.replace(x["said"], F.lit("."), F.lit("\\."))), "|")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), pattern, F.lit(r")(?![\p{L}\p{N}])"))
    return one.groupBy("_of").agg(F.map_from_entries(F.collect_list(F.struct("said", "w.put"))).alias("_known"), pattern.alias("_again"))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text with its personal data replaced: ``doc_id, text, n_entities``.

    Types: e-mail and IP addresses of both versions, phone, card, social security and account numbers, secrets, and persons behind a
    title, with whatever names them again in the same document.  Equal entities get equal stand-ins in all documents, different ones different stand-ins.  Text without an
    entity stays as it is; null stays null with 0 entities.  Rows repeated with one id are all kept.  An empty table gives
    an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    marked = rows.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    hit = snapshot(marked.filter(F.size("_found") > 0))
    clean = marked.filter(F.size("_found") == 0).select("doc_id", "text", F.lit(0).alias("n_entities"))
    met = classified(hit.select("doc_id", F.explode(F.array_distinct("_found")).alias("entity")).distinct())
    met = with_gender(snapshot(met))
    met = snapshot(met)
    cores = assign(snapshot(met.select("kind", "normal", "traits").distinct()), key)
    e, core = F.col("entity"), F.col("core")
    head = F.regexp_extract(e, rf"^({HEAD})", 1)
    shouted = (e == F.upper(e)) & (e != F.lower(e))
    name = F.substr(e, F.length(head) + 1)
    cased = F.when((name == F.upper(name)) & (F.length(name) > 2), F.upper(core)).otherwise(core)
    made = (
        F.when(F.col("kind") == "person", F.concat(head, cased))
        .when(F.col("kind") == "ip6", F.when(shouted, F.upper(core)).otherwise(core))
        # the national form leaves the code out
        .when((F.col("kind") == "phone") & e.rlike(NATIONAL), _filled(e, F.substr(core, F.lit(2))))
        .when(F.col("kind") == "secret", F.concat(F.regexp_replace(e, VALUE, ""), core))
        .when(F.col("kind").isin("ip", "email"), core)
        .otherwise(_filled(e, core))
    )
    named = met.join(cores, ["kind", "normal", "traits"]).select("doc_id", "entity", made.alias("made"))
    # one map per document; a row without id is matched like any other
    maps = named.groupBy(F.col("doc_id").alias("_id")).agg(F.map_from_entries(F.collect_set(F.struct("entity", "made"))).alias("_map"))
    joined = hit.join(maps, F.col("doc_id").eqNullSafe(F.col("_id")))
    known = _mentions(named.filter(F.col("entity").rlike(f"^{HEAD}")))
    joined = joined.join(known, F.col("doc_id").eqNullSafe(F.col("_of")), "left")
    again = F.col("_again")

    def gap_of(gap: Column) -> Column:
        """What is between two entities, with the document's names in it replaced."""
        met = F.regexp_extract_all(gap, again, F.lit(0))
        put = F.zip_with(F.split(gap, again, -1), met, lambda g, m: F.concat(g, F.coalesce(F.element_at("_known", m), F.lit(""))))
        return F.when(again.isNull(), gap).otherwise(F.array_join(put, ""))

    gaps = F.split("text", ANY, -1)
    text = F.array_join(
        F.transform(gaps, lambda g, i: F.concat(gap_of(g), F.when(i < F.size("_found"), F.element_at("_map", F.get("_found", i))).otherwise(F.lit("")))), ""
    )
    more = F.when(again.isNull(), 0).otherwise(F.aggregate(gaps, F.lit(0), lambda n, g: n + F.regexp_count(g, again)))
    changed = joined.select("doc_id", text.alias("text"), (F.size("_found") + more).cast("int").alias("n_entities"))
    return clean.unionByName(changed)
