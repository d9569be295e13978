"""Surrogate generation for personal data.

One regular expression finds e-mail and IPv4 addresses, phone, card and account numbers, secrets in hexadecimal
and names after a form of address. Each entity gets a keyed replacement of its own kind: letters keep their case
and script, digits stay digits, punctuation and grouping stay as written, card numbers keep their check sum
modulo 10. Spellings of one entity (grouping of digits, case of an address) share one surrogate, in all documents.

A name is up to four parts with initials and particles between; a part may have inner capitals, hyphens and
apostrophes. All of it is replaced: the family name (the last part, with the particles before it) by a family name, with
a hyphen where it has one, and what stands before it by one first name of the gender of its form of address, or by an
initial where only initials do, so that "Dr Weiss", "Mr Weiss" and "Mr John Weiss" stay one family. A first name after a form without
gender takes the gender that the same full name has elsewhere, where it has one only.

Distinctness: over the distinct entities, candidates that two entities share, or that are themselves an entity of
the input, are found by grouping and joining, as they will be written; all but the least entity of such a group take
their next candidate, until none is left. From the attempt `GROW_FROM` on, candidates of names, addresses, phone and
social security numbers get longer with each attempt, so that no number of entities uses up their surrogates. IPv4
addresses, card and account numbers and secrets keep their length: the least of these spaces has 223 * 2^24
surrogates, and after `MOST_ATTEMPTS` an error says which kind has run out. The work follows the distinct entities,
and hot ones are aggregated before they are joined.

Two scans of the texts: one takes the rows with an entity, which are staged, taken apart and joined again; one passes
the others on.

Key: the session's setting `KEY_SETTING`, or an argument. Where neither is given, one is drawn at random for the
session, so that no reader of this source can compute surrogates.

Defined results: a null text stays null and an empty one empty, with no entities. Rows are told apart by doc_id
and text; equal rows get equal results. Names of the Latin, Greek and Cyrillic scripts get surrogates of their script;
names of any other script with capital letters get Latin ones. In an e-mail address, a letter of another script or
with an accent, and any other character beyond ASCII, becomes a letter of its script where `OTHERS` has one, else a
Latin one; other digits become digits 0 to 9. Further columns are ignored, or kept by `carry`.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, let, stage_table

#: Forms of address by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος", "Κος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа", "Κυρία", "Κα")
NEUTRAL = ("Dr", "Prof")
#: Longest first, so that none is taken for the beginning of another.
TITLE = "(?:(?:" + "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)) + r")\.? )+"

#: Particles of family names, with small or capital letter, and those with a small letter only.
PARTICLES = "van von der den de del della di da dos du la le ten ter zu zum zur af av".split()
SMALL_PARTICLES = "al el bin ibn y e und".split()
_PARTICLE = "(?:" + "|".join([f"[{p[0].upper()}{p[0]}]{p[1:]}" for p in PARTICLES] + SMALL_PARTICLES) + ")"
_INITIALS = r"(?:\p{Lu}\.)(?:[- ]?\p{Lu}\.)*"
#: A part of a name: inner capitals, hyphens and apostrophes included, but not a possessive s.
_LETTERS = r"[\p{L}\p{M}]"
_PART = rf"(?:\p{{Lu}}|\p{{Ll}}{{1,2}}['’]\p{{Lu}}){_LETTERS}*+(?:[-‐‑'’](?![sS](?!{_LETTERS})){_LETTERS}++)*"
_PARTS = rf"(?!{TITLE})(?:(?:{_INITIALS}|{_PARTICLE}) )*{_PART}"
_FAMILY = rf"((?:{_PARTICLE} )*[^ ]+)$"

#: First names by script and gender, and syllables of family names by script.
FIRST = {
    ("latin", "m"): "Adam Bruno Carlo David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    ("latin", "f"): "Anna Berta Clara Diana Elena Flora Greta Hanna Irene Julia Klara Laura Maria Nora Olga Paula".split(),
    ("greek", "m"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θανάσης Κώστας Λευτέρης".split(),
    ("greek", "f"): "Αγγελική Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Κατερίνα Μαρίνα".split(),
    ("cyrillic", "m"): "Адам Борис Виктор Глеб Денис Егор Захар Иван".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Мария".split(),
}
SYLLABLES = {
    "latin": "ba den for gal hol kem lin mar nor pel ras sten tor val wes zan".split(),
    "greek": "βα δεν φορ γαλ κεμ λιν μαρ νορ πελ ρας τορ βαλ ζαν δολ μιρ σεβ".split(),
    "cyrillic": "ба ден фор гал кем лин мар нор пел рас тор вал зан дол мир сев".split(),
}

_WORD = r"[^\s\"'(),:;<>\[\]\\@|=]"
PATTERNS = {
    "email": rf"(?<!{_WORD}){_WORD}++@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)+",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "secret": r"(?<![0-9A-Za-z])(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?![0-9A-Za-z])",
    "card": r"(?<![\d+])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<!\d)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\d+(])\(\d{3}\) ?\d{3}[ -]\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "name": rf"(?<!\p{{L}}){TITLE}{_PARTS}(?: {_PARTS}){{0,3}}",
}
#: Back references count over the whole expression; only "card" has a group of its own.
ANY = "|".join(PATTERNS[k] for k in ("email", "card", "ipv4", "secret", "account", "ssn", "phone", "name"))

#: The attempt from which surrogates grow, by kind; numbers keep their length longer, since theirs is a fixed format.
GROW_FROM = {"given": 1, "family": 2, "email": 2, "phone": 6, "ssn": 6}
#: Only kinds of a fixed length can come here, with more entities than most of their surrogates.
MOST_ATTEMPTS = 200

KEY_SETTING = "spark.tessera.pii.key"


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting; a random one is set where there is none."""
    key = spark.conf.get(KEY_SETTING, None)
    if key is None:
        key = secrets.token_hex(16)
        spark.conf.set(KEY_SETTING, key)
    return key


def _may_match(text: Column) -> Column:
    """False only where ANY has no match: every alternative needs a digit, an @ or a form of address."""
    out = text.rlike("[0-9@]")
    for title in MALE + FEMALE + NEUTRAL:
        out = out | text.contains(title)
    return out


def _kind(surface: Column) -> Column:
    """The kind of a match of ANY."""
    out = F.when(surface.contains("@"), "email")
    for kind in ("card", "ipv4", "secret", "account", "ssn", "phone"):
        out = out.when(surface.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("family")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _norm(kind: Column, surface: Column) -> Column:
    """What all spellings of an entity share; of a name, the family name."""
    return (
        F.when(kind.isin("card", "phone", "ssn"), _digits(surface))
        .when(kind.isin("email", "secret"), F.lower(surface))
        .when(kind == "account", F.replace(surface, F.lit(" "), F.lit("")))
        .when(kind == "family", F.regexp_extract(F.regexp_replace(surface, rf"^{TITLE}", ""), _FAMILY, 1))
        .otherwise(surface)
    )


def _named(mentions: DataFrame) -> DataFrame:
    """Mentions with the entity of their first name: `given` is gender and name, null without a first name."""
    title = F.regexp_extract("surface", rf"^({TITLE})", 1)
    bare = F.substring_index(F.rtrim(F.replace(title, F.lit("."), F.lit(""))), " ", 1)
    gender = F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("n")
    name = F.regexp_replace("surface", rf"^{TITLE}", "")
    before = F.rtrim(F.regexp_replace(name, _FAMILY, ""))
    first = F.when((F.col("kind") == "family") & (before != ""), before)
    parsed = cut(mentions.select("*", first.alias("first"), gender.alias("gender")))
    known = (
        parsed.filter("first IS NOT NULL AND gender <> 'n'").groupBy("first", "norm").agg(F.min("gender").alias("lo"), F.max("gender").alias("hi"))
    )
    only = known.filter("lo = hi").select("first", "norm", F.col("lo").alias("only"))
    sex = F.when(F.col("gender") == "n", F.coalesce("only", "gender")).otherwise(F.col("gender"))
    return parsed.join(only, ["first", "norm"], "left").select(
        "row_key", "place", "surface", "kind", "norm", F.concat(sex, F.lit(":"), F.col("first")).alias("given")
    )


def _byte(stream: Column, i: Column) -> Column:
    """The i-th (from 0) keyed byte as an int."""
    block = F.element_at(stream, F.shiftright(i.cast("int"), 5) + 1)
    return F.conv(F.substring(block, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")


def _stream(key: str, kind: Column, norm: Column, attempt: Column, use: str = "") -> Column:
    """Keyed hexadecimal digits in blocks of 32 bytes, a byte for each character of the entity and more."""
    seed = F.concat_ws("|", F.lit(key + use), kind, norm, attempt.cast("string"))
    blocks = F.sequence(F.lit(0), F.ceil(F.length(norm) / 32).cast("int"))
    return F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")), 256))


_ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "абвгдежзиклмнопрстуфхцчшэюя",
)
#: Letters for those of their script that `_ALPHABETS` lacks.
OTHERS = {
    "Greek": _ALPHABETS[2],
    "Cyrillic": _ALPHABETS[3],
    "Han": "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミ",
    "Hangul": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누두루",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
}


def _like(text: Column, stream: Column, hexadecimal: bool = False) -> Column:
    """`text` with each digit and letter replaced by one of its own class."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        out = F.when(c.rlike("[0-9]"), (b % 10).cast("string"))
        if hexadecimal:
            out = out.when(c.rlike("[a-f]"), F.substring(F.lit("abcdef"), b % 6 + 1, F.lit(1)))
        for letters in _ALPHABETS:
            out = out.when(F.instr(F.lit(letters), c) > 0, F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1)))
        other = F.when(c.rlike(r"\p{N}"), (b % 10).cast("string"))
        for script, letters in OTHERS.items():
            other = other.when(c.rlike(rf"\p{{Is{script}}}"), F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1)))
        other = other.otherwise(F.substring(F.lit(_ALPHABETS[0]), b % 26 + 1, F.lit(1)))
        return out.when(c.rlike(r"[^\x00-\x7F]"), other).otherwise(c)

    return F.array_join(F.transform(_chars(text), one), "")


def _chars(text: Column) -> Column:
    """The characters of a text, in one pass."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _check_sum(digits: Column) -> Column:
    """The sum of the card check: every second digit from the right is doubled."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda a, x: a + x)


def _pick(items: list[str], b: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), b % len(items) + 1)


def _more(stream: Column, kind: str, attempt: Column, syllables: list[str]) -> Column:
    """What a candidate of `kind` grows by: a further syllable for each attempt from GROW_FROM on."""
    n = F.least(attempt - (GROW_FROM[kind] - 1), F.lit(32))
    more = F.array(F.sha2(F.element_at(stream, 1), 256))
    drawn = F.transform(F.sequence(F.lit(1), n), lambda j: _pick(syllables, _byte(more, j - 1)))
    return F.when(n > 0, F.array_join(drawn, "")).otherwise("")


def candidate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The surrogate of an entity in its shared form."""

    def made(s: Column) -> Column:
        drawn = _like(norm, s)
        body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
        with_zero = F.concat(body, F.lit("0"))
        last = F.pmod(_check_sum(norm) - _check_sum(with_zero), F.lit(10)).cast("string")
        local = F.substring_index(norm, "@", 1)
        host = F.substring_index(norm, "@", -1)
        label = F.substring_index(host, ".", 1)
        mail = F.concat(
            _like(local, s),
            _more(s, "email", attempt, SYLLABLES["latin"]),
            F.lit("@"),
            _like(label, _stream(key, kind, norm, attempt, "label")),
            F.lit(".example."),
            F.substring_index(host, ".", -1),
        )
        address = F.concat_ws(".", (_byte(s, F.lit(0)) % 223 + 1).cast("string"), *[_byte(s, F.lit(i)).cast("string") for i in (1, 2, 3)])
        sex = F.substring_index(norm, ":", 1)
        sex = F.when(sex == "n", F.when(_byte(s, F.lit(9)) % 2 == 0, "m").otherwise("f")).otherwise(sex)
        by_script = []
        for script in SYLLABLES:
            drawn_four = [_pick(SYLLABLES[script], _byte(s, F.lit(i))) for i in (1, 2, 3, 4)]
            heads, tails = F.concat(*drawn_four[:2]), F.concat(*drawn_four[2:], _more(s, "family", attempt, SYLLABLES[script]))
            hyphen = norm.rlike("[-‐‑]")
            family = F.when(hyphen, F.concat(F.initcap(heads), F.lit("-"), F.initcap(tails))).otherwise(F.initcap(F.concat(heads, tails)))
            first = F.when(sex == "m", _pick(FIRST[script, "m"], _byte(s, F.lit(0)))).otherwise(
                _pick(FIRST[script, "f"], _byte(s, F.lit(0)))
            )
            first = F.concat(first, _more(s, "given", attempt, SYLLABLES[script]))
            capitals = [x.upper() for x in sorted({x[0] for x in SYLLABLES[script]})]
            initials = F.concat(_pick(capitals, _byte(s, F.lit(0))), F.lit("."), _more(s, "given", attempt, [f"{x}." for x in capitals]))
            first = F.when(F.substring_index(norm, ":", -1).rlike(f"^{_INITIALS}$"), initials).otherwise(first)
            by_script.append(F.when(kind == "given", first).otherwise(family))
        latin, greek, cyrillic = by_script
        part = F.when(norm.rlike(r"\p{IsCyrillic}"), cyrillic).when(norm.rlike(r"\p{IsGreek}"), greek).otherwise(latin)
        digits = [str(d) for d in range(10)]
        return (
            F.when(kind == "email", mail)
            .when(kind == "ipv4", address)
            .when(kind == "secret", _like(norm, s, hexadecimal=True))
            .when(kind == "card", F.concat(body, last))
            .when(
                kind == "phone",
                F.concat(
                    F.substring(norm, 1, 1), F.substring(drawn, F.lit(2), F.length(drawn)), _more(s, "phone", attempt, digits)
                ),
            )
            .when(kind == "ssn", F.concat(drawn, _more(s, "ssn", attempt, digits)))
            .when(kind == "account", F.concat(F.substring(norm, 1, 2), F.substring(drawn, F.lit(3), F.length(drawn))))
            .when(kind.isin("family", "given"), part)
            .otherwise(drawn)
        )

    return let(_stream(key, kind, norm, attempt), made)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """One surrogate for each distinct (kind, norm), no two alike and none of them an entity itself."""
    known = cut(entities.select("kind", "norm").distinct())
    state = known.select("kind", "norm", F.lit(0).alias("attempt"))
    for _ in range(MOST_ATTEMPTS):
        state = cut(state.withColumn("surrogate", candidate(key, F.col("kind"), F.col("norm"), F.col("attempt"))))
        shared = (
            state.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min("norm").alias("keeper")).filter("n > 1")
        )
        bare = F.when(F.col("kind") == "given", F.substring_index("norm", ":", -1)).otherwise(F.col("norm"))
        real = known.select("kind", bare.alias("surrogate"), F.lit(True).alias("is_real")).distinct()
        marked = (
            state.join(shared, ["kind", "surrogate"], "left")
            .join(real, ["kind", "surrogate"], "left")
            .withColumn("again", F.col("is_real").isNotNull() | (F.col("keeper") != F.col("norm")))
            .withColumn("again", F.coalesce("again", F.lit(False)))
            .select("kind", "norm", "attempt", "surrogate", "again")
        )
        if marked.filter("again").isEmpty():
            return state.select("kind", "norm", "surrogate")
        state = marked.select("kind", "norm", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    kinds = [r.kind for r in marked.filter("again").select("kind").distinct().collect()]
    raise RuntimeError(f"more entities than surrogates of the same format: {', '.join(sorted(kinds))}")


def _written(kind: Column, surface: Column, surrogate: Column) -> Column:
    """The surrogate as the mention writes its entity: the same grouping, case and form of address."""

    def grouped(acc: Column, c: Column) -> Column:
        move = c.rlike("[0-9]") | ((kind == "account") & (c != " "))
        return F.struct(
            F.concat(acc["t"], F.when(move, F.substring(surrogate, acc["i"], F.lit(1))).otherwise(c)).alias("t"),
            (acc["i"] + move.cast("int")).alias("i"),
        )

    rest = F.length(surrogate)
    spaced = F.aggregate(
        _chars(surface),
        F.struct(F.lit("").alias("t"), F.lit(1).alias("i")),
        grouped,
        lambda a: F.concat(a["t"], F.substring(surrogate, a["i"], rest)),
    )
    title = F.regexp_extract(surface, rf"^{TITLE}", 0)
    return (
        F.when(kind.isin("card", "phone", "ssn", "account"), spaced)
        .when(kind == "family", F.concat(title, surrogate))
        .when(kind.isin("email", "secret") & (F.upper(surface) == surface) & (F.lower(surface) != surface), F.upper(surrogate))
        .otherwise(surrogate)
    )


def replace_entities(docs: DataFrame, key: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row with its entities replaced: doc_id, text, n_entities (and the columns of `carry` as `carried`)."""
    key = key or session_key(docs.sparkSession)
    extra = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    none = F.array().cast("array<string>")
    matches = F.when(_may_match(F.col("text")), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(none)
    found = docs.select("doc_id", "text", *extra, F.coalesce(matches, none).alias("found"))
    names = ["carried"] if carry else []
    clean = found.filter("size(found) = 0").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), *names)
    hit = stage_table(found.filter("size(found) > 0").withColumn("row_key", F.sha2(F.col("text"), 256)))
    mentions = (
        hit.select("row_key", "found")
        .dropDuplicates(["row_key"])
        .select("row_key", F.posexplode("found").alias("place", "surface"))
        .withColumn("kind", _kind(F.col("surface")))
        .withColumn("norm", _norm(F.col("kind"), F.col("surface")))
    )
    mentions = cut(_named(mentions))
    given = mentions.filter("given IS NOT NULL").select(F.lit("given").alias("kind"), F.col("given").alias("norm"))
    made = surrogates(mentions.select("kind", "norm").unionByName(given), key)
    first = made.filter("kind = 'given'").select(F.col("norm").alias("given"), F.col("surrogate").alias("first"))
    surrogate = F.concat_ws(" ", "first", "surrogate")
    written = (
        mentions.join(made, ["kind", "norm"])
        .join(first, "given", "left")
        .withColumn("written", _written(F.col("kind"), F.col("surface"), surrogate))
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_list(F.struct("place", "written"))).alias("by_place"))
    )
    parts = F.split("text", ANY)
    joined = F.array_join(
        F.flatten(
            F.zip_with(
                parts,
                F.transform("by_place", lambda x: x["written"]),
                lambda p, s: F.array(F.coalesce(p, F.lit("")), F.coalesce(s, F.lit(""))),
            )
        ),
        "",
    )
    done = hit.join(written, "row_key").select(
        "doc_id", joined.alias("text"), F.size("found").cast("long").alias("n_entities"), *names
    )
    return clean.unionByName(done)
