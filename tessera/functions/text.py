"""Text normalisation as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Salt words that may end a name.
SALTS = (
    *"mesylate mesilate hydrochloride hcl sulfate sulphate sodium potassium calcium acetate maleate fumarate".split(),
    *"hemifumarate tartrate besylate besilate succinate phosphate citrate bromide chloride nitrate tosylate".split(),
    *("trihydrate", "dihydrate", "monohydrate", "disoproxil fumarate", "alafenamide", "proxetil", "medoxomil", "axetil"),
    *"pivoxil cilexetil stearate palmitate decanoate valerate propionate dipropionate furoate".split(),
    *("hydrobromide", "magnesium"),
)


def squeeze(x: Column) -> Column:
    """Trimmed of all white space, with single spaces inside."""
    return F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), r"\s+", " ")


def strip_suffix(name: Column, suffixes: tuple[str, ...] | list[str], plural: bool = True) -> Column:
    """Upper-cased name without one trailing word of `suffixes`; words are matched whole and case-insensitively, with
    `plural` also with an S behind."""
    words = "|".join(s.upper().replace(" ", r"\s+") for s in suffixes)
    return F.regexp_replace(F.upper(F.trim(name)), rf"\s+(?:{words}){'S?' if plural else ''}\s*$", "")


def strip_first(name: Column, patterns: list[str], least: int = 3) -> Column:
    """The name after the first pattern that changes it; null if none does or fewer than `least` characters stay."""
    cases = None
    for p in patterns:
        out = F.regexp_replace(name, p, "")
        cases = F.when(out != name, out) if cases is None else cases.when(out != name, out)
    return F.when(F.length(cases) >= least, cases)


def canonical(value: Column, mapping: dict[str, str]) -> Column:
    """The mapped form of a value, or the value itself."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, value), value)


def trigrams(x: Column) -> Column:
    """Distinct trigrams of the words, each with two blanks before and one behind, in lower case."""
    words = F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.flatten(
        F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    )
    return F.array_distinct(grams)


def edit_ratio(a: Column, b: Column) -> Column:
    """100 * (1 - edit distance / longer length), rounded down."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.floor(100 * (1 - F.levenshtein(a, b) / F.nullif(longest, F.lit(0)))).cast("long")


def token_sort(x: Column) -> Column:
    """The words of a text in order, joined by spaces."""
    return F.array_join(F.array_sort(F.split(F.lower(F.trim(x)), r"\s+")), " ")


def strength(x: Column) -> tuple[Column, Column]:
    """First number with a unit: amount and upper-cased unit (null where there is none)."""
    pattern = r"(?i)(\d+(?:\.\d+)?)\s*(MG|MCG|ML|G)\b"
    amount = F.regexp_extract(x, pattern, 1)
    unit = F.upper(F.regexp_extract(x, pattern, 2))
    return F.when(amount != "", amount.cast("double")), F.when(unit != "", unit)


def first_rule(rules: list[tuple[str, Column]], default: str) -> Column:
    """The label of the first rule that holds."""
    out = reduce(lambda acc, r: acc.when(r[1], r[0]) if acc is not None else F.when(r[1], r[0]), rules, None)
    return out.otherwise(default)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of numbers, in double precision; null where one has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def suffix_pattern(suffix: str) -> str:
    """The regular expression of a trailing suffix: words in any spacing, upper or lower case, singular or plural."""
    words = r"[\s,/-]+".join(f"\\Q{w}\\E" for w in suffix.split())
    return rf"(?i)[\s,]+(?:{words})s?\s*$"


def strip_form(name: Column, form: Column, patterns: dict[str, str]) -> Column:
    """The name without its form: an exact ending first, then the pattern that the form is mapped to."""
    ends = F.lower(name).endswith(F.concat(F.lit(" "), F.lower(form)))
    out = F.when(ends, F.rtrim(F.substring(name, F.lit(1), F.length(name) - F.length(form) - 1)))
    for value, suffix in patterns.items():
        out = out.when(form == value, F.regexp_replace(name, suffix_pattern(suffix), ""))
    return out.otherwise(name)


def variant_suffix(name: Column) -> Column:
    """A digit and a letter at the end of a name ("2a"), which tell variants apart; empty where there are none."""
    return F.regexp_extract(F.lower(F.replace(name, F.lit(" "), F.lit(""))), r"(\d[a-z])$", 1)


def parenthetical(x: Column) -> Column:
    """What stands in the first parentheses; null without any."""
    return F.nullif(F.regexp_extract(x, r"\(([^)]+)\)", 1), F.lit(""))


def long_tokens(x: Column, least: int = 6) -> Column:
    """Tokens between blanks, hyphens and slashes of at least `least` characters."""
    return F.filter(F.split(x, r"[\s\-/]+"), lambda t: F.length(t) >= least)


def list_literal(x: Column) -> Column:
    """The strings of a list written as a JSON array or with single quotes; any other text is a list of itself."""
    parsed = F.from_json(x, "array<string>", {"allowSingleQuotes": "true"})
    return F.when(F.trim(x).startswith("["), F.coalesce(parsed, F.array(x))).otherwise(F.array(x))


def name_variants(name: Column, suffixes: list[str]) -> Column:
    """The name and what it is without each of the suffixes, distinct, in order."""
    return F.array_distinct(F.array(name, *[F.regexp_replace(name, suffix_pattern(x), "") for x in suffixes]))


def grade(a: Column, b: Column) -> Column:
    """GREEN for names equal up to case, YELLOW where one holds the other, else RED."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    return F.when(x == y, "GREEN").when(F.contains(x, y) | F.contains(y, x), "YELLOW").otherwise("RED")


def arrow_change(x: Column) -> tuple[Column, Column]:
    """Direction (up, down, same) and percentage of a change written with an arrow."""
    arrow = F.regexp_extract(x, r"([↑↓↔])", 1)
    direction = F.when(arrow == "↑", "up").when(arrow == "↓", "down").when(arrow == "↔", "same")
    return direction, F.nullif(F.regexp_extract(x, r"[↑↓↔]\s*(\d+)%", 1), F.lit("")).cast("int")


def timing(x: Column) -> Column:
    """The class of an administration time, by the first rule that fits."""
    low = F.lower(x)
    rules = [("empty stomach", low.rlike("empty stomach|without food")), ("separate", low.rlike(r"\d+ hours? (?:before|after)"))]
    return first_rule([*rules, ("with food", low.rlike("with (?:food|meals?)"))], "any")


def is_header(cells: Column) -> Column:
    """Whether every cell of a table row is a head of numbers (n, N, %)."""
    return (F.size(cells) > 0) & F.forall(cells, lambda c: F.trim(c).rlike("^[nN%]+$"))


def nearest(x: Column, values: list[float]) -> Column:
    """The value of a list that lies nearest, the lesser one of two."""
    return F.array_min(F.transform(F.array(*map(F.lit, values)), lambda v: F.struct(F.abs(v - x).alias("d"), v.alias("v"))))["v"]


def token_sort_ratio(a: Column, b: Column) -> Column:
    """edit_ratio of the sorted words."""
    return edit_ratio(token_sort(a), token_sort(b))


def chunks(x: Column, size: int) -> Column:
    """A text in pieces of at most `size` characters, cut behind the last line feed that fits, if there is one behind the
    piece's first character. One fold over the lines; a null or empty text has no pieces."""
    lines = F.regexp_extract_all(x, F.lit("[^\n]*\n|[^\n]+"), F.lit(0))

    def step(s: Column, line: Column) -> Column:
        end = s["at"] + F.length(line)
        full = end > s["start"] + size
        at_break = full & (s["feed"] > s["start"])
        start = F.when(at_break, s["feed"] + 1).otherwise(s["start"])
        # What is left of a long line is cut by size.
        more = F.greatest(F.ceil((end - start - size) / size), F.lit(0)).cast("int")
        none = F.array().cast("array<int>")
        by_size = F.when(more > 0, F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), lambda k: start + k * size)).otherwise(none)
        cuts = F.concat(s["cuts"], F.when(at_break, F.array(start)).otherwise(none), by_size)
        feed = F.when(line.endswith("\n"), end - 1).otherwise(s["feed"])
        return F.struct(end.alias("at"), (start + more * size).alias("start"), feed.alias("feed"), cuts.alias("cuts"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(-1).alias("feed"), F.array(F.lit(0)).alias("cuts"))
    cuts = F.aggregate(lines, zero, step)["cuts"]
    pieces = F.transform(cuts, lambda c, i: F.substring(x, c + 1, F.coalesce(F.get(cuts, i + 1), F.length(x)) - c))
    return F.filter(pieces, lambda p: p != "")
