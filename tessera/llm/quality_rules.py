"""Quality rules: a threshold table compiled into one projection, without user functions.

Each text is measured once (lengths, symbols, stop words, lines, repeated passages) and every rule is a ratio
of two measures with bounds. The plan is a scan and a projection: no shuffle, no state, any number of rows.

Defined results: a null or empty text has no words, so all its measures are 0 and it fails the base rules.
Rows are judged one by one, so repeated rows and null doc_ids are kept as they come; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, text_of, words_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Common function words of English, German, French and Spanish, in lower case.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "der die und in den von zu das mit sich des auf für ist im dem eine ein nicht als "
    "de la le et les des en un du une que pour est dans qui par au pas sur avec "
    "el y los se las del por con no una para su al es lo"
).split()

#: Fixed width of the windows in which repeats are looked for.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """`low <= part / whole <= high` must hold for texts of at least `from_words` words."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The threshold table. Bounds leave room on either side of prose in the four languages.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=2.0, high=12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", high=0.3),
    Rule("stop_word_share", "n_stop_words", "n_words", low=0.04, from_words=30),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", high=0.5),
)


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of WINDOW words that occur twice or more among `words`.

    Windows are held as hashes; only in texts in which some hash repeats they are sorted, and neighbours of equal hash
    are compared word by word.
    """

    def at(i: Column) -> Column:
        return F.slice(words, i, WINDOW)

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))

        def starts(z: Column) -> Column:
            def same(k: Column, j: Column) -> Column:
                x, y = F.get(z, k), F.get(z, j)
                return F.when(F.coalesce(x["h"] == y["h"], F.lit(False)), at(x["i"]) == at(y["i"])).otherwise(F.lit(False))

            hit = F.filter(F.sequence(F.lit(0), F.size(z) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
            return F.sort_array(F.transform(hit, lambda k: F.get(z, k)["i"]))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            let(ordered, starts),
            zero,
            lambda acc, i: F.struct(
                (i + WINDOW).alias("end"), (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - i)).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def count(hashes: Column) -> Column:
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0).cast("long")).otherwise(covered(hashes))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(at(i)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, count))


def _removed(text: Column, chars: str) -> Column:
    """How many characters of `text` are among `chars`."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measures(text: Column) -> Column:
    """One struct of all measures of a text that is not null."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    return let(
        F.struct(words_of(text).alias("w"), lines.alias("l")),
        lambda s: F.struct(
            F.size(s["w"]).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            _removed(text, SYMBOLS).alias("n_symbols"),
            F.size(s["l"]).cast("long").alias("n_lines"),
            (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(s["w"]).alias("n_repeat_words"),
            F.size(F.filter(s["w"], lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            _removed(text, "!").alias("n_exclamations"),
        ),
    )


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that the measures `m` break."""
    broken = []
    for r in rules:
        # Products instead of quotients: no division by zero, and the same comparison in any engine.
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (m[r.part] < m[r.whole] * F.lit(r.low))
        if r.high is not None:
            bad = bad | (m[r.part] > m[r.whole] * F.lit(r.high))
        broken.append(F.when((m["n_words"] >= r.from_words) & bad, F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def base_failed(m: Column) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of each row: doc_id, the measures, base_failed, broken_rules, kept."""
    judged = docs.select("doc_id", measures(text_of()).alias("m")).select(
        "doc_id", "m.*", base_failed(F.col("m")).alias("base_failed"), verdict(F.col("m"), rules).alias("broken_rules")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def filter_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns.

    The verdict is one expression that measures the text once, so that the filter can be pushed anywhere.
    """
    return docs.filter(let(measures(text_of()), lambda m: ~base_failed(m) & (F.size(verdict(m, rules)) == 0)))
