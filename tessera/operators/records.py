"""Records of many sources brought to one shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def standardise(doc: Column, mapping: dict[str, tuple[str, str, str]], unmapped: str = "unmapped_fields") -> Column:
    """The fields of a JSON object as an array of (category, field, slot, value), within the row.

    `mapping` gives category, field and slot ('' for the whole field) of a source field; any other field goes to the
    category `unmapped` under its own name, so none is lost. Fields without a value are left out.
    """
    pairs = [x for k, (category, field, slot) in mapping.items() for x in (F.lit(k), F.struct(F.lit(category).alias("category"), F.lit(field).alias("field"), F.lit(slot).alias("slot")))]
    targets = F.create_map(*pairs)

    def place(e: Column) -> Column:
        own = F.struct(F.lit(unmapped).alias("category"), e["key"].alias("field"), F.lit("").alias("slot"))
        at = F.coalesce(F.try_element_at(targets, e["key"]), own)
        return F.struct(at["category"].alias("category"), at["field"].alias("field"), at["slot"].alias("slot"), e["value"].alias("value"))

    entries = F.filter(F.map_entries(F.from_json(doc, "map<string,string>")), lambda e: e["value"].isNotNull())
    return F.coalesce(F.transform(entries, place), F.filter(F.array(F.struct(*[F.lit("").alias(c) for c in ("category", "field", "slot", "value")])), lambda x: F.lit(False)))


def nested(items: Column) -> Column:
    """The array of `standardise` as maps category -> field -> slot -> value; of equal slots the last one stays."""

    def distinct(rows: Column, part: str) -> Column:
        return F.array_sort(F.array_distinct(F.transform(rows, lambda r: r[part])))

    def slots(rows: Column) -> Column:
        return F.map_from_entries(F.transform(distinct(rows, "slot"), lambda s: F.struct(s, F.element_at(F.filter(rows, lambda r: r["slot"] == s), -1)["value"])))

    def fields(rows: Column) -> Column:
        return F.map_from_entries(F.transform(distinct(rows, "field"), lambda f: F.struct(f, slots(F.filter(rows, lambda r: r["field"] == f)))))

    return F.map_from_entries(F.transform(distinct(items, "category"), lambda c: F.struct(c, fields(F.filter(items, lambda r: r["category"] == c)))))


def first_text(*sources: Column) -> Column:
    """The first source that is not blank, in order of preference."""
    return F.coalesce(*[F.when(F.trim(s) != "", s) for s in sources])


def main_names(names: Column) -> Column:
    """Distinct names in upper case, in order; blank ones are left out."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda n: F.upper(F.trim(n))), lambda n: n != "")))


def other_names(names: Column, main: Column) -> Column:
    """main_names of the rest: those that are among `main` are left out."""
    return F.array_except(main_names(names), main)


def role_of(name: Column, main: Column) -> Column:
    """active where the name holds a main name or is part of one, else excipient."""
    n = F.upper(F.trim(name))
    return F.when(F.exists(main, lambda m: F.contains(m, n) | F.contains(n, m)), "active").otherwise("excipient")
