import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import trees

NAMES = ["a", "b", "a.b", "", "{", 'q"', "é", "longer name"]
VALUES = [{}, [], None, "", " \t", "{not json", "[]", "null", "text", "a longer text", 0, 1, -25, 2.5, True, False, [1, {"a": {}}], [[]], '"', "\\n", "{}"]


def document(r, depth):
    if depth == 0 or r.random() < 0.3:
        return r.choice(VALUES)
    return {n: document(r, depth - 1) for n in r.sample(NAMES, r.randrange(4))}


def documents(seed, n=60):
    r = random.Random(seed)
    docs = [{n: document(r, 5) for n in r.sample(NAMES, r.randrange(1, 5))} for _ in range(n)]
    deep = "x"
    for i in range(18):
        deep = {f"n{i}": deep, "{}": {}}
    return [*docs, deep, {}, [], "text", 5, None]


def nodes(value, path=(), inner=False, items=False):
    children = value.items() if isinstance(value, dict) else enumerate(value) if items and isinstance(value, list) else ()
    children = list(children)
    if inner or not children:
        yield path, value
    for k, v in children:
        yield from nodes(v, (*path, None if isinstance(value, list) else k), inner, items)


def frame(spark, docs):
    return spark.createDataFrame([(i, i % 7, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)], "id long, g long, doc string")


def plain(v):
    return json.dumps(v, sort_keys=True)


@pytest.mark.parametrize("inner, items", [(False, False), (True, False), (True, True), (False, True)])
def test_walk_finds_every_node(spark, inner, items):
    docs = documents(1)
    got = sorted((r.id, repr(tuple(r.path)), r.kind, plain(json.loads(r.value))) for r in trees.walk(frame(spark, docs), "id", "doc", inner, items).collect())
    kinds = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}
    want = sorted((i, repr(p), kinds[type(v)], plain(v)) for i, d in enumerate(docs) for p, v in nodes(d, (), inner, items))
    assert got == want


def test_walk_of_text_that_is_no_json_and_of_clashing_columns(spark):
    df = spark.createDataFrame([(1, "{oops", 2), (2, None, 3), (3, "", 1), (None, "7", 1)], "path long, doc string, v int")
    assert sorted(map(tuple, trees.walk(df.withColumnRenamed("path", "id"), "id", "doc").collect()), key=repr) == [
        (1, [], "invalid", '"{oops"'), (3, [], "invalid", '""'), (None, [], "number", "7"),
    ]
    assert trees.walk(df.limit(0).withColumnRenamed("path", "id"), "id", "doc", inner=True).count() == 0


def test_assemble_inverts_walk(spark):
    docs = documents(2)
    got = {r.id: r.doc for r in trees.assemble(trees.walk(frame(spark, docs), "id", "doc"), "id").collect()}
    assert {k: plain(json.loads(v)) for k, v in got.items()} == {i: plain(d) for i, d in enumerate(docs)}


def fold(doc, fills):
    """jsonb_set with creation, fill by fill; parents have to be objects."""
    doc = json.loads(json.dumps(doc))
    for path, value in sorted(fills.items(), key=lambda f: (len(f[0]), f[0])):
        at = doc
        for name in path[:-1]:
            at = at.get(name) if isinstance(at, dict) else None
        if isinstance(at, dict):
            at[path[-1]] = json.loads(json.dumps(value))
    return doc


def test_set_paths_equals_a_fold(spark):
    r, docs = random.Random(3), documents(3)
    fills = {}
    for i, d in enumerate(docs):
        known = [p for p, _ in nodes(d, (), True) if p]
        for _ in range(r.randrange(5)):
            base = r.choice(known) if known and r.random() < 0.8 else ()
            path = (*base, *r.sample(NAMES, r.randrange(3))) or (r.choice(NAMES),)
            fills.setdefault(i, {})[path] = document(r, 2)
    rows = [(i, list(p), json.dumps(v, ensure_ascii=False)) for i, f in fills.items() for p, v in f.items()]
    out = trees.set_paths(frame(spark, docs), "id", "doc", spark.createDataFrame(rows, "id long, path array<string>, value string"))
    got = {x.id: plain(json.loads(x.doc)) for x in out.collect()}
    assert got == {i: plain(fold(d, fills.get(i, {}))) for i, d in enumerate(docs)}


def gap(v):
    return v is None or v in ([], {}) or isinstance(v, str) and not v.strip()


def at_path(v, path):
    for name in path:
        v = v.get(name) if isinstance(v, dict) else None
    return v


def test_decisions_and_enriched_documents(spark):
    docs = documents(4)
    df = frame(spark, docs)
    decided = trees.fill_decisions(df, "id", ["g"], "doc")
    size = {plain(json.loads(r.value)): len(r.value) for r in trees.walk(df, "id", "doc", inner=True).collect()}
    want, fills = [], {}
    for i, d in enumerate(docs):
        for p, v in nodes(d):
            if p and gap(v):
                found = [(-size[plain(x)], j, x) for j, e in enumerate(docs) if j % 7 == i % 7 and not gap(x := at_path(e, p))]
                best = min(found, key=lambda x: x[:2], default=None)
                want.append((i, p, plain(v), best and plain(best[2]), best and best[1], len(found), "filled" if best else "skipped_no_sibling_value"))
                if best:
                    fills.setdefault(i, {})[p] = best[2]
    got = [(r.id, tuple(r.path), plain(json.loads(r.original_value)), r.filled_value and plain(json.loads(r.filled_value)), *r[4:]) for r in decided.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(fills) > 5
    done = {r.id: plain(json.loads(r.doc)) for r in trees.enrich(df, "id", "doc", decided).collect()}
    assert done == {i: plain(fold(d, fills.get(i, {}))) for i, d in enumerate(docs)}


def merged(schema, value):
    """One template of all shapes: objects win, items of arrays merge under the array's name."""
    for k, v in value.items():
        if isinstance(v, (dict, list)):
            if not isinstance(schema.get(k), dict):
                schema[k] = {}
            for x in [v] if isinstance(v, dict) else v:
                merge_items(schema[k], x)
        else:
            schema.setdefault(k, None)
    return schema


def merge_items(schema, x):
    if isinstance(x, dict):
        merged(schema, x)
    elif isinstance(x, list):
        for y in x:
            merge_items(schema, y)


def test_catalogue_and_template(spark):
    docs = [d for d in documents(5) if isinstance(d, dict)]
    paths = trees.catalogue(frame(spark, docs), "id", "doc")
    want, counts = {}, {}
    for d in docs:
        merged(want, d)
        for p, _ in nodes(d, (), True, True):
            if p:
                counts[p] = counts.get(p, 0) + 1
    rows = paths.collect()
    assert {tuple(r.path): r.n for r in rows} == counts
    assert all(r.n == r.n_object + r.n_array + r.n_string + r.n_number + r.n_boolean + r.n_null for r in rows)
    assert json.loads(trees.template(paths).first().doc) == want


def test_differences(spark):
    before, after = documents(6, 30), documents(7, 30)
    got = sorted((r.id, repr(tuple(r.path)), r.change) for r in trees.differences(frame(spark, before), frame(spark, after), "id", "doc").collect())
    want = []
    for i, (b, a) in enumerate(zip(before, after)):
        b, a = ({p: plain(v) for p, v in nodes(x)} for x in (b, a))
        want += [(i, repr(p), "lost" if p not in a else "added" if p not in b else "changed") for p in a.keys() | b.keys() if a.get(p) != b.get(p)]
    assert got == sorted(want)


def test_gaps_by_type(spark):
    texts = ["null", "[]", "{}", '""', '" \\n\\t"', '"[]"', '"null"', "0", "false", '"{}"', '" "', None]
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select("value", trees.is_gap(F.col("value")).alias("g")).collect()
    assert [r.value for r in rows if r.g] == ["null", "[]", "{}", '""', '" \\n\\t"', '" "', None]


def deep_merge(template, record, extra=True):
    out = dict(template)
    for k, v in record.items():
        if k in out or extra:
            out[k] = deep_merge(out[k], v, extra) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


@pytest.mark.parametrize("extra", [True, False])
def test_merge(spark, extra):
    pairs = [(a, b) for a, b in zip(documents(8), documents(9)) if isinstance(a, dict) and isinstance(b, dict)]
    rows = [(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id long, template string, record string")
    got = {r.id: plain(json.loads(r.doc)) for r in trees.merge(df, "id", "template", "record", extra).collect()}
    assert got == {i: plain(deep_merge(a, b, extra)) for i, (a, b) in enumerate(pairs)}
