"""The thin queries opN_<name> over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    chat,
    exact_dedup,
    jaccard_join,
    mixing,
    periodic_runs,
    pieces,
    pii,
    quality_classifier,
    quality_rules,
    recompression,
    simhash,
    structure_repair,
    token_file,
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        mixing.assign(_read(spark, sf_dir, "documents"))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            "taken",
            F.size("takes").cast("long").alias("n_takes"),
            F.get("takes", F.lit(0))["position"].alias("first_position"),
        )
        .orderBy("first_position", "doc_id")
    )


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(_read(spark, sf_dir, "documents"), with_text=False)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_stop_words",
        "n_exclamations",
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, _read(spark, sf_dir, "labels")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_read(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(_read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = token_file.new_path(spark)
    token_file.write(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_file.read(spark, path, with_ids=False)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_read(spark, sf_dir, "conversations"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(_read(spark, sf_dir, "documents"), model, with_ids=False)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find(_read(spark, sf_dir, "documents"), periodic_runs.repeat_tail)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults of op13: conv_id, turn, role, text."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(place[0], F.lit(":"), place[1]).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.filter("kind <> 0").select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations")
    known = structure_repair.reports(damaged(conversations)).withColumnRenamed("conv_id", "c")
    every = conversations.select("conv_id").distinct().join(known, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return every.select("conv_id", *counts, *texts)


def queries():
    return {
        "op1_mixing": op1_mixing,
        "op2_recompression": op2_recompression,
        "op3_quality_rules": op3_quality_rules,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_pii": op6_pii,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_token_file": op8_token_file,
        "op9_chat": op9_chat,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_simhash": op11_simhash,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_structure_repair": op13_structure_repair,
    }


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))


def _broken(rule: quality_rules.Rule) -> str:
    parts = []
    if rule.low is not None:
        parts.append(f"{rule.part} < {rule.whole} * CAST({rule.low} AS DOUBLE)")
    if rule.high is not None:
        parts.append(f"{rule.part} > {rule.whole} * CAST({rule.high} AS DOUBLE)")
    return f"(n_words >= {rule.from_words} AND ({' OR '.join(parts)}))"


OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
win AS (
  SELECT r, i, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') AS s
  FROM (SELECT r, w, unnest(range(1, CAST(len(w) AS BIGINT) - 3)) AS i FROM d)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words,
         CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclamations
  FROM d LEFT JOIN cov USING (r))
SELECT *, NOT base_failed AND NOT ({' OR '.join(map(_broken, quality_rules.RULES))}) AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
"""

OP7_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
"""


OP2_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT r, i, sha256(array_to_string(list_slice(w, i, i + {recompression.WIDTH - 1}), ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, CAST(len(w) AS BIGINT) - {recompression.WIDTH - 2})) AS i FROM d)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
cov AS (SELECT DISTINCT r, i + k AS j FROM rep, (SELECT unnest(range(0, {recompression.WIDTH})) AS k)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS j FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM words ANTI JOIN cov USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP5_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(CAST(len(w) AS BIGINT) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.r = a JOIN n y ON y.r = b
  WHERE 100 * c >= {jaccard_join.PERCENT} * (x.n + y.n - c)),
reach AS (SELECT r, doc_id AS c FROM d UNION SELECT b, c FROM reach JOIN links ON a = r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT r, min(c) AS component_id FROM reach GROUP BY r) USING (r)
"""

_WEIGHTS = ", ".join(map(str, mixing.WEIGHTS))


def _position(share: str, knots) -> str:
    pieces = [(t0, t1, w0, w1, (t1 - t0) * (w0 + w1) / 2) for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole, before, cases = sum(p[4] for p in pieces), 0.0, ""
    for t0, t1, w0, w1, area in pieces:
        rest = f"({share} * CAST({whole} AS DOUBLE) - CAST({before} AS DOUBLE))"
        root = f"sqrt(greatest(0.0::DOUBLE, {w0 * w0}::DOUBLE + {2 * (w1 - w0) / (t1 - t0)}::DOUBLE * {rest}))"
        before += area
        cases += (
            f" WHEN {share} * CAST({whole} AS DOUBLE) <= CAST({before} AS DOUBLE) THEN"
            f" least({t1}::DOUBLE, {t0}::DOUBLE + 2::DOUBLE * {rest} / ({w0}::DOUBLE + {root}))"
        )
    return f"CASE{cases} ELSE {knots[-1][0]}::DOUBLE END"


_FIRST = " ".join(
    f"WHEN rank % {len(mixing.SCHEDULES)} = {k} THEN {_position('(start / quota)', knots)}"
    for k, knots in enumerate(mixing.SCHEDULES)
)

OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS key,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                              lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
c AS (SELECT *, CAST(([{_WEIGHTS}])[rank % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight,
             CAST(source_size * {mixing.MAX_REPEATS} AS DOUBLE) AS cap FROM r),
l AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS capped,
         sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           AS open_weight,
         row_number() OVER (ORDER BY cap / weight, rank) AS nth
  FROM c),
f AS (SELECT * FROM l WHERE cap * open_weight > weight * (total - capped) ORDER BY nth LIMIT 1),
t AS (
  SELECT l.source, l.source_size, l.rank,
         CASE WHEN l.nth >= f.nth THEN l.weight * (f.total - f.capped) / f.open_weight ELSE l.cap END AS target
  FROM l LEFT JOIN f ON true),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                                ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST({' + '.join(f'greatest(0, least(size, quota - {k} * source_size - start))' for k in range(mixing.MAX_REPEATS))}
            AS BIGINT) AS taken,
       CAST({' + '.join(f'(CASE WHEN size > 0 AND {k} * source_size + start < quota THEN 1 ELSE 0 END)' for k in range(mixing.MAX_REPEATS))}
            AS BIGINT) AS n_takes,
       CASE WHEN size > 0 AND start < quota THEN CASE {_FIRST} END END AS first_position
FROM p
"""

OP9_SQL = r"""
WITH c AS (SELECT *, CASE WHEN conv_id IS NULL THEN 'row' || row_number() OVER () ELSE 'conv' || conv_id END AS c FROM conversations),
t AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS place,
         count(*) OVER (PARTITION BY c) AS n_turns
  FROM (SELECT *, sha256(coalesce(role, chr(0)) || chr(1) || coalesce(text, chr(0))) AS digest FROM c)),
p AS (
  SELECT c, conv_id, place, n_turns, string_agg(digest, '') OVER (PARTITION BY c ORDER BY place) AS prefix FROM t),
w AS (SELECT prefix, n_turns, coalesce(arg_min(c, conv_id), min(c)) AS c, count(*) AS n_equal
      FROM p WHERE place = n_turns GROUP BY prefix, n_turns),
k AS (SELECT * FROM w WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < n_turns))
SELECT t.conv_id, k.n_turns, k.n_equal,
       string_agg('<|' || translate(regexp_replace(regexp_replace(coalesce(role, 'unknown'), '<(\\*)\|', '<\\\1|', 'g'), '\|(\\*)>', '|\\\1>', 'g'), chr(10), ' ')
                  || '|>' || chr(10) || regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10), '' ORDER BY place) AS text
FROM k JOIN t ON k.c = t.c
GROUP BY k.c, t.conv_id, k.n_turns, k.n_equal
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters: eight shifts a character."""
    shift = "xor({0} >> 1, CASE WHEN {0} & 1 = 1 THEN 3988292384 ELSE 0 END)".format("xor(c, x)")
    bits = f"flatten(list_transform(string_split({text}, ''), lambda s: [CAST(ascii(s) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, x: {shift}), 4294967295)"


OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
e AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
f AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
           list_concat(w[1:a], list_transform(range(0, n - a), lambda k: w[a + k % (1 + (n - a) // (3 + g % 8)) + 1])) END AS w
  FROM e),
tri AS (
  SELECT r, n, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT r, n, w, unnest(range(1, n - 1)) AS i FROM f)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM tri x JOIN tri y ON x.r = y.r AND x.t = y.t AND y.i > x.i WHERE 4 * (y.i - x.i) <= x.n),
isles AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM pairs),
periodic AS (
  SELECT r, q, min(i) - 1 AS start, count(*) + 2 + q AS length FROM isles GROUP BY r, q, isle
  HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM periodic GROUP BY r, start, length),
top AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
         arg_min({{'s': start, 'l': length, 'q': period}}, {{'l': -length, 's': start, 'q': period}}) AS t
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period + 1, start + length + 1)) AS i FROM runs),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, n + 1)) AS i FROM f),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.t.s AS start, top.t.l AS length, top.t.q AS period,
       1000 * top.t.l // top.t.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM f LEFT JOIN top USING (r) LEFT JOIN kept USING (r)
"""

OP13_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM k)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE '' END AS fault
  FROM o),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
-- The state is the last role's initial. Up to two insertions go before each row and after the last one.
follow(q, z) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
name(z, role) AS (VALUES ('u', 'user'), ('a', 'assistant')),
ins AS (
  SELECT q, q AS z, 0 AS cost, '' AS audit, '' AS lines FROM follow
  UNION ALL SELECT q, z, 5, 'I', role || ':' || chr(10) FROM follow JOIN name USING (z)
  UNION ALL SELECT x.q, y.z, 10, 'II', n1.role || ':' || chr(10) || n2.role || ':' || chr(10)
  FROM follow x JOIN follow y ON y.q = x.z JOIN name n1 ON n1.z = x.z JOIN name n2 ON n2.z = y.z),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS q, lpad('0', 12, '0') AS best, '' AS lines FROM facts
  UNION ALL
  SELECT conv_id, i, q, min(best), arg_min(lines, best) FROM (
    SELECT w.conv_id, f.i, e.q, lpad(CAST(CAST(left(w.best, 12) AS BIGINT) + ins.cost + e.cost AS VARCHAR), 12, '0')
             || substr(w.best, 13) || ins.audit || e.letter AS best,
           w.lines || ins.lines || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10) ELSE n.role || ':' || f.text || chr(10) END AS lines
    FROM ways w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN ins ON ins.q = w.q JOIN follow ON follow.q = ins.z JOIN name n ON n.z = follow.z,
    LATERAL (SELECT * FROM (VALUES ('D', 2, ins.z, true), ('R', 1 + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, follow.z, fault NOT IN ('blank', 'duplicate')),
      ('K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, f.c, fault NOT IN ('blank', 'duplicate') AND (f.c = follow.z OR (f.c = 's' AND ins.z = '')))) v(letter, cost, q, ok) WHERE ok) e)
  GROUP BY conv_id, i, q),
done AS (
  SELECT conv_id, min(lpad(CAST(CAST(left(best, 12) AS BIGINT) + ins.cost AS VARCHAR), 12, '0') || substr(best, 13) || ins.audit) AS best,
         arg_min(w.lines || ins.lines, lpad(CAST(CAST(left(best, 12) AS BIGINT) + ins.cost AS VARCHAR), 12, '0') || substr(best, 13) || ins.audit) AS lines
  FROM ways w JOIN facts USING (conv_id) JOIN ins ON ins.q = w.q WHERE w.i = n AND ins.z IN ('', 'a') GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 12) AS BIGINT), 0) AS cost,
       coalesce(substr(best, 13), '') AS audit, sha256(CASE WHEN coalesce(lines, '') = '' THEN '' ELSE left(lines, length(lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql():
    return {
        "op1_mixing": OP1_SQL,
        "op2_recompression": OP2_SQL,
        "op3_quality_rules": OP3_SQL,
        "op5_jaccard_join": OP5_SQL,
        "op7_exact_dedup": OP7_SQL,
        "op9_chat": OP9_SQL,
        "op12_periodic_runs": OP12_SQL,
        "op13_structure_repair": OP13_SQL,
    }
