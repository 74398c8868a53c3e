"""Registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op10_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.sentencepiece_bpe import encode_digests

    return encode_digests(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.language_id import identify

    return identify(documents(spark, sf_dir))


@register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from hirelake.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op2_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


@register
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.mixing import mix

    return mix(documents(spark, sf_dir))


ORACLE["op1_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::BIGINT AS weight
  FROM d GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () - (sum(3 * source_size) OVER o - 3 * source_size) AS rest,
         sum(weight) OVER () - (sum(weight) OVER o - weight) AS weight_rest
  FROM s WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, cap * weight_rest <= rest * weight AS clamped FROM w),
u AS (SELECT rest AS open_rest, weight_rest AS open_weight FROM c WHERE NOT clamped
      ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE (weight * open_rest)::DOUBLE / open_weight::DOUBLE END AS target
  FROM c LEFT JOIN u ON true),
p AS (
  SELECT *, floor(target + 0.5)::BIGINT AS want,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // greatest(source_size, 1) ELSE 0 END AS whole
  FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.want - p.whole * p.source_size AS part,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
e AS (SELECT *, least(greatest(part - before, 0), size) AS extra FROM r)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (whole * size + extra)::BIGINT AS taken,
       (whole + CASE WHEN extra = size AND (size > 0 AND part - before > 0) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM e
"""


@register
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.personal_data import digests

    return digests(documents(spark, sf_dir))


@register
def op9_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.sharding import shard

    return shard(documents(spark, sf_dir))


_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"[0-9]+(?:-[0-9]+)+",
}
_CONFIRM = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR (len(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0",
    "card": """len(g) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, len(g)), lambda i: CASE
        WHEN i % 2 = 0 THEN ascii(g[len(g) - i]) - 48 WHEN ascii(g[len(g) - i]) - 48 > 4 THEN 2 * (ascii(g[len(g) - i]) - 48) - 9
        ELSE 2 * (ascii(g[len(g) - i]) - 48) END)) % 10 = 0""",
    "phone": "len(g) BETWEEN 9 AND 15",
    "iban": """len(a) = coalesce(list_extract(map_extract(MAP {%s}, a[1:2]), 1), 0) AND
        list_reduce(list_prepend(0, list_transform(string_split(a[5:] || a[1:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)),
                    lambda x, y: (x * CASE WHEN y > 9 THEN 100 ELSE 10 END + y) % 97) = 1""",
    "ssn": """regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND m NOT SIMILAR TO '(000|666|9[0-9]{2})-.*|.*-00-.*|.*-0000'
        AND regexp_matches(lower(text[greatest(1, s - 39):s]), '\b(?:ssn|social security)')""",
}


def _iban_sql() -> str:
    """Account numbers by country, each of its own length."""
    from hirelake.llm.personal_data import IBAN_LENGTHS

    form = r"{}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{}}}{}"
    return r"\b(?:" + "|".join(form.format(c, n // 4 - 1, rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for c, n in IBAN_LENGTHS.items()) + r")\b"


def _personal_data_sql() -> str:
    """Matches and the pieces between them alternate, as in the operator; rows are spans instead of arrays.

    An underscore does not belong to an account number but would to a word of ``\\b``, so there it is read as a dot.
    """
    from hirelake.llm.personal_data import IBAN_LENGTHS

    confirm = _CONFIRM | {"iban": _CONFIRM["iban"].replace("%s", ", ".join(f"'{k}': {v}" for k, v in IBAN_LENGTHS.items()))}
    base = {k: _BASE[k] for k in ("email", "ip", "card", "phone")}
    parts = []
    for k, (kind, pattern) in enumerate((base | {"iban": _iban_sql(), "ssn": _BASE["ssn"]}).items()):
        text = "replace(text, '_', '.')" if kind == "iban" else "text"
        parts.append(f"""
  SELECT r, {k} AS k, '{kind}' AS kind, s, s + len(m) AS e FROM (
    SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS g, replace(m, ' ', '') AS a FROM (
      SELECT r, text, ms[i] AS m, (len(array_to_string(ps[1:i], '')) + len(array_to_string(ms[1:i - 1], '')))::BIGINT AS s FROM (
        SELECT r, text, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT r, text, regexp_extract_all({text}, '{pattern}') AS ms, regexp_split_to_array({text}, '{pattern}') AS ps
          FROM d WHERE regexp_matches({text}, '{pattern}'))))) WHERE {confirm[kind]}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(parts)}),
g AS (SELECT r, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card,
        count(*) FILTER (k = 3) AS n_phone, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""


ORACLE["op8_personal_data"] = _personal_data_sql()


@register
def op6_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.near_duplicates import near_duplicates

    return near_duplicates(documents(spark, sf_dir), width=3, percent=85)


ORACLE["op6_bottom_k_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh
  FROM d),
e AS (SELECT r, doc_id, len(sh) AS n, unnest(sh) AS x FROM s WHERE doc_id IS NOT NULL),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.r < b.r
  GROUP BY a.r, b.r, a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
c AS (SELECT doc_id, doc_id AS reach FROM d WHERE doc_id IS NOT NULL
      UNION SELECT c.doc_id, l.b FROM c JOIN l ON c.reach = l.a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, m.component_id, coalesce(m.component_id = s.doc_id, true) AS kept
FROM s LEFT JOIN (SELECT doc_id, min(reach) AS component_id FROM c GROUP BY doc_id) m ON s.doc_id = m.doc_id
"""


@register
def op5_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.multi_index import search

    return search(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@register
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.license_scan import scan

    return scan(documents(spark, sf_dir))


@register
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.divergence import audit

    return audit(documents(spark, sf_dir))


ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(k.term) AS v, coalesce(sum(k.n), 0)::HUGEINT AS words
      FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
g AS (SELECT x.lang, x.source, l.v, coalesce(any_value(s.words), 0)::HUGEINT AS words
      FROM (SELECT DISTINCT lang, source FROM d) x JOIN l USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS words FROM c GROUP BY ALL) s ON s.lang = x.lang AND s.source = x.source GROUP BY ALL),
p AS (  -- every group prices every kept term
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.words + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (l.words + 2 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
v AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM o
QUALIFY part = 'pair' OR rank <= 10
"""


@register
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelake.llm.fill_in_middle import digests

    return digests(documents(spark, sf_dir))


ORACLE["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT % (len(u) + 1) AS i, ('0x' || x[9:16])::BIGINT % (len(u) + 1) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || x[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || x[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, array_to_string(u[1:least(i, j)], '') AS pre, array_to_string(u[least(i, j) + 1:greatest(i, j)], '') AS mid,
         array_to_string(u[greatest(i, j) + 1:], '') AS suf
  FROM h),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output
  FROM c),
b AS (
  SELECT *, CASE form WHEN 'plain' THEN [output] ELSE string_split(replace(replace(output[4:], '<S>', '<M>'), '<P>', '<M>'), '<M>') END AS parts
  FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN parts[1] WHEN 'psm' THEN parts[1] || parts[3] || parts[2] ELSE parts[2] || parts[3] || parts[1] END) AS restored_sha256
FROM b
"""


@register
def op13_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from hirelake.llm.byte_bpe import encode_digests

    return encode_digests(documents(spark, sf_dir), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
