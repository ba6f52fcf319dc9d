"""Registered queries of the corpus operators, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from finecast.llm import (
    byte_bpe, chat, decontaminate, exact_dedup, fill_middle, html_extract, mixing, ngram_join, product_codes, quality, secrets_scan, suffix_dedup,
    url_filter,
)
from finecast.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RULE = """CASE WHEN (h = 'example.com' OR ends_with(h, '.example.com')) AND starts_with(p, '/de/') THEN 'example.com/de/'
  WHEN (h = 'example.net' OR ends_with(h, '.example.net')) AND starts_with(p, '/en/') THEN 'example.net/en/'
  WHEN (h = 'org' OR ends_with(h, '.org')) AND starts_with(p, '/fr/') THEN 'org/fr/'
  WHEN (h = 'net' OR ends_with(h, '.net')) AND starts_with(p, '/') THEN 'net/' END"""

# An address without a rule takes its verdict from the addresses that settle on the same one.
OP1_SQL = rf"""
WITH base AS (
  SELECT page_id, url, {_LOWER.format("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} AS h,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS p,
         regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref)(=[^&]*)?', '', 'g'), '^&', '') AS q
  FROM pages),
ruled AS (
  SELECT *, {_RULE} AS rule FROM base),
nodes AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own,
         'https://' || regexp_replace(h, '^(www|m)\.', '') || regexp_replace(p, '(\.html|/)$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS settled
  FROM ruled),
ends AS (
  SELECT settled, own FROM nodes WHERE url IS NOT NULL
  UNION ALL
  SELECT settled, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END
  FROM (SELECT settled, {_RULE} AS rule FROM (
    SELECT DISTINCT settled, regexp_extract(settled, '://([^/?#]*)', 1) AS h, regexp_extract(settled, '://[^/?#]*([^?#]*)', 1) AS p FROM nodes))),
groups AS (SELECT settled, bool_or(own = 'allow') AS allowed, bool_or(own = 'block') AS blocked FROM ends GROUP BY settled)
SELECT n.page_id, n.h AS host, n.p AS path, n.rule,
       CASE WHEN n.own IS NOT NULL THEN n.own WHEN g.blocked AND NOT coalesce(g.allowed, false) THEN 'block' ELSE 'allow' END AS verdict
FROM nodes n LEFT JOIN groups g ON n.settled = g.settled AND n.url IS NOT NULL
"""


@_query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url under the rules, aliases included."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(doc_id::VARCHAR || ':17') AS o FROM documents),
sliced AS (SELECT *, ('0x' || substr(o, 5, 4))::BIGINT AS s FROM sized),
totals AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM totals),
ratios AS (SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM weighted),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM ratios WINDOW b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)), cap) AS target FROM levels),
ranked AS (
  SELECT d.*, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.s, d.o ROWS UNBOUNDED PRECEDING) AS upto
  FROM sliced d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN target - whole * source_size > 0 AND 2 * upto - size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""


@_query("op2_source_mix", OP2_SQL)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM places p JOIN grams g USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query("op4_decontamination", OP4_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS c, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t ORDER BY c DESC, doc_id)
"""


@_query("op5_exact_dedup", OP5_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups over all documents."""
    return exact_dedup.exact_report(table(spark, sf_dir, "documents"))


@_query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets_scan.secrets_report(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
           + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@_query("op6_chat_format", OP6_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks in control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoken = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "CASE WHEN id = 0 THEN 'user' ELSE 'assistant' END AS role", f"'{said}' AS text")
    return chat.chat_report(turns.unionByName(spoken))


@_query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; fitted on the labels that are not held out."""
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 100 bytes that start earlier."""
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


OP9_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, least(3, len(w)) AS n, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes m ON m.doc_id = x JOIN sizes n ON n.doc_id = y WHERE 100 * c >= 90 * (m.n + n.n - c)),
reach AS (
  SELECT doc_id, doc_id AS to_id FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.to_id)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, d.component_id
FROM (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN sizes z USING (doc_id)
"""


@_query("op9_ngram_join", OP9_SQL)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word sets are alike."""
    return ngram_join.join_report(table(spark, sf_dir, "documents"))


@_query("op7_html_extract")
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.html_report(table(spark, sf_dir, "pages"))


# The four draws of a document, its cuts and its form; tokens are joined back from a list.
OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS c2,
         ('0x' || h[17:24])::BIGINT % 100 AS c3, ('0x' || h[25:32])::BIGINT % 100 AS c4 FROM t),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 90 THEN 'plain'
                 WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(w[1:least(c1, c2)], ''), '') AS p,
         coalesce(array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
         coalesce(array_to_string(w[greatest(c1, c2) + 1:n], ''), '') AS s FROM d)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


@_query("op11_fill_middle", OP11_SQL)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for infilling, and rebuilt."""
    return fill_middle.fill_middle_report(table(spark, sf_dir, "documents"))


def _op13_sql(rounds: int = 4) -> str:
    """Every round in full: all parts against all entries."""
    near = """near{k} AS MATERIALIZED (
  SELECT r, p, min({{d: d, e: e}}) AS b
  FROM (SELECT x.r, x.p, c.e, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN book{k} c USING (p, i) GROUP BY ALL) GROUP BY ALL)"""
    book = """book{n} AS MATERIALIZED (
  SELECT c.p, c.e, c.i, coalesce(m.v, c.v) AS v
  FROM book{k} c LEFT JOIN (
    SELECT n.p, n.b.e AS e, x.i, (sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS v
    FROM near{k} n JOIN x USING (r, p) GROUP BY ALL) m USING (p, e, i))"""
    steps = [f"{near.format(k=k)}, {book.format(k=k, n=k + 1)}" for k in range(rounds)] + [near.format(k=rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, *
  FROM (SELECT vec_id, label, list_transform(embedding, lambda f: floor(1024 * f::DOUBLE)::BIGINT) AS v FROM documents_of_vectors)),
x AS MATERIALIZED (
  SELECT r, (j - 1) // (len // 4) AS p, (j - 1) % (len // 4) AS i, v
  FROM (SELECT r, len(v) AS len, unnest(v) AS v, unnest(range(1, len(v) + 1)) AS j FROM kept)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, v FROM x WHERE r <= 256),
{", ".join(steps)},
coded AS (
  SELECT r, string_agg(lpad(lower(to_hex(b.e::BIGINT)), 2, '0'), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
""".replace("documents_of_vectors", "embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda f: f IS NULL OR NOT isfinite(f))) = 0")


@_query("op13_product_codes", _op13_sql())
def op13_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors."""
    return product_codes.codes_report(table(spark, sf_dir, "embeddings"))


@_query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they stand for."""
    vocabulary = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.bpe_report(table(spark, sf_dir, "documents"), vocabulary)
