"""The registered queries of the operators, each over its whole tables, and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

#: Sites on which a line counts as boilerplate.
MIN_SITES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file() -> str:
    """The tokenizer the queries use; TOKENIZER_FILE names another."""
    if found := os.environ.get("TOKENIZER_FILE"):
        return found
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_window_decontamination(spark, sf_dir):
    from .decontaminate import contaminated

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_source_mix(spark, sf_dir):
    from .mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_simhash_pigeonhole(spark, sf_dir):
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_prefix_free_suffixes(spark, sf_dir):
    from .suffix_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chunk_containment(spark, sf_dir):
    from .chunk_fingerprint import edited_neighbours

    return edited_neighbours(table(spark, sf_dir, "documents"))


def op6_rule_quality(spark, sf_dir):
    from .rule_quality import score_quality

    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_line_spread(spark, sf_dir):
    from .line_spread import remove_spread_lines

    kept = remove_spread_lines(table(spark, sf_dir, "documents"), min_sites=MIN_SITES)
    digest = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


def op8_counterfactual_toxicity(spark, sf_dir):
    from .toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_line_blocks(spark, sf_dir):
    from .html_blocks import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_token_orc(spark, sf_dir):
    from .token_orc import tokenize_to_orc

    return tokenize_to_orc(table(spark, sf_dir, "documents"), tokenizer_file())


def op11_jaccard_tiles(spark, sf_dir):
    from .jaccard_tiles import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op12_pivotal_spelling(spark, sf_dir):
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"), min_length=7, min_count=2, ratio=10)


def op13_source_divergence(spark, sf_dir):
    from .source_divergence import divergence

    return divergence(table(spark, sf_dir, "documents"), min_docs=10, top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_window_decontamination": op1_window_decontamination,
    "op2_source_mix": op2_source_mix,
    "op3_simhash_pigeonhole": op3_simhash_pigeonhole,
    "op4_prefix_free_suffixes": op4_prefix_free_suffixes,
    "op5_chunk_containment": op5_chunk_containment,
    "op6_rule_quality": op6_rule_quality,
    "op7_line_spread": op7_line_spread,
    "op8_counterfactual_toxicity": op8_counterfactual_toxicity,
    "op9_line_blocks": op9_line_blocks,
    "op10_token_orc": op10_token_orc,
    "op11_jaccard_tiles": op11_jaccard_tiles,
    "op12_pivotal_spelling": op12_pivotal_spelling,
    "op13_source_divergence": op13_source_divergence,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op1_window_decontamination": rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, w[p : p + least(10, len(w)) - 1] AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(win) AS k FROM iw),
dw AS (
  SELECT doc_id, p, k, w[p : p + k - 1] AS win
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, n WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw ON dw.win = iw.win),
words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM hit)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op2_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM r),
l AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lvl
  FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * max(lvl) OVER ()) AS target FROM l),
j AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 1.0::DOUBLE END AS rate,
         ('0x' || substr(md5(concat('17:', coalesce(d.doc_id::VARCHAR, 'null'), ':', md5(coalesce(d.text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM j""",
    "op7_line_spread": rf"""
WITH l AS (
  SELECT doc_id, source, pos, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
s AS (
  SELECT line FROM l WHERE trim(translate(line, chr(9) || chr(13), '  ')) <> ''
  GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= {MIN_SITES}),
k AS (
  SELECT doc_id, count(*) AS n_lines, count(s.line) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE s.line IS NULL) AS kept
  FROM l LEFT JOIN s ON l.line = s.line GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)""",
    "op11_jaccard_tiles": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[p : p + least(3, len(w)) - 1], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - least(3, len(w)) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * k >= 90 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(r, t) AS (SELECT r, r FROM w UNION SELECT reach.r, e.y FROM reach JOIN e ON reach.t = e.x),
c AS (SELECT reach.r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.t GROUP BY reach.r)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w JOIN c USING (r) LEFT JOIN n USING (r)""",
    "op13_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::BIGINT AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*)::BIGINT AS v, sum(total)::BIGINT AS size FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::BIGINT AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT x.lang, x.source, coalesce(max(v), 0)::BIGINT AS v, coalesce(max(v.size), 0)::BIGINT AS lang_size, coalesce(max(s.size), 0)::BIGINT AS size
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS size FROM c GROUP BY lang, source) s ON s.lang = x.lang AND s.source = x.source
  GROUP BY x.lang, x.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.size + 2 * g.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.total + 2) // (g.lang_size + 2 * g.v))::BIGINT AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 10""",
}
