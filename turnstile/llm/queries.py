"""The queries of this subpackage over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstile.llm import decontamination, fim, lm_score, merkle, packing, pii, pu_quality, quality_rules, secrets, simhash, substring, token_files, url_rules
from turnstile.llm.common import read, tokenizer_file


def op9_simhash_dedup(spark, sf):
    return simhash.simhash_groups(read(spark, sf, "documents"), shingle=3, max_bits=2)


def op1_decontamination(spark, sf):
    return decontamination.find_leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


OP1_SQL = r"""
WITH texts AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'item', item_id, text FROM benchmark WHERE item_id IS NOT NULL
), numbered AS (
  SELECT kind, id, row_number() OVER () AS nr, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM texts
), words AS (
  SELECT kind, id, nr, len(w) AS n, unnest(w) AS w0, generate_subscripts(w, 1) AS i FROM numbered
), runs AS (
  SELECT kind, id, n, w0, lead(w0, 1) OVER p AS w1, lead(w0, 2) OVER p AS w2, lead(w0, 3) OVER p AS w3,
    lead(w0, 4) OVER p AS w4, i
  FROM words WINDOW p AS (PARTITION BY nr ORDER BY i)
), shingles AS (
  SELECT DISTINCT kind, id, concat_ws(' ', w0, w1, w2, w3, w4) AS s
  FROM runs WHERE w4 IS NOT NULL OR n < 5 AND i = 1
), sizes AS (
  SELECT id AS item_id, count(*) AS n_shingles FROM shingles WHERE kind = 'item' GROUP BY 1
), shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles i ON d.s = i.s AND d.kind = 'doc' AND i.kind = 'item' GROUP BY 1, 2
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= ceil(0.8 * n_shingles - 1e-9)
"""


def op2_token_files(spark, sf):
    back = token_files.round_trip(read(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return back.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_lattice_score(spark, sf):
    return lm_score.score_texts(read(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_pu_quality(spark, sf):
    docs, labels = (read(spark, sf, t) for t in ("documents", "labels"))
    return pu_quality.score_quality(docs, labels, threshold=0.3)


def op5_best_fit_packing(spark, sf):
    packed = packing.pack(read(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op6_url_rules(spark, sf):
    return url_rules.judge_urls(read(spark, sf, "pages"), url_rules.rules_table(spark, URL_RULES))


OP6_SQL = """
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), fits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""


def op7_personal_data(spark, sf):
    return pii.find_personal_data(read(spark, sf, "documents"))


def op8_substring_dedup(spark, sf):
    return substring.remove_repeated(read(spark, sf, "documents"), window=13).drop("kept")


def op10_quality_rules(spark, sf):
    docs, labels = (read(spark, sf, t) for t in ("documents", "labels"))
    return quality_rules.apply_rules(docs, labels)


def op11_merkle_manifest(spark, sf):
    found = merkle.manifest(read(spark, sf, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang", "pos")


def _listed(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op12_secret_scan(spark, sf):
    found = secrets.find_secrets(read(spark, sf, "documents"))
    counts = [_of_kind("base", k) for k in ("assign", "access", "hex")]
    base, spans = F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    return found.select("doc_id", *counts, base, spans, _of_kind("spans", "novel").alias("n_added"))


def op13_fill_in_middle(spark, sf):
    out = fim.fill_in_middle(read(spark, sf, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS hx FROM documents
), t AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS toks,
    CAST('0x' || substr(hx, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(hx, 9, 8) AS UBIGINT) AS h2,
    CAST('0x' || substr(hx, 17, 8) AS UBIGINT) AS h3, CAST('0x' || substr(hx, 25, 8) AS UBIGINT) AS h4
  FROM d
), c AS (
  SELECT doc_id, text, toks, len(toks) AS n,
    least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS k1, greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS k2,
    CASE WHEN doc_id IS NULL OR text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT *, array_to_string(toks[1:k1], '') AS prefix, array_to_string(toks[k1 + 1:k2], '') AS middle,
    array_to_string(toks[k2 + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form = 'plain' THEN NULL ELSE length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form = 'plain' THEN NULL ELSE length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


QUERIES = {q.__name__: q for q in (op1_decontamination, op2_token_files, op3_lattice_score, op4_pu_quality, op5_best_fit_packing, op6_url_rules, op7_personal_data, op8_substring_dedup, op9_simhash_dedup, op10_quality_rules, op11_merkle_manifest, op12_secret_scan, op13_fill_in_middle)}
ORACLE_SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op6_url_rules": OP6_SQL, "op13_fill_in_middle": OP13_SQL}
