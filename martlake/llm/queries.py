"""The queries of this package and, where DuckDB can repeat them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import (
    bpe_codec, chat_template, common, exact_dedup, fill_middle, fingerprints, licenses, mixing, packing, quality_classifier,
    secrets, simhash_dedup, token_counts, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op8_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY norm) AS keep_id,
       COUNT(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = MIN(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""")
def op8_exact_dedup(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return exact_dedup.exact_duplicates(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("sha").alias("text_sha256"))


@query("op10_simhash_golay")
def op10_simhash_golay(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return simhash_dedup.near_duplicates(docs).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    path = common.tokenizer_path(token_counts.MODEL)
    return token_counts.token_counts(docs, path).withColumnRenamed("id", "doc_id")


@query("op3_bin_slack_packing")
def op3_bin_slack_packing(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return packing.pack(docs, common.tokenizer_path(packing.VOCABULARY), common.tokenizer_path(packing.RANKS))


@query("op7_pareto_mixing", r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size,
         (('0x' || substr(md5(concat_ws(':', '42', doc_id::VARCHAR, coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE
          + 0.5) / 281474976710656.0 AS u
  FROM documents),
d2 AS (SELECT *, length(bin(size)) AS g FROM d),
s1 AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d2 GROUP BY source),
s2 AS (SELECT *, [5.0, 2.0, 1.0][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS w,
              source_size * 2.0::DOUBLE AS cap, (SUM(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s1),
s3 AS (SELECT *, (total - coalesce(SUM(cap) OVER (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / SUM(w) OVER (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT arg_min(level, cap / w) FILTER (level * w <= cap) AS common FROM s3),
s AS (SELECT source, source_size, CASE WHEN common IS NULL THEN cap ELSE least(cap, common * w) END AS target
      FROM s3, s4),
c1 AS (SELECT source, g, SUM(size)::BIGINT AS words FROM d2 GROUP BY source, g),
c2 AS (SELECT c1.*, s.source_size, s.target,
              coalesce(SUM(words) OVER (PARTITION BY c1.source ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
              SUM(g * words) OVER (PARTITION BY c1.source ORDER BY g DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mass
       FROM c1 JOIN s ON c1.source IS NOT DISTINCT FROM s.source),
c3 AS (SELECT *, CASE WHEN mass > 0 THEN (target - above::DOUBLE * 2.0::DOUBLE) / mass::DOUBLE END AS f FROM c2),
c4 AS (SELECT *, arg_max(f, g) FILTER (f * g::DOUBLE <= 2.0) OVER (PARTITION BY source) AS factor FROM c3),
c5 AS (SELECT *, CASE WHEN factor IS NULL THEN 2.0::DOUBLE ELSE least(2.0::DOUBLE, factor * g::DOUBLE) END AS copies FROM c4),
c AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p,
             target - (SUM(floor(copies)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS rest FROM c5),
r AS (SELECT d2.doc_id, d2.size, d2.source, c.source_size, c.target, c.whole, c.rest,
             CASE WHEN p > 0 AND size > 0 THEN (u / (1.0::DOUBLE - u)) * ((1.0::DOUBLE - p) / p) END AS q
      FROM d2 JOIN c ON d2.source IS NOT DISTINCT FROM c.source AND d2.g = c.g),
k AS (SELECT *, q IS NOT NULL AND 2 * coalesce(SUM(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size <= 2 * rest AS picked FROM r)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN size > 0 THEN (whole + picked::BIGINT) * size ELSE 0 END)::BIGINT AS taken FROM k""")
def op7_pareto_mixing(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return (mixing.mix_counts(docs).withColumnRenamed("id", "doc_id")
            .select("doc_id", "size", "source_size", "target", "taken"))


@query("op6_quality_mil")
def op6_quality_mil(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    labels = common.read_table(spark, sf_dir, "labels")
    return quality_classifier.quality_scores(docs, labels).withColumnRenamed("id", "doc_id")


def _tree_sql(table: str, text: str, to: str) -> str:
    """Leaves, body and root of the texts in ``table``, step by step."""
    return rf"""
{to}_1 AS (SELECT *, regexp_extract_all({text}, '{fingerprints.LEAF_PATTERN}') AS {to}_blocks FROM {table}),
{to}_2 AS (SELECT *, list_transform({to}_blocks, lambda b: substr(md5(b), 1, 16) || '.' || length(b)) AS {to}_leaves,
                  array_to_string(list_transform({to}_blocks, lambda b: substr(md5(b), 1, 16) || '.' || length(b) ||
                    CASE WHEN ends_with(b, chr(10)) THEN ';' ELSE ',' END), '') AS {to}_flat FROM {to}_1),
{to}_3 AS (SELECT *, array_to_string(list_transform(regexp_extract_all({to}_flat, '[^;]+;?'), lambda p: p ||
                    CASE WHEN starts_with(p, substr(md5(chr(10)), 1, 16) || '.1;')
                           OR substr(md5(p), 1, 1) IN ('0', '1') THEN '/' ELSE '' END), '') AS {to}_body FROM {to}_2),
{to}_4 AS (SELECT *, sha256(array_to_string(list_transform(regexp_extract_all({to}_body, '[^/]+/?'),
                    lambda s: substr(md5(array_to_string(list_transform(regexp_extract_all(s, '[^;]+;?/?'),
                      lambda p: substr(md5(p), 1, 16)), '')), 1, 16)), '')) || '|' || {to}_body AS {to} FROM {to}_3)"""


def _near_sql(a: str, b: str) -> str:
    def length(leaves):
        return (f"list_sum(list_transform({leaves}, lambda x: split_part(x, '.', 2)::BIGINT))")
    return (f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE"
            f" (2 * coalesce({length(f'list_intersect({a}_leaves, {b}_leaves)')}, 0))::DOUBLE"
            f" / (coalesce({length(f'list_distinct({a}_leaves)')}, 0)"
            f" + coalesce({length(f'list_distinct({b}_leaves)')}, 0))::DOUBLE END")


@query("op1_merkle_fingerprints", f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
{_tree_sql('t', 'text', 'fp')},
u AS (SELECT doc_id, text, n, fp, fp_leaves,
             coalesce(LEAD(text) OVER w, FIRST(text) OVER (ORDER BY doc_id)) AS next_text,
             coalesce(LEAD(fp) OVER w, FIRST(fp) OVER (ORDER BY doc_id)) AS nx,
             coalesce(LEAD(fp_leaves) OVER w, FIRST(fp_leaves) OVER (ORDER BY doc_id)) AS nx_leaves
      FROM fp_4 WINDOW w AS (ORDER BY doc_id)),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) AS edited FROM u),
{_tree_sql('e', 'edited', 'ed')}
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, ed AS edited_fingerprint,
       {_near_sql('fp', 'ed')} AS near_edited, {_near_sql('fp', 'nx')} AS near_next FROM ed_4""")
def op1_merkle_fingerprints(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return fingerprints.edited_fingerprints(docs).select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _hits_sql() -> str:
    """Matches with the gaps before them, for every kind."""
    out = []
    for kind, (rank, role, pattern) in secrets.KINDS.items():
        p = pattern.replace("'", "''")
        values = f"regexp_extract_all(text, '{p}', 2)" if kind == "assign" else "[]::VARCHAR[]"
        out.append(f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, '{role}' AS role,"
                   f" string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS ms,"
                   f" {values} AS vs FROM d WHERE regexp_matches(text, '{p}')")
    return "\n  UNION ALL ".join(out)


@query("op2_credential_links", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
h AS ({_hits_sql()}),
m AS (SELECT doc_id, kind, rank, role, i, length(gaps[i]) AS gap, ms[i] AS m, vs[i] AS v
      FROM h, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS i)),
p AS (SELECT *, SUM(gap + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS e FROM m),
s AS (SELECT doc_id, kind, rank, role, e - length(m) AS b, e FROM p
      WHERE CASE kind WHEN 'assign' THEN length(v) >= 6
                      WHEN 'weak' THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') ELSE true END),
j AS (SELECT w.doc_id, w.kind, w.rank, w.role, w.b, w.e,
             bool_or((o.e <= w.b OR o.b >= w.e) AND o.role = 'identifier') AS ident,
             bool_or((o.e <= w.b OR o.b >= w.e) AND o.role = 'secret') AS secret,
             bool_or(NOT (o.e <= w.b OR o.b >= w.e) AND o.rank <= 3) AS known
      FROM s w JOIN s o ON w.doc_id = o.doc_id AND o.e > w.b - {secrets.SCOPE} AND o.b < w.e + {secrets.SCOPE}
      WHERE w.rank > 3 GROUP BY ALL),
a AS (SELECT doc_id, kind, rank, b, e FROM s WHERE rank <= 3
      UNION ALL SELECT doc_id, kind, rank, b, e FROM j
      WHERE NOT known AND (role = 'secret' OR secret) AND (role = 'identifier' OR ident)),
g AS (SELECT doc_id, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access,
             COUNT(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (rank <= 3) AS base,
             string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans FROM a GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)""")
def op2_credential_links(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.STRONG))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in secrets.STRONG]
    return secrets.secret_spans(docs).select(
        F.col("id").alias("doc_id"), *counts, F.sha2(secrets.written_spans(base), 256).alias("base_sha256"),
        secrets.written_spans(F.col("spans")).alias("spans"))


@query("op9_chat_template")
def op9_chat_template(spark, sf_dir):
    turns = common.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    return (chat_template.formatted_digests(turns.unionByName(extra))
            .withColumnRenamed("conv", "conv_id"))


def _license_sql() -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'"
    rows, unknown = licenses.template_vectors()
    vectors = ", ".join(f"({lit(t)}, {i!r}::DOUBLE, {k}, {lit(n)}, {w!r}::DOUBLE)" for t, i, k, n, w in rows)
    return f"""
WITH v(term, idf, template, license, weight) AS (VALUES {vectors}),
f AS (SELECT doc_id, coalesce(text, '') AS text, {licenses.DOC_PATH_SQL} AS path FROM documents),
c AS (SELECT doc_id, i AS n, lines[i] AS body
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM f), LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)
      WHERE regexp_matches(lines[i], {lit(licenses.MARKERS)})),
t AS (SELECT doc_id, n, term, COUNT(*) AS tf
      FROM (SELECT doc_id, n, unnest(regexp_extract_all(lower(body), {lit(licenses.TERM)})) AS term FROM c) GROUP BY ALL),
x AS (SELECT t.*, tf * coalesce(i.idf, {unknown!r}::DOUBLE) AS x FROM t LEFT JOIN (SELECT DISTINCT term, idf FROM v) i USING (term)),
nm AS (SELECT doc_id, n, sqrt(SUM(x * x)) AS norm, SUM(tf) AS words FROM x GROUP BY ALL),
dt AS (SELECT doc_id, n, template, license, SUM(x * weight) AS dot FROM x JOIN v USING (term) GROUP BY ALL),
sc AS (SELECT doc_id, n, words, license, round(dot / norm, 6) AS s FROM dt JOIN nm USING (doc_id, n)),
b AS (SELECT * FROM sc QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id, n ORDER BY s DESC, license) = 1),
o AS (SELECT doc_id, arg_min(license, struct_pack(s := -s, l := license)) AS own, MAX(s) AS os, SUM(words) AS w, COUNT(*) AS nh
      FROM b WHERE s >= {licenses.LEAST} GROUP BY doc_id),
r AS (SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, own, os, w, nh,
             len(regexp_extract_all(lower(text), {lit(licenses.TERM)})) AS nt FROM f LEFT JOIN o USING (doc_id)),
sp AS (SELECT dir AS anc, arg_min(own, struct_pack(s := -os, l := own)) AS license, MAX(os) AS s
       FROM r WHERE own IS NOT NULL AND w >= {licenses.FILE_SHARE} * nt GROUP BY dir),
ds AS (SELECT dir, i AS depth, array_to_string(string_split(dir, '/')[1:i], '/') AS anc
       FROM (SELECT DISTINCT dir FROM r), LATERAL (SELECT unnest(range(0, len(string_split(dir, '/')) + 1)) AS i)),
ne AS (SELECT dir, depth, anc, license, s FROM ds JOIN sp USING (anc)
       QUALIFY ROW_NUMBER() OVER (PARTITION BY dir ORDER BY depth DESC, anc DESC) = 1)
SELECT doc_id, path, coalesce(own, license) AS license, coalesce(os, s) AS similarity,
       CASE WHEN own IS NOT NULL THEN 'own' WHEN license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own IS NULL AND license IS NOT NULL THEN anc END AS directory, coalesce(nh, 0) AS n_headers
FROM r LEFT JOIN ne USING (dir)"""


@query("op5_license_scan", _license_sql())
def op5_license_scan(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    files = docs.select("doc_id", "text", F.expr(licenses.DOC_PATH).alias("path"))
    return licenses.scan(files, "doc_id", "path").withColumnRenamed("id", "doc_id")


@query("op11_bpe_codec")
def op11_bpe_codec(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    path = common.tokenizer_path(bpe_codec.VOCABULARY)
    encoded = bpe_codec.encode(docs, path).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return bpe_codec.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


@query("op12_fill_in_middle", r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
c AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS prefix,
         array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p""")
def op12_fill_in_middle(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents")
    return fill_middle.restored_texts(fill_middle.fill_in_middle(docs)).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, sf_dir):
    """``deviation`` is null where it is beyond a long."""
    vectors = common.read_table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors).select(
        F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "whitened", "explained", "identity_error")
