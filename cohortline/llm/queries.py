"""Registered queries of the training-data operators: ``opN_<name>`` applies operator N,
with production parameters, to its whole table. ORACLE has DuckDB SQL where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import (bpe, chosen_path, exact_dedup, fill_middle, license_scan, mixing, pii, quality_pu,
                            sentence_pieces, sharding, suffix_repetition, url_templates, vector_codes)
from cohortline.llm.common import saved, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_repetition.rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat")


@query("op10_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, VOCABULARY).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    spellings = "folded"
    for pattern, replacement in (*license_scan.NOTICE_ENDS, (license_scan.COPYRIGHT_LINE, " "), *license_scan.SPELLINGS):
        spellings = f"regexp_replace({spellings}, {q(pattern)}, {q(replacement)}, 'g')"
    known = ", ".join(f"({q(a)}, {q(b)})" for a, b in license_scan.KNOWN)

    def canonical(source: str, columns: str) -> str:
        return f"""SELECT {columns}, trim(regexp_replace({spellings}, {q(license_scan.SEPARATORS)}, ' ', 'g')) AS form
            FROM (SELECT *, translate(unit, '{license_scan.UPPER}', '{license_scan.LOWER}') AS folded FROM {source})"""

    return f"""
        WITH known AS (SELECT * FROM (VALUES {known}) v(licence, unit)),
        known_forms AS (SELECT DISTINCT licence, sha256(form) AS digest FROM ({canonical("known", "licence")})),
        parts AS (
            SELECT DISTINCT doc_id, whole, unit FROM (
                SELECT doc_id, whole, unnest(list_concat([whole], string_split_regex(whole, '\n[ \\t\\r]*\n'),
                                                         string_split(whole, chr(10)))) AS unit
                FROM (SELECT doc_id, coalesce(text, '') AS whole FROM documents))),
        forms AS (SELECT doc_id, is_whole, sha256(form) AS digest
                  FROM ({canonical("(SELECT *, unit = whole AS is_whole FROM parts)", "doc_id, is_whole")}) WHERE form <> ''),
        found AS (
            SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
                   count(DISTINCT digest) AS n_matches,
                   string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (is_whole) AS whole_licences
            FROM forms JOIN known_forms USING (digest) GROUP BY doc_id)
        SELECT d.doc_id, licences, coalesce(n_matches, 0) AS n_matches, whole_licences
        FROM documents d LEFT JOIN found USING (doc_id)"""


@query("op2_license_scan", _license_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known_texts(spark))


SHARDS = 8


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32"))
    return sharding.interleave(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@query("op5_source_mix", f"""
    WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    means AS (
        SELECT source, pow(n::DOUBLE, {mixing.TEMPERATURE}) / (SELECT sum(pow(n::DOUBLE, {mixing.TEMPERATURE})) FROM counts)
                       * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
    steps AS (SELECT source, ceil(rate / {mixing.STEP})::BIGINT AS steps, rate / ceil(rate / {mixing.STEP}) AS mu FROM means),
    cdf(source, mu, k, t, c) AS (
        SELECT source, mu, 0, exp(-mu), exp(-mu) FROM steps
        UNION ALL
        SELECT source, mu, k + 1, t * mu / (k + 1), c + t * mu / (k + 1) FROM cdf WHERE k < ceil(mu + 12 * sqrt(mu) + 30)),
    draws AS (
        SELECT d.doc_id, j,
               ('0x' || substr(md5('{mixing.SEED}:' || doc_id || ':' || j), 1, 13))::BIGINT / pow(2, 52) AS u, d.source
        FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, s.steps + 1)) r(j)),
    copies AS (
        SELECT doc_id, count(*) FILTER (u >= c)::INT AS n_copies
        FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source GROUP BY doc_id)
    SELECT d.*, r.copy::INT AS copy, n_copies
    FROM documents d JOIN copies USING (doc_id), unnest(range(0, n_copies)) r(copy)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.temperature_weights(docs))


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def _joined(spans: str):
    names = F.array(*[F.lit(k) for k in (*pii.KINDS, *pii.TERM_KINDS)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op6_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality_pu.fit(docs, table(spark, sf_dir, "labels"))
    return quality_pu.score(docs, network).select(
        "doc_id", (quality_pu.fold("doc_id") == quality_pu.HELD_OUT).alias("held_out"), "score", "predicted")


@query("op11_fill_middle", r"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
               sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    drawn AS (
        SELECT doc_id, whole, units, len(units) AS n,
               ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
               ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM cut),
    formed AS (
        SELECT doc_id, whole, n, units, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>') OR contains(whole, '<M>')
                         OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    pieces AS (
        SELECT doc_id, whole, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p,
               coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:], ''), '') AS s
        FROM formed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(whole) AS restored_sha256 FROM pieces""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return fill_middle.transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query("op12_sentence_pieces")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_pieces.encode(docs, PIECE_MODEL, decoded=True).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def _vector_sql(rounds: int = 4) -> str:
    """Lists hold whole numbers as doubles, exact far beyond these sums."""
    nearest = lambda book: f"""(SELECT vec_id, p, min((xx - 2 * list_dot_product(q, b) + bb) * 256 + e)::BIGINT AS best
        FROM parts JOIN (SELECT *, list_dot_product(b, b) AS bb FROM {book}) USING (p) GROUP BY vec_id, p)"""  # noqa: E731
    steps = "".join(f""",
    near{k} AS MATERIALIZED {nearest(f"book{k}")},
    book{k + 1} AS MATERIALIZED (
        SELECT p, e, coalesce(moved, b) AS b FROM book{k} LEFT JOIN (
            SELECT p, e, list(mean ORDER BY pos) AS moved FROM (
                SELECT p, best % 256 AS e, pos, floor(sum(q[pos]) / count(*)) AS mean
                FROM near{k} JOIN parts USING (vec_id, p), unnest(range(1, len(q) + 1)) r(pos) GROUP BY ALL)
            GROUP BY p, e) USING (p, e))""" for k in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT *, list_dot_product(q, q) AS xx FROM (
            SELECT vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS q FROM kept, unnest(range(4)) r(p))),
    book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, q AS b FROM parts
        WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)){steps},
    coded AS MATERIALIZED (
        SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
        FROM {nearest(f"book{rounds}")} GROUP BY vec_id)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
           (SELECT sha256(string_agg(b[pos]::BIGINT::VARCHAR, ',' ORDER BY p, e, pos))
            FROM book{rounds}, unnest(range(1, len(b) + 1)) r(pos)) AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id)"""


@query("op13_vector_codes", _vector_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.fit(vectors)
    coded = saved(vector_codes.encode(vectors, books).select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"))
    return vector_codes.with_sums(coded, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error",
        F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))
