"""Registered queries: one per operator of the inventory, each over the driver's
tables (through the fixture views), each paired with DuckDB SQL where SQL can say it.

Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions import codes as code_fns
from cohortline.functions.icd import add_dot, icd_diagnosis_dot, icd_procedure_dot
from cohortline.functions.times import parse_time
from cohortline.operators import audit as audit_ops
from cohortline.operators import cohort as cohort_ops
from cohortline.operators import links as link_ops
from cohortline.operators import metadata as meta_ops
from cohortline.operators import order as order_ops
from cohortline.operators import prepare as prep_ops
from cohortline.operators import subjects as subject_ops
from cohortline.operators.events import EventRows, event_rows, extract_events
from cohortline.operators.joins import union_all
from cohortline.plans import etl
from cohortline.plans import oracle as O
from cohortline.plans.event_spec import EVENTS
from cohortline.schemas import EVENT_COLUMNS, RAW, SPLITS_SCHEMA
from cohortline.session import ensure_conf, scratch_dir
from cohortline.sources import fixtures as fx
from cohortline.sources.inference import conflicts, file_kinds, typed
from cohortline.sources.readers import discover_prefixes, read_csv, read_table, resolve_prefix
from cohortline.sources.sinks import land, write_cohort, write_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = sql
        return wrapped
    return register


# ---------------------------------------------------------------- shared pieces

SUBJECT_TABLES = ["admissions", "patients", "diagnoses_icd", "labevents", "inputevents", "omr"]
ALL_COLUMNS = [n for n, _ in EVENT_COLUMNS]


def _prepared_patients(spark, d):
    return prep_ops.fix_static(fx.patients(spark, d), fx.admissions(spark, d))


def _prepared_diagnoses(spark, d):
    return prep_ops.add_discharge_time(fx.diagnoses_icd(spark, d), fx.admissions(spark, d))


def _table_events(spark, d, columns=None) -> dict[str, DataFrame]:
    """Events of every fixture table, each from one scan of its (prepared) table."""
    return {
        "hosp/admissions": extract_events(fx.admissions(spark, d), EVENTS["hosp/admissions"], columns),
        "hosp/diagnoses_icd": extract_events(_prepared_diagnoses(spark, d), EVENTS["hosp/diagnoses_icd"], columns),
        "hosp/labevents": extract_events(fx.labevents(spark, d), EVENTS["hosp/labevents"], columns),
        "hosp/patients": extract_events(_prepared_patients(spark, d), EVENTS["hosp/patients"], columns),
        "icu/inputevents": extract_events(fx.inputevents(spark, d), EVENTS["icu/inputevents"], columns),
        "hosp/omr": extract_events(fx.omr(spark, d), EVENTS["hosp/omr"], columns),
    }


def _cohort_events(spark, d) -> DataFrame:
    return cohort_ops.union_events(list(_table_events(spark, d).values()))


def _cohort_rows(spark, d) -> list[EventRows]:
    """What the events of every fixture table are made of."""
    tables = {
        "hosp/admissions": fx.admissions(spark, d), "hosp/diagnoses_icd": _prepared_diagnoses(spark, d),
        "hosp/labevents": fx.labevents(spark, d), "hosp/patients": _prepared_patients(spark, d),
        "icu/inputevents": fx.inputevents(spark, d), "hosp/omr": fx.omr(spark, d)}
    return [event_rows(df, EVENTS[p]) for p, df in tables.items()]


def _cohort_codes(spark, d) -> DataFrame:
    """Distinct codes of every table, deduplicated per table before the union."""
    frames = [meta_ops.observed_codes(e) for e in _table_events(spark, d, ["code"]).values()]
    return meta_ops.observed_codes(union_all(frames))


def _subjects(spark, d) -> DataFrame:
    frames = [fx.RAW_FIXTURES[p](spark, d) for p in
              ("hosp/admissions", "hosp/patients", "hosp/diagnoses_icd", "hosp/labevents", "icu/inputevents",
               "hosp/omr")]
    return subject_ops.distinct_subjects(frames)


def _shards(spark, d, keep_rank=False) -> DataFrame:
    return subject_ops.assign_shards(_subjects(spark, d), keep_rank=keep_rank)


def _placement(spark, d, out: str) -> cohort_ops.Placement:
    """Tasks of the cohort write over the fixture tables."""
    tables = _fixture_spec()
    sizes = subject_ops.subject_sizes([(fx.RAW_FIXTURES[p](spark, d), len(events)) for p, events in tables.items()])
    sizes = spark.read.parquet(write_parquet(sizes, f"{out}/sizes"))
    splits = spark.read.parquet(write_parquet(subject_ops.assign_shards(sizes), f"{out}/metadata/subject_splits.parquet"))
    sized = spark.read.parquet(write_parquet(sizes.join(splits, "subject_id"), f"{out}/sized"))
    times = lambda: union_all(
        [e.select("subject_id", "time") for e in _table_events(spark, d, ["subject_id", "time"]).values()])
    return cohort_ops.place(sized, times, f"{out}/placement")


def _dictionaries(spark, d) -> dict[str, DataFrame]:
    return {
        "hosp/d_icd_diagnoses": prep_ops.normalize_icd(fx.d_icd_diagnoses(spark, d), "diagnoses"),
        "d_labitems_to_loinc": fx.d_labitems_to_loinc(spark, d),
    }


def _fixture_spec() -> dict:
    keys = ["hosp/admissions", "hosp/diagnoses_icd", "hosp/labevents", "hosp/patients", "icu/inputevents", "hosp/omr"]
    return {k: EVENTS[k] for k in keys}


def _lab_metadata(spark, d) -> DataFrame:
    spec = {"hosp/labevents": EVENTS["hosp/labevents"]}
    return meta_ops.all_dictionary_codes(spec, {"d_labitems_to_loinc": fx.d_labitems_to_loinc(spark, d)})


def _joined(c):
    return F.array_join(F.col(c), "|").alias(c)


# ------------------------------------------------------------------ SQL pieces

def _dot_sql(code: str, pos: int) -> str:
    return (f"CASE WHEN length({code}) > {pos} THEN substr({code}, 1, {pos}) || '.' || substr({code}, {pos + 1}) "
            f"ELSE {code} END")


def _diag_norm_sql(version: str, code: str) -> str:
    v, c = f"CAST({version} AS VARCHAR)", f"CAST({code} AS VARCHAR)"
    icd9 = f"CASE WHEN starts_with({c}, 'E') THEN {_dot_sql(c, 4)} ELSE {_dot_sql(c, 3)} END"
    return f"CASE WHEN {v} = '9' THEN {icd9} ELSE {_dot_sql(c, 3)} END"


def _proc_norm_sql(version: str, code: str) -> str:
    v, c = f"CAST({version} AS VARCHAR)", f"CAST({code} AS VARCHAR)"
    return f"CASE WHEN {v} = '9' THEN {_dot_sql(c, 2)} ELSE {c} END"


_SUBJECTS_SQL = "SELECT DISTINCT subject_id FROM (" + " UNION ALL ".join(
    f"SELECT CAST(subject_id AS BIGINT) AS subject_id FROM {t}" for t in SUBJECT_TABLES
) + ") WHERE subject_id IS NOT NULL"


def _shards_sql(seed: int = subject_ops.DEFAULT_SEED, n: int = subject_ops.SUBJECTS_PER_SHARD) -> str:
    return f"""
SELECT subject_id, split, rank, CAST(floor((rank - 1) / {n}) AS INTEGER) AS shard FROM (
  SELECT subject_id, split, row_number() OVER (PARTITION BY split ORDER BY h, subject_id) AS rank FROM (
    SELECT subject_id, h,
      CASE WHEN CAST(h AS DOUBLE) / CAST(4294967296 AS DOUBLE) < CAST(0.8 AS DOUBLE) THEN 'train'
           WHEN CAST(h AS DOUBLE) / CAST(4294967296 AS DOUBLE) < CAST(0.9 AS DOUBLE) THEN 'tuning'
           ELSE 'held_out' END AS split
    FROM (SELECT subject_id, ('0x' || substr(md5(CAST(subject_id AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT AS h
          FROM ({_SUBJECTS_SQL}))))"""


_SHARDS_SQL = _shards_sql()


def _events_view_sql(table: str, view: str, columns=None) -> str:
    return O.events_sql(view, EVENTS[table], columns)


_COHORT_SQL = "\nUNION ALL\n".join([
    _events_view_sql("hosp/admissions", "admissions", ALL_COLUMNS),
    _events_view_sql("hosp/diagnoses_icd", "diagnoses_prepared", ALL_COLUMNS),
    _events_view_sql("hosp/labevents", "labevents", ALL_COLUMNS),
    _events_view_sql("hosp/patients", "patients_prepared", ALL_COLUMNS),
    _events_view_sql("icu/inputevents", "inputevents", ALL_COLUMNS),
    _events_view_sql("hosp/omr", "omr", ALL_COLUMNS),
])
_COHORT_VIEWS = ["admissions", "diagnoses_prepared", "labevents", "patients_prepared", "inputevents", "omr"]

_DIAG_META_SQL = f"""
SELECT 'DIAGNOSIS//ICD//' || coalesce(CAST(icd_version AS VARCHAR), 'UNK') || '//' || coalesce(CAST(icd_code AS VARCHAR), 'UNK') AS code,
  long_title AS description,
  'ICD' || icd_version || 'CM/' || ({_diag_norm_sql('icd_version', 'icd_code')}) AS parent_codes
FROM d_icd_diagnoses"""

_LAB_META_SQL = """
SELECT 'LAB//SPECIMEN_COLLECTED//' || coalesce("itemid (omop_source_code)", 'UNK') AS code,
  coalesce(omop_concept_name, label) AS description, omop_vocabulary_id || '/' || omop_concept_code AS parent_codes
FROM d_labitems_to_loinc
UNION ALL
SELECT 'LAB//RESULT//' || coalesce("itemid (omop_source_code)", 'UNK') || '//' || coalesce(valueuom, 'UNK') AS code,
  coalesce(omop_concept_name, label) AS description, omop_vocabulary_id || '/' || omop_concept_code AS parent_codes
FROM d_labitems_to_loinc"""


def _collapse_sql(rows_sql: str) -> str:
    return f"""
SELECT code, string_agg(DISTINCT description, chr(10) ORDER BY description) AS description,
  string_agg(DISTINCT parent_codes, '|' ORDER BY parent_codes) AS parent_codes
FROM ({rows_sql}) GROUP BY code"""


# ------------------------------------------------------------------ A: sources

# Text in one CSV file of documents: some splits, and no more than one task should write.
CSV_FILE_BYTES = 256 << 20


@query("src_read_by_prefix", O.with_views(["admissions"], "SELECT *, 'csv.gz' AS source_format FROM admissions"))
def src_read_by_prefix(spark, d):
    """A1: a table present as .csv.gz and .parquet is read from the .csv.gz."""
    root = scratch_dir(spark, "raw")
    adm = fx.admissions(spark, d)
    adm.write.mode("overwrite").option("header", "true").option("compression", "gzip").csv(
        f"{root}/hosp/admissions.csv.gz")
    adm.limit(0).write.mode("overwrite").parquet(f"{root}/hosp/admissions.parquet")
    prefixes = discover_prefixes(spark, root)
    assert prefixes == ["hosp/admissions"], prefixes
    _, fmt = resolve_prefix(spark, root, "hosp/admissions")
    return read_table(spark, root, "hosp/admissions", RAW["hosp/admissions"]).withColumn(
        "source_format", F.lit(fmt))


@query("src_csv_typed", O.with_views(["patients"], "SELECT * FROM patients"))
def src_csv_typed(spark, d):
    """A3: CSV read with the declared types, cast by column name."""
    path = f"{scratch_dir(spark, 'csv')}/patients.csv"
    fx.patients(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path, RAW["hosp/patients"])


@query("src_csv_strings", O.with_views(["d_icd_diagnoses"], f"""
SELECT icd_code, icd_version, long_title, {_diag_norm_sql('icd_version', 'icd_code')} AS norm_icd_code
FROM d_icd_diagnoses"""))
def src_csv_strings(spark, d):
    """A4: an ICD dictionary read as text (no inference), then normalised."""
    path = f"{scratch_dir(spark, 'csv')}/d_icd_diagnoses.csv"
    fx.d_icd_diagnoses(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    return prep_ops.normalize_icd(read_csv(spark, path), "diagnoses")


@query("src_csv_multiline", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def src_csv_multiline(spark, d):
    """A3, A4: whole texts, newlines and quotes included, in plain CSV files read by their splits."""
    path = f"{scratch_dir(spark, 'csv')}/documents.csv"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, math.ceil(text_bytes / CSV_FILE_BYTES))
    docs.coalesce(files).write.option("header", "true").option("escape", '"').csv(path)
    return read_csv(spark, path)


@query("src_csv_inferred", """
SELECT l_orderkey, l_linenumber, l_extendedprice, lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS padded,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS VARCHAR) ELSE l_returnflag END AS mixed,
  l_linenumber > 3 AS flag, CAST(CASE WHEN l_linenumber > 1 THEN l_linenumber END AS DOUBLE) / 4 AS sparse
FROM lineitem""")
def src_csv_inferred(spark, d):
    """A3: types of an undeclared CSV table found from all its values; codes with leading zeros stay text."""
    path = f"{scratch_dir(spark, 'csv')}/lines.csv"
    number = F.col("l_linenumber")
    spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.lpad(number.cast("string"), 4, "0").alias("padded"),
        F.when(number % 2 == 0, number.cast("string")).otherwise(F.col("l_returnflag")).alias("mixed"),
        (number > 3).alias("flag"), (F.when(number > 1, number).cast("double") / 4).alias("sparse")
    ).write.option("header", "true").csv(path)
    return typed(read_csv(spark, path))


@query("src_csv_conflicts", """
SELECT * FROM (VALUES ('key', 'double', 0, 'bigint'), ('mixed', 'string', 0, 'bigint'), ('mixed', 'string', 1, 'double'))
  v("column", type, delivery, file_type) WHERE (SELECT count(*) FROM orders) > 0""")
def src_csv_conflicts(spark, d):
    """A3: files whose values alone have another type than the column over all files."""
    path = f"{scratch_dir(spark, 'csv')}/orders.csv"
    orders, key = spark.read.parquet(f"{d}/orders.parquet"), F.col("o_orderkey")
    deliveries = [(key.cast("string"), key.cast("string")), (F.concat(key, F.lit(".5")), F.concat(key, F.lit(".25"))),
                  (F.concat(key, F.lit(".0")), F.col("o_orderstatus"))]
    for i, (first, second) in enumerate(deliveries):
        orders.select(first.alias("key"), second.alias("mixed"), F.col("o_orderpriority").alias(
            "text")).coalesce(1).write.option("header", "true").csv(f"{path}/delivery={i}")
    found = conflicts(file_kinds(read_csv(spark, path)))
    return found.select("column", "type", F.regexp_extract("file", "delivery=([0-9])", 1).cast("int").alias("delivery"), "file_type")


@query("src_parquet", O.with_views(["labevents"], "SELECT * FROM labevents"))
def src_parquet(spark, d):
    """Parquet read conformed to the declared schema."""
    root = scratch_dir(spark, "raw")
    fx.labevents(spark, d).write.mode("overwrite").parquet(f"{root}/hosp/labevents.parquet")
    return read_table(spark, root, "hosp/labevents", RAW["hosp/labevents"])


@query("sink_parquet_roundtrip", O.with_views(["diagnoses_prepared"], "SELECT * FROM diagnoses_prepared"))
def sink_parquet_roundtrip(spark, d):
    """A prepared table written as Parquet and read back."""
    path = write_parquet(_prepared_diagnoses(spark, d), f"{scratch_dir(spark, 'prepared')}/hosp/diagnoses_icd.parquet")
    return spark.read.parquet(path)


@query("land_parquet", O.with_views(["inputevents"], "SELECT * FROM inputevents"))
def land_parquet(spark, d):
    """A10: a gzipped CSV landed as splittable Parquet."""
    root = scratch_dir(spark, "landing")
    src = f"{root}/icu/inputevents.csv.gz"
    fx.inputevents(spark, d).write.mode("overwrite").option("header", "true").option("compression", "gzip").csv(src)
    land(spark, read_csv(spark, src), src, f"{root}/landed/icu/inputevents.parquet")
    return read_table(spark, f"{root}/landed", "icu/inputevents", RAW["icu/inputevents"])


@query("cohort_sharded", O.with_views(_COHORT_VIEWS, f"""
SELECT DISTINCT e.*, s.split, s.shard FROM ({_COHORT_SQL}) e JOIN ({_SHARDS_SQL}) s ON e.subject_id = s.subject_id"""))
def cohort_sharded(spark, d):
    """The cohort written by split and shard, deduplicated and sorted, read back."""
    out = scratch_dir(spark, "cohort")
    return spark.read.parquet(write_cohort(_cohort_rows(spark, d), _placement(spark, d, out), out))


@query("code_catalog", O.with_views(_COHORT_VIEWS + ["d_icd_diagnoses", "d_labitems_to_loinc"], f"""
SELECT o.code, m.description, m.parent_codes, NULL AS possibly_cpt_code
FROM (SELECT DISTINCT code FROM ({_COHORT_SQL})) o
LEFT JOIN ({_collapse_sql(_DIAG_META_SQL + ' UNION ALL ' + _LAB_META_SQL)}) m ON o.code = m.code"""))
def code_catalog(spark, d):
    """A12 (+AG3, C3): every observed code with its metadata, written and read back."""
    metadata = meta_ops.all_dictionary_codes(_fixture_spec(), _dictionaries(spark, d))
    cat = meta_ops.catalogue(_cohort_codes(spark, d), metadata)
    path = write_parquet(cat, f"{scratch_dir(spark, 'metadata')}/codes.parquet")
    return spark.read.parquet(path).select(
        "code", "description", _joined("parent_codes"), _joined("possibly_cpt_code"))


@query("subject_splits", O.with_views(SUBJECT_TABLES, f"SELECT subject_id, split, shard FROM ({_SHARDS_SQL})"))
def subject_splits(spark, d):
    """The subject split table, written and read back."""
    path = write_parquet(_shards(spark, d), f"{scratch_dir(spark, 'metadata')}/subject_splits.parquet")
    return spark.read.schema(SPLITS_SCHEMA).parquet(path)


_FIRST_DELIVERY = ["patients", "omr"]


def _appended_sql(first: list[str], seed: int = subject_ops.DEFAULT_SEED, n: int = subject_ops.SUBJECTS_PER_SHARD) -> str:
    """Shards after two deliveries: the subjects of ``first``, then all others behind them."""
    early = " UNION ALL ".join(f"SELECT CAST(subject_id AS BIGINT) AS subject_id FROM {t}" for t in first)
    return f"""
SELECT subject_id, split, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY later, h, subject_id) - 1) / {n}) AS INTEGER) AS shard
FROM (SELECT s.subject_id, s.split, e.subject_id IS NULL AS later,
        ('0x' || substr(md5(CAST(s.subject_id AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT AS h
      FROM ({_shards_sql(seed, n)}) s LEFT JOIN (SELECT DISTINCT subject_id FROM ({early})) e ON s.subject_id = e.subject_id)"""


@query("subject_splits_appended", O.with_views(SUBJECT_TABLES, _appended_sql(_FIRST_DELIVERY, n=100)))
def subject_splits_appended(spark, d):
    """The splits after a second delivery; subjects of the first keep their places."""
    path = f"{scratch_dir(spark, 'metadata')}/subject_splits.parquet"
    first = subject_ops.distinct_subjects([fx.RAW_FIXTURES[f"hosp/{t}"](spark, d) for t in _FIRST_DELIVERY])
    write_parquet(subject_ops.assign_shards(first, n_per_shard=100), path)
    fresh = subject_ops.append_shards(spark.read.schema(SPLITS_SCHEMA).parquet(path), _subjects(spark, d), n_per_shard=100)
    write_parquet(fresh.checkpoint(), path, mode="append")
    return spark.read.schema(SPLITS_SCHEMA).parquet(path)


@query("cohort_appended", O.with_views(_COHORT_VIEWS, f"""
SELECT DISTINCT e.*, s.split, s.shard FROM ({_COHORT_SQL}) e
JOIN ({_appended_sql(["patients", "admissions"])}) s ON e.subject_id = s.subject_id"""))
def cohort_appended(spark, d):
    """G1, AG2, A11: the cohort after two deliveries, the second with a table of the first again."""
    out = scratch_dir(spark, "cohort")
    tables = {p: fx.RAW_FIXTURES[p](spark, d) for p in _fixture_spec()}
    dictionaries = {"hosp/d_icd_diagnoses": fx.d_icd_diagnoses(spark, d), "d_labitems_to_loinc": fx.d_labitems_to_loinc(spark, d)}
    first = {p: tables[p] for p in ("hosp/patients", "hosp/admissions")}
    second = {p: tables[p] for p in tables if p != "hosp/patients"}
    etl.build(spark, etl.Inputs(first, dictionaries), out)
    etl.append(spark, etl.Inputs(second, dictionaries), out)
    return spark.read.parquet(f"{out}/data")


@query("cohort_order", O.with_views(_COHORT_VIEWS, f"""
SELECT split, shard, count(*) AS rows, TRUE AS sorted FROM (
  SELECT DISTINCT e.*, s.split, s.shard FROM ({_COHORT_SQL}) e JOIN ({_SHARDS_SQL}) s ON e.subject_id = s.subject_id)
GROUP BY split, shard"""))
def cohort_order(spark, d):
    """every shard's rows and whether its files hold them in order."""
    out = scratch_dir(spark, "cohort")
    path = write_cohort(_cohort_rows(spark, d), _placement(spark, d, out), out)
    return order_ops.shard_order(order_ops.file_order(spark, path)).drop("files")


_AUDIT_BASE = "https://data.example.org/files/corpus/1.0/"
_AUDIT_SQL = f"""
WITH files AS (
  SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS key, sha256(text) AS actual_sha256 FROM documents),
manifest AS (
  SELECT source || '/' || CAST(d.doc_id AS VARCHAR) || CASE WHEN l.toxic = 1 THEN '.txt.gz' ELSE '.txt' END AS key,
    CASE WHEN l.quality = 1 THEN sha256(d.text) ELSE sha256(d.text || chr(10)) END AS expected_sha256
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT coalesce(f.key, m.key) AS key, m.expected_sha256, f.actual_sha256,
  CASE WHEN f.actual_sha256 IS NULL THEN 'missing' WHEN m.expected_sha256 IS NULL THEN 'not_in_manifest'
       WHEN f.actual_sha256 = m.expected_sha256 THEN 'valid' ELSE 'mismatch' END AS status,
  NOT (f.actual_sha256 IS NOT NULL AND m.expected_sha256 IS NOT NULL AND f.actual_sha256 = m.expected_sha256) AS refetch
FROM files f FULL OUTER JOIN manifest m ON f.key = m.key"""


@query("manifest_audit", _AUDIT_SQL)
def manifest_audit(spark, d):
    """Documents as files (URL under /files/<name>/<version>/), a manifest of the
    labelled ones (stale hash when quality is 0, a .gz name when toxic)."""
    docs = fx.table(spark, d, "documents")
    url = F.concat(F.lit(_AUDIT_BASE), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = docs.select(audit_ops.manifest_key(url).alias("key"), F.sha2(F.col("text"), 256).alias("actual_sha256"))
    labelled = fx.table(spark, d, "labels").join(docs, "doc_id")
    expected = F.when(F.col("quality") == 1, F.sha2(F.col("text"), 256)).otherwise(
        F.sha2(F.concat(F.col("text"), F.lit("\n")), 256))
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                    F.when(F.col("toxic") == 1, F.lit(".txt.gz")).otherwise(F.lit(".txt")))
    lines = labelled.select(F.concat(expected, F.lit("  "), path).alias("value"), F.col("doc_id").alias("_order"))
    return audit_ops.audit(files, audit_ops.parse_manifest(lines, order_col="_order"))


# What the pages' anchors look like to a pattern once comments, scripts and styles are gone.
_NOISE = r"(?is)<!--.*?-->|<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>"
_ANCHOR_HREF = r"""(?is)<a\s+(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _links_sql(reference: str = "href") -> str:
    """Anchors of the pages resolved; ``reference`` rewrites each href before."""
    return rf"""
WITH a AS (
  SELECT page_id, url, unnest(regexp_extract_all(
    regexp_replace(html, '{_NOISE.replace("'", "''")}', ' ', 'g'), '{_ANCHOR_HREF.replace("'", "''")}', 1)) AS v FROM pages),
b0 AS (
  SELECT page_id, url, trim(replace(replace(replace(replace(replace(
    CASE WHEN starts_with(v, '"') OR starts_with(v, '''') THEN substr(v, 2, length(v) - 2) ELSE v END,
    '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS href FROM a),
b AS (SELECT page_id, url, {reference} AS href FROM b0),
c AS (
  SELECT page_id, href, url,
    regexp_replace(url, '#.*$', '') AS no_frag,
    regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') AS no_query,
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS scheme,
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS origin FROM b),
d AS (
  SELECT *, CASE WHEN regexp_matches(no_query, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$') THEN no_query || '/'
                 ELSE regexp_extract(no_query, '^(.*/)', 1) END AS folder FROM c),
raw AS (
  SELECT page_id, href, folder, origin,
    regexp_matches(href, '^([a-zA-Z][a-zA-Z0-9+.-]*:|//)') AS absolute,
    CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
         WHEN starts_with(href, '//') THEN scheme || ':' || href
         WHEN starts_with(href, '/') THEN origin || href
         WHEN starts_with(href, '?') THEN no_query || href
         WHEN starts_with(href, '#') THEN no_frag || href
         WHEN href = '' THEN url
         ELSE folder || href END AS link FROM d),
f AS (
  SELECT *, regexp_extract(substr(link, length(origin) + 1), '^([^?#]*)', 1) AS path,
    regexp_extract(substr(link, length(origin) + 1), '([?#].*)$', 1) AS tail FROM raw),
e AS (
  SELECT page_id, href, folder,
    CASE WHEN absolute OR NOT regexp_matches(path, '(^|/)\.\.?(/|$)') THEN link
         ELSE origin || array_to_string(list_reduce(string_split(path, '/'), lambda stack, s:
                CASE s WHEN '..' THEN stack[:-2] WHEN '.' THEN stack ELSE list_append(stack, s) END, []::VARCHAR[]), '/')
              || CASE WHEN regexp_matches(path, '/\.\.?$') THEN '/' ELSE '' END || tail END AS link_url FROM f)
SELECT page_id, href, link_url, CASE WHEN ends_with(link_url, '/') THEN 'directory' ELSE 'file' END AS kind,
  starts_with(link_url, folder) AS in_scope,
  CASE WHEN starts_with(link_url, folder) THEN
    CASE WHEN ends_with(link_url, '/') THEN regexp_replace(substr(link_url, length(folder) + 1), '^/+|/+$', '', 'g')
         ELSE substr(link_url, length(folder) + 1) END END AS rel_path
FROM e"""


@query("page_links", _links_sql())
def page_links(spark, d):
    """Anchors of every stored page, resolved and classified."""
    return link_ops.page_links(fx.table(spark, d, "pages"))


@query("page_links_dotted", _links_sql("""CASE page_id % 4
  WHEN 0 THEN '.' || href WHEN 1 THEN '..' || href || '/..' WHEN 2 THEN './x/../../.' || href || '?q=../a' ELSE href || '/.' END"""))
def page_links_dotted(spark, d):
    """Every anchor rewritten to a reference with dot segments and written as entities."""
    anchors = link_ops.extract_hrefs(fx.table(spark, d, "pages").select("page_id", "url", "html"))
    href, kind = F.col("href"), F.col("page_id") % 4
    dotted = (F.when(kind == 0, F.concat(F.lit("."), href)).when(kind == 1, F.concat(F.lit(".."), href, F.lit("/..")))
              .when(kind == 2, F.concat(F.lit("./x/../../."), href, F.lit("?q=../a"))).otherwise(F.concat(href, F.lit("/."))))
    written = F.replace(F.replace(dotted, F.lit("&"), F.lit("&amp;")), F.lit("/"), F.lit("&#x2f;"))
    again = anchors.select("page_id", "url", F.concat(F.lit("<a class='>' href=\""), written, F.lit("\">x</a>")).alias("html"))
    return link_ops.page_links(again)


# ------------------------------------------------------- B: projections, filters

@query("event_rename", O.with_views(["inputevents"], O.events_sql(
    "inputevents", {"input_start": EVENTS["icu/inputevents"]["input_start"]})))
def event_rename(spark, d):
    """Value columns passed through under their output names (stay_id -> icustay_id ...)."""
    return extract_events(fx.inputevents(spark, d), {"input_start": EVENTS["icu/inputevents"]["input_start"]})


@query("event_time_filter", O.with_views(["labevents"], O.events_sql(
    "labevents", {"lab_result": EVENTS["hosp/labevents"]["lab_result"]})))
def event_time_filter(spark, d):
    """Lab results whose store time is missing are dropped."""
    return extract_events(fx.labevents(spark, d), {"lab_result": EVENTS["hosp/labevents"]["lab_result"]})


@query("event_leading_null", O.with_views(["omr"], _events_view_sql("hosp/omr", "omr")))
def event_leading_null(spark, d):
    """A code that is a column drops the row when that column is null."""
    return extract_events(fx.omr(spark, d), EVENTS["hosp/omr"])


@query("code_metadata_semi", O.with_views(["labevents", "d_labitems_to_loinc"], f"""
SELECT m.* FROM ({_collapse_sql(_LAB_META_SQL)}) m
WHERE m.code IN (SELECT code FROM ({_events_view_sql('hosp/labevents', 'labevents')}))"""))
def code_metadata_semi(spark, d):
    """Dictionary metadata kept only for codes that occur."""
    observed = meta_ops.observed_codes(extract_events(fx.labevents(spark, d), EVENTS["hosp/labevents"], ["code"]))
    out = meta_ops.restrict_to_observed(_lab_metadata(spark, d), observed)
    return out.select("code", "description", _joined("parent_codes"))


# ------------------------------------------------------------------- C: joins

@query("discharge_time_join", O.with_views(["diagnoses_prepared"], "SELECT * FROM diagnoses_prepared"))
def discharge_time_join(spark, d):
    """Diagnoses with their admission's discharge time (null hadm_id never matches)."""
    return _prepared_diagnoses(spark, d)


@query("static_fix", O.with_views(["patients_prepared"], "SELECT * FROM patients_prepared"))
def static_fix(spark, d):
    """Patients with death time and year of birth."""
    return _prepared_patients(spark, d)


@query("code_metadata_join", O.with_views(["diagnoses_prepared", "d_icd_diagnoses"], f"""
SELECT o.code, m.description, m.parent_codes
FROM (SELECT DISTINCT code FROM ({_events_view_sql('hosp/diagnoses_icd', 'diagnoses_prepared')})) o
LEFT JOIN ({_collapse_sql(_DIAG_META_SQL)}) m ON o.code = m.code"""))
def code_metadata_join(spark, d):
    """Observed diagnosis codes with description and parent code from the ICD dictionary."""
    spec = {"hosp/diagnoses_icd": EVENTS["hosp/diagnoses_icd"]}
    dicts = {"hosp/d_icd_diagnoses": prep_ops.normalize_icd(fx.d_icd_diagnoses(spark, d), "diagnoses")}
    observed = meta_ops.observed_codes(
        extract_events(_prepared_diagnoses(spark, d), EVENTS["hosp/diagnoses_icd"], ["code"]))
    cat = meta_ops.catalogue(observed, meta_ops.all_dictionary_codes(spec, dicts))
    return cat.select("code", "description", _joined("parent_codes"))


@query("subject_shard_join", O.with_views(["patients_prepared", *SUBJECT_TABLES], f"""
SELECT e.subject_id, e.time, e.code, s.split, s.shard
FROM ({_events_view_sql('hosp/patients', 'patients_prepared')}) e JOIN ({_SHARDS_SQL}) s ON e.subject_id = s.subject_id"""))
def subject_shard_join(spark, d):
    """C4: split and shard attached to every event."""
    events = extract_events(_prepared_patients(spark, d), EVENTS["hosp/patients"])
    shards = _shards(spark, d)
    return subject_ops.attach_shards(events, shards).select("subject_id", "time", "code", "split", "shard")


@query("subject_shard_join_seeded", O.with_views(["patients_prepared", *SUBJECT_TABLES], f"""
SELECT e.subject_id, e.time, e.code, s.split, s.shard
FROM ({_events_view_sql('hosp/patients', 'patients_prepared')}) e JOIN ({_shards_sql(7, 300)}) s ON e.subject_id = s.subject_id"""))
def subject_shard_join_seeded(spark, d):
    """C4: the same under another seed and shard size."""
    events = extract_events(_prepared_patients(spark, d), EVENTS["hosp/patients"])
    shards = subject_ops.assign_shards(_subjects(spark, d), n_per_shard=300, seed=7)
    return subject_ops.attach_shards(events, shards).select("subject_id", "time", "code", "split", "shard")


# ------------------------------------------------------------- AG: aggregates

@query("death_time_min", O.with_views(["death_times"], "SELECT * FROM death_times"))
def death_time_min(spark, d):
    """AG1: earliest in-hospital death time per subject (text min, nulls skipped)."""
    return prep_ops.death_times(fx.admissions(spark, d))


@query("event_dedupe", O.with_views(["inputevents"], f"SELECT DISTINCT * FROM ({_events_view_sql('icu/inputevents', 'inputevents')})"))
def event_dedupe(spark, d):
    """AG2: exact-duplicate infusion events removed."""
    return cohort_ops.dedupe(extract_events(fx.inputevents(spark, d), EVENTS["icu/inputevents"]))


_PROC_META_SQL = "\nUNION ALL\n".join(
    f"""SELECT 'PROCEDURE//{kind}//' || coalesce("itemid (omop_source_code)", 'UNK') AS code,
  coalesce(omop_concept_name, label) AS description, omop_vocabulary_id || '/' || omop_concept_code AS parent_codes
FROM {view}""" for kind in ("START", "END") for view in ("proc_datetimeevents", "proc_itemid"))


@query("code_metadata_collapse", O.with_views(["proc_datetimeevents", "proc_itemid"], _collapse_sql(_PROC_META_SQL)))
def code_metadata_collapse(spark, d):
    """AG4: two procedure dictionaries over every part; each code's rows collapse to
    sorted distinct descriptions and parent codes."""
    spec = {"icu/procedureevents": EVENTS["icu/procedureevents"]}
    dicts = {"proc_datetimeevents": fx.proc_datetimeevents(spark, d), "proc_itemid": fx.proc_itemid(spark, d)}
    rows = meta_ops.all_dictionary_codes(spec, dicts)
    return meta_ops.collapse(rows).select("code", "description", _joined("parent_codes"))


@query("distinct_subjects", O.with_views(SUBJECT_TABLES, _SUBJECTS_SQL))
def distinct_subjects(spark, d):
    """AG5: every distinct subject over all event tables."""
    return _subjects(spark, d)


# ----------------------------------------------------------------- E: windows

@query("subject_shard_number", O.with_views(SUBJECT_TABLES, _SHARDS_SQL))
def subject_shard_number(spark, d):
    """Rank within split by hash order, and shard = floor((rank-1)/1000)."""
    return _shards(spark, d, keep_rank=True)


# -------------------------------------------------------------- G: set ops

@query("cohort_union", O.with_views(_COHORT_VIEWS, _COHORT_SQL))
def cohort_union(spark, d):
    """G1: every table's events as one frame with the full declared column set."""
    return _cohort_events(spark, d)


@query("event_fanout", O.with_views(["admissions"], f"""
SELECT subject_id, time, code FROM ({_events_view_sql('hosp/admissions', 'admissions')})"""))
def event_fanout(spark, d):
    """Four events per admission row from a single scan."""
    return extract_events(fx.admissions(spark, d), EVENTS["hosp/admissions"]).select("subject_id", "time", "code")


# ------------------------------------------------------------- H: scalars

@query("icd_add_dot", O.with_views(["d_icd_diagnoses"], f"""
SELECT icd_code, {_dot_sql('icd_code', 1)} AS dot_1, {_dot_sql('icd_code', 3)} AS dot_3,
  {_dot_sql('icd_code', 6)} AS dot_6 FROM d_icd_diagnoses"""))
def icd_add_dot(spark, d):
    """H1: dot after 1, 3 and 6 characters."""
    c = F.col("icd_code")
    return fx.d_icd_diagnoses(spark, d).select(
        "icd_code", add_dot(c, 1).alias("dot_1"), add_dot(c, 3).alias("dot_3"), add_dot(c, 6).alias("dot_6"))


@query("icd_diagnosis_norm", O.with_views(["d_icd_diagnoses"], f"""
SELECT icd_code, icd_version, {_diag_norm_sql('icd_version', 'icd_code')} AS norm_icd_code FROM d_icd_diagnoses"""))
def icd_diagnosis_norm(spark, d):
    """H2: diagnosis dotting by version."""
    return fx.d_icd_diagnoses(spark, d).select(
        "icd_code", "icd_version", icd_diagnosis_dot(F.col("icd_version"), F.col("icd_code")).alias("norm_icd_code"))


@query("icd_procedure_norm", O.with_views(["diagnoses_icd"], f"""
SELECT icd_code, icd_version, {_proc_norm_sql('icd_version', 'icd_code')} AS norm_icd_code FROM diagnoses_icd"""))
def icd_procedure_norm(spark, d):
    """H3: procedure dotting by version (integer versions compared as text)."""
    return fx.diagnoses_icd(spark, d).select(
        "icd_code", "icd_version", icd_procedure_dot(F.col("icd_version"), F.col("icd_code")).alias("norm_icd_code"))


_ADMISSION_EVENT = {"admission": EVENTS["hosp/admissions"]["admission"]}


@query("event_code", O.with_views(["admissions"], f"""
SELECT subject_id, code, hadm_id FROM ({O.events_sql('admissions', _ADMISSION_EVENT)})"""))
def event_code(spark, d):
    """H8: composite code with UNK for a null non-leading column."""
    return extract_events(fx.admissions(spark, d), _ADMISSION_EVENT).select("subject_id", "code", "hadm_id")


@query("event_time_parse", O.with_views(["admissions"], f"""
SELECT hadm_id, admittime, {O.time_sql('admittime', '%Y-%m-%d %H:%M:%S')} AS time FROM admissions"""))
def event_time_parse(spark, d):
    """H9: text to timestamp with one format (null when it does not parse)."""
    adm = fx.admissions(spark, d)
    return adm.select("hadm_id", "admittime",
                      parse_time(F.col("admittime"), "%Y-%m-%d %H:%M:%S", adm.schema["admittime"].dataType).alias("time"))


@query("event_time_native", """
SELECT DISTINCT subject_id, time, code FROM (
  SELECT user_id AS subject_id, date_trunc('second', ts) + INTERVAL (200 * k) MILLISECOND AS time,
    'MEDICATION//' || event_type || '//UNK' AS code
  FROM events, unnest([1, 2]) r(k))""")
def event_time_native(spark, d):
    """H9, K0, AG2: times that a Parquet file holds typed keep their fractions, so that events
    0.2 s apart are two, before and after duplicates go."""
    root = scratch_dir(spark, "raw")
    events = spark.read.parquet(f"{d}/events.parquet")
    whole = F.date_trunc("second", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    typed = events.select(F.col("user_id").alias("subject_id"), F.col("event_type").alias("medication"),
                          F.explode(F.array(*[whole + F.expr(f"INTERVAL '0.{2 * k}' SECOND") for k in (1, 2)])).alias("charttime"))
    typed.write.parquet(f"{root}/hosp/emar.parquet")
    emar = read_table(spark, root, "hosp/emar", RAW["hosp/emar"])
    return cohort_ops.dedupe(extract_events(emar, EVENTS["hosp/emar"]).select("subject_id", "time", "code"))


@query("event_time_multi_format", O.with_views(["patients_prepared"], f"""
SELECT subject_id, dod, {O.time_sql('dod', ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])} AS time FROM patients_prepared"""))
def event_time_multi_format(spark, d):
    """Formats tried in order, first match wins."""
    return _prepared_patients(spark, d).select(
        "subject_id", "dod", parse_time(F.col("dod"), ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d"]).alias("time"))


@query("event_birth", O.with_views(["patients_prepared"], f"""
SELECT subject_id, year_of_birth, {O.time_sql('year_of_birth', '%Y')} AS time FROM patients_prepared"""))
def event_birth(spark, d):
    """A year becomes 1 January of that year."""
    return _prepared_patients(spark, d).select(
        "subject_id", "year_of_birth", parse_time(F.col("year_of_birth"), "%Y").alias("time"))


_GENDER_EVENT = {"gender": EVENTS["hosp/patients"]["gender"]}


@query("event_static", O.with_views(["patients_prepared"], O.events_sql("patients_prepared", _GENDER_EVENT)))
def event_static(spark, d):
    """Static events keep a null time."""
    return extract_events(_prepared_patients(spark, d), _GENDER_EVENT)


@query("parent_code_template", O.with_views(["d_icd_diagnoses"], _DIAG_META_SQL))
def parent_code_template(spark, d):
    """``ICD{icd_version}CM/{norm_icd_code}`` per dictionary row."""
    ev = EVENTS["hosp/diagnoses_icd"]["diagnosis"]
    dictionary = prep_ops.normalize_icd(fx.d_icd_diagnoses(spark, d), "diagnoses")
    return meta_ops.dictionary_codes(dictionary, ev, ev["_metadata"]["hosp/d_icd_diagnoses"])


@query("parent_code_conditional", O.with_views(["d_icd_diagnoses"], f"""
SELECT 'PROCEDURE//ICD//' || coalesce(CAST(icd_version AS VARCHAR), 'UNK') || '//' || coalesce(CAST(icd_code AS VARCHAR), 'UNK') AS code,
  long_title AS description,
  CASE WHEN CAST(icd_version AS VARCHAR) = '9' THEN 'ICD' || icd_version || 'Proc/' || ({_proc_norm_sql('icd_version', 'icd_code')})
       WHEN CAST(icd_version AS VARCHAR) = '10' THEN 'ICD' || icd_version || 'PCS/' || ({_proc_norm_sql('icd_version', 'icd_code')})
  END AS parent_codes
FROM d_icd_diagnoses"""))
def parent_code_conditional(spark, d):
    """The procedure dictionary's templates chosen by ICD version."""
    ev = EVENTS["hosp/procedures_icd"]["procedure"]
    dictionary = prep_ops.normalize_icd(fx.d_icd_diagnoses(spark, d), "procedures")
    return meta_ops.dictionary_codes(dictionary, ev, ev["_metadata"]["hosp/d_icd_procedures"])


@query("description_collate", O.with_views(["proc_datetimeevents"], """
SELECT "itemid (omop_source_code)" AS itemid, coalesce(omop_concept_name, label) AS description FROM proc_datetimeevents"""))
def description_collate(spark, d):
    """First non-null of the description columns; a spaced column renamed."""
    dictionary = fx.proc_datetimeevents(spark, d)
    return dictionary.select(F.col("`itemid (omop_source_code)`").alias("itemid"),
                             code_fns.collate(dictionary, ["omop_concept_name", "label"]).alias("description"))


@query("event_numeric_value", O.with_views(["labevents"], f"""
SELECT subject_id, time, code, numeric_value FROM ({O.events_sql('labevents', {'lab_result': EVENTS['hosp/labevents']['lab_result']})})"""))
def event_numeric_value(spark, d):
    """Numeric values as FLOAT."""
    ev = {"lab_result": EVENTS["hosp/labevents"]["lab_result"]}
    return extract_events(fx.labevents(spark, d), ev).select("subject_id", "time", "code", "numeric_value")


@query("event_text_value", O.with_views(["labevents"], f"""
SELECT subject_id, time, code, text_value FROM ({O.events_sql('labevents', {'lab_result': EVENTS['hosp/labevents']['lab_result']})})"""))
def event_text_value(spark, d):
    """Text values passed through."""
    ev = {"lab_result": EVENTS["hosp/labevents"]["lab_result"]}
    return extract_events(fx.labevents(spark, d), ev).select("subject_id", "time", "code", "text_value")


# ------------------------------------------------------ K: per-table extraction

@query("events_admissions", O.with_views(["admissions"], _events_view_sql("hosp/admissions", "admissions")))
def events_admissions(spark, d):
    """K0 events 1-4."""
    return _table_events(spark, d)["hosp/admissions"]


@query("events_diagnoses", O.with_views(["diagnoses_prepared"], _events_view_sql("hosp/diagnoses_icd", "diagnoses_prepared")))
def events_diagnoses(spark, d):
    """K0 event 5 (after the discharge-time join)."""
    return extract_events(_prepared_diagnoses(spark, d), EVENTS["hosp/diagnoses_icd"])


@query("events_labs", O.with_views(["labevents"], _events_view_sql("hosp/labevents", "labevents")))
def events_labs(spark, d):
    """K0 events 9-10."""
    return extract_events(fx.labevents(spark, d), EVENTS["hosp/labevents"])


@query("events_patients", O.with_views(["patients_prepared"], _events_view_sql("hosp/patients", "patients_prepared")))
def events_patients(spark, d):
    """K0 events 12-14 (after the static fix)."""
    return extract_events(_prepared_patients(spark, d), EVENTS["hosp/patients"])


@query("events_infusions", O.with_views(["inputevents"], _events_view_sql("icu/inputevents", "inputevents")))
def events_infusions(spark, d):
    """K0 events 24-26."""
    return extract_events(fx.inputevents(spark, d), EVENTS["icu/inputevents"])


# The other ten tables register themselves; imported last, since they use ``query``.
from cohortline.plans import table_queries  # noqa: E402, F401
