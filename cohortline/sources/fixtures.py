"""Raw clinical tables derived from the driver's tables (FIXTURES.md section 6).

The driver tables have no null keys, so these views create nulls, unmatched keys,
missing units and missing times on purpose. Every view is conformed to the declared
raw schema; columns a view does not define are typed nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.schemas import DICTIONARIES, ITEM_KEY, RAW
from cohortline.sources import files
from cohortline.sources.readers import conform


_TABLES: dict[tuple, DataFrame] = {}
# Smaller driver tables are not worth an exchange.
DEALT_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the DataFrame (plan only, no data) is reused within a session
    so that building a query does not list and open the same files again. A table of a few row groups
    is as many tasks, however large, so its rows are dealt out to all cores; one with row groups for
    all of them is read as it is."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no context on the client
        app = spark.conf.get("spark.app.id", "")
    key = (id(spark), app, sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        df = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        _TABLES[key] = df if files.size(spark, path) < DEALT_BYTES or _reading_tasks(df) >= cores / 2 else df.repartition(cores)
    return _TABLES[key]


def _reading_tasks(df: DataFrame) -> int:
    """Tasks that get rows when ``df`` is read, found from the footers of its files."""
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def _text(ts: Column) -> Column:
    return ts.cast("string")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    return conform(o.select(
        F.col("o_custkey").alias("subject_id"),
        key.alias("hadm_id"),
        _text(d).alias("admittime"),
        _text(d + F.expr("INTERVAL 5 DAYS")).alias("dischtime"),
        F.when((F.col("o_orderstatus") == "F") & (key % 40 == 0), _text(d + F.expr("INTERVAL 3 DAYS")))
        .alias("deathtime"),
        F.col("o_orderpriority").alias("admission_type"),
        F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("admission_location"),
        F.when(key % 3 == 0, _text(d)).alias("edregtime"),
    ), RAW["hosp/admissions"], keep_extra=False)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return conform(c.select(
        key.alias("subject_id"),
        F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.lit(20) + F.col("c_nationkey")).alias("anchor_age"),
        F.lit(2150).alias("anchor_year"),
        F.when(key % 9 == 0, F.lit("2003-06-01")).alias("dod"),
    ), RAW["hosp/patients"], keep_extra=False)


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def _icd_code(key: Column) -> Column:
    prefix = F.when(key % 5 == 0, F.lit("E")).when(key % 5 == 1, F.lit("V")).otherwise(F.lit(""))
    return F.concat(prefix, (F.lit(10) + key).cast("string"))


def diagnoses_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _lineitem_orders(spark, sf_dir)
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    return conform(lo.select(
        F.col("o_custkey").alias("subject_id"),
        F.when(ok % 11 == 0, F.lit(None).cast("bigint")).otherwise(ok).alias("hadm_id"),
        F.col("l_linenumber").alias("seq_num"),
        F.when(pk % 2 == 0, F.lit(9)).otherwise(F.lit(10)).alias("icd_version"),
        _icd_code(pk).alias("icd_code"),
    ), RAW["hosp/diagnoses_icd"], keep_extra=False)


def d_icd_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return conform(p.select(
        _icd_code(pk).alias("icd_code"),
        F.when(pk % 2 == 0, F.lit("9")).otherwise(F.lit("10")).alias("icd_version"),
        F.col("p_name").alias("long_title"),
    ), DICTIONARIES["hosp/d_icd_diagnoses"], keep_extra=False)


def labevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return conform(e.select(
        F.col("user_id").alias("subject_id"),
        F.when(eid % 4 == 0, F.lit(None).cast("bigint")).otherwise(eid).alias("hadm_id"),
        (F.lit(51000) + eid % 20000).alias("itemid"),
        F.date_format(ts, fmt).alias("charttime"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format(ts + F.expr("INTERVAL 1 HOUR"), fmt)).alias("storetime"),
        F.col("value").alias("valuenum"),
        F.col("props").alias("value"),
        F.when(eid % 20 < 5, F.lit(None).cast("string")).otherwise(F.lit("mg/dL")).alias("valueuom"),
        F.col("event_type").alias("priority"),
    ), RAW["hosp/labevents"], keep_extra=False)


def d_labitems_to_loinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return conform(p.select(
        (F.lit(51000) + pk).cast("string").alias(ITEM_KEY),
        F.when(pk % 20 < 5, F.lit(None).cast("string")).otherwise(F.lit("mg/dL")).alias("valueuom"),
        F.when(pk % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("omop_concept_name"),
        F.col("p_brand").alias("label"),
        F.lit("LOINC").alias("omop_vocabulary_id"),
        F.col("p_type").alias("omop_concept_code"),
    ), DICTIONARIES["d_labitems_to_loinc"], keep_extra=False)


def inputevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _lineitem_orders(spark, sf_dir)
    ship = F.col("l_shipdate")
    return conform(lo.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_suppkey").alias("stay_id"),
        F.col("l_partkey").alias("itemid"),
        _text(ship).alias("starttime"),
        _text(ship + F.expr("INTERVAL 2 HOURS")).alias("endtime"),
        F.col("l_discount").alias("rate"),
        F.lit("mL/hour").alias("rateuom"),
        F.col("l_quantity").alias("amount"),
        F.lit("mL").alias("amountuom"),
        F.col("l_tax").alias("patientweight"),
    ), RAW["icu/inputevents"], keep_extra=False)


RAW_FIXTURES = {
    "hosp/admissions": admissions,
    "hosp/patients": patients,
    "hosp/diagnoses_icd": diagnoses_icd,
    "hosp/labevents": labevents,
    "icu/inputevents": inputevents,
}
DICTIONARY_FIXTURES = {
    "hosp/d_icd_diagnoses": d_icd_diagnoses,
    "d_labitems_to_loinc": d_labitems_to_loinc,
}


def omr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outpatient results: the code is a column (``result_name``), null on purpose
    for some rows so the leading-null rule has work to do."""
    e = table(spark, sf_dir, "events")
    return conform(e.select(
        F.col("user_id").alias("subject_id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("chartdate"),
        F.when(F.col("event_id") % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
        .alias("result_name"),
        F.col("props").alias("result_value"),
    ), RAW["hosp/omr"], keep_extra=False)


RAW_FIXTURES["hosp/omr"] = omr


def proc_datetimeevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A procedure-item dictionary over every part (grows with the data)."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return conform(p.select(
        pk.cast("string").alias(ITEM_KEY),
        F.col("p_brand").alias("label"),
        F.when(pk % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("omop_concept_name"),
        F.lit("SNOMED").alias("omop_vocabulary_id"),
        F.col("p_type").alias("omop_concept_code"),
    ), DICTIONARIES["proc_datetimeevents"], keep_extra=False)


def proc_itemid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second dictionary for the same items, so codes have two rows to collapse."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return conform(p.select(
        pk.cast("string").alias(ITEM_KEY),
        F.col("p_brand").alias("label"),
        F.when(pk % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("omop_concept_name"),
        F.lit("LOINC").alias("omop_vocabulary_id"),
        F.col("p_size").cast("string").alias("omop_concept_code"),
    ), DICTIONARIES["proc_itemid"], keep_extra=False)


DICTIONARY_FIXTURES["proc_datetimeevents"] = proc_datetimeevents
DICTIONARY_FIXTURES["proc_itemid"] = proc_itemid
