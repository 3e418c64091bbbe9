"""Views of the ten further event tables and of their dictionaries; the SQL of the queries in
``plans/table_queries.py`` states the same columns over the driver's tables.

Each covers a whole driver table; key-modulo rules only put nulls into columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.schemas import DICTIONARIES, ITEM_KEY, RAW
from cohortline.sources.fixtures import _lineitem_orders, _text, table
from cohortline.sources.readers import conform

SECONDS, DAY = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"


def _unless(missing: Column, value) -> Column:
    """``value``, or null where ``missing``."""
    return F.when(~missing, value)


def _str(c: Column) -> Column:
    return c.cast("string")


def _view(df: DataFrame, prefix: str, **columns: Column) -> DataFrame:
    schema = RAW.get(prefix) or DICTIONARIES[prefix]
    return conform(df.select(*[c.alias(n) for n, c in columns.items()]), schema, keep_extra=False)


def drgcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _view(
        table(spark, sf_dir, "orders"), "hosp/drgcodes", subject_id=F.col("o_custkey"),
        hadm_id=_unless(key % 11 == 0, key), drg_type=F.col("o_orderstatus"),
        drg_code=_unless(key % 5 == 0, _str(key % 1000)), description=F.col("o_orderpriority"),
        drg_severity=_str(key % 4), drg_mortality=_unless(key % 3 == 0, _str(key % 5)))


def emar(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return _view(
        table(spark, sf_dir, "events"), "hosp/emar", subject_id=F.col("user_id"), hadm_id=key,
        emar_id=F.concat(_str(F.col("user_id")), F.lit("-"), _str(key)), emar_seq=_str(key % 7),
        charttime=F.date_format("ts", SECONDS), medication=_unless(key % 9 == 0, F.col("event_type")),
        event_txt=_unless(key % 8 == 0, F.lit("Administered")))


def hcpcsevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _view(
        table(spark, sf_dir, "orders"), "hosp/hcpcsevents", subject_id=F.col("o_custkey"), hadm_id=key,
        chartdate=F.date_format("o_orderdate", DAY), hcpcs_cd=_str(key % 5000),
        short_description=_unless(key % 6 == 0, F.concat(F.lit("S"), _str(key % 5000))))


def pharmacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, ts = F.col("event_id"), F.col("ts")
    return _view(
        table(spark, sf_dir, "events"), "hosp/pharmacy", subject_id=F.col("user_id"), hadm_id=key,
        starttime=F.when(key % 2 == 0, F.date_format(ts, DAY)).otherwise(F.date_format(ts, SECONDS)),
        stoptime=_unless(key % 5 == 0, F.date_format(ts + F.expr("INTERVAL 1 HOUR"), SECONDS)),
        medication=_unless(key % 9 == 0, F.col("event_type")),
        route=F.when(key % 4 == 0, "IV").otherwise("PO"), frequency=F.lit("BID"),
        doses_per_24_hrs=_str(key % 4), poe_id=F.concat(_str(F.col("user_id")), F.lit("-"), _str(key)))


def procedures_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _view(
        table(spark, sf_dir, "orders"), "hosp/procedures_icd", subject_id=F.col("o_custkey"),
        hadm_id=_unless(key % 11 == 0, key), seq_num=F.lit(1), chartdate=F.date_format("o_orderdate", DAY),
        icd_code=_str(F.lit(1000) + key % 5000), icd_version=F.when(key % 2 == 0, 9).otherwise(10))


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return _view(
        table(spark, sf_dir, "events"), "hosp/transfers", subject_id=F.col("user_id"),
        hadm_id=_unless(key % 4 == 0, key), intime=F.date_format("ts", SECONDS), eventtype=F.col("event_type"),
        careunit=_unless(key % 5 == 0, F.concat(F.lit("Unit "), _str(key % 6))))


def icustays(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return _view(
        table(spark, sf_dir, "orders"), "icu/icustays", subject_id=F.col("o_custkey"), hadm_id=key,
        stay_id=key * 10, intime=_text(day), outtime=_unless(key % 8 == 0, _text(day + F.expr("INTERVAL 2 DAYS"))),
        first_careunit=F.col("o_orderpriority"), last_careunit=_unless(key % 7 == 0, F.col("o_orderstatus")))


def chartevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("l_partkey")
    return _view(
        _lineitem_orders(spark, sf_dir), "icu/chartevents", subject_id=F.col("o_custkey"),
        hadm_id=F.col("l_orderkey"), stay_id=F.col("l_suppkey"), itemid=item, charttime=_text(F.col("l_shipdate")),
        value=_str(F.col("l_linenumber")), valuenum=F.col("l_quantity"),
        valueuom=_unless(item % 2 == 0, F.lit("mmHg")))


def procedureevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship = F.col("l_shipdate")
    return _view(
        _lineitem_orders(spark, sf_dir), "icu/procedureevents", subject_id=F.col("o_custkey"),
        hadm_id=F.col("l_orderkey"), stay_id=F.col("l_suppkey"), itemid=F.col("l_partkey"), starttime=_text(ship),
        endtime=_unless(F.col("l_linenumber") % 3 == 0, _text(ship + F.expr("INTERVAL 1 HOUR"))))


def outputevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return _view(
        table(spark, sf_dir, "events"), "icu/outputevents", subject_id=F.col("user_id"), hadm_id=key,
        stay_id=F.col("user_id"), itemid=key % 30000, charttime=F.date_format("ts", SECONDS), value=F.col("value"),
        valueuom=_unless(key % 3 == 0, F.lit("mL")))


def _omop(spark: SparkSession, sf_dir: str, prefix: str, vocabulary: str, **more: Column) -> DataFrame:
    """An item dictionary over every part."""
    pk = F.col("p_partkey")
    columns = {
        ITEM_KEY: _str(pk), "label": F.col("p_brand"), "omop_concept_name": _unless(pk % 3 == 0, F.col("p_name")),
        "omop_vocabulary_id": F.lit(vocabulary), "omop_concept_code": F.col("p_type"), **more}
    return _view(table(spark, sf_dir, "part"), prefix, **columns)


def outputevents_to_loinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "outputevents_to_loinc", "LOINC",
                 unitname=_unless(F.col("p_partkey") % 3 == 0, F.lit("mL")))


def inputevents_to_rxnorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "inputevents_to_rxnorm", "RxNorm")


def d_hcpcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = F.col("p_partkey")
    return _view(table(spark, sf_dir, "part"), "hosp/d_hcpcs", code=_str(pk), long_description=F.col("p_name"),
                 short_description=F.concat(F.lit("S"), _str(pk)))


def d_icd_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = F.col("p_partkey")
    return _view(table(spark, sf_dir, "part"), "hosp/d_icd_procedures", icd_code=_str(F.lit(1000) + pk),
                 icd_version=F.when(pk % 2 == 0, "9").otherwise("10"), long_title=F.col("p_name"))
