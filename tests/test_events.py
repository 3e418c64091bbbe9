"""Event extraction over small literal tables (the tables without a driver view)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortline.operators.events import extract_events
from cohortline.operators.prepare import add_discharge_time
from cohortline.plans.event_spec import EVENTS
from cohortline.schemas import RAW
from cohortline.sources.readers import conform

T = dt.datetime


def frame(spark, prefix, rows):
    schema = RAW[prefix]
    names = list(rows[0].keys())
    sub = ", ".join(f"`{n}` {schema[n].dataType.simpleString()}" for n in names)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], sub)
    return conform(df, schema, keep_extra=False)


def events(spark, prefix, rows, cols=("subject_id", "time", "code")):
    out = extract_events(frame(spark, prefix, rows), EVENTS[prefix])
    return sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)


def test_every_event_has_declared_output_columns():
    assert len(EVENTS) == 16
    assert sum(len(v) for v in EVENTS.values()) == 27


def test_drgcodes(spark):
    rows = [{"subject_id": 1, "hadm_id": 10, "drg_type": "HCFA", "drg_code": "0012", "description": "X",
             "drg_severity": "2", "drg_mortality": None},
            {"subject_id": 1, "hadm_id": 11, "drg_type": "APR", "drg_code": None, "description": None,
             "drg_severity": None, "drg_mortality": "1"}]
    df = frame(spark, "hosp/drgcodes", rows).withColumn("hadm_discharge_time", F.lit("2020-01-02 03:04:05"))
    df = df.withColumn("hadm_discharge_time", F.when(F.col("hadm_id") == 10, F.col("hadm_discharge_time")))
    out = extract_events(df, EVENTS["hosp/drgcodes"]).collect()
    assert [(r.code, r.time, r.drg_severity) for r in out] == [("DRG//HCFA//0012//X", T(2020, 1, 2, 3, 4, 5), "2")]


def test_emar_and_transfers(spark):
    emar = [{"subject_id": 2, "hadm_id": 20, "emar_id": "2-1", "emar_seq": "1", "charttime": "2020-01-01 00:00:00",
             "medication": "Heparin", "event_txt": None}]
    assert events(spark, "hosp/emar", emar) == [(2, T(2020, 1, 1), "MEDICATION//Heparin//UNK")]
    tr = [{"subject_id": 3, "hadm_id": 30, "intime": "2020-01-01 01:00:00", "eventtype": "admit", "careunit": None},
          {"subject_id": 3, "hadm_id": 30, "intime": "bad", "eventtype": "transfer", "careunit": "ICU"}]
    assert events(spark, "hosp/transfers", tr) == [(3, T(2020, 1, 1, 1), "TRANSFER_TO//admit//UNK")]


def test_hcpcs_date_format(spark):
    rows = [{"subject_id": 4, "hadm_id": 40, "chartdate": "2020-05-06", "short_description": "Visit"},
            {"subject_id": 4, "hadm_id": 40, "chartdate": "2020-05-06 00:00:00", "short_description": "Other"}]
    assert events(spark, "hosp/hcpcsevents", rows) == [(4, T(2020, 5, 6), "HCPCS//Visit")]


def test_omr_leading_column(spark):
    rows = [{"subject_id": 5, "chartdate": "2020-01-01", "result_name": "BMI", "result_value": "22.1"},
            {"subject_id": 5, "chartdate": "2020-01-01", "result_name": None, "result_value": "1"}]
    assert events(spark, "hosp/omr", rows, ("code", "text_value")) == [("BMI", "22.1")]


def test_pharmacy_two_formats(spark):
    rows = [{"subject_id": 6, "starttime": "2020-01-01", "stoptime": "2020-01-02 10:00:00", "medication": "A",
             "route": "PO", "frequency": "Q8H", "doses_per_24_hrs": "3", "poe_id": "p1"}]
    got = events(spark, "hosp/pharmacy", rows, ("time", "code", "route", "poe_id"))
    assert got == [(T(2020, 1, 1), "MEDICATION//START//A", "PO", "p1"),
                   (T(2020, 1, 2, 10), "MEDICATION//STOP//A", None, "p1")]


def test_procedures_after_discharge_join(spark):
    proc = frame(spark, "hosp/procedures_icd", [
        {"subject_id": 7, "hadm_id": 70, "icd_code": "0040", "icd_version": 9},
        {"subject_id": 7, "hadm_id": None, "icd_code": "0050", "icd_version": 10}])
    adm = frame(spark, "hosp/admissions", [{"subject_id": 7, "hadm_id": 70, "dischtime": "2020-02-02 02:02:02"}])
    out = extract_events(add_discharge_time(proc, adm), EVENTS["hosp/procedures_icd"]).collect()
    assert [(r.code, r.time, r.hadm_id) for r in out] == [("PROCEDURE//ICD//9//0040", T(2020, 2, 2, 2, 2, 2), 70)]


def test_icustays_rename(spark):
    rows = [{"subject_id": 8, "hadm_id": 80, "stay_id": 800, "intime": "2020-01-01 00:00:00",
             "outtime": "2020-01-03 00:00:00", "first_careunit": "MICU", "last_careunit": None}]
    got = events(spark, "icu/icustays", rows, ("code", "icustay_id", "hadm_id"))
    assert got == [("ICU_ADMISSION//MICU", 800, 80), ("ICU_DISCHARGE//UNK", 800, 80)]


def test_chartevents_values(spark):
    rows = [{"subject_id": 9, "hadm_id": 90, "stay_id": 900, "itemid": 220045, "charttime": "2020-01-01 00:00:00",
             "value": "80", "valuenum": 80.0, "valueuom": "bpm"},
            {"subject_id": 9, "hadm_id": 90, "stay_id": 900, "itemid": 220046, "charttime": "2020-01-01 00:00:00",
             "value": "text", "valuenum": None, "valueuom": None}]
    got = events(spark, "icu/chartevents", rows, ("code", "numeric_value", "text_value", "icustay_id"))
    assert got == [("LAB//220045//bpm", 80.0, "80", 900), ("LAB//220046//UNK", None, "text", 900)]


def test_procedureevents_and_outputevents(spark):
    pe = [{"subject_id": 10, "hadm_id": 1, "stay_id": 2, "itemid": 225459, "starttime": "2020-01-01 00:00:00",
           "endtime": None}]
    assert events(spark, "icu/procedureevents", pe, ("code",)) == [("PROCEDURE//START//225459",)]
    oe = [{"subject_id": 11, "hadm_id": 1, "stay_id": 2, "itemid": 226559, "charttime": "2020-01-01 00:00:00",
           "value": 100.0, "valueuom": "ml"}]
    assert events(spark, "icu/outputevents", oe, ("code", "numeric_value")) == [("SUBJECT_FLUID_OUTPUT//226559//ml", 100.0)]


def test_inputevents_three_events_one_scan(spark):
    rows = [{"subject_id": 12, "hadm_id": 1, "stay_id": 2, "itemid": 5, "starttime": "2020-01-01 00:00:00",
             "endtime": "2020-01-01 02:00:00", "orderid": 77, "linkorderid": 78, "rate": 1.5, "rateuom": "mL/hour",
             "amount": 3.0, "amountuom": "mL", "patientweight": 70.0, "statusdescription": "Stopped"}]
    df = extract_events(frame(spark, "icu/inputevents", rows), EVENTS["icu/inputevents"])
    got = sorted((r.code, r.numeric_value, r.unit, r.order_id, r.statusdescription) for r in df.collect())
    assert got == [("INFUSION_END//5", 3.0, "mL", 77, "Stopped"), ("INFUSION_START//5", 1.5, "mL/hour", 77, None),
                   ("SUBJECT_WEIGHT_AT_INFUSION//KG", 70.0, None, None, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("FileScan") <= 1 or "Generate" in plan


def test_malformed_numeric_becomes_null(spark):
    rows = [{"subject_id": 13, "hadm_id": 1, "itemid": 1, "charttime": "2020-01-01 00:00:00",
             "storetime": "2020-01-01 00:00:00", "value": "x", "valuenum": None, "valueuom": "u"}]
    df = frame(spark, "hosp/labevents", rows).withColumn("valuenum", F.lit("not a number"))
    out = extract_events(df, EVENTS["hosp/labevents"]).filter(F.col("code").startswith("LAB//RESULT")).first()
    assert out.numeric_value is None and out.text_value == "x"


def test_static_kept_dynamic_null_dropped(spark):
    pat = spark.createDataFrame([(1, "F", "2100", None), (2, None, "x", "2001-02-03")],
                                "subject_id bigint, gender string, year_of_birth string, dod string")
    got = sorted((r.subject_id, r.code, r.time) for r in extract_events(pat, EVENTS["hosp/patients"]).collect())
    assert got == [(1, "GENDER//F", None), (1, "MEDS_BIRTH", T(2100, 1, 1)),
                   (2, "GENDER//UNK", None), (2, "MEDS_DEATH", T(2001, 2, 3))]


@pytest.mark.parametrize("prefix", sorted(EVENTS))
def test_every_table_compiles_on_empty_input(spark, prefix):
    df = spark.createDataFrame([], RAW[prefix])
    assert extract_events(df, EVENTS[prefix]).count() == 0


def test_typed_times_keep_fractions(spark):
    """Times that a file has typed reach the events as they are, whatever their type."""
    rows = [(1, "2020-01-01 00:00:00.2"), (1, "2020-01-01 00:00:00.7"), (2, None)]
    text = spark.createDataFrame(rows, "subject_id long, t string").withColumn("medication", F.lit("x"))
    for kind, times in (("timestamp_ntz", {200_000, 700_000}), ("timestamp", {200_000, 700_000}), ("date", {0})):
        typed = conform(text.withColumn("charttime", F.col("t").cast(kind)).drop("t"), RAW["hosp/emar"])
        out = extract_events(typed, EVENTS["hosp/emar"]).dropDuplicates().collect()
        assert {r["time"].microsecond for r in out} == times and len(out) == len(times)


def test_death_time_of_typed_and_text_files(spark):
    from cohortline.operators.prepare import fix_static

    admissions = spark.createDataFrame([(1, "2020-01-02 03:04:05.5"), (2, None)], "subject_id long, deathtime string")
    admissions = admissions.withColumn("deathtime", F.col("deathtime").cast("timestamp_ntz"))
    patients = spark.createDataFrame([(1, "F", 30, 2150, "2020-01-03"), (2, "M", 40, 2150, "2021-05-06"), (3, "M", 1, 2150, "odd")],
                                     "subject_id long, gender string, anchor_age int, anchor_year int, dod string")
    out = {r["subject_id"]: r["dod"] for r in fix_static(patients, admissions).collect()}
    assert out == {1: T(2020, 1, 2, 3, 4, 5, 500_000), 2: T(2021, 5, 6), 3: None}
    dated = patients.withColumn("dod", F.expr("try_cast(dod AS date)"))
    assert {r["subject_id"]: r["dod"] for r in fix_static(dated, admissions).collect()} == out
