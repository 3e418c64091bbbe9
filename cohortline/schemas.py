"""Declared schemas: raw tables, dictionaries and the event output row.

The source tables are text-first (CSV); types below are our declaration (D14):
identifiers that are arithmetic keys are BIGINT, code-like columns stay STRING so
leading zeros survive, all times are text parsed by the event specification.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW: dict[str, T.StructType] = {
    "hosp/admissions": _schema(
        ("subject_id", L), ("hadm_id", L), ("admittime", S), ("dischtime", S), ("deathtime", S),
        ("edregtime", S), ("edouttime", S), ("admission_type", S), ("admission_location", S),
        ("discharge_location", S), ("insurance", S), ("language", S), ("marital_status", S), ("race", S),
    ),
    "hosp/patients": _schema(
        ("subject_id", L), ("gender", S), ("anchor_age", I), ("anchor_year", I), ("dod", S),
    ),
    "hosp/diagnoses_icd": _schema(
        ("subject_id", L), ("hadm_id", L), ("seq_num", I), ("icd_code", S), ("icd_version", I),
    ),
    "hosp/procedures_icd": _schema(
        ("subject_id", L), ("hadm_id", L), ("seq_num", I), ("chartdate", S), ("icd_code", S), ("icd_version", I),
    ),
    "hosp/drgcodes": _schema(
        ("subject_id", L), ("hadm_id", L), ("drg_type", S), ("drg_code", S), ("description", S),
        ("drg_severity", S), ("drg_mortality", S),
    ),
    "hosp/emar": _schema(
        ("subject_id", L), ("hadm_id", L), ("emar_id", S), ("emar_seq", S), ("charttime", S),
        ("medication", S), ("event_txt", S),
    ),
    "hosp/hcpcsevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("chartdate", S), ("hcpcs_cd", S), ("short_description", S),
    ),
    "hosp/labevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("itemid", L), ("charttime", S), ("storetime", S),
        ("value", S), ("valuenum", D), ("valueuom", S), ("priority", S),
    ),
    "hosp/omr": _schema(
        ("subject_id", L), ("chartdate", S), ("result_name", S), ("result_value", S),
    ),
    "hosp/pharmacy": _schema(
        ("subject_id", L), ("hadm_id", L), ("starttime", S), ("stoptime", S), ("medication", S),
        ("route", S), ("frequency", S), ("doses_per_24_hrs", S), ("poe_id", S),
    ),
    "hosp/transfers": _schema(
        ("subject_id", L), ("hadm_id", L), ("intime", S), ("eventtype", S), ("careunit", S),
    ),
    "icu/icustays": _schema(
        ("subject_id", L), ("hadm_id", L), ("stay_id", L), ("intime", S), ("outtime", S),
        ("first_careunit", S), ("last_careunit", S),
    ),
    "icu/chartevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("stay_id", L), ("itemid", L), ("charttime", S),
        ("value", S), ("valuenum", D), ("valueuom", S),
    ),
    "icu/procedureevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("stay_id", L), ("itemid", L), ("starttime", S), ("endtime", S),
    ),
    "icu/inputevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("stay_id", L), ("itemid", L), ("starttime", S), ("endtime", S),
        ("orderid", L), ("linkorderid", L), ("rate", D), ("rateuom", S), ("amount", D), ("amountuom", S),
        ("patientweight", D), ("ordercategorydescription", S), ("statusdescription", S),
    ),
    "icu/outputevents": _schema(
        ("subject_id", L), ("hadm_id", L), ("stay_id", L), ("itemid", L), ("charttime", S),
        ("value", D), ("valueuom", S),
    ),
}

_OMOP = (("label", S), ("omop_concept_name", S), ("omop_vocabulary_id", S), ("omop_concept_code", S))
ITEM_KEY = "itemid (omop_source_code)"

# Dictionaries are read as text (the ICD ones must keep leading zeros).
DICTIONARIES: dict[str, T.StructType] = {
    "hosp/d_icd_diagnoses": _schema(("icd_code", S), ("icd_version", S), ("long_title", S)),
    "hosp/d_icd_procedures": _schema(("icd_code", S), ("icd_version", S), ("long_title", S)),
    "hosp/d_hcpcs": _schema(("code", S), ("category", S), ("long_description", S), ("short_description", S)),
    "d_labitems_to_loinc": _schema((ITEM_KEY, S), ("valueuom", S), *_OMOP),
    "inputevents_to_rxnorm": _schema((ITEM_KEY, S), *_OMOP),
    "outputevents_to_loinc": _schema((ITEM_KEY, S), ("unitname", S), *_OMOP),
    "proc_datetimeevents": _schema((ITEM_KEY, S), *_OMOP),
    "proc_itemid": _schema((ITEM_KEY, S), *_OMOP),
}

# The event row (D5): core columns first, then extension columns in a fixed order.
CORE_COLUMNS: list[tuple[str, T.DataType]] = [
    ("subject_id", L), ("time", T.TimestampNTZType()), ("code", S), ("numeric_value", T.FloatType()),
    ("text_value", S),
]
EXTENSION_COLUMNS: list[tuple[str, T.DataType]] = [
    ("hadm_id", L), ("icustay_id", L), ("order_id", L), ("link_order_id", L),
    ("insurance", S), ("language", S), ("marital_status", S), ("race", S), ("drg_severity", S),
    ("drg_mortality", S), ("emar_id", S), ("emar_seq", S), ("priority", S), ("route", S),
    ("frequency", S), ("doses_per_24_hrs", S), ("poe_id", S), ("unit", S),
    ("ordercategorydescription", S), ("statusdescription", S),
]
EVENT_COLUMNS = CORE_COLUMNS + EXTENSION_COLUMNS
EVENT_TYPES: dict[str, T.DataType] = dict(EVENT_COLUMNS)

SPLITS_SCHEMA = _schema(("subject_id", L), ("split", S), ("shard", I))
