"""Registered queries of the ten further event tables and of their dictionaries' metadata.

Their SQL is written by hand over the driver's tables: it uses neither the event
specification nor the code that reads it, so an error there shows up as a mismatch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators import metadata as meta_ops
from cohortline.operators import prepare as prep_ops
from cohortline.operators.events import extract_events
from cohortline.plans.event_spec import EVENTS
from cohortline.plans.queries import query
from cohortline.sources import fixtures as fx
from cohortline.sources import fixtures_events as fe

_NO_VALUES = "CAST(NULL AS FLOAT) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value"
_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_SECOND = "date_trunc('second', ts)"


@query("events_drg", f"""
SELECT o.o_custkey AS subject_id, a.o_orderdate + INTERVAL '5' DAY AS time,
  'DRG//' || o.o_orderstatus || '//' || CASE WHEN o.o_orderkey % 5 = 0 THEN 'UNK' ELSE CAST(o.o_orderkey % 1000 AS VARCHAR) END
    || '//' || o.o_orderpriority AS code, {_NO_VALUES}, o.o_orderkey AS hadm_id,
  CAST(o.o_orderkey % 4 AS VARCHAR) AS drg_severity,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(o.o_orderkey % 5 AS VARCHAR) END AS drg_mortality
FROM orders o JOIN orders a ON a.o_orderkey = o.o_orderkey AND o.o_orderkey % 11 <> 0""")
def events_drg(spark, d):
    """K0 event 6 (after the discharge-time join; rows without an admission drop out)."""
    return extract_events(prep_ops.add_discharge_time(fe.drgcodes(spark, d), fx.admissions(spark, d)),
                          EVENTS["hosp/drgcodes"])


@query("events_emar", f"""
SELECT user_id AS subject_id, {_SECOND} AS time,
  'MEDICATION//' || CASE WHEN event_id % 9 = 0 THEN 'UNK' ELSE event_type END
    || '//' || CASE WHEN event_id % 8 = 0 THEN 'UNK' ELSE 'Administered' END AS code, {_NO_VALUES},
  event_id AS hadm_id, user_id || '-' || event_id AS emar_id, CAST(event_id % 7 AS VARCHAR) AS emar_seq
FROM events""")
def events_emar(spark, d):
    """K0 event 7."""
    return extract_events(fe.emar(spark, d), EVENTS["hosp/emar"])


@query("events_hcpcs", f"""
SELECT o_custkey AS subject_id, date_trunc('day', o_orderdate)::TIMESTAMP AS time,
  'HCPCS//' || CASE WHEN o_orderkey % 6 = 0 THEN 'UNK' ELSE 'S' || (o_orderkey % 5000) END AS code, {_NO_VALUES},
  o_orderkey AS hadm_id
FROM orders""")
def events_hcpcs(spark, d):
    """K0 event 8 (a date without a time of day)."""
    return extract_events(fe.hcpcsevents(spark, d), EVENTS["hosp/hcpcsevents"])


_DRUG = "CASE WHEN event_id % 9 = 0 THEN 'UNK' ELSE event_type END"


@query("events_pharmacy", f"""
SELECT user_id AS subject_id,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts)::TIMESTAMP ELSE {_SECOND} END AS time,
  'MEDICATION//START//' || {_DRUG} AS code, {_NO_VALUES},
  CASE WHEN event_id % 4 = 0 THEN 'IV' ELSE 'PO' END AS route, 'BID' AS frequency,
  CAST(event_id % 4 AS VARCHAR) AS doses_per_24_hrs, user_id || '-' || event_id AS poe_id
FROM events
UNION ALL
SELECT user_id, {_SECOND} + INTERVAL '1' HOUR, 'MEDICATION//STOP//' || {_DRUG}, {_NO_VALUES},
  NULL, NULL, NULL, user_id || '-' || event_id
FROM events WHERE event_id % 5 <> 0""")
def events_pharmacy(spark, d):
    """K0 events 15-16 (two time formats, one scan)."""
    return extract_events(fe.pharmacy(spark, d), EVENTS["hosp/pharmacy"])


@query("events_procedures", f"""
SELECT o.o_custkey AS subject_id, a.o_orderdate + INTERVAL '5' DAY AS time,
  'PROCEDURE//ICD//' || CASE WHEN o.o_orderkey % 2 = 0 THEN '9' ELSE '10' END || '//' || (1000 + o.o_orderkey % 5000) AS code,
  {_NO_VALUES}, o.o_orderkey AS hadm_id
FROM orders o JOIN orders a ON a.o_orderkey = o.o_orderkey AND o.o_orderkey % 11 <> 0""")
def events_procedures(spark, d):
    """K0 event 17 (after the discharge-time join)."""
    return extract_events(prep_ops.add_discharge_time(fe.procedures_icd(spark, d), fx.admissions(spark, d)),
                          EVENTS["hosp/procedures_icd"])


@query("events_transfers", f"""
SELECT user_id AS subject_id, {_SECOND} AS time,
  'TRANSFER_TO//' || event_type || '//' || CASE WHEN event_id % 5 = 0 THEN 'UNK' ELSE 'Unit ' || (event_id % 6) END AS code,
  {_NO_VALUES}, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS hadm_id
FROM events""")
def events_transfers(spark, d):
    """K0 event 18."""
    return extract_events(fe.transfers(spark, d), EVENTS["hosp/transfers"])


@query("events_icustays", f"""
SELECT o_custkey AS subject_id, CAST(o_orderdate AS TIMESTAMP) AS time, 'ICU_ADMISSION//' || o_orderpriority AS code,
  {_NO_VALUES}, o_orderkey AS hadm_id, o_orderkey * 10 AS icustay_id
FROM orders
UNION ALL
SELECT o_custkey, o_orderdate + INTERVAL '2' DAY,
  'ICU_DISCHARGE//' || CASE WHEN o_orderkey % 7 = 0 THEN 'UNK' ELSE o_orderstatus END, {_NO_VALUES}, o_orderkey, o_orderkey * 10
FROM orders WHERE o_orderkey % 8 <> 0""")
def events_icustays(spark, d):
    """K0 events 19-20."""
    return extract_events(fe.icustays(spark, d), EVENTS["icu/icustays"])


@query("events_chart", f"""
SELECT o_custkey AS subject_id, CAST(l_shipdate AS TIMESTAMP) AS time,
  'LAB//' || l_partkey || '//' || CASE WHEN l_partkey % 2 = 0 THEN 'UNK' ELSE 'mmHg' END AS code,
  CAST(l_quantity AS FLOAT) AS numeric_value, CAST(l_linenumber AS VARCHAR) AS text_value,
  l_orderkey AS hadm_id, l_suppkey AS icustay_id
{_LINES}""")
def events_chart(spark, d):
    """K0 event 21."""
    return extract_events(fe.chartevents(spark, d), EVENTS["icu/chartevents"])


@query("events_icu_procedures", f"""
SELECT o_custkey AS subject_id, CAST(l_shipdate AS TIMESTAMP) AS time, 'PROCEDURE//START//' || l_partkey AS code,
  {_NO_VALUES}, l_orderkey AS hadm_id, l_suppkey AS icustay_id
{_LINES}
UNION ALL
SELECT o_custkey, l_shipdate + INTERVAL '1' HOUR, 'PROCEDURE//END//' || l_partkey, {_NO_VALUES}, l_orderkey, l_suppkey
{_LINES} WHERE l_linenumber % 3 <> 0""")
def events_icu_procedures(spark, d):
    """K0 events 22-23."""
    return extract_events(fe.procedureevents(spark, d), EVENTS["icu/procedureevents"])


@query("events_outputs", f"""
SELECT user_id AS subject_id, {_SECOND} AS time,
  'SUBJECT_FLUID_OUTPUT//' || (event_id % 30000) || '//' || CASE WHEN event_id % 3 = 0 THEN 'UNK' ELSE 'mL' END AS code,
  CAST(value AS FLOAT) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value, event_id AS hadm_id, user_id AS icustay_id
FROM events""")
def events_outputs(spark, d):
    """K0 event 27."""
    return extract_events(fe.outputevents(spark, d), EVENTS["icu/outputevents"])


# ------------------------------------------------- dictionaries of these tables

def _codes(events: dict, df: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Observed codes of a table with the metadata of its dictionaries; lists as text."""
    observed = meta_ops.observed_codes(extract_events(df, events, columns=["code"]))
    out = meta_ops.catalogue(observed, meta_ops.all_dictionary_codes({"table": events}, dictionaries))
    return out.select("code", "description", *[F.array_join(c, "|").alias(c) for c in ("parent_codes", "possibly_cpt_code")])


_NAME = "CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END"


@query("code_metadata_hcpcs", """
SELECT o.code, m.description, NULL AS parent_codes, m.possibly_cpt_code FROM (
  SELECT DISTINCT 'HCPCS//' || CASE WHEN o_orderkey % 6 = 0 THEN 'UNK' ELSE 'S' || (o_orderkey % 5000) END AS code FROM orders) o
LEFT JOIN (SELECT 'HCPCS//S' || p_partkey AS code, p_name AS description, CAST(p_partkey AS VARCHAR) AS possibly_cpt_code
  FROM part) m ON o.code = m.code""")
def code_metadata_hcpcs(spark, d):
    """C3 for the HCPCS codes, with ``possibly_cpt_code``."""
    return _codes(EVENTS["hosp/hcpcsevents"], fe.hcpcsevents(spark, d), {"hosp/d_hcpcs": fe.d_hcpcs(spark, d)})


@query("code_metadata_outputs", f"""
SELECT o.code, m.description, m.parent_codes, NULL AS possibly_cpt_code FROM (
  SELECT DISTINCT 'SUBJECT_FLUID_OUTPUT//' || (event_id % 30000) || '//'
    || CASE WHEN event_id % 3 = 0 THEN 'UNK' ELSE 'mL' END AS code FROM events) o
LEFT JOIN (SELECT 'SUBJECT_FLUID_OUTPUT//' || p_partkey || '//' || CASE WHEN p_partkey % 3 = 0 THEN 'UNK' ELSE 'mL' END AS code,
    {_NAME} AS description, 'LOINC/' || p_type AS parent_codes FROM part) m ON o.code = m.code""")
def code_metadata_outputs(spark, d):
    """C3 for the output codes; the dictionary's unit column has another name."""
    return _codes(EVENTS["icu/outputevents"], fe.outputevents(spark, d),
                  {"outputevents_to_loinc": fe.outputevents_to_loinc(spark, d)})


@query("code_metadata_infusions", f"""
SELECT o.code, m.description, m.parent_codes, NULL AS possibly_cpt_code FROM (
  SELECT DISTINCT k.kind || l_partkey AS code FROM lineitem, (VALUES ('INFUSION_START//'), ('INFUSION_END//')) k(kind)
  UNION ALL SELECT 'SUBJECT_WEIGHT_AT_INFUSION//KG') o
LEFT JOIN (SELECT k.kind || p_partkey AS code, {_NAME} AS description, 'RxNorm/' || p_type AS parent_codes
  FROM part, (VALUES ('INFUSION_START//'), ('INFUSION_END//')) k(kind)) m ON o.code = m.code""")
def code_metadata_infusions(spark, d):
    """C3 for the infusion codes."""
    return _codes(EVENTS["icu/inputevents"], fx.inputevents(spark, d),
                  {"inputevents_to_rxnorm": fe.inputevents_to_rxnorm(spark, d)})


@query("code_metadata_procedures", """
SELECT o.code, m.description, m.parent_codes, NULL AS possibly_cpt_code FROM (
  SELECT DISTINCT 'PROCEDURE//ICD//' || CASE WHEN o_orderkey % 2 = 0 THEN '9' ELSE '10' END || '//' || (1000 + o_orderkey % 5000) AS code
  FROM orders WHERE o_orderkey % 11 <> 0) o
LEFT JOIN (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'PROCEDURE//ICD//9//' ELSE 'PROCEDURE//ICD//10//' END || (1000 + p_partkey) AS code,
    p_name AS description,
    CASE WHEN p_partkey % 2 = 0
         THEN 'ICD9Proc/' || substr(CAST(1000 + p_partkey AS VARCHAR), 1, 2) || '.' || substr(CAST(1000 + p_partkey AS VARCHAR), 3)
         ELSE 'ICD10PCS/' || (1000 + p_partkey) END AS parent_codes FROM part) m ON o.code = m.code""")
def code_metadata_procedures(spark, d):
    """C3 for the procedure codes; the parent template depends on the ICD version."""
    prepared = prep_ops.add_discharge_time(fe.procedures_icd(spark, d), fx.admissions(spark, d))
    return _codes(EVENTS["hosp/procedures_icd"], prepared,
                  {"hosp/d_icd_procedures": prep_ops.normalize_icd(fe.d_icd_procedures(spark, d), "procedures")})
