"""DuckDB SQL for the registered queries (the correctness oracle).

The fixture views of FIXTURES.md section 6 are written here once more, in DuckDB's
dialect, and the event specification is rendered as plain SQL (one SELECT per
event, UNION ALL), so every Spark query is checked against an independent engine.
"""

from __future__ import annotations

from cohortline.functions.codes import CODE_SEPARATOR, NULL_PART, code_parts, column_ref
from cohortline.operators.events import value_columns
from cohortline.schemas import EVENT_TYPES
from pyspark.sql import types as T

FIXTURE_SQL = {
    "admissions": """
SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, CAST(o_orderdate AS VARCHAR) AS admittime,
 CAST(o_orderdate + INTERVAL '5' DAY AS VARCHAR) AS dischtime,
 CASE WHEN o_orderstatus = 'F' AND o_orderkey % 40 = 0 THEN CAST(o_orderdate + INTERVAL '3' DAY AS VARCHAR) END AS deathtime,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS VARCHAR) END AS edregtime,
 CAST(NULL AS VARCHAR) AS edouttime,
 o_orderpriority AS admission_type,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS admission_location,
 CAST(NULL AS VARCHAR) AS discharge_location, CAST(NULL AS VARCHAR) AS insurance,
 CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS marital_status, CAST(NULL AS VARCHAR) AS race
FROM orders""",
    "patients": """
SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
 20 + c_nationkey AS anchor_age, 2150 AS anchor_year, CASE WHEN c_custkey % 9 = 0 THEN '2003-06-01' END AS dod
FROM customer""",
    "diagnoses_icd": """
SELECT o_custkey AS subject_id, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_orderkey END AS hadm_id,
 l_linenumber AS seq_num, CASE WHEN l_partkey % 5 = 0 THEN 'E' WHEN l_partkey % 5 = 1 THEN 'V' ELSE '' END
 || CAST(10 + l_partkey AS VARCHAR) AS icd_code, CASE WHEN l_partkey % 2 = 0 THEN 9 ELSE 10 END AS icd_version
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "d_icd_diagnoses": """
SELECT CASE WHEN p_partkey % 5 = 0 THEN 'E' WHEN p_partkey % 5 = 1 THEN 'V' ELSE '' END
 || CAST(10 + p_partkey AS VARCHAR) AS icd_code,
 CASE WHEN p_partkey % 2 = 0 THEN '9' ELSE '10' END AS icd_version, p_name AS long_title
FROM part""",
    "labevents": """
SELECT user_id AS subject_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS hadm_id,
 51000 + event_id % 20000 AS itemid, CAST(date_trunc('second', ts) AS VARCHAR) AS charttime,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) + INTERVAL '1' HOUR AS VARCHAR) END AS storetime,
 CAST(props AS VARCHAR) AS value, value AS valuenum,
 CASE WHEN event_id % 20 < 5 THEN NULL ELSE 'mg/dL' END AS valueuom, event_type AS priority
FROM events""",
    "d_labitems_to_loinc": """
SELECT CAST(51000 + p_partkey AS VARCHAR) AS "itemid (omop_source_code)",
 CASE WHEN p_partkey % 20 < 5 THEN NULL ELSE 'mg/dL' END AS valueuom,
 p_brand AS label, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS omop_concept_name,
 'LOINC' AS omop_vocabulary_id, p_type AS omop_concept_code
FROM part""",
    "inputevents": """
SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_suppkey AS stay_id, l_partkey AS itemid,
 CAST(l_shipdate AS VARCHAR) AS starttime, CAST(l_shipdate + INTERVAL '2' HOUR AS VARCHAR) AS endtime,
 CAST(NULL AS BIGINT) AS orderid, CAST(NULL AS BIGINT) AS linkorderid,
 l_discount AS rate, 'mL/hour' AS rateuom, l_quantity AS amount, 'mL' AS amountuom, l_tax AS patientweight,
 CAST(NULL AS VARCHAR) AS ordercategorydescription, CAST(NULL AS VARCHAR) AS statusdescription
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "omr": """
SELECT user_id AS subject_id, strftime(ts, '%Y-%m-%d') AS chartdate,
 CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS result_name, CAST(props AS VARCHAR) AS result_value
FROM events""",
    "proc_datetimeevents": """
SELECT CAST(p_partkey AS VARCHAR) AS "itemid (omop_source_code)", p_brand AS label,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS omop_concept_name,
 'SNOMED' AS omop_vocabulary_id, p_type AS omop_concept_code
FROM part""",
    "proc_itemid": """
SELECT CAST(p_partkey AS VARCHAR) AS "itemid (omop_source_code)", p_brand AS label,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS omop_concept_name,
 'LOINC' AS omop_vocabulary_id, CAST(p_size AS VARCHAR) AS omop_concept_code
FROM part""",
    "death_times": "SELECT subject_id, min(deathtime) AS deathtime FROM admissions GROUP BY subject_id",
    "patients_prepared": """
SELECT p.subject_id, coalesce(d.deathtime, p.dod) AS dod,
 CAST(p.anchor_year - p.anchor_age AS VARCHAR) AS year_of_birth, p.gender
FROM patients p LEFT JOIN death_times d ON p.subject_id = d.subject_id""",
    "diagnoses_prepared": """
SELECT x.*, a.dischtime AS hadm_discharge_time
FROM diagnoses_icd x LEFT JOIN admissions a ON x.hadm_id = a.hadm_id""",
}

# Which fixture views each view needs (they are emitted in this order).
_DEPENDS = {
    "patients_prepared": ["admissions", "patients", "death_times"],
    "death_times": ["admissions"],
    "diagnoses_prepared": ["admissions", "diagnoses_icd"],
}


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the named fixture views (and what they need), then ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


_SQL_TYPES = {T.LongType: "BIGINT", T.StringType: "VARCHAR", T.FloatType: "FLOAT", T.TimestampNTZType: "TIMESTAMP"}


def _sql_type(dt: T.DataType) -> str:
    return _SQL_TYPES[type(dt)]


def _pattern(fmt: str) -> str:
    return fmt.replace("'", "''")


def _quote_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def time_sql(source: str, formats) -> str:
    if isinstance(formats, str):
        formats = [formats]
    parts = [f"try_strptime(CAST({source} AS VARCHAR), '{_pattern(f)}')" for f in formats]
    return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"


def code_sql(code, available: set[str] | None = None) -> tuple[str, str]:
    """(code expression, keep condition) in SQL; rule D1."""
    exprs, keep = [], "TRUE"
    for i, part in enumerate(code_parts(code)):
        name = column_ref(part)
        if name is None:
            exprs.append("'" + part.replace("'", "''") + "'")
            continue
        ref = f"CAST({_quote_ident(name)} AS VARCHAR)" if available is None or name in available else "CAST(NULL AS VARCHAR)"
        if i == 0:
            keep = f"{ref} IS NOT NULL"
            exprs.append(ref)
        else:
            exprs.append(f"coalesce({ref}, '{NULL_PART}')")
    if len(exprs) == 1:
        return exprs[0], keep
    return f" || '{CODE_SEPARATOR}' || ".join(exprs), keep


def events_sql(source_view: str, events: dict[str, dict], columns: list[str] | None = None,
               available: set[str] | None = None) -> str:
    """UNION ALL of one SELECT per event over ``source_view`` (rules B3-B5, D1-D3, D5)."""
    columns = columns or value_columns(events)
    selects = []
    for ev in events.values():
        code, keep = code_sql(ev["code"], available)
        if ev.get("time") is None:
            time = "CAST(NULL AS TIMESTAMP)"
        else:
            name = column_ref(ev["time"]) or ev["time"]
            time = time_sql(_quote_ident(name), ev.get("time_format"))
            keep = f"({keep}) AND {time} IS NOT NULL"
        fields = []
        for col in columns:
            typ = _sql_type(EVENT_TYPES[col])
            if col == "subject_id":
                expr = "CAST(subject_id AS BIGINT)"
            elif col == "time":
                expr = time
            elif col == "code":
                expr = code
            elif col in ev:
                src = column_ref(ev[col]) or ev[col]
                if available is not None and src not in available:
                    expr = f"CAST(NULL AS {typ})"
                elif typ == "VARCHAR":
                    expr = f"CAST({_quote_ident(src)} AS VARCHAR)"
                else:
                    expr = f"TRY_CAST({_quote_ident(src)} AS {typ})"
            else:
                expr = f"CAST(NULL AS {typ})"
            fields.append(f"{expr} AS {col}")
        selects.append(f"SELECT {', '.join(fields)} FROM {source_view} WHERE {keep}")
    return "\nUNION ALL\n".join(selects)
