"""Preparation joins (C1, C2, AG1) and ICD dictionary normalisation (H2, H3, H6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.icd import icd_diagnosis_dot, icd_procedure_dot
from cohortline.functions.times import parse_time
from cohortline.operators.joins import lookup_join


def add_discharge_time(df: DataFrame, admissions: DataFrame,
                       out_column: str = "hadm_discharge_time") -> DataFrame:
    """Left-join the admission's discharge time by ``hadm_id``.

    Null ``hadm_id`` never matches; such rows keep a null time (and their events
    are later dropped by the null-time rule).
    """
    lookup = admissions.select("hadm_id", F.col("dischtime").alias(out_column))
    return lookup_join(df, lookup, "hadm_id")


def death_times(admissions: DataFrame) -> DataFrame:
    """Earliest in-hospital death time per subject (AG1); text min, nulls skipped.

    Partial aggregation runs before the shuffle, so a subject with very many
    admissions costs one row per map task, not one row per admission.
    """
    return admissions.groupBy("subject_id").agg(F.min("deathtime").alias("deathtime"))


# The text formats of a death time, in order.
DEATH_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d"]


def _comparable(joined: DataFrame, name: str) -> Column:
    types = {joined.schema[n].dataType for n in ("deathtime", "dod")}
    if len(types) == 1:
        return F.col(name)
    return parse_time(F.col(name), DEATH_FORMATS, joined.schema[name].dataType)


def fix_static(patients: DataFrame, admissions: DataFrame) -> DataFrame:
    """Patients with death time (coalesce of in-hospital death and ``dod``) and a
    year of birth ``anchor_year - anchor_age`` as text (C2, H4, H5). Where one of the two
    files has typed times and the other text, both become times."""
    joined = lookup_join(patients, death_times(admissions), "subject_id")
    in_hospital, dod = (_comparable(joined, n) for n in ("deathtime", "dod"))
    return joined.select(
        "subject_id",
        F.coalesce(in_hospital, dod).alias("dod"),
        (F.col("anchor_year") - F.col("anchor_age")).cast("string").alias("year_of_birth"),
        "gender",
    )


def normalize_icd(dictionary: DataFrame, kind: str) -> DataFrame:
    """Add ``norm_icd_code`` to an ICD dictionary: ``kind`` is "diagnoses" or "procedures"."""
    fn = {"diagnoses": icd_diagnosis_dot, "procedures": icd_procedure_dot}[kind]
    version, code = F.col("icd_version").cast("string"), F.col("icd_code").cast("string")
    return dictionary.withColumn("norm_icd_code", fn(version, code))


# Which prepared table depends on which lookup, and how (the preparation dispatch).
PREPARATION = {
    "hosp/diagnoses_icd": (add_discharge_time, "hosp/admissions"),
    "hosp/procedures_icd": (add_discharge_time, "hosp/admissions"),
    "hosp/drgcodes": (add_discharge_time, "hosp/admissions"),
    "hosp/patients": (fix_static, "hosp/admissions"),
}
ICD_DICTIONARIES = {"hosp/d_icd_diagnoses": "diagnoses", "hosp/d_icd_procedures": "procedures"}
