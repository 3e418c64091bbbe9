"""A user's own event specification, wanted columns only, and the fixed catalogue schema."""

from pyspark.sql import functions as F

from cohortline.operators.events import extract_events
from cohortline.operators.metadata import catalogue
from cohortline.plans import etl
from cohortline.plans.event_spec import EVENTS
from cohortline.sources import fixtures as fx

SPEC = {
    "clinic/visits": {
        "visit": {"code": ["VISIT", "col(kind)"], "time": "col(at)", "time_format": "%Y-%m-%d", "room": "room",
                  "_metadata": {"clinic/kinds": {"kind": "kind_id", "description": "label"}}},
    },
}


def test_new_table_and_value_column_reach_the_cohort(spark, tmp_path):
    raw = tmp_path / "raw" / "clinic"
    raw.mkdir(parents=True)
    (raw / "visits.csv").write_text("subject_id,kind,at,room\n1,A,2150-01-01,7b\n2,,2150-01-02,\n2,B,never,1\n")
    (raw / "kinds.csv").write_text("kind_id,label\nA,Annual\n")
    (raw / "other.csv").write_text("x\n1\n")
    paths = etl.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), spec=SPEC)
    rows = spark.read.parquet(paths["data"]).select("subject_id", "code", F.col("time").cast("string"), "room").collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, "VISIT//A", "2150-01-01 00:00:00", "7b"), (2, "VISIT//UNK", "2150-01-02 00:00:00", None)]
    codes = spark.read.parquet(paths["codes"])
    assert codes.columns == ["code", "description", "parent_codes", "possibly_cpt_code"]
    assert {(r.code, r.description) for r in codes.collect()} == {("VISIT//A", "Annual"), ("VISIT//UNK", None)}


def test_wanted_columns_prune_the_scan(spark):
    sf = "/root/testdata/sf0.001"
    events = extract_events(fx.labevents(spark, sf), EVENTS["hosp/labevents"], columns=["code"])
    assert events.columns == ["code"]
    physical = events.distinct()._jdf.queryExecution().executedPlan().toString()
    schema = physical[physical.index("ReadSchema"):].splitlines()[0]
    assert "props" not in schema and "value" not in schema and "event_id" in schema


def test_catalogue_columns_do_not_depend_on_dictionaries(spark):
    observed = spark.createDataFrame([("A",)], "code string")
    assert catalogue(observed, None).columns == ["code", "description", "parent_codes", "possibly_cpt_code"]
