"""Incremental extraction: a second run processes only the new files."""

from conftest import SF_SMALL
from cohortline.operators.prepare import add_discharge_time
from cohortline.sources import fixtures as fx
from cohortline.streaming import stream_table_events


def test_incremental_runs(spark, tmp_path):
    landed, out, ckpt = str(tmp_path / "landed"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    labs = fx.labevents(spark, SF_SMALL)
    first, second = labs.filter("subject_id % 2 = 0"), labs.filter("subject_id % 2 = 1")
    first.write.mode("append").parquet(f"{landed}/hosp/labevents.parquet")
    q = stream_table_events(spark, landed, "hosp/labevents", out, ckpt)
    q.awaitTermination()
    n1 = spark.read.parquet(f"{out}/hosp/labevents").count()
    second.write.mode("append").parquet(f"{landed}/hosp/labevents.parquet")
    q = stream_table_events(spark, landed, "hosp/labevents", out, ckpt)
    q.awaitTermination()
    n2 = spark.read.parquet(f"{out}/hosp/labevents").count()
    from cohortline.operators.events import extract_events
    from cohortline.plans.event_spec import EVENTS
    assert n1 == extract_events(first, EVENTS["hosp/labevents"]).count()
    assert n2 == extract_events(labs, EVENTS["hosp/labevents"]).count()


def test_stream_static_preparation_join(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    fx.diagnoses_icd(spark, SF_SMALL).write.parquet(f"{landed}/hosp/diagnoses_icd.parquet")
    adm = fx.admissions(spark, SF_SMALL)
    q = stream_table_events(spark, landed, "hosp/diagnoses_icd", out, str(tmp_path / "ckpt"),
                            prepare=lambda s: add_discharge_time(s, adm))
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/hosp/diagnoses_icd")
    from cohortline.plans.queries import QUERIES
    expected = QUERIES["events_diagnoses"](spark, SF_SMALL)
    assert got.count() == expected.count() and got.exceptAll(expected.select(*got.columns)).count() == 0


def test_stream_of_typed_times(spark, tmp_path):
    """Files with typed times, fractions of a second included."""
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    spark.sql("SELECT 1L AS subject_id, 'x' AS medication, TIMESTAMP_NTZ '2020-01-01 00:00:00.2' AS charttime UNION ALL "
              "SELECT 1L, 'x', TIMESTAMP_NTZ '2020-01-01 00:00:00.7'").write.parquet(f"{landed}/hosp/emar.parquet")
    stream_table_events(spark, landed, "hosp/emar", out).awaitTermination()
    got = spark.read.parquet(f"{out}/hosp/emar").collect()
    assert {r["time"].microsecond for r in got} == {200_000, 700_000}
