"""End-to-end ETL over raw files (the output contract), cohort order, plans, null keys."""

import glob
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cohortline.operators import cohort as cohort_ops
from cohortline.operators.joins import lookup_join
from cohortline.session import scratch_dir
from cohortline.plans import etl
from cohortline.sources import fixtures as fx
from cohortline.sources.readers import discover_prefixes, read_table, resolve_prefix
from cohortline.schemas import RAW


def _csv(df, path, gz=False):
    w = df.coalesce(1).write.mode("overwrite").option("header", "true")
    if gz:
        w = w.option("compression", "gzip")
    w.csv(path)


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    _csv(fx.admissions(spark, SF_SMALL), f"{root}/hosp/admissions.csv.gz", gz=True)
    fx.admissions(spark, SF_SMALL).limit(3).write.parquet(f"{root}/hosp/admissions.parquet")
    _csv(fx.patients(spark, SF_SMALL), f"{root}/hosp/patients.csv")
    fx.diagnoses_icd(spark, SF_SMALL).write.parquet(f"{root}/hosp/diagnoses_icd.parquet")
    _csv(fx.labevents(spark, SF_SMALL), f"{root}/hosp/labevents.csv")
    fx.inputevents(spark, SF_SMALL).write.parquet(f"{root}/icu/inputevents.parquet")
    fx.omr(spark, SF_SMALL).write.parquet(f"{root}/hosp/omr.parquet")
    _csv(fx.d_icd_diagnoses(spark, SF_SMALL), f"{root}/hosp/d_icd_diagnoses.csv")
    _csv(fx.d_labitems_to_loinc(spark, SF_SMALL), f"{root}/d_labitems_to_loinc.csv")
    return root


@pytest.fixture(scope="module")
def built(spark, raw_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    paths = etl.run(spark, raw_dir, out, dataset_name="demo", dataset_version="1:0", n_per_shard=40)
    return out, paths


def test_discovery_and_priority(spark, raw_dir):
    prefixes = discover_prefixes(spark, raw_dir)
    assert "hosp/admissions" in prefixes and prefixes.count("hosp/admissions") == 1
    path, fmt = resolve_prefix(spark, raw_dir, "hosp/admissions")
    assert fmt == "csv.gz" and path.endswith("hosp/admissions.csv.gz")
    with pytest.raises(FileNotFoundError):
        resolve_prefix(spark, raw_dir, "hosp/nothing")


def test_csv_typed_by_name(spark, raw_dir):
    df = read_table(spark, raw_dir, "hosp/patients", RAW["hosp/patients"])
    types = dict(df.dtypes)
    assert types["subject_id"] == "bigint" and types["anchor_age"] == "int" and types["dod"] == "string"
    assert df.count() == fx.patients(spark, SF_SMALL).count()


def test_csv_quotes_and_leading_zeros(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text('icd_code,icd_version,long_title\n0010,9,"Cholera, ""classic"""\n')
    df = read_table(spark, str(tmp_path), "d")
    assert [tuple(r) for r in df.collect()] == [("0010", "9", 'Cholera, "classic"')]


def test_output_contract(built):
    out, _ = built
    assert glob.glob(f"{out}/data/**/*.parquet", recursive=True)
    for name in ("codes.parquet", "subject_splits.parquet", "dataset.json"):
        assert os.path.exists(f"{out}/metadata/{name}")
    desc = json.loads(open(f"{out}/metadata/dataset.json").read())
    assert desc["dataset_name"] == "demo" and desc["dataset_version"] == "1:0" and "created_at" in desc


def test_cohort_rows_shards_order(spark, built, raw_dir):
    out, paths = built
    cohort = spark.read.parquet(paths["data"])
    splits = spark.read.parquet(paths["splits"])
    # every subject in exactly one shard, shards of at most 40 subjects
    per_shard = splits.groupBy("split", "shard").count().collect()
    assert max(r["count"] for r in per_shard) <= 40 and len(per_shard) > 3
    assert splits.count() == splits.select("subject_id").distinct().count()
    assert cohort.select("subject_id", "split", "shard").distinct().groupBy("subject_id").count() \
        .filter("count > 1").count() == 0
    # no exact duplicates, and same rows as the deduplicated union of events
    cols = [c for c in cohort.columns if c not in ("split", "shard")]
    assert cohort.count() == cohort.distinct().count()
    expected = etl.all_events(etl.prepare(etl.load_inputs(spark, raw_dir))).distinct()
    assert cohort.select(*cols).exceptAll(expected.select(*cols)).count() == 0
    assert expected.select(*cols).exceptAll(cohort.select(*cols)).count() == 0
    # every file sorted by subject, time (nulls first), code
    import pyarrow.parquet as pq
    for f in glob.glob(f"{paths['data']}/**/*.parquet", recursive=True):
        t = pq.read_table(f, columns=["subject_id", "time", "code"]).to_pylist()
        keys = [(r["subject_id"], r["time"] is not None, r["time"] or 0, r["code"]) for r in t]
        assert keys == sorted(keys, key=lambda k: (k[0], k[1], k[2] if k[1] else 0, k[3]))


def test_catalogue_keeps_observed_codes(spark, built):
    _, paths = built
    codes = spark.read.parquet(paths["codes"])
    cohort_codes = spark.read.parquet(paths["data"]).select("code").distinct()
    assert codes.count() == cohort_codes.count()
    diag = codes.filter(F.col("code").startswith("DIAGNOSIS//ICD//9//E")).filter(F.col("description").isNotNull()).first()
    assert diag is not None and diag["parent_codes"][0].startswith("ICD9CM/E")


def placed(spark, events, rows_per_task=cohort_ops.ROWS_PER_TASK):
    """Placement of events that have split and shard already."""
    sizes = events.groupBy("subject_id", "split", "shard").agg(F.count(F.lit(1)).alias("rows")).checkpoint()
    return cohort_ops.place(sizes, lambda: events.select("subject_id", "time"), scratch_dir(spark, "placement"), rows_per_task)


def with_shards(df):
    return df.withColumn("split", F.when(F.col("subject_id") % 3 > 0, F.lit("train")).otherwise(F.lit("held_out"))).withColumn(
        "shard", (F.col("subject_id") / 10).cast("int"))


def test_finalize_has_one_exchange_and_removes_duplicates(spark):
    rows = [(1, "a", None, 5), (1, "a", None, 5), (2, "b", 5, 0), (1, "c", 3, 7), (2, "b", 5, 0), (1, "c", 3, None), (1, "c", 3, None)]
    df = with_shards(spark.createDataFrame(rows, "subject_id bigint, code string, hadm_id bigint, s long").withColumn(
        "time", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s"))
    events = df.drop("split", "shard")
    out = cohort_ops.finalize(events, placed(spark, df))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 1 and plan.count("REPARTITION_BY_NUM") == 1
    got = [tuple(r) for r in out.select(*df.columns).collect()]
    assert sorted(got, key=str) == sorted(set(map(tuple, df.collect())), key=str)


def test_events_are_exchanged_once(spark):
    """With the subjects' places small enough to broadcast, the only exchange above the events is
    that by task."""
    from cohortline.plans import queries as Q

    placement = Q._placement(spark, SF_SMALL, scratch_dir(spark, "t"))
    from cohortline.operators.events import extract_events
    from cohortline.plans.event_spec import EVENTS
    events = extract_events(fx.labevents(spark, SF_SMALL), EVENTS["hosp/labevents"])
    plan = cohort_ops.finalize(events, placement)._jdf.queryExecution().executedPlan().toString()
    tree = plan.split("BroadcastHashJoin")[0]
    assert "BroadcastHashJoin" in plan and tree.count("Exchange") == 1 and "REPARTITION_BY_NUM" in tree


def test_tasks_have_equal_weight_and_the_cohort_order(spark):
    events = with_shards(spark.range(40_000).select(
        F.expr("CAST(floor(pow(rand(3), 3) * 200) AS BIGINT)").alias("subject_id"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("time"), F.lit("c").alias("code")).checkpoint())
    placement = placed(spark, events, 2_000)
    out = cohort_ops.finalize(events.drop("split", "shard"), placement).withColumn("p", F.spark_partition_id())
    rows = out.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("split", "shard", "subject_id")).alias("low"),
                                F.max(F.struct("split", "shard", "subject_id")).alias("high")).orderBy("p").collect()
    assert sum(r["n"] for r in rows) == 40_000 and placement.tasks == 20
    assert max(r["n"] for r in rows) <= 2 * 2_000 + 2_000
    assert all(a["high"] <= b["low"] for a, b in zip(rows, rows[1:]))


def test_place_of_no_events(spark):
    empty = spark.createDataFrame([], "subject_id bigint, split string, shard int, rows bigint")
    placement = cohort_ops.place(empty, lambda: None, scratch_dir(spark, "placement"))
    assert placement.tasks == 1 and placement.subjects.count() == 0


def test_lookup_join_spreads_null_keys(spark):
    """With the lookup too large to broadcast, null keys must not share one task."""
    left = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("hadm_id"), F.col("id").alias("v"))
    right = spark.range(0, 4000, 4).select(F.col("id").alias("hadm_id"), F.lit("t").alias("dischtime"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "false")
        out = lookup_join(left, right, "hadm_id")
        parts = out.filter(F.col("dischtime").isNull()).select(F.spark_partition_id()).distinct().count()
        assert out.count() == 4000 and out.filter(F.col("dischtime").isNotNull()).count() == 1000
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    assert parts > 1


def test_lookup_join_shuffle_path_routes_null_keys(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "subject_id bigint, hadm_id bigint")
    right = spark.createDataFrame([(10, "t10"), (11, "t11")], "hadm_id bigint, dischtime string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = lookup_join(left, right, "hadm_id")
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "Union" not in plan and "_null_salt" in plan and "SortMergeJoin" in plan
        got = sorted(tuple(r) for r in shuffled.select("subject_id", "dischtime").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == [(1, "t10"), (2, None), (3, "t11")]
    assert sorted(tuple(r) for r in lookup_join(left, right, "hadm_id").select("subject_id", "dischtime").collect()) == got


def test_missing_icd_dictionary_is_named(spark):
    diag = fx.diagnoses_icd(spark, SF_SMALL)
    adm = fx.admissions(spark, SF_SMALL)
    inputs = etl.Inputs({"hosp/diagnoses_icd": diag, "hosp/admissions": adm}, {})
    with pytest.raises(FileNotFoundError, match="hosp/d_icd_diagnoses"):
        etl.prepare(inputs)


def test_command_line(spark, raw_dir, tmp_path):
    from cohortline.__main__ import main

    paths = main([raw_dir, str(tmp_path / "cli"), "--dataset-name", "d", "--subjects-per-shard", "500"])
    splits = spark.read.parquet(paths["splits"])
    assert splits.agg({"shard": "max"}).first()[0] == 0
    assert spark.read.parquet(paths["data"]).count() > 0


def test_hot_subject_is_split_across_tasks(spark, tmp_path):
    """One subject with a third of all rows is written by several tasks, each sorted."""
    n_hot, n_other, subjects = 30000, 60000, 200
    hot = spark.range(n_hot).select(F.lit(7).cast("bigint").alias("subject_id"),
                                    F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("time"),
                                    F.lit("LAB//1").alias("code"))
    rest = spark.range(n_other).select((F.col("id") % subjects + 100).alias("subject_id"),
                                       F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("time"),
                                       F.concat(F.lit("LAB//"), (F.col("id") % 5).cast("string")).alias("code"))
    events = cohort_ops.conform_events(hot.unionByName(rest))
    split = events.withColumn("split", F.when(F.col("subject_id") >= 0, F.lit("train"))).withColumn(
        "shard", (F.col("subject_id") / 1000).cast("int"))
    out = cohort_ops.finalize(events, placed(spark, split, 10_000))
    parts = out.select("subject_id", "time").withColumn("p", F.spark_partition_id())
    slices = parts.filter("subject_id = 7").groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("low"), F.max("time").alias("high")).orderBy("low").collect()
    assert out.count() == n_hot + n_other
    path = str(tmp_path / "data")
    out.write.partitionBy("split", "shard").parquet(path)
    assert len(slices) >= 3 and max(s["n"] for s in slices) <= 12_000
    assert all(a["high"] < b["low"] for a, b in zip(slices, slices[1:]))
    import pyarrow.parquet as pq
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    assert len(files) >= 2
    for f in files:
        rows = pq.read_table(f, columns=["subject_id", "time"]).to_pylist()
        keys = [(r["subject_id"], r["time"]) for r in rows]
        assert keys == sorted(keys)


def test_rerun_overwrites(spark, built, raw_dir):
    out, paths = built
    before = spark.read.parquet(paths["data"]).count()
    codes = spark.read.parquet(paths["codes"]).count()
    etl.run(spark, raw_dir, out, dataset_name="demo", dataset_version="1:1", n_per_shard=40)
    assert spark.read.parquet(paths["data"]).count() == before
    assert spark.read.parquet(paths["codes"]).count() == codes
    assert json.loads(open(f"{out}/metadata/dataset.json").read())["dataset_version"] == "1:1"


def test_cohort_schema(spark, built):
    from cohortline.schemas import EVENT_COLUMNS

    _, paths = built
    got = dict(spark.read.parquet(paths["data"]).dtypes)
    expected = {n: t.simpleString() for n, t in EVENT_COLUMNS}
    expected.update({"split": "string", "shard": "int"})
    assert got == expected
    codes = dict(spark.read.parquet(paths["codes"]).dtypes)
    assert codes["code"] == "string" and codes["description"] == "string"
    assert codes["parent_codes"] == "array<string>"
    assert dict(spark.read.parquet(paths["splits"]).dtypes) == {"subject_id": "bigint", "split": "string", "shard": "int"}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_shard_join_keeps_all_events(spark, threshold):
    from cohortline.operators import subjects as ops

    events = spark.range(3_000).select((F.col("id") % 150).cast("long").alias("subject_id"), F.col("id").alias("value"))
    splits = ops.assign_shards(events.select("subject_id").distinct(), 50, seed=7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = ops.attach_shards(events, splits).collect()
        places = {r["subject_id"]: (r["split"], r["shard"]) for r in splits.collect()}
        assert len(got) == 3_000 and all((r["split"], r["shard"]) == places[r["subject_id"]] for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_csv_quoted_newlines_and_fractional_times(spark, tmp_path):
    from cohortline.functions.times import parse_time
    from cohortline.sources.readers import conform, read_csv

    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x\ny"\n2,z\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [("1", "x\ny"), ("2", "z")]
    times = spark.sql("SELECT TIMESTAMP_NTZ '2150-01-01 01:02:03.5' AS t")
    text = conform(times, spark.createDataFrame([], "t string").schema)
    kept = text.select(parse_time(F.col("t"), "%Y-%m-%d %H:%M:%S", text.schema["t"].dataType).alias("t")).first()["t"]
    assert kept.microsecond == 500_000
    ended = spark.createDataFrame([("2150-01-01\n",), ("2150-01-01",)], "t string")
    assert [r["t"] is None for r in ended.select(parse_time(F.col("t"), "%Y-%m-%d").alias("t")).collect()] == [True, False]
