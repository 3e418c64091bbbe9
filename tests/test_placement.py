"""Places of subjects found by ranges of (hash, subject), without another exchange of the events."""

import re

import pytest
from pyspark.sql import functions as F

from cohortline.operators import cohort as cohort_ops
from cohortline.operators.subjects import append_shards, assign_shards
from cohortline.session import SHUFFLES_REMOVED, scratch_dir, shuffles_removed

SUBJECTS = 6_000


@pytest.fixture(scope="module")
def events(spark):
    """Some events a subject, and one subject with a tenth of all."""
    some = spark.range(SUBJECTS * 5).select((F.col("id") % SUBJECTS * 7).alias("subject_id"), F.col("id").alias("s"))
    hot = spark.range(SUBJECTS // 2).select(F.lit(7 * 11).cast("long").alias("subject_id"), F.col("id").alias("s"))
    nobody = spark.range(3).select(F.lit(None).cast("long").alias("subject_id"), F.col("id").alias("s"))
    rows = some.union(hot).union(nobody)
    time = F.when(F.col("s") % 9 > 0, F.timestamp_seconds("s").cast("timestamp_ntz"))
    return rows.select("subject_id", time.alias("time"), F.concat(F.lit("c"), F.col("s") % 3).alias("code"),
                       F.col("s").alias("hadm_id")).checkpoint()


def placement(spark, events, shards, rows_per_task, seed=42):
    sizes = events.filter("subject_id IS NOT NULL").groupBy("subject_id").agg(F.count(F.lit(1)).alias("rows"))
    sized = sizes.join(shards, "subject_id").checkpoint()
    return cohort_ops.place(sized, lambda: events.select("subject_id", "time"), scratch_dir(spark, "placement"), rows_per_task, seed)


def shards_of(events, seed=42):
    return assign_shards(events.select("subject_id").filter("subject_id IS NOT NULL").distinct(), 1000, seed)


@pytest.mark.parametrize("rows_per_task", [1_000, 40_000])
@pytest.mark.parametrize("seed", [42, 7])
def test_ranges_give_the_places_of_the_table(spark, events, seed, rows_per_task):
    placed = placement(spark, events, shards_of(events, seed), rows_per_task, seed)
    assert placed.ranges is not None and placed.ranges.table.count() * 16 <= SUBJECTS
    by_table = cohort_ops.Placement(placed.subjects, placed.tasks, placed.hot)
    found, expected = (cohort_ops._located(events, p) for p in (placed, by_table))
    columns = ["subject_id", "time", "code", "hadm_id", "split", "shard", "task", "cuts"]
    assert found.count() == expected.count() == SUBJECTS * 5 + SUBJECTS // 2
    assert found.select(*columns).exceptAll(expected.select(*columns)).count() == 0
    out = [cohort_ops.finalize(events, p).withColumn("p", F.spark_partition_id()) for p in (placed, by_table)]
    assert out[0].count() == out[1].count() and out[0].exceptAll(out[1].select(*out[0].columns)).count() == 0


def test_events_are_exchanged_once_whatever_the_number_of_subjects(spark, events):
    """The table of subjects, too large to broadcast, was joined by an exchange of all events."""
    placed = placement(spark, events, shards_of(events), 5_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cohort_ops.finalize(events, placed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"\bExchange ", plan)) == 1 and "REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan


def test_places_without_ranges_are_joined(spark, events):
    """Shards not cut from the order of hashes have as many ranges as subjects: no broadcast of those."""
    shards = spark.range(SUBJECTS).select((F.col("id") * 7).alias("subject_id"), F.lit("train").alias("split"),
                                          (F.col("id") % 6).cast("int").alias("shard"))
    placed = placement(spark, events, shards, 40_000)
    assert placed.ranges is None
    assert cohort_ops.finalize(events, placed).count() == events.filter("subject_id IS NOT NULL").distinct().count()


def test_ranges_of_two_deliveries(spark, events):
    """Few later subjects cut the ranges in which they fall."""
    first = shards_of(events.filter("subject_id % 700 > 0")).checkpoint()
    both = first.union(append_shards(first, events.select("subject_id").filter("subject_id IS NOT NULL").distinct(), 1000))
    placed = placement(spark, events, both.checkpoint(), 40_000)
    assert placed.ranges is not None
    got = cohort_ops._located(events, placed).select("subject_id", "split", "shard").distinct()
    assert got.count() == SUBJECTS and got.exceptAll(both.select(*got.columns)).count() == 0


def test_shuffles_go_when_a_write_has_ended(spark):
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    with shuffles_removed(spark):
        assert spark.conf.get(SHUFFLES_REMOVED) == "true"
    assert spark.conf.get(SHUFFLES_REMOVED, None) == before


SPEC = {
    "a": {"START": {"code": ["START", "col(item)"], "time": "col(start)", "time_format": ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d"],
                    "numeric_value": "rate", "hadm_id": "hadm_id", "own_column": "note"},
          # a code that is the name of a column, a column that is not there, and a time shared with another event
          "END": {"code": "item", "time": "col(end)", "time_format": "%Y-%m-%d", "text_value": "absent", "unit": "col(note)"},
          "AGAIN": {"code": "col(note)", "time": "col(end)", "time_format": "%Y-%m-%d", "hadm_id": "hadm_id"},
          "NEVER": {"code": "NEVER", "time": "col(absent)", "time_format": "%Y"}},
    "b": {"STATIC": {"code": "STATIC", "time": None}, "WHO": {"code": ["WHO", "col(subject_id)", "col(absent)"], "time": None}},
    "c": {"NONE": {"code": "NONE", "time": "col(absent)", "time_format": "%Y"}},
}


@pytest.fixture(scope="module")
def tables(spark):
    """Rows with several events each, one subject with a third of them; subjects of two types; null times and codes."""
    i = F.col("id")
    a = spark.range(6_000).select(
        F.when(i % 3 == 0, 7).otherwise(i % 500).cast("long").alias("subject_id"), (i % 4).cast("string").alias("item"),
        F.when(i % 11 > 0, F.date_format(F.timestamp_seconds(i * 7_000), "yyyy-MM-dd HH:mm:ss")).alias("start"),
        F.when(i % 7 > 0, F.date_format(F.timestamp_seconds(i * 9_000), "yyyy-MM-dd")).otherwise("no date").alias("end"),
        F.when(i % 5 > 0, F.concat(F.lit("n"), i % 6)).alias("note"), (i / 3).alias("rate"), (i % 50).alias("hadm_id"))
    b = spark.range(500).select(F.format_string("%05d", "id").alias("subject_id"))
    c = spark.range(9).select(i.alias("subject_id"))
    return {"a": a.union(a.limit(500)).checkpoint(), "b": b.union(b).checkpoint(), "c": c}


@pytest.mark.parametrize("rows_per_task", [700, 300_000])
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_rows_exchanged_give_the_same_events(spark, tables, rows_per_task, threshold):
    from cohortline.operators.events import EventRows, event_rows, extract_events

    frames = [extract_events(tables[p], SPEC[p]) for p in SPEC]
    old = frames[0].limit(200).withColumn("text_value", F.lit("old")).checkpoint()
    events = cohort_ops.union_events([*frames, old])
    rows = [*[event_rows(tables[p], SPEC[p]) for p in SPEC], EventRows(old)]
    shards = assign_shards(events.select("subject_id").filter("subject_id IS NOT NULL").distinct(), 100)
    sizes = events.filter("subject_id IS NOT NULL").groupBy("subject_id").agg(F.count(F.lit(1)).alias("rows"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        placed = cohort_ops.place(sizes.join(shards, "subject_id").checkpoint(), lambda: events.select("subject_id", "time"),
                                  scratch_dir(spark, "placement"), rows_per_task)
        assert placed.hot
        got, expected = (cohort_ops.finalize(e, placed).withColumn("p", F.spark_partition_id()) for e in (rows, events))
        assert got.schema == expected.schema and "own_column" in got.columns
        assert got.count() == expected.count() == events.distinct().count()
        assert got.exceptAll(expected).count() == 0
        assert got.filter("subject_id = 7").select("p").distinct().count() > 2
        if threshold == "10485760":
            plan = cohort_ops.finalize(rows, placed)._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"\bExchange ", plan)) == 1 and "Generate" in plan.split("REPARTITION_BY_NUM")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_no_event_are_not_exchanged(spark, tables):
    from cohortline.operators.events import event_rows

    rows = event_rows(tables["a"], {"END": SPEC["a"]["AGAIN"]})
    assert rows.rows.columns == ["subject_id", "_time0", "note", "hadm_id"]
    assert rows.rows.count() == tables["a"].filter("note IS NOT NULL AND end IS NOT NULL").count()
    assert event_rows(tables["c"], SPEC["c"]).events == []
