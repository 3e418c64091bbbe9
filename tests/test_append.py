"""Later deliveries: appended splits, merged shards, and the audit of the cohort's order."""

import glob
import hashlib
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cohortline.operators import order as order_ops
from cohortline.operators.metadata import with_older
from cohortline.operators.subjects import append_shards, assign_shards
from cohortline.plans import etl
from cohortline.sources import fixtures as fx


def subjects(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "subject_id long")


def places(df):
    return {r["subject_id"]: (r["split"], r["shard"]) for r in df.collect()}


def ranked(ids, n, taken):
    """Places of new ids behind ``taken`` ones, by the rule, one at a time."""
    out, count = {}, dict(taken)
    for i in sorted(ids, key=lambda i: (int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16), i)):
        unit = int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) / 2 ** 32
        split = "train" if unit < .8 else "tuning" if unit < .9 else "held_out"
        out[i] = (split, count.get(split, 0) // n)
        count[split] = count.get(split, 0) + 1
    return out, count


def test_splits_of_three_deliveries(spark):
    rng = random.Random(1)
    first, second, third = (rng.sample(range(10_000), k) for k in (130, 200, 1))
    table = assign_shards(subjects(spark, first), 20).checkpoint()
    expected, taken = ranked(first, 20, {})
    assert places(table) == expected
    for ids in (second, second, third):       # the second comes twice: nothing new
        fresh = [i for i in ids if i not in expected]
        more, taken = ranked(fresh, 20, taken)
        expected |= more
        added = append_shards(table, subjects(spark, ids), 20).checkpoint()
        assert places(added) == more
        table = table.unionByName(added).checkpoint()
    assert places(table) == expected
    sizes = {(r["split"], r["shard"]): r["count"] for r in table.groupBy("split", "shard").count().collect()}
    for split in ("train", "tuning", "held_out"):     # all shards full but the last
        counts = [sizes[k] for k in sorted(k for k in sizes if k[0] == split)]
        assert all(c == 20 for c in counts[:-1])


def test_append_to_nothing_is_a_first_assignment(spark):
    ids = range(500)
    empty = assign_shards(subjects(spark, []), 30)
    assert places(append_shards(empty, subjects(spark, ids), 30)) == places(assign_shards(subjects(spark, ids), 30))


@pytest.fixture(scope="module")
def inputs(spark):
    """All tables, and one delivery for a few subjects and a new one."""
    tables = {p: fx.RAW_FIXTURES[p](spark, SF_SMALL) for p in ("hosp/admissions", "hosp/patients", "hosp/labevents", "hosp/omr")}
    few = {p: df.filter("subject_id IN (1, 2, 3)") for p, df in tables.items() if p != "hosp/labevents"}
    omr = few["hosp/omr"]
    few["hosp/omr"] = omr.limit(1).withColumn("subject_id", F.lit(777_777).cast("long")).union(
        omr.limit(2).withColumn("chartdate", F.lit("2200-01-01")).withColumn("subject_id", F.lit(2).cast("long")))
    return etl.Inputs(tables), etl.Inputs(few)


def test_second_delivery_rewrites_only_its_shards(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    paths = etl.build(spark, inputs[0], out, n_per_shard=10, seed=5)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/data/**/*.parquet", recursive=True)}
    rows = spark.read.parquet(paths["data"]).checkpoint()
    old = places(spark.read.parquet(paths["splits"]))
    for _ in range(2):                          # the same delivery again changes nothing
        etl.append(spark, inputs[1], out)
        splits = places(spark.read.parquet(paths["splits"]))
        assert {i: p for i, p in splits.items() if i in old} == old and set(splits) - set(old) == {777_777}
        now = spark.read.parquet(paths["data"])
        new = etl.all_events(etl.prepare(inputs[1])).distinct()
        columns = [c for c in rows.columns if c not in ("split", "shard")]
        expected = rows.select(*columns).union(new.select(*columns)).distinct()
        assert now.count() == expected.count() and now.select(*columns).exceptAll(expected).count() == 0
        touched = {splits[i] for i in (1, 2, 3, 777_777) if i in splits}
        kept = {f for f, t in before.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == t}
        folder = lambda f: tuple(p.split("=")[1] for p in f.split("/")[-3:-1])
        assert {folder(f) for f in set(before) - kept} == {(s, str(n)) for s, n in touched} & {folder(f) for f in before}
        codes = [r["code"] for r in spark.read.parquet(paths["codes"]).collect()]
        assert sorted(codes) == sorted(r["code"] for r in now.select("code").distinct().collect())
        assert order_ops.shard_order(order_ops.file_order(spark, paths["data"])).filter("NOT sorted").count() == 0


def test_codes_of_a_delivery_are_those_of_its_cohort(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    paths = etl.build(spark, inputs[0], out, n_per_shard=10, seed=5)
    omr = inputs[1].tables["hosp/omr"]
    nobody = omr.limit(1).withColumn("subject_id", F.lit(None).cast("long")).withColumn("result_name", F.lit("OF NOBODY"))
    etl.append(spark, etl.Inputs(inputs[1].tables | {"hosp/omr": omr.union(nobody)}), out)
    codes = sorted(r["code"] for r in spark.read.parquet(paths["codes"]).collect())
    assert codes == sorted(r["code"] for r in spark.read.parquet(paths["data"]).select("code").distinct().collect())


def test_codes_keep_older_metadata(spark):
    new = spark.createDataFrame([("a", None, None), ("b", "new", ["p"]), ("c", None, None)], "code string, description string, parent_codes array<string>")
    old = spark.createDataFrame([("a", "old", "x"), ("b", "old", "y")], "code string, description string, note string")
    got = {r["code"]: (r["description"], r["parent_codes"], r["note"]) for r in with_older(new, old).collect()}
    assert got == {"a": ("old", None, "x"), "b": ("new", ["p"], "y"), "c": (None, None, None)}


def test_command_line_appends(spark, inputs, tmp_path):
    from cohortline.__main__ import main

    raw = str(tmp_path / "raw")
    for prefix, df in inputs[1].tables.items():
        df.write.parquet(f"{raw}/{prefix}.parquet")
    out = str(tmp_path / "out")
    main([raw, out, "--subjects-per-shard", "2"])
    before = spark.read.parquet(f"{out}/data").count()
    main([raw, out, "--append"])
    assert spark.read.parquet(f"{out}/data").count() == before


def cohort(path, files):
    """Files of (subject, time, code) rows of one shard, in small row groups."""
    os.makedirs(f"{path}/split=train/shard=0")
    for i, rows in enumerate(files):
        table = pa.table({"subject_id": pa.array([r[0] for r in rows], pa.int64()),
                          "time": pa.array([r[1] for r in rows], pa.timestamp("us")), "code": [r[2] for r in rows]})
        pq.write_table(table, f"{path}/split=train/shard=0/part-{i}.parquet", row_group_size=7)


def test_order_audit(spark, tmp_path):
    rows = [(i // 40, None if i % 40 < 3 else 1_000_000 * (i % 40), f"c{'é' if i % 2 else 'z'}") for i in range(400)]
    rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2].encode()))
    swapped = [*rows[:210], rows[211], rows[210], *rows[212:]]
    cases = {"good": ([rows[:150], rows[150:]], True), "swapped": ([swapped], False),
             "files overlap": ([rows[::2], rows[1::2]], False), "null after": ([[*rows[3:6], rows[0]]], False),
             "equal keys": ([[rows[5]] * 30, [rows[5]] * 3], True)}
    for name, (files, good) in cases.items():
        path = str(tmp_path / name.replace(" ", "_"))
        cohort(path, files)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1200")     # several tasks a file
        try:
            found = order_ops.file_order(spark, path)
            got = order_ops.shard_order(found).collect()
            assert [(r["rows"], r["sorted"]) for r in got] == [(sum(map(len, files)), good)], name
            if name == "files overlap":
                assert found.filter("sorted").count() == 2
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_order_audit_reads_the_cohort_once(spark, tmp_path):
    cohort(str(tmp_path), [[(1, None, "a")], [(2, 5, "b")]])
    found = order_ops.shard_order(order_ops.file_order(spark, str(tmp_path)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Relation [") == 1
    assert [(r["files"], r["rows"], r["sorted"]) for r in found.collect()] == [(2, 2, True)]
