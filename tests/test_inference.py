"""Types of undeclared columns."""

import random

from pyspark.sql import functions as F

from cohortline.plans import etl
from cohortline.sources import inference as I
from cohortline.sources.readers import read_csv


def test_kinds_of_values(spark):
    cases = {I.WHOLE: ["0", "-7", "+12", "999999999999999999"], I.NUMBER: ["1.5", "-0.25", ".5", "3.", "1e9", "2.5E-3"],
             I.BOOLEAN: ["true", "FALSE"], None: ["", None],
             I.TEXT: ["007", "00", "1234567890123456789", "1,5", "x", " 1", "1 ", "1\n", "0010.5", "NaN", "inf", "-", "."]}
    rows = [(v, k) for k, values in cases.items() for v in values]
    for r in spark.createDataFrame(rows, "v string, k int").select("v", "k", I.kind(F.col("v")).alias("got")).collect():
        assert r["got"] == r["k"], r


def test_every_type_holds_its_values_and_merging_is_a_union(spark):
    sets = spark.range(16).select(F.col("id").cast("int").alias("a")).crossJoin(spark.range(16).select(F.col("id").cast("int").alias("b")))
    rows = sets.select("a", "b", I.type_of(F.col("a")).alias("ta"), I.type_of(F.col("b")).alias("tb"),
                       I.type_of(F.col("a").bitwiseOR(F.col("b"))).alias("both")).collect()
    wider = {"bigint": {"bigint", "double", "string"}, "double": {"double", "string"}, "boolean": {"boolean", "string"}, "string": {"string"}}
    for r in rows:
        assert r["a"] == 0 or r["both"] in wider[r["ta"]]
        assert r["b"] == 0 or r["both"] in wider[r["tb"]]
    assert {r["a"]: r["ta"] for r in rows}[0] == "string"


def test_typed_over_files_and_conflicts(spark, tmp_path):
    rng = random.Random(2)
    for i, (a, b) in enumerate([("1", "01"), ("2.5", "7"), ("", ""), ("-3", "8")]):
        lines = [f"{a},{b},{rng.choice(['true', 'false'])},{rng.randint(0, 9)},," for _ in range(30)]
        (tmp_path / f"f{i}.csv").write_text("n,code,flag,`odd .name,empty,none\n" + "\n".join(lines) + "\n")
    df = read_csv(spark, str(tmp_path))
    typed = I.typed(df)
    assert dict(typed.dtypes) == {"n": "double", "code": "string", "flag": "boolean", "`odd .name": "bigint", "empty": "string", "none": "string"}
    assert sorted(map(str, {r["n"] for r in typed.collect()})) == ["-3.0", "1.0", "2.5", "None"]
    got = sorted((r["column"], r["type"], r["file"].rsplit("/", 1)[1], r["file_type"]) for r in I.conflicts(I.file_kinds(df)).collect())
    assert got == [("code", "string", "f1.csv", "bigint"), ("code", "string", "f3.csv", "bigint"),
                   ("n", "double", "f0.csv", "bigint"), ("n", "double", "f3.csv", "bigint")]
    assert I.typed(spark.read.parquet("/root/testdata/sf0.001/region.parquet").select("r_regionkey")).columns == ["r_regionkey"]


def test_undeclared_tables_are_typed_by_the_etl(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "own").mkdir(parents=True)
    (raw / "own" / "t.csv").write_text("subject_id,score,zip,at\n1,2.50,00123,2020-01-01\n2,3,99999,2020-01-02\n")
    spec = {"own/t": {"e": {"code": ["OWN", "col(zip)"], "time": "col(at)", "time_format": "%Y-%m-%d", "numeric_value": "score"}}}
    inputs = etl.load_inputs(spark, str(raw), spec)
    assert dict(inputs.tables["own/t"].dtypes) == {"subject_id": "bigint", "score": "double", "zip": "string", "at": "string"}
    got = sorted((r["code"], r["numeric_value"]) for r in etl.all_events(inputs, spec).collect())
    assert got == [("OWN//00123", 2.5), ("OWN//99999", 3.0)]
