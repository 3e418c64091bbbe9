"""CSV records found from any byte range, against Python's csv module."""

import csv
import os
import random
import re

import pyarrow as pa
import pytest

from cohortline.plans import queries
from cohortline.sources import csv_records
from cohortline.sources.readers import read_csv
from cohortline.sources.sinks import land

FRAGMENTS = ["a", "b,", "\n", '"', " ", "\r\n", "é", "x\ny", '","', '""', "long " * 30, "\n\n", '"\n"', "", "\t"]


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    old = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "1")
    yield lambda n: spark.conf.set(keys[1], str(n))
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def expected(path):
    with open(path, newline="", encoding="utf-8") as f:
        return sorted((tuple(v or None for v in row) for row in list(csv.reader(f))[1:] if any(v.strip() for v in row)), key=repr)


def rows(df):
    return sorted((tuple(v or None for v in r) for r in df.collect()), key=repr)


def write(path, rng, count, share, ending, quoting):
    data = [["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 6))) if rng.random() < share else str(i)
             for _ in range(2)] + [str(i)] for i in range(count)]
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=ending, quoting=quoting)
        out.writerow(["a", "b c", "d`e"])
        out.writerows(data)


@pytest.mark.parametrize("case", range(8))
def test_records_equal_those_of_a_whole_file(spark, tmp_path, small_splits, case):
    rng = random.Random(case)
    path = str(tmp_path / "t.csv")
    write(path, rng, rng.choice([3, 50, 300]), rng.choice([0.02, 0.5]), rng.choice(["\n", "\r\n"]),
          rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
    small_splits(rng.choice([61, 301, 1009]))
    got = read_csv(spark, path)
    assert got.columns == ["a", "b c", "d`e"]
    assert rows(got) == expected(path)


def test_many_tasks_for_one_file(spark, tmp_path, small_splits):
    path = str(tmp_path / "t.csv")
    write(path, random.Random(9), 2000, 0.1, "\n", csv.QUOTE_MINIMAL)
    small_splits(16_000)
    got = read_csv(spark, path)
    assert got.rdd.getNumPartitions() > 8
    assert rows(got) == expected(path)
    landed = land(spark, got, path, str(tmp_path / "landed.parquet"))
    assert rows(spark.read.parquet(landed)) == expected(path)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("Union")[0]


def test_several_files_a_field_over_many_splits_and_an_open_end(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('x,y\n1,"' + "line\n" * 500 + '"\n2,b\n')
    (tmp_path / "b.csv").write_text('x,y\n3,plain\n\n4,"half" more\n5,6" pipe\n')
    (tmp_path / "c.csv").write_text('"x\nname",y\n7,"left open\nto the end\n')
    small_splits(100)
    got = {r[0]: r[1] for r in csv_records.read(spark, str(tmp_path / "[ab].csv")).collect()}
    assert got == {"1": "line\n" * 500, "2": "b", "3": "plain", "4": '"half" more', "5": '6" pipe'}, got.keys()
    got = csv_records.read(spark, str(tmp_path / "c.csv"))
    assert got.columns == ["x\nname", "y"]
    assert [r[1].rstrip("\n") for r in got.collect()] == ["left open\nto the end"]


def test_files_without_quoted_newlines_stay_native(spark, tmp_path):
    for name, text in (("plain", "a,b\n1,2\n"), ("quoted", 'a,b\n"1,","say ""x"""\n'), ("empty", ""), ("header", "a,b\n")):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        df = csv_records.read(spark, str(path))
        assert "MapInArrow" not in df._jdf.queryExecution().toString()
        assert df.count() == text.count("\n1") + text.count('\n"')


def test_line_functions():
    """Patterns against a character-wise reading of every short line."""
    quotes = csv_records.Quotes()

    def behind(line, inside):
        at_start, closed = not inside, False
        i = 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside, closed = False, True
            elif c == ",":
                at_start = True
                i += 1
                continue
            elif c == '"' and at_start:
                inside = True
            at_start = False
            i += 1
        return inside

    rng = random.Random(3)
    for _ in range(3000):
        line = "".join(rng.choice('",ax') for _ in range(rng.randint(0, 9)))
        for inside in (False, True):
            assert quotes.behind(pa.array([line]), inside)[1] == behind(line, inside), (line, inside)
    assert re.compile(quotes.opens)


def test_a_split_without_a_known_state_stops_the_job(spark, tmp_path):
    """Files that change between the passes must not lose rows."""
    from pyspark.sql import functions as F

    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    lines = csv_records._lines(spark, str(path)).withColumns(
        {"starts_in": F.lit(None).cast("boolean"), "is_last": F.lit(True)})
    with pytest.raises(Exception, match="changed while they were read"):
        csv_records._whole_records(lines, csv_records.Quotes()).collect()


def test_documents_are_written_by_several_tasks(spark, small_splits, tmp_path, monkeypatch):
    """The table grows by files, not by what one task writes; the rows stay the same."""
    texts = [(i, f'"{i}", said\nthe second line,' * 40, "en", "web", i) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", 1 << 17)
    small_splits(1 << 15)
    got = queries.QUERIES["src_csv_multiline"](spark, str(tmp_path))
    sizes = [os.path.getsize(f.removeprefix("file://")) for f in got.inputFiles()]
    assert len(sizes) > 2 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert rows(got.select("doc_id", "text")) == rows(docs.select(docs.doc_id.cast("string"), "text"))
