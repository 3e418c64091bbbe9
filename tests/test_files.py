"""File helpers: Hadoop FileSystem through the gateway, ``os`` without one."""

from cohortline.sources import files


class NoGateway:
    """Stands in for a Spark Connect session: no JVM on the client."""

    @property
    def sparkContext(self):
        raise RuntimeError("no JVM")


def test_helpers_with_and_without_gateway(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("listing")
    outputs = tmp_path_factory.mktemp("outputs")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("12345")
    for session in (spark, NoGateway()):
        assert files.exists(session, str(tmp_path / "a" / "x.csv"))
        assert not files.exists(session, str(tmp_path / "nope"))
        assert files.size(session, str(tmp_path / "a")) == 5
        assert files.entries(session, str(tmp_path)) == [("a", True)]
        assert files.entries(session, str(tmp_path / "a")) == [("x.csv", False)]
        out = str(outputs / "m" / f"d-{type(session).__name__}.json")
        files.write_text(session, out, '{"k": 1}')
        assert open(out).read() == '{"k": 1}'


def test_landing_parts():
    from cohortline.sources.sinks import landing_parts

    assert landing_parts(0) == 1
    assert landing_parts(25 << 30) == 800   # a 25 GB gzip expands about 4x


def test_discovery_never_looks_into_table_folders(spark, tmp_path, monkeypatch):
    from cohortline.sources.readers import discover_prefixes

    for name in ("hosp/a.parquet/part-0.csv", "hosp/b.csv/x/part-1", "icu/deep/c.csv.gz", "_tmp/d.csv", "icu/.e.csv", "f.parquet/p", "g.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    seen, entries = [], files.entries
    monkeypatch.setattr(files, "entries", lambda s, f: seen.append(f) or entries(s, f))
    assert discover_prefixes(spark, str(tmp_path)) == ["f", "hosp/a", "hosp/b", "icu/deep/c"]
    assert len(seen) == 4 and not any(".parquet" in f or ".csv" in f for f in seen)
