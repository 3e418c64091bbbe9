"""Property tests: the Spark column rules against plain-Python statements of them.

Each example is a batch of values evaluated in one Spark job.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortline.functions.codes import code_column
from cohortline.functions.icd import add_dot, icd_diagnosis_dot, icd_procedure_dot
from cohortline.functions.times import parse_time

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
codes = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=9),
                  st.from_regex(r"[EV]?[0-9]{1,6}", fullmatch=True))


def py_dot(code, p):
    if code is None:
        return None
    return code[:p] + "." + code[p:] if len(code) > p else code


def py_diag(version, code):
    if code is None:
        return None
    if version == "9":
        return py_dot(code, 4 if code.startswith("E") else 3)
    return py_dot(code, 3)


def py_proc(version, code):
    return py_dot(code, 2) if version == "9" else code


@SETTINGS
@given(st.lists(st.tuples(codes, st.integers(0, 8)), min_size=1, max_size=40))
def test_add_dot_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "c string, p int")
    positions = sorted({p for _, p in rows})
    got = df.select("c", "p", *[add_dot(F.col("c"), p).alias(f"d{p}") for p in positions]).collect()
    for r in got:
        assert r[f"d{r.p}"] == py_dot(r.c, r.p)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["9", "10", None, "11"]), codes), min_size=1, max_size=40))
def test_icd_rules_match(spark, rows):
    df = spark.createDataFrame(rows, "v string, c string")
    got = df.select("v", "c", icd_diagnosis_dot(F.col("v"), F.col("c")).alias("d"),
                    icd_procedure_dot(F.col("v"), F.col("c")).alias("p")).collect()
    for r in got:
        assert r.d == py_diag(r.v, r.c) and r.p == py_proc(r.v, r.c)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=5)), st.one_of(st.none(), st.integers(-99, 99))),
                min_size=1, max_size=40))
def test_code_parts_rule(spark, rows):
    df = spark.createDataFrame(rows, "a string, b bigint")
    code, keep = code_column(df, ["K", "col(a)", "col(b)"])
    lead, lead_keep = code_column(df, ["col(a)", "col(b)"])
    for r in df.select("a", "b", code.alias("c"), keep.alias("k"), lead.alias("l"), lead_keep.alias("lk")).collect():
        a = "UNK" if r.a is None else r.a
        b = "UNK" if r.b is None else str(r.b)
        assert r.c == f"K//{a}//{b}" and r.k is True
        assert r.lk == (r.a is not None)
        if r.a is not None:
            assert r.l == f"{r.a}//{b}"


stamps = st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31)).map(
    lambda d: d.replace(microsecond=0))
texts = st.one_of(stamps.map(lambda d: d.strftime("%Y-%m-%d %H:%M:%S")), stamps.map(lambda d: d.strftime("%Y-%m-%d")),
                  st.text(alphabet="0123456789-: T", max_size=20), st.none())


def py_parse(text, formats):
    for f in formats:
        try:
            return dt.datetime.strptime(text, f) if text is not None and _full(text, f) else None
        except ValueError:
            continue
    return None


def _full(text, f):
    # strptime accepts 1-digit fields; the rule is the zero-padded layout only
    widths = {"%Y": 4, "%m": 2, "%d": 2, "%H": 2, "%M": 2, "%S": 2}
    pattern, i = "", 0
    while i < len(f):
        if f[i] == "%":
            pattern += r"\d{%d}" % widths[f[i:i + 2]]
            i += 2
        else:
            pattern += "\\" + f[i] if not f[i].isalnum() else f[i]
            i += 1
    import re
    return re.fullmatch(pattern, text) is not None


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40))
def test_time_formats_rule(spark, values):
    formats = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for r in df.select("s", parse_time(F.col("s"), formats).alias("t")).collect():
        expected = None
        for f in formats:
            expected = py_parse(r.s, [f])
            if expected is not None:
                break
        assert r.t == expected, r.s


from urllib.parse import urljoin  # noqa: E402

from cohortline.operators.links import page_links  # noqa: E402

BASES = ["http://example.com/", "http://example.com/a/b/", "http://example.com/a/b?x=1", "https://ex.org",
         "http://ex.org/a/b.html#frag", "https://m.ex.net/en/25?page=2&ref=x"]
segment = st.text(alphabet="abcxyz019_-", min_size=1, max_size=4)
paths = st.lists(segment, min_size=0, max_size=3).map("/".join)
hrefs = st.one_of(
    paths, paths.map(lambda p: "/" + p), paths.map(lambda p: p + "/"),
    paths.map(lambda p: "//other.org/" + p), paths.map(lambda p: "https://other.org/" + p),
    segment.map(lambda q: "?" + q), segment.map(lambda f: "#" + f), st.just(""),
)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(BASES), hrefs), min_size=1, max_size=30))
def test_link_resolution_matches_urljoin(spark, pairs):
    rows = [(i, base, f'<a href="{href}">x</a>') for i, (base, href) in enumerate(pairs)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.link_url for r in page_links(pages).collect()}
    for i, (base, href) in enumerate(pairs):
        assert got[i] == urljoin(base, href), (base, href)


import hashlib  # noqa: E402

from cohortline.operators.subjects import assign_shards  # noqa: E402


def py_shards(ids, n, seed=42):
    out, by_split = {}, {}
    for i in ids:
        h = int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:8], 16)
        u = h / 2 ** 32
        split = "train" if u < 0.8 else "tuning" if u < 0.9 else "held_out"
        by_split.setdefault(split, []).append((h, i))
    for split, keys in by_split.items():
        for rank, (_, i) in enumerate(sorted(keys), start=1):
            out[i] = (split, (rank - 1) // n, rank)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 10 ** 9), min_size=1, max_size=300), st.integers(1, 25))
def test_shards_match_rule(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in sorted(ids)], "subject_id bigint")
    got = {r.subject_id: (r.split, r.shard, r.rank) for r in assign_shards(df, n_per_shard=n, keep_rank=True).collect()}
    assert got == py_shards(ids, n)


from cohortline.operators.audit import parse_manifest  # noqa: E402

token = st.text(alphabet="abcdef0123456789./_", min_size=1, max_size=6)
manifest_lines = st.one_of(
    st.tuples(token, token).map(lambda t: f"{t[0]}  {t[1]}"),
    st.tuples(token, token, token).map(lambda t: f"{t[0]} {t[1]} {t[2]}"),
    token, st.just(""), st.just("   "),
)


@SETTINGS
@given(st.lists(manifest_lines, min_size=1, max_size=40))
def test_manifest_parse_rule(spark, lines):
    expected = {}
    for line in lines:
        parts = line.split()
        if len(parts) >= 2:
            expected[parts[1]] = parts[0]
    df = spark.createDataFrame([(ln, i) for i, ln in enumerate(lines)], "value string, n long")
    got = {r.key: r.expected_sha256 for r in parse_manifest(df, order_col="n").collect()}
    assert got == expected
