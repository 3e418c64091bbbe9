"""Checksum audit and link extraction, with the reference's own examples."""

import hashlib

from pyspark.sql import functions as F

from cohortline.operators import audit as A
from cohortline.operators.links import page_links


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_manifest_valid_and_mismatch(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    (files / "demo.csv").write_text("demo data")
    (files / "common.csv").write_text("common data")
    (files / "wrong.csv").write_text("wrong data")
    (files / "extra.csv").write_text("x")
    manifest = tmp_path / "SHA256SUMS.txt"
    manifest.write_text("\n".join([
        f"{sha('demo data')}  demo.csv", f"{sha('common data')} common.csv", f"{sha('correct data')} wrong.csv",
        "malformed-line", f"{sha('z')} gone.csv",
    ]) + "\n")
    got = {r.key: (r.status, r.refetch) for r in A.audit_directory(spark, str(files), str(manifest)).collect()}
    assert got == {"demo.csv": ("valid", False), "common.csv": ("valid", False), "wrong.csv": ("mismatch", True),
                   "extra.csv": ("not_in_manifest", True), "gone.csv": ("missing", True)}


def test_unreadable_manifest_fetches_everything(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("a")
    got = [(r.key, r.status, r.refetch) for r in A.audit_directory(spark, str(tmp_path / "f"), str(tmp_path / "none.txt")).collect()]
    assert got == [("a.csv", "manifest_unreadable", True)]


def test_manifest_last_line_wins(spark):
    lines = spark.createDataFrame([(f"{sha('a')} f.csv", 1), (f"{sha('b')} f.csv", 2), ("short", 3)], "value string, n long")
    got = A.parse_manifest(lines, order_col="n").collect()
    assert [(r.key, r.expected_sha256) for r in got] == [("f.csv", sha("b"))]


def test_manifest_key_rule(spark):
    df = spark.createDataFrame([("https://h/files/ds/3.1/hosp/admissions.csv.gz",), ("https://h/files/ds/3.1/",),
                                ("http://example.com/foo.csv",)], "u string")
    assert [r[0] for r in df.select(A.manifest_key(F.col("u"))).collect()] == ["hosp/admissions.csv.gz", "index.html", None]


def test_key_rule_against_path_splitting(spark):
    """The path's pieces after the first four; the file name where there are none; no key for a
    path too short to name a manifest."""
    import itertools
    from urllib.parse import urlparse

    urls = ["http://h" + "/".join(p) for n in range(6) for p in itertools.product(["", "a"], repeat=n) if not p or p[0] == ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", A.manifest_key(F.col("u")).alias("k"))
    for r in df.collect():
        parts = urlparse(r.u).path.split("/")
        name = parts[-1] or "index.html"
        assert r.k == (("/".join(parts[4:]) or name) if len(parts) >= 4 else None), r.u


def test_files_of_any_size_are_hashed(spark, tmp_path, monkeypatch):
    """Many small files, some streamed ones with odd names, and one over 2 GB (sparse)."""
    root = tmp_path / "set"
    expected = {}
    for i in range(1500):
        folder = root / f"d{i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        body = f"{i}\n".encode() * (1 + i % 50)
        name = f"f {i}%20é+.bin" if i % 500 == 0 else f"f{i}"
        (folder / name).write_bytes(body)
        expected[f"d{i % 7}/{name}"] = hashlib.sha256(body).hexdigest()
    monkeypatch.setattr(A, "ROW_BYTES", 150)
    got = {r.key: r.actual_sha256 for r in A.hash_files(spark, str(root)).collect()}
    assert got == expected
    monkeypatch.undo()
    big = tmp_path / "big"
    big.mkdir()
    with open(big / "huge.csv", "wb") as f:
        f.truncate((2 << 30) + 5)
    digest = hashlib.sha256()
    for size in [1 << 20] * 2048 + [5]:
        digest.update(bytes(size))
    assert [tuple(r) for r in A.hash_files(spark, str(big)).collect()] == [("huge.csv", digest.hexdigest())]


def test_files_without_a_key_are_fetched(spark):
    files = spark.createDataFrame([(None, "x"), (None, "x"), ("a", "x")], "key string, actual_sha256 string")
    manifest = spark.createDataFrame([("a", "x")], "key string, expected_sha256 string")
    got = sorted(((r.key, r.status, r.refetch) for r in A.audit(files, manifest).collect()), key=str)
    assert got == sorted([(None, "no_manifest", True)] * 2 + [("a", "valid", False)], key=str)


PAGE = """<html><body><!-- <a href="commented.csv">x</a> --><script>var s='<a href="js.csv">';</script>
<a href="foo.csv">foo</a><a href='bar/'>bar</a><a class=x href=bur/wor.csv>w</a>
<a href="http://other.com/baz.csv">other</a><a href="./">self</a><a href="?q=1&amp;r=2">q</a></body></html>"""


def test_links_of_listing(spark):
    pages = spark.createDataFrame([(1, "http://example.com/", PAGE)], "page_id long, url string, html string")
    got = {r.href: (r.kind, r.in_scope, r.rel_path) for r in page_links(pages).collect()}
    assert got == {
        "foo.csv": ("file", True, "foo.csv"),
        "bar/": ("directory", True, "bar"),
        "bur/wor.csv": ("file", True, "bur/wor.csv"),
        "http://other.com/baz.csv": ("file", False, None),
        "./": ("directory", True, ""),
        "?q=1&r=2": ("file", True, "?q=1&r=2"),
    }


def test_links_one_level_down(spark):
    html = '<a href="baz.csv">b</a><a href="/bar/qux.csv">q</a><a href="//example.com/bar/">d</a>'
    pages = spark.createDataFrame([(2, "http://example.com/bar/", html)], "page_id long, url string, html string")
    got = sorted((r.link_url, r.kind, r.rel_path) for r in page_links(pages).collect())
    assert got == [("http://example.com/bar/", "directory", ""), ("http://example.com/bar/baz.csv", "file", "baz.csv"),
                   ("http://example.com/bar/qux.csv", "file", "qux.csv")]
