"""Anchor extraction on the driver's pages against Python's own HTML tokenizer."""

import html
import random
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_CHECK
from cohortline.functions.markup import decode_references
from cohortline.functions.urls import join_url
from cohortline.operators.links import extract_hrefs, page_links
from cohortline.sources import fixtures as fx


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        # the last of several counts, one without a value is empty
        if tag == "a" and "href" in dict(attrs):
            self.hrefs.append((dict(attrs)["href"] or "").strip(" "))

    handle_startendtag = handle_starttag


def test_hrefs_match_html_parser(spark):
    expected = Counter()
    for row in pq.read_table(f"{SF_CHECK}/pages.parquet", columns=["page_id", "html"]).to_pylist():
        parser = Anchors()
        parser.feed(row["html"])
        parser.close()
        expected.update((row["page_id"], h) for h in parser.hrefs)
    got = Counter((r.page_id, r.href) for r in extract_hrefs(fx.table(spark, SF_CHECK, "pages")).collect())
    assert sum(expected.values()) > 1000
    assert got == expected


PIECES = ["<a href=x>", "<A HREF='y/z'>", '<a class="a>b" href="../q?a=1&amp;b=&#50;">', "<a\nhref = \"w \" >", "</a>", "text & more ",
          "<!-- <a href=c1> -->", "<!-- open <a href=c2> ", "<script>var a='<a href=s1>';</script>", "<style><a href=s2></style >",
          "<script src='x'/>", "<SCRIPT type=t>if (a<b) '<a href=s3>'</SCRIPT>", "<!DOCTYPE html>", "<?pi <a href=p>?>", "<![CDATA[ <a href=cd> ]]>",
          "<a>", "<a href>", "<a href=''>", "<a href=1 href=2>", "<a data-href=n href=/r/../s;p#f>", "<abbr href=no>", "<a/href=sl>",
          "<a href=bur/wor.csv/>", "< a href=no>", "<1 a>", "</ a href=no>", "<b title='<a href=t>'>", "&lt;a href=e&gt;", "\n", "<a x=y href=&notit;&copy>",
          "<a href=//h2/x/./y>", "<a href=mailto:me@x>", "<a href='   lead'>", "<br/>", "<p style=color:red>"]


def test_random_pages_equal_html_parser_and_urljoin(spark):
    rng = random.Random(12)
    bases = ["http://h/a/b/index.html", "http://h/a/b/", "http://h", "https://h/x;y/z?q=1#f"]
    rows = [(i, rng.choice(bases), "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = Counter()
    for page, base, text in rows:
        parser = Anchors()
        parser.feed(text)
        parser.close()
        expected.update((page, h, urljoin(base, h)) for h in parser.hrefs)
    got = Counter((r.page_id, r.href, r.link_url) for r in page_links(pages).collect())
    assert sum(expected.values()) > 3000
    assert got == expected, (list((got - expected).items())[:5], list((expected - got).items())[:5])


def test_references_equal_those_of_the_library(spark):
    rng = random.Random(5)
    marks = ["&amp;", "&lt", "&notit;", "&#39;", "&#x41;", "&#128;", "&#129;", "&#0;", "&#xD800;", "&#99999999999999;", "&#xFDD0;", "&", "&zzz;",
             "x", "&copyright", "&#", "&#x;", " ", "&CounterClockwiseContourIntegral;", "&nbsp;", "&#11;", "&#1114112;", "a=1&b=2", "&#x1F600;"]
    rows = [("".join(rng.choice(marks) for _ in range(rng.randint(0, 5))),) for _ in range(2000)]
    df = spark.createDataFrame(rows, "s string")
    for r in df.select("s", decode_references(F.col("s")).alias("t")).collect():
        assert r.t == html.unescape(r.s), r.s


def test_references_to_urls_equal_urljoin(spark):
    rng = random.Random(6)
    segments = ["a", "b.c", "..", ".", "", "x;p", "..;q", "é", "%2e"]
    path = lambda: ("/" if rng.random() < .5 else "") + "/".join(rng.choice(segments) for _ in range(rng.randint(0, 6)))
    starts = ["", "", "", "http:", "https:", "mailto:", "HTTP:", "//h2", "http://h3", "ftp://f"]
    bases = ["http://h/a/b/c", "http://h/a/b/", "http://h", "http://h/", "https://h/x;y/z;w?q=1#f", "http://h/a//b/../c", ""]
    rows = [(rng.choice(bases), rng.choice(starts) + path() + rng.choice(["", "?q=1", "?"]) + rng.choice(["", "#f", "#"])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "b string, r string").select("b", "r", join_url(F.col("b"), F.col("r")).alias("u"))
    for r in df.collect():
        assert r.u == urljoin(r.b, r.r), r
