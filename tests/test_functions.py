from __future__ import annotations

from datetime import datetime
from html.parser import HTMLParser

import pytest
from conftest import SF_DIR, rows, session_zone
from pyspark.sql import functions as F

from tripmart.functions import html, names
from tripmart.functions.numeric import round_half_up, to_int
from tripmart.functions.time import hour_label, in_month, month_bounds, month_label, month_start, utc_instant, wall_clock
from tripmart.sources.links import category_links, first_links, missing_by_page, missing_categories, page_links

ZONES = ["UTC", "America/Sao_Paulo", "America/New_York"]


def test_to_int_truncates_and_gives_null_where_nothing_fits(spark):
    values = [(None,), (1.9,), (-1.9,), (3e9,), (float("nan"),)]
    df = spark.createDataFrame(values, "passengers double").select(to_int(F.col("passengers")))
    assert [r[0] for r in df.collect()] == [None, 1, -1, None, None]


def test_rounding_ties_go_up(spark):
    values = [1.005, 2.675, 0.125, 1.115, -0.125, 1.015]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(round_half_up(F.col("x")))
    assert [r[0] for r in df.collect()] == [1.01, 2.68, 0.13, 1.12, -0.13, 1.02]


def test_rounding_ignores_summation_order(spark):
    df = spark.createDataFrame([(2.6749999999999994,), (2.675,), (2.6750000000000007,)], "x double")
    assert {r[0] for r in df.select(round_half_up(F.col("x"))).collect()} == {2.68}


@pytest.mark.parametrize("zone", ZONES)
def test_wall_clock_survives_every_session_zone(spark, zone):
    with session_zone(spark, zone):
        ntz = spark.sql(
            """SELECT * FROM VALUES (TIMESTAMP_NTZ'2023-03-12 02:30:00.123456'), (TIMESTAMP_NTZ'2023-05-01 00:30:00'),
               (TIMESTAMP_NTZ'2023-11-05 01:30:00'), (TIMESTAMP_NTZ'1969-12-31 23:59:59') AS t(ts)"""
        )
        instants = ntz.select("ts", utc_instant(ntz, "ts").alias("at"))
        back = instants.select("ts", wall_clock(instants, "at").alias("again"), F.unix_micros("at").alias("micros"))
        for ts, again, micros in back.collect():
            assert ts == again
            assert micros == round((ts - datetime(1970, 1, 1)).total_seconds() * 1e6)
        labels = instants.select(
            month_label(month_start(instants, "at")), hour_label(F.to_date("ts"), F.hour("ts")), in_month(instants, "at", "2023-05")
        )
        assert rows(labels) == [
            ("1969-12", "1969-12-31 23", False),
            ("2023-03", "2023-03-12 02", False),
            ("2023-05", "2023-05-01 00", True),
            ("2023-11", "2023-11-05 01", False),
        ]


def test_month_range_reaches_the_scan(spark):
    trips = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    plan = trips.filter(in_month(trips, "o_orderdate", "1998-12"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-12-01" in plan
    assert "LessThan(o_orderdate,1999-01-01" in plan


def test_month_bounds_cross_the_year():
    assert [d.isoformat() for d in month_bounds("2023-12")] == ["2023-12-01", "2024-01-01"]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("s3a://raw/yellow_tripdata/yellow_tripdata_2023-01.parquet", ("yellow_tripdata", "2023-01")),
        ("file:///z/fhvhv_tripdata/fhvhv_tripdata_2023-05.parquet/part-0-x_y.snappy.parquet", ("fhvhv_tripdata", "2023-05")),
        ("/z/a_b/object=a_b_2022-12.parquet/part-0.parquet", ("a_b", "2022-12")),
        ("/z/a_b/a_b_extra_2022-12.parquet", ("a_b", "2022-12")),
    ],
)
def test_names_of_landed_objects(spark, path, expected):
    where = names.object_path(F.col("p"))
    df = spark.createDataFrame([(path,)], "p string").select(
        names.dataset(names.object_name(where)), names.source_date(where)
    )
    assert tuple(df.first()) == expected


def test_target_path_and_scheme(spark):
    df = spark.createDataFrame([("yellow_tripdata_2023-01.parquet", "s3a://b/k")], "n string, p string")
    found = df.select(names.target_path("s3://b/parquet/", F.col("n")), names.plain_scheme(F.col("p"))).first()
    assert tuple(found) == ("s3://b/parquet/yellow_tripdata_parquet/2023_01", "s3://b/k")


PAGE = """
<html><!-- <a href="/hidden_2023-01.parquet">Yellow Taxi Trip Records</a> --><script>"<a href='/x'>y</a>"</script>
<p>High Volume For-Hire Vehicle Trip Records</p>
<A CLASS="x" HREF="/d/yellow_tripdata_2023-01.parquet ">YELLOW taxi
trip records</A>
<a title="a > b" href='/d/yellow_tripdata_2023-01.parquet'>  <b>Yellow</b> <i>Taxi</i> Trip&nbsp;Records</a>
<a href="/d/yellow_tripdata_2023-01b.parquet"><b>Yellow Taxi</b><span> Trip Records</span></a>
<a href=/d/fhvhv_tripdata_2023-01.parquet>High Volume For-Hire Vehicle Trip Records</a>
<a href="/d/fhv_tripdata_2023-01.parquet?a=1&amp;b=2">For-Hire Vehicle Trip Records</a>
<a href="/d/fhv_tripdata_2023-02.parquet">For-Hire Vehicle Trip Records &#8364;&#x20AC; &amp;lt; &#99999999;</a>
<a name="top">no link</a><a href="">empty</a></html>
"""


def _page(spark, text: str = PAGE):
    return spark.createDataFrame([(1, text)], "page_id int, html string")


def test_links_of_a_hand_made_page(spark):
    found = [(r.href, r.text) for r in page_links(_page(spark), ["page_id"]).orderBy("pos").collect()]
    assert found == [
        ("/d/yellow_tripdata_2023-01.parquet ", "YELLOW taxi\ntrip records"),
        ("/d/yellow_tripdata_2023-01.parquet", "Yellow Taxi Trip\u00a0Records"),
        ("/d/yellow_tripdata_2023-01b.parquet", "Yellow Taxi Trip Records"),
        ("/d/fhvhv_tripdata_2023-01.parquet", "High Volume For-Hire Vehicle Trip Records"),
        ("/d/fhv_tripdata_2023-01.parquet?a=1&b=2", "For-Hire Vehicle Trip Records"),
        ("/d/fhv_tripdata_2023-02.parquet", "For-Hire Vehicle Trip Records \u20ac\u20ac &lt; \ufffd"),
        ("", "empty"),
    ]


def test_an_unclosed_anchor_ends_where_the_next_begins(spark):
    found = page_links(_page(spark, '<a href="/1">one <a href="/2">two</a><a href="/3">three'), ["page_id"])
    assert [(r.href, r.text) for r in found.orderBy("pos").collect()] == [("/1", "one"), ("/2", "two"), ("/3", "three")]


@pytest.mark.parametrize(
    ("tag", "href"),
    [
        ("""<a title="see href=/no" data-href="/no" hreflang='en' href="/yes">""", "/yes"),
        ("<a href=/it's>", "/it's"),
        ("<a class=x href = '/yes' download>", "/yes"),
        ('<a href="/a>b?x=1">', "/a>b?x=1"),
        ("<a\nhref='/yes'/>", "/yes"),
        ('<a title="don\'t" href="/yes">', "/yes"),
        ("<a href=>", ""),
        ('<a title="href=/no">', None),
        ("<a>", None),
        ("<abbr href='/no'>", None),
    ],
)
def test_href_of_a_tag(spark, tag, href):
    found = page_links(_page(spark, f"<p>it's</p>{tag}don't</a>"), ["page_id"]).collect()
    assert [(r.href, r.text) for r in found] == ([] if href is None else [(href, "don't")])


def test_long_malformed_pages_are_read_whole(spark):
    page = "<a href='/1'>x</a>" + "<a " + "=" * 100_000 + "<p " * 50_000 + "'" * 50_001 + "<a href='/2'>y</a>"
    assert [r.href for r in page_links(_page(spark, page), ["page_id"]).orderBy("pos").collect()][0] == "/1"


def test_category_links_and_the_first_of_each(spark):
    categories = ["For-Hire Vehicle Trip Records", "Yellow Taxi Trip Records"]
    links = page_links(_page(spark), ["page_id"])
    matched = category_links(links, categories, ["2023-01", "2023-03"])
    assert rows(matched.select("category", "href")) == [
        ("For-Hire Vehicle Trip Records", "/d/fhv_tripdata_2023-01.parquet?a=1&b=2"),
        ("For-Hire Vehicle Trip Records", "/d/fhvhv_tripdata_2023-01.parquet"),
        ("Yellow Taxi Trip Records", "/d/yellow_tripdata_2023-01b.parquet"),
    ]
    assert rows(first_links(matched, ["page_id"]).select("category", "href")) == [
        ("For-Hire Vehicle Trip Records", "/d/fhvhv_tripdata_2023-01.parquet"),
        ("Yellow Taxi Trip Records", "/d/yellow_tripdata_2023-01b.parquet"),
    ]
    exact = category_links(links, categories, ["2023-01"], exact=True)
    assert ("/d/fhvhv_tripdata_2023-01.parquet",) not in rows(exact.select("href"))


def test_missing_categories(spark):
    pages = spark.createDataFrame([(1, "<p>Green &amp; Red</p>"), (2, "<a href='blue'>gold</a>")], "page_id int, html string")
    wanted = ["green & red", "GOLD", "blue", "gr<p>een"]
    assert rows(missing_categories(pages, wanted)) == [("blue",), ("gr<p>een",)]
    assert rows(missing_by_page(pages, ["page_id"], wanted)) == [
        (1, "GOLD"), (1, "blue"), (1, "gr<p>een"), (2, "blue"), (2, "gr<p>een"), (2, "green & red"),
    ]


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[list] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.found.append([dict(attrs)["href"], []])
            self.inside = True

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False

    def handle_data(self, data):
        if self.inside and data.strip():
            self.found[-1][1].append(data.strip())


def test_links_equal_an_html_parser_on_all_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    expected = []
    for page in pages.collect():
        parser = _Anchors()
        parser.feed(page.html)
        expected += [(page.page_id, pos, href, " ".join(text)) for pos, (href, text) in enumerate(parser.found)]
    assert rows(page_links(pages, ["page_id"])) == sorted(expected, key=repr)


def test_text_of_pages_keeps_comments_and_drops_attributes(spark):
    df = _page(spark, '<p title="attr">a<!-- note --></p>').select(html.text_pieces(F.col("html")))
    assert [p.strip() for p in df.first()[0].split("\u0001") if p.strip()] == ["a", "note"]
