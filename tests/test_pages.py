"""Extraction from listing and detail page templates."""

from pyspark.sql import functions as F

from destrank.functions import html as H
from destrank.operators.pages import collect_hotels, hotel_details, listing_cards

LISTING = """<html><head><script>var s = "<div data-testid=\\"property-card\\">";</script></head><body>
<div data-testid="property-card"><div><h3><a data-testid="title-link" href="https://x.example/h/one.html?aid=1">
<div data-testid="title">Hotel One</div></a></h3>
<div class="a dff2e52086 f63b14ab7a">8.2</div></div></div>
<div data-testid="property-card"><a href="https://x.example/h/two.html" data-testid="title-link">
<div data-testid="title">Hotel &amp; Two</div></a><div class="f63b14ab7a">no</div></div>
<div data-testid="property-card"><div data-testid="title">No Link</div></div>
</body></html>"""

DETAIL_ONE = """<html><body><div data-testid="property-description">Nice <b>place</b> to stay</div>
<p data-testid="property-description">Second part</p>
<script>b_map_center_latitude = 48.87; b_map_center_longitude = -2.02;</script></body></html>"""


def test_listing_cards(spark):
    pages = spark.createDataFrame([("Paris", LISTING)], "city string, html string")
    cards = [r.asDict() for r in listing_cards(pages).orderBy("card_pos").collect()]
    assert [(c["name"], c["score"], c["url"]) for c in cards] == [
        ("Hotel One", "8.2", "https://x.example/h/one.html"),
        ("Hotel & Two", None, "https://x.example/h/two.html"),
    ]


def test_details_and_merge(spark):
    search = spark.createDataFrame([("Paris", LISTING)], "city string, html string")
    details = spark.createDataFrame(
        [("https://x.example/h/one.html?lang=en", DETAIL_ONE), ("https://x.example/h/one.html", DETAIL_ONE)],
        "url string, html string",
    )
    d = hotel_details(details).collect()[0]
    assert d.description == "Nice place to stay Second part"
    assert d.latitude == 48.87 and d.longitude == -2.02
    hotels = {r.name: r for r in collect_hotels(search, details).collect()}
    assert len(hotels) == 2  # duplicate detail pages do not multiply the listing
    assert hotels["Hotel One"].latitude == 48.87
    assert hotels["Hotel & Two"].description is None


def test_element_and_attribute(spark):
    df = spark.createDataFrame(
        [('<html lang="de"><title>A &amp; B</title><!-- <h1>no</h1> --><h1> <i>Big</i> one </h1><a href="/x">x</a>',)],
        "html string",
    )
    body = H.drop_noise("html")
    r = df.select(
        H.attribute("html", "html", "lang").alias("lang"),
        H.element_text(body, "title").alias("title"),
        H.element_text(body, "h1").alias("h1"),
        F.size(H.all_attributes(body, "a", "href")).alias("n"),
    ).collect()[0]
    assert (r.lang, r.title, r.h1, r.n) == ("de", "A & B", "Big one", 1)


def _card(name, score, link):
    parts = ['<div data-testid="property-card"><div class="wrap">']
    inner = f'<div data-testid="title">{name}</div>'
    if link is not None:
        parts.append(f'<h3><a data-testid="title-link" href="{link}?aid=9">{inner}</a></h3>')
    else:
        parts.append(f"<h3>{inner}</h3>")
    if score is not None:
        parts.append(f'<div class="x f63b14ab7a dff2e52086">{score}</div>')
    parts.append("</div></div>")
    return "".join(parts)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cards=st.lists(
        st.tuples(
            st.sampled_from(["Alpha", "Beta Inn", "Gamma & Co"]),
            st.one_of(st.none(), st.sampled_from(["7.1", "8.5", "9.0"])),
            st.one_of(st.none(), st.sampled_from(["https://x.example/a", "https://x.example/b"])),
        ),
        max_size=8,
    )
)
def test_cards_stay_aligned_when_fields_are_missing(spark, cards):
    html = "<html><body>" + "".join(_card(n, s, u) for n, s, u in cards) + "</body></html>"
    pages = spark.createDataFrame([("P", html.replace("&", "&amp;"))], "city string, html string")
    got = [(r.card_pos, r.name, r.score, r.url) for r in listing_cards(pages).orderBy("card_pos").collect()]
    want = [(i, n, s, u) for i, (n, s, u) in enumerate(cards) if u is not None]
    assert got == want


def test_one_row_per_hotel_and_error_pages_hide_nothing(spark):
    cards = [_card("A", "7.1", "https://x.example/a"), _card("B", None, "https://x.example/b")]
    search = spark.createDataFrame([("P", cards[0] + cards[1]), ("P", cards[0])], "city string, html string")
    good = '<div data-testid="property-description">Nice</div> b_map_center_latitude = 48.87;'
    rows = [("https://x.example/a?x=1", "<html>error</html>"), ("https://x.example/a", good)]
    out = collect_hotels(search, spark.createDataFrame(rows, "url string, html string")).collect()
    assert sorted((r.name, r.description, r.latitude) for r in out if r.name == "A") == [("A", "Nice", 48.87)]
    assert len(out) == 2


def test_last_card_ends_with_its_element_and_nested_text_is_whole(spark):
    footer = '<div class="f63b14ab7a dff2e52086">9.9</div><a data-testid="title-link" href="https://x.example/z">z</a>'
    nested = (
        '<div data-testid="property-card"><a data-testid="title-link" href="https://x.example/n">'
        '<div data-testid="title"><div>Grand</div> <DIV>Old</DIV > Hotel</div></a>'
        '<div class="f63b14ab7a dff2e52086"><b>8.1</b></div></div>'
    )
    html = nested + _card("Last", None, "https://x.example/l") + footer
    pages = spark.createDataFrame([("P", html)], "city string, html string")
    got = [(r.name, r.score, r.url) for r in listing_cards(pages).orderBy("card_pos").collect()]
    assert got == [("Grand Old Hotel", "8.1", "https://x.example/n"), ("Last", None, "https://x.example/l")]


def test_unclosed_and_absent_elements(spark):
    df = spark.createDataFrame([("<h1>open <b>end",), ("<p>none</p>",), (None,), ("<h1></h1>x",)], "html string")
    assert [r[0] for r in df.select(H.element_text("html", "h1")).collect()] == ["open end", None, None, None]


def test_first_card_and_first_usable_details_in_crawl_order(spark):
    url = "https://x.example/a"
    search = spark.createDataFrame([(2, "Q", _card("A", "1.0", url)), (1, "P", _card("B", "2.0", url))], "page_id long, city string, html string")

    def described(text):
        return f'<div data-testid="property-description">{text}</div>'

    rows = [(1, url, "<html>error</html>"), (3, url, described("aaa")), (2, url + "?x=1", described("zzz"))]
    details = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [(r.city, r.name, r.score, r.description) for r in collect_hotels(search, details).collect()] == [("P", "B", "2.0", "zzz")]
