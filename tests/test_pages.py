from tickloom.operators.profiles import company_profile, extract_fields

PAGE = """<html><!-- <div class="P6K39c">no</div> --><script>var a="<div class='P6K39c'>x</div>"</script>
<div class="YMlKec fxKbKc">$1 &amp;lt; &#8364;5 &#x41;&bogus; & b</div>
<DIV id=1 class='a P6K39c b'>one<div>in<div class=x>ner</div></div>!</DIV><div class="P6K39cc">not</div><div class="p6k39c">nor</div>
<div class="P6K39c">two<div class="P6K39c">nested <b>three</b></div>tail</div><div class=P6K39c>four</div>
<div class="fxKbKc YMlKec">order</div><div class="Yfwt5">first text</div><div class="bLLb2d">about unclosed"""


def test_company_profile(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "page_id int, html string")
    got = {r["page_id"]: r.asDict() for r in company_profile(pages).collect()}
    none = "No Data Available"
    assert got[1] == {
        "page_id": 1,
        "price": "$1 &lt; €5 A&bogus; & b",
        "pcp": "oneinner!",
        "drp": "twonested threetail",
        "yrp": "nested three",
        "mcp": "four",
        "about": "about unclosed",
        "np1": none,
        # Its partner is missing, so the text does not count although it is on the page.
        "n1": none,
        "np2": none,
        "n2": none,
    }
    for page in (2, 3):
        assert set(got[page].values()) == {page, none}


def test_partner_is_kept_without_text(spark):
    html = '<div class="sfyJob">A</div><div class="sfyJob">B</div><div class="Yfwt5">a</div>'
    row = company_profile(spark.createDataFrame([(html,)], "html string")).first()
    assert (row["np1"], row["n1"], row["np2"], row["n2"]) == ("A", "a", "B", "No Data Available")


def test_references_are_decoded_once(spark):
    cases = {
        "&amp;lt; &lt;&gt;&quot;&apos;&amp;amp;&nbsp;.": "&lt; <>\"'&amp; .",
        "&amp;eacute; &eacute; &amp;": "&eacute; é &",
        "&amp;#65; &#65; &am &;": "&#65; A &am &;",
    }
    for text, want in cases.items():
        page = spark.createDataFrame([(f"<p class='x'>{text}</p>",)], "html string")
        assert extract_fields(page, [("t", "p", "x", 0)]).first()["t"] == want


def test_fields_by_tag_and_long_pages(spark):
    html = "<p>x</p>" * 50_000 + '<div class="k">' + "<div>y</div>" * 20_000 + "</div><div class='k'>z</div>"
    fields = [("first", "div", "k", 0), ("second", "div", "k", 1), ("third", "div", "k", 2)]
    row = extract_fields(spark.createDataFrame([(html,)], "html string"), fields, default="-").first()
    assert row["first"] == "y" * 20_000
    assert (row["second"], row["third"]) == ("z", "-")


def test_ordinary_markup(spark):
    """Quoted ends of tags, attributes that only look like a class, class lists, names and open scripts."""
    fields = [("x", "div", "ad", 0), ("y", "div", "YMlKec fxKbKc", 0)]
    cases = {
        '<div title="a > b" class="ad">x</div>': "x",
        '<div class="ad"><img alt="1 > 0">in</div>': "in",
        """<div data-x="q class='ad' z">no</div><div class=ad>yes</div>""": "yes",
        '<div id=a class="b  ad\n c">list</div>': "list",
        '<div class="ad">Caf&eacute; &ne; &Auml;&notaname;</div>': "Café ≠ Ä&notaname;",
        '<script>if (a > b) { "<div class=\'ad\'>x</div>"': "No Data Available",
        '<!-- <div class="ad">x</div>': "No Data Available",
    }
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "page_id int, html string")
    got = [r["x"] for r in extract_fields(pages, fields).orderBy("page_id").collect()]
    assert got == list(cases.values())
    blanks = spark.createDataFrame([(1, '<div class=" YMlKec   fxKbKc ">p</div>')], "page_id int, html string")
    assert extract_fields(blanks, fields).first()["y"] == "p"
