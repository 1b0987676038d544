"""Fields of web pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.pages import paired_text
from tickloom.operators.profiles import company_profile, extract_fields
from tickloom.plans.registry import query
from tickloom.plans.tables import table

# Check SQL: pages without comments, scripts and styles, and the text of a piece of markup.
_CLEAN = """
WITH c AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
    '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g') AS h
  FROM pages
)"""


def _text(piece: str) -> str:
    stripped = f"regexp_replace({piece}, '<[/!?a-zA-Z][^>]*>', '', 'g')"
    for name, char in [("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"),
                       ("&#39;", "chr(39)"), ("&amp;", "'&'")]:
        stripped = f"replace({stripped}, '{name}', {char})"
    return stripped


def _nth(pattern: str, n: int) -> str:
    found = f"regexp_extract_all(h, '{pattern}', 1)"
    return f"CASE WHEN len({found}) > {n} THEN {_text(f'{found}[{n + 1}]')} ELSE 'No Data Available' END"


_AD = '(?s)<div class="ad">(.*?)</div>'
_LINK = "(?s)<a [^>]*>(.*?)</a>"
_TITLE = "(?s)<title>(.*?)</title>"
_HEAD = "(?s)<h1>(.*?)</h1>"
_ARTICLE = "(?s)<article>(.*?)</article>"


@query(_CLEAN + f" SELECT page_id, {_nth(_AD, 0)} AS ad, {_nth(_TITLE, 0)} AS title FROM c")
def html_first_field(spark: SparkSession, folder: str) -> DataFrame:
    fields = [("ad", "div", "ad", 0), ("title", "title", None, 0)]
    return extract_fields(table(spark, folder, "pages"), fields, keep=["page_id"])


@query(
    _CLEAN + " SELECT page_id, " + ", ".join(f"{_nth(_LINK, n)} AS link_{n}" for n in range(4)) + " FROM c"
)
def html_nth_fields(spark: SparkSession, folder: str) -> DataFrame:
    fields = [(f"link_{n}", "a", None, n) for n in range(4)]
    return extract_fields(table(spark, folder, "pages"), fields, keep=["page_id"])


@query(
    _CLEAN
    + f""" SELECT page_id, {_nth(_LINK, 0)} AS link_0, {_nth(_HEAD, 0)} AS head_0,
{_nth(_LINK, 1)} AS link_1, {_nth(_HEAD, 1)} AS head_1 FROM c"""
)
def html_paired_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Links paired with headings; where the heading is missing, the link stays."""
    fields = [("link_0", "a", None, 0), ("head_0", "h1", None, 0), ("link_1", "a", None, 1), ("head_1", "h1", None, 1)]
    found = extract_fields(table(spark, folder, "pages"), fields, keep=["page_id"], default=None)
    return found.select(
        "page_id",
        *[F.coalesce(f"link_{n}", F.lit("No Data Available")).alias(f"link_{n}") for n in range(2)],
        *[paired_text(F.col(f"link_{n}"), F.col(f"head_{n}")).alias(f"head_{n}") for n in range(2)],
    )


# Elements of the supplied pages that stand in for the parts of a company page.
_STAND_INS = [
    ('<div class="ad">', '<div class="YMlKec fxKbKc">'),
    ("</a>", "</div>"),
    ("<article>", '<div class="bLLb2d">'),
    ("</article>", "</div>"),
    ("<h1>", '<div class="sfyJob">'),
    ("</h1>", "</div>"),
    ("<title>", '<div class="Yfwt5">'),
    ("</title>", "</div>"),
]


@query(
    _CLEAN
    + f""" SELECT page_id, {_nth(_AD, 0)} AS price, {_nth(_LINK, 0)} AS pcp, {_nth(_LINK, 1)} AS drp,
{_nth(_LINK, 2)} AS yrp, {_nth(_LINK, 3)} AS mcp, {_nth(_ARTICLE, 0)} AS about, {_nth(_HEAD, 0)} AS np1,
CASE WHEN len(regexp_extract_all(h, '{_HEAD}', 1)) > 0 THEN {_nth(_TITLE, 0)} ELSE 'No Data Available' END AS n1,
{_nth(_HEAD, 1)} AS np2,
CASE WHEN len(regexp_extract_all(h, '{_HEAD}', 1)) > 1 THEN {_nth(_TITLE, 1)} ELSE 'No Data Available' END AS n2
FROM c"""
)
def html_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The company profile over whole pages whose elements were renamed to those of a company page."""
    html = F.col("html")
    for old, new in _STAND_INS:
        html = F.replace(html, F.lit(old), F.lit(new))
    html = F.regexp_replace(html, "<a [^>]*>", '<div class="x P6K39c">')
    return company_profile(table(spark, folder, "pages").select("page_id", html.alias("html")))
