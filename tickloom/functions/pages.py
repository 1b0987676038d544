"""Element text from HTML pages, inside the JVM.

An element is found by tag and class like a CSS selector and ends at its balanced closing tag, so nested
elements of the same tag are handled. The text is that of all descendants, without scripts, styles and
comments, with character references decoded.
"""

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATA = "No Data Available"

# Character references by name: the standard table, with blanks that never break as plain ones.
NAMED_REFERENCES = {f"&{name}": text for name, text in html5.items() if name.endswith(";")} | {"&nbsp;": " "}
_SEPARATOR = "\x01"
_COMMON_REFERENCES = ["&nbsp;", "&lt;", "&gt;", "&quot;", "&apos;", "&amp;"]
_REFERENCE_TABLE = "".join(f"{k}{v}{_SEPARATOR}" for k, v in NAMED_REFERENCES.items())

# Fields of a company page, the class of the div holding each, and its position.
PROFILE_FIELDS = [
    ("price", "YMlKec fxKbKc", 0),
    ("pcp", "P6K39c", 0),
    ("drp", "P6K39c", 1),
    ("yrp", "P6K39c", 2),
    ("mcp", "P6K39c", 3),
    ("about", "bLLb2d", 0),
    ("np1", "sfyJob", 0),
    ("n1", "Yfwt5", 0),
    ("np2", "sfyJob", 1),
    ("n2", "Yfwt5", 1),
]

# A field read only after its partner was found.
PAIRED_WITH = {"n1": "np1", "n2": "np2"}

# The rest of a tag up to its end, stepping over quoted values. Quotes are written as codes, as the
# patterns stand inside quoted SQL text.
_REST_OF_TAG = r"(?:[^\x22\x27>]++|\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)*+>"

# Parts of a page whose content is not markup: comments and raw-text elements; unclosed ones reach to the end.
_NOT_MARKUP = (
    r"<(?s:!--.*?(?:-->|\z)|(?i:(script|style|template))\b" + _REST_OF_TAG + r".*?(?:</(?i:\1)\s*>|\z))"
)


def markup(html: Column) -> Column:
    """The page without comments, scripts and styles. Compute it once and select several fields from it."""
    return F.regexp_replace(html, _NOT_MARKUP, "")


# The expressions below nest higher-order functions, so they are written as SQL text. ``transform(array(x),
# v -> …)[0]`` binds x to v, which evaluates it once however often v is used.


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _code_point(number: str) -> str:
    valid = f"{number} BETWEEN 1 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343"
    return f"decode(unhex(lpad(hex(if({valid}, {number}, 65533)), 8, '0')), 'UTF-32')"


def _decoded(text: str) -> str:
    # Where only the few common names occur they are replaced, the ampersand last so that nothing is decoded
    # twice. Otherwise the text is taken apart; a name is looked up in one text that holds the whole table.
    common = text
    for name in _COMMON_REFERENCES:
        common = f"replace({common}, {_quoted(name)}, {_quoted(NAMED_REFERENCES[name])})"
    others = "|".join(name[1:-1] for name in _COMMON_REFERENCES)
    others = f"{text} RLIKE r'&(?!(?:{others});)#?[0-9a-zA-Z]{{1,32}};'"
    table, end = _quoted(_REFERENCE_TABLE), _quoted(_SEPARATOR)
    named = f"if(contains({table}, k), substring_index(substring_index({table}, k, -1), {end}, 1), k)"
    hexadecimal = "CAST(conv(substring(k, 4, length(k) - 4), 16, 10) AS BIGINT)"
    decimal = "CAST(substring(k, 3, length(k) - 3) AS BIGINT)"
    token = f"""CASE
      WHEN NOT startswith(k, '&') OR length(k) < 3 THEN k
      WHEN k = '&amp;' THEN '&'
      WHEN k RLIKE r'^&#[xX][0-9a-fA-F]{{1,8}};$' THEN {_code_point(hexadecimal)}
      WHEN k RLIKE r'^&#[0-9]{{1,9}};$' THEN {_code_point(decimal)}
      ELSE {named} END"""
    tokens = f"regexp_extract_all({text}, r'(?s)(&#?[0-9a-zA-Z]{{1,32}};|[^&]+|&)', 1)"
    taken_apart = f"array_join(transform({tokens}, k -> {token}), '')"
    return f"CASE WHEN NOT contains({text}, '&') THEN {text} WHEN {others} THEN {taken_apart} ELSE {common} END"


def _plain(markup_text: str) -> str:
    """Markup to text: without tags, each character reference decoded exactly once."""
    stripped = f"regexp_replace({markup_text}, r'<[/!?a-zA-Z]{_REST_OF_TAG}', '')"
    return f"transform(array({stripped}), t -> {_decoded('t')})[0]"


def tag_table(page: str, tag: str, classes: bool = True) -> Column:
    """The page, a column made by ``markup``, cut before every opening and closing tag of one name.

    An array of (opens, shuts, classes, part): whether the part starts with such a tag, its class names between
    single blanks, and the markup up to the next one. Made once; every field is a lookup in it. Quotes and the
    class attribute are read here, as tags and attributes are case-insensitive and values may hold any text.
    Without ``classes`` no class is read, for a tag that is only looked up by name.
    """
    value = r"(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27|[^\s\x22\x27>]++)"
    others = rf"(?:[\s/]*+(?!class\s*=)[^\s\x22\x27>=/]++(?:\s*+=\s*+{value})?+)*+"
    class_ = rf"(?i)^<{tag}(?=[\s/]){others}[\s/]*+class\s*=\s*({value})"
    inner = r"if(v RLIKE r'^[\x22\x27]', substring(v, 2, length(v) - 2), v)"
    names = rf"""transform(array(regexp_extract(x, r'{class_}', 1)), v ->
      regexp_replace(concat(' ', {inner}, ' '), r'\s+', ' '))[0]"""
    names = names if classes else "''"
    return F.expr(
        rf"""transform(split({page}, r'(?i)(?=</?{tag}[\s/>])'), x ->
          transform(array(x RLIKE r'(?i)^<{tag}[\s/>]'), o ->
            named_struct('opens', o, 'shuts', startswith(x, '</'), 'classes', if(o, {names}, ''), 'part', x))[0])"""
    )


def _has_classes(class_: str | None) -> str:
    """Test of one entry of a tag table: several classes must be the whole attribute, a single one be in its list."""
    if class_ is None:
        return "e.opens"
    wanted = _quoted(f" {' '.join(class_.split())} ")
    return f"e.classes = {wanted}" if len(class_.split()) > 1 else f"contains(e.classes, {wanted})"


def element_texts(tags: str, class_: str | None, first: int) -> Column:
    """Texts of the first so many matching elements, in page order.

    ``tags`` names a column made by ``tag_table``. An element runs from its opening tag to the closing
    one that balances it, or to the end of the page.
    """
    depth = "a.depth + if(e.shuts, -1, 1)"
    balanced = f"""aggregate(s, named_struct('depth', 0, 'seen', 0, 'end', 0),
      (a, e) -> if(a.end > 0, a, named_struct('depth', {depth}, 'seen', a.seen + 1,
                                              'end', if({depth} = 0, a.seen + 1, 0))),
      a -> if(a.end > 0, a.end - 1, size(s)))"""
    # The closing tag itself, with what follows it, is not part of the element.
    text = f"transform(array(array_join(transform(slice(s, 1, {balanced}), e -> e.part), '')), m -> {_plain('m')})[0]"
    matches = f"filter(sequence(1, size({tags})), i -> transform(array({tags}[i - 1]), e -> {_has_classes(class_)})[0])"
    return F.expr(
        f"""transform(slice({matches}, 1, {first}),
              i -> transform(array(slice({tags}, i, size({tags}))), s -> {text})[0])"""
    )


def nth_text(texts: Column, index: int, default: str | None = NO_DATA) -> Column:
    """Text at a position counted from 0, or the default when there are fewer elements."""
    return F.coalesce(F.try_element_at(texts, F.lit(index + 1)), F.lit(default))


def paired_text(partner: Column, text: Column, default: str = NO_DATA) -> Column:
    """Text that counts only when its partner exists; a missing text leaves the partner as it is."""
    return F.coalesce(F.when(partner.isNotNull(), text), F.lit(default))
