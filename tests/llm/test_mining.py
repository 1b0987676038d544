"""Hard negatives, collocations and main texts, against plain versions."""

import html
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import collocations, maintext, negatives
from tickloom.llm.queries import QUERIES

# --- hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (40, 33, 70), (130, 64, 257), (17, 100, 0)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    assert (negatives.strassen(a, b, 2) == a @ b).all() and (negatives.strassen(a, b) == a @ b).all()


def test_strassen_wraps_back_and_widens():
    rng = np.random.default_rng(3)
    # Sums inside the recursion pass 64 bits, results do not.
    a, b = rng.integers(-(2**29), 2**29, (40, 40)), rng.integers(-(2**28), 2**28, (40, 40))
    assert (negatives.strassen(a, b, 4) == a.astype(object) @ b.astype(object)).all()
    big = np.array([[2**62, 2**62], [-(2**62), 5]])
    assert negatives.scores_of(big, big).tolist() == [[2**63 - 1, -(2**63)], [-(2**63), 2**63 - 1]]


def test_heaps_merge():
    rng = np.random.default_rng(4)
    keys, scores, ids = rng.integers(0, 9, 500), rng.integers(-5, 5, 500), rng.integers(0, 90, 500)
    heaps = negatives.Heaps(4)
    for i in range(0, 500, 77):
        heaps.add(keys[i : i + 77], scores[i : i + 77], ids[i : i + 77])
    got = list(zip(heaps.keys.tolist(), heaps.scores.tolist(), heaps.ids.tolist(), strict=True))
    want = []
    for key in range(9):
        mine = [(k, s, i) for k, s, i in zip(keys.tolist(), scores.tolist(), ids.tolist(), strict=True) if k == key]
        want += sorted(mine, key=lambda x: (-x[1], x[2]))[:4]
    assert got == want


def plain_negatives(rows, positives, negatives_, percent):
    """Rows (vec_id, whole vector, label), every tenth vec_id an anchor."""
    out = []
    for i, (anchor, v, label) in enumerate(rows):
        if anchor % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), c, m) for j, (c, w, m) in enumerate(rows) if j != i]
        best = sorted((s, c) for s, c, m in scored if m == label)[:positives]
        for place, (p, positive) in enumerate(best, 1):
            inside = sorted((s, c) for s, c, m in scored if m != label and percent * -p <= 100 * -s <= 100 * -p)
            for rank, (s, c) in enumerate(inside[:negatives_], 1):
                out.append((anchor, positive, rank, c, -p, -s, place))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_match_a_plain_version(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(negatives, "SHARD_BYTES", 1000)
        monkeypatch.setattr(negatives, "BLOCK_BYTES", 500)
        monkeypatch.setattr(negatives, "TILE", (3, 7))
    rng = np.random.default_rng(6)
    data = rng.normal(0.1, 0.4, (150, 6)).round(2)
    data[20:45] = data[20]  # ties across labels
    rows = [(i, data[i].tolist(), int(rng.integers(0, 3)), "x") for i in range(150)]
    rows += [(20, data[20].tolist(), 1, "x"), (20, data[3].tolist(), 0, "x"), (7, data[7].tolist(), 2, "x")]
    rows += [(400, data[1].tolist(), 9, "x")]  # an anchor without positives
    odd = [(30, None, 1, "x"), (40, [None] * 6, 1, "x"), (50, [float("nan")] * 6, 1, "x"), (60, [float("inf")] * 6, 1, "x"),
           (None, [1.0] * 6, 1, "x"), (70, [1.0] * 6, None, "x")]
    schema = "vec_id long, embedding array<double>, label int, row string"
    got = negatives.hard_negatives(spark.createDataFrame(rows + odd, schema), F.col("vec_id") % 10 == 0, "label", 5, 4, 70, 64)
    whole = [(i, [int(np.floor(64 * x)) for x in v], m) for i, v, m, _ in rows]
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_place"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == plain_negatives(whole, 5, 4, 70)


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [], 1), (1, [], 2)], [(1, [2.0, 3.0], 0)]):
        assert negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") == 0).count() == 0
    # Shorter vectors are filled with zeros.
    rows = [(0, [1.0], 1), (1, [4.0, 9.0], 1), (2, [3.5, 1.0, 1.0], 2)]
    (only,) = negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") == 0).collect()
    assert (only["positive_id"], only["negative_id"], only["negative_score"]) == (1, 2, 256 * 896)


# --- collocations


def plain_collocations(docs, longest=3, least=10, covered=50):
    """All rows but the rank, per language, in order."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = lang or "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and b >= least and 100 * b >= covered * a
                and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in f.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found), 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def some_docs():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)] + ["Der", "ünd", " x", "a b", "Á", "the", "\x00", "$"]
    ends = [".", ",", ";", ":", "!", "?", "\n", "\r", "\x0b", "\x0c", " ", "\t", "  "]
    docs = []
    for i in range(150):
        text = ""
        for _ in range(rng.choice([0, 1, 3, 30, 90])):
            text += rng.choice(words[: rng.choice([4, 20])]) + rng.choice([" ", " ", " ", rng.choice(ends)])
        docs.append(([None, "de", "en", "und"][i % 4], text))
    docs += [("de", None), ("en", ""), (None, " \t .. ,"), ("en", "hot pair here " * 900), ("fr", "ab. " * 30)]
    docs += [("de", "exact copy of this line")] * 12
    return docs


@pytest.mark.parametrize("limits", [{}, {"SMALL": 4}, {"SMALL": 8, "HOT_SUFFIXES": 6, "CHUNK_SUFFIXES": 40, "CHUNK_BYTES": 700, "OVERFULL": 2}])
def test_collocations_match_a_plain_version(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(collocations, name, value)
    docs = some_docs()
    rows = [(i, text, lang, "x", 1) for i, (lang, text) in enumerate(docs)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string, a int")
    for longest in (3, 4) if limits else (3,):
        got = collocations.collocations(table, longest=longest, first=None).collect()
        assert sorted(tuple(r) for r in got) == plain_collocations(docs, longest)
    short = collocations.collocations(table, first=2).collect()
    assert sorted(tuple(r) for r in short) == [r for r in plain_collocations(docs) if r[1] <= 2]


def test_collocations_of_nothing(spark):
    schema = "text string, lang string"
    for rows in ([], [(None, None)], [("", "en"), (". .", "en")], [("one two", "en")]):
        assert collocations.collocations(spark.createDataFrame(rows, schema)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 4_000_000_019, 4_000_000_033, 7_777_777_777
    row = spark.range(1).selectExpr(f"{a}L a", f"{left}L l", f"{right}L r")
    row = row.select(*[F.col(c).cast("decimal(19,0)") for c in "alr"]).selectExpr("1000000 * a * a div (l * r) s")
    assert row.first()["s"] == 1000000 * a * a // (left * right)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    text = b"A b, " * 40 + b"x" * 200 + b". end " + b"y " * 100
    parts = list(collocations.pieces_of([text]))
    assert b"".join(parts) == text.translate(collocations.FOLD)
    assert all(p.endswith(b".") for p in parts[:-1]) and max(map(len, parts)) <= 206


# --- main text


def plain_main_text(page):
    """The supplied pages have one article, of a heading and paragraphs; the page may be cut off anywhere."""
    page = re.sub(r"<[A-Za-z/!][^>]*$", "", page or "")
    body = re.split(r"</article>|<footer>", page.partition("<article>")[2])[0]
    blocks = [re.sub(r"</?b>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.1"])
def test_main_text_of_all_pages(spark, name):
    folder = f"/root/testdata/{name}"
    got = {r["page_id"]: r for r in QUERIES["op13_main_text"](spark, folder).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{folder}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        want = plain_main_text(page)
        assert (got[page_id]["url"], got[page_id]["text"], got[page_id]["n_chars"]) == (url, want, len(want))


ARTICLE = "<h1>A title</h1><p>First paragraph, with enough words to look like text of an article.</p><p>Short.</p>"
TEXT = "A title\n\nFirst paragraph, with enough words to look like text of an article.\n\nShort."
LONG = "Words that a visitor might want to read if they were not an advert or a notice, again and again. " * 4


@pytest.mark.parametrize(
    "page",
    [
        f"<body><header><h1>Site</h1>{LONG}</header><main>{ARTICLE}</main><footer>{LONG}</footer>",
        f"<div class='menu'><ul><li>a<li>b</ul></div><div id=content>{ARTICLE}</div><div class='sidebar'>{LONG}</div>",
        f"<article>{ARTICLE}<div class='ad'>{LONG}</div><form><p>{LONG}<input></form></article><section id=comments><p>{LONG}</section>",
        f"<div class=ad><article>{ARTICLE}</article>",
        f"<p class='cookie-notice'>{LONG}</p><div role=navigation>{LONG}</div><div>{ARTICLE}</div><aside>{LONG}</aside>",
        f"<script>var x = '<p>{LONG}'</script><style>p {{}}</style><!-- {LONG} --><article>{ARTICLE}<script>x</script></article>",
        f"<article>{ARTICLE}</article><div class=comments><article class=comment><p>{LONG}</p></article></div>",
        f"<article><h1>A&#32;<b>ti</b>tle</h1><p>First  paragraph,\n<em>with</em>\tenough words to look<br>like text of an article.<p>Short.</article>",
        f"<body>{ARTICLE}<div style='display: none'>{LONG}</div><div hidden>{LONG}</div></body>",
        f"<article>{ARTICLE}<span class=ad>{LONG}</span><noscript>{LONG}</noscript></article>",
    ],
)
def test_other_layouts(page):
    assert maintext.main_text(page) == TEXT


def test_odd_pages(spark):
    deep = "<div>" * 30_000 + "<p>deep text here</p>" + "</span>" * 30_000
    rows = [(1, "u", None), (2, None, ""), (None, "u", ARTICLE), (4, "u", ARTICLE), (4, "u", ARTICLE), (5, "u", deep),
            (6, "u", "<![foo bar"), (7, "u", "<p>a &lt; b &amp;amp; &#x110000; &bogus; &am"), (8, "u", "<article><p>x" * 20_000),
            (9, "u", "<table><tr><td>a<td>b<tr><td>c</table>"), (10, "u", "no markup\nat all"), (11, "u", "<p>cut <b"), (12, "u", "<script>")]
    table = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = maintext.extract_main_text(table).collect()
    assert len(got) == len(rows) and [r["n_chars"] for r in got] == [len(r["text"]) for r in got]
    texts = [r["text"] for r in got]
    assert texts[:7] == ["", "", TEXT, TEXT, TEXT, "deep text here", ""]
    assert texts[7] == "a < b &amp; � &bogus; &am"
    assert texts[9:] == ["a b\n\nc", "no markup at all", "cut", ""]
    assert maintext.extract_main_text(table.limit(0)).count() == 0
