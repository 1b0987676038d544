"""Language of web pages by Bayesian fusion of evidence.

Four sources speak for a language: the text (a model of character trigrams counted over all documents with
a known language), the language that the markup declares, the suffix of the address, and what else its
host and domain hold. The last three are counted over all pages by grouped aggregation of the text's
verdicts; a page's own share is taken out again before its counts are used on it. Sparse hosts lean on
their domain, and sparse domains on all pages.
"""

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.hashing import slices
from tickloom.llm.tables import materialise
from tickloom.operators.spread import attach_per_key

BUCKETS = 1 << 14
#: Trigrams of a text do not speak independently; together they count as at most so many.
TEXT_WEIGHT = 40.0
#: Pages that the level above is worth where a host or domain is counted.
PRIOR_PAGES = 4.0
SMOOTHING = 0.5

OPENING = re.compile(r"<!--|<(script|style|noscript)\b|</?[a-z]|<[!?]", re.I)
TAG_REST = re.compile(r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>")
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript")}
ROOT_TAG = re.compile(r"<html\b[^>]*", re.I)
DECLARED = re.compile(r"\slang\s*=\s*[\"']?([a-z]{2,3})", re.I)
#: Second-level names under which countries register domains (fixed values).
SHARED_SUFFIXES = ["ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "ltd", "mil", "ne", "net", "or", "org", "plc"]
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the UTF-8 bytes of a text in lower case, with runs of blanks as one."""
    raw = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def visible_text(page: str) -> str:
    """A page without tags, comments and scripts, in one pass whatever the page holds.

    A comment or script without an end hides the rest of the page. Should a quote never end, tags end at
    the next angle bracket from there on.
    """
    shown, at, quotes_end = [], 0, True
    while (found := OPENING.search(page, at)) is not None:
        shown.append(page[at : found.start()])
        if found[0] == "<!--":
            end = page.find("-->", found.end())
            at = len(page) if end < 0 else end + 3
            continue
        rest = TAG_REST.match(page, found.end()) if quotes_end else None
        if rest is not None:
            at = rest.end()
        else:
            quotes_end = False
            end = page.find(">", found.end())
            at = len(page) if end < 0 else end + 1
        if found[1]:
            closing = CLOSING[found[1].lower()].search(page, at)
            at = closing.end() if closing else len(page)
    shown.append(page[at:])
    return html.unescape(" ".join(shown))


def declared_language(page: str) -> str | None:
    root = ROOT_TAG.search(page)
    found = DECLARED.search(root[0]) if root else None
    return found[1].lower() if found else None


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all documents with a language and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in (w.slice(a, b - a) for w in batches for a, b in slices(w.column(1))):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in counts.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(own[used])],
                ["lang", "bucket", "n"],
            )

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = known.mapInArrow(run, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class TextModel:
    """Log-likelihoods of trigrams per language: a table of fixed width, with a row per language."""

    def __init__(self, counts: pa.Table):
        self.langs = sorted(set(counts["lang"].to_pylist()))
        table = np.zeros((len(self.langs), BUCKETS))
        rows = np.searchsorted(np.array(self.langs), np.array(counts["lang"].to_pylist(), object).astype(str))
        if len(self.langs):
            table[rows, counts["bucket"].to_numpy()] = counts["n"].to_numpy()
        table += SMOOTHING
        self.logs = np.log(table / table.sum(axis=1, keepdims=True))

    def likelihoods(self, text: str) -> np.ndarray:
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.langs))
        sums = self.logs @ np.bincount(found, minlength=BUCKETS)
        return (sums - sums.max()) * min(1.0, TEXT_WEIGHT / len(found))


def text_evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """Per page: page_id, url, declared, likelihoods and the text's own verdict (shares that sum to 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (w.slice(a, b - a) for w in batches for a, b in slices(w.column(2))):
            declared, logs, shares = [], [], []
            for page in batch.column(2).to_pylist():
                declared.append(declared_language(page or ""))
                own = model.likelihoods(visible_text(page or ""))
                logs.append(own.tolist())
                part = np.exp(own)
                shares.append((part / part.sum()).tolist())
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(declared, pa.string()), pa.array(logs, kind), pa.array(shares, kind)],
                ["page_id", "url", "declared", "logs", "shares"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, declared string, logs array<double>, shares array<double>"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def counted(pages: DataFrame, key: str, langs: int, name: str) -> DataFrame:
    """Per value of ``key`` (null is one) its pages and the sum of their shares, as an array over languages."""
    sums = F.array(*[F.sum(F.col("shares")[i]) for i in range(langs)])
    return pages.groupBy(key).agg(sums.alias(name), F.count("*").alias("__pages"))


def with_counts(pages: DataFrame, key: str, langs: int, name: str) -> DataFrame:
    """Add the sums of a page's key without the page itself. A value may have any share of the pages."""
    joined = attach_per_key(pages, counted(pages, key, langs, name), [key], "__pages").drop("__pages")
    others = F.zip_with(name, "shares", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    return joined.withColumn(name, others)


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def registered_domain(host: Column) -> Column:
    """The domain a host is registered under: two labels, or three below a country's shared suffix (``co.uk``).

    So all hosts of a site share their domain's counts; addresses made of numbers are domains of their own.
    """
    labels = F.split(host, r"\.")
    count = F.size(labels)
    shared = (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, count - 2).isin(SHARED_SUFFIXES)
    taken = F.when(shared, 3).otherwise(2)
    name = F.array_join(F.slice(labels, F.greatest(count - taken + 1, F.lit(1)), taken), ".")
    return F.when(host.rlike(r"^[0-9.]+$") | host.contains(":"), host).otherwise(name)


def identify_languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page: page_id, declared, text_lang, lang and confidence (the posterior of ``lang``).

    A null page has no text and no declaration, a null address no suffix and host (pages without one share
    a host of their own); then the other evidence decides. Repeated pages each count. Pages of any length are read
    whole. Ties go to the first language by code point. If no document has a language, lang is null. Other columns are
    not read. A host's counts lean on its domain's other hosts, whose own pages are not counted twice.
    """
    model = TextModel(count_trigrams(docs).orderBy("lang", "bucket").toArrow())
    langs = len(model.langs)
    if not langs:
        none = F.lit(None).cast("string")
        return pages.select(
            "page_id", none.alias("declared"), none.alias("text_lang"), none.alias("lang"),
            F.lit(None).cast("double").alias("confidence"),
        )
    seen = text_evidence(pages, model)
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)), F.lit(""))
    labels = F.split(F.col("host"), r"\.")
    seen = seen.withColumn("host", host).withColumns(
        {"domain": registered_domain(F.col("host")), "suffix": F.element_at(labels, -1)}
    )
    seen = materialise(seen, "pages")
    whole = seen.agg(*[F.sum(F.col("shares")[i]).alias(str(i)) for i in range(langs)]).first()
    everywhere = F.array(*[F.lit(float(x or 0.0)) for x in whole])
    for key, name in (("declared", "by_declared"), ("suffix", "by_suffix"), ("domain", "by_domain"), ("host", "by_host")):
        seen = with_counts(seen, key, langs, name)
    # The domain speaks through its other hosts only: what the host holds is its own evidence, and counts once.
    others = F.zip_with("by_domain", "by_host", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    seen = seen.withColumn("by_domain", others)

    def prior(counts: Column, above: Column) -> Column:
        """Counts smoothed towards the shares of the level above."""
        size = total(counts)
        return F.zip_with(counts, above, lambda n, p: (n + PRIOR_PAGES * p) / (size + PRIOR_PAGES))

    def likelihood(counts: Column, kinds: float) -> Column:
        """How often pages of each language show this value."""
        return F.zip_with(counts, everywhere, lambda n, all_: F.log((n + SMOOTHING) / (all_ + SMOOTHING * kinds)))

    top = F.transform(everywhere, lambda n: (n + SMOOTHING) / (total(everywhere) + SMOOTHING * langs))
    placed = seen.withColumn("prior", prior(F.col("by_domain"), top))
    placed = placed.withColumn("prior", prior(F.col("by_host"), F.col("prior")))
    sums = F.zip_with("logs", F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b)
    sums = F.zip_with(sums, F.when(F.col("declared").isNotNull(), likelihood(F.col("by_declared"), 2.0 * langs)).otherwise(F.array_repeat(F.lit(0.0), langs)), lambda a, b: a + b)
    sums = F.zip_with(sums, F.when(F.col("suffix").isNotNull(), likelihood(F.col("by_suffix"), 2.0 * langs)).otherwise(F.array_repeat(F.lit(0.0), langs)), lambda a, b: a + b)
    placed = placed.withColumn("fused", sums)
    names = F.array(*[F.lit(x) for x in model.langs])
    best = F.array_max("fused")
    return placed.select(
        "page_id",
        "declared",
        F.when(F.size("logs") > 0, F.get(names, (F.array_position("logs", F.array_max("logs")) - 1).cast("int"))).alias("text_lang"),
        F.get(names, (F.array_position("fused", best) - 1).cast("int")).alias("lang"),
        (1 / total(F.transform("fused", lambda x: F.exp(x - best)))).alias("confidence"),
    )
