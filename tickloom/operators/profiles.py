"""Fields of many pages at once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.pages import (
    NO_DATA,
    PAIRED_WITH,
    PROFILE_FIELDS,
    element_texts,
    markup,
    nth_text,
    paired_text,
    tag_table,
)


def extract_fields(
    pages: DataFrame,
    fields: list[tuple[str, str, str | None, int]],
    html: str = "html",
    keep: list[str] | None = None,
    default: str | None = NO_DATA,
) -> DataFrame:
    """Add one text column per ``(name, tag, class, position)``.

    The page is cleaned once, read once per tag name into a table of its tags, and each distinct (tag, class)
    is looked up there once, however many positions are taken from it. Narrow: no shuffle, no Python.
    """
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    wanted: dict[tuple[str, str | None], int] = {}
    for _, tag, class_, index in fields:
        wanted[(tag, class_)] = max(wanted.get((tag, class_), 0), index + 1)
    names = {lookup: f"__texts_{i}" for i, lookup in enumerate(wanted)}
    tags = sorted({tag for tag, _ in wanted})
    cleaned = pages.select(*keep, markup(F.col(html)).alias("__page"))
    cut = cleaned.select(*keep, *[tag_table("__page", t, any(c for n, c in wanted if n == t)).alias(f"__{t}") for t in tags])
    searched = cut.select(
        *keep,
        *[
            element_texts(f"__{tag}", class_, first).alias(names[(tag, class_)])
            for (tag, class_), first in wanted.items()
        ],
    )
    return searched.select(
        *keep,
        *[nth_text(F.col(names[(tag, c)]), i, default).alias(name) for name, tag, c, i in fields],
    )


def company_profile(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The ten profile fields of company pages, one row per page."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    fields = [(name, "div", class_, index) for name, class_, index in PROFILE_FIELDS]
    found = extract_fields(pages, fields, html, keep, default=None)
    names = [name for name, _, _ in PROFILE_FIELDS]
    return found.select(
        *keep,
        *[
            paired_text(F.col(PAIRED_WITH[n]), F.col(n)).alias(n)
            if n in PAIRED_WITH
            else F.coalesce(n, F.lit(NO_DATA)).alias(n)
            for n in names
        ],
    )
