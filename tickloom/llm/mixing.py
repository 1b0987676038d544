"""Mixing sources to target weights by weighted sampling without replacement.

Every source gets a word budget. A budget beyond the source's size means complete epochs first: every
document is taken that many times. The rest of the budget is a fraction of an epoch, filled by
Efraimidis-Spirakis sampling: each document draws an exponential key divided by its quality weight, the
documents of a source are sorted by key, and sizes are summed until the budget is reached.

Only DataFrame functions are used. A source may own any share of the rows: sorting and summing run over
range partitions of (source, key), of which a large source spans many.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise
from tickloom.operators.spread import attach_per_key, join_on_keys, ordered_chunks, row_numbers, running_total

# Hexadecimal digits of the MD5 sum that make the uniform draw: 52 bits, exact in a double.
DRAW_DIGITS = 13
REPEATS = 3
#: The number of a row, where rows with equal doc_id are to be told apart.
ROW = "__row_number"


def uniform(key: Column, seed: int) -> Column:
    """A repeatable draw from (0, 1) for a key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(16**DRAW_DIGITS))


def share_budget(per_source: DataFrame, total: int, repeats: int = REPEATS) -> DataFrame:
    """Add ``target`` to rows (source, source_size, weight): the words each source is to give.

    Targets are in proportion to the weights and sum to ``total``. None passes ``repeats`` times its
    source's size; what is above is shared again by weight among the others until none is above. Each
    round reads two sums, and the level only rises, so at most one round per source is needed.
    """
    cap = F.col("source_size") * F.lit(float(repeats))
    level = None
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("weight") >= cap
        sums = per_source.agg(
            F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("free")
        ).first()
        if not sums["free"]:
            return per_source.withColumn("target", cap)
        rest = (total - (sums["capped"] or 0.0)) / sums["free"]
        if level is not None and rest <= level:
            break
        level = rest
    return per_source.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def cycling_weights(per_source: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Add ``weight``: the values of ``cycle`` in turn, by code point of the source, null last."""
    placed = row_numbers(
        per_source.withColumn("__last", F.col("source").isNull()), [], ["__last", "source"], "__row", "__rows"
    )
    values = F.array(*[F.lit(float(w)) for w in cycle])
    at = F.pmod(F.col("__row") - 1, F.lit(len(cycle))).cast("int")
    return placed.withColumn("weight", F.get(values, at)).drop("__row", "__rows", "__last")


def source_sizes(sized: DataFrame) -> DataFrame:
    """One row per source: its words and documents. Null is a source of its own."""
    return sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_documents")
    )


def mix(sized: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Decide how often each document enters the mix.

    ``sized`` has doc_id, source, size (words) and quality (a weight above 0; null counts as 1, and a
    document of weight 0 or less comes last). ``targets`` has source, source_size, source_documents and
    target. Returns doc_id, source, size, source_size, target, epochs (complete ones) and times (how often
    the document is taken). The last document of a fraction enters if at least half of it is inside the
    budget. Rows with equal doc_id draw the same key; ties go by doc_id, size and source order of arrival,
    so repeated rows may swap places without changing the result. A column ``ROW`` of ``sized`` is kept.
    Documents of size 0, such as null and empty texts, take part and count nothing; very long ones count whole. An
    empty table gives an empty table.
    """
    weight = F.coalesce(F.col("quality").cast("double"), F.lit(1.0))
    key = F.when(weight > 0, -F.log(uniform(F.col("doc_id"), seed)) / weight).otherwise(F.lit(float("inf")))
    row = [ROW] if ROW in sized.columns else []
    keyed = sized.select("doc_id", "source", "size", *row, key.alias("__draw"))
    summed = running_total(
        ordered_chunks(keyed, ["source"], ["__draw", "doc_id", "size", *row]), ["source"], "size", "__upto"
    )
    told = attach_per_key(summed.drop("whole_total"), targets, ["source"], "source_documents")
    # Equal to the target exactly where a source is taken ``repeats`` times, so the fraction is then 0.
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    enters = F.col("__upto") - F.col("size") / 2 <= F.col("rest")
    return (
        told.withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", rest)
        .withColumn("times", F.col("epochs") + F.when(enters & (F.col("rest") > 0), 1).otherwise(0))
        .select("doc_id", "source", "size", "source_size", "target", "epochs", "times", *row)
    )


def label_quality(labels: DataFrame, good: float = 1.0, bad: float = 0.5) -> DataFrame:
    """One quality weight per labelled doc_id, repeated labels averaged."""
    value = F.when(F.col("quality") == 1, good).when(F.col("quality") == 0, bad)
    return labels.groupBy("doc_id").agg(F.avg(value).alias("quality"))


def sized_documents(docs: DataFrame, size: Column, quality: DataFrame | None = None) -> DataFrame:
    """Written rows (doc_id, source, size, quality) for ``mix``: the texts are read once."""
    row = [ROW] if ROW in docs.columns else []
    sized = docs.select("doc_id", "source", size.alias("size"), *row)
    if quality is not None:
        sized = sized.join(quality.select("doc_id", "quality"), "doc_id", "left")
    else:
        sized = sized.withColumn("quality", F.lit(1.0))
    return materialise(sized, "sized")


def repeat_documents(docs: DataFrame, times: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``times`` (of ``mix``) says.

    Rows are told apart by ``ROW`` where both have it, otherwise by doc_id: rows with equal doc_id are then
    all taken as often as one of them.
    """
    name = "__times"
    if ROW in docs.columns and ROW in times.columns:
        joined = docs.join(times.select(ROW, F.col("times").alias(name)), ROW).drop(ROW).filter(F.col(name) > 0)
    else:
        told = times.groupBy("doc_id").agg(F.max("times").alias(name))
        joined = join_on_keys(docs, told, ["doc_id"], "inner").filter(F.col(name) > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col(name).cast("int")))
    return joined.withColumn("__copy", copies).drop(name, "__copy")


def mixed_corpus(docs: DataFrame, size: Column, quality: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """``docs`` mixed with cycling weights and a budget of all its words: every row as often as the mix takes it.

    Rows are written once with a number of their own, so rows without a doc_id, or with an equal one, are decided one by
    one. Columns of any name and type are kept. ``size`` is an expression over ``docs``; with ``count_words`` a
    null or empty text has size 0, counts nothing, and is taken as its source's epochs have it. An empty table
    gives an empty one.
    """
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    # Only names of its own beside the document, whatever its columns are called.
    rows = materialise(docs.select(document, size.alias("size"), F.monotonically_increasing_id().alias(ROW)), "numbered-rows")
    told = rows.select(F.col("document.doc_id").alias("doc_id"), F.col("document.source").alias("source"), "size", ROW)
    mixed = mix_documents(told, F.col("size"), quality, seed)
    return repeat_documents(rows, mixed).select("document.*")


def mix_documents(
    docs: DataFrame, size: Column, quality: DataFrame | None = None, seed: int = 0
) -> DataFrame:
    """``mix`` with cycling weights and a budget of all words of ``docs``."""
    sized = sized_documents(docs, size, quality)
    per_source = materialise(cycling_weights(source_sizes(sized)), "sources")
    total = per_source.agg(F.sum("source_size")).first()[0] or 0
    return mix(sized, share_budget(per_source, total), seed)


__all__ = [
    "cycling_weights",
    "label_quality",
    "mix",
    "mix_documents",
    "mixed_corpus",
    "repeat_documents",
    "share_budget",
    "sized_documents",
    "source_sizes",
    "uniform",
]
