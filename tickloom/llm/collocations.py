"""Phrase collocations per language, counted by sorting suffix pointers.

A text is cut into pieces and words, and every word is a pointer to the suffix that starts there. Multikey
three-way quicksort orders the pointers by their first words: a partition is split around a pivot word into
smaller, equal and larger; the equal part goes on with the next word, and its size is the count of the
phrase it shares. The sort ends at the maximum phrase length, and abandons parts too small to matter.

It runs twice. Each task sorts the pointers of its own texts and writes what follows each leading word, equal
suffixes with their number. These rows are then routed by leading word, so that a task sorts all suffixes of its words and
can abandon infrequent parts for good. A word with very many suffixes is routed by two leading words, and
such a pair by all three, so that no word or pair has to fit in one task.
"""

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.hashing import slices
from tickloom.operators.spread import attach_per_key
from tickloom.storage import materialise, new_path

# Bytes of text sorted at once; more equal suffixes meet in larger chunks.
CHUNK_BYTES = 12 << 20
# Suffixes sorted at once after routing, and those of one lead, or one part of it, that stay together.
CHUNK_SUFFIXES = 1 << 20
HOT_SUFFIXES = 1 << 19
# A part of a lead that holds this many times its share is routed by one word more.
OVERFULL = 4
# Parts up to this size are sorted directly, many at a time.
SMALL = 1024
# What ends a piece, and blanks inside it; only A-Z are lower-cased.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"."
_TO = bytearray(range(256))
for _c in range(65, 91):
    _TO[_c] = _c + 32
for _c in PIECE_ENDS:
    _TO[_c] = MARK[0]
_TO[9] = 32
FOLD = bytes(_TO)
# The "word" behind the last one of a piece; sorts first and ends a phrase.
END = -1


def quicksort(
    words: list[np.ndarray], weights: np.ndarray, starts: np.ndarray, least: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of suffixes within the groups [starts[i], starts[i+1]).

    ``words[d]`` holds the number of each suffix's word at depth d, ``weights`` how often it occurs. A part
    whose weight is below ``least`` is abandoned, as no phrase in it can occur so often. Returns the order of the
    suffixes; the parts left for direct sorting, as rows (begin, end, words known to be equal); and what the
    equal parts have counted, as rows (a suffix, words, weight).
    """
    at = np.arange(len(weights))
    ends = np.append(starts[1:], len(at))
    heavy = np.add.reduceat(weights, starts) >= least if len(starts) else np.zeros(0, np.bool_)
    large = heavy & (ends - starts > SMALL)
    direct = heavy & ~large
    rest = [np.stack((starts[direct], ends[direct], np.zeros(direct.sum(), np.int64)), axis=1)]
    counted = [np.zeros((0, 3), np.int64)]
    todo = [(int(b), int(e), 0) for b, e in zip(starts[large], ends[large], strict=True)]
    while todo:
        begin, end, depth = todo.pop()
        part = at[begin:end]
        word = words[depth][part]
        sample = np.sort(word[:: max(1, len(word) // 9)])
        pivot = sample[len(sample) // 2]
        less, equal = word < pivot, word == pivot
        smaller, same, larger = part[less], part[equal], part[~(less | equal)]
        at[begin:end] = np.concatenate((smaller, same, larger))
        one, two = begin + len(smaller), end - len(larger)
        for b, e, known in ((begin, one, depth), (one, two, depth + 1), (two, end, depth)):
            weight = int(weights[at[b:e]].sum())
            if b == e or weight < least:
                continue
            if known > depth and pivot != END:
                counted.append(np.array([[at[b], known, weight]]))
            over = known == len(words) or (known > depth and pivot == END)
            if over or e - b <= SMALL:
                rest.append(np.array([[b, e, known]]))
            else:
                todo.append((b, e, known))
    parts = np.concatenate(rest)
    return at, parts[np.argsort(parts[:, 0], kind="stable")], np.concatenate(counted)


def sort_parts(words: list[np.ndarray], at: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of all small parts sorted at once, and the part of each."""
    lengths = parts[:, 1] - parts[:, 0]
    part = np.repeat(np.arange(len(parts)), lengths)
    inside = np.arange(len(part)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = at[np.repeat(parts[:, 0], lengths) + inside]
    order = np.lexsort([w[at] for w in reversed(words)] + [part])
    return at[order], part[order]


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where any of some columns changes."""
    new = np.zeros(len(columns[0]), np.bool_)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def sums(weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights, first) if len(first) else np.zeros(0, np.int64)


def distinct_suffixes(words: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different suffixes in order, and how often each occurs."""
    count = len(words[0])
    ones, start = np.ones(count, np.int64), np.zeros(min(1, count), np.int64)
    at, parts, _ = quicksort(words, ones, start)
    at, _ = sort_parts(words, at, parts)
    words = [w[at] for w in words]
    first = run_starts(words)
    return [w[first] for w in words], sums(ones, first)


def frequent_phrases(
    words: list[np.ndarray], weights: np.ndarray, starts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a suffix that begins with it, number of words, weight) of every phrase of weight ``least`` or more.

    A phrase is counted by the equal part that it makes, or, in parts sorted directly, by its run.
    """
    at, parts, counted = quicksort(words, weights, starts, least)
    at, part = sort_parts(words, at, parts)
    known = parts[part, 2] if len(part) else part
    out = [counted]
    for d in range(1, len(words) + 1):
        first = run_starts([part, *[w[at] for w in words[:d]]])
        weight = sums(weights[at], first)
        taken = (weight >= least) & (words[d - 1][at[first]] != END) & (known[first] < d)
        out.append(np.stack((at[first], np.full(len(first), d), weight), axis=1)[taken])
    found = np.concatenate(out)
    return found[:, 0], found[:, 1], found[:, 2]


def encode(words: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Words as numbers, and the distinct words by number."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def pieces_of(texts: list[bytes]) -> Iterator[bytes]:
    """Folded texts, each in slices that end with a piece where it has one in reach."""
    for text in texts:
        folded = text.translate(FOLD)
        begin = 0
        while begin < len(folded):
            end = len(folded)
            if end - begin > CHUNK_BYTES:
                found = folded.rfind(MARK, begin, begin + CHUNK_BYTES)
                found = folded.find(MARK, begin + CHUNK_BYTES) if found <= begin else found
                end = found + 1 if found >= 0 else end
            yield folded[begin:end]
            begin = end


def local_suffixes(lang: str, texts: list[bytes], depth: int) -> list[pa.RecordBatch]:
    """What follows each word of folded texts of a language, a row per word: ``ROWS``.

    ``tails`` has a line per distinct suffix behind the lead, its words joined by blanks, rising in the order
    of some numbering; ``counts`` their numbers as 32-bit integers. Suffixes without a second word have none.
    """
    number, names = encode((MARK + b" " + (b" " + MARK + b" ").join(texts).replace(MARK, b" . ")).split())
    mark = pa.compute.index(names, MARK).as_py()
    number[number == mark] = END
    padded = np.append(number, [END] * depth)
    columns, over = [], np.zeros(len(number), np.bool_)
    for d in range(depth):
        word = np.where(over, END, padded[d : d + len(number)])
        over |= word == END
        columns.append(word)
    real = number != END
    words, counts = distinct_suffixes([c[real] for c in columns])
    first, columns = packed(words[0], words[1:], counts, names)
    return as_rows(lang, names.take(pa.array(words[0][first])), np.zeros(len(first)), columns)


def joined(words: list[np.ndarray], names: pa.Array) -> pa.Array:
    """The words of each suffix joined by blanks, up to its end."""
    known = [names.take(pa.array(w, mask=w == END)) for w in words]
    if len(known) == 1:
        return known[0]
    return pa.compute.binary_join_element_wise(*known, b" ", null_handling="skip")


def packed(group: np.ndarray, tails: list[np.ndarray], weights: np.ndarray, names: pa.Array) -> tuple[np.ndarray, dict]:
    """The tails of each run of equal ``group`` as lines: where the runs start, and the columns of a row for each."""
    first = run_starts([group])
    has = tails[0] != END
    behind = np.cumsum(np.append(0, has))[np.append(first, len(group))]
    lines = joined([t[has] for t in tails], names)
    lines = pa.compute.binary_join_element_wise(lines, b"", b"\n") if len(lines) else pa.array([], pa.binary())
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[: len(lines) + 1] if len(lines) else np.zeros(1, np.int32)
    # A chunk of texts has fewer words than a 32-bit number can count.
    counts = weights[has].astype("<u4")

    def cut(at: np.ndarray, data) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), data])

    return first, {
        "tails": cut(offsets[behind], lines.buffers()[2] if len(lines) else pa.py_buffer(b"")),
        "counts": cut(behind * 4, pa.py_buffer(counts.tobytes())),
        "suffixes": pa.array(np.diff(behind), pa.int64()),
        "weight": pa.array(sums(weights, first), pa.int64()),
    }


ROWS = "lang string, lead string, part int, tails binary, counts binary, suffixes long, weight long"


def as_rows(lang: str, lead: pa.Array, part: np.ndarray, columns: dict) -> list[pa.RecordBatch]:
    langs = pa.array([lang] * len(lead), pa.string())
    rows = {"lang": langs, "lead": lead.cast(pa.string()), "part": pa.array(part, pa.int32()), **columns}
    return pa.table(rows).to_batches(max_chunksize=4096)


def _sort_texts(depth: int):
    """Batches of (lang, text) to rows of suffixes, sorted in chunks of bounded bytes per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in sorted(waiting):
                yield from local_suffixes(lang, waiting[lang], depth)
            waiting.clear()

        for batch in batches:
            for begin, end in slices(batch.column(1)):
                langs = batch.column(0).slice(begin, end - begin).to_pylist()
                texts = batch.column(1).slice(begin, end - begin).cast(pa.binary()).to_pylist()
                for lang, text in zip(langs, texts, strict=True):
                    for piece in pieces_of([text] if text else []):
                        if size + len(piece) > CHUNK_BYTES:
                            yield from flush()
                            size = 0
                        waiting.setdefault(lang, []).append(piece)
                        size += len(piece)
        yield from flush()

    return run


def unpacked(tails: pa.Array, counts: pa.Array, columns: int) -> tuple[list[np.ndarray], np.ndarray, pa.Array]:
    """The words of all lines as ``columns`` of numbers, their counts, and the words by number."""
    blob = b"".join(tails.to_pylist())
    weights = np.frombuffer(b"".join(counts.to_pylist()), "<u4").astype(np.int64)
    if not blob:
        return [np.zeros(0, np.int64) for _ in range(columns)], weights, pa.array([], pa.binary())
    # Every line ends with a line end, behind which the split leaves one empty word.
    number, names = encode(blob.replace(b"\n", b" \n ").split(b" ")[:-1])
    ends = np.flatnonzero(number == pa.compute.index(names, b"\n").as_py())
    begins = np.append(0, ends[:-1] + 1)
    out = []
    for d in range(columns):
        there = begins + d < ends
        out.append(np.where(there, number[np.where(there, begins + d, 0)], END))
    return out, weights, names


def _per_row(depth: int, split):
    """``split`` every row (lang, lead, tails, counts, slices) that has something behind its lead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, lead, tails, counts, slices_ = batch.slice(i, 1).columns
                words, weights, names = unpacked(tails, counts, depth)
                if len(weights):
                    yield from split(lang[0].as_py(), lead[0].as_py(), words, weights, names, slices_[0].as_py())

    return run


def deal(lang: str, lead: str, words: list[np.ndarray], weights: np.ndarray, names: pa.Array, count: int):
    """The suffixes of a lead in ``count`` parts, by the hash of the word behind it."""
    part = np.array([zlib.crc32(w) % count for w in names.to_pylist()], np.int64)[words[0]]
    order = np.argsort(part, kind="stable")
    first, columns = packed(part[order], [w[order] for w in words], weights[order], names)
    return as_rows(lang, pa.array([lead] * len(first), pa.string()), part[order][first], columns)


def lengthen(lang: str, lead: str, words: list[np.ndarray], weights: np.ndarray, names: pa.Array, count: int):
    """A row for the lead with each word behind it; equal words stand together already."""
    first, columns = packed(words[0], words[1:] or [np.full(len(weights), END)], weights, names)
    longer = pa.compute.binary_join_element_wise(lead.encode(), names.take(pa.array(words[0][first])), b" ")
    return as_rows(lang, longer, np.zeros(len(first)), columns)


def _sort_routed(depth: int, least: int):
    """Rows sorted by (lang, lead, part), each with up to ``depth`` words behind the lead, to frequent phrases."""

    def phrases(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        langs, leads = rows["lang"].combine_chunks(), rows["lead"].combine_chunks()
        keys = [c.dictionary_encode().indices.to_numpy() for c in (langs, leads)] + [rows["part"].to_numpy()]
        before = np.append(0, np.cumsum(rows["suffixes"].to_numpy()))
        first_row = run_starts(keys)
        starts, ends = before[first_row], before[np.append(first_row[1:], rows.num_rows)]
        # Leads without anything behind them have no suffixes to sort.
        first_row, starts = first_row[ends > starts], starts[ends > starts]
        words, weights, names = unpacked(rows["tails"], rows["counts"], depth)
        suffix, length, weight = frequent_phrases(words, weights, starts, least)
        row = first_row[np.searchsorted(starts, suffix, side="right") - 1]
        for d in np.unique(length):
            some = length == d
            at = pa.array(row[some])
            behind = joined([w[suffix[some]] for w in words[:d]], names)
            phrase = pa.compute.binary_join_element_wise(leads.take(at).cast(pa.binary()), behind, b" ")
            yield from pa.table(
                {"lang": langs.take(at), "phrase": phrase.cast(pa.string()), "f": pa.array(weight[some], pa.int64())}
            ).to_batches(max_chunksize=8192)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, last = [], 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            # Cut only between leads and parts, whose suffixes are sorted together.
            sizes = table["suffixes"].to_numpy()
            keys = list(zip(*(table[c].to_pylist() for c in ("lang", "lead", "part")), strict=True))
            begin = 0
            for i, key in enumerate(keys):
                if size >= CHUNK_SUFFIXES and key != last:
                    if i > begin:
                        waiting.append(table.slice(begin, i - begin))
                    yield from phrases(pa.concat_tables(waiting))
                    waiting, size, begin = [], 0, i
                size += int(sizes[i])
                last = key
            waiting.append(table.slice(begin))
        if waiting:
            yield from phrases(pa.concat_tables(waiting))

    return run


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table below the shared folder, compressed well: suffixes repeat each other."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def phrase_counts(docs: DataFrame, lang: str = "lang", longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Two tables: (lang, n), all words of a language, and (lang, phrase, f) of all phrases of up to ``longest``
    words that occur ``least`` times or more.

    Pieces, words and cases as in ``collocations``.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), "text").filter("text <> ''")
    rows = _written(texts.mapInArrow(_sort_texts(longest), ROWS), "suffixes")
    asked = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    totals = rows.groupBy("lang").agg(F.sum("weight").alias("n"))
    frequent = []
    for behind in range(longest - 1, -1, -1):
        leads = rows.groupBy("lang", "lead").agg(
            F.sum("weight").alias("f"), F.sum("suffixes").alias("s"), F.count("*").alias("__rows")
        )
        leads = _written(leads, "leads")
        frequent.append(leads.filter(F.col("f") >= least).select("lang", F.col("lead").alias("phrase"), "f"))
        if not behind:
            break
        size = leads.agg(F.sum("s").alias("all"), F.max("s").alias("most")).first()
        overfull = None
        if (size["most"] or 0) > HOT_SUFFIXES:
            slices_ = F.ceil(F.col("s") / HOT_SUFFIXES).cast("int").alias("slices")
            hot = leads.filter(F.col("s") > HOT_SUFFIXES).select("lang", "lead", "__rows", slices_)
            told = attach_per_key(rows, hot, ["lang", "lead"], "__rows")
            needed = ["lang", "lead", "tails", "counts", "slices"]
            dealt = told.filter("slices > 1").select(needed).mapInArrow(_per_row(behind, deal), ROWS)
            dealt = _written(dealt, "dealt")
            parts = dealt.groupBy("lang", "lead", "part").agg(F.sum("suffixes").alias("s"), F.count("*").alias("__rows"))
            overfull = materialise(parts.filter(F.col("s") > OVERFULL * HOT_SUFFIXES), "overfull")
            overfull = overfull.withColumn("slices", F.lit(0)).drop("s") if not overfull.isEmpty() else None
            if overfull is not None:
                dealt = attach_per_key(dealt, overfull, ["lang", "lead", "part"], "__rows")
                lengthened = dealt.filter("slices = 0").select(needed).mapInArrow(_per_row(behind, lengthen), ROWS)
                dealt = dealt.filter("slices IS NULL").drop("slices", "__rows")
            rows = told.filter("slices IS NULL").drop("slices", "__rows").unionByName(dealt)
        tasks = max(asked, -(-(size["all"] or 0) // CHUNK_SUFFIXES))
        key = ["lang", "lead", "part"]
        routed = rows.repartition(tasks, *key).sortWithinPartitions(*key)
        frequent.append(routed.mapInArrow(_sort_routed(behind, least), "lang string, phrase string, f long"))
        if overfull is None:
            break
        rows = _written(lengthened, "suffixes")
    return totals, _written(reduce(DataFrame.unionByName, frequent), "phrases")


def collocations(
    docs: DataFrame, lang: str = "lang", longest: int = 3, least: int = 10, covered: int = 50, first: int | None = 2000
) -> DataFrame:
    """The ``first`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and
    tabs. A phrase is two to ``longest`` neighbouring words of a piece, and a candidate if it occurs a >= ``least``
    times in its language, overlaps included. Cut in two, its parts occur l and r times; the score is
    floor(1000000 * a * a / (l * r)) of the lowest-scoring cut, exact, ties to the shortest first part. Candidates
    inside a longer one that occurs at least ``covered`` percent as often are dropped. n counts all words of the
    language. Order: score and a falling, then the phrase in byte order. ``first=None`` gives all.

    Rows without a language count as ``und``; null and empty texts have no words, and count nothing. Repeated rows count
    each time. An empty table gives an empty one. Texts of any length are sorted in bounded chunks; other columns are not read.
    """
    totals, found = phrase_counts(docs, lang, longest, least)
    split = F.split("phrase", " ")
    phrases = found.withColumn("words", F.size(split))
    candidates = phrases.filter("words > 1").withColumnRenamed("f", "a")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")}
    )
    # No more candidates begin, or end, with a part than it has occurrences to share among them.
    parts = phrases.filter(F.col("words") < longest)
    for part, count in (("first", "l"), ("rest", "r")):
        known = parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
        cuts = attach_per_key(cuts, known, ["lang", part], count)
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumns(exact).withColumn("score", F.expr("1000000 * a * a div (l * r)"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", F.col("a").cast("long").alias("a")).agg(lowest)

    # Every shorter phrase of two words or more inside a candidate, with the most frequent candidate around it.
    word = F.split("phrase", " ")
    around = candidates.filter("words > 2").select(
        "lang", "a", word.alias("w"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    )
    around = around.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("from"))
    around = around.withColumn("phrase", F.array_join(F.slice("w", F.col("from"), F.col("size")), " "))
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = scored.join(around, ["lang", "phrase"], "left")
    kept = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang",
        "rank",
        "phrase",
        "a",
        F.col("cut.l").cast("long").alias("l"),
        F.col("cut.r").cast("long").alias("r"),
        "n",
        F.col("cut.score").cast("long").alias("score"),
    )
