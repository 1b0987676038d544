"""Toxicity by compression distance: which of two zstandard dictionaries compresses a text's windows better.

One dictionary is trained on windows of ordinary text, the other on what the toxic samples have and the ordinary
ones lack: spans of words whose character grams stand in significantly more toxic samples. A window is compressed
with the ordinary dictionary and with both; zero bytes in place of the toxic one keep sizes and distances equal,
so that the two lengths differ only by what the toxic dictionary saves. A logistic curve turns a document's
window differences into a score, shifted so that 0.7 is the calibrated threshold. Curve and threshold are fitted on
differences that dictionaries of the other folds gave; the final dictionaries learn from all folds.

Fitting uses a bounded sample of labelled rows, a Spark task for each fold; scoring reads every whole text, and
each row on its own.
"""

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm.hashing import slices
from tickloom.llm.tables import free_name

#: Bounds of the fitting sample: rows of each label, bytes of each text (longer ones are not sampled), and bytes
#: of all texts of a label (in the order of the draw, rows beyond are left out).
FIT_ROWS = 2_000
FIT_TEXT_BYTES = 2 << 20
FIT_BYTES = 8 << 20
#: Folds of the sample, near copies together; a part of the fit for each, and one for all.
FOLDS = 5
#: The threshold has the best F1 on out-of-fold samples among those that flag at most this share of ordinary ones.
FALSE_SHARE = 0.01
WINDOW, STEP = 6, 3
#: Lengths of the grams that may tell samples apart; the shortest is the shortest match of the dictionaries.
GRAMS = (5, 8)
ORDINARY_BYTES = 65_536
#: A gram counts as toxic if it is so many times as frequent in toxic samples, and not by chance: among all
#: grams tested, of all samples together and of each group alike in words, so many pass by chance (expected).
LIFT, CHANCE = 20.0, 0.25
#: Samples count as copies of each other if so large a share of their three-word runs is common (estimated).
COPY_SHARE, SKETCH = 0.4, 64
#: Groups of the samples, and the frequent words that tell them apart.
GROUPS, GROUP_WORDS = 8, 512
THRESHOLD = 0.7

# Letters in lower case; other ASCII characters are blanks.
LOWER = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in bytes(range(256)).lower())
# Bytes are marked by their place in the word, so that a beginning only matches a beginning.
MARKS = np.array([37 * place % 256 for place in range(13)], np.uint8)
BLANK = 32


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in lower case, their bytes marked by place (a blank never results)."""
    raw = np.frombuffer(b" " + (text or "").encode().translate(LOWER) + b" ", np.uint8)
    blank = raw == BLANK
    at = np.arange(len(raw))
    place = at - np.maximum.accumulate(np.where(blank, at, 0)) - 1
    marked = raw ^ MARKS[np.clip(place, 0, len(MARKS) - 1)]
    marked[marked == BLANK] = 0
    marked[blank] = BLANK
    return [w for w in marked.tobytes().split(b" ") if w]


def padded(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def windows_of(words: list[bytes]) -> list[bytes]:
    """Overlapping windows over all words; the last one ends with the text."""
    return [padded(words[i : i + WINDOW]) for i in range(0, max(1, len(words) - WINDOW + STEP), STEP)] if words else []


def grams_of(words: list[bytes]) -> set[bytes]:
    return {p[i : i + n] for w in set(words) for p in (b" " + w + b" ",) for n in GRAMS for i in range(len(p) - n + 1)}


def evidence(k1: int, n1: int, k2: int, n2: int) -> float:
    """Log-likelihood ratio for different shares k1/n1 and k2/n2."""

    def log_likelihood(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    both = (k1 + k2) / (n1 + n2)
    return 2 * sum(log_likelihood(k, n, k / n) - log_likelihood(k, n, both) for k, n in ((k1, n1), (k2, n2)))


def groups_of(samples: list[list[bytes]]) -> np.ndarray:
    """A group for each sample, from its frequent words (languages, mostly): nearest of ``GROUPS`` directions."""
    seen = [set(words) for words in samples]
    frequent = sorted(Counter(w for some in seen for w in some).items(), key=lambda x: (-x[1], x[0]))[:GROUP_WORDS]
    place = {w: i for i, (w, _) in enumerate(frequent)}
    x = np.zeros((len(samples), len(place)), np.float32)
    for row, some in enumerate(seen):
        x[row, [place[w] for w in some if w in place]] = 1
    x *= np.log((len(samples) + 1) / np.maximum(x.sum(axis=0), 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    middles = x.mean(axis=0, keepdims=True)
    while len(middles) < GROUPS:  # the sample least like any middle so far begins the next one
        middles = np.vstack((middles, x[np.argmin((x @ middles.T).max(axis=1) + (~x.any(axis=1)))]))
    for _ in range(20):
        nearest = np.argmax(x @ middles.T, axis=1)
        for group in range(GROUPS):
            if (own := x[nearest == group]).any():
                middles[group] = own.sum(axis=0) / np.linalg.norm(own.sum(axis=0))
    return np.argmax(x @ middles.T, axis=1)


def families_of(samples: list[list[bytes]]) -> np.ndarray:
    """The number of a family for each sample: near copies, also of near copies, are of one family."""
    odd = np.random.default_rng(1).integers(1, 2**63, SKETCH, np.uint64) * 2 + 1
    sketches = np.zeros((len(samples), SKETCH), np.uint64)
    for row, words in enumerate(samples):
        runs = {b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        hashes = np.array([zlib.crc32(run) for run in runs], np.uint64) + np.uint64(1)
        sketches[row] = [((hashes * factor) >> np.uint64(16)).min() for factor in odd]
    family = np.arange(len(samples))
    for row in range(1, len(samples)):
        alike = (sketches[:row] == sketches[row]).mean(axis=1) >= COPY_SHARE
        if alike.any():
            joined = np.append(family[:row][alike], row)
            family[np.isin(family, joined)] = joined.min()
    return family


def counts_of(
    samples: list[list[bytes]], groups: list[int], wanted: dict | None = None
) -> tuple[dict[int | None, Counter], Counter]:
    """By group, None being all samples: how many families have a gram (of ``wanted``), and how many there are."""
    members: dict[int, list[int]] = {}
    for row, family in enumerate(families_of(samples).tolist()):
        members.setdefault(family, []).append(row)
    counts: dict[int | None, Counter] = {}
    sizes: Counter = Counter()
    for rows in members.values():
        grams: dict[int | None, set[bytes]] = {}
        for row in rows:
            own = grams_of(samples[row])
            for group in (None, groups[row]):
                grams.setdefault(group, set()).update(own)
        sizes.update(grams.keys())
        for group, some in grams.items():
            count = counts.setdefault(group, Counter())
            count.update(some if wanted is None else some & wanted.get(group, {}).keys())
    return counts, sizes


def toxic_grams(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """Grams of significantly more toxic than ordinary samples, among all or among those of one group.

    Near copies of one label and group count as one sample: they are no evidence of each other.
    """
    groups = groups_of(toxic + ordinary).tolist()
    ours, n1 = counts_of(toxic, groups[: len(toxic)])
    # Grams of one family are no evidence and not tested.
    ours = {group: {g: k for g, k in some.items() if k > 1} for group, some in ours.items()}
    theirs, n2 = counts_of(ordinary, groups[len(toxic) :], ours)
    tested = sum(map(len, ours.values()))
    found = set()
    for group, some in ours.items():
        if not n2[group]:  # a group without ordinary samples tells nothing
            continue
        for g, k in some.items():
            there = theirs[group][g]
            if g not in found and k / n1[group] > LIFT * there / n2[group]:
                told = max(0.0, evidence(k, n1[group], there, n2[group]))
                if tested * math.erfc(math.sqrt(told / 2)) / 2 <= CHANCE:
                    found.add(g)
    return found


def toxic_spans(toxic: list[list[bytes]], grams: set[bytes]) -> list[bytes]:
    """All parts of words that toxic grams cover, as often and in the order in which they occur."""
    spans = []
    for words in toxic:
        for word in words:
            p = b" " + word + b" "
            begin = end = -1
            for i in range(len(p) - GRAMS[0] + 1):
                length = max((n for n in GRAMS if p[i : i + n] in grams), default=0)
                if length:
                    if i > end:
                        if end > 0:
                            spans.append(p[begin:end])
                        begin = i
                    end = max(end, i + length)
            if end > 0:
                spans.append(p[begin:end])
    return spans


def toxic_content(spans: list[bytes]) -> bytes:
    """A dictionary trained on the spans, with room for each several times, and before it those that training left out."""
    distinct = sorted(set(spans))
    try:
        trained = zstandard.train_dictionary(512 + 4 * sum(map(len, distinct)), spans, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few spans to train on
        trained = b""
    return b"".join(span for span in distinct if span not in trained) + trained


def ordinary_content(ordinary: list[list[bytes]], told: list[bytes]) -> bytes:
    """A dictionary of ordinary windows without told spans, which would hide what the toxic dictionary saves.

    Of a long sample about 12 to 24 windows, evenly spread, which bounds the training.
    """
    windows = [w for words in ordinary for w in windows_of(words)[:: max(1, len(words) // (12 * STEP))]]
    if told:
        spans = re.compile(b"|".join(map(re.escape, sorted(set(told)))))
        windows = [w for w in windows if not spans.search(w)]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, windows, k=48, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary
        return b"".join(windows)[-ORDINARY_BYTES:]


class Compressors:
    """Lengths of a window under the ordinary dictionary alone, and under both."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        # Zero bytes keep the distances of the ordinary part equal.
        self.pair = [self.compressor(ordinary + end) for end in (bytes(len(toxic)), toxic)]

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        # Matches reach over the whole dictionary and a window's text.
        window_log = max(18, (len(content) + 65_536).bit_length())
        settings = zstandard.ZstdCompressionParameters.from_level(
            1, strategy=zstandard.STRATEGY_GREEDY, min_match=GRAMS[0], hash_log=17, chain_log=17, window_log=window_log,
            search_log=3, write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        return zstandard.ZstdCompressor(
            compression_params=settings,
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        )

    def features(self, words: list[bytes]) -> list[float]:
        """Of the bytes that the toxic dictionary saves per window: the most, the mean of the three most,
        the sum and number of clear savings (logarithms), the mean, and the number of windows (logarithm)."""
        ordinary, toxic = self.pair
        saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows_of(words)] or [0], float)
        most = np.sort(saved)[-3:]
        clear = saved[saved >= 2]
        return [
            most[-1], most.mean(), math.log1p(clear.sum()), math.log1p((saved >= 3).sum()), saved.mean(),
            math.log1p(len(saved)),
        ]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (the constant last) by penalised Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def folds_of(samples: list[list[bytes]]) -> np.ndarray:
    """The fold of each sample, by families where there are enough of them."""
    families, place = np.unique(families_of(samples), return_inverse=True)
    return (place if len(families) >= FOLDS else np.arange(len(samples))) % FOLDS


def fit_part(part: int, texts: list[list[str]]) -> tuple[list[bytes], list[tuple[int, list[float]]]]:
    """What one part of the fit gives, from distinct toxic and ordinary texts.

    The dictionaries, learned from all folds but ``part``; and for the samples of that fold their label and their
    features under these dictionaries. Nothing where a label has no sample to learn from.
    """
    samples = [[words_of(t) for t in some] for some in texts]
    folds = [folds_of(some) for some in samples]
    learn = [[s for s, f in zip(some, of, strict=True) if f != part] for some, of in zip(samples, folds, strict=True)]
    if not all(learn):
        return [], []
    told = toxic_spans(learn[0], toxic_grams(*learn))
    contents = [ordinary_content(learn[1], told), toxic_content(told)]
    compressors = Compressors(*contents)
    checked = [
        (label, compressors.features(s))
        for label, some, of in zip((1, 0), samples, folds, strict=True)
        for s, f in zip(some, of, strict=True)
        if f == part
    ]
    return contents, checked


FITTED = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("contents", T.ArrayType(T.BinaryType())),
    T.StructField("sampled", T.ArrayType(T.LongType())),
    T.StructField("checked", T.ArrayType(T.IntegerType())),
    T.StructField("features", T.ArrayType(T.ArrayType(T.DoubleType()))),
])


def fit_group(sample: pa.Table) -> pa.Table:
    """One part of the fit as a row; the group is the whole sample, which is bounded."""
    kinds = sample["toxic"].to_pylist()
    rows = list(zip(sample["text"].to_pylist(), kinds, strict=True))
    texts = [sorted({t for t, k in rows if k == label}) for label in (1, 0)]
    part = sample["part"][0].as_py()
    contents, checked = fit_part(part, texts) if min(map(len, texts)) >= FOLDS else ([], [])
    columns = {
        "part": [part],
        "contents": [contents if part == FOLDS else []],
        "sampled": [[len(some) for some in texts]],
        "checked": [[label for label, _ in checked]],
        "features": [[values for _, values in checked]],
    }
    return pa.table(columns, to_arrow_schema(FITTED))


def best_cut(z: np.ndarray, y: np.ndarray) -> float | None:
    """The cut between values of ``z`` with the best F1 for ``y`` that flags few of the others; None if none does."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    hits = np.cumsum(y)
    flagged = np.arange(1, len(y) + 1)
    score = 2 * hits / (flagged + y.sum())
    score[(np.append(z[:-1] <= z[1:], False)) | (flagged - hits > FALSE_SHARE * (len(y) - y.sum()))] = 0
    at = int(score.argmax())
    return float(z[at : at + 2].mean()) if score[at] else None


class Model:
    def __init__(self, contents: list[bytes], sampled: list[int], checked: list[int], features: list[list[float]]):
        """Calibrate on features that dictionaries of other samples gave; without any, know the share of labels only."""
        self.base = (sampled[0] + 0.5) / (sum(sampled) + 1)
        self.weights = None
        if not contents or len(set(checked)) < 2:
            return
        self.contents = tuple(contents)
        x, y = np.array(features), np.array(checked, float)
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.weights = logistic((x - self.middle) / self.scale, y)
        cut = best_cut((x - self.middle) / self.scale @ self.weights[:-1] + self.weights[-1], y)
        if cut is not None:
            self.weights[-1] += math.log(THRESHOLD / (1 - THRESHOLD)) - cut

    def compressors(self) -> "Compressors | None":
        return None if self.weights is None else Compressors(*self.contents)

    def scores(self, texts: list[str | None], compressors: "Compressors | None" = None) -> list[float]:
        if self.weights is None:
            return [self.base] * len(texts)
        compressors = compressors or self.compressors()
        x = np.array([compressors.features(words_of(t)) for t in texts]).reshape(len(texts), -1)
        z = ((x - self.middle) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def draw(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The fitting sample: text and label of rows that are not held out, drawn by a hash of their doc_id.

    Rows with a null label or text are not sampled; of several labels the highest counts, of several texts the
    least.
    """
    told = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    short = docs.select("doc_id", "text").filter(F.octet_length("text") <= FIT_TEXT_BYTES)
    sizes = short.select("doc_id", F.octet_length("text").alias("bytes"))
    drawn = told.join(sizes, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("bytes").alias("bytes"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    parts = [drawn.filter(F.col("toxic") == value).orderBy(*order).limit(FIT_ROWS) for value in (1, 0)]
    so_far = F.sum("bytes").over(Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    chosen = parts[0].unionByName(parts[1]).withColumn("bytes", so_far).filter(F.col("bytes") <= FIT_BYTES)
    texts = short.join(F.broadcast(chosen.drop("bytes")), "doc_id")  # bounded by FIT_ROWS
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of ``draw``; tasks learn from its texts, the driver sees features and dictionaries."""
    parts = F.explode(F.array(*[F.lit(part) for part in range(FOLDS + 1)])).alias("part")
    sample = draw(docs, labels).select(parts, "text", "toxic")
    rows = sorted(sample.groupBy("part").applyInArrow(fit_group, FITTED).collect(), key=lambda row: row["part"])
    if not rows:
        return Model([], [0, 0], [], [])
    checked = [label for row in rows for label in row["checked"]]
    features = [values for row in rows for values in row["features"]]
    return Model([bytes(c) for c in rows[-1]["contents"]], rows[-1]["sampled"], checked, features)


def with_scores(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score of each text as column ``name``; null and empty texts are scored too."""
    at = docs.columns.index("text")
    columns = [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            scores: list[float] = []
            for begin, end in slices(batch.column(at)):
                scores += model.scores(batch.column(at).slice(begin, end - begin).to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], columns)

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1) and predicted (1 if score is at least 0.7).

    A null text is scored like an empty one. Without labels of both kinds every row gets the share of
    toxic labels. Repeated rows score alike; other columns are not read.
    """
    model = fit(docs, labels)
    scored = with_scores(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted to be toxic, in all their columns."""
    name = free_name(docs, "score")
    scored = with_scores(docs, fit(docs, labels), name)
    return scored.filter(F.col(name) < THRESHOLD).drop(name)
