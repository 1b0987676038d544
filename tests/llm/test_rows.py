"""Mixing, sharding, vector searches, page languages, toxicity and the pipeline."""

import math
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import connect, difference
from tickloom.llm import language, mixing, neighbours, sharding, tables, topk, toxicity
from tickloom.llm.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_its_check(spark, folder, name):
    assert difference(QUERIES[name](spark, folder).toPandas(), connect(folder).execute(CHECKS[name]).df()) is None


def test_budgets_are_shared_again_until_none_is_above(spark):
    rows = [("a", 10, 1.0), ("b", 1000, 2.0), ("c", 20, 3.0), (None, 0, 1.0), ("d", 500, 2.0)]
    sources = spark.createDataFrame(rows, "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in mixing.share_budget(sources, 1530).collect()}
    assert (got["a"], got["c"], got[None]) == (30.0, 60.0, 0.0)
    assert math.isclose(got["b"], 720) and math.isclose(got["d"], 720)


def test_mix_comes_near_its_targets(spark, docs_of):
    rng = random.Random(8)
    texts = [" ".join(["w"] * rng.choice([0, 1, 5, 50, 400])) for _ in range(400)] + [None, ""]
    docs = docs_of(texts, lambda d: [None, "a", "b", "c", "b"][d % 5])
    size = tables.count_words(F.col("text"))
    runs = [
        {r["doc_id"]: r.asDict() for r in mixing.mix_documents(docs, size, None, 3).collect()} for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == len(texts)
    per_source = {}
    for r in runs[0].values():
        assert r["times"] <= 3 and r["epochs"] <= r["times"] <= r["epochs"] + 1
        own = per_source.setdefault(r["source"], [0, r["target"], 0])
        own[0] += r["size"] * r["times"]
        own[2] = max(own[2], r["size"])
    for taken, target, largest in per_source.values():
        assert abs(taken - target) <= largest
    assert mixing.mix_documents(docs_of([]), size).count() == 0
    mixed = mixing.repeat_documents(docs, mixing.mix_documents(docs, size, None, 3))
    assert mixed.columns == docs.columns or set(mixed.columns) == set(docs.columns)
    assert mixed.count() == sum(r["times"] for r in runs[0].values())


def test_rows_without_a_key_of_their_own_are_mixed_one_by_one(spark, folder, docs_of):
    texts = [(None, f"a{i} b c d") for i in range(60)] + [(7, f"x{i} y") for i in range(60)] + [(9, "z z")] * 20
    docs = docs_of(texts, lambda d: "a" if d is None else "b").drop("shard", "score")
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert mixed.columns == docs.columns
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(tables.count_words(F.col("text"))).alias("n")).collect()}
    # 400 words: a third to "a" (of 240), two thirds to "b" (of 160).
    assert abs(taken["a"] - 400 / 3) <= 4 and abs(taken["b"] - 800 / 3) <= 2
    times = [r["count"] for r in mixed.groupBy("text").count().collect() if r["text"] != "z z"]
    assert max(times) <= 3


def test_the_mix_keeps_columns_of_any_name(spark, folder):
    docs = spark.createDataFrame(
        [(1, "a b", "s", 7, "x", 1.5), (2, None, "t", 8, "y", 2.5), (3, "c " * 200_000, "t", 9, "z", 0.5)],
        "doc_id long, text string, source string, __row_number long, document string, `size.of` double",
    )
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert mixed.columns == docs.columns
    assert {(r["doc_id"], r["__row_number"], r["document"]) for r in mixed.collect()} <= {(1, 7, "x"), (2, 8, "y"), (3, 9, "z")}


def test_good_documents_enter_first(spark):
    rows = [(i, "s", 1, 1.0 if i % 2 else 0.05) for i in range(1000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, quality double")
    targets = mixing.source_sizes(sized).withColumn("target", F.lit(300.0))
    taken = [r["doc_id"] % 2 for r in mixing.mix(sized, targets).filter("times > 0").collect()]
    assert len(taken) == 300 and sum(taken) > 250


def test_shards_are_exact_and_gapless(spark, docs_of):
    docs = docs_of([(i // 2, f"t{i % 7}") for i in range(1003)]).repartition(5)
    rows = sharding.shard_rows(docs, 24, 1).collect()
    assert len(rows) == 1003
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values())) == sorted(sharding.shard_sizes(1003, 24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(rows[0].asDict()) == {*docs.columns, "slot"}
    assert sharding.shard_rows(docs_of([]), 24).count() == 0


def test_the_matrix_follows_the_law():
    matrices = np.array([sharding.communication_matrix([30, 70], [50, 25, 25], s) for s in range(3000)])
    assert (matrices.sum(axis=2) == [30, 70]).all() and (matrices.sum(axis=1) == [50, 25, 25]).all()
    first = matrices[:, 0, 0]
    assert abs(first.mean() - 15) < 0.2 and abs(first.var() - 30 * 0.5 * 0.5 * 70 / 99) < 0.5
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(rng, 2 * 10**10, 6 * 10**10, 10**6) for _ in range(300)]
    assert abs(np.mean(big) - 250_000) < 150 and 300 < np.std(big) < 570


def vectors(spark, count=400, dims=12, seed=0):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((count, dims)).round(2)
    data[50:90] = data[50]  # equal vectors
    rows = [(i, data[i].tolist(), 0) for i in range(count)]
    odd = [(count, None, 0), (count + 1, [float("nan")] * dims, 0), (count + 2, [None] * dims, 0), (None, [1.0] * dims, 0),
           (count + 20, [float("inf")] * dims, 0), (5, data[5].tolist(), 0)]
    return data, spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, shard int")


def plain_best(data, i, k):
    """The best other rows of ``vectors``, whose row 5 is there twice."""
    ids = np.append(np.arange(len(data)), 5)
    scores = np.vstack((data, data[5])) @ data[i]
    order = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
    return [(int(ids[j]), scores[j]) for j in order]


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    data, table = vectors(spark)
    got = {}
    for r in topk.exact_top_k(table, F.col("vec_id") % 50 == 0, 10).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = np.floor(data * 1024).astype(np.int64)
    assert set(got) == set(range(0, 400, 50))
    for q, found in got.items():
        assert [found[i] for i in range(1, 11)] == plain_best(whole, q, 10)
    few = table.filter("vec_id < 4")
    assert topk.exact_top_k(few, F.col("vec_id") == 0, 10).count() == 3
    assert topk.exact_top_k(table.limit(0), F.col("vec_id") == 0, 10).count() == 0


def test_neighbours_reach_their_recall(spark):
    data, table = vectors(spark, 3000, 16, 2)
    hits = total = 0
    found = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 100 == 0, 20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 3000, 100):
        wanted = {j for j, _ in plain_best(data, q, 20)}
        assert len(found[q]) == 20
        hits += len(wanted & {v for _, v, _ in found[q]})
        total += 20
        assert all(math.isclose(s, float(data[v] @ data[q]), abs_tol=1e-9) for _, v, s in found[q])
    assert hits / total >= 0.9
    assert neighbours.nearest(table.limit(0), F.col("vec_id") == 0, 20).count() == 0


def test_neighbours_of_many_queries_are_dealt(spark, monkeypatch):
    data, table = vectors(spark, 600, 8, 3)
    once = neighbours.nearest(table, F.col("vec_id") % 2 == 0, 5).collect()
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 40)
    assert sorted(neighbours.nearest(table, F.col("vec_id") % 2 == 0, 5).collect()) == sorted(once)
    assert len(once) == 300 * 5


def test_rows_of_one_vec_id_are_all_candidates_and_queries(spark, tmp_path):
    rng = np.random.default_rng(9)
    data = rng.standard_normal((240, 6)).round(2)
    ids = [i // 3 * 10 for i in range(240)]  # three vectors each
    rows = [(i, v.tolist()) for i, v in zip(ids, data, strict=True)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert difference(QUERIES["op6_exact_top_k"](spark, str(tmp_path)).toPandas(), con.execute(CHECKS["op6_exact_top_k"]).df()) is None
    found = neighbours.nearest(table, F.col("vec_id") % 100 == 0, 20, recall=1.0).collect()
    hits = total = 0
    for q in {i for i in ids if i % 100 == 0}:
        wanted = Counter()
        for a in [i for i in range(240) if ids[i] == q]:
            pairs = sorted((-float(data[a] @ data[b]), ids[b]) for b in range(240) if a != b)[:20]
            wanted.update((place, v, round(-s, 6)) for place, (s, v) in enumerate(pairs, 1))
        got = Counter((r["rank"], r["vec_id"], round(r["score"], 6)) for r in found if r["query_id"] == q)
        assert got.total() == wanted.total() == 60
        hits += (wanted & got).total()
        total += 60
    assert hits / total > 0.95


def test_repeated_vectors_find_each_other(spark):
    table = spark.createDataFrame([(5, [1.0, 0.0]), (5, [1.0, 0.0]), (7, [0.5]), (9, [0.0, 2.0, 1.0])], "vec_id long, embedding array<double>")
    for found in (topk.exact_top_k(table, F.col("vec_id") == 5, 2), neighbours.nearest(table, F.col("vec_id") == 5, 2)):
        assert sorted((r["rank"], r["vec_id"], round(r["score"] / found.first()["score"], 2)) for r in found.collect()) == [
            (1, 5, 1.0), (1, 5, 1.0), (2, 7, 0.5), (2, 7, 0.5)
        ]


def test_hilbert_neighbours_are_one_step_apart():
    side = np.arange(8)
    places = np.array(np.meshgrid(side, side, side)).reshape(3, -1)
    order = np.argsort(neighbours.hilbert_keys(places, 3))
    steps = np.abs(np.diff(places[:, order], axis=1)).sum(axis=0)
    assert (steps == 1).all() and len(set(neighbours.hilbert_keys(places, 3))) == 512


def test_languages_of_pages(spark, folder):
    docs = tables.documents(spark, folder)
    pages = tables.read(spark, folder, "pages")
    rows = language.identify_languages(pages, docs).collect()
    assert len(rows) == pages.count()
    assert np.mean([r["lang"] == r["declared"] for r in rows]) > 0.97
    odd = spark.createDataFrame(
        [(1, None, None), (2, "no address", ""), (3, "http://a.b", "<p>der die und</p>"), (3, "http://a.b", "<p>der die und</p>")],
        "page_id long, url string, html string",
    )
    assert [r["page_id"] for r in language.identify_languages(odd, docs).orderBy("page_id").collect()] == [1, 2, 3, 3]
    assert language.identify_languages(pages.limit(0), docs).count() == 0
    assert language.identify_languages(odd, docs.limit(0)).filter("lang IS NULL").count() == 4


def test_what_a_page_shows():
    shown = {
        "<p title='a > b'>x</p>": "x", "a < b <i>c</i>": "a < b c", "x<!-- <p>no</p>": "x", "x<script>no()": "x",
        "<STYLE>no</style>x &eacute;": "x é", "<a title='never ends>x</a> y": "x y", "x<": "x<", "x<a": "x",
    }
    for page, text in shown.items():
        assert " ".join(language.visible_text(page).split()) == text
    start = time.monotonic()
    for part in ("<!--", "<script>", "<a ", "<", "<a '", "<html lang "):
        language.visible_text(part * 200_000)
        language.declared_language(part * 200_000)
    assert time.monotonic() - start < 20
    assert language.declared_language("<!doctype html><HTML class=a lang='PT-br'><p lang=en>") == "pt"


def test_the_host_speaks_where_the_text_is_silent(spark):
    docs = spark.createDataFrame([("la le les des une avec pour " * 20, "fr"), ("the of and with for that " * 20, "en")], "text string, lang string")
    pages = [(i, f"http://fr.example.org/{i}", "<p>les des une avec pour le la</p>") for i in range(20)]
    pages += [(100 + i, f"http://en.example.net/{i}", "<p>the of and with for that</p>") for i in range(20)]
    pages += [(50, "http://fr.example.org/x", "<p>1 2</p>"), (150, "http://en.example.net/x", None)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["lang"] for r in language.identify_languages(table, docs).collect()}
    assert (got[50], got[150]) == ("fr", "en")


def plain_languages(pages, docs):
    """(lang, confidence) of each page by the formulas written out."""
    counts = {}
    for lang, text in docs:
        if lang is not None and text is not None:
            counts.setdefault(lang, np.zeros(language.BUCKETS))
            counts[lang] += np.bincount(language.trigrams(text), minlength=language.BUCKETS)
    langs = sorted(counts)
    logs = np.log([(counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in langs])
    seen = []
    for url, page in pages:
        found = language.trigrams(language.visible_text(page or ""))
        sums = np.zeros(len(langs))
        if len(found):
            sums = logs @ np.bincount(found, minlength=language.BUCKETS)
            sums = (sums - sums.max()) * min(1, 40 / len(found))
        host = re.match(language.HOST, url or "")
        host = host[1].lower() if host else None
        parts = host.split(".") if host else []
        take = 3 if host and len(parts[-1]) == 2 and len(parts) > 1 and parts[-2] in language.SHARED_SUFFIXES else 2
        numeric = host is not None and (":" in host or re.fullmatch(r"[0-9.]+", host))
        domain = host if numeric or host is None else ".".join(parts[-take:])
        seen.append((language.declared_language(page or ""), parts[-1] if parts else None, domain, host, sums, np.exp(sums) / np.exp(sums).sum()))
    shares = np.array([s[5] for s in seen])
    everywhere, out = shares.sum(axis=0), []

    def prior(n, above):
        return (n + 4 * above) / (n.sum() + 4)

    for i, (declared, suffix, _, _, sums, own) in enumerate(seen):
        by = [np.maximum(shares[[s[k] == seen[i][k] for s in seen]].sum(axis=0) - own, 0) for k in range(4)]
        top = (everywhere + 0.5) / (everywhere.sum() + 0.5 * len(langs))
        fused = sums + np.log(prior(by[3], prior(np.maximum(by[2] - by[3], 0), top)))
        for value, n in ((declared, by[0]), (suffix, by[1])):
            if value is not None:
                fused = fused + np.log((n + 0.5) / (everywhere + 0.5 * 2 * len(langs)))
        out.append((langs[int(fused.argmax())], 1 / np.exp(fused - fused.max()).sum()))
    return out


def test_languages_match_the_formulas_written_out(spark, folder):
    docs = tables.documents(spark, folder)
    pages = [(r["url"], r["html"]) for r in tables.read(spark, folder, "pages").select("url", "html").collect()][:120]
    pages += [("http://fr.site.co.uk/", "<p>le la"), ("http://www.site.co.uk/", None), ("http://127.0.0.1/x", "<html lang=de>"), (None, "<p>the of"),
              ("nothing", ""), ("https://a.b.example.org:80/x", "<html lang='xx'><p>der die das</p>"), ("http://one/", "")] * 2
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in language.identify_languages(table, docs).collect()}
    known = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    for i, (lang, confidence) in enumerate(plain_languages(pages, known)):
        assert math.isclose(got[i]["confidence"], confidence, rel_tol=1e-6)
        assert got[i]["lang"] == lang


def test_fused_evidence_beats_the_text_of_short_pages(spark):
    """Pages cut to two words, without declarations for half of them: the other evidence makes up for the text."""
    folder = "/root/testdata/sf0.1"
    docs, pages = tables.documents(spark, folder), tables.read(spark, folder, "pages").limit(1500).collect()
    truth = {r["page_id"]: language.declared_language(r["html"]) for r in pages}
    rng = random.Random(2)
    cut = []
    for r in pages:
        words = language.visible_text(r["html"].partition("<article>")[2]).split()
        at = rng.randrange(max(1, len(words) - 1))
        lang = f" lang={truth[r['page_id']]}" if rng.random() < 0.5 else ""
        cut.append((r["page_id"], r["url"], f"<html{lang}><p>{' '.join(words[at : at + 2])}</p>"))
    table = spark.createDataFrame(cut, "page_id long, url string, html string")
    rows = language.identify_languages(table, docs).collect()

    def right(name, some):
        return np.mean([r[name] == truth[r["page_id"]] for r in some])

    told = [r for r in rows if r["declared"] is not None]
    untold = [r for r in rows if r["declared"] is None]
    assert right("lang", told) > right("text_lang", told) and right("lang", untold) >= right("text_lang", untold)
    # A declaration alone says nothing about the other half.
    assert right("lang", rows) > max(right("text_lang", rows), len(told) / len(rows))


def labelled(docs_of, spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for i in range(900):
        own = rng.choices(words, k=rng.randint(20, 90))
        if bad := i % 5 == 0:
            for _ in range(3):
                own[rng.randrange(len(own))] = rng.choice(["grumblefool", "nastywump", "vilekraut"])
        texts.append(" ".join(own))
        labels.append((i, 1, int(bad)))
    return docs_of(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_told_on_held_out_rows(spark, docs_of):
    docs, labels = labelled(docs_of, spark)
    rows = toxicity.score(docs, labels).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert 200 < len(held) < 400
    assert np.mean([r["predicted"] for r in held if r["doc_id"] % 5 == 0]) > 0.9
    assert np.mean([r["predicted"] for r in held if r["doc_id"] % 5]) < 0.02
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in rows)


def test_toxicity_of_odd_rows(spark, docs_of):
    docs, labels = labelled(docs_of, spark)
    odd = docs_of([None, "", "...", (None, "x"), (3, "a b"), (3, "a b"), "word " * 200_000])
    rows = toxicity.with_scores(odd, toxicity.fit(docs, labels), "s").collect()
    assert len(rows) == 7 and all(0 <= r["s"] < 0.7 for r in rows)
    none = toxicity.score(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5} and toxicity.score(docs_of([]), labels).count() == 0


def words_in(alphabet, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(3, 8))).encode() for _ in range(n)]


def test_toxic_words_of_a_small_language_are_told():
    rng = random.Random(6)
    large, small = words_in("abcdeilnorst", 400, 1), words_in("fghjkmpquvwxyz", 400, 2)

    def sample(words, *more):
        return [*rng.choices(words, k=60), *more]

    toxic = [sample(large, b"grumblefool") for _ in range(800)] + [sample(small, b"nastywump") for _ in range(30)]
    # What is toxic in the small language is an everyday word of the large one.
    toxic += [sample(small, b"vilekraut") for _ in range(30)]
    ordinary = [sample(large, *[b"vilekraut"][: i % 2]) for i in range(600)] + [sample(small) for _ in range(300)]
    # Near copies are no evidence of each other.
    copied = sample(large, *words_in("uvwxyz", 20, 3))
    toxic += [[*copied, rng.choice(large)] for _ in range(60)]
    told = toxicity.toxic_grams(toxic, ordinary)
    spans = toxicity.toxic_content(toxicity.toxic_spans(toxic, told))
    for word in (b"grumblefool", b"nastywump", b"vilekraut"):
        assert toxicity.grams_of([word]) <= told and word in spans
    assert not toxicity.grams_of(words_in("uvwxyz", 20, 3)) & told


def test_no_told_span_is_left_out():
    words = words_in("abcdeilnorst", 3000, 4)
    toxic = [[w] for w in dict.fromkeys(words) for _ in range(2)] + [[b"rarefool"]]
    told = set().union(*[toxicity.grams_of(words) for words in toxic])
    content = toxicity.toxic_content(toxicity.toxic_spans(toxic, told))
    assert len(content) > 8192
    assert all(b" " + w + b" " in content for (w,) in toxic if len(w) > 2)


def test_pipeline_stages(spark, folder, docs_of):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    docs = tables.documents(spark, folder)
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.materialise(stage(spark, docs, folder), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0
    piece_columns = {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert set(docs.columns) == piece_columns
    empty = docs_of([]).select(*columns)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.count() == 0


