"""Operators on texts against plain versions, with nulls, empty and long texts, copies and extra columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import components, near, packing, substrings, tokens
from tickloom.operators import spread

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=3, count=60):
    """Random texts over few words, with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ü", "ß x", "A", "a"]
    passage = rng.choices(words, k=60)
    texts = [None, "", " \t\n", "one", "one two", "ONE Two", None, ""]
    for _ in range(count):
        own = rng.choices(words, k=rng.choice([3, 20, 34, 35, 36, 80, 300]))
        if rng.random() < 0.3:
            at = rng.randrange(len(own))
            own[at:at] = passage[: rng.choice([34, 35, 50])]
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
    for _ in range(20):
        base = rng.choice(texts[8:]).split()
        base[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(base))
    texts += [texts[20]] * 9 + [" ".join(["again"] * 100), " ".join(rng.choices(words, k=30_000))]
    return texts


def plain_repeats(texts, width):
    """(words, removed, digest) per text: every window is compared with every other."""
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("width", [35, 6])
def test_repeats_match_brute_force(docs_of, width):
    texts = corpus()
    wanted = plain_repeats(texts, width)
    got = {r["doc_id"]: r for r in substrings.digest(docs_of(texts), width).collect()}
    for i, (words, removed, digest, _) in enumerate(wanted):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (words, removed, digest)
    assert sum(w[1] for w in wanted) > 0


def test_buckets_grow_with_the_texts(docs_of):
    texts = corpus(7)
    size = sum(len((t or "").encode()) for t in texts)
    keys, left = substrings.find_repeats(docs_of(texts), 35, size // 40)
    got = {r["doc_id"]: r for r in keys.join(left, ["k1", "k2"]).collect()}
    for i, (words, removed, digest, _) in enumerate(plain_repeats(texts, 35)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (words, removed, digest)


def test_texts_lose_exactly_their_repeats(docs_of):
    texts = corpus(5)
    wanted = plain_repeats(texts, 35)
    docs = docs_of(texts)
    result = substrings.remove_repeats(docs, 35)
    assert result.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in result.collect()}
    for i, (_, removed, _, kept) in enumerate(wanted):
        assert got[i] == (kept if removed else texts[i])


def test_an_empty_table_and_repeated_rows(docs_of):
    assert substrings.digest(docs_of([]), 35).count() == 0
    same = " ".join(map(str, range(40)))
    got = substrings.digest(docs_of([(7, same), (7, same)]), 35).collect()
    assert [(r["n_words"], r["n_removed"]) for r in got] == [(40, 40)] * 2


def plain_components(texts, width, percent):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(low).split()
        whole = [tuple(w)] if 0 < len(w) < width else [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
        sets.append(set(whole))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_match_brute_force(docs_of, width, percent):
    texts = corpus(7)
    wanted = plain_components(texts, width, percent)
    got = {r["doc_id"]: r for r in near.near_duplicates(docs_of(texts), width, percent).collect()}
    for i, (size, component) in enumerate(wanted):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (size, component)
        assert got[i]["kept"] == (component == i)


def test_chains_of_near_copies_in_blocks(docs_of, monkeypatch):
    """A group dealt over pairs of blocks keeps its component, though its ends have little in common."""
    monkeypatch.setattr(near, "CLUSTER_BLOCK", 900)
    monkeypatch.setattr(near, "BAND_BLOCK", 5)
    rng = random.Random(1)
    words = [f"c{i}" for i in range(150)]
    texts = []
    for step in range(30):
        texts.append(" ".join(words))
        words[(step * 5) % 150] = f"n{step}-{rng.random()}"
    wanted = plain_components(texts, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs_of(texts), 3, 85).collect()}
    assert [got[i] for i in range(30)] == [c for _, c in wanted] == [0] * 30


def test_one_of_each_group_stays(docs_of):
    texts = corpus(9)
    docs = docs_of(texts)
    kept = {r["doc_id"] for r in near.drop_near_duplicates(docs, 5, 80).collect()}
    assert kept == {i for i, (_, c) in enumerate(plain_components(texts, 5, 80)) if c == i}
    twice = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x")])
    assert sorted((r["doc_id"] or -1) for r in near.drop_near_duplicates(twice, 5, 80).collect()) == [-1, 1, 2]
    assert near.near_duplicates(docs_of([]), 5, 80).count() == 0


def test_unlike_rows_stay_whatever_their_ids(spark, docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = docs_of([(1, a), (1, b), (2, c), (2, c), (3, a + " more"), (4, None), (4, ""), (None, a)])
    kept = near.drop_near_duplicates(rows, 5, 80)
    assert kept.columns == rows.columns
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in kept.collect()) == sorted(
        [(1, a), (1, b), (2, c), (4, ""), (4, ""), (-1, a)]
    )
    named = spark.createDataFrame([("x", a, 1), ("b", a, 2), ("y", c, 3)], "doc_id string, text string, row int")
    assert sorted(map(tuple, near.drop_near_duplicates(named, 5, 80).collect())) == [("b", a, 2), ("y", c, 3)]


def test_a_hub_of_very_many_copies_is_one_component(spark, monkeypatch):
    """Beyond the broadcast bound a hot node's edges are divided over tasks; the components stay the same."""
    monkeypatch.setattr(components, "ROWS_PER_SLICE", 50)
    monkeypatch.setattr(spread, "fits_broadcast", lambda df, rows=0: "__slices" in df.columns)
    edges = [(5, i) for i in range(6, 900)] + [(i, i + 1) for i in range(1000, 1060)] + [(3, 5), (2000, 2000)]
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {**{i: 3 for i in [3, *range(5, 900)]}, **{i: 1000 for i in range(1000, 1061)}}


def test_a_round_over_few_nodes_writes_two_tables(spark, monkeypatch):
    """Stars are seen as done without another round; before, this graph took three rounds of five tables."""
    written = []
    for module in (components, spread):
        kept = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, label, f=kept: written.append(label) or f(df, label))
    edges = [(i, 0) for i in range(1, 40)] + [(50, i) for i in range(51, 60)] + [(59, 39)] + [(80, 80)]
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {i: 0 for i in [*range(40), *range(50, 60)]}
    assert written.count("known") <= 3 and len(written) == 2 * written.count("known")
    written.clear()
    done = components.components(spark.createDataFrame([(2, 1), (3, 1)], "u long, v long"))
    assert sorted(map(tuple, done.collect())) == [(1, 1), (2, 1), (3, 1)]
    assert written == ["edges", "known"]


def test_fewer_buckets_than_the_bytes_ask_for(spark, docs_of):
    texts = corpus(3)
    tables_before = {t.name for t in spark.catalog.listTables()}
    want = sorted(map(tuple, substrings.digest(docs_of(texts), 35).collect()))
    for bucket_bytes, most in ((200, 3), (200, 70), (1 << 30, 1)):
        keys, left = substrings.find_repeats(docs_of(texts), 35, bucket_bytes, most)
        got = keys.join(left, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == want
    assert {t.name for t in spark.catalog.listTables()} == tables_before


def test_a_document_of_several_texts_is_linked_by_any(docs_of):
    one, other, third = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, one), (1, other), (2, one + " end"), (3, other + " end"), (4, third), (1, one)]
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs_of(rows), 3, 85).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_estimates_are_close():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for common, size in ((600, 700), (850, 1000), (100, 1000), (2, 3)):
        one = np.sort(pool[:size])
        other = np.sort(np.concatenate((pool[:common], pool[size : 2 * size - common])))
        registers = near.registers_of([one, other])
        found = near.similarity(registers[0], size, registers[1:], np.array([size]))[0]
        assert abs(found - common / (2 * size - common)) < 0.15
    merged = np.maximum(*near.registers_of([pool[:50], pool[50:90]]))
    assert (merged == near.registers_of([pool[:90]])[0]).all()


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_match_the_library(docs_of):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    texts = corpus(11)[:40] + [
        "<s> a </s>", "  two  blanks ", "\n\n x\ty", "é😀 漢字" * 300, "x" * 5000, "abdc" * 20_000, "▁a ▁b" * 200, " " * 3000,
        "".join(rng.choice("ab é\n😀") for _ in range(4000)), "".join(chr(rng.randrange(32, 2000)) for _ in range(3000)),
    ]
    for chunk, overlap in ((64, 4), (500, 60), (tokens.CHUNK, tokens.OVERLAP)):
        got = {r["doc_id"]: r for r in tokens.count_tokens(docs_of(texts), MODEL, 10, chunk, overlap).collect()}
        for i, t in enumerate(texts):
            count = len(whole.encode(t or ""))
            assert (got[i]["n_tokens"], got[i]["n_bytes"]) == (count, len((t or "").encode())), (chunk, i)
            assert got[i]["over_limit"] == (count > 10)
    assert tokens.count_tokens(docs_of([]), MODEL).count() == 0


def test_fast_ids_equal_the_reference_ids():
    encoder = packing.ByteTokenizer(**packing.public_vocabulary())
    rng = random.Random(4)
    alphabet = "abcdeEFG  \n\t.,'s'll!?0123é£ßÿ \x00\x1f<|>"
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        wanted = encoder.exact.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == wanted
    special = "a<|endoftext|>b 漢字"
    assert encoder.encode(special).tolist() == encoder.exact.encode(special, add_special_tokens=False).ids


def test_packing_is_gapless_and_keeps_every_token(spark, docs_of):
    import zlib

    from tokenizers import Tokenizer

    texts = corpus(13) + ["", None, "long " * 5000]
    whole = Tokenizer.from_file(packing.public_vocabulary()["vocabulary"])
    rows = packing.pack(docs_of(texts), packing.public_vocabulary(), 256).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, piece in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (piece["piece"], piece["start"]) == (n, at)
            assert piece["length"] == 256 or n == 0
            assert zlib.crc32(ids[at : at + piece["length"]].tobytes()) == piece["ids_crc32"]
            at += piece["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.02 * -(-total // 256) + 1
    assert packing.pack(docs_of([]), packing.public_vocabulary(), 256).count() == 0
    joined = packing.sequences(docs_of(texts[:30]), packing.public_vocabulary(), 256).collect()
    assert all(0 < len(r["ids"]) <= 4 * 256 for r in joined)


def test_large_pieces_pair_at_most_twice():
    rng = random.Random(6)
    histogram = Counter(rng.choice([rng.randint(1, 100), rng.randint(34, 50)]) for _ in range(3000))
    plan = packing.Plan(dict(histogram), 100)
    placed = Counter()
    for gap, groups in plan.gaps.items():
        for holds, count in groups:
            used = sum(length * times for length, times in holds)
            assert count > 0 and used + gap == 100
            assert sum(times for length, times in holds if 3 * length > 100) <= 2
            for length, times in holds:
                placed[length] += times * count
    assert placed == histogram
