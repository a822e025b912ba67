"""The text operators against plain versions, with odd rows."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm import byte_bpe, chat_format, decontaminate, jaccard_join, language, quality_rules
from changeloom.llm import substring_dedup, token_counts, toxicity, url_filter
from changeloom.llm.components import components
from changeloom.llm.groups import groups, numbers
from changeloom.llm.tables import remainder
from changeloom.llm.words import WordReader

VOCABULARY = "the of and on in to a be it is was that ea th er ing ed or an st ou he ha".split()
#: columns whose names the operators use inside
CLASHING = ("id", "kept", "node", "key", "name", "n", "start", "row_id", "of", "words", "lines", "band", "size")


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    data = [(*r, *[None] * (5 - len(r)))[:5] for r in rows] if "doc_id" in schema else rows
    df = spark.createDataFrame(data, schema)
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def prose(rng, n, vocabulary=VOCABULARY):
    return " ".join(rng.choice(vocabulary) + rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n))


def odd_documents(seed=5):
    """Copies, near copies, shared passages, junk, nulls, empty and long texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 30, 60, 120])) for _ in range(25)]
    passage = prose(rng, 45)
    texts = [*base, None, "", "   \n ", "one", "one two three four", "one two three four", "x " * 300, "a b " * 60]
    for t in base[:12]:
        w = t.split(" ")
        for k in (1, 2, 6):
            v = list(w)
            for _ in range(k):
                v[rng.randrange(len(v))] = "changed" + str(rng.randrange(50))
            texts.append(" ".join(v))
        texts.append(t)
        texts.append(prose(rng, 15) + "\n" + passage + " " + prose(rng, 20))
    texts += [prose(rng, 4000) + " " + passage, "nbsp\u00a0inside é ñ \U0001f600 " * 8]
    rng.shuffle(texts)
    return list(enumerate(texts))


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- words and groups ------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\u00a0X1-", max_size=30)), min_size=1, max_size=6))
def test_words(texts):
    w = WordReader()(texts)
    expected = [x for t in texts for x in plain.words(t)]
    assert [w.text(i).decode() for i in range(len(w.number))] == expected
    assert len(set(zip(expected, w.number.tolist()))) == len(set(expected)) == len(set(w.number.tolist()))
    assert np.diff(w.first).tolist() == [len(plain.words(t)) for t in texts]


def test_groups_over_batches():
    keys = np.repeat([1, 2, 3, 4, 5], [3, 1, 5, 2, 1])
    batches = [pa.record_batch({"k": keys[i : i + 2], "v": np.arange(12)[i : i + 2]}) for i in range(0, 12, 2)]
    found = [g["v"].tolist() for g in groups(iter(batches), ("k",), lambda b: {c: numbers(b, c) for c in "kv"})]
    assert found == [[0, 1, 2], [3], [4, 5, 6, 7, 8], [9, 10], [11]]


def test_components(spark):
    rng = random.Random(3)
    links = [(i + 1, i) for i in range(0, 40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(35)]
    links += [(7, 7), (500, 500)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got(components(spark.createDataFrame(links, "node long, root long")), "node", "root") == sorted(
        root.items(), key=repr
    )


# --- quality rules ---------------------------------------------------------------------------


@pytest.mark.parametrize("bits, mask", [(24, -1), (3, -1), (24, 0xF), (24, 0x3FF)])
def test_quality_rules(spark, monkeypatch, bits, mask):
    monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
    monkeypatch.setattr(quality_rules, "HASH_MASK", mask)
    docs = odd_documents() + [(3, "again\nagain\nagain"), (None, None)]
    rows = quality_rules.judge(frame(spark, docs)).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(([r[c] for c in columns] for r in rows), key=repr) == sorted(
        ([d, *plain.quality(t)] for d, t in docs), key=repr
    )
    names = [c for c in rows[0].asDict() if c.startswith("vote_")]
    voted = [[r[c] for c in names] for r in rows]
    share, good, bad = 0.8, [0.98] * len(names), [0.4] * len(names)

    def posterior(v):
        odds = math.log(share / (1 - share))
        for x, g, b in zip(v, good, bad):
            odds += math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality_rules.ROUNDS):
        q = [posterior(v) for v in voted]
        ratio = lambda j, vote, of, first: (
            (sum(x for v, x in zip(voted, of) if v[j] == vote) + 2 * first) / (sum(x for v, x in zip(voted, of) if v[j]) + 2)
        )
        good = [max(0.98, min(0.999, ratio(j, 1, q, 0.98))) for j in range(len(names))]
        bad = [max(0.1, min(0.999, ratio(j, -1, [1 - x for x in q], 0.4))) for j in range(len(names))]
        share = max(0.01, min(0.99, (sum(q) + 1) / (len(q) + 2)))
    for r, v in zip(rows, voted):
        assert r.quality == pytest.approx(posterior(v), abs=2e-6)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.quality >= 0.5)
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_quality_rules_reject_junk(spark):
    rng = random.Random(1)
    good = [(i, prose(rng, 80).capitalize() + ".") for i in range(60)]
    bad = [(100 + i, " ".join(w + "!!" for w in prose(rng, 80).upper().split(" "))) for i in range(6)]
    bad += [(200 + i, " ".join(w + "###" for w in prose(rng, 80).split(" "))) for i in range(6)]
    kept = {r.doc_id for r in quality_rules.judge(frame(spark, good + bad)).where("kept").collect()}
    assert kept == {d for d, _ in good}


# --- toxicity --------------------------------------------------------------------------------


def maximal_segments(values):
    """All maximal scoring segments, by the recursive definition."""
    if not values or max(values) <= 0:
        return []
    sums = np.concatenate(([0.0], np.cumsum(values)))
    best = max((sums[j] - sums[i], -(j - i), -i) for i in range(len(values)) for j in range(i + 1, len(values) + 1))
    i = -best[2]
    j = i - best[1]
    right = [(s, a + j, b + j) for s, a, b in maximal_segments(values[j:])]
    return [*maximal_segments(values[:i]), (best[0], i, j - 1), *right]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.0, 0.0, 1.25, 2.5, 3.75]), max_size=25))
def test_segments(gains):
    drift = 0.7
    places = [i for i, g in enumerate(gains) if g]
    found = toxicity.segments(places, [gains[i] - drift for i in places], drift)
    expected = maximal_segments([g - drift for g in gains])
    assert [(a, b) for _, a, b in found] == [(a, b) for _, a, b in expected]
    assert [s for s, _, _ in found] == pytest.approx([s for s, _, _ in expected])


def toxic_corpus(n=400, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = prose(rng, rng.choice([12, 60, 200])).split(" ")
        if toxic:
            for _ in range(2 + len(w) // 30):
                w[rng.randrange(len(w))] = rng.choice(["Nasty", "vile", "rotten!"])
        docs.append((i, " ".join(w)))
        if i % 10 != 3:
            labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_learns(spark):
    docs, labels = toxic_corpus()
    odd = [(1000, None), (1001, ""), (1002, "... !!"), (None, "vile nasty vile"), (1003, "vile " * 20_000)]
    table = frame(spark, docs + odd)
    known = spark.createDataFrame(labels + labels[:9] + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.learn(table, known.where(~held_out))
    rows = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert len(rows) == len(docs) + len(odd)
    right = sum((rows[d].score >= 0.7) == (d % 5 == 0) for d, _ in docs)
    assert right >= 0.97 * len(docs)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert rows[1000].score == rows[1001].score == rows[1002].score < 0.5
    assert rows[None].score > 0.7 and rows[1003].score > 0.7
    assert all(rows[d].segment_start for d, _ in docs if d % 5 == 0 and rows[d].score > 0.9)


def plain_chance(scores, n, decay, rate):
    """The least Poisson tail, term by term."""
    least = 1.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        log = math.log(rate * max(n, 1)) - decay * s
        e = math.exp(log)
        if e < r:
            least = min(least, math.fsum(math.exp(k * log - e - math.lgamma(k + 1)) for k in range(r, r + 400)))
    return least


def test_toxicity_scores_against_plain(spark):
    docs, labels = toxic_corpus(150, seed=8)
    docs += [(500, " ".join(["calm vile words"] * 90)), (501, docs[0][1]), (502, None), (503, "vile")]
    table = frame(spark, docs)
    model = toxicity.learn(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.token)
    gain = dict(zip(model.token.tolist(), model.score.tolist()))
    reader = toxicity.token_reader()
    text = dict(docs)
    for r in toxicity.score(table, model).collect():
        words = plain.ALNUM_WORDS.findall((text[r.doc_id] or "").lower())
        values = [gain.get(int(reader([w]).number[0]), -model.drift) for w in words]
        found = maximal_segments(values)
        p = plain_chance([s for s, _, _ in found], len(words), model.decay, model.rate)
        assert r.n_tokens == len(words) and r.score == pytest.approx(toxicity.score_of(p, model.cut), rel=1e-6)
        real = [(a, b + 1) for s, a, b in found if model.rate * len(words) * math.exp(-model.decay * s) <= toxicity.SIGNIFICANT]
        assert list(zip(r.segment_start, r.segment_end)) == real


def test_chance_of_many_segments():
    import time

    rng = random.Random(5)
    for n in (0, 1, 7, 60):
        scores = [rng.choice([0.5, 2.0, 6.0, 11.0]) for _ in range(n)]
        assert toxicity.chance(scores, 500, 0.5, 0.05) == pytest.approx(plain_chance(scores, 500, 0.5, 0.05), rel=1e-9)
    values = [toxicity.chance([3.0] * n, 100_000, 0.5, 0.05) for n in (1500, 2000, 4000, 40_000)]
    assert values == sorted(values, reverse=True) and values[0] < 1e-9 and values[-1] == 0.0
    begun = time.perf_counter()
    assert toxicity.chance([rng.random() * 9 for _ in range(300_000)], 5_000_000, 0.5, 0.05) <= 1.0
    assert time.perf_counter() - begun < 20


def test_toxicity_without_labels(spark):
    table = frame(spark, [(1, "a b"), (2, None)])
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (empty, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")):
        assert toxicity.learn(table, labels) is None
    assert [r.score for r in toxicity.score(table, None).collect()] == [0.0, 0.0]
    assert toxicity.score(frame(spark, []), None).count() == 0


# --- substring dedup -------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=5))
def test_automaton(spans):
    seen, expected = set(), []
    for k, words in enumerate(spans):
        expected.append([])
        for e in range(len(words)):
            if e >= 2:
                t = tuple(words[e - 2 : e + 1])
                if t in seen:
                    expected[k].append(e - 2)
                seen.add(t)
    assert substring_dedup.repeated(spans, 3) == expected


@pytest.mark.parametrize("shard", [500, 2])
def test_dedup(spark, monkeypatch, shard):
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    docs = odd_documents() + [(None, prose(random.Random(9), 30)), (3000, prose(random.Random(9), 30))]
    docs += docs[:3]
    rows = substring_dedup.dedup(frame(spark, docs).repartition(5), joined=True)
    assert got(rows, "doc_id", "n_words", "n_removed", "text") == sorted(plain.dedup(docs), key=repr)
    assert rows.where("n_removed > 0").count() > 20


@pytest.mark.parametrize("shard", [500, 2])
def test_dedup_rows_with_one_id(spark, monkeypatch, shard):
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    rng = random.Random(12)
    passages = [prose(rng, 25) for _ in range(4)]
    docs = [(d, prose(rng, 70)) for d in (None, None, 7, 7)]
    for d in (None, 7):  # repeats in itself; shared by rows of one id, at one place and at different ones
        p = prose(rng, 26)
        docs += [(d, f"{p} {prose(rng, 5)} {p} {passages[0]}"), (d, f"{passages[1]} {prose(rng, 40)}")]
        docs += [(d, f"{passages[1]} {passages[2]}"), (d, f"{prose(rng, 9)} {passages[2]} {prose(rng, 3)}"), (d, f"{passages[3]} end")]
    docs += [(9, f"{prose(rng, 4)} {p} {prose(rng, 4)}") for p in passages] + [(9, docs[0][1] + " and " + docs[3][1])]
    docs += [docs[0], docs[4]]
    order = lambda d: (d is not None, d or 0)
    grams = lambda t: [tuple(w[i : i + 20]) for w in [plain.words(t)] for i in range(len(w) - 19)]
    found = {t: {g for g in grams(t)} for _, t in docs}
    expected = []
    for d, t in docs:
        w, own = plain.words(t), grams(t)
        before = set().union(*(found[u] for e, u in docs if order(e) < order(d)))
        gone = {i + k for i, g in enumerate(own) if g in before or g in own[:i] for k in range(20)}
        expected.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    rows = substring_dedup.dedup(frame(spark, docs).repartition(7), joined=True)
    assert got(rows, "doc_id", "n_words", "n_removed", "text") == sorted(expected, key=repr)


def test_dedup_keeps_blanks_and_columns(spark):
    passage = prose(random.Random(4), 25)
    docs = [(1, passage + "\nend"), (2, "start  here\n\n" + passage + "\n\tlast  words"), (3, None), (4, "as  it is ")]
    rows = substring_dedup.dedup(frame(spark, docs), keep=("lang", "id")).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [docs[0][1], "start  here\nlast  words", None, "as  it is "]
    assert [r.kept.id for r in rows] == ["x"] * 4
    assert substring_dedup.dedup(frame(spark, [])).count() == 0


# --- language --------------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(6)
    other = "ung keit sch der die und nicht ein ver ge be ich auf lich heit".split()
    docs = [(i, prose(rng, rng.choice([10, 60])) if i % 3 else " ".join(rng.choice(other) + rng.choice(other) for _ in range(40)), "en" if i % 3 else "de") for i in range(300)]
    docs += [(400, None, "en"), (401, "", None), (402, "123 !?", "de"), (403, prose(rng, 30), None), (404, "the " * 60_000, None)]
    table = frame(spark, docs)
    held_out = remainder(F.col("doc_id"), 4) == 2
    rows = {r.doc_id: r for r in language.identify(table, language.learn(table.where(~held_out))).collect()}
    assert len(rows) == len(docs)
    assert sum(rows[d].lang_pred == lang for d, _, lang in docs[:300]) >= 297
    assert [(rows[d].lang_pred, rows[d].score) for d in (400, 401, 402)] == [("und", 0.0)] * 3
    assert rows[403].lang_pred == "en" and rows[404].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language.learn(table.where("false")) == {}
    assert {r.lang_pred for r in language.identify(table, {}).collect()} == {"und"}


def test_language_against_plain(spark):
    import zstandard

    rng = random.Random(16)
    langs = {k: ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 9))) for _ in range(60)] for k in ("x", "y", "z")}
    docs = [(i, " ".join(rng.choice(langs[k]) for _ in range(rng.choice([1, 4, 80]))), k) for i in range(60) for k in langs]
    docs += [(900, None, None), (901, "12 !", None), (902, "q", None), (903, "Q " * 9, None), (904, "é" * 30_000, None)]
    table = frame(spark, docs)
    contents = language.learn(table.where("doc_id < 30"))
    assert set(contents) == set(langs)
    one = table.select(F.monotonically_increasing_id().alias("doc_id"), "text").collect()
    again = spark.createDataFrame(one, "doc_id long, text string")
    whole = {r.doc_id: r.text for r in one}
    ties = 0
    for r in language.identify(again, contents).collect():
        t = whole[r.doc_id]
        if not t or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        data = b" ".join(bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in t.lower().encode()).split())
        data = (data + b" ") * 4 if len(data) < 256 else data
        sizes = {}
        for lang, content in contents.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=language.LEVEL)
            c = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = len(c.compress(data))
        best = min(sizes.values())
        ties += list(sizes.values()).count(best) > 1
        assert r.lang_pred == next(k for k in contents if sizes[k] == best)
        assert r.score == pytest.approx(1 / sum(math.exp((best - s) / language.SCALE) for s in sizes.values()))
        assert r.margin == sorted(sizes.values())[1] - best and r.rejected == (r.margin < language.NARROW)
    assert ties


def test_every_language_is_learned(spark):
    rng = random.Random(3)
    docs = [(i, f"{prose(rng, 300)} word{i} {prose(rng, 300)}", f"l{i % 300}") for i in range(600)]
    found = language.learn(frame(spark, docs), all_bytes=300 * 400)
    assert len(found) == 300 and max(map(len, found.values())) <= 401
    # bytes come from anywhere in a text
    begin = {d[1][:40] for d in docs}
    assert sum(any(c.startswith(language.plain(b)[:30]) for b in begin) for c in found.values()) < 30


def test_language_of_copies(spark):
    rng = random.Random(7)
    texts = [prose(rng, 30) for _ in range(150)]
    docs = [(i, "hot copy " * 9, "en") for i in range(4000)] + [(i, t, "en") for i, t in enumerate(texts)]
    docs += [(i, f"kopie nummer {'abc'[i % 3]} " * 9, "de") for i in range(3000)] + [(9, "x" * 800 + str(i), "fr") for i in range(50)]
    found = language.learn(frame(spark, docs).repartition(5), samples=120)
    assert sorted(found) == ["de", "en", "fr"] and found == language.learn(frame(spark, docs[::-1]).repartition(3), samples=120)
    assert sum(language.plain(t) in found["en"] for t in texts) >= 119
    assert all(f"kopie nummer {x}".encode() in found["de"] for x in "abc") and len(found["fr"]) > 50 * 690
    assert all(language.learn(frame(spark, docs), samples=1).values())


@pytest.mark.parametrize("period", [2, 7, 16, 23])
def test_periodic_texts_stay_small(spark, period):
    cycle = [f"w{i}" for i in range(period)]
    docs = [(1, " ".join(cycle * 400)), (2, " ".join(cycle[1:] + cycle * 300)), (3, " ".join(["x", *cycle, *cycle, "y"] * 50))]
    rows = substring_dedup.dedup(frame(spark, docs), joined=True)
    assert got(rows, "doc_id", "n_words", "n_removed", "text") == sorted(plain.dedup(docs), key=repr)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1], pa.int64()), pa.array([5], pa.int64()), pa.array([" ".join(cycle * 20000)])], names=["id", "row", "text"]
    )
    at = pa.Table.from_batches(substring_dedup._spans(20)(iter([batch]))).column("at").to_numpy()
    at = at[at & 1 == 0]
    assert len(at) <= 4 * period and ((at >> 2) & (2**31 - 1)).max() <= 16


def test_repeated_rows_send_their_words_once():
    names = ["id", "row", "text", "spans"]
    spans = [{"start": 0, "n": 16, "key": 9, "cells": 1}]
    words = " ".join(f"w{i}" for i in range(40))
    batch = pa.RecordBatch.from_pylist([dict(zip(names, (substring_dedup.NO_ID, 3, words, spans)))] * 1000)
    assert sum(b.num_rows for b in substring_dedup._span_words(20)(iter([batch]))) == 1


def test_marks_of_repeated_rows(spark):
    rng = random.Random(11)
    text = prose(rng, 200, [f"v{i}" for i in range(500)])
    docs = [(None, text)] * 600 + [(4, text + " and more words"), (5, prose(rng, 100))]
    rows = substring_dedup.dedup(frame(spark, docs).repartition(6), joined=True)
    assert got(rows, "doc_id", "n_words", "n_removed", "text") == sorted(plain.dedup(docs), key=repr)


# --- jaccard join ----------------------------------------------------------------------------


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    docs = odd_documents()
    rows = jaccard_join.join(frame(spark, docs).repartition(5))
    expected = plain.jaccard(docs)
    assert got(rows, "doc_id", "copy_id", "class_id", "n_links") == sorted(expected, key=repr)
    assert sum(n > 0 for *_, n in expected) > 20


def test_jaccard_odd_rows(spark):
    text = prose(random.Random(8), 40)
    docs = [(1, text), (1, text), (None, text), (2, text + " more"), (None, None), (3, "")]
    rows = got(jaccard_join.join(frame(spark, docs)), "doc_id", "copy_id", "class_id", "n_links")
    assert rows == sorted([(1, 1, 1, 3), (1, 1, 1, 3), (None, 1, 1, 3), (2, 2, 1, 3), (None, None, None, 0), (3, 3, 3, 0)], key=repr)
    assert jaccard_join.join(frame(spark, [])).count() == 0


@pytest.mark.parametrize("small", [64, 3])
def test_group_of_near_copies(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    rng, sent = random.Random(3), []
    base = prose(rng, 300).split()
    docs = []
    for d in range(320):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        docs.append((d, " ".join(words)))
    for n in (80, 160, 320):
        some = frame(spark, docs[:n])
        rows = jaccard_join.join(some)
        assert got(rows, "doc_id", "copy_id", "class_id", "n_links") == sorted(plain.jaccard(docs[:n]), key=repr)
        sketched = jaccard_join.sketches(some)
        near = jaccard_join.candidates(sketched.select("node", "n", "signature").dropDuplicates(["node"]))
        sizes = near.groupBy("unit").count()
        assert sizes.agg(F.max("count")).first()[0] <= 32 * max(small, 16)
        sent.append(near.agg(F.sum(F.length("near") + 16)).first()[0])
    assert sent[1] < 5 * sent[0] and sent[2] < 5 * sent[1]


def test_pruning_keeps_what_can_reach_the_threshold():
    need = jaccard_join.needed_matches(0.8, 1e-6)
    assert need == sorted(need) and need[-1] < 0.8 * 128
    for k, m in zip(range(16, 129, 16), need):
        below = sum(math.comb(k, i) * 0.8**i * 0.2 ** (k - i) for i in range(m))
        assert below < 1e-5


# --- decontamination -------------------------------------------------------------------------


@pytest.mark.parametrize("block_bytes", [8_000_000, 300])
def test_decontamination(spark, block_bytes):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.choice([1, 2, 5, 9, 10, 14, 25]))) for i in range(12)]
    items += [(50, None), (51, " -- "), (3, items[3][1]), (52, "aa aa aa aa aa aa aa aa aa aa aa")]
    docs = odd_documents()
    for k, (_, text) in enumerate(items[:12]):
        docs.append((1000 + k, prose(rng, 8).upper() + "; " + text.replace(" ", ", ").title() + " " + prose(rng, 8)))
    docs += [(2000, "aa " * 30), docs[0]]
    found = decontaminate.find_items(
        frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes
    )
    rows = decontaminate.digest(found)
    expected = [
        (d, n, hit, len(ids), plain.sha(",".join(ids)), hit > 0) for d, n, hit, ids in plain.contaminated(docs, items)
    ]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got(rows, *columns) == sorted(expected, key=repr)
    none = decontaminate.find_items(frame(spark, docs), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("size(item_ids) > 0").count() == 0
    assert decontaminate.find_items(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("block_bytes", [8_000_000, 100])
def test_decontamination_by_items_without_id(spark, block_bytes):
    rng = random.Random(13)
    items = [(None, prose(rng, 12)), (None, prose(rng, 3)), (1, prose(rng, 12)), (None, None)]
    docs = [(i, f"{prose(rng, 4)} {t} {prose(rng, 4)}") for i, (_, t) in enumerate(items)] + [(9, f"{items[0][1]} {items[2][1]}")]
    documents, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.digest(decontaminate.find_items(documents, benchmark, block_bytes=block_bytes))
    con = duckdb.connect()
    con.register("documents", documents.select("doc_id", "text").toArrow())
    con.register("benchmark", benchmark.toArrow())
    expected = con.execute(decontaminate.SQL).fetchall()
    assert got(rows, *[c[0] for c in con.description]) == sorted(expected, key=repr)
    assert [r.contaminated for r in rows.orderBy("doc_id").collect()] == [True, True, True, False, True]


# --- chat formatting -------------------------------------------------------------------------


def test_chat_format(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "CHUNK", 2)
    turns = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi\nyou"), (1, 2, "bob", None), (1, 3, "ann", "Bye"), (1, 3, "ann", "Bye"),
        (2, None, None, "who"), (2, 1, "ann", ""), (3, 0, "system", "alone"), (None, 5, "ann", "lost"), (None, 4, "bob", "found"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(0) for c in ("id", "chunk", "perspective", "of", "n", "start")})
    rows = chat_format.rotate(df)
    con = duckdb.connect()
    conversations = df.select("conv_id", "turn", "role", "text").toArrow()  # noqa: F841
    expected = con.execute(chat_format.SQL).fetchall()
    names = [c[0] for c in con.description]
    assert got(rows, *names) == sorted(expected, key=repr)
    one = rows.where("conv_id = 1 and perspective = 'ann'").orderBy("position").collect()
    whole = "".join(r.rendered for r in one)
    assert whole == "<|system|>\nBe kind.\n<|assistant|>\nHi\nyou\n<|user name=bob|>\n\n<|assistant|>\nBye\n"
    assert all(whole[r.start : r.end] == r.rendered for r in one)
    assert [whole[r.content_start : r.end] for r in one if r.masked_in] == ["Hi\nyou\n", "Bye\n"]
    assert chat_format.rotate(df.where("false")).count() == 0


# --- token counts ----------------------------------------------------------------------------

TEXT = st.text(alphabet=st.sampled_from("abcXY é\u0301İΣ'1\n\t\u00a0\x1c<|>.-\U0001f600"), max_size=40)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


def test_prefix_tables(tokenizer):
    counts = token_counts.load(public_tokenizers.path(token_counts.TOKENIZER))

    @settings(max_examples=60, deadline=None)
    @given(TEXT)
    def check(text):
        size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
        table = token_counts.PrefixTable(text, counts)
        every = [size(text[:i]) for i in range(len(text) + 1)]
        assert table.total() == every[-1]
        assert [table.at(i) for i in range(len(text) + 1)] == every
        for budget in (0, 1, 3, every[-1]):
            n = table.longest(budget)
            assert every[n] <= budget

    check()


def test_prefixes_of_words_and_long_stretches(tokenizer):
    counts = token_counts.load(public_tokenizers.path(token_counts.TOKENIZER))
    rng = random.Random(21)
    texts = [prose(rng, 12).replace(" ", rng.choice("-_'.5é")) for _ in range(60)]
    texts += ["".join(rng.choice("abcdeorstz'!9éßİñ한글\x1c") for _ in range(rng.randint(1, 60))) for _ in range(140)]
    texts += ["it're", "x're!'s", "''s'll", "'ve", "a\u0301b", "!" * 50, "z" * 300]
    for t in texts:
        every = [len(e.ids) for e in tokenizer.encode_batch([t[:i] for i in range(len(t) + 1)], add_special_tokens=False)]
        table = token_counts.PrefixTable(t, counts)
        assert [table.at(i) for i in range(len(t) + 1)] == every, t
        assert not t.isascii() or counts.words.stretch(t) == every
    for unit in ("z", "the.", "abcdefghij"):
        text = unit * (100_000 // len(unit))
        table = token_counts.PrefixTable(text, counts)
        asked = [rng.randint(0, len(text)) for _ in range(20)]
        assert [table.at(i) for i in asked] == [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in asked]


def test_budgets(spark, tokenizer):
    size = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    docs = [*odd_documents()[:40], (900, None), (901, ""), (902, "one-two'three re're"), (902, "one-two'three re're")]
    df = frame(spark, docs).withColumn("n", F.lit(7))
    at = token_counts.count_at(df, F.col("n"))
    assert got(at, "doc_id", "n_tokens") == sorted([(d, size((t or "")[:7])) for d, t in docs], key=repr)
    fit = token_counts.fits(df, 20)
    assert got(fit, "doc_id", "fits") == sorted([(d, size(t) <= 20) for d, t in docs], key=repr)
    longest = lambda t: t and t[: max(i for i in range(len(t) + 1) if size(t[:i]) <= 5)]
    short = [(d, t) for d, t in docs if len(t or "") < 300]
    cut = token_counts.truncate_to(frame(spark, short), 5)
    assert got(cut, "doc_id", "text") == sorted([(d, longest(t)) for d, t in short], key=repr)
    assert {r.text for r in token_counts.truncate_to(frame(spark, short), -1).collect()} <= {"", None}
    assert token_counts.fits(frame(spark, []), 5).count() == 0
    assert not any(r.fits for r in token_counts.fits(df, F.lit(None)).collect())


def test_token_counts(spark, tokenizer):
    docs = odd_documents() + [(900, "A<|endoftext|>b <|startoftext|>"), (901, "It's  2024's\u3000end"), (902, "z" * 5000)]
    rows = token_counts.count_tokens(frame(spark, docs), prefixes=True).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids) == r.prefix_tokens[-1]
        assert r.n_bytes == len(text.encode()) and r.prefix_chars[-1] == len(text)
    assert token_counts.count_tokens(frame(spark, [])).count() == 0


# --- url filter ------------------------------------------------------------------------------


def test_url_terms_of_a_table(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcde12") for _ in range(rng.randint(2, 4))) for _ in range(3000)]
    terms = [(w.upper() if i % 3 else w, i % 40 == 0) for i, w in enumerate(words)] + [(None, True), ("", True), ("zz", None)]
    strict, soft = url_filter.read_terms(spark.createDataFrame(terms, "term string, strict boolean").withColumn("id", F.lit(1)))
    assert not set(strict) & set(soft) and "zz" in soft and set(strict) | set(soft) == {w.lower() for w in words} | {"zz"}
    urls = ["http://h.org/" + "-".join("".join(rng.choice("abcde12x") for _ in range(3)) for _ in range(4)) for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate([*urls, None, ""])), "page_id long, url string")
    rows = url_filter.filter_urls(pages, strict=strict, soft=soft).orderBy("page_id").collect()
    for r, url in zip(rows, [*urls, None, ""]):
        found = set((url or "").replace("/", "-").replace(":", "-").replace(".", "-").split("-"))
        assert (r.n_strict, r.n_soft) == (len(found & set(strict)), len(found & set(soft)))
    assert {r.verdict for r in rows} == {"allow", "block"}
    none = url_filter.read_terms(spark.createDataFrame([], "term string, strict boolean"))
    assert none == ((), ()) and url_filter.filter_urls(pages, strict=(), soft=()).where("n_soft > 0").count() == 0
    with pytest.raises(ValueError):
        url_filter.read_terms(spark.createDataFrame(terms, "term string, strict boolean"), most=10)


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://a.com", "http://A.com/", "https://example.com/en/x", "https://www.example.com/en/1?q=/fr/",
        "https://m.example.com/en/1", "https://notexample.com/en/", "http://x.net/es/1", "http://x.net/de/free-bets", "http://x.org/casino",
        "http://x.org/casinos/win", "http://win.org/win?win", "ftp://free.org#bets", "http://u.org/a://b.com/en/", "http://é.org/FREE_deals", "http://freebets.net",
    ]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(None, "http://x.net/fr/")], "page_id long, url string")
    rows = url_filter.filter_urls(pages.withColumns({c: F.lit(1) for c in ("id", "host", "rule", "n_soft")}))
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    expected = con.execute(url_filter.sql()).fetchall()
    names = [c[0] for c in con.description]
    assert got(rows, *names) == sorted(expected, key=repr)
    verdict = {r.page_id: (r.rule, r.verdict) for r in rows.collect()}
    assert [verdict[i] for i in (3, 4, 5, 6, 7, 9, 10, 11, 12, 14)] == [
        (None, "allow"), ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("example.com/en/", "block"),
        ("net/es/", "block"), (None, "block"), (None, "block"), (None, "allow"), (None, "block"),
    ]
    assert url_filter.filter_urls(pages.where("false")).count() == 0


# --- byte-level BPE --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))


def test_tree_codec(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.TreeCodec(ranks, leaf=3)

    @settings(max_examples=150, deadline=None)
    @given(st.one_of(TEXT, st.text(max_size=40), st.text(alphabet=" \n\tab", max_size=150), st.text(alphabet="ab'sre1", max_size=150)))
    def check(text):
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()

    check()


def test_byte_bpe(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = odd_documents() + [(900, "z" * 30_000), (901, " " * 9000), (902, "<|endoftext|> it's\r\n\r\n")]
    rows = byte_bpe.decode(byte_bpe.encode(frame(spark, docs), leaf=64)).collect()
    texts = dict(docs)
    assert len(rows) == len(docs)
    assert sorted(rows, key=repr) == sorted(byte_bpe.round_trip(frame(spark, docs), leaf=64).collect(), key=repr)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.token_ids, "<u4").tolist() == library.encode_ordinary(text)
        assert r.decoded == text.encode() and r.n_tokens == len(r.token_ids) // 4
    assert byte_bpe.encode(frame(spark, [])).count() == 0
