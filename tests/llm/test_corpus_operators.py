"""Near-duplicate groups, collocations and conversation repair against plain versions, with odd rows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import CLASHING, frame, got, odd_documents, prose

from pyspark.sql import functions as F

from changeloom.llm import collocations, conversation_repair, minhash_dedup
from changeloom.llm.conversation_repair import Survivors, ending
from changeloom.llm.words import WordReader, grams


def thue_morse(n):
    text = "a"
    while len(text) < n:
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_patterned_words_differ(n):
    one, other = thue_morse(n)
    number = WordReader()([f"{one} {other}", f"{one}x {other}x"]).number
    assert len(set(number.tolist())) == 4
    pair = np.array([1, 2], np.uint64)
    runs = [grams(pair[[int(c == "b") for c in t]], n)[0] for t in (one, other)]
    assert runs[0] != runs[1]


# --- near-duplicate groups -------------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 3])
def test_near_groups(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    docs = odd_documents(seed=9) + [(900, "Two Words"), (901, "two words"), (902, "TWO"), (903, thue_morse(2048)[0]), (904, thue_morse(2048)[1])]
    rng = random.Random(4)
    base = prose(rng, 200).split(" ")
    for k in range(60):  # a group of near copies, beyond any block
        w = list(base)
        for _ in range(rng.randrange(1, 12)):
            w[rng.randrange(200)] = f"new{rng.randrange(30)}"
        docs.append((1000 + k, " ".join(w)))
    found = got(minhash_dedup.dedup(frame(spark, docs).repartition(3)), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(((d, n, c, d == c) for d, n, c in plain.near_groups(docs)), key=repr)


def test_near_groups_of_odd_ids(spark):
    text = prose(random.Random(2), 40)
    docs = [(None, text), (5, text + " end"), (5, text), (None, "alone here now"), (None, None), (7, ""), (None, "alone here now")]
    found = got(minhash_dedup.dedup(frame(spark, docs)), "doc_id", "n_shingles", "component_id", "kept")
    n = len(text.split())
    assert sorted(found, key=repr) == sorted(
        [(None, n - 1, 5, False), (5, n, 5, True), (5, n - 1, 5, True), (None, 2, None, True), (None, 2, None, True), (None, 0, None, True), (7, 0, 7, True)],
        key=repr,
    )
    assert minhash_dedup.dedup(frame(spark, [])).count() == 0


def test_signature_bound():
    from math import comb

    least = minhash_dedup.needed(0.8)
    chance = sum(comb(128, m) * 0.8**m * 0.2 ** (128 - m) for m in range(least))
    assert chance <= minhash_dedup.TOLERANCE < chance + comb(128, least) * 0.8**least * 0.2 ** (128 - least)


# --- collocations ----------------------------------------------------------------------------


@pytest.mark.parametrize("very", [collocations.VERY_FREQUENT, 6])
def test_collocations(spark, very):
    rng = random.Random(7)
    docs = []
    for k in range(120):
        words = [rng.choice(["the", "of", "The", "red", "fox", "é", "x-y", "to"]) for _ in range(rng.randrange(0, 60))]
        for _ in range(3):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["new york city", "a.b", "one,\ttwo three four five six", ";", "\v", " "]))
        docs.append((" ".join(words), rng.choice(["en", "de", None, "und", ""])))
    docs += [(None, "en"), ("", None), ("long " * 3000, "en"), (docs[0][0], "en")]
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    df = df.withColumns({c: F.lit("x") for c in (*CLASHING, "rank", "phrase", "word", "number", "route", "a")})
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    for top in (2000, 4):
        found = got(collocations.mine(df, least=3, top=top, very=very), *columns)
        assert found == sorted(plain.collocations(docs, 3, top), key=repr)


def test_collocations_without_rows(spark):
    assert collocations.mine(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert collocations.mine(spark.createDataFrame([(None, None), (" .", "en")], "text string, lang string")).count() == 0


def test_quicksort_counts():
    rng = np.random.default_rng(1)
    seen = rng.integers(0, 3, (5, 400)).astype(np.uint64)
    seen[1:][np.cumsum(seen[:-1] == 0, axis=0) > 0] = 0
    count = rng.integers(1, 5, 400)
    expected = defaultdict(int)
    for k in range(400):
        for m in range(2, 6):
            if seen[:m, k].all():
                expected[tuple(seen[:m, k])] += int(count[k])
    found = {tuple(seen[:m, k]): w for k, m, w in collocations.quicksort_counts(seen, count, 9)}
    assert found == {p: n for p, n in expected.items() if n >= 9}


# --- conversations ---------------------------------------------------------------------------

ROLE = st.sampled_from(["system", "user", "assistant", "user", "assistant", "bot", "", " "])
TEXT = st.sampled_from(["a.", "b", "c!", "", " \n", "d? ", "e.", "f", "g."])


def searched(rows):
    survivors, seen, held = Survivors.at(0), set(), 0
    for role, text in rows:
        blank, again = not plain.BLANK_WORDS.search(text), (role, text) in seen
        seen.add((role, text))
        open_ = not blank and text.rstrip()[-1] not in ".!?"
        ways = conversation_repair.STEPS[conversation_repair.initial(role), blank or again, open_]
        survivors.step([(a, b, c, e, e) for a, b, c, e in ways])
        held = max(held, survivors.held)
    state, cost, inserted = ending(survivors)
    return cost, "".join(survivors.path(state)) + inserted, held


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=12))
def test_search(rows):
    assert searched(rows)[:2] == plain.repaired(rows)[:2]


def test_search_holds_little():
    rng = random.Random(3)
    rows = [(("user", "assistant")[i % 2] if rng.random() < 0.9 else "bot", f"t{i}.") for i in range(20000)]
    cost, audit, held = searched(rows)
    assert (cost, audit) == plain.repaired(rows)[:2] and held < 200


def damaged_conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(30), None]:
        for t in range(rng.choice([0, 1, 3, 9, 40])):
            role = rng.choice(["system" if not t else "user", "user", "assistant", "assistant", None, "bot"])
            turn = rng.choice([t, t, t, t + 3, None])
            rows += [(c, turn, role, rng.choice([f"t{t}.", f"t{t}", "same!", "", None, "end? "]))] * rng.choice([1, 1, 1, 2, 7])
    return rows


@pytest.mark.parametrize("chunk", [2, 256])
def test_repair(spark, chunk):
    rows = damaged_conversations(5)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in (*CLASHING, "part", "nth", "copies", "edits", "at", "of")})
    found = conversation_repair.repair(df, chunk=chunk)
    shas = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digest(found.rows).collect()}
    by_id = defaultdict(list)
    for c, turn, role, text in rows:
        by_id[c].append((turn is not None, turn, " " if role is None else role, " " if text is None else text))
    report = {r.conv_id: r for r in found.report.collect()}
    assert set(report) == set(by_id)
    for c, conv in by_id.items():
        conv.sort(key=lambda r: (r[0], r[1] or 0, *r[2:]))
        pairs = [r[2:] for r in conv]
        cost, audit, lines = plain.repaired(pairs)
        turns = [r[1] for r in conv if r[0]]
        blank = [not plain.BLANK_WORDS.search(t) for _, t in pairs]
        again = [p in pairs[:i] for i, p in enumerate(pairs)]
        cut = [not b and t.rstrip()[-1] not in ".!?" for b, (_, t) in zip(blank, pairs)]
        r = report[c]
        assert (r.cost, r.audit) == (cost, audit)
        assert shas.get(c, plain.sha("")) == plain.sha("\n".join(lines))
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r.blank == sum(blank) and r.duplicate == sum(a and not b for a, b in zip(again, blank))
        assert r.truncated == sum(x and not a for x, a in zip(cut, again))
        assert r.illegal == sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in zip(pairs, pairs[1:]))


def test_repair_of_a_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2 if t % 97 else 0], f"word {t}.") for t in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = conversation_repair.repair(df)
    (r,) = found.report.collect()
    cost, audit, lines = plain.repaired([x[2:] for x in rows])
    assert (r.cost, r.audit, r.gaps) == (cost, audit, 0)
    assert conversation_repair.digest(found.rows).first().repaired_sha256 == plain.sha("\n".join(lines))


def test_repair_query_with_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, extra int"
    assert conversation_repair.query(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None, 1), (3, 0, "user", "hi.", 1), (8, 1, "user", "x", 2)]
    found = {r.conv_id: r for r in conversation_repair.query(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {None, 3, 8}
    assert found[None].blank in (0, 1) and found[None].cost in (0, 4)
