"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return BLANK_WORDS.findall(text or "")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def dedup(docs, window=20):
    """(id, n_words, n_removed, words that stay joined by blanks) of (id, text) rows."""
    first: dict[tuple, tuple] = {}
    order = lambda d: (d is not None, d or 0)
    for d, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            t = tuple(w[i : i + window])
            first[t] = min(first.get(t, (order(d), i)), (order(d), i))
    out = []
    for d, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (order(d), i):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard(docs, threshold=0.8):
    """(id, copy_id, class_id, n_links) of (id, text) rows with different ids."""
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    root = {d: d for d in ids}
    copy, links = dict(root), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                r, s = find(a), find(b)
                root[max(r, s)] = min(r, s)
                if x == y:
                    copy[b] = min(copy[b], copy[a])
    return [(d, copy[d], find(d), links[d]) for d in ids]


def contaminated(docs, items, window=10):
    """(id, n_words, n_hit, sorted item ids) of (id, text) rows."""
    patterns = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            patterns[tuple(w[i : i + m])].add(str(item))
    out = []
    for d, text in docs:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in {len(p) for p in patterns}:
            for i in range(len(w) - m + 1):
                if names := patterns.get(tuple(w[i : i + m])):
                    found |= names
                    hit |= set(range(i, i + m))
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if BLANK_WORDS.search(x)]
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def near_groups(docs, threshold=0.8):
    """(id, number of shingles, smallest id of its group) of (id, text) rows with different ids; two lower-cased words."""
    sets = {}
    for d, text in docs:
        w = words((text or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                r, s = find(a), find(b)
                root[max(r, s)] = min(r, s)
    return [(d, len(s), find(d)) for d, s in sets.items()]


def collocations(docs, least, top):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    out = []
    by_lang = defaultdict(list)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            by_lang["und" if lang is None else lang].append(re.findall(r"[^\x20\x09]+", piece))
    for lang, pieces in by_lang.items():
        count = Counter(tuple(w[i : i + m]) for w in pieces for m in range(1, 6) for i in range(len(w) - m + 1))
        n = sum(map(len, pieces))
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in good.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        rows = []
        for p, a in good.items():
            if inside[p] < a:
                cuts = [(1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n, -score))
    return out


def repaired(rows):
    """(cost, audit, lines) of the (role, text) rows of a conversation: the best whole string of edits to each place."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    best, seen = {"": (0, "", ())}, set()

    def better(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(now):
        for _ in range(3):
            for state, (cost, audit, lines) in list(now.items()):
                for x in follow[state]:
                    if x in named:
                        better(now, x, (cost + 3, audit + "I", (*lines, named[x] + ":")))
        return now

    for role, text in rows:
        blank, again = not BLANK_WORDS.search(text), (role, text) in seen
        seen.add((role, text))
        more = 0 if blank or text.rstrip(" \t\n\v\f\r")[-1] in ".!?" else 3
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            better(after, state, (cost + 4, audit + "D", lines))
            if not (blank or again):
                for x in follow[state]:
                    if role[:1] == x:
                        better(after, x, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                    if x in named:
                        better(after, x, (cost + 3 + more, audit + "R", (*lines, f"{named[x]}:{text}")))
        best = after
    return min(v for k, v in inserted(best).items() if k in ("", "a"))
