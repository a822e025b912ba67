"""Removal of passages that also stand earlier in the corpus, by matching statistics of suffix automata.

A window is ``WINDOW`` consecutive words. A word goes if it is inside a window whose words also start
earlier: in a document with a smaller id, or earlier in the same one. The reference of every document
is thus the whole corpus before it, too much to broadcast; so the reference is dealt into shards by
content, and passages meet only the shard that can hold them:

1. A window's key is the smallest hash of its 5-word runs, so equal windows have equal keys.
   Consecutive windows with one key are a span, cut after 16 windows where a text repeats itself; a span is
   named by the hash of its words.
2. By key: of spans with equal names all but the first go whole. A first one needs a closer look if other
   spans have its key (they may share windows) or it repeats a 5-word run in itself.
3. The words of these are sent to the shards. A shard's suffix automaton takes in its spans in order, word
   by word; before a word is added, the longest match that ends there is known, and where it has
   ``WINDOW`` words or more, that window also starts earlier. A key with more than ``SHARD`` different
   spans is dealt further, window by window, by the windows' hashes.
4. The spans and windows that go are applied to the documents.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged, held as 64-bit numbers.

Defined results: null and empty texts have no words; rows without an id come before all others. A row's place
is its id and a hash of its text: rows with the same id and text are repetitions of one document; rows with
the same id (or none) and different texts are documents of their own, of which neither is earlier than the
other. Other columns are ignored, or returned with ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .groups import Rows, groups, numbers, objects
from .tables import written
from .words import WordReader, grams, mix, portions

WINDOW = 20
KEY = 5
SHARD = 500
#: stands for a missing id
NO_ID = -(1 << 63)


def _places(id_col: str, text_col: str) -> list[Column]:
    """What documents are ordered by (id), what tells rows of one id apart (row), and the text."""
    text = F.col(f"`{text_col}`").cast("string")
    return [
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("row"),
        text.alias("text"),
    ]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    return out


def _leaders(first: np.ndarray) -> np.ndarray:
    return np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.zeros(0, int)


def _pieces(begin: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges cut into consecutive ones of ``most`` at most."""
    n = -(-(end - begin) // most)
    begins = np.repeat(begin - most * (np.cumsum(n) - n), n) + most * np.arange(n.sum())
    return begins, np.minimum(begins + most, np.repeat(end, n))


def _spans(window: int):
    """Task code: spans of a batch; of equal ones only the first (of each row with the smallest id) is left to be
    compared with others. ``at`` packs the start, the number of windows, whether a run comes again, and whether
    the span goes in any case."""
    width = window - KEY + 1  # 5-word runs of a window

    def cut(words, ids: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        runs = grams(words.number, KEY)
        n = len(words.number) - window + 1
        if n <= 0:
            return [np.zeros(0, np.int64)] * 6 + [np.zeros(0, bool)]
        least = runs[:n].copy()
        for i in range(1, width):
            np.minimum(least, runs[i : i + n], out=least)
        again = np.zeros(len(runs) + 1, np.int64)  # runs that come again within a window's reach
        for lag in range(1, width + 1):
            if lag < len(runs):
                again[1 : len(runs) - lag + 1] |= runs[lag:] == runs[:-lag]
        again = np.cumsum(again)
        inside = words.doc[:n] == words.doc[window - 1 :]
        change = np.ones(n, bool)
        change[1:] = (least[1:] != least[:-1]) | (words.doc[1:n] != words.doc[: n - 1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(change)
        end = np.concatenate((begin[1:], [n]))
        begin, end = _pieces(begin[inside[begin]], end[inside[begin]], width)
        total = np.zeros(len(words.number) + 1, np.uint64)
        # a span's name: its words' numbers weighed by their place in it
        power = np.cumprod(np.full(len(words.number), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        inverse = np.cumprod(np.full(len(words.number), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64), dtype=np.uint64)
        np.cumsum(words.number * power, dtype=np.uint64, out=total[1:])
        name = mix((total[end + window - 1] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
        inner = again[np.minimum(end + width - 1, len(runs))] > again[begin]
        d = words.doc[begin]
        return [
            least[begin].view(np.int64), name.view(np.int64), ids[d], rows[d], begin - words.first[d], end - begin, inner,
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            ids, texts = numbers(batch, "id"), numbers(batch, "row")
            found = [cut(reader(column), ids[part], texts[part]) for part, column in portions(batch.column("text"))]
            if not found:
                continue
            key, name, doc, row, start, n, inner = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((start, row, doc, name, key))
            key, name, doc, row, start, n, inner = (x[order] for x in (key, name, doc, row, start, n, inner))
            leader = _leaders(_changes(key, name))
            own = _leaders(_changes(key, name, doc, row))
            later = (doc != doc[leader]) | (start != start[own])
            keep = _changes(key, name, doc, row, start)
            # those that go in any case are put together where they touch, and dealt by their place
            goes = np.flatnonzero(later & keep)
            goes = goes[np.lexsort((start[goes], row[goes], doc[goes]))]
            if len(goes):
                touch = np.zeros(len(goes), bool)
                touch[1:] = (start[goes[1:]] == start[goes[:-1]] + n[goes[:-1]]) & ~_changes(doc[goes], row[goes])[1:]
                heads = np.flatnonzero(~touch)
                keep[goes[touch]] = False
                n[goes[heads]] = np.add.reduceat(n[goes], heads)
            place = mix(doc.view(np.uint64) * np.uint64(31) + row.view(np.uint64) + start.astype(np.uint64)).view(np.int64)
            key, inner = np.where(later, place, key), inner & ~later
            at = (start.astype(np.int64) << 33) | (n.astype(np.int64) << 2) | (inner.astype(np.int64) << 1) | later
            for i in range(0, len(key), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[part][keep[part]], pa.int64()) for x in (key, name, doc, row, at)],
                    names=["key", "name", "id", "row", "at"],
                )

    return run


def _span_words(window: int):
    """Task code: the words of the spans that are named, or of each of their windows where their key is dealt further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        kinds = [("key", pa.int64()), ("cell", pa.int32()), ("id", pa.int64()), ("row", pa.int64())]
        kinds += [("start", pa.int32()), ("words", pa.binary())]
        rows = Rows(pa.schema(kinds))
        for batch in batches:
            single: list[tuple[int, int, int, int, int, int, bytes]] = []
            sent: set[tuple[int, int]] = set()
            for part, column in portions(batch.column("text")):
                words = reader(column)
                asked = [batch.column(c).slice(part.start, len(column)).to_pylist() for c in ("id", "row", "spans")]
                for d, (doc, row, spans) in enumerate(zip(*asked)):
                    if (doc, row) in sent:
                        continue  # a repetition of a row
                    sent.add((doc, row))
                    own = words.number[words.first[d] : words.first[d + 1]]
                    for s in spans:
                        start, n, key, cells = s["start"], s["n"], s["key"], s["cells"]
                        if cells == 1:
                            rows.add(key, 0, doc, row, start, own[start : start + n + window - 1].tobytes())
                            continue
                        name = grams(own[start : start + n + window - 1], window).tolist()
                        for i in range(n):
                            single.append((key, name[i], doc, row, start + i, cells, own[start + i : start + i + window].tobytes()))
                if rows.full():
                    yield rows.batch()
            # of equal windows of a batch only the first (of each row with the smallest id) is compared with others; the
            # rest go, and are dealt by their place
            first = kept = None
            for key, name, doc, row, start, cells, own in sorted(single):
                if first is None or first[:2] != (key, name):
                    first, kept = (key, name, doc), None
                if doc == first[2] and (kept is None or kept[0] != row):
                    kept = (row, start)
                    rows.add(key, name % cells, doc, row, start, own)
                elif doc != first[2] or start != kept[1]:
                    rows.add((doc * 31 + row + start) & 0x7FFFFFFF, -1, doc, row, start, b"")
            if rows.full():
                yield rows.batch()
        yield rows.batch()

    return run


class SuffixAutomaton:
    """Suffix automaton of the words added so far, with the longest match of the text being added."""

    def __init__(self):
        self.move: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.last = 0
        self.state = self.matched = 0

    def _new(self, size: int, move: dict[int, int], link: int) -> int:
        self.move.append(move)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def add(self, word: int) -> None:
        move, link, size = self.move, self.link, self.size
        now, p = self._new(size[self.last] + 1, {}, 0), self.last
        while p >= 0 and word not in move[p]:
            move[p][word] = now
            p = link[p]
        if p >= 0:
            q = move[p][word]
            if size[q] == size[p] + 1:
                link[now] = q
            else:
                clone = self._new(size[p] + 1, dict(move[q]), link[q])
                while p >= 0 and move[p].get(word) == q:
                    move[p][word] = clone
                    p = link[p]
                link[q] = link[now] = clone
        self.last = now

    def follow(self, word: int) -> int:
        """Words of the longest match that ends with this word, in what was added before it."""
        state, matched = self.state, self.matched
        while state and matched <= self.size[self.link[state]]:
            state = self.link[state]
        while state and word not in self.move[state]:
            state = self.link[state]
            matched = self.size[state]
        if word in self.move[state]:
            state, matched = self.move[state][word], matched + 1
        else:
            matched = 0
        self.state, self.matched = state, matched
        return matched

    def begin(self, mark: int) -> None:
        """Start of another text; ``mark`` is a word that no text has."""
        self.add(mark)
        self.restart()

    def restart(self) -> None:
        """What is followed next is another text."""
        self.state = self.matched = 0


def repeated(spans: Sequence[Sequence[int]], window: int, places: Sequence[tuple[int, int]] | None = None) -> list[list[int]]:
    """For each span, in order: the starts of its windows that also start earlier.

    ``places`` are the spans' documents (id, row). Of documents with the same id neither is earlier, so each of
    these is followed through the automaton of smaller ids and one of its own before the former takes them in.
    """
    automaton, out = SuffixAutomaton(), []
    places = places or [(0, 0)] * len(spans)
    begin = 0
    while begin < len(spans):
        end = begin + 1
        while end < len(spans) and places[end][0] == places[begin][0]:
            end += 1
        alone = places[begin] == places[end - 1]
        own = None
        for k in range(begin, end):
            if alone:
                automaton.begin(-1 - k)
            else:
                automaton.restart()
                if k == begin or places[k] != places[k - 1]:
                    own = SuffixAutomaton()
                own.begin(-1 - k)
            found = []
            for i, word in enumerate(spans[k]):
                matched = automaton.follow(word)
                if alone:
                    automaton.add(word)
                else:
                    matched = max(matched, own.follow(word))
                    own.add(word)
                if matched >= window:
                    found.append(i - window + 1)
            out.append(found)
        if not alone:
            for k, words in enumerate(dict.fromkeys(map(tuple, spans[begin:end]))):
                automaton.begin(-1 - begin - k)
                for word in words:
                    automaton.add(word)
        begin = end
    return out


def _match(window: int):
    """Task code: the windows of each shard that also start earlier."""

    def arrays(batch: pa.RecordBatch):
        return {c: numbers(batch, c) for c in ("key", "cell", "id", "row", "start")} | {"words": objects(batch, "words")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(pa.schema([("id", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]))
        for g in groups(batches, ("key", "cell"), arrays):
            if g["cell"][0] < 0:
                for doc, row, start in zip(g["id"].tolist(), g["row"].tolist(), g["start"].tolist()):
                    rows.add(doc, row, start, 1)
                continue
            place = list(zip(g["id"].tolist(), g["row"].tolist(), g["start"].tolist()))
            one = [k for k in range(len(place)) if not k or place[k] != place[k - 1]]  # a repeated row is no second place
            spans = [np.frombuffer(g["words"][k], np.uint64).tolist() for k in one]
            for k, starts in zip(one, repeated(spans, window, [place[k][:2] for k in one])):
                begin = before = None
                for s in [*starts, None]:
                    if begin is not None and s != before + 1:
                        rows.add(*place[k][:2], place[k][2] + begin, before - begin + 1)
                        begin = None
                    if begin is None:
                        begin = s
                    before = s
            if rows.full():
                yield rows.batch()
        yield rows.batch()

    return run


def _apply(window: int, joined: bool):
    """Task code: documents without the words that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        for batch in batches:
            for part, column in portions(batch.column("text")):
                words = reader(column)
                out: tuple[list, list, list] = ([], [], [])
                for d, spans in enumerate(batch.column("gone").slice(part.start, len(column)).to_pylist()):
                    begin, end = int(words.first[d]), int(words.first[d + 1])
                    n, text = end - begin, column[d]
                    removed = 0
                    if spans:
                        change = np.zeros(n + 1, np.int64)
                        for s in spans:
                            change[min(s["start"], n)] += 1
                            change[min(s["start"] + s["n"] + window - 1, n)] -= 1
                        left = begin + np.flatnonzero(np.cumsum(change[:-1]) == 0)
                        removed = n - len(left)
                    else:
                        left = np.arange(begin, end)
                    if joined:
                        data = words.data
                        text = b" ".join(
                            [data[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist())]
                        ).decode()
                    elif removed:
                        text = _rest(words, left)
                    out[0].append(n)
                    out[1].append(removed)
                    out[2].append(text)
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("kept"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                    names=["kept", "n_words", "n_removed", "text"],
                )

    return run


def _rest(words, left: np.ndarray) -> str:
    """Runs of words that stay with the blanks between them, joined by a line feed."""
    if not len(left):
        return ""
    breaks = np.flatnonzero(np.diff(left) > 1)
    first = left[np.concatenate(([0], breaks + 1))]
    last = left[np.concatenate((breaks, [len(left) - 1]))]
    return b"\n".join(words.data[words.start[a] : words.end[b]] for a, b in zip(first, last)).decode()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Runs of n windows from a start word on, by the row's place (id, row), whose words also start earlier."""
    rows = docs.select(*_places(id_col, text_col))
    spans = rows.mapInArrow(_spans(window), "key long, name long, id long, row long, at long")
    by_name = Window.partitionBy("key", "name").orderBy("id", "row", "at")
    by_row = Window.partitionBy("key", "name", "id", "row").orderBy("at")
    ranked = (
        spans.withColumn("least", F.first("id").over(by_name))
        .withColumn("number", F.row_number().over(by_name))
        .withColumn("rank", F.rank().over(by_row))
        .withColumn("again", F.coalesce(F.lag("at").over(by_row) == F.col("at"), F.lit(False)))  # from a repeated row
    )
    classes = F.sum((F.col("number") == 1).cast("int")).over(Window.partitionBy("key"))
    inner, local = F.col("at").bitwiseAND(2) != 0, F.col("at").bitwiseAND(1) != 0
    later = local | (F.col("id") > F.col("least")) | (F.col("rank") > 1)
    # a span has window - KEY + 1 windows at most
    cells = F.when(F.col("classes") > SHARD, F.ceil(F.col("classes") * (window - KEY + 1) / SHARD)).otherwise(1)
    marks = (
        ranked.select("key", "id", "row", "at", later.alias("later"), "number", "again")
        .withColumn("classes", classes)
        .where(~F.col("again") & (F.col("later") | (F.col("classes") > 1) | inner))
    )
    start, n = F.shiftright("at", 33), F.shiftright("at", 2).bitwiseAND((1 << 31) - 1)
    marks = written(
        marks.select(
            "id", "row", start.cast("int").alias("start"), n.cast("int").alias("n"), "key", "later", cells.cast("int").alias("cells")
        ),
        "dedup-marks",
    )
    asked = marks.where("not later").groupBy("id", "row").agg(
        F.collect_list(F.struct("start", "n", "key", "cells")).alias("spans")
    )
    words = rows.join(asked, ["id", "row"]).select("id", "row", "text", "spans")
    words = words.mapInArrow(_span_words(window), "key long, cell int, id long, row long, start int, words binary")
    shards = words.repartition("key", "cell").sortWithinPartitions("key", "cell", "id", "row", "start")
    matched = shards.mapInArrow(_match(window), "id long, row long, start int, n int")
    # written, so that the shuffles up to here can be dropped before the documents are shuffled again
    return written(matched.union(marks.where("later").select("id", "row", "start", "n")), "dedup-gone")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    joined: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row: id, n_words, n_removed and the text that stays.

    With ``joined`` the text is the words that stay joined by blanks; else runs of them keep the blanks they
    had, and a text that loses nothing is returned as it is. ``keep`` names columns of the input that come
    back in the struct ``kept``.
    """
    gone = repeats(docs, id_col, text_col, window)
    gone = gone.groupBy("id", "row").agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    kept = F.struct(F.col(f"`{id_col}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")]).alias("kept"))
    rows = docs.select(*_places(id_col, text_col), kept.alias("kept"))
    rows = rows.join(gone, ["id", "row"], "left").select("kept", "text", "gone")
    kind = rows.schema["kept"].dataType.simpleString()
    done = rows.mapInArrow(_apply(window, joined), f"kept {kind}, n_words long, n_removed long, text string")
    return done.select(
        F.col("kept.id").alias(id_col),
        *([F.col("kept.kept").alias("kept")] if keep else []),
        "n_words",
        "n_removed",
        F.col("text").alias("text"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS t FROM d, unnest(range(1, len(w) - 18)) AS u(i)
), hit AS (
  SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM hit, unnest(range(0, 20)) AS u(k)
), rest AS (
  SELECT d.doc_id, u.i, d.w[u.i] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(i)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.i = u.i)
), texts AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM rest GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (doc_id)"""
