"""Benchmark passages in documents, found by Wu-Manber search over words.

A pattern is a run of ``window`` consecutive words of an item, or a whole shorter item. Patterns of
one length m share a searcher: the table of blocks of two words says how far the search may move on
(m - 1 words where a block is in no pattern), buckets by the last block select the patterns that may
end here, and words are compared one by one to confirm. Words are lower-cased (A-Z) runs of ASCII
letters, digits and non-ASCII characters, held as 64-bit numbers.

Items go to the tasks in blocks of at most ``block_bytes`` of text, checked beforehand; with more
blocks than one the documents pass once for each block, and what was found travels with them.

Defined results: null and empty texts have no words; items without words are never found; items without an
id are searched too, their hits contaminate a document but add nothing to its item_ids; repeated
documents are searched each, repeated items count once by id; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts, written
from .words import NOT_ALNUM, WordReader, grams, portions

WINDOW = 10
BLOCK_BYTES = 8_000_000


class Searcher:
    """All patterns of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(dict)

    def add(self, words: Sequence[int], blocks: Sequence[int], item: str | None) -> None:
        for at, block in enumerate(blocks):
            move = self.length - self.block - at
            self.shift[block] = min(self.shift.get(block, self.far), move)
        items = self.buckets[blocks[-1]].setdefault(tuple(words), set())
        if item is not None:
            items.add(item)

    def find(self, words: list[int], blocks: list[int], begin: int, end: int) -> Iterator[tuple[int, set[str]]]:
        """Starts of occurrences in words[begin:end] and the items they are of."""
        shift, far, back = self.shift.get, self.far, self.length - self.block
        at, last = begin + back, end - self.block
        while at <= last:
            move = shift(blocks[at], far)
            if move:
                at += move
                continue
            start = at - back
            first = words[start]
            for pattern, items in self.buckets[blocks[at]].items():
                if pattern[0] == first and tuple(words[start : start + self.length]) == pattern:
                    yield start, items
            at += 1


def searchers(items: Sequence[tuple[str | None, str | None]], window: int) -> list[Searcher]:
    reader, by_length = WordReader(NOT_ALNUM, lower=True), {}
    for item, text in items:
        number = reader([text]).number
        length = min(window, len(number))
        if length:
            search = by_length.setdefault(length, Searcher(length))
            words, blocks = number.tolist(), grams(number, search.block).tolist()
            for i in range(len(words) - length + 1):
                search.add(words[i : i + length], blocks[i : i + length - search.block + 1], item)
    return list(by_length.values())


def _merged(starts: Sequence[int], ends: Sequence[int]) -> tuple[list[int], list[int]]:
    out: tuple[list[int], list[int]] = ([], [])
    for s, e in sorted(zip(starts, ends)):
        if out[1] and s <= out[1][-1]:
            out[1][-1] = max(out[1][-1], e)
        else:
            out[0].append(s)
            out[1].append(e)
    return out


def _search(items: list[tuple[str | None, str | None]], window: int, passed: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(NOT_ALNUM, lower=True)
        search = searchers(items, window)
        for batch in batches:
            for part, column in portions(batch.column("text")):
                words = reader(column)
                numbers = words.number.tolist()
                blocks = {s.block: grams(words.number, s.block).tolist() for s in search}
                rows = batch.slice(part.start, part.stop - part.start)
                first = words.first.tolist()
                out = {"n_words": [], "hit_start": [], "hit_end": [], "item_ids": []}
                before = zip(*(rows.column(n).to_pylist() for n in ("hit_start", "hit_end", "item_ids")))
                for d, (starts, ends, found) in enumerate(before):
                    begin, end = first[d], first[d + 1]
                    found = set(found)
                    for s in search:
                        for at, names in s.find(numbers, blocks[s.block], begin, end):
                            starts.append(at - begin)
                            ends.append(at - begin + s.length)
                            found |= names
                    starts, ends = _merged(starts, ends)
                    for name, value in zip(out, (end - begin, starts, ends, sorted(found))):
                        out[name].append(value)
                kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in passed), *(pa.array(v, k) for v, k in zip(out.values(), kinds))],
                    names=[*passed, *out],
                )

    return run


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, n_words, hit_start and hit_end (words, merged), item_ids (sorted).

    With ``keep``, names of columns of the input, these come back in the struct ``kept`` and the text in ``text``.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    empty = F.array().cast("array<int>")
    state = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *kept,
        empty.alias("hit_start"),
        empty.alias("hit_end"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    tests = texts(items, item_col, item_text_col).select(F.col("id").cast("string").alias("item"), "text")
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first().n
    n_blocks = max(1, -(-size // block_bytes))
    whole = ["id", "text", *(["kept"] if keep else [])]
    kinds = {c: state.schema[c].dataType.simpleString() for c in whole}
    for b in range(n_blocks):
        block = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b)
        patterns = [(r.item, r.text) for r in block.collect()]
        last = b == n_blocks - 1
        passed = ["id"] if last and not keep else whole
        state = state.mapInArrow(
            _search(patterns, window, passed),
            "".join(f"{c} {kinds[c]}, " for c in passed) + "n_words long, hit_start array<int>, hit_end array<int>, item_ids array<string>",
        )
        if not last:
            state = written(state, "decontaminate").drop("n_words")
    return state.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate(
        F.zip_with("hit_end", "hit_start", lambda e, s: e - s), F.lit(0).cast("bigint"), lambda total, n: total + n
    )
    return found.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), pat AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS p
  FROM bw, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
  WHERE len(w) > 0
), win AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM dw, (SELECT DISTINCT m FROM pat) AS lens, unnest(range(1, len(w) - m + 2)) AS t(i)
), occ AS (
  SELECT win.doc_id, win.i, win.m, pat.item_id FROM win JOIN pat ON win.p = pat.p AND win.m = pat.m
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM occ, unnest(range(0, m)) AS t(k) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM occ GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
