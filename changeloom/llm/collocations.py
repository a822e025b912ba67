"""Phrase collocations: frequent phrases of two to five words whose parts meet more often than by chance.

1. Every task cuts its texts into pieces and words, counts its words, and adds each pair of neighbours to a table of
   counters by hash. Summed over all tasks the table says which pairs can't be frequent (a counter is never below a
   pair's count) and which are very frequent. Its size follows the corpus up to ``MOST_SLOTS``; beyond, it excludes
   fewer pairs and changes nothing else.
2. A suffix pointer stands at every word and sees ``LONGEST`` words at most, up to the end of its piece or the
   first pair that can't be frequent. Pointers that see the same words are sent once by a task, with their number, and
   routed by the first two words; by three, four or five where the pairs before are very frequent. So neither a hot
   word nor a hot passage meets in one task.
3. A route's pointers go through a multikey three-way quicksort: parted by the word at the present depth into smaller,
   equal and greater ones, the equal ones then by the next word. The weight of an equal part is the count of its
   phrase. A part (of any kind) below ``MIN_COUNT`` is abandoned. Counts of phrases that are all very frequent pairs
   are sums over the routes that saw them.
4. Candidates are cut at each place, scored by exact whole numbers (the lowest score of a cut counts), dropped where a
   candidate one word longer is as frequent, and ranked in each language.

Words are known by 64-bit numbers until the result is written out. Lower-casing is of A-Z; pieces end at
``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+`` in them.

Defined results: null and empty texts have no words; a null language is ``und`` and one with documents of that name.
Repeated rows count as often as they stand there. Ids play no part and may be missing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .groups import groups, numbers, objects
from .tables import written
from .words import LOWER, WordReader, Words, mix, portions

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
PIECE_END = tuple(b".,;:!?\x0a\x0b\x0c\x0d")
#: words, and suffix pointers, that a task holds before it combines them
HELD, HELD_POINTERS = 1 << 19, 1 << 18
#: bytes of text for each counter of the table of pairs; fewest and most counters; counters in a row
SLOT_BYTES, LEAST_SLOTS, MOST_SLOTS, SLICE = 128, 1 << 16, 1 << 26, 1 << 16
#: words of the corpus for each route; a pair of more occurrences than this is routed by further words
ROUTE_WORDS, VERY_FREQUENT = 1 << 17, 1 << 19
LEAST_ROUTES = 256
#: groups in which the best are found before they meet
SALTS = 64


def _lang_key(lang: str | None) -> np.uint64:
    name = (UNKNOWN if lang is None else lang).encode("utf-8", "surrogatepass")
    return np.uint64(int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little"))


class Pieces:
    """Words of batches of texts: their numbers (of word and language), pieces and places."""

    def __init__(self):
        self.reader = WordReader(tuple(b"\x20\x09") + PIECE_END, lower=True)
        self.ends = np.zeros(256, bool)
        self.ends[list(PIECE_END)] = True
        self.keys: dict[str | None, np.uint64] = {}

    def __call__(self, texts: list[str | None], langs: list[str | None]):
        words = self.reader(texts)
        for lang in set(langs) - self.keys.keys():
            self.keys[lang] = _lang_key(lang)
        key = np.array([self.keys[x] for x in langs], np.uint64)
        number = mix(words.number ^ key[words.doc]) if len(words.number) else words.number
        piece = np.cumsum(self.ends[np.frombuffer(words.data, np.uint8)])[words.start]
        return words, number, piece


def _pairs(number: np.ndarray, piece: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word: whether the next one is in its piece, and the counter of the two."""
    inside = np.append(piece[1:] == piece[:-1], False)[: len(number)]
    slot = (mix(number[:-1] ^ mix(number[1:])) & np.uint64(slots - 1)).astype(np.int64)
    return inside, np.append(slot, 0)[: len(number)]


def _words(words: Words, number: np.ndarray, langs: list[str]) -> pa.RecordBatch:
    """Distinct words with their language, spelling and count."""
    distinct, first, n = np.unique(number, return_index=True, return_counts=True)
    data = words.data.translate(LOWER)
    spelled = [data[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
    return pa.RecordBatch.from_pydict(
        {
            "number": pa.array(distinct.view(np.int64)),
            "lang": pa.array(langs, pa.string()).take(pa.array(words.doc[first])),
            "word": pa.array(spelled, pa.binary()),
            "n": pa.array(n),
        }
    )


def _counted(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The words in batches, with empty columns for slices of the table."""
    for i in range(0, rows.num_rows, 1 << 15):
        part = rows.slice(i, 1 << 15)
        none = [pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.binary())]
        word = pa.array([w.decode("utf-8", "surrogatepass") for w in part.column("word").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays(
            [part.column("number"), part.column("lang"), word, part.column("n"), *none],
            names=["number", "lang", "word", "n", "slice", "counts"],
        )


COUNTED = "number long, lang string, word string, n long, slice long, counts binary"


def _count(slots: int):
    """Task code: each word of a task with its count, and the task's table of pairs in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = Pieces(), np.zeros(slots, np.uint16)
        held: list[pa.RecordBatch] = []
        size = 0

        def combined() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            _, first, of = np.unique(numbers(rows, "number"), return_index=True, return_inverse=True)
            n = np.bincount(of, weights=numbers(rows, "n")).astype(np.int64)
            return rows.take(pa.array(first)).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part, column in portions(batch.column("text")):
                words, number, piece = pieces(column, langs[part])
                if not len(number):
                    continue
                inside, slot = _pairs(number, piece, slots)
                at, n = np.unique(slot[inside], return_counts=True)
                table[at] = np.minimum(table[at] + n, 0xFFFF)
                held.append(_words(words, number, [UNKNOWN if x is None else x for x in langs[part]]))
                size += held[-1].num_rows
                if size >= HELD:
                    held = [combined()]
                    size = held[0].num_rows
                    if size >= HELD >> 1:
                        yield from _counted(held[0])
                        held, size = [], 0
        if held:
            yield from _counted(combined())
        for k in range(0, slots, SLICE):
            part = table[k : k + SLICE]
            if part.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "number": pa.nulls(1, pa.int64()), "lang": pa.nulls(1, pa.string()), "word": pa.nulls(1, pa.string()),
                        "n": pa.nulls(1, pa.int64()), "slice": pa.array([k // SLICE]), "counts": pa.array([part.tobytes()]),
                    }
                )

    return run


def _sum_slices(least: int, very: int):
    """Task code: of each slice the counters of at least ``least``, and those that are very frequent, as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(k: int, total: np.ndarray) -> pa.RecordBatch:
            bits = [np.packbits(total >= x, bitorder="little").tobytes() for x in (least, very)]
            return pa.RecordBatch.from_arrays([pa.array([k]), pa.array(bits[:1]), pa.array(bits[1:])], names=["slice", "often", "very"])

        now, total = None, None
        for batch in batches:
            for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                part = np.frombuffer(counts.as_buffer(), np.uint16)
                if k != now:
                    if now is not None:
                        yield row(now, total)
                    now, total = k, np.zeros(len(part), np.int64)
                total += part
        if now is not None:
            yield row(now, total)

    return run


class Filter:
    """Which pairs may be frequent, and which are very frequent."""

    def __init__(self, slots: int, rows):
        self.slots = slots
        self.often, self.very = np.zeros((2, slots // 8), np.uint8)
        for r in rows:
            begin = r["slice"] * SLICE // 8
            for name in ("often", "very"):
                bits = np.frombuffer(r[name], np.uint8)
                getattr(self, name)[begin : begin + len(bits)] = bits

    def bits(self, name: str, slot: np.ndarray) -> np.ndarray:
        return (getattr(self, name)[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def suffixes(number: np.ndarray, piece: np.ndarray, pairs: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Words that each useful suffix pointer sees (a row for each depth, 0 beyond the end), and the number of words it is
    routed by."""
    inside, slot = _pairs(number, piece, pairs.slots)
    goes_on = inside & pairs.bits("often", slot)
    very = goes_on & pairs.bits("very", slot)
    at = np.flatnonzero(goes_on)
    seen, depth = np.zeros((LONGEST, len(at)), np.uint64), np.full(len(at), 2)
    seen[0] = number[at]
    on, hot = np.ones(len(at), bool), np.ones(len(at), bool)
    for d in range(1, LONGEST):
        before = np.minimum(at + d - 1, len(number) - 1)
        on = on & goes_on[before]
        seen[d] = np.where(on, number[np.minimum(at + d, len(number) - 1)], 0)
        hot = hot & very[before]
        if d + 1 < LONGEST:
            depth += on & hot & goes_on[np.minimum(before + 1, len(number) - 1)]
    return seen, depth


def _route(pairs, n_routes: int):
    """Task code: suffix pointers of a task, equal ones once, packed by route."""
    fields = [("route", pa.int64()), ("n", pa.int64()), ("packed", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, filtered = Pieces(), pairs.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            seen, depth = (np.concatenate([h[k] for h in held], axis=-1) for k in (0, 1))
            name = np.zeros(seen.shape[1], np.uint64)
            route = name
            for d in range(LONGEST):
                name = mix((name ^ seen[d]) + np.uint64(d + 1))
                route = np.where(depth == d + 1, name, route)
            _, first, count = np.unique(name, return_index=True, return_counts=True)
            route = (route[first] % np.uint64(n_routes)).astype(np.int64)
            order = np.argsort(route, kind="stable")
            route, seen, count = route[order], seen[:, first[order]], count[order].astype(np.uint64)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(route)) + 1, [len(route)]))
            spans = [(int(a), int(b)) for a, b in zip(cuts, cuts[1:]) if b > a]
            packed = [np.vstack((seen[:, a:b], count[None, a:b])).tobytes() for a, b in spans]
            columns = ([int(route[a]) for a, _ in spans], [b - a for a, b in spans], packed)
            return pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(columns, fields)], names=[f[0] for f in fields])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part, column in portions(batch.column("text")):
                _, number, piece = pieces(column, langs[part])
                if len(number):
                    held.append(suffixes(number, piece, filtered))
                    size += held[-1][0].shape[1]
                if size >= HELD_POINTERS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def quicksort_counts(seen: np.ndarray, count: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a pointer, number of its first words, count) of each phrase of two words or more that has ``least`` pointers.

    Multikey three-way quicksort; parts that weigh less than ``least`` are abandoned."""
    parts = [(np.arange(seen.shape[1]), 0)]
    while parts:
        pointers, depth = parts.pop()
        if count[pointers].sum() < least:
            continue
        word = seen[depth, pointers]
        pivot = word[len(word) // 2]
        equal = word == pivot
        if not equal.all():
            smaller = word < pivot
            parts += [(pointers[smaller], depth), (pointers[~(smaller | equal)], depth)]
            pointers = pointers[equal]
        if not pivot:  # where pointers end
            continue
        weight = int(count[pointers].sum())
        if weight < least:
            continue
        if depth:
            yield int(pointers[0]), depth + 1, weight
        if depth + 1 < LONGEST:
            parts.append((pointers, depth + 1))


def _mine(pairs, least: int):
    """Task code: frequent phrases of each route, and sums for those that other routes see too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filtered = pairs.value
        arrays = lambda b: {"route": numbers(b, "route"), "packed": objects(b, "packed")}
        for g in groups(batches, ("route",), arrays):
            blocks = [np.frombuffer(x, np.uint64).reshape(LONGEST + 1, -1) for x in g["packed"]]
            both = np.concatenate(blocks, axis=1)
            seen, count = both[:LONGEST], both[LONGEST].astype(np.int64)
            # the number of first words of which each two neighbours are very frequent: up to there other routes take part
            shared = np.ones(seen.shape[1], np.int64)
            hot = np.ones(seen.shape[1], bool)
            for d in range(1, LONGEST - 1):
                slot = (mix(seen[d - 1] ^ mix(seen[d])) & np.uint64(filtered.slots - 1)).astype(np.int64)
                hot = hot & (seen[d] != 0) & filtered.bits("very", slot)
                shared += hot
            words, counts = [], []
            for k, m, weight in quicksort_counts(seen, count, least):
                if m > shared[k]:
                    words.append(seen[:m, k].view(np.int64).tolist())
                    counts.append(weight)
            for m in range(2, LONGEST):
                part = np.flatnonzero(shared >= m)
                if len(part):
                    phrases, of = np.unique(seen[:m, part], axis=1, return_inverse=True)
                    words += np.ascontiguousarray(phrases.T).view(np.int64).tolist()
                    counts += np.bincount(of.ravel(), weights=count[part]).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.int64())), pa.array(counts, pa.int64())], names=["words", "a"]
            )

    return run


def phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, very: int = VERY_FREQUENT
) -> tuple[DataFrame, ...]:
    """Frequent phrases (words as numbers, a), frequent words (number, lang, word, n) and words of each language."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    size = read.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (size // SLOT_BYTES).bit_length()))
    counted = written(read.mapInArrow(_count(slots), COUNTED), "collocation-counts")
    per_word = written(
        counted.where("number is not null").groupBy("number", "lang", "word").agg(F.sum("n").alias("n")), "collocation-words"
    )
    langs = per_word.groupBy("lang").agg(F.sum("n").alias("all"))
    n_words = per_word.agg(F.sum("n").alias("n")).first()["n"] or 0
    slices = counted.where("slice is not null").select("slice", "counts").repartition("slice").sortWithinPartitions("slice")
    bits = slices.mapInArrow(_sum_slices(least, very), "slice long, often binary, very binary").collect()  # MOST_SLOTS / 4 bytes at most
    pairs = spark.sparkContext.broadcast(Filter(slots, bits))
    n_routes = max(LEAST_ROUTES, n_words // ROUTE_WORDS)
    routed = read.mapInArrow(_route(pairs, n_routes), "route long, n long, packed binary")
    routed = routed.repartition("route").sortWithinPartitions("route")
    found = written(routed.mapInArrow(_mine(pairs, least), "words array<bigint>, a long"), "collocation-phrases")
    found = found.groupBy("words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return written(found, "collocation-phrases"), per_word.where(F.col("n") >= least), langs


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = MIN_COUNT,
    top: int = TOP,
    very: int = VERY_FREQUENT,
) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    found, words, langs = phrases(docs, text_col, lang_col, least, very)
    size = F.size("words")
    # longer phrases that are as frequent
    longer = found.where(size > 2).select(
        F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("part"), F.col("a").alias("longer")
    )
    longer = longer.groupBy("part").agg(F.max("longer").alias("longer"))
    kept = found.join(longer, F.col("words") == F.col("part"), "left").where("longer is null or longer < a").select("words", "a")
    known = found.union(words.select(F.array("number"), "n"))
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cut = cut.withColumn("first", F.slice("words", F.lit(1), F.col("k"))).withColumn("rest", F.slice("words", F.col("k") + 1, size - F.col("k")))
    cut = cut.join(known.select(F.col("words").alias("first"), F.col("a").alias("l")), "first")
    cut = cut.join(known.select(F.col("words").alias("rest"), F.col("a").alias("r")), "rest")
    named = words.select(F.col("number").alias("number"), "lang").join(langs, "lang")
    cut = cut.join(named, F.col("words")[0] == F.col("number"))
    # whole numbers of 38 digits: a * n and l * r may pass 64 bits
    wide = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    cut = cut.withColumn("above", F.lit(1000).cast("decimal(4,0)") * wide("a", 15) * wide("all", 17))
    cut = cut.withColumn("below", wide("l", 18) * wide("r", 18)).withColumn("score", F.expr("above div below"))
    scored = cut.groupBy("words", "a", "lang", F.col("all").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelled = scored.select("words", F.posexplode("words").alias("i", "number")).join(words.select("number", "word"), "number")
    spelled = spelled.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("all_"))
    spelled = spelled.select("words", F.array_join(F.col("all_.word"), " ").alias("phrase"))
    rows = scored.join(spelled, "words").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = best.where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (
  SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, phrase, any_value(m) AS m, count(*) AS a FROM (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM w, unnest(range(1, {LONGEST + 1})) AS s(m), unnest(range(1, len(w) - m + 2)) AS u(i)
  ) GROUP BY lang, phrase HAVING count(*) >= {MIN_COUNT}
), c AS MATERIALIZED (
  SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
), sub AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS a
  FROM c, unnest(range(2, m)) AS s(k), unnest(range(1, m - k + 2)) AS u(i) GROUP BY ALL
), cut AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n.n,
         CAST((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM c, unnest(range(1, c.m)) AS s(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.m], ' ')
  JOIN n ON n.lang = c.lang
), best AS (
  SELECT lang, phrase, any_value(a) AS a, min({{'score': score, 'k': k, 'l': l, 'r': r}}) AS cut, any_value(n) AS n
  FROM cut ANTI JOIN sub ON sub.lang = cut.lang AND sub.phrase = cut.phrase AND 100 * sub.a >= 100 * cut.a
  GROUP BY lang, phrase
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank, phrase, a,
       cut.l AS l, cut.r AS r, CAST(n AS BIGINT) AS n, cut.score AS score
FROM best QUALIFY rank <= {TOP}"""
