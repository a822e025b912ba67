"""Token counts of every prefix.

A text's tokens never reach over blank space, so the count at the end of a stretch without blanks is
the count before it plus its own: a table of running totals over the stretch ends, filled in one pass
(:func:`count_tokens`). Inside a stretch :class:`WordPrefixes` fills the same kind of table byte by byte: the
last token of a prefix is the one token that ends there and stays apart from the last token of what is before
it, and the prefix has one token more than that. A count at any prefix (:func:`count_at`), the longest prefix
that fits a budget (:func:`truncate_to`) and whether a text does (:func:`fits`) are then looked up.

Defined results: null counts as empty (and is returned as null by ``truncate_to``); a length below 0 or null
counts as 0, one beyond the text as the whole text; a budget below 0 or null fits nothing and leaves an empty
text; repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import texts

TOKENIZER = "word_bpe_49k.json"
#: distinct stretches whose counts a task remembers at a time
REMEMBER = 400_000
#: characters at which the tokenizer and this module both cut
CUTS = " \t\n\r"
#: fixed values: the tokenizer's shortened forms and its pattern of words
SHORT = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = regex.compile("|".join(SHORT) + rf"|\p{{L}}+|\p{{N}}|[^{_BLANK}\p{{L}}\p{{N}}]+")


class Counts(dict):
    """Tokens of a stretch without blanks; unknown ones are counted with the tokenizer."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__({"": 0})
        self.tokenizer = tokenizer

    @cached_property
    def words(self) -> WordPrefixes:
        return WordPrefixes(self.tokenizer)

    def learn(self, stretches) -> None:
        unknown = [s for s in set(stretches) if s not in self]
        if len(self) + len(unknown) > REMEMBER:
            self.clear()
            self[""] = 0
            unknown = list(set(stretches))
        for begin in range(0, len(unknown), 4096):
            part = unknown[begin : begin + 4096]
            for s, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self[s] = len(e.ids)

    def __missing__(self, stretch: str) -> int:
        self[stretch] = n = len(self.tokenizer.encode(stretch, add_special_tokens=False).ids)
        return n


def stretches_of(text: str) -> list[str]:
    """Parts between blanks; joined by one character each they have the text's length."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class WordPrefixes:
    """Token counts of all prefixes of a stretch, by dynamic programming over the words it is split into.

    Made for tokenizers that bring text to NFC and lower case, split it by :data:`SPLIT` and merge the bytes
    of a word, the last of which is marked.
    """

    def __init__(self, tokenizer: Tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.vocabulary = set(model["vocab"])
        self.most = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        other = [b for b in range(256) if b not in plain]
        self.letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.apart: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Byte-pair merging of a few symbols."""
        while len(symbols) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(symbols, symbols[1:])]
            i = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[i] == len(self.rank):
                break
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]
        return symbols

    def _stays(self, before: str, token: str) -> bool:
        """Whether the two tokens come out as they are when their bytes are merged together."""
        known = self.apart.get((before, token))
        if known is None:
            body = token.removesuffix(self.end) if self.end else token
            symbols = [*before, *body[:-1], body[-1] + token[len(body) :]]
            if len(self.apart) > REMEMBER:
                self.apart.clear()
            known = self.apart[before, token] = self.merged(symbols) == ([before, token] if before else [token])
        return known

    def word(self, word: str) -> list[int]:
        """Tokens of each prefix of a word (by characters), each taken as a word of its own."""
        letters = "".join(map(self.letter.__getitem__, word.encode()))
        last, count = [""], [0]  # of each prefix whose last byte is not marked
        for i in range(1, len(letters) + 1):
            token, n = self._step(letters, i, "", last, count)
            last.append(token)
            count.append(n)
        out, at = [0], 0
        for c in word:
            at += len(c.encode())
            out.append(self._step(letters, at, self.end, last, count)[1] if self.end else count[at])
        return out

    def _step(self, letters: str, i: int, end: str, last: list[str], count: list[int]) -> tuple[str, int]:
        for begin in range(max(0, i - self.most), i):
            token = letters[begin:i] + end
            if token in self.vocabulary and (last[begin] or not begin) and self._stays(last[begin], token):
                return token, count[begin] + 1
        raise AssertionError("every byte is a token")

    def stretch(self, text: str) -> list[int] | None:
        """Tokens of each prefix of a stretch; None if its prefixes are not normalised one character at a time."""
        lower = [c.lower() for c in text]
        if any(len(c) != 1 for c in lower) or unicodedata.normalize("NFC", text) != text:
            return None
        out, before = [0], 0
        for found in SPLIT.finditer("".join(lower)):
            out += [before] * (found.start() + 1 - len(out))
            word = found.group()
            # the beginning of a shortened form is not one: an apostrophe and letters
            inside = self.word(word) if word not in SHORT else [0, *(self._parts(word[:i]) for i in range(1, len(word) + 1))]
            out += [before + n for n in inside[1:]]
            before = out[-1]
        return out + [before] * (len(text) + 1 - len(out))

    def _parts(self, text: str) -> int:
        return sum(self.word(w)[-1] for w in SPLIT.findall(text))


class PrefixTable:
    """Exact token counts of a text's prefixes (by number of characters)."""

    def __init__(self, text: str, counts: Counts):
        self.parts = stretches_of(text)
        counts.learn(self.parts)
        self.ends = np.cumsum([len(p) + 1 for p in self.parts]) - 1
        self.totals = np.cumsum([counts[p] for p in self.parts])
        self.counts = counts
        self.inner: dict[str, list[int]] = {}

    def _inside(self, part: str) -> list[int]:
        if part not in self.inner:
            table = self.counts.words.stretch(part)
            if table is None or table[-1] != self.counts[part]:  # rare: every prefix with the tokenizer
                heads = [part[:i] for i in range(len(part) + 1)]
                self.counts.learn(heads)
                table = [self.counts[h] for h in heads]
            self.inner[part] = table
        return self.inner[part]

    def total(self) -> int:
        return int(self.totals[-1])

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters."""
        k = int(np.searchsorted(self.ends, chars))
        if k == len(self.parts):
            return self.total()
        begin = int(self.ends[k - 1]) + 1 if k else 0
        before = int(self.totals[k - 1]) if k else 0
        return before + (self._inside(self.parts[k])[chars - begin] if chars > begin else 0)

    def longest(self, budget: int) -> int:
        """Most whole stretches, and then characters, whose tokens stay within the budget."""
        k = bisect_right(self.totals, budget)
        if k == len(self.parts):
            return int(self.ends[-1])
        begin = int(self.ends[k - 1]) + 1 if k else 0
        before = int(self.totals[k - 1]) if k else 0
        inside = self._inside(self.parts[k])
        return begin + max(i for i, n in enumerate(inside) if before + n <= budget)


def load(path: str) -> Counts:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    return Counts(Tokenizer.from_file(path))


def _count(path: str, prefixes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = load(path)
        for batch in batches:
            ids, column = batch.column("id"), batch.column("text")
            for begin in range(0, batch.num_rows, 256):
                part = column.slice(begin, 256).to_pylist()
                parts = [stretches_of(t or "") for t in part]
                counts.learn(s for p in parts for s in p)
                totals = [np.cumsum([counts[s] for s in p], dtype=np.int64) for p in parts]
                out = [
                    ids.slice(begin, 256),
                    pa.array([len((t or "").encode()) for t in part], pa.int64()),
                    pa.array([int(t[-1]) for t in totals], pa.int64()),
                ]
                names = ["id", "n_bytes", "n_tokens"]
                if prefixes:
                    ends = [np.cumsum([len(s) + 1 for s in p], dtype=np.int64) - 1 for p in parts]
                    out += [pa.array(ends, pa.list_(pa.int64())), pa.array(totals, pa.list_(pa.int64()))]
                    names += ["prefix_chars", "prefix_tokens"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def count_tokens(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, prefixes: bool = False
) -> DataFrame:
    """One row per row: id, n_bytes, n_tokens; with ``prefixes`` the table of counts as two arrays."""
    rows = texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    more = ", prefix_chars array<bigint>, prefix_tokens array<bigint>" if prefixes else ""
    counted = rows.mapInArrow(
        _count(tokenizer or public_tokenizers.path(TOKENIZER), prefixes), f"id {kind}, n_bytes long, n_tokens long{more}"
    )
    return counted.withColumnRenamed("id", id_col)


def _looked_up(path: str, value: Callable[[PrefixTable, str, int], object], kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = load(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found = [
                    value(PrefixTable(t or "", counts), t, -1 if n is None else n)
                    for t, n in zip(part.column("text").to_pylist(), part.column("n").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, kind)], names=["id", "found"])

    return run


def _lookup(df: DataFrame, n: Column | int, id_col: str, text_col: str, tokenizer: str | None, value, name: str, kind: str):
    n = (F.lit(n) if isinstance(n, int) else n).cast("bigint").alias("n")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), n)
    types = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    code = _looked_up(tokenizer or public_tokenizers.path(TOKENIZER), value, types[kind])
    found = rows.mapInArrow(code, f"id {rows.schema['id'].dataType.simpleString()}, found {kind}")
    return found.select(F.col("id").alias(id_col), F.col("found").alias(name))


def count_at(
    df: DataFrame, chars: Column | int, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """id and n_tokens of the first ``chars`` characters (code points) of each text."""
    return _lookup(df, chars, id_col, text_col, tokenizer, lambda t, _, n: t.at(max(n, 0)), "n_tokens", "long")


def fits(
    df: DataFrame, budget: Column | int, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """id and whether the text has at most ``budget`` tokens."""
    return _lookup(df, budget, id_col, text_col, tokenizer, lambda t, _, n: t.total() <= n, "fits", "boolean")


def truncate_to(
    df: DataFrame, budget: Column | int, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """id and the longest prefix of the text that has at most ``budget`` tokens."""
    cut = lambda t, text, n: None if text is None else text[: t.longest(n)] if n >= 0 else ""
    return _lookup(df, budget, id_col, text_col, tokenizer, cut, "text", "string")
