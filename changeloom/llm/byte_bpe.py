"""Byte-level BPE encoding and decoding by tree reduction.

Encodings of texts form a monoid: a text is halved down to leaves, the leaves are encoded, and
neighbours are joined. Where two parts meet, a window of text around the seam is encoded anew. It
grows until it starts and ends at a place where blank space follows something else, or is the whole
part: no match of the pattern covers such a place in any text, so the tokens outside of the window
can't change. Decoding concatenates the tokens' bytes up the same tree.

Defined results: null encodes as empty; ids outside of the vocabulary raise; repeated rows are encoded
each; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts
from .words import portions

VOCABULARY = "byte_bpe_50k.tiktoken"
#: characters of a leaf of the tree
LEAF = 256
#: characters on each side of a seam that are looked at first
WINDOW = 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def cut_before(text: str, end: int) -> int:
    """The last place up to ``end`` where a blank follows something else; 0 if there is none."""
    for i in range(min(end, len(text) - 1), 0, -1):
        if text[i] in " \n\t" and not text[i - 1].isspace():
            return i
    return 0


def cut_after(text: str, begin: int) -> int:
    """The first such place from ``begin`` on; the text's end if there is none."""
    for i in range(max(begin, 1), len(text)):
        if text[i] in " \n\t" and not text[i - 1].isspace():
            return i
    return len(text)


class TreeCodec:
    """Encodes and decodes with the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, leaf: int = LEAF):
        table = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leaf_tokens: Callable[[str], list[int]] = table.encode_ordinary
        self.leaf = leaf
        self.token = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, begin: int, end: int) -> list[int]:
        if end - begin <= self.leaf:
            return self.leaf_tokens(text[begin:end])
        middle = (begin + end) // 2
        return self.join(text, begin, middle, end, self._encode(text, begin, middle), self._encode(text, middle, end))

    def join(self, text: str, begin: int, middle: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """Tokens of text[begin:end] from those of its two parts."""
        low, high, width = middle, middle, WINDOW
        while low > begin:
            low = max(begin, middle - width)
            if cut := cut_before(text[low:middle], middle - low):
                low += cut
                break
            width *= 2
        width = WINDOW
        while high < end:
            high = min(end, middle + width)
            if (cut := cut_after(text[middle:high], 0)) < high - middle:
                high = middle + cut
                break
            width *= 2
        keep, size = len(left), len(text[low:middle].encode())
        while size > 0:
            keep -= 1
            size -= self.size[left[keep]]
        skip, missing = 0, len(text[middle:high].encode())
        while missing > 0:
            missing -= self.size[right[skip]]
            skip += 1
        if size or missing:
            raise AssertionError("a token reaches over a place where none can")
        return left[:keep] + self.leaf_tokens(text[low:high]) + right[skip:]

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join(map(self.token.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _encoder(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(read_ranks(path), leaf=leaf)
        for batch in batches:
            for part, column in portions(batch.column("text")):
                tokens = [codec.encode(t or "") for t in column]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(part.start, len(column)),
                        pa.array(map(len, tokens), pa.int64()),
                        pa.array([np.array(t, "<u4").tobytes() for t in tokens], pa.binary()),
                    ],
                    names=["id", "n_tokens", "token_ids"],
                )

    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(read_ranks(path))
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                decoded = [
                    codec.decode(np.frombuffer(ids or b"", "<u4").tolist()) for ids in part.column("token_ids").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"]
                )

    return run


def _round_trip(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(read_ranks(path), leaf=leaf)
        for batch in batches:
            for part, column in portions(batch.column("text")):
                tokens = [codec.encode(t or "") for t in column]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(part.start, len(column)),
                        pa.array(map(len, tokens), pa.int64()),
                        pa.array([np.array(t, "<u4").tobytes() for t in tokens], pa.binary()),
                        pa.array([codec.decode(t) for t in tokens], pa.binary()),
                    ],
                    names=["id", "n_tokens", "token_ids", "decoded"],
                )

    return run


def encode(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, leaf: int = LEAF
) -> DataFrame:
    """One row per row: id, n_tokens and token_ids (little-endian unsigned 32-bit numbers)."""
    rows = texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return rows.mapInArrow(_encoder(path, leaf), f"id {kind}, n_tokens long, token_ids binary").withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """Adds the column decoded (bytes) to the id, n_tokens and token_ids of encoded rows."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), "n_tokens", "token_ids")
    kind = rows.schema["id"].dataType.simpleString()
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    decoded = rows.mapInArrow(_decoder(path), f"id {kind}, n_tokens long, token_ids binary, decoded binary")
    return decoded.withColumnRenamed("id", id_col)


def round_trip(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, leaf: int = LEAF
) -> DataFrame:
    """``decode`` of ``encode`` by one set of Python workers instead of two: id, n_tokens, token_ids, decoded."""
    rows = texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    coded = rows.mapInArrow(_round_trip(path, leaf), f"id {kind}, n_tokens long, token_ids binary, decoded binary")
    return coded.withColumnRenamed("id", id_col)
