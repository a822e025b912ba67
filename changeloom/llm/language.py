"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with labelled text; a text is
compressed with every one, whole, and belongs to the language whose result is smallest. The margin
to the runner-up, in bytes, gives the score; narrow margins are marked ``rejected``. Both sides are
lower-cased and lose ASCII characters other than letters; a text of under ``SHORT`` bytes is repeated,
as zstandard gives up on blocks that it can't make smaller.

Model: every language that is labelled, by at most ``samples`` different texts (those with the smallest hash, copies
count once). A text gives ``sample_chars`` characters from a place that its hash chooses. A dictionary has ``dict_bytes``
at most, in equal parts for its texts, and less where there are so many languages that all would have more than
``all_bytes`` together, which bounds what is sent to the tasks. Labels are learned only from the rows that are passed
for training.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with a single learned
language everything else is that language with score 1; with no labelled row everything is ``und``.
Ties go to the language with more labelled rows. Repeated rows are judged each; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLES = 120
SAMPLE_CHARS = 700
DICT_BYTES = 110_000
ALL_BYTES = 32_000_000
LEVEL = 5
SHORT, REPEATS = 256, 4
#: bytes of margin that change the odds by a factor e
SCALE = 2.0
#: a margin of fewer bytes is narrow
NARROW = 3


_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_PLAIN).split())


def _smallest(samples: int):
    """Task code: of each language the different texts with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[int, str]] = {}
        bound: dict[str, int] = {}
        for batch in batches:
            text = batch.column("text")
            for i, (lang, unit) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("unit").to_pylist())):
                own = found.setdefault(lang, {})
                if unit in own or unit > bound.get(lang, unit):
                    continue
                own[unit] = text[i].as_py()
                if len(own) >= 2 * samples:
                    found[lang] = {u: own[u] for u in sorted(own)[:samples]}
                    bound[lang] = max(found[lang], default=unit)
        for lang, own in found.items():
            units = sorted(own)[:samples]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(units), pa.string()), pa.array(units, pa.int64()), pa.array([own[u] for u in units], pa.string())],
                names=["lang", "unit", "text"],
            )

    return run


def learn(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    samples: int = SAMPLES,
    sample_chars: int = SAMPLE_CHARS,
    dict_bytes: int = DICT_BYTES,
    all_bytes: int = ALL_BYTES,
) -> dict[str, bytes]:
    """Dictionary contents by language, most frequent first, from a bounded sample chosen by a hash."""
    rows = labelled.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).where("lang is not null and text is not null and text <> ''")
    # one row for each language
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return {}
    own_bytes = max(1, min(dict_bytes, all_bytes // len(counts)))
    chars = max(1, min(sample_chars, 4 * own_bytes // samples))
    start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
    pieces = rows.select("lang", F.xxhash64("text").alias("unit"), F.substr("text", start, F.lit(chars)).alias("text"))
    # the smallest hashes of each task's rows, then of all
    few = pieces.mapInArrow(_smallest(samples), "lang string, unit long, text string")
    by_lang = Window.partitionBy("lang").orderBy("unit")
    few = few.dropDuplicates(["lang", "unit"]).withColumn("place", F.row_number().over(by_lang)).where(F.col("place") <= samples)
    found: dict[str, list[bytes]] = {r.lang: [] for r in counts}
    for r in sorted(few.collect(), key=lambda r: r.place):
        found[r.lang].append(plain(r.text))
    return {lang: b" ".join(p[: own_bytes // len(parts)] for p in parts) for lang, parts in found.items() if parts}


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, contents: dict[str, bytes]):
        self.langs = list(contents)
        self.compressors = []
        for lang in self.langs:
            words = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def __call__(self, text: str | None) -> tuple[str, float, int]:
        """Language, score, and the margin in bytes."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0
        data = plain(text)
        if len(data) < SHORT:
            data = (data + b" ") * REPEATS
        sizes = [len(c.compress(data)) for c in self.compressors]
        best = min(sizes)
        score = 1 / sum(math.exp((best - s) / SCALE) for s in sizes)
        rest = sorted(sizes)[1:]
        return self.langs[sizes.index(best)], score, (rest[0] - best if rest else len(data))


def _classify(contents: dict[str, bytes], narrow: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(contents)
        for batch in batches:
            ids, column = batch.column("id"), batch.column("text")
            for begin in range(0, batch.num_rows, 512):
                found = [classify(t) for t in column.slice(begin, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(begin, 512),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([f[2] < narrow for f in found], pa.bool_()),
                    ],
                    names=["id", "lang_pred", "score", "margin", "rejected"],
                )

    return run


def identify(
    df: DataFrame, contents: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", narrow: int = NARROW
) -> DataFrame:
    """One row per row: id, lang_pred, score, margin, rejected."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _classify(contents, narrow), f"id {kind}, lang_pred string, score double, margin long, rejected boolean"
    ).withColumnRenamed("id", id_col)
