"""Toxic passages: maximum-scoring segments over token log-odds.

A token's score is the log-odds of its share of the tokens of toxic against other labelled documents,
with a Dirichlet prior in proportion to its share of all of them. Occurrences between the same two
neighbours count once, so that copies, shared passages and repeated words don't weigh more. Every
token costs ``DRIFT``; one whose log-odds are less than ``MIN_Z`` standard errors adds nothing to that. A linear-time scan finds all maximal
segments of a document. The number of segments of at least such a score that chance would give,
K m exp(-lambda s) for m tokens, has lambda from the token scores of clean documents and K from
their best segments; the r best segments together count as the chance of r or more of them, and the
least such chance decides. The chance at which the score reaches 0.7 is the one that
parts the training rows best.

Model: at most ``max_rows`` labelled documents (those with the smallest hash) and ``max_terms`` tokens.
Tokens are lower-cased runs of letters and digits. Only the rows passed for training are learned from.

Defined results: null and empty texts have no segment and the score of chance 1 (the lowest, above
0); with no toxic training row every score is 0. Repeated rows are scored each; a document's label
counts once however often its label row is repeated (1 wins over 0); other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts, written
from .words import NOT_ALNUM, WordReader, mix, portions

MAX_ROWS = 12_000
MAX_TERMS = 20_000
#: weight of the prior: this part of all counted tokens
PRIOR = 0.1
MIN_Z = 3.0
DRIFT = 0.7
TOXIC = 0.7
#: a segment is reported where chance would give so many in the document
SIGNIFICANT = 0.05


@dataclass
class Model:
    token: np.ndarray  # sorted
    score: np.ndarray
    drift: float
    decay: float  # lambda
    rate: float  # K
    cut: float  # the chance at which the score is TOXIC


def segments(places: Sequence[int], gains: Sequence[float], drift: float) -> list[tuple[float, int, int]]:
    """All maximal segments (score, first, last) of a row of numbers that is -drift but at some places.

    Only places with a gain above zero can start or end one, so these are walked alone. Of the
    segments so far, each remembers the nearest earlier one that began lower, so every link is
    followed a bounded number of times in all.
    """
    left: list[float] = []
    right: list[float] = []
    begin: list[int] = []
    end: list[int] = []
    lower: list[int] = []
    total, before = 0.0, -1
    for place, gain in zip(places, gains):
        total -= drift * (place - before - 1)
        before = place
        low, total = total, total + gain
        if gain <= 0:
            continue
        first = place
        while True:
            k = len(left) - 1
            while k >= 0 and left[k] >= low:
                k = lower[k]
            if k < 0 or right[k] >= total:
                break
            low, first = left[k], begin[k]
            for column in (left, right, begin, end, lower):
                del column[k:]
        left.append(low)
        right.append(total)
        begin.append(first)
        end.append(place)
        lower.append(k)
    return [(r - x, a, b) for x, r, a, b in zip(left, right, begin, end)]


def token_reader() -> WordReader:
    return WordReader(NOT_ALNUM)  # of lower-cased texts


def scan(texts_: Sequence[str | None], model_token, model_score, drift: float, reader: WordReader):
    """For each text: number of tokens and its segments."""
    words = reader([t.lower() if t else t for t in texts_])
    at = np.searchsorted(model_token, words.number)
    at[at == len(model_token)] = 0
    known = np.flatnonzero(model_token[at] == words.number) if len(model_token) else np.zeros(0, int)
    gains = model_score[at[known]] if len(known) else np.zeros(0)
    cuts = np.searchsorted(known, words.first)
    for d in range(len(texts_)):
        part = slice(cuts[d], cuts[d + 1])
        places = (known[part] - words.first[d]).tolist()
        yield int(words.first[d + 1] - words.first[d]), segments(places, gains[part].tolist(), drift)


def chance(scores: Sequence[float], n_tokens: int, decay: float, rate: float) -> float:
    """The least chance, over r, that clean text of this length has r segments as good as the r-th best.

    The number of such segments is Poisson with the expected number e. For e < r the chance of r or more is the
    r-th term and the falling ones after it, in logarithms; a term that isn't below the least chance so far settles
    it, so that few sums are taken however many segments there are."""
    least = 1.0
    begin = math.log(rate * max(n_tokens, 1)) if rate > 0 else -math.inf
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        log_expected = begin - decay * s
        expected = math.exp(min(log_expected, 700.0))
        if expected >= r:  # then it can't be small
            continue
        term = math.exp(r * log_expected - expected - math.lgamma(r + 1)) if expected > 0 else 0.0
        if term >= least:
            continue
        tail, k = term, r
        while term > 1e-15 * tail:
            k += 1
            term *= expected / k
            tail += term
        least = min(least, tail)
    return least


def score_of(p: float, cut: float) -> float:
    """TOXIC at p = cut, near 1 for a smaller chance and near 0 for a larger one."""
    if p <= 0:
        return 1.0
    return 1 / (1 + (1 - TOXIC) / TOXIC * math.sqrt(p / cut))


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens with the number of both neighbours, once for each label in a portion."""
    reader = token_reader()
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for part, column in portions(batch.column("text")):
            words = reader([t.lower() if t else t for t in column])
            n = len(words.number)
            around = np.zeros((2, n), np.uint64)
            same = words.doc[1:] == words.doc[:-1]
            around[0, 1:][same] = words.number[:-1][same]
            around[1, :-1][same] = words.number[1:][same]
            context = mix(around[0] * np.uint64(3) + around[1])
            label = toxic[part][words.doc].astype(np.int32)
            _, first = np.unique(mix(context + words.number) + label.astype(np.uint64), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[first]) for x in (words.number.view(np.int64), context.view(np.int64), label)],
                names=["token", "context", "toxic"],
            )


def _scored(token: np.ndarray, score: np.ndarray, drift: float):
    """Task code: label, number of tokens and the scores of all segments of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = token_reader()
        for batch in batches:
            for part, column in portions(batch.column("text")):
                found = [(n, [x[0] for x in s]) for n, s in scan(column, token, score, drift, reader)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic").slice(part.start, part.stop - part.start),
                        pa.array([f[0] for f in found], pa.int64()),
                        pa.array([f[1] for f in found], pa.list_(pa.float64())),
                    ],
                    names=["toxic", "n", "scores"],
                )

    return run


def _chances(decay: float, rate: float):
    """Task code: label and chance of each scored row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("scores").to_pylist(), batch.column("n").to_pylist())
            found = pa.array([chance(s, n, decay, rate) for s, n in rows], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), found], names=["toxic", "chance"])

    return run


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """Texts and labels of at most max_rows labelled documents."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    chosen = known.withColumn("unit", unit).orderBy("unit", "id").limit(max_rows).drop("unit")
    return texts(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("text", "toxic").dropDuplicates()


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
    max_terms: int = MAX_TERMS,
    drift: float = DRIFT,
) -> Model | None:
    """The model of the labelled rows; None if none of them is toxic or none is clean."""
    rows = sample(docs, labels, id_col, text_col, label_col, max_rows)
    tokens = rows.mapInArrow(_count_tokens, "token long, context long, toxic int").dropDuplicates()
    counts = tokens.groupBy("token").agg(
        F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0")
    )
    counts = written(counts, "toxicity")
    n = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not n.n1 or not n.n0:
        return None
    prior, all_prior = PRIOR * (F.col("n1") + F.col("n0")), PRIOR * (n.n1 + n.n0)
    odds = [F.log((F.col(c) + prior) / (n[c] + all_prior - F.col(c) - prior + 1e-9)) for c in ("n1", "n0")]
    error = F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior))
    scored = counts.where("n1 + n0 >= 3").withColumn("score", odds[0] - odds[1]).withColumn("z", F.col("score") / error)
    strong = scored.withColumn("score", F.col("score") - drift).where((F.col("z") >= MIN_Z) & (F.col("score") > 0))
    terms = strong.orderBy(F.desc("z"), "token").limit(max_terms).select("token", "score", "n0").collect()
    order = sorted(terms, key=lambda r: r.token & (2**64 - 1))
    token = np.array([r.token & (2**64 - 1) for r in order], np.uint64)
    score = np.array([r.score for r in order])
    decay = _decay([(r.score, r.n0 / n.n0) for r in terms], drift)
    scored = written(rows.mapInArrow(_scored(token, score, drift), "toxic int, n long, scores array<double>"), "toxicity")
    clean = scored.where("toxic = 0 and n > 0").select("n", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("best"))
    weight = [r.n * math.exp(-decay * r.best) for r in clean.collect()]
    rate = len(weight) / max(sum(weight), 1e-9)
    judged = scored.mapInArrow(_chances(decay, rate), "toxic int, chance double").collect()
    chances = sorted((r.chance, r.toxic) for r in judged)
    return Model(token, score, drift, decay, rate, _best_cut(chances))


def _decay(terms: Sequence[tuple[float, float]], drift: float) -> float:
    """lambda > 0 with sum p exp(lambda s) = 1 over the scores of clean tokens."""
    rest = max(0.0, 1 - sum(p for _, p in terms))
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        value = rest * math.exp(-middle * drift) + sum(p * math.exp(min(middle * s, 500)) for s, p in terms)
        low, high = (middle, high) if value < 1 else (low, middle)
    return max(low, 0.05)


def _best_cut(chances: Sequence[tuple[float, int]]) -> float:
    """The chance up to which calling rows toxic makes the fewest errors; the middle of that step, by its logarithm."""
    errors = sum(t for _, t in chances)
    best, cut = errors, 1e-12
    for k, (p, toxic) in enumerate(chances):
        errors += -1 if toxic else 1
        after = chances[k + 1][0] if k + 1 < len(chances) else 1.0
        if errors < best and after > p:
            best, cut = errors, math.sqrt(max(p, 1e-12) * max(after, 1e-12))
    return min(max(cut, 1e-12), 0.5)


def _score(model: Model | None, passed: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = token_reader()
        for batch in batches:
            for part, column in portions(batch.column("text")):
                out: dict[str, list] = {"n_tokens": [], "score": [], "segment_start": [], "segment_end": []}
                none = ((0, []) for _ in column)
                for n, found in scan(column, model.token, model.score, model.drift, reader) if model else none:
                    p = chance([s for s, _, _ in found], n, model.decay, model.rate) if model else 1.0
                    real = [x for x in found if model.rate * n * math.exp(-model.decay * x[0]) <= SIGNIFICANT]
                    for name, value in zip(
                        out, (n, score_of(p, model.cut) if model else 0.0, [x[1] for x in real], [x[2] + 1 for x in real])
                    ):
                        out[name].append(value)
                kinds = (pa.int64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in passed), *(pa.array(v, k) for v, k in zip(out.values(), kinds))],
                    names=[*passed, *out],
                )

    return run


def score(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per row: id, n_tokens, score, and the significant segments as token positions.

    With ``keep``, names of columns of the input, these come back in the struct ``kept`` and the text in ``text``.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *kept)
    passed = ["id", "text", "kept"] if keep else ["id"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in passed)
    scored = rows.mapInArrow(
        _score(model, passed), kinds + ", n_tokens long, score double, segment_start array<int>, segment_end array<int>"
    )
    return scored.withColumnRenamed("id", id_col)
