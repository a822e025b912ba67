"""Similarity self-join of documents: Jaccard similarity of their sets of 5-word shingles.

1. Documents with the same shingle set are one class; from here on classes are joined.
2. MinHash signatures of 128 values of 16 bits; classes that share one of 32 bands of four values are
   candidates (at similarity 0.8 a pair shares none with probability 5e-8).
3. Bayesian pruning: a candidate pair's values are compared 16 at a time; it is dropped as soon as the
   posterior probability (uniform prior) of a similarity at the threshold or above falls below
   ``TOLERANCE``. A pair is looked at only in the first band that it shares.
4. The rest is verified with the shingle sets themselves (48 bits of each shingle's hash).

A band's members beyond ``BLOCK`` are dealt into blocks, and each two blocks (a cell) go to a task of their own.
Step 4 works on units of bounded size: a cell in which many members have candidates is one, and what is found in
small cells is put together by its smallest member, who is in at most one cell of each band. A unit gets the sets
of its members and the candidates as bits (a large cell) or a list (else), and hands out counts, never a row for
a pair. So a group of g near copies sends about BANDS * g / BLOCK times its sets, and g * g / 16 bytes of bits.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A text of one to four words has one shingle, of all of them.

Defined results: documents without words are linked to nothing and are each other's copies in no sense:
their ``copy_id`` and ``class_id`` are their own id. Repeated rows are copies of each other. Rows without an
id take part; an id that is needed for them is the smallest of their copies, or null. Ids are whole
numbers. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .groups import Rows, groups, numbers, objects
from .tables import texts, written
from .words import WordReader, Words, grams, mix, portions

SHINGLE = 5
THRESHOLD = 0.8
HASHES, BANDS = 128, 32
STEP = 16
TOLERANCE = 1e-6
BLOCK = 512
#: members with candidates up to which a cell is put together with others
SMALL = 64
#: parts in which the members of a band's value are counted
PARTS = 64


def shingles(words: Words, d: int, runs: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of the d-th text; ``runs`` are the hashes of all 5-word runs."""
    begin, end = words.first[d], words.first[d + 1]
    if end - begin >= SHINGLE:
        return np.unique(runs[begin : end - SHINGLE + 1])
    return grams(words.number[begin:end], int(end - begin)) if end > begin else np.zeros(0, np.uint64)


def set_key(shingle: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers that name a set of shingles."""
    return np.array([mix(shingle).sum(dtype=np.uint64), mix(~shingle).sum(dtype=np.uint64)], np.uint64).view(np.int64)


def signature(shingle: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    high, low = (shingle >> np.uint64(32)).astype(np.uint32), shingle.astype(np.uint32)
    for i in range(0, len(shingle), 2048):
        values = high[i : i + 2048, None] * a + low[i : i + 2048, None] * b
        np.minimum(least, values.min(axis=0), out=least)
    return (least ^ (least >> np.uint32(16))).astype(np.uint16)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    a, b = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)).astype(np.uint32).reshape(2, HASHES) | np.uint32(1)
    return a, b


def _sketch(passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader()
        a, b = _factors()
        for batch in batches:
            for part, column in portions(batch.column("text")):
                words = reader(column)
                runs = grams(words.number, SHINGLE)
                sets = [shingles(words, d, runs) for d in range(len(column))]
                keys = [set_key(s) for s in sets]
                signed = [signature(s, a, b).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(part.start, part.stop - part.start) for c in passed),
                        pa.array([int(k[0]) for k in keys], pa.int64()),
                        pa.array([int(k[1]) for k in keys], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signed, pa.list_(pa.int64())),
                    ],
                    names=[*passed, "node", "node2", "n", "signature"],
                )

    return run


def needed_matches(threshold: float, tolerance: float) -> list[int]:
    """By number of compared values (in steps): the fewest equal ones with which a pair stays.

    With a uniform prior the similarity is Beta(m + 1, k - m + 1) after m of k; that it is at least t has the
    probability that k + 1 draws of chance t succeed m times at most.
    """
    out = []
    for k in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(k + 1):
            total += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return out


#: candidates of a node within a unit: bits over the unit's sorted nodes where it is a whole cell, else their nodes
NEAR = pa.schema([("unit", pa.int64()), ("node", pa.int64()), ("whole", pa.bool_()), ("near", pa.binary())])


def _similar_sizes(n: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9


def _candidates(threshold: float, tolerance: float, small: int):
    """Task code: within each cell of a band, the pairs that survive the pruning, by the unit that verifies them."""

    def arrays(batch: pa.RecordBatch):
        out = {c: numbers(batch, c) for c in ("band", "value", "p", "q", "node", "n", "block", "n_blocks")}
        out["signature"] = batch.column("signature").flatten().to_numpy().reshape(batch.num_rows, -1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = needed_matches(threshold, tolerance)
        rows = Rows(NEAR)
        for g in groups(batches, ("band", "value", "p", "q"), arrays):
            node, n, block, packed, band = g["node"], g["n"], g["block"], g["signature"], int(g["band"][0])
            values = np.ascontiguousarray(packed).view(np.uint16)
            if g["p"][0] == g["q"][0]:
                i, j = np.triu_indices(len(node), 1)
            else:
                one, two = np.flatnonzero(block == g["p"][0]), np.flatnonzero(block == g["q"][0])
                i, j = (x.ravel() for x in np.meshgrid(one, two, indexing="ij"))
            if not len(i):
                continue
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for k in range(0, len(i), 1 << 15):
                x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                stay = _similar_sizes(n, x, y, threshold)
                x, y = x[stay], y[stay]
                if band and len(x):
                    stay = ~(packed[x, :band] == packed[y, :band]).any(axis=1)
                    x, y = x[stay], y[stay]
                equal = np.zeros(len(x), np.int64)
                for step, least in enumerate(need):
                    if not len(x):
                        break
                    part = slice(step * STEP, (step + 1) * STEP)
                    equal += (values[x, part] == values[y, part]).sum(axis=1)
                    stay = equal >= least
                    x, y, equal = x[stay], y[stay], equal[stay]
                found.append((x, y))
            i, j = (np.concatenate(c) for c in zip(*found))
            if not len(i):
                continue
            low, high = node[np.minimum(i, j)], node[np.maximum(i, j)]  # a cell is sorted by node
            members = np.unique(np.concatenate((low, high)))
            i, j = np.searchsorted(members, low), np.searchsorted(members, high)
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            cuts = np.searchsorted(i, np.arange(len(members) + 1))
            whole = g["n_blocks"][0] > 1 or len(members) > small
            if whole:
                place = np.array([band, g["value"][0], g["p"][0], g["q"][0]], np.int64).view(np.uint64)
                units = np.repeat(grams(place, len(place)).view(np.int64), len(members))
            else:
                units = roots(members, i, j)
            for m, (unit, own) in enumerate(zip(units.tolist(), members.tolist())):
                others = j[cuts[m] : cuts[m + 1]]
                if whole:
                    bits = np.zeros(len(members), bool)
                    bits[others] = True
                    rows.add(unit, own, True, np.packbits(bits).tobytes())
                else:
                    rows.add(unit, own, False, members[others].tobytes())
            if rows.full():
                yield rows.batch()
        yield rows.batch()

    return run


def roots(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each place the smallest node that it is connected with by the pairs (i, j)."""
    low = node.copy()
    while len(i):
        both = np.minimum(low[i], low[j])
        before = low.copy()
        np.minimum.at(low, i, both)
        np.minimum.at(low, j, both)
        if (low == before).all():
            break
    return low


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: node and packed shingle set (six bytes each) of a text."""
    reader = WordReader()
    for batch in batches:
        for part, column in portions(batch.column("text")):
            words = reader(column)
            runs = grams(words.number, SHINGLE)
            sets = [shingles(words, d, runs) for d in range(len(column))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(set_key(s)[0]) for s in sets], pa.int64()),
                    pa.array([s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes() for s in sets], pa.binary()),
                ],
                names=["of", "packed"],
            )


def _verify(threshold: float):
    """Task code: exact similarity of the candidate pairs of each unit."""

    def arrays(batch: pa.RecordBatch):
        out = {c: numbers(batch, c) for c in ("unit", "node", "size", "whole")}
        return out | {c: objects(batch, c) for c in ("near", "packed")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("node", "n_classes", "n_docs", "root")
        rows = Rows(pa.schema([(c, pa.int64()) for c in fields]))
        for g in groups(batches, ("unit",), arrays):
            node, place = np.unique(g["node"], return_index=True)
            size, whole, near, packed = (g[c][place] for c in ("size", "whole", "near", "packed"))
            parts = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in packed]
            n = np.array([len(x) for x in parts])
            wide = np.zeros((n.sum(), 8), np.uint8)
            wide[:, :6] = np.concatenate(parts)
            distinct, ids = np.unique(wide.view(np.int64).ravel(), return_inverse=True)
            starts = np.concatenate(([0], np.cumsum(n)[:-1]))
            links: list[tuple[np.ndarray, np.ndarray]] = []
            for i in range(len(node)):
                if whole[i]:
                    bits = np.unpackbits(np.frombuffer(near[i], np.uint8), count=len(node))
                    j = np.flatnonzero(bits)
                else:
                    j = np.searchsorted(node, np.unique(np.frombuffer(near[i], np.int64)))
                if not len(j):
                    continue
                own = np.zeros(len(distinct), bool)
                own[ids[starts[i] : starts[i] + n[i]]] = True
                if len(j) * 4 > len(node):
                    common = np.add.reduceat(own[ids].view(np.int8), starts, dtype=np.int64)[j]
                else:
                    common = np.array([np.count_nonzero(own[ids[starts[x] : starts[x] + n[x]]]) for x in j])
                j = j[common >= threshold * (n[i] + n[j] - common) - 1e-9]
                links.append((np.full(len(j), i), j))
            if not links:
                continue
            i, j = (np.concatenate(c) for c in zip(*links))
            root = roots(node, i, j)
            a, b = np.concatenate((i, j)), np.concatenate((j, i))
            classes = np.bincount(a, minlength=len(node))
            docs = np.bincount(a, weights=size[b], minlength=len(node)).astype(np.int64)
            for m in np.flatnonzero(classes).tolist():
                rows.add(int(node[m]), int(classes[m]), int(docs[m]), int(root[m]))
            if rows.full():
                yield rows.batch()
        yield rows.batch()

    return run


def _dealt(rows: DataFrame, count: str, keys: list[str]) -> DataFrame:
    """Each row once for every cell (p, q) of blocks that its own block takes part in."""
    n_blocks = F.ceil(F.col(count) / BLOCK).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda x: F.struct(F.least("block", x).alias("p"), F.greatest("block", x).alias("q")),
    )
    dealt = (
        rows.withColumn("n_blocks", n_blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
        .withColumn("cell", F.explode(cells))
        .select("*", "cell.p", "cell.q")
        .drop("cell", count)
    )
    return dealt.repartition(*keys, "p", "q").sortWithinPartitions(*keys, "p", "q", "node")


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    rows = texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    passed = ["id", "row"] if keyed else ["id"]
    rows = rows.withColumn("row", F.xxhash64("text")) if keyed else rows
    kinds = "".join(f"{c} long, " for c in passed) + "node long, node2 long, n long, signature array<bigint>"
    return written(rows.mapInArrow(_sketch(passed), kinds), "jaccard-sketches")


def candidates(classes: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Pairs of classes that share a band and survive the pruning: (unit, node, whole, near), see ``NEAR``."""
    bands = classes.select("node", F.posexplode("signature").alias("band", "value"))
    # a value's members are counted part by part, so that no task gets all members of a frequent one
    parts = bands.groupBy("band", "value", F.pmod(F.xxhash64("node"), F.lit(PARTS)).alias("part"))
    parts = parts.agg(F.collect_list("node").alias("nodes"))
    count = F.sum(F.size("nodes")).over(Window.partitionBy("band", "value"))
    shared = parts.withColumn("members", count).where("members > 1")
    shared = shared.select("band", "value", "members", F.explode("nodes").alias("node"))
    members = shared.join(classes.select("node", "n", "signature"), "node")
    cells = _dealt(members, "members", ["band", "value"]).select(
        "band", "value", "p", "q", "node", "n", "block", "n_blocks", "signature"
    )
    kinds = "unit long, node long, whole boolean, near binary"
    return cells.mapInArrow(_candidates(threshold, tolerance, SMALL), kinds)


def links(
    docs: DataFrame,
    sketched: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, DataFrame]:
    """Classes (node, copy_id, size) and, of those with links, (node, n_classes, n_docs, root) by unit."""
    # of rows with a key of their own: the first of each class, rows without an id last
    lead = [F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "row")).alias("lead")] if "row" in sketched.columns else []
    classes = written(
        sketched.where("n > 0")
        .groupBy("node", "node2")
        .agg(
            F.min("id").alias("copy_id"),
            F.count("*").alias("size"),
            F.any_value("n").alias("n"),
            F.any_value("signature").alias("signature"),
            *lead,
        )
        .drop("node2"),
        "jaccard-classes",
    )
    near = written(candidates(classes, threshold, tolerance), "jaccard-near")
    joined = F.aggregate(F.collect_list("near"), F.lit(bytearray()), lambda all_, x: F.concat(all_, x))
    by_unit = near.groupBy("unit", "node").agg(joined.alias("near"), F.bool_or("whole").alias("whole"))
    wanted = near.select("node").distinct().join(classes, "node").select("node", "copy_id", "size")
    read = texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    sets = (
        read.join(wanted.select("copy_id").distinct(), F.col("id").eqNullSafe(F.col("copy_id")), "left_semi")
        .mapInArrow(_sets, "of long, packed binary")
        .withColumnRenamed("of", "node")
    )
    rows = by_unit.join(wanted.select("node", "size"), "node").join(sets, "node")
    rows = rows.select("unit", "node", "size", "whole", "near", "packed")
    units = rows.repartition("unit").sortWithinPartitions("unit", "node")
    found = units.mapInArrow(_verify(threshold), "node long, n_classes long, n_docs long, root long")
    return classes, written(found, "jaccard-links")


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    keyed: bool = False,
) -> DataFrame:
    """One row per row: id, copy_id (smallest id with the same shingles), class_id (smallest id in its group of
    linked documents) and n_links (other documents at the threshold or above, copies included).

    With ``keyed`` also row (xxhash64 of the text) and the struct ``lead``: id and row of the group's first
    document, by id (null last) and row; null for a document without words."""
    sketched = sketches(docs, id_col, text_col, keyed)
    lead = ["lead"] if keyed else []
    classes, found = links(docs, sketched, id_col, text_col, threshold, tolerance)
    sums = found.groupBy("node").agg(F.sum("n_docs").alias("linked"))
    group = components(found.select("node", "root"))
    group = group.join(classes.select("node", "copy_id", *lead), "node")
    lowest = group.groupBy("root").agg(F.min("copy_id").alias("class_id"), *[F.min(c).alias("class_lead") for c in lead])
    known = group.select("node", "root").join(lowest, "root").join(sums, "node")
    known = known.select("node", "class_id", "linked", *[f"class_{c}" for c in lead])
    # written, so that Spark can split the rows of a class with very many copies in the join that follows
    per_class = written(classes.select("node", "copy_id", "size", *lead).join(known, "node", "left"), "jaccard-classes")
    rows = sketched.select("id", "node", "n", *(["row"] if keyed else [])).join(
        per_class.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & (F.col("n") > 0), "left"
    )
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("class_id", "copy_id", "id").alias("class_id"),
        (F.coalesce("size", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        *([F.col("row"), F.coalesce("class_lead", "lead").alias("lead")] if keyed else []),
    )


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s
  FROM d, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS u(i) WHERE len(w) > 0
), size AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT x, y, c = nx.n AND c = ny.n AS same
  FROM pair JOIN size nx ON nx.doc_id = x JOIN size ny ON ny.doc_id = y WHERE 10 * c >= 8 * (nx.n + ny.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS low FROM d
  UNION
  SELECT link.y, reach.low FROM reach JOIN link ON link.x = reach.x WHERE reach.low < link.y
), group_of AS (
  SELECT x AS doc_id, min(low) AS class_id FROM reach GROUP BY x
), counts AS (
  SELECT x AS doc_id, count(*) AS n_links, min(CASE WHEN same THEN y END) AS copy FROM link GROUP BY x
)
SELECT doc_id, least(doc_id, coalesce(copy, doc_id)) AS copy_id, class_id, coalesce(n_links, 0) AS n_links
FROM group_of LEFT JOIN counts USING (doc_id)"""
