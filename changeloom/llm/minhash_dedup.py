"""Near-duplicate groups: minima of universal hashes, bands, signatures, exact sets, connected components.

1. A document's set are its distinct shingles of ``SHINGLE`` words, lower-cased (A-Z); a shorter document's whole
   sequence is its one shingle. Documents with equal sets are one class; from here on classes are linked.
2. A class's signature are the minima of ``HASHES`` multiply-shift hashes of its shingles. Classes that share a band
   of ``ROWS`` minima are in one bucket (at a similarity of 0.8 two classes share none of 32 bands with
   probability 5e-8).
3. In a bucket signatures are compared; two that agree in fewer places than ``needed`` says are apart (a pair at the
   threshold agrees in fewer with probability 1e-9). What is left, with its alternating star components, are units.
4. In a unit the sets themselves are compared, and the links that hold are joined to components in the same way.

Only components are asked for, so a pair whose ends are already connected isn't compared. The members of a large
bucket or unit are dealt into blocks of ``BLOCK``; each block also gets up to four hubs, the same ones for all, so
that a group of near copies is one component after the first round. Only where a bucket or unit still has several
components, the members outside its largest one meet all members of other components, block by block
(``_second_round``). So no link is lost, no pair is listed, and a group's work grows with its size where its
members are alike.

Shingles and classes are known by hashes of 64 and 128 bits. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined results: documents without words (null, empty) have no shingles, are linked to nothing and kept. Rows that
repeat an id are documents of their own. Rows without an id take part; ``component_id`` is the smallest id that a
component has, null where it has none, and a document is kept where its id is its component's (a null one only
where no member has an id). Ids are whole numbers. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .groups import Arrays, numbers, objects
from .tables import texts, written
from .words import WordReader, Words, grams, mix, portions

SHINGLE = 2
THRESHOLD = 0.8
HASHES, ROWS = 128, 4
#: chance with which a pair at the threshold may be taken for one below it by its signature
TOLERANCE = 1e-9
#: members of a bucket or unit that one comparison holds, and shingles of them
BLOCK = 64
BLOCK_SHINGLES = 1 << 22
#: ids that are sent to all tasks at most (8 bytes each); more are joined by a shuffle
SENT = 1 << 19
LINK = "node long, root long"


def needed(threshold: float, tolerance: float = TOLERANCE) -> int:
    """Fewest equal minima with which a pair stays: fewer have at most the chance ``tolerance`` at the threshold."""
    total = 0.0
    for m in range(HASHES + 1):
        total += comb(HASHES, m) * threshold**m * (1 - threshold) ** (HASHES - m)
        if total > tolerance:
            return m
    return HASHES


def shingles(words: Words, d: int, runs: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of the d-th text; ``runs`` are the hashes of all runs of ``SHINGLE`` words."""
    begin, end = int(words.first[d]), int(words.first[d + 1])
    if end - begin >= SHINGLE:
        return np.unique(runs[begin : end - SHINGLE + 1])
    return grams(words.number[begin:end], end - begin) if end > begin else np.zeros(0, np.uint64)


def class_key(shingle: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set of shingles."""
    both = np.array([mix(shingle).sum(dtype=np.uint64), mix(shingle ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)])
    return tuple(mix(both + np.uint64(len(shingle))).view(np.int64).tolist())


def signature(shingle: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of each hash (a * x + b) >> 32 of the shingles' upper halves, folded to 16 bits."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    x = shingle >> np.uint64(32)
    for i in range(0, len(x), 1024):
        values = x[i : i + 1024, None] * a
        values += b
        values >>= np.uint64(32)
        np.minimum(least, values.min(axis=0), out=least)
    return (least ^ (least >> np.uint64(16))).astype(np.uint16)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    a, b = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)).reshape(2, HASHES)
    return a | np.uint64(1), b


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, slice, list[np.ndarray]]]:
    reader = WordReader(lower=True)
    for batch in batches:
        for part, column in portions(batch.column("text")):
            words = reader(column)
            runs = grams(words.number, SHINGLE)
            yield batch, part, [shingles(words, d, runs) for d in range(len(column))]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: id, class, number of shingles and signature of each text."""
    a, b = _factors()
    for batch, part, sets in _read(batches):
        keys = [class_key(s) for s in sets]
        signed = [signature(s, a, b).view(np.int64) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").slice(part.start, part.stop - part.start),
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(signed, pa.list_(pa.int64())),
            ],
            names=["id", "node", "node2", "n", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: class and packed shingles of each text."""
    for _, _, sets in _read(batches):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([class_key(s)[0] for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["of", "packed"],
        )


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], arrays: Callable[[pa.RecordBatch], Arrays], size: int = 1 << 13
) -> Iterator[tuple[Arrays, np.ndarray]]:
    """Many groups at a time (of some ``size`` rows, less where they have sets), never a part of one: the rows' arrays
    and each row's group number."""
    held: list[Arrays] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(arrays(batch))
        n += batch.num_rows + (int(held[-1]["n"].sum()) // BLOCK if "packed" in held[-1] else 0)
        if n >= size:
            now = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            change = np.flatnonzero(np.any([now[k][1:] != now[k][:-1] for k in keys], axis=0)) + 1
            if len(change):
                cut = int(change[-1])
                yield _numbered({c: x[:cut] for c, x in now.items()}, keys)
                now = {c: x[cut:] for c, x in now.items()}
            held, n = [now], 0
    if held:
        yield _numbered({c: np.concatenate([h[c] for h in held]) for c in held[0]}, keys)


def _numbered(now: Arrays, keys: tuple[str, ...]) -> tuple[Arrays, np.ndarray]:
    new = np.any([now[k][1:] != now[k][:-1] for k in keys], axis=0)
    return now, np.concatenate(([0], np.cumsum(new)))


def connect(low: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``low`` names each place's component by a place in it; the result also joins i with j."""
    while len(i):
        i, j = low[i], low[j]
        apart = i != j
        i, j = i[apart], j[apart]
        np.minimum.at(low, np.maximum(i, j), np.minimum(i, j))
        while not (low[low] == low).all():
            low = low[low]
    return low


def _compare(rest: bool, alike: Callable[[Arrays, np.ndarray, np.ndarray], np.ndarray], arrays, keys: tuple[str, ...]):
    """Task code: within each group, links of rows that are alike, each member with the first of its component.

    Rows of one group are compared at distance 1, 2, ... for the whole batch at once, until all that are in one
    group are connected or compared. With ``rest`` only pairs of known components (``root``) are left out and
    only those with a member outside the group's largest component are looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, group in whole_groups(batches, keys, arrays):
            n = len(group)
            low = np.arange(n)
            if rest:  # rows of one known component are one from the start
                order = np.lexsort((g["root"], group))
                same = (group[order][1:] == group[order][:-1]) & (g["root"][order][1:] == g["root"][order][:-1])
                low = connect(low, order[:-1][same], order[1:][same])
            began = low.copy()
            last = np.append(np.flatnonzero(group[1:] != group[:-1]), n - 1)[group]
            open_ = np.flatnonzero(last > np.arange(n))
            for lag in range(1, n):
                open_ = open_[open_ + lag <= last[open_]]
                if not len(open_):
                    break
                i = open_[low[open_] != low[open_ + lag]]
                if rest:
                    i = i[g["rest"][i] | g["rest"][i + lag]]
                j = i + lag
                stay = alike(g, i, j)
                low = connect(low, i[stay], j[stay])
            linked = np.flatnonzero(low != began)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g["node"][linked], pa.int64()), pa.array(g["node"][low[linked]], pa.int64())], names=["node", "root"]
            )

    return run


def _sizes(g: Arrays, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum(g["n"][i], g["n"][j]) >= threshold * np.maximum(g["n"][i], g["n"][j]) - 1e-9


def _alike_signatures(threshold: float):
    least = needed(threshold)

    def alike(g: Arrays, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = _sizes(g, i, j, threshold)
        x, y = i[out], j[out]
        out[out] = (g["signature"][x] == g["signature"][y]).sum(axis=1) >= least
        return out

    return alike


def _alike_sets(threshold: float):
    signatures = _alike_signatures(threshold)

    def alike(g: Arrays, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = signatures(g, i, j)
        for k in np.flatnonzero(out).tolist():
            a, b = (np.frombuffer(g["packed"][x[k]], np.uint64) for x in (i, j))
            if len(b) < len(a):
                a, b = b, a
            at = np.searchsorted(b, a)
            common = np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)
            out[k] = common >= threshold * (len(a) + len(b) - common) - 1e-9
        return out

    return alike


def _arrays(columns: tuple[str, ...]):
    def arrays(batch: pa.RecordBatch) -> Arrays:
        out = {c: numbers(batch, c) for c in columns if c not in ("signature", "packed")}
        packed = batch.column("signature").flatten().to_numpy()
        out["signature"] = packed.reshape(batch.num_rows, -1).view(np.uint16)
        if "packed" in columns:
            out["packed"] = objects(batch, "packed")
        return out

    return arrays


def _counted(members: DataFrame) -> DataFrame:
    """Rows (key, node, n) of the keys that have several, with the key's number of blocks and its hubs."""
    other = F.xxhash64("node")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    large = members.groupBy(F.col("key").alias("of")).agg(
        F.min("node").alias("h1"), F.max("node").alias("h2"), F.min(other).alias("h3"), F.max(other).alias("h4"), blocks.alias("n_blocks")
    )
    found = members.join(large.where("h1 <> h2"), F.col("key") == F.col("of"))
    hub = F.col("node").isin(F.col("h1"), F.col("h2")) | other.isin(F.col("h3"), F.col("h4"))
    return found.select("key", "node", "n_blocks", hub.alias("hub"))


def _block(n_blocks: str, salt: int):
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n_blocks)).cast("int")


def _first_round(counted: DataFrame) -> DataFrame:
    """Each member in its block, hubs in all blocks of their key."""
    own = F.array(_block("n_blocks", 0))
    blocks = F.when(F.col("hub"), F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(own)
    return counted.select("key", "node", F.explode(blocks).alias("block"))


def _second_round(counted: DataFrame, known: DataFrame) -> DataFrame | None:
    """Cells of the keys of several blocks that are more than one component: members outside the largest, by blocks,
    against all members, by blocks."""
    rows = counted.where("n_blocks > 1").join(known.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    rows = rows.select("key", "node", "n_blocks", F.coalesce("root", "node").alias("root"))
    per = rows.groupBy("key", "root").agg(F.count("*").alias("c"))
    per = per.groupBy(F.col("key").alias("of")).agg(
        F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("all"), F.count("*").alias("roots")
    )
    per = per.where("roots > 1").withColumn("n_rest", F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int"))
    open_ = written(rows.join(per, F.col("key") == F.col("of")).withColumn("rest", F.col("root") != F.col("top.root")), "minhash-open")
    if open_.isEmpty():
        return None
    every = open_.withColumn("q", _block("n_blocks", 0)).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1)))
    outside = open_.where("rest").withColumn("p", _block("n_rest", 1))
    outside = outside.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    cells = [x.select("key", "p", "q", "node", "root", (F.col("rest") if i else F.lit(False)).alias("rest")) for i, x in enumerate((every, outside))]
    return cells[0].union(cells[1])


def _linked(members: DataFrame, payload: DataFrame, alike, columns: tuple[str, ...], purpose: str) -> DataFrame:
    """(node, root) of the components of the members (key, node, n) that are alike within a key."""
    counted = written(_counted(members), f"minhash-{purpose}")
    of = payload.withColumnRenamed("node", "of")

    def found(dealt: DataFrame, keys: tuple[str, ...], more: tuple[str, ...] = ()) -> DataFrame:
        rows = dealt.join(of, F.col("node") == F.col("of")).select(*keys, "node", *more, *columns)
        rows = rows.repartition(*keys).sortWithinPartitions(*keys, "node")
        run = _compare(bool(more), alike, _arrays((*keys, "node", *more, *columns)), keys)
        return written(rows.mapInArrow(run, LINK), f"minhash-{purpose}-links")

    links = found(_first_round(counted), ("key", "block"))
    known = components(links)
    cells = _second_round(counted, known)
    if cells is None:
        return known
    return components(links.union(found(cells, ("key", "p", "q"), ("root", "rest"))))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: id, n_shingles, component_id and kept; see the module."""
    read = texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    kinds = "id long, node long, node2 long, n long, signature array<bigint>"
    sketched = written(read.mapInArrow(_sketch, kinds), "minhash-sketches")
    signed = sketched.where("n > 0").groupBy("node", "node2")
    classes = written(
        signed.agg(F.min("id").alias("least"), F.any_value("n").alias("n"), F.any_value("signature").alias("signature")).drop("node2"),
        "minhash-classes",
    )
    bands = classes.select("node", "n", F.posexplode("signature").alias("band", "value"))
    bands = bands.select(F.xxhash64("band", "value").alias("key"), "node", "n")
    units = _linked(bands, classes.select("node", "n", "signature"), _alike_signatures(threshold), ("n", "signature"), "bands")
    units = written(units.join(classes.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).drop("of"), "minhash-units")
    # one text of each class that is in a unit
    wanted = units.select(F.col("least").alias("wanted")).distinct()
    if units.count() <= SENT:
        wanted = F.broadcast(wanted)
    sets = read.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets = sets.mapInArrow(_sets, "of long, packed binary").groupBy("of").agg(F.any_value("packed").alias("packed"))
    payload = units.join(sets, F.col("node") == F.col("of")).select("node", "n", "signature", "packed")
    payload = written(payload, "minhash-sets")
    members = units.select(F.col("root").alias("key"), "node", "n")
    group = _linked(members, payload, _alike_sets(threshold), ("n", "signature", "packed"), "units")

    rooted = group.join(classes.select(F.col("node").alias("of"), "least"), F.col("node") == F.col("of"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = rooted.select("node", "root").join(lowest, "root").select("node", "component")
    # written, so that Spark can split the rows of a class with very many copies in the join that follows
    per_class = classes.select("node", "least").join(known, "node", "left")
    per_class = written(per_class.select(F.col("node").alias("of"), F.coalesce("component", "least").alias("component")), "minhash-classes")
    rows = sketched.select("id", "node", "n").join(per_class, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w
  FROM documents
), d AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w
), one AS MATERIALIZED (
  SELECT list_sort(s) AS s, min(doc_id) AS doc_id, len(s) AS n FROM d WHERE len(s) > 0 GROUP BY ALL
), sh AS MATERIALIZED (
  SELECT doc_id, n, unnest(s) AS x FROM one
), rare AS (
  SELECT doc_id, sh.x, row_number() OVER (PARTITION BY doc_id ORDER BY df, sh.x) AS r, n
  FROM sh JOIN (SELECT x, count(*) AS df FROM sh GROUP BY x) AS f ON f.x = sh.x
), lead AS MATERIALIZED (
  SELECT doc_id, x, n FROM rare WHERE r <= n - (80 * n + 99) // 100 + 1
), pair AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y
  FROM lead a JOIN lead b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), link AS MATERIALIZED (
  SELECT x, y FROM (
    SELECT x, y, len(list_intersect(a.s, b.s)) AS c, a.n + b.n AS n
    FROM pair JOIN one a ON a.doc_id = x JOIN one b ON b.doc_id = y
  ) WHERE 100 * c >= 80 * (n - c)
), both_ways AS MATERIALIZED (
  SELECT x, y FROM link UNION SELECT y, x FROM link
), reach AS (
  SELECT doc_id AS x, doc_id AS low FROM one
  UNION
  SELECT l.y, reach.low FROM reach JOIN both_ways l ON l.x = reach.x WHERE reach.low < l.y
), root AS (
  SELECT x, min(low) AS low FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(low, d.doc_id) AS component_id, d.doc_id = coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN one ON one.s = list_sort(d.s) AND len(d.s) > 0 LEFT JOIN root ON root.x = one.doc_id"""
