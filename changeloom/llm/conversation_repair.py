"""Conversations repaired at the least cost, by a Viterbi search whose survivors are let go as soon as they agree.

A conversation's rows, by turn (nulls first), role and text, are edited so that the initials of its roles read
``(s?(ua)+)?``: a row is kept (cost 0, its initial must fit), given the role user or assistant (3), or deleted (4, the only
way for a blank row or one whose role and text stand earlier); an empty row of either role may be put in anywhere (3). A row
that stays although its text doesn't end in ``[.!?]`` costs 3 more. Of equally cheap repairs that one is taken whose
``audit``, the edits' initials (K, R, D, I) in order, is least as ASCII.

``Survivors`` holds the best path into each state as leaves of one tree of back pointers. A node counts the nodes
that point to it and goes with the last of them; what all survivors have in common is handed out at once, so that
the tree holds only what is open; a path that is dearer than another by more than any way on could make good is
no survivor. Paths of equal cost are told apart by their whole open strings: a survivor knows
its place among them (no survivor's string begins another's, as each ends in an edit of the same row), and
a longer string sorts by its predecessor's place and then by its own last edits.

No conversation is one task's work: rows are sorted over all partitions, and every ``CHUNK`` rows of a conversation are
searched on their own from each state they may be entered in. A chunk's costs and the order of its strings are a few
numbers; a second search runs over these, conversation by conversation, and chooses each chunk's way. Rows that
are equal in all columns travel as one row with their number.

Defined results: a null role or text counts as one blank, a null turn comes first, rows without a conversation id are the
conversation of that id (null). A conversation without rows needs no edits. Rows that are repeated as they are
are each other's duplicates. Very long conversations pass through ``digest`` row by row, in one task's time but not in its
memory. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

#: where a path stands: nothing yet, after a system turn, after a user turn, after an assistant turn
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
DONE = (BEGIN, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: what may follow: state and initial to state
NEXT = {
    (BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: rows, and bytes of text, that are searched and held at a time
CHUNK, CHUNK_BYTES = 256, 1 << 20
BLANK = r"[^\x20\x09-\x0D]"


#: what it costs at most more to go on from the first state in place of the second, however the rows go on: insertions
#: that lead there, or a system turn that is deleted
DEARER = {
    (BEGIN, SYSTEM): 0, (BEGIN, USER): 3, (BEGIN, ASSISTANT): 0, (SYSTEM, BEGIN): 6, (SYSTEM, USER): 3, (SYSTEM, ASSISTANT): 6,
    (USER, BEGIN): 7, (USER, SYSTEM): 3, (USER, ASSISTANT): 3, (ASSISTANT, BEGIN): 4, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 3,
}


def _inserted() -> dict[int, list[tuple[str, int]]]:
    """For each state the states that insertions lead to, with their edits; more than three never pay."""
    out = {}
    for state in STATES:
        found = [("", state)]
        for n in (1, 2, 3):
            for roles in product("ua", repeat=n):
                s = state
                for r in roles:
                    s = NEXT.get((s, r))
                    if s is None:
                        break
                if s is not None:
                    found.append(("I" * n, s))
        out[state] = found
    return out


INSERTED = _inserted()


def _steps(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) of a row: insertions before it and its own edit."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for state in STATES:
        for before, s in INSERTED[state]:
            paid = INSERT * len(before)
            ways = [(DELETE, "D", s)]
            if not must_go:
                more = TRUNCATED if truncated else 0
                if (s, initial) in NEXT:
                    ways.append((more, "K", NEXT[s, initial]))
                ways += [(REROLE + more, "R", NEXT[s, r]) for r in ROLES if (s, r) in NEXT]
            for cost, edit, to in ways:
                way = (paid + cost, before + edit)
                best[state, to] = min(best.get((state, to), way), way)
    return [(a, b, cost, edits) for (a, b), (cost, edits) in best.items()]


STEPS = {(i, g, t): _steps(i, g, t) for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


@dataclass(slots=True)
class Node:
    """A place in the tree of back pointers: what was done last, and how many nodes (and leaves) point here."""

    before: Node | None
    done: object
    uses: int = 0


@dataclass(slots=True)
class Survivor:
    cost: int
    place: int  # of its open string among the survivors'
    leaf: Node


@dataclass
class Survivors:
    """The best paths into each state; ``settled`` collects what they have in common."""

    now: dict[int, Survivor]
    root: Node
    settled: list = field(default_factory=list)
    held: int = 0  # nodes in the tree

    @classmethod
    def at(cls, state: int) -> Survivors:
        root = Node(None, None, uses=1)
        return cls({state: Survivor(0, 0, root)}, root)

    def step(self, ways: Iterable[tuple[int, int, int, object, object]]) -> None:
        """Take one step further: ways (from, to, cost, what is done, what it sorts by) between states."""
        best: dict[int, tuple[int, int, object, object, Node]] = {}
        for a, b, cost, done, by in ways:
            if (s := self.now.get(a)) is not None:
                way = (s.cost + cost, s.place, by)
                if b not in best or way < best[b][:3]:
                    best[b] = (*way, done, s.leaf)
        # a path that can't become the best one, nor as good as that, is no survivor
        least = {b: way[0] for b, way in best.items()}
        for b, cost in least.items():
            if any(least[a] + more < cost for (a, x), more in DEARER.items() if x == b and a in least):
                del best[b]
        order = sorted((place, by, b) for b, (_, place, by, _, _) in best.items())
        before = [s.leaf for s in self.now.values()]
        self.now = {}
        for i, (_, _, b) in enumerate(order):
            cost, _, _, done, leaf = best[b]
            leaf.uses += 1
            self.held += 1
            self.now[b] = Survivor(cost, i, Node(leaf, done, uses=1))
        for leaf in before:
            self._release(leaf)
        self._settle()

    def _release(self, node: Node) -> None:
        """Give up one use of a node; without any it goes, and gives up its own."""
        node.uses -= 1
        while not node.uses and node is not self.root:
            self.held -= 1
            before, node.before = node.before, None
            node = before
            node.uses -= 1

    def _settle(self) -> None:
        """Hand out what follows the root as long as nothing else follows it."""
        if self.root.uses > 1:
            return
        chain, node = [], next(iter(self.now.values())).leaf
        while node is not self.root:
            chain.append(node)
            node = node.before
        for child in reversed(chain):
            self.settled.append(child.done)
            self.held -= 1
            child.before, self.root = None, child
            if child.uses > 1:
                return

    def _open(self, leaf: Node) -> list:
        out = []
        while leaf is not self.root:
            out.append(leaf.done)
            leaf = leaf.before
        return out[::-1]

    def path(self, state: int) -> list:
        return self.settled + self._open(self.now[state].leaf)


def ending(survivors: Survivors) -> tuple[int, int, str]:
    """State, cost and last insertions of the best whole path."""
    ways = []
    for state, s in survivors.now.items():
        ways += [(s.cost + INSERT * len(i), s.place, i, state) for i, to in INSERTED[state] if to in DONE]
    cost, _, inserted, state = min(ways)
    return state, cost, inserted


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def apply_edits(state: int, edits: Iterable[str], rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str, int]]:
    """(edit, role, text, state after it) of each row that the edits, entered in ``state``, leave or put in."""
    rows = iter(rows)
    for edit in edits:
        if edit == "I":
            role, text = ROLES["a" if state == USER else "u"], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES["a" if state == USER else "u"]
        state = NEXT[state, initial(role)]
        yield edit, role, text, state


# --- rows ------------------------------------------------------------------------------------


def _blank(c: Column) -> Column:
    return ~c.rlike(BLANK)


def _turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Different rows with their number, and whether their role and text stand earlier in the conversation."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
    )
    rows = rows.groupBy("id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("same", F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256))
    rows = written(rows, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    earliest = rows.groupBy(F.col("id").alias("of"), F.col("same").alias("as")).agg(F.count("*").alias("turns"), F.min(place).alias("earliest"))
    earliest = earliest.where("turns > 1").drop("turns")
    rows = rows.join(earliest, F.col("id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("as")), "left")
    seen = F.col("earliest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
    return rows.select("id", "turn", "role", "text", "copies", seen.alias("seen"))


_CHUNK = (
    "id {id}, part int, nth long, rows array<struct<role:string,text:string,copies:bigint>>, costs array<bigint>, places array<int>, "
    "edits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long"
)
_FAULTS = ("blank", "duplicate", "truncated", "illegal")


class _Open:
    """A chunk that is being searched, from every state it may be entered in."""

    def __init__(self, entered: Iterable[int]):
        self.searches = {e: Survivors.at(e) for e in entered}
        self.rows: list[tuple[str, str, int]] = []
        self.size = 0
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, copies: int, seen: bool, blank: bool, ended: bool) -> None:
        self.rows.append((role, text, copies))
        self.size += len(text) + copies
        letter, now = initial(role), role[:1]
        if self.last is not None and self.last + now not in ("su", "ua", "au"):
            self.faults["illegal"] += 1
        self.faults["illegal"] += (copies - 1) * (now + now not in ("su", "ua", "au"))
        self.first = now if self.first is None else self.first
        self.last = now
        if turn is not None:
            if self.high != turn:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.faults["blank"] += copies * blank
        self.faults["duplicate"] += 0 if blank else copies if seen else copies - 1
        self.faults["truncated"] += not (blank or seen or ended)
        for k in range(copies):
            ways = STEPS[letter, blank or seen or k > 0, not ended]
            steps = [(a, b, cost, edits, edits) for a, b, cost, edits in ways]
            for s in self.searches.values():
                s.step(steps)

    def values(self) -> dict:
        costs, places, edits = [], [], []
        for e in STATES:
            s = self.searches.get(e)
            for x in STATES:
                known = s is not None and x in s.now
                costs.append(s.now[x].cost if known else None)
                places.append(s.now[x].place if known else None)
                edits.append("".join(s.path(x)) if known else None)
        rows = [{"role": r, "text": t, "copies": c} for r, t, c in self.rows]
        return {"rows": rows, "costs": costs, "places": places, "edits": edits, **self.faults, "first": self.first,
                "last": self.last, "low": self.low, "high": self.high, "turns": self.turns}


def _search(schema: pa.Schema, chunk: int):
    """Task code: chunks of the sorted rows. Only the first chunk of a task may not begin its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth, now, open_ = TaskContext.get().partitionId(), 0, None, None
        out: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                other = open_ is None or row["id"] != now
                if other or len(open_.rows) >= chunk or open_.size >= CHUNK_BYTES:
                    if open_ is not None:
                        out.append({"id": now, "part": part, "nth": nth, **open_.values()})
                        size += open_.size
                        nth += 1
                    entered = (BEGIN,) if other and open_ is not None else STATES
                    now, open_ = row["id"], _Open(entered)
                    if size >= CHUNK_BYTES or len(out) >= 1024:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                open_.add(*(row[c] for c in ("turn", "role", "text", "copies", "seen", "blank", "ended")))
        if open_ is not None:
            out.append({"id": now, "part": part, "nth": nth, **open_.values()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows in order, each with whether it is the first of its id."""
    now, begun = None, False
    for batch in batches:
        for row in batch.to_pylist():
            yield not begun or row["id"] != now, row
            now, begun = row["id"], True


def _choose(schema: pa.Schema):
    """Task code: each chunk's way through it, by a search over the chunks of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        survivors: Survivors | None = None
        queue: list[tuple] = []  # id, part and nth of chunks whose way is not settled
        out: list[dict] = []

        def settle(ways: list) -> None:
            for (e, x), key in zip(ways, queue):
                out.append(dict(zip(("id", "part", "nth", "entered", "left", "ending", "paid"), (*key, e, x, None, None))))
            del queue[: len(ways)]

        def finish() -> None:
            state, cost, inserted = ending(survivors)
            settle(survivors.path(state))
            out[-1] |= {"ending": inserted, "paid": cost}

        for first, row in _by_id(batches):
            if first:
                if survivors is not None:
                    finish()
                survivors = Survivors.at(BEGIN)
            ways = []
            for e in STATES:
                for x in STATES:
                    if (cost := row["costs"][4 * e + x]) is not None:
                        ways.append((e, x, cost, (e, x), row["places"][4 * e + x]))
            queue.append((row["id"], row["part"], row["nth"]))
            survivors.step(ways)
            settle(survivors.settled)
            survivors.settled = []
            if len(out) >= 4096:  # the last chunk of a conversation may still get its ending
                yield pa.RecordBatch.from_pylist(out[:-1], schema)
                del out[:-1]
        if survivors is not None:
            finish()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _replay(schema: pa.Schema):
    """Task code: the rows that the chosen edits of each chunk leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = ((r["role"], r["text"]) for r in row["rows"] for _ in range(r["copies"]))
                edits = row["edits"] + (row["ending"] or "")
                out = [
                    {"id": row["id"], "part": row["part"], "nth": row["nth"], "at": i, "edit": edit, "role": role, "text": text}
                    for i, (edit, role, text, _) in enumerate(apply_edits(row["entered"], edits, rows))
                ]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _digest(schema: pa.Schema):
    """Task code: SHA-256 of each conversation's lines ``role:text``, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        done: list[dict] = []
        for first, row in _by_id(batches):
            if first:
                if sha is not None:
                    done.append({"id": now, "repaired_sha256": sha.hexdigest()})
                now, sha = row["id"], hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if sha is not None:
            done.append({"id": now, "repaired_sha256": sha.hexdigest()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _arrow(df: DataFrame, kinds: str) -> tuple[str, pa.Schema]:
    """A schema text with the type of the ids in ``df``, for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    text = kinds.format(id=df.schema["id"].dataType.simpleString())
    return text, to_arrow_schema(_parse_datatype_string(text))


@dataclass
class Repair:
    """What a repair found: ``report``, a row for each conversation with rows, and ``rows``, the repaired rows in
    the order of (id, part, nth, at) with the edit that made them."""

    report: DataFrame
    rows: DataFrame


def repair(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk: int = CHUNK,
) -> Repair:
    """Report: id, gaps, blank, duplicate, truncated, illegal, cost and audit; see the module."""
    turns = _turns(df, id_col, turn_col, role_col, text_col)
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    turns = turns.select("*", _blank(F.col("text")).alias("blank"), ended.alias("ended"))
    keys = [F.asc_nulls_first(c) for c in ("id", "turn", "role", "text")]
    turns = turns.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kinds, schema = _arrow(turns, _CHUNK)
    chunks = written(turns.mapInArrow(_search(schema, chunk), kinds), "repair-chunks")

    def in_order(rows: DataFrame, *by: str) -> DataFrame:
        return rows.repartition("id").sortWithinPartitions("id", "part", "nth", *by)

    kinds, schema = _arrow(turns, "id {id}, part int, nth long, entered int, left int, ending string, paid long")
    ways = in_order(chunks.select("id", "part", "nth", "costs", "places")).mapInArrow(_choose(schema), kinds)
    # a chunk is known by its place in the rows alone
    chosen = written(ways.drop("id"), "repair-ways")
    # counts over chunks: what lies between two chunks is seen by the later one
    solved = chunks.join(chosen, ["part", "nth"]).withColumn("edits", F.col("edits")[F.col("entered") * 4 + F.col("left")])
    place = F.struct("part", "nth")
    parts = solved.groupBy("id").agg(
        *[F.sum(c).alias(c) for c in _FAULTS],
        F.max("paid").alias("cost"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("turns").alias("turns"),
        F.array_sort(F.collect_list(F.struct(place.alias("place"), "first", "last", "low", "high"))).alias("seams"),
        F.array_sort(F.collect_list(F.struct(place.alias("place"), F.concat("edits", F.coalesce("ending", F.lit(""))).alias("edits")))).alias("all_"),
    )
    seam = lambda test: F.size(
        F.filter(F.sequence(F.lit(1), F.size("seams")), lambda i: (i > 1) & test(F.get("seams", i - 2), F.get("seams", i - 1)))
    )
    jumps = seam(lambda a, b: ~F.concat(a["last"], b["first"]).isin("su", "ua", "au"))
    again = seam(lambda a, b: F.coalesce(a["high"] == b["low"], F.lit(False)))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - again), F.lit(0).cast("long"))
    report = parts.select(
        F.col("id").alias(id_col),
        gaps.alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + jumps).alias("illegal"),
        "cost",
        F.array_join(F.col("all_.edits"), "").alias("audit"),
    )
    kinds, schema = _arrow(turns, "id {id}, part int, nth long, at long, edit string, role string, text string")
    rows = solved.select("id", "part", "nth", "rows", "entered", "edits", "ending").mapInArrow(_replay(schema), kinds)
    return Repair(report, rows.withColumnRenamed("id", id_col))


def digest(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """SHA-256 of each conversation's repaired lines."""
    rows = rows.withColumnRenamed(id_col, "id")
    kinds, schema = _arrow(rows, "id {id}, repaired_sha256 string")
    ordered = rows.repartition("id").sortWithinPartitions("id", "part", "nth", "at")
    return ordered.mapInArrow(_digest(schema), kinds).withColumnRenamed("id", id_col)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn``, modulo 20."""
    c = {x: F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", c["conv_id"], c["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", c["role"].alias("role"), c["text"].alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))


def query(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    found = repair(damage(conversations))
    every = conversations.select("conv_id").distinct()
    counts = ["gaps", *_FAULTS, "cost"]
    out = every.withColumnRenamed("conv_id", "asked")
    report = written(found.report, "repair-report").withColumnRenamed("conv_id", "of")
    hashes = digest(found.rows).withColumnRenamed("conv_id", "hashed")
    out = out.join(report, F.col("asked").eqNullSafe(F.col("of")), "left")
    out = out.join(hashes, F.col("asked").eqNullSafe(F.col("hashed")), "left")
    return out.select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


SQL = r"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k,
         coalesce(role, ' ') AS r, coalesce(text, ' ') AS x
  FROM conversations
), crc AS (
  SELECT keyed.*, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 20 AS kind
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS text
  FROM crc, unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) WHERE kind <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, left(role, 1) AS letter,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS two
  FROM ordered
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (NOT blank AND seen) AS duplicate, count(*) FILTER (NOT blank AND NOT seen AND cut) AS truncated,
         count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM placed GROUP BY conv_id
), edge(a, letter, b) AS (
  VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), put AS (
  SELECT DISTINCT a, a AS b, '' AS e, [] ::VARCHAR[] AS out FROM (SELECT a FROM edge UNION SELECT b FROM edge)
  UNION ALL
  SELECT put.a, edge.b, e || 'I', list_append(out, CASE letter WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
  FROM put JOIN edge ON edge.a = put.b AND letter <> 's' WHERE len(e) < 3
), way AS MATERIALIZED (
  SELECT put.a, put.b AS b, e || 'D' AS e, 3 * len(e) + 4 AS cost, out, NULL AS letter FROM put
  UNION ALL
  SELECT put.a, edge.b, e || 'K', 3 * len(e), out, edge.letter FROM put JOIN edge ON edge.a = put.b
  UNION ALL
  SELECT put.a, edge.b, e || 'R', 3 * len(e) + 3, list_append(out, CASE letter WHEN 'u' THEN 'user' ELSE 'assistant' END), NULL
  FROM put JOIN edge ON edge.a = put.b AND letter <> 's'
), path AS (
  SELECT conv_id, 0 ::BIGINT AS i, '-' AS state, {'cost': 0 ::BIGINT, 'audit': '', 'out': [] ::VARCHAR[]} AS best FROM faults
  UNION ALL
  SELECT p.conv_id, p.i, way.b, min({
      'cost': best.cost + way.cost + CASE WHEN cut AND right(e, 1) <> 'D' THEN 3 ELSE 0 END, 'audit': best.audit || e,
      'out': best.out || CASE right(e, 1) WHEN 'D' THEN way.out WHEN 'K' THEN list_append(way.out, role || ':' || text)
                         ELSE list_append(way.out[1 : len(way.out) - 1], way.out[len(way.out)] || ':' || text) END})
  FROM path JOIN placed p ON p.conv_id IS NOT DISTINCT FROM path.conv_id AND p.i = path.i + 1
  JOIN way ON way.a = path.state AND (right(e, 1) = 'D' OR NOT (seen OR blank)) AND (way.letter IS NULL OR way.letter = p.letter)
  GROUP BY p.conv_id, p.i, way.b
), ended AS (
  SELECT path.conv_id, min({'cost': best.cost + 3 * len(e), 'audit': best.audit || e, 'out': best.out || put.out}) AS best
  FROM path JOIN faults f ON f.conv_id IS NOT DISTINCT FROM path.conv_id AND path.i = f.n JOIN put ON put.a = state AND put.b IN ('-', 'a')
  GROUP BY path.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(array_to_string(coalesce(best.out, []), chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""
