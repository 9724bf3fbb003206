"""Repair of conversations by the cheapest audit of their turns.

An audit names what happens to each row of a conversation, in order: ``K`` keeps it (cost 0), ``R`` gives it
the role user or assistant (1), ``D`` deletes it (2), ``I`` puts a row with empty text, user or assistant, at
any place (5). Blank and repeated rows must go; a truncated row that stays costs 5 more. The roles' initials
must read ``(s?(ua)+)?`` at the end. Of audits of least cost the ASCII-least is taken.

What comes before a row matters only as one of four states, so the cheapest audit is found by dynamic
programming. Its prefixes are persistent: a prefix is a node with the letter it adds to its parent, so the
states share what they have in common. A node keeps a rolling hash of its whole prefix and its ancestors 1, 2,
4, ... letters up. Two prefixes of one cost are compared by their longest common prefix: binary lifting over the
hashes finds where they part, and the letters before it are compared until the nodes are one, so that equal hashes
of different prefixes do no harm. Prefixes of one cost and the same rows never contain each other (the rest
would be insertions, which cost), so the least prefix stays the least whatever follows.

A conversation may have very many rows. Rows are range-partitioned and cut to slices of at most ``SLICE`` rows;
a slice that may not begin its conversation is solved from every state, and the slices' audits are put
together in order. The repaired text is hashed as a stream of sorted rows, in bounded memory but for the audit,
a byte a row, which is also the result; a hash over a whole text can't be split between tasks.

Rules: a null role or text is one space, in the damage's key also a null id or turn. Rows of a conversation are
ordered by turn (nulls first), then role and text. An empty role has no initial and fits nowhere. Rows
of a null ``conv_id`` are one conversation. Repeated rows are duplicates of the first one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored

SLICE = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant.
STATES = 4
AFTER_USER, AFTER_ASSISTANT = 2, 3
LEGAL = {"su", "ua", "au"}
# Modulus and base of the prefixes' rolling hash.
MODULUS, BASE = (1 << 61) - 1, 1_000_003
#: Characters of a text that take part in cutting the ranges.
HEAD = 64


class Prefixes:
    """Linked prefixes of audits; node 0 is the empty one."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]

    def add(self, node: int, letter: str) -> int:
        """The node of ``node`` and one letter more."""
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
        self.up.append(up)
        return len(self.up) - 1

    def ancestor(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the prefix of ``a`` comes before that of ``b``."""
        if a == b:
            return False
        short = min(self.depth[a], self.depth[b])
        x = self.ancestor(a, self.depth[a] - short)
        y = self.ancestor(b, self.depth[b] - short)
        first = self.depth[a] < self.depth[b]
        if self.hash[x] != self.hash[y]:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            first = self.letter[x] < self.letter[y]
            x, y = self.up[x][0], self.up[y][0]
        while x != y:  # equal hashes: the letters tell
            if self.letter[x] != self.letter[y]:
                first = self.letter[x] < self.letter[y]
            x, y = self.up[x][0], self.up[y][0]
        return first

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


class Search:
    """The best prefix that leads to each state."""

    def __init__(self, entry: int) -> None:
        self.prefixes = Prefixes()
        self.best: dict[int, tuple[int, int]] = {entry: (0, 0)}

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, node: int, letter: str) -> None:
        old = best.get(state)
        if old is not None and old[0] < cost:
            return
        made = self.prefixes.add(node, letter)
        if old is None or cost < old[0] or self.prefixes.less(made, old[1]):
            best[state] = cost, made

    def insert(self) -> None:
        """Rows put in at this place: one, or a user and an assistant."""
        for _ in range(2):
            for state, (cost, node) in list(self.best.items()):
                to = AFTER_ASSISTANT if state == AFTER_USER else AFTER_USER
                self._offer(self.best, to, cost + INSERT, node, "I")

    def row(self, initial: str, gone: bool, truncated: bool) -> None:
        best: dict[int, tuple[int, int]] = {}
        more = TRUNCATED * truncated
        for state, (cost, node) in self.best.items():
            self._offer(best, state, cost + DELETE, node, "D")
            if gone:
                continue
            wanted, to = ("a", AFTER_ASSISTANT) if state == AFTER_USER else ("u", AFTER_USER)
            if initial == wanted:
                self._offer(best, to, cost + KEEP + more, node, "K")
            else:
                self._offer(best, to, cost + REROLE + more, node, "R")
            if initial == "s" and state == 0:
                self._offer(best, 1, cost + KEEP + more, node, "K")
        self.best = best


def transfers(rows: list[tuple[str, bool, bool]], entries: tuple[int, ...]) -> list[tuple[int, int, int, str]]:
    """``entry, exit, cost, audit`` of rows ``initial, gone, truncated``."""
    out = []
    for entry in entries:
        search = Search(entry)
        for row in rows:
            search.insert()
            search.row(*row)
        out += [(entry, state, cost, search.prefixes.text(node)) for state, (cost, node) in search.best.items()]
    return out


def _earlier(a: tuple | None, b: tuple | None) -> bool:
    """Whether the audit ``a`` comes before ``b``; both are linked slices ``(before, audit)``."""
    left, right = [], []
    while a is not b:
        if a is not None:
            left.append(a[1])
            a = a[0]
        if b is not None:
            right.append(b[1])
            b = b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


def whole_audit(slices: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of a conversation from its slices' transfers in order."""
    best: dict[int, tuple[int, tuple | None]] = {0: (0, None)}
    # Rows put in after the last row are a slice of their own.
    search = [(e, e, 0, "") for e in range(STATES)]
    for entry in range(STATES):
        end = Search(entry)
        end.insert()
        search += [(entry, s, c, end.prefixes.text(n)) for s, (c, n) in end.best.items() if s != entry]
    for moves in [*slices, search]:
        now: dict[int, tuple[int, tuple | None]] = {}
        for entry, state, cost, audit in moves:
            if entry not in best:
                continue
            total, linked = best[entry][0] + cost, (best[entry][1], audit)
            if state not in now or total < now[state][0] or total == now[state][0] and _earlier(linked, now[state][1]):
                now[state] = total, linked
        best = now
    cost, linked = best[0]  # all rows deleted
    if best[AFTER_ASSISTANT][0] < cost or best[AFTER_ASSISTANT][0] == cost and _earlier(best[AFTER_ASSISTANT][1], linked):
        cost, linked = best[AFTER_ASSISTANT]
    parts = []
    while linked is not None:
        parts.append(linked[1])
        linked = linked[0]
    return cost, "".join(reversed(parts))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the hash of id and turn."""
    space = F.lit(" ")

    def name(c: str):
        return F.coalesce(F.col(c).cast("string"), space)

    draw = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))
    rows = rows.where("draw != 0").withColumn("copy", F.explode(copies))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def _add_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with ``again``: whether a row equals the row before it. Equal rows are in one range."""
    own = ("conv_id", "turn", "role", "mark")
    before: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.select(own)
        first = before if before is not None else rows.slice(0, 1)
        earlier = pa.Table.from_batches([first, rows.slice(0, batch.num_rows - 1)]).combine_chunks()
        again = pa.array(np.ones(batch.num_rows, bool))
        for c in own:
            a, b = rows.column(c), earlier.column(c).chunk(0)
            both_null = pc.and_(pc.is_null(a), pc.is_null(b))
            again = pc.and_(again, pc.or_(both_null, pc.fill_null(pc.equal(a, b), False)))
        if before is None:
            again = pa.concat_arrays([pa.array([False]), again.slice(1)])
        before = rows.slice(batch.num_rows - 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, again], [*batch.schema.names, "again"])


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows in order, stored, with their ``place``, and what their text and role tell."""
    rows = stored(rows.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("mark")), "turns")
    key = ["conv_id", "role", "mark"]
    firsts = rows.groupBy(*key).agg(F.min(F.struct("turn")).alias("low"), F.max(F.struct("turn")).alias("high"))
    # Only texts of several turns; a table, so that Spark can split the rows of a hot one.
    firsts = firsts.where("low < high").select(*[F.col(c).alias(f"{c}_of") for c in key], F.col("low.turn").alias("first"))
    firsts = stored(firsts, "repeated-turns")
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_of")) & (F.col("role") == F.col("role_of")) & (F.col("mark") == F.col("mark_of"))
    later = F.col("role_of").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    seen = rows.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "mark", later.alias("later"))
    head = F.substring("text", 1, HEAD).alias("head")
    ranged = seen.select("*", head).repartitionByRange("conv_id", "turn", "role", "head")
    placed = ranged.sortWithinPartitions("conv_id", "turn", "role", "text").drop("head")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema.fields)
    return stored(
        placed.mapInArrow(_add_again, f"{shape}, again boolean").select(
            "*",
            F.monotonically_increasing_id().alias("place"),
            F.substring("role", 1, 1).alias("initial"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        ),
        "ordered-turns",
    )


SLICES = (
    "conv_id {kind}, place bigint, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, first string, last string, moves array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
)


class _Slice:
    """Counts and states of a run of rows of one conversation."""

    def __init__(self, row: dict, begins: bool) -> None:
        self.conv_id, self.place, self.first, self.begins = row["conv_id"], row["place"], row["initial"], begins
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last, self.rows = None, []

    def add(self, row: dict) -> None:
        initial, blank = row["initial"], row["blank"]
        duplicate = not blank and (row["again"] or row["later"])
        truncated = not blank and not duplicate and row["truncated"]
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if row["turn"] is not None and row["turn"] != self.high:
            self.low = row["turn"] if self.low is None else self.low
            self.high, self.turns = row["turn"], self.turns + 1
        self.rows.append((initial, blank or duplicate, truncated))

    def record(self) -> dict:
        names = ("conv_id", "place", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last")
        moves = transfers(self.rows, (0,) if self.begins else tuple(range(STATES)))
        kept = [dict(zip(("entry", "exit", "cost", "audit"), m, strict=True)) for m in moves]
        return {n: getattr(self, n) for n in names} | {"moves": kept}


def _slicer(schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                follows = before is not None and row["place"] == before["place"] + 1
                same = follows and row["conv_id"] == before["conv_id"]
                if now is None or not same or len(now.rows) >= SLICE:
                    if now is not None:
                        done.append(now.record())
                    # The first row of a task's run may go on with a conversation of another task.
                    now = _Slice(row, begins=follows and not same)
                now.add(row)
                before = row
            yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.record()], schema)

    return cut


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _joined(schema: pa.Schema):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_joined_row(r) for r in batch.to_pylist()], schema)

    return join


def _joined_row(group: dict) -> dict:
    slices = [s for s in group["slices"] if s["moves"] is not None]
    out = dict.fromkeys(COUNTS, 0) | {"conv_id": group["conv_id"], "audit": ""}
    low = high = last = None
    turns = 0
    for s in slices:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            out[c] += s[c]
        if last is not None:
            out["illegal"] += last + s["first"] not in LEGAL
        last = s["last"]
        if s["low"] is not None:
            turns += s["turns"] - (s["low"] == high)
            low, high = s["low"] if low is None else low, s["high"]
    if low is not None:
        out["gaps"] = high - low + 1 - turns
    moves = [[(m["entry"], m["exit"], m["cost"], m["audit"]) for m in s["moves"]] for s in slices]
    out["cost"], out["audit"] = whole_audit(moves)
    return out


class _Repair:
    """Hash of a repaired conversation, row by row."""

    def __init__(self, head: dict) -> None:
        self.head, self.at, self.state, self.digest, self.rows = head, 0, 0, hashlib.sha256(), 0

    def _write(self, role: str, text: str, initial: str) -> None:
        self.digest.update(("\n" * (self.rows > 0) + f"{role}:{text}").encode())
        self.rows += 1
        self.state = {"s": 1, "u": AFTER_USER, "a": AFTER_ASSISTANT}[initial]

    def _next_role(self) -> str:
        return "assistant" if self.state == AFTER_USER else "user"

    def inserts(self) -> None:
        audit = self.head["audit"]
        while self.at < len(audit) and audit[self.at] == "I":
            self._write(self._next_role(), "", self._next_role()[0])
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.head["audit"][self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text, role[0])
        elif edit == "R":
            self._write(self._next_role(), text, self._next_role()[0])

    def record(self) -> dict:
        self.inserts()
        return {c: self.head[c] for c in ("conv_id", *COUNTS, "audit")} | {"repaired_sha256": self.digest.hexdigest()}


def _hasher(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["audit"] is not None:  # the first row of a conversation
                    if now is not None:
                        done.append(now.record())
                    now = _Repair(row)
                else:
                    now.add(row["role"], row["text"])
            yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.record()], schema)

    return run


def _schema(df: DataFrame, names: list[str], more: list[tuple[str, pa.DataType]]) -> pa.Schema:
    own = df.select(*names).limit(0).toArrow().schema
    return pa.schema([*own, *more])


def audits(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ordered rows, and a row for each id of ``ids``: ``conv_id``, the counts, ``cost`` and ``audit``."""
    ordered = _ordered(rows)
    kind = dict(ordered.dtypes)["conv_id"]
    move = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    longs = [(c, pa.int64()) for c in ("place", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")]
    shape = _schema(ordered, ["conv_id"], [*longs, ("first", pa.string()), ("last", pa.string()), ("moves", move)])
    asked = ordered.select("conv_id", "place", F.col("turn").cast("bigint").alias("turn"), "again", "later", "initial", "blank", "truncated")
    slices = asked.mapInArrow(_slicer(shape), SLICES.format(kind=kind))
    # Every original id, also of a conversation that has lost all rows.
    slices = slices.unionByName(ids.select("conv_id").distinct(), allowMissingColumns=True)
    parts = F.sort_array(F.collect_list(F.struct(*slices.columns[1:]))).alias("slices")
    grouped = slices.groupBy("conv_id").agg(parts)
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    whole = _schema(ordered, ["conv_id"], [*((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
    return ordered, grouped.mapInArrow(_joined(whole), f"conv_id {kind}, {counts}, audit string")


def repaired(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    ordered, heads = audits(rows, ids)
    heads = heads.withColumn("place", F.lit(-1).cast("bigint"))
    both = heads.unionByName(ordered.select("conv_id", "place", "role", "text"), allowMissingColumns=True)
    sorted_rows = both.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    more = [*((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    kind = dict(ordered.dtypes)["conv_id"]
    return sorted_rows.mapInArrow(
        _hasher(_schema(ordered, ["conv_id"], more)), f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    )


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations."""
    return repaired(damaged(conversations), conversations)
