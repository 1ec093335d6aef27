"""Repair of the turn structure of conversations at least cost.

A conversation's rows, in order of turn, must become a sequence of roles that
reads ``(system? (user assistant)+)?``.  Each row is kept, given another role
or deleted, and empty rows may be inserted; each edit has an integer price.
The cheapest edits are a shortest path through a lattice of (rows read, role
last written), found by the auction algorithm: every node has a price, a path
grows from the origin along arcs whose cost equals the difference of prices,
and where no such arc is left the last node's price rises and the path loses
it.  When the path arrives, prices are a solution of the dual problem, so
every arc of every cheapest path is tight; the one whose edits come first in
the alphabet is read off the tight arcs that lead to the end.

In Spark: faults, digests and the search for repeated rows are column
expressions, aggregates and a join; rows are then sorted by conversation and
pass the tasks as a stream, in which a conversation of any length costs one
byte a row, as its audit string does.  Texts are only streamed.  In a task,
all different sequences of a batch are solved in lockstep; long ones are cut
into blocks of ``BLOCK`` rows whose distances between states, again by
auction, are chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import batches, give_back, materialise, pick

BLOCK = 32
FAR = 1 << 24           # no arc
DETOUR = 16             # more than the distances to the end of two states can differ
DELETE, INSERT, KEEP, REROLE, STOP = range(5)
LETTERS = np.frombuffer(b"DIKR", np.uint8)
#: states: nothing written, system, user, assistant; the one role that may be written freely
FOLLOW = np.array([2, 2, 3, 2])
ROLES = ("", "", "user", "assistant")
#: row codes: role s, u, a, other; + 4 if truncated; 8: to be deleted; 9: after the last row
GONE, END = 8, 9


def _costs() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    delete, rerole = np.full(10, 3), np.full(10, FAR)
    keep, target = np.full((10, 4), FAR), np.zeros((10, 4), np.int64)
    delete[END] = FAR
    for code in range(8):
        late = code // 4
        rerole[code] = 2 + late
        for state, role, to in ((0, 0, 1), (0, 1, 2), (1, 1, 2), (2, 2, 3), (3, 1, 2)):
            if code % 4 == role:
                keep[code, state], target[code, state] = late, to
    return delete, rerole, keep, target


DELETE_COST, REROLE_COST, KEEP_COST, KEEP_TO = _costs()
LEAST = np.minimum(np.minimum(DELETE_COST, REROLE_COST), KEEP_COST.min(axis=1))
LEAST[END] = 0


class Lattices:
    """Blocks of rows (codes up to ``size``, then ``END``) with the distances
    ``goal`` from the states after their last row to the end."""

    def __init__(self, codes: np.ndarray, size: np.ndarray, goal: np.ndarray):
        self.codes, self.size, self.goal = codes, size, goal
        self.width = codes.shape[1]
        # a layer for each number of rows read, and one without a way to the end
        ahead = np.concatenate([np.cumsum(LEAST[codes][:, ::-1], axis=1)[:, ::-1], np.zeros((len(codes), 1), np.int64)], axis=1)
        self.price = np.repeat(ahead[:, :, None] + goal.min(axis=1)[:, None, None], 4, axis=2)
        self.price[:, -1] = FAR

    def auction(self, origin: int) -> np.ndarray:
        """Distances from ``origin`` before the first row to the end.  Prices
        stay feasible, so a further origin starts from those of the last."""
        price, stride = self.price.reshape(-1), (self.width + 1) * 4
        path = np.zeros((len(self.codes), self.width * 4 + 1), np.int64)
        path[:, 0] = origin
        top = np.zeros(len(self.codes), np.int64)
        active = np.arange(len(self.codes))
        while len(active):
            node = path[active, top[active]]
            row, state, base = node >> 2, node & 3, active * stride
            code = self.codes[active, row]
            here, after = base + (row << 2), base + (row << 2) + 4
            to = np.stack([after + state, here + FOLLOW[state], after + KEEP_TO[code, state], after + FOLLOW[state]])
            value = price[to]
            value[DELETE] += DELETE_COST[code]
            value[INSERT] += 2
            value[KEEP] += KEEP_COST[code, state]
            value[REROLE] += REROLE_COST[code]
            best = value.argmin(axis=0)
            every = np.arange(len(active))
            low = value[best, every]
            arrive = np.where(row == self.size[active], self.goal[active, state], FAR)
            least, now = np.minimum(low, arrive), price[base + node]
            rise = least > now
            # contract: the price rises to the cheapest way on, the node leaves the path
            price[(base + node)[rise]] = least[rise]
            shorter = active[rise]
            top[shorter] = np.maximum(top[shorter] - 1, 0)
            # extend: along a tight arc
            done = ~rise & (arrive == now)
            on = ~rise & ~done
            longer = active[on]
            top[longer] += 1
            path[longer, top[longer]] = to[best[on], every[on]] - base[on]
            active = active[~done]
        return self.price[:, 0, origin].copy()

    def choices(self) -> np.ndarray:
        """At each node the first edit by letter among the tight arcs that
        lead to the end (``STOP``: the block's last row is done)."""
        out = np.full((len(self.codes), self.width, 4), STOP, np.int8)
        reach = np.zeros((len(self.codes), 4), bool)
        for row in range(self.width - 1, -1, -1):
            now, after, code = self.price[:, row], self.price[:, row + 1], self.codes[:, row]
            to = KEEP_TO[code]
            stop = (row == self.size)[:, None] & (self.goal == now)
            delete = (after + DELETE_COST[code][:, None] == now) & reach
            keep = (np.take_along_axis(after, to, 1) + KEEP_COST[code] == now) & np.take_along_axis(reach, to, 1)
            rerole = (after[:, FOLLOW] + REROLE_COST[code][:, None] == now) & reach[:, FOLLOW]
            insert = now[:, FOLLOW] + 2 == now
            reach = stop | delete | keep | rerole
            for _ in range(3):  # at most three inserts in a row lead anywhere new
                reach = reach | (insert & reach[:, FOLLOW])
            out[:, row] = np.select([stop, delete, insert & reach[:, FOLLOW], keep, rerole],
                                    [STOP, DELETE, INSERT, KEEP, REROLE], STOP)
        return out


def _trace(codes: np.ndarray, choices: np.ndarray, state: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Follow the choices of each block from its state: edits, last state."""
    count, state = len(codes), state.copy()
    edits, used = np.zeros((count, codes.shape[1] * 4), np.uint8), np.zeros(count, np.int64)
    row, active = np.zeros(count, np.int64), np.arange(count)
    while len(active):
        at, s = row[active], state[active]
        edit = choices[active, at, s]
        on = edit != STOP
        active, at, s, edit = active[on], at[on], s[on], edit[on]
        edits[active, used[active]] = LETTERS[edit]
        used[active] += 1
        state[active] = np.select([edit == DELETE, edit == KEEP], [s, KEEP_TO[codes[active, at], s]], FOLLOW[s])
        row[active] += edit != INSERT
    return [edits[k, :used[k]].tobytes() for k in range(count)], state


def solve(sequences: list[bytes]) -> list[tuple[int, str]]:
    """Least cost and audit (edits' initials) of each sequence of row codes."""
    if not sequences:
        return []
    length = np.array([len(s) for s in sequences])
    number = np.maximum(-(-length // BLOCK), 1)
    first = np.cumsum(number) - number
    last = first + number - 1
    total = int(number.sum())
    width = (BLOCK if total > len(sequences) else int(length.max())) + 1
    codes, size = np.full((total, width), END, np.int64), np.zeros(total, np.int64)
    for at, n, s in zip(first, number, sequences):
        row = np.frombuffer(s, np.uint8)
        for k in range(n):
            part = row[k * BLOCK:(k + 1) * BLOCK]
            codes[at + k, :len(part)], size[at + k] = part, len(part)
    goal = np.zeros((total, 4), np.int64)
    goal[last] = [0, DETOUR, DETOUR, 0]
    inner = np.setdiff1d(np.arange(total), last)
    if len(inner):
        ways = np.empty((len(inner), 4, 4), np.int64)       # block, state after it, state before it
        for part in _pieces(len(inner)):
            own = inner[part]
            for e in range(4):
                aim = np.full((len(own), 4), DETOUR)
                aim[:, e] = 0
                block = Lattices(codes[own], size[own], aim)
                for origin in range(4):
                    ways[part, e, origin] = block.auction(origin)
        ends = last[number > 1]
        block = Lattices(codes[ends], size[ends], goal[ends])
        entry = dict(zip(ends.tolist(), np.stack([block.auction(origin) for origin in range(4)], axis=1)))
        ahead = None
        for k in range(len(inner) - 1, -1, -1):
            ahead = entry.get(int(inner[k]) + 1, ahead)
            goal[inner[k]] = ahead
            ahead = (ways[k] + ahead[:, None]).min(axis=0)
    # from each state that a block can start in: edits, and the state after it
    states = range(4 if len(inner) else 1)
    followed: list[tuple[list[bytes], list]] = [([], []) for _ in states]
    cost: list[int] = []
    for part in _pieces(total):
        block = Lattices(codes[part], size[part], goal[part])
        cost.extend(block.auction(0).tolist())
        for origin in states[1:]:
            block.auction(origin)
        choices = block.choices()
        for s in states:
            edits, after = _trace(codes[part], choices, np.full(len(choices), s))
            followed[s][0].extend(edits)
            followed[s][1].extend(after.tolist())
    out = []
    for at, n in zip(first, number):
        edits, s = [], 0
        for k in range(at, at + n):
            edits.append(followed[s][0][k])
            s = followed[s][1][k]
        out.append((cost[at], b"".join(edits).decode()))
    return out


def _pieces(count: int, size: int = 4096) -> Iterator[slice]:
    """Slices of a bounded number of blocks."""
    return (slice(at, min(at + size, count)) for at in range(0, count, size))


# --- tables -------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """Planted faults, by crc32(``conv_id:turn``) % 20: 0 drops the row, 1
    empties its text, 2 takes ``[.!?]`` out of it, 3 repeats it, 4 makes it the
    user's.  Nulls of role and text, and in the hashed text, are one space.
    Columns conv_id, turn, role, text, copies; a dropped row has copies 0."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return rows.select(
        "conv_id", "turn", F.when(d == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(d == 1, F.lit("")).when(d == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text")).alias("text"),
        F.when(d == 0, 0).when(d == 3, 2).otherwise(1).cast("long").alias("copies"))


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Rows of a conversation in one task, in order (nulls come first)."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "key")


def _faults(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number, without texts: conv_id, turn, role,
    key, blank, cut, copies, fresh (no earlier row of the conversation is
    equal in role and text)."""
    last = F.right(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), F.lit(1))
    there = F.col("copies") > 0
    only = lambda c: F.when(there, c)
    slim = (rows.select("conv_id", only(F.col("turn")).alias("turn"), only(F.col("role")).alias("role"),
                        only(_digest()).alias("key"), only(last == "").alias("blank"),
                        only(~last.isin(".", "!", "?")).alias("cut"), "copies")
            .groupBy("conv_id", "turn", "role", "key", "blank", "cut").agg(F.sum("copies").alias("copies")))
    # nulls come first: the pair (has a turn, turn) orders as rows do
    spot = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = (slim.where("NOT blank").groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k"))
              .agg(F.min(spot).alias("spot")))
    return (slim.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
            .select(*slim.columns, F.coalesce(F.col("spot") == spot, F.lit(False)).alias("fresh")))


class _Open:
    """What is known of the conversation whose rows are being read."""

    def __init__(self, conv):
        self.conv, self.codes, self.counts = conv, [], np.zeros(4, np.int64)
        self.low = self.high = self.turn = self.initial = None
        self.turns = 0

    def row(self, done) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.tolist(), *done)


_CLASS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _read(rows: Iterator[pa.RecordBatch]) -> Iterator[list[_Open]]:
    """Finished conversations, batch by batch, from rows in order."""
    now = None
    for batch in batches(rows):
        finished = []
        for conv, turn, role, blank, cut, copies, fresh in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    finished.append(now)
                now = _Open(conv)
            if not copies:
                continue
            if turn is not None:
                if turn != now.turn:
                    now.turns += 1
                now.turn = now.high = turn
                now.low = turn if now.low is None else now.low
            initial, good = role[:1], fresh and not blank
            if now.initial is not None and (now.initial, initial) not in _LEGAL:
                now.counts[3] += 1
            now.counts[3] += copies - 1         # a role never follows itself
            now.initial = initial
            if good:
                now.codes.append(_CLASS.get(initial, 3) + 4 * cut)
            now.codes.extend([GONE] * (copies - good)) if copies < 64 else now.codes.append(bytes([GONE]) * (copies - good))
            now.counts[0] += copies if blank else 0
            now.counts[1] += 0 if blank else copies - good
            now.counts[2] += good and cut
            if len(now.codes) > 1 << 12:
                now.codes = [_packed(now.codes)]
        yield finished
    if now is not None:
        yield [now]


def _packed(codes: list) -> bytes:
    return b"".join(c if isinstance(c, bytes) else bytes([c]) for c in codes)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of
    each conversation of ``rows`` (conv_id, turn, role, text, copies).

    Rows are taken by turn, nulls first, then by role and digest of the text.
    A null conv_id is a conversation; one whose rows all have copies 0 has
    zeros and an empty audit."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ready = _in_order(_faults(rows)).select("conv_id", "turn", "role", "blank", "cut", "copies", "fresh")
    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    out_type = pa.schema([("conv_id", _arrow_type(rows)), *[(c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}
        for finished in _read(batch_rows):
            sequences = [_packed(c.codes) for c in finished]
            new = sorted({s for s in sequences if s not in known}, key=len)
            if len(known) + len(new) > 200_000:
                known.clear()
                new = sorted(set(sequences), key=len)
            found = dict(known)
            # like lengths together; a bounded number of lattices at once
            at = 0
            while at < len(new):
                stop, cells = at, 0
                while stop < len(new) and (stop == at or cells + len(new[stop]) < 200_000):
                    cells, stop = cells + len(new[stop]) + 1, stop + 1
                found.update(zip(new[at:stop], solve(new[at:stop])))
                at = stop
            if finished:
                data = zip(*(c.row(found[s]) for c, s in zip(finished, sequences)))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(data, out_type.types)], schema=out_type)
            known = {s: v for s, v in found.items() if len(s) <= 2 * BLOCK}
        give_back()

    return ready.mapInArrow(run, schema)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(rows.schema["conv_id"].dataType)


def apply_edits(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I),
    turn (null if inserted), role, text; in order of place within each task.

    Each audit meets its rows by one shuffle; a task holds one audit and one
    batch of rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    cid, void = _arrow_type(rows), F.lit(None)
    both = audit.select("conv_id", F.lit(0).alias("kind"), void.cast("long").alias("turn"), void.cast("string").alias("role"),
                        void.cast("binary").alias("key"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
    both = both.unionByName(rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("key"), "text", "copies"))
    ready = _in_order(both, "kind").select("conv_id", "kind", "turn", "role", "text", "copies")
    names = ["conv_id", "place", "edit", "turn", "role", "text"]
    types = [cid, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    states = {"s": 1, "u": 2, "a": 3}

    def pack(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names)

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, at, state, place, out = None, "", 0, 0, 0, []

        def inserts():
            nonlocal at, state, place
            while at < len(edits) and edits[at] == "I":
                state = int(FOLLOW[state])
                out.append((conv, place, "I", None, ROLES[state], ""))
                at, place = at + 1, place + 1

        for batch in batches(batch_rows, text=4):
            for cid_, kind_, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if kind_ == 0:
                    inserts()
                    conv, edits, at, state, place = cid_, text, 0, 0, 0
                    continue
                for _ in range(copies):
                    inserts()
                    edit, at = edits[at], at + 1
                    if edit == "D":
                        continue
                    state = states[role[:1]] if edit == "K" else int(FOLLOW[state])
                    out.append((conv, place, edit, turn, role if edit == "K" else ROLES[state], text))
                    place += 1
            if out:
                yield pack(out)
                out.clear()
        inserts()
        if out:
            yield pack(out)

    return ready.mapInArrow(run, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """sha256 of each repaired conversation's ``role:text`` lines, read as
    ``apply_edits`` gives them (the hash is serial, so its rows are streamed)."""
    kind, cid = repaired.schema["conv_id"].dataType.simpleString(), _arrow_type(repaired)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches(rows):
            out = []
            for own, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (cid, pa.string()))], ["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], cid), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def conversation_rows(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The columns the operator reads (a missing one counts as null)."""
    return pick(table, conv_id=conv_col, turn=f"{turn_col}:long", role=f"{role_col}:string", text=f"{text_col}:string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired rows of a table (conv_id, turn, role, text[, copies]).

    Nulls in role and text count as one space, as which a role is none of the
    three known and a text is blank.  Only a role's first letter matters:
    ``s``, ``u`` or ``a`` can be kept, any other (or an empty role) must be
    changed or deleted.  Equal rows are duplicates of the first; an empty table gives
    two empty results; extra columns are not read.
    """
    if "copies" not in rows.columns:
        rows = conversation_rows(rows).withColumn("copies", F.lit(1).cast("long"))
        rows = rows.fillna(" ", ["role", "text"])
    found = materialise(audits(rows), "audits")
    return found, apply_edits(rows, found)


def damaged_repairs(table: DataFrame) -> DataFrame:
    """Damage every conversation of ``table``, repair it, and give per
    original conv_id its audit and the digest of the repaired rows."""
    found, repaired = repair(damage(conversation_rows(table)))
    hashed = digests(repaired).withColumnRenamed("conv_id", "c")
    nothing = hashlib.sha256().hexdigest()
    return (found.join(hashed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select(*found.columns, F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
