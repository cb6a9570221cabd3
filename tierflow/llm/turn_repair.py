"""Repair of conversation structure: the cheapest edits that make roles alternate, and of these the least.

The roles of a conversation shall spell `(s?(ua)+)?` by their initials. Where a row stands in that pattern is one of four
states (nothing yet, system, user, assistant); states at places are nodes, edits are arcs between them: Delete, Keep and
Rerole lead past a row, Insert stays before it. A dynamic programme from the end gives every node its cost to the end, and
arcs that lose nothing by it are optimal. Among the optimal paths the one whose edits, as initials, are least in ASCII wins;
it is found by prefix doubling: arcs are ranked by the first 1, 2, 4, ... edits of the audit that begins with them, from the
ranks of the length before and a pointer to the arc that comes after; once no audit goes on, the rank of an arc is that of its
whole audit, the least arc of a conversation's first node is taken, and the doubled pointers name every arc behind it.

Defined results: null role, text, conv_id or turn counts as one space wherever its text is asked for; a null turn sorts first;
rows of one turn go by role, then by digest of role and text; a null conv_id is a conversation of its own; a role with another
initial than s, u or a, or none, cannot be kept. A conversation without rows has zeros, an empty audit and the hash of nothing.
Repeated rows are faults (duplicates). Extra columns are ignored; an empty table gives no rows.

Scale: first only digests and flags (some 50 bytes a row) are shuffled by conversation; a conversation's must fit a task, as
its audit, one value, must. Texts then follow their audit in order through one more shuffle and are hashed as a stream, so
that no conversation's texts are ever held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.turns import DIGEST_BYTES, in_order, turn_digest

DELETE, KEEP, REROLE, INSERT, TRUNCATED = 2, 0, 1, 5, 5
#: Edits by ASCII order of their initials.
LABELS = np.frombuffer(b"DIKR", dtype=np.uint8)
#: States: 0 nothing yet, 1 system, 2 user, 3 assistant. Which state may be entered next by user or assistant, ...
NEXT = np.array([2, 2, 3, 2])
#: ... and by keeping a role of the given kind (0 other, 1 system, 2 user, 3 assistant); -1 if it does not fit.
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
FINAL = (0, 3)
FAR = 1 << 60
ROLES = {2: b"user:", 3: b"assistant:"}
#: Rows of short conversations are worked on together, so many at least.
TOGETHER = 20_000
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDITS = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in SUMMARY) + ", audit binary"


def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, alive, role, text): rows after damage; a dropped row stays, not alive, to name its conversation."""
    fate = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"),
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.col("fate") != 0, F.when(F.col("fate") == 3, 2).otherwise(1))).alias("alive")
    return rows.select("conv_id", "turn", copies, role.alias("role"), text.alias("text"))


def described(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, alive, role, text) by digest, kind of role and whether the text is blank or cut off."""
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    kind = reduce(lambda c, k: c.when(F.left(F.col("role"), F.lit(1)) == "sua"[k - 1], k), (1, 2, 3), F.when(F.lit(False), 0))
    return rows.select(
        "conv_id", "turn", "alive", "role", turn_digest(F.col("role"), F.col("text")).alias("digest"),
        kind.otherwise(0).alias("kind"), (end == "").alias("is_blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
    )


def audits(rows: DataFrame) -> DataFrame:
    """`AUDITS` of every conversation among `rows` (conv_id, turn, alive, role, text)."""
    narrow = described(rows).repartition("conv_id").sortWithinPartitions("conv_id", *in_order("turn", "role", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            edge, ids = last_start(batch), batch.column("conv_id")
            held.append(batch.slice(0, edge))
            # The last conversation may go on in the next batch; the ones before it are complete.
            if (edge or ids[0] != before) and sum(b.num_rows for b in held) >= TOGETHER:
                yield repaired(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(edge))
            before = ids[-1]
        if held:
            yield repaired(pa.Table.from_batches(held))

    return narrow.select("conv_id", "turn", "alive", "digest", "kind", "is_blank", "is_cut").mapInArrow(run, AUDITS)


def last_start(batch: pa.RecordBatch) -> int:
    """The row of a batch at which its last conversation begins."""
    conv, known = plain(batch.column("conv_id"))
    same = (conv == conv[-1]) & (known == known[-1])
    return 0 if same.all() else int(len(same) - np.argmin(same[::-1]))


def plain(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and whether they are known."""
    known = np.asarray(column.is_valid())
    return np.asarray(column.fill_null(0)), known


def first_of(*columns: np.ndarray) -> np.ndarray:
    """For every row whether it is the first with its values."""
    order = np.lexsort((np.arange(len(columns[0])), *columns))
    first = np.ones(len(order), dtype=bool)
    if len(order):
        first[order[1:]] = reduce(np.logical_or, (c[order[1:]] != c[order[:-1]] for c in columns))
    return first


def repaired(table: pa.Table) -> pa.RecordBatch:
    """`AUDITS` of the complete conversations in `table`, whose rows are sorted."""
    table = table.combine_chunks()
    conv, known = plain(table.column("conv_id"))
    begins = np.ones(len(conv), dtype=bool)
    begins[1:] = (conv[1:] != conv[:-1]) | (known[1:] != known[:-1])
    owner, names = np.cumsum(begins) - 1, table.column("conv_id").take(pa.array(np.flatnonzero(begins))).combine_chunks()
    total = len(names)

    alive = np.flatnonzero(np.asarray(table.column("alive")))
    owner, rows = owner[alive], table.take(pa.array(alive)).combine_chunks()
    blank, cut, kind = (np.asarray(rows.column(c)) for c in ("is_blank", "is_cut", "kind"))
    digest = np.frombuffer(b"".join(rows.column("digest").to_pylist()), dtype=np.uint64).reshape(-1, DIGEST_BYTES // 8)
    repeat = ~blank & ~first_of(digest[:, 0], digest[:, 1], owner)
    cut = cut & ~blank & ~repeat

    def count(flags: np.ndarray, of: np.ndarray = owner) -> np.ndarray:
        return np.bincount(of[flags], minlength=total)

    together = owner[1:] == owner[:-1]
    legal = ((kind[1:] == 2) & np.isin(kind[:-1], (1, 3))) | ((kind[1:] == 3) & (kind[:-1] == 2))
    illegal = count(together & ~legal, owner[1:])
    turn, numbered = plain(rows.column("turn"))
    gaps = np.zeros(total, dtype=np.int64)
    turn, of = turn[numbered], owner[numbered]
    if len(of):
        # Sorted by turn within a conversation: its first and last number are the least and the greatest.
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        stop = np.concatenate([start[1:], [len(of)]]) - 1
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (turn[1:] != turn[:-1])])
        gaps[of[start]] = turn[stop] - turn[start] + 1 - np.add.reduceat(new.astype(np.int64), start)

    sizes = np.bincount(owner, minlength=total)
    cost, found = least_edits(sizes, kind, blank | repeat, cut)
    values = [gaps, count(blank), count(repeat), count(cut), illegal, cost]
    return pa.RecordBatch.from_arrays(
        [names.cast(pa.int64()), *[pa.array(v, pa.int64()) for v in values], pa.array(found, pa.binary())],
        ["conv_id", *SUMMARY, "audit"],
    )


def least_edits(sizes: np.ndarray, kind: np.ndarray, must_go: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Least cost and least audit of each conversation, given how many rows it has and, row by row, what they are."""
    places = sizes + 1
    first = np.concatenate([[0], np.cumsum(places)])[:-1]
    costs = costs_to_end(sizes, first, int(places.sum()), kind, must_go, cut)
    arcs, target = optimal_arcs(costs, sizes, first, kind, must_go, cut)
    return costs[first, 0], least_audits(arcs, target, first)


def arcs_from(costs_after: np.ndarray, kind: np.ndarray, must_go: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Cost to the end by Delete, Keep and Rerole (axis 1) from each state (axis 2), given those behind the row."""
    extra = np.where(must_go, FAR, np.where(cut, TRUNCATED, 0))[:, None]
    into = KEPT[:, kind].T
    kept = np.where(into >= 0, np.take_along_axis(costs_after, np.maximum(into, 0), axis=1), FAR) + extra + KEEP
    return np.stack([costs_after + DELETE, kept, costs_after[:, NEXT] + extra + REROLE], axis=1)


def with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs of the states at one place, once a user or assistant may be put in."""
    user, assistant = costs[:, 2], costs[:, 3]
    user, assistant = np.minimum(user, assistant + INSERT), np.minimum(assistant, user + INSERT)
    return np.stack([np.minimum(costs[:, 0], user + INSERT), np.minimum(costs[:, 1], user + INSERT), user, assistant], axis=1)


def costs_to_end(
    sizes: np.ndarray, first: np.ndarray, places: int, kind: np.ndarray, must_go: np.ndarray, cut: np.ndarray
) -> np.ndarray:
    """The least cost from each place and state to the end; all conversations take a step at once, from their ends."""
    costs = np.full((places, 4), FAR, dtype=np.int64)
    end = np.full((1, 4), FAR, dtype=np.int64)
    end[0, list(FINAL)] = 0
    costs[first + sizes] = with_inserts(end)
    order = np.argsort(-sizes, kind="stable")
    row_first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    falling = -sizes[order]
    for step in range(1, int(sizes.max(initial=0)) + 1):
        going = order[: np.searchsorted(falling, -step, side="right")]
        place, row = first[going] + sizes[going] - step, row_first[going] + sizes[going] - step
        ways = arcs_from(costs[place + 1], kind[row], must_go[row], cut[row])
        costs[place] = with_inserts(np.minimum(ways.min(axis=1), FAR))
    return costs


def optimal_arcs(
    costs: np.ndarray, sizes: np.ndarray, first: np.ndarray, kind: np.ndarray, must_go: np.ndarray, cut: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For every node (place x 4 + state) and edit whether that arc loses nothing, and the node it leads to."""
    places = len(costs)
    is_row = np.ones(places, dtype=bool)
    is_row[first + sizes] = False
    at = np.flatnonzero(is_row)
    arcs = np.zeros((places, 4, 4), dtype=bool)
    target = np.zeros((places, 4, 4), dtype=np.int64)
    node = np.arange(places)[:, None] * 4
    states = np.arange(4)[None, :]
    arcs[:, :, 1] = costs[:, NEXT] + INSERT == costs
    target[:, :, 1] = node + NEXT[None, :]
    if len(at):
        ways = arcs_from(costs[at + 1], kind, must_go, cut)
        for edit, way in ((0, 0), (2, 1), (3, 2)):
            arcs[at, :, edit] = ways[:, way] == costs[at]
        target[at, :, 0] = node[at] + 4 + states
        target[at, :, 2] = node[at] + 4 + np.maximum(KEPT[:, kind].T, 0)
        target[at, :, 3] = node[at] + 4 + NEXT[None, :]
    arcs &= (costs < FAR)[:, :, None]
    ended = np.zeros((places, 4), dtype=bool)
    ended[np.ix_(first + sizes, FINAL)] = True
    arcs[ended] = False  # nothing follows once the pattern is complete
    return arcs.reshape(-1, 4), target.reshape(-1, 4)


def least_audits(arcs: np.ndarray, target: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The least audit from the first node of each conversation.

    Arcs are numbered; one more stands for the end, ranks below all and follows itself. An arc is followed by the least
    arc of the node it leads to; edits of a node differ, so its least arc by the first edit is its least arc.
    """
    nodes, edits = np.nonzero(arcs)
    number = np.full(arcs.shape, -1, dtype=np.int64)
    number[nodes, edits] = np.arange(len(nodes))
    end = len(nodes)
    has, least = arcs.any(axis=1), np.argmax(arcs, axis=1)
    opening = np.where(has, number[np.arange(len(arcs)), least], end)
    follow = np.append(opening[target[nodes, edits]], end)
    rank = np.append(edits + 1, 0)
    length = np.append(np.ones(end, dtype=np.int64), 0)
    doubled = [follow]
    while (follow != end).any():
        pair = rank * (int(rank.max()) + 1) + rank[follow]
        rank = np.unique(pair, return_inverse=True)[1]
        length = length + length[follow]
        follow = follow[follow]
        doubled.append(follow)
    # The first node's arcs compared by the rank of their whole audits.
    start = first * 4
    ranked = np.where(number[start] >= 0, np.append(rank, 0)[number[start]], len(nodes) + 1)
    begin = np.where(has[start], number[start, np.argmin(ranked, axis=1)], end)
    sizes = length[begin]
    at = np.repeat(begin, sizes)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for bit, step in enumerate(doubled):
        odd = (place >> bit) & 1 == 1
        at[odd] = step[at[odd]]
    text = LABELS[edits[at]].tobytes() if len(at) else b""
    edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return [text[a:b] for a, b in zip(edge, edge[1:])]


class Applied:
    """One conversation's audit, applied to its rows as they come, and hashed."""

    def __init__(self, audit: bytes):
        self.audit, self.at, self.state, self.total, self.empty = audit, 0, 0, hashlib.sha256(), True

    def put(self, line: bytes) -> None:
        self.total.update(line if self.empty else b"\n" + line)
        self.empty = False

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == b"I":
            self.at += 1
            self.state = int(NEXT[self.state])
            self.put(ROLES[self.state])

    def row(self, role: bytes, text: bytes) -> None:
        self.inserts()
        edit, self.at = self.audit[self.at : self.at + 1], self.at + 1
        if edit == b"K":
            self.state = int(KEPT[self.state, b"sua".find(role[:1]) + 1])
            self.put(role + b":" + text)
        elif edit == b"R":
            self.state = int(NEXT[self.state])
            self.put(ROLES[self.state] + text)

    def digest(self) -> str:
        self.inserts()
        return self.total.hexdigest()


def hashed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`found` (`AUDITS`) with the hash of each repaired conversation: an audit comes first, its rows follow in order."""
    names = ["conv_id", *SUMMARY, "audit"]
    texts = rows.where("alive").select(
        "conv_id", F.lit(1).alias("step"), "turn", F.col("role"), turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.col("text"),
    )
    both = found.withColumn("step", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "step", *in_order("turn", "role", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            step = batch.column("step").to_pylist()
            role, text = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text"))
            for n, s in enumerate(step):
                if s:
                    current.row(role[n], text[n])
                    continue
                if current:
                    done[-1]["repaired_sha256"] = current.digest()
                if len(done) >= TOGETHER:
                    yield pa.RecordBatch.from_pylist(done, RESULT)
                    done = []
                done.append({c: batch.column(c)[n].as_py() for c in names})
                current = Applied(done[-1]["audit"])
                done[-1]["audit"] = done[-1]["audit"].decode()
        if current:
            done[-1]["repaired_sha256"] = current.digest()
        yield pa.RecordBatch.from_pylist(done, RESULT)

    return ordered.select(*names, "step", "role", "text").mapInArrow(run, AUDITS.replace("binary", "string") + ", repaired_sha256 string")


RESULT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in SUMMARY], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """Counts of faults, cheapest edits and repaired form of each conversation of `rows` (conv_id, turn, alive, role, text).

    Columns: conv_id, gaps (numbers missing between the least and the greatest turn), blank, duplicate, truncated (rows by their
    first fault), illegal (neighbouring roles that do not alternate), cost, audit (initials of the edits in order) and
    repaired_sha256 (repaired `role:text`, a line each).
    """
    return hashed(rows, audits(rows))
