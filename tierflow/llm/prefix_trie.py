"""The prefix trie of conversations, from sorted neighbours.

Conversations are sorted by their turns. How many turns two neighbours share (their LCP) is an edge between them; taken in
descending depth by union-find, an edge of depth d joins two components under the node of depth d that both lie below, so
every merge makes a branching node, or widens one, and the turns between a component's top and d are a chain below it.

Sorted conversations are cut into ranges. A range builds its forest alone: nodes that neither its first nor its last
conversation reaches are closed and final. The others, on the paths of those two, stay open: what hangs below an open node
inside the range is contracted into a few numbers on it (members, children, leaves, saved). Contracted forests of `FAN_IN`
adjacent ranges are merged by the same procedure, with paths in place of conversations, until one is left.

Defined results: turns go by number, null first; turns of one number by role, then by digest of role and text; null role or
text is empty; rows without a conv_id belong to no conversation; an empty table has no nodes, not even a root. Repeated
rows are turns of their own, copies of whole conversations members of the same nodes. Extra columns are ignored. Equality
of turns rests on 128-bit digests; very long texts only cost their digest.

Scale: texts never leave the scan; a turn is 16 bytes and a length. A conversation is one row of those and must fit a task,
as must a range (about `RANGE_BYTES`); copies are told apart by conv_id, so a group of copies of any size is cut as well.
The contracted forests are two paths per range, whatever its size. The members that end at an open node are hashed in a
stream, chunk by chunk in order, since one hash over them is what is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import parallelism, stored
from tierflow.llm.turns import DIGEST_BYTES, turn_digest

RANGE_BYTES, RANGE_ROWS = 16 << 20, 2_000
#: So many contracted forests are merged by one task.
FAN_IN = 64
CHUNK_IDS = 50_000
#: A conversation takes its first turns from the one whose number is the last multiple of this, ...
FAMILY = 100
#: ... fewer than this many of them.
HEADS = 6

NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE, SPINE, ENDS = 0, 1, 2
OUT = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends_sha256 string, own_ref binary, parent_ref binary, part bigint, place bigint, keys binary,"
    " chars binary, extras binary"
)
COLUMNS = [c.strip().split(" ")[0] for c in OUT.split(",")]
ARROW = dict(zip(COLUMNS, [pa.int32()] + [pa.int64()] * 7 + [pa.string()] + [pa.binary()] * 2 + [pa.int64()] * 2 + [pa.binary()] * 3))


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of digest and length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"), role.alias("role"), turn_digest(role, text).alias("digest"),
            F.char_length(text).alias("chars"),
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    turns = F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Each conversation begins with the first turns of its family's first one and goes on with its own after as many."""
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    firsts = paths.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, HEADS - 1).alias("first")
    )
    joined = paths.withColumn("of", F.col("conv_id") - F.col("conv_id") % FAMILY).join(
        firsts, F.col("of") == F.col("family"), "left"
    )
    begin = F.when(F.col("first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("first", F.lit(1), head))
    own = F.slice("turns", head + 1, F.greatest(F.size("turns") - head, F.lit(0)))
    return joined.select("conv_id", F.concat(begin, own).alias("turns"))


def flat(paths: DataFrame) -> DataFrame:
    """A stored table (conv_id, keys, chars): digests end to end, in whose byte order prefixes come first, and lengths."""

    def joined(field: str) -> Column:
        return F.unhex(F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t[field]), 8 if field == "chars" else 32, "0")), ""))

    return stored(paths.select("conv_id", joined("digest").alias("keys"), joined("chars").alias("chars")), "paths")


class Path:
    """A conversation, or a range's first or last path; `extras` maps depths to what is known of the nodes on it.

    An entry is [members, least member, children, leaves, saved, ids of the members that end there].
    """

    __slots__ = ("keys", "chars", "extras", "size")

    def __init__(self, keys: bytes, chars: np.ndarray, extras: dict[int, list]):
        self.keys, self.chars, self.extras, self.size = keys, chars, extras, len(keys) // DIGEST_BYTES


def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with in common."""
    low, high = 0, min(len(a), len(b)) // DIGEST_BYTES
    if a[: high * DIGEST_BYTES] == b[: high * DIGEST_BYTES]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        at = middle * DIGEST_BYTES
        low, high = (middle, high) if a[:at] == b[:at] else (low, middle)
    return low


def reference(path: Path, depth: int) -> bytes:
    return hashlib.sha256(path.keys[: depth * DIGEST_BYTES]).digest()[:DIGEST_BYTES]


def ids_text(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


class Forest:
    """The trie of sorted `paths`; `last` closes all nodes, otherwise those on the first and last path stay open."""

    def __init__(self, paths: list[Path], part: int, last: bool, named: bool):
        self.paths, self.part, self.last, self.named = paths, part, last, named
        self.rows: list[list] = []
        self.open: tuple[dict, dict] = ({}, {})
        depths = self.gather()
        self.above = list(range(len(paths)))
        self.low, self.high = list(range(len(paths))), list(range(len(paths)))
        self.top = [p.size for p in paths]
        self.node = [self.at(i, p.size) for i, p in enumerate(paths)]
        self.waiting: list[list[int]] = [[] for _ in paths]
        for edge in np.argsort(-np.array(depths, dtype=np.int64), kind="stable").tolist():
            self.merge(edge, edge + 1, depths[edge])
        if paths:
            root = self.find(0)
            self.lift(root, 0)
            self.finish(root)

    def gather(self) -> list[int]:
        """LCP of neighbours. What several paths know of one node moves to the first of them."""
        depths, home = [], [0] * (self.paths[0].size + 1) if self.paths else []
        for i in range(1, len(self.paths)):
            path, common = self.paths[i], shared(self.paths[i - 1].keys, self.paths[i].keys)
            depths.append(common)
            home = home[: common + 1] + [i] * (path.size - common)
            for depth in [d for d in path.extras if d <= common]:
                known, more = self.paths[home[depth]].extras.get(depth), path.extras.pop(depth)
                self.paths[home[depth]].extras[depth] = more if known is None else added(known, more)
        return depths

    def at(self, path: int, depth: int) -> list:
        return self.paths[path].extras.pop(depth, None) or [0, None, 0, 0, 0, []]

    def find(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def merge(self, a: int, b: int, depth: int) -> None:
        a, b = self.find(a), self.find(b)
        for c in (a, b):
            self.lift(c, depth)
        keep, gone = (a, b) if len(self.waiting[a]) >= len(self.waiting[b]) else (b, a)
        self.above[gone] = keep
        self.low[keep], self.high[keep] = self.low[a], self.high[b]
        self.node[keep] = added(self.node[a], self.node[b])
        self.waiting[keep] += self.waiting[gone]
        self.waiting[gone] = []

    def lift(self, c: int, depth: int) -> None:
        """Finish the nodes of a component that lie deeper than `depth`."""
        while self.top[c] > depth:
            below = self.finish(c)
            self.top[c] -= 1
            self.node[c] = added(self.at(self.low[c], self.top[c]), below)

    def finish(self, c: int) -> list:
        """All is known of the top node of a component: emit it, or leave it open. Returns what its parent gets."""
        depth, low, high, first = self.top[c], self.low[c], self.high[c], self.paths[self.low[c]]
        members, least, children, leaves, saved, ends = self.node[c]
        is_open = not self.last and (low == 0 or high == len(self.paths) - 1)
        if is_open:
            own = reference(first, depth)
            for row in self.waiting[c]:
                self.rows[row][COLUMNS.index("parent_ref")] = own
            self.waiting[c] = []
            self.open[0 if low == 0 else 1][depth] = [members, least, children, leaves, saved]
            for n, start in enumerate(range(0, len(ends), CHUNK_IDS)):
                self.rows.append(record(kind=ENDS, own_ref=own, part=self.part, place=n,
                                        extras=ids_text(ends[start : start + CHUNK_IDS])))
            return [0, None, 0, 0, 0, []]
        for row in self.waiting[c]:
            self.rows[row][COLUMNS.index("parent_conv_id")] = least
        leaves = leaves or 1
        saved += (members - 1) * int(first.chars[depth - 1]) if depth else 0
        self.waiting[c] = [len(self.rows)]
        self.rows.append(record(
            kind=NODE, conv_id=least, depth=depth, n_convs=members, n_children=children, n_leaves=leaves, saved_tokens=saved,
            ends_sha256=None if self.named else hashlib.sha256(ids_text(ends)).hexdigest() if ends else NO_ENDS,
            own_ref=reference(first, depth) if self.named else None,
        ))
        return [members, least, 1, leaves, saved, []]

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Finished nodes, chunks of ends and, of a forest that is still open, its contracted paths."""
        for place, (found, path) in enumerate(zip(self.open, (0, -1))):
            if found:
                table = np.array([[depth, members, least is not None, least or 0, children, leaves, saved]
                                  for depth, (members, least, children, leaves, saved) in sorted(found.items())], dtype=np.int64)
                p = self.paths[path]
                self.rows.append(record(kind=SPINE, part=self.part, place=place, keys=p.keys,
                                        chars=np.asarray(p.chars, dtype=">u4").tobytes(), extras=table.tobytes()))
        for start in range(0, len(self.rows), 10_000):
            columns = zip(*self.rows[start : start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, ARROW[n]) for n, c in zip(COLUMNS, columns)], COLUMNS)


def record(**values) -> list:
    return [values.get(c) for c in COLUMNS]


def added(a: list, b: list) -> list:
    least = a[1] if b[1] is None else b[1] if a[1] is None else min(a[1], b[1])
    return [a[0] + b[0], least, a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] + b[5] if b[5] else a[5]]


def conversations_of(batches: Iterator[pa.RecordBatch]) -> list[Path]:
    """Sorted conversations as paths; copies follow one another and become one."""
    paths: list[Path] = []
    for batch in batches:
        for conv, keys, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "keys", "chars"))):
            if paths and paths[-1].keys == keys:
                known = paths[-1].extras[paths[-1].size]
                known[0] += 1
                known[1] = min(known[1], conv)
                known[5].append(conv)
            else:
                paths.append(Path(keys, np.frombuffer(chars, dtype=">u4"), {len(keys) // DIGEST_BYTES: [1, conv, 0, 0, 0, [conv]]}))
    return paths


def spines_of(group: pa.Table) -> list[Path]:
    """The contracted paths of adjacent ranges, in order."""
    rows = group.select(["part", "place", "keys", "chars", "extras"]).to_pylist()
    paths = []
    for r in sorted(rows, key=lambda r: (r["part"], r["place"])):
        table = np.frombuffer(r["extras"], dtype=np.int64).reshape(-1, 7).tolist()
        extras = {d: [n, least if has else None, children, leaves, saved, []] for d, n, has, least, children, leaves, saved in table}
        paths.append(Path(r["keys"], np.frombuffer(r["chars"], dtype=">u4"), extras))
    return paths


def forests(sorted_paths: DataFrame) -> DataFrame:
    """Each range's closed nodes and contracted forest, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from Forest(conversations_of(batches), TaskContext.get().partitionId(), last=False, named=False).batches()

    return stored(sorted_paths.mapInArrow(run, OUT), "forests")


def merged(found: DataFrame, last: bool) -> DataFrame:
    """Contracted forests merged, `FAN_IN` adjacent ones by a task."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py() // FAN_IN
        return pa.Table.from_batches(Forest(spines_of(group), part, last, named=True).batches())

    spines = found.where(F.col("kind") == SPINE)
    return stored(spines.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(run, OUT), "forests")


def ends_of(chunks: DataFrame) -> DataFrame:
    """(e_ref, e_sha256): the hash of all ids that end at an open node; each is read in order and never held whole."""
    ordered = chunks.select("own_ref", "part", "place", "extras").repartition("own_ref").sortWithinPartitions("own_ref", "part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, done = None, None, []
        for batch in batches:
            for ref, text in zip(batch.column("own_ref").to_pylist(), batch.column("extras").to_pylist()):
                if ref != current:
                    if current is not None:
                        done.append((current, total.hexdigest()))
                    current, total = ref, hashlib.sha256(text)
                else:
                    total.update(b"," + text)
        if current is not None:
            done.append((current, total.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["e_ref", "e_sha256"]
        )

    return ordered.mapInArrow(run, "e_ref binary, e_sha256 string")


def ranges_for(paths: DataFrame) -> int:
    rows, size = paths.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("keys") + F.length("chars")), F.lit(0))).first()
    return max(1, -(-size // RANGE_BYTES), min(parallelism(paths), -(-rows // RANGE_ROWS)))


def trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of `paths` (conv_id, turns); see `conversation_trie`."""
    table = flat(paths)
    order = [F.col("keys").asc(), F.col("conv_id").asc()]
    ranged = table.repartitionByRange(ranges_for(table), *order).sortWithinPartitions(*order)
    found = forests(ranged)
    rounds = [found]
    while True:
        top = rounds[-1].where(F.col("kind") == SPINE).agg(F.max("part")).first()[0]
        if top is None:  # there are no conversations
            break
        rounds.append(merged(rounds[-1], last=top < FAN_IN))
        if top < FAN_IN:
            break
    values = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = found.where((F.col("kind") == NODE) & F.col("parent_ref").isNull()).select(*values)
    if len(rounds) == 1:
        return closed
    # What ends at a node is known to the ranges only; nodes that were open there are named by the merges.
    late = rounds[1]
    for more in rounds[2:]:
        late = late.unionByName(more)
    late = stored(
        late.where(F.col("kind") == NODE).join(ends_of(found.where(F.col("kind") == ENDS)), F.col("own_ref") == F.col("e_ref"), "left")
        .withColumn("ends_sha256", F.coalesce("e_sha256", F.lit(NO_ENDS))).select(*values, "own_ref", "parent_ref"),
        "late-nodes",
    )
    names = late.select(F.col("own_ref").alias("p_ref"), F.col("conv_id").alias("p_conv_id"))
    orphans = found.where((F.col("kind") == NODE) & F.col("parent_ref").isNotNull()).select(*values, "parent_ref").unionByName(
        late.where("parent_ref IS NOT NULL").select(*values, "parent_ref")
    )
    adopted = orphans.join(names, F.col("parent_ref") == F.col("p_ref")).withColumn("parent_conv_id", F.col("p_conv_id"))
    return closed.unionByName(late.where("parent_ref IS NULL").select(*values)).unionByName(adopted.select(*values))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, one row per node.

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root: null), n_convs, n_children,
    n_leaves (childless nodes at or below), saved_tokens (over all nodes at or below: members but one times the code points
    of the node's last text) and ends_sha256 (hash of the ascending, comma-joined ids of members that end here).
    """
    return trie(rebuilt(paths_of(conversations)))
