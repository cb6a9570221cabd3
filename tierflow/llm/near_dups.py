"""Near duplicates: n-gram Jaccard similarity join over a MinHash LSH forest, verified exactly.

A text is the set of its runs of five words. Every distinct text gets `TREES` MinHash signatures of `DEPTH` values;
a signature is a path in the prefix trie of its tree, and texts that share a prefix of length d meet in one node.
Texts at the threshold meet in some tree with probability 1 - (1 - t^d)^TREES, so the forest is searched at the longest
prefix length d that reaches the target; what meets at a longer prefix meets there as well. The default leaves a pair of
texts exactly at 0.8 unmet with probability 1.3e-5, and a closer pair more rarely. Then all pairs within a group of texts
that met are compared on their shingle sets and links below the threshold are discarded; classes are the connected
components of the links that remain.

Scale: identical texts are one node with a count, so copies are never paired. Nodes of the tries are map-side combined
aggregates (least and greatest group), never lists. A large group is cut into blocks of bounded rows and bytes, one task
per pair of blocks; a task returns link counts and a spanning forest of its links, never pairs. Counting links between
m texts that really are all alike takes m^2 / 2 comparisons; nothing else is quadratic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.shared import quoted, row_of, sieve, sifted, stored
from tierflow.llm.words import Words, mixed, portions, run_hashes, words_of

TREES, DEPTH, STEP_UP = 48, 12, 3
BLOCK_ROWS, BLOCK_BYTES = 1024, 8 << 20


def depths(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH, step: int = STEP_UP) -> list[int]:
    """Prefix lengths to search, longest first; the last one reaches the target recall at the threshold."""
    last = depth
    while last > 1 and 1 - (1 - threshold**last) ** trees < recall:
        last -= 1
    return [*range(depth, last, -step), last]


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `n` words and where each document's begin; a shorter text is one run of all its words."""
    at, grams = words.grams(n)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole = np.array(
            [run_hashes(words.hashes, words.first[i : i + 1], int(words.counts[i]))[0] for i in short], dtype=np.uint64
        )
        at, grams = np.concatenate([at, words.first[short]]), np.concatenate([grams, whole])
        order = np.argsort(at, kind="stable")
        at, grams = at[order], grams[order]
    return grams, np.searchsorted(at, words.first)


def prefix_hashes(grams: np.ndarray, first: np.ndarray, lengths: list[int]) -> np.ndarray:
    """For each document with shingles: a hash per tree and prefix length, longest first."""
    full = np.flatnonzero(np.diff(first))
    low = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    draw = np.random.default_rng(7)
    out = np.zeros((len(full), TREES, len(lengths)), dtype=np.uint64)
    for tree in range(TREES):
        path = np.full(len(full), tree + 1, dtype=np.uint64)
        for level in range(1, lengths[0] + 1):
            a, b = (np.uint32(x) for x in draw.integers(0, 1 << 32, 2))
            with np.errstate(over="ignore"):
                value = low * (a | np.uint32(1)) + b
                least = np.minimum.reduceat(value ^ (value >> np.uint32(15)), first[full])
                path = mixed(path + least.astype(np.uint64))
            if level in lengths:
                out[:, tree, lengths.index(level)] = path
    return out.reshape(len(full), TREES * len(lengths))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
) -> DataFrame:
    """One row per row of `docs`: key (digest of the text), doc_id, class_id, links, kept.

    class_id is the smallest id in the class; links counts the other rows whose text is similar enough, copies
    included. `kept` marks the row with that id. Null ids come after all others; a class of null ids alone has a
    null class_id. Texts without words have no shingles: equal ones are copies of each other and of nothing else.
    An empty table gives an empty result.
    """
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    lengths = depths(threshold, recall)[-1:]  # what a longer prefix joins, this one joins too

    # One node per distinct text; its number is given when the table is written.
    nodes = stored(
        rows.groupBy(key.alias("key")).agg(
            F.count(F.lit(1)).alias("copies"), F.min("id").alias("id")
        ).withColumn("node", F.monotonically_increasing_id()),
        "near-nodes",
    )

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                grams, first = shingles(words_of(part.column("text")), shingle)
                full = np.flatnonzero(np.diff(first))
                paths = prefix_hashes(grams, first, lengths).astype(np.int64)
                ends = np.arange(len(full) + 1, dtype=np.int32) * paths.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(full)),
                        part.column("id").take(pa.array(full)),
                        pa.ListArray.from_arrays(ends, pa.array(paths.ravel())),
                    ],
                    ["key", "id", "paths"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    paths = rows.select(key.alias("key"), "id", "text").mapInArrow(
        signed, f"key string, id {id_type}, paths array<bigint>"
    )
    # The row with the node's own id speaks for its copies; joining on both spreads a pile of copies over all tasks.
    own = nodes.select(F.col("key").alias("n_key"), F.col("id").alias("n_id"), "node")
    meets = stored(
        paths.join(own.hint("merge"), (F.col("key") == F.col("n_key")) & F.col("id").eqNullSafe(F.col("n_id")))
        .dropDuplicates(["node"])
        .select("node", F.posexplode("paths").alias("slot", "path"))
        .select("node", (F.col("slot") % len(lengths)).alias("step"), "path"),
        "near-meets",
    )
    label = nodes.select("node", F.col("node").alias("grp"))
    for step in range(len(lengths)):
        here = meets.where(F.col("step") == step).join(label.hint("merge"), "node").select("path", "grp").distinct()
        joint = here.groupBy("path").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high")
        pairs = stored(
            here.join(joint.select("path", "low").hint("merge"), "path").where("grp > low").select(
                F.col("grp").alias("a"), F.col("low").alias("b")
            ).distinct(),
            "near-pairs",
        )
        roots = components(pairs)
        label = stored(
            label.join(roots.hint("merge"), label["grp"] == roots["member"], "left").select(
                "node", F.coalesce("root", "grp").alias("grp")
            ),
            "near-groups",
        )
    verified = verify(rows.select(key.alias("key"), "id", "text"), nodes, label, shingle, threshold)
    linked = components(verified.where("kind = 'edge'").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = verified.where("kind = 'links'").groupBy("node").agg(F.sum("n").alias("similar"))
    classed = (
        nodes.join(counts, "node", "left")
        .join(linked, nodes["node"] == linked["member"], "left")
        .select(
            "key",
            (F.coalesce("similar", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root", "node").alias("class"),
            "id",
        )
    )
    classed = stored(classed, "near-classes")
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key"))
    names = stored(classed.groupBy("class").agg(best.alias("best")), "near-names")
    result = stored(classed.join(names, "class").select(F.col("key").alias("c_key"), "links", "best"), "near-result")
    return rows.select(key.alias("key"), "id").join(result.hint("merge"), F.col("key") == F.col("c_key")).select(
        "key",
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("class_id"),
        "links",
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))).alias("kept"),
    )


def verify(rows: DataFrame, nodes: DataFrame, label: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Links of the texts that share a group: rows (kind 'links': node, n) and (kind 'edge': node, other)."""
    sizes = label.groupBy("grp").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = label.join(sizes, "grp").join(nodes, "node").select("key", "id", "node", "copies", "grp", "members")
    # One row of each text: the copies have the same node, and the one with the node's id stands for them.
    wanted = stored(sieve(members, F.struct("key", "id")), "near-sieve")
    texts = stored(
        sifted(rows, F.struct("key", "id"), wanted, "member").where("member").join(
            members.withColumnRenamed("key", "m_key").withColumnRenamed("id", "m_id").hint("merge"),
            (F.col("key") == F.col("m_key")) & F.col("id").eqNullSafe(F.col("m_id")),
        )
        .select("node", "copies", "grp", "members", "text")
        .dropDuplicates(["node"]),
        "near-texts",
    )
    blocks = F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES), F.lit(1)
    )
    bulk = stored(texts.groupBy("grp").agg(blocks.cast("int").alias("blocks")), "near-blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (
        texts.join(bulk.hint("merge"), "grp")
        .withColumn("block", own)
        .withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "grp",
            F.least("block", "peer").alias("low"),
            F.greatest("block", "peer").alias("high"),
            "block", "node", "copies", "text",
        )
    )
    schema = "kind string, node bigint, other bigint, n bigint"

    def compare(group: pa.Table) -> pa.Table:
        return compared(group, shingle, threshold)

    return stored(placed.groupBy("grp", "low", "high").applyInArrow(compare, schema), "near-links")


def compared(group: pa.Table, shingle: int, threshold: float) -> pa.Table:
    """Similar pairs of one group (or between its two blocks) as link counts and a spanning forest."""
    group = group.combine_chunks()
    node = group.column("node").to_numpy()
    copies = group.column("copies").to_numpy()
    block = group.column("block").to_numpy()
    links = np.zeros(len(node), dtype=np.int64)
    root = list(range(len(node)))
    edges: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    cross = group.column("low")[0] != group.column("high")[0]
    for i, j in similar_pairs(group.column("text").chunk(0), shingle, threshold):
        if cross and block[i] == block[j]:
            continue
        links[i] += copies[j]
        links[j] += copies[i]
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            edges.append((i, j))
    has = np.flatnonzero(links)
    none = [None] * len(has)
    return pa.table(
        {
            "kind": pa.array(["links"] * len(has) + ["edge"] * len(edges), pa.string()),
            "node": pa.array([*node[has], *(node[i] for i, _ in edges)], pa.int64()),
            "other": pa.array([*none, *(node[j] for _, j in edges)], pa.int64()),
            "n": pa.array([*links[has], *([None] * len(edges))], pa.int64()),
        }
    )


def similar_pairs(texts: pa.Array, shingle: int, threshold: float, strip: int = 512, width: int = 8192) -> Iterator:
    """Pairs i < j of texts whose shingle sets have a Jaccard similarity of `threshold` or more.

    Overlaps are counted as products of 0/1 matrices, a strip of documents by a run of shingles at a time.
    """
    grams, first = shingles(words_of(texts), shingle)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    values, column = np.unique(grams, return_inverse=True)
    cell = np.unique(owner * max(1, len(values)) + column)
    owner, column = np.divmod(cell, max(1, len(values)))
    size = np.bincount(owner, minlength=len(first) - 1)
    shared = np.bincount(column, minlength=len(values)) > 1  # the others count in sizes alone
    rank = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], rank[column[shared[column]]]
    total, width = len(size), max(1, min(width, int(shared.sum())))
    for low in range(0, total, strip):
        high = min(total, low + strip)
        for low2 in range(low, total, strip):
            high2 = min(total, low2 + strip)
            overlap = np.zeros((high - low, high2 - low2), dtype=np.float32)
            for at in range(0, int(shared.sum()), width):
                run = (column >= at) & (column < at + width)

                def matrix(a: int, b: int) -> np.ndarray:
                    out = np.zeros((b - a, width), dtype=np.float32)
                    mine = run & (owner >= a) & (owner < b)
                    out[owner[mine] - a, column[mine] - at] = 1
                    return out

                left = matrix(low, high)
                overlap += left @ (left if low2 == low else matrix(low2, high2)).T
            union = size[low:high, None] + size[None, low2:high2] - overlap
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = (overlap > 0) & (overlap >= threshold * union - 1e-6)
            for i, j in zip(*np.nonzero(hit)):
                if low + i < low2 + j:
                    yield low + int(i), low2 + int(j)


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how: float) -> DataFrame:
    """The row with the smallest id of each class, with the columns of `docs`; of equal rows with that id, one."""
    found = near_duplicates(docs, text, doc_id, **how).groupBy(
        F.col("key").alias("k_key"), F.col("doc_id").alias("k_id")
    ).agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    found = stored(found, "near-found")
    # Rows that stay and are the only ones of their text and id need not move.
    moved = stored(sieve(found.where("NOT kept OR n > 1"), F.struct("k_key", "k_id")), "near-sieve")
    rows = docs.select(
        row_of(docs).alias("row"),
        F.md5(F.coalesce(F.col(quoted(text)), F.lit("")).cast("binary")).alias("key"),
        F.col(quoted(doc_id)).alias("id"),
    )
    marked = sifted(rows, F.struct("key", "id"), moved, "moves")
    kept = found.where("kept").hint("merge")
    judged = (
        marked.where("moves")
        .join(kept, (F.col("key") == F.col("k_key")) & F.col("id").eqNullSafe(F.col("k_id")), "left_semi")
        .dropDuplicates(["key", "id"])
    )
    return marked.where("NOT moves").select("row.*").unionAll(judged.select("row.*"))
