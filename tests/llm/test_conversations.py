"""Conversation trie and turn repair on awkward rows, against their SQL and against plain Python."""

import hashlib
import random
import zlib
from functools import cache

import duckdb
import pytest

from compare import differences
from tierflow.llm import prefix_trie, turn_repair
from tierflow.llm.queries import QUERIES, SQL

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, depth string, keys int, audit string, step string, digest string,"
          " n_convs int")
NAMES = ("op12_conversation_trie", "op13_turn_repair")


def talk(conv, turns):
    return [(conv, n, role, text) for n, (role, text) in enumerate(turns)]


def awkward():
    rng = random.Random(7)
    out = []
    for conv in [*range(-250, 700, 7), *range(0, 700, 100), 10**12]:
        roles = rng.choice([["system", "user", "assistant"], ["user", "assistant"], ["user", "user", "tool"], ["", "a", "u"]])
        for turn in range(rng.randrange(9)):
            text = rng.choice(["Hi.", "yes!", "no", "", " ", "a\tb?", "Ünïcode.", "cut off", "..", "Hi.", None])
            out.append((conv, turn + 2 * (rng.random() < 0.1), rng.choice([*roles, roles[turn % len(roles)], None]), text))
    out += [r for conv in range(2001, 2060) for r in talk(conv, [("user", "Same."), ("assistant", "Copy.")])]
    out += talk(3000, [("user", "a."), ("assistant", "b.")] * 220) + talk(3001, [("user", f"long {n} ") for n in range(300)])
    out += [(4000, None, "user", "null turn."), (4000, 1, None, None), (4000, 1, "user", "tie."), (4000, 1, "assistant", "tie."),
            (4000, 1, "user", "tie."), (4000, None, None, ""), (4001, 0, "user", "word " * 30_000 + "end"),
            (None, 0, "user", "no id."), (None, None, None, None), (5000, -4, "user", "x."), (5000, 9, "assistant", "y\n")]
    rng.shuffle(out)
    return [(*r, "d", 1, "a", "s", "g", 2) for r in out]


def stored(spark, area, rows):
    path = f"{area}/conversations.parquet"
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("rows", [awkward(), []], ids=["awkward", "empty"])
def test_awkward_rows_give_the_stated_result(spark, area, name, rows):
    con = stored(spark, area, rows)
    assert differences(QUERIES[name](spark, area), SQL[name], con) == []


@pytest.mark.parametrize("fan_in, rows_per_range", [(2, 3), (3, 20), (64, 1)])
def test_forests_of_many_ranges_merge_to_one(spark, area, monkeypatch, fan_in, rows_per_range):
    """Groups of copies and long paths across many ranges, merged over several rounds."""
    monkeypatch.setattr(prefix_trie, "FAN_IN", fan_in)
    monkeypatch.setattr(prefix_trie, "RANGE_ROWS", rows_per_range)
    monkeypatch.setattr(prefix_trie, "parallelism", lambda df: 29)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 4)
    con = stored(spark, area, awkward())
    assert differences(QUERIES["op12_conversation_trie"](spark, area), SQL["op12_conversation_trie"], con) == []


def test_trie_of_one_conversation(spark):
    rows = [(7, 0, "user", "héé"), (7, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.depth, *r) for r in prefix_trie.trie(prefix_trie.paths_of(df)).collect())
    ended, empty = (hashlib.sha256(x).hexdigest() for x in (b"7", b""))
    assert got == [(0, 7, 0, None, 1, 1, 1, 0, empty), (1, 7, 1, 7, 1, 1, 1, 0, empty), (2, 7, 2, 7, 1, 0, 1, 0, ended)]


def least_edits(turns):
    """(cost, audit, lines) by plain recursion; turns are (role, text) after damage."""
    seen, fault = set(), []
    for role, text in turns:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault.append("go" if not bare or (role, text) in seen else "cut" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserts=0):
        ways = [(0, "", ())] if i == len(turns) and state in ("", "a") else []
        if inserts < 3:
            cost, audit, lines = best(i, after[state], inserts + 1)
            ways.append((cost + 5, "I" + audit, (name[after[state]] + ":", *lines)))
        if i < len(turns):
            (role, text), extra = turns[i], 5 * (fault[i] == "cut")
            cost, audit, lines = best(i + 1, state)
            ways.append((cost + 2, "D" + audit, lines))
            if fault[i] != "go":
                if role[:1] == after[state] or (role[:1] == "s" and state == ""):
                    cost, audit, lines = best(i + 1, role[:1])
                    ways.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, after[state])
                ways.append((cost + 1 + extra, "R" + audit, (f"{name[after[state]]}:{text}", *lines)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    return best(0, "")


def test_repair_is_the_least_of_all_edits(spark):
    rng = random.Random(3)
    convs = {
        c: [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b!", "cut", "", "c?"])) for _ in range(rng.randrange(8))]
        for c in range(400)
    }
    rows = [(c, n, True, *t) for c, turns in convs.items() for n, t in enumerate(turns)] + [(c, None, False, "x", "y") for c in convs]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, alive boolean, role string, text string")
    for r in turn_repair.repaired_conversations(df).collect():
        cost, audit, lines = least_edits(convs[r.conv_id])
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), convs[r.conv_id]


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in (0, 1, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.conv_id, -1 if r.turn is None else r.turn, r.role, r.text) for r in turn_repair.damaged(df).where("alive").collect())
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "One Two Three"}.get(fate, text)
        want += [(c, -1 if t is None else t, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    assert got == sorted(want)


def test_rows_of_one_conversation_over_many_batches(spark, monkeypatch):
    """Conversations that begin and end anywhere in Arrow batches of a few rows."""
    monkeypatch.setattr(turn_repair, "TOGETHER", 5)
    rows = [(c, t, True, ["user", "assistant"][t % 2], f"{c} {t}.") for c in range(30) for t in range(1 + c % 11)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, alive boolean, role string, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = {r.conv_id: (r.cost, r.audit) for r in turn_repair.repaired_conversations(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {c: ((1 + c % 11) % 2 * 2, "K" * (c % 11 + 1) if (1 + c % 11) % 2 == 0 else least_edits(
        tuple((["user", "assistant"][t % 2], f"{c} {t}.") for t in range(1 + c % 11)))[1]) for c in range(30)}
