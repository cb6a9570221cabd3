"""Exact duplicates against grouping by the whole normalised text."""

import random
import re
from collections import defaultdict
from hashlib import sha256

from tierflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id bigint, text string, run string, gid int, n int"


def plain(text):
    return re.sub(r"[\x20\x09-\x0d]", "", text or "")


def test_groups_winners_and_digests(spark):
    draw = random.Random(3)
    stem = "".join(draw.choice("ab ") for _ in range(3000))
    texts = [stem[: draw.choice([0, 1, 31, 32, 33, 159, 160, 161, 900, 3000])] for _ in range(150)]
    texts = [t.replace("a", "a ", draw.randint(0, 3)) + draw.choice(["", "", " ", "\n", "z", "é"]) for t in texts]
    texts += [None, "", " \t\x0b", "\x1c", " ", "x" * 100_000, "x" * 99_999 + "y", " " + "x" * 100_000]
    rows = [(1000 - i, t, "r", 7, 1) for i, t in enumerate(texts)]
    got = {r.row.doc_id: r for r in exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[plain(t)].append((-len(t or ""), i))
    assert len(got) == len(rows)
    for body, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), i == keep)
            assert r.text_sha256 == sha256(body.encode()).hexdigest()


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(None, "same text", "a", 1, 2), (5, "same text", "b", 1, 2), (5, "same text", "b", 1, 2), (None, None, "c", 0, 0),
            (None, "", "d", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = exact_duplicates(df).collect()
    assert len(out) == 5 and sum(r.kept for r in out) == 2
    assert {(r.row.text or "", r.keep_id, r.group_size) for r in out} == {("same text", 5, 3), ("", None, 2)}
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns and kept.count() == 2


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_sieve_lets_every_key_through_and_little_else(spark):
    from pyspark.sql import functions as F

    from tierflow.llm.shared import sieve, sifted

    keys, others = spark.range(5000).selectExpr("CAST(id AS STRING) AS k"), spark.range(5000, 25000).selectExpr("CAST(id AS STRING) AS k")
    bits = sieve(keys, F.col("k"))
    assert sifted(keys, F.col("k"), bits, "hit").where("NOT hit").isEmpty()
    assert sifted(others, F.col("k"), bits, "hit").where("hit").count() < 50
    assert sifted(others, F.col("k"), bits.limit(0), "hit").where("hit").isEmpty()


def test_rows_that_bring_their_text_store_it_once(spark, monkeypatch):
    import tierflow.llm.exact_dedup as module

    tables = []

    def split_table(df, path, whole=module.split_table):
        tables.append(df.columns)
        return whole(df, path)

    monkeypatch.setattr(module, "split_table", split_table)
    body = "the same first words for all of them, and then "
    rows = [(i, body * 3 + "ab"[i % 2] + " " * i, "x") for i in range(6)] + [(9, None, "x"), (8, " ", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, body string, text string")
    kept = module.drop_exact_duplicates(df, text="body")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 8]
    assert tables and all("text" not in columns for columns in tables)
    slim = module.exact_duplicates(df, text="body", columns=["doc_id"])
    assert sorted(r.row.doc_id for r in slim.where("kept").collect()) == [4, 5, 8]
