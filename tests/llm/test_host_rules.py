"""Host rules: measures by plain Python, awkward rows against the SQL, and hosts that differ."""

import duckdb

from compare import differences
from tierflow.llm.host_rules import LIMIT, MEASURES, by_host, host_verdicts, judged_by_host, measured, prior
from tierflow.llm.queries import QUERIES, SQL

SCHEMA = "doc_id bigint, text string, source string, n_words string, host string, row int, kept string"
GOOD = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) for i in range(6))
BAD = "buy now " * 40


def plain(text):
    blanks = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in blanks else c for c in text or "").split(" ")
    words = [w for w in words if w]
    lines = [line for line in (text or "").split("\n") if line.strip(blanks)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + s for i, g in enumerate(grams) if grams.count(g) > 1 for s in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered))


def awkward():
    texts = [None, "", " \t\n", "a a a a", "a b c a b c", "x\n\n x\nx\n x", "é ü 漢字 | é ü 漢字 #", GOOD, BAD, GOOD + "\r\n" + GOOD,
             "long " * 20_000, "\n", "a b c", "one two three four one two three"]
    rows = [(i, t, s) for i, (t, s) in enumerate((t, s) for t in texts for s in ("Farm.com", "farm.com ", None, "", "ok.org"))]
    rows += rows[:20] + [(None, GOOD, "ok.org"), (None, None, None)]
    rows += [(1000 + i, BAD, "spam.net") for i in range(60)] + [(1100, GOOD, "spam.net")]
    rows += [(2000 + i, GOOD, f"site{i % 30}.org") for i in range(300)]
    return [(*r, "w", "h", 1, "k") for r in rows]


def test_measures(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    got = measured(df, columns=["doc_id", "text"]).collect()
    assert len(got) == len(awkward())
    known = {}
    for r in got:
        if r.row.text not in known:
            known[r.row.text] = plain(r.row.text) if len(r.row.text or "") < 5_000 else None
        if known[r.row.text]:
            assert tuple(r[m] for m in MEASURES) == known[r.row.text], r.row.text


def test_awkward_rows_give_the_stated_result(spark, area):
    for name, rows in (("some", awkward()), ("none", [])):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{area}/{name}/documents.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{area}/{name}/documents.parquet/*.parquet')")
        assert differences(QUERIES["op11_host_rules"](spark, f"{area}/{name}"), SQL["op11_host_rules"], con) == []


def test_a_failing_host_is_refused_and_small_hosts_are_shrunk(spark):
    rows = [(i, BAD, "spam.net") for i in range(60)] + [(100, GOOD, "spam.net"), (101, BAD, "tiny.org"), (102, GOOD, "tiny.org")]
    rows += [(200 + i, GOOD, f"site{i % 30}.org") for i in range(300)] + [(900, GOOD, None)]
    df = spark.createDataFrame([(*r, "w", "h", 1, "k") for r in rows], SCHEMA)
    kept = {r.row.doc_id: r.kept for r in judged_by_host(df).collect()}
    assert not kept[100] and not kept[0] and not kept[101]
    assert kept[102] and kept[900] and all(kept[200 + i] for i in range(300))
    verdicts = {r.host: r for r in host_verdicts(by_host(measured(df))).collect()}
    assert verdicts["spam.net"].rate_repetitive > LIMIT > verdicts["tiny.org"].rate_repetitive
    assert 0 < verdicts["site3.org"].rate_repetitive < 0.1


def test_the_prior_follows_how_much_hosts_differ():
    alike = prior(hosts=100, n=10_000, nn=100 * 100.0**2, x=1_000, xx=100 * 10**2 / 100)
    apart = prior(hosts=100, n=10_000, nn=100 * 100.0**2, x=1_000, xx=10 * 100.0**2 / 100)
    assert alike.weight > 1_000 > 1 > apart.weight
    assert abs(alike.failed / alike.weight - 0.1) < 1e-3
    assert prior(0, 0, 0.0, 0, 0.0).weight > 0
