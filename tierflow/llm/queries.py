"""Registered queries of the operators, each with the SQL that states its result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import prefix_trie, quality, toxicity, turn_repair
from tierflow.llm.archives import archive
from tierflow.llm.backoff import backoff_scores
from tierflow.llm.decontaminate import contaminated
from tierflow.llm.exact_dedup import exact_duplicates
from tierflow.llm.host_rules import BASE_RULES, HOST_RULES, LEAST_CORRELATION, LIMIT, MEASURES, judged_by_host
from tierflow.llm.mixing import taken_in_order
from tierflow.llm.near_dups import near_duplicates
from tierflow.llm.shared import remainder
from tierflow.llm.substrings import passages
from tierflow.llm.url_templates import ALIKE, MANY, PRIOR, PRIOR_SHARE, REJECT, SELDOM, Rule, judged

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


@query(r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
        FROM documents
    ), r AS (
        SELECT doc_id, body,
            first_value(doc_id) OVER w AS keep_id,
            row_number() OVER w AS place,
            count(*) OVER (PARTITION BY body) AS group_size
        FROM d WINDOW w AS (PARTITION BY body ORDER BY length(t) DESC, doc_id)
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM r
""")
def op3_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Every document with the row that stays of its equal texts."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return exact_duplicates(docs, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


@query()
def op1_ngram_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    """Every document with the class of its near copies and the number of documents linked to it."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "links", "kept")


@query()
def op2_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    labels = table(spark, root, "labels").where(remainder(F.col("doc_id"), 4) != 2)
    return quality.scored(docs, quality.fit(docs, labels)).select(
        "row.doc_id", (remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"), "score", "predicted"
    )


@query()
def op4_benchmark_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of the item found."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, root, "benchmark")).select(
        "doc_id", "item_id", "coverage", F.size("tiles").alias("tiles")
    )


@query(r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
            md5(coalesce(doc_id::VARCHAR, '')) AS turn
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM sized GROUP BY source
    ), ranked AS (
        SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, [-0.5, 0.0, 0.5][((rank - 1) % 3 + 1)::INT]::DOUBLE AS ramp
        FROM sources
    ), filling AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (fills ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (fills ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM ranked WINDOW fills AS (ORDER BY source_size::DOUBLE * 3 / weight, rank)
    ), goals AS (
        SELECT source, source_size, ramp, least((source_size * 3)::DOUBLE,
            max(CASE WHEN level * weight <= source_size * 3 THEN level END) OVER () * weight) AS target
        FROM filling
    ), placed AS (
        SELECT d.doc_id, d.size, g.source_size, g.target, g.ramp,
            (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)
                - d.size)::BIGINT AS "begin",
            floor(g.target / greatest(g.source_size, 1))::BIGINT AS whole
        FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
    ), mixed AS (
        SELECT *, CASE WHEN size > 0 THEN whole * size + least(greatest(floor(target)::BIGINT - whole * source_size
            - "begin", 0), size) ELSE 0 END::BIGINT AS taken
        FROM placed
    )
    SELECT doc_id, size::BIGINT AS size, source_size, target, taken, round(CASE WHEN taken > 0 THEN
        CASE WHEN ramp = 0 THEN "begin" / target
        ELSE (sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * ("begin" / target)) - (1 - ramp)) / (2 * ramp) END END, 9) + 0.0 AS position
    FROM mixed
""")
def op5_curriculum_mix(spark: SparkSession, root: str) -> DataFrame:
    """Words that the mix takes from every document, and when it is first read, counted from the training order."""
    return taken_in_order(table(spark, root, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position")
    )


@query()
def op8_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    labels = table(spark, root, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    return toxicity.scored(docs, toxicity.learn(docs, labels), columns=["doc_id"]).select(
        "row.doc_id", (remainder(F.col("row.doc_id"), 3) == 1).alias("held_out"), "score", "predicted"
    )


@query(r"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first, sha1(body) AS hex FROM p),
    b AS (
        SELECT *, array_to_string(list_transform(string_split_regex(hex, ''), lambda c: ['0000', '0001', '0010', '0011',
            '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'
            ][strpos('0123456789abcdef', c)]), '') AS bits
        FROM f
    )
    SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
            list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, 1 + k * 5 + j, 1) = '1' THEN 1 << (4 - j) ELSE 0
            END))::BIGINT, 1)), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM b
""")
def op7_legacy_archive(spark: SparkSession, root: str) -> DataFrame:
    """Every page through legacy and WARC archives: its payload, and whether it repeats an earlier page's."""
    return archive(table(spark, root, "pages")).select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )



@query(r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), g AS (
        SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
    ), f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS first FROM g),
    r AS (SELECT DISTINCT doc_id, i + k AS place FROM f, range(0, 13) t(k) WHERE first < doc_id),
    gone AS (SELECT doc_id, list(place) AS places FROM r GROUP BY doc_id)
    SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
        sha256(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_contains(places, i), false)), ' ')) AS kept_sha256
    FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id
""")
def op10_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Every document without the passages that an earlier document has."""
    return passages(table(spark, root, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


#: Host, path and verdict of the rules.
RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]


def template_sql() -> str:
    """The template tree in SQL, a level at a time, as deep as the paths go."""
    ranked = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    rule = "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'" for r in ranked
    ) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in ranked) + " END"
    return rf"""
    WITH RECURSIVE u AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
        FROM u
    ), fitted AS (SELECT *, {rule} AS rule FROM parts),
    shaped AS (
        SELECT row_number() OVER () AS rid, page_id, host, path, rule, {verdict} AS decided,
            CASE WHEN path IN ('', '/') THEN []::VARCHAR[] ELSE list_transform(
                string_split(regexp_replace(path, '^/', ''), '/'), lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*'
                    WHEN s = '' OR left(s, 1) IN ('*', '~', '=') THEN '=' || s ELSE s END) END AS shape
        FROM fitted
    ), tree AS (
        SELECT rid, host, decided, shape, 0 AS depth, '' AS template, false AS ended FROM shaped
        UNION ALL
        SELECT rid, host, decided, shape, depth + 1, template || CASE WHEN seg IS NULL THEN ''
                WHEN seg = '*' OR kinds >= {MANY} AND everything <= {SELDOM}::DOUBLE * kinds THEN '/*'
                WHEN labelled > 0 AND abs(blocked - labelled * share) <= {ALIKE}::DOUBLE * sqrt(labelled * share * (1 - share)) + 0.5::DOUBLE
                THEN CASE WHEN blocked * 2 >= labelled THEN '/~block' ELSE '/~allow' END ELSE '/' || seg END, seg IS NULL
        FROM (
            SELECT *, sum((place = 1)::INT) OVER node AS kinds, count(*) OVER node AS everything,
                sum(CASE WHEN place = 1 THEN blocked ELSE 0 END) OVER side
                    / greatest(sum(CASE WHEN place = 1 THEN labelled ELSE 0 END) OVER side, 1) AS share
            FROM (
                SELECT *, count(decided) OVER branch AS labelled, count(*) FILTER (decided = 'block') OVER branch AS blocked,
                    row_number() OVER (PARTITION BY host, template, seg ORDER BY rid) AS place
                FROM (SELECT *, shape[depth + 1] AS seg FROM tree WHERE NOT ended)
                WINDOW branch AS (PARTITION BY host, template, seg)
            ) WINDOW node AS (PARTITION BY host, template),
                side AS (PARTITION BY host, template, blocked * 2 >= labelled, labelled > 0)
        )
    ), purity AS (
        SELECT host, template, (count(*) FILTER (decided = 'block') + {PRIOR * PRIOR_SHARE}::DOUBLE)
            / (count(decided) + {PRIOR}::DOUBLE) AS purity
        FROM tree WHERE ended GROUP BY host, template
    )
    SELECT page_id, s.host, path, rule, t.template,
        coalesce(s.decided, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict
    FROM shaped s JOIN tree t ON t.rid = s.rid AND t.ended JOIN purity p ON p.host = t.host AND p.template = t.template
    """


@query(template_sql())
def op9_url_templates(spark: SparkSession, root: str) -> DataFrame:
    """Verdict on every page's url, by rule or by its host's path templates."""
    return judged(table(spark, root, "pages").select("page_id", "url"), RULES).select(
        "row.page_id", "host", "path", "rule", "template", "verdict"
    )


@query()
def op6_backoff_score(spark: SparkSession, root: str) -> DataFrame:
    """Language model score of every document by trigrams of all the others, with every count over all documents."""
    return backoff_scores(table(spark, root, "documents").select("doc_id", "text"), order=3, least=1, leave_out=True)


def host_rules_sql() -> str:
    rules = ", ".join(f"({rule})::INT AS {name}" for name, rule in HOST_RULES.items())
    sums = ", ".join(f"sum({c}) AS {c}" for c in HOST_RULES)
    moments = ", ".join(
        f"(sum({c}) + 0.5::DOUBLE) / (sum(n) + 1) AS mean_{c}, sum({c}) AS x_{c}, sum({c}::DOUBLE * {c} / n) AS xx_{c}" for c in HOST_RULES
    )
    means = ", ".join(
        f"""least(greatest(CASE WHEN mean_{c} * (1 - mean_{c}) * (n - nn / n - (hosts - 1)) > 0
            THEN (xx_{c} - 2 * mean_{c} * x_{c} + mean_{c} * mean_{c} * n - mean_{c} * (1 - mean_{c}) * (hosts - 1))
                 / (mean_{c} * (1 - mean_{c}) * (n - nn / n - (hosts - 1))) ELSE 0 END, {LEAST_CORRELATION}::DOUBLE),
            1 - {LEAST_CORRELATION}::DOUBLE) AS corr_{c}, mean_{c}""" for c in HOST_RULES
    )
    refused = " OR ".join(
        f"(h.{c} + mean_{c} * (1 / corr_{c} - 1)) / (h.n + (1 / corr_{c} - 1)) >= {LIMIT}::DOUBLE" for c in HOST_RULES
    )
    base = " OR ".join(f"({rule})" for rule in BASE_RULES.values())
    return rf"""
    WITH d AS (
        SELECT row_number() OVER () AS rid, doc_id, nullif(lower(trim(source)), '') AS host, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), l AS (
        SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
    ), g AS (
        SELECT rid, i, word || ' ' || lead(word) OVER v || ' ' || lead(word, 2) OVER v AS gram
        FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d) WINDOW v AS (PARTITION BY rid ORDER BY i)
    ), often AS (
        SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1
    ), covered AS (
        SELECT rid, count(DISTINCT i + s) AS n_repeat_words FROM often, range(3) AS steps(s) GROUP BY rid
    ), m AS (
        SELECT doc_id, host, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM d JOIN l USING (rid) LEFT JOIN covered USING (rid)
    ), f AS (SELECT *, {rules} FROM m),
    h AS (SELECT host, count(*) AS n, {sums} FROM f WHERE host IS NOT NULL GROUP BY host),
    s AS (SELECT count(*) AS hosts, sum(n) AS n, sum(n::DOUBLE * n) AS nn, {moments} FROM h),
    p AS (SELECT {means} FROM s),
    v AS (SELECT host, {refused} AS refused FROM h, p)
    SELECT doc_id, {", ".join(f"{c}::BIGINT AS {c}" for c in MEASURES)}, ({base}) AS base_failed,
        NOT ({base}) AND NOT coalesce(refused, false) AS kept
    FROM f LEFT JOIN v USING (host)
    """


@query(host_rules_sql())
def op11_host_rules(spark: SparkSession, root: str) -> DataFrame:
    """Measures of every document, and whether it stays by its own rules and by its source's failure rates."""
    return judged_by_host(table(spark, root, "documents"), columns=["doc_id"]).select(
        "row.doc_id", *MEASURES, "base_failed", "kept"
    )


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of ASCII text, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({steps}, lambda x: x::BIGINT)), lambda c, x: {fold}), 4294967295::BIGINT)"


TRIE_SQL = f"""
    WITH o AS (
        SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
    ), k AS (SELECT *, md5(length(r) || ':' || r || t) AS digest FROM o),
    c AS (
        SELECT conv_id, list({{'k': digest, 'n': length(t)}} ORDER BY turn NULLS FIRST, r, digest) AS own,
            {crc32_sql("conv_id::VARCHAR")} % {prefix_trie.HEADS} AS h FROM k GROUP BY conv_id
    ), p AS (
        SELECT c.conv_id, list_concat(CASE WHEN b.own IS NULL OR c.h = 0 THEN [] ELSE b.own[:c.h] END, c.own[c.h + 1:]) AS turns
        FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % {prefix_trie.FAMILY}
    ), q AS (SELECT conv_id, len(turns) AS size, turns, array_to_string(list_transform(turns, lambda x: x.k), '') AS path FROM p),
    n AS (
        SELECT conv_id, size, depth, path[:32 * depth] AS node, CASE WHEN depth > 0 THEN turns[depth].n ELSE 0 END AS chars
        FROM (SELECT *, unnest(range(0, size + 1)) AS depth FROM q)
    ), nodes AS (
        SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
        FROM n GROUP BY depth, node
    ), kids AS (SELECT depth - 1 AS depth, node[:32 * (depth - 1)] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, node)),
    below AS (
        SELECT up AS depth, node[:32 * up] AS node, sum((n_convs - 1) * chars) AS saved, sum((n_children = 0)::INT) AS leaves
        FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_nodes) GROUP BY ALL
    )
    SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, leaves::BIGINT AS n_leaves,
        saved::BIGINT AS saved_tokens, a.ends_sha256
    FROM full_nodes a JOIN below USING (depth, node)
    LEFT JOIN nodes b ON b.depth = a.depth - 1 AND b.node = a.node[:32 * (a.depth - 1)]
"""


@query(TRIE_SQL)
def op12_conversation_trie(spark: SparkSession, root: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, root, "conversations"))


def repair_sql() -> str:
    def way(label: str, cost: int | str, audit: str, line: str | None = None) -> str:
        body = f"{audit}.body" if line is None else f"list_prepend({line}, {audit}.body)"
        return f"{{'cost': {audit}.cost + {cost}, 'audit': '{label}' || {audit}.audit, 'body': {body}}}"

    def least(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))[1]"

    after, name = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    moves = []
    for s in range(4):
        keeps = " ".join(f"WHEN '{c}' THEN {way('K', 'f.extra', f'b{t}', 'f.line')}" for c, t in kept[s].items())
        role = name[after[s]]
        rerole = way("R", "1 + f.extra", f"b{after[s]}", f"'{role}:' || f.t")
        moves.append(least(
            way("D", 2, f"b{s}"), f"CASE WHEN f.must_go THEN NULL ELSE CASE left(f.r, 1) {keeps} END END",
            f"CASE WHEN f.must_go THEN NULL ELSE {rerole} END",
        ) + f" AS x{s}")
    user, assistant = least("x2", way("I", 5, "x3", "'assistant:'")), least("x3", way("I", 5, "x2", "'user:'"))
    inserts = f"""
        SELECT conv_id, i, {least("x0", way("I", 5, "y2", "'user:'"))} AS b0, {least("x1", way("I", 5, "y2", "'user:'"))} AS b1,
            y2 AS b2, y3 AS b3 FROM (SELECT *, {user} AS y2, {assistant} AS y3 FROM"""
    kind = "STRUCT(cost BIGINT, audit VARCHAR, body VARCHAR[])"
    end, none = f"{{'cost': 0, 'audit': '', 'body': []}}::{kind}", f"NULL::{kind}"
    return rf"""
    WITH RECURSIVE o AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
            {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fate FROM conversations
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE r END AS r,
            CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS t
        FROM o, range(2) AS copies(n) WHERE fate <> 0 AND (n = 0 OR fate = 3)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, md5(length(r) || ':' || r || t)) AS i
        FROM damaged
    ), faults AS (
        SELECT *, NOT regexp_matches(t, '[^ 	-
]') AS blank,
            row_number() OVER (PARTITION BY conv_id, r, t ORDER BY i) > 1 AS seen,
            NOT regexp_matches(t, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM placed
    ), f AS (
        SELECT *, blank OR seen AS must_go, CASE WHEN cut AND NOT blank AND NOT seen THEN 5 ELSE 0 END AS extra,
            r || ':' || t AS line, lag(left(r, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(r, 1) AS pair FROM faults
    ), counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (extra > 0) AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS size FROM f GROUP BY conv_id
    ), best AS (
        {inserts} (SELECT conv_id, size + 1 AS i, {end} AS x0, {none} AS x1, {none} AS x2, {end} AS x3 FROM counts))
        UNION ALL
        {inserts} (SELECT f.conv_id, f.i, {", ".join(moves)} FROM best JOIN f ON f.i = best.i - 1 AND f.conv_id IS NOT DISTINCT FROM best.conv_id))
    )
    SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b0.cost, 0)::BIGINT AS cost,
        coalesce(b0.audit, '') AS audit, sha256(coalesce(array_to_string(b0.body, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id AND best.i = 1
    """


@query(repair_sql())
def op13_turn_repair(spark: SparkSession, root: str) -> DataFrame:
    """Faults, cheapest edits and repaired form of every conversation after damage."""
    return turn_repair.repaired_conversations(turn_repair.damaged(table(spark, root, "conversations")))
