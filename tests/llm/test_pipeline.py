"""The pipeline stage by stage against brute force on what its predecessor kept."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest
from test_decontaminate import plain_tiles, tokens
from test_exact_dedup import plain
from test_mixing import filled
from test_near_dups import brute

import corpus_pipeline
from tierflow.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, each written and read again."""
    place = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, ROOT).write.parquet(f"{place}/{name}")
        result = spark.read.parquet(f"{place}/{name}")
        out[name] = docs, result
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(spark, stages):
    names = list(stages)
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    assert all(stages[n][1].columns == stages[n][0].columns for n in names[:-1])


def test_quality_keeps_good_rows(spark, stages):
    docs, kept = stages["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    ids = set(texts(kept))
    wrong = [i for i, q in labels.items() if (i in ids) != (q == 1)]
    assert len(wrong) <= 0.03 * len(labels) and len(ids) > 0.7 * docs.count()


def test_exact_dedup_keeps_the_longest_of_equal_texts(stages):
    before, after = map(texts, stages["exact_dedup"])
    groups = {}
    for i, t in before.items():
        groups.setdefault(plain(t), []).append((-len(t or ""), i))
    assert set(after) == {min(g)[1] for g in groups.values()}
    assert all(after[i] == before[i] for i in after)


def test_near_dedup_keeps_one_of_each_class(stages):
    before, after = map(texts, stages["near_dedup"])
    assert set(after) == {c for c, _ in brute(sorted(before.items())).values()}


def test_decontamination_drops_documents_with_an_item(spark, stages):
    before, after = map(texts, stages["decontamination"])
    items = [tokens(r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    runs = [{tuple(i[k : k + 5]) for k in range(len(i) - 4)} for i in items]
    dropped = set()
    for d, text in before.items():
        own = tokens(text)
        seeds = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        for item, run in zip(items, runs):
            if len(run & seeds) * 5 >= 0.5 * len(item) and plain_tiles(item, own) >= 0.5 * len(item):
                dropped.add(d)
    assert set(after) == set(before) - dropped and dropped


def test_mixing_reads_each_source_to_its_target(stages):
    docs, readings = stages["mixing"]
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0d]+", r.text or ""))
    taken = {s: 0 for s in sizes}
    for r in readings.collect():
        taken[r.source] += r.words
    assert all(abs(taken[s] - t) <= 1 for s, t in filled(sizes).items())
    known = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == known[r.doc_id] for r in readings.collect())


def test_odd_documents_pass_through_every_stage(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key string, id int, kept int"
    rows = [(None, None, None, None, None, "a", "b", 1, 2), (1, "", "en", "s", 0, "a", "b", 1, 2), (1, "", "en", "s", 0, "a", "b", 1, 2),
            (2, "A plain sentence that stays, since nothing is wrong with it.", "en", "s", 60, "a", "b", 1, 2),
            (3, "Once more and more. " * 20_000, "en", None, 1, "a", "b", 1, 2)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, ROOT)
            path = f"{tmp_path}/{name}-{docs.count()}"
            out.write.mode("overwrite").parquet(path)
            assert name == "mixing" or out.columns == docs.columns
            docs = spark.read.schema(out.schema).parquet(path)


def test_every_operator_has_its_query(spark):
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
