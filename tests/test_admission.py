"""Loads of many files: a micro-batch each, whole, once; and tables whose schema grows under a running checkpoint."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.tables import read_batches
from tierflow.streaming.admission import Landing, SchemaLog, run_growing, widened, wider
from tierflow.streaming.sinks import run_stream, write_batch


def ids(df):
    return sorted(r[0] for r in df.collect())


def read(spark, path):
    return spark.read.schema("id bigint").parquet(path)


def test_a_load_of_many_files_is_one_micro_batch(spark, area):
    landing, tasks = Landing(f"{area}/landing"), []
    landing.land(spark.range(100).repartition(5), 7)
    landing.land(spark.range(0), 3)
    landing.land(spark.range(200, 230).repartition(3), 4)

    def take(rows, number):
        tasks.append(rows.rdd.getNumPartitions() if number == 0 else 0)
        write_batch(rows, f"{area}/table", number)

    landing.admit(spark, read, take, f"{area}/marks")
    landing.land(spark.range(300, 310), 5)
    landing.admit(spark, read, take, f"{area}/marks")
    landing.admit(spark, read, take, f"{area}/marks")
    table = read_batches(spark, f"{area}/table", schema=T.StructType.fromDDL("id bigint"))
    counts = {r.batch_id: r["count"] for r in table.groupBy("batch_id").count().collect()}
    assert counts == {0: 100, 2: 30, 3: 10} and len(tasks) == 4
    entries = {r.load: (r.n_rows, r.n_files) for r in landing.entries(spark).collect()}
    assert entries[7] == (100, 5) and entries[4] == (30, 3) and entries[3][0] == 0


def test_loads_without_entry_wait_and_repeated_ones_change_nothing(spark, area):
    landing, seen = Landing(f"{area}/landing"), []
    assert landing.entries(spark) is None and landing.schemas(spark) == []
    landing.land(spark.range(3), 0)
    spark.range(50).write.parquet(landing.place(1))  # its writer died before the entry
    landing.land(spark.range(9), 0)
    landing.admit(spark, read, lambda rows, number: seen.append(ids(rows)), f"{area}/marks")
    assert seen == [[0, 1, 2]]
    landing.land(spark.range(5, 7), 1)  # delivered again
    landing.admit(spark, read, lambda rows, number: seen.append(ids(rows)), f"{area}/marks")
    assert seen == [[0, 1, 2], [5, 6]]


def test_a_micro_batch_that_fails_brings_its_load_again(spark, area):
    landing, fails = Landing(f"{area}/landing"), [True]
    for load in range(2):
        landing.land(spark.range(load * 10, load * 10 + 4).repartition(2), load)

    def take(rows, number):
        write_batch(rows, f"{area}/table", number)
        if number == 1 and fails:
            fails.pop()
            raise RuntimeError("lost after writing")

    with pytest.raises(StreamingQueryException):
        landing.admit(spark, read, take, f"{area}/marks")
    landing.admit(spark, read, take, f"{area}/marks")
    assert ids(read_batches(spark, f"{area}/table").select("id")) == [0, 1, 2, 3, 10, 11, 12, 13]


@pytest.mark.parametrize("rows", [0, 1, 50])
def test_a_load_has_as_many_files_as_asked_for(spark, area, rows):
    landing = Landing(f"{area}/landing")
    landing.land(spark.range(rows), 0, files=4)
    stored = spark.read.schema("id bigint").parquet(landing.files)
    assert len(stored.inputFiles()) == 4 and ids(stored) == list(range(rows))
    assert landing.entries(spark).first().n_files == 4


def test_schema_grows_on_one_checkpoint(spark, area):
    landing, log = Landing(f"{area}/landing"), SchemaLog(f"{area}/schemas")

    def run():
        return run_growing(spark, landing, log, lambda rows: run_stream(rows, f"{area}/table", f"{area}/marks"))

    assert run() is None and log.current(spark) == T.StructType()
    landing.land(spark.sql("SELECT 1 AS id, 5 AS v, named_struct('a', 1) AS s"), 0)
    run()
    run()
    assert len(log.versions(spark)) == 1
    landing.land(spark.sql("SELECT 2L AS id, 0.5D AS v, named_struct('a', 2, 'b', 'x') AS s, 'new' AS w"), 1)
    landing.land(spark.sql("SELECT 3 AS id, 'again' AS w"), 2)
    run()
    table = log.read(spark, f"{area}/table")
    assert table.schema.simpleString() == "struct<id:bigint,v:double,s:struct<a:int,b:string>,w:string>"
    got = sorted(tuple(r) for r in table.select("id", "v", F.col("s.a"), F.col("s.b"), "w").collect())
    assert got == [(1, 5.0, 1, None, None), (2, 0.5, 2, "x", "new"), (3, None, None, None, "again")]
    assert [len(v) for v in log.versions(spark)] == [3, 4]


def test_a_load_that_does_not_fit_stops_the_run_before_its_rows(spark, area):
    landing, log = Landing(f"{area}/landing"), SchemaLog(f"{area}/schemas")
    take = lambda rows: run_stream(rows, f"{area}/table", f"{area}/marks")
    landing.land(spark.sql("SELECT 1 AS id"), 0)
    run_growing(spark, landing, log, take)
    landing.land(spark.sql("SELECT 'one' AS id"), 1)
    with pytest.raises(ValueError, match="id: no type holds both int and string"):
        run_growing(spark, landing, log, take)
    assert ids(log.read(spark, f"{area}/table")) == [1] and len(log.versions(spark)) == 1


def ddl(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("a, b, both", [
    ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("smallint", "double", "double"), ("int", "float", "double"),
    ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "string", "string"),
    ("decimal(5,2)", "decimal(6,1)", "decimal(7,2)"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("map<string,int>", "map<string,double>", "map<string,double>"), ("struct<a:int>", "struct<A:bigint,b:int>", "struct<a:bigint,b:int>"),
    ("bigint", "double", None), ("string", "int", None), ("timestamp", "date", None), ("decimal(38,0)", "decimal(38,2)", None),
])
def test_wider_types(a, b, both):
    x, y = ddl(f"c {a}")[0].dataType, ddl(f"c {b}")[0].dataType
    if both is None:
        for pair in ((x, y), (y, x)):
            with pytest.raises(ValueError):
                wider(*pair)
        return
    assert wider(x, y).simpleString().lower() == wider(y, x).simpleString().lower() == both


def test_fields_keep_order_and_first_spelling():
    grown = widened(ddl("a int not null, B string"), ddl("c int, b string, A bigint"))
    assert grown.simpleString() == "struct<a:bigint,B:string,c:int>" and all(f.nullable for f in grown)
