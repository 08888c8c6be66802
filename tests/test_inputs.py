"""Streams per input into one bronze table: repeated batches, growing schemas, records that do not parse."""

import dataclasses

import pytest
from pyspark.sql import types as T

from siltstone.plans.spec import Ingest, SpecError
from siltstone.streaming import inputs
from siltstone.streaming.chain import Placement

PRE = (("*", "'a' as source", "'b' as sourcetype", "timestamp '2024-01-01 00:00:00' as time", "'v' as value"),)


@pytest.fixture
def place(spark, database, tmp_path):
    spark.conf.set("siltstone.bronze.database", database)
    yield Placement(checkpoints=str(tmp_path / "checkpoints"), tables=str(tmp_path / "tables"))
    spark.conf.unset("siltstone.bronze.database")


def ddl(text):
    return T.StructType.fromDDL(text)


def test_merged_schema(spark):
    old = ddl("a int, s struct<x: int, y: float>, l array<int>")
    new = ddl("b string, A bigint, s struct<z: string, x: double>, l array<bigint>")
    assert inputs.merged_schema(old, new) == ddl("a bigint, s struct<x: double, y: float, z: string>, l array<bigint>, b string")
    assert inputs.merged_schema(old, old) == old
    assert inputs.merged_schema(new, ddl("a int")) == new  # the wider one stays
    for clash in ("a string", "a timestamp", "s int", "s struct<x: string>", "l array<string>", "l map<string, int>"):
        with pytest.raises(SpecError, match="no type holds"):
            inputs.merged_schema(old, ddl(clash))
    with pytest.raises(SpecError, match="but for case"):
        inputs.merged_schema(old, T.StructType([T.StructField("c", T.LongType()), T.StructField("C", T.LongType())]))


def test_a_repeated_batch_adds_nothing(spark, place, database):
    table, path = f"{database}.b", place.path(f"{database}.b")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, date string").selectExpr("k", "cast(date as date) as date")
    for ident, batch in (("one", 0), ("one", 1), ("two", 0), ("one", 0)):
        inputs._replace(spark, rows, table, path, ident, batch)
    half = rows.filter("k = 1")  # as if a write had been cut short
    inputs._replace(spark, half, table, path, "two", 1)
    files = {r.f for r in spark.sql(f"SELECT DISTINCT _metadata.file_path AS f FROM {table} WHERE input_id = 'one'").collect()}
    inputs._replace(spark, rows, table, path, "two", 1)
    inputs._replace(spark, rows.selectExpr("k", "date", "'new' AS extra"), table, path, "three", 0)
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    found = spark.table(table).groupBy("input_id", "input_batch").count().collect()
    assert sorted(map(tuple, found)) == [("one", 0, 2), ("one", 1, 2), ("three", 0, 2), ("two", 0, 2), ("two", 1, 2)]
    assert spark.table(table).filter("extra = 'new'").count() == 2
    now = {r.f for r in spark.sql(f"SELECT DISTINCT _metadata.file_path AS f FROM {table} WHERE input_id = 'one'").collect()}
    assert now == files  # a batch that is all there is not written again


def test_a_type_that_clashes_is_refused_at_the_next_start(spark, place, tmp_path, database):
    folder = str(tmp_path / "in")
    ingest = Ingest(name="typed", inputs=(folder,), format="parquet", pre=PRE)
    spark.range(3).selectExpr("cast(id as int) as k").write.parquet(folder)
    inputs.run_inputs(spark, [ingest], place)
    inputs.run_inputs(spark, [ingest], place)  # nothing new, and the schema is not looked up again
    memory = inputs.SchemaMemory(spark, place.checkpoint("bronze", f"typed-{inputs.input_id(ingest)}") + "-schema")
    assert memory.recall()[0] == ddl("k int") and memory.version() == 1
    spark.range(3, 5).selectExpr("id + 10000000000 as k", "'x' as more").write.mode("append").parquet(folder)
    inputs.run_inputs(spark, [ingest], place)
    rows = spark.table(f"{database}.typed").select("k", "more").collect()
    assert sorted(map(tuple, rows), key=repr) == [(0, None), (1, None), (10000000003, "x"), (10000000004, "x"), (2, None)]
    assert memory.recall()[0] == ddl("k bigint, more string")
    spark.range(1).selectExpr("'text' as k").write.mode("append").parquet(folder)
    with pytest.raises(SpecError, match="column k was bigint and is string"):
        inputs.run_inputs(spark, [ingest], place)
    assert spark.table(f"{database}.typed").count() == 5


@pytest.mark.parametrize("kind", ["variant", "csv variant", "typed"])
def test_records_that_do_not_parse_are_kept_apart(spark, place, tmp_path, database, kind):
    folder = tmp_path / "in"
    folder.mkdir()
    if kind == "csv variant":
        (folder / "a.csv").write_text("k,name\n1,one\n2\n3,three\n")
        ingest = Ingest(name="checked", inputs=(str(folder),), format="csv", single_variant=True, options={"header": "true"})
        pre, bad = "cast(data:k as int) as k", ["2"]
    else:
        (folder / "a.json").write_text('{"k": 1}\n{"k": 2\n{"k": 3}\nnot json\n')
        ingest = Ingest(name="checked", inputs=(str(folder),), format="jsonl", single_variant=kind == "variant", schema=None if kind == "variant" else "k int")
        pre, bad = ("cast(data:k as int) as k" if kind == "variant" else "k"), ['{"k": 2', "not json"]
    made = ("'a' as source", "'b' as sourcetype", "timestamp '2024-01-01 00:00:00' as time", pre, "data" if ingest.single_variant else "'v' as value")
    ingest = dataclasses.replace(ingest, pre=(made,))
    inputs.run_inputs(spark, [ingest], place)
    assert sorted(r.k for r in spark.table(f"{database}.checked").collect()) == [1, 3]
    broken = spark.table(inputs.quarantine_table(spark, ingest)).collect()
    assert sorted(r.text for r in broken) == sorted(bad) and all(r.file.endswith(("a.csv", "a.json")) for r in broken)
    (row,) = inputs.quarantine_counts(spark, ingest).collect()
    assert row.records == len(bad) and row.input_id == inputs.input_id(ingest)


def test_bad_calls(spark, place):
    one = Ingest(name="n", inputs=("/a",), format="text")
    with pytest.raises(SpecError, match="given twice"):
        inputs.run_inputs(spark, [one, one], place)
    with pytest.raises(SpecError, match="carry its name"):
        inputs.run_inputs(spark, [one, dataclasses.replace(one, name="m")], place)
    with pytest.raises(SpecError, match="folder for tables"):
        inputs.start_input(spark, one, dataclasses.replace(place, tables=None))
    assert inputs.input_id(one) != inputs.input_id(dataclasses.replace(one, inputs=("/a/",)))
