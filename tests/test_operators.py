import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import samples
from siltstone.functions import normalize as n
from siltstone.operators import lookups
from siltstone.operators.fields import captured_names, output_columns
from siltstone.operators.ingest import to_bronze
from siltstone.operators.layers import explode_elements, to_gold, to_silver
from siltstone.operators.lookups import BROADCAST_LIMIT_CONF, SALT_ABOVE_CONF, apply_lookups, hot_keys, planned_size
from siltstone.plans import naming
from siltstone.plans.chain import run_batch
from siltstone.plans.ocsf import CLASSES, class_schema, conform, mapping_problems
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, Lookup, LookupSource, SilverSpec, SpecError, load_flow
from siltstone.quality import profile
from siltstone.sources.files import one_path, read_batch, reader_options, with_hints


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- specs -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "conf, message",
    [
        ({"name": "x"}, "autoloader"),
        ({"name": "x", "autoloader": {"inputs": []}}, "format"),
        ({"name": "x", "autoloader": {"format": "json"}, "gold": [{"name": "g", "input": "nope"}]}, "unknown table"),
        ({"name": "x", "autoloader": {"format": "json"}, "silver": {"transform": [{"fields": [{"name": "a"}]}]}}, "needs expr"),
        ({"name": "x", "autoloader": {"format": "json"}, "silver": {"transform": [{"filter": "TODO"}]}}, "unfinished"),
        ({"name": "x", "autoloader": {"format": "json"}, "bronze": {"preTransform": [["a"], "b"]}}, "mixes"),
    ],
)
def test_bad_specs_are_rejected(conf, message):
    with pytest.raises(SpecError, match=message):
        Flow.from_dict(conf)


def test_flow_reads_from_yaml_and_json(tmp_path):
    pytest.importorskip("yaml")
    text = (
        "name: demo\nautoloader:\n  inputs: [/in]\n  format: jsonl\n  cloudFiles: {sep: ' ', schemaHints: 'a int'}\n"
        "bronze:\n  loadAsSingleVariant: true\n  preTransform:\n    - 'now() as time'\n    - data\n"
        "  lookups:\n    - name: l\n      source: {type: csv, path: /l}\n      join:\n        on: ['main.a = lookup.b', c]\n"
        "silver:\n  transform:\n    - name: s\n      fields:\n        - {name: a.b, literal: it's}\n"
    )
    path = tmp_path / "flow.yaml"
    path.write_text(text)
    flow = load_flow(str(path))
    assert flow.ingest.pre == (("now() as time", "data"),)
    assert flow.ingest.lookups[0].on == (("a", "b"), ("c", "c"))
    assert flow.ingest.schema_hints == "a int" and flow.ingest.options == {"sep": " "}
    assert flow.silver[0].fields[0].literal == "it's"


def test_later_reader_options_win():
    ingest = Ingest(name="i", format="json", multiline=True, options={"multiLine": "false", "a": "1"}, single_variant=True)
    assert reader_options(Ingest(name="i", format="csv", single_variant=True)) == {"enforceSchema": "false"}
    assert reader_options(ingest, {"a": "2"}) == {"multiLine": "false", "singleVariantColumn": "data", "a": "2"}


def test_one_glob_for_many_inputs(spark):
    assert one_path(spark, ["/a/b"]) == "/a/b"
    assert one_path(spark, ["/a/b", "/c"]) == "file:///{a/b,c}"
    assert one_path(spark, ["s3://x/a", "s3://x/b/c"]) == "s3://x/{a,b/c}"
    # A relative path lies where Spark looks for it, not where this process does.
    spark._jsc.hadoopConfiguration().set("fs.defaultFS", "viewfs://cluster/")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.cluster.link./user", "file:///tmp")
    try:
        joint = one_path(spark, ["/user/a", "viewfs://cluster/user/b"])
    finally:
        spark._jsc.hadoopConfiguration().set("fs.defaultFS", "file:///")
    assert joint == "viewfs://cluster/{user/a,user/b}"
    with pytest.raises(SpecError):
        one_path(spark, ["s3://x/a", "/b"])


def test_csv_records_keep_their_text(spark, tmp_path):
    samples.write(tmp_path / "in", ["id at n", "012345678901 1e5 +7", "- 0x1 007"], "a.csv")
    ingest = Ingest(name="c", inputs=(str(tmp_path / "in"),), format="csv", options={"header": "true", "sep": " "}, single_variant=True)
    df = read_batch(spark, ingest)
    assert rows(df.select(n.text("$.id"), n.text("$.at"), n.text("$.n"), n.number("$.n"))) == [
        ("-", "0x1", "007", 7), ("012345678901", "1e5", "+7", 7),
    ]
    samples.write(tmp_path / "in", ["at id n", "x y 1"], "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_batch(spark, ingest).collect()


def test_routing_parses_a_record_once(spark, small):
    """A filter that the optimizer moves to the scan reads one member, not the record."""
    from workload import catalogue

    def filters(name):
        optimized = catalogue.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in optimized.splitlines() if line.lstrip("+- :").startswith("Filter")], optimized

    for name in ("okta_authentication", "github_account_change"):
        found, _ = filters(name)
        assert found and all("struct<" not in line for line in found), name
    found, _ = filters("ios_authentication")
    assert sum(line.count("regexp_extract_all") for line in found) == 2 and not any("regexp_replace" in line for line in found)
    limit = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    try:
        _, optimized = filters("vpc_network_activity")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", limit)
    assert optimized.count(r"^172\.") == 2


def test_table_names(spark):
    assert naming.layer_table(spark, "silver", "a.b") == "a.b"
    assert naming.layer_table(spark, "silver", "t") == "`t`"
    with pytest.raises(SpecError, match="database"):
        naming.gold_table(spark, GoldSpec(name="g", input="s"))
    with pytest.raises(SpecError, match="catalog"):
        naming.gold_table(spark, GoldSpec(name="g", input="s", catalog="c"))
    assert naming.gold_table(spark, GoldSpec(name="g", input="s", database="d")) == "`d`.`g`"
    long = "/very/long/path/that/ends/the/same/way"
    assert naming.query_name("bronze", "/a" + long) != naming.query_name("bronze", "/b" + long)


# -- fields ------------------------------------------------------------------------------


def test_nested_literals_keep_type_and_quotes(spark):
    columns = output_columns(
        [Field("s.n", literal=3), Field("s.t.q", literal="it's"), Field("top", literal=True), Field("s.t.z", literal=None)]
    )
    df = spark.range(1).select(*columns)
    assert df.columns == ["top", "s"]
    assert df.select("s.n", "s.t.q", "s.t.z", "top").first() == (3, "it's", None, True)


@pytest.mark.parametrize("names", [("a", "a.b"), ("a.b", "a.b.c"), ("a.b.c", "a.b"), ("a", "a")])
def test_colliding_names_raise(names):
    with pytest.raises(SpecError):
        output_columns([Field(name, literal=1) for name in names])


def test_carried_column_may_not_repeat(spark):
    with pytest.raises(SpecError, match="repeat"):
        to_silver(spark.range(1), SilverSpec(name="s", preserve=True, fields=(Field("ID", literal=1),)))


def test_shadowing_is_reported(spark):
    df = spark.range(1).selectExpr("id as action")
    made = [Field("action", "upper(action)"), Field("note", "concat(action, '!')"), Field("other", literal=1)]
    assert captured_names(df, made) == ["action"]


# -- ingest ------------------------------------------------------------------------------


def test_row_cap_and_metadata(spark, tmp_path):
    path = samples.write(tmp_path / "in", samples.IOS)
    ingest = Ingest(name="i", inputs=(path,), format="syslog", pre=(("timestamp'2024-01-01' as time", "value"),))
    df = to_bronze(read_batch(spark, ingest, row_limit=3), ingest)
    assert df.count() == 3
    assert df.columns == ["record_id", "time", "date", "value", "_metadata", "processed_time", "dsl_id"]
    expected = df.select(F.md5(F.concat_ws("_", "value", F.lit("part.log")))).first()[0]
    assert df.select("record_id").first()[0] == expected


def test_declared_columns_are_kept(spark, tmp_path):
    path = samples.write(tmp_path / "in", ["x"])
    ingest = Ingest(
        name="i", inputs=(path,), format="text",
        pre=(("date'2020-02-02' as date", "'mine' as record_id", "'row' as dsl_id", "current_timestamp() as time", "value"),),
    )
    row = to_bronze(read_batch(spark, ingest), ingest).first()
    assert (row["record_id"], row["dsl_id"], str(row["date"])) == ("mine", "row", "2020-02-02")


def test_unknown_format_and_hints(spark):
    with pytest.raises(SpecError, match="format"):
        read_batch(spark, Ingest(name="i", inputs=("/x",), format="xlsx"))
    from pyspark.sql import types as T

    schema = with_hints(T.StructType.fromDDL("a int, b int"), "b string, c date")
    assert [f.dataType.simpleString() for f in schema.fields] == ["int", "string", "date"]


# -- lookups -----------------------------------------------------------------------------


@pytest.fixture
def salted(spark):
    """Small lookups are salted too."""
    spark.conf.set(SALT_ABOVE_CONF, "0")
    yield
    spark.conf.unset(SALT_ABOVE_CONF)


def _lookup(frame, **more):
    return Lookup(LookupSource(frame=frame), on=(("k", "k"),), name="l", prefix="l_", **more)


@pytest.mark.parametrize("how", ["left", "inner", "right", "full"])
@pytest.mark.parametrize("form", [{}, {"broadcast": True}, {"salt": 3}, {"hot_keys": True}])
def test_all_join_types_match_a_plain_join(spark, how, form, salted):
    main = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "z")], "i int, k string")
    side = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 30), ("q", 40)], "k string, v int")
    expected = main.join(side.toDF("l_k", "l_v"), F.col("k") == F.col("l_k"), how)
    assert rows(apply_lookups(main, [_lookup(side, how=how, **form)])) == rows(expected)


def test_broadcast_is_asked_for_only_below_the_limit(spark):
    main = spark.range(1000).selectExpr("id as k")
    side = spark.range(1000).selectExpr("id as k", "id * 2 as v")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(apply_lookups(main, [_lookup(side, broadcast=True)]))
        # Decoded rows are taken to be several times as large as the optimizer says.
        spark.conf.set(BROADCAST_LIMIT_CONF, str(planned_size(side) + 1))
        assert "BroadcastHashJoin" not in plan(apply_lookups(main, [_lookup(side, broadcast=True)]))
        spark.conf.set(BROADCAST_LIMIT_CONF, "10")
        assert "BroadcastHashJoin" not in plan(apply_lookups(main, [_lookup(side, broadcast=True)]))
    finally:
        spark.conf.unset(BROADCAST_LIMIT_CONF)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and tasks stay as planned."""
    held = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for name, value in held.items():
        spark.conf.set(name, value)


def _skewed(spark, kind="bigint"):
    """A third of the rows share one key, nobody says which."""
    return spark.range(30000).selectExpr(f"cast(CASE WHEN id % 3 = 0 THEN 77 ELSE id END AS {kind}) as k", "id")


LONGS = ("bigint", "bigint")


@pytest.mark.parametrize(
    "how, kinds",
    [("left", LONGS), ("inner", LONGS), ("right", LONGS), ("full", LONGS), ("left", ("int", "bigint")), ("left", ("string", "string")),
     ("left", ("double", "double")), ("full", ("string", "bigint"))],
)
def test_unknown_hot_keys_are_found_and_salted_alone(spark, how, kinds, salted, shuffled):
    main, side = _skewed(spark, kinds[0]), spark.range(40000).selectExpr(f"cast(id AS {kinds[1]}) as k", "id * 2 as v")
    joined = apply_lookups(main, [_lookup(side, how=how, hot_keys=True)])
    expected = main.join(side.toDF("l_k", "l_v"), F.col("k") == F.col("l_k"), how)
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    if how in ("left", "inner"):
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 10000  # no task gets the hot key's 10,000
        plain = [r[1] for r in expected.groupBy(F.spark_partition_id()).count().collect()] if kinds[0] == kinds[1] else [10000]
        assert max(plain) >= 10000


def test_hot_keys_are_named_by_hash_and_only_if_hot(spark):
    hot, salt = hot_keys(_skewed(spark), ["k"])
    (key,) = hot
    assert spark.range(77, 78).select(F.xxhash64("id")).first()[0] == key and salt == 3  # a third of 8 tasks' rows
    nulls = spark.range(1000).selectExpr("cast(if(id % 2 = 0, null, id) as int) as k", "'x' as j")
    assert len(hot_keys(nulls, ["k", "j"])[0]) == 1
    assert hot_keys(spark.range(1000).selectExpr("id as k"), ["k"]) == ([], 0)
    assert hot_keys(spark.range(0).selectExpr("id as k"), ["k"]) == ([], 0)


def test_hot_keys_copy_the_hot_lookup_rows_only(spark, salted, shuffled):
    main, side = _skewed(spark), spark.range(40000).selectExpr("id as k", "id as v")
    text = plan(apply_lookups(main, [_lookup(side, how="left", hot_keys=True)]))
    assert "CASE WHEN" in text and "explode" in text.lower() and text.count("SortMergeJoin") == 1
    even = plan(apply_lookups(spark.range(9000).selectExpr("id as k"), [_lookup(side, how="left", hot_keys=True)]))
    assert "explode" not in even.lower()  # nothing is hot: a plain join


def test_small_lookups_are_not_salted(spark):
    main, side = spark.range(100).selectExpr("id as k"), spark.range(10).selectExpr("id as k", "id as v")
    assert "explode" not in plan(apply_lookups(main, [_lookup(side, salt=8)])).lower()


def test_large_outer_lookups_read_the_main_side_once(spark, small):
    main = spark.read.parquet(f"{small}/lineitem.parquet").selectExpr("l_partkey as k", "l_orderkey")
    side = spark.read.parquet(f"{small}/part.parquet").selectExpr("p_partkey as k", "p_brand as v")
    assert plan(apply_lookups(main, [_lookup(side, how="full")])).count("FileScan") == 2


@pytest.mark.parametrize("how", ["right", "full"])
@pytest.mark.parametrize("form", [{"salt": 4}, {"hot_keys": True}])
def test_small_outer_lookups_spread_keys_that_repeat_on_both_sides(spark, how, form):
    """Two keys make nearly all rows; no task makes more than a few times its share."""
    main = spark.range(2000).selectExpr("IF(id % 10 = 0, NULL, id % 2) as k", "id")
    side = spark.range(60).selectExpr("IF(id % 5 = 0, NULL, id % 3) as k", "id as v")
    joined = apply_lookups(main, [_lookup(side, how=how, **form)])
    expected = main.join(side.toDF("l_k", "l_v"), F.col("k") == F.col("l_k"), how)
    assert rows(joined) == rows(expected)
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4


@pytest.mark.parametrize("how", ["right", "full"])
@pytest.mark.parametrize("form", [{"salt": 4}, {"hot_keys": True}])
@pytest.mark.parametrize("kind", ["BIGINT", "STRING", "DOUBLE"])
def test_outer_lookups_joined_in_runs_keep_every_row(spark, monkeypatch, how, form, kind):
    """Keys with many lookup rows, one or none, null keys and rows that come twice, on both sides."""
    monkeypatch.setattr(lookups, "RUN", 4)
    main = spark.range(400).selectExpr(f"IF(id % 10 = 0, NULL, CAST(id % 3 AS {kind})) as k", "id % 90 as runs")
    side = spark.range(60).selectExpr(f"IF(id % 7 = 0, NULL, CAST(IF(id < 3, 90 + id, id * id % 5) AS {kind})) as k", "id % 40 as v")
    joined = apply_lookups(main, [_lookup(side, how=how, **form)])
    assert ("__run" in plan(joined)) == (kind != "DOUBLE")
    assert rows(joined) == rows(main.join(side.toDF("l_k", "l_v"), F.col("k") == F.col("l_k"), how))


def test_rows_of_keys_that_repeat_on_both_sides_are_stored_small(spark, tmp_path):
    """Two million rows made of two keys: neighbours repeat, so that a file needs a fraction of a byte a row."""
    main = spark.range(1000).selectExpr("id % 2 as k", "id")
    side = spark.range(4000).selectExpr("id % 2 as k", "id as v")
    joined = apply_lookups(main, [_lookup(side, how="right", salt=4)])
    joined.write.option("compression", "snappy").parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 0.6 * 2_000_000


def test_a_hot_key_is_spread_over_salts(spark, salted):
    """A third of the rows share one key; with salts no task gets them all."""
    main = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END as k", "id")
    side = spark.range(-1, 30000).selectExpr("id as k", "id as v")
    settings_before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = apply_lookups(main, [_lookup(side, how="left", salt=8)])
        assert "monotonically" not in plan(joined)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 10000
        assert joined.filter("k = -1 AND l_v = -1").count() == 10000
    finally:
        for name, value in settings_before.items():
            spark.conf.set(name, value)


def test_lookup_errors(spark):
    main = spark.range(1).selectExpr("'a' as k")
    side = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(SpecError, match="multiply"):
        apply_lookups(main, [_lookup(side, unique=True)])
    with pytest.raises(SpecError, match="repeats columns"):
        apply_lookups(main, [Lookup(LookupSource(frame=side), on=(("k", "k"),))])
    with pytest.raises(SpecError, match="no lookup columns"):
        apply_lookups(main, [_lookup(side, select=("zzz",))])
    with pytest.raises(SpecError, match="join type"):
        _lookup(side, how="semi")


# -- generators ----------------------------------------------------------------------------


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(st.integers(-5, 5), max_size=4)), min_size=1, max_size=6))
def test_outer_explode_keeps_every_row(spark, lists):
    df = spark.createDataFrame([(i, xs) for i, xs in enumerate(lists)], "i int, xs array<int>")
    expected = sum(max(len(xs or []), 1) for xs in lists)
    assert explode_elements(df, "xs").count() == expected
    as_variant = df.withColumn("xs", F.to_variant_object("xs"))
    assert explode_elements(as_variant, "xs").count() == expected


def test_explode_needs_a_collection(spark):
    with pytest.raises(SpecError, match="cannot explode"):
        explode_elements(spark.range(1), "id")


def test_explode_keeps_columns_named_like_its_output(spark):
    df = spark.range(1).selectExpr("1 as pos", "2 as key", "3 as value", "parse_json('[7]') as xs")
    assert rows(explode_elements(df, "xs").selectExpr("pos", "key", "value", "cast(_exploded as int)")) == [(1, 2, 3, 7)]


# -- classes -------------------------------------------------------------------------------


def test_class_schemas():
    # Top-level columns of each class.
    sizes = {
        "account_change": 35, "api_activity": 36, "authentication": 42, "authorize_session": 37,
        "data_security_finding": 49, "detection_finding": 49, "datastore_activity": 40, "dhcp_activity": 37,
        "dns_activity": 38, "email_activity": 35, "entity_management": 37, "file_activity": 34, "group_management": 36,
        "http_activity": 39, "kernel_extension_activity": 16, "network_activity": 38, "process_activity": 36,
        "scheduled_job_activity": 36, "script_activity": 31, "ssh_activity": 35, "user_access": 35,
        "vulnerability_finding": 33,
    }
    assert {name: len(class_schema(name)) for name in CLASSES} == sizes
    assert class_schema("api_activity")["http_request"].dataType["url"].dataType.simpleString() == "string"
    assert "hostname" in class_schema("authorize_session")["http_request"].dataType["url"].dataType.names


def test_conform_fills_reorders_and_refuses_extras(spark):
    df = spark.range(1).select(F.struct(F.lit("u").alias("uid")).alias("metadata"), F.lit(5).cast("bigint").alias("severity_id"))
    once = conform(df, "http_activity")
    expected = class_schema("http_activity").simpleString()
    assert once.schema.simpleString() == expected == conform(once, "http_activity").schema.simpleString()
    assert once.select("metadata.uid", "metadata.product.name", "severity_id").first() == ("u", None, 5)
    with pytest.raises(SpecError, match="outside"):
        conform(df.withColumn("odd", F.lit(1)), "http_activity")
    assert "odd" not in conform(df.withColumn("odd", F.lit(1)), "http_activity", strict=False).columns
    assert mapping_problems(df.withColumn("odd", F.lit(1)), "http_activity")["extra"] == ["odd"]


# -- normalisers -----------------------------------------------------------------------------


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.one_of(st.none(), st.text(alphabet="0123456789x-", max_size=3)))
def test_severity_is_total(spark, digit):
    df = spark.createDataFrame([(digit,)], "d string").select(n.syslog_severity(F.col("d")).alias("s"))
    expected = {"0": 6, "1": 5, "2": 5, "3": 4, "4": 3, "5": 2, "6": 1, "7": 1}
    try:
        key = str(int(digit)) if digit else None
    except ValueError:
        key = None
    assert df.first()[0] == expected.get(key, 99)


def test_record_reads_like_single_paths(spark):
    lines = [
        '{"a":"x","b":"-","c":{"d":1,"e":"q"},"l":[1,"z",3],"t":1700000000.5,"k.x":"dot"}',
        '{"a":{"z":1},"b":"12","c":"oops","l":"no","t":"2024-01-01"}',
        '{"a":null,"b":12.7,"c":null}', "[1,2]", '"str"',
    ]
    wanted = {"a": "string", "b": "int", "c.d": "bigint", "c.e": "string", "l": "array<int>", "t": "timestamp", ("k.x",): "string"}
    df = spark.createDataFrame([(line,) for line in lines], "r string").select(F.parse_json("r").alias("data"))
    single = df.select(
        *(F.try_variant_get("data", "$" + "".join(f"['{k}']" for k in (p.split(".") if isinstance(p, str) else p)), t)
          for p, t in wanted.items())
    )
    together = df.select(n.record(wanted).alias("record")).select(*(n.member(p) for p in wanted))
    assert rows(single) == rows(together)


def test_ios_description_may_hold_the_break_sign(spark):
    line = "7: Mar  3 2025 08:00:01: %A-5-B: odd \u0001 text"
    df = spark.createDataFrame([(line,), ("\u0001" * 6,)], "value string").select(n.ios_parts(F.col("value")).alias("p"))
    assert [r[0] for r in df.collect()] == [["7", "Mar  3 2025 08:00:01", "A", "5", "B", "odd \u0001 text"], None]


# -- plans -----------------------------------------------------------------------------------


def test_profile_reads_the_table_once(spark, small):
    text = plan(profile.null_profile(spark.read.parquet(f"{small}/orders.parquet")))
    assert text.count("FileScan parquet") == 1


def test_filters_and_columns_reach_the_scan(spark, small):
    spec = SilverSpec(name="s", filter="l_quantity > 10", fields=(Field("k", source="l_orderkey"),))
    text = plan(to_silver(spark.read.parquet(f"{small}/lineitem.parquet"), spec))
    assert "GreaterThan(l_quantity,10.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_no_python_and_no_shuffle_in_a_mapping(spark, small):
    from workload import catalogue

    for name in ("vpc_network_activity", "dns_activity", "github_account_change", "explode_variant", "gold_routing"):
        text = plan(catalogue.QUERIES[name](spark, small))
        assert "Python" not in text and "Exchange" not in text and "Cartesian" not in text, name


def test_layers_can_be_chosen(spark, tmp_path):
    from siltstone.sources import cisco_ios

    flow = cisco_ios.flow(samples.write(tmp_path / "in", samples.IOS))
    run = run_batch(spark, flow, tables=["authentication"])
    assert list(run.gold) == ["authentication"] and list(run.silver) == ["cisco_ios_silver"]
    again = run_batch(spark, flow, silver=run.silver, conformed=False)
    assert again.bronze is None and "actor" not in again.gold["authentication"].columns
    with pytest.raises(SpecError, match="unknown table"):
        run_batch(spark, flow, silver={})


def test_gold_filters_before_and_after(spark):
    spec = GoldSpec(name="g", input="s", filter="id > 2", fields=(Field("twice", "id * 2"),), post_filter="twice < 12")
    assert [r[0] for r in to_gold(spark.range(10), spec).collect()] == [6, 8, 10]


# -- one reading of each value -----------------------------------------------------------


def test_observables_are_compiled_and_leave_out_missing_values(spark):
    made = n.observables([("a", "A", F.col("id")), ("b", "B", F.when(F.col("id") > 0, F.lit("x")))])
    df = spark.range(2).select(made.alias("o"))
    assert "lambda" not in plan(df)
    assert [[tuple(o) for o in r.o] for r in df.collect()] == [[("a", "A", "0")], [("a", "A", "1"), ("b", "B", "x")]]
    none = spark.range(1).select(n.observables([("a", "A", n.null_of("string"))]).alias("o"))
    assert none.first().o == []


def test_direction_reads_each_end_once(spark):
    ends = [(a, b, d) for a in (True, False, None) for b in (True, False, None) for d in ("ingress", "egress", "x", None)]
    df = spark.createDataFrame(ends, "a boolean, b boolean, d string")
    code = n.direction_id(F.col("a"), F.col("b"), F.col("d"))
    alone = n.direction_id(F.col("a"), F.col("b"))
    known = {(True, True): 3, (True, False): 2, (False, True): 1}
    for r in df.select("*", code.alias("code"), alone.alias("alone")).collect():
        assert r.alone == known.get((r.a, r.b), 0)
        assert r.code == {"ingress": 1, "egress": 2}.get(r.d, r.alone)
    held = df.select(n.is_private(F.col("d")).alias("p"), n.is_private(F.concat("d", F.lit("."))).alias("q"))
    assert plan(held.select(n.direction_id(F.col("p"), F.col("q")))).count("Project") == 1
