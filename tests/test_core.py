"""Functions, index, search, results, records and streams."""

import itertools
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from logspark.functions import scalar as S
from logspark.operators import index as I
from logspark.operators import metrics as M
from logspark.operators import prune as P
from logspark.operators import records as R
from logspark.operators import reports as T
from logspark.operators import results as Q
from logspark.operators import search as X
from logspark.operators import segments as G
from logspark.operators import symbols as Y
from logspark.plans.queries import QUERIES, T0, T1, indexed_events
from logspark.sources import files
from logspark.streaming import streams

SF = "/root/testdata/sf0.001"

# Cases of the search grammar's contract.
GRAMMAR = [
    ('a == "hello"', ["a=hello"]), ('includes(b, "bye")', ["b=bye"]), ('MyClass.field == "value"', ["MyClass.field=value"]), ('includes(MyClass.field, "value with space")', ["MyClass.field=value with space"]),
    ('field == ""', ["field="]), ('(a == "1") && (b == "2")', ["a=1", "b=2"]), ('(a == "1") || (b == "2")', ["a=1", "b=2"]), ('a == "1" && b == "2" || c == "3"', ["a=1", "b=2", "c=3"]),
    ('a == "1" && (b == "2" || c == "3")', ["a=1", "b=2", "c=3"]), ('((a == "1") && (includes(b, "2"))) || (MyClass.c == "3")', ["a=1", "b=2", "MyClass.c=3"]),
    ('(a == "1" || b == "2") && (c == "3" || d == "4")', ["a=1", "b=2", "c=3", "d=4"]), ('(((a == "1")))', ["a=1"]),
]


@pytest.mark.parametrize(("text", "constants"), GRAMMAR)
def test_grammar_over_all_truth_values(spark, text, constants):
    found, shape = X.clauses(text)
    assert [f"{c.field}={c.value}" for c in found] == constants
    names = [f"x{i}" for i in range(len(found))]
    rows = list(itertools.product([False, True], repeat=len(found)))
    df = spark.createDataFrame(rows, ", ".join(f"{n} boolean" for n in names))
    got = df.select(*names, X.gate_expr(text, dict(enumerate(names))).alias("y")).collect()
    python = shape.replace("&&", " and ").replace("||", " or ")
    for i, n in enumerate(names):
        python = python.replace(f"\x00{i}\x00", n)
    assert all(r.y == eval(python.strip(), {}, r.asDict()) for r in got)  # noqa: S307  built from names and operators only


@pytest.mark.parametrize("text", ["", None, "a == hello", 'includes(a "1")', '(a == "1"', 'a = "1"', 'includes(a, "1" extra', 'a == "1" b == "2"', 'a == "1" && '])
def test_bad_searches(text):
    with pytest.raises(ValueError):
        X.clauses(text)


def test_literals_are_data(spark):
    value = "x' OR 1=1 && \\ || y"
    df = spark.createDataFrame([(value,), ("z",)], "a string")
    assert df.where(X.search_expr(f'a == "{value}"')).count() == 1
    assert df.where(X.search_expr('includes(a, "&& \\")')).count() == 1


def test_pruning_never_changes_the_answer(spark):
    e = indexed_events(spark, SF).cache()
    postings = I.distinct_tokens(e).cache()
    filters = I.build_bloom(postings, limit=4).cache()  # several parts
    assert filters.where("parts > 1").count() > 0
    for text in ('event_type == "error"', 'k == "7" || event_type == "view" && user_id == "3"', 'includes(this, "1") && k == "5"', 'includes(this, "click")', 'k == "absent"'):
        o = X.QueryOptions(text)
        plain = sorted(r.seq for r in Q.search(e, o).collect())
        assert plain == sorted(r.seq for r in Q.search(e, o, postings=postings).collect())
        assert plain == sorted(r.seq for r in Q.search(e, o, filters=filters).collect())


def token_rows(spark, n, prefix="tok"):
    return spark.range(n).select(F.lit("t").alias("target"), F.lit(0).cast("long").alias("bucket"), F.lit("o").alias("object_id"), F.lit(0).cast("long").alias("chunk_id"), F.concat(F.lit(prefix), F.col("id")).alias("token"))


@pytest.mark.parametrize(("n", "limit", "accuracy", "least"), [(3000, 4096, 90, 1), (3000, 1024, 90, 1), (3000, 1024, 99, 1), (5000, 256, 95, 2), (40, 4096, 90, 1), (1, 4096, 90, 1)])
def test_filters_are_sized_for_their_tokens(spark, n, limit, accuracy, least):
    f = I.build_bloom(token_rows(spark, n), limit, accuracy, least).cache()
    rows = f.collect()
    assert sum(r.n for r in rows) == n
    assert all(len(r.bitmap) * 8 == r.bits <= limit * 8 for r in rows)
    assert all(r.fpr <= (100 - accuracy) / 100 * 1.05 for r in rows)
    assert {(r.part / r.parts) for r in rows} == {r.part / r.parts for r in rows if r.part < r.parts} and abs(sum(1 / r.parts for r in rows) - 1) < 1e-9
    assert n < 100 or sum(r.bits for r in rows) / n < 16  # bits a token
    if len(rows) > 1:  # only what the last rate does not hold is bisected
        assert all(r.n <= I.tokens_for((100 - accuracy) / 100, limit) for r in rows)
    tokens = token_rows(spark, n).select("token")
    held = f.crossJoin(tokens).where(P.bloom_might_contain(F.col("token")))
    assert held.select("token").distinct().count() == n  # no false negative
    absent = f.crossJoin(token_rows(spark, 4000, "none").select("token")).where(P.bloom_might_contain(F.col("token"))).count()
    want = sum(r.fpr / r.parts for r in rows)  # a token is tested against its own part
    assert absent <= 4000 * want * 2 + 20


def test_filter_sizes():
    assert I.filter_size(100, 0.01) == (960, 7)
    assert I.filter_size(0, 0.01) == (8, 7)
    assert I.filter_size(I.tokens_for(0.01, 64), 0.01)[0] <= 512 < I.filter_size(I.tokens_for(0.01, 64) + 1, 0.01)[0]
    for bad in (0, 1):
        with pytest.raises(ValueError):
            I.tokens_for(bad)
        with pytest.raises(ValueError):
            I.filter_size(3, bad)


def test_filters_of_nothing_and_bad_rates(spark):
    assert I.build_bloom(token_rows(spark, 0)).count() == 0
    with pytest.raises(ValueError):
        I.build_bloom(token_rows(spark, 1), accuracy=100)
    f = I.build_bloom(token_rows(spark, 20))
    both = [f.where(P.might_contain_all(t)).count() for t in (["tok1", "tok2"], ["tok1", "absent"], [])]
    assert both == [1, 0, 1]
    assert [f.where(P.might_contain_any(t)).count() for t in (["absent", "tok3"], ["absent"], [])] == [1, 0, 0]


def test_bitmaps_gate_by_template(spark):
    e = indexed_events(spark, SF).cache()
    postings = I.distinct_tokens(e).cache()
    filters = I.build_bloom(postings)
    hashes = [r.token for r in postings.where("token = '7' or token = 'signup'").select("token").distinct().collect()]
    o = X.QueryOptions('event_type == "error"')
    exact, may = (Q.candidates(e, o, template_hashes=hashes, **side).distinct() for side in ({"postings": postings}, {"filters": filters}))
    assert exact.count() > 0 and exact.exceptAll(may).count() == 0
    assert may.count() <= Q.candidates(e, o, filters=filters).distinct().count()
    assert Q.candidates(e, o, filters=filters, template_hashes=["no such hash"]).count() < may.count()


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).head().x
    lit = F.lit
    assert value(S.tokenize(lit("a,b;;c d"), ",; ")) == ["a", "b", "c", "d"]
    assert [value(S.epoch_millis(lit(x))) for x in (1704067798, 1704067798778, 1704067798778549, 1704067798778549000, 5, None)] == [1704067798000, *[1704067798778] * 3, None, None]
    assert [value(S.parse_duration_ns(lit(x))) for x in ("10s", "-3m", "250", "P1DT2H", "PT1.5S", "x", "P", "7xy")] == [10**10, -180 * 10**9, 250 * 10**6, 93600 * 10**9, 1500 * 10**6, None, None, None]
    assert value(S.syslog_msg(lit('<134>1 2024-01-15T10:30:00Z host app 1234 - - {"level":"INFO","msg":"test"}'))) == '{"level":"INFO","msg":"test"}'
    assert value(S.escape_control(lit("a\nb\tc\x01"))) == "a\\nb\\tc\\u0001"
    assert value(S.any_value_to_json(lit('{"kvlistValue":{"values":[{"key":"a","value":{"arrayValue":{"values":[{"intValue":"1"},{"stringValue":"x\\"y"}]}}}]}}'))) == '{"a":[1,"x\\"y"]}'
    nested = {"a": {"b": {"c": ["x", 1, {"d": None}]}}}
    assert json.loads(value(S.any_value_to_json(S.json_to_any_value(lit(json.dumps(nested)))))) == nested
    assert value(S.any_value_to_json(lit("{}"))) is None and value(S.any_value_to_json(lit("no json"))) is None
    assert value(S.poly_hash(lit("ab"))) == value(S.poly_hash(lit("b"), S.poly_hash(lit("a")))) == 31 * 97 + 98
    assert value(S.poly_hash(lit("z" * 40))) == (sum(122 * 31**i for i in range(40)) + 2**63) % 2**64 - 2**63
    assert value(S.json_to_any_value(lit('[1,"a",true]'))) == '{"arrayValue":{"values":[{"intValue":1},{"stringValue":"a"},{"boolValue":true}]}}'
    assert [value(S.truncate_dimension(lit(v), lit(n))) for v, n in (("warning", "level"), ("", "level"), ("404 Not Found", "http"), ("Netherlands", "geo"))] == ["WARN", "UNCL", "404", "Netherland"]
    assert value(S.event_time_seconds(F.unhex(lit("65A5C2F800000000")))) == 0x65A5C2F8
    assert [value(S.is_well_formed_utf8(F.unhex(lit(x)))) for x in ("C3A9", "FF")] == [True, False]
    assert value(S.series_hash(lit("a"), lit("b"))) == value(S.series_hash(lit("a"), lit("b"))) != value(S.series_hash(lit("ab"), lit("")))
    assert S.time_slice(0, 100, 10, 3) == 40
    assert value(S.join_markers(F.create_map(lit("a"), lit("1")), t=lit(5))) == {"a": "1", "_carried_t": "5"}
    assert [value(S.format_bytes(lit(x))) for x in (999, 1500, 2_000_000, 3_100_000_000)] == ["999B", "1.5KB", "2.0MB", "3.1GB"]
    with pytest.raises(Exception, match="unsupported data point"):
        value(S.sample_value(lit("histogram"), lit(1.0), lit(1.0)))


def test_greedy_chunks(spark):
    lines = spark.createDataFrame([("o", i * 10, i * 10 + 10, "x") for i in range(10)], "object_id string, line_start long, line_end long, text string")
    got = {r.line_start: r.chunk_id for r in I.assign_chunks(lines, 25, greedy=True).collect()}
    assert [got[i * 10] for i in range(10)] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    with pytest.raises(ValueError):
        I.assign_chunks(lines, 0)


def test_files(spark, tmp_path):
    path = tmp_path / "log.txt"
    path.write_bytes("é one\ntwo\nthree\n".encode())
    rows = files.read_lines(spark, str(path)).orderBy("line_start").collect()
    assert [(r.line_start, r.line_end, r.text) for r in rows] == [(0, 7, "é one"), (7, 11, "two"), (11, 17, "three")]
    assert [r.text for r in files.read_ranges(spark, str(path), [(7, 4)]).collect()] == ["two"]
    assert sorted(r.text for r in files.read_ranges(spark, f"file://{path}", [(0, 2), (8, 9)]).collect()) == ["three", "é one"]


def test_index_tables(spark, tmp_path):
    root = str(tmp_path)
    e = indexed_events(spark, SF)
    I.write_filters(I.distinct_tokens(e), root, "postings")
    I.write_chunks(I.chunk_bounds(e), root)
    assert files.read_chunks(spark, root).count() == I.chunk_bounds(e).count()
    before = spark.read.parquet(f"{root}/postings").count()
    own = files.read_object_entries(spark, root, "2024-01-10", "postings").count()
    assert I.delete_object(spark, root, "postings", "2024-01-10") == own > 0
    assert spark.read.parquet(f"{root}/postings").count() == before - own
    odd = e.withColumn("target", F.when(F.col("seq") % 3 == 0, "app:web").when(F.col("seq") % 3 == 1, "007")).withColumn("object_id", (F.col("seq") % 2).cast("string"))
    I.write_filters(I.distinct_tokens(odd), root, "odd")  # targets that are escaped, numbers and null
    rows = I.read_index(spark, root, "odd")
    total, want = rows.count(), rows.where("object_id <> '1'").select("target", "token").collect()
    assert I.delete_object(spark, root, "odd", "1") == total - len(want) > 0
    left = I.read_index(spark, root, "odd")
    assert sorted(map(str, left.select("target", "token").collect())) == sorted(map(str, want))
    assert {r.target for r in left.select("target").distinct().collect()} == {"app:web", "007", None}
    assert I.delete_object(spark, root, "odd", "0") == len(want)
    assert not [p for p in (tmp_path / "odd").rglob("*.parquet")]
    t0 = 1704844800000
    got = files.scan_filters_between(spark, root, "events", t0 + 5, t0 + 86_400_000 * 3, 3_600_000, "postings")
    assert got.where("bucket < %d" % t0).count() == 0 and got.count() > 0
    assert "PartitionFilters: [isnotnull(target" in got._jdf.queryExecution().toString()


def test_templates_are_compacted(spark, tmp_path):
    root = str(tmp_path)
    for version, rows in enumerate([[("a", "A", 2), ("b", "B", 1)], [("a", "A2", 1), ("c", "C", 3)]]):
        I.append_templates(spark.createDataFrame(rows, "template_hash string, template string, first_seen long"), root)
        assert I.compact_templates(spark, root, version)
    assert not I.compact_templates(spark, root, 9, last_ms=10, now_ms=15, min_interval_ms=10)
    merged = I.latest_merged(spark.read.parquet(f"{root}/templates/merged"), "version")
    assert {r.template_hash: r.template for r in merged.collect()} == {"a": "A2", "b": "B", "c": "C"}
    assert not list((tmp_path / "templates" / "raw").glob("*.parquet")) and len({p.parent for p in (tmp_path / "templates" / "merged").rglob("*.parquet")}) == 1
    assert {r.template_hash: r.template for r in I.read_templates(spark, root).collect()} == {"a": "A2", "b": "B", "c": "C"}


def test_results_and_deadline(spark, tmp_path):
    rows = spark.createDataFrame([("o", i, "s1" if i < 5 else "s2", "t\n" if i == 3 else "t") for i in range(12)], "object_id string, seq long, slice string, text string")
    counted = {r.slice: r for r in Q.write_results(rows, str(tmp_path), "q", 3).collect()}
    assert (counted["s2"].written, counted["s2"].dropped, counted["s2"].truncated, counted["s1"].control) == (3, 4, True, 1)
    assert Q.read_results(spark, str(tmp_path), "q", "seq long").count() == 6
    assert Q.run_with_deadline(spark, lambda: spark.range(5).count(), 60_000) == (5, False)
    slow = F.udf(lambda x: __import__("time").sleep(30) or x, "long")
    assert Q.run_with_deadline(spark, lambda: spark.range(2).select(slow("id")).collect(), 1500) == (None, True)


def test_otlp_roundtrip_keeps_types_and_resources(spark):
    deep = {"kvlistValue": {"values": [{"key": "b", "value": {"arrayValue": {"values": [{"kvlistValue": {"values": [{"key": "c", "value": {"arrayValue": {"values": [{"stringValue": "x]}"}, {}]}}}]}}]}}}]}}
    one = spark.createDataFrame([(json.dumps({"resourceLogs": [{"resource": {}, "scopeLogs": [{"logRecords": [{"body": deep, "attributes": [{"key": "a", "value": deep}, {"key": "a", "value": {"boolValue": True}}, {"key": "d", "value": deep}]}]}]}]}),)], "request string")
    r = R.flatten_otlp(one).head()
    assert json.loads(r.body) == json.loads(r.attributes["d"]) == {"b": [{"c": ["x]}", None]}]} and r.attributes["a"] == "true"
    request = {"resourceLogs": [{"resource": {"attributes": [{"key": "service.name", "value": {"stringValue": ""}}, {"key": "k8s.pod.name", "value": {"stringValue": "p1"}}]}, "scopeLogs": [{"logRecords": [
        {"timeUnixNano": "5", "body": {"stringValue": "plain"}, "attributes": [{"key": "n", "value": {"intValue": "3"}}]}, {"timeUnixNano": "6", "body": {"kvlistValue": {"values": [{"key": "a", "value": {"boolValue": True}}]}}}]}]}]}
    got = R.flatten_otlp(spark.createDataFrame([(json.dumps(request),)], "request string")).orderBy("time_ns").collect()
    assert [(r.tag, r.body, r.attributes) for r in got] == [("p1", "plain", {"n": "3"}), ("p1", '{"a":true}', {})]
    grouped = R.group_by_resource(R.flatten_otlp(spark.createDataFrame([(json.dumps(request),)], "request string")))
    assert grouped.head().records and grouped.count() == 1


@pytest.mark.parametrize(("n", "batch"), [(1000, 100), (1000, 7), (1, 100)])
def test_batches_of_equal_records_are_bounded(spark, n, batch):
    rows = spark.range(n).select(F.lit(5).cast("long").alias("time_ns"), F.lit(None).cast("long").alias("observed_ns"), F.lit("same").alias("body"), F.expr("map('k', 'v')").alias("attributes"), F.expr("map('service.name', 's')").alias("resource"))
    rows = rows.union(rows.limit(3).withColumn("resource", F.expr("map('service.name', 't')")))
    sizes = [len(r.records) for r in R.group_by_resource(rows, batch).where("resource like '%\"s\"%'").collect()]
    assert sum(sizes) == n and max(sizes) <= batch
    sent = [r.n_records for r in R.to_otlp(rows, batch).collect()]
    assert sum(sent) == n + min(n, 3) and max(sent) <= batch and len(sent) <= 2 * n / batch + 3
    assert R.flatten_otlp(R.to_otlp(rows, batch)).groupBy("tag").count().orderBy("tag").collect()[0]["count"] == n


def test_reports(spark):
    df = spark.createDataFrame([("a", "5"), ("b", "x"), ("c", "15")], "name string, v string")
    assert [(r["rank"], r.name, r.pct, r.bar) for r in T.chart(df, "name", "v", 2, 20).collect()] == [(1, "c", 75, "#" * 15), (2, "a", 25, "#" * 5)]
    s = spark.createDataFrame([("m", "counter", "a", 100000, 2.0), ("m", "counter", "b", 5, 0.0)], "name string, kind string, labels string, ts long, value double")
    assert sorted((r.ts, r.value) for r in M.zero_start(s).where("labels = 'a'").collect()) == [(40000, 0.0), (100000, 2.0)]
    assert M.zero_start(s).where("labels = 'b'").count() == 1


def test_streams_equal_batch(spark, tmp_path):
    e = indexed_events(spark, SF)
    for i in range(3):
        e.where(f"seq % 3 = {i}").write.mode("append").parquet(f"{tmp_path}/in")
    source = files.stream_objects(spark, f"{tmp_path}/in", e.schema)
    streams.stream_index(source, str(tmp_path), f"{tmp_path}/c1").awaitTermination()
    got = G.read(spark, str(tmp_path), "postings").select(*I.CHUNK, "token").distinct()
    assert got.exceptAll(I.distinct_tokens(e)).count() == 0 and got.count() == I.distinct_tokens(e).count()

    held = {}

    class Sink:
        def write(self, samples, batch_id):
            held.update({r.kind: r.value for r in samples.collect()})

    listener = streams.StreamCounters()
    spark.streams.addListener(listener)
    counted = source.withColumn("kind", F.col("enrichment")["event_type"])
    streams.start_counters(counted, ["kind"], "n_bytes", Sink(), f"{tmp_path}/c2", None).awaitTermination()
    want = {r.kind: r.value for r in M.counters(e.withColumn("kind", F.col("enrichment")["event_type"]), ["kind"], "n_bytes").collect()}
    assert held == want
    sent = []
    records = source.select((F.col("ts_ms") * 10**6).alias("time_ns"), F.lit(None).cast("long").alias("observed_ns"), F.col("text").alias("body"), F.col("enrichment").alias("attributes"), F.create_map(F.lit("service.name"), F.lit("s")).alias("resource"))
    streams.stream_otlp(records, lambda d: sent.extend(d.collect()), f"{tmp_path}/c3", 100).awaitTermination()
    assert sum(r.n_records for r in sent) == e.count()
    q = streams.stream_templates(source.select(F.col("object_id").alias("template_hash"), F.col("object_id").alias("template"))).writeStream.format("memory").queryName("tpl").option("checkpointLocation", f"{tmp_path}/c4").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tpl").count() == e.select("object_id").distinct().count()
    seen = source.select(F.lit("n").alias("name"), F.col("object_id").alias("labels"), F.timestamp_millis("ts_ms").alias("ts"))
    q = streams.first_seen_stream(seen, watermark="40 days").writeStream.format("memory").queryName("seen").option("checkpointLocation", f"{tmp_path}/c5").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen").count() == e.select("object_id").distinct().count()
    buckets = streams.bucket_stream(spark.readStream.schema(e.withColumn("ts", F.timestamp_millis("ts_ms")).schema).parquet(f"{tmp_path}/in").withColumn("ts", F.timestamp_millis("ts_ms")), "1 hour", "40 days")
    q = buckets.writeStream.format("memory").queryName("bkt").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c6").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("bkt").agg(F.sum("n")).head()[0] == e.count()
    on_time, late = streams.split_late(e.withColumn("newest_ms", F.lit(1706000000000)), 86_400_000)
    assert on_time.count() + late.count() == e.count() and late.count() > 0


def test_every_query_runs(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def test_extensions(spark):
    from logspark.operators import extend as E

    df = spark.createDataFrame([("error: x", "TRUE"), ("fine", None)], "line string, flag string")
    E.register_includes(spark)
    assert E.run_sql(spark, "SELECT count(*) AS n FROM {d} WHERE includes(line, :v)", {"v": "error"}, d=df).head().n == 1
    assert [r.x for r in df.select(E.truthy(E.expr("flag")).alias("x")).collect()] == [True, False]
    E.register(spark, "shout", lambda s: s.str.upper(), "string")
    assert E.run_sql(spark, "SELECT shout('a') AS x").head().x == "A"


def test_model_matches_operators(spark):
    from logspark.model import DDL, schema

    e = indexed_events(spark, SF)
    postings = I.distinct_tokens(e)
    made = {"events": e, "postings": postings, "filters": I.build_bloom(postings), "chunks": I.chunk_table(e.withColumns({"line_start": F.lit(0).cast("long"), "line_end": F.lit(9).cast("long")}))}
    for name, df in made.items():
        types = {f.name: f.dataType.simpleString() for f in schema(name)}
        assert set(types) <= set(df.columns), name
        assert types == {c: df.schema[c].dataType.simpleString() for c in types}
    assert all(schema(n) for n in DDL)


def test_symbol_and_key_postings_are_rows(spark):
    nodes = spark.range(1000).select(F.col("id").alias("unit_id"), F.explode(F.array(F.lit("leaf"), F.concat(F.lit("u"), F.col("id") % 7), F.lit("leaf"))).alias("value"))
    postings = Y.build_symbol_index(nodes)
    assert postings.columns == ["symbol", "unit_id"]
    assert postings.where("symbol = 'leaf'").count() == 1000
    placed = Y.symbol_positions(postings, spark.range(1000).select(F.col("id").alias("unit_id"), F.lit(3).alias("length")))
    assert placed.count() == 2000
    assert "collect_" not in placed._jdf.queryExecution().toString()
    parts = I.list_parts(postings, "symbol", "unit_id", "unit_ids", 100).where("symbol = 'leaf'").collect()
    assert sorted(u for r in parts for u in r.unit_ids) == list(range(1000))
    assert len(parts) == 10
    assert max(len(r.unit_ids) for r in parts) < 200
    assert all(r.unit_ids == sorted(r.unit_ids) for r in parts)
    keys = I.reverse_index(indexed_events(spark, SF))
    assert keys.columns == ["object_id", "key"]
    assert "collect_" not in keys._jdf.queryExecution().toString()


def test_deep_symbols(spark):
    tree = None
    for depth in range(11, -1, -1):
        tree = {"value": f"d{depth}", "context": "VAR", **({"children": [tree]} if tree else {})}
    units = spark.createDataFrame([(1, json.dumps({"nodes": [tree]})), (2, json.dumps({"nodes": []})), (3, None)], "unit_id long, unit string")
    assert [(r.depth, r.value) for r in Y.walk_symbols(units).orderBy("depth").collect()] == [(d, f"d{d}") for d in range(12)]
    assert Y.walk_symbols(units, max_depth=3).count() == 3
    assert Y.walk_symbols(units.limit(0)).count() == 0


def test_lines_and_ranges_of_raw_objects(spark, tmp_path):
    """Lines of files split anywhere, and ranges that start and end anywhere, against plain Python over the bytes."""
    from logspark.sources import files

    r = random.Random(7)
    root = tmp_path / "objects of tests"
    root.mkdir()
    held = {}
    for name in ("a.log", "b=1.log", "c.log", "empty.log", "open.log"):
        lines = [bytes(r.choices(b"ab\xc3\xa9\xff\t\r ", k=r.choice([0, 1, 7, 40, 300]))) for _ in range({"empty.log": 0}.get(name, 400))]
        data = b"".join(x + b"\n" for x in lines)
        if name == "open.log":
            data += b"the last line has no end"
        (root / name).write_bytes(data)
        at, held[name] = 0, []
        for x in data.split(b"\n")[: -1 if data.endswith(b"\n") or not data else None]:
            held[name].append((at, x))
            at += len(x) + 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = files.read_lines(spark, str(root)).select("object_id", "line_start", "line_end", F.col("text").cast("binary").alias("text")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    names = {x.object_id for x in got}
    of = {n: next(o for o in names if o.endswith(n.replace("=", "%3D")) or o.endswith(n)) for n in held if held[n]}
    assert sorted((x.object_id, x.line_start, bytes(x.text)) for x in got) == sorted((of[n], a, x) for n in of for a, x in held[n])
    assert all(x.line_end == x.line_start + len(x.text) + 1 for x in got)
    ranges = [(of[n], r.randrange(0, 30_000), r.choice([0, 1, 5, 100, 5000, 10**9])) for n in of for _ in range(12)]
    found = files.read_object_ranges(spark.createDataFrame(ranges, "object_id string, offset long, length long")).select("object_id", "line_start", F.col("text").cast("binary").alias("text")).collect()
    want = [(o, a, x) for o, start, n in ranges for name in of if of[name] == o for a, x in held[name] if start <= a < start + n]
    assert sorted((x.object_id, x.line_start, bytes(x.text)) for x in found) == sorted(want)
    one = files.read_ranges(spark, of["a.log"], [(100, 900), (0, 50)]).select("line_start", F.col("text").cast("binary").alias("text")).collect()
    assert sorted((x.line_start, bytes(x.text)) for x in one) == sorted((a, x) for a, x in held["a.log"] if a < 50 or 100 <= a < 1000)


def test_long_lines_are_read_behind_their_range(tmp_path, monkeypatch):
    from logspark.sources import files

    monkeypatch.setattr(files, "PIECE", 1000)
    data = b"x" * 300_000 + b"\n" + b"short\n" + b"y" * 50_000
    (tmp_path / "o").write_bytes(data)
    read = lambda a, n: [(p, len(t)) for b in files._range_lines(str(tmp_path / "o"), a, n) for p, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
    assert read(0, 1) == [(0, 300_000)]
    assert read(5, 10) == []
    assert read(1, 300_001) == [(300_001, 5)]
    assert read(0, 10**7) == [(0, 300_000), (300_001, 5), (300_007, 50_000)]
    assert read(400_000, 5) == []


def test_merged_ranges(spark):
    """Adjacent chunks become one range, gaps and every most-th chunk end it."""
    r = random.Random(3)
    rows = [(o, c, c * 10 + (c > 40) * 3, 10 + (c == 40) * 3) for o in ("a", "b") for c in range(70) if r.random() < 0.7]
    got = P.merge_ranges(spark.createDataFrame(rows, "object_id string, chunk_id long, offset long, length long"), 16).collect()
    want = []
    for o, c, offset, length in rows:
        if want and want[-1][0] == o and want[-1][1] + want[-1][2] == offset and c % 16:
            want[-1][2] += length
            want[-1][3] += 1
        else:
            want.append([o, offset, length, 1])
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_search_over_objects_reads_less_and_finds_all(spark):
    from logspark.operators import objects as O
    from logspark.plans import queries as Z

    root = Z.object_index_of(spark, SF)
    lines = Z.parsed(files_of(spark)).cache()
    for text in ('user_id == "17"', 'event_type == "error" && k == "5"', 'includes(this, "view")', 'k == "absent"'):
        for t0, t1 in ((0, 0), (T0, T1)):
            o = X.QueryOptions(text, t0=t0, t1=t1)
            want = sorted(r.seq for r in lines.where(X.in_range(F.col("ts_ms"), t0, t1) & X.search_expr(text, fields=Q.EVENT_FIELDS)).collect())
            for kind in ("postings", "filters"):
                assert sorted(r.seq for r in O.search_objects(spark, root, "logs", o, Z.parsed, kind).collect()) == want, (text, kind)
    c = O.read_counters(spark, root, "logs", X.QueryOptions('user_id == "17"')).head()
    assert 0 < c.bytes < c.bytes_held and c.ranges <= c.chunks < c.chunks_held
    few = O.read_counters(spark, root, "logs", X.QueryOptions('k == "absent"')).head()
    assert (few.bytes, few.ranges) == (0, 0)


def files_of(spark):
    from logspark.plans import queries as Z
    from logspark.sources import files

    return files.read_lines(spark, Z.log_objects(spark, SF))


def test_segments_are_merged_level_by_level(spark, tmp_path):
    root, e = str(tmp_path), indexed_events(spark, SF)
    postings = I.distinct_tokens(e).cache()
    assert G.read(spark, root, "postings").count() == 0 and G.live(spark, root, "postings") == (0, [])
    pinned = {}
    for i in range(7):
        assert G.append(I.distinct_tokens(e.where(f"seq % 7 = {i}")), root, "postings", i)
        assert not G.append(I.distinct_tokens(e.where(f"seq % 7 = {i}")), root, "postings", i)  # run again
        G.compact(spark, root, "postings", 2)
        version, live = G.live(spark, root, "postings")
        assert sorted(b for s in live for b in s["batches"]) == list(range(i + 1))
        assert len({s["level"] for s in live}) == len(live)  # at most one of a level is left
        pinned[version] = i
    for version, i in pinned.items():  # readers of older versions are not disturbed
        want = I.distinct_tokens(e.where(f"seq % 7 <= {i}"))
        got = G.read(spark, root, "postings", version).select(*want.columns).distinct()
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert G.compact(spark, root, "postings", full=True) == 1
    once = G.read(spark, root, "postings")
    assert once.count() == postings.count() and once.select(*postings.columns).exceptAll(postings).count() == 0
    assert G.vacuum(spark, root, "postings") > 0
    assert G.read(spark, root, "postings").count() == postings.count()
    assert len(list((tmp_path / "postings").glob("segment=*"))) == 1
    plan = once.where("target = 'events' and bucket_day = '2024-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket_day" in plan


def test_segments_survive_dead_and_concurrent_writers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(G, "PATIENCE", 0.3)
    root, e = str(tmp_path), indexed_events(spark, SF)
    rows = I.distinct_tokens(e)
    G.append(rows.where("chunk_id % 2 = 0"), root, "postings", 0)
    (tmp_path / "postings/_manifest/000000000002.json").write_text('[{"na')  # a writer that died while it wrote
    (tmp_path / "postings/segment=dead").mkdir()
    assert G.live(spark, root, "postings")[0] == 1
    G.append(rows.where("chunk_id % 2 = 1"), root, "postings", 1)
    assert G.live(spark, root, "postings")[0] == 3
    assert G.read(spark, root, "postings").count() == rows.count()
    seen = []

    def change(now):
        if not seen:  # another writer commits between this one's reading and writing
            seen.append(len(now))
            G.commit(spark, root, "postings", lambda live: [*live, {"name": live[0]["name"], "level": 9, "batches": [77]}])
        return [*now, {"name": now[0]["name"], "level": 8, "batches": [88]}]

    assert G.commit(spark, root, "postings", change)
    assert sorted(b for s in G.live(spark, root, "postings")[1] for b in s["batches"]) == [0, 1, 77, 88]


@pytest.mark.parametrize(("bits", "factor", "group"), [(16, 64, 256), (3, 2, 2), (4, 1, 3)])
def test_scans_equal_sequential_ones(spark, monkeypatch, bits, factor, group):
    """Objects of one line to many blocks, lines longer than blocks, and a null object, against plain loops."""
    from logspark.operators import scans

    monkeypatch.setattr(scans, "BLOCK_BITS", bits)
    monkeypatch.setattr(scans, "FACTOR", factor)
    monkeypatch.setattr(scans, "GROUP", group)
    r = random.Random(bits)
    rows, want, size = [], {}, 100
    for name, n in (("a", 700), ("b", 1), (None, 90), ("c", 300), ("d", 40)):
        at = chunk = held = 0
        last = None
        for i in range(n):
            length = r.choice([0, 3, 20, 99, 100, 101]) if name != "d" else r.choice([0, 5000, 12])
            value = r.choice([None, None, i])
            last = value if value is not None else last
            want[name, i] = (at, last, chunk)
            rows.append((name, i, "x" * length, value))
            at += length + 1
            held += length + 1
            if held > size:
                chunk, held = chunk + 1, 0
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "object_id string, seq long, text string, v long").repartition(3)
    lines = I.line_offsets(df, "object_id", ["seq"], "text")
    got = I.fill_forward(I.assign_chunks(lines, size, greedy=True), "v", ["object_id"], ["seq"], "filled").collect()
    assert {(x.object_id, x.seq): (x.line_start, x.filled, x.chunk_id) for x in got} == want
    assert len(got) == len(rows)
    assert I.assign_chunks(lines.limit(0), size, greedy=True).count() == 0
    with pytest.raises(ValueError):
        I.assign_chunks(lines, 0)


def test_minterms():
    from logspark.operators.many import minterms_of

    each = lambda t: [sorted(m) for m in minterms_of(t)]
    assert each('a == "1"') == [[0]]
    assert each('a == "1" && (b == "2" || includes(c, "3")) || d == "4"') == [[0, 1], [0, 2], [3]]
    assert each('(a == "1" || b == "2") && (a == "1" || c == "3")') == [[0, 2], [0, 3], [1, 2], [1, 3]]  # by number: equal clauses are not merged
    assert each('a == "1" || a == "1" && b == "2"') == [[0], [1, 2]]
    with pytest.raises(ValueError):
        minterms_of(" && ".join(f'(a{i} == "1" || b{i} == "2")' for i in range(20)))


def test_many_searches_equal_single_ones(spark):
    from logspark.operators import many as N

    e = indexed_events(spark, SF).cache()
    postings = I.distinct_tokens(e).cache()
    texts = [
        'event_type == "error"', 'k == "7" || event_type == "view" && user_id == "3"', 'includes(this, "1") && k == "5"', 'includes(text, "click") || user_id == "9"', 'k == "absent"',
        'event_type == "absent" && k == "1"', '(event_type == "view" || event_type == "click") && (k == "1" || k == "2" || includes(user_id, "14"))', 'user_id == "5" && user_id == "6"', 'nothing == "x" || k == "3"',
    ]
    names = {"user_id": "enrichment['user_id']", "nothing": "enrichment['nothing']", **Q.EVENT_FIELDS}
    for some in (texts, [t for t in texts if "includes" not in t]):
        want = sorted((i, r.seq) for i, t in enumerate(some) for r in e.where(X.search_expr(t, names)).select("seq").collect())
        for side in (None, postings):
            assert sorted(map(tuple, N.search_many(e, dict(enumerate(some)), ["seq"], side).select("query", "seq").collect())) == want
    terms = N.minterms(spark, {0: 'user_id == "17"', 1: 'k == "absent"'})
    chunks = N.prune_many(postings, terms)
    assert 0 < chunks.count() < e.select("object_id", "chunk_id").distinct().count()
    assert N.prune_many(postings, N.minterms(spark, {0: 'user_id == "17"', 1: 'includes(this, "x")'})) is None


def test_pages_open_few_files(spark):
    from logspark.plans import queries as Z

    root = Z.stored_index(spark, SF)
    want = [tuple(r) for r in I.read_index(spark, root, "postings").select(*files.KEY).distinct().orderBy(*files.KEY).collect()]
    total = len(I.read_index(spark, root, "postings").inputFiles())
    got, after, opened = [], None, []
    for _ in range(4):  # a caller that comes back with the key
        page, after, n = next(files.key_pages(spark, root, "events", 7, after))
        got += page
        opened.append(n)
    assert got == want[:28]
    assert max(opened) < total / 5
    late = next(files.key_pages(spark, root, "events", 50, want[-3]))
    assert late[0] == want[-2:] and late[1] is None
    assert next(files.key_pages(spark, root, "events", 50, want[-1])) == ([], None, late[2])


def test_early_stop_reads_no_day_after_the_limit(spark):
    e = indexed_events(spark, SF).select("object_id", "seq", "n_bytes").cache()
    days = sorted(r.object_id for r in e.select("object_id").distinct().collect())
    asked = []

    def of(day):
        asked.append(day)
        return e.where(F.col("object_id") == day)

    want = sorted(r.seq for r in Q.limit_bytes(e, ["object_id", "seq"], 1500, "n_bytes", "object_id").collect())
    rows, read = Q.limit_bytes_early(of, days, ["seq"], 1500, "n_bytes")
    assert sorted(r.seq for r in rows.collect()) == want
    assert read == asked == days[: len(asked)] and len(asked) < len(days) / 2
    assert Q.limit_bytes_early(of, days, ["seq"], 0, "n_bytes") == (None, [])


def test_series_return_within_and_after_their_time(spark, tmp_path):
    hour = 3_600_000
    batches = [[("a", 0), ("b", 0), ("a", 5 * hour)], [("a", 10 * hour), ("b", 7 * hour)], [("c", 30 * hour)], [("a", 31 * hour), ("c", 33 * hour), ("b", 32 * hour)], [("c", 39 * hour), ("c", 46 * hour)]]
    batches = [[(x, t + 1000 * hour) for x, t in rows] for rows in batches]
    for i, rows in enumerate(batches):
        spark.createDataFrame([("m", x, t) for x, t in rows], "name string, labels string, ts long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = streams.first_seen_ttl(files.stream_objects(spark, f"{tmp_path}/in", "name string, labels string, ts long"), 6 * hour, watermark="0 seconds").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        q.awaitTermination()
        held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
        if i == 2:
            assert held[-1] == 1  # a and b have been idle for longer and have left
    got = sorted((r.labels, r.ts // hour - 1000) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", 0), ("a", 31), ("b", 0), ("b", 7), ("b", 32), ("c", 30), ("c", 46)]
    twin = streams.first_seen_ttl_batch(spark.createDataFrame([("m", x, t) for rows in batches for x, t in rows], "name string, labels string, ts long"), 6 * hour)
    assert sorted((r.labels, r.ts // hour - 1000) for r in twin.collect()) == got


def test_late_rows_cost_each_batch_the_same(spark, tmp_path):
    """A batch reads one row of those before it, however many there were; it may be run again."""
    for i, times in enumerate([[1000, 5000], [9000, 2000], [100, 8000], [20_000, 8999]]):
        spark.createDataFrame([(t,) for t in times], "ts_ms long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        streams.start_buckets(files.stream_objects(spark, f"{tmp_path}/in", "ts_ms long"), 1000, 4000, str(tmp_path), f"{tmp_path}/check").awaitTermination()
        assert streams._newest(spark, str(tmp_path), i + 1) == max(5000, 9000 * (i > 0), 20_000 * (i > 2))
    got = {r.bucket: (r.n, r.n_late) for r in streams.read_buckets(spark, str(tmp_path)).collect()}
    assert got == {0: (1, 1), 1000: (1, 0), 2000: (1, 0), 5000: (1, 0), 8000: (2, 0), 9000: (1, 0), 20_000: (1, 0)}


def test_digest_tree_finds_and_mends_a_change(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), f"line {r.randrange(150)}") for _ in range(400)]
    df = spark.createDataFrame(rows, "grp string, line string")
    nodes = lambda t: {(x.grp, x.level, x.prefix): x.digest for x in t.collect()}
    old = nodes(I.digest_tree(df, ["grp"], "line", 2))
    assert nodes(I.digest_tree(spark.createDataFrame(r.sample(rows, len(rows)), df.schema).repartition(5), ["grp"], "line", 2)) == old
    assert {k[0] for k in old if k[1] == 0} == {"a", "b", None}
    changed = [*rows[1:], ("c", "a group of its own"), ("a", rows[0][1] + " changed")]
    new_df = spark.createDataFrame(changed, df.schema)
    new = nodes(I.digest_tree(new_df, ["grp"], "line", 2))
    trees = [I.digest_tree(x, ["grp"], "line", 2) for x in (df, new_df)]
    found = I.changed_prefixes(*trees, ["grp"])
    want = {(g, p) for g, level, p in {**old, **new} if level == 2 and old.get((g, level, p)) != new.get((g, level, p))}
    assert {(x.grp, x.prefix) for x in found.collect()} == want and 2 <= len(want) <= 3
    assert nodes(I.update_tree(trees[0], new_df, ["grp"], "line", found, 2)) == new
    assert I.changed_prefixes(trees[0], trees[0], ["grp"]).count() == 0
    assert I.digest_tree(df.limit(0), ["grp"], "line").count() == 0
    with pytest.raises(ValueError):
        I.digest_tree(df, ["grp"], "line", 0)


def test_bucketed_tables_are_joined_as_they_lie(spark):
    from logspark.plans import queries as Z

    QUERIES["chunk_lookup_bucketed"](spark, SF)
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("chunks_")).removeprefix("chunks_")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = Z.bucketed_lookup(spark, name, ["error", "17"])
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows and "SortMergeJoin" in plan and "Exchange" not in plan


def test_source_counters_tell_their_deltas(spark, tmp_path):
    told = []
    counters = streams.StreamCounters(told.append, every=0.0)
    spark.streams.addListener(counters)
    try:
        for i in range(2):
            spark.createDataFrame([("é" * 10,), ("abc",), (None,)], "text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            streams.observe_source(files.stream_objects(spark, f"{tmp_path}/in", "text string"), "text").writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
            for _ in range(100):
                if counters.rows >= 3 * (i + 1):
                    break
                time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    assert (counters.rows, counters.bytes) == (6, 46)
    assert sum(d["bytes"] for d in told) == 46 and len([d for d in told if d["rows"]]) == 2
