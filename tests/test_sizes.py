"""Queries on small tables that have what larger ones bring: sparse chunks, many series, many keys."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logspark.operators import index as I
from logspark.operators import prune as P
from logspark.plans.queries import ORACLE, QUERIES

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
#: Chunks of one event each: a token in another field, a user whose id is large, and neither.
SPARSE = [(0, 6, 5, "click", 17), (100, 7, 1213, "error", 4), (200, 8, 17, "view", 1), (300, 9, 8, "error", 2), (400, 10, 6, "view", 3)]


def events_in(spark, folder, rows) -> str:
    """A folder with events of (event_id, day or hours, user_id, event_type, k)."""
    made = [(i, datetime(2024, 1, 1) + timedelta(days=d - 1, seconds=i % 86_400), u, t, 1.0, f'{{"k": {k}}}') for i, d, u, t, k in rows]
    spark.createDataFrame(made, EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def differences(spark, folder, name) -> tuple[int, list, list]:
    """Number of a query's rows, and what it and its SQL have beyond one another."""
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    db.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    db.execute(f"CREATE TABLE want AS {ORACLE[name]}")
    columns = [r[0] for r in db.execute("DESCRIBE want").fetchall()]
    want = sorted(db.execute("FROM want").fetchall(), key=repr)
    got = sorted(map(tuple, QUERIES[name](spark, folder).select(*columns).collect()), key=repr)
    return len(got), [r for r in got if r not in want], [r for r in want if r not in got] if len(got) == len(want) else want


def test_bucketed_hits_of_any_field_equal_sql(spark, tmp_path):
    folder = events_in(spark, tmp_path, SPARSE)
    assert differences(spark, folder, "chunk_lookup_bucketed") == (4, [], [])


def test_gates_take_all_users_of_larger_tables(spark, tmp_path):
    folder = events_in(spark, tmp_path, SPARSE)
    assert differences(spark, folder, "search_gated_bitmap") == (1, [], [])


@pytest.mark.parametrize("listed", [3, 100_000])
def test_gates_of_many_hashes_equal_those_of_lists(spark, monkeypatch, listed):
    monkeypatch.setattr(P, "LISTED", listed)
    key = [F.lit("t").alias("target"), F.lit(0).cast("long").alias("bucket"), F.lit("o").alias("object_id"), (F.col("id") / 20).cast("long").alias("chunk_id")]
    postings = spark.range(400).select(*key, F.concat(F.lit("tok"), "id").alias("token"))
    asked = [f"tok{i}" for i in range(0, 200, 20)] + ["absent"]
    hashes = spark.createDataFrame([(t,) for t in asked], "h string")
    for rows, prune in ((postings, P.prune_by_postings), (I.build_bloom(postings), P.prune_by_bitmap)):
        many, few = (sorted(map(tuple, prune(rows, 'a == "x"', [[]], h).collect())) for h in (hashes, asked))
        assert many == few and set(many) >= {("o", i) for i in range(10)} and len(many) < 20


def test_a_token_meets_one_part_of_its_filter(spark):
    tokens = spark.range(3000).select(F.lit("t").alias("target"), F.lit(0).cast("long").alias("bucket"), F.col("id") % 2, F.concat(F.lit("tok"), "id").alias("token"))
    tokens = tokens.select("target", "bucket", F.col("(id % 2)").cast("string").alias("object_id"), F.lit(0).cast("long").alias("chunk_id"), "token").union(tokens.limit(1).selectExpr("target", "bucket", "'one'", "0L", "token"))
    made = I.build_bloom(tokens, limit=64, accuracy=95).cache()
    met = P.filters_of(tokens.select("object_id", "token"), made, ["object_id"])
    assert made.count() > 50 and met.count() == 3001  # a join by object alone has a row for each token and part
    assert met.where(P.bloom_might_contain(F.col("token"))).count() == 3001


def test_all_pages_are_those_of_continuation_keys(spark):
    from logspark.plans import queries as Z
    from logspark.sources import files

    root = Z.stored_index(spark, "/root/testdata/sf0.001", "postings")
    want = [(*k, i) for i, (page, _, _) in enumerate(files.key_pages(spark, root, "events", 7)) for k in page]
    jobs = "pages"
    spark.sparkContext.setJobGroup(jobs, jobs)
    try:
        got = sorted(map(tuple, files.all_key_pages(spark, root, "events", 7).collect()))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == want and len(spark.sparkContext.statusTracker().getJobIdsForGroup(jobs)) < want[-1][-1]


def test_a_query_makes_the_parts_of_the_index_that_it_reads(spark, tmp_path):
    import os

    from logspark.plans import queries as Z

    folder = events_in(spark, tmp_path, SPARSE)
    held = lambda: sorted(p for p in os.listdir(root) if not p.startswith("."))
    for name, parts in (("stream_first_seen", ["events"]), ("search_stored_postings", ["events", "postings"]), ("search_stored_bitmap", ["events", "filters", "postings"])):
        assert differences(spark, folder, name)[1:] == ([], [])
        root = Z.stored_index(spark, folder, "events")
        assert held() == parts
    assert Z.stored_index(spark, folder) == root and held() == ["chunks", "events", "filters", "postings", "reverse"]
    assert not [p for p in os.listdir(os.path.dirname(root)) if p.startswith(f"{os.path.basename(root)}-")]


def test_many_searches_shuffle_no_row_for_a_minterm(spark):
    from logspark.operators import many as N
    from logspark.plans.queries import indexed_events

    e = indexed_events(spark, "/root/testdata/sf0.001").cache()
    searches = {i: f'user_id == "{i % 9}" && event_type == "view"' for i in range(200)}
    terms = N.minterms(spark, searches)
    chunks = N.prune_many(I.distinct_tokens(e), terms)
    assert "minterm" not in chunks._jdf.queryExecution().optimizedPlan().toString()  # 200 minterms have 9 sets of tokens
    want = sorted((q, r.seq) for r in e.where("enrichment['event_type'] = 'view'").select("seq", F.col("enrichment")["user_id"].cast("int").alias("u")).collect() for q in searches if q % 9 == r.u)
    twice = e.select(*e.columns).union(e.withColumn("enrichment", F.create_map(F.lit("event_type"), F.lit("view"))))  # other events of the same keys
    assert sorted(map(tuple, N.search_many(twice, searches, ["seq"], I.distinct_tokens(e)).collect())) == want
