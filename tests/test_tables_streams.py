"""Merges, versions, backfill, retention, streaming equality."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from upswell.operators import tables as B
from upswell.operators.pages import candidate_links_v1
from upswell.plans.news import run_news_refresh
from upswell.sources import feeds as S
from upswell.sources import stored
from upswell.operators.merge import merge_into, read_merged
from upswell.streaming import stream_event_upserts, stream_news, upsert_batch

EVENTS = "company_id string, source_url string, event_type string, ingest_ord long, note string"


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "keep"), ("b", 2, "keep")], "k string, v int, other string")
    batch = spark.createDataFrame([("b", 20, 1), ("b", 21, 2), ("c", 30, 1)], "k string, v int, seq int")
    out = B.upsert_by_key(target, batch, ["k"], [F.col("seq").desc()]).select("k", "v", "other")
    assert {tuple(r) for r in out.collect()} == {("a", 1, "keep"), ("b", 21, "keep"), ("c", 30, None)}
    again = B.upsert_by_key(out, batch, ["k"], [F.col("seq").desc()]).select("k", "v", "other")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in out.collect()}


def test_versions_and_pointer(spark, tmp_path):
    root = str(tmp_path / "t")
    assert B.read_current(spark, root) is None
    B.write_version(spark.range(1), root, 0)
    B.write_version(spark.range(2), root, 1)
    B.write_version(spark.range(3), root, 2, current=False)
    assert B.current_version(spark, root) == 1 and B.read_current(spark, root).count() == 2
    merge = upsert_batch(root)
    merge(spark.range(9), 1)
    assert B.read_current(spark, root).count() == 2


def test_backfill_skips_on_either_key(spark):
    rows = [
        ("Acme, Inc.", "https://www.acme.com/x", "India", 1), ("Acme Two", "http://acme.com", "USA", 2), ("No Site", None, "Unknown", 3),
        ("no site", "acme", "Rest of World", 4), ("Known", "https://known.io", "USA", 5), ("Fresh", None, None, 6), (None, "https://z.com", "USA", 7),
    ]
    startups = spark.createDataFrame(rows, "company_name string, homepage string, region string, ord long")
    for c in ("business_idea", "industry", "year_founded", "founder_name"):
        startups = startups.withColumn(c, F.lit("x"))
    startups = startups.withColumn("momentum_score", F.lit(1))
    companies = spark.createDataFrame([("other", "known.io"), ("fresh", None)], "normalized_name string, primary_domain string")
    got = {(r.normalized_name, r.primary_domain, r.region_bucket) for r in B.backfill_companies(startups, companies).collect()}
    assert got == {("acme inc ", "acme.com", "INDIA"), ("no site", None, None)}


def test_timestamps_and_retention(spark):
    df = spark.createDataFrame([("a", True, False), ("b", False, True), ("c", False, False)], "id string, rediscovered boolean, fact_verified boolean")
    df = df.withColumns({"last_seen": F.to_date(F.lit("2026-01-01")), "last_verified": F.when(F.col("id") != "c", F.to_date(F.lit("2026-01-02")))})
    now = F.to_date(F.lit("2026-02-01"))
    got = {r.id: (str(r.last_seen), str(r.last_verified)) for r in B.apply_timestamps(df, now).collect()}
    assert got == {"a": ("2026-02-01", "2026-01-02"), "b": ("2026-01-01", "2026-02-01"), "c": ("2026-01-01", "2026-02-01")}
    ts = spark.createDataFrame([("2026-01-18",), ("2026-01-17",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert B.prune_older_than(ts, "t", F.lit("2026-02-01").cast("timestamp")).count() == 1


def test_publish_replaces_the_whole_ranking(spark):
    companies = spark.createDataFrame([("a", 5, 1), ("b", 4, 2)], "company_id string, momentum_score int, regional_rank int")
    ranked = spark.createDataFrame([("b", 9, 1)], "company_id string, momentum_score int, regional_rank int")
    got = {tuple(r) for r in B.publish_ranking(companies, ranked, True).select("company_id", "momentum_score", "regional_rank").collect()}
    assert got == {("a", None, None), ("b", 9, 1)}
    assert B.publish_ranking(companies, ranked, False) is companies


def test_constraints(spark):
    df = spark.createDataFrame(
        [("a", "u", "acquisition", "completed", "t"), ("a", "u", "acquisition", "completed", "t"), (None, None, "ipo", "maybe", None)],
        "company_id string, source_url string, event_type string, verification_status string, evidence_text string",
    )
    got = {r.rule: r.violations for r in B.check_constraints(df).collect()}
    assert got == {
        "event_type not allowed": 1, "status not allowed": 1, "company_id missing": 1, "source_url missing": 1, "evidence_text missing": 1, "key not unique": 1,
    }


def test_weights_fall_back(spark):
    defaults = spark.createDataFrame([("x", 0.4), ("y", 0.6)], "component string, weight double")
    mine = spark.createDataFrame([("x", 1.0)], "component string, weight double")
    assert {tuple(r) for r in stored.load_weights(mine, defaults).collect()} == {("x", 1.0)}
    assert stored.load_weights(mine.filter("false"), defaults).count() == 2
    assert stored.load_weights(None, defaults) is defaults


def test_feeds_first_wins(spark):
    def source(rows, order):
        df = spark.createDataFrame(rows, "title string, link string, item_ord int").withColumn("source_ord", F.lit(order))
        return lambda _: df

    one = source([("first", "u1", 0), ("none", "", 1), ("null", None, 2)], 0)
    two = source([("second", "u1", 0), ("other", "u2", 1)], 1)
    got = {(r.title, r.link) for r in S.load_articles(spark, [two, one]).collect()}
    assert got == {("first", "u1"), ("other", "u2")}


def test_feed_files(spark, tmp_path):
    (tmp_path / "f.json").write_text(
        "\n".join('{"source_name":"A","source_ord":0,"item_ord":%d,"title":"t%d","description":"d","link":"u%d","published":"Wed, 02 Oct 2002 13:00:00 GMT"}' % (i, i, i) for i in range(30))
    )
    (tmp_path / "h.json").write_text('{"query":"q","query_ord":0,"hits":[{"title":"T","url":null,"objectID":"7","created_at":"2024-01-01T00:00:00Z"},{"title":"","url":"x"}]}')
    assert S.scan_feed_items(spark, str(tmp_path / "f.json")).count() == 30
    items = S.scan_feed_items(spark, str(tmp_path / "f.json"), 25)
    assert items.count() == 25 and items.filter("summary = 'd' and published_ts is not null").count() == 25
    hits = S.scan_search_hits(spark, str(tmp_path / "h.json")).collect()
    assert [(h.link, h.summary) for h in hits] == [("https://news.ycombinator.com/item?id=7", "T")]


def test_older_link_rule(spark):
    html = '<a href="https://www.twitter.com/a">t</a><a href="https://acme.com/p?x=1">a</a><a href="https://sub.medium.com/x">m</a>'
    got = candidate_links_v1(spark.createDataFrame([(1, html)], "id int, html string")).collect()
    assert [r.link for r in got] == ["https://acme.com/p"]


def _event_rows():
    return [(f"c{i % 7}", f"u{i % 5}", "acquisition", i, f"n{i}") for i in range(60)]


@pytest.mark.parametrize("files", [1, 3])
def test_event_stream_is_the_same_for_any_batching(spark, tmp_path, files):
    src, root = str(tmp_path / "src"), str(tmp_path / "out")
    rows = _event_rows()
    for i in range(files):
        part = rows[i * len(rows) // files : (i + 1) * len(rows) // files]
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(src)
    stream_event_upserts(stream, root, str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.company_id, r.source_url): r.ingest_ord for r in read_merged(spark, root).collect()}
    want: dict = {}
    for c, u, _, o, _ in rows:
        want[c, u] = max(o, want.get((c, u), -1))
    assert got == want


def _stream(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_event_stream_in_a_bad_order_and_with_a_new_checkpoint(spark, tmp_path):
    src, root, rows = str(tmp_path / "src"), str(tmp_path / "out"), _event_rows()
    for part in (rows[40:], rows[:20], rows[20:40]):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(src)
    run = lambda state: stream_event_upserts(_stream(spark, src, EVENTS), root, str(tmp_path / state)).trigger(availableNow=True).start().awaitTermination()
    got = lambda: {(r.company_id, r.source_url): r.ingest_ord for r in read_merged(spark, root).collect()}
    want = {}
    for c, u, _, o, _ in rows:
        want[c, u] = max(o, want.get((c, u), -1))
    run("state")
    assert got() == want
    spark.createDataFrame([("new", "u", "acquisition", 100, "n")], EVENTS).write.mode("append").parquet(src)
    run("another state")
    assert got() == want | {("new", "u"): 100}


def test_a_batch_that_is_sent_again_changes_nothing(spark, tmp_path):
    root, merge = str(tmp_path / "t"), upsert_batch(str(tmp_path / "t"))
    batch = spark.createDataFrame(_event_rows(), EVENTS)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "one")
    try:
        merge(batch, 0)
        merge(batch, 0)
        assert B.current_version(spark, root) == 0
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", "two")
        merge(batch, 0)
        assert B.current_version(spark, root) == 1
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_news_stream_in_a_bad_order(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "rows")
    for day in (0, 40, 80, 5):
        df = spark.createDataFrame([("Title", "text", f"u{day}"), ("Title", "text", "again")], "title string, summary string, link string")
        df = df.withColumn("fetched_at", F.timestamp_seconds(F.lit(1767225600 + day * 86400)))
        df.coalesce(1).write.mode("append").parquet(src)
    stream_news(_stream(spark, src, df.schema)).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.link for r in spark.read.parquet(out).collect()) == ["again", "u0", "u40", "u5", "u80"]


def test_news_stream_and_refresh(spark, tmp_path):
    rows = [(f"Title {i}", "text", f"u{i % 4}", f"2026-01-0{1 + i % 3}") for i in range(12)] + [("Webinar", "x", "u9", "2026-01-01")]
    df = spark.createDataFrame(rows, "title string, summary string, link string, t string").withColumn("fetched_at", F.col("t").cast("timestamp"))
    src = str(tmp_path / "src")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "rows")
    stream_news(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.link for r in spark.read.parquet(out).collect()) == ["u0", "u1", "u2", "u3"]

    articles = df.withColumnRenamed("fetched_at", "published_ts").withColumns({"source_name": F.lit("s"), "source_ord": F.lit(0), "item_ord": F.lit(1)})
    news = spark.createDataFrame([("u0", "old", "s"), ("gone", "old", "s"), ("stay", "old", "s")], "link string, title string, source_name string").withColumns(
        {"published_ts": F.lit(None).cast("timestamp"), "fetched_at": F.when(F.col("link") == "gone", F.lit("2025-12-01")).otherwise(F.lit("2026-01-02")).cast("timestamp")}
    )
    got = {r.link for r in run_news_refresh(articles, news, F.lit("2026-01-04").cast("timestamp")).collect()}
    assert got == {"u0", "u1", "u2", "u3", "stay"}


def _files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [(f"c{i}", i, "old") for i in range(200)]
    merge_into(spark.createDataFrame(rows, "k string, v long, w string"), root, ["k"], buckets=16)
    before = _files(f"{root}/table")
    merge_into(spark.createDataFrame([("c7", 1000), ("fresh", 1)], "k string, v long"), root, ["k"])
    after = _files(f"{root}/table")
    assert 16 - 2 <= len(set(before) & set(after)) and all(before[f] == after[f] for f in set(before) & set(after))
    want = {k: (v, w) for k, v, w in rows} | {"c7": (1000, "old"), "fresh": (1, None)}
    assert {r.k: (r.v, r.w) for r in read_merged(spark, root).collect()} == want
    some = spark.createDataFrame([("c7",)], "k string")
    few = read_merged(spark, root, some, ["k"])
    assert few.count() < 60 and few.filter("k = 'c7'").count() == 1
    merge_into(spark.createDataFrame([], "k string, v long"), root, ["k"])
    assert read_merged(spark, root).count() == 201 and read_merged(spark, str(tmp_path / "none")) is None


def test_a_merge_lost_half_way_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    from upswell.operators import merge as M

    root = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    merge_into(frame([(f"c{i}", i) for i in range(50)]), root, ["k"], buckets=4)

    def lost(rows, path):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(M, "_overwrite", lost)
        with pytest.raises(OSError):
            merge_into(frame([("c1", 111), ("x", 1)]), root, ["k"])
    merge_into(frame([("c2", 222)]), root, ["k"])
    got = {r.k: r.v for r in read_merged(spark, root).collect()}
    assert got == {f"c{i}": i for i in range(50)} | {"c1": 111, "x": 1, "c2": 222}


def test_columns_set_on_insert_and_newer_stored_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k string, seen int, v string, o int")
    for batch in ([("a", 1, "x", 5), ("b", 1, "x", 5)], [("a", 2, "y", 6), ("b", 2, "y", 4), ("c", 2, "y", 1)]):
        merge_into(frame(batch), root, ["k"], keep=["seen"], newest="o", buckets=2)
    assert {tuple(r) for r in read_merged(spark, root).collect()} == {("a", 1, "y", 6), ("b", 1, "x", 5), ("c", 2, "y", 1)}


def test_a_headline_keeps_the_clock_of_its_first_sighting(spark):
    news = spark.createDataFrame([("l", "t", "s", "2026-01-01", "2026-01-01")], "link string, title string, source_name string, p string, f string")
    news = news.select("link", "title", "source_name", F.col("p").cast("timestamp").alias("published_ts"), F.col("f").cast("timestamp").alias("fetched_at"))
    feed = spark.createDataFrame([("raises $8M in funding", "startup raises", "l", "S", 0, 0), ("raises $9M in funding", "startup raises", "m", "S", 0, 1)], "title string, summary string, link string, source_name string, source_ord int, item_ord int")
    feed = feed.withColumn("published_ts", F.lit("2026-01-09").cast("timestamp"))
    at = lambda d: {r.link: str(r.fetched_at)[:10] for r in run_news_refresh(feed, news, F.lit(d).cast("timestamp")).collect()}
    assert at("2026-01-10") == {"l": "2026-01-01", "m": "2026-01-10"}
    assert at("2026-01-16") == {"m": "2026-01-16"}
