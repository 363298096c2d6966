"""What one job keeps for the next: conversions by content, responses by URL and time."""

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from webkb.conf import CACHE_IGNORE_HTTP_CODES
from webkb.operators import cache as CA
from webkb.operators.store import PUSHED_KEYS
from webkb.session import scratch_path
from webkb.sources import tables as TB

ITEM = "id string, key string, text string"


def _convert(seen):
    def convert(df):
        seen.append(sorted(r.key for r in df.collect()))
        return df.select("key", F.upper("text").alias("markdown"),
                         F.when(F.col("text").startswith("bad"), F.lit("refused")).alias("error"))
    return convert


def _items(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in texts], "id string, text string")
    return rows.select("id", CA.content_key("text").alias("key"), "text")


def test_equal_contents_are_converted_once(spark):
    root, seen = scratch_path(spark, "t-conv"), []
    first = _items(spark, [("a", "x"), ("b", "x"), ("b", "x"), ("c", "y"), ("d", None), ("e", ""), ("f", "bad")])
    got = {(r.id, r.markdown, r.error, r.made) for r in CA.convert_once(first, _convert(seen), "o", root)[1].collect()}
    assert got == {("a", "X", None, True), ("b", "X", None, True), ("c", "Y", None, True), ("d", None, None, True),
                   ("e", "", None, True), ("f", None, "refused", True)}
    assert len(seen[0]) == len(set(seen[0])) == 5  # x, y, NULL, '', bad
    # the next job: other ids, one new content; what failed is tried again
    second = _items(spark, [("g", "x"), ("h", "z"), ("f", "bad"), ("e", "")])
    again = {r.id: (r.markdown, r.made) for r in CA.convert_once(second, _convert(seen), "o", root)[1].collect()}
    assert again["g"] == ("X", False) and again["h"] == ("Z", True) and again["e"] == ("", False)
    assert again["f"][1] and len(seen[1]) == 2
    # other options are other conversions, an empty table is none
    CA.convert_once(second.filter("id = 'g'"), _convert(seen), "p", root)[0].collect()
    assert len(seen[2]) == 1
    assert CA.convert_once(second.limit(0), _convert(seen), "o", root)[1].count() == 0


def test_many_contents_by_join(spark):
    """More keys than are sent to the reader one by one, with a third of all items of one content."""
    root, seen, n = scratch_path(spark, "t-conv"), [], PUSHED_KEYS * 3
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"),
                                F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
                                    F.concat(F.lit("t"), F.col("id"))).alias("text"))
    items = ids.select("id", CA.content_key("text").alias("key"), "text")
    out = CA.convert_once(items, _convert(seen), "o", root)[1]
    assert out.count() == n and out.filter("made").count() == n and len(seen[0]) == n - n // 3 + 1
    out = CA.convert_once(items, _convert(seen), "o", root)[1]
    assert out.filter("made").count() == 0 and seen[1] == []
    assert out.join(items.select("id", "text"), "id").filter(F.col("markdown") != F.upper("text")).count() == 0


def test_fresh_responses_brute_force(spark):
    root, rng, start, ttl = scratch_path(spark, "t-resp"), random.Random(5), datetime(2024, 1, 1, 22), 7200
    kept = []
    for step in range(8):
        at = start + timedelta(minutes=45 * step)
        rows = [(f"u{u}", rng.choice([200, 200, 404, 429, 503])) for u in range(12) if rng.random() < 0.5]
        df = spark.createDataFrame([(u, u, s, None, f"{u} at {at}".encode()) for u, s in rows],
                                   "key string, url string, status int, content_type string, content binary")
        CA.store_responses(df, root, "asset", str(at))
        kept += [(u, at, f"{u} at {at}") for u, s in rows if s not in CACHE_IGNORE_HTTP_CODES]
    for minutes in (0, 44, 45, 120, 165, 400, 600):
        at = start + timedelta(minutes=minutes)
        want = {}
        for u, ts, text in kept:
            if timedelta(0) <= at - ts <= timedelta(seconds=ttl):
                want[u] = max(want.get(u, (ts, text)), (ts, text))
        fresh = CA.fresh_responses(spark, root, "asset", str(at), ttl)
        assert {r.key: bytes(r.content).decode() for r in fresh.collect()} == {u: t for u, (_, t) in want.items()}
    assert CA.fresh_responses(spark, root, "page", str(start), ttl).count() == 0
    assert CA.fresh_responses(spark, scratch_path(spark, "none"), "page", str(start), ttl).count() == 0


def test_cached_page_stands_for_the_live_one(spark):
    root, ts = scratch_path(spark, "t-resp"), "2024-01-02 00:30:00"
    old = spark.createDataFrame([("http://a.example/x", 1, "http://a.example/x#top", 200, "text/html", b"old"),
                                 ("http://a.example/gone", 2, "http://a.example/gone", 200, "text/html", b"gone")],
                                "key string, page_id long, url string, status int, content_type string, content binary")
    CA.store_responses(old, root, "page", "2024-01-01 23:30:00")
    live = spark.createDataFrame([(1, "http://a.example/x", "new"), (3, "http://a.example/y", "y"), (4, None, "n")],
                                 "page_id long, url string, html string")
    seen = CA.served_pages(TB.page_store(live), CA.fresh_responses(spark, root, "page", ts, 3600))
    assert {(r.page_id, r.html, r.served) for r in seen.collect()} == {
        (1, "old", True), (2, "gone", True), (3, "y", False), (4, "n", False)}
    late = CA.served_pages(TB.page_store(live), CA.fresh_responses(spark, root, "page", ts, 3599))
    assert {(r.page_id, r.html) for r in late.collect()} == {(1, "new"), (3, "y"), (4, "n")}


def test_lookup_reads_the_days_that_can_hold_it(spark):
    root = scratch_path(spark, "t-resp")
    df = spark.createDataFrame([("u", "u", 200, None, b"x")],
                               "key string, url string, status int, content_type string, content binary")
    for day in range(1, 6):
        CA.store_responses(df, root, "asset", f"2024-01-0{day} 12:00:00")
    fresh = CA.fresh_responses(spark, root, "asset", "2024-01-05 13:00:00")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-04" in plan
    noon = datetime(2024, 1, 5, 12, tzinfo=UTC)
    assert [r.ts_us for r in fresh.collect()] == [int(noon.timestamp()) * 1_000_000]


def test_a_job_takes_its_pages_from_the_store_once(spark, tmp_path):
    """The HTML of the page table is read to parse it, and to set the reached pages aside; what converts,
    stores and caches them does not read it again. Duplicate, cached and NULL pages come out as before."""
    from webkb.conf import JobConf
    from webkb.functions.urls import canonical_url
    from webkb.operators import links as LK
    from webkb.plans.pipeline import build_kb

    rows = [(i, f"http://h.example.org/{i}", f"<p>t{i}</p><a href='/{i + 1}'>x</a><a href='/{i + 1}'>y</a>") for i in range(8)]
    rows += [(20, "http://H.example.org/3#a", "<p>again</p>"), (21, "http://h.example.org/8", None), (22, None, "<p>n</p>")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    pages = made.mapInArrow(counted, made.schema)
    assets = spark.createDataFrame([], "url string, status int, content_type string, content binary")
    conf = JobConf(job_ts="2024-01-02 03:04:05", max_depth=20, seeds=["http://h.example.org/0"])
    out = build_kb(spark, pages, assets, conf, str(tmp_path / "kb"), cache=str(tmp_path / "cache"))
    assert sorted(r.page_id for r in out["crawled"].collect()) == [*range(8), 21]
    got = {r.URL: r.raw_content_path != "" for r in out["metadata"].collect()}
    assert sorted(got) == [f"http://h.example.org/{i}" for i in range(8)]
    assert sum(r.stage == "raw" for r in out["objects"].collect()) == 8
    # keys of the store, the parse, the seeds' level, the edges' targets and the pages set aside
    assert read.value <= 16 * len(rows), read.value / len(rows)
    parsed = LK.parse_pages(made.withColumn("url_key", canonical_url("url")), ("url_key",))
    plain = LK.link_edges(parsed.drop("url_key")).collect()
    assert sorted(LK.link_edges(parsed).collect()) == sorted(plain) and len(plain) == 8
