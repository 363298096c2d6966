"""Keyed sinks: lookups read what they need, versions form one series, the
state store keeps first writers."""

import hashlib

import pytest
from pyspark.sql import functions as F

from webkb.functions import paths as PA
from webkb.operators import export as EX
from webkb.operators import store as ST
from webkb.session import delete_path, scratch_path
from webkb.sources import tables as TB
from webkb.streaming import ingest as SI
from webkb.streaming import keyed as SK

JOB = "20240102_030405"
ROWS = ("element_id string, url string, type string, parent_url string, parent_id string, depth int, pos int, "
        "page_id long, job_id string, checksum string")


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest() + "_" + JOB


def rows(spark, ids, checksum="", job=JOB):
    return spark.createDataFrame([(key(i), f"u{i}", "URL", None, None, 0, 0, i, job, checksum) for i in ids], ROWS)


def scan_metrics(df):
    """Files and rows that the scans of an executed plan without adaptive parts have read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return {n: leaf.metrics().apply(n).value() for n in ("numFiles", "numOutputRows")}


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_path(spark, "t-keys")
    ST.insert_metadata(rows(spark, range(3000)), root)
    return root


def test_lookup_reads_the_files_its_keys_can_be_in(spark, stored):
    total = scan_metrics(spark.read.schema("element_id string").parquet(stored))
    few = ST.stored_keys(rows(spark, [5, 6]).select("element_id"), stored)
    assert {r.element_id for r in few.collect()} == {key(5), key(6)}
    got = scan_metrics(few)
    assert got["numFiles"] <= total["numFiles"] / 4 and got["numOutputRows"] <= total["numOutputRows"] / 4
    # keys that are not stored: their Bloom filters leave no row group to read
    absent = ST.stored_keys(rows(spark, range(10_000, 10_040)).select("element_id"), stored)
    assert absent.count() == 0 and scan_metrics(absent)["numOutputRows"] <= total["numOutputRows"] / 10


def test_lookups_of_any_size_find_the_same(spark, stored, monkeypatch):
    ids = range(2900, 3100)
    found = []
    for most in (0, 10, 1000):
        monkeypatch.setattr(ST, "PUSHED_KEYS", most)
        keys = rows(spark, ids).select("element_id")
        found.append({r.element_id for r in keys.join(ST.stored_keys(keys, stored), "element_id", "left_semi").collect()})
    assert found[0] == found[1] == found[2] == {key(i) for i in range(2900, 3000)}


def test_tables_with_other_numbers_of_digits(spark, monkeypatch):
    root = scratch_path(spark, "t-digits")
    for digits, ids in ((1, range(50)), (3, range(40, 90)), (2, range(80, 120)), (1, range(130))):
        monkeypatch.setattr(ST, "KEY_DIGITS", digits)
        ST.insert_metadata(rows(spark, ids), root)
    assert TB.read_metadata(spark, root).count() == 130
    assert TB.read_metadata(spark, root).select("element_id").distinct().count() == 130


def test_every_row_is_inserted_or_rejected(spark):
    """Equal rows, a hot key, keys stored before and broken rows: each is in exactly one place."""
    root = scratch_path(spark, "t-all")
    ST.insert_metadata(rows(spark, [1, 2]), root)
    batch = rows(spark, [1, 3, 3, 3] + [4] * 500).unionByName(rows(spark, [4], "x" * 64)).unionByName(
        rows(spark, [5]).withColumn("element_id", F.lit(None).cast("string")))
    out = ST.insert_metadata(batch, root)
    reasons = {r.reason: r["count"] for r in out["rejects"].groupBy("reason").count().collect()}
    assert out["inserted"].count() == 2
    assert reasons == {"duplicate element_id in batch": 501, "element_id already stored": 1, "element_id is null": 1,
                       "checksum malformed": 1}


def test_rejects_are_kept_once(spark):
    root = scratch_path(spark, "t-rejects")
    out = ST.insert_metadata(rows(spark, [1, 1, 2, 2]), scratch_path(spark, "t-m"))["rejects"]
    for _ in range(3):
        ST.write_rejects(out, root)
    more = ST.insert_metadata(rows(spark, [8, 8, 2, 2]), scratch_path(spark, "t-m"))["rejects"]
    ST.write_rejects(more, root)
    assert sorted(r.URL for r in spark.read.parquet(root).collect()) == ["u1", "u2", "u8"]


def test_versions_are_one_series(spark, monkeypatch):
    root = scratch_path(spark, "t-versions")
    claim = lambda run: ST.claim_version(spark, root, run)
    assert [claim("a"), claim("s/0"), claim("b"), claim("s/0"), claim("s/1"), claim("a"), claim("c")] == [0, 1, 2, 1, 3, 0, 4]
    monkeypatch.setattr(ST, "KEPT_VERSIONS", 2)
    assert [claim("d"), claim("e"), claim("f"), claim("e")] == [5, 6, 7, 6]


def test_newest_content_whoever_wrote_it(spark):
    root, pages = scratch_path(spark, "t-newest"), scratch_path(spark, "t-land")

    def objects(content):
        return spark.createDataFrame([("J/raw/a.html", "a", bytearray(content, "utf8"), "text/html", "c", "J", "raw")],
                                     "path string, element_id string, content binary, content_type string, "
                                     "checksum string, job_id string, stage string")

    served = lambda: TB.read_objects(spark, root).first().content.decode()
    ST.write_objects(objects("run 0"), root)
    ST.write_objects(objects("run 1"), root)
    spark.range(1).write.parquet(pages)
    seen = []

    def stream(checkpoint):
        def each(batch, batch_id):
            run = f"{SI.stream_id(spark, checkpoint)}/{batch_id}"
            seen.append(run)
            ST.write_objects(objects(f"stream {len(set(seen))}"), root, run)
        (spark.readStream.schema("id long").parquet(pages).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())

    first, second = scratch_path(spark, "t-ck"), scratch_path(spark, "t-ck")
    stream(first)
    assert served() == "stream 1"
    stream(second)  # a fresh checkpoint: micro-batch 0 again, and a new writer
    assert served() == "stream 2" and len(set(seen)) == 2
    ST.write_objects(objects("run 2"), root)
    delete_path(spark, f"{second}/commits")
    stream(second)  # the replay of an old micro-batch is no new writer
    assert seen[1] == seen[2] and served() == "run 2"


def test_state_keeps_first_writers_and_survives_restarts(spark):
    landing, root, progress = (scratch_path(spark, n) for n in ("t-land", "t-index", "t-ck"))
    page = '<a href="/f.pdf">f</a><img src="/logo.png">'
    schema = "page_id long, url string, html string"
    url = "http://a.example/{}".format

    def land(i, pages):
        spark.createDataFrame(pages, schema).repartition(3).write.parquet(f"{landing}/{i}")

    def run():
        SK.stream_stateful(SI.read_page_stream(spark, f"{landing}/*"), JOB, root, progress).awaitTermination()
        return {(r.URL, r.batch, r.checksum[:6], r.parent_id) for r in SK.read_index(spark, root).collect()}

    def want(i, batch, html):
        return url(i), batch, hashlib.sha256(html.encode()).hexdigest()[:6], None

    parent = hashlib.sha256(url(1).encode()).hexdigest() + "_" + JOB
    land(0, [(i, url(i), page) for i in (2, 1, 3)])
    shared = {("http://a.example/f.pdf", 0, "", parent), ("http://a.example/logo.png", 0, "", parent)}
    first = shared | {want(i, 0, page) for i in (1, 2, 3)}
    assert run() == first
    land(1, [(i, url(i), page + " again") for i in (0, 1, 4)])
    second = first | {want(i, 1, page + " again") for i in (0, 4)}
    assert run() == second
    assert run() == second  # nothing landed
    delete_path(spark, f"{progress}/commits/1")
    delete_path(spark, f"{progress}/commits/.1.crc")
    assert run() == second  # the second micro-batch replayed
    land(2, [(i, url(i), page + " more") for i in range(6)])
    assert run() == second | {want(5, 2, page + " more")}
    assert SK.read_index(spark, root).count() == len(second) + 1


def test_paths_of_elements_are_hex_prefixed(spark):
    """The digits that lay out the table are those of the id's hash."""
    got = spark.range(1).select(PA.element_id(F.lit("0"), F.lit(JOB)).alias("k")).first().k
    assert got == key(0)


def objects(spark, texts, order=None):
    return spark.createDataFrame(
        [(f"{JOB}/raw/{i}.html", f"{i}", bytearray(t.encode()), "text/html", hashlib.sha256(t.encode()).hexdigest(), order, JOB, "raw")
         for i, t in texts],
        "path string, element_id string, content binary, content_type string, checksum string, order_key long, job_id string, "
        "stage string").coalesce(1)


def held(df):
    return sorted((r.path.rsplit("/", 1)[1], r.content.decode()) for r in df.select("path", "content").collect())


def file_names(spark, root):
    return {r[0] for r in TB.object_rows(spark, root).select("file_path").distinct().collect()}


def test_compaction_rewrites_the_files_with_overwritten_rows_alone(spark):
    root = scratch_path(spark, "t-compact") + "/a b"
    for texts in ([(1, "one"), (2, "two")], [(3, "three"), (4, "")], [(5, "five")]):
        ST.write_objects(objects(spark, texts), root)
    old = file_names(spark, root)
    assert ST.compact_objects(spark, root) == [] and file_names(spark, root) == old
    ST.write_objects(objects(spark, [(2, "two again"), (6, "six"), (6, "six")]), root)
    want = [("1.html", "one"), ("2.html", "two again"), ("3.html", "three"), ("4.html", ""), ("5.html", "five"), ("6.html", "six")]
    assert held(TB.read_objects(spark, root)) == want
    before = file_names(spark, root)
    replaced = ST.compact_objects(spark, root)
    after = file_names(spark, root)
    assert len(replaced) == 2 and after & before == before - set(replaced) and len(old & after) == 2
    assert held(TB.read_object_rows(spark, root)) == held(TB.read_objects(spark, root)) == want
    assert ST.compact_objects(spark, root) == []


def test_compaction_that_ended_in_between(spark, monkeypatch):
    """New files written, old ones not deleted: readers see each object once, the next run finishes."""
    root = scratch_path(spark, "t-compact")
    for texts in ([(1, "one"), (2, "two")], [(2, "two again")]):
        ST.write_objects(objects(spark, texts), root)
    with monkeypatch.context() as m:
        m.setattr(ST, "delete_path", lambda *a, **k: None)
        ST.compact_objects(spark, root)
    want = [("1.html", "one"), ("2.html", "two again")]
    assert len(held(TB.read_object_rows(spark, root))) > 2
    assert held(TB.read_objects(spark, root)) == want
    ST.compact_objects(spark, root)
    assert held(TB.read_object_rows(spark, root)) == want


def test_compaction_reads_the_files_it_replaces(spark):
    root = scratch_path(spark, "t-compact")
    for n in range(6):
        ST.write_objects(objects(spark, [(n, f"text {n}")]), root)
    ST.write_objects(objects(spark, [(3, "again")]), root)
    rows = TB.object_rows(spark, root)
    file = rows.filter("element_id = '3'").first()["file_path"]
    assert scan_metrics(rows.filter(F.col("file_path").isin([file])))["numFiles"] == 1


def test_failed_export_lists_nothing(spark, tmp_path):
    root = f"file://{tmp_path}"
    good = objects(spark, [(1, "one"), (2, "two")]).select("path", "content")
    bad = good.unionByName(objects(spark, [(3, "three")]).select(F.raise_error(F.lit("no content")).cast("string").alias("path"), "content"))
    with pytest.raises(Exception):
        EX.export_objects(bad, root, run="first")
    assert not [p for p in (tmp_path / EX.LISTINGS).rglob("*") if p.is_file()]
    listed = EX.export_objects(good, root, run="second")
    assert sorted(tuple(r) for r in listed.collect()) == [(f"{JOB}/raw/1.html", 3), (f"{JOB}/raw/2.html", 3)]
    assert (tmp_path / JOB / "raw/2.html").read_bytes() == b"two"
    assert EX.export_objects(good.limit(0), root).count() == 0
    assert not list(tmp_path.rglob("*.pending"))
