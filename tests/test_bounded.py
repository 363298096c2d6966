"""Tables of many files, and steps whose memory or time must not follow the size of a batch."""

import time

import numpy as np
import pyarrow as pa

from webkb.functions import html as H
from webkb.llm import common as C
from webkb.llm import simhash as SH
from webkb.operators import assets as AS
from webkb.operators import search as SE
from webkb.plans import queries as Q
from webkb.session import scratch_path


def test_stream_ingest_reads_a_table_of_many_files(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.example.org/en/{i}", f"<html><article><h1>t {i}</h1></article></html>") for i in range(12)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(
        str(tmp_path / "pages.parquet"))
    got = Q.QUERIES["stream_ingest"](spark, str(tmp_path)).collect()
    want = Q.QUERIES["metadata_first_writer"](spark, str(tmp_path)).collect()
    assert len(want) > 12 and sorted(got, key=lambda r: (r.element_id, r.type)) == sorted(
        want, key=lambda r: (r.element_id, r.type))


def _pages(n):
    url = pa.array([f"http://h.example.org/{i}" for i in range(n)])
    return url, pa.array([None if i % 100 == 7 else f"<p>{i}</p><a href='/{i}.pdf'>x</a>" for i in range(n)])


def test_pages_leave_python_in_slices():
    url, html = _pages(1000)
    for udf in (H.parse_html_udf, H.markdown_udf()):
        out = list(udf.func(iter([(url, html), (url.slice(0, 0), html.slice(0, 0))])))
        assert max(map(len, out)) <= H.SLICE_ROWS and sum(map(len, out)) == 1000
    links = [i["value"] for part in H.parse_html_udf.func(iter([(url, html)])) for page in part.to_pylist()
             for i in page["items"]]
    assert links == [f"/{i}.pdf" for i in range(1000) if i % 100 != 7]


def test_slices_are_bounded_by_bytes():
    big = pa.array(["x" * (H.SLICE_BYTES // 2 + 1), "y", None, "z" * (3 * H.SLICE_BYTES), "a"])
    assert list(H.held_slices(big)) == [(0, 3), (3, 1), (4, 1)]


def test_files_leave_python_in_slices():
    files = pa.RecordBatch.from_pydict({"key": [str(i) for i in range(600)], "content": [b"t%d" % i for i in range(600)]})
    out = list(AS._pdf_partition("auto", lambda method: lambda content: content.decode())(iter([files])))
    assert max(b.num_rows for b in out) <= H.SLICE_ROWS
    assert [r["markdown"] for b in out for r in b.to_pylist()] == [f"t{i}" for i in range(600)]


def test_a_block_is_scored_for_many_queries_at_once():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows, factor = {}, np.zeros((300, SE.BLOCK))
    for i, w in enumerate(words):
        places = np.sort(rng.permutation(SE.BLOCK)[:max(2, 1500 // (i + 1))])
        rows[w] = np.stack([places, np.ones(len(places)), np.full(len(places), 10)], 1).astype("<i4").tobytes(), 1.0
        factor[i, places] = 1.0
    queries = [(q, [(words[i], 1.0 + float(rng.random())) for i in
                    np.unique(np.append(np.arange(20), rng.integers(20, 300, 20)))]) for q in range(3000)]
    scorer = SE.BlockScorer(queries, 10, 1.2, 0.75, 10.0)
    began = time.perf_counter()
    scorer.block(0, rows, None)
    # one query after the other took some milliseconds each
    assert time.perf_counter() - began < 1.2
    got = {}
    for q, d, s in scorer.rows():
        got.setdefault(q, []).append((d, round(s, 9)))
    for q, terms in queries[::100]:
        total = sum(w * factor[words.index(t)] for t, w in terms)
        best = sorted(np.flatnonzero(total).tolist(), key=lambda d: (-round(total[d], 9), d))[:10]
        assert got[q] == [(d, round(float(total[d]), 9)) for d in best]


def test_index_rows_of_a_folder_are_written_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(SE, "BLOCK_BITS", 3)
    monkeypatch.setattr(SE, "BLOCK", 8)
    docs = spark.createDataFrame([(i, f"common w{i % 50}") for i in range(600)], "doc_id long, text string")
    root = SE.build_index(docs, scratch_path(spark, "t-index"), parts=1)
    rows = spark.read.schema(SE.POSTINGS).parquet(f"{root}/postings")
    assert len(rows.inputFiles()) > 3  # one file a folder, however many documents, before


def test_batches_of_a_read_table_are_bounded_by_bytes(spark, tmp_path):
    spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('x', 20000) as text").write.parquet(
        str(tmp_path / "documents.parquet"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    spark.conf.unset(C.BATCH_CONF)
    got = C.read(spark, str(tmp_path), "documents").coalesce(1).mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 3000
    assert max(r.bytes for r in got) < 2 * C.BATCH_BYTES  # 60 MB in one batch before
    spark.conf.set(C.BATCH_CONF, str(1 << 20))
    C.read(spark, str(tmp_path), "documents")
    assert spark.conf.get(C.BATCH_CONF) == str(1 << 20)
    spark.conf.unset(C.BATCH_CONF)


def test_texts_become_python_objects_in_pieces(spark):
    half = C.PIECE_BYTES // 2 + 1
    got = list(C.pieces(pa.array(["x" * half, None, "y" * half, "", "z"])))
    assert [len(p) for p in got] == [2, 3] and got[0][1] is None
    texts = [None, "", "a b c d", "x " * C.PIECE_BYTES, "tail of it"] + [f"word{i} and {i % 7}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.fp for r in docs.select("doc_id", SH.fingerprint_column().alias("fp")).collect()}
    assert [found[i] % (1 << 64) for i in range(len(texts))] == [SH.fingerprint(t) for t in texts]
    assert min(found.values()) < 0 < max(found.values())
