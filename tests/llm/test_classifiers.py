import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webkb.llm import quality, toxicity
from webkb.llm.labelled import sample

PATH = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, label int, order long, score double"


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("module, label, folds, fold, cut, limit", [
    (quality, "quality", 4, 2, 0.7, 0.98), (toxicity, "toxic", 5, 0, 0.5, 0.8)])
def test_held_out(spark, module, label, folds, fold, cut, limit):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = module.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r[label] for r in labels.collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    assert auc([(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]) > limit


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows_and_no_labels(spark, module, label):
    rows = [(None, None), (1, ""), (1, ""), (2, "x"), (3, "long " * 200_000), (4, "\x00\U0001f600")]
    docs = spark.createDataFrame([(d, t, 1, 2, 3.0) for d, t in rows], SCHEMA)
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    one = spark.createDataFrame([(2, 1), (3, 1), (None, 0), (4, None), (9, 0), (9, 1)], f"doc_id long, {label} int")
    for labels in (none, one):
        got = module.score_documents(docs, labels).collect()
        assert len(got) == len(rows) and len({r.score for r in got}) == 1
    assert module.score_documents(docs.limit(0), one).count() == 0


def test_whole_document_counts():
    """What comes after the first chunk decides as what comes before it."""
    good, bad = [b"plain words in a row, and more. " * 9] * 40, [b"plain words in a row $$$%%% and more. " * 9] * 40
    net = quality.train(good + bad, [1] * 40 + [0] * 40, epochs=15)
    long = b"plain words in a row, and more. " * 4000
    assert net.score(long) > 0.5 > net.score(long + b"words in a row $$$%%% and")
    assert net.pooled(long)[0] == pytest.approx(quality.Network.pooled(net, long, where=True)[0])


def test_chunks_miss_and_repeat_nothing():
    net = quality.Network.random(np.random.default_rng(1))
    data = np.random.default_rng(2).integers(0, 256, 3 * quality.CHUNK + 5, dtype=np.uint8).tobytes()
    got, at = net.pooled(data, where=True)
    places = np.frombuffer(data, np.uint8)
    full = sum(net.filters[k][places[k:len(places) - quality.WIDTH + 1 + k]] for k in range(quality.WIDTH))
    assert got == pytest.approx(full.max(axis=0), rel=1e-5) and (at == full.argmax(axis=0)).all()


def test_windows_cover():
    for n in (0, 1, 71, 96, 97, 168, 1000):
        text = bytes(i % 251 for i in range(n))
        seen = set()
        for i, w in enumerate(toxicity.windows(text)):
            assert w == text[i * toxicity.STRIDE:i * toxicity.STRIDE + len(w)]
            seen.update(range(i * toxicity.STRIDE, i * toxicity.STRIDE + len(w)))
        assert seen == set(range(n))


def test_keep_good(spark):
    docs, labels = (spark.read.parquet(f"{PATH}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = sorted(r.doc_id for r in quality.score_documents(docs, labels).collect() if r.predicted)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_a_label_of_long_texts_only_is_learned_too(spark):
    """Texts within the bound come first; a label that has none of them gives the starts of its longest."""
    docs = spark.createDataFrame([(i, "short text " + str(i)) for i in range(40)] + [(i, "long " * 5000) for i in range(40, 60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 40)) for i in range(60)], "doc_id long, quality int")
    got, odds = sample(docs, labels, "quality", F.lit(True), 10, 1000)
    assert got["label"].tolist() == [0] * 10 + [1] * 10 and odds == 20.5 / 40.5
    assert all(len(t) == 1000 for t in got["text"][10:]) and all(len(t) < 20 for t in got["text"][:10])
    mixed = docs.withColumn("text", F.when(F.col("doc_id") == 47, F.lit("few")).otherwise(F.col("text")))
    got, _ = sample(mixed, labels, "quality", F.lit(True), 3, 1000)
    assert got["text"].tolist()[3] == b"few" and len(got) == 6
    none, odds = sample(docs, labels.limit(0), "quality", F.lit(True), 3, 1000)
    assert len(none) == 0 and odds == 1.0
