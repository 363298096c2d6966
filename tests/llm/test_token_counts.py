import random

from webkb.llm import token_counts as T

SCHEMA = "doc_id long, text string, length long, docs long"


def brute(texts):
    enc = T.encoding(open(T.VOCABULARY, "rb").read())
    n = [len(enc.encode_ordinary(t or "")) for t in texts]
    return sorted((length, n.count(length), sum(x >= length for x in n), sum(x for x in n if x >= length), len(n), sum(n),
                   sum(min(x, length) for x in n), sum(x <= length for x in n) / len(n)) for length in set(n)), n


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_matches_brute_force(spark):
    texts = [None, "", "a", "  \n", "it's 12 °C\nhere", "x " * 5000, "same text", "same text", "日本語 é" * 50]
    docs = spark.createDataFrame([(i, t, 9, 9) for i, t in enumerate(texts)], SCHEMA)
    want, n = brute(texts)
    for block in (1024, 3):
        got = T.histogram(docs, block=block)
        assert got.columns == ["length", "docs", "docs_from", "tokens_from", "docs_all", "tokens_all",
                               "truncated_total", "quantile"]
        assert found(got) == want
    for limit in (0, 1, 7, 100, 10**9):
        assert T.truncated_total(got, limit) == sum(min(x, limit) for x in n)
    for share in (0.0, 0.3, 0.5, 0.99, 1.0):
        assert T.quantile(got, share) == next(x for x in sorted(n) if sum(y <= x for y in n) >= share * len(n))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(T.histogram(docs)) == brute([r.text for r in docs.collect()])[0]


def test_pieces_do_not_change_tokens():
    enc = T.encoding(open(T.VOCABULARY, "rb").read())
    rng = random.Random(7)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "é", "\n", "\n", " ", "'s", "1", ".", "日"]) for _ in range(300))
        parts = list(T.pieces(text, 20))
        assert "".join(parts) == text
        assert [t for p in parts for t in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_empty(spark):
    none = T.histogram(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and T.truncated_total(none, 5) == 0 and T.quantile(none, 0.5) is None


def test_runs_of_blanks_are_one_piece():
    """Cut out of the pattern or not, with and without a word after them: the same tokens."""
    enc = T.encoding(open(T.VOCABULARY, "rb").read())
    rng = random.Random(8)
    short = T.re.compile(T.BLANKS.pattern.replace("{10000,}", "{3,}"))
    for _ in range(400):
        text = "".join(rng.choice(["a", "B's", "é", "\n", "\n", " ", " ", "  ", "\t", "\x1c", "\u3000", "\xa0", "1", "."])
                       for _ in range(rng.randrange(60)))
        assert T.token_count(enc, text, short) == len(enc.encode_ordinary(text))


def test_very_long_runs_of_blanks(spark):
    n = 2_000_000
    texts = [" " * n, " " * n + "word", "word" + "\n" * n + "word", "a" + " \n" * (n // 2) + " b"]
    enc = T.encoding(open(T.VOCABULARY, "rb").read())
    piece = lambda t: len(enc._encode_single_piece(t))
    want = [piece(texts[0]), piece(" " * (n - 1)) + piece(" word"), 2 * piece("word") + piece("\n" * (n - 1)) + piece("\n"),
            piece("a") + piece(" \n" * (n // 2)) + piece(" b")]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["length"]: r["docs"] for r in T.histogram(docs).collect()}
    assert got == {w: want.count(w) for w in want}
