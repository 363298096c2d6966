import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from webkb.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
DOCS = "doc_id long, text string, n string, form int"


def brute(doc_id, text):
    text = text or ""
    w = UNIT.findall(text)
    hexes = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out, chars = "plain", text, (None, None)
    elif h[3] % 100 < 20:
        form, out, chars = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
    else:
        form, out, chars = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(w), form, *chars, sha(out), sha(text)


def test_rows_against_brute_force(spark):
    texts = [None, "", "a", "abcdefgh", "abcdefghi", "abc def, ghi.", "a <P> b", "<S>", "x<M", "<", "éé日本語 mixed テキスト",
             "\U0001f600" * 9, "\n\t \r\n", "z" * 100_000, "é" * 4096 + "Az@[`{", "word " * 30_000, "@AZ[`az{\x7f\x00"]
    docs = [(i, texts[i % len(texts)], "clash", 7) for i in range(40 * len(texts))]
    docs += [(None, "no id here", "", 0), (3, "same id", "", 0), (3, "same id", "", 0), (3, "other text", "", 0), (-5, "minus", "", 0)]
    got = fim.digests(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute(d, t) for d, t, *_ in docs), key=str)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.digests(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ@[`{ é中\U0001f600\n\x00\x7f\u0080"), max_size=80))
def test_every_unit_ends_where_the_pattern_ends(text):
    data, units = text.encode(), UNIT.findall(text)
    found = fim.Units(data)
    assert found.count == len(units)
    ends = [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]
    assert [found.end(k) for k in range(len(units) + 1)] == ends
    assert [found.points(e) for e in ends] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_settings_choose_the_form(spark):
    docs = spark.createDataFrame([(i, "some text, cut somewhere") for i in range(50)], "doc_id long, text string")
    assert {r["form"] for r in fim.transform(docs, plain_from=0).collect()} == {"plain"}
    rows = fim.transform(docs, plain_from=100, spm_below=100, markers=("[a]", "[b]", "[c]")).collect()
    assert {r["form"] for r in rows} == {"spm"} and all(r["output"].startswith("[b]") for r in rows)
    assert len({r["output"] for r in fim.transform(docs, seed=2).collect()}) > 20
