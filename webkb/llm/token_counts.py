"""Token counts: an exact histogram of encoded lengths and its suffix sums.

Documents are encoded whole and aggregated by their number of tokens, so all
that is kept of the corpus is one row per distinct length. Suffix sums over the
histogram answer, for every context limit, how many documents and tokens there
are in all, what is left when each document is cut at the limit, and quantiles.

Sums run in two steps, within blocks of lengths and over the blocks, so that
no window holds more than a block's lengths or the number of blocks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webkb.llm.common import cut, slices

#: Fixed value: how byte-level BPE of this vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Runs of at least this many blanks are cut out of what the pattern splits: it backtracks through a run.
LONG_RUN = 10_000
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encoding(vocabulary: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """A byte-level BPE from the lines of its rank file."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``docs`` (text) to ``length``, the number of tokens of each whole text.

    The rank file is read once, by the driver, and travels with the function.
    Tasks count lengths before the shuffle: ``length, docs`` partial sums.
    """
    with open(vocabulary, "rb") as f:
        ranks = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks, pattern)
        for batch in slices(batches, "text"):
            found: dict[int, int] = {}
            for text in batch.column("text").to_pylist():
                n = token_count(bpe, text or "")
                found[n] = found.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                             names=["length", "docs"])

    return docs.select("text").mapInArrow(run, "length long, docs long")


def token_count(bpe: tiktoken.Encoding, text: str, runs: re.Pattern = BLANKS) -> int:
    """Tokens of a whole text. A long run of blanks is one piece of the
    pattern, but for its last blank where a word follows, which goes with the
    word; such a piece is encoded by itself."""
    total = at = 0
    for run in runs.finditer(text):
        end = run.end() - (run.end() < len(text))
        total += sum(len(bpe.encode_ordinary(part)) for part in pieces(text[at:run.start()]))
        total += len(bpe._encode_single_piece(text[run.start():end]))
        at = end
    return total + sum(len(bpe.encode_ordinary(part)) for part in pieces(text[at:]))


def pieces(text: str, most: int = 1 << 20) -> Iterator[str]:
    """A text in pieces of about ``most`` characters, cut where a letter
    follows a line break that follows a letter: the pattern never merges
    across such a place, so the pieces' tokens are the text's."""
    start = 0
    while len(text) - start > most:
        at = text.find("\n", start + most)
        while at >= 0 and not (text[at - 1:at].isalpha() and text[at + 1:at + 2].isalpha()):
            at = text.find("\n", at + 1)
        if at < 0:
            break
        yield text[start:at + 1]
        start = at + 1
    yield text[start:]


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, block: int = 256) -> DataFrame:
    """One row per distinct length: ``length, docs, docs_from, tokens_from``
    (documents of at least that length, and their tokens), ``docs_all,
    tokens_all, truncated_total`` (tokens left when every document is cut at
    that length) and ``quantile`` (share of documents of at most that length).

    A NULL or empty text has length 0; a text may be as long as a task's memory
    allows, blanks without end included; repeated rows count each; other
    columns are not read; an empty table gives an empty result.
    """
    counts = cut(lengths(docs, vocabulary, pattern).groupBy("length").agg(F.sum("docs").alias("docs"))
                 .withColumn("block", F.floor(F.col("length") / block)), "token-counts")
    tokens = F.col("length") * F.col("docs")
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    blocks = blocks.select(
        F.col("block").alias("of"), zero(F.sum("d").over(above)).alias("docs_above"),
        zero(F.sum("t").over(above)).alias("tokens_above"))
    docs_all, tokens_all = counts.agg(zero(F.sum("docs")), zero(F.sum(tokens))).first()
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    rows = counts.join(blocks, F.col("block") == F.col("of")).select(
        "length", "docs", (F.sum("docs").over(within) + F.col("docs_above")).alias("docs_from"),
        (F.sum(tokens).over(within) + F.col("tokens_above")).alias("tokens_from"),
        F.lit(docs_all).cast("long").alias("docs_all"), F.lit(tokens_all).cast("long").alias("tokens_all"))
    return rows.select(
        "*", (F.col("tokens_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("docs_all") - F.col("docs_from") + F.col("docs")) / F.col("docs_all")).alias("quantile"))


def truncated_total(found: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, from a histogram."""
    row = found.filter(F.col("length") >= limit).orderBy("length").select(
        "docs_from", "tokens_from", "tokens_all").first()
    if row:
        return row["tokens_all"] - row["tokens_from"] + limit * row["docs_from"]
    row = found.select("tokens_all").first()
    return row["tokens_all"] if row else 0


def quantile(found: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents don't exceed."""
    row = found.filter(F.col("quantile") >= share).orderBy("length").select("length").first()
    return row["length"] if row else None
