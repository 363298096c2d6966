"""Fill-in-the-middle: cut texts between units and reorder the parts.

A unit is a run of ASCII letters or any other single code point. Where units
end is found on the UTF-8 bytes eight at a time: a text is viewed as 64-bit
words, and shifts and adds mark the last byte of every unit in all eight bytes
of a word at once (SWAR). Population counts of the marks, summed up, give the
number of units before each word; the end of unit k is then a binary search
for its word and a select of the remaining bits inside it. No list of units is
ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import slices

#: Prefix, suffix and middle markers.
MARKERS = ("<P>", "<S>", "<M>")

_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES = np.uint64(0x0101010101010101)
_CASE = np.uint64(0x2020202020202020)
_FROM_A = _ONES * np.uint64(0x80 - ord("a"))
_PAST_Z = _ONES * np.uint64(0x7F - ord("z"))
_S1, _S7, _S8, _S56 = (np.uint64(n) for n in (1, 7, 8, 56))


class Units:
    """The units of one text: how many there are and where they end."""

    def __init__(self, text: bytes):
        self.size = len(text)
        # one more word, so that every byte has one after it
        words = np.frombuffer(text + bytes(16 - len(text) % 8), "<u8")
        folded = (words | _CASE) & _LOW
        letter = (folded + _FROM_A) & ~(folded + _PAST_Z) & ~words & _HIGH
        inner = words & ~(words << _S1) & _HIGH  # bytes 10xxxxxx continue a code point
        following = lambda marks: (marks[:-1] >> _S8) | (marks[1:] << _S56)
        ends = ~following(inner) & ~(letter[:-1] & following(letter)) & _HIGH
        if len(text) % 8:  # no marks behind the text
            ends[-1] &= np.uint64((1 << 8 * (len(text) % 8)) - 1)
        else:
            ends[-1:] = 0
        self.ends = ends
        self.before = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        self.inner = inner
        self.count = int(self.before[-1])

    def end(self, units: int) -> int:
        """The number of bytes of the first ``units`` units."""
        if not units:
            return 0
        word = int(np.searchsorted(self.before, units))
        rank = units - (int(self.before[word - 1]) if word else 0)
        marks = int(self.ends[word])
        for _ in range(rank - 1):  # at most seven: drop the lower marks of the word
            marks &= marks - 1
        return 8 * word + ((marks & -marks).bit_length() - 1) // 8 + 1

    def points(self, size: int) -> int:
        """The number of code points in the first ``size`` bytes, a whole number of them."""
        word, rest = divmod(size, 8)
        inner = int(np.bitwise_count(self.inner[:word]).sum())
        if rest:
            inner += (int(self.inner[word]) & ((1 << 8 * rest) - 1)).bit_count()
        return size - inner


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers from the hash of seed and id (a NULL id: the empty string)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def rearrange(text: bytes, doc_id: int | None, seed: int, plain_from: int, spm_below: int,
              markers: tuple[bytes, ...]) -> tuple[int, str, int | None, int | None, bytes]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    units = Units(text)
    h = draws(doc_id, seed)
    if not text or any(m in text for m in markers) or h[2] % 100 >= plain_from:
        return units.count, "plain", None, None, text
    first, second = sorted((h[0] % (units.count + 1), h[1] % (units.count + 1)))
    a, b = units.end(first), units.end(second)
    p, s, m = markers
    spm = h[3] % 100 < spm_below
    parts = (s, text[b:], p, text[:a], m, text[a:b]) if spm else (p, text[:a], s, text[b:], m, text[a:b])
    head = units.points(a)
    return units.count, "spm" if spm else "psm", head, units.points(b) - head, b"".join(parts)


def transform(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20,
              markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n`` (units),
    ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Two cuts drawn from (seed, doc_id) split the whole text between units into
    prefix, middle and suffix (each may be empty). ``form`` is ``psm``
    (prefix, suffix, middle), ``spm`` (suffix, prefix, middle; ``spm_below`` in
    100) or ``plain``: the text itself, for 100 - ``plain_from`` in 100, for
    texts that are empty or NULL, and for texts that hold a marker.

    A NULL doc_id draws as the empty string would; rows that repeat a doc_id
    draw the same numbers. Nothing is shared between rows, so copies, order and
    partitions don't matter. Text without any break between letters is a single
    unit. An empty table gives an empty result; other columns are not read.
    """
    sent = tuple(m.encode() for m in markers)
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows = [rearrange(text or b"", doc_id, seed, plain_from, spm_below, sent) for doc_id, text in
                    zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())]
            *cuts, outputs = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cuts, kinds)),
                 pa.array(outputs, pa.binary()).cast(pa.string())], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from: its parts put back in order.
    The parts hold no marker, so the first of each kind is the one set."""
    p, s, m = markers
    before = lambda mark: F.substring_index(output, mark, 1)
    after = lambda text, mark: F.substring_index(text, mark, -1)
    middle = after(output, m)
    return (F.when(form == "psm", F.concat(after(before(s), p), middle, after(before(m), s)))
            .when(form == "spm", F.concat(after(before(m), p), middle, after(before(p), s))).otherwise(output))


def digests(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` with the hashes of the
    output and of the text rebuilt from output and form."""
    made = transform(docs, **settings)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
