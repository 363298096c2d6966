"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by its ``prefix`` nearest reference points (pivots) in
order. Inverted lists say which vectors have a pivot in their prefix; each
vector is at home in the list of its nearest one. Two vectors are a candidate
pair if one has the other's home in its prefix and the prefixes share at least
``shared`` pivots; candidates are verified by their cosine in double precision.

Lists are matched on narrow rows first: inside a list, vectors meet that share
``shared - 1`` further pivots, which a sort of their pivot combinations finds
without looking at pairs. Only vectors with a candidate travel with their
components, to be verified in blocks of a list. A block counts links and joins
its vectors into local groups; it emits a row per vector, never one per pair.

Equal vectors are one vector with a number of copies before anything else. A
list with more than ``hot`` rows is not matched in one task: all its vectors go
on to the blocks, ``block`` home vectors each, over which its other vectors are
repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webkb.llm.common import cut, drop_cut
from webkb.llm.components import components


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; their largest component first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Vectors (bytes of components of ``kind``) as rows of doubles; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for i, value in enumerate(column.to_pylist()):
        v = np.frombuffer(value, kind)
        out[i, :len(v)] = v
    return out


def spread(sample: np.ndarray, most: int, apart: float) -> np.ndarray:
    """Up to ``most`` rows of ``sample``, each with a cosine of at most ``apart``
    to all rows taken before: a dense group of near copies gives one pivot,
    which its members agree on, and not many whose order is noise."""
    taken = np.zeros((0, sample.shape[1]))
    for at in range(0, len(sample), 256):
        part = sample[at:at + 256]
        part = part[(part @ taken.T).max(axis=1, initial=-1.0) <= apart]
        chosen: list[int] = []
        near = part @ part.T
        for i in range(len(part)):
            if not chosen or near[i, chosen].max() <= apart:
                chosen.append(i)
        taken = np.concatenate([taken, part[chosen]])
        if len(taken) >= most:
            break
    return taken[:most]


def classes(rows: DataFrame, kind: str) -> DataFrame:
    """Distinct usable vectors of ``rows`` (vec_id, t1, t2, usable, vector):
    ``node, t1, t2, first_id, copies, size, vector`` (bytes of its components)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
            at = np.cumsum([0, *column.value_lengths().to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("t1", "t2", "first_id", "copies")), column.value_lengths().cast(pa.int32()),
                 pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["t1", "t2", "first_id", "copies", "size", "vector"])

    distinct = rows.filter("usable").groupBy("t1", "t2").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
    return cut(distinct.select("t1", "t2", "first_id", "copies", "vector").mapInArrow(
        run, "t1 long, t2 long, first_id long, copies long, size int, vector binary")
        .withColumn("node", F.monotonically_increasing_id()), "pivot-classes")


def choose_pivots(found: DataFrame, kind: str, count: int, width: int, most: int, apart: float, seed: int) -> np.ndarray:
    """Pivots for ``count`` vectors: five times the square root of their
    number, at most ``most``, from a seeded sample of four times as many."""
    wanted = min(most, max(64, int(5 * count ** 0.5)))
    sample = found.select("vector", F.xxhash64(F.lit(seed), "t1", "t2").alias("order"), "t1", "t2").orderBy(
        "order", "t1", "t2").limit(4 * wanted).select("vector").toArrow()
    return spread(unit(_matrix(sample.column("vector").combine_chunks(), kind, width)), wanted, apart)


def described(found: DataFrame, kind: str, pivots: np.ndarray, prefix: int) -> DataFrame:
    """``node, nearest``: the ``prefix`` nearest pivots of each vector, nearest first."""
    width, prefix = pivots.shape[1], min(prefix, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = -(unit(_matrix(batch.column("vector"), kind, width)) @ pivots.T)
            top = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
            # equally near pivots in the order of their numbers
            value = np.take_along_axis(near, top, 1)
            top = np.take_along_axis(top, np.lexsort((top, value), axis=1), 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, top.size + 1, prefix), pa.int32()), pa.array(top.ravel()))],
                names=["node", "nearest"])

    return found.select("node", "vector").mapInArrow(run, "node long, nearest array<int>")


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by the columns ``names``, cut so that none spans two groups."""
    for batch in batches:
        keys = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            changed[1:] |= key[1:] != key[:-1]
        edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _nearest(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("nearest")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def _matched(postings: DataFrame, shared: int, pivots: int) -> DataFrame:
    """Rows of inverted lists (pivot, node, home, nearest), whole lists sorted
    by pivot, to ``pivot, node`` of those that may have a partner in the list."""

    def one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        pivot = parts[0].column("pivot")[0].as_py()
        node = np.concatenate([p.column("node").to_numpy() for p in parts])
        home = np.concatenate([p.column("home").to_numpy(zero_copy_only=False) for p in parts])
        near = np.concatenate([_nearest(p) for p in parts])
        others = np.sort(near[near != pivot].reshape(len(near), -1), axis=1).astype(np.int64)
        flagged = np.zeros(len(node), bool)
        picks = list(combinations(range(others.shape[1]), min(shared, near.shape[1]) - 1))
        code = np.zeros((len(node), len(picks)), np.int64)
        for column, pick in enumerate(picks):
            for p in pick:
                # beyond 64 bits codes may collide, which costs a row
                code[:, column] = code[:, column] * np.int64(pivots) + others[:, p]
        _, group = np.unique(code.ravel(), return_inverse=True)
        whose = np.repeat(np.arange(len(node)), len(picks))
        many = np.bincount(group) > 1
        homes = np.bincount(group, weights=home[whose]) > 0
        flagged[whose[(many & homes)[group]]] = True
        return pa.RecordBatch.from_arrays([pa.array(np.full(flagged.sum(), pivot, np.int32)), pa.array(node[flagged])],
                                          names=["pivot", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in _grouped(batches, ["pivot"]):
            if held and held[0].column("pivot")[0] != part.column("pivot")[0]:
                yield one(held)
                held = []
            held.append(part)
        if held:
            yield one(held)

    return postings.mapInArrow(run, "pivot int, node long")


class _Block:
    """Home vectors of one block of a list, and what they link with.

    Homes that are linked, directly or through a visitor, get a common root;
    a visitor then only needs an edge to one of the homes it is linked with.
    """

    def __init__(self, least: float, shared: int):
        self.least, self.shared = least, shared
        self.rows: dict[str, np.ndarray] = {}
        self.links = self.root = np.zeros(0, np.int64)

    def _pairs(self, part: dict[str, np.ndarray], first: int) -> tuple[np.ndarray, np.ndarray]:
        """Verified pairs (home, row of ``part``); ``first``: the place of the
        part's first row among the homes, -1 if it holds visitors."""
        mine = self.rows
        i, j = np.nonzero(mine["vectors"] @ part["vectors"].T >= self.least)
        ok = mine["size"][i] == part["size"][j]
        if first >= 0:
            ok &= i < first + j
        i, j = i[ok], j[ok]
        a, b = mine["near"][i], part["near"][j]
        common = sum((a[:, [c]] == b).any(axis=1).astype(np.int8) for c in range(a.shape[1]))
        ok = common >= min(self.shared, a.shape[1])
        if first < 0:
            # a pair that meets in both homes' lists counts in the one of the smaller number
            ok &= (a[:, 0] <= b[:, 0]) | ~(a == b[:, [0]]).any(axis=1)
        return i[ok], j[ok]

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """One root for the homes ``a[k]`` and ``b[k]``: the first of them all."""
        while True:
            of_a, of_b = self.root[a], self.root[b]
            apart = of_a != of_b
            if not apart.any():
                return
            np.minimum.at(self.root, np.maximum(of_a, of_b)[apart], np.minimum(of_a, of_b)[apart])
            while not np.array_equal(above := self.root[self.root], self.root):
                self.root = above

    def _count(self, i: np.ndarray, part: dict[str, np.ndarray], j: np.ndarray) -> np.ndarray:
        """Add the homes' links; returns those of the part's rows."""
        np.add.at(self.links, i, part["copies"][j])
        links = np.zeros(len(part["node"]), np.int64)
        np.add.at(links, j, self.rows["copies"][i])
        return links

    def home(self, part: dict[str, np.ndarray]) -> None:
        """Add home vectors; they are linked with those before and each other."""
        first, n = len(self.root), len(part["node"])
        self.rows = {c: np.concatenate([self.rows[c], v]) if first else v for c, v in part.items()}
        self.root = np.concatenate([self.root, np.arange(first, first + n)])
        self.links = np.concatenate([self.links, np.zeros(n, np.int64)])
        i, j = self._pairs(part, first)
        self.links[first:] += self._count(i, part, j)
        self._join(i, first + j)

    def visit(self, part: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        """Rows for those of ``part`` that are linked with a home."""
        i, j = self._pairs(part, -1) if self.rows else ((), ())
        if not len(i):
            return None
        links = self._count(i, part, j)
        to = np.full(len(links), len(self.root), np.int64)
        np.minimum.at(to, j, i)
        self._join(i, to[j])
        has = np.flatnonzero(links)
        return _linked(part["node"][has], self.rows["node"][to[has]], links[has])

    def done(self) -> pa.RecordBatch | None:
        if not self.links.any():
            return None
        has = np.flatnonzero(self.links)
        return _linked(self.rows["node"][has], self.rows["node"][self.root[has]], self.links[has])


def _linked(node: np.ndarray, to: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (node, to, links)], names=["node", "to", "links"])


def _verified(rows: DataFrame, kind: str, width: int, least: float, shared: int, step: int = 1024) -> DataFrame:
    """Rows of blocks (pivot, block, visitor, node, copies, size, nearest,
    vector), whole blocks sorted with their homes first, to ``node, to,
    links``: partial counts and one edge per vector and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for whole in _grouped(batches, ["pivot", "block", "visitor"]):
            key = whole.column("pivot")[0].as_py(), whole.column("block")[0].as_py()
            if key != now:
                if block and (out := block.done()):
                    yield out
                now, block = key, _Block(least, shared)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                part = {c: batch.column(c).to_numpy() for c in ("node", "copies", "size")}
                part |= {"near": _nearest(batch), "vectors": unit(_matrix(batch.column("vector"), kind, width))}
                if batch.column("visitor")[0].as_py():
                    if out := block.visit(part):
                        yield out
                else:
                    block.home(part)
        if block and (out := block.done()):
            yield out

    return rows.mapInArrow(run, "node long, to long, links long")


def links(found: DataFrame, kind: str, least: float = 0.95, prefix: int = 8, shared: int = 3, most: int = 4096,
          apart: float = 0.8, seed: int = 42, hot: int = 1 << 16, block: int = 1024) -> DataFrame:
    """Links of the distinct vectors ``found`` (of :func:`classes`): ``node,
    to, links``, where ``links`` sums up to the copies of other vectors that
    are linked with ``node``, and the edges ``node, to`` join what is linked."""
    spark = found.sparkSession
    empty = spark.createDataFrame([], "node long, to long, links long")
    count, width = found.agg(F.count("*"), F.max("size")).first()
    if count < 2:
        return empty
    pivots = choose_pivots(found, kind, count, width, most, apart, seed)
    near = cut(described(found, kind, pivots, prefix), "pivot-described")
    postings = near.select("node", "nearest", F.posexplode("nearest").alias("place", "pivot")).select(
        "pivot", "node", (F.col("place") == 0).alias("home"), "nearest")
    # one row per pivot
    long_lists = [r["pivot"] for r in postings.groupBy("pivot").count().filter(F.col("count") > hot).collect()]
    is_long = F.col("pivot").isin(long_lists) if long_lists else F.lit(False)
    short = postings.filter(~is_long).repartition("pivot").sortWithinPartitions("pivot")
    flagged = cut(_matched(short, shared, len(pivots)).unionByName(postings.filter(is_long).select("pivot", "node")),
                  "pivot-flagged")
    home = F.col("nearest")[0]
    members = cut(flagged.join(near, "node").select("pivot", "node", "nearest", (home != F.col("pivot")).alias("visitor")),
                  "pivot-members")
    blocks = members.filter("not visitor").groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # at most one row per pivot is sent
    dealt = members.join(F.broadcast(blocks), "pivot").withColumn(
        "of", F.pmod(F.xxhash64(F.lit(seed + 1), "node"), F.col("blocks")).cast("int"))
    # a visitor goes to every block of the list, a home visits the blocks after its own
    start = F.when(F.col("visitor"), 0).otherwise(F.col("of"))
    sent = dealt.withColumn("block", F.explode(F.sequence(start, F.col("blocks") - 1))).select(
        "pivot", "block", (F.col("visitor") | (F.col("block") != F.col("of"))).alias("visitor"), "node", "nearest")
    rows = sent.join(found.select("node", "copies", "size", "vector"), "node")
    rows = rows.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "visitor")
    out = cut(_verified(rows, kind, width, least, shared), "pivot-links")
    for table in (near, flagged, members):
        drop_cut(table)
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.95, **settings) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): ``vec_id, n_links``
    (other vectors found with a cosine of at least ``least``), ``component_id``
    (the smallest vec_id reachable over links, itself included) and ``kept``
    (whether that is its own).

    A vector that is NULL, empty, all zeros, or holds a NULL or non-finite
    component links with nothing. Equal vectors always link; vectors of
    different lengths never do. Links found are verified in double precision;
    the index misses few of the others (see the README). Repeated vec_ids are
    rows of their own with a common id; a row without a vec_id links, is not
    kept, and has a component_id only if its component has an id. An empty
    table gives an empty result; other columns are not read.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    component = "float" if kind == "<f4" else "double"
    v = F.col("embedding").cast(f"array<{component}>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.coalesce((F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", usable.alias("usable"), F.xxhash64("embedding").alias("t1"),
                          F.xxhash64(F.lit(7), "embedding").alias("t2"), v.alias("vector"))
    found = classes(rows, kind)
    pairs = links(found, kind, least, **settings)
    counts = pairs.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(pairs.select(F.col("node").alias("u"), F.col("to").alias("v")), "pivot")
    joined = found.select("node", "t1", "t2", "first_id", "copies").join(counts, "node", "left").join(
        roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    done = cut(joined.join(ids, "root").select(
        "t1", "t2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "pivot-found")
    lone = ~F.col("usable")
    linked = rows.drop("vector").filter("usable").join(done, ["t1", "t2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(lone).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
