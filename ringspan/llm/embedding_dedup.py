"""Near-duplicate embeddings: sign hashing with random hyperplanes, exact cosines, connected components.

Equal vectors are one node from the start. In each of several tables a vector's bucket is the signs of its
products with random hyperplanes. The vectors of a bucket are compared by exact cosines, as matrix products;
a pair counts in the first table in which its buckets are the same, so nothing is counted twice and no pairs
travel: a task returns, per vector, the number of its links and one link that keeps it connected. Buckets
above a size are cut into blocks, and every pair of blocks is a task's work of its own.

At a cosine of 0.95 two vectors agree in a sign with probability 0.899, so 16 planes and 32 tables miss a pair
with probability (1 - 0.899**16)**32 = 0.002. Vectors of the same bucket by chance grow with the number of
vectors over ``2**bits``: take a bit more per doubling, and tables to match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import small_batches
from ringspan.llm.components import connected_components
from ringspan.llm.scratch import HashFilter, Scratch, hash_filter

COSINE = 0.95
BITS = 16
TABLES = 32
# Rows of a block; a task holds two.
BLOCK = 2048
# Groups of up to so many rows are compared side by side, larger ones one at a time.
_SMALL = 32


@lru_cache(maxsize=4)
def _planes(dimensions: int, bits: int, tables: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dimensions]).normal(size=(dimensions, bits * tables))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that squares neither overflow nor vanish."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _buckets(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Each row's bucket in every table."""
    signs = (units @ _planes(units.shape[1], bits, tables) >= 0).reshape(len(units), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _by_width(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of the vectors of each length."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    widths = np.diff(offsets)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        yield at, values[offsets[:-1][at][:, None] + np.arange(width)]


def _keys(tables: np.ndarray, buckets: np.ndarray, width: int) -> np.ndarray:
    """One number for a table, a bucket and the vectors' length."""
    return (np.int64(width) << np.int64(48)) ^ (tables.astype(np.int64) << np.int64(40)) ^ buckets


def _bucket_keys(batches: Iterable[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 4 << 20):
        for _, rows in _by_width(batch.column("vector")):
            keys = _keys(np.arange(tables), _buckets(_unit(rows), bits, tables), rows.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1))], names=["bucket"])


MEMBERS = "bucket long, tab int, node long, copies long, vector array<double>"


def _members(
    batches: Iterable[pa.RecordBatch], bits: int, tables: int, shared: HashFilter
) -> Iterator[pa.RecordBatch]:
    """Every vector once for each of its buckets that others are in as well."""
    for batch in small_batches(batches, 1 << 20):
        for at, rows in _by_width(batch.column("vector")):
            keys = _keys(np.arange(tables), _buckets(_unit(rows), bits, tables), rows.shape[1])
            which, table = np.nonzero(shared.has(keys.reshape(-1)).reshape(keys.shape))
            taken = batch.take(pa.array(at[which]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[which, table]),
                    pa.array(table, pa.int32()),
                    *(taken.column(c) for c in ("node", "copies", "vector")),
                ],
                names=["bucket", "tab", "node", "copies", "vector"],
            )


FOUND = "node long, links long, other long"


class _Groups:
    """The rows of a task in groups of equal ``bucket, pair``, sorted; a group may span batches."""

    def __init__(self, cosine: float, bits: int, tables: int) -> None:
        self.cosine, self.bits, self.tables = cosine, bits, tables

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            bucket, pair = (table.column(c).to_numpy() for c in ("bucket", "pair"))
            # The last group may go on in the next batch.
            last = int(np.flatnonzero((bucket != bucket[-1]) | (pair != pair[-1])).max(initial=-1)) + 1
            if last:
                yield self._compare(table.slice(0, last))
            held = table.slice(last)
        if held is not None:
            yield self._compare(held)

    def _compare(self, table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        column = {c: table.column(c).to_numpy() for c in ("bucket", "pair", "tab", "node", "copies", "block")}
        vectors = table.column("vector").chunk(0)
        units = None
        for at, rows in _by_width(vectors):
            if units is None:
                units = np.zeros((len(vectors), rows.shape[1])) if len(at) == len(vectors) else [None] * len(vectors)
            rows = _unit(rows)
            if isinstance(units, list):
                for place, row in zip(at, rows):
                    units[place] = row
            else:
                units = rows
        new = np.ones(len(vectors), bool)
        new[1:] = (column["bucket"][1:] != column["bucket"][:-1]) | (column["pair"][1:] != column["pair"][:-1])
        firsts = np.flatnonzero(new)
        sizes = np.diff(np.append(firsts, len(new)))
        group = np.cumsum(new) - 1
        # Of two blocks only the pairs across them are compared.
        mixed = np.maximum.reduceat(column["block"], firsts) != np.minimum.reduceat(column["block"], firsts)

        left, right = [], []
        if not isinstance(units, list):
            for step in range(1, min(_SMALL, int(sizes.max()))):
                a = np.flatnonzero(
                    (group[:-step] == group[step:]) & (sizes <= _SMALL)[group[:-step]]
                )
                b = a + step
                near = np.einsum("ij,ij->i", units[a], units[b]) >= self.cosine
                left.append(a[near])
                right.append(b[near])
            large = np.flatnonzero(sizes > _SMALL)
        else:
            large = np.flatnonzero(sizes > 1)  # vectors of several lengths in one batch
        for g in large.tolist():
            rows = np.arange(firsts[g], firsts[g] + sizes[g])
            own = np.stack([units[r] for r in rows]) if isinstance(units, list) else units[rows]
            for low in range(0, len(rows), 512):
                a, b = np.nonzero(own[low : low + 512] @ own.T >= self.cosine)
                later = b > a + low
                left.append(rows[a[later] + low])
                right.append(rows[b[later]])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
        across = ~mixed[group[a]] | (column["block"][a] != column["block"][b])
        a, b = a[across], b[across]
        return self._links(a, b, units, column)

    def _links(self, a: np.ndarray, b: np.ndarray, units: object, column: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Counts of links per vector, and for each vector one link; only pairs whose first table this is."""
        node, copies, tab = column["node"], column["copies"], column["tab"]
        if len(a):
            rows = np.unique(np.concatenate([a, b]))
            if isinstance(units, list):
                own = {r: _buckets(units[r][None], self.bits, self.tables)[0] for r in rows.tolist()}
                buckets = np.stack([own[r] for r in rows.tolist()])
            else:
                buckets = _buckets(units[rows], self.bits, self.tables)
            same = buckets[np.searchsorted(rows, a)] == buckets[np.searchsorted(rows, b)]
            first = same.argmax(axis=1) == tab[a]
            a, b = a[first], b[first]
        ends, others = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((node[others], ends))
        ends, others = ends[order], others[order]
        firsts = np.flatnonzero(np.diff(ends, prepend=-1))
        links = np.add.reduceat(copies[others], firsts) if len(ends) else np.empty(0, np.int64)
        tree = _spanning(node, a, b)
        # Rows without counts carry the links that keep larger groups connected.
        nodes = np.concatenate([node[ends[firsts]], node[tree[0]]])
        counts = np.concatenate([links, np.zeros(len(tree[0]), np.int64)])
        other = np.concatenate([np.full(len(firsts), np.iinfo(np.int64).min), node[tree[1]]])
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(other, mask=other == np.iinfo(np.int64).min)],
            names=["node", "links", "other"],
        )


def _spanning(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between rows, as many as keep the same rows connected and no more."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for at, (x, y) in enumerate(zip(node[a].tolist(), node[b].tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(at)
    return a[kept], b[kept]


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    bits: int = BITS,
    tables: int = TABLES,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row per row of ``vectors``.

    ``n_links`` counts the other rows whose cosine is ``cosine`` or more, of those that share a bucket;
    ``component_id`` is the smallest id reachable by links, and ``kept`` marks the rows of that id. Vectors that
    are NULL, zero, empty or hold NULL or non-finite elements link with nothing; vectors of different
    lengths don't link. Repeated rows link with each other. A NULL id names no component.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    context = vectors.sparkSession.sparkContext
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.withColumn(
        "node", F.when(fine & F.exists("vector", lambda x: x != 0), F.xxhash64("vector"))
    )
    # Equal vectors: how many, their smallest id, and one of the vectors.
    nodes = scratch.save(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first("vector").alias("vector")),
        "nodes",
    )
    buckets = scratch.save(
        nodes.select("vector")
        .mapInArrow(lambda batches: _bucket_keys(batches, bits, tables), "bucket long")
        .groupBy("bucket")
        .count()
        .where("count > 1"),
        "buckets",
    )
    shared = context.broadcast(hash_filter(buckets.select("bucket")))
    members = nodes.select("node", "copies", "vector").mapInArrow(
        lambda batches: _members(batches, bits, tables, shared.value), MEMBERS
    )
    # Large buckets in blocks; a row goes to every pair of blocks that its own is part of.
    large = scratch.save(
        buckets.where(F.col("count") > block).select("bucket", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
        "large",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = members.join(large, "bucket", "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "bucket",
        (F.least("block", "with") * blocks + F.greatest("block", "with")).alias("pair"),
        "tab",
        "node",
        "copies",
        "block",
        "vector",
    )
    found = scratch.save(
        dealt.repartition("bucket", "pair")
        .sortWithinPartitions("bucket", "pair")
        .mapInArrow(_Groups(cosine, bits, tables), FOUND),
        "found",
    )
    groups = connected_components(found.where("other is not null"), scratch, "node", "other")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        nodes.drop("vector")
        .join(counts, "node", "left")
        .join(groups, "node", "left")
        .select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
            "low",
        )
    )
    named = scratch.save(named, "named")
    lows = scratch.save(named.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    named = scratch.save(named.join(lows, "component").select("node", "n_links", "component_id"), "answers")
    component = F.coalesce("component_id", "vec_id")
    return (
        rows.select("vec_id", "node")
        .join(named, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
