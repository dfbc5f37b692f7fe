"""Near-duplicate vectors: small-world graphs per shard, every shard queried, links verified and joined to components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..session import materialize
from .frames import batch, chosen
from .graph import components
from .small_world import Graph, levels_of

LEAST = 0.9
#: Recall that the audits of each shard ask for.
RECALL = 0.99
#: Shards at least, and bytes of the components in a shard at most, about, as a search task holds them in double precision.
SHARDS, SHARD_BYTES = 8, 128 << 20
#: Vectors of any shard, by hash, that every shard's audit asks for besides some of its own.
PROBES = 1024
#: Tasks that share the queries of a shard.
SHARES = 4
#: The search works in single precision; pairs this much below the threshold are looked at in double precision too.
MARGIN = 1e-4

_INDEX = "shard bigint, place int, node bigint, copies bigint, vector binary, links array<binary>, beam int"
_NODES = pa.schema([
    ("shard", pa.int64()), ("place", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()),
    ("links", pa.list_(pa.binary())), ("beam", pa.int32()),
])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_links", pa.int64())])


def _matrix(raws: list[bytes]) -> np.ndarray:
    """Stored vectors of one shard: the first byte tells the bytes of a component, the same for all rows of a column."""
    return np.stack([np.frombuffer(r, f"<f{r[0]}", offset=1) for r in raws])


def _unit(vectors: np.ndarray) -> np.ndarray:
    exact = vectors.astype(np.float64)
    # Scaled first, so that squares of very large or small components stay finite.
    exact /= np.abs(exact).max(axis=1, keepdims=True)
    return exact / np.linalg.norm(exact, axis=1, keepdims=True)


def _runs(batches, keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of sorted batches, cut where a key changes."""
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = np.stack([rows[k].to_numpy() for k in keys])
        firsts = np.flatnonzero(np.append(True, (columns[:, 1:] != columns[:, :-1]).any(axis=0)))
        for a, b in zip(firsts, np.append(firsts[1:], rows.num_rows), strict=True):
            yield tuple(columns[:, a].tolist()), rows.slice(a, b - a)


def _built(least: float, recall: float, probes: list[bytes]):
    def done(shard: int, parts: list[pa.RecordBatch]) -> Iterator:
        names = np.concatenate([p["node"].to_numpy() for p in parts])
        copies = np.concatenate([p["copies"].to_numpy() for p in parts])
        raws = [r for p in parts for r in p["vector"].to_pylist()]
        levels = levels_of(names)
        order = np.lexsort((names, -levels))
        names, copies, raws = names[order], copies[order], [raws[i] for i in order]
        graph = Graph.build(_unit(_matrix(raws)).astype(np.float32), levels[order])
        fitting = [p for p in probes if len(p) == len(raws[0])]
        more = _unit(_matrix(fitting)).astype(np.float32) if fitting else None
        beam = graph.audited_beam(least, recall, more=more)
        for a in range(0, len(names), 10_000):
            b = min(a + 10_000, len(names))
            links = [[level[i].astype("<i4").tobytes() for level in graph.links if i < len(level)] for i in range(a, b)]
            yield batch(_NODES, np.full(b - a, shard), np.arange(a, b), names[a:b], copies[a:b], raws[a:b], links, np.full(b - a, beam))

    def run(batches) -> Iterator:
        at, parts = None, []
        for (shard,), rows in _runs(batches, ("shard",)):
            if at is not None and shard != at:
                yield from done(at, parts)
                parts = []
            at = shard
            parts.append(rows)
        if parts:
            yield from done(at, parts)

    return run


def _graph(parts: list[pa.RecordBatch]) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray, int]:
    raws = _matrix([r for p in parts for r in p["vector"].to_pylist()])
    names = np.concatenate([p["node"].to_numpy() for p in parts])
    copies = np.concatenate([p["copies"].to_numpy() for p in parts])
    rows = [x for p in parts for x in p["links"].to_pylist()]
    exact = _unit(raws)
    levels = [np.stack([np.frombuffer(r[k], "<i4") for r in rows if len(r) > k]) for k in range(len(rows[0]))]
    return Graph(exact.astype(np.float32), levels), exact, names, copies, parts[0]["beam"][0].as_py()


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links (a, b) connect, at most one per node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            other = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[label[other]], nodes[other]
        label = new


def _searched(least: float):
    def answer(index, rows: pa.RecordBatch) -> Iterator:
        graph, exact, names, copies, beam = index
        queries = rows["node"].to_numpy()
        vectors = _unit(_matrix(rows["vector"].to_pylist()))
        q, n = graph.within(vectors.astype(np.float32), least - MARGIN, beam)
        cosine = np.concatenate([
            np.einsum("ij,ij->i", vectors[q[a : a + 65536]], exact[n[a : a + 65536]]) for a in range(0, len(q), 65536)
        ] or [np.zeros(0)])
        good = (cosine >= least) & (queries[q] != names[n])
        q, n = q[good], n[good]
        counts = np.bincount(q, weights=copies[n], minlength=len(queries)).astype(np.int64)
        some = np.flatnonzero(counts)
        yield batch(_FOUND, queries[some], pa.nulls(len(some), pa.int64()), counts[some])
        if len(q):
            a, b = _forest(queries[q], names[n])
            yield batch(_FOUND, a, b, pa.nulls(len(a), pa.int64()))

    def run(batches) -> Iterator:
        at, parts, index = None, [], None
        for (shard, share, kind), rows in _runs(batches, ("shard", "share", "kind")):
            if (shard, share) != at:
                at, parts, index = (shard, share), [], None
            if kind == 0:
                parts.append(rows)
            else:
                if index is None:
                    index, parts = _graph(parts), []
                for a in range(0, rows.num_rows, 2048):
                    yield from answer(index, rows.slice(a, 2048))

    return run


def links(vectors: DataFrame, least: float = LEAST, recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding"):
    """Rows with their ``node`` (null if they link with nothing), the nodes, and what the search found.

    Equal vectors are one node. Nodes are dealt to shards by hash, ``SHARDS`` or as many as keep a shard near
    ``SHARD_BYTES``; vectors of different lengths never meet. A shard's graph and the beam that its
    audit asks for are kept as one row per node. Every node is then a query in every shard of its length:
    the rows of a graph come first in a task and the queries stream past it.
    """
    rows = chosen(vectors, vec_id=vec_id, embedding=embedding)
    kind = vectors.schema[embedding].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("__v"))
    finite = F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("__v").isNotNull() & finite & F.exists("__v", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("__v")))
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("__v").alias("__v"), F.count("*").alias("copies"))
    nodes = materialize(nodes, "vectors")
    numbers = nodes.agg(F.sum(F.size("__v").cast("bigint"))).first()[0] or 0
    shards = max(SHARDS, -(-8 * numbers // SHARD_BYTES))
    # The bytes of the floats, so that tasks need no lists of Python numbers.
    shard = F.size("__v") * F.lit(shards).cast("bigint") + F.pmod("node", F.lit(shards))
    nodes = nodes.withColumn("shard", shard).mapInArrow(_packed(4 if single else 8), "node bigint, copies bigint, vector binary, length int, shard bigint")
    probes = [bytes(r["vector"]) for r in nodes.orderBy(F.xxhash64("node")).limit(PROBES).select("vector").collect()]
    dealt = nodes.repartition("shard").sortWithinPartitions("shard", "node")
    index = materialize(dealt.select("shard", "node", "copies", "vector").mapInArrow(_built(least, recall, probes), _INDEX), "small-worlds")
    share = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    one = index.select("shard", share.alias("share"), F.lit(0).alias("kind"), "place", "node", "copies", "vector", "links", "beam")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    two = index.withColumn("__first", F.floor(F.col("shard") / shards) * shards).withColumn("__k", every).select(
        (F.col("__first") + F.col("__k")).alias("shard"), F.pmod(F.xxhash64("node"), F.lit(SHARES)).cast("int").alias("share"),
        F.lit(1).alias("kind"), "place", "node", "copies", "vector",
        F.lit(None).cast("array<binary>").alias("links"), F.lit(None).cast("int").alias("beam"),
    )
    # A length may lack some shards: its queries find no graph there.
    two = two.join(index.select("shard").distinct(), "shard", "left_semi").select(one.columns)
    together = one.union(two).repartition("shard", "share").sortWithinPartitions("shard", "share", "kind", "place")
    found = materialize(together.mapInArrow(_searched(least), "a bigint, b bigint, n_links bigint"), "vector-links")
    return rows.drop("__v"), nodes, found


def _packed(width: int):
    """Vectors as bytes in the precision of their column, so that searches, hashes and cosines lose nothing."""
    schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()), ("length", pa.int32()), ("shard", pa.int64())])
    mark = bytes([width])

    def run(batches) -> Iterator:
        for rows in batches:
            lists = rows["__v"]
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), f"<f{width}")
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            raw = [mark + values[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
            yield batch(schema, rows["node"], rows["copies"], raw, np.diff(lists.offsets.to_numpy()), rows["shard"])

    return run


def near_duplicates(
    vectors: DataFrame, least: float = LEAST, recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Each row's ``n_links``, ``component_id`` and ``kept``: whether it is its component's smallest id.

    Vectors that are null, zero or have null or non-finite components link with nothing. Equal vectors link.
    Rows with a null id are linked as others, but name no component unless all its rows have none; they are not kept
    if there is another. An empty table gives none.
    """
    rows, nodes, found = links(vectors, least, recall, vec_id, embedding)
    counts = found.where("n_links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("__n"))
    labels = components(found.where("b IS NOT NULL"))
    about = nodes.select("node", "copies").join(counts, "node", "left").join(labels, "node", "left")
    about = about.select(
        "node", (F.coalesce("__n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("__class")
    )
    joined = rows.join(about, "node", "left")
    least_id = joined.where("__class IS NOT NULL").groupBy("__class").agg(F.min("vec_id").alias("__least"))
    joined = joined.join(least_id, "__class", "left")
    component = F.when(F.col("__class").isNull(), F.col("vec_id")).otherwise(F.col("__least"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
