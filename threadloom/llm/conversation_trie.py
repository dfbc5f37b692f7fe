"""The prefix trie of conversations, with sums over its subtrees by depth bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import number_rows
from ..session import materialize
from .frames import batch, chosen

#: Depths of a band. A node is exploded to this many ancestors at most.
BAND = 8
#: Rows of one conversation whose running sums are taken in one window.
BLOCK = 64
#: Ids in one piece of a list of members.
PAGE = 2048
#: The conversations of one stem share its first turns.
STEM = 100
HEADS = 6

NODE = ["k1", "k2"]
_PAGES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("least", pa.int64()), ("ids", pa.binary())])
_ENDS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def positions(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` from 1, two 64-bit hashes of role and text, and the text's code points.

    Turns are in order of ``turn``, nulls first; equal ones by role and then text. A null role or text is empty.
    Rows with a null ``conv_id`` belong to no conversation and are left out. One conversation may hold any share of the rows.
    """
    rows = chosen(conversations, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id is not null")
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("id", F.monotonically_increasing_id())  # rows equal in all else spread over tasks too
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("id")]
    kept = ["conv_id", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("2"), "text", "role").alias("h2"), F.length("text").alias("points")]
    return number_rows(rows, ["conv_id"], order, kept=kept)


def regrafted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: the rows, and ``conv_id`` with its ``length`` in turns.

    Conversation c takes the first h turns of c - c % 100 and then its own after its first h; h is crc32(c) % 6.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("__n"))
    head = F.crc32(F.col("conv_id").cast("string")) % HEADS
    own = own.select("conv_id", "__n", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % STEM).alias("stem"))
    stems = own.select(F.col("conv_id").alias("stem"), F.col("__n").alias("__stem"))
    convs = own.join(stems, "stem", "left").select(
        "conv_id", "stem", "head", F.least("head", F.coalesce("__stem", F.lit(0))).alias("taken"), "__n"
    )
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("__n") - F.col("head"), F.lit(0))).drop("__n")
    convs = materialize(convs, "trie-conversations")
    heads = turns.where(F.col("position") < HEADS).withColumnRenamed("conv_id", "stem")
    heads = heads.join(convs, "stem").where(F.col("position") <= F.col("taken"))
    rest = turns.where(F.col("position") > F.crc32(F.col("conv_id").cast("string")) % HEADS).join(convs, "conv_id")
    rest = rest.withColumn("position", F.col("position") - F.col("head") + F.col("taken"))
    columns = ["conv_id", "position", "h1", "h2", "points", (F.col("position") == F.col("length")).alias("last")]
    return heads.select(*columns).union(rest.select(*columns)), convs.select("conv_id", "length")


def _running(rows: DataFrame, place: str) -> DataFrame:
    """``k1`` and ``k2`` made running sums (exclusive or) within each conversation, in the order of ``place`` from 0.

    Sums within blocks, then in the same way over the blocks' sums, so no window holds a whole long conversation.
    """
    block = F.floor(F.col(place) / BLOCK).cast("bigint")
    rows = rows.withColumn("__block", block)
    within = Window.partitionBy("conv_id", "__block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({k: F.bit_xor(k).over(within) for k in NODE})
    rows = materialize(rows, "trie-running")
    if not rows.where("__block > 0").limit(1).count():
        return rows.drop("__block")
    last = Window.partitionBy("conv_id", "__block").orderBy(F.col(place).desc())
    sums = rows.withColumn("__r", F.row_number().over(last)).where("__r = 1").select("conv_id", F.col("__block").alias("__at"), *NODE)
    before = _running(sums, "__at").select("conv_id", (F.col("__at") + 1).alias("__block"), F.col("k1").alias("__b1"), F.col("k2").alias("__b2"))
    return rows.join(before, ["conv_id", "__block"], "left").drop("__block").withColumns(
        {k: F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0))) for k, b in (("k1", "__b1"), ("k2", "__b2"))}
    ).drop("__b1", "__b2")


def prefixes(rows: DataFrame) -> DataFrame:
    """A row for each prefix of each conversation: ``depth``, its key ``k1``, ``k2``, and its parent's ``p1``, ``p2``.

    A prefix's key is the exclusive or of 128-bit hashes of its turns, each hashed with its position.
    """
    place = (F.col("position") - 1).alias("__place")
    z = {"k1": F.xxhash64("position", "h1", "h2"), "k2": F.xxhash64("h2", F.lit("2"), "position", "h1")}
    rows = rows.select("conv_id", F.col("position").alias("depth"), place, "points", "last", *[c.alias(k) for k, c in z.items()], *[c.alias(f"__z{k}") for k, c in z.items()])
    rows = _running(rows, "__place")
    return rows.select("conv_id", "depth", "points", "last", *NODE, F.col("k1").bitwiseXOR(F.col("__zk1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("__zk2")).alias("p2"))


def _root() -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2"))


def _paths(rows: DataFrame, step: int) -> DataFrame:
    """For the nodes at depths that ``step`` divides: those on the way to each within its band, itself included."""
    band = F.floor(F.col("depth") / (step * BAND)).cast("bigint")
    within = Window.partitionBy("conv_id", "__band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.where(F.col("depth") % step == 0).withColumn("__band", band)
    path = F.collect_list(F.struct(*NODE)).over(within)
    path = F.when(F.col("__band") == 0, F.concat(F.array(_root()), path)).otherwise(path)
    return rows.select("depth", *NODE, path.alias("path")).groupBy("depth", *NODE).agg(F.first("path").alias("path"))


def _summed(rows: DataFrame, values: DataFrame, sums: list[str], deepest: int, step: int = 1) -> DataFrame:
    """Sums over the subtree of every node whose depth ``step`` divides; ``values`` has them for the nodes alone.

    Nodes are exploded to their ancestors within a band of ``BAND`` such depths. The bands' first nodes are then a tree ``BAND`` times
    less deep, which is summed in the same way; their totals go to the ancestors in the band above.
    """
    paths = materialize(_paths(rows, step), "trie-paths")
    top = values.join(paths, NODE, "left").select(F.coalesce("path", F.array(_root())).alias("path"), *sums)
    add = [F.sum(c).alias(c) for c in sums]

    def up(frame: DataFrame) -> DataFrame:
        return frame.select(F.explode("path").alias("__to"), *sums).groupBy("__to.k1", "__to.k2").agg(*add)

    inside = materialize(up(top), "trie-sums")
    if deepest < step * BAND:
        return inside
    wide = step * BAND
    firsts = inside.join(rows.where(F.col("depth") % wide == 0).select(*NODE), NODE, "left_semi")
    totals = _summed(rows, firsts.union(inside.where("k1 = 0 and k2 = 0")), sums, deepest, wide)
    # The last node of the band above, on the way to a band's first node.
    above = _above(rows, step)
    down = totals.join(above, NODE).join(paths.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "path"), ["a1", "a2"])
    return materialize(inside.union(up(down)).groupBy(*NODE).agg(*add), "trie-sums")


def _above(rows: DataFrame, step: int) -> DataFrame:
    """For each first node of a band but the root: the node ``step`` depths above, ``a1`` and ``a2``."""
    wide = step * BAND
    if step == 1:
        return rows.where(F.col("depth") % wide == 0).select(*NODE, F.col("p1").alias("a1"), F.col("p2").alias("a2")).distinct()
    lower = rows.where(F.col("depth") % wide == 0).select("conv_id", "depth", *NODE)
    upper = rows.where(F.col("depth") % wide == wide - step).select("conv_id", (F.col("depth") + step).alias("depth"), F.col("k1").alias("a1"), F.col("k2").alias("a2"))
    return lower.join(upper, ["conv_id", "depth"]).select(*NODE, "a1", "a2").distinct()


def _pages(batches) -> Iterator:
    """Ids in order, joined by commas, in pieces of ``PAGE``; a piece carries its least id."""
    for rows in batches:
        k1, k2, ids = (rows[n].to_numpy() for n in ("k1", "k2", "conv_id"))
        new = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        firsts = [s for a, b in zip(new.tolist(), [*new[1:].tolist(), len(ids)], strict=True) for s in range(a, b, PAGE)]
        texts = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(firsts, [*firsts[1:], len(ids)], strict=True)]
        yield batch(_PAGES, k1[firsts], k2[firsts], ids[firsts], texts)


def _hashed(batches) -> Iterator:
    """One digest a node, over its pieces one after another: what is held is one state."""
    key, state = None, None
    for rows in batches:
        out = []
        for k1, k2, ids in zip(rows["k1"].to_pylist(), rows["k2"].to_pylist(), rows["ids"], strict=True):
            if (k1, k2) != key:
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        if out:
            yield batch(_ENDS, *zip(*out, strict=True))
    if state:
        yield batch(_ENDS, [key[0]], [key[1]], [state.hexdigest()])


def _ends(members: DataFrame) -> DataFrame:
    """``ends_sha256`` of the ids that end at each node.

    The lists are written in pieces by all tasks; only the bytes of one list's pieces pass one after another, as SHA-256 asks.
    """
    # A node may hold most of the ids, so they are dealt by id too.
    slices = members.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pages = slices.mapInArrow(_pages, "k1 bigint, k2 bigint, least bigint, ids binary")
    return pages.repartition(*NODE).sortWithinPartitions(*NODE, "least").mapInArrow(_hashed, "k1 bigint, k2 bigint, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations, with its members and the sums over its subtree.

    ``rows`` has ``conv_id``, ``position``, ``h1``, ``h2``, ``points`` and ``last`` for every turn, ``convs`` every ``conv_id`` and
    its ``length``, so that those without a turn count as members of the root. ``conv_id`` is the smallest member;
    ``n_leaves`` and ``saved_tokens`` are sums over the subtree. No conversation gives no row, not even a root.
    """
    rows = materialize(prefixes(rows), "trie-prefixes")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    nodes = rows.groupBy("depth", *NODE, "p1", "p2", "points").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"), F.lit(0).alias("points"), "n_convs", "conv_id")
    nodes = materialize(nodes.unionByName(root), "trie-nodes")

    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    values = nodes.select(*NODE, (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved_tokens"))
    sums = _summed(rows, values, ["n_leaves", "saved_tokens"], deepest)

    members = rows.where("last").select(*NODE, "conv_id").union(convs.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, NODE).join(_ends(members), NODE, "left").join(parents, ["p1", "p2"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def sql(table: str = "conversations") -> str:
    """The rows of ``trie`` over ``regrafted`` turns in DuckDB's SQL, CRC-32 by its table of 256 remainders."""
    return f"""
WITH RECURSIVE bits(i, v, k) AS (
    SELECT CAST(i AS BIGINT), CAST(i AS BIGINT), 0 FROM range(256) AS t(i)
    UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT conv_id AS c FROM {table} WHERE conv_id IS NOT NULL),
hs AS (SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {HEADS} AS h FROM ids, tab),
own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
    FROM {table} WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n FROM own GROUP BY 1),
turns AS (
    SELECT hs.c, o.p AS d, o.role, o.text FROM hs JOIN own o ON o.c = hs.c - hs.c % {STEM} AND o.p <= hs.h
    UNION ALL SELECT hs.c, o.p - hs.h + least(hs.h, coalesce(n.n, 0)), o.role, o.text
    FROM hs JOIN own o ON o.c = hs.c AND o.p > hs.h LEFT JOIN n ON n.c = hs.c - hs.c % {STEM}),
pre AS (SELECT c, d, length(text) AS points, string_agg(CAST(length(role) AS VARCHAR) || ':' || role || CAST(length(text) AS VARCHAR) || ':' || text, '')
      OVER (PARTITION BY c ORDER BY d) AS k FROM turns),
members AS (
    SELECT c, 0 AS d, '' AS k, '' AS pk, 0 AS points FROM ids
    UNION ALL SELECT c, d, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY d), ''), points FROM pre),
nodes AS (SELECT d, k, min(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, min(points) AS points FROM members GROUP BY d, k),
kids AS (SELECT pk AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
lens AS (SELECT c, max(d) AS d FROM members GROUP BY 1),
ends AS (SELECT m.k, sha256(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c)) AS e FROM members m JOIN lens l ON m.c = l.c AND m.d = l.d GROUP BY 1),
sums AS (
    SELECT m.k, sum(CASE WHEN q.n_children IS NULL THEN 1 ELSE 0 END) AS leaves, sum((b.n_convs - 1) * b.points) AS saved
    FROM nodes b LEFT JOIN kids q ON q.k = b.k JOIN members m ON m.c = b.conv_id AND m.d <= b.d GROUP BY 1)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(q.n_children, 0) AS n_children,
    CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.e, sha256('')) AS ends_sha256
FROM nodes a JOIN sums s ON s.k = a.k LEFT JOIN kids q ON q.k = a.k LEFT JOIN ends e ON e.k = a.k LEFT JOIN nodes p ON a.d > 0 AND p.k = a.pk"""
