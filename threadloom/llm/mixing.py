"""Mixing of sources to target weights by pivotal rounding of copy numbers."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .frames import chosen

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one task rounds by itself, about; also the fan-in of the tree above.
LEAF = 10_000
FAN_IN = 64
_TAKEN = "__row bigint, doc_id bigint, size bigint, __s bigint, share double, whole bigint, part bigint, open boolean"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``target`` of each source, given ``source`` and ``source_size``, one row per source.

    Sources in order of their code points, null last, have the weights in turn. All
    targets together are all sizes. A target is lambda times the weight, or
    ``most`` times the source's size if that is less. Sources reach their limit in the
    order of limit / weight, so lambda is the first quotient of what is left by the
    weight that is left which stays under the next limit. Two windows over one row per source.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("__w", weight).withColumn("__full", limit)
    order = Window.orderBy(F.col("__full") / F.col("__w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumn("__left", F.sum("source_size").over(every) - F.coalesce(F.sum("__full").over(before), F.lit(0.0)))
    rows = rows.withColumn("__weight", F.sum("__w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("__lambda", F.col("__left") / F.col("__weight"))
    under = F.col("__lambda") * F.col("__w") <= F.col("__full")
    level = F.min(F.when(under, F.struct(F.col("__full") / F.col("__w"), F.col("__lambda")))).over(every)
    target = F.least(level.getField("__lambda") * F.col("__w"), F.col("__full"))
    return rows.select("source", "source_size", F.coalesce(target, F.col("__full")).alias("target"))


def _draw(seed: int, *ids: int) -> float:
    """A number in [0, 1) that depends on its arguments alone."""
    raw = hashlib.blake2b(repr((seed, ids)).encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little") / 2.0**64


def pivot(rows: list[tuple[int, int, float]], seed: int) -> tuple[list[tuple[int, int]], tuple[int, int, float] | None]:
    """Round fractional copies (row, size, share) until at most one is left open.

    Two rows exchange words: one's share goes up as the other's goes down, so that
    size * share keeps its sum. The two ways until a share gets to 0 or 1 are
    taken with the odds that keep each expected share. Gives the rounded rows, and the open one.
    """
    done: list[tuple[int, int]] = []
    held = None
    for row, size, share in rows:
        if share <= 0 or share >= 1 or not size:
            done.append((row, int(share >= 1)))
            continue
        if held is None:
            held = (row, size, share)
            continue
        a, n, p = held
        b, m, q = row, size, share
        up = min((1 - p) * n, q * m)  # words from b to a
        down = min(p * n, (1 - q) * m)
        move = up if _draw(seed, a, b) * (up + down) < down else -down
        to_end = move == up
        p, q = p + move / n, q - move / m
        # The share that set the limit is exactly integral, whatever the rounding of floats.
        if to_end:
            a_ends, b_ends = (1 - held[2]) * n <= up, share * m <= up
            p, q = (1.0 if a_ends else p), (0.0 if b_ends else q)
        else:
            a_ends, b_ends = held[2] * n <= down, (1 - share) * m <= down
            p, q = (0.0 if a_ends else p), (1.0 if b_ends else q)
        held = None
        for key, words, value, ended in ((a, n, p, a_ends), (b, m, q, b_ends)):
            if ended or not 0 < value < 1:
                done.append((key, int(value >= 0.5)))
            else:
                held = (key, words, value)
    return done, held


def _round(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "__row"], ascending=[False, True])
        done, held = pivot(list(zip(pdf["__row"].tolist(), pdf["size"].tolist(), pdf["share"].tolist(), strict=True)), seed)
        whole = dict(done)
        pdf["open"] = ~pdf["__row"].isin(whole)
        pdf["whole"] = pdf["whole"] + pdf["__row"].map(whole).fillna(0).astype("int64")
        if held is not None:
            # What is left of the source's last document has no partner: at the root it is taken in part.
            at = pdf["__row"] == held[0]
            pdf.loc[at, "share"] = held[2]
            if last:
                pdf.loc[at, "part"] = round(held[1] * held[2])
                pdf["open"] = False
        return pdf[[c.split()[0] for c in _TAKEN.split(", ")]]

    return run


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """How many words the mix takes of each document: ``whole`` copies, and ``part`` words of one more.

    A source's documents have target / source_size copies each in the mean: the
    integral copies are sure, the fraction is rounded by pivots. Leaves of about ``LEAF`` rows,
    chosen by a hash of the row, are rounded by themselves and leave one open row at most;
    open rows meet ``FAN_IN`` at a time in a tree until one per source is left. So the words taken of a
    source are its target but for half a word, and no group outgrows a task, whatever
    share of the rows one source has. Reruns agree, as each choice depends on the rows alone.

    Null texts have no words and are taken zero times; a null source is a source; a
    null ``doc_id`` and repeated rows are rows of their own. An empty table gives none.
    """
    rows = chosen(docs, doc_id=doc_id, text=text, source=source)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))
    # Rows that are the same in all three are told apart by their number among themselves.
    rows = materialize(rows, "mixing-sizes")
    sums = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__n")).drop("__n"), weights, most)
    stats = rows.groupBy("source").agg(F.count("*").alias("__n"))
    sums = materialize(
        sums.join(stats, sums["source"].eqNullSafe(stats["source"])).select(
            sums["source"], "source_size", "target", "__n", F.xxhash64(sums["source"], F.lit(seed)).alias("__s")
        ),
        "mixing-targets",
    )
    twins = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("__k"))
    rows = twins.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), "__k")).alias("__k"))
    rows = rows.withColumn("__row", F.xxhash64("doc_id", "source", "size", "__k"))
    copies = F.col("target") / F.col("source_size")
    joined = rows.join(sums, rows["source"].eqNullSafe(sums["source"])).select(
        "__row", "doc_id", "size", "__s", sums["source"], "source_size", "target", "__n",
        F.when(F.col("source_size") > 0, copies).otherwise(0.0).alias("__c"),
    )
    leaves = F.ceil(F.col("__n") / LEAF)
    start = joined.select(
        "__row", "doc_id", "size", "__s", (F.col("__c") - F.floor("__c")).alias("share"),
        F.floor("__c").alias("whole"), F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("open"),
        leaves.alias("__leaves"), F.pmod(F.xxhash64(F.lit(seed), "__row"), leaves).alias("__leaf"),
    )
    most_leaves = sums.agg(F.ceil(F.max("__n") / LEAF)).first()[0] or 1
    parts: list[DataFrame] = []
    level, width = start.drop("__leaves"), int(most_leaves)
    while True:
        last = width <= 1
        rounded = level.groupBy("__s", "__leaf").applyInPandas(_round(seed, last), _TAKEN)
        rounded = materialize(rounded, "mixing-level")
        parts.append(rounded.where(~F.col("open")))
        if last:
            break
        width = -(-width // FAN_IN)
        level = rounded.where("open").withColumn("__leaf", F.pmod(F.xxhash64(F.lit(width), "__row"), F.lit(width)))
    taken = parts[0]
    for more in parts[1:]:
        taken = taken.unionByName(more)
    return taken.join(sums, "__s").select(
        "doc_id", "source", "size", "source_size", "target", "whole", "part",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
    )


def take(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken, and the one cut row per source.

    A null source is a source of its own. A null or empty text has no words and is not taken. Null ids and repeated rows are
    taken each by its own share. An empty table gives no row.
    """
    columns = docs.columns
    flat = docs.toDF(*[f"__c{i}" for i in range(len(columns))])
    at = {name: f"__c{columns.index(column)}" for name, column in (("doc_id", doc_id), ("text", text), ("source", source))}
    keys = [F.col(at["doc_id"]).cast("bigint"), F.col(at["source"]), word_count(F.col(at["text"]))]
    flat = flat.withColumn("__key", F.xxhash64(*keys))
    plan = mix(docs, weights, most, seed, doc_id, text, source)
    # Rows that agree in id, source and size share their copies: the first has them all, in the order of their content.
    plan = plan.select(F.xxhash64("doc_id", "source", "size").alias("__key"), "whole", "part")
    order = Window.partitionBy("__key").orderBy(F.desc("whole"), F.desc("part"))
    plan = plan.withColumn("__k", F.row_number().over(order))
    order = Window.partitionBy("__key").orderBy(*[F.col(c) for c in flat.columns if c != "__key"])
    flat = flat.withColumn("__k", F.row_number().over(order))
    joined = flat.join(plan, ["__key", "__k"])
    words = F.col(at["text"])
    whole = F.array_repeat(F.lit(False), F.col("whole").cast("int"))
    part = F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    out = joined.withColumn("__cut", F.explode(F.concat(whole, part)))
    first = F.slice(F.regexp_extract_all(words, F.lit(f"({WORD})"), F.lit(1)), 1, F.greatest("part", F.lit(1)).cast("int"))
    out = out.withColumn(at["text"], F.when(F.col("__cut"), F.array_join(first, " ")).otherwise(words))
    return out.select(*[f"__c{i}" for i in range(len(columns))]).toDF(*columns)
