"""Comment threads: depth, order, limits, orphans and tree output."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import bare_id
from ..session import materialize
from .ranking import keep_first, number_rows, top_per_group


def thread_depth(comments: DataFrame, with_path: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Depth, top-level ancestor and path of every comment.

    Input: ``link_id, reddit_id, parent_id, ord``; ``ord`` is the input order.
    Every comment holds a chain of known ancestors and the id that chain hangs
    on. One round joins each open comment with the comment its chain hangs on
    and takes over that chain, so chains double in length: a thread of depth d
    takes log2(d) + 1 rounds, and a finished comment is never written again.

    ``reached`` is false for comments without a path to the submission: their
    parent is missing, or the links form a cycle. ``with_path=False`` keeps
    every row small, whatever the depth.
    """
    spark = comments.sparkSession
    step = F.struct(F.col("ord").cast("bigint").alias("ord"), F.col("reddit_id").alias("id"))
    nodes = comments.select(
        bare_id("link_id").alias("link"),
        F.col("reddit_id").alias("id"),
        bare_id("parent_id").alias("up"),
        F.lit(0).cast("bigint").alias("depth"),
        F.col("reddit_id").alias("root"),
        *([F.array(step).alias("path")] if with_path else []),
        F.col("ord").cast("bigint").alias("ord"),
        *carry,
    ).withColumn("state", F.when(F.col("up") == F.col("link"), "reached").otherwise("open"))

    # One row per id: a repeated id would multiply the rows below it.
    nodes = keep_first(nodes, ["link", "id"], [F.asc("ord"), F.asc("up")])
    current = materialize(nodes, "thread-round")
    finished: list[DataFrame] = []
    total, still_open, before = current.count(), current.where("state = 'open'").count(), -1
    # Every round finishes some comment unless only cycles are left.
    while still_open and still_open != before:
        finished.append(current.where("state <> 'open'"))
        known = current
        for part in finished[:-1]:
            known = known.unionByName(part)
        current = materialize(_take_over(current.where("state = 'open'"), known, with_path, carry, 2 * still_open < total), "thread-round")
        before, still_open = still_open, current.where("state = 'open'").count()

    result = current
    for part in finished:
        result = result.unionByName(part)
    reached = F.col("state") == "reached"
    return result.select(
        "link",
        "id",
        F.when(reached, F.col("depth")).alias("depth"),
        F.when(reached, F.col("root")).alias("root_comment_id"),
        *([F.when(reached, F.col("path")).alias("path")] if with_path else []),
        "ord",
        reached.alias("reached"),
        *carry,
    )


def _take_over(open_rows: DataFrame, known: DataFrame, with_path: bool, carry: Sequence[str], few: bool) -> DataFrame:
    """One doubling round. ``known`` is unique on (link, id), so no row multiplies;
    where many comments hang on one id, adaptive execution splits that side. With ``few``
    open rows, ``known`` is cut to what they point at first."""
    upper = known.select(
        "link",
        F.col("id").alias("up"),
        F.col("up").alias("next_up"),
        F.col("depth").alias("upper_depth"),
        F.col("root").alias("upper_root"),
        F.col("state").alias("upper_state"),
        *([F.col("path").alias("upper_path")] if with_path else []),
    )
    if few:
        upper = upper.join(open_rows.select("link", "up").distinct(), ["link", "up"], "left_semi")
    found = F.col("upper_state").isNotNull()
    joined = open_rows.join(upper, ["link", "up"], "left")
    return joined.select(
        "link",
        "id",
        F.when(found, F.col("next_up")).otherwise(F.col("up")).alias("up"),
        F.when(found, F.col("depth") + F.col("upper_depth") + 1).otherwise(F.col("depth")).alias("depth"),
        F.when(found, F.col("upper_root")).otherwise(F.col("root")).alias("root"),
        *(
            [F.when(found, F.concat("upper_path", "path")).otherwise(F.col("path")).alias("path")]
            if with_path
            else []
        ),
        "ord",
        *carry,
        F.coalesce("upper_state", F.lit("orphan")).alias("state"),
    )


def path_ids(path: Column | str = "path", separator: str = "/") -> Column:
    return F.array_join(F.transform(path, lambda s: s["id"]), separator)


def thread_orphans(threads: DataFrame) -> DataFrame:
    """Comments with no path to their submission."""
    return threads.where(~F.col("reached"))


def thread_raw_order(threads: DataFrame) -> DataFrame:
    """The flat list in level order, with its position in the thread."""
    order = [F.asc("depth"), F.asc("ord"), F.asc("id")]
    return number_rows(threads.where("reached"), ["link"], order)


def thread_limit(threads: DataFrame, n: int, style: str = "structured") -> DataFrame:
    """``n`` comments (raw) or ``n`` top-level comments with all replies; 0 is all."""
    reached = threads.where("reached")
    if n == 0:
        return reached
    if style == "raw":
        return top_per_group(reached, ["link"], [F.asc("depth"), F.asc("ord"), F.asc("id")], n)
    roots = top_per_group(reached.where("depth = 0"), ["link"], [F.asc("ord"), F.asc("id")], n)
    kept = roots.select("link", F.col("id").alias("root_comment_id"))
    return reached.join(kept, ["link", "root_comment_id"], "left_semi")


def thread_tour(comments: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Reached comments with their place in a walk through the thread, as longs.

    Input as for ``thread_depth``. The walk opens a comment, walks its replies by
    ``ord`` and id, and closes it: ``enter`` and ``leave`` count the steps of
    its thread before either. So ``enter`` is reading order, the replies of a
    comment lie between its two steps, and ``size`` is their number and itself.
    ``first`` is true for the eldest of its siblings.

    Every step knows the next one, and ranks come by pointer jumping: a
    round adds the steps up to the one pointed at and takes over its pointer, so n
    steps take log2(n) + 1 equi-joins of rows of a fixed size, whatever the
    depth. Comments without a path to the submission have no place and are left out.
    """
    nodes = comments.select(
        bare_id("link_id").alias("link"),
        F.col("reddit_id").alias("id"),
        bare_id("parent_id").alias("up"),
        F.col("ord").cast("bigint").alias("ord"),
        *carry,
    )
    nodes = keep_first(nodes, ["link", "id"], [F.asc("ord"), F.asc("up")])
    # One comment may have most replies, so siblings are numbered without a window over them.
    nodes = materialize(number_rows(nodes, ["link", "up"], [F.asc("ord"), F.asc("id")], "place"), "tour-comments")
    # A comment may have the id of its submission, whose replies are not its own.
    eldest = nodes.where("place = 1 and up <> link").select("link", F.col("up").alias("id"), F.col("id").alias("to"))
    younger = nodes.select("link", "up", (F.col("place") - 1).alias("place"), F.col("id").alias("to"))
    opening = nodes.select("link", "id").join(eldest, ["link", "id"], "left").select(
        "link", "id", F.lit(False).alias("closes"), F.coalesce("to", "id").alias("to"), F.col("to").isNull().alias("to_closes"), F.lit(False).alias("ends")
    )
    closing = nodes.select("link", "id", "up", "place").join(younger, ["link", "up", "place"], "left").select(
        "link", "id", F.lit(True).alias("closes"), F.coalesce("to", "up").alias("to"), F.col("to").isNull().alias("to_closes"),
        (F.col("to").isNull() & (F.col("up") == F.col("link"))).alias("ends"),
    )
    steps = opening.union(closing).select(
        "link", "id", "closes", "to", "to_closes",
        F.lit(1).cast("bigint").alias("steps"),
        F.when(F.col("closes"), -1).otherwise(1).cast("bigint").alias("rise"),
        F.when(F.col("ends"), "done").otherwise("open").alias("state"),
    )
    current = materialize(steps, "tour-round")
    finished: list[DataFrame] = []
    still_open, before = current.where("state = 'open'").count(), -1
    # Every round finishes some step unless only cycles are left.
    while still_open and still_open != before:
        finished.append(current.where("state <> 'open'"))
        known = current
        for part in finished[:-1]:
            known = known.unionByName(part)
        current = materialize(_jumped(current.where("state = 'open'"), known), "tour-round")
        before, still_open = still_open, current.where("state = 'open'").count()
    ranked = current
    for part in finished:
        ranked = ranked.unionByName(part)
    ranked = ranked.where("state = 'done'").select("link", "id", "closes", "steps", "rise")
    total = ranked.groupBy("link").agg(F.max("steps").alias("total"))
    left = ranked.where("closes").select("link", "id", F.col("steps").alias("after"))
    placed = ranked.where("not closes").join(left, ["link", "id"]).join(total, "link")
    return placed.join(nodes, ["link", "id"]).select(
        "link", "id", "up", "ord", (-F.col("rise")).alias("depth"), (F.col("total") - F.col("steps")).alias("enter"),
        (F.col("total") - F.col("after")).alias("leave"), ((F.col("steps") - F.col("after") + 1) / 2).cast("bigint").alias("size"),
        (F.col("place") == 1).alias("first"), *carry,
    )


def _jumped(open_steps: DataFrame, known: DataFrame) -> DataFrame:
    """One round: every open step takes over the count and the pointer of the step it points at."""
    target = known.select(
        "link", F.col("id").alias("to"), F.col("closes").alias("to_closes"), F.col("to").alias("next"), F.col("to_closes").alias("next_closes"),
        F.col("steps").alias("more"), F.col("rise").alias("rises"), F.col("state").alias("found"),
    )
    pointed = open_steps.select("link", "to", "to_closes").distinct()
    target = target.join(pointed, ["link", "to", "to_closes"], "left_semi")
    joined = open_steps.join(target, ["link", "to", "to_closes"], "left")
    return joined.select(
        "link", "id", "closes", F.coalesce("next", "to").alias("to"), F.coalesce("next_closes", "to_closes").alias("to_closes"),
        (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), (F.col("rise") + F.coalesce("rises", F.lit(0))).alias("rise"),
        F.coalesce("found", F.lit("lost")).alias("state"),
    )


def tree_fragments(comments: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Nested reply JSON of every thread, as fragments in reading order.

    Joining the fragments of a link by ``at``, from 0 without a gap, gives one JSON array of comments
    with nested ``replies``. A comment gives an opening and a closing fragment,
    so a thread of any size stays spread over rows and tasks, and a fragment's
    place is one long.
    """
    tour = materialize(thread_tour(comments, [f for f in fields if f not in ("link", "id", "up", "ord", "depth")]), "tour")
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    opening = F.concat(F.when(F.col("first"), "").otherwise(","), F.substr(record, F.lit(1), F.length(record) - 1), F.lit(',"replies":['))
    inner = tour.select(
        "link",
        F.inline(
            F.array(
                F.struct((F.col("enter") + 1).alias("at"), opening.alias("fragment")),
                F.struct((F.col("leave") + 1).alias("at"), F.lit("]}").alias("fragment")),
            )
        ),
    )
    lengths = tour.groupBy("link").agg((F.max("leave") + 2).alias("end"))
    links = comments.select(bare_id("link_id").alias("link")).distinct().join(lengths, "link", "left")
    frame = links.select(
        "link",
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("[").alias("fragment")),
                F.struct(F.coalesce("end", F.lit(1)).cast("bigint").alias("at"), F.lit("]").alias("fragment")),
            )
        ),
    )
    return inner.unionByName(frame)


def thread_tree_json(comments: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Tree fragments with their line number in the document of the thread."""
    return tree_fragments(comments, fields).select("link", (F.col("at") + 1).alias("line_no"), "fragment")


def flatten_nested(
    docs: DataFrame, comments: str = "comments", levels_per_pass: int = 8, take: Callable[[Column], Column] | None = None
) -> DataFrame:
    """All comments of nested comment documents, with their depth.

    ``comments`` is an array of VARIANT. One pass unfolds several levels inside
    the row, without a shuffle; a further pass runs only over what is left of
    deeper documents. ``take`` picks what ``comment`` holds, so that a row need not
    carry the replies below it.
    """
    keys = [c for c in docs.columns if c != comments]
    frontier = docs.withColumnRenamed(comments, "__level")
    base, parts = 0, []
    names = [f"__level_{i}" for i in range(levels_per_pass + 1)]
    while True:
        unfolded = frontier.withColumnRenamed("__level", names[0])
        for above, below in zip(names, names[1:]):
            unfolded = unfolded.withColumn(below, _replies_of(F.col(above)))
        tagged = [_with_depth(F.col(n), base + i, take) for i, n in enumerate(names[:-1])]
        parts.append(unfolded.select(*keys, F.inline(F.concat(*tagged))))
        rest = unfolded.where(F.size(names[-1]) > 0).select(*keys, F.col(names[-1]).alias("__level"))
        rest = materialize(rest, "deeper")
        if rest.isEmpty():
            break
        frontier, base = rest, base + levels_per_pass
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _with_depth(level: Column, depth: int, take: Callable[[Column], Column] | None) -> Column:
    return F.transform(level, lambda c: F.struct(F.lit(depth).alias("depth"), (take(c) if take else c).alias("comment")))


def _replies_of(level: Column) -> Column:
    replies = F.transform(
        level,
        lambda c: F.coalesce(
            F.try_variant_get(c, "$.replies", "array<variant>"), F.array().cast("array<variant>")
        ),
    )
    return F.flatten(replies)


def thread_posts(submissions: DataFrame, comments: DataFrame, threads: DataFrame) -> DataFrame:
    """Submission and reached comments as one list of posts; the submission has depth 0."""
    roots = submissions.select(
        F.concat(F.lit("t3_"), "reddit_id").alias("post_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).cast("bigint").alias("depth"),
        "author",
        "created_utc",
        F.col("selftext").alias("body"),
        "score",
    )
    placed = threads.where("reached").select(F.col("id").alias("reddit_id"), (F.col("depth") + 1).alias("depth"))
    replies = comments.drop("depth").join(placed, "reddit_id").select(
        F.concat(F.lit("t1_"), "reddit_id").alias("post_id"),
        "parent_id",
        "depth",
        "author",
        "created_utc",
        "body",
        "score",
    )
    return roots.unionByName(replies)
