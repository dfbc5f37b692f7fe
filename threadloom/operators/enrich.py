"""Thread enrichment: mentions of known names, perks next to them, user processors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import materialize

# A sentence ends at its mark or at a line break.
SENTENCE_END = r"[.!?]+[ \t\r\n]+|\n+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def sentences(posts: DataFrame, text: str = "body") -> DataFrame:
    """One row per sentence."""
    return posts.select("post_id", F.posexplode(F.split(text, SENTENCE_END)).alias("sentence_no", "sentence"))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NOT_WORD), "")


def alias_table(aliases: DataFrame) -> DataFrame:
    """The dictionary with every alias as lower-case words and their number."""
    words = _words(F.lower("alias"))
    labels = [c for c in aliases.columns if c != "alias"]
    return aliases.select(
        *labels, F.array_join(words, " ").alias("alias_key"), F.size(words).alias("alias_size")
    ).where("alias_size > 0").distinct()


def _beginnings(table: DataFrame, length: int) -> DataFrame:
    """First ``length`` words of the aliases that have so many, and the sizes below twice that which begin so."""
    begun = table.where(F.col("alias_size") >= length).select(
        F.xxhash64(F.substring_index("alias_key", " ", length)).alias(f"__key{length}"), "alias_size"
    )
    sizes = F.collect_set(F.when(F.col("alias_size") < 2 * length, F.col("alias_size")))
    return begun.groupBy(f"__key{length}").agg(sizes.alias(f"__sizes{length}"))


def _single_forms(spoken: DataFrame, table: DataFrame) -> DataFrame:
    """Words that may be an alias of their own: they need nothing beside them for that."""
    known = table.where("alias_size = 1").select(F.xxhash64("alias_key").alias("__known"))
    # Of a plain column, explode would test the size before the exchange, which cuts each sentence into words twice.
    said = spoken.select("post_id", "sentence_no", F.explode(F.array_distinct("__words")).alias("form"))
    return said.join(known, F.xxhash64(F.lower("form")) == F.col("__known"), "left_semi")


def _longer_forms(spoken: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """Word runs that may be an alias of two words or more.

    From each pair of words on, the text is followed along the dictionary's beginnings of
    2, 4, ... words, each an equi-join that only keeps places where an alias goes on; only
    there are runs built, of the sizes that begin so. A place carries as many words as
    the longest alias has, so the work grows with the text, not with the length of a
    sentence.
    """
    seconds = F.posexplode(F.slice("__words", 2, F.size("__words"))).alias("__place", "__second")
    pairs = spoken.select("post_id", "sentence_no", "__words", seconds)
    pair = F.concat(F.get("__words", "__place"), F.lit(" "), "__second")
    run = F.slice("__words", F.col("__place") + 1, longest)
    places = pairs.select("post_id", "sentence_no", run.alias("__run"), F.xxhash64(F.lower(pair)).alias("__at2"))
    length, sizes = 2, []
    while length <= longest:
        begun = _beginnings(table, length)
        if sizes:
            begins = F.lower(F.array_join(F.slice("__run", 1, length), " "))
            places = places.withColumn(f"__at{length}", F.when(F.size("__run") >= length, F.xxhash64(begins)))
        places = places.join(begun, places[f"__at{length}"] == begun[f"__key{length}"], "left" if sizes else "inner")
        sizes.append(F.coalesce(f"__sizes{length}", F.array().cast("array<int>")))
        length *= 2
    fitting = F.filter(F.concat(*sizes), lambda n: n <= F.size("__run"))
    forms = F.transform(fitting, lambda n: F.array_join(F.slice("__run", 1, n), " "))
    return places.select("post_id", "sentence_no", F.explode(forms).alias("form"))


def _forms(spoken: DataFrame, table: DataFrame) -> DataFrame:
    """Distinct word runs of each sentence that may be in ``table``, as ``form``.

    Single words and longer runs are searched apart, as most places begin no longer alias.
    The search compares hashes; a form meets its alias by the words themselves afterwards.
    """
    longest = table.agg(F.max("alias_size")).first()[0] or 0
    said = F.array_join(_words(F.col("sentence")), " ").alias("__said")
    # Dealt by sentence before anything grows, as the distinct forms of a sentence meet in the end. Words go as one text.
    spoken = spoken.select("post_id", "sentence_no", said).repartition("post_id", "sentence_no")
    spoken = spoken.select("post_id", "sentence_no", F.split("__said", " ").alias("__words"))
    # A form counts once per sentence, so repeats go before the lookup.
    found = _single_forms(spoken, table).distinct()
    return found.unionByName(_longer_forms(spoken, table, longest).distinct()) if longest > 1 else found


def _mentions(spoken: DataFrame, aliases: DataFrame) -> DataFrame:
    table = materialize(alias_table(aliases), "aliases")
    labels = [c for c in aliases.columns if c != "alias"]
    forms = _forms(spoken, table).withColumn("alias_key", F.lower("form"))
    return forms.join(table, "alias_key").select("post_id", "sentence_no", *labels, "form")


def mentions(posts: DataFrame, aliases: DataFrame, text: str = "body") -> DataFrame:
    """Occurrences of aliases as whole words, case-insensitive, the surface form kept.

    Dictionary: ``alias`` and any label columns, which come out as they are. It may
    have any size, and no post meets an alias it does not contain. Equal forms in
    one sentence count once.
    """
    return _mentions(sentences(posts, text), aliases)


def entity_mentions(posts: DataFrame, aliases: DataFrame, text: str = "body") -> DataFrame:
    """Distinct surface forms per entity and post: the evidence, one row each.

    Sentences are counted per form, and only then does a form meet its entities.
    """
    table = materialize(alias_table(aliases.select("canonical", "alias")), "aliases")
    counted = _forms(sentences(posts, text), table).groupBy("post_id", "form").agg(F.count("*").alias("sentences"))
    counted = counted.withColumn("alias_key", F.lower("form"))
    return counted.join(table, "alias_key").select("canonical", "form", "post_id", "sentences")


def benefit_mentions(
    posts: DataFrame, aliases: DataFrame, perks: DataFrame, text: str = "body"
) -> DataFrame:
    """Entities with a perk word in the same or a neighbouring sentence.

    Perks: ``benefit, keyword``. Perks are searched first and stored, each listed
    under its own sentence and both neighbours. Only those sentences are searched
    for entities, as no other can hold a pair; one equi-join on post and sentence
    finds the pairs.
    """
    found = mentions(posts, perks.select("benefit", F.col("keyword").alias("alias")), text)
    around = F.array(*[F.col("sentence_no") + d for d in (-1, 0, 1)])
    near = found.select("post_id", F.explode(around).alias("sentence_no"), "benefit").distinct()
    near = materialize(near, "perks")
    # Posts without a perk are not cut into sentences again.
    beside = posts.join(near.select("post_id").distinct(), "post_id", "left_semi")
    beside = sentences(beside, text).join(near, ["post_id", "sentence_no"], "left_semi")
    named = _mentions(beside, aliases.select("canonical", "alias")).select("post_id", "sentence_no", "canonical").distinct()
    return named.join(near, ["post_id", "sentence_no"])


def process_pending_with(
    items: DataFrame, process: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Run a user's function over pending items, batch by batch in the executors.

    The result is meant for the queue log, so a repeated run writes the same events.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield process(batch)

    return items.mapInPandas(run, schema)
