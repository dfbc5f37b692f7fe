"""Raw records to the canonical document and table shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import DELETED, author_label, edited_at, edited_flag, epoch_to_time, null_to_zero
from .ranking import in_pages

# The fields of a community record.
SUBREDDIT_FIELDS = [
    "can_assign_link_flair", "can_assign_user_flair", "created_utc", "description",
    "description_html", "display_name", "id", "name", "nsfw", "public_description",
    "spoilers_enabled", "subscribers", "user_is_banned", "user_is_moderator", "user_is_subscriber",
]


def _edited(c: str) -> Column:
    """False, or the time of the edit, as text."""
    edited = F.col(c)
    epoch = F.try_variant_get(edited, "$", "double")
    is_time = F.schema_of_variant(edited) != "BOOLEAN"
    return F.when(is_time, epoch_to_time(epoch)).otherwise(F.lit("false"))


def submission_record(raw: DataFrame, include_all: bool = False) -> DataFrame:
    """The 20-field submission document; ``include_all`` adds community and type."""
    extra = [F.struct(*[subreddit_field(f, "subreddit.") for f in SUBREDDIT_FIELDS]).alias("subreddit"),
             F.lit("submission").alias("type")] if include_all else []
    return raw.select(
        author_label("author_name").alias("author"),
        epoch_to_time("created_utc").alias("created_utc"),
        "distinguished",
        _edited("edited").alias("edited"),
        "id", "is_original_content", "is_self", "link_flair_text", "locked", "name",
        F.col("over_18").alias("nsfw"),
        "num_comments", "permalink", "score", "selftext", "spoiler", "stickied", "title",
        "upvote_ratio", "url",
        *extra,
    )


def comment_record(raw: DataFrame, include_all: bool = False) -> DataFrame:
    """The 12-field comment document; ``include_all`` adds parent record and type."""
    extra = ["submission", "subreddit_id", F.lit("comment").alias("type")] if include_all else []
    return raw.select(
        author_label("author_name").alias("author"),
        "body", "body_html",
        epoch_to_time("created_utc").alias("created_utc"),
        "distinguished",
        _edited("edited").alias("edited"),
        "id", "is_submitter", "link_id", "parent_id", "score", "stickied",
        *extra,
    )


def subreddit_field(name: str, prefix: str = "") -> Column:
    if name == "created_utc":
        return epoch_to_time(prefix + name).alias(name)
    if name == "nsfw":
        return F.col(prefix + "over18").alias(name)
    return F.col(prefix + name).alias(name)


def subreddit_record(raw: DataFrame) -> DataFrame:
    """The 15-field community document."""
    return raw.select(*[subreddit_field(f) for f in SUBREDDIT_FIELDS])


def multireddit_record(raw: DataFrame) -> DataFrame:
    """The 10-field collection document with its nested communities."""

    def nested(s: Column) -> Column:
        renamed = {"nsfw": s["over18"], "created_utc": epoch_to_time(s["created_utc"])}
        return F.struct(*[(renamed[f] if f in renamed else s[f]).alias(f) for f in SUBREDDIT_FIELDS])

    return raw.select(
        "can_edit", "copied_from",
        epoch_to_time("created_utc").alias("created_utc"),
        "description_html", "description_md", "display_name", "name",
        F.col("over_18").alias("nsfw"),
        F.transform(F.coalesce("subreddits", F.array().cast(raw.schema["subreddits"].dataType)), nested).alias("subreddits"),
        "visibility",
    )


# The fields of a trophy and of a profile.
TROPHY_FIELDS = ["award_id", "description", "icon_40", "icon_70", "name", "url"]
PROFILE_FIELDS = [
    "comment_karma", "created_utc", "fullname", "has_verified_email", "icon_img", "id",
    "is_employee", "is_friend", "is_mod", "is_gold", "link_karma", "name", "subreddit", "trophies",
]


def redditor_information(raw: DataFrame) -> DataFrame:
    """Profile as JSON: two fields for a suspended account, fourteen otherwise.

    ``is_suspended`` is null for a normal account. An empty trophy list is null. The account's own community
    keeps its creation time as a number.
    """
    trophies = F.when(
        F.size("trophies") > 0,
        F.transform("trophies", lambda t: F.struct(*[t[f].alias(f) for f in TROPHY_FIELDS])),
    )
    named = {f: F.col("subreddit.over18" if f == "nsfw" else f"subreddit.{f}") for f in SUBREDDIT_FIELDS}
    own = F.when(F.col("subreddit").isNotNull(), F.struct(*[c.alias(f) for f, c in named.items()]))
    fields = {"created_utc": epoch_to_time("created_utc"), "subreddit": own, "trophies": trophies}
    profile = F.struct(*[fields.get(f, F.col(f)).alias(f) for f in PROFILE_FIELDS])
    options = {"ignoreNullFields": "false"}
    information = F.when(
        F.col("is_suspended").isNotNull(), F.to_json(F.struct("is_suspended", "name"), options)
    ).otherwise(F.to_json(profile, options))
    return raw.select("name", information.alias("information"))


def label_interactions(documents: DataFrame, keys: list[str]) -> DataFrame:
    """One row per item of every interaction list, with the list name, the type and
    whether the list was forbidden."""
    lists = documents.select(*keys, F.explode("interactions").alias("category", "items"))
    items = lists.select(*keys, "category", F.posexplode("items").alias("item_pos", "item"))
    as_text = F.try_variant_get("item", "$", "string")
    forbidden = (F.schema_of_variant("item") == "STRING") & (as_text == "FORBIDDEN")
    return items.select(
        *keys, "category", "item_pos", "item",
        F.try_variant_get("item", "$.type", "string").alias("type"),
        F.coalesce(forbidden, F.lit(False)).alias("forbidden"),
    )


def submission_row(documents: DataFrame) -> DataFrame:
    """Document to table row, with the defaults of the load."""

    def default(name: str, value: object) -> Column:
        return F.coalesce(F.col(name), F.lit(value))

    return documents.select(
        F.col("id").alias("reddit_id"),
        "title", "url", "permalink",
        default("selftext", "").alias("selftext"),
        default("author", DELETED).alias("author"),
        F.try_to_timestamp("created_utc").alias("created_utc"),
        null_to_zero("score").alias("score"),
        "upvote_ratio",
        null_to_zero("num_comments").alias("num_comments"),
        default("is_self", False).alias("is_self"),
        default("is_original_content", False).alias("is_original_content"),
        default("nsfw", False).alias("is_nsfw"),
        default("spoiler", False).alias("is_spoiler"),
        default("stickied", False).alias("is_stickied"),
        default("locked", False).alias("is_locked"),
        "distinguished", "link_flair_text",
    )


def comment_row(documents: DataFrame) -> DataFrame:
    """Document to table row; the edit flag and time are kept, which the load once lost, and a reply's depth where it is known."""
    depth = ["depth"] if "depth" in documents.columns else []
    return documents.select(
        *depth,
        F.col("id").alias("reddit_id"),
        "body", "body_html",
        F.coalesce("author", F.lit(DELETED)).alias("author"),
        F.try_to_timestamp("created_utc").alias("created_utc"),
        null_to_zero("score").alias("score"),
        "parent_id", "link_id",
        F.coalesce("is_submitter", F.lit(False)).alias("is_submitter"),
        F.coalesce("stickied", F.lit(False)).alias("is_stickied"),
        "distinguished",
        edited_flag("edited").alias("edited_flag"),
        F.try_to_timestamp(edited_at("edited")).alias("edited_at"),
    )


# The fields of a post's metadata, and those a gallery has besides.
METADATA_FIELDS = [
    "author", "created_utc", "distinguished", "edited", "is_original_content", "is_self",
    "link_flair_text", "locked", "nsfw", "num_comments", "permalink", "score", "selftext",
    "spoiler", "stickied", "subreddit", "title", "upvote_ratio",
]
GALLERY_FIELDS = ["gallery_data", "media_metadata"]


def submission_metadata(documents: DataFrame) -> DataFrame:
    """Metadata block of a comment document, keys sorted; the gallery fields may be null."""
    present = [f for f in GALLERY_FIELDS if f in documents.columns]
    return documents.select(*sorted(METADATA_FIELDS + present))


def rules(documents: DataFrame) -> DataFrame:
    """One row per community rule."""
    fields = ["created_utc", "description", "kind", "priority", "short_name", "violation_reason"]
    exploded = documents.select(
        F.col("scrape_settings.subreddit").alias("subreddit"), F.explode("subreddit_rules.rules").alias("rule")
    )
    return exploded.select(
        "subreddit",
        *[(epoch_to_time("rule.created_utc") if f == "created_utc" else F.col(f"rule.{f}")).alias(f) for f in fields],
    )


def columns_to_lists(rows: DataFrame, keys: list[str], order: list[Column], page_size: int) -> DataFrame:
    """Rows as one list per column, in pages of bounded size."""
    fields = [c for c in rows.columns if c not in keys]
    pages = in_pages(rows, keys, order, F.struct(*fields), "items", page_size)
    return pages.select(*keys, "page", *[F.col(f"items.{f}").alias(f) for f in fields])

