"""Registered queries: comment threads, word frequencies, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import iso_time
from ..functions.text import BLANKED, EDGE_SPACE, mask_numbers, raw_tokens
from ..operators import enrich, threads, words
from .bindings import Tables
from .reading import iso
from .registry import query

# --- threads ---------------------------------------------------------------

NODES = """nodes AS (SELECT split_part(link_id, '_', -1) AS link, reddit_id AS id,
      split_part(parent_id, '_', -1) AS up, * FROM {table})"""
WALK = NODES + """, walk AS (
    SELECT link, id, CAST(0 AS BIGINT) AS depth, id AS root_comment_id, id AS path, [ord] AS spot FROM nodes WHERE up = link
    UNION ALL
    SELECT n.link, n.id, w.depth + 1, w.root_comment_id, w.path || '/' || n.id, list_append(w.spot, n.ord)
    FROM nodes n JOIN walk w ON n.link = w.link AND n.up = w.id WHERE n.up <> n.link)"""


def walk(table: str, body: str) -> str:
    return f"WITH RECURSIVE {WALK.format(table=table)} {body}"


# Alike in all copies of a comment, and ``thread_depth`` keeps one row per id: the raw feed serves as it is.
LINKS = ["link_id", "reddit_id", "parent_id", "ord"]


@query("thread_depth", walk("comments", "SELECT link, id, depth, root_comment_id, path FROM walk"))
def thread_depth(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.raw_comments.select(*LINKS)).where("reached")
    return placed.select("link", "id", "depth", "root_comment_id", threads.path_ids().alias("path"))


@query("thread_orphans", walk("threads", "SELECT link, id FROM nodes WHERE (link, id) NOT IN (SELECT (link, id) FROM walk)"))
def thread_orphans(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.threads.select(*LINKS), with_path=False)
    return threads.thread_orphans(placed).select("link", "id")


@query("thread_raw_order", walk("comments", """, flat AS (SELECT w.*, n.ord FROM walk w JOIN nodes n USING (link, id))
    SELECT link, id, depth, row_number() OVER (PARTITION BY link ORDER BY depth, ord, id) AS position FROM flat"""))
def thread_raw_order(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.raw_comments.select(*LINKS), with_path=False)
    return threads.thread_raw_order(placed).select("link", "id", "depth", "position")


@query("thread_limit", walk("comments", """, roots AS (
      SELECT w.link, w.id, row_number() OVER (PARTITION BY w.link ORDER BY n.ord, w.id) AS r
      FROM walk w JOIN nodes n USING (link, id) WHERE w.depth = 0)
    SELECT link, id, depth, root_comment_id FROM walk WHERE (link, root_comment_id) IN (SELECT (link, id) FROM roots WHERE r <= 1)"""))
def thread_limit(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.raw_comments.select(*LINKS), with_path=False)
    return threads.thread_limit(placed, 1).select("link", "id", "depth", "root_comment_id")


@query("thread_limit_raw", walk("threads", """, flat AS (
      SELECT w.*, row_number() OVER (PARTITION BY w.link ORDER BY w.depth, n.ord, w.id) AS r
      FROM walk w JOIN nodes n USING (link, id))
    SELECT link, id, depth FROM flat WHERE r <= 3"""))
def thread_limit_raw(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.threads.select(*LINKS), with_path=False)
    return threads.thread_limit(placed, 3, style="raw").select("link", "id", "depth")


TREE = """, eldest AS (SELECT link, list_slice(spot, 1, len(spot) - 1) AS up_spot, min(spot[-1]) AS ord FROM walk GROUP BY ALL),
    lines AS (
      SELECT w.link, w.spot, CASE WHEN w.spot[-1] = e.ord THEN '' ELSE ',' END || '{"id":' || to_json(w.id) || ',"author":' || to_json(n.author)
        || ',"body":' || to_json(n.body) || ',"replies":[' AS fragment
      FROM walk w JOIN nodes n USING (link, id)
        JOIN eldest e ON e.link = w.link AND e.up_spot = list_slice(w.spot, 1, len(w.spot) - 1)
      UNION ALL SELECT link, list_append(spot, 9223372036854775807), ']}' FROM walk
      UNION ALL SELECT DISTINCT link, [-9223372036854775807], '[' FROM nodes
      UNION ALL SELECT DISTINCT link, [9223372036854775807], ']' FROM nodes)
    SELECT link, row_number() OVER (PARTITION BY link ORDER BY spot) AS line_no, fragment FROM lines"""
# The same lines as they stand in the written files.
TREE_FILE = TREE.replace("SELECT link, row_number() OVER (PARTITION BY link ORDER BY spot) AS line_no, fragment FROM lines", "SELECT fragment AS value FROM lines")


@query("thread_tree_json", walk("threads", TREE))
def thread_tree_json(t: Tables) -> DataFrame:
    return threads.thread_tree_json(t.threads, ["id", "author", "body"])


def nested_documents(t: Tables) -> DataFrame:
    """A nested comment document per stored text: lines, their sentences as replies, and the parts of those at commas."""

    def node(text, replies):
        return F.struct(text.alias("body"), replies.alias("replies"))

    none = F.array().cast("array<string>")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: node(
            line, F.transform(F.split(line, r"\. "), lambda s: node(s, F.transform(F.split(s, ", "), lambda p: node(p, none))))
        ),
    )
    return t.documents.select(
        "doc_id", F.from_json(F.to_json(lines), "array<variant>").alias("comments")
    )


LINES = """(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"""
SENTENCES = f"(SELECT doc_id, unnest(string_split(line, '. ')) AS body FROM {LINES})"
PARTS = f"(SELECT doc_id, unnest(string_split(body, ', ')) AS body FROM {SENTENCES})"
NESTED_ROWS = f"""SELECT doc_id, 0 AS depth, line AS body FROM {LINES} UNION ALL SELECT doc_id, 1, body FROM {SENTENCES}
    UNION ALL SELECT doc_id, 2, body FROM {PARTS}"""


def flat_bodies(t: Tables) -> DataFrame:
    body = lambda comment: F.try_variant_get(comment, "$.body", "string")
    flat = threads.flatten_nested(nested_documents(t), levels_per_pass=2, take=body)
    return flat.withColumnRenamed("comment", "body")


@query("thread_flatten_nested", NESTED_ROWS)
def thread_flatten_nested(t: Tables) -> DataFrame:
    return flat_bodies(t)


@query("thread_posts", walk("comments", f"""
    SELECT 't3_' || s.reddit_id AS post_id, NULL AS parent_id, CAST(0 AS BIGINT) AS depth, s.author,
      {iso('s.created_utc')} AS created_utc, s.selftext AS body, s.score FROM submissions s
    UNION ALL
    SELECT 't1_' || n.id, n.parent_id, w.depth + 1, n.author, {iso('n.created_utc')}, n.body, n.score
    FROM walk w JOIN nodes n USING (link, id)"""))
def thread_posts(t: Tables) -> DataFrame:
    placed = threads.thread_depth(t.raw_comments.select(*LINKS), with_path=False)
    posts = threads.thread_posts(t.posts, t.comments, placed)
    return posts.withColumn("created_utc", iso_time("created_utc"))


# --- words -----------------------------------------------------------------

BLANKS = " " * len(BLANKED)


def counted(source: str, keys: str = "", more: str = "count(*) AS frequency") -> str:
    """SQL word counts over ``source`` with a column ``text`` and the ``keys``."""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}word, {more} FROM (
      SELECT *, trim(translate(piece, '{BLANKED}', '{BLANKS}'), '{EDGE_SPACE}') AS word
      FROM (SELECT *, unnest(string_split(text, ' ')) AS piece, generate_subscripts(string_split(text, ' '), 1) AS nth
            FROM {source}))
      WHERE word <> '' GROUP BY {lead}word"""


TITLED = "(SELECT doc_id, source, lang, text || ' ' || lang || ' ' || source AS text FROM documents)"


def _titled(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", "source", F.col("text").alias("selftext"), F.concat_ws(" ", "lang", "source").alias("title")
    )


@query("word_freq_submissions", counted(TITLED))
def word_freq_submissions(t: Tables) -> DataFrame:
    return words.submission_words(_titled(t))


@query("word_freq_comments", counted("conversations"))
def word_freq_comments(t: Tables) -> DataFrame:
    return words.comment_words(t.threads)


@query("word_freq_structured_comments", counted(f"(SELECT body AS text FROM ({NESTED_ROWS}))"))
def word_freq_structured_comments(t: Tables) -> DataFrame:
    return words.comment_words(flat_bodies(t))


def feed(t: Tables) -> DataFrame:
    """A mixed feed over the stored texts: submissions, comments, forbidden marks and
    records without a type, by language."""
    submission = F.to_json(
        F.struct(F.lit("submission").alias("type"), F.col("text").alias("selftext"), F.concat_ws(" ", "lang", "source").alias("title"))
    )
    comment = F.to_json(F.struct(F.lit("comment").alias("type"), F.col("text").alias("body")))
    untyped = F.to_json(F.struct(F.col("text").alias("body")))
    item = (
        F.when(F.col("lang") == "en", submission)
        .when(F.col("lang") == "fr", comment)
        .when(F.col("lang") == "de", F.lit('"FORBIDDEN"'))
        .otherwise(untyped)
    )
    return t.documents.select("doc_id", "source", F.parse_json(item).alias("item"))


MIXED = """(SELECT doc_id, source, CASE lang WHEN 'en' THEN text || ' ' || lang || ' ' || source ELSE text END AS text
    FROM documents WHERE lang IN ('en', 'fr'))"""


@query("word_freq_mixed", counted(MIXED))
def word_freq_mixed(t: Tables) -> DataFrame:
    return words.mixed_words(feed(t))


@query("mixed_type_filter", """SELECT doc_id, CASE lang WHEN 'en' THEN 'submission' ELSE 'comment' END AS type
    FROM documents WHERE lang IN ('en', 'fr')""")
def mixed_type_filter(t: Tables) -> DataFrame:
    return words.only_records(feed(t)).select("doc_id", F.try_variant_get("item", "$.type", "string").alias("type"))


@query("word_freq_by_file", counted("(SELECT source AS file, text FROM documents)", "file"))
def word_freq_by_file(t: Tables) -> DataFrame:
    return words.words_by_file(t.documents.select(F.col("source").alias("file"), "text"))


@query("wordcloud_weights", f"""SELECT source, word, position, frequency, round(frequency / max(frequency) OVER (PARTITION BY source), 6) AS weight
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY frequency DESC, word) AS position
          FROM ({counted('documents', 'source')})) WHERE position <= 200""")
def wordcloud_weights(t: Tables) -> DataFrame:
    frequencies = words.count_words(t.documents, ["text"], by=["source"])
    weights = words.cloud_weights(frequencies, ["source"])
    return weights.withColumn("weight", F.round("weight", 6)).select("source", "word", "position", "frequency", "weight")


@query("words_by_frequency", counted(
    TITLED, "source", "count(*) AS frequency, CAST(min(doc_id * 2147483648 + nth - 1) AS VARCHAR) AS first_at"))
def words_by_frequency(t: Tables) -> DataFrame:
    rows = words.words_by_frequency(_titled(t), ["selftext", "title"], "doc_id", by=["source"])
    return rows.withColumn("first_at", F.col("first_at").cast("string"))


@query("token_union", f"""SELECT doc_id, len(string_split(text, ' ')) AS pieces FROM {TITLED}""")
def token_union(t: Tables) -> DataFrame:
    return _titled(t).select("doc_id", F.size(raw_tokens("selftext", "title")).cast("bigint").alias("pieces"))


# --- enrichment ------------------------------------------------------------

END = r"[.!?]+[ \t\r\n]+|\n+"
CUT = r"[^\p{L}\p{N}]+"


def sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{CUT}'), lambda w: w <> '')"


SPOKEN = f"""spoken AS (SELECT doc_id AS post_id, unnest(regexp_split_to_array(text, '{END}')) AS sentence,
      generate_subscripts(regexp_split_to_array(text, '{END}'), 1) - 1 AS sentence_no FROM documents),
    said AS (SELECT post_id, sentence_no, {sql_words('sentence')} AS w FROM spoken),
    forms AS (
      SELECT DISTINCT post_id, sentence_no, form FROM (
        SELECT post_id, sentence_no, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS form
        FROM said, (VALUES (1), (2), (3), (4), (5), (6)) AS v(n))),
    item_words AS (SELECT item_id, item_id % 6 + 1 AS n, {sql_words('text')} AS w FROM benchmark),
    aliases AS (SELECT DISTINCT 'item-' || item_id AS canonical, lower(array_to_string(w[i:i + n - 1], ' ')) AS alias_key
      FROM (SELECT *, unnest(range(1, len(w) + 1, n)) AS i FROM item_words)),
    perks AS (SELECT DISTINCT 'kind-' || (item_id % 4) AS canonical, lower(word) AS alias_key
      FROM (SELECT item_id, unnest(w) AS word FROM item_words) WHERE length(word) >= 9),
    found AS (SELECT f.post_id, f.sentence_no, a.canonical, f.form FROM forms f JOIN aliases a ON lower(f.form) = a.alias_key)"""


def _item_words(t: Tables) -> DataFrame:
    listed = F.filter(F.split("text", enrich.NOT_WORD), lambda w: w != "")
    return t.stored("benchmark").select("item_id", (F.col("item_id") % 6 + 1).cast("int").alias("n"), listed.alias("w"))


def aliases(t: Tables) -> DataFrame:
    """Every benchmark text, cut into runs of one to six words, each of which names the text."""
    starts = _item_words(t).where(F.size("w") > 0).select("*", F.explode(F.sequence(F.lit(1), F.size("w"), "n")).alias("i"))
    return starts.select(F.concat(F.lit("item-"), "item_id").alias("canonical"), F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("alias"))


def perks(t: Tables) -> DataFrame:
    """The long words of every benchmark text stand for a kind."""
    words = _item_words(t).select("item_id", F.explode("w").alias("keyword")).where(F.length("keyword") >= 9)
    return words.select(F.concat(F.lit("kind-"), F.col("item_id") % 4).alias("benefit"), "keyword")


def _texts(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("post_id"), F.col("text").alias("body"))


@query("entity_mentions", f"WITH {SPOKEN} SELECT canonical, form, post_id, count(*) AS sentences FROM found GROUP BY ALL")
def entity_mentions(t: Tables) -> DataFrame:
    return enrich.entity_mentions(_texts(t), aliases(t))


@query("benefit_mentions", f"""WITH {SPOKEN},
    perk_found AS (SELECT DISTINCT f.post_id, f.sentence_no, p.canonical FROM forms f JOIN perks p ON lower(f.form) = p.alias_key),
    near AS (SELECT DISTINCT post_id, sentence_no + d AS sentence_no, canonical AS benefit
      FROM perk_found, (VALUES (-1), (0), (1)) AS v(d))
    SELECT DISTINCT f.post_id, CAST(f.sentence_no AS INTEGER) AS sentence_no, f.canonical, n.benefit FROM found f
    JOIN near n ON f.post_id = n.post_id AND f.sentence_no = n.sentence_no""")
def benefit_mentions(t: Tables) -> DataFrame:
    return enrich.benefit_mentions(_texts(t), aliases(t), perks(t))


@query("mask_numbers", r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text,
      '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '', 'g'),
      '\+?[0-9]{1,3}[ -][0-9]{3,5}[ -][0-9]{4,6}', '', 'g'), '[0-9]{7,}', '••••', 'g') AS text FROM documents""")
def masked(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", mask_numbers("text").alias("text"))
