"""All registered queries."""

from . import expressions, files_feeds, loading, reading, threads_words  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
