"""Text expressions: word cleaning, tokens, previews, masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The thirteen characters that word cleaning blanks out.
BLANKED = "[(),:;.}{<>`]"

# The characters that count as white space at the edge of a word.
EDGE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_word(word: Column | str) -> Column:
    """Blank out punctuation and strip the edges; inner blanks stay."""
    blanked = F.translate(_col(word), BLANKED, " " * len(BLANKED))
    return F.btrim(blanked, F.lit(EDGE_SPACE))


def raw_tokens(*fields: Column | str) -> Column:
    """Space-separated pieces of all fields, in field order; a null field adds nothing."""
    parts = [F.split(F.coalesce(_col(f), F.lit("")), " ") for f in fields]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def one_line(text: Column | str) -> Column:
    return F.translate(_col(text), "\n", " ")


def preview(text: Column | str, length: int) -> Column:
    """First ``length`` characters, always followed by an ellipsis."""
    return F.concat(F.substring(_col(text), 1, length), F.lit("..."))


def preview_if_longer(text: Column | str, length: int) -> Column:
    """The text itself, or its first ``length`` characters and an ellipsis."""
    text = _col(text)
    return F.when(F.length(text) > length, preview(text, length)).otherwise(text)


def mask_numbers(text: Column | str) -> Column:
    """Drop e-mail addresses and phone numbers, mask digit runs longer than six."""
    no_mail = F.regexp_replace(_col(text), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "")
    no_phone = F.regexp_replace(no_mail, r"\+?[0-9]{1,3}[ -][0-9]{3,5}[ -][0-9]{4,6}", "")
    return F.regexp_replace(no_phone, r"[0-9]{7,}", "••••")


def truncate_name(name: Column | str) -> Column:
    """Names over 50 characters keep the first 48 and end in two dashes."""
    name = _col(name)
    return F.when(F.length(name) > 50, F.concat(F.substring(name, 1, 48), F.lit("--"))).otherwise(name)


# Characters a file name may not hold.
FORBIDDEN_IN_NAMES = '[@!#$%^&*()<>?/"\\|}{~:+`=]'


def safe_name(name: Column | str) -> Column:
    return F.translate(_col(name), FORBIDDEN_IN_NAMES, "_" * len(FORBIDDEN_IN_NAMES))


def like_pattern(term: str, literal: bool = False) -> str:
    """``%term%`` for ILIKE.

    ``%`` and ``_`` stay wildcards unless ``literal``. A backslash that escapes
    nothing is dropped: PostgreSQL ignores it, where Spark raises.
    """
    if literal:
        escaped = "".join("\\" + ch if ch in "%_\\" else ch for ch in term)
        return f"%{escaped}%"
    kept, i = [], 0
    while i < len(term):
        if term[i] != "\\":
            kept.append(term[i])
        elif i + 1 < len(term) and term[i + 1] in "%_\\":
            kept.append(term[i : i + 2])
            i += 1
        i += 1
    return "%" + "".join(kept) + "%"
