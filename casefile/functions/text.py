"""Column helpers (T2-T9, C1-C5).  All are built-in Spark expressions, so they
stay inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII word characters.  The reference engine's regex word boundary is ASCII,
# Java's is Unicode-aware, so whole-word matching uses explicit look-arounds.
WORD_CLASS = "0-9A-Za-z_"

# ASCII whitespace as the reference engine's regex `\s` sees it (no \x0B).
WS_CLASS = r"[\t\n\f\r ]"

# Blanks accepted around a date string.
_BLANKS = r"[ \t\n\x0B\f\r]*"

# Year, separator (-, / or blank; the same both times), month, day, then an
# optional valid HH:MM[:SS[.fff]] time introduced by `T` or a blank.
_DATE_RE = (
    "^" + _BLANKS
    + r"(\d{4})([-/ ])(\d{1,2})\2(\d{1,2})"
    + r"(?:[T ](?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?)?"
    + _BLANKS + "$"
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c: str | Column) -> Column:
    """Text -> DATE, NULL for anything that is not a calendar date."""
    c = col(c)
    y = F.regexp_extract(c, _DATE_RE, 1)
    m = F.regexp_extract(c, _DATE_RE, 3)
    d = F.regexp_extract(c, _DATE_RE, 4)
    ymd = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(y != "", ymd.try_cast("date"))


def unicode_trim(c: str | Column) -> Column:
    """Trim Unicode space separators (blank, NBSP, em space...), not tabs."""
    return F.regexp_replace(col(c), r"^\p{Zs}+|\p{Zs}+$", "")


def search_text(subject: str | Column, body: str | Column) -> Column:
    """lower(subject + ' ' + body), NULL parts as empty."""
    return F.lower(F.concat_ws(" ", F.coalesce(col(subject), F.lit("")),
                               F.coalesce(col(body), F.lit(""))))


def message_excerpt(body: str | Column, n: int = 500) -> Column:
    """Collapse ASCII whitespace runs to one blank, keep the first n chars."""
    return F.substring(F.regexp_replace(col(body), WS_CLASS + "+", " "), 1, n)


def address_domain(addr: str | Column) -> Column:
    """T4: lower-cased second `@` part ('' when absent)."""
    return F.lower(F.split_part(col(addr), F.lit("@"), F.lit(2)))


def address_user(addr: str | Column) -> Column:
    """T4: the local part of an address."""
    return F.split_part(col(addr), F.lit("@"), F.lit(1))


def week_bucket(d: str | Column) -> Column:
    """Monday week start as DATE."""
    return F.trunc(col(d), "week")


def whole_word_pattern(words: Iterable[str]) -> str:
    """Alternation of lexicon words with ASCII word-boundary look-arounds."""
    alts = "|".join(re.escape(w.lower()) for w in words)
    return f"(?<![{WORD_CLASS}])({alts})(?![{WORD_CLASS}])"


def lexicon_hits(text: str | Column, words: Iterable[str]) -> Column:
    """Distinct whole-word lexicon hits in already lower-cased text (array)."""
    return F.array_distinct(F.regexp_extract_all(col(text), F.lit(whole_word_pattern(words)), 1))


def any_substring(text: str | Column, words: Iterable[str]) -> Column:
    """Case-insensitive substring prefilter over lower-cased text (F2)."""
    text = col(text)
    conds = [text.contains(w.lower()) for w in words]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def short_name(urn: str | Column) -> Column:
    """The part after the last ':' of a catalog identifier."""
    return F.element_at(F.split(col(urn), ":"), -1)


def term_name(urn: str | Column) -> Column:
    """Glossary term urns also drop the node path before the last '.'."""
    return F.element_at(F.split(short_name(urn), r"\."), -1)


def ascii_trim(c: str | Column) -> Column:
    """Strip ASCII whitespace (blank, tab, newlines, form feed) at both ends."""
    return F.regexp_replace(col(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def safe_evidence_table(name: str | Column, schema: str = "analytics") -> Column:
    """Forgiving table name -> `<schema>.<safe>`; NULL when nothing is left."""
    quotes = r"[`\"\[\]]"
    t = F.regexp_replace(ascii_trim(F.coalesce(col(name), F.lit(""))), f"^{quotes}+|{quotes}+$", "")
    t = ascii_trim(t)
    last = F.element_at(F.split(t, r"\."), -1)
    last = F.regexp_replace(ascii_trim(last), f"^{quotes}+|{quotes}+$", "")
    safe = F.regexp_replace(F.regexp_replace(last, "[^A-Za-z0-9_]", "_"), "^_+|_+$", "")
    return F.when(safe != "", F.concat(F.lit(schema + "."), safe))


#: The query of a wrapped statement follows its first word AS.
_WORD_AS = r"(?i)\bas\s+"


def _bare_sql(sql: str | Column) -> Column:
    """The statement without blanks around it and closing semicolons."""
    return F.regexp_replace(ascii_trim(F.coalesce(col(sql), F.lit(""))), f"(;|{WS_CLASS})+$", "")


def strip_create_wrapper(sql: str | Column) -> Column:
    """The query inside CREATE [OR REPLACE] TABLE|VIEW ... AS, without closing semicolons."""
    s = _bare_sql(sql)
    return F.when(is_create_wrapped(sql), _bare_sql(F.element_at(F.split(s, _WORD_AS, 2), -1))).otherwise(s)


def is_create_wrapped(sql: str | Column) -> Column:
    """The first words are CREATE TABLE or VIEW, OR REPLACE between them or not."""
    s = _bare_sql(sql)
    word = F.split(F.lower(s), r"\s+", 5)
    kind = F.when((F.get(word, F.lit(1)) == "or") & (F.get(word, F.lit(2)) == "replace"), F.get(word, F.lit(3))
                  ).otherwise(F.get(word, F.lit(1)))
    opens = (F.get(word, F.lit(0)) == "create") & F.split(kind, "[^a-z0-9_]", 2)[0].isin("table", "view")
    return F.coalesce(opens, F.lit(False)) & s.rlike(_WORD_AS)
