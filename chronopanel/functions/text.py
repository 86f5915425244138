"""Text helpers for names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

#: Words that do not tell companies apart. Fixed values.
STOP_WORDS = ["inc", "corp", "corporation", "co", "company", "plc", "ltd", "holdings", "group", "the", "class", "a", "b", "c"]


def normal_name(name: Column | str, stop: list[str] = STOP_WORDS) -> Column:
    """Lower case, letters and digits only, without stop words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(col(name)), r"[^a-z0-9]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(stop)), " ")


def label(ticker: Column | str) -> Column:
    """Dots of a symbol become hyphens; upper case; no surrounding space."""
    return F.replace(F.upper(F.trim(col(ticker))), F.lit("."), F.lit("-"))


def bare_label(ticker: Column | str) -> Column:
    """A label without its -YYYYMM suffix."""
    return F.regexp_replace(col(ticker), r"-\d{6}$", "")


def label_month(ticker: Column | str) -> Column:
    """First day of the month in a label's suffix, NULL without one."""
    month = F.regexp_extract(col(ticker), r"-(\d{6})$", 1)
    return F.when(month != "", F.to_date(F.concat(month, F.lit("01")), "yyyyMMdd"))


def similarity(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / longer length; 1 for two empty strings."""
    longest = F.greatest(F.length(col(a)), F.length(col(b)))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(col(a), col(b)) / longest)


def plain_text(html: Column | str) -> Column:
    """Text of a page: scripts, styles and tags go, a few entities are resolved, runs of space become one."""
    x = F.regexp_replace(col(html), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(x, r"[ \t\r\n]+", " "))


def sentences(text: Column | str) -> Column:
    """Array of the sentences of a text."""
    return F.filter(F.split(col(text), r"(?<=[.!?]) +"), lambda s: s != "")


def literal(raw: Column | str) -> list[Column]:
    """A command line's value: its kind (none, bool, int, float, text) and the value as text of that kind."""
    x = F.trim(col(raw))
    kind = (
        F.when(F.lower(x).isin("none", "null", ""), "none").when(F.lower(x).isin("true", "false"), "bool").when(x.rlike(r"^[+-]?\d+$"), "int")
        .when(x.try_cast("double").isNotNull(), "float").otherwise("text")
    )
    value = F.when(kind == "bool", F.lower(x)).when(kind == "int", x.try_cast("long").cast("string")).when(kind == "float", x.try_cast("double").cast("string")).when(kind == "text", x)
    return [kind.alias("kind"), value.alias("value")]
