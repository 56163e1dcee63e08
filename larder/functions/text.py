"""Text expressions (E1-E7, E11, X1, X2), all native so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: what a normalised name keeps. Punctuation to a space and then runs of blanks to one
# space is the same as any run of other characters to one space, in half the passes. Spelled out:
# Java's matcher looks up listed characters in one bitmap, but asks a chain of tests for ranges.
KEPT = "abcdefghijklmnopqrstuvwxyz0123456789"
NOT_KEPT = f"[^{KEPT}]+"

# One quoted item, single or double quotes, backslash escaping any character but a line feed.
# Possessive and unrolled: a plain (?:[^'\\]|\\.)* recurses per character in Java's matcher and
# overflows the stack on items of a few thousand characters. (?d) makes "." stop at \n only.
QUOTED_ITEM = r"""(?d)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""

# What ends an item while a whole list is cleaned at once. No normalised name has it.
END = "\u0001"
# Any text as a row of these: what precedes a quote, and the item, if the quote begins one, without
# its quotes. Finds the items that QUOTED_ITEM does.
UP_TO_ITEM = r"""(?d)[^'"]*+(?:'([^'\\]*+(?:\\.[^'\\]*+)*+)'|"([^"\\]*+(?:\\.[^"\\]*+)*+)"|['"]|\z)"""


def normalize(text: Column | str) -> Column:
    """Lower-case, punctuation to spaces, blanks collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_KEPT, " "))


def quoted_items(text: Column | str) -> Column:
    """Items of a list literal with their quotes, NULL for NULL."""
    return F.regexp_extract_all(text, F.lit(QUOTED_ITEM), F.lit(0))


def unquote(item: Column | str) -> Column:
    return F.substring(item, F.lit(2), F.length(item) - 2)


def normalized_names(text: Column | str) -> Column:
    """The distinct normalised items of a list literal, in any order and perhaps with an empty one;
    NULL for NULL.

    As ``normalize`` of every item, but the list is cleaned as one text and cut last, so no
    expression is evaluated per item.
    """
    bare = F.lower(F.replace(text, F.lit(END), F.lit(" ")))
    items = F.regexp_replace(bare, UP_TO_ITEM, f"$1$2{END}")
    cleaned = F.regexp_replace(items, f"[^{KEPT}{END}]+", " ")
    for blank in (f" {END}", f"{END} "):
        cleaned = F.replace(cleaned, F.lit(blank), F.lit(END))
    return F.array_distinct(F.split(F.ltrim(cleaned), END))


def parse_list(text: Column | str) -> Column:
    """Items of a list literal such as ``['a', "b"]`` as ``array<string>``.

    Escapes are kept as written, empty items are kept, NULL gives an empty array, and an item whose
    quote never closes is left out.
    """
    return F.coalesce(F.transform(quoted_items(text), unquote), F.array().cast("array<string>"))


def explode_list(df: DataFrame, text: str, item: str) -> DataFrame:
    """One row per item of the list literal in ``text``, which ``item`` replaces.

    Explodes before unquoting: ``transform`` would take the scan's stage out of generated code.
    """
    others = [c for c in df.columns if c != text]
    quoted = df.select(*others, F.explode(quoted_items(text)).alias("_quoted"))
    return quoted.select(*others, unquote("_quoted").alias(item))


def normalized_terms(terms: Sequence[str]) -> list[Column]:
    """Search terms put through the same clean-up as the stored names.

    Expressions of literals, which Catalyst folds: they reach a scan as pushed filters, and no job
    runs for them.
    """
    if not terms:
        raise ValueError("a search needs at least one term")
    return [normalize(F.lit(term)) for term in terms]
