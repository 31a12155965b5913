"""String column functions: masking and keyword matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopflow.constants import PHONE_KEEP, PHONE_STARS

TOKEN_SPLIT = r"[^\p{L}\p{Nd}]+"   # word characters are letters and digits
IDEOGRAPH = r"([\p{IsHan}\p{IsHiragana}])"   # written without spaces: each is a token


def mask_phone(tel: Column, keep: int = PHONE_KEEP, stars: int = PHONE_STARS) -> Column:
    """First ``keep`` characters followed by a constant run of ``*``; shorter
    numbers keep all their characters. NULL stays NULL."""
    return F.concat(F.substring(tel, 1, keep), F.lit("*" * stars))


def tokens(text: Column) -> Column:
    """Lower-cased word tokens (letters/digits runs; every ideograph is a token
    of its own, as in a standard analyser), empties removed."""
    spaced = F.regexp_replace(F.lower(text), IDEOGRAPH, " $1 ")
    return F.filter(F.split(spaced, TOKEN_SPLIT), lambda t: t != "")


def matches_all_terms(text: Column, keyword: Column | str) -> Column:
    """Every keyword token occurs among the text tokens (AND match).

    An empty keyword matches nothing (``forall`` over an empty array is true,
    hence the size guard)."""
    kw = tokens(F.lit(keyword) if isinstance(keyword, str) else keyword)
    doc = tokens(text)
    return (F.size(kw) > 0) & F.forall(kw, lambda t: F.array_contains(doc, t))
