"""Search predicates as boolean columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates two tokens of a text, and the edges of one token.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
WORD_START = r"(?<![\p{L}\p{N}])(?:"
WORD_END = r")(?![\p{L}\p{N}])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def query_tokens(query: str) -> list[str]:
    """The distinct lower-case tokens of a query, in order."""
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


def match_text(text: Column | str, query: str) -> Column:
    """Any token of ``query`` occurs as a token of the text, whatever its case.

    One regular expression over the whole text: it stops at the first hit and builds
    no token array per row.
    """
    tokens = query_tokens(query)
    if not tokens:
        return F.lit(False)
    words = "|".join(re.escape(t) for t in tokens)
    return F.lower(_col(text)).rlike(WORD_START + words + WORD_END)


def term(column: Column | str, value) -> Column:
    """Exact value."""
    return _col(column) == F.lit(value)


def value_range(column: Column | str, *, gte=None, gt=None, lte=None, lt=None) -> Column:
    """All the given bounds hold."""
    column = _col(column)
    bounds = [
        (gte, lambda v: column >= v),
        (gt, lambda v: column > v),
        (lte, lambda v: column <= v),
        (lt, lambda v: column < v),
    ]
    return all_of([make(v) for v, make in bounds if v is not None])


def exists(column: Column | str) -> Column:
    """The field has a value."""
    return _col(column).isNotNull()


def match_all() -> Column:
    return F.lit(True)


def all_of(clauses: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, clauses) if clauses else F.lit(True)


def bool_query(must: list[Column] = (), filters: list[Column] = ()) -> Column:
    """Every ``must`` and every ``filter`` clause; without scores they act alike.

    Filters go first because exact terms and ranges are cheaper than text matches.
    """
    return all_of([*filters, *must])
