"""Expressions behind the dashboard's table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.fixed_values import BRANCH_GROUPS, CRITICAL_BELOW, LOW_BELOW


def stock_band(qty: Column) -> Column:
    return (
        F.when(qty < CRITICAL_BELOW, "critical").when(qty < LOW_BELOW, "low").otherwise("normal")
    )


def branch_group(branch: Column, groups: Mapping[str, Iterable[str]] = BRANCH_GROUPS) -> Column:
    """Group of a branch, "" for a branch in no group.

    The groups are a short list in the configuration, so this is a CASE and not a join. For a
    branch table use :func:`stockweave.operators.lookup.map_or_default`.
    """
    group = F.lit(None).cast("string")
    for name, branches in reversed(list(groups.items())):
        group = F.when(branch.isin(*branches), name).otherwise(group)
    return F.coalesce(group, F.lit(""))


def quantity_text(qty: Column) -> Column:
    """Quantity as the table shows it: no decimals on whole numbers."""
    whole = qty.try_cast("bigint")
    return F.when(qty == whole.cast("double"), whole.cast("string")).otherwise(
        qty.cast("string")
    )


def search_words(text: str) -> list[str]:
    """Words of a search box text; a quoted phrase counts as one word."""
    found = re.findall(r'"([^"]+)"|([^\s"]+)', text)
    return [(phrase or word).lower() for phrase, word in found]


def matches_search(text: str, *columns: Column) -> Column:
    """Every word or phrase occurs in some cell of the row, in any case. Between the cells stands a
    quote, which neither words nor phrases hold, so nothing is found across two of them."""
    row = F.lower(F.concat_ws('"', *columns))
    return reduce(
        lambda left, word: left & row.contains(word), search_words(text), F.lit(True)
    )
