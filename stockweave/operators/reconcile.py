"""Reconciliation of the feeds into one quantity per SKU and branch.

The rules. Records are read in the order of ``ord``. Stores, head office and depot (item phases)
name an item; the first record of an item opens its entry and fixes the entry's SKU. The online
shop and the vending machines (SKU phases) name a SKU; their records belong to the first entry
with that SKU, else they open an entry named like the SKU, unless an item of that name is there
already under another SKU, in which case they are dropped. Within an entry the last record of a
branch counts. Entries with the same SKU are merged: the first entry gives the item name, and for
each branch the entry opened last gives the quantity, even if another entry's record came later.

The plan. The raw feed is read by two aggregations, each with partial results in every task: the
``digest`` keeps one row per phase, key and branch, ``first_records`` one row per item and SKU. A hot
item or SKU shrinks to one row per branch there, before any shuffle. Both aggregate numbers only,
which keeps them hash aggregations; a string in their buffers would turn them into a sort of all
rows. The SKU of an item record has no place in the key of the digest, where it could undo the
reduction. Every join works on such reduced rows, is an equi join on item or SKU, and is left to the optimizer: broadcast if the
staged table is small, else sort-merge with skew splitting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.sources.staging import stage

ITEM_PHASES = (1, 4, 5)
SKU_PHASES = (2, 3)
#: Item phases which are read before any SKU phase.
BASE_PHASES = tuple(phase for phase in ITEM_PHASES if phase < min(SKU_PHASES))


def item_records(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("phase").isin(*ITEM_PHASES))


def sku_records(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("phase").isin(*SKU_PHASES))


def digest(feed: DataFrame) -> DataFrame:
    """First and last ordinal and last quantity per phase, key and branch.

    The key is the item in an item phase and the SKU in a SKU phase; the other one is NULL.
    """
    of_item = F.col("phase").isin(*ITEM_PHASES)
    return feed.groupBy(
        "phase",
        F.when(of_item, F.col("item")).alias("item"),
        F.when(~of_item, F.col("sku")).alias("sku"),
        "branch",
    ).agg(
        F.min("ord").alias("first_ord"),
        F.max("ord").alias("last_ord"),
        F.max_by("qty", "ord").alias("qty"),
    )


def merged_digest(parts: DataFrame) -> DataFrame:
    """One digest of many, whose rows may share keys."""
    return parts.groupBy("phase", "item", "sku", "branch").agg(
        F.min("first_ord").alias("first_ord"),
        F.max("last_ord").alias("last_ord"),
        F.max_by("qty", "last_ord").alias("qty"),
    )


def first_records(feed: DataFrame) -> DataFrame:
    """First item-phase record of every item: the first of each SKU, and the first of those."""
    by_sku = item_records(feed).groupBy("item", "sku").agg(
        F.min("ord").alias("ord"), F.min("phase").alias("phase")
    )
    return first_of_items(by_sku)


def first_of_items(by_sku: DataFrame) -> DataFrame:
    """The first record of every item, from the first ones of each SKU (item, sku, ord, phase)."""
    return by_sku.groupBy("item").agg(
        F.min_by("sku", "ord").alias("sku"),
        F.min("ord").alias("ord"),
        F.min("phase").alias("phase"),
    )


def sku_heads(digested: DataFrame, firsts: DataFrame) -> DataFrame:
    """The entry which each SKU of a SKU phase belongs to.

    Columns: sku, first_ord, item and entry_ord of the entry, is_new. Item and entry_ord are NULL
    for a SKU which is dropped because an item has that name.
    """
    base = firsts.where(F.col("phase").isin(*BASE_PHASES))
    known = base.groupBy("sku").agg(
        F.min_by("item", "ord").alias("known_item"), F.min("ord").alias("known_ord")
    )
    names = base.select(F.col("item").alias("sku"), F.lit(True).alias("is_name"))
    wanted = sku_records(digested).groupBy("sku").agg(F.min("first_ord").alias("first_ord"))
    is_new = F.col("known_ord").isNull() & F.col("is_name").isNull()
    return (
        wanted.join(known, "sku", "left")
        .join(names, "sku", "left")
        .select(
            "sku",
            "first_ord",
            F.when(is_new, F.col("sku")).otherwise(F.col("known_item")).alias("item"),
            F.when(is_new, F.col("first_ord")).otherwise(F.col("known_ord")).alias("entry_ord"),
            is_new.alias("is_new"),
        )
    )


def new_sku_entries(heads: DataFrame) -> DataFrame:
    return heads.where("is_new").select("sku", F.col("first_ord").alias("ord"))


def item_entries(firsts: DataFrame, heads: DataFrame) -> DataFrame:
    """One entry per item: its SKU and the ordinal at which it was opened."""
    opened = new_sku_entries(heads).select(F.col("sku").alias("item"), "sku", "ord")
    return (
        firsts.select("item", "sku", "ord")
        .unionByName(opened)
        .groupBy("item")
        .agg(F.min_by("sku", "ord").alias("sku"), F.min("ord").alias("entry_ord"))
    )


def entry_quantities(digested: DataFrame, heads: DataFrame) -> DataFrame:
    """Last quantity per entry and branch."""
    by_item = item_records(digested).select("item", "branch", "last_ord", "qty")
    by_sku = (
        sku_records(digested)
        .select("sku", "branch", "last_ord", "qty")
        .join(heads.where(F.col("item").isNotNull()).select("sku", "item"), "sku")
        .select("item", "branch", "last_ord", "qty")
    )
    return by_item.unionByName(by_sku).groupBy("item", "branch").agg(
        F.max_by("qty", "last_ord").alias("qty")
    )


def merged_quantities(quantities: DataFrame, entries: DataFrame) -> DataFrame:
    """Quantity per SKU and branch: the entry opened last wins."""
    return (
        quantities.join(entries, "item")
        .groupBy("sku", "branch")
        .agg(F.max_by("qty", "entry_ord").alias("qty"))
    )


def sku_names(entries: DataFrame) -> DataFrame:
    """Item name and opening ordinal of each SKU, from its first entry."""
    return entries.groupBy("sku").agg(
        F.min_by("item", "entry_ord").alias("item"), F.min("entry_ord").alias("entry_ord")
    )


def last_per_branch(feed: DataFrame) -> DataFrame:
    """Last quantity per item and branch, over the records which name an item."""
    return (
        feed.where(F.col("item").isNotNull())
        .groupBy("item", "branch")
        .agg(F.max_by("qty", "ord").alias("qty"))
    )


@dataclass(frozen=True)
class Reconciliation:
    """The feed and its staged reductions."""

    feed: DataFrame
    digest: DataFrame
    firsts: DataFrame
    heads: DataFrame
    entries: DataFrame

    def snapshot(self) -> DataFrame:
        """Long form: sku, item, branch, qty, entry_ord."""
        quantities = merged_quantities(entry_quantities(self.digest, self.heads), self.entries)
        return quantities.join(sku_names(self.entries), "sku").select(
            "sku", "item", "branch", "qty", "entry_ord"
        )

    def resolved_by_item(self) -> DataFrame:
        """Every item-phase record with the SKU of its entry."""
        records = item_records(self.feed).select("ord", "item", "branch", "qty")
        return records.join(self.entries.select("item", "sku"), "item").select(
            "ord", "sku", "branch", "qty"
        )

    def resolved_by_sku(self) -> DataFrame:
        """Every SKU-phase record with the entry it belongs to."""
        heads = self.heads.where(F.col("entry_ord").isNotNull()).select("sku", "entry_ord")
        records = sku_records(self.feed).select("ord", "sku", "branch", "qty")
        return records.join(heads, "sku").select("ord", "sku", "entry_ord", "branch", "qty")

    def dropped(self) -> DataFrame:
        """SKU-phase records dropped because an item has the SKU as its name."""
        clashes = self.heads.where(F.col("entry_ord").isNull()).select("sku")
        return sku_records(self.feed).join(clashes, "sku", "left_semi")


def reconcile(feed: DataFrame) -> Reconciliation:
    """Reduce a clean feed to its entries; see the module text for the rules."""
    return reconcile_reduced(feed, digest(feed), first_records(feed))


def reconcile_reduced(feed: DataFrame, digested: DataFrame, firsts: DataFrame) -> Reconciliation:
    """The entries of a feed whose digest and first records are known. The feed itself is read only
    for questions to single records."""
    digested, firsts = stage(digested, "digest"), stage(firsts, "first-records")
    heads = stage(sku_heads(digested, firsts), "sku-heads")
    entries = stage(item_entries(firsts, heads), "entries")
    return Reconciliation(feed, digested, firsts, heads, entries)


def nested(snapshot: DataFrame) -> DataFrame:
    """One row per SKU with a map from branch to quantity, and its place in the document.

    A SKU has one pair per branch name, which bounds the list.
    """
    pairs = F.collect_list(F.struct("branch", "qty"))
    return snapshot.groupBy("sku", "item", "entry_ord").agg(
        F.map_from_entries(F.sort_array(pairs)).alias("branches")
    )


def document_entries(snapshot: DataFrame) -> DataFrame:
    """SKU rows as they stand in a snapshot document; ``pairs`` become the branch map there."""
    pairs = F.sort_array(F.collect_list(F.struct("branch", "qty")))
    return snapshot.groupBy("sku", "item", "entry_ord").agg(pairs.alias("pairs")).select(
        F.col("item").alias("Item"), F.col("sku").alias("SKU"), "pairs", "entry_ord"
    )


def explode_branches(skus: DataFrame) -> DataFrame:
    """Long form of SKU rows with a branch map; a SKU without branches has no rows."""
    return skus.select("sku", "item", F.explode("branches").alias("branch", "qty"))
