"""A hierarchical Pitman-Yor language model, trained by Gibbs sampling over the whole corpus.

A token's context is the token before it, told apart by its 64-bit hash; the first one's is the end
of the text before. Each context has a restaurant whose customers are the training tokens seen there;
all of them share one parent, the restaurant of words without context, whose customers are the
tables of the others; its base is even over the training words and one unknown word.

The work is dealt out three times. Blocks of documents hold the texts, as places in a sorted list of
the block's different words. Buckets of words give every word a number, and then hold all counts of
their words, so that a word's cells, its row of the parent restaurant and its probability are in one
place. What the buckets must tell each other is the number of customers and tables of each context:
shares of contexts add them up over all buckets, and each bucket gets back those of its own contexts.
Which contexts a bucket has it tells once; from then on it sends their numbers alone. Words are told
apart by 64-bit hashes, but (word, context) pairs, which are many, hold numbers, as steps from one to
the next. Where the customers of a bucket sit is written after each round for the next one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import partitions, read, text_batches
from stockweave.sources.staging import new_path

CONTEXTS = 256  # thousand contexts of buckets in a share, where their totals are added up
BURN_IN, SAMPLES = 3, 2  # sweeps left out after the start, and averaged
EXACT, DENSE = 2048, 4  # see ``reseat``
GROUPS, GROUP = 16, 1 << 18  # in a sweep of one dish: least number of groups, customers of one at most
BLOCK_TOKENS = 1 << 21
BUCKET_BYTES = 16_000_000
STRENGTH = 1.0
END = b"\n"  # no word is white space
SEED = 11


def pack(values: np.ndarray) -> bytes:
    """An array as bytes: all first bytes, all second ones, and so on, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _pack_rising(numbers: np.ndarray, sizes: np.ndarray | None = None) -> bytes:
    """Numbers that rise within groups of the given sizes, as the steps between them."""
    steps = numbers.astype(np.uint64)
    steps[1:] -= numbers[:-1].astype(np.uint64)
    if sizes is not None:
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[starts] = numbers[starts]
    return pack(steps)


def _unpack_rising(data: bytes, sizes: np.ndarray | None = None) -> np.ndarray:
    steps = unpack(data, np.uint64)
    numbers = np.cumsum(steps, dtype=np.uint64)
    if sizes is not None and len(steps):
        sizes = sizes[sizes > 0].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        numbers -= np.repeat(numbers[starts] - steps[starts], sizes)
    return numbers


def _word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


# ---------------------------------------------------------------- blocks of documents

BLOCK_SCHEMA = "block string, bucket int, words binary, ids binary, flags binary, lengths binary, tokens binary"


@dataclass
class Block:
    """Documents which are counted together."""

    local: dict[bytes, int] = field(default_factory=dict)
    texts: list[np.ndarray] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)  # 1: held out, 2: no doc_id
    tokens: int = 0

    def add(self, doc_id: int, flag: int, text: str | None) -> None:
        words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
        words.append(END)
        known = self.local
        places = [known.setdefault(word, len(known)) for word in words]
        self.texts.append(np.array(places, dtype=np.int32))
        self.ids.append(doc_id)
        self.flags.append(flag)
        self.tokens += len(words)

    def rows(self, buckets: int, name: str) -> Iterator[dict]:
        """One row of words for each bucket, and the documents as places in the list of all words."""
        keys = np.array([_word_key(w) for w in self.local], dtype=np.uint64)
        order = np.lexsort((keys, _bucket_of(keys, buckets)))
        rank = np.empty(len(keys), dtype=np.uint32)
        rank[order] = np.arange(len(keys), dtype=np.uint32)
        lengths = np.array([len(t) for t in self.texts])
        tokens = rank[np.concatenate(self.texts)]
        self.texts.clear()
        keys = keys[order]
        empty = dict.fromkeys(("words", "ids", "flags", "lengths", "tokens"))
        ends = np.searchsorted(_bucket_of(keys, buckets), np.arange(buckets), side="right")
        for bucket, part in enumerate(np.split(keys, ends[:-1])):
            if len(part):
                yield empty | {"block": name, "bucket": bucket, "words": _pack_rising(part)}
        yield empty | {
            "block": name, "bucket": -1, "ids": pack(np.array(self.ids, dtype=np.int64)),
            "flags": pack(np.array(self.flags, dtype=np.uint8)), "lengths": pack(lengths.astype(np.int64)),
            "tokens": pack(tokens),
        }


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def count_blocks(documents: DataFrame, buckets: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, made, task = Block(), 0, TaskContext.get().partitionId()
        for part in parts:
            for doc_id, flag, text in zip(part["doc_id"], part["flag"], part["text"]):
                block.add(int(doc_id), int(flag), text)
                if block.tokens >= block_tokens:
                    yield pd.DataFrame(list(block.rows(buckets, f"{task}-{made}")))
                    block, made = Block(), made + 1
        if block.ids:
            yield pd.DataFrame(list(block.rows(buckets, f"{task}-{made}")))

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    rows = text_batches(documents).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        (held_out.cast("int") + 2 * F.col("doc_id").isNull().cast("int")).alias("flag"), "text",
    )
    return rows.mapInPandas(counted, BLOCK_SCHEMA)


# ---------------------------------------------------------------- numbers of words


NUMBERS_SCHEMA = "block string, bucket int, numbers binary, different long"


def _number(part: pd.DataFrame) -> pd.DataFrame:
    """The places of each block's words among all words of a bucket, and how many these are."""
    words = [_unpack_rising(x) for x in part["words"]]
    different, place = np.unique(np.concatenate(words), return_inverse=True)
    places = np.split(place, np.cumsum([len(x) for x in words])[:-1])
    return pd.DataFrame({
        "block": part["block"], "bucket": part["bucket"], "numbers": [_pack_rising(x) for x in places],
        "different": len(different),
    })


PAIRS_SCHEMA = "block string, bucket int, words binary, sizes binary, contexts binary, counts binary"


def _pairs_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The different (word, context) pairs of a block as sorted codes, each token's place among them,
    and the number of words by which a code has to be divided."""
    words = int(tokens.max()) + 1
    codes = tokens.astype(np.int64) * words
    codes[1:] += tokens[:-1]
    codes[0] += tokens[-1]  # the end of a text, as before every other text
    pairs, places = np.unique(codes, return_inverse=True)
    return pairs, places, words


def _pair(each: int):
    """The pairs of a block by bucket. A word's number is its bucket times ``each``, the most words that
    a bucket has, and its place there; so numbers are dense and rise with the block's own places."""
    def paired(texts: pd.DataFrame, numbered: pd.DataFrame) -> pd.DataFrame:
        row, numbered = texts.iloc[0], numbered.sort_values("bucket")
        ranks = [_unpack_rising(x) for x in numbered["numbers"]]
        buckets = numbered["bucket"].tolist()
        numbers = np.concatenate([rank + np.uint64(bucket * each) for rank, bucket in zip(ranks, buckets)])
        pairs, places, words = _pairs_of(unpack(row["tokens"], np.uint32))
        training = np.repeat((unpack(row["flags"], np.uint8) & 1) == 0, unpack(row["lengths"], np.int64))
        counts = np.bincount(places[training], minlength=len(pairs)).astype(np.uint32)
        owner, contexts = pairs // words, numbers[pairs % words]
        sizes = np.bincount(owner, minlength=words).astype(np.uint32)
        made, w0, p0 = [], 0, 0
        for bucket, rank in zip(buckets, ranks):
            w1 = w0 + len(rank)
            p1 = p0 + int(sizes[w0:w1].sum())
            made.append((
                row["block"], bucket, _pack_rising(numbers[w0:w1]), pack(sizes[w0:w1]),
                _pack_rising(contexts[p0:p1], sizes[w0:w1].astype(np.int64)), pack(counts[p0:p1]),
            ))
            w0, p0 = w1, p1
        return pd.DataFrame(made, columns=["block", "bucket", "words", "sizes", "contexts", "counts"])

    return paired


# ---------------------------------------------------------------- buckets of words


@dataclass
class Cells:
    """All training counts of a bucket: sorted words, and their cells sorted by (word, context); contexts
    are places in ``keys``, the sorted numbers of all that the bucket's words have, held-out ones too."""

    words: np.ndarray
    owner: np.ndarray
    contexts: np.ndarray
    counts: np.ndarray
    keys: np.ndarray | None = None

    @property
    def codes(self) -> np.ndarray:
        return self.owner * len(self.keys) + self.contexts


CELLS_SCHEMA = "bucket int, words binary, sizes binary, contexts binary, counts binary, keys binary, n_keys long"


def _merge(part: pd.DataFrame) -> pd.DataFrame:
    """The cells of one bucket from the pairs of all blocks; what only held-out texts have is left out."""
    words = [_unpack_rising(x) for x in part["words"]]
    sizes = [unpack(x, np.uint32) for x in part["sizes"]]
    key = np.concatenate([np.repeat(w, n) for w, n in zip(words, sizes)])
    contexts = np.concatenate([_unpack_rising(x, n) for x, n in zip(part["contexts"], sizes)])
    keys, context = np.unique(contexts, return_inverse=True)
    count = np.concatenate([unpack(x, np.uint32) for x in part["counts"]]).astype(np.int64)
    seen = count > 0
    key, context, count = key[seen], context[seen], count[seen]
    words, owner = np.unique(key, return_inverse=True)
    codes, cell = np.unique(owner * len(keys) + context, return_inverse=True)
    counts = np.bincount(cell, count, minlength=len(codes)).astype(np.int64)
    sizes = np.bincount(codes // len(keys), minlength=len(words))
    return pd.DataFrame({
        "bucket": part["bucket"].iloc[:1], "words": [_pack_rising(words)], "sizes": [pack(sizes.astype(np.uint32))],
        "contexts": [_pack_rising(codes % len(keys), sizes)], "counts": [pack(counts)],
        "keys": [_pack_rising(keys)], "n_keys": [len(keys)],
    })


def _cells(row) -> Cells:
    sizes = unpack(row["sizes"], np.uint32)
    return Cells(
        _unpack_rising(row["words"]), np.repeat(np.arange(len(sizes)), sizes),
        _unpack_rising(row["contexts"], sizes).astype(np.int64), unpack(row["counts"], np.int64), _unpack_rising(row["keys"]),
    )


# ---------------------------------------------------------------- the restaurants


@dataclass
class Totals:
    """What a bucket knows of the others: customers of its contexts and the discounts, and for each round
    the tables of its contexts and the customers and tables of the parent restaurant."""

    vocabulary: int
    tokens: int
    customers: np.ndarray
    discount: float
    parent_discount: float
    rounds: list[tuple[np.ndarray, int, int]] = field(default_factory=list)

    def openness(self, at: int) -> np.ndarray:
        """How much a context leaves to the parent, by context."""
        return (STRENGTH + self.discount * self.rounds[at][0]) / (STRENGTH + self.customers)

    def parent(self, at: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probabilities of words with so many customers and tables."""
        _, all_customers, all_tables = self.rounds[at]
        even = (STRENGTH + self.parent_discount * all_tables) / (self.vocabulary + 1)
        return (customers - self.parent_discount * tables + even) / (STRENGTH + all_customers)


@lru_cache(maxsize=4)
def _seatings(discount: float) -> np.ndarray:
    """By customers and tables, up to ``EXACT``: the log of how many ways there are to seat them, each
    weighted with the product over its tables of (1 - discount) (2 - discount) ... (size - 1 - discount)."""
    ways = np.full((EXACT + 1, EXACT + 1), -np.inf)
    ways[1, 1] = 0.0
    for n in range(2, EXACT + 1):
        joins = ways[n - 1, 1:n] + np.log(n - 1 - discount * np.arange(1, n))
        ways[n, 1:n] = np.logaddexp(joins, ways[n - 1, : n - 1])
        ways[n, n] = ways[n - 1, n - 1]
    return ways


def reseat(
    customers: np.ndarray, tables: np.ndarray, opening: np.ndarray, discount: float, rng,
    seats: dict[int, np.ndarray] | None = None,
) -> np.ndarray:
    """New numbers of tables of many dishes after all their customers have been seated again.

    ``customers`` and ``tables`` are those of each dish, ``opening`` is the weight of a new table. Of
    a dish with up to ``EXACT`` customers the number is drawn from its exact distribution, whatever
    it was. Where more sit already, the next customer changes the weight of t tables by the factor
    1 - discount t / seated, or opens one with the weight opening / seated; over many customers that
    leaves each table with the weight (seated / customers) ** discount, and adds a Poisson number of
    new ones. So a larger dish draws the tables of its first ``EXACT`` customers in the light of all
    that follow, then the new tables of these. The first ones must be ``DENSE`` times ``opening`` at
    least; where that is more than ``EXACT``, they get up in groups, each of them once, and sit down
    again (see ``_sweep``). ``seats`` keeps the sizes of their tables, by dish, between the sweeps.

    How far the drawn number is from the exact distribution, as the total variation: below 0.001 for
    an opening up to 5, below 0.01 up to 40 and every discount that ``_discount`` gives; above that the
    mean is off by less than 4 % at the least discount, 0.1, and by less than 0.1 % from 0.6 on.
    """
    tables, seats = tables.copy(), {} if seats is None else seats
    first = np.minimum(customers, np.maximum(EXACT, np.ceil(DENSE * opening))).astype(np.int64)
    thinned = (first / np.maximum(customers, 1)) ** discount
    weight = opening * thinned
    tables[customers == 1] = 1
    few = np.flatnonzero((first > 1) & (first <= EXACT))
    few = few[np.argsort(first[few], kind="stable")]
    sizes, starts = np.unique(first[few], return_index=True)
    for size, dishes in zip(sizes.tolist(), np.split(few, starts[1:])):
        ways, step = _seatings(discount)[size, 1 : size + 1], max(1, (1 << 19) // size)
        for at in range(0, len(dishes), step):
            some = dishes[at : at + step]
            chance = ways + np.log(weight[some])[:, None] * np.arange(1, size + 1)
            chance = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            tables[some] = 1 + (chance < rng.random(len(some))[:, None] * chance[:, -1:]).sum(axis=1)
    for dish in np.flatnonzero(first > EXACT).tolist():
        seated = _fill(seats.get(dish, np.zeros(0, dtype=np.int64)), int(first[dish]), weight[dish], discount, rng)
        seats[dish] = _sweep(seated, weight[dish], discount, rng)
        tables[dish] = len(seats[dish])
    many = np.flatnonzero(customers > first)
    tables[many] += rng.poisson(opening[many] / discount * (1 - thinned[many]))
    return np.minimum(tables, customers)


def _fill(seated: np.ndarray, customers: int, opening: float, discount: float, rng) -> np.ndarray:
    """As many customers as there are now: some leave at random, or new ones sit down."""
    while (surplus := int(seated.sum()) - customers) > 0:
        gone = np.minimum(rng.multinomial(surplus, seated / seated.sum()), seated)
        seated = seated - gone
        seated = seated[seated > 0]
    while surplus < 0:
        more = min(-surplus, GROUP)
        opens = _openings(int(seated.sum()), len(seated), more, opening, discount, rng)
        seated = np.concatenate(_sit(seated, opens, discount, rng))
        surplus += more
    return seated


def _sweep(sizes: np.ndarray, opening: float, discount: float, rng) -> np.ndarray:
    """The tables of one dish after each customer has got up once, in random groups.

    A group sits down one by one, at a new table with weight ``opening``, else at an old one with
    weight size - discount. The new seats are taken with the Metropolis-Hastings chance, which
    makes up for the sums of these weights, so the exact distribution stays as it is.
    """
    waiting, moved = sizes, np.zeros_like(sizes)
    for groups in range(max(GROUPS, -(-int(sizes.sum()) // GROUP)), 0, -1):
        up = rng.binomial(waiting, 1 / groups)
        waiting = waiting - up
        rest, size = waiting + moved, int(up.sum())
        stays = rest > 0
        count, used = int(rest.sum()), int(stays.sum())
        new = _openings(count, used, size, opening, discount, rng)
        # the way back: where the first customer of each table that is empty now stood in the group
        empty = up[~stays & (up > 0)]
        old = np.zeros(size, dtype=bool)
        if len(empty):
            places = rng.choice(size, int(empty.sum()), replace=False)
            old[np.minimum.reduceat(places, np.cumsum(empty) - empty)] = True
        gain = _log_weights(count, used, new, opening, discount) - _log_weights(count, used, old, opening, discount)
        if np.log1p(-rng.random()) < gain:
            joined, opened = _sit(rest[stays], new, discount, rng)
            waiting = np.append(waiting[stays], np.zeros_like(opened))
            moved = np.append(joined, opened) - waiting
        else:
            moved = moved + up
    return moved[moved > 0]


def _openings(count: int, used: int, more: int, opening: float, discount: float, rng) -> np.ndarray:
    """Which of the next customers open a table, after ``count`` at ``used`` tables."""
    drawn, seated = rng.random(more), opening + count + np.arange(more)
    opens = np.zeros(more, dtype=bool)
    while True:  # each turn is right for one customer more at least
        again = drawn * (seated - discount * (used + np.cumsum(opens) - opens)) < opening
        if (again == opens).all():
            return opens
        opens = again


def _log_weights(count: int, used: int, opens: np.ndarray, opening: float, discount: float) -> float:
    before = used + np.cumsum(opens) - opens
    return float(np.log(opening + count + np.arange(len(opens)) - discount * before).sum())


def _sit(sizes: np.ndarray, opens: np.ndarray, discount: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the old and of the new tables, after customers who open a table where ``opens`` says so.

    The newest table and all older ones form an urn, then the next newest and those older than it.
    """
    count, used, places = int(sizes.sum()), len(sizes), np.flatnonzero(opens)
    opened = np.ones(len(places), dtype=np.int64)
    older = count + places - discount * (used + np.arange(len(places)))
    share = np.where(older > 0, rng.beta(1 - discount, np.maximum(older, 1e-300)), 1.0)
    joining, end = 0, len(opens)
    for at in range(len(places) - 1, -1, -1):
        joining += end - int(places[at]) - 1
        end = int(places[at])
        here = int(rng.binomial(joining, share[at]))
        opened[at] += here
        joining -= here
    joining += end
    if used:
        weight = rng.standard_gamma(sizes - discount)
        sizes = sizes + rng.multinomial(joining, weight / weight.sum())
    return sizes, opened


@dataclass
class State:
    """Where the customers of a bucket sit after a round: the tables of its cells and, in the parent
    restaurant, of its words; of dishes with more than ``EXACT`` customers the sizes of the tables."""

    tables: np.ndarray
    parent_tables: np.ndarray
    seats: dict[int, np.ndarray] = field(default_factory=dict)
    parent_seats: dict[int, np.ndarray] = field(default_factory=dict)

    def customers(self, cells: Cells) -> np.ndarray:
        """Of the parent restaurant, by word."""
        return np.bincount(cells.owner, self.tables, minlength=len(cells.words)).astype(np.int64)

    def packed(self) -> list[bytes]:
        return [pack(self.tables), pack(self.parent_tables), _pack_seats(self.seats), _pack_seats(self.parent_seats)]

    @classmethod
    def unpacked(cls, parts) -> State:
        tables, parent_tables, seats, parent_seats = parts
        return cls(unpack(tables, np.int64), unpack(parent_tables, np.int64), _unpack_seats(seats), _unpack_seats(parent_seats))


def _pack_seats(seats: dict[int, np.ndarray]) -> bytes:
    lengths = [len(x) for x in seats.values()]
    return pack(np.concatenate([[len(seats)], list(seats), lengths, *seats.values()]).astype(np.int64))


def _unpack_seats(data: bytes) -> dict[int, np.ndarray]:
    numbers = unpack(data, np.int64)
    n = int(numbers[0])
    sizes = np.split(numbers[1 + 2 * n :], np.cumsum(numbers[1 + n : 1 + 2 * n])[:-1])
    return dict(zip(numbers[1 : 1 + n].tolist(), sizes))


def start(cells: Cells) -> State:
    """Round 0 gives every cell and every word one table."""
    return State(np.ones(len(cells.counts), dtype=np.int64), np.ones(len(cells.words), dtype=np.int64))


def sweep(cells: Cells, totals: Totals, bucket: int, state: State) -> State:
    """The state after one more round: it sweeps the contexts, with the parent as the last round has
    left it, and then the parent."""
    at = len(totals.rounds) - 1
    rng = np.random.default_rng([SEED, bucket, at])
    likely = totals.parent(at, state.customers(cells), state.parent_tables)
    opening = (STRENGTH + totals.discount * totals.rounds[at][0][cells.contexts]) * likely[cells.owner]
    seats, parent_seats = dict(state.seats), dict(state.parent_seats)
    after = State(reseat(cells.counts, state.tables, opening, totals.discount, rng, seats), state.parent_tables, seats, parent_seats)
    customers = after.customers(cells)
    even = (STRENGTH + totals.parent_discount * totals.rounds[at][2]) / (totals.vocabulary + 1)
    after.parent_tables = reseat(
        customers, np.minimum(state.parent_tables, customers), np.full(len(customers), even), totals.parent_discount, rng,
        parent_seats,
    )
    return after


# ---------------------------------------------------------------- training


PASSED_SCHEMA = "share int, bucket int, keys binary, sums binary, numbers array<long>, state array<binary>"
ADDED_SCHEMA = "share int, bucket int, sums binary, places binary, numbers array<long>"


def _share_of(keys: np.ndarray, shares: int) -> np.ndarray:
    return (keys % np.uint64(shares)).astype(np.int64)


def _passed(
    bucket: int, cells: Cells, numbers: tuple, values: np.ndarray, shares: int, state: State | None = None
) -> pd.DataFrame:
    """What a bucket tells the others: its numbers, and a value for each of its contexts, by share. The
    keys of the contexts are told once, before there is a state; later the values stand in the same
    order. The state (share -2) is for the bucket itself."""
    sums = np.bincount(cells.contexts, values, minlength=len(cells.keys)).astype(np.int64)
    share = _share_of(cells.keys, shares)
    order = np.argsort(share, kind="stable")
    ends = np.searchsorted(share[order], np.arange(shares + 1))
    rows = [(-1, bucket, None, None, [int(n) for n in numbers], None)]
    for at in range(shares):
        here = order[ends[at] : ends[at + 1]]
        if len(here):
            rows.append((at, bucket, None if state else _pack_rising(cells.keys[here]), pack(sums[here]), None, None))
    if state:
        rows.append((-2, bucket, None, None, None, state.packed()))
    return pd.DataFrame(rows, columns=["share", "bucket", "keys", "sums", "numbers", "state"])


def _sum_of_numbers(part: pd.DataFrame) -> pd.DataFrame:
    numbers = np.sum(part["numbers"].tolist(), axis=0)
    return pd.DataFrame({"share": [-1], "bucket": [-1], "sums": [None], "places": [None], "numbers": [numbers.tolist()]})


def _summed(places: list[np.ndarray], sums: list[np.ndarray]) -> list[bytes]:
    """For each bucket the totals of its contexts, of which ``places`` are the numbers in the share."""
    totals = np.bincount(np.concatenate(places), np.concatenate(sums)).astype(np.int64)
    return [pack(totals[place]) for place in places]


def _place_contexts(part: pd.DataFrame) -> pd.DataFrame:
    """The first totals of one share, and which of its contexts each bucket has: numbers in the order of
    the keys, so the steps between them are small. Of share -1 the sums of the numbers."""
    if part["share"].iloc[0] < 0:
        return _sum_of_numbers(part)
    keys = [_unpack_rising(key) for key in part["keys"]]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    places = np.split(place, np.cumsum([len(key) for key in keys])[:-1])
    return pd.DataFrame({
        "share": part["share"], "bucket": part["bucket"],
        "sums": _summed(places, [unpack(x, np.int64) for x in part["sums"]]),
        "places": [_pack_rising(x) for x in places], "numbers": None,
    })


def _add_up(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The totals of one share in a later round; ``known`` has the places of its buckets."""
    if part.empty or part["share"].iloc[0] < 0:
        return _sum_of_numbers(part)
    listed = dict(zip(known["bucket"], known["places"]))
    places = [_unpack_rising(listed[bucket]).astype(np.int64) for bucket in part["bucket"]]
    return pd.DataFrame({
        "share": part["share"], "bucket": part["bucket"],
        "sums": _summed(places, [unpack(x, np.int64) for x in part["sums"]]), "places": None, "numbers": None,
    })


def _told(shared: Totals, cells: Cells, history: pd.DataFrame, shares: int) -> Totals:
    """The totals with the numbers of a bucket's own contexts, in the rounds that the history has; round
    -1 has customers."""
    order = np.argsort(_share_of(cells.keys, shares), kind="stable")
    found = {}
    for at, rows in history.sort_values(["at", "share"]).groupby("at"):
        found[int(at)] = np.empty(len(order), dtype=np.float64)
        found[int(at)][order] = np.concatenate([unpack(x, np.int64) for x in rows["sums"]])
    rounds = [(found.get(at), customers, tables) for at, (_, customers, tables) in enumerate(shared.rounds)]
    return replace(shared, customers=found[-1], rounds=rounds)


def _first_numbers(cells: Cells) -> tuple:
    different = np.bincount(cells.owner, minlength=len(cells.words))
    return (
        len(cells.words), cells.counts.sum(), (cells.counts == 1).sum(), (cells.counts == 2).sum(),
        (different == 1).sum(), (different == 2).sum(),
    )


def _discount(once: int, twice: int) -> float:
    """The usual estimate from how many counts are one and two."""
    return min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)


def train(cells: DataFrame, rounds: int, shares: int, tasks: int) -> tuple[Totals, DataFrame]:
    """The totals that are single numbers, and for each bucket the totals of its contexts and its own
    state (share -2) after all rounds."""
    spark = cells.sparkSession
    dealt = cells.repartition(tasks, "bucket").groupBy("bucket")
    columns = ["at", "bucket", "share", "sums", "state"]

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.to_dict("records"):
                found = _cells(row)
                yield _passed(row["bucket"], found, _first_numbers(found), found.counts, shares)

    def by_share(table: DataFrame):
        return table.repartition(min(shares + 1, tasks), "share").groupBy("share")

    def told(summed: DataFrame, at: int) -> tuple[list[int], DataFrame]:
        added = _written(summed, "totals")
        numbers = added.filter("share < 0").select("numbers").collect()
        spark._jvm.System.gc()  # lets Spark remove the shuffle files of what is written now
        history = added.filter("share >= 0").withColumn("at", F.lit(at)).withColumn("state", F.lit(None).cast("array<binary>"))
        return numbers[0][0] if numbers else [], history

    passed = cells.mapInPandas(first, PASSED_SCHEMA).drop("state")
    numbers, history = told(by_share(passed).applyInPandas(_place_contexts, ADDED_SCHEMA), -1)
    places = history.select("share", "bucket", "places")
    history = history.select(columns)
    words, tokens, once, twice, in_one, in_two = numbers or [0] * 6
    totals = Totals(words, tokens, np.zeros(0), _discount(once, twice), _discount(in_one, in_two))
    for done in range(rounds + 1):
        def later(part: pd.DataFrame, past: pd.DataFrame) -> pd.DataFrame:
            found, bucket = _cells(part.iloc[0]), int(part["bucket"].iloc[0])
            if totals.rounds:
                own = past["share"] < 0
                state = State.unpacked(past[own]["state"].iloc[0])
                state = sweep(found, _told(totals, found, past[~own], shares), bucket, state)
            else:
                state = start(found)
            numbers = state.customers(found).sum(), state.parent_tables.sum()
            return _passed(bucket, found, numbers, state.tables, shares, state)

        past = history.filter(F.col("at").isin(-1, done - 1)).repartition(tasks, "bucket").groupBy("bucket")
        passed = _written(dealt.cogroup(past).applyInPandas(later, PASSED_SCHEMA), "passed")
        sums = passed.filter("share >= -1").select("share", "bucket", "sums", "numbers")
        numbers, added = told(by_share(sums).cogroup(by_share(places)).applyInPandas(_add_up, ADDED_SCHEMA), done)
        totals.rounds.append((np.zeros(0), *(numbers or [0, 0])))
        states = passed.filter("share = -2").withColumn("at", F.lit(done))
        history = history.unionByName(added.select(columns)).unionByName(states.select(columns))
    return totals, history


# ---------------------------------------------------------------- scoring


def _answer(shared: Totals, samples: int, shares: int):
    """For each block: the mean probability of its pairs in a bucket and the counts of its words."""
    rounds = range(len(shared.rounds))[-samples:]

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        cells, bucket = _cells(known.iloc[0]), int(known["bucket"].iloc[0])
        past, asked = asked[asked["at"].notna()], asked[asked["at"].isna()]
        states = past[past["share"] < 0].sort_values("at")["state"]
        totals = _told(shared, cells, past[past["share"] >= 0], shares)
        tables, likely = np.zeros(len(cells.counts)), []
        for at, state in zip(rounds, map(State.unpacked, states)):
            tables += state.tables / len(rounds)
            parent = totals.parent(at, state.customers(cells), state.parent_tables)
            likely.append(np.append(parent, totals.parent(at, np.zeros(1), np.zeros(1))))
        own = (cells.counts - totals.discount * tables) / (STRENGTH + totals.customers[cells.contexts])
        word_counts = np.append(np.bincount(cells.owner, cells.counts, minlength=len(cells.words)), 0).astype(np.uint32)
        codes, made = cells.codes, []
        for row in asked.itertuples(index=False):
            word = _find(cells.words, _unpack_rising(row.words))  # the place behind the last: unknown
            sizes = unpack(row.sizes, np.uint32)
            pair_word = np.repeat(word, sizes)
            context = np.searchsorted(cells.keys, _unpack_rising(row.contexts, sizes))
            cell = _find(codes, pair_word * len(cells.keys) + context)
            chance = np.append(own, 0.0)[cell]
            for at, parent in zip(rounds, likely):
                chance += totals.openness(at)[context] * parent[pair_word] / len(rounds)
            made.append((row.block, row.bucket, pack(np.log10(chance).astype(np.float32)), pack(word_counts[word])))
        return pd.DataFrame(made, columns=["block", "bucket", "scores", "counts"])

    return answer


def _find(among: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in a sorted array; its length for what it does not have."""
    at = np.searchsorted(among, wanted)
    inside = at < len(among)
    inside[inside] = among[at[inside]] == wanted[inside]
    return np.where(inside, at, len(among))


def _read_scores(totals: Totals):
    def scored(documents: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row, answers = documents.iloc[0], answers.sort_values("bucket")
        score = np.concatenate([unpack(x, np.float32) for x in answers["scores"]]).astype(np.float64)
        counts = np.concatenate([unpack(x, np.uint32) for x in answers["counts"]]).astype(np.float64)
        base = np.log10((counts + 0.5) / (totals.tokens + 0.5 * (totals.vocabulary + 1)))
        tokens, lengths = unpack(row["tokens"], np.uint32), unpack(row["lengths"], np.int64)
        _, places, _ = _pairs_of(tokens)
        starts, flags = np.cumsum(lengths) - lengths, unpack(row["flags"], np.uint8)
        return pd.DataFrame({
            "id": unpack(row["ids"], np.int64), "has_id": (flags & 2) == 0, "held_out": (flags & 1) == 1,
            "n_tokens": lengths, "n_known": np.add.reduceat((counts > 0).astype(np.int64)[tokens], starts),
            "base_score": np.add.reduceat(base[tokens], starts), "score": np.add.reduceat(score[places], starts),
        })

    return scored


def score(documents: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Tokens are the words, A-Z lower-cased, and one end. The model learns from the documents whose
    crc32(doc_id as text) mod 5 is not 1 and scores all: ``score`` is the sum of log10 of the
    probabilities, each averaged over the last ``samples`` rounds; ``burn_in`` sweeps over all customers
    come before them. ``base_score`` is that of single
    words with 0.5 added to each count. A null or blank text is an end alone; a null doc_id counts as
    the empty string; rows with one doc_id are separate documents; an empty table gives an empty
    one. The tables of a word with over ``EXACT`` customers in a context are drawn with the small error
    that ``reseat`` states. Words are told apart by 64-bit hashes. Texts are read whole, however long; one text is never
    split over blocks.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    tasks = max(4 * spark.sparkContext.defaultParallelism, partitions(spark))
    blocks = _written(count_blocks(documents, buckets), "blocks")
    texts = blocks.filter("bucket < 0").drop("bucket", "words")
    words = blocks.filter("bucket >= 0").select("block", "bucket", "words")
    per_bucket = min(buckets, tasks)
    numbered = words.repartition(per_bucket, "bucket").groupBy("bucket").applyInPandas(_number, NUMBERS_SCHEMA)
    numbered = _written(numbered, "numbers")
    each = numbered.agg(F.max("different")).first()[0] or 0
    spark._jvm.System.gc()  # see ``train``
    by_block = texts.select("block", "flags", "lengths", "tokens").repartition(tasks, "block").groupBy("block")
    pairs = by_block.cogroup(
        numbered.select("block", "bucket", "numbers").repartition(tasks, "block").groupBy("block")
    ).applyInPandas(_pair(each), PAIRS_SCHEMA)
    pairs = _written(pairs, "pairs")
    spark._jvm.System.gc()
    merged = pairs.drop("block").repartition(per_bucket, "bucket").groupBy("bucket").applyInPandas(_merge, CELLS_SCHEMA)
    cells = _written(merged, "cells")
    spark._jvm.System.gc()
    shares = max(1, -(-(cells.agg(F.sum("n_keys")).first()[0] or 0) // (CONTEXTS << 10)))
    cells = cells.drop("n_keys")
    totals, history = train(cells, burn_in + samples, shares, per_bucket)
    history = history.filter((F.col("at") < 0) | (F.col("at") > burn_in))
    asked = pairs.select("block", "bucket", "words", "sizes", "contexts").unionByName(history, allowMissingColumns=True)
    answers = asked.repartition(per_bucket, "bucket").groupBy("bucket").cogroup(
        cells.repartition(per_bucket, "bucket").groupBy("bucket")
    ).applyInPandas(_answer(totals, samples, shares), "block string, bucket int, scores binary, counts binary")
    scored = texts.repartition(tasks, "block").groupBy("block").cogroup(
        answers.repartition(tasks, "block").groupBy("block")
    ).applyInPandas(
        _read_scores(totals),
        "id long, has_id boolean, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.select(
        F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    """Written once, without compression: the columns are compressed already."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def perplexity(scored: DataFrame) -> float:
    """Of the held-out documents."""
    sums = scored.filter("held_out").agg(F.sum("score").alias("score"), F.sum("n_tokens").alias("n")).first()
    return 10 ** (-sums["score"] / sums["n"]) if sums["n"] else float("nan")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"))
