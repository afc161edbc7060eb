"""Personal data: known forms are seeds, the contexts they stand in become patterns, and trusted patterns
discover identifiers of other forms."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: What a pattern's confidence has to reach to be trusted, and rounds of scoring at most.
TRUST, ROUNDS = 0.7, 6
#: Width of the confidence interval in standard deviations.
DEVIATIONS = 1.96
SLOT = "<>"

LOCAL_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_FORM = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_FORM = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_FORM = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile("[^0-9]+")

#: What looks like an identifier: an address spelt out, groups of digits, letters mixed with digits.
LOOSE = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?P<mail>[A-Za-z0-9._%+-]++(?:@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
    r"|(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z][A-Za-z0-9-]*+(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z][A-Za-z0-9-]*+)++))"
    r"|(?<![A-Za-z0-9])(?P<hex>[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7})(?![A-Za-z0-9:])"
    r"|(?<![A-Za-z0-9])(?P<number>[0-9](?:[\x20().:/-]{0,2}[0-9])++)(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?P<mixed>(?=[A-Za-z]*+[0-9])[A-Za-z0-9_-]{6,})"
)
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
SPELT_AT, SPELT_DOT = re.compile(r"\x20?[\[(]at[\])]\x20?|\x20at\x20"), re.compile(r"\x20?[\[(]dot[\])]\x20?|\x20dot\x20")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")

FOUND = (
    "base array<struct<kind:int,start:int,end:int>>, "
    "mentions array<struct<instance:string,seed:int,fits:int,start:int,end:int,patterns:array<string>>>"
)


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of local part, @ and dotted domain; each @ is looked at once, so it is linear."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        local = LOCAL_BACKWARDS.match(text[last:at][::-1])
        domain = local and DOMAIN.match(text, at + 1)
        if domain:
            found.append((at - local.end(), domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return found


def small_parts(address: str) -> bool:
    """Whether no part of a dotted address is above 255."""
    parts = [part.lstrip("0") for part in address.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def passes_luhn(digits: str) -> bool:
    """Whether the check digit of a card number fits."""
    doubled = sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all that has a known form, by kind and start.

    Of every kind the matches are the leftmost ones that do not overlap; a match that fails its
    kind's check (parts up to 255; 16 to 19 digits with a fitting check digit; 8 to 15 digits) is
    dropped, and nothing inside it is tried again.
    """
    found = [(EMAIL, *span) for span in emails(text)]
    found += [(IP, *m.span()) for m in IP_FORM.finditer(text) if small_parts(m[0])]
    for match in CARD_FORM.finditer(text):
        if match.end() - match.start() >= 16:
            digits = NO_DIGIT.sub("", match[0])
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((CARD, *match.span()))
    found += [(PHONE, *m.span()) for m in PHONE_FORM.finditer(text) if 8 <= len(NO_DIGIT.sub("", m[0])) <= 15]
    return found


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, int]]:
    """(instance, the kinds whose form it comes near as bits, start, end) of all that looks like an
    identifier between the ``base`` spans."""
    at = 0
    for start, end in sorted((s, e) for _, s, e in base) + [(len(text), len(text))]:
        for match in LOOSE.finditer(text, at, max(at, start)):
            whole, form = match[0], match.lastgroup
            digits = NO_DIGIT.sub("", whole)
            if form == "mail":
                instance, fits = SPELT_DOT.sub(".", SPELT_AT.sub("@", whole)).lower(), 1 << EMAIL
            elif form == "hex":
                instance, fits = whole.lower(), 1 << IP
            elif form == "number":
                if DOTTED.fullmatch(whole):
                    instance, fits = whole, 1 << IP
                elif len(digits) < 7:
                    continue
                else:
                    instance = digits
                    fits = (1 << PHONE if len(digits) <= 15 else 0) | (1 << CARD if 12 <= len(digits) <= 19 else 0)
            else:
                instance, fits = whole.lower(), 0
            yield instance, fits, *match.span()
        at = max(at, end)


def _near(text: str, at: int, count: int, step: int) -> list[str]:
    """The ``count`` tokens before (``step`` -1) or after (1) a place, whole ones; '' beyond the text."""
    window = 64
    while True:
        part = text[max(0, at - window) : at] if step < 0 else text[at : at + window]
        tokens = TOKEN.findall(part)
        whole = window >= (at if step < 0 else len(text) - at)
        if whole or len(tokens) > count:  # the farthest token may be cut, it is not one of them
            break
        window *= 2
    tokens = [""] * count + tokens if step < 0 else tokens + [""] * count
    picked = tokens[-count:] if step < 0 else tokens[:count]
    return ["0" if x.isdigit() else x.lower() for x in picked]


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns that a span stands in: the two tokens before it, and its neighbours."""
    second, first = _near(text, start, 2, -1)
    return [f"{second} {first} {SLOT}", f"{first} {SLOT} {_near(text, end, 1, 1)[0]}"]


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """All spans that look like an identifier, with their instance and their patterns."""
    found = []
    for kind, start, end in base:
        part = text[start:end]
        instance = part.lower() if kind in (EMAIL, IP) else NO_DIGIT.sub("", part)
        found.append((instance, 1 << kind, 0, start, end, contexts(text, start, end)))
    for instance, fits, start, end in loose_spans(text, base):
        found.append((instance, 0, fits, start, end, contexts(text, start, end)))
    return found


def _found_column(text: Column) -> Column:
    @F.pandas_udf(FOUND)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            base = [base_spans(x) for x in part]
            yield pd.DataFrame({"base": base, "mentions": [mentions(x, spans) for x, spans in zip(part, base)]}, dtype=object)

    return found(F.coalesce(text, F.lit("")))


def mention_graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph of patterns and instances: (pattern, instance), distinct, and (instance, seed, fits),
    with the kinds that an instance is a seed of, and those whose form it comes near, as bits."""
    mention = found.select(F.explode("mentions").alias("m"))
    edges = mention.select(F.explode("m.patterns").alias("pattern"), "m.instance").distinct()
    instances = mention.groupBy("m.instance").agg(F.bit_or("m.seed").alias("seed"), F.bit_or("m.fits").alias("fits"))
    return stage(edges, "edges"), stage(instances, "instances")


def _kinds_of(bits: str) -> Column:
    """One row for each kind whose bit is set."""
    kinds = F.array(*[F.lit(kind) for kind in range(len(KINDS))])
    return F.explode(F.filter(kinds, lambda kind: F.getbit(bits, kind) == 1))


def _lower_bound(hits: Column, size: Column) -> Column:
    """The lower end of the Wilson interval for ``hits`` out of ``size``."""
    share, z2 = hits / size, DEVIATIONS**2
    spread = DEVIATIONS * F.sqrt(share * (1 - share) / size + z2 / (4 * size * size))
    return (share + z2 / (2 * size) - spread) / (1 + z2 / size)


def bootstrap(edges: DataFrame, instances: DataFrame, trust: float = TRUST, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, confidence) of the trusted patterns, and (instance, kind, score) of what they
    discover.

    A seed's score for its kind is 1. In each round a pattern's confidence for a kind is the lower
    bound of the share that the scores of its instances have in the number of them: so it takes some
    ten different seeds, and few strangers, to be trusted. An instance that is no seed and comes near
    the form of the kind has the score 1 minus the product of (1 - confidence) over its trusted
    patterns, and counts by that in the next round. The rounds end when nothing changes.
    """
    seeds = instances.select("instance", _kinds_of("seed").alias("kind"), F.lit(1.0).alias("score"))
    open_kinds = stage(instances.filter("seed = 0").select("instance", _kinds_of("fits").alias("kind")), "open")
    sizes = stage(edges.groupBy("pattern").agg(F.count("*").alias("size")), "sizes")
    scores, state = seeds, None
    for _ in range(rounds):
        hits = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("hits"))
        trusted = stage(
            hits.join(sizes, "pattern").select("pattern", "kind", _lower_bound(F.col("hits"), F.col("size")).alias("confidence"))
            .filter(F.col("confidence") >= trust), "trusted",
        )
        reached = edges.join(trusted, "pattern").join(open_kinds, ["instance", "kind"])
        missed = F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-12))))
        discovered = stage(reached.groupBy("instance", "kind").agg((1 - F.exp(missed)).alias("score")), "discovered")
        before, state = state, (trusted.count(), *discovered.agg(F.count("*"), F.round(F.sum("score"), 6)).first())
        if state == before or not state[1]:
            break
        scores = seeds.unionByName(discovered)
    return trusted, discovered


def find_personal_data(documents: DataFrame, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and added of every row of ``documents``: arrays of (kind, start, end).

    ``base`` are the spans of known form, as ``base_spans`` gives them; ``added`` are the spans of
    identifiers which trusted patterns discover (``bootstrap``), at every place they are mentioned,
    as the kind of the highest score, the first one of ties. Added spans never overlap base ones.
    Both are sorted by kind and start; positions count code points.

    A null text counts as empty and has no spans; texts of any length are read whole; every row
    stands for itself, but copies of a mention add nothing to a pattern's confidence. Other columns
    are not read; no rows give no rows.
    """
    found = documents.select("doc_id", _found_column(F.col("text")).alias("found"))
    found = stage(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "found.*"), "found")
    _, discovered = bootstrap(*mention_graph(found), trust, rounds)
    known = discovered.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    places = found.select("row", F.explode("mentions").alias("m")).filter("m.seed = 0 AND m.fits <> 0")
    added = places.select("row", "m.instance", "m.fits", "m.start", "m.end").join(known, "instance").filter(F.getbit("fits", "kind") == 1)
    added = added.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    nothing = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return found.select("row", "doc_id", "base").join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("added", nothing).alias("added")
    )


def trusted_patterns(documents: DataFrame, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that ``documents`` make trusted."""
    found = stage(documents.select(_found_column(F.col("text")).alias("found")).select("found.*"), "found")
    trusted, _ = bootstrap(*mention_graph(found), trust, rounds)
    return trusted.withColumn("kind", _name(F.col("kind")))


def _name(kind: Column) -> Column:
    return F.get(F.array(*map(F.lit, KINDS)), kind)


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _name(s["kind"]), s["start"], s["end"])), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans; ``n_added`` counts the added ones."""
    found = find_personal_data(read(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
