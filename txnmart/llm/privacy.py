"""Find personal data, and the terms around it that give it away.

Patterns find the protected entities: e-mail addresses, IP addresses, card and phone numbers. Corpus
co-occurrence then tells how strongly each term reveals an entity ``c``: with probabilities over
different texts (copies count once everywhere), the pointwise mutual information of term and entity as a share of the entity's
information content, ``log(p(t, c) / (p(t) p(c))) / log(1 / p(c))``. It is 1 for a term that occurs
with that entity alone. Terms from ``REMOVE`` on are removed, those from ``GENERALISE`` on are replaced
by a general word, everywhere in the documents that hold the entity.

A share needs evidence beyond rarity, for a word that is in one text only goes with whatever else that text
holds. So a pair counts at any distance if two or more different texts hold both. A pair of a single
text counts only if the term stands within ``NEAR`` terms of the entity, and rates at most ``SINGLE``: such a
term is generalised, never removed. Which of these holds doesn't depend on the size of the corpus.

Entities that are in the same texts share all their figures, and so do terms that are in the same texts
with entities and in equally many of the corpus. So pairs are formed of such groups, not of single entities
and terms: a long contact list is one group, or a few, however many entities and terms it holds.

Nulls: a NULL text counts as empty. Texts without personal data have no spans. Repeated rows get
equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed, text_of
from txnmart.session import written

GENERALISE = 0.7
REMOVE = 0.9
#: The most that a pair seen in one text can rate.
SINGLE = 0.8
#: Terms on either side of an entity that are near it.
NEAR = 5
KINDS = ("email", "ip", "card", "phone")
#: Terms that one task counts before it passes the counts on.
COUNTED = 500_000
#: Bits of the filter that tells texts of one row from those that may have copies.
MARKS = 1 << 22

# Fixed forms of the base kinds. The look-behinds only save tries that can't match: a match takes
# a run of digits whole, so none begins inside one.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W_]+")
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(map(int, reversed(digits))):
        total += digit if at % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, found.end()))
        # No later match begins before this sign: what precedes it ends at it.
        done = found.end() if found else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each base kind, leftmost first and not overlapping within a kind; code points, end exclusive."""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if DIGIT.search(text):
        out["ip"] = [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in _octets(m[0]))]
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _octets(text: str) -> list[str]:
    # Leading zeros don't count, and a number of over three other digits is too large at any length.
    return [(part.lstrip("0") or "0")[:4] for part in text.split(".")]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def occurrences(text: str, found: dict[str, list[Span]]) -> tuple[list[int], list[dict]]:
    """The different entities of a text, and its different terms outside of them with all their places and the entities near any; all as hashes."""
    entities = sorted((start, end, kind) for kind, spans in found.items() for start, end in spans)
    if not entities:
        return [], []
    known: dict[str, int] = {}
    places: dict[int, list[int]] = {}
    starts, order = [], []
    at = 0
    for match in TERM.finditer(text):
        start, end = match.span()
        while at < len(entities) and entities[at][1] <= start:
            at += 1
        if not any(e[0] < end and start < e[1] for e in entities[at : at + len(KINDS)]):
            word = match[0].lower()
            term = known.get(word)
            if term is None:
                term = known[word] = _hash(word)
            places.setdefault(term, []).extend((start, end))
            starts.append(start)
            order.append(term)
    values = [_hash(f"{kind}:{text[a:b].lower() if kind in ('email', 'ip') else _digits(text[a:b])}") for a, b, kind in entities]
    near: dict[int, dict[int, None]] = {}
    for value, (start, _, _) in zip(values, entities, strict=True):
        at = bisect_left(starts, start)
        for term in order[max(0, at - NEAR) : at + NEAR]:
            near.setdefault(term, {})[value] = None
    return list(dict.fromkeys(values)), [{"term": term, "places": own, "near": list(near.get(term, ()))} for term, own in places.items()]


SCANNED = (
    "doc_id long, _file string, _row long, _text long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "entities array<long>, terms array<struct<term:long,places:array<int>,near:array<long>>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """Base spans of each row, its entities, and the terms of rows with entities."""
    kind = pa.list_(pa.struct([("term", pa.int64()), ("places", pa.list_(pa.int32())), ("near", pa.list_(pa.int64()))]))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts: list[list[int]] = [[] for _ in KINDS]
                bases, entities, terms = [], [], []
                for value in part.column("_text"):
                    text = value.as_py()
                    found = base_spans(text)
                    for own, spans in zip(counts, found.values(), strict=True):
                        own.append(len(spans))
                    bases.append(listed([(kind, *span) for kind, spans in found.items() for span in spans]))
                    for column, own in zip((entities, terms), occurrences(text, found), strict=True):
                        column.append(own)
                columns = [part.column("doc_id"), *map(part.column, PLACE), part.column("_hash"), *map(pa.array, counts)]
                columns += [pa.array(bases, pa.string()), pa.array(entities, pa.list_(pa.int64())), pa.array(terms, kind)]
                names = ["doc_id", *PLACE, "_text", *(f"n_{k}" for k in KINDS), "base", "entities", "terms"]
                yield pa.RecordBatch.from_arrays([c.cast(pa.int64()) if pa.types.is_integer(c.type) else c for c in columns], names=names)

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.withColumn("_hash", F.xxhash64("_text")).mapInArrow(mapped, SCANNED)


def repeated(scanned: DataFrame) -> np.ndarray:
    """A bit for each of ``MARKS`` remainders of text hashes: set if a text of several rows has it."""
    texts = scanned.groupBy("_text").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    marks = texts.select(F.pmod("_text", F.lit(MARKS)).alias("_mark")).distinct().toArrow()["_mark"].to_numpy()
    bits = np.zeros(MARKS, bool)
    bits[marks] = True
    return np.packbits(bits)


def term_counts(docs: DataFrame, marks: np.ndarray, counted: int = COUNTED) -> DataFrame:
    """(term, docs): in how many different texts each term of the corpus occurs.

    Texts without a mark of `repeated` come once and are counted where they are read; the others are
    folded by their hash first, so few texts are shuffled.
    """

    def marked(hashes: pa.Array) -> np.ndarray:
        at = hashes.to_numpy() % MARKS
        return (marks[at >> 3] >> (7 - (at & 7))) & 1 == 1

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~marked(batch.column("_hash")))).select(["_text"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(batch.column("_hash"))))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def passed() -> pa.RecordBatch:
            terms = [_hash(term) for term in total]
            return pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.int64()), "docs": pa.array(total.values(), pa.int64())})

        for batch in batches:
            for value in batch.column("_text"):
                # Words are cut before they are lowered, like those around entities.
                total.update({term.lower() for term in set(TERM.findall(value.as_py()))})
                if len(total) > counted:
                    yield passed()
                    total.clear()
        yield passed()

    rows = docs.select(text_of().alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    once = rows.mapInArrow(lambda batches: mapped(single(batches)), "term long, docs long")
    folded = rows.mapInArrow(several, "_text string, _hash long").groupBy("_hash").agg(F.first("_text").alias("_text"))
    partial = once.unionByName(folded.select("_text").mapInArrow(mapped, "term long, docs long"))
    return partial.groupBy("term").agg(F.sum("docs").alias("docs"))


def _texts(scanned: DataFrame) -> DataFrame:
    """_text, entities and terms of each different text that holds entities."""
    holding = scanned.filter(F.size("entities") > 0)
    firsts = holding.groupBy("_text").agg(F.min(F.struct(*PLACE)).alias("_first")).select("_first.*")
    return written(holding.select(*PLACE, "_text", "entities", "terms").join(firsts, PLACE, "left_semi").drop(*PLACE))


def _group(*more: str) -> list[Column]:
    """The number of texts, and a name for the set of texts (of 128 bits, hashed with ``more``)."""
    names = (F.bit_xor(F.xxhash64("_text", F.lit(salt))) for salt in (1, 2))
    return [F.count("*").alias("_texts"), F.xxhash64(*names, F.count("*"), *more).alias("_group")]


@dataclass
class Rated:
    """What `rate` knows of the terms around entities.

    ``entities`` (entity, of, entities): in how many texts, and the group. ``terms`` (term, docs, held, terms): in how many
    texts of the corpus and of those with entities, and the group. ``groups`` (_text, entities, terms): pairs of groups in
    each text. ``shares`` (entities, terms, share): pairs of groups with enough of a share.
    """

    n: int
    texts: DataFrame
    entities: DataFrame
    terms: DataFrame
    groups: DataFrame
    shares: DataFrame


def _share(both: Column | int, docs: Column, of: Column, n: int) -> Column:
    told = F.log(F.lit(float(n)) * both / (docs * of))
    return F.when(of < n, told / F.log(F.lit(float(n)) / of)).otherwise(0.0)


def rate(scanned: DataFrame, docs: DataFrame, least: float = GENERALISE) -> Rated:
    """Rate the terms of texts that hold entities: pairs of at least two texts, with a share of at least ``least``."""
    texts = _texts(scanned)
    n = scanned.select("_text").distinct().count()
    each_entity = texts.select("_text", F.explode("entities").alias("entity"))
    entities = each_entity.groupBy("entity").agg(*_group()).select("entity", F.col("_texts").alias("of"), F.col("_group").alias("entities"))
    entities = written(entities)
    each_term = texts.select("_text", F.explode("terms.term").alias("term"))
    held = each_term.groupBy("term").agg(*_group())
    counts = written(term_counts(docs, repeated(scanned))) if not texts.isEmpty() else held.select("term", F.col("_texts").alias("docs"))
    terms = held.join(counts, "term").select("term", "docs", F.col("_texts").alias("held"), F.xxhash64("_group", "docs").alias("terms"))
    terms = written(terms)
    # A term's share with any entity is at most that with one text's entity in all texts that hold the term.
    most = 1 - F.log(F.col("docs") / F.col("held")) / math.log(max(n, 2))
    some_terms = each_term.join(terms.filter((F.col("held") > 1) & (most >= least - 1e-9)), "term")
    some_entities = each_entity.join(entities.filter("of > 1"), "entity")
    groups = some_entities.select("_text", "entities", "of").distinct().join(some_terms.select("_text", "terms", "docs").distinct(), "_text")
    groups = written(groups)
    pairs = groups.groupBy("entities", "terms", "of", "docs").agg(F.count("*").alias("both")).filter("both > 1")
    shares = pairs.select("entities", "terms", _share(F.col("both"), F.col("docs"), F.col("of"), n).alias("share"))
    return Rated(n, texts, entities, terms, groups.select("_text", "entities", "terms"), written(shares.filter(F.col("share") >= least)))


def disclosures(scanned: DataFrame, docs: DataFrame, least: float = GENERALISE) -> DataFrame:
    """(entity, term, share): pairs of at least two texts in which the term discloses at least ``least`` of the entity's information."""
    rated = rate(scanned, docs, least)
    pairs = rated.shares.join(rated.entities.select("entity", "entities"), "entities").join(rated.terms.select("term", "terms"), "terms")
    return pairs.select("entity", "term", "share")


def risky(rated: Rated, least: float = GENERALISE) -> DataFrame:
    """(_text, term, share): terms of each different text with entities, with their strongest disclosure."""
    strongest = rated.groups.join(rated.shares, ["entities", "terms"]).groupBy("_text", "terms").agg(F.max("share").alias("share"))
    each_term = rated.texts.select("_text", F.explode("terms").alias("t"))
    named = each_term.select("_text", "t.term").join(rated.terms.filter("held > 1").select("term", "terms"), "term")
    repeatedly = named.join(strongest, ["_text", "terms"]).select("_text", "term", "share")
    beside = each_term.select("_text", "t.term", F.explode("t.near").alias("entity"))
    beside = beside.join(rated.entities.select("entity", "of"), "entity").join(rated.terms.select("term", "docs"), "term")
    once = F.least(F.lit(SINGLE), _share(1, F.col("docs"), F.col("of"), rated.n))
    beside = beside.select("_text", "term", once.alias("share")).filter(F.col("share") >= least)
    # A pair of several texts rates no less than as a pair of one, so the larger is right.
    return repeatedly.unionByName(beside).groupBy("_text", "term").agg(F.max("share").alias("share"))


def find(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per document: doc_id, counts of each base kind, base (spans as text), spans (with the terms'), and place."""
    scanned = written(scan(docs))
    rated = rate(scanned, docs, generalise)
    places = rated.texts.select("_text", F.explode("terms").alias("t")).select("_text", "t.term", "t.places")
    places = places.join(risky(rated, generalise), ["_text", "term"])
    steps = F.sequence(F.lit(0), F.size("places") - 2, F.lit(2))
    spot = places.withColumn("_at", F.explode(steps)).select(
        "_text",
        F.when(F.col("share") >= remove, "removed").otherwise("generalised").alias("kind"),
        F.element_at("places", F.col("_at") + 1).alias("start"),
        F.element_at("places", F.col("_at") + 2).alias("end"),
    )
    spans = spot.groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("_terms"))
    told = F.concat_ws(",", F.transform("_terms", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    spans = written(spans.select("_text", told.alias("_told")))
    # Only rows with entities look for terms; all copies of a text take those of its first.
    whole = [*(c for c in scanned.columns if c not in ("entities", "terms", "_text")), "spans"]
    holding = scanned.filter(F.size("entities") > 0).join(spans, "_text", "left")
    found = holding.withColumn("spans", F.concat_ws(",", "base", "_told")).select(whole)
    return found.unionByName(scanned.filter(F.size("entities") == 0).withColumn("spans", F.col("base")).select(whole))


def rewritten(text: str, spans: str) -> str:
    """The text with its spans replaced: entities by their kind, generalised terms by a general word; removed ones go."""
    marked = sorted((int(start), int(end), kind) for kind, start, end in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for start, end, kind in marked:
        if start < at:  # overlaps an entity that is replaced already
            at = max(at, end)
            continue
        out.append(text[at:start])
        if kind == "generalised":
            word = text[start:end]
            out.append("[number]" if word.isdigit() else "[name]" if word[0].isupper() else "[term]")
        elif kind != "removed":
            out.append(f"[{kind}]")
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and sanitised text of each row of ``docs``, given `find` of the same rows."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("_text"), batch.column("spans"), strict=True)
            texts = [rewritten(text.as_py(), spans.as_py()) for text, spans in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.join(found.select(*PLACE, "spans"), PLACE).mapInArrow(mapped, "doc_id long, text string")

