"""Byte-level BPE: encoding by ranked merges in higher-order functions, and decoding.

Texts are cut into words by the vocabulary's pattern, and consecutive documents of a task are packed
into a few rows: a head with their distinct words, and rows with the texts as numbers of these words. So a word is merged once
for some millions of words, and no word is shuffled. Words are first cut where no token of the vocabulary
reaches across: no merge does either, so the parts, again distinct, are merged alone. A part travels as a string with one
character for each of its tokens, at first one for each byte, beside the merged tokens of its pairs of bytes. A higher-order function
folds the merges over it: the pair of the lowest rank, the leftmost of equals, becomes one character, until no pair
is in the rank map, a literal of the plan in small parts by a hash of the pair. Decoding looks each id up in a
literal array of pieces, as strings of one character a byte, and joins them to binary.

The map holds the pair of parts that the merges of lower ranks leave of each token. Where some token isn't
left as two parts so, any two tokens that join to a token are held instead, and tokens that their own merges
don't give are kept as whole words, as the library behind the rank files does; with such tokens, words aren't cut.

Nulls: a NULL text counts as empty and has no ids. Rows are told apart by their place, so repeated rows
and NULL ids are encoded one by one. Texts of any length are encoded whole; a word of n bytes
takes time n * n at most. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import placed, text_of

#: Parts of the literal rank map.
PARTS = 1 << 16
#: Words of the texts that share a head, unless one text has more.
WORDS = 6_000_000
#: Words of the texts in one row, unless one text has more.
ROW = 500_000
#: Most ids in one Arrow batch, unless one text has more.
BATCH = 1_000_000
#: Words that are cut at a time, the longest runs of bytes that are looked up for it, and bits of their tables.
SOME, RUN, SLOTS = 20_000, 6, 22
#: Beside words of UTF-8, where this byte is never found.
BETWEEN = 0xFF
#: Characters of tokens start here and leave out the surrogates; those below are free for marks.
FIRST, SURROGATES, GAP = 0x100, 0xD800, 0x800
LARGEST = 0xFF00 - FIRST - GAP
EDGE, WHOLE, NO_RANK = "\x01", "\x02", "￿"
PACKED = pa.schema(
    [
        ("words", pa.list_(pa.string())),
        ("pairs", pa.list_(pa.string())),
        ("sizes", pa.binary()),
        ("parts", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("files", pa.list_(pa.string())),
        ("rows", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("at", pa.binary()),
    ]
)
PACKED_COLUMNS = (
    "words array<string>, pairs array<string>, sizes binary, parts binary, "
    "ids array<long>, files array<string>, rows array<long>, counts array<long>, at binary"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each piece in a file of lines with a piece in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def merged(word: bytes, ranks: dict[bytes, int], below: float = float("inf")) -> list[bytes]:
    """Parts of a word after all merges with ranks under ``below``."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def character(rank: int) -> str:
    """The character of a token; characters are in the order of ranks."""
    return chr(rank + FIRST if rank + FIRST < SURROGATES else rank + FIRST + GAP)


def numbers(characters: str) -> np.ndarray:
    """Ranks of characters."""
    codes = np.frombuffer(characters.encode("utf-16-le"), "<u2").astype(np.int32) - FIRST
    return np.where(codes >= SURROGATES - FIRST, codes - GAP, codes)


def strings(codes: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of so many of the characters each."""
    widths = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800)
    ends = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(lengths)])]
    data = codes.astype("<u2").tobytes().decode("utf-16-le").encode()
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))


def taken(values: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the runs with the numbers ``at``, of runs of such lengths."""
    own = lengths[at]
    skipped = (np.cumsum(lengths) - lengths)[at] - (np.cumsum(own) - own)
    return values[np.repeat(skipped, own) + np.arange(own.sum())]


class Cuts:
    """Cuts words where no piece of ``ranks`` reaches across."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tables = []
        for size in range(2, RUN + 1):
            if size < RUN:
                runs = {piece for piece in ranks if len(piece) == size}
            else:
                runs = {piece[i : i + RUN] for piece in ranks for i in range(len(piece) - RUN + 1)}
            table = np.zeros(1 << SLOTS, bool)
            if runs:
                each = np.frombuffer(b"".join(runs), np.uint8)
                *_, slots = self.slots(each, size)
                table[slots[::size]] = True
            self.tables.append(np.packbits(table))

    @staticmethod
    def slots(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """Slots of the runs of 2, 3 and more bytes, by where they begin."""
        hashes = data.astype(np.uint32) + np.uint32(1)
        for size in range(2, most + 1):
            hashes = hashes[:-1] * np.uint32(0x01000193) + data[size - 1 :] + np.uint32(1)
            yield (hashes * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOTS)

    def cut(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The parts of words, and how many each word has. Unequal runs in one slot only leave longer parts."""
        raw = bytes([BETWEEN]).join([b"", *words, b""])
        data = np.frombuffer(raw, np.uint8)
        across = np.zeros(len(data) + 1, np.int32)
        for size, slots in enumerate(self.slots(data, RUN), 2):
            if len(slots):
                found = (self.tables[size - 2][slots >> 3] >> (7 - (slots & 7))) & 1
                across[1 : 1 + len(found)] += found
                across[size : size + len(found)] -= found
        return parts_of(raw, data, np.cumsum(across[:-1]) == 0)


def parts_of(raw: bytes, data: np.ndarray, begins: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The parts of words with ``BETWEEN`` around them, by where parts begin; how many parts each word has."""
    between = data == BETWEEN
    begins = begins | between
    begins[1:] |= between[:-1]
    starts = np.flatnonzero(begins)
    own = ~between[starts]
    ends = np.append(starts[1:], len(data))[own].tolist()
    sizes = np.diff(np.flatnonzero(~own)) - 1
    return list(map(raw.__getitem__, map(slice, starts[own].tolist(), ends))), sizes


class Vocabulary:
    """Ranks of byte pieces, and the pattern that cuts texts into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([byte]) not in ranks for byte in range(256)) or max(ranks.values()) > LARGEST or min(ranks.values()) < 0:
            raise ValueError(f"ranks from 0 to {LARGEST} and all single bytes are needed")
        self.ranks, self.pattern = ranks, pattern
        self.bytes = {byte: character(ranks[bytes([byte])]) for byte in range(256)}

    def merges(self) -> dict[str, str]:
        """The merged token of each pair of tokens, and of whole words that merges don't give."""
        ranks = self.ranks
        longer = [(piece, rank) for piece, rank in ranks.items() if len(piece) > 1]
        parts = {piece: merged(piece, ranks, rank) for piece, rank in longer}
        if all(len(own) == 2 for own in parts.values()):
            return {"".join(character(ranks[part]) for part in own): character(ranks[piece]) for piece, own in parts.items()}
        found = {}
        for piece, rank in longer:
            for cut in range(1, len(piece)):
                if piece[:cut] in ranks and piece[cut:] in ranks:
                    found[character(ranks[piece[:cut]]) + character(ranks[piece[cut:]])] = character(rank)
            if merged(piece, ranks) != [piece]:
                found[WHOLE + "".join(map(self.bytes.get, piece))] = character(rank)
        return found

    @staticmethod
    def rank_map(merges: dict[str, str]) -> Column:
        """The merges as a literal: an array of maps, by the hash of the key."""
        parts: list[dict[str, str]] = [{} for _ in range(PARTS)]
        for key, value in merges.items():
            parts[xxhash.xxh64_intdigest(key.encode(), 42) % PARTS][key] = value
        return F.from_json(F.lit(json.dumps(parts)), "array<map<string,string>>")

    def byte_merges(self, merges: dict[str, str]) -> np.ndarray:
        """Code of the merged token of two bytes, or of ``NO_RANK``."""
        own = list(self.bytes.values())
        found = np.array([[ord(merges.get(left + right, NO_RANK)) for right in own] for left in own], np.uint16)
        found[BETWEEN] = found[:, BETWEEN] = ord(NO_RANK)
        return found

    def pieces(self) -> Column:
        """Pieces by id as a literal array of strings, one character a byte."""
        own: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            own[rank] = piece.decode("latin-1")
        return F.from_json(F.lit(json.dumps(own)), "array<string>")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def fold_merges(word: Column, pairs: Column, ranks: Column, wholes: bool) -> Column:
    """The word's tokens: ``word`` has one character for each byte and ``EDGE`` at both ends, ``pairs`` the merged tokens of
    each two of them or ``NO_RANK``. ``wholes`` tells whether whole words are in the rank map.
    """

    def found(key: Column) -> Column:
        part = F.get(ranks, F.xxhash64(key).bitwiseAND(PARTS - 1).cast("int"))
        return F.try_element_at(part, key)

    def pair(tokens: Column, at: Column) -> Column:
        return F.coalesce(found(F.substr(tokens, at, F.lit(2))), F.lit(NO_RANK))

    def using(state: Column, value: Column, body) -> Column:
        # unlike _let, this doesn't copy the state
        return F.aggregate(F.array(value), state, body)

    def step(state: Column, _: Column) -> Column:
        def merge(state: Column, least: Column) -> Column:
            def put(state: Column, at: Column) -> Column:
                def joined(state: Column, fewer: Column) -> Column:
                    beside = F.concat(pair(fewer, at - 1), pair(fewer, at))
                    return F.struct(fewer.alias("tokens"), F.overlay(state["pairs"], beside, at - 1, F.lit(3)).alias("pairs"))

                return using(state, F.overlay(state["tokens"], least, at, F.lit(2)), joined)

            return F.when(least < NO_RANK, using(state, F.instr(state["pairs"], least), put)).otherwise(state)

        return using(state, F.array_min(F.split(state["pairs"], "")), merge)

    start = F.struct(word.alias("tokens"), pairs.alias("pairs"))
    steps = F.sequence(F.lit(4), F.greatest(F.length(word), F.lit(4)))
    folded = F.aggregate(steps, start, step, lambda state: F.btrim(state["tokens"], F.lit(EDGE)))
    if not wholes:
        return folded
    return F.coalesce(found(F.concat(F.lit(WHOLE), F.substr(word, F.lit(2), F.length(word) - 2))), folded)


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = at = len(self)
        return at


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, place and ``tokens`` (array of ids) of each row of ``docs``."""
    pattern, merges = vocabulary.pattern, vocabulary.merges()
    wholes = any(key.startswith(WHOLE) for key in merges)
    cuts = None if wholes else Cuts(vocabulary.ranks)
    spelled = np.array([ord(vocabulary.bytes[byte]) for byte in range(256)], np.uint16)
    spelled[BETWEEN] = ord(EDGE)
    paired = vocabulary.byte_merges(merges)

    def packed(**columns) -> pa.RecordBatch:
        given = [pa.array([columns.get(field.name, b"" if field.type == pa.binary() else [])], field.type) for field in PACKED]
        return pa.RecordBatch.from_arrays(given, schema=PACKED)

    def head(words: _Numbers) -> pa.RecordBatch:
        numbered, parts, sizes, spelt = _Numbers(), [], [], list(words)
        for first in range(0, len(spelt), SOME):
            some = [word.encode() for word in spelt[first : first + SOME]]
            own, size = cuts.cut(some) if cuts else (some, np.array(list(map(bool, some))))
            parts.append(np.fromiter(map(numbered.__getitem__, filter(None, own)), np.int32, int(size.sum())))
            sizes.append(size.astype(np.int32))
        edge = bytes([BETWEEN])
        data = np.frombuffer(edge + (edge + edge).join(numbered) + edge, np.uint8)
        lengths = np.fromiter(map(len, numbered), np.int32, len(numbered))
        inside = (data[:-1] != BETWEEN) | (data[1:] != BETWEEN)
        texts = [strings(spelled[data], lengths + 2), strings(paired[data[:-1], data[1:]][inside], lengths + 1)] if numbered else [[], []]
        flat = [np.concatenate(x).tobytes() if x else b"" for x in (sizes, parts)]
        return packed(words=texts[0], pairs=texts[1], sizes=flat[0], parts=flat[1])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall

        def row(places: list[tuple], texts: list[np.ndarray]) -> pa.RecordBatch:
            ids, files, rows = ([place[i] for place in places] for i in range(3))
            return packed(ids=ids, files=files, rows=rows, counts=list(map(len, texts)), at=np.concatenate(texts).tobytes())

        words, done, places, texts, size, total = _Numbers(), [], [], [], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = find(batch.column("_text")[i].as_py())
                places.append(tuple(batch.column(name)[i].as_py() for name in ("doc_id", "_file", "_row")))
                texts.append(np.fromiter(map(words.__getitem__, text), np.int32, len(text)))
                size += len(text)
                total += len(text)
                if size >= ROW or total >= WORDS:
                    done.append(row(places, texts))
                    places, texts, size = [], [], 0
                if total >= WORDS:
                    yield head(words)
                    yield from done
                    words, done, total = _Numbers(), [], 0
        if places:
            done.append(row(places, texts))
        if done:
            yield head(words)
            yield from done

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = lengths = np.zeros(0, np.int32)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, files, rows, counts = (batch.column(name)[i].values for name in ("ids", "files", "rows", "counts"))
                sizes, parts, at = (np.frombuffer(batch.column(name)[i].as_py(), np.int32) for name in ("sizes", "parts", "at"))
                if not len(ids):
                    merged_parts = batch.column("words").slice(i, 1)
                    own = pc.utf8_length(merged_parts[0].values).to_numpy()
                    tokens = taken(numbers(pc.binary_join(merged_parts, "")[0].as_py()), own, parts)
                    ends = np.concatenate([[0], np.cumsum(own[parts])])
                    lengths = np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])
                    continue
                ends = np.cumsum(counts.to_numpy())
                sums = np.diff(np.concatenate([[0], np.cumsum(lengths[at])])[np.concatenate([[0], ends])])
                first = 0
                while first < len(ends):
                    last = first + max(1, int(np.searchsorted(np.cumsum(sums[first:]), BATCH, "right")))
                    some = at[ends[first - 1] if first else 0 : ends[last - 1]]
                    bounds = np.concatenate([[0], np.cumsum(sums[first:last])]).astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(taken(tokens, lengths, some), pa.int32()))
                    columns = [column.slice(first, last - first) for column in (ids, files, rows)]
                    yield pa.RecordBatch.from_arrays([*columns, found], names=["doc_id", "_file", "_row", "tokens"])
                    first = last

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    packed_rows = rows.mapInArrow(pack, PACKED_COLUMNS)
    words = _let(
        vocabulary.rank_map(merges),
        lambda ranks: F.zip_with("words", "pairs", lambda word, pairs: fold_merges(word, pairs, ranks, wholes)),
    )
    return packed_rows.withColumn("words", words).drop("pairs").mapInArrow(unpack, "doc_id long, _file string, _row long, tokens array<int>")


def decode(tokens: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of an array of ids; an id that isn't in the vocabulary has none."""
    joined = _let(vocabulary.pieces(), lambda pieces: F.array_join(F.transform(tokens, lambda rank: F.get(pieces, rank)), ""))
    return F.encode(joined, "ISO-8859-1")
