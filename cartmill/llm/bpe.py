"""Byte-level BPE: encoding by ranked merges folded with higher-order functions, and decoding.

Merges run in Spark expressions: a word's bytes become an array of two- or three-byte ids, and ``aggregate`` folds the
lowest-ranked neighbouring pair into its merged id until no pair has a rank. The rank map is one literal, a hash table
in a binary value: CRC-32 of a pair's two ids gives the two places where its entry may stand.

Words are encoded once each where that pays: the most frequent distinct words of the corpus, ``DICTIONARY_WORDS`` of
at most ``DICTIONARY_BYTES`` bytes or fewer, are folded and broadcast, a bounded size; any other word is folded once
per batch of documents that contain it, in the same expression. Documents are never shuffled: a map puts the ids of
known words in order, with marks for the words it lacks, the fold encodes those, and a second map replaces the marks
and decodes. The first map works on arrays: a batch's texts are cut in units, each distinct unit is looked up once. Words longer than ``LONG_BYTES`` would make the fold quadratic; they take the same merges from a heap.

Defined results: null and empty texts give no ids; equal rows give equal results; a null id is passed through.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common

DICTIONARY_WORDS = 1 << 21
DICTIONARY_BYTES = 32
LONG_BYTES = 128

# white space as the splitting pattern has it
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# a run of white space and what follows up to the next: no match of the pattern crosses its ends
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
# the same white space in UTF-8: single bytes, and the codes of two and of three bytes
_SPACES = [c.encode() for c in re.findall(f"[{_SPACE}]", "".join(map(chr, range(0x3001))))]
_SPACE_BYTES = np.isin(np.arange(256), [c[0] for c in _SPACES if len(c) == 1])
_WIDE_SPACES = {n: [int.from_bytes(c, "big") for c in _SPACES if len(c) == n] for n in (2, 3)}
_WIDE_LEADS = np.isin(np.arange(256), [c[0] for c in _SPACES if len(c) > 1])
_LETTER_BYTES = np.isin(np.arange(256), [c for c in range(128) if chr(c).isalpha()])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _word_pattern(pattern: str):
    """The splitting pattern with its white space spelled out."""
    inside = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    return regex.compile(inside)


def _splitter(pattern: str):
    """(lead, unit) to the matches in lead + unit; letters, and letters with one point or comma, need no search."""
    search = _word_pattern(pattern).findall

    def split(lead: str, unit: str) -> list[str]:
        if unit.isalpha():
            return [lead + unit]
        if unit[-1] in ".," and unit[:-1].isalpha():
            return [lead + unit[:-1], unit[-1]]
        return search(lead + unit)

    return split


class RankTable:
    """The rank map as one binary value for Spark expressions; ``width`` bytes hold an id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = 2 if max(ranks.values()) < 0xFFFF else 3
        pack = self.pack
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[pack(left) + pack(right)] = pack(rank)
        self.bits = max(4, (2 * len(pairs)).bit_length())
        while (table := self._place(pairs)) is None:
            self.bits += 1
        empty = b"\xff" * (3 * self.width)
        self.table = b"".join(table.get(i, empty) for i in range(1 << self.bits))
        self.none = b"\xff" * self.width
        self.bytes = [pack(ranks[bytes([b])]) for b in range(256)]
        # ranks of the pairs of single bytes, directly by their codes
        self.byte_pairs = b"".join(
            pack(ranks[t]) if (t := bytes((a, b))) in ranks else self.none for a in range(256) for b in range(256)
        )

    def pack(self, number: int) -> bytes:
        return number.to_bytes(self.width, "big")

    def _places(self, key: bytes) -> tuple[int, int]:
        h, mask = zlib.crc32(key), (1 << self.bits) - 1
        return h & mask, (h >> (32 - self.bits)) & mask

    def _place(self, pairs: dict[bytes, bytes]) -> dict[int, bytes] | None:
        table: dict[int, bytes] = {}
        for key, value in pairs.items():
            entry, at = key + value, self._places(key)[0]
            for _ in range(500):
                entry, old = table.get(at), entry
                table[at] = old
                if entry is None:
                    break
                a, b = self._places(entry[: 2 * self.width])
                at = b if at == a else a
            else:
                return None
        return table

    def fold(self, words: Column) -> Column:
        """Array of words, each a string of Latin-1 characters standing for bytes, to array of packed ids (binary).

        A word's state are the ids of its parts between two marks, as one binary value, and an array of its
        neighbouring pairs: each one's rank with the place of its first byte, so that the least is the leftmost pair
        of the lowest rank. A merge puts two new pairs for three and leaves the others as they are.
        """
        w, mask, bits = self.width, (1 << self.bits) - 1, self.bits
        none, one_id, two_ids, rest = F.lit(self.none), F.lit(w), F.lit(2 * w), F.lit(1 << 20)

        def let(value: Column, body) -> Column:
            return F.transform(F.array(value), body)[0]

        def ids_at(packed: Column, place: Column, count: Column = one_id) -> Column:
            return F.substring(packed, place * w + 1, count)

        def rank_of(table: Column, key: Column) -> Column:
            def look(hashed: Column) -> Column:
                def at(place: Column) -> Column:
                    return (place * (3 * w) + 1).cast("int")

                first = at(hashed.bitwiseAND(F.lit(mask)))
                second = at(F.shiftright(hashed, 32 - bits).bitwiseAND(F.lit(mask)))
                # a pair stands in its second place only if its first is taken
                return (
                    F.when(F.substring(table, first, two_ids) == key, F.substring(table, first + 2 * w, one_id))
                    .when(F.substring(table, first + 2 * w, one_id) == none, none)
                    .when(F.substring(table, second, two_ids) == key, F.substring(table, second + 2 * w, one_id))
                    .otherwise(none)
                )

            return look(F.crc32(key))

        def place_of(ranked: Column) -> Column:
            return F.substring(ranked, F.lit(w + 1), F.lit(4))

        def merge(known: Column):
            def step(state: Column, _: Column) -> Column:
                parts, ranked = state["parts"], state["ranked"]

                def at(best: Column) -> Column:
                    merged = F.substring(best, F.lit(1), one_id)

                    def around(p: Column) -> Column:
                        before = F.concat(ids_at(parts, p - 1), merged)
                        after = F.concat(merged, ids_at(parts, p + 2))
                        return F.struct(
                            F.concat(F.substring(parts, F.lit(1), p * w), merged, ids_at(parts, p + 2, rest)).alias("parts"),
                            F.concat(
                                F.slice(ranked, F.lit(1), p - 1),
                                F.array(
                                    F.concat(let(before, lambda key: rank_of(known["table"], key)), place_of(F.get(ranked, p - 1))),
                                    F.concat(let(after, lambda key: rank_of(known["table"], key)), place_of(best)),
                                ),
                                F.slice(ranked, p + 3, rest),
                            ).alias("ranked"),
                        )

                    place = F.array_position(ranked, best).cast("int") - 1
                    done = F.struct(parts.alias("parts"), F.slice(ranked, F.lit(1), F.lit(0)).alias("ranked"))
                    return F.when(merged == none, done).otherwise(let(place, around))

                return F.when(F.size(ranked) == 0, state).otherwise(let(F.array_min(ranked), at))

            return step

        def encode(known: Column):
            def one(word: Column) -> Column:
                def run(codes: Column) -> Column:
                    parts = F.aggregate(codes, none, lambda packed, c: F.concat(packed, F.get(known["single"], c)))

                    def ranked(place: Column, i: Column) -> Column:
                        pair = (F.get(codes, i - 1) * 256 + F.get(codes, i)) * w + 1  # null beyond the ends
                        return F.concat(F.coalesce(F.substring(known["bytes"], pair, one_id), none), place)

                    start = F.struct(
                        F.concat(parts, none).alias("parts"),
                        F.transform(F.slice(known["place"], F.lit(1), F.size(codes) + 1), ranked).alias("ranked"),
                    )
                    return F.aggregate(
                        codes,
                        start,
                        merge(known),
                        lambda state: F.substring(state["parts"], F.lit(w + 1), F.length(state["parts"]) - 2 * w),
                    )

                return let(F.transform(F.split(word, ""), lambda c: F.ascii(c)), run)

            return one

        # the literals are bound once by an outer lambda, so the plan holds each a single time
        known = F.struct(
            F.lit(self.table).alias("table"),
            F.lit(self.byte_pairs).alias("bytes"),
            _binaries(self.bytes).alias("single"),
            # a place is a character, whose UTF-8 form sorts by its code
            _binaries([chr(i + 1).encode() for i in range(LONG_BYTES + 1)]).alias("place"),
        )
        return F.transform(F.array(known), lambda k: F.transform(words, encode(k)))[0]


def _binaries(values: list[bytes]) -> Column:
    """A constant array, folded by the optimizer."""
    return F.transform(F.split(F.lit(",".join(v.hex() for v in values)), ","), lambda h: F.unhex(h))


def merge_long(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The fold's result for one long word, in n log n steps: a heap of pairs over a linked list of parts."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0 when merged away
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if not end[i] or end[i] >= n:
            continue
        j = end[i]
        if ranks.get(word[i : end[j]]) != rank:
            continue
        end[i], end[j] = end[j], 0
        if end[i] < n:
            before[end[i]] = i
            if (r := ranks.get(word[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if (b := before[i]) >= 0 and (r := ranks.get(word[b : end[i]])) is not None:
            heapq.heappush(heap, (r, b))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def units_of(text: str) -> tuple[list[str], list[str] | None]:
    """A text in units that no match of the splitting pattern crosses: the plain form of what ``unit_starts`` finds.

    Where single spaces and single line ends are all its white space, these are the lines' words, each but a line's
    first with the space before it: returned are the text's lines and None. Otherwise returned are the units proper,
    runs of white space with what follows, as the second value.
    """
    words = text.split()
    if sum(map(len, words)) + len(words) - 1 == len(text) and text.count(" ") + text.count("\n") == len(words) - 1:
        return text.split("\n"), None
    return [], _UNIT.findall(text)


def _count_words(docs: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """(word, n): distinct words with their counts.

    White-space separated units are counted first, in each task before the shuffle, and only distinct ones are
    divided into words. Java's idea of letters decides here what is worth remembering, never what ids come out.
    """
    text = F.col(f"`{common.field(docs, text_col).name}`")
    units = docs.select(F.explode(F.regexp_extract_all(text, F.lit(r"\s*\S+"), F.lit(0))).alias("unit"))
    counted = units.groupBy("unit").agg(F.count("*").alias("n"))
    words = counted.select(F.explode(F.regexp_extract_all("unit", F.lit(pattern), F.lit(0))).alias("word"), "n")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of at least some count, chosen so that they are ``most`` or fewer; a histogram of counts decides.

    A word that stands once is left out: it is folded once either way.
    """
    sizes = counts.groupBy(F.when(F.col("n") < 4096, F.col("n")).otherwise(F.lit(4096)).alias("n")).agg(F.count("*").alias("words"))
    least, total = 1 << 62, 0
    for n, words in sorted(((r["n"], r["words"]) for r in sizes.collect()), reverse=True):
        total += words
        if total > most or n < 2:
            break
        least = n
    return counts.filter(F.col("n") >= least)


def dictionary(docs: DataFrame, text_col: str, table: RankTable, pattern: str, most: int = DICTIONARY_WORDS) -> Dictionary:
    """The most frequent distinct words with their ids."""
    # counted once; two passes read it
    counts = common.stored(_count_words(docs, text_col, pattern), "bpe-words")
    size = F.octet_length("word")
    words = _frequent(counts.filter((size > 1) & (size <= DICTIONARY_BYTES)), most)
    # folding is work for all cores, however few bytes the words are
    spread = words.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    latin = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    common.release()  # the driver's memory is small
    packed = [spread.select(F.xxhash64("word").alias("hash"), table.fold(F.array(latin))[0].alias("ids")).toArrow()]
    return Dictionary.of(packed, {token: table.pack(rank) for token, rank in table.ranks.items()})


def _little(ids: bytes, width: int) -> bytes:
    """Packed big-endian ids, ``width`` bytes wide, as little-endian 32-bit integers."""
    return b"".join([ids[i : i + width][::-1] + b"\0" * (4 - width) for i in range(0, len(ids), width)])


def _hashes(words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of each word."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64).view(np.int64)


def _gather(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that start at ``first``, one after the other."""
    ends = np.cumsum(sizes)
    places = np.repeat(first - (ends - sizes), sizes)
    places += np.arange(len(places))
    return values[places]


class Dictionary:
    """Packed ids of words by the words' hashes: some 20 bytes for each."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, ids: bytes):
        self.hashes, self.starts, self.ids = hashes, starts, ids

    @classmethod
    def of(cls, found: list[pa.Table], tokens: dict[bytes, bytes]) -> Dictionary:
        """From a list of one table, which is taken out of it so that its memory is free once it is sorted.

        Of words of one hash the first is kept; ``tokens``, words that are one id whole, come before all others.
        """
        own = pa.table({"hash": _hashes(list(tokens)), "ids": pa.array(tokens.values(), type=pa.binary())})
        packed = pa.concat_tables([own, found.pop().cast(own.schema)])
        hashes, first = np.unique(packed["hash"].to_numpy(), return_index=True)
        column = pa.concat_arrays(packed["ids"].chunks).take(pa.array(first))
        del packed
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[: len(column) + 1]
        return cls(hashes, offsets.astype(np.uint32), column.buffers()[2].to_pybytes())

    def find(self, words: list[bytes], pieces: Pieces, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that are here, one after the other, and their number for each word, 0 where it is not."""
        numbers = np.zeros(len(words), dtype=np.int64)
        wanted = _hashes(words)
        order = np.argsort(wanted)  # neighbours are found near each other
        at = np.empty(len(words), dtype=np.int64)
        at[order] = np.searchsorted(self.hashes, wanted[order])
        at = np.minimum(at, len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == wanted)
        first, after = (self.starts[at[hit] + i].astype(np.int64) // width for i in (0, 1))
        sizes = after - first
        little = np.zeros((int(sizes.sum()), 4), dtype=np.uint8)
        little[:, :width] = _gather(np.frombuffer(self.ids, dtype=np.uint8).reshape(-1, width), first, sizes)[:, ::-1]
        ids = little.view("<u4").ravel()
        # words of equal hash are told apart by what the ids decode to
        ends = np.cumsum(sizes)
        reached = np.concatenate([[0], np.cumsum(pieces.sizes[ids])])
        starts, ends = reached[ends - sizes].tolist(), reached[ends].tolist()
        decoded = pieces.decode(ids.tobytes())
        same = np.array([decoded[a:b] == words[i] for i, a, b in zip(hit.tolist(), starts, ends, strict=True)], dtype=bool)
        numbers[hit[same]] = sizes[same]
        return ids[np.repeat(same, sizes)], numbers


class Pieces:
    """The bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: bytes, step: int = 1 << 18) -> bytes:
        """The pieces of little-endian 32-bit ids, one after the other."""
        numbers, out = np.frombuffer(ids, dtype="<u4"), []
        for part in (numbers[i : i + step] for i in range(0, len(numbers), step)):
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            at = np.repeat(self.starts[part] - (ends - sizes), sizes)
            out.append(self.data[at + np.arange(len(at))].tobytes())
        return b"".join(out)


_MARK = 0xFFFFFFFF


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts, null being empty, and where each begins and the last ends."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the units of texts begin in their bytes: at each text's first byte and each run of white space."""
    space = _SPACE_BYTES[data]
    leads = np.flatnonzero(_WIDE_LEADS[data])
    if len(leads):
        wide = np.concatenate([data, np.zeros(2, dtype=np.uint8)]).astype(np.int32)
        two = (wide[leads] << 8) | wide[leads + 1]
        for codes, n in ((two, 2), ((two << 8) | wide[leads + 2], 3)):
            at = leads[np.isin(codes, _WIDE_SPACES[n])]
            for i in range(n):
                space[at + i] = True
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(first)


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to the letters of ASCII or U+00C0 to U+017F."""
    letter = _LETTER_BYTES[data]
    leads = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    sign = (data[leads] == 0xC3) & ((data[leads + 1] == 0x97) | (data[leads + 1] == 0xB7))  # times and division
    leads = leads[~sign]
    letter[leads] = letter[leads + 1] = True
    return letter


class _Words:
    """What a worker knows: ranks, and the broadcast dictionary.

    Ids are little-endian 32-bit integers. A word that only the fold can encode is a mark and its number among the
    words that the batch lacks.
    """

    def __init__(self, ranks: dict[bytes, int], known: Dictionary, pattern: str, width: int, pieces: Pieces):
        self.ranks, self.known, self.width, self.pieces = ranks, known, width, pieces
        self.split = _splitter(pattern)

    def encode(self, texts: pa.Array) -> tuple[pa.Array, list[bytes]]:
        """Ids of the texts, with marks, and the words that the marks number."""
        data, offsets = _flat(texts)
        starts = unit_starts(data, offsets)
        if not len(starts):
            return pa.array([b""] * len(texts), type=pa.binary()), []
        units = _binary(data, np.append(starts, len(data))).dictionary_encode()
        ids, sizes, lacking = self._units(units.dictionary)
        which = units.indices.to_numpy()
        own = sizes[which]
        ends = 4 * np.concatenate([[0], np.cumsum(own)])[np.searchsorted(starts, offsets)]
        found = _gather(ids, (np.cumsum(sizes) - sizes)[which], own)
        return _binary(found, ends).cast(pa.binary()), lacking

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids of distinct units, one after the other, their number for each unit, and the words that marks number.

        Letters after at most one space, and such with one point or comma, need no search for their words.
        """
        data, offsets = _flat(units)
        begin, end = offsets[:-1], offsets[1:]
        others = np.concatenate([[0], np.cumsum(~_letters(data))])
        others = others[end] - others[begin] - (data[begin] == ord(" "))
        letters, last = end - begin - (data[begin] == ord(" ")), data[end - 1]
        ended = (others == 1) & (letters > 1) & ((last == ord(".")) | (last == ord(",")))
        searched = np.flatnonzero(~ended & ((others != 0) | (letters == 0)))

        # each unit's words by their numbers: first a word for each unit, then the words found by search, "." and ","
        whole = data.tobytes()
        words = [whole[a:b] for a, b in zip(begin.tolist(), (end - ended).tolist(), strict=True)]
        counts, more = 1 + ended, []
        for i in searched.tolist():
            own = self.split("", words[i].decode())
            counts[i] = len(own)
            words[i], *rest = [w.encode() for w in own]
            more += rest
        first = np.cumsum(counts) - counts
        numbers = np.empty(int(counts.sum()), dtype=np.int64)
        numbers[first] = np.arange(len(units))
        numbers[_gather(np.arange(len(numbers)), first[searched] + 1, counts[searched] - 1)] = len(units) + np.arange(len(more))
        numbers[first[ended] + 1] = len(units) + len(more) + (last[ended] == ord(","))
        words += [*more, b".", b","]

        ids, sizes, lacking = self._ids(words)
        own = sizes[numbers]
        return _gather(ids, (np.cumsum(sizes) - sizes)[numbers], own), np.add.reduceat(own, first), lacking

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids of words, one after the other, their number for each word, and the words that marks number."""
        ids, sizes = self.known.find(words, self.pieces, self.width)
        at = np.cumsum(sizes)
        lacking: dict[bytes, int] = {}
        places, rest = [], []
        for i in np.flatnonzero(sizes == 0).tolist():
            word = words[i]
            if (rank := self.ranks.get(word)) is not None:
                own = [rank]
            elif len(word) > LONG_BYTES:
                own = merge_long(self.ranks, word)
            else:
                own = [_MARK, lacking.setdefault(word, len(lacking))]
            places += [at[i]] * len(own)
            rest += own
            sizes[i] = len(own)
        return np.insert(ids, places, np.array(rest, dtype=np.uint32)) if rest else ids, sizes, list(lacking)


class _Coder:
    """What a worker holds: the bytes of every id, and what encoding takes once it has to encode."""

    def __init__(self, ranks):
        self.ranks, self.pieces, self._words = ranks, Pieces(ranks.value), None

    def words(self, known, pattern: str, width: int) -> _Words:
        if self._words is None:
            self._words = _Words(self.ranks.value, known.value, pattern, width, self.pieces)
        return self._words


def _unmarked(ids: bytes, rest: list[bytes]) -> bytes:
    """Ids with every mark and number replaced by the ids of that word."""
    numbers = np.frombuffer(ids, dtype="<u4")
    marks = np.flatnonzero(numbers == _MARK).tolist()
    if not marks:
        return ids
    out, at = [], 0
    for m in marks:
        out += (ids[4 * at : 4 * m], rest[numbers[m + 1]])
        at = m + 2
    out.append(ids[4 * at :])
    return b"".join(out)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    most: int = DICTIONARY_WORDS,
    finish=None,
    fields: list[T.StructField] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, or all, with the column ``ids`` (array of int) or what ``finish`` makes of it.

    ``finish`` gets the ids as bytes of little-endian 32-bit integers and ``Pieces`` to decode them, and returns a
    tuple for ``fields``.
    """
    ranks = read_ranks(ranks_path)
    table = RankTable(ranks)
    context = docs.sparkSession.sparkContext
    shared = common.share(context, ranks)
    known = common.share(context, dictionary(docs, text_col, table, pattern, most))
    common.release()  # the driver's memory is small
    width = table.width
    kept = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).schema
    text, packed_ids = common.free(docs, "_text"), common.free(docs, "_ids")
    source = docs.select(F.col(f"`{common.field(docs, text_col).name}`").alias(text), *[F.col(f"`{f.name}`") for f in kept])

    # a batch of documents is one row, next to the distinct words its documents lack
    held = T.StructType([*kept, T.StructField(packed_ids, T.BinaryType())])
    gathered = common.schema_of(("docs", T.ArrayType(held)), ("rest", T.ArrayType(T.StringType())))
    target = common.arrow_schema(gathered)
    key = ("bpe", shared, known, pattern)

    def gather(batches):
        words = common.held(key, lambda: _Coder(shared)).words(known, pattern, width)
        struct_type = target.field(0).type.value_type
        for b in batches:
            for part in common.slices(b, 0):
                ids, lacking = words.encode(part.column(0))
                columns = [*part.columns[1:], ids]
                rows = pa.StructArray.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, struct_type, strict=True)], fields=list(struct_type)
                )
                rest = pa.array([w.decode("latin-1") for w in lacking], type=pa.string())
                lists = [
                    pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), x, type=f.type)
                    for x, f in ((rows, target.field(0)), (rest, target.field(1)))
                ]
                yield pa.RecordBatch.from_arrays(lists, schema=target)
        common.release()

    folded = source.mapInArrow(gather, gathered).select("docs", table.fold(F.col("rest")).alias("rest"))
    if finish is None:
        fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]

        def finish(ids, _):
            return (as_list(ids),)

    schema = T.StructType([*kept, *fields])

    written = common.arrow_schema(schema)

    def unmark(batches):
        pieces = common.held(key, lambda: _Coder(shared)).pieces
        for b in batches:
            for i in range(b.num_rows):  # one slice of documents at a time
                ((held, packed),) = zip(*[c.to_pylist() for c in b.slice(i, 1).columns], strict=True)
                rest = [_little(p, width) for p in packed]
                out = []
                for doc in held:
                    *own, ids = doc.values()
                    out.append((*own, *finish(_unmarked(ids, rest), pieces)))
                yield common.to_batch(out, written)
        common.release()

    return folded.mapInArrow(unmark, schema)


def as_list(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()
