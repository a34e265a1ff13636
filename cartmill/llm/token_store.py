"""Token ids in binary files, with document boundaries in Elias-Fano form.

Documents are sorted by id over the whole input, encoded in the sorted tasks and written as shards: one concatenated
array of ids, and next to it the ends of the documents and their ids as Elias-Fano sequences. Such a sequence keeps
the low bits of each value packed and the high bits in unary; counts of ones for each block of 512 bits, in 32 bits,
let ``select`` find any boundary without a table of offsets.

A shard holds up to ``SHARD_IDS`` ids, or one longer document. Files carry the name of the task's attempt, and the
manifest lists those of the attempts that succeeded: what a lost executor leaves is never read.

Defined results: null and empty texts have the end id only; rows with the same id keep their own entries, ordered by
text; rows with a null id come first; an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common, files

SHARD_IDS = 4 << 20
_CACHED_UNITS = 800_000
_MAGIC = b"EFIDS\x00\x00\x01"
# version, bytes of an id, rows with a null id, documents, ids, smallest document id
_HEADER = struct.Struct("<8sIIQQq")
_SEQUENCE = struct.Struct("<QBQQ")
_BLOCK = 64  # bytes
_TOGETHER = 1024  # documents whose bounds are selected at once
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


@dataclass
class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    size: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray

    def __post_init__(self):
        ones = _ONES[self.high].astype(np.uint32)
        pad = -len(ones) % _BLOCK
        per_block = np.pad(ones, (0, pad)).reshape(-1, _BLOCK).sum(axis=1, dtype=np.uint32)
        self.before = np.concatenate(([np.uint32(0)], np.cumsum(per_block, dtype=np.uint32)))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        width = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> width) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[places.astype(np.int64)] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def select(self, i: int) -> int:
        """Value number i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        return int(self.select_many(np.array([i]))[0])

    def select_many(self, i: np.ndarray) -> np.ndarray:
        """Values by ascending numbers: the counts name the block of each, its ones are looked for in that block alone."""
        block = np.searchsorted(self.before, i, side="right") - 1
        high = np.empty(len(i), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            b = int(block[a])
            ones = np.flatnonzero(np.unpackbits(self.high[b * _BLOCK : (b + 1) * _BLOCK], bitorder="little"))
            high[a:z] = 8 * _BLOCK * b + ones[i[a:z] - int(self.before[b])]
        at = i.astype(np.int64) * self.low_bits
        raw = np.zeros(len(i), dtype=np.uint64)
        if self.low_bits:
            found = np.take(self.low, (at >> 3)[:, None] + np.arange(9), mode="clip").astype(np.uint64)
            shift = (at & 7).astype(np.uint64)
            whole = (found[:, :8] << (8 * np.arange(8, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
            raw = whole >> shift | found[:, 8] << np.uint64(1) << (np.uint64(63) - shift)
            raw &= (np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1)
        return (high - i).astype(np.uint64) << np.uint64(self.low_bits) | raw

    def values(self) -> np.ndarray:
        """The whole sequence."""
        if not self.size:
            return np.zeros(0, dtype=np.uint64)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.size].astype(np.uint64)
        high -= np.arange(self.size, dtype=np.uint64)
        bits = np.unpackbits(self.low, bitorder="little", count=self.size * self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        low = (bits.reshape(self.size, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return (high << np.uint64(self.low_bits)) | low

    def dump(self) -> bytes:
        head = _SEQUENCE.pack(self.size, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def load(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        size, low_bits, n_low, n_high = _SEQUENCE.unpack_from(data, at)
        at += _SEQUENCE.size
        low = np.frombuffer(data, dtype=np.uint8, count=n_low, offset=at)
        high = np.frombuffer(data, dtype=np.uint8, count=n_high, offset=at + n_low)
        return cls(size, low_bits, low, high), at + n_low + n_high


def dump_shard(keys: list[int | None], ends: list[int], ids: list[bytes], id_bytes: int) -> list[bytes]:
    """The parts of a shard's file; ``ends`` counts ids up to each document's end."""
    known = [k for k in keys if k is not None]
    base = known[0] if known else 0
    offsets = EliasFano.of(np.array([k - base for k in known], dtype=np.uint64))
    body = b"".join(ids)
    head = _HEADER.pack(_MAGIC, id_bytes, len(keys) - len(known), len(keys), len(body) // id_bytes, base)
    meta = head + EliasFano.of(np.array(ends, dtype=np.uint64)).dump() + offsets.dump()
    return [meta, body, struct.pack("<I", zlib.crc32(body, zlib.crc32(meta)))]


class Shard:
    """A shard's file, read back."""

    def __init__(self, data: bytes):
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged shard")
        magic, id_bytes, self.nulls, self.docs, n_ids, self.base = _HEADER.unpack_from(data, 0)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        self.ends, at = EliasFano.load(data, _HEADER.size)
        self.keys, at = EliasFano.load(data, at)
        self.ids = np.frombuffer(data, dtype=f"<u{id_bytes}", count=n_ids, offset=at)

    def document(self, i: int) -> np.ndarray:
        """Ids of document number i, found through the boundaries."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def __iter__(self):
        """(document id, first id's place, ids) of each document; bounds and ids are selected some documents at a time."""
        start = 0
        for a in range(0, self.docs, _TOGETHER):
            numbers = np.arange(a, min(self.docs, a + _TOGETHER))
            ends = self.ends.select_many(numbers).tolist()
            known = self.keys.select_many(numbers[numbers >= self.nulls] - self.nulls).tolist()
            keys = [None] * (len(numbers) - len(known)) + [self.base + k for k in known]
            for key, end in zip(keys, ends, strict=True):
                yield key, start, self.ids[start:end]
                start = end


def _encoder(path: str, end_id: int, words) -> _UnitEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if words is lower_case_words:
        require_lower_case(path)
    return _UnitEncoder(Tokenizer.from_file(path), end_id, words)


class _UnitEncoder(dict):
    """Packed ids of white-space separated units, each encoded when first met.

    The tokenizer must drop ASCII white space between words. ``words`` may divide a unit into the words that the
    tokenizer would form, as its model sees them, or return None where it cannot tell.
    """

    def __init__(self, tokenizer, end_id: int, words=None):
        super().__init__()
        self.tokenizer, self.model, self.words = tokenizer, tokenizer.model, words
        self.id_bytes = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.end = end_id.to_bytes(self.id_bytes, "little")
        self.parts: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.id_bytes == 2 else 'I'}", *ids)

    def _part(self, word: str) -> bytes:
        found = self.parts.get(word)
        if found is None:
            found = self.parts[word] = self._pack([t.id for t in self.model.tokenize(word)])
        return found

    def __missing__(self, unit: str) -> bytes:
        words = self.words(unit) if self.words else None
        if words is None:
            found = self._pack(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        else:
            found = self._part(words[0]) if len(words) == 1 else b"".join(map(self._part, words))
        self[unit] = found
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        for cache in (self, self.parts):
            if len(cache) >= _CACHED_UNITS:
                cache.clear()
        return [b"".join(map(self.__getitem__, _split(t))) + self.end for t in texts]


# How the lower-casing vocabulary divides text into words
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# printable characters that no normal form changes and whose lower case does not depend on their neighbours
_PLAIN = re.compile(r"[!-~\xa1-\u012f]+")
# byte-level vocabularies write bytes that are no printable Latin-1 characters as the characters from U+0100 on
_PRINTED = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
_LEVEL = {b: chr(b) for b in _PRINTED} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))
}


# Normal forms and steps before the model, as the tokenizer file names them
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_DIVIDERS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def require_lower_case(path: str) -> None:
    """An error unless the tokenizer divides text as ``lower_case_words`` does."""
    with open(path, encoding="utf8") as file:
        described = json.load(file)
    normal, divided = described.get("normalizer") or {}, described.get("pre_tokenizer") or {}
    if normal.get("normalizers") != _NORMALIZERS or divided.get("pretokenizers") != _DIVIDERS:
        raise ValueError(f"{path} divides text into other words; write without 'words'")


def lower_case_words(unit: str) -> list[str] | None:
    """Words of a unit as a byte-level vocabulary with lower-casing and ``_WORD`` has them; None if it is not plain."""
    if not unit.isascii():
        if not _PLAIN.fullmatch(unit) or "<|" in unit:
            return None
        words = [unit.lower()] if unit.isalpha() else _WORD.findall(unit.lower())
        return [w.encode().decode("latin-1").translate(_LEVEL) for w in words]
    if unit.isalpha():
        return [unit.lower()]
    return _WORD.findall(unit.lower()) if unit.isprintable() and "<|" not in unit else None


_ASCII_SPACE = re.compile("[\t-\r ]+")


def _split(text: str | None) -> list[str]:
    """Units between white space; the separators U+001C to U+001F are none to tokenizers."""
    if not text:
        return []
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return [u for u in _ASCII_SPACE.split(text) if u]
    return text.split()


def write_token_ids(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
    words=None,
) -> DataFrame:
    """Write the shards and return the manifest: part, seq, name, n_docs, n_ids; reading order is (part, seq)."""
    schema = common.schema_of(
        ("part", T.IntegerType()), ("seq", T.IntegerType()), ("name", T.StringType()), ("n_docs", T.LongType()), ("n_ids", T.LongType())
    )
    target = common.arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        part, attempt, seq = TaskContext.get().partitionId(), files.attempt_name(), 0
        kept = ("token ids", tokenizer_path, end_id, words)
        encoder = common.held(kept, lambda: _encoder(tokenizer_path, end_id, words))
        keys, ends, ids, total = [], [], [], 0

        def flush():
            name = f"ids-{part:06d}-{seq:05d}-{attempt}.efi"
            files.write_file(folder, name, dump_shard(keys, ends, ids, encoder.id_bytes))
            return common.to_batch([(part, seq, name, len(keys), total)], target)

        for b in batches:
            for piece in common.slices(b, 1):
                texts = piece.column(1).to_pylist()
                for key, found in zip(piece.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    count = len(found) // encoder.id_bytes
                    if keys and total + count > shard_ids:
                        yield flush()
                        keys, ends, ids, total, seq = [], [], [], 0, seq + 1
                    total += count
                    keys.append(key)
                    ends.append(total)
                    ids.append(found)
        if keys:
            yield flush()

    source = common.doc_rows(docs, id_col, text_col)
    key, text = (F.col(f"`{c}`") for c in source.columns)
    source = source.select(key.cast("long").alias("key"), text.alias("text"))
    ordered = source.repartitionByRange(F.col("key")).sortWithinPartitions("key", "text")
    return common.stored(ordered.mapInArrow(run, schema), "token-manifest")


def read_token_ids(manifest: DataFrame, folder: str, finish, schema: T.StructType) -> DataFrame:
    """Rows ``finish(doc_id, start, ids)`` of all documents; start counts the ids of all documents before it."""
    sums = manifest.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    # one row for each task that wrote: the only rows that are ordered as a whole
    parts = sums.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("before_part"))
    within = Window.partitionBy("part").orderBy("seq")
    placed = manifest.withColumn("before", F.sum("n_ids").over(within) - F.col("n_ids")).join(parts, "part")
    shards = placed.select("name", (F.col("before") + F.col("before_part")).alias("base"))

    def rows(batch):
        for name, base in batch:
            with files.read_stream(folder, name) as stream:
                shard = Shard(stream.read())
            for key, start, ids in shard:
                yield finish(key, base + start, ids)

    spread = shards.repartition(max(1, manifest.count()), F.col("name"))  # else the few names are read by one task
    return common.arrow_map(spread, rows, schema)
