"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Items and documents are reduced to lower-case words (A to Z only) joined by single spaces. The automaton holds every
window of ``window`` item words, an item with fewer words being one window, with the separating spaces at both ends
so that only whole words match. A document is scanned once; hits are kept as ranges of words and mapped back to the
code points of the original text.

The automaton lives in each task's memory, so items are dealt into blocks of at most ``BLOCK_BYTES`` bytes of
windows. Each block is one more map over the documents: nothing is shuffled, however many items there are.

Defined results: null and empty texts have no words and no hits; an item without words matches nothing; items sharing
a window are all reported; items with a null id remove text but are not listed; equal rows give equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common

# bytes of distinct windows that one automaton may hold; a trie node costs some 20 times its byte
BLOCK_BYTES = 8 << 20

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_NORMAL = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())
_WORD = re.compile(rb"[^\x20]+")

_HIT_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
)


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case words of a text as UTF-8."""
    return (text or "").encode().translate(_NORMAL).split()


def _windows(text: str | None, size: int) -> set[tuple[bytes, int]]:
    words = normal_words(text)
    if not words:
        return set()
    size = min(size, len(words))
    return {(b" ".join(words[i : i + size]), size) for i in range(len(words) - size + 1)}


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (phrase, n_words, items): the ids of all items that contain each."""
    schema = common.schema_of(("item", T.StringType()), ("phrase", T.BinaryType()), ("n_words", T.IntegerType()))

    def rows(batch):
        for key, text in batch:
            for phrase, size in _windows(text, window):
                yield key, phrase, size

    source = common.doc_rows(items, id_col, text_col)
    source = source.withColumn(source.columns[0], F.col(f"`{source.columns[0]}`").cast("string"))
    return common.arrow_map(source, rows, schema).groupBy("phrase", "n_words").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


def _blocks(windows: DataFrame) -> Iterable[list[tuple[bytes, int, list[str]]]]:
    """Windows in blocks whose size was measured first, so that a block fits the driver and each task."""
    total = windows.agg(F.sum(F.length("phrase") + F.lit(16))).first()[0] or 0
    count = -(-int(total) // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("phrase"), F.lit(max(count, 1)))
    for i in range(count):
        yield [tuple(r) for r in windows.filter(block == i).collect()]


def build_automaton(windows: Iterable[tuple[bytes, int, list[str]]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase, size, items in windows:
        key = f" {phrase.decode('latin-1')} "
        automaton.add_word(key, (len(key), size, list(items)))
    automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
    """Hits as (first word, word after the last, items)."""
    text = f" {b' '.join(words).decode('latin-1')} "
    found = [(end + 1 - size, n, items) for end, (size, n, items) in automaton.iter(text)]
    if not found:
        return []
    # a word's number is that of the space before it
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 0x20)
    firsts = np.searchsorted(spaces, [at for at, _, _ in found])
    return [(int(first), int(first) + n, items) for first, (_, n, items) in zip(firsts, found, strict=True)]


def _covered(hits, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    for h in hits:
        edge[h[0]] += 1
        edge[h[1]] -= 1
    return np.cumsum(edge[:n]) > 0


def hit_spans(text: str, hits: list[tuple]) -> list[tuple[int, int]]:
    """Code point ranges of the original text that the hits cover, joined where they touch."""
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.translate(_NORMAL))]
    inside = _covered(hits, len(places))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    spans = []
    for first, after in edges.reshape(-1, 2):
        start = len(data[: places[first][0]].decode())
        spans.append((start, start + len(data[places[first][0] : places[after - 1][1]].decode())))
    return spans


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the ranges; one space stays where words would run together."""
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start].rstrip())
        at = end
    return " ".join(p for p in (*parts, text[at:].lstrip()) if p) if spans else text


def _with_hits(docs: DataFrame, text_col: str, windows: DataFrame) -> DataFrame:
    """``docs`` with the array of hits as the last column; one map over the documents per block of windows."""
    out = docs.withColumn(common.free(docs, "_hits"), F.array().cast(_HIT_TYPE))
    schema = out.schema
    text_at = schema.names.index(common.field(docs, text_col).name)
    spark = docs.sparkSession
    for block in _blocks(windows):
        shared = common.share(spark.sparkContext, block)

        def rows(batch, shared=shared, state={}):  # noqa: B006 - one automaton per task
            if "automaton" not in state:
                state["automaton"] = build_automaton(shared.value)
            for row in batch:
                hits = scan(state["automaton"], normal_words(row[text_at]))
                yield (*row[:-1], [*row[-1], *[{"start": a, "end": b, "items": i} for a, b, i in hits]])

        out = common.arrow_map(out, rows, schema)
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """Per row: n_words, n_hit (words inside an item window), item_ids (sorted as strings) and code point spans."""
    windows = item_windows(items, window, item_id, item_text)
    found = _with_hits(common.doc_rows(docs, id_col, text_col), text_col, windows)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = common.schema_of(
        common.field(docs, id_col),
        ("n_words", T.LongType()),
        ("n_hit", T.LongType()),
        ("item_ids", T.ArrayType(T.StringType())),
        ("spans", T.ArrayType(span)),
    )

    def rows(batch):
        for key, text, hits in batch:
            n = len(normal_words(text))
            if not hits:
                yield key, n, 0, [], []
                continue
            ranges = [(h["start"], h["end"]) for h in hits]
            spans = [{"start": a, "end": b} for a, b in hit_spans(text, ranges)]
            yield key, n, int(_covered(ranges, n).sum()), sorted({i for h in hits for i in h["items"]}), spans

    return common.arrow_map(found, rows, schema)


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """``docs`` with the words inside item windows cut out of the text; all rows and other columns stay."""
    windows = item_windows(items, window, item_id, item_text)
    found = _with_hits(docs, text_col, windows)
    at = docs.columns.index(common.field(docs, text_col).name)

    def rows(batch):
        for row in batch:
            text, hits = row[at], row[-1]
            if hits:
                text = remove_spans(text, hit_spans(text, [(h["start"], h["end"]) for h in hits]))
            yield (*row[:at], text, *row[at + 1 : -1])

    return common.arrow_map(found, rows, docs.schema)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """The rows of ``docs`` without a word inside an item window."""
    windows = item_windows(items, window, item_id, item_text)
    found = _with_hits(docs, text_col, windows)
    return found.filter(F.size(found.columns[-1]) == 0).drop(found.columns[-1])
