"""The best-scoring phrases of each language, grown best-first under admissible bounds.

Words and pairs of frequent words are counted in full. Longer phrases are grown from prefixes: no extension of a prefix
p, which starts with the word w, occurs more often than p or than the most frequent pair that starts with p's last word,
and cutting the extension after w gives a score of at most 2m / (f(w) + m) if it occurs at most m times. Prefixes are
expanded in batches of falling bounds: a batch's threshold is the score that the ``2 * top``-th pair of the language
has, then the ``8 * top``-th and so on. All prefixes whose bound reaches the threshold are expanded by one pass over the
texts for each length; the same pass counts what stands one word to the left or right of phrases that reach the
threshold themselves, which settles whether a longer phrase covers them: a phrase inside a longer one is inside one
that is a word longer and at least as frequent. When ``top`` phrases at or above the threshold survive, or the threshold
is 0, all with better or equal scores are known, ties included, and the language is done.

Which phrases a pass counts is looked up in bit maps of fixed size (4 MiB by default) by hash; a hash shared by chance only
makes it count more. Counts are keyed by language and phrase, combined in each task first, so a language that has most
of the rows, or a word in every text, is no hot key. Scores are exact: products are decimals.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count as often as they
stand; an empty table gives an empty result; only the two columns named are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartmill.llm.common import arrow_schema, doc_rows, release, slices, stored

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Capitals to small letters, and what ends a piece to one sign that no word holds.
_SIGNS = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 10 * b"."
)


@dataclass(frozen=True)
class Limits:
    """Candidates have 2 to ``max_words`` words and ``min_count`` occurrences.

    One is dropped if a longer candidate that holds it has at least ``cover`` percent of its occurrences. A bit map has
    2 ** ``map_bits`` bits; phrases of ``slice_bytes`` of text are counted together before Spark sees them.
    """

    top: int = 2000
    min_count: int = 30
    max_words: int = 4
    cover: int = 80
    map_bits: int = 25
    slice_bytes: int = 8 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Grams:
    """Hashes of the words and phrases that start at each place."""

    def __init__(self, first: np.ndarray):
        self.of = [first]

    def __getitem__(self, length: int) -> np.ndarray:
        while len(self.of) < length:
            k = len(self.of)
            self.of.append(_mixed(self.of[-1][:-1] * _MIX + self.of[0][k:]))
        return self.of[length - 1]


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _slots(hashes: np.ndarray, map_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - map_bits)).astype(np.int64)


@dataclass(frozen=True)
class _Set:
    """Bit map of phrases of so many words."""

    bits: np.ndarray
    words: int

    def has(self, grams: _Grams, start: int, n: int) -> np.ndarray:
        """Whether the phrases that start ``start`` words after each of ``n`` places may be in the set."""
        slot = _slots(grams[self.words][start : start + n], (8 * len(self.bits)).bit_length() - 1)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _set(phrases: DataFrame, length: int, map_bits: int) -> _Set:
    """Bit map of (lang, phrase) with phrases of ``length`` words; what comes to the driver is no larger than the map."""

    def run(batches):
        for batch in batches:
            bits: dict[int, int] = {}
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, text in zip(langs, texts, strict=True):
                slot = int(_slots(_Grams(_word_hashes(text.encode().split(b" "), lang))[length], map_bits)[0])
                bits[slot >> 6] = bits.get(slot >> 6, 0) | 1 << (slot & 63)
            values = np.fromiter(bits.values(), np.uint64, len(bits)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(bits), pa.int64()), pa.array(values)], names=["word", "bits"])

    rows = phrases.select("lang", "phrase").mapInArrow(run, "word long, bits long")
    found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (map_bits - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return _Set(out.view(np.uint8), length)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the words and signs of all texts in order, what the numbers stand for, and which of those are words."""
    joined = b".".join(texts.cast(pa.large_binary()).fill_null(b"").to_pylist())
    signs = joined.translate(_SIGNS).replace(b".", b" . ")
    split = pc.ascii_split_whitespace(pa.array([signs], pa.large_binary()).cast(pa.large_string())).flatten()
    coded = split.dictionary_encode()
    known = coded.dictionary
    word = ~np.asarray(pc.is_in(known, value_set=pa.array(["", "."], known.type)))
    return coded.indices.to_numpy(zero_copy_only=False), known, word


def _distinct(numbers: np.ndarray, at: np.ndarray, length: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct phrase that starts at the places, and how often it does."""
    key = numbers[at].astype(np.int64)
    for j in range(1, length):
        if j > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * base + numbers[at + j]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return at[first], count


Wanted = Callable[[dict[str, _Set], _Grams, int], np.ndarray]


def _counts(
    docs: DataFrame, length: int, slice_bytes: int, wanted: Wanted | None = None, sets: dict[str, _Set] | None = None
) -> DataFrame:
    """(lang, phrase, f): occurrences of the phrases of ``length`` words that ``wanted`` asks for, or of all.

    ``wanted`` gets the sets, the hashes and the number of places.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sets or {})

    def rows(lang: str, texts: pa.Array) -> pa.RecordBatch | None:
        numbers, known, word = _tokens(texts)
        n = len(numbers) - length + 1
        if n <= 0:
            return None
        inside = word[numbers]
        whole = inside[:n].copy()
        for j in range(1, length):
            whole &= inside[j : j + n]
        if wanted is not None:
            grams = _Grams(_word_hashes(known.cast(pa.large_binary()).to_pylist(), lang)[numbers])
            with np.errstate(over="ignore"):
                whole &= wanted(shared.value, grams, n)
        at, count = _distinct(numbers, np.flatnonzero(whole), length, len(known))
        words = [known.take(pa.array(numbers[at + j])) for j in range(length)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", known.type)) if length > 1 else words[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), phrase.cast(pa.string()), pa.array(count, pa.int64())], schema=target
        )

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0, slice_bytes):
                langs = part.column(1).cast(pa.string()).fill_null("und")
                for lang in pc.unique(langs).to_pylist():
                    found = rows(lang, part.column(0).filter(pc.equal(langs, lang)))
                    if found is not None and found.num_rows:
                        yield found
        release()

    schema = "lang string, phrase string, f long"
    target = arrow_schema(spark.createDataFrame([], schema).schema)
    found = docs.mapInArrow(run, schema).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    out = stored(found, f"phrases-{length}")
    shared.destroy()
    return out


def _parts(length: int) -> dict[str, Column]:
    """First words, last words and so on of a phrase, as columns."""
    words = F.split("phrase", " ")
    out = {}
    for k in range(1, length):
        out[f"head{k}"] = F.array_join(F.slice(words, 1, k), " ")
        out[f"tail{length - k}"] = F.array_join(F.slice(words, k + 1, length - k), " ")
    return out


def _scored(a: str, left: str, right: str) -> Column:
    """2,000,000 a / (l + r), rounded down, exactly; 0 for 0 / 0."""
    return F.expr(
        f"coalesce(cast(cast({a} as decimal(20, 0)) * 2000000 div nullif(cast({left} as decimal(20, 0)) + {right}, 0) as bigint), 0)"
    )


def _with_bound(phrases: DataFrame, words: DataFrame, nexts: DataFrame) -> DataFrame:
    """Adds ``bound``: no extension of the phrase has a larger score.

    ``words`` counts words, ``nexts`` has the most frequent pair that starts with each word.
    """
    first = words.select("lang", F.col("phrase").alias("w"), F.col("f").alias("f_first"))
    out = phrases.withColumn("w", F.substring_index("phrase", " ", 1)).join(first, ["lang", "w"]).drop("w")
    out = out.withColumn("w", F.substring_index("phrase", " ", -1)).join(nexts, ["lang", "w"], "left").drop("w")
    out = out.withColumn("m", F.least("f", F.coalesce("f_next", F.lit(0))))
    return out.withColumn("bound", _scored("m", "f_first", "m")).drop("f_first", "f_next", "m")


def _cut(phrases: DataFrame, counts: dict[int, DataFrame], length: int) -> DataFrame:
    """(lang, phrase, f, l, r, score) of the lowest-scoring cut, of several that after the fewest words.

    A cut one part of which was not counted gives no score: ``score`` is then null.
    """
    out = phrases.select("lang", "phrase", "f").withColumns(_parts(length))
    for k in range(1, length):
        for part, at in ((f"head{k}", k), (f"tail{k}", k)):
            known = counts[at].select("lang", F.col("phrase").alias(part), F.col("f").alias(f"f_{part}"))
            out = out.join(known, ["lang", part], "left")
    cuts = []
    for k in range(1, length):
        left, right = f"f_head{k}", f"f_tail{length - k}"
        cuts.append(
            F.struct(_scored("f", left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
        )
    complete = reduce(lambda a, b: a & b, [F.col(f"f_{s}{k}").isNotNull() for k in range(1, length) for s in ("head", "tail")])
    best = F.when(complete, F.array_min(F.array(*cuts)))
    return out.withColumn("best", best).select("lang", "phrase", "f", "best.l", "best.r", "best.score")


def _longest(phrases: DataFrame, part: str, length: int) -> DataFrame:
    """(lang, phrase, f_next): the most frequent of the phrases that start or end with each part."""
    grouped = phrases.withColumn("part", _parts(length)[f"{part}{length - 1}"]).groupBy("lang", "part")
    return grouped.agg(F.max("f").alias("f_next")).withColumnRenamed("part", "phrase")


def _surviving(phrases: DataFrame, longer: DataFrame | None, length: int, cover: int) -> DataFrame:
    """Those no longer phrase covers; ``longer`` has all that are a word longer and hold one of them."""
    if longer is None:
        return phrases
    both = _longest(longer, "head", length + 1).unionByName(_longest(longer, "tail", length + 1))
    covered = both.groupBy("lang", "phrase").agg(F.max("f_next").alias("f_next"))
    out = phrases.join(covered, ["lang", "phrase"], "left")
    return out.filter(F.col("f_next").isNull() | (100 * F.col("f_next") < cover * F.col("f"))).drop("f_next")


def _expanded(docs: DataFrame, known: dict[int, DataFrame], limits: Limits, thresholds: DataFrame) -> DataFrame:
    """All surviving phrases of the languages in ``thresholds`` that reach their threshold ``t``.

    ``known`` has words, and pairs with score and bound.
    """
    pairs = known[2].join(thresholds, "lang")
    counts = {1: known[1], 2: known[2].join(thresholds, "lang", "left_semi")}
    reaching = [(2, pairs.filter("score >= t").select("lang", "phrase", "f", "l", "r", "score"))]
    frontier = pairs.filter("score >= t or bound >= t")
    longer: dict[int, DataFrame] = {}
    bits, at_once = limits.map_bits, limits.slice_bytes
    pair = _set(counts[2], 2, bits)
    for length in range(3, limits.max_words + 1):
        own = length - 1
        sets = {"prefix": _set(frontier, own, bits), "reaching": _set(reaching[-1][1], own, bits), "pair": pair}

        def wanted(sets: dict[str, _Set], grams: _Grams, n: int, length: int = length) -> np.ndarray:
            grown = sets["prefix"].has(grams, 0, n) & sets["pair"].has(grams, length - 2, n)
            return grown | (sets["pair"].has(grams, 0, n) & sets["reaching"].has(grams, 1, n))

        found = _counts(docs, length, at_once, wanted, sets).filter(F.col("f") >= limits.min_count)
        found = found.join(thresholds, "lang", "left_semi")
        counts[length] = longer[own] = found
        # parts of three words and more may not have been counted, where their own prefix has a low bound
        parts = dict(counts)
        for part in range(3, length):
            grown = frontier.select("lang", F.col("phrase").alias(f"head{own}"))
            lacking = found.withColumns(_parts(length)).join(grown, ["lang", f"head{own}"], "left_semi")
            lacking = lacking.select("lang", F.col(f"tail{part}").alias("phrase")).distinct()
            lacking = stored(lacking.join(counts[part], ["lang", "phrase"], "left_anti"), f"phrases-lacking-{part}")
            if not lacking.isEmpty():
                asked = {"lacking": _set(lacking, part, bits)}
                more = _counts(docs, part, at_once, lambda sets, grams, n: sets["lacking"].has(grams, 0, n), asked)
                more = more.join(lacking, ["lang", "phrase"], "left_semi")
                parts[part] = counts[part].unionByName(more)
        scored = stored(_cut(found, parts, length).join(thresholds, "lang"), f"phrases-scored-{length}")
        reaching.append((length, scored.filter("score >= t").drop("t")))
        bounded = _with_bound(scored, known[1], known[0])
        frontier = bounded.filter("score >= t or bound >= t")
    kept = [_surviving(phrases, longer.get(length), length, limits.cover) for length, phrases in reaching]
    return stored(reduce(DataFrame.unionByName, kept), "phrases-surviving")


def collocations(df: DataFrame, limits: Limits = Limits(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts at the cut with the lowest score 2,000,000 a / (l + r),
    ``n`` all words of the language. Ranked by score, then ``a``, then the phrase's bytes.
    """
    docs = doc_rows(df, text_col, lang_col)
    words = _counts(docs, 1, limits.slice_bytes)
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
    frequent = words.filter(F.col("f") >= limits.min_count)
    both = {"word": _set(frequent, 1, limits.map_bits)}

    def frequent_words(sets: dict[str, _Set], grams: _Grams, n: int) -> np.ndarray:
        return sets["word"].has(grams, 0, n) & sets["word"].has(grams, 1, n)

    pairs = _counts(docs, 2, limits.slice_bytes, frequent_words, both)
    pairs = pairs.filter(F.col("f") >= limits.min_count)
    nexts = pairs.groupBy("lang", F.substring_index("phrase", " ", 1).alias("w")).agg(F.max("f").alias("f_next"))
    scored = stored(_with_bound(_cut(pairs, {1: frequent}, 2), frequent, nexts), "phrases-pairs")
    known = {0: stored(nexts, "phrases-next"), 1: frequent, 2: scored}
    done = []
    active, rank = totals.select("lang"), 2 * limits.top
    while not active.isEmpty():
        order = Window.partitionBy("lang").orderBy(F.desc("score"), "phrase")
        at = scored.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= rank)
        at = at.filter(F.col("i") == rank).select("lang", F.col("score").alias("t"))
        thresholds = stored(active.join(at, "lang", "left").select("lang", F.coalesce("t", F.lit(0)).alias("t")), "phrases-thresholds")
        found = _expanded(docs, known, limits, thresholds)
        count = found.groupBy("lang").agg(F.count("*").alias("n"))
        settled = thresholds.join(count, "lang", "left").select("lang", ((F.col("t") == 0) | (F.coalesce("n", F.lit(0)) >= limits.top)).alias("ok"))
        settled = stored(settled, "phrases-settled")
        done.append(found.join(settled.filter("ok"), "lang", "left_semi"))
        active, rank = settled.filter(~F.col("ok")).select("lang"), 4 * rank
    if not done:
        done = [_empty(df.sparkSession)]
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = reduce(DataFrame.unionByName, done).withColumn("rank", F.row_number().over(best).cast("long"))
    ranked = ranked.filter(F.col("rank") <= limits.top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, phrase string, f long, l long, r long, score long")
