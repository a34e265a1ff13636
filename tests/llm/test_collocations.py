from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cartmill.llm import collocations
from cartmill.llm.collocations import Limits


def brute(rows, limits):
    """Every phrase of every piece counted."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, limits.max_words + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= limits.min_count}
    out = []
    for (lang, *words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        inside = (
            b
            for (other, *longer), b in candidates.items()
            if other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        )
        if all(100 * b < limits.cover * a for b in inside):
            out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= limits.top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return result


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, 1) for i, (g, t) in enumerate(rows)], "phrase long, text string, lang string, f int")


def answers(df, limits):
    return sorted(tuple(r) for r in collocations.collocations(df, limits).collect())


def texts(seed, n=60):
    """Words of skewed frequency, with passages that many texts share."""
    rng = random.Random(seed)
    words = ["a", "B", "c", "Dd", "e", " f", "É", "g-h", "i\x1cj", "k"]
    passages = [" ".join(rng.choices(words, k=rng.randint(2, 8))) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.4:
                parts.append(rng.choice(passages))
            else:
                parts.append(rng.choice([" ", "\t", "  "]).join(rng.choices(words, weights=range(10, 0, -1), k=rng.randint(1, 9))))
        joined = "".join(p + rng.choice([" ", ". ", ",", "\n", "\x0b", " ! ? "]) for p in parts)
        out.append((rng.choice(["en", "en", "de", None, ""]), joined))
    return out


@pytest.mark.parametrize(
    ("seed", "limits"),
    [(1, Limits(5, 3)), (2, Limits(3, 2)), (3, Limits(10_000, 2)), (4, Limits(8, 2, max_words=6)), (5, Limits(2, 4, 3, 100))],
)
def test_equals_brute_force(spark, seed, limits):
    rows = texts(seed)
    assert answers(table(spark, rows), limits) == brute(rows, limits)


def test_shared_hashes_and_small_slices(spark):
    rows, limits = texts(7), Limits(4, 2, map_bits=7, slice_bytes=200)
    assert answers(table(spark, rows).repartition(5), limits) == brute(rows, limits)


def test_further_batches_of_the_frontier(spark):
    """Longer phrases cover nearly all of the best pairs, so lower thresholds are needed."""
    rng = random.Random(11)
    chains = [" ".join(f"w{i}{j}" for j in "abcd") for i in range(20)]
    rows = [("en", ". ".join([*chains, " ".join(rng.choices([f"v{i}" for i in range(8)], k=40))])) for _ in range(6)]
    calls = []
    keep = collocations._expanded

    def counted(*args):
        calls.append(1)
        return keep(*args)

    limits = Limits(top=30, min_count=4)
    try:
        collocations._expanded = counted
        assert answers(table(spark, rows), limits) == brute(rows, limits)
    finally:
        collocations._expanded = keep
    assert len(calls) > 1


def test_awkward_rows(spark):
    assert answers(table(spark, []), Limits()) == []
    assert answers(table(spark, [("en", None), (None, ""), ("en", " .,\t\n")]), Limits(5, 1)) == []
    rows = [(None, "x y"), ("und", "X Y"), ("en", "y x")]
    assert answers(table(spark, rows), Limits(5, 2)) == [("und", 1, "x y", 2, 2, 2, 4, 1_000_000)]


def test_very_long_text(spark):
    rows = [("en", "p q " * 200_000), ("en", "p q r")]
    got = answers(table(spark, rows), Limits(5, 2))
    assert [(r[2], r[3]) for r in got] == [("p q p q", 199_999), ("q p q p", 199_998)]
    assert got[0][6] == 400_003


def test_ties_are_ranked_by_bytes(spark):
    rows = [("en", "é b. a b2. z z1. a b2. z z1. é b")]
    assert [r[2] for r in answers(table(spark, rows), Limits(3, 2))] == ["a b2", "z z1", "é b"]


def test_exact_products(spark):
    row = spark.createDataFrame([(9 * 10**18, 9 * 10**18, 9 * 10**18)], "a long, l long, r long")
    assert row.select(collocations._scored("a", "l", "r")).first()[0] == 1_000_000


def test_hashes_of_phrases_follow_their_words():
    words = np.array([3, 5, 7, 3, 5, 7], np.uint64)
    with np.errstate(over="ignore"):
        grams = collocations._Grams(words)
        assert grams[3][0] == grams[3][3] and len(set(grams[3].tolist())) == 3
