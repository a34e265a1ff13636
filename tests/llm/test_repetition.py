from __future__ import annotations

import random

import numpy as np
import pytest

from cartmill.llm import repetition

LIMITS = repetition.RepetitionLimits()


def brute_repeat_words(words, k=3):
    grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    return len({j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + k)})


@pytest.mark.parametrize("seed", range(12))
def test_counts_equal_brute_force(seed):
    rng = random.Random(seed)
    words = [rng.choice("ab c# ddd é% f".split()) for _ in range(rng.randint(0, 40))]
    text = "".join(w + rng.choice([" ", "\n", "\t", " \x0b"]) for w in words)
    n, chars, symbols, dup_lines, repeat, *_ = repetition.measure(text, LIMITS)
    assert (n, chars, symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text))
    assert repeat == brute_repeat_words(words)
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b")]
    assert dup_lines == len(lines) - len(set(lines))


@pytest.mark.parametrize("k", [2, 3, 5])
def test_rolling_hashes_tell_windows_apart(k):
    ids = np.array(random.Random(k).choices(range(3), k=300))
    hashes = repetition.window_hashes(ids, [k])[k]
    windows = [tuple(ids[i : i + k]) for i in range(len(ids) - k + 1)]
    assert len(hashes) == len(windows) and len(set(hashes.tolist())) == len(set(windows))
    assert len(set(zip(hashes.tolist(), windows, strict=True))) == len(set(windows))


def test_verdicts(spark, docs):
    clean = " ".join(f"word{i}" for i in range(60))
    line = " ".join(f"w{i}" for i in range(12))
    rows = [(1, clean), (2, "\n".join([line] * 20)), (3, None), (4, ""), (None, clean), (1, clean), (5, f"{clean}\n{clean}")]
    got = repetition.repetition_quality(docs(rows)).collect()
    assert [(r["doc_id"], r["base_failed"], r["kept"]) for r in got] == [
        (1, False, True),
        (2, True, False),
        (3, True, False),
        (4, True, False),
        (None, False, True),
        (1, False, True),
        (5, True, False),
    ]


def test_verdict_of_the_method_alone():
    """A passage of 60 words that stands twice among 360 passes the base rules and is rejected by its 10-grams."""
    words = [f"word{i:03}" for i in range(300)]
    *_, failed, kept = repetition.measure(" ".join(words + words[100:160]), LIMITS)
    assert (failed, kept) == (False, False)
    *_, failed, kept = repetition.measure(" ".join(words + words[100:120]), LIMITS)
    assert (failed, kept) == (False, True)


def test_share_of_repeated_lines():
    """Two of five short lines are repeated: few characters, but too many lines. One of three is none too many."""
    words = [f"word{i:03}" for i in range(300)]
    lines = ["a b", "c d", "a b", "c d", " ".join(words)]
    *_, failed, kept = repetition.measure("\n".join(lines), LIMITS)
    assert (failed, kept) == (False, False)
    *_, failed, kept = repetition.measure("\n".join(["a b", "a b", " ".join(words)]), LIMITS)
    assert (failed, kept) == (False, True)


def test_long_text_and_empty_table(docs):
    n, *_, failed, kept = repetition.measure("word " * 300_000, LIMITS)
    assert (n, failed, kept) == (300_000, True, False)
    assert repetition.repetition_quality(docs([])).count() == 0
