from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cartmill.llm import runs
from cartmill.llm.queries import _periodic_tail


def brute(words):
    """Every period compared at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def text_of(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        unit = [rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(1, 25))]
        out += (unit * rng.randint(1, 9))[: rng.randint(1, 120)]
        if rng.random() < 0.3:
            out += out[-rng.randint(1, 40) :] * rng.randint(1, 5)
    return out


def numbered(texts):
    return np.array([w for t in texts for w in t], np.int32), np.array([len(t) for t in texts], np.int64)


@pytest.mark.parametrize("seed", range(60))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    texts = [text_of(rng) for _ in range(rng.randint(1, 8))]
    assert runs.find_runs(*numbered(texts), 5) == [brute(t) for t in texts]


@pytest.mark.parametrize("seed", range(30))
def test_grammar_derives_the_words(seed):
    rng = random.Random(seed)
    texts = [text_of(rng) for _ in range(4)]
    words, sizes = numbered(texts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    grammar, top, places = runs.re_pair(words, doc, 5)

    def derive(symbol):
        if symbol < 5:
            return [symbol]
        return derive(int(grammar.left[symbol - 5])) + derive(int(grammar.right[symbol - 5]))

    assert [w for s in top.tolist() for w in derive(s)] == words.tolist()
    assert all(derive(s) == words[p : p + len(derive(s))].tolist() for s, p in zip(top.tolist(), places.tolist(), strict=True))
    for k in range(len(grammar.left)):
        body = derive(5 + k)
        assert len(body) == grammar.length[k] and words[grammar.first[k] :][: len(body)].tolist() == body
    # no pair stands twice within documents unless it overlaps itself
    owner = doc[places] if len(places) else places
    pairs = [(a, b) for i, (a, b) in enumerate(zip(top.tolist(), top[1:].tolist(), strict=False)) if owner[i] == owner[i + 1]]
    assert all(a == b or pairs.count((a, b)) == 1 for a, b in pairs)


def test_equal_hashes_of_different_words_do_not_show(monkeypatch):
    monkeypatch.setattr(runs, "_mixed", lambda x: x & np.uint64(1))
    rng = random.Random(1)
    for _ in range(40):
        text = text_of(rng)
        assert runs.find_runs(*numbered([text]), 5) == [brute(text)]


@pytest.mark.parametrize(
    ("words", "expected"),
    [
        ([0] * 200_000, [(0, 200_000, 1)]),
        ([0, 1] * 50_000 + [2], [(0, 100_000, 2)]),
        (list(range(3_000)) * 40, [(0, 120_000, 3_000)]),
        (list(range(100_000)), []),
    ],
)
def test_very_long_texts(words, expected):
    assert runs.find_runs(*numbered([words]), max(words) + 1) == [expected]


def test_small_slices_give_the_same_runs(docs):
    rng = random.Random(3)
    rows = [(i, " ".join(map(str, text_of(rng)))) for i in range(30)]
    whole = runs.periodic_runs(docs(rows)).collect()
    assert runs.periodic_runs(docs(rows), slice_bytes=64).collect() == whole
    assert [[tuple(r) for r in row["runs"]] for row in whole] == [brute(t.split()) for _, t in rows]


def test_awkward_rows(docs):
    rows = [(1, None), (2, ""), (3, "a\x0ba\x0ca\r\na\ta a \n"), (3, "a\x0ba\x0ca\r\na\ta a \n"), (None, "x y\u00a0z " * 4), (4, "a a a a a")]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs(rows)).collect()]
    assert got == [
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 6, [(0, 6, 1)], "a"),
        (3, 6, [(0, 6, 1)], "a"),
        (None, 8, [(0, 8, 2)], "x y\u00a0z"),
        (4, 5, [], "a a a a a"),
    ]
    assert runs.periodic_runs(docs([])).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(7, "b b b b b b b", "r", 1)], "doc_id long, text string, runs string, n_words int")
    row = runs.periodic_runs(df).first()
    assert (row["n_words"], row["collapsed"], [tuple(x) for x in row["runs"]]) == (7, "b", [(0, 7, 1)])


def test_words_kept_by_every_run():
    """A word goes if any run holds it after that run's first period, though another run begins with it."""
    words = [0, 0, 0, 0, 0, 0, 1] * 4
    found = runs.find_runs(*numbered([words]), 2)[0]
    assert found == brute(words) and (0, 28, 7) in found
    assert (~runs.dropped(28, found)).tolist() == [True] + [False] * 5 + [True] + [False] * 21


def test_planted_tail():
    key = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    words = [str(i).encode() for i in range(50)]
    h = zlib.crc32(str(key).encode())
    a, p = h // 10 % 50, 1 + (50 - h // 10 % 50) // (3 + h // 10 % 8)
    assert _periodic_tail(key, words) == [words[i if i < a else a + (i - a) % p] for i in range(50)]
    assert _periodic_tail(None, words) == words and _periodic_tail(key, []) == []
