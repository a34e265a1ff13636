from __future__ import annotations

import random
import re

import pytest

from cartmill.llm import decontamination as dc

PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, size):
    own, hit, ids = words(text), set(), set()
    for key, item in items:
        parts = words(item)
        n = min(size, len(parts))
        for i in range(len(parts) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == parts[i : i + n]:
                    hit.update(range(j, j + n))
                    ids |= {str(key)} if key is not None else set()
    return len(own), len(hit), sorted(ids)


@pytest.fixture
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return build


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_equals_brute_force(docs, items, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    rng = random.Random(5)
    vocabulary = ["one", "Two", "ÉTÉ", "x1", "a", "über"]
    held = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(12)]
    held += [(3, "one two one"), (None, "x1 x1 x1"), (99, None), (98, "..."), (10, "a")]
    rows = [(i, ", ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(30)]
    rows += [(40, None), (41, ""), (None, "a a"), (5, rows[5][1]), (42, "no hit"), (43, "x1-x1/X1!")]
    got = dc.contamination(docs(rows), items(held), window=4).collect()
    assert [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got] == [
        (i, *brute(t, held, 4)) for i, t in rows
    ]


def test_spans_and_removal(docs, items):
    text = "Ä start. The ANSWER is forty-two, they say — end"
    held = items([(1, "the answer, is forty two")])
    row = dc.contamination(docs([(1, text)]), held, window=10).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["The ANSWER is forty-two"]
    cut = dc.remove_contamination(docs([(1, text), (2, None), (3, "kept  as is ")]), held).collect()
    assert [r["text"] for r in cut] == ["Ä start. , they say — end", None, "kept  as is "]
    left = dc.drop_contaminated(docs([(1, text), (2, None), (3, "kept")]), held)
    assert [r["doc_id"] for r in left.collect()] == [2, 3] and left.columns == docs([]).columns


def test_empty_tables_and_long_texts(docs, items):
    assert dc.contamination(docs([]), items([(1, "a b")])).count() == 0
    assert dc.contamination(docs([(1, "a b")]), items([])).first()["n_hit"] == 0
    row = dc.contamination(docs([(1, "filler " * 200_000 + "q w e r t y u i o p")]), items([(1, "q w e r t y u i o p")])).first()
    assert (row["n_words"], row["n_hit"]) == (200_010, 10)
