from __future__ import annotations

import random

import numpy as np
import pytest

from cartmill.llm import substrings


def brute(rows, length):
    """Kept bytes and removed runs by comparing all strings in order."""
    seen, out = set(), {}
    for key, text in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(data[i : i + length])
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(data), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def check(docs, rows, length):
    got = substrings.remove_repeats(docs(rows), length=length).collect()
    want = brute(rows, length)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], len(r["spans"]), bytes(r["kept"])) == want[r["doc_id"]], r["doc_id"]


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(n))


@pytest.mark.parametrize("frequent", [48, 2])
@pytest.mark.parametrize("length", [32, 100])
def test_equals_brute_force(docs, monkeypatch, frequent, length):
    monkeypatch.setattr(substrings, "_FREQUENT", frequent)
    rng = random.Random(length)
    passage, line = words(rng, 60), words(rng, 30)
    rows = []
    for i in range(40):
        parts = [words(rng, rng.randint(0, 50))]
        if i % 3 == 0:
            parts.append(line)
        if i % 5 == 0:
            parts.insert(rng.randint(0, 1), passage[rng.randint(0, 40) :])
        rows.append((i, "\n".join(parts)))
    rows += [(50, rows[7][1]), (51, rows[7][1]), (52, "ab" * 300), (53, "ab" * 200), (54, passage + passage), (55, "a" * 500)]
    rows += [(60, None), (61, ""), (62, "x" * (length - 1)), (7, rows[7][1]), (None, line + line)]
    check(docs, rows, length)


def test_repeated_text_over_many_batches(docs, spark):
    rng = random.Random(9)
    line = words(rng, 40)
    rows = [(i, f"{words(rng, 3)} {line} {words(rng, 3)}") for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(docs, rows, 64)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equal_windows_name_equal_places():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 500).astype(np.uint8)
    h = substrings.seed_hashes(data)
    assert len(h) == 500 - substrings._SEED + 1
    for width in (1, 2, 5, 17, 64, 85):
        want = [i + int(np.argmin(h[i : i + width])) for i in range(len(h) - width + 1)]
        assert substrings.first_minima(h, width).tolist() == want


def test_long_text_and_empty_table(docs):
    text = words(random.Random(2), 100_000)
    row = substrings.remove_repeats(docs([(1, text), (2, text)])).orderBy("doc_id").collect()
    assert bytes(row[0]["kept"]).decode() == text and bytes(row[1]["kept"]) == b"" and len(row[1]["spans"]) == 1
    assert substrings.remove_repeats(docs([])).count() == 0


def test_text_ids_are_refused(spark):
    with pytest.raises(TypeError):
        substrings.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
