from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from cartmill.llm import simhash


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(values, bits):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_fingerprints():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50):
        text = "".join(rng.choice(["Äb", "X", "yy", "z\xa0"]) + rng.choice(" \n\t\x0b") for _ in range(n))
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def flipped(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("rows", [20_000, 40])
def test_links_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "SHARD_ROWS", rows)
    rng = random.Random(7)
    values = [rng.getrandbits(64) for _ in range(60)] + [0, 1, 3, (1 << 64) - 1]
    for v in values[:30]:
        for _ in range(6):  # chains of near values, some just too far
            v = flipped(rng, v, rng.choice([1, 2, 2, 3]))
            values.append(v)
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    distinct = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, least long")
    roots = {r["fp"]: r["root"] for r in simhash._roots(distinct, 2).collect()}
    want = brute_groups(values, 2)
    assert len(roots) == len(values)
    groups = {}
    for s, label in zip(signed, want, strict=True):
        groups.setdefault(label, set()).add(roots[s])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_more_vantage_points_link_alike(spark, monkeypatch):
    rng = random.Random(3)
    values = [rng.getrandbits(63) for _ in range(80)]
    values += [flipped(rng, v, 2) & ((1 << 63) - 1) for v in values]
    distinct = spark.createDataFrame([(v,) for v in set(values)], "fp long")

    def linked():
        return {(r["node"], r["root"]) for r in simhash.components(simhash._stars(distinct, 2)).collect()}

    found = []
    for levels in (1, 2, 3):
        monkeypatch.setattr(simhash, "_levels", lambda n, levels=levels: levels)
        found.append(linked())
    assert found[0] == found[1] == found[2] and found[0]


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (100, 150)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert roots == {**dict.fromkeys(range(1, 61), 0), 150: 100, 200: 100}


def test_groups_within_a_shard():
    values = np.array([0, 1, 3, 15 << 40, (15 << 40) + 1], dtype=np.uint64)
    groups = simhash._Groups(10)
    simhash.link_within(values, values, 1, groups, 5)
    groups.join(np.arange(5), np.arange(5) + 5)
    assert groups.label[:5].tolist() == [0, 0, 0, 3, 3]


def test_near_duplicates_and_survivors(docs):
    text = " ".join(f"w{i}" for i in range(400))
    near = text.replace("w200", "other")
    rows = [(5, text), (3, near), (9, text), (9, text), (None, text), (1, "quite another text"), (7, None), (8, ""), (6, "x y")]
    assert bin(simhash.fingerprint(text) ^ simhash.fingerprint(near)).count("1") <= 2
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs(rows)).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (None, 3), (1, 1), (7, 7), (8, 7), (6, 6)}
    kept = simhash.keep_one(docs(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7] and kept.columns == docs([]).columns
    assert simhash.keep_one(docs([(None, text), (None, text)])).count() == 1


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.keep_one(docs([])).count() == 0
