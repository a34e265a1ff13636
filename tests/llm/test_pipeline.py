"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import check_oracles
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from cartmill.llm import bpe, common, pii
from tests.llm.conftest import SF
from tests.llm.test_decontamination import brute as brute_contamination
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_simhash import brute_fingerprint, brute_groups

NAMES = sorted(common.QUERIES)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check_oracles.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in NAMES)
    assert numbers == list(range(1, 14)) and set(NAMES) | {"pipeline"} <= set(queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]


@pytest.mark.parametrize("name", [n for n in NAMES if n in common.SQL])
def test_matches_sql(spark, con, name):
    problems, _, _ = check_oracles.compare(name, queries()[name](spark, SF), oracle_sql()[name], con)
    assert problems == []


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def test_personal_data(spark, texts):
    got = queries()["op5_personal_data"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert set(listed(spans).split(",")) - {""} <= set(r["spans"].split(","))


def test_near_duplicates(spark, texts):
    got = {r["doc_id"]: r for r in queries()["op6_simhash_near_duplicates"](spark, SF).collect()}
    ids = sorted(texts)
    values = [brute_fingerprint(texts[i]) for i in ids]
    for i, value, label in zip(ids, values, brute_groups(values, 2), strict=True):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{value:016x}", ids[label])


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, texts, library):
    got = queries()["op7_byte_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert tuple(r)[1:] == (len(ids), packed, hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


def test_token_ids(spark, texts):
    got = {r["doc_id"]: r for r in queries()["op9_token_ids"](spark, SF).collect()}
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        assert tuple(got[i])[1:] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_toxicity_rows(spark, texts):
    got = queries()["op8_toxicity"](spark, SF).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in texts}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_stages(spark, con, texts, library):
    docs = common.table(spark, SF, "documents")
    scored = {r["doc_id"]: r["score"] for r in queries()["op8_toxicity"](spark, SF).collect()}
    stages = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        out = common.stored(stages[name](spark, frame, SF), "stage-test")
        if name != "byte_bpe":
            assert out.dtypes == docs.dtypes
        return out, {r["doc_id"]: r for r in out.collect()}

    frame, rows = run("toxicity", docs)
    assert set(rows) == {i for i, s in scored.items() if s < 0.5}
    before = sorted(rows)
    groups = brute_groups([brute_fingerprint(texts[i]) for i in before], 2)
    frame, rows = run("near_duplicates", frame)
    assert set(rows) == {before[label] for label in groups}
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    clean = {i for i in rows if not brute_contamination(texts[i], items, 10)[1]}
    frame, rows = run("decontamination", frame)
    assert set(rows) == clean and all(r["text"] == texts[i] for i, r in rows.items())
    frame, rows = run("personal_data", frame)
    assert set(rows) == clean
    for i, r in rows.items():
        assert r["text"] == pii.replace_spans(texts[i], brute_spans(texts[i])) and r["n_chars"] == len(r["text"])
    private = {i: r["text"] for i, r in rows.items()}
    _, rows = run("byte_bpe", frame)
    assert {i: r["text"] for i, r in rows.items()} == private
    assert all(r["ids"] == library.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in rows.values())


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows and an empty table pass every stage."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c", "en", "s", 5)] * 2 + [(None, None, None, None, None)] * 2
    rows += [(2, "", "en", None, 0), (3, "word mail@host.org " * 20_000, "en", "s", 1)]
    for name in ("labels", "benchmark"):
        common.table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for data, left in ((rows, 3), ([], 0)):
        docs = spark.createDataFrame(data, kinds)
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, str(tmp_path)), f"awkward-{name}")
        assert docs.count() == left
        if left:
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert texts[1] == "a b c" and texts[3].startswith("word <EMAIL> word <EMAIL>")
