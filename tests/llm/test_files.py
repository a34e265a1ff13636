"""Operators that write files: WARC archives and token ids."""

from __future__ import annotations

import base64
import glob
import hashlib
import io
import json
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartmill.llm import common, files, token_store, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def pages(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, key string")

    return build


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


ROWS = [
    (7, "http://a/7", "<p>one</p>"),
    (3, "http://a/3\r\nInjected: yes", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "ünï" * 4000),
    (6, "http://a/6", "ünï" * 4000),
    (-2, "http://a/-2", "only here"),
    (None, "http://a/n", "only here"),
]


def test_archive_round_trip(spark, pages):
    folder = common.new_folder(spark, "warc-test")
    manifest = warc.write_archive(pages(ROWS), folder, layout=warc.ArchiveLayout(shard_bytes=20_000, file_bytes=300))
    got = warc.read_archive(manifest, folder).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["key"], []).append(r)
    assert len(got) == len(ROWS) and manifest.count() > 3
    for key, _, html in ROWS:
        payload = (html or "").encode()
        for r in by_key[key]:
            assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), digest(payload))
            assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == payload
    kinds = {k: sorted((r["record_type"], r["refers_to"]) for r in v) for k, v in by_key.items()}
    assert kinds[3] == [("response", None)] and kinds[7] == kinds[9] == [("revisit", 3)]
    assert kinds[4] == [("response", None)] and kinds[5] == [("revisit", 4)]
    assert kinds[6] == [("response", None), ("revisit", 6)]
    # among equal payloads a null key gives way
    assert {kinds[-2][0][0], kinds[None][0][0]} == {"response", "revisit"}


def test_same_files_however_the_rows_lie(spark, pages):
    rows = [(i, f"http://h/{i}", "text " * (i % 50)) for i in range(0, 4000, 7)]
    random.Random(1).shuffle(rows)
    found = []
    for parts in (1, 5):
        folder = common.new_folder(spark, "warc-test")
        layout = warc.ArchiveLayout(shard_bytes=100_000, file_bytes=10_000)
        manifest = warc.write_archive(pages(rows).repartition(parts), folder, layout=layout)
        found.append(sorted(tuple(r) for r in manifest.collect()))
        rows.reverse()
    assert found[0] == found[1] and len(found[0]) > 5


def test_only_committed_files_are_listed(spark, pages):
    folder = common.new_folder(spark, "warc-test")
    manifest = warc.write_archive(pages(ROWS), folder)
    system, root = files.open_folder(folder)
    system.create_dir(f"{root}/_temporary/lost", recursive=True)
    with system.open_output_stream(f"{root}/_temporary/lost/archive-00000000-00000.warc.gz", compression=None) as out:
        out.write(b"half a rec")
    assert warc.read_archive(manifest, folder).count() == len(ROWS)
    name = manifest.first()["name"]
    files.move_file(folder, "_temporary/gone", name)  # moved by an earlier attempt
    with pytest.raises(FileNotFoundError):
        files.move_file(folder, "_temporary/gone", "never.warc.gz")


def test_small_payloads_may_stay_responses(spark, pages):
    folder = common.new_folder(spark, "warc-test")
    manifest = warc.write_archive(pages(ROWS), folder, layout=warc.ArchiveLayout(min_payload=11))
    kinds = [(r["key"], r["record_type"]) for r in warc.read_archive(manifest, folder).collect()]
    assert sorted(k for k, t in kinds if t == "revisit") == [6]


def test_damage_is_noticed():
    member = warc.response_member(1, "http://a", b"payload", None, warc.ArchiveLayout())
    ((headers, block),) = warc.read_members(io.BytesIO(member))
    assert headers["warc-payload-digest"] == f"sha1:{digest(b'payload')}" and block.endswith(b"\r\n\r\npayload")
    with pytest.raises(ValueError):
        list(warc.read_members(io.BytesIO(__import__("gzip").compress(b"HTTP/1.1 200"))))


def test_cuts_divide_heavy_bins(spark):
    keys = list(range(1000)) + [1 << 50]
    sizes = spark.createDataFrame([(k, 10) for k in keys], "key long, size long")
    cuts = warc.range_cuts(sizes, 500)
    dealt = np.bincount(np.searchsorted(cuts, keys, side="right"))
    assert dealt.max() <= 50 and len(cuts) >= 20
    assert warc.range_cuts(sizes.limit(0), 500) == []


def test_number_of_shards_is_bounded(spark, monkeypatch):
    sizes = spark.range(5_000).selectExpr("id AS key", "10 AS size")
    monkeypatch.setattr(warc, "MOST_SHARDS", 20)
    cuts = warc.range_cuts(sizes, 100)
    assert 10 <= len(cuts) <= 20


def test_empty_archive(spark, pages):
    folder = common.new_folder(spark, "warc-test")
    assert warc.read_archive(warc.write_archive(pages([]), folder), folder).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000])
@pytest.mark.parametrize("top", [1, 40, 10**6, 2**60])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n).astype(np.uint64))
    data = token_store.EliasFano.of(values).dump()
    found, end = token_store.EliasFano.load(data, 0)
    assert end == len(data) and (found.values() == values).all()
    assert [found.select(i) for i in range(n)] == values.tolist()
    some = np.arange(0, n, 3)
    assert found.select_many(some).tolist() == values[some].tolist()
    with pytest.raises(IndexError):
        found.select(n)
    # two bits and the logarithm of the mean gap for each value
    assert 8 * len(data) <= n * (3 + max(1, top // max(n, 1)).bit_length()) + 400


TEXTS = [(9, "Hello, World! it's"), (2, None), (5, ""), (None, "null first"), (5, "ünïcode Straße İstanbul 123"), (2**60, " a\xa0b\x1cc <|endoftext|> ")]


@pytest.mark.parametrize("shard_ids", [1, 6, 1 << 20])
@pytest.mark.parametrize("words", [None, token_store.lower_case_words])
def test_token_ids_round_trip(spark, docs, shard_ids, words):
    folder = common.new_folder(spark, "ids-test")
    manifest = token_store.write_token_ids(docs(TEXTS), folder, TOKENIZER, 1, shard_ids=shard_ids, words=words)
    schema = common.schema_of(*[(c, token_store.T.LongType()) for c in ("doc_id", "start")], ("ids", token_store.T.ArrayType(token_store.T.LongType())))
    got = token_store.read_token_ids(manifest, folder, lambda k, s, ids: (k, s, ids.tolist()), schema).collect()
    tokenizer, start, want = Tokenizer.from_file(TOKENIZER), 0, []
    for key, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((key, start, ids))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_document_by_boundaries(spark, docs):
    folder = common.new_folder(spark, "ids-test")
    manifest = token_store.write_token_ids(docs(TEXTS), folder, TOKENIZER, 1)
    for row in manifest.collect():
        with files.read_stream(folder, row["name"]) as stream:
            data = stream.read()
        shard = token_store.Shard(data)
        assert [shard.document(i).tolist() for i in range(shard.docs)] == [ids.tolist() for _, _, ids in shard]
        with pytest.raises(ValueError):
            token_store.Shard(data[:-9] + bytes([data[-9] ^ 1]) + data[-8:])


def test_files_of_lost_attempts_are_not_read(spark, docs):
    folder = common.new_folder(spark, "ids-test")
    manifest = token_store.write_token_ids(docs(TEXTS), folder, TOKENIZER, 1)
    files.write_file(folder, "ids-000000-00000-9-9-9.efi", [b"left behind"])
    schema = common.schema_of(("doc_id", token_store.T.LongType()))
    assert token_store.read_token_ids(manifest, folder, lambda k, s, ids: (k,), schema).count() == len(TEXTS)
    assert not glob.glob(f"{folder.removeprefix('file://')}/*.tmp")


def test_reading_selects_boundaries(monkeypatch):
    """No sequence is unpacked whole to read the documents of a shard."""
    sizes = np.random.default_rng(3).integers(0, 400, 5_000)
    keys = np.cumsum(np.random.default_rng(4).integers(0, 99, 4_990)).tolist()
    ids = [np.arange(n, dtype="<u2").tobytes() for n in sizes]
    parts = token_store.dump_shard([None] * 10 + keys, np.cumsum(sizes).tolist(), ids, 2)
    monkeypatch.delattr(token_store.EliasFano, "values")
    shard = token_store.Shard(b"".join(parts))
    got = list(shard)
    assert [k for k, *_ in got] == [None] * 10 + keys
    assert [x.tobytes() for *_, x in got] == ids and [s for _, s, _ in got] == (np.cumsum(sizes) - sizes).tolist()


def test_other_tokenizers_are_refused(tmp_path):
    described = json.loads(Path(TOKENIZER).read_text())
    described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\p{N}+|\p{L}+"
    (tmp_path / "t.json").write_text(json.dumps(described))
    with pytest.raises(ValueError, match="other words"):
        token_store.require_lower_case(str(tmp_path / "t.json"))
    token_store.require_lower_case(TOKENIZER)


def test_no_documents(spark, docs):
    folder = common.new_folder(spark, "ids-test")
    manifest = token_store.write_token_ids(docs([]), folder, TOKENIZER, 1)
    schema = common.schema_of(("doc_id", token_store.T.LongType()))
    assert token_store.read_token_ids(manifest, folder, lambda k, s, ids: (k,), schema).count() == 0
