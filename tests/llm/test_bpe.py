from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from cartmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None,
    "",
    " ",
    "\n\n x",
    "Hello  world,\tit's Ünïcode 12345!! \x1c\xa0 　done ",
    "plain words on\ntwo lines",
    "日本語のテキスト😀 emoji",
    "a" * 700 + " " + "thththththionerblestandofthe" * 40,
    "Donaudampfschifffahrtsgesellschaftskapitän 'tis we'll",
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_equals_the_library(spark, docs, library, most):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[4]), (4, TEXTS[4])]
    got = bpe.encode_documents(docs(rows), PATH, public_tokenizers.PATTERN, most=most).collect()
    assert [(r["doc_id"], r["ids"]) for r in got] == [(i, library.encode_ordinary(t or "")) for i, t in rows]


def test_decoding_returns_the_bytes(docs):
    got = bpe.encode_documents(
        docs(list(enumerate(TEXTS))),
        PATH,
        public_tokenizers.PATTERN,
        finish=lambda ids, pieces: (pieces.decode(ids),),
        fields=[bpe.T.StructField("decoded", bpe.T.BinaryType())],
    ).collect()
    assert [bytes(r["decoded"]).decode() for r in got] == [t or "" for t in TEXTS]


def test_fold_equals_the_heap(spark, ranks):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeéßñthion ", k=rng.randint(1, 40))).encode()[: bpe.LONG_BYTES] for _ in range(300)]
    words += [b"a", b"\xff\x00", b"x" * bpe.LONG_BYTES]
    table = bpe.RankTable(ranks)
    frame = spark.createDataFrame([([w.decode("latin-1") for w in words],)], "words array<string>")
    ids = frame.select(table.fold(bpe.F.col("words"))).first()[0]
    for word, packed in zip(words, ids, strict=True):
        found = [int.from_bytes(packed[i : i + 2], "big") for i in range(0, len(packed), 2)]
        if word not in ranks:
            assert found == bpe.merge_long(ranks, word), word


def test_long_word_in_little_time(library, ranks):
    word = "".join(random.Random(1).choices("abcdefgh", k=50_000))
    assert bpe.merge_long(ranks, word.encode()) == library.encode_ordinary(word)


def test_units_hold_whole_matches():
    split, fast = bpe._word_pattern(public_tokenizers.PATTERN).findall, bpe._splitter(public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices("ab1 .\n\t\x1c\xa0'sé", k=rng.randint(0, 20)))
        lines, units = bpe.units_of(text)
        if units is None:
            units = []
            for line in lines:
                head, *tail = line.split(" ")
                units += ["\n", head, *[f" {t}" for t in tail]]
            units = units[1:]
        assert [w for u in units for w in split(u)] == split(text), repr(text)
        assert [w for u in units for w in (fast(" ", u[1:]) if u[:1] == " " and u[1:] else fast("", u) if u else [])] == split(text)


def test_empty_table(docs):
    assert bpe.encode_documents(docs([]), PATH, public_tokenizers.PATTERN).count() == 0


def _worker(ranks, found):
    """A worker's words, with a dictionary of the words given."""
    hashes, packed = bpe._hashes(found), [b"".join(r.to_bytes(2, "big") for r in bpe.merge_long(ranks, w)) for w in found]
    rows = pa.table({"hash": hashes, "ids": pa.array(packed, type=pa.binary())})
    known = bpe.Dictionary.of([rows], {token: rank.to_bytes(2, "big") for token, rank in ranks.items()})
    return bpe._Words(ranks, known, public_tokenizers.PATTERN, 2, bpe.Pieces(ranks))


def _whole(ids, lacking, ranks):
    rest = [b"".join(r.to_bytes(4, "little") for r in bpe.merge_long(ranks, w)) for w in lacking]
    return [bpe.as_list(bpe._unmarked(i, rest)) for i in ids.to_pylist()]


def test_units_of_arrays_are_those_of_texts():
    rng = random.Random(4)
    spaces = "".join(chr(c) for c in range(0x3001) if bpe.regex.match(f"[{bpe._SPACE}]", chr(c)))
    texts = ["".join(rng.choices("ab1.'é日×" + spaces + "\x1c\u200b\u2010" + " " * 20, k=rng.randint(0, 12))) for _ in range(3000)]
    data, offsets = bpe._flat(pa.array(texts))
    bounds = [*bpe.unit_starts(data, offsets).tolist(), len(data)]
    got = [data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
    assert got == [u for t in texts for u in bpe._UNIT.findall(t)]


def test_each_distinct_unit_is_looked_up_once(ranks, library, monkeypatch):
    texts = pa.array(["Wörtlich wörtlich wörtlich, 12 ×x wörtlich."] * 50 + [None, "", " ", "qzxkjv qzxkjv.", *TEXTS])
    words, asked = _worker(ranks, [" wörtlich".encode()]), []
    find = words.known.find
    monkeypatch.setattr(words.known, "find", lambda w, *rest: asked.append(w) or find(w, *rest))
    ids, lacking = words.encode(texts[3:])  # a part of an array
    assert len(asked) == 1 and asked[0].count(" wörtlich".encode()) == 3  # alone, with a comma, with a point
    assert b"qzxkjv" in lacking and " wörtlich".encode() not in lacking
    assert _whole(ids, lacking, ranks) == [library.encode_ordinary(t or "") for t in texts[3:].to_pylist()]


def test_words_of_equal_hash_are_told_apart(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "_hashes", lambda words: bpe.np.array([len(w) for w in words], dtype=bpe.np.int64))
    words = _worker(ranks, [b"qzxkjvqzxkjv", b"vjkxzqvjkxzq"])
    texts = ["qzxkjvqzxkjv vjkxzqvjkxzq", "the vjkxzqvjkxz thing"]
    assert _whole(*words.encode(pa.array(texts)), ranks) == [library.encode_ordinary(t) for t in texts]
