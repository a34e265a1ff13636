"""Tables whose columns have the names that operators might use for their own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartmill.llm import bpe, collocations, decontamination, pii, posting, repetition, runs, simhash, substrings, toxicity

NAMES = (
    "_row _key _terms _hits _score score _text fp _chosen _chosen_id _ids _added_key text_key base node root least first "
    "lists id key vec phrase f runs n_words spans HITS Fingerprint _label"
).split()
TEXTS = [
    (1, "Write to ann@example.org or call +44 20 7946 0958, please. " + "A calm text about the sea and its shore. " * 3),
    (2, "Another text that speaks of hills, valleys and the wide plain behind them, " * 4),
    (3, None),
    (4, ""),
    (4, "one two three four five six seven eight nine ten eleven"),
]


@pytest.fixture
def table(spark):
    """Every odd column has text, every even one numbers, each its own."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    extra = {n: F.concat(F.lit(f"{n}-"), "doc_id") if i % 2 else F.col("doc_id") * 100 + i for i, n in enumerate(NAMES)}
    return docs.withColumns({n: c for n, c in extra.items() if n.lower() not in {x.lower() for x in docs.columns}})


@pytest.fixture
def items(spark):
    return spark.createDataFrame([("i1", "two three four five six seven eight nine ten eleven")], "item_id string, text string")


def unchanged(got, table):
    """All columns as before; the clashing ones have the values of their row."""
    assert got.columns == table.columns
    for row in got.collect():
        for i, n in enumerate(NAMES):
            assert row[n] == (f"{n}-{row['doc_id']}" if i % 2 else row["doc_id"] * 100 + i), n
    return sorted(r["doc_id"] for r in got.select("doc_id").collect())


def test_rows_that_stay(table, items):
    assert unchanged(simhash.keep_one(table, shingle=3, max_bits=2), table) == [1, 2, 3, 4]
    assert unchanged(decontamination.drop_contaminated(table, items), table) == [1, 2, 3, 4]
    assert unchanged(decontamination.remove_contamination(table, items), table) == [1, 2, 3, 4, 4]
    cleaned = pii.sanitise(table)
    assert unchanged(cleaned, table) == [1, 2, 3, 4, 4]
    assert "<EMAIL>" in cleaned.filter("doc_id = 1").first()["text"]


def test_scores(table):
    shape = toxicity.NetworkShape(window=4, hidden=2, epochs=1)
    network = toxicity.train(["bad bad words here", "good and calm words"], [1, 0], shape)
    for n in (None, network):
        scored = toxicity.add_scores(table, n, score="_new")
        assert unchanged(scored.drop("_new"), table) and 0 <= scored.first()["_new"] <= 1
        # a column of the same name gives way
        replaced = toxicity.add_scores(table, n)
        assert replaced.columns == [c for c in table.columns if c != "score"] + ["score"]
        assert all(0 <= r["score"] <= 1 for r in replaced.collect())


def test_stages(spark, table, tmp_path):
    docs = table
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "no text of any document is this")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert unchanged(docs, table) == ([1, 2, 3, 4, 4] if name == "toxicity" else [1, 2, 3, 4]), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids", "text"]


def test_other_operators_read_their_columns_only(spark, table, items):
    assert decontamination.contamination(table, items).count() == 5
    assert pii.personal_data(table).count() == 5
    assert repetition.repetition_quality(table).count() == 5
    assert runs.periodic_runs(table).count() == 5
    assert substrings.remove_repeats(table).count() == 5
    assert simhash.near_duplicates(table).count() == 5
    assert collocations.collocations(table, collocations.Limits(3, 2)).count() == 3
    vectors = spark.createDataFrame([(0, [1.0, 0.0], 7, "x", 5), (1, [0.5, 0.5], 8, "y", 6)], "vec_id long, embedding array<float>, id int, vec string, lists int")
    assert posting.nearest(vectors, F.col("id") % 20 == 0, 3).count() == 1


def test_encoding_keeps_columns(table):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.encode_documents(table, ranks, public_tokenizers.PATTERN)
    assert got.columns == [*table.columns, "ids"]
    assert unchanged(got.drop("ids"), table) == [1, 2, 3, 4, 4]
