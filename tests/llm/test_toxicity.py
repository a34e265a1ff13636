from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from cartmill.llm import toxicity

SMALL = toxicity.NetworkShape(window=5, stride=3, hidden=3, word_size=2, gram_size=3, bits=6)


def test_gradients_equal_differences():
    network = toxicity.Network.fresh(SMALL)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(0)
    forward, backward = rng.standard_normal((2, 7, 9))
    windows = rng.integers(0, 7, (4, 5))
    windows[1, 3:] = windows[2, 1:] = -1
    y = np.array([1, 0, 1, 0.0])

    def loss():
        logits = network.logits(forward, backward, windows, {})
        return np.sum(np.log1p(np.exp(logits)) - y * logits)

    keep = {}
    logits = network.logits(forward, backward, windows, keep)
    found = network.gradients(windows, keep, toxicity._sigmoid(logits) - y)

    def difference(array, at, e=1e-5):
        old = array[at]
        array[at] = old + e
        up = loss()
        array[at] = old - e
        down = loss()
        array[at] = old
        return (up - down) / (2 * e)

    for name in ("out", "out_bias", "att", "att_out", "att_bias", "rec_f", "rec_b"):
        for at in np.ndindex(network.weights[name].shape):
            assert difference(network.weights[name], at) == pytest.approx(found[name][at], abs=1e-4)
    for inputs, g in ((forward, found["x_f"]), (backward, found["x_b"])):
        total = np.zeros_like(inputs)
        np.add.at(total, np.maximum(windows.T, 0)[windows.T >= 0], g[windows.T >= 0])
        for at in np.ndindex(inputs.shape):
            assert difference(inputs, at) == pytest.approx(total[at], abs=1e-4)


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 8, 100])
def test_windows_cover_all_words(n):
    starts = toxicity.window_starts(n, SMALL)
    covered = {i for s in starts for i in range(s, min(n, s + SMALL.window))}
    assert covered == set(range(n)) and all(b - a <= SMALL.stride for a, b in zip(starts, starts[1:], strict=False))


def texts(rng, n, toxic):
    vowels = "aeiou"
    out = []
    for _ in range(n):
        words = ["".join(rng.choice("bcdfglmnprst") + rng.choice(vowels) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["kwyx", "zyxq"]) + rng.choice(["en", "or", "", "ly", "ness"]) + rng.choice(["", ",", "!"]))
        out.append(" ".join(words))
    return out


def test_accuracy_on_held_out_labels(spark, docs):
    rng = random.Random(4)
    rows = [(i, t, i % 2) for i, t in enumerate(x for pair in zip(texts(rng, 200, False), texts(rng, 200, True), strict=True) for x in pair)]
    frame = docs([(i, t) for i, t, _ in rows] + [(None, "w"), (1000, None), (1001, ""), (1002, "..., !"), (0, rows[0][1])])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (5, None, 1), (5, 1, 1)], "doc_id long, toxic int, text int")
    chosen, _ = toxicity.labelled_sample(frame, labels, "doc_id", "text", "toxic", toxicity.NetworkShape())
    held = {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not held & set(chosen) and len(set(chosen)) == len(rows) - len(held)
    network = toxicity.fit(frame, labels)
    scored = toxicity.add_scores(frame, network)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scored.columns == [*frame.columns, "score"] and scored.count() == len(rows) + 5
    assert got[1000] == got[1001] == got[1002] == 0 and all(0 <= v <= 1 for v in got.values())
    right = [(got[i] >= 0.5) == bool(y) for i, t, y in rows if t in held]
    assert np.mean(right) > 0.9


def test_strongest_window_counts(spark):
    rng = random.Random(4)
    network = toxicity.train(texts(rng, 60, False) + texts(rng, 60, True), [0] * 60 + [1] * 60)
    scorer = toxicity.Scorer(network)
    clean = " ".join(texts(rng, 300, False))
    low, high, end = scorer.scores([clean, f"kwyxen zyxqor {clean}", f"{clean} kwyxen zyxqor"])
    assert high > low and end > low and len(clean.split()) > 5000
    assert scorer.scores([clean])[0] == pytest.approx(low, abs=1e-5)


def test_all_windows_are_scored():
    """The score is the largest of every run of words, and a passage scores the same behind any number of words."""
    rng = random.Random(6)
    network = toxicity.train(texts(rng, 60, False) + texts(rng, 60, True), [0] * 60 + [1] * 60)
    scorer, width = toxicity.Scorer(network), network.shape.window
    words = " ".join(texts(rng, 60, False) + texts(rng, 3, True)).split()
    runs = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    whole = [" ".join(words), "", " ".join(words[:width]), " ".join(words[: width + 1]), " ".join(words[:3])]
    each = scorer.scores(runs)
    got = scorer.scores(whole)
    assert got[0] == pytest.approx(each.max(), abs=1e-4) and got[1] == 0 and got[2] == pytest.approx(each[0], abs=1e-4)
    assert got[3] == pytest.approx(each[:2].max(), abs=1e-4)
    strongest = runs[int(each.argmax())]
    shifted = scorer.scores([" ".join([*words[:k], strongest, *words[:40]]) for k in range(18)])
    assert all(s >= each.max() - 1e-4 for s in shifted)


def test_sample_is_bounded(spark, docs):
    rows = [(i, f"text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    shape = toxicity.NetworkShape(sample_rows=7)
    assert len(toxicity.labelled_sample(docs(rows), labels, "doc_id", "text", "toxic", shape)[0]) == 14


def test_without_labels(spark, docs):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs([(1, "a")]), labels) is None
    assert toxicity.add_scores(docs([(1, "a")]), None).first()["score"] == 0
    assert toxicity.add_scores(docs([]), toxicity.train(["a", "b"], [0, 1])).count() == 0


def test_inputs_in_one_pass():
    """The inputs that scoring computes at once are those that training puts together."""
    shape = toxicity.NetworkShape()
    network, rng = toxicity.Network.fresh(shape, 3), np.random.default_rng(2)
    for name in ("word_odds", "gram_odds"):
        network.weights[name] = rng.normal(size=network.weights[name].shape).astype(np.float32)
    words = ["a", "", "bc", "überall", "x" * 500, *(f"word{i}" * (i % 4) for i in range(50))]
    w = network.weights
    want = np.concatenate((network.embeddings(words), toxicity._odds_features(w["word_odds"], w["gram_odds"], words, shape)), axis=1)
    assert np.abs(network.inputs(words) - want).max() < 1e-5


def test_very_long_text_through_spark(docs):
    """A toxic passage is found wherever it stands in a text of half a million words."""
    shape = toxicity.NetworkShape(window=6, hidden=4, epochs=4, sample_rows=50)
    texts = [f"you vile rotten fool number {i} go away" for i in range(40)] + [f"the calm sea number {i} lies still" for i in range(40)]
    network = toxicity.train(texts, [1] * 40 + [0] * 40, shape)
    calm = "the calm sea lies still " * 50_000
    rows = [(1, calm), (2, calm + "you vile rotten fool go away " + calm), (3, None)]
    scores = {r["doc_id"]: r["score"] for r in toxicity.add_scores(docs(rows), network).collect()}
    assert scores[1] < 0.5 < scores[2] and scores[3] == 0


def test_strongest_windows_are_found_by_few_full_ones(monkeypatch):
    """A rough pass leaves a part of the windows to be computed in full, and scores are those of all windows in full."""
    rng = random.Random(11)
    clean, toxic = texts(rng, 300, False), texts(rng, 300, True)
    network = toxicity.train(clean[:60] + toxic[:60], [0] * 60 + [1] * 60)
    joined = [" ".join(clean[i : i + 9] + toxic[i : i + i % 3]) for i in range(60, 290, 9)]
    computed = []
    full = toxicity.Network.logits_at

    def counted(self, forward, backward, ids, starts, step=2048):
        computed.append(len(starts))
        return full(self, forward, backward, ids, starts, step)

    monkeypatch.setattr(toxicity.Network, "logits_at", counted)
    got = toxicity.Scorer(network).scores(joined + clean + toxic)
    few, computed[:] = sum(computed), []
    monkeypatch.setattr(toxicity.Network, "has_rough", lambda self: False)
    want = toxicity.Scorer(network).scores(joined + clean + toxic)
    assert np.abs(got - want).max() < 1e-5
    assert few < sum(computed) / 2


def test_rough_windows():
    """Rough numbers lie near the full ones, also for inputs that saturate the gates; other weights have none."""
    rng = np.random.default_rng(5)
    network = toxicity.Network.fresh(toxicity.NetworkShape())
    forward, backward = (rng.normal(size=(500, 24)).astype(np.float32) for _ in range(2))
    forward[7], backward[8] = 1e4, -1e4
    ids = rng.integers(0, 500, 9000)
    want = network.logits_at(forward, backward, ids, np.arange(len(ids) - 23))
    got = network.rough_logits(forward, backward, ids, 12)
    assert network.has_rough() and np.abs(got - want).max() < 0.1
    windows = ids[np.arange(100)[:, None] + np.arange(24)]
    assert np.abs(network.logits(forward, backward, windows) - want[:100]).max() < 1e-4
    network.weights["rec_f"] = network.weights["rec_f"] * 1000
    assert not network.has_rough()


def slow_and_fast():
    """A network whose first unit answers to "aa" at once and whose second fills up over a whole window of "bb"."""
    network = toxicity.Network.fresh(toxicity.NetworkShape())
    w = {name: np.zeros_like(value) for name, value in network.weights.items()}
    w["word"][toxicity._word_buckets(["aa", "bb"], network.shape.bits), [0, 1]] = 1
    w["bias_f"][:2] = -8, np.log(9)
    w["in_f"][0, 16] = w["in_f"][1, 17] = 5
    w["out"][:2], w["out_bias"][0] = (6.1, 10), -6.3
    network.weights = w
    return network


def in_full(network, text):
    """The score by ``logits`` of every window, one after the other."""
    scorer = toxicity.Scorer(network)
    windows, _ = toxicity._windows(scorer.numbered([text]), network.shape)
    return 1 / (1 + np.exp(-max(float(scorer.window_logits(row[None])[0]) for row in windows)))


def test_window_that_looks_weak_from_a_few_words(docs):
    """Every window is computed over all its words: the strongest here is not so by any ten words of it."""
    network, text = slow_and_fast(), "aa " * 60 + "bb " * 30
    score = toxicity.add_scores(docs([(1, text)]), network).first()["score"]
    assert score == pytest.approx(in_full(network, text), abs=1e-4) and score > 0.5
    assert toxicity.Scorer(network).scores([text])[0] < 0.5


def test_sliding_windows():
    """All windows side by side are those computed one by one, over several steps and between texts of any length."""
    rng = random.Random(3)
    network = toxicity.train(texts(rng, 60, False) + texts(rng, 60, True), [0] * 60 + [1] * 60)
    some = [*texts(rng, 40, True), *(" ".join(f"w{j % 7}" for j in range(n)) for n in (0, 1, 23, 24, 25, 26, 47, 300))]
    got = toxicity.EveryWindow(network).scores(some)
    assert np.abs(got - [in_full(network, text) if text else 0 for text in some]).max() < 1e-5
    forward, backward = np.random.default_rng(5).normal(size=(2, 50, 24)).astype(np.float32) * 3
    ids = np.random.default_rng(6).integers(0, 50, 200)
    want = network.logits(forward, backward, ids[np.arange(177)[:, None] + np.arange(24)])
    for step in (1, 50, 177, 500):
        assert np.abs(network.sliding_logits(forward, backward, ids, step) - want).max() < 1e-5


def test_units_met_again_are_kept():
    """A full memory keeps what texts have in common; scores are those of a scorer that remembers all."""
    rng = random.Random(8)
    network = toxicity.train(texts(rng, 60, False) + texts(rng, 60, True), [0] * 60 + [1] * 60)
    batches = [[f"{x} ... often seen {at}" for x in texts(rng, 20, at % 2)] for at in range(30)]
    small, large = toxicity.EveryWindow(network), toxicity.EveryWindow(network)
    small.MOST_UNITS = 2000
    for batch in batches:
        assert np.abs(small.scores(batch) - large.scores(batch)).max() < 1e-5
        assert len(small.forward) >= len(small.words) and small.word_of.max() == len(small.words) - 1
        assert len(small.word_of) == len(small.again) == len(small.units)
    assert {"often", "seen", "..."} <= set(small.units) and len(small.units) < len(large.units)
    small.MOST_WORDS = 1
    assert np.abs(small.scores(batches[0]) - large.scores(batches[0])).max() < 1e-5


def test_pipeline_drops_by_every_window(spark, docs, tmp_path, monkeypatch):
    """The first stage drops a text for a window that looks weak from a few of its words."""
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(corpus_pipeline.toxicity, "fit", lambda docs, labels: slow_and_fast())
    rows = [(1, "aa " * 60 + "bb " * 30), (2, "aa " * 90), (3, "cc " * 90), (4, None)]
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs(rows), str(tmp_path)).collect()) == [2, 3, 4]
