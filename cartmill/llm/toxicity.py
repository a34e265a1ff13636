"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

The operator computes every window of every text in full (``EveryWindow``). A search that computes all windows roughly and
in full only those that may be the strongest (``Scorer._strongest``) is kept for comparison; no query uses it.

A word enters as the embedding of its hashed form next to the mean embedding of its hashed character n-grams, so that
unseen forms of a known stem still speak, and with the log odds that form and n-grams have in the labelled sample. Both directions run over windows of ``window`` words, attention pools the
states of a window, and a text scores as its strongest window; every run of ``window`` words is one (``stride`` 1), so
a passage scores the same wherever it stands. Texts are scored whole.

Labels say that a text is toxic, not where. Training therefore takes, in every epoch, the window of each text that the
network finds most toxic and fits those. A sampled text meets the log odds that the other folds of the sample give, as
an unseen text would, so the network cannot learn it by heart. The sample is bounded by ``sample_rows`` for each label and ``sample_chars`` for each text, whatever the input's size.

Defined results: a text without words scores 0; so does every text if the sample lacks one of the labels; a null id is
never in the sample; rows with equal texts score alike; labels given twice count as toxic if either does.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common


@dataclass(frozen=True)
class NetworkShape:
    window: int = 24
    stride: int = 1
    hidden: int = 8
    word_size: int = 4
    gram_size: int = 8
    grams: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 14  # of the hashed vocabularies
    folds: int = 5
    balance: float = 0.5  # 0 keeps the sample's odds, 1 makes both labels weigh the same
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    embedding_rate: float = 0.05  # of that of the other weights
    sample_rows: int = 600
    sample_chars: int = 10_000


_STRIP = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¡¿«»“”„‘’…–—"


def _word(unit: str) -> str:
    word = unit.lower()
    return word if word.isalpha() else word.strip(_STRIP)


def _word_buckets(words: list[str], bits: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.int64, count=len(words)) >> (32 - bits)


def _gram_buckets(words: list[str], sizes: Iterable[int], bits: int):
    """For each n-gram length: buckets of all n-grams of the words, in order, and the bounds of each word's."""
    coded = [b"<" + w.encode() + b">" for w in words]
    data = np.frombuffer(b"".join(coded), dtype=np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    ends = np.cumsum(lengths)
    with np.errstate(over="ignore"):
        for n in sizes:
            counts = np.maximum(lengths - n + 1, 0)
            bounds = np.concatenate(([0], np.cumsum(counts)))
            at = np.arange(bounds[-1]) + np.repeat(ends - lengths - bounds[:-1], counts)
            h = np.full(len(at), n, dtype=np.uint32)
            for j in range(n):
                h = (h ^ data[at + j]) * np.uint32(0x01000193) + (h >> np.uint32(15))
            yield ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64), bounds


def _in_parts(run, words: list[str], step: int = 1 << 13) -> np.ndarray:
    """Rows for words, computed for so many at a time."""
    return np.concatenate([run(words[at : at + step]) for at in range(0, max(len(words), 1), step)])


def _gram_means(table: np.ndarray, words: list[str], shape: NetworkShape) -> np.ndarray:
    """Mean of the n-grams' rows of the table for each word."""
    total, count = np.zeros((len(words), table.shape[1])), np.zeros(len(words))
    for buckets, bounds in _gram_buckets(words, shape.grams, shape.bits):
        sums = np.concatenate((np.zeros((1, table.shape[1])), np.cumsum(table[buckets], axis=0, dtype=np.float64)))
        total += sums[bounds[1:]] - sums[bounds[:-1]]
        count += np.diff(bounds)
    return (total / np.maximum(count, 1)[:, None]).astype(np.float32)


def _odds_features(word_odds: np.ndarray, gram_odds: np.ndarray, words: list[str], shape: NetworkShape) -> np.ndarray:
    """Odds of each word, and the mean and the largest odds of its n-grams."""
    n, most = len(words), np.full(len(words), -np.inf, dtype=np.float32)
    for buckets, bounds in _gram_buckets(words, shape.grams, shape.bits):
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            most[some] = np.maximum(most[some], np.maximum.reduceat(gram_odds[buckets], bounds[some]))
    out = np.empty((n, 3), dtype=np.float32)
    out[:, 0] = word_odds[_word_buckets(words, shape.bits)]
    out[:, 1] = _gram_means(gram_odds[:, None], words, shape)[:, 0]
    out[:, 2] = np.where(np.isfinite(most), most, 0)
    return out


def _described(w: dict[str, np.ndarray], words: list[str], shape: NetworkShape) -> np.ndarray:
    """Inputs of words in one pass over their n-grams: embeddings, odds of the word, mean and largest odds of n-grams."""
    coded = [x.encode() for x in words]
    word_of = np.fromiter(map(zlib.crc32, coded), dtype=np.int64, count=len(coded)) >> (32 - shape.bits)
    data = np.frombuffer(b"<" + b"><".join(coded) + b">", dtype=np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) + 2
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))  # bytes from here to the word's end
    table = np.column_stack((w["gram"], w["gram_odds"]))
    size = table.shape[1]
    sums, count = np.zeros((len(words), size), dtype=np.float32), np.zeros(len(words), dtype=np.int64)
    most = np.full(len(words), -np.inf, dtype=np.float32)
    with np.errstate(over="ignore"):
        for n in shape.grams:
            counts = np.maximum(lengths - n + 1, 0)
            some = np.flatnonzero(counts)
            if not len(some):
                continue
            total = len(data) - n + 1
            h = np.full(total, n, dtype=np.uint32)
            for j in range(n):
                h = (h ^ data[j : j + total]) * np.uint32(0x01000193) + (h >> np.uint32(15))
            h = h[left[:total] >= n]
            rows = table.take((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - shape.bits), axis=0)
            starts = (np.cumsum(counts) - counts)[some]
            sums[some] += np.add.reduceat(rows, starts, axis=0)
            most[some] = np.maximum(most[some], np.maximum.reduceat(rows[:, -1], starts))
            count += counts
    sums /= np.maximum(count, 1)[:, None]
    most = np.where(np.isfinite(most), most, np.float32(0))
    return np.column_stack((w["word"][word_of], sums[:, :-1], w["word_odds"][word_of], sums[:, -1], most))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(x, recurrent, mask, keep=None):
    """States of a gated recurrent layer over inputs (time, batch, 3 hidden); ``keep`` collects what backward needs."""
    steps, batch, width = x.shape
    size = width // 3
    h = np.zeros((batch, size), dtype=x.dtype)
    states = np.empty((steps, batch, size), dtype=x.dtype)
    for t in range(steps):
        hu = h @ recurrent
        gates = _sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        new = n + z * (h - n)
        if mask is not None:
            new *= mask[t][:, None]
        if keep is not None:
            keep.append((h, z, r, n, hu[:, 2 * size :]))
        states[t] = h = new
    return states


def _slide(x: np.ndarray, recurrent: np.ndarray, order: Iterable[int], starts: np.ndarray, states: np.ndarray) -> None:
    """States of a gated recurrent layer in windows that begin at ``starts``; states are (time, hidden, windows)."""
    _, size, many = states.shape
    x, turned = np.ascontiguousarray(x.T), np.ascontiguousarray(recurrent.T)
    h = np.zeros((size, many), dtype=x.dtype)
    for t in order:
        hu = turned @ h
        own = x.take(starts + t, axis=1)
        gates = own[: 2 * size] + hu[: 2 * size]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        n = hu[2 * size :]
        n *= gates[size:]
        n += own[2 * size :]
        np.tanh(n, out=n)
        h -= n
        h *= gates[:size]
        h += n
        states[t] = h


# A float's bits, read as a whole number, grow with its logarithm: so exp(y) is about the number _EXP * y + _ONE read as bits
_EXP, _ONE = np.float32((1 << 23) / np.log(2)), np.float32((127 << 23) - 361_000)
_MOST_EXP = 80.0  # beyond this the bits are no float


def _one_and_exp(scaled: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """1 + exp(y) within some 3 % of exp(y), for ``_EXP * y + _ONE``; ``bits`` is room for it."""
    np.copyto(bits, scaled, casting="unsafe")
    found = bits.view(np.float32)
    found += 1
    return found


def _rough_states(x: np.ndarray, recurrent: np.ndarray, context: int, back: bool) -> Iterable[np.ndarray]:
    """States of a gated recurrent layer after each run of 1, 2, ... ``context`` words, by the run's first word.

    ``x`` (3 hidden, words) and ``recurrent`` (3 hidden, hidden) are scaled for ``_one_and_exp``.
    """
    size, words = recurrent.shape[1], x.shape[1]
    # the first word's states come from its input alone
    gates = _one_and_exp(x[:size], np.empty((size, words), dtype=np.int32))
    h = np.divide(2, _one_and_exp(x[2 * size :], np.empty((size, words), dtype=np.int32)))
    h -= 1
    h -= h / gates
    yield h
    hu = np.empty((3 * size, words), dtype=np.float32)
    bits = np.empty((3 * size, words), dtype=np.int32)
    for length in range(2, context + 1):
        many = words - length + 1
        before = h[:, 1:] if back else h[:, :many]
        own = x[:, :many] if back else x[:, length - 1 :]
        part, room = hu[:, :many], bits[:, :many]
        np.matmul(recurrent, before, out=part)
        gates, n = part[: 2 * size], part[2 * size :]
        gates += own[: 2 * size]
        gates = _one_and_exp(gates, room[: 2 * size])  # a gate is 1 / this
        n /= gates[size:]
        n += own[2 * size :]
        np.divide(2, _one_and_exp(n, room[2 * size :]), out=n)
        n -= 1
        h = before - n
        h /= gates[:size]
        h += n
        yield h


def _run_back(grad, kept, recurrent, mask):
    """Gradients of inputs and recurrent weights from those of the states."""
    steps, batch, size = grad.shape
    gx, gu = np.empty((steps, batch, 3 * size), dtype=grad.dtype), np.zeros_like(recurrent)
    carry = np.zeros((batch, size), dtype=grad.dtype)
    for t in reversed(range(steps)):
        h, z, r, n, un = kept[t]
        g = (grad[t] + carry) * mask[t][:, None]
        gn = g * (1 - z) * (1 - n * n)
        gz = g * (h - n) * z * (1 - z)
        gr = gn * un * r * (1 - r)
        gx[t] = np.concatenate((gz, gr, gn), axis=1)
        through = np.concatenate((gz, gr, gn * r), axis=1)
        gu += h.T @ through
        carry = g * z + through @ recurrent.T
    return gx, gu


@dataclass
class Network:
    """Weights by name, and what they compute."""

    shape: NetworkShape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, shape: NetworkShape, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        size, inputs, hidden = 1 << shape.bits, shape.word_size + shape.gram_size + 3, shape.hidden

        def values(*dims, scale):
            return (rng.standard_normal(dims) * scale).astype(np.float32)

        weights = {"word": values(size, shape.word_size, scale=0.1), "gram": values(size, shape.gram_size, scale=0.1)}
        weights |= {name: np.zeros(size, dtype=np.float32) for name in ("word_odds", "gram_odds")}
        for side in "fb":
            weights[f"in_{side}"] = values(inputs, 3 * hidden, scale=0.3)
            weights[f"bias_{side}"] = np.zeros(3 * hidden, dtype=np.float32)
            weights[f"rec_{side}"] = values(hidden, 3 * hidden, scale=0.3)
        weights["att"] = values(2 * hidden, hidden, scale=0.3)
        weights["att_bias"] = np.zeros(hidden, dtype=np.float32)
        weights["att_out"] = values(hidden, scale=0.3)
        weights["out"] = values(2 * hidden, scale=0.3)
        weights["out_bias"] = np.zeros(1, dtype=np.float32)
        return cls(shape, weights)

    def embeddings(self, words: list[str]) -> np.ndarray:
        w = self.weights
        known = w["word"][_word_buckets(words, self.shape.bits)]
        return np.concatenate((known, _in_parts(lambda part: _gram_means(w["gram"], part, self.shape), words)), axis=1)

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vectors of words."""
        return _in_parts(lambda part: _described(self.weights, part, self.shape), words)

    def projections(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the input vectors add to the gates of both directions; a word needs it once."""
        w = self.weights
        return inputs @ w["in_f"] + w["bias_f"], inputs @ w["in_b"] + w["bias_b"]

    def logits(self, forward: np.ndarray, backward: np.ndarray, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """One number for each window; windows (batch, time) index the projections, -1 being no word."""
        w, places = self.weights, windows.T
        full = keep is None and bool((windows[:, -1] >= 0).all())
        mask = None if full else (places >= 0).astype(np.float32)
        at = places if full else np.maximum(places, 0)
        kept_f, kept_b = ([], []) if keep is not None else (None, None)
        ahead = _run(forward[at], w["rec_f"], mask, kept_f)
        back = _run(backward[at[::-1]], w["rec_b"], None if mask is None else mask[::-1], kept_b)[::-1]
        states = np.concatenate((ahead, back), axis=2)
        hidden = np.tanh(states @ w["att"] + w["att_bias"])
        scores = hidden @ w["att_out"]
        if mask is not None:
            scores = np.where(mask > 0, scores, np.float32(-1e9))
        share = np.exp(scores - scores.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", share, states)
        if keep is not None:
            keep.update(mask=mask, kept_f=kept_f, kept_b=kept_b, states=states, hidden=hidden, share=share, pooled=pooled)
        return pooled @ w["out"] + w["out_bias"][0]

    def logits_at(self, forward: np.ndarray, backward: np.ndarray, ids: np.ndarray, starts: np.ndarray, step: int = 2048) -> np.ndarray:
        """``logits`` of windows of consecutive words that begin at ``starts``; they lie side by side."""
        w, size, width = self.weights, self.shape.hidden, self.shape.window
        out = np.empty(len(starts), dtype=np.float32)
        att, att_bias = np.ascontiguousarray(w["att"].T), w["att_bias"][:, None]
        states = np.empty((width, 2 * size, min(step, len(out))), dtype=np.float32)
        for at in range(0, len(out), step):
            some = starts[at : at + step]
            low = some.min()
            inside = np.zeros(some.max() - low + width, dtype=bool)
            for j in range(width):
                inside[some - low + j] = True
            part, first = np.flatnonzero(inside) + low, (np.cumsum(inside) - 1)[some - low]
            own = states[:, :, : len(some)]
            _slide(forward[ids[part]], w["rec_f"], range(width), first, own[:, :size])
            _slide(backward[ids[part]], w["rec_b"], range(width - 1, -1, -1), first, own[:, size:])
            hidden = np.matmul(att, own)
            hidden += att_bias
            np.tanh(hidden, out=hidden)
            scores = np.matmul(w["att_out"], hidden)
            share = np.exp(scores - scores.max(axis=0))
            share /= share.sum(axis=0)
            out[at : at + step] = (share * np.matmul(w["out"], own)).sum(axis=0)
        return out + w["out_bias"][0]

    def sliding_logits(self, forward: np.ndarray, backward: np.ndarray, ids: np.ndarray, step: int = 2000) -> np.ndarray:
        """``logits`` of all windows of consecutive words; windows lie side by side, so a step reads one slice for all.

        Rows of 2,000 numbers do not fall on the same few lines of the cache, as those of 2,048 would.
        """
        w, size, width = self.weights, self.shape.hidden, self.shape.window
        # sigmoid(x) is half of 1 + tanh(x / 2): gates enter halved, and so does what the reset gate multiplies
        half = np.repeat(np.float32([0.5, 1]), (2 * size, size))[:, None]
        sides = [
            (forward, np.ascontiguousarray(w["rec_f"].T * np.float32(0.5)), range(width), slice(0, size)),
            (backward, np.ascontiguousarray(w["rec_b"].T * np.float32(0.5)), range(width - 1, -1, -1), slice(size, 2 * size)),
        ]
        att, att_bias = np.ascontiguousarray(w["att"].T), w["att_bias"][:, None]
        out = np.empty(len(ids) - width + 1, dtype=np.float32)
        most = min(step, len(out))
        room, added = np.empty((width, 2 * size, most), dtype=np.float32), np.empty((3 * size, most), dtype=np.float32)
        for at in range(0, len(out), step):
            many = min(step, len(out) - at)
            part, states, hu = ids[at : at + many + width - 1], room[:, :, :many], added[:, :many]
            for rows, recurrent, order, mine in sides:
                x = np.multiply(rows.take(part, axis=0).T, half, order="C")
                h = np.zeros((size, many), dtype=np.float32)
                hu[:] = 0
                for t in order:
                    if t != order[0]:
                        np.matmul(recurrent, h, out=hu)
                    gates, n, new = hu[: 2 * size], hu[2 * size :], states[t, mine]
                    gates += x[: 2 * size, t : t + many]
                    np.tanh(gates, out=gates)
                    gates += 1
                    n *= gates[size:]
                    n += x[2 * size :, t : t + many]
                    np.tanh(n, out=n)
                    z = gates[:size]
                    z *= 0.5
                    np.subtract(h, n, out=new)
                    new *= z
                    new += n
                    h = new
            hidden = np.matmul(att, states)
            hidden += att_bias
            np.tanh(hidden, out=hidden)
            share = np.matmul(w["att_out"], hidden)
            share -= share.max(axis=0)
            np.exp(share, out=share)
            value = np.matmul(w["out"], states)
            value *= share
            out[at : at + many] = value.sum(axis=0) / share.sum(axis=0)
        return out + w["out_bias"][0]

    def _rough_scales(self) -> tuple[np.ndarray, float]:
        """What scales the gates for ``_one_and_exp``, and how large an input may be for the sums to stay in its range."""
        size = self.shape.hidden
        most = max(float(np.abs(self.weights[f"rec_{side}"]).sum(axis=0).max()) for side in "fb")
        return -_EXP * np.repeat(np.float32([1, 2]), (2 * size, size)), _MOST_EXP / 2 - most

    def has_rough(self) -> bool:
        """Whether ``rough_logits`` can be computed with these weights; any training of normal length gives such."""
        w = self.weights
        attention = max(np.abs(w["att"]).sum(axis=0).max() + np.abs(w["att_bias"]).max(), np.abs(w["att_out"]).sum())
        return self._rough_scales()[1] > 20 and attention < _MOST_EXP / 2 and self.shape.window >= 4

    def rough_logits(self, forward: np.ndarray, backward: np.ndarray, ids: np.ndarray, context: int = 10, step: int = 8192) -> np.ndarray:
        """About ``logits`` of all windows of consecutive words, at a fraction of the cost.

        A state comes from the last ``context`` words of the window up to it, so neighbouring windows share most of
        theirs, and the exponential function is read off a float's bits.
        """
        w, size, width = self.weights, self.shape.hidden, self.shape.window
        context = min(context, width // 2)
        scale, most = self._rough_scales()
        recurrent = {side: np.ascontiguousarray((w[f"rec_{side}"] * scale).T) for side in "fb"}
        # attention before its tanh, scaled, and what the states add to the logit
        att = np.column_stack((w["att"] * (-2 * _EXP), w["out"])).T.astype(np.float32)
        att_f, att_b = np.ascontiguousarray(att[:, :size]), np.ascontiguousarray(att[:, size:])
        bias = np.append(w["att_bias"] * (-2 * _EXP) + _ONE, 0).astype(np.float32)[:, None]
        att_out = 2 * w["att_out"]
        out = np.empty(len(ids) - width + 1, dtype=np.float32)
        # a gate is open or closed long before its input is that large
        forward, backward = (x if -most <= x.min() and x.max() <= most else x.clip(-most, most) for x in (forward, backward))
        scale = scale[:, None]

        def weighed(ahead: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Weights of places in attention, and weights times what the places add to the logit."""
            both = ahead + back
            scores = _one_and_exp(both[:-1], np.empty(both[:-1].shape, dtype=np.int32))
            share = np.exp(att_out @ np.reciprocal(scores, out=scores) - att_out.sum() / 2)
            return share, share * both[-1]

        for at in range(0, len(out), step):
            many = min(step, len(out) - at)
            part = ids[at : at + many + width - 1]
            fs, bs = [], []
            for found, rows, side, of in ((fs, forward, "f", att_f), (bs, backward, "b", att_b)):
                x = np.multiply(rows.take(part, axis=0).T, scale, order="C")
                x += _ONE
                for h in _rough_states(x, recurrent[side], context, side == "b"):
                    found.append(of @ h)
                    if side == "b":
                        found[-1] += bias
            last = bs[-1]
            # places with a full context on both sides are the same in all windows that have them
            shared = width - 2 * context + 2
            middle = many + shared - 1
            total, value = weighed(fs[-1][:, :middle], last[:, context - 1 : context - 1 + middle])
            total, value = (sum(x[j : j + many] for j in range(shared)) for x in (total, value))
            for p in range(context - 1):
                edge = width - 1 - p
                for ahead, back in (
                    (fs[p][:, :many], last[:, p : p + many]),
                    (fs[-1][:, edge - context + 1 : edge - context + 1 + many], bs[p][:, edge : edge + many]),
                ):
                    share, own = weighed(ahead, back)
                    total, value = total + share, value + own
            out[at : at + many] = value / total
        return out + w["out_bias"][0]

    def gradients(self, windows: np.ndarray, keep: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weights behind ``logits`` and of the projections, by the errors of the logits."""
        w, g = self.weights, {}
        states, hidden, share, mask = keep["states"], keep["hidden"], keep["share"], keep["mask"]
        size = self.shape.hidden
        g["out"], g["out_bias"] = keep["pooled"].T @ error, np.array([error.sum()], dtype=np.float32)
        g_pooled = error[:, None] * w["out"]
        g_share = np.einsum("bh,tbh->tb", g_pooled, states)
        g_scores = share * (g_share - (share * g_share).sum(axis=0))
        g_hidden = g_scores[:, :, None] * w["att_out"] * (1 - hidden * hidden)
        g["att_out"] = np.einsum("tb,tbh->h", g_scores, hidden)
        g["att"] = np.einsum("tbi,tbj->ij", states, g_hidden, optimize=True)
        g["att_bias"] = g_hidden.sum(axis=(0, 1))
        g_states = share[:, :, None] * g_pooled + g_hidden @ w["att"].T
        g["x_f"], g["rec_f"] = _run_back(g_states[:, :, :size], keep["kept_f"], w["rec_f"], mask)
        g_back, g["rec_b"] = _run_back(g_states[::-1, :, size:], keep["kept_b"], w["rec_b"], mask[::-1])
        g["x_b"] = g_back[::-1]
        return g


def window_starts(n: int, shape: NetworkShape) -> np.ndarray:
    """First words of the overlapping windows that together cover ``n`` words; the last one ends with the text."""
    if n <= shape.window:
        return np.zeros(min(n, 1), dtype=np.int64)
    starts = np.arange(0, n - shape.window, shape.stride, dtype=np.int64)
    return np.append(starts, n - shape.window)


def _windows(ids: list[np.ndarray], shape: NetworkShape) -> tuple[np.ndarray, np.ndarray]:
    """Windows over all texts and the text of each."""
    starts = [window_starts(len(x), shape) for x in ids]
    owner = np.repeat(np.arange(len(ids)), [len(s) for s in starts])
    if not len(owner):
        return np.zeros((0, shape.window), dtype=np.int64), owner
    flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
    first = (np.cumsum(sizes) - sizes)[owner] + np.concatenate(starts)
    kind = np.int32 if len(flat) < 1 << 30 else np.int64  # all windows of the sample are held while training
    at = first.astype(kind)[:, None] + np.arange(shape.window, dtype=kind)
    inside = at < np.cumsum(sizes)[owner][:, None]
    return np.where(inside, flat[np.minimum(at, len(flat) - 1)], -1), owner


class _AllWindows:
    """``_windows`` of many texts, each made when asked for: only the words and the windows' places are held."""

    def __init__(self, ids: list[np.ndarray], shape: NetworkShape):
        starts = [window_starts(len(x), shape) for x in ids]
        self.owner = np.repeat(np.arange(len(ids), dtype=np.int32), [len(s) for s in starts])
        # texts shorter than a window are filled up, so that every window is a stretch of words
        filled = [np.append(x, np.full(shape.window - len(x), -1, x.dtype)) if 0 < len(x) < shape.window else x for x in ids]
        sizes = np.array([len(x) for x in filled], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        self.starts = (np.concatenate([s + f for s, f in zip(starts, first, strict=True)]) if ids else first).astype(np.int32)
        self.flat = np.concatenate([*filled, np.full(shape.window, -1, np.int32)])
        self.places = np.arange(shape.window, dtype=np.int32)

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, which: np.ndarray) -> np.ndarray:
        return self.flat[self.starts[which][:, None] + self.places]


class Scorer:
    """Scores texts in a worker, with projections kept for words met before."""

    MOST_WORDS = 100_000
    MOST_UNITS = 150_000

    def __init__(self, network: Network):
        self.network = network
        self.clear()

    def clear(self) -> None:
        width = 3 * self.network.shape.hidden
        self.units: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.word_of = np.zeros(0, dtype=np.int32)  # of each unit, -1 where it has none
        self.again = np.zeros(0, dtype=bool)  # whether a further batch of texts has the unit
        self.forward = np.zeros((0, width), dtype=np.float32)
        self.backward = np.zeros((0, width), dtype=np.float32)

    def _thin(self) -> None:
        """Keep the units met again, and their words; most units stand in one batch of texts only."""
        kept = np.flatnonzero(self.again)
        used, new = np.unique(self.word_of[kept], return_inverse=True)
        none = int(len(used) > 0 and used[0] < 0)
        used = used[none:]
        if len(kept) > self.MOST_UNITS // 2 or len(used) > self.MOST_WORDS // 2:
            self.clear()
            return
        units, words = list(self.units), list(self.words)  # in the order of their numbers
        self.units = {units[i]: number for number, i in enumerate(kept.tolist())}
        self.words = {words[i]: number for number, i in enumerate(used.tolist())}
        self.word_of, self.again = (new - none).astype(np.int32), np.zeros(len(kept), dtype=bool)
        self.forward, self.backward = self.forward[used], self.backward[used]

    def _learn(self, fresh: list[str]) -> None:
        """Number the units and project words not met before."""
        own = [_word(unit) for unit in fresh]
        known = self.words
        new = [word for word in dict.fromkeys(own) if word and word not in known]
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self.units.update(zip(fresh, range(len(self.units), len(self.units) + len(fresh)), strict=True))
        self.word_of = np.append(self.word_of, np.array([known.get(word, -1) for word in own], dtype=np.int32))
        self.again = np.append(self.again, np.zeros(len(fresh), dtype=bool))
        if new:
            f, b = self.network.projections(self.network.inputs(new))
            need = len(self.words)
            if need > len(self.forward):
                more = max(need, 2 * len(self.forward)) - len(self.forward)
                pad = np.zeros((more, f.shape[1]), dtype=np.float32)
                self.forward, self.backward = np.concatenate((self.forward, pad)), np.concatenate((self.backward, pad))
            self.forward[need - len(new) : need], self.backward[need - len(new) : need] = f, b

    def numbered(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """The texts as numbers of words."""
        if len(self.words) >= self.MOST_WORDS or len(self.units) >= self.MOST_UNITS:
            self._thin()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.utf8_split_whitespace(pc.fill_null(column, ""))  # at what str.split takes for whitespace
        coded, ends = split.flatten().dictionary_encode(), np.cumsum(pc.list_value_length(split).to_numpy())
        units = coded.dictionary.to_pylist()
        found = np.fromiter(map(self.units.get, units, repeat(-1)), dtype=np.int64, count=len(units))
        unmet = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(unmet):
            found[unmet] = np.arange(len(self.units), len(self.units) + len(unmet))
            self._learn([units[i] for i in unmet.tolist()])
        ids = self.word_of[found].astype(np.int64)[coded.indices.to_numpy()]
        return [own[own >= 0] for own in np.split(ids, ends[:-1])] if len(ends) else []

    def window_logits(self, windows: np.ndarray, step: int = 2048) -> np.ndarray:
        parts = [
            self.network.logits(self.forward, self.backward, windows[at : at + step]) for at in range(0, len(windows), step)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)

    #: Every so many windows one is computed in full whatever its rough number, so that errors are known everywhere.
    PROBE = 128
    #: Windows whose rough number is at most this below their text's largest are computed in full, and if errors turn
    #: out larger than it allows for, those at most ``SAFETY`` times the spread of the text's errors below, or the
    #: spread of errors that all texts have in numbers about as large.
    MARGIN, SAFETY = 0.1, 2.0

    def _strongest(self, ids: list[np.ndarray]) -> np.ndarray:
        """The largest logit of all windows of each text, which all are longer than a window.

        All windows are computed roughly; those that may be their text's strongest, as far as the errors found in
        the text say, are computed in full, and only such numbers are returned.
        """
        network, width = self.network, self.network.shape.window
        flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
        firsts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(ids)), sizes - width + 1)
        # windows that reach into the next text do not count
        starts = np.arange(len(owner)) + (width - 1) * owner
        first = firsts - (width - 1) * np.arange(len(ids))
        if not network.has_rough():
            return np.maximum.reduceat(network.logits_at(self.forward, self.backward, flat, starts), first)
        rough = network.rough_logits(self.forward, self.backward, flat)[starts]
        top = np.maximum.reduceat(rough, first)
        below = top[owner] - rough
        level, top_level = (np.clip(2 * x + 41, 1, 81).astype(np.int8) for x in (rough, top))  # halves of a logit
        full = np.full(len(rough), np.nan, dtype=np.float32)
        margin = np.full(len(ids), self.MARGIN, dtype=np.float32)
        wanted = below <= self.MARGIN
        wanted[:: self.PROBE] = True
        while len(which := np.flatnonzero(wanted)):
            full[which] = network.logits_at(self.forward, self.backward, flat, starts[which])
            error = full - rough
            spread = np.fmax.reduceat(error, first) - np.fmin.reduceat(error, first)
            known = np.flatnonzero(~np.isnan(full))
            high, low = np.full(83, -np.inf, dtype=np.float32), np.full(83, np.inf, dtype=np.float32)
            np.maximum.at(high, level[known], error[known])
            np.minimum.at(low, level[known], error[known])
            # with the levels above and below
            common_spread = np.max([high[:-2], high[1:-1], high[2:]], axis=0) - np.min([low[:-2], low[1:-1], low[2:]], axis=0)
            margin = np.max([margin, self.SAFETY * spread, common_spread[top_level - 1]], axis=0)
            wanted = (below <= margin[owner]) & np.isnan(full)
        return np.fmax.reduceat(full, first)

    def scores(self, texts: list[str | None] | pa.Array) -> np.ndarray:
        """The strongest window of each text, between 0 and 1."""
        shape, ids = self.network.shape, self.numbered(texts)
        out = np.full(len(texts), -np.inf)
        if shape.stride == 1:
            long = [i for i, x in enumerate(ids) if len(x) > shape.window]
            if long:
                out[long] = self._strongest([ids[i] for i in long])
                for i in long:
                    ids[i] = ids[i][:0]
        windows, owner = _windows(ids, shape)
        np.maximum.at(out, owner, self.window_logits(windows).astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(out, -700, 700))) * np.isfinite(out)


class EveryWindow(Scorer):
    """Scores texts with every window computed in full."""

    def _strongest(self, ids: list[np.ndarray]) -> np.ndarray:
        """The largest logit of all windows of each text, which all are longer than a window."""
        flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
        found = self.network.sliding_logits(self.forward, self.backward, flat)
        firsts = np.cumsum(sizes) - sizes
        # windows that reach into the next text do not count
        bounds = np.column_stack((firsts, firsts + sizes - self.network.shape.window + 1)).ravel()[:-1]
        return np.maximum.reduceat(found, bounds)[::2]


def _log_odds(buckets: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Log odds of each bucket, against one never seen, by the number of texts of either label that have it once or more."""
    counts = np.zeros((2, size))
    for found, label in zip(buckets, labels, strict=True):
        counts[int(label), found] += 1
    share = (counts + 0.5) / (np.bincount(labels, minlength=2)[:, None] + 1)
    odds = np.log(share[1] / share[0]) - np.log((labels == 0).sum() + 1) + np.log((labels == 1).sum() + 1)
    return np.clip(np.where(counts.sum(axis=0) > 1, odds, 0), -4, 4).astype(np.float32)


class _Adam:
    def __init__(self, rate: float, slower: dict[str, float]):
        self.rate, self.slower, self.step, self.moments = rate, slower, 0, {}

    def update(self, weights: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for name, g in gradients.items():
            m, v = self.moments.setdefault(name, (np.zeros_like(weights[name]), np.zeros_like(weights[name])))
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            weights[name] -= (self.slower.get(name, 1) * scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def train(texts: list[str], labels: list[int], shape: NetworkShape | None = None, seed: int = 7) -> Network | None:
    """Fit a network to labelled texts; None if one of the labels is missing."""
    shape = shape or NetworkShape()
    y = np.array(labels, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return None
    network = Network.fresh(shape, seed)
    w, rng = network.weights, np.random.default_rng(seed)
    numbering = Scorer(network)
    numbering.MOST_WORDS = numbering.MOST_UNITS = 1 << 62
    # some texts at a time, as words in a list take ten times the space of the text
    ids = [x.astype(np.int32) for at in range(0, len(texts), 64) for x in numbering.numbered(texts[at : at + 64])]
    words = list(numbering.words)
    windows = _AllWindows(ids, shape)
    owner = windows.owner
    numbering.clear()
    if not len(windows):
        return None
    n, size = len(words), 1 << shape.bits
    word_of = _word_buckets(words, shape.bits)
    # n-grams of each word, all lengths together, by word
    lists = [(b.astype(np.int32), bounds) for b, bounds in _gram_buckets(words, shape.grams, shape.bits)]
    bounds = sum(b for _, b in lists)
    grams, filled = np.empty(bounds[-1], dtype=np.int32), bounds[:-1].copy()
    for found, own in lists:
        counts = np.diff(own)
        grams[np.arange(len(found)) + np.repeat(filled - own[:-1], counts)] = found
        filled += counts
    del lists, found

    def grams_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = bounds[chosen + 1] - bounds[chosen]
        before = np.cumsum(counts) - counts
        return grams[np.arange(counts.sum()) + np.repeat(bounds[chosen] - before, counts)], counts

    small = np.min_scalar_type(size)
    by_text = [(np.unique(word_of[x]).astype(small), np.unique(grams_of(x)[0]).astype(small)) for x in map(np.unique, ids)]
    w["word_odds"], w["gram_odds"] = (_log_odds([t[i] for t in by_text], y, size) for i in (0, 1))
    # number the words of each fold anew, with the odds of the other folds
    fold = np.empty(len(y), dtype=np.int64)
    for label in (0, 1):
        members = rng.permutation(np.flatnonzero(y == label))
        fold[members] = np.arange(len(members)) % shape.folds
    fixed = np.empty((shape.folds, n, 3), dtype=np.float32)
    for f in range(shape.folds):
        others = np.flatnonzero(fold != f)
        tables = (_log_odds([by_text[i][k] for i in others], y[others], size) for k in (0, 1))
        tables = tuple(tables)
        fixed[f] = _in_parts(lambda part, tables=tables: _odds_features(*tables, part, shape), words)
    del by_text
    adam = _Adam(shape.rate, {"word": shape.embedding_rate, "gram": shape.embedding_rate})
    toxic_weight = ((y == 0).sum() / (y == 1).sum()) ** shape.balance
    odd = shape.word_size + shape.gram_size  # from here on the inputs are odds, not trained
    for epoch in range(shape.epochs):
        strength = np.empty(len(windows), dtype=np.float32)
        embedded = network.embeddings(words) if epoch else None
        for f in range(shape.folds):
            own = np.flatnonzero(fold[owner] == f)
            if epoch == 0:  # before the network knows anything: the window with the largest odds
                odds = np.append(fixed[f].sum(axis=1), np.float32(-99))  # the last one for places without a word
                for some in (own[at : at + 4096] for at in range(0, len(own), 4096)):
                    strength[some] = odds[windows[some]].max(axis=1)
            else:
                numbering.forward, numbering.backward = network.projections(np.concatenate((embedded, fixed[f]), axis=1))
                for some in (own[at : at + 2048] for at in range(0, len(own), 2048)):
                    strength[some] = numbering.window_logits(windows[some])
        del embedded
        ranked = np.lexsort((strength, owner))
        last = np.flatnonzero(np.append(owner[ranked][1:] != owner[ranked][:-1], True))
        best = ranked[last]
        # clean texts also lend a window at random: all of theirs are clean
        other = rng.permutation(np.flatnonzero(y[owner] == 0))[: int((y == 0).sum())]
        chosen = rng.permutation(np.concatenate((best, other)))
        for at in range(0, len(chosen), shape.batch):
            part = chosen[at : at + shape.batch]
            target = y[owner[part]].astype(np.float32)
            # a word is another one in each fold
            numbers = np.where(windows[part] >= 0, windows[part] + n * fold[owner[part]][:, None], -1)
            used, place = np.unique(numbers, return_inverse=True)
            place = place.reshape(len(part), -1)
            if used[0] < 0:
                used, place = used[1:], place - 1
            plain = used % n
            gram, counts = grams_of(plain)
            starts = np.cumsum(counts) - counts
            mean = np.add.reduceat(w["gram"][gram], starts, axis=0) / counts[:, None]
            x = np.concatenate((w["word"][word_of[plain]], mean, fixed[used // n, plain]), axis=1).astype(np.float32)
            forward, backward = network.projections(x)
            keep: dict = {}
            logit = network.logits(forward, backward, place, keep)
            weight = np.where(target > 0, toxic_weight, 1).astype(np.float32)
            g = network.gradients(place, keep, (weight * (_sigmoid(logit) - target) / weight.sum()).astype(np.float32))
            g_x = np.zeros_like(x)
            flat, inside = np.maximum(place.T, 0).ravel(), (place.T >= 0).ravel()
            for side in "fb":
                g_in = g.pop(f"x_{side}").reshape(-1, 3 * shape.hidden)[inside]
                by_word = np.zeros((len(used), 3 * shape.hidden), dtype=np.float32)
                np.add.at(by_word, flat[inside], g_in)
                g[f"in_{side}"], g[f"bias_{side}"] = x.T @ by_word, by_word.sum(axis=0)
                g_x += by_word @ w[f"in_{side}"].T
            g["word"], g["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
            np.add.at(g["word"], word_of[plain], g_x[:, : shape.word_size])
            np.add.at(g["gram"], gram, np.repeat(g_x[:, shape.word_size : odd] / counts[:, None], counts, axis=0))
            adam.update(w, g)
    return network


def fold_of(key) -> F.Column:
    """crc32 of the id's text modulo 5; fold 0 is held out."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, shape: NetworkShape
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``sample_rows`` rows for each label, chosen by a hash of the id, none held out."""
    key, name = F.col(f"`{common.field(labels, id_col).name}`"), common.field(docs, id_col).name
    known = labels.filter(key.isNotNull() & F.col(f"`{label_col}`").isNotNull() & (fold_of(key) != 0))
    known = known.groupBy(key.alias("_key")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("_label"))
    text = F.col(f"`{common.field(docs, text_col).name}`")
    short = docs.select(F.col(f"`{name}`").alias("_id"), text.alias("_text")).filter(F.length("_text") <= shape.sample_chars)
    parts = []
    for label in (0, 1):
        some = known.filter(F.col("_label") == label).orderBy(F.xxhash64("_key"), "_key").limit(shape.sample_rows)
        # the limit bounds what is broadcast
        joined = short.join(F.broadcast(some), F.col("_id") == F.col("_key")).select("_key", "_text", "_label")
        parts.append(joined.orderBy(F.xxhash64("_key"), "_key", "_text").limit(shape.sample_rows))
    rows = parts[0].unionByName(parts[1]).collect()
    return [r["_text"] for r in rows], [r["_label"] for r in rows]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    shape: NetworkShape | None = None,
) -> Network | None:
    """Train on the bounded sample of labelled rows that are not held out."""
    shape = shape or NetworkShape()
    common.release()  # the driver's memory is small
    network = train(*labelled_sample(docs, labels, id_col, text_col, label_col, shape), shape)
    common.release()
    return network


def add_scores(docs: DataFrame, network: Network | None, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the column ``score``, in place of one of that name; rows and other columns stay."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != score.lower()])
    if network is None:
        return docs.withColumn(score, F.lit(0.0))
    shared = common.share(docs.sparkSession.sparkContext, (network.shape, network.weights))
    at = docs.columns.index(common.field(docs, text_col).name)
    schema = T.StructType([*docs.schema, T.StructField(score, T.DoubleType())])
    target = common.arrow_schema(schema)

    def run(batches):
        scorer = common.held(("toxicity", shared), lambda: EveryWindow(Network(*shared.value)))
        for b in batches:
            for part in common.slices(b, at, 2 << 20):
                found = pa.array(scorer.scores(part.column(at)))
                columns = [c.cast(f.type) for c, f in zip(part.columns, target, strict=False)]
                yield pa.RecordBatch.from_arrays([*columns, found], schema=target)
        common.release()

    return docs.mapInArrow(run, schema)
