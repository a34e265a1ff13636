"""Stretches of words that repeat with a fixed period, found on a grammar of the words.

The words of a slice of documents (some 4 MB of text) are numbered and compressed by Re-Pair: in each round every
pair of neighbouring symbols that occurs twice or more without overlap gets a symbol of its own; where two pairs
share a symbol the more frequent one wins, the other waits for the next round. Pairs never cross documents.

A run lies within one symbol or crosses a boundary between two. Runs that cross the boundary inside a rule are
computed once, on one place where the rule's symbol stands, and carried to all places it is derived at, from the
innermost rules outwards; runs that cross a boundary between the symbols left at the top are computed there. Pieces cut
off at the end of a symbol lie inside the run found further out, with the same period, and are merged with it.

A run of period q and at least four periods holds a square of that period to the right or the left of any boundary
inside it. Periods below 4 are compared directly. For a period from G to 2G - 1 the G words at the boundary must come
again q words on, so candidates are equal G-grams of one document, doubled in length from level to level and only where
the shorter gram comes twice. Squares and their extents are compared by hashes of prefixes, and every run found is
compared word by word before it counts.

No shuffle; memory is bounded by a slice or the longest document. Defined results: a null or empty text has no words
and no runs; a null key is a key like any other; repeated rows each get their own row; an empty table gives an empty
table; only the key and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartmill.llm.common import arrow_schema, doc_rows, field, release, schema_of, slices, to_batch

MIN_LENGTH, MIN_PERIODS = 6, 4
#: Pairs of equal grams looked at together.
CHUNK = 1 << 20
#: Fixed odd numbers for mixing 64 bits.
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)

Run = tuple[int, int, int]


class Grammar:
    """Symbols from ``terminals`` on stand for the pair ``left``, ``right``; ``first`` is a place where they stand."""

    def __init__(self, terminals: int):
        self.terminals = terminals
        self.left = self.right = self.length = self.first = np.empty(0, np.int64)

    def add(self, left: np.ndarray, right: np.ndarray, first: np.ndarray) -> np.ndarray:
        """New symbols for the pairs."""
        length = self.length_of(left) + self.length_of(right)
        start = self.terminals + len(self.left)
        self.left, self.right = np.append(self.left, left), np.append(self.right, right)
        self.length, self.first = np.append(self.length, length), np.append(self.first, first)
        return np.arange(start, start + len(left))

    def length_of(self, symbols: np.ndarray) -> np.ndarray:
        """Words that each symbol stands for."""
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.terminals
        out[rule] = self.length[symbols[rule] - self.terminals]
        return out


def _alternate(same: np.ndarray) -> np.ndarray:
    """True at every second place of each stretch of places that equal the one before, starting with its first."""
    places = np.arange(len(same))
    opened = np.maximum.accumulate(np.where(same, 0, places))
    return (places - opened) % 2 == 0


def re_pair(words: np.ndarray, doc: np.ndarray, terminals: int) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """Grammar of the words, and the symbols left at the top with the places where they start."""
    grammar, symbols, places, owner = Grammar(terminals), words.astype(np.int64), np.arange(len(words)), doc
    # pairs that came once never come twice later, unless a new symbol is part of them
    live = np.ones(max(0, len(symbols) - 1), bool)
    while live.any():
        at = np.flatnonzero(live & (owner[:-1] == owner[1:]))
        key = symbols[at] << 32 | symbols[at + 1]
        if len(at):
            again = np.append(False, (key[1:] == key[:-1]) & (at[1:] == at[:-1] + 1))
            free = _alternate(again)
            at, key = at[free], key[free]
        pairs, number, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = count[number] >= 2
        at, number = at[twice], number[twice]
        if not len(at):
            break
        weight = np.zeros(len(symbols) + 1, np.int64)
        weight[at + 1] = count[number] << 32 | number + 1
        wins = (weight[at + 1] > weight[at]) & (weight[at + 1] > weight[at + 2])
        chosen, number = at[wins], number[wins]
        uses = np.bincount(number, minlength=len(pairs))
        kept = uses[number] >= 2
        chosen, number = chosen[kept], number[kept]
        live = np.zeros(len(symbols), bool)
        live[at] = True
        if len(chosen):
            rules, first, number = np.unique(number, return_index=True, return_inverse=True)
            new = grammar.add(symbols[chosen[first]], symbols[chosen[first] + 1], places[chosen[first]])
            symbols = symbols.copy()
            symbols[chosen] = new[number]
            live[chosen] = True
            live[np.maximum(chosen - 1, 0)] = True
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            symbols, places, owner, live = symbols[stay], places[stay], owner[stay], live[stay]
        else:  # every winner stands once: its pair is given up, the others go on
            live[at[wins]] = False
        live = live[:-1]
    return grammar, symbols, places


class _Equal:
    """Compares parts of the words by sums of hashes times powers."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.codes = _mixed(words.astype(np.uint64) + np.uint64(1))
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE)), dtype=np.uint64)
        self.sums = np.append(np.uint64(0), np.cumsum(self.codes * self.powers[:n], dtype=np.uint64))

    def same(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from x and from y on (x < y) have equal hashes."""
        return (self.sums[x + size] - self.sums[x]) * self.powers[y - x] == self.sums[y + size] - self.sums[y]

    def _longest(self, most: np.ndarray, holds: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def forward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._longest(most, lambda size: self.same(x, y, size))

    def backward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._longest(most, lambda size: self.same(x - size, y - size, size))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


def _short_periods(words: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(boundary number, x, period) of squares of periods 1 to 3 on either side of a boundary."""
    n = len(words)
    for q in range(1, min(4, n)):
        square = np.zeros(n + 1, bool)  # the 2q words from here on are a square
        equal = words[:-q] == words[q:]
        whole = equal[: len(equal) - q + 1].copy()
        for j in range(1, q):
            whole &= equal[j : j + len(whole)]
        square[: len(whole)] = whole
        right = np.flatnonzero((b + 2 * q <= hi) & square[b])
        yield right, b[right], np.full(len(right), q)
        left = np.flatnonzero((b - 2 * q >= lo) & square[np.maximum(b - 2 * q, 0)])
        yield left, b[left] - q, np.full(len(left), q)


def _repeated(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key comes twice, ordered by key and place, and the number of their key."""
    bits = max(10, min(22, int(4 * len(key)).bit_length()))
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.bincount(bucket, minlength=1 << bits)[bucket] > 1
    key, at = key[maybe], at[maybe]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    opens = np.append(True, key[1:] != key[:-1])[: len(key)]
    group = np.cumsum(opens) - 1
    several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.empty(0, bool)
    return at[several], group[several]


def _pairs(at: np.ndarray, group: np.ndarray, gram: int, n: int, wanted: np.ndarray, forward: bool):
    """(number in ``wanted``, distance) of equal grams ``gram`` to 2 * gram - 1 words after or before the places wanted."""
    ordered = group * (2 * n + 2) + at  # ascending: places ascend within a group
    group_of = np.full(n + 1, -1, np.int64)
    group_of[at] = group
    ask = np.flatnonzero((wanted >= 0) & (group_of[np.clip(wanted, 0, n)] >= 0))
    base = group_of[wanted[ask]] * (2 * n + 2)
    place = wanted[ask]
    if forward:
        start = np.searchsorted(ordered, base + place + gram)
        end = np.searchsorted(ordered, base + np.minimum(place + 2 * gram, 2 * n + 1))
    else:
        start = np.searchsorted(ordered, base + np.maximum(place - 2 * gram + 1, 0))
        end = np.searchsorted(ordered, base + np.maximum(place - gram + 1, 0))
    size = np.maximum(end - start, 0)
    ask, start, size = ask[size > 0], start[size > 0], size[size > 0]
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // CHUNK, prepend=0)).tolist()
    for a, z in zip([0, *cuts], [*cuts, len(ask)], strict=True):
        s = size[a:z]
        if len(s):
            which = np.repeat(np.arange(a, z), s)
            other = at[start[which] + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)]
            yield ask[which], np.abs(other - wanted[ask[which]])


def _long_periods(words: np.ndarray, doc: np.ndarray, equal: _Equal, b: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(boundary number, x, period) where the first half of a square of period 4 or more may come again."""
    n, gram = len(words), 4
    if n < 4 * gram:
        return
    widest = int((hi - lo).max(initial=0))
    at = np.flatnonzero(doc[: n - 3] == doc[3:])
    code = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        code[: n - 3] = _mixed(
            _mixed(_mixed(equal.codes[: n - 3]) + equal.codes[1 : n - 2]) * _MIX + _mixed(equal.codes[2 : n - 1] * _BASE + equal.codes[3:])
        )
        key = _mixed(code[at] + _mixed(doc[at].astype(np.uint64)))
        while len(at) and 4 * gram <= widest:
            at, group = _repeated(key, at)
            fits = hi - lo >= 4 * gram
            for forward in (True, False):
                wanted = np.where(fits, b if forward else b - gram, -1)
                for which, q in _pairs(at, group, gram, n, wanted, forward):
                    room = hi[which] - b[which] if forward else b[which] - lo[which]
                    ok = (2 * q <= room) & (MIN_PERIODS * q <= hi[which] - lo[which])
                    yield which[ok], (b[which] if forward else b[which] - q)[ok], q[ok]
            known = np.zeros(n + gram, bool)
            known[at] = True
            at = np.sort(at)
            at = at[known[at + gram]]
            at = at[doc[np.minimum(at + 2 * gram - 1, n - 1)] == doc[at]]
            at = at[at + 2 * gram <= n]
            code[at] = _mixed(_mixed(code[at]) + code[at + gram] * _BASE)
            gram *= 2
            key = _mixed(code[at] + _mixed(doc[at].astype(np.uint64)))


def _exact(words: np.ndarray, lo: int, hi: int, x: int, q: int) -> tuple[int, int]:
    """Start and end of the longest stretch of period q around the words from x on, within the bounds."""
    differ = np.flatnonzero(words[lo : hi - q] != words[lo + q : hi]) + lo
    after = np.searchsorted(differ, x)
    start = int(differ[after - 1]) + 1 if after else lo
    return start, (int(differ[after]) if after < len(differ) else hi - q) + q


class _Covered:
    """Runs found so far at each boundary, to pass over multiples of their periods."""

    def __init__(self, boundaries: int):
        self.layers: list[np.ndarray] = []
        self.height = np.zeros(boundaries, np.int64)
        self.row = np.full(boundaries, -1, np.int64)
        self.rows = 0

    def add(self, k: int, start: int, end: int, period: int) -> None:
        if self.row[k] < 0:
            self.row[k] = self.rows
            self.rows += 1
        row, layer = int(self.row[k]), int(self.height[k])
        if layer == len(self.layers):
            self.layers.append(np.zeros((3, 64), np.int64))
        if row >= self.layers[layer].shape[1]:
            wider = np.zeros((3, 2 * (row + 1)), np.int64)
            wider[:, : self.layers[layer].shape[1]] = self.layers[layer]
            self.layers[layer] = wider
        self.layers[layer][:, row] = start, end, period
        self.height[k] += 1

    def new(self, which: np.ndarray, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        """False where x - q : x + q or x : x + 2q lies in a run found whose period divides q."""
        out, row = np.ones(len(which), bool), self.row[which]
        for layer in self.layers:
            at = np.flatnonzero((row >= 0) & (row < layer.shape[1]) & out)
            start, end, period = layer[:, row[at]]
            inside = (period > 0) & (start <= x[at]) & (x[at] + q[at] <= end) & (end - start >= 2 * q[at])
            out[at[inside]] = q[at[inside]] % period[inside] != 0
        return out


def crossing(
    words: np.ndarray, doc: np.ndarray, equal: _Equal, b: np.ndarray, lo: np.ndarray, hi: np.ndarray
) -> dict[int, list[Run]]:
    """Runs within lo:hi that cross or touch the boundary b, by the boundary's number, as (start, end, period)."""
    found: dict[int, set[Run]] = {}
    covered = _Covered(len(b))
    with np.errstate(over="ignore"):
        for which, x, q in chain(_short_periods(words, b, lo, hi), _long_periods(words, doc, equal, b, lo, hi)):
            good = equal.same(x - np.where(x < b[which], q, 0), x + np.where(x < b[which], 0, q), q)
            good[good] = covered.new(which[good], x[good], q[good])
            which, x, q = which[good], x[good], q[good]
            if not len(which):
                continue
            low, high = lo[which], hi[which]
            start = x - equal.backward(x, x + q, x - low)
            end = x + q + equal.forward(x, x + q, high - x - q)
            long = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * q)
            for k, at, s, e, p in zip(*(c[long].tolist() for c in (which, x, start, end, q)), strict=True):
                if (s, e, p) not in found.get(k, ()):
                    if not np.array_equal(words[s : e - p], words[s + p : e]):  # equal hashes of different words
                        s, e = _exact(words, int(lo[k]), int(hi[k]), at, p)
                        if e - s < max(MIN_LENGTH, MIN_PERIODS * p):
                            continue
                    found.setdefault(k, set()).add((s, e, p))
                    covered.add(k, s, e, p)
    return {k: list(runs) for k, runs in found.items()}


def merged(runs: Iterable[Run]) -> list[Run]:
    """Without pieces inside another run of the same period, by start and period."""
    out: list[Run] = []
    last_period = reach = -1
    for p, s, minus_e in sorted({(p, s, -e) for s, e, p in runs}):
        if p != last_period or -minus_e > reach:
            out.append((s, -minus_e, p))
            last_period, reach = p, -minus_e
    return sorted(out, key=lambda r: (r[0], r[2]))


def find_runs(words: np.ndarray, sizes: np.ndarray, terminals: int) -> list[list[Run]]:
    """(start, length, period) of the runs of each document; ``words`` are the numbered words of all of them."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    grammar, top, places = re_pair(words, doc, terminals)
    with np.errstate(over="ignore"):
        equal = _Equal(words)
    # boundaries inside rules long enough for a run, then those between symbols at the top
    rules = np.flatnonzero(grammar.length >= MIN_LENGTH)
    inner = grammar.first[rules] + grammar.length_of(grammar.left[rules])
    outer = places[1:][doc[places[1:]] == doc[places[:-1]]] if len(places) else places
    owner = doc[outer]
    b = np.append(inner, outer)
    lo = np.append(grammar.first[rules], starts[owner])
    hi = np.append(grammar.first[rules] + grammar.length[rules], ends[owner])
    of_doc: dict[int, list[Run]] = {}
    of_rule: dict[int, list[Run]] = {}
    own = np.zeros(grammar.terminals + len(grammar.left), bool)
    for k, runs in crossing(words, doc, equal, b, lo, hi).items():
        if k < len(rules):
            rule = int(rules[k])
            of_rule[grammar.terminals + rule] = [(s - int(lo[k]), e - int(lo[k]), p) for s, e, p in runs]
            own[grammar.terminals + rule] = True
        else:
            of_doc.setdefault(int(owner[k - len(rules)]), []).extend(runs)
    # from inner rules outwards: parts come before what is made of them
    if of_rule:
        for rule in rules.tolist():
            symbol, left, right = grammar.terminals + rule, int(grammar.left[rule]), int(grammar.right[rule])
            if own[symbol] or own[left] or own[right]:
                own[symbol] = True
                shift = int(grammar.length_of(np.array([left]))[0])
                inside = chain(of_rule.get(symbol, ()), of_rule.get(left, ()))
                moved = ((s + shift, e + shift, p) for s, e, p in of_rule.get(right, ()))
                of_rule[symbol] = merged(chain(inside, moved))
        for i in np.flatnonzero(own[top]).tolist():
            place = int(places[i])
            of_doc.setdefault(int(doc[place]), []).extend((s + place, e + place, p) for s, e, p in of_rule[int(top[i])])
    out: list[list[Run]] = [[] for _ in sizes]
    for k, runs in of_doc.items():
        smallest: dict[tuple[int, int], int] = {}
        for s, e, p in merged(runs):
            smallest[s, e] = min(p, smallest.get((s, e), p))
        first = int(starts[k])
        out[k] = sorted(((s - first, e - s, p) for (s, e), p in smallest.items()), key=lambda r: (r[0], r[2]))
    return out


def dropped(n: int, runs: Iterable[Run]) -> np.ndarray:
    """True for words that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """Per row: the key, ``n_words``, ``runs`` (start, length and period in words, by start and period) and ``collapsed``.

    Words are split at space, tab, line feed, vertical tab, form feed and carriage return. A run is a stretch of at least
    ``MIN_LENGTH`` words and ``MIN_PERIODS`` times its smallest period that cannot be extended. ``collapsed`` holds the
    words joined by one space without those that a run holds after its first period. ``rewrite`` may replace the words
    of a row before the search; it sees the key and the words as bytes. ``slice_bytes`` of text share a grammar.
    """
    schema = schema_of(
        field(df, id_col), ("n_words", T.LongType()), ("runs", T.ArrayType(_RUN)), ("collapsed", T.StringType())
    )
    target = arrow_schema(schema)

    def rows(part: pa.RecordBatch):
        keys = part.column(0).to_pylist()
        texts = part.column(1).cast(pa.large_binary()).to_pylist()
        split = [(t or b"").split() for t in texts]
        if rewrite is not None:
            split = [rewrite(k, ws) for k, ws in zip(keys, split, strict=True)]
        sizes = np.array([len(ws) for ws in split], np.int64)
        coded = pa.array(chain.from_iterable(split), pa.large_binary(), size=int(sizes.sum())).dictionary_encode()
        words = coded.indices.to_numpy(zero_copy_only=False)
        for key, ws, runs in zip(keys, split, find_runs(words, sizes, len(coded.dictionary)), strict=True):
            n = len(ws)
            if runs:
                gone = dropped(n, runs).tolist()
                ws = [w for w, g in zip(ws, gone, strict=True) if not g]
            yield key, n, [{"start": s, "length": e, "period": p} for s, e, p in runs], b" ".join(ws).decode()

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, slice_bytes):
                yield to_batch(list(rows(part)), target)
        release()

    return doc_rows(df, id_col, text_col).mapInArrow(run, schema)
