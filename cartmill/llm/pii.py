"""Personal data: patterns, and terms that the corpus shows to give protected values away.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Co-occurrence over the whole corpus says how
much a term t reveals a found value c: with n(c) and n(t) the number of texts having either and n(t, c) those having
both, wherever they stand, disclosure is PMI(t; c) / IC(c), where IC(c) = log2(N / n(c)) is all there is to learn about
c. A term whose disclosure reaches ``threshold`` is generalised to a placeholder wherever it stands in the texts having
that value. Any word that stands only once in the corpus would reveal its text's value, so two texts are the least that
show more than chance. Copies count once: equal texts are one text, and the words around the value as well as those
around the term must differ in ``min_support`` ways, so that copying a text or a passage convicts no term.

Texts are searched by a map; what is shuffled are the terms of texts with a value that recurs, and counts, combined in
each task first, keyed by (value, term) or by term, so that a value or term standing in a third of all texts costs each
task one row.

Defined results: null and empty texts have no spans; rows with the same id and text give the same result; a null id
is passed through; extra columns are kept by ``sanitise``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ORDER = {kind: i for i, kind in enumerate((*KINDS, TERM))}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at the first digit of a run
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[^0-9]+")


@dataclass(frozen=True)
class Disclosure:
    """When a term counts as revealing: share of IC, texts and contexts needed, words on either side in a context."""

    threshold: float = 0.9
    min_support: int = 2
    reach: int = 6


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches in linear time: an address is looked for to the left of each at sign."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            after = m.end()
            yield start, after
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind, in code points."""
    out = [(a, b, "email") for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return in_order(out)


def in_order(spans) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1]))


def _value(text: str, start: int, end: int, kind: str) -> str:
    """The protected value of a span, however it is written."""
    raw = text[start:end]
    return f"{kind}:{raw.lower() if kind in ('email', 'ip') else _DIGITS.sub('', raw)}"


def terms_outside(text: str, spans) -> list[tuple[str, int, int]]:
    """(term, start, end) of all terms outside the spans, in order."""
    out, at = [], 0
    for start, end in [*((a, b) for a, b, _ in spans), (len(text), len(text))]:
        out += [(m[0].lower(), *m.span()) for m in _TERM.finditer(text, at, max(at, start))]
        at = max(at, end)
    return out


def _mark(terms) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(" ".join(t[0] for t in terms).encode()) - (1 << 63)


def value_contexts(text: str, spans, reach: int):
    """(value, context) for each base span: a hash of the nearest terms on either side, however far they are."""
    terms = terms_outside(text, spans)
    ends = [t[2] for t in terms]
    for start, end, kind in spans:
        at = bisect_right(ends, start)
        yield _value(text, start, end, kind), _mark(terms[max(0, at - reach) : at + reach])


_BASE = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("kind", T.StringType()),
        ]
    )
)


def _contexts(docs: DataFrame, text_col: str, reach: int) -> DataFrame:
    """One row per (text, base span): text_key, value, context."""
    schema = common.schema_of(("text_key", T.LongType()), ("value", T.StringType()), ("context", T.LongType()))

    def rows(batch):
        for key, text in batch:
            spans = base_spans(text) if text else []
            for value, mark in value_contexts(text, spans, reach) if spans else ():
                yield key, value, mark

    return common.arrow_map(_keyed(docs, text_col), rows, schema)


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    name = common.field(docs, text_col).name
    return docs.select(F.xxhash64(F.col(f"`{name}`")).alias("text_key"), F.col(f"`{name}`"))


_TERMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("around", T.LongType()),
        ]
    )
)


def _recurring(contexts: DataFrame, rules: Disclosure) -> DataFrame:
    """(value, n_value) of the values that stand in enough texts; no other can convict a term."""
    texts = contexts.groupBy("value", "text_key").agg(F.lit(1).alias("one"))
    return texts.groupBy("value").agg(F.count("*").alias("n_value")).filter(F.col("n_value") >= rules.min_support)


_BITS = 1 << 22


def _occurrences(docs: DataFrame, text_col: str, rules: Disclosure, contexts: DataFrame) -> DataFrame:
    """(text_key, terms): all terms outside base spans, with the words around them, of texts with a recurring value."""
    schema = common.schema_of(("text_key", T.LongType()), ("terms", _TERMS))
    reach = rules.reach
    chosen = contexts.join(_recurring(contexts, rules), "value", "left_semi").select("text_key").distinct()
    # a bit map of fixed size keeps nearly all other texts out before anything is shuffled
    bit = F.pmod("text_key", F.lit(_BITS))
    parts = chosen.groupBy(F.shiftright(bit, 15).alias("part")).agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    shared = common.share(docs.sparkSession.sparkContext, {r["part"]: bytes(r["bits"]) for r in parts.collect()})

    def rows(batch):
        bits = shared.value
        for key, text in batch:
            at = key % _BITS
            part = bits.get(at >> 15)
            if part is None or not part[(at & 32767) >> 3] >> (at & 7) & 1:
                continue
            spans = base_spans(text) if text else []
            if spans:
                terms = terms_outside(text, spans)
                yield key, [
                    {"term": t, "start": a, "end": b, "around": _mark(terms[max(0, i - reach) : i + reach + 1])}
                    for i, (t, a, b) in enumerate(terms)
                ]

    every = common.arrow_map(_keyed(docs, text_col), rows, schema, batch=256)
    return every.join(chosen, "text_key", "left_semi").dropDuplicates(["text_key"])


def _term_counts(docs: DataFrame, text_col: str, flush: int = 200_000) -> DataFrame:
    """(term, n): the number of texts having each term; a task adds up before anything is shuffled."""
    name = common.field(docs, text_col).name
    schema = common.schema_of(("term", T.StringType()), ("n", T.LongType()))
    target = common.arrow_schema(schema)

    def run(batches):
        from collections import Counter

        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update(set(_TERM.findall((text or "").lower())))
                if len(counts) >= flush:
                    yield common.to_batch(list(counts.items()), target)
                    counts.clear()
        if counts:
            yield common.to_batch(list(counts.items()), target)

    counted = docs.select(F.col(f"`{name}`")).mapInArrow(run, schema)
    return counted.groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_terms(
    docs: DataFrame,
    text_col: str = "text",
    rules: Disclosure | None = None,
    contexts: DataFrame | None = None,
    occurrences: DataFrame | None = None,
) -> DataFrame:
    """(value, term, disclosure) for the terms that reveal a value found by the base patterns."""
    rules = rules or Disclosure()
    if contexts is None:
        contexts = _contexts(docs, text_col, rules.reach)
    if occurrences is None:
        occurrences = _occurrences(docs, text_col, rules, contexts)
    values = _recurring(contexts, rules)
    around = contexts.join(values, "value", "left_semi")
    having = around.select("text_key", "value").distinct()
    terms = occurrences.select("text_key", F.explode("terms").alias("t")).select("text_key", "t.term", "t.around")
    once = terms.select("text_key", "term").distinct()

    def enough(counted: DataFrame, name: str) -> DataFrame:
        found = counted.groupBy("value", "term").agg(F.count("*").alias(name))
        return found.filter(F.col(name) >= rules.min_support)

    def kinds(pairs: DataFrame, of: str) -> DataFrame:
        return enough(pairs.groupBy("value", "term", of).agg(F.lit(1).alias("one")), f"n_{of}")

    total = docs.agg(F.count("*").alias("n_texts"))
    scored = (
        enough(having.join(once, "text_key"), "n_joint")
        .join(kinds(around.join(once, "text_key"), "context"), ["value", "term"])
        .join(kinds(having.join(terms, "text_key"), "around"), ["value", "term"])
        .join(values, "value")
        .join(_term_counts(docs, text_col), "term")
        .crossJoin(F.broadcast(total))
    )
    n_joint, n_value, n_term, n = (F.col(c).cast("double") for c in ("n_joint", "n_value", "n_term", "n_texts"))
    information = F.log2(n / n_value)
    shared = F.log2(n * n_joint / (n_value * F.greatest(n_term, n_joint)))
    return (
        scored.filter(F.col("n_value") < F.col("n_texts"))
        .select("value", "term", (shared / information).alias("disclosure"))
        .filter(F.col("disclosure") >= rules.threshold)
    )


def _added(docs: DataFrame, text_col: str, rules: Disclosure) -> DataFrame:
    """(text_key, terms): spans of revealing terms for each text that has any.

    Contexts and the terms of texts with a recurring value are stored, because several passes read them.
    """
    contexts = common.stored(_contexts(docs, text_col, rules.reach), "pii-contexts")
    occurrences = common.stored(_occurrences(docs, text_col, rules, contexts), "pii-terms")
    found = disclosing_terms(docs, text_col, rules, contexts, occurrences).select("value", "term")
    # a term that reveals several values of a text is marked once
    marked = contexts.select("text_key", "value").distinct().join(found, "value").select("text_key", "term").distinct()
    places = occurrences.select("text_key", F.explode("terms").alias("t")).select("text_key", "t.term", "t.start", "t.end")
    return (
        places.join(marked, ["text_key", "term"])
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("start", "end", F.lit(TERM).alias("kind"))).cast(_BASE).alias("terms"))
    )


def _with_terms(docs: DataFrame, text_col: str, rules: Disclosure) -> DataFrame:
    """``docs`` with the column of added spans."""
    name = common.field(docs, text_col).name
    key, other, terms = (common.free(docs, c) for c in ("_key", "_added_key", "_terms"))
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{name}`")))
    added = _added(docs, text_col, rules).select(F.col("text_key").alias(other), F.col("terms").alias(terms))
    return keyed.join(added, F.col(key) == F.col(other), "left").drop(key, other)


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Disclosure | None = None
) -> DataFrame:
    """Per row: all spans (start, end, kind), base and added, by start and kind."""
    rules = rules or Disclosure()
    found = find_base(docs, id_col, text_col)
    added = _added(docs, text_col, rules).select(F.col("text_key").alias("_added_key"), F.col("terms").alias("_terms"))
    joined = found.join(added, F.col("text_key") == F.col("_added_key"), "left")
    every = F.concat("base", F.coalesce("_terms", F.array().cast(_BASE)))
    ranks = F.create_map(*[F.lit(x) for k, i in ORDER.items() for x in (k, i)])
    ranked = F.sort_array(
        F.transform(every, lambda s: F.struct(s["start"], F.element_at(ranks, s["kind"]), s["end"], s["kind"]))
    )
    spans = F.transform(ranked, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return joined.select(*[F.col(f"`{c}`") for c in found.columns if c not in ("text_key", "base")], spans.alias("spans"))


def find_base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: the id, a key of the text and the base spans."""
    schema = common.schema_of(common.field(docs, id_col), ("text_key", T.LongType()), ("base", _BASE))

    def rows(batch):
        for key, text, mark in batch:
            spans = base_spans(text) if text else []
            yield key, mark, [{"start": a, "end": b, "kind": k} for a, b, k in spans]

    source = common.doc_rows(docs, id_col, text_col)
    return common.arrow_map(source.withColumn("_mark", F.xxhash64(F.col(f"`{source.columns[1]}`"))), rows, schema)


def replace_spans(text: str, spans) -> str:
    """Each span becomes ``<KIND>``; of overlapping ones the earlier and then longer wins and covers both."""
    parts, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1], ORDER[s[2]])):
        if start < at:
            at = max(at, end)
            continue
        parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join((*parts, text[at:]))


def sanitise(docs: DataFrame, text_col: str = "text", rules: Disclosure | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; rows and other columns stay."""
    joined = _with_terms(docs, text_col, rules or Disclosure())
    at = docs.columns.index(common.field(docs, text_col).name)

    def rows(batch):
        for row in batch:
            text, terms = row[at], row[-1]
            if text:
                spans = base_spans(text) + [(t["start"], t["end"], t["kind"]) for t in terms or ()]
                text = replace_spans(text, spans)
            yield (*row[:at], text, *row[at + 1 : -1])

    return common.arrow_map(joined, rows, docs.schema)
