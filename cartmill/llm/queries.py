"""One query for each operator on the driver's tables, next to the SQL that checks it where SQL can express it."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import (
    bpe,
    collocations,
    decontamination,
    extraction,
    pii,
    posting,
    repetition,
    runs,
    simhash,
    substrings,
    token_store,
    toxicity,
    warc,
)
from cartmill.llm.common import new_folder, query, schema_of, table

_BPE_FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]

_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _repetition_sql(ngrams: dict[int, int], line_chars: int, line_count: int, least_lines: int) -> str:
    """Counts by list functions and windows over exploded words and lines."""
    shares = []
    for k, percent in ngrams.items():
        gram = " || ' ' || ".join(
            f"lead(w, {j}) OVER p" if j else "w" for j in range(k)
        )
        shares.append(
            f"""SELECT r FROM (
  SELECT r, i, w, max(later) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS hit FROM (
    SELECT r, i, w, CASE WHEN g IS NOT NULL AND row_number() OVER (PARTITION BY r, g ORDER BY i) > 1 THEN 1 ELSE 0 END AS later
    FROM (SELECT r, i, w, {gram} AS g FROM words WINDOW p AS (PARTITION BY r ORDER BY i))))
GROUP BY r HAVING 100 * sum(CASE WHEN hit = 1 THEN length(w) ELSE 0 END) > {percent} * sum(length(w))"""
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {_WORDS_SQL} AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
lines AS (SELECT r, line, i, row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth FROM (
  SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d))
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
line_stats AS (SELECT r, count(*) AS n_lines, count(*) FILTER (nth > 1) AS dup,
  coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (nth > 1), 0) AS dup_chars
  FROM lines GROUP BY r),
threes AS (SELECT r, i, g, count(*) OVER (PARTITION BY r, g) AS n FROM (
  SELECT r, i, CASE WHEN lead(w, 2) OVER p IS NULL THEN NULL ELSE w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p END AS g
  FROM words WINDOW p AS (PARTITION BY r ORDER BY i))),
repeats AS (SELECT r, count(*) FILTER (hit = 1) AS n FROM (
  SELECT r, max(CASE WHEN g IS NOT NULL AND n > 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM threes) GROUP BY r),
over_limit AS ({" UNION ".join(shares)}),
base AS (SELECT d.r, doc_id, len(ws)::BIGINT AS n_words,
  length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
  coalesce(dup_chars, 0) AS dup_chars, coalesce(n_lines, 0) AS n_lines, o.r IS NOT NULL AS over_share
  FROM d LEFT JOIN line_stats USING (r) LEFT JOIN repeats USING (r) LEFT JOIN over_limit o USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT over_share
    AND 100 * dup_chars <= {line_chars} * word_chars
    AND NOT (n_dup_lines >= {least_lines} AND 100 * n_dup_lines > {line_count} * n_lines) AS kept
FROM base"""


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (
  SELECT item_id, regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark)),
w AS (SELECT DISTINCT item_id, size, array_to_string(ws[pos : pos + size - 1], ' ') AS phrase FROM (
  SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS pos FROM i WHERE size > 0)),
grams AS (SELECT r, size, pos, array_to_string(ws[pos : pos + size - 1], ' ') AS phrase FROM (
  SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS pos
  FROM d, (SELECT DISTINCT size FROM w) WHERE len(ws) >= size)),
hits AS (SELECT r, pos, size, item_id FROM grams JOIN w USING (size, phrase)),
n_hit AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(pos, pos + size)) AS pos FROM hits) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS list
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids.list, '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN ids USING (r)"""


@query("op1_benchmark_decontamination", _CONTAMINATION_SQL)
def _contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@query("op5_personal_data")
def _personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != pii.TERM)
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


_LIMITS = repetition.RepetitionLimits()


@query("op10_quality_repetition", _repetition_sql(_LIMITS.ngrams, _LIMITS.line_chars, _LIMITS.line_count, _LIMITS.least_lines))
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_quality(table(spark, sf_dir, "documents"), limits=_LIMITS).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op7_byte_bpe")
def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def finish(ids: bytes, pieces: bpe.Pieces) -> tuple:
        decoded = pieces.decode(ids)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], finish=finish, fields=_BPE_FIELDS)


_END_ID = 1


@query("op9_token_ids")
def _token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "token-ids")
    manifest = token_store.write_token_ids(docs, folder, public_tokenizers.path("word_bpe_49k.json"), _END_ID, words=token_store.lower_case_words)

    def finish(key, start: int, ids) -> tuple:
        return key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    long = T.LongType()
    schema = schema_of(("doc_id", long), ("start", long), ("n_tokens", long), ("ids_crc32", long))
    return token_store.read_token_ids(manifest, folder, finish, schema)


def _warc_sql() -> str:
    """SHA-1 in base32: five hex digits are four base32 digits."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for i in range(8):
        number = f"('0x' || substr(hex, {5 * i + 1}, 5))::BIGINT"
        parts += [f"substr('{digits}', (({number} >> {shift}) & 31)::BIGINT + 1, 1)" for shift in (15, 10, 5, 0)]
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, payload_bytes, {" || ".join(parts)} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g"""


@query("op4_warc_archive", _warc_sql())
def _warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = new_folder(spark, "warc")
    read = warc.read_archive(warc.write_archive(pages, folder), folder)
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


SIMHASH = {"shingle": 3, "max_bits": 2}


@query("op6_simhash_near_duplicates")
def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)


@query("op8_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.add_scores(docs, network)
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op2_html_extraction")
def _html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(table(spark, sf_dir, "pages"))


_REPEATS_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
h AS (SELECT doc_id, n, hex(b) AS x FROM d),
w AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM h WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS opens FROM r),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM (
  SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM s),
t AS (SELECT h.doc_id, sum(e - a) AS removed, count(*) AS spans,
  string_agg(substr(x, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) || substr(any_value(x), 2 * max(e) + 1) AS kept
  FROM k JOIN h USING (doc_id) GROUP BY h.doc_id)
SELECT h.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM h LEFT JOIN t USING (doc_id)"""


@query("op3_repeated_strings", _REPEATS_SQL)
def _repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_CRC32_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""
_RUNS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS ws, {_CRC32_SQL} AS h FROM documents),
e AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a, h // 10 AS g FROM d),
t AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
w AS (SELECT r, n, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w
  FROM (SELECT *, unnest(range(0, n)) AS i FROM t)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS l
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
  GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l),
listed AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS text,
  min((-l, s, q)) AS best FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, -best[1]::BIGINT AS length, best[3]::BIGINT AS period,
  (-best[1] * 1000 // best[3])::BIGINT AS exponent_milli, sha256(coalesce(listed.text, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""


def _periodic_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """Where a tenth of the keys fall, the words from some place on repeat a part of themselves."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op12_periodic_runs", _RUNS_SQL)
def _periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=_periodic_tail)
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_NEAREST_SQL = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@query("op13_nearest_neighbours", _NEAREST_SQL)
def _nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = posting.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


_COLLOCATIONS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {_LOWER_SQL} AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k))
  GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT c.lang, c.k, c.phrase, a, x.f AS l, y.f AS r, cut, 2000000::HUGEINT * a // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : cut], ' ') AND x.k = cut
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1 : c.k], ' ') AND y.k = c.k - cut),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(ws[i : i + size - 1], ' ') AS phrase, max(a) AS longer FROM (
  SELECT lang, ws, a, size, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM c))
  GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


@query("op11_phrase_collocations", _COLLOCATIONS_SQL)
def _phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
