"""Deterministic sharded WARC writer, and a reader.

Records are dealt into shards by ranges of their key whose ends come from exact sums of bytes, so the same rows give
the same shards on any cluster. A task sorts its shards, writes each record as a gzip member with fresh headers and
digests, and starts a new file when the compressed size is reached. Files get temporary names that contain the
attempt; the manifest written afterwards lists what successful attempts wrote, and a second job moves exactly those
files to their final names. Whatever a lost executor leaves behind is never listed.

Records with equal payloads become one response, the one with the smallest key, and revisits that refer to it. Only
digests and keys are grouped, never payloads: a payload shared by a third of all records is one row per task.

Defined results: a null payload is empty; a null URL is replaced by the record's own URI; among rows that share key
and payload one is the response and the others revisit it; rows with a null key come first and, where equal, refer to
a record without key; an empty table gives an empty archive. All rows of one key go to one shard, whose files still
roll.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common, files

TEMPORARY = "_temporary"
_OVERHEAD = 1024  # bytes that headers add to a record, for dealing only
_BINS = 1 << 12


@dataclass(frozen=True)
class ArchiveLayout:
    """Payload bytes dealt to a shard, compressed bytes of a file, smallest payload to deduplicate, record date."""

    shard_bytes: int = 16 << 20
    file_bytes: int = 4 << 20
    min_payload: int = 0
    date: str = "2024-01-01T00:00:00Z"
    prefix: str = "archive"
    level: int = 6


def digest32(data: bytes) -> str:
    """Bare base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(key) -> str:
    return f"urn:x-record:{'' if key is None else key}"


def _headers(pairs: list[tuple[str, str]]) -> bytes:
    # a line break inside a value would start a new header
    return "".join(f"{k}: {_encoded(v)}\r\n" for k, v in pairs).encode()


def _encoded(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _member(record_type: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = [("WARC-Type", record_type), *headers, ("WARC-Block-Digest", f"sha1:{digest32(block)}"), ("Content-Length", str(len(block)))]
    return gzip.compress(b"WARC/1.1\r\n" + _headers(head) + b"\r\n" + block + b"\r\n\r\n", level, mtime=0)


def response_member(key, url: str | None, payload: bytes, refers_to: tuple | None, layout: ArchiveLayout) -> bytes:
    """A response, or with ``refers_to`` (key, url) of an earlier one a revisit without payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Record-ID", f"<{record_uri(key)}>"),
        ("WARC-Target-URI", url if url else record_uri(key)),
        ("WARC-Date", layout.date),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        return _member("response", headers, http + payload, layout.level)
    first, first_url = refers_to
    headers += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", f"<{record_uri(first)}>"),
        ("WARC-Refers-To-Target-URI", first_url if first_url else record_uri(first)),
        ("WARC-Refers-To-Date", layout.date),
    ]
    return _member("revisit", headers, http, layout.level)


def _info_member(name: str, layout: ArchiveLayout) -> bytes:
    headers = [
        ("WARC-Record-ID", f"<urn:x-file:{name}>"),
        ("WARC-Date", layout.date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _member("warcinfo", headers, b"software: cartmill\r\nformat: WARC File Format 1.1\r\n", layout.level)


MOST_SHARDS = 1 << 16


def range_cuts(sizes: DataFrame, target: int) -> list[int]:
    """Ascending keys at which a new shard begins, so that shards hold about ``target`` of the column ``size``.

    Sums per bin of keys are exact, so the cuts do not depend on how the rows lie. Bins that are too heavy are
    divided again until they are light or a single key; what reaches the driver is a few numbers for each shard, of
    which there are ``MOST_SHARDS`` at most, larger ones if the input asks for more.
    """
    low, high, total = sizes.agg(F.min("key"), F.max("key"), F.sum("size")).first()
    if low is None or total <= target:
        return []
    target = max(target, -(-total // MOST_SHARDS))
    shift = max(0, (high - low).bit_length() - _BINS.bit_length() + 1)
    sums: list[tuple[int, int]] = []
    frame = sizes
    while True:
        found = frame.groupBy(F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("size")).collect()
        heavy = [r["bin"] for r in found if r["size"] > target and shift]
        sums += [(r["bin"] << shift, r["size"]) for r in found if not (r["size"] > target and shift)]
        if not heavy:
            break
        bins = sizes.sparkSession.createDataFrame([(b,) for b in heavy], "heavy long")
        frame = sizes.join(bins, F.shiftright("key", shift) == F.col("heavy"), "left_semi")
        shift = max(0, shift - 8)
    cuts, held = [], 0
    for start, size in sorted(sums):
        if held and held + size > target:
            cuts.append(start)
            held = 0
        held += size
    return cuts


def _repeats(narrow: DataFrame, layout: ArchiveLayout) -> DataFrame:
    """(key, digest, first, first_url) for every row whose payload a smaller key has, or an equal row beside it."""
    groups = narrow.filter(F.col("bytes") >= layout.min_payload).groupBy("digest", "bytes").agg(
        F.count("*").alias("rows"),
        F.min(F.struct(F.col("key").isNotNull().alias("known"), "key", "url")).alias("first"),
    )
    groups = groups.filter(F.col("rows") > 1).select(
        F.col("digest").alias("same"), F.col("first.key").alias("first"), F.col("first.url").alias("first_url")
    )
    return narrow.join(groups, F.col("digest") == F.col("same")).select("key", "digest", "first", "first_url").distinct()


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    layout: ArchiveLayout | None = None,
) -> DataFrame:
    """Write the archive and return its manifest (name, n_records, n_bytes, sha1) of committed files."""
    layout = layout or ArchiveLayout()
    source = common.doc_rows(pages, id_col, url_col, payload_col)
    key, url, payload = (F.col(f"`{c}`") for c in source.columns)
    data = F.coalesce(payload.cast("binary"), F.lit(b""))
    records = source.select(key.cast("long").alias("key"), url.cast("string").alias("url"), data.alias("payload"))
    narrow = records.select("key", "url", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"))
    cuts = range_cuts(
        records.select("key", (F.octet_length("payload") + _OVERHEAD).cast("long").alias("size")).filter(F.col("key").isNotNull()),
        layout.shard_bytes,
    )
    marks = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("long")
    def shard_of(keys):
        known = keys.fillna(0).to_numpy(dtype=np.int64)
        return keys.where(keys.isna(), np.searchsorted(marks, known, side="right")).fillna(-1).astype("int64")

    none = F.lit(None)
    rows = records.select("key", F.lit(1).alias("kind"), "url", "payload", F.sha1("payload").alias("digest"), none.cast("long").alias("first"))
    marks_rows = _repeats(narrow, layout).select(
        "key", F.lit(0).alias("kind"), F.col("first_url").alias("url"), none.cast("binary").alias("payload"), "digest", "first"
    )
    # a mark stands right before the record it turns into a revisit, so payloads are moved once only
    placed = rows.unionByName(marks_rows).withColumn("shard", shard_of("key"))
    order = ["shard", F.col("key").asc_nulls_first(), "digest", "kind", "url"]
    dealt = placed.repartitionByRange(len(cuts) + 1, F.col("shard")).sortWithinPartitions(*order)
    columns = ["shard", "key", "kind", "url", "payload", "digest", "first"]
    schema = common.schema_of(
        ("name", T.StringType()), ("temporary", T.StringType()), ("n_records", T.LongType()), ("n_bytes", T.LongType()), ("sha1", T.StringType())
    )
    target = common.arrow_schema(schema)

    def run(batches):
        attempt, open_file, mark, seen = files.attempt_name(), None, None, None
        for b in batches:
            for shard, key, kind, url, payload, digest, first in _rows(b):
                if kind == 0:
                    mark = (key, digest, first, url)
                    continue
                if open_file and (open_file.shard != shard or open_file.size >= layout.file_bytes):
                    yield common.to_batch([open_file.close()], target)
                    open_file = _File(folder, layout, attempt, shard, open_file.number + 1 if open_file.shard == shard else 0)
                if open_file is None:
                    open_file = _File(folder, layout, attempt, shard, 0)
                refers_to = None
                if mark and mark[:2] == (key, digest):
                    # the response itself has a mark too: its first row is the response
                    if mark[2] != key or seen == (key, digest):
                        refers_to = mark[2:]
                    seen = (key, digest)
                open_file.add(response_member(key, url, payload, refers_to, layout))
        if open_file:
            yield common.to_batch([open_file.close()], target)

    written = common.stored(dealt.select(*columns).mapInArrow(run, schema), "warc-manifest")

    def commit(batch):
        for name, temporary, n_records, n_bytes, sha1 in batch:
            files.move_file(folder, temporary, name)
            yield name, n_records, n_bytes, sha1

    committed = common.schema_of(*[f for f in schema if f.name != "temporary"])
    moved = common.arrow_map(written.repartition("name"), commit, committed)
    path = f"{folder}/_manifest"
    moved.write.parquet(path)
    return pages.sparkSession.read.schema(committed).parquet(path)


def _rows(batch: pa.RecordBatch, step: int = 256):
    for start in range(0, batch.num_rows, step):
        yield from zip(*[c.to_pylist() for c in batch.slice(start, step).columns], strict=True)


class _File:
    """A file being written under its temporary name."""

    def __init__(self, folder: str, layout: ArchiveLayout, attempt: str, shard: int, number: int):
        part = "null" if shard < 0 else f"{shard:08d}"
        self.shard, self.number, self.size, self.records = shard, number, 0, 0
        self.name = f"{layout.prefix}-{part}-{number:05d}.warc.gz"
        self.temporary = f"{TEMPORARY}/{attempt}/{self.name}"
        system, root = files.open_folder(folder)
        system.create_dir(f"{root}/{TEMPORARY}/{attempt}", recursive=True)
        self.out, self.sha1 = system.open_output_stream(f"{root}/{self.temporary}", compression=None), hashlib.sha1()
        self._write(_info_member(self.name, layout))

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.sha1.update(member)
        self.size += len(member)

    def add(self, member: bytes) -> None:
        self._write(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return self.name, self.temporary, self.records, self.size, self.sha1.hexdigest()


def read_members(stream):
    """(headers, block) of each record of an archive file, read member by member."""
    with gzip.GzipFile(fileobj=stream) as data:
        while line := data.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/1."):
                raise ValueError("not a WARC record")
            headers = {}
            while (line := data.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
            block = data.read(int(headers["content-length"]))
            yield headers, block


def _bare(digest: str) -> str:
    return digest.removeprefix("sha1:")


def _key_of(uri: str):
    text = uri.strip("<>").removeprefix("urn:x-record:")
    return int(text) if text else None


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record: key, url, record_type, payload_bytes, payload_digest, refers_to, payload (null in revisits).

    Block digests, and payload digests of responses, are computed again and must agree.
    """
    schema = common.schema_of(
        ("key", T.LongType()),
        ("url", T.StringType()),
        ("record_type", T.StringType()),
        ("payload_bytes", T.LongType()),
        ("payload_digest", T.StringType()),
        ("refers_to", T.LongType()),
        ("payload", T.BinaryType()),
    )

    def rows(batch):
        for (name,) in batch:
            with files.read_stream(folder, name) as stream:
                for headers, block in read_members(stream):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"(?im)^Content-Length:\s*(\d+)", http)[1])
                    digest = _bare(headers["warc-payload-digest"])
                    response = headers["warc-type"] == "response"
                    if digest32(block) != _bare(headers["warc-block-digest"]) or response and (
                        digest32(payload) != digest or len(payload) != size
                    ):
                        raise ValueError(f"record {headers['warc-record-id']} of {name} is damaged")
                    refers_to = None if response else _key_of(headers["warc-refers-to"])
                    key, url = _key_of(headers["warc-record-id"]), headers["warc-target-uri"]
                    yield key, url, headers["warc-type"], size, digest, refers_to, payload if response else None

    return common.arrow_map(manifest.select("name").repartition(max(1, manifest.count()), "name"), rows, schema, batch=256)
