"""WARC archives: writing, and reading by boundary-chain verification.

*Writing.*  One record per page: a ``response`` with an HTTP block, or a
``revisit`` (HTTP head only, ``WARC-Refers-To``) of the page with the smallest id
among those with an equal payload of at least ``min_bytes`` bytes.  Spark's text
sink writes them: the record separator (two CRLF) is its line separator, so
files come from its commit protocol and any file system will do.

*Reading.*  The text source cuts the files at the magic ``WARC/1.1`` CRLF; its
splits run in parallel and nothing reads a whole file at once.  A cut may be a
record's start or magic inside a payload.  Each task emits its candidates with the
offset of the successor that their Content-Length names, already followed up to
the end of the split; pointer jumping from offset 0 of each file over these
exits finds the one entry of each split that is reachable, and from there the
records of the split are walked.  What is not reachable is payload.  Records
that hold magic are put together from their segments in a second pass.

Defined results: a null payload is empty; a null id is kept as null and counts after
all others as an original; rows with equal id and payload are records of their own
and all of the smallest id are responses; ids may be any text; an empty table
gives no record; a chain that does not reach the file's end raises an error.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b32encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.session import ensure_checkpoint_dir, scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 100_000
BROADCAST = 32 << 20     # bytes


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits (five hex digits) make four characters."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("<urn:page:"), F.url_encode(c.cast("string")), F.lit(">")),
                      F.lit("<urn:nopage>"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """One column ``value``: the text of each page's record without the closing END."""
    ensure_checkpoint_dir(pages.sparkSession)
    own = pages.select(
        F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload")) \
        .withColumn("digest", base32_sha1(F.col("payload").cast("binary"))) \
        .withColumn("size", F.octet_length("payload"))
    first = own.select("digest", "size", "id").where(F.col("size") >= min_bytes) \
        .groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n")) \
        .where("n > 1").select("digest", "first_id").checkpoint()
    # Only repeated payloads are looked up; counted, they may go to the pages instead of the pages to them.
    if first.count() * 128 <= BROADCAST:
        first = F.broadcast(first)
    own = own.join(first, "digest", "left") \
        .withColumn("again", (F.col("size") >= min_bytes) & F.col("first_id").isNotNull()
                    & ~F.col("id").eqNullSafe(F.col("first_id")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A"), " ", "%20")
    block = F.octet_length(http) + F.when(F.col("again"), 0).otherwise(F.col("size"))
    return own.select(F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("again"), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: "), _urn(F.col("first_id")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit(END), http,
        F.when(F.col("again"), "").otherwise(F.col("payload"))).alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, **names) -> None:
    records(pages, **names).write.option("lineSep", END) \
        .option("maxRecordsPerFile", records_per_file).text(path)


_FIELD = re.compile(rb"(?im)^(warc-type|warc-record-id|warc-refers-to|warc-payload-digest|"
                    rb"warc-target-uri|content-length|content-type):[ \t]*(.*?)[ \t]*\r?$")


def _head(segment: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of a record's head behind the magic, and its fields; None: not a head."""
    at = segment.find(b"\r\n\r\n")
    if at < 0:
        return None
    fields = {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(segment[:at])}
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return at + 4, fields


def _payload(block: bytes, fields: dict[str, str]) -> tuple[int, str]:
    """Length and digest of a record's full payload; a revisit's head names both."""
    body = block
    if fields.get("content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n")
        body = block[at + 4:] if at >= 0 else block
        if fields["warc-type"] == "revisit":
            named = re.search(rb"(?im)^content-length:[ \t]*(\d+)", block)
            return (int(named[1]) if named else len(body)), fields.get("warc-payload-digest", "")[5:]
    digest = b32encode(hashlib.sha1(body).digest()).decode()
    named = fields.get("warc-payload-digest", "")
    if named.startswith("sha1:") and named[5:] != digest:
        digest = ""                          # damaged, or cut by magic: see _whole
    return len(body), digest


FIELDS = ["warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri"]
CANDIDATES = ("file string, block long, size long, rel long, next_rel long, exit_rel long, "
              "within boolean, type string, record_id string, refers_to string, uri string, "
              "payload_bytes long, payload_digest string")


def _split_rows(file: str, block: int, segments: list[bytes], opens: bool):
    """Candidates of one split.  ``opens``: its first segment is the file's start, before any magic."""
    size = len(MAGIC)
    # A segment that follows a cut has the magic before it; the offsets count from the
    # first byte that this split reads.
    rows, at = [], 0
    for k, segment in enumerate(segments):
        start = at if not (opens and k == 0) else None
        if opens and k == 0:
            if segment:
                raise ValueError(f"{file} does not begin with {MAGIC.strip()}")
            continue
        at += size + len(segment)
        head = _head(segment)
        if head is None:
            continue
        length = head[0] + int(head[1]["content-length"])
        block_bytes = segment[head[0]:length]
        whole = len(segment) >= length
        n, digest = _payload(block_bytes, head[1]) if whole else (None, None)
        rows.append([start, start + size + length + len(END), whole, head[1], n, digest])
    known = {r[0]: r for r in rows}
    exits: dict[int, int] = {}
    for r in reversed(rows):                 # a successor has a larger offset
        exits[r[0]] = exits.get(r[1]) if r[1] in known else (r[1] if r[1] >= at else None)
    for start, after, whole, fields, n, digest in rows:
        yield (file, block, at, start, after, exits[start], whole,
               *(fields.get(f) for f in FIELDS), n, digest)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]])
                       for c in CANDIDATES.split(", ")])

    def out(split):
        rows = list(_split_rows(*split))
        if not rows:                         # a split without candidates still takes up room
            size = sum(len(MAGIC) + len(s) for s in split[2][split[3]:])
            rows = [(split[0], split[1], size, *[None] * 10)]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), kinds.types)], schema=kinds)

    split = None
    for batch in batches:
        for file, block, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if split is None or split[:2] != (file, block):
                if split:
                    yield out(split)
                split = (file, block, [], block == 0)
            split[2].append(value)
    if split:
        yield out(split)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _reachable_entries(found: DataFrame) -> DataFrame:
    """(file, block, entry): the reachable first record of each split, by pointer jumping."""
    splits = found.select("file", "block", "size").distinct()
    base = F.coalesce(F.sum("size").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("base", base)
    nodes = found.where("rel is not null").join(splits.drop("size"), ["file", "block"]) \
        .select("file", "block", (F.col("base") + F.col("rel")).alias("at"),
                (F.col("base") + F.col("exit_rel")).alias("to"), "base")
    exits = nodes.where("to is not null").select("file", F.col("to").alias("at")).distinct()
    # Only what some split's chain leads to, and the files' starts, can be an entry.
    nodes = nodes.join(exits, ["file", "at"], "left_semi") \
        .unionByName(nodes.where("at = 0")).checkpoint()
    reached = nodes.where("at = 0").select("file", "at")
    jump = nodes.select("file", "at", "to")
    n = reached.count()
    while True:
        further = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = reached.unionByName(further).distinct().checkpoint()
        m = reached.count()
        if m == n:
            break
        n = m
        # Pointers twice as far: where the one I point to points.
        hop = jump.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jump = jump.join(hop, ["file", "to"]).select("file", "at", F.col("far").alias("to")).checkpoint()
    ends = splits.groupBy("file").agg(F.sum("size").alias("at"))
    lost = ends.join(reached, ["file", "at"], "left_anti")
    broken = lost.where("at > 0").first()
    if broken:
        raise ValueError(f"the records of {broken['file']} do not reach its end at {broken['at']}")
    return nodes.join(reached, ["file", "at"], "left_semi") \
        .select("file", "block", (F.col("at") - F.col("base")).alias("entry"), "base").distinct()


def _walk(rows):
    """The records of one split that follow each other from its entry."""
    after = dict(zip(rows["rel"], rows["next_rel"]))
    keep, at = set(), rows["entry"].iloc[0]
    while at in after:
        keep.add(at)
        at = after[at]
    return rows[rows["rel"].isin(keep)]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Columns ``file``, ``offset``, ``type``, ``record_id``, ``refers_to`` (urns), ``uri``,
    ``payload_bytes``, ``payload_digest`` (both of the full payload), one row a record."""
    ensure_checkpoint_dir(spark)
    found = _segments(spark, path).mapInArrow(_candidates, CANDIDATES).checkpoint()
    entries = _reachable_entries(found)
    walked = found.where("rel is not null").join(entries, ["file", "block"])
    kept = walked.groupBy("file", "block").applyInPandas(
        lambda rows: _walk(rows), CANDIDATES + ", entry long, base long") \
        .withColumn("offset", F.col("base") + F.col("rel")).checkpoint()
    out = ["file", "offset", "type", "record_id", "refers_to", "uri", "payload_bytes", "payload_digest"]
    parts = kept.where(~F.col("within"))
    if parts.isEmpty():
        return kept.select(*out)
    return kept.where("within").select(*out).unionByName(_whole(spark, path, found, parts).select(*out))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests = [], []
        for segments in batch.column("segments").to_pylist():
            whole = MAGIC.encode().join(s["value"] for s in sorted(segments, key=lambda s: s["at"]))
            length, fields = _head(whole)
            n, digest = _payload(whole[length:length + int(fields["content-length"])], fields)
            sizes.append(n)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("offset"), pa.array(sizes, pa.int64()),
             pa.array(digests, pa.string())], names=["file", "offset", "payload_bytes", "payload_digest"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their offset from the start of the split."""
    last, at = None, 0
    for batch in batches:
        files, blocks, values = (batch.column(k).to_pylist() for k in range(3))
        rels = []
        for file, block, value in zip(files, blocks, values):
            if (file, block) != last:
                last, at = (file, block), (-len(MAGIC) if block == 0 else 0)
            rels.append(at)
            at += len(MAGIC) + len(value)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(rels, pa.int64())],
                                         names=["file", "block", "value", "rel"])


def _whole(spark: SparkSession, path: str, found: DataFrame, parts: DataFrame) -> DataFrame:
    """The records that hold magic, put together; a group is the segments of one record."""
    splits = found.select("file", "block", "size").distinct().withColumn("base", F.coalesce(F.sum("size").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    spans = parts.select("file", F.col("offset").alias("at"), F.col("offset").alias("owner"),
                         (F.col("base") + F.col("next_rel")).alias("stop"))
    segments = _segments(spark, path).mapInArrow(
        _placed, "file string, block long, value binary, rel long") \
        .join(spans.select("file").distinct(), "file", "left_semi").join(splits, ["file", "block"]) \
        .select("file", (F.col("base") + F.col("rel")).alias("at"), "value").where("at >= 0")
    # A segment belongs to the last record that starts at or before it, up to that record's end;
    # the window holds offsets only.
    none = F.lit(None).cast("long")
    before = Window.partitionBy("file").orderBy("at", F.col("owner").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    owned = segments.select("file", "at", none.alias("owner"), none.alias("stop")).unionByName(spans) \
        .select("file", "at", "owner", F.last("owner", ignorenulls=True).over(before).alias("offset"),
                F.last("stop", ignorenulls=True).over(before).alias("end")) \
        .where(F.col("owner").isNull() & (F.col("at") < F.col("end"))).select("file", "at", "offset")
    whole = segments.join(owned, ["file", "at"]) \
        .groupBy("file", "offset").agg(F.collect_list(F.struct("at", "value")).alias("segments")) \
        .mapInArrow(_joined, "file string, offset long, payload_bytes long, payload_digest string")
    return parts.drop("payload_bytes", "payload_digest").join(whole, ["file", "offset"])


def page_id(urn: Column) -> Column:
    """The id that a record's urn names; null for the urn of no page."""
    return F.url_decode(F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")))


def round_trip(pages: DataFrame, path: str | None = None, **names) -> DataFrame:
    """Writes the pages' records below ``path`` (by default a fresh shared folder) and reads them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(pages, path, **names)
    return read(spark, path)
