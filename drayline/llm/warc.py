"""Web archives: WARC files written and read by Spark, and one index of all captures in order.

Writing.  Captures are stored once, payloads packed, with their digests.  The
first capture of a payload is a ``response`` record, all later ones are
``revisit`` records that name it; which payloads repeat comes from one row a
payload and task.  Records are written by Spark's text writer, which puts the
bytes of a column into files as they are, so its commit protocol holds and any
shared store will do.  An archive is one file of a bounded size: a Zstandard
frame for each record, so that a record can be read alone, and between them
the writer's line end, which is chosen to be an empty skippable frame.

Reading.  Frames are unpacked one by one, records are checked against the
lengths in their headers and payloads against their digests.

Index.  Each archive gives a run of its captures sorted by URL key, time and
place.  A sample of keys cuts the order into ranges; every run is cut at the same
bounds, and each range merges its stretches of all runs through a tree of losers.
The bounds hold the time and the place too, so a URL of any number of captures is
shared by many ranges.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from drayline.session import RunFolder

ARCHIVE_BYTES = 32 << 20
#: Captures in one range of the index, and sampled keys for each range.
RANGE_CAPTURES = 100_000
SAMPLED_PER_RANGE = 32
#: A payload with more captures than this is looked up in a list of such payloads: at most captures / HOT_COPIES rows.
HOT_COPIES = 20_000

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = b"\r\n"
SKIP = b"P*M\x18\0\0\0\0"  # an empty skippable frame


class Malformed(ValueError):
    """An archive that does not hold what its headers say."""


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as archives write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """A key that sorts captures of a site together: host labels reversed, then port, path and query, in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = host.split(".")
    labels = labels[1:] if labels[0] == "www" and len(labels) > 2 else labels
    usual = {"http": 80, "https": 443}.get(parts.scheme.lower())
    place = f":{port}" if port and port != usual else ""
    return f"{','.join(reversed(labels))}{place}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def _plain(value: str) -> str:
    """A header value without line ends or blanks at its ends; such characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), value)


def record(kind: str, identity: str, url: str | None, at: datetime, payload: bytes, digest: str, first: tuple[str, str | None, datetime] | None) -> bytes:
    """One record; a revisit keeps the HTTP head only and names the first capture."""
    stamp = lambda t: t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:capture:{identity}>",
        *([f"WARC-Target-URI: {_plain(url)}"] if url is not None else []),
        f"WARC-Date: {stamp(at)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if first is not None:
        identity, target, date = first
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:capture:{identity}>"]
        lines += [f"WARC-Refers-To-Target-URI: {_plain(target)}"] if target is not None else []
        lines += [f"WARC-Refers-To-Date: {stamp(date)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + EOL + "\r\n".join(lines).encode() + EOL + EOL + block + EOL + EOL


def _headers(data: bytes, at: int) -> tuple[dict[bytes, bytes], int]:
    end = data.find(EOL + EOL, at)
    if end < 0:
        raise Malformed("a record's head does not end")
    lines = data[at:end].split(EOL)
    return {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}, end + 4


def frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each record's frame; the skippable frame after it counts as part of it."""
    unpack, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        end = data.find(SKIP, at)
        while True:
            if end < 0:
                raise Malformed(f"no whole frame begins at {at}")
            try:
                content = unpack.decompress(data[at:end])
                break
            except zstandard.ZstdError:  # the sign may stand inside a frame by chance
                end = data.find(SKIP, end + 1)
        yield at, end + len(SKIP) - at, content
        at = end + len(SKIP)


def parse(data: bytes) -> Iterator[dict]:
    """The records of an archive in their order, with offset and length in it."""
    for at, length, raw in frames(data):
        if not raw.startswith(VERSION + EOL):
            raise Malformed(f"no record begins at {at}")
        head, body = _headers(raw, 0)
        try:
            end = body + int(head[b"content-length"])
            kind, digest = head[b"warc-type"].decode(), head[b"warc-payload-digest"].decode().removeprefix("sha1:")
            inner, payload = _headers(raw, body)
            size = int(inner[b"content-length"])
        except (KeyError, ValueError) as error:
            raise Malformed(f"the record at {at} lacks a header: {error}") from error
        if raw[end:] != EOL + EOL or payload > end:
            raise Malformed(f"the record at {at} does not end where it says")
        if kind == "response" and (end - payload != size or payload_digest(raw[payload:end]) != digest):
            raise Malformed(f"the payload of the record at {at} is damaged")
        name = lambda field: head[field].decode().removeprefix("<urn:capture:").removesuffix(">") if field in head else None  # noqa: B023, E731
        yield {
            "identity": name(b"warc-record-id"), "url": head[b"warc-target-uri"].decode() if b"warc-target-uri" in head else None,
            "at": head[b"warc-date"].decode(), "kind": kind, "digest": digest, "size": size,
            "refers_to": name(b"warc-refers-to"), "offset": at, "length": length,
        }


class LoserTree:
    """Merge of sorted runs: each inner node keeps the run that lost there, the root's run gives the next key."""

    def __init__(self, runs: list[list[bytes]]):
        self.runs = runs
        self.heads = [run[0] if run else None for run in runs]
        self.place = [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        for run in range(len(runs)):
            self._replay(run, building=True)

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` goes first; ended runs go last, ties by number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _replay(self, run: int, building: bool = False) -> None:
        node = (run + len(self.runs)) >> 1
        while node > 0:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = run
                return
            if self._before(other, run):
                self.losers[node], run = run, other
            node >>= 1
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) of all keys in order."""
        while self.runs and self.heads[self.losers[0]] is not None:
            run = self.losers[0]
            at = self.place[run]
            yield run, at
            self.place[run] = at + 1
            self.heads[run] = self.runs[run][at + 1] if at + 1 < len(self.runs[run]) else None
            self._replay(run)


def _stored_captures(pages: DataFrame, run: RunFolder, id_col: str, url_col: str, payload_col: str, time_col: str | None) -> DataFrame:
    """The pages with digests, stored once; ``row`` names each of them from then on."""
    at = F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(F.coalesce(F.col(id_col).cast("long"), F.lit(0)))
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(at, F.timestamp_seconds(F.lit(0))).alias("captured_at"), payload.alias("payload"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor()
        for batch in batches:
            payloads = batch.column(3).to_pylist()
            made = [
                pa.array([hashlib.sha1(x).digest() for x in payloads], pa.binary()),
                pa.array([len(x) for x in payloads], pa.int64()),
                pa.array([small.compress(x) for x in payloads], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=[*names, "digest", "size", "packed"])

    names = ["page_id", "url", "captured_at"]
    schema = T.StructType([*plain.schema.fields[:3], T.StructField("digest", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("packed", T.BinaryType())])
    return run.keep(plain.mapInArrow(pack, schema).withColumn("row", F.monotonically_increasing_id()), "captures")


def mark_revisits(captures: DataFrame, run: RunFolder, least_bytes: int) -> DataFrame:
    """``row`` of each capture whose payload an earlier one has, with that one's id, URL and time.

    Earlier: smaller id, nulls last, then time, URL and stored place.
    """
    known = captures.where(F.col("size") >= least_bytes)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "captured_at", "url", "row")
    groups = known.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    groups = run.keep(groups, "payloads")
    few, many = groups.where(F.col("copies") <= HOT_COPIES), groups.where(F.col("copies") > HOT_COPIES)
    slim = known.select("row", "digest")
    if many.isEmpty():
        found = slim.join(few, "digest")
    else:  # at most rows / HOT_COPIES payloads, each some hundred bytes
        hot = F.broadcast(many)
        found = slim.join(hot, "digest").unionByName(slim.join(hot.select("digest"), "digest", "left_anti").join(few, "digest"))
    return found.where(F.col("row") != F.col("first.row")).select(
        "row", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("page_id", "url", "captured_at")], F.lit(True).alias("revisit")
    )


def write_archives(
    pages: DataFrame,
    run: RunFolder,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    time_col: str | None = None,
    least_bytes: int = 0,
) -> None:
    """Write one record a row below ``path`` as ``archive=<n>/*.txt``, each folder one packed WARC file of about ``ARCHIVE_BYTES``.

    Captures whose payload of at least ``least_bytes`` bytes an earlier capture
    has become revisits.  Null payloads are empty ones, null URLs are left out,
    control characters and blanks in URLs are percent-encoded.  Without
    ``time_col``, or where it is null, a capture's time is its id in seconds.
    A payload has to fit into one task; an archive is at most ``ARCHIVE_BYTES``
    and one record.
    """
    captures = _stored_captures(pages, run, id_col, url_col, payload_col, time_col)
    marks = mark_revisits(captures, run, least_bytes)
    # Rows are dealt by their number, so no payload and no URL gathers in one task.
    joined = captures.join(marks, "row", "left").select(
        "row", "page_id", "url", "captured_at", "packed", "digest", "first_page_id", "first_url", "first_captured_at", "revisit"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
        number, held = None, 0
        for batch in batches:
            made, archives = [], []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row, page, url, at, packed, digest, first, first_url, first_at, again in zip(*columns, strict=True):
                named = lambda x: "" if x is None else str(x)
                origin = (named(first), first_url, first_at) if again else None
                kind = "revisit" if again else "response"
                whole = record(kind, named(page), url, at, unpack.decompress(packed), base64.b32encode(digest).decode(), origin)
                raw = small.compress(whole)
                if number is None or held + len(raw) + len(SKIP) > ARCHIVE_BYTES:
                    number, held = row, 0  # the number of its first row names an archive
                held += len(raw) + len(SKIP)
                made.append(raw)
                archives.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(archives, pa.int64()), pa.array(made, pa.binary())], names=["archive", "raw"])

    records = joined.mapInArrow(build, "archive long, raw binary")
    # The text writer copies bytes; its line end is the skippable frame.
    lines = records.select("archive", F.col("raw").cast("string").alias("value"))
    lines.write.partitionBy("archive").option("lineSep", SKIP.decode()).mode("errorifexists").text(path)


_RECORD = T.StructType(
    [
        T.StructField("url_key", T.StringType()),
        T.StructField("captured_at", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
_ARROW = pa.struct([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in _RECORD])


def _sort_key(entry: dict) -> bytes:
    """Bytes in the order of the index: URL key, time, id, place."""
    page = entry["page_id"]
    place = b"\xff" * 8 if page is None else (page + (1 << 63)).to_bytes(8, "big")
    return b"\0".join([entry["url_key"].encode(), entry["captured_at"].encode(), place + entry["archive"].encode() + entry["offset"].to_bytes(8, "big")])


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Each archive as one sorted run: ``archive``, the sort keys and the entries."""
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("keys", T.ArrayType(T.BinaryType())), T.StructField("entries", T.ArrayType(_RECORD))])
    # Folders are listed by Spark; the path of a file is percent-encoded and serves as a name only.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).load(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                archive = name.rsplit("/", 2)[1].removeprefix("archive=")
                entries = []
                number = lambda x: int(x) if x else None
                for r in parse(content.as_py()):
                    entry = {
                        "url_key": url_key(r["url"]), "captured_at": re.sub(r"\D", "", r["at"]), "page_id": number(r["identity"]), "url": r["url"],
                        "record_type": r["kind"], "payload_digest": r["digest"], "payload_bytes": r["size"], "refers_to": number(r["refers_to"]),
                        "archive": archive, "offset": r["offset"], "length": r["length"],
                    }
                    entries.append((_sort_key(entry), entry))
                entries.sort(key=lambda x: x[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([archive], pa.string()),
                        pa.array([[k for k, _ in entries]], pa.list_(pa.binary())),
                        pa.array([[e for _, e in entries]], pa.list_(_ARROW)),
                    ],
                    names=["archive", "keys", "entries"],
                )

    return files.select("path", "content").mapInArrow(read, schema)


def range_bounds(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> list[bytes]:
    """Keys that cut the order into ranges of about ``range_captures``, from a sample.

    The driver sees ``SAMPLED_PER_RANGE`` keys a range and tasks one a range: at
    5 * 10^9 captures 1.6 million and 50,000 keys.  Any bounds give the right order.
    """
    total = runs.agg(F.sum(F.size("keys"))).first()[0] or 0
    ranges = -(-total // range_captures)
    if ranges <= 1:
        return []
    share = min(1.0, ranges * SAMPLED_PER_RANGE / total)
    drawn = runs.select(F.explode("keys").alias("key")).where(F.rand(5) < share)
    keys = sorted(bytes(r.key) for r in drawn.toLocalIterator())
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)} if keys else ())


def merge_runs(runs: DataFrame, bounds: list[bytes]) -> DataFrame:
    """All captures with ``part`` and ``place``: in their order, captures are sorted by URL key, time, id and place of the record."""
    entry = pa.list_(_ARROW)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, entries = batch.column(1)[i].as_py(), batch.column(2)[i].values
                a = 0
                while a < len(keys):
                    part = bisect_right(bounds, keys[a])
                    b = len(keys) if part == len(bounds) else next_at(keys, bounds[part], a)
                    stretch = entries.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int64()), pa.array([keys[a:b]], pa.list_(pa.binary())), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), stretch).cast(entry)],
                        names=["part", "keys", "entries"],
                    )
                    a = b

    def next_at(keys: list[bytes], bound: bytes, low: int) -> int:
        high = len(keys)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if keys[middle] < bound else (low, middle)
        return low

    def merge(table: pa.Table) -> pa.Table:
        stretches = table.column("keys").to_pylist()
        entries = table.column("entries").combine_chunks()
        entries = entries.chunk(0) if isinstance(entries, pa.ChunkedArray) else entries
        first, at = [], 0
        for keys in stretches:
            first.append(at)
            at += len(keys)
        order = pa.array([first[run] + place for run, place in LoserTree(stretches)], pa.int64())
        merged = entries.flatten().take(order)
        columns = [pa.array([table.column("part")[0].as_py()] * at, pa.int64()), pa.array(range(at), pa.int64()), *merged.flatten()]
        return pa.Table.from_arrays(columns, names=["part", "place", *[f.name for f in _RECORD]])

    shape = T.StructType([T.StructField("part", T.LongType()), T.StructField("keys", T.ArrayType(T.BinaryType())), T.StructField("entries", T.ArrayType(_RECORD))])
    out = T.StructType([T.StructField("part", T.LongType()), T.StructField("place", T.LongType()), *_RECORD])
    return runs.mapInArrow(cut, shape).groupBy("part").applyInArrow(merge, out)


def capture_index(spark: SparkSession, path: str, run: RunFolder, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """Read all archives below ``path`` and give every capture in global order of URL key and time.

    Columns: ``part`` and ``place`` (the order), ``url_key``, ``captured_at``
    (digits of the time), ``page_id``, ``url``, ``record_type``,
    ``payload_digest``, ``payload_bytes``, ``refers_to``, ``archive``, ``offset``,
    ``length``.  Raises ``Malformed`` for damaged archives; no archives give no rows.
    """
    runs = run.keep(capture_runs(spark, path), "runs")
    return merge_runs(runs, range_bounds(runs, range_captures))
