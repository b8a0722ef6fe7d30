"""Archives against a plain account of their captures, and the merge against sorting."""

import base64
import collections
import hashlib
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
import zstandard

from drayline.llm import warc
from drayline.llm.warc import LoserTree, Malformed, capture_index, parse, record, url_key, write_archives
from drayline.session import RunFolder

SCHEMA = "page_id long, url string, html string"


def brute(rows, least=0):
    first = {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault((html or "").encode(), page)
    out, told = [], set()
    for page, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= least and (first[raw] != page or (raw, page) in told)
        told.add((raw, page))
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[raw] if again else None))
    return collections.Counter(out)


def round_trip(spark, run, rows, name, ranges=warc.RANGE_CAPTURES, **options):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_archives(pages, run, f"{run.path}/{name}", **options)
    return capture_index(spark, f"{run.path}/{name}", run, ranges)


def pages(seed, n=80):
    rnd = random.Random(seed)
    bodies = ["", "x", "<p>é漢</p>", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb", "\r\n", *["page " * k for k in range(12)]]
    urls = [None, "", "http://www.b.example/x?q=1", "https://a.example:443/Y", "http://a.example:81/", "no url at all", "http://a.example/with blank\r\nand line", "http://[bad", "HTTP://C.example"]
    return [(i, rnd.choice(urls), rnd.choice([None, *bodies])) for i in rnd.sample(range(1000), n)]


@pytest.mark.parametrize("archive_bytes,hot,least", [(32 << 20, 20_000, 0), (1500, 3, 0), (1, 3, 20)])
def test_against_brute_force(spark, run, monkeypatch, archive_bytes, hot, least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    monkeypatch.setattr(warc, "HOT_COPIES", hot)
    rows = pages(archive_bytes)
    rows += [(None, "http://n.example/", "nobody"), (None, "http://n.example/", "nobody"), (2000, None, "twice"), (2000, None, "twice")]
    got = round_trip(spark, run, rows, "archives", 13, least_bytes=least).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(rows, least)
    ordered = sorted(got, key=lambda r: (r.part, r.place))
    keys = [warc._sort_key(r.asDict()) for r in ordered]
    assert keys == sorted(keys) and len({r.part for r in got}) > 3
    files = {p.parent.name.removeprefix("archive="): p.read_bytes() for p in Path(f"{run.path}/archives").glob("*/*.txt")}
    assert len(files) == len({r.archive for r in got}) and sum(map(len, files.values())) == sum(r.length for r in got)
    for r in got:  # every index entry finds its record
        held = list(parse(files[r.archive][r.offset : r.offset + r.length]))
        assert [(x["kind"], x["digest"], x["size"]) for x in held] == [(r.record_type, r.payload_digest, r.payload_bytes)]


def test_one_url_is_cut_by_time(spark, run):
    rows = [(i, "http://one.example/", f"body {i % 7}") for i in range(300)]
    got = round_trip(spark, run, rows, "one", 20).orderBy("part", "place").collect()
    assert [r.page_id for r in got] == list(range(300)) and len({r.part for r in got}) > 8


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16])
def test_loser_tree(runs):
    rnd = random.Random(runs)
    lists = [sorted(bytes([rnd.randrange(40)]) for _ in range(rnd.choice([0, 1, 30]))) for _ in range(runs)]
    merged = [lists[r][i] for r, i in LoserTree(lists)]
    assert merged == sorted(x for y in lists for x in y)
    assert sorted(LoserTree(lists)) == [(r, i) for r, x in enumerate(lists) for i in range(len(x))]


def test_url_keys():
    assert url_key("https://www.Example.com/A?b=C") == "com,example)/a?b=c"
    assert url_key("http://example.com:80") == "com,example)/" and url_key("http://example.com:81") == "com,example:81)/"
    assert url_key(None) == url_key("") == "" and url_key(" Odd ") == "odd" and url_key("http://[x") == "http://[x"


def test_damage_is_noticed():
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    good = record("response", "1", "http://a/", at, b"payload", warc.payload_digest(b"payload"), None)
    framed = lambda raw: zstandard.ZstdCompressor().compress(raw) + warc.SKIP
    whole = framed(good)
    assert [r["size"] for r in parse(whole + whole)] == [7, 7] and list(parse(b"")) == []
    for bad in (good[1:], good[:-1], good.replace(b"payload", b"pAyload"), good.replace(b"WARC-Type", b"WARC-Tipe"), good.replace(b"Content-Length: 7", b"Content-Length: 8"), good[:40]):
        with pytest.raises(Malformed):
            list(parse(framed(bad)))
    for bad in (whole[1:], whole[:-1], whole[:-9] + whole[-8:], whole + b"x"):
        with pytest.raises(Malformed):
            list(parse(bad))


def test_the_sign_between_frames_may_stand_inside():
    rnd = random.Random(1)
    at, noise = datetime(2024, 1, 1, tzinfo=timezone.utc), bytes(rnd.randrange(256) for _ in range(500)) + warc.SKIP * 3
    raw = zstandard.ZstdCompressor().compress(record("response", "1", None, at, noise, warc.payload_digest(noise), None)) + warc.SKIP
    assert raw.count(warc.SKIP) >= 2 and [r["size"] for r in parse(raw + raw)] == [len(noise)] * 2
    assert zstandard.ZstdDecompressor().stream_reader(raw + raw, read_across_frames=True).read().count(b"WARC/1.1") == 2


def test_time_column_and_clashing_names(spark, run):
    rows = [(1, "u", "same", datetime(2024, 5, 1), 1), (2, "u", "same", None, 2), (3, "u", "x" * 200_000, datetime(2024, 4, 1), 3)]
    docs = spark.createDataFrame(rows, "row long, archive string, digest string, size timestamp, page_id long")
    write_archives(docs, run, f"{run.path}/clash", "row", "archive", "digest", "size")
    got = capture_index(spark, f"{run.path}/clash", run).orderBy("part", "place").collect()
    assert [(r.page_id, r.captured_at[:8], r.record_type, r.refers_to) for r in got] == [(2, "19700101", "revisit", 1), (3, "20240401", "response", None), (1, "20240501", "response", None)]


def test_empty_table(spark):
    run = RunFolder(spark, "test")
    assert round_trip(spark, run, [], "none").collect() == []
    run.close()
