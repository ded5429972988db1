"""WARC archives: round trips, members, index, revisits, damage."""

import glob
import gzip
import hashlib
import json
import zlib

import pytest

from strata.llm import warc
from strata.llm.warc import normalise, page_records, parse_member, read_index, read_records, write_monolithic

LONG = "<p>" + "ab\r\n\r\nWARC/1.1 é " * 400 + "</p>"
ROWS = [
    (1, "http://a/x", LONG),
    (2, "http://a/y", LONG),
    (9, "http://a/z", LONG),
    (3, None, "<p>short"),
    (4, "http://b/\r\nWARC-Type: x y\x7f", "<p>short"),
    (5, "", ""),
    (6, "http://c/é", None),
    (None, "http://d/", LONG),
    (2**60 + 1, "http://e/", "x" * 200_000),
    (7, "u", "y" * 1500),
    (7, "u", "y" * 1500),  # a repeated row
]


@pytest.fixture(scope="module")
def pages(spark):
    # names of the operator's own columns beside the needed ones
    rows = [(*r, "p", 1, "h") for r in ROWS]
    schema = "page_id long, url string, html string, payload string, head int, sha1 string"
    return spark.createDataFrame(rows, schema).repartition(3)


def plain(rows):
    """Page, bytes, digest, type and target by the contract, in Python."""
    texts = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, t in texts:
        heads = [j for j, u in texts if u == t and j is not None]
        revisit = len(t) >= 1000 and heads and (i is None or i < max(heads))
        out.append((i, len(t), hashlib.sha1(t).hexdigest(), "revisit" if revisit else "response", max(heads) if revisit else None))
    return sorted(out, key=repr)


def told(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_round_trip(spark, pages, scratch):
    crawled = write_monolithic(page_records(pages), f"{scratch}/crawl", archive_bytes=20_000)
    files = glob.glob(f"{scratch}/crawl/*.warc.gz")
    assert crawled.count() == len(files) > 3
    for f in files:  # each is one stream
        z = zlib.decompressobj(31)
        z.decompress(open(f, "rb").read())
        assert z.eof and not z.unused_data
    index = read_index(normalise(crawled, f"{scratch}/records"))
    got = read_records(index, payloads=True)
    assert told(got) == plain(ROWS)
    by_id = {r["page_id"]: r for r in got.collect()}
    assert by_id[9]["payload"].decode() == LONG and by_id[1]["payload"] is None
    assert by_id[3]["target_uri"] is None and by_id[5]["target_uri"] == "" and by_id[6]["target_uri"] == "http://c/é"
    assert by_id[4]["target_uri"] == "http://b/%0D%0AWARC-Type:%20x%20y%7F"
    assert by_id[2**60 + 1]["payload_bytes"] == 200_000


def test_members_and_sidecars(spark, pages, scratch):
    done = normalise(write_monolithic(page_records(pages), f"{scratch}/crawl"), f"{scratch}/records").collect()
    n = 0
    for m in done:
        data = open(m["archive"], "rb").read()
        at = 0
        for entry in map(json.loads, open(m["sidecar"])):
            assert entry["offset"] == at
            record = gzip.decompress(data[at : at + entry["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert f"WARC-Record-ID: {entry['id']}".encode() in record
            at += entry["length"]
            n += 1
        assert at == len(data) == m["bytes"]
    assert n == len(ROWS) == sum(m["n_records"] for m in done)


def test_some_records_of_an_index(spark, pages, scratch):
    index = read_index(normalise(write_monolithic(page_records(pages), f"{scratch}/crawl"), f"{scratch}/records"))
    assert [r["page_id"] for r in read_records(index.filter("target = 'http://a/z'")).collect()] == [9]


@pytest.mark.parametrize("form", ["plain", "members", "padded"])
def test_other_archives(spark, scratch, form):
    """Archives not written here: plain, cut into members, zeros between, bare block types."""
    heads = [b"WARC/1.0\r\nwarc-type: metadata\r\nWARC-Record-ID: <urn:a>\r\nX: 1\r\n folded\r\nCONTENT-LENGTH: %d\r\n\r\n" % n for n in (0, 5, 3 << 20)]
    blocks = [b"", b"\r\n\r\nx", b"q" * (3 << 20)]
    records = [h + b + b"\r\n\r\n" for h, b in zip(heads, blocks, strict=True)]
    data = {
        "plain": b"".join(records),
        "members": b"".join(map(gzip.compress, records)),
        "padded": b"\0\0".join(map(gzip.compress, records)) + b"\0" * 9,
    }[form]
    open(f"{scratch}/in.warc.gz", "wb").write(data)
    manifest = normalise(spark.createDataFrame([(f"{scratch}/in.warc.gz",)], "archive string"), f"{scratch}/out")
    out = open(manifest.first()["archive"], "rb").read()
    entries = sorted(read_index(manifest).collect(), key=lambda r: r["offset"])
    assert [e["type"] for e in entries] == ["metadata"] * 3
    back = [parse_member(out[e["offset"] : e["offset"] + e["length"]]) for e in entries]
    assert [b for _, b in back] == blocks and back[0][0]["x"] == "1 folded"


@pytest.mark.parametrize("cut", ["end", "flip", "length"])
def test_damage_raises(spark, pages, scratch, cut):
    crawled = write_monolithic(page_records(pages.coalesce(1)), f"{scratch}/crawl")
    path = crawled.first()["archive"]
    data = bytearray(open(path, "rb").read())
    if cut == "end":
        data = data[:-20]
    elif cut == "flip":
        data[len(data) // 2] ^= 0xFF
    else:
        data = gzip.compress(gzip.decompress(bytes(data)).replace(b"Content-Length: ", b"Content-Length: 9", 1))
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        read_records(read_index(normalise(crawled, f"{scratch}/records"))).collect()


def test_bounded_inflation():
    """A stream that inflates a thousandfold comes in bounded pieces."""
    packed = gzip.compress(b"\0" * (50 << 20))
    sizes = [len(p) for p in warc.inflated(warc._Held(packed))]
    assert sum(sizes) == 50 << 20 and max(sizes) <= warc.CHUNK
