"""WARC archives: round trips, independent reading of the bytes, every check of the reader, and odd rows."""
import base64
import hashlib
import io
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from adherence.llm import warc as W
from adherence.llm.base import table


def plain(rows, least=0):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of (page_id, html), plainly."""
    groups = {}
    for page_id, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, html in rows:
        payload, ids = (html or "").encode(), [i for i in groups[html or ""] if i is not None]
        again = len(payload) >= least and ids and page_id != min(ids)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=repr)


def through(spark, pages, path, least=0, roll=W.ROLL):
    W.write_archives(W.page_records(pages, least=least), path, roll)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    got = W.read_archives(spark, path).where("record_type <> 'warcinfo'")
    return got.withColumns({"page_id": page("record_id"), "first": page("refers_to")})


def digest_rows(got):
    return sorted((tuple(r) for r in got.select("page_id", "payload_length", "payload_digest", "record_type", "first").collect()), key=repr)


def test_whole_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = W.op13_warc(spark, sf_dir)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain([(r.page_id, r.html) for r in pages.collect()])


def test_round_trip_with_copies_and_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", rng.choice(["", None, "copy ü", "x" * 700, f"own {i} " * rng.randint(0, 300)]), "extra") for i in range(400)]
    rows += [(None, None, "copy ü", None), (None, "a\r\nb", "no id at all", None), (7, rows[7][1], rows[7][2], "extra"), (900, "u", "\r\n\r\nWARC/1.1\r\n" * 5, "x"), (901, "u", "long" * 1_500_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(5)
    got = through(spark, pages, f"{tmp_path}/a", roll=20_000).cache()
    assert digest_rows(got) == plain([(r[0], r[2]) for r in rows])
    assert got.select("archive").distinct().count() > 5
    held = {r.page_id: bytes(r.payload).decode() for r in got.where("record_type = 'response' and page_id is not null").collect()}
    assert all(held[i] == (html or "") for i, _, html, _ in rows if i in held) and held[901] == "long" * 1_500_000
    uris = {r.target_uri for r in got.collect()}
    assert "a%0D%0Ab" in uris and None in uris


def test_small_payloads_are_responses_and_empty_tables(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (5, "u", None), (6, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert digest_rows(through(spark, pages, f"{tmp_path}/a", least=3)) == plain([(r[0], r[2]) for r in rows], 3)
    assert through(spark, pages.where("false"), f"{tmp_path}/b").count() == 0


def test_salted_join_gives_the_same(spark, tmp_path, monkeypatch):
    rows = [(i, "u", "hot" if i % 3 else f"own {i % 20}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(W, "BROADCAST_PAYLOADS", 0)
    assert digest_rows(through(spark, pages, f"{tmp_path}/a")) == plain([(r[0], r[2]) for r in rows])


def test_bytes_of_an_archive_read_independently(spark, tmp_path):
    """Leading dictionary frame, then a frame a record, by the format and not by our reader."""
    rows = [(i, f"http://h/{i}", f"<p>page {i} of a site with much in common {i * i}</p>" * 40) for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    W.write_archives(W.page_records(pages), f"{tmp_path}/a")
    (path,) = (tmp_path / "a").glob("*.warc.zst")
    data = path.read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size], max_output_size=1 << 20))
    data, records = data[8 + size:], []
    while data:
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        records.append(one.decompress(data))
        data = one.unused_data
    assert len(records) == 501 and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    for r in records:
        head, _, rest = r.partition(b"\r\n\r\n")
        assert int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]) == len(rest) - 4


RECORDS = [W.record_bytes(f"<urn:page:{i}>", "response", "2020-01-01T00:00:00Z", f"payload {i} ".encode() * 30, "http://h/") for i in range(40)]


def archive(records=RECORDS, dictionary=None, plain_dictionary=False, between=b""):
    out = b""
    if dictionary:
        content = dictionary.as_bytes()
        content = content if plain_dictionary else zstandard.ZstdCompressor().compress(content)
        out = W.DICTIONARY_MAGIC.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    compressor = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return out + between.join(compressor.compress(r) for r in records)


def read(data, permissive=False):
    return list(W.records(io.BytesIO(data), "a", permissive))


def trained():
    return zstandard.train_dictionary(4096, [f"payload {i} of many with words {i * 7}".encode() * 20 for i in range(300)])


@pytest.mark.parametrize("plain_dictionary", [True, False])
def test_dictionary_compressed_or_plain_and_skippable_frames_between(plain_dictionary):
    skip = 0x184D2A50.to_bytes(4, "little") + (W.CHUNK * 3 + 5).to_bytes(4, "little") + b"s" * (W.CHUNK * 3 + 5)
    rows = read(archive(dictionary=trained(), plain_dictionary=plain_dictionary, between=skip))
    assert [r["record_id"] for r in rows] == [f"<urn:page:{i}>" for i in range(40)]
    assert read(b"") == []


def test_frames_longer_than_a_chunk():
    big = random.Random(2).randbytes(W.CHUNK * 3)
    data = archive([RECORDS[0], W.record_bytes("<b>", "response", "2020", big), *RECORDS[1:]])
    assert [len(r["payload"]) for r in read(data)][1] == len(big) and len(read(data)) == 41


def broken(**change):
    r = RECORDS[0]
    for old, new in change.values():
        assert old in r
        r = r.replace(old, new)
    return r


@pytest.mark.parametrize("record, says", [
    (broken(x=(b"WARC/1.1", b"WARC/9.9")), "version"),
    (broken(x=(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b"")), "warc-date"),
    (broken(x=(b"WARC-Type: response\r\n", b"no colon\r\n")), "header line"),
    (RECORDS[0][:-1], "bytes and not"),
    (RECORDS[0] + b"x", "bytes and not"),
    (broken(x=(b"payload 0 payload", b"payload 1 payload")), "digest"),
    (re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: 1\r\n\r\nHTTP", RECORDS[0]), "bytes and not"),
    (re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: -1\r\n\r\nHTTP", RECORDS[0]), "no number"),
    (W.record_bytes("<a>", "revisit", "2020", b"x", None, "<b>").replace(b"WARC-Refers-To: <b>\r\n", b""), "refers"),
    (W.record_bytes("<a>", "revisit", "2020", b"x", None, "<b>").replace(b"WARC-Payload-Digest", b"X-Other"), "digest"),
    (b"", "version"),
])
def test_checks_of_records(record, says):
    data = archive([RECORDS[0], record, RECORDS[1]])
    with pytest.raises(W.WarcError, match=says):
        read(data)
    rows = read(data, permissive=True)
    assert [bool(r["error"]) for r in rows] == [False, True, False]


def test_broken_frames_in_permissive_mode():
    compressor = zstandard.ZstdCompressor(write_checksum=True)
    good = [compressor.compress(r) for r in RECORDS[:6]]
    hurt = bytearray(good[2])
    hurt[len(hurt) // 2] ^= 0xFF
    data = b"".join([*good[:2], bytes(hurt), good[3], b"rubbish", good[4], good[5][:-9]])
    with pytest.raises(W.WarcError):
        read(data)
    rows = read(data, permissive=True)
    assert [r["record_id"] for r in rows if not r["error"]] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    assert [r["place"] for r in rows if r["error"]][0] == sum(map(len, good[:2])) and sum(1 for r in rows if r["error"]) == 3


def test_what_no_manifest_names_is_not_read(spark, tmp_path):
    rows = [(i, "u", f"text {i}") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    W.write_archives(W.page_records(pages), f"{tmp_path}/a")
    (tmp_path / "a" / "part-left.warc.zst").write_bytes(b"what a killed task left")
    assert W.read_archives(spark, f"{tmp_path}/a").where("record_type = 'response'").count() == 30
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "foreign.warc.zst").write_bytes(archive(dictionary=trained()) + b"rubbish")
    got = W.read_archives(spark, f"{tmp_path}/b", mode="PERMISSIVE", payload=False)
    assert got.where("error is null").count() == 40 and got.where("error is not null and payload is null").count() == 1
