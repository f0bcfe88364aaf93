import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerlens.llm import archives
from ledgerlens.llm.archives import DICTIONARY_FRAME, _file_system, _kind, dictionary, read_archives, records, write_archives
from ledgerlens.sources.files import work_folder

SCHEMA = "page_id long, url string, html string, payload string, keeper long, sha1 string, URL string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "s", "u") for r in rows], SCHEMA)


ODD = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>one</p>"),
    (3, "http://c/ä b\r\nX: y", "<p>zwei ä 🙂</p>"),
    (4, None, None),
    (5, "http://d/", ""),
    (6, "http://e/", "long " * 200_000),
    (7, "http://f/", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"),
    (8, "http://g/", "<p>zwei ä 🙂</p>"),
    (8, "http://g/", "<p>zwei ä 🙂</p>"),
    (None, "http://h/", "<p>one</p>"),
    (None, "http://i/", "alone"),
    (None, "http://i/", "alone"),
]


def expected(rows, least):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        keeper = max(same) if same and len(payload) >= least else page_id
        name = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = page_id != keeper
        out.append((page_id, len(payload), name, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, least):
    archives = write_archives(pages(spark, ODD).repartition(3), work_folder(spark, "warc"), least)
    found = read_archives(archives)
    rows = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(str(tuple(r)) for r in rows) == expected(ODD, least)
    for r in found.where("record_type = 'response'").collect():
        assert len(r["payload"]) == r["payload_bytes"]
        if r["page_id"] is not None:
            assert bytes(r["payload"]).decode() in [html or "" for i, _, html in ODD if i == r["page_id"]]
    assert found.where("record_type = 'revisit' and payload is not null").count() == 0
    assert archives.agg(F.sum("records")).first()[0] == len(ODD)


def test_addresses_and_names_of_records(spark):
    folder = work_folder(spark, "warc")
    first = write_archives(pages(spark, ODD).coalesce(1), folder)
    assert {r["url"] for r in read_archives(first).collect()} == {u for _, u, _ in ODD}

    def blocks(of):
        store, at = _file_system(of.where("records > 0").first()["path"])
        with store.open_input_stream(at) as stream:
            return list(records(stream))

    found = blocks(first)
    named = {f["WARC-Record-ID"]: f for f, _ in found}
    for fields, _ in found:
        if fields["WARC-Type"] == "revisit":
            of = named[fields["WARC-Refers-To"]]
            assert of["WARC-Type"] == "response" and of["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"] and of["Page-ID"] == fields["Page-Refers-To"]
    # a rerun writes the same records
    again = blocks(write_archives(pages(spark, ODD).coalesce(1), work_folder(spark, "warc")))
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_dictionary_sample_is_bounded(spark, monkeypatch):
    """Equal payloads count once, and of a long one a part is taken."""
    taken = []
    monkeypatch.setattr(archives, "dictionary", lambda some: (taken.extend(some), b"")[1])
    monkeypatch.setattr(archives, "SAMPLE_BYTES", 1000)
    rows = [(i, "http://x/", "the same page " * 50) for i in range(3000)] + [(5000 + i, "http://y/", f"{i} " * 2000) for i in range(5)]
    write_archives(pages(spark, rows), work_folder(spark, "warc"))
    assert 1 <= len(taken) <= 6 and all(len(t) < 2000 and t.startswith(b"WARC/1.1") for t in taken)


def test_no_pages(spark):
    archives = write_archives(pages(spark, []), work_folder(spark, "warc"))
    assert read_archives(archives).count() == 0


def test_each_record_is_a_frame_behind_the_dictionary(spark):
    rows = [(i, f"http://x/{i}", f"<html><body><p>page number {i} of many that look alike</p></body></html>" * 20) for i in range(300)]
    archives = write_archives(pages(spark, rows).coalesce(1), work_folder(spark, "warc"))
    path = archives.where("records > 0").first()["path"]
    store, at = _file_system(path)
    with store.open_input_stream(at) as f:
        data = f.read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == DICTIONARY_FRAME
    content, rest = data[8 : 8 + size], data[8 + size :]
    frames = 0
    while rest:
        out = zstandard.ZstdDecompressor(dict_data=_kind(content)).decompressobj()
        assert out.decompress(rest).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
        rest, frames = out.unused_data, frames + 1
    assert frames == 300
    plain = sum(len(zstandard.ZstdCompressor(level=6).compress(r[2].encode())) for r in rows)
    assert len(data) - 8 - size < plain + 300 * 300


def test_dictionary_of_few_records():
    assert dictionary([]) == b""
    assert dictionary([b"abc", b""]) == b"abc"
    assert len(dictionary([b"some payload %d" % (i * 7919) * 30 for i in range(200)])) > 0
