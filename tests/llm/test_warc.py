import base64
import hashlib

import pytest
import zstandard

from facetry.llm import warc

ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/\r\nX-Evil: 1", ""), (4, "http://é/", None),
    (5, "u", "é" * 200_000), (None, "n", "<p>one</p>"), (None, "n", "own"), (6, "http://c", "x" * 2_000_000), (1, "http://a/", "<p>one</p>"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    got = warc.read_archives(warc.write_archives(frame(spark, ROWS), archive_bytes=1000)).collect()
    assert len(got) == len(ROWS) and not any(r["error"] for r in got)
    want = []
    for page, url, html in ROWS:
        first = min((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None), default=None)
        revisit = first is not None and page != first
        want.append((page or 0, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(repr, want)) == sorted(
        repr((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got
    )
    texts = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bytes(texts[5]).decode() == "é" * 200_000 and bytes(texts[3]) == b""
    assert {r["uri"] for r in got if r["page_id"] == 3} == {"http://b/%0D%0AX-Evil:%201"}


def test_small_payloads_are_never_revisits(spark):
    rows = [(i, "u", "ab" if i < 3 else "abcdef") for i in range(6)]
    got = warc.read_archives(warc.write_archives(frame(spark, rows), min_bytes=3)).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got if r["record_type"] == "revisit") == [(4, "revisit"), (5, "revisit")]


def test_empty_table(spark):
    archives = warc.write_archives(frame(spark, []))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_files(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "text " * i) for i in range(200)]
    n = warc.export_files(warc.write_archives(frame(spark, rows), archive_bytes=2000), str(tmp_path))
    assert n == len(list(tmp_path.glob("*.warc.zst"))) > 1
    got = warc.read_files(spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(i, 5 * i) for i in range(200)]


def archive(records, dictionary=b"", packed=False, **options):
    lead = dictionary
    if packed:
        lead = zstandard.ZstdCompressor().compress(dictionary)
    used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    coder = zstandard.ZstdCompressor(dict_data=used, **options)
    return warc.leading_frame(lead) + b"".join(coder.compress(r) for r in records)


RECORDS = [warc.make_record(i, f"u{i}", bytes([65 + i]) * 300_000 if i == 1 else b"payload %d" % i, None, False) for i in range(4)]


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_raw_or_compressed(packed):
    made = archive(RECORDS, b"WARC/1.1 Content-Length payload " * 20, packed)
    assert [r["page_id"] for r in warc.read_archive(made)] == [0, 1, 2, 3]
    assert [r["page_id"] for r in warc.read_archive(archive(RECORDS, write_checksum=True))] == [0, 1, 2, 3]
    assert list(warc.read_archive(b"")) == []


def test_damage_is_told_and_the_rest_is_read():
    bad = [
        RECORDS[0].replace(b"payload 0", b"paYload 0"),
        RECORDS[2].replace(b"WARC/1.1", b"WARC/9.1"),
        RECORDS[2].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 1", 1),
        RECORDS[2].replace(b"WARC-Date", b"WARC Date:x\r\n-"),
        RECORDS[2] + RECORDS[3],  # two records in one frame
        RECORDS[2][:-1],
        b"",
    ]
    for record in bad:
        found = list(warc.read_archive(archive([RECORDS[0], record, RECORDS[3]])))
        assert [r["error"] is None for r in found] == [True, False, True], record
    whole = archive(RECORDS)
    cut = list(warc.read_archive(whole[:-5]))
    assert [r["error"] is None for r in cut] == [True, True, True, False]
    flipped = bytearray(archive(RECORDS, write_checksum=True))
    flipped[20] ^= 255
    found = list(warc.read_archive(bytes(flipped)))
    assert found[0]["error"] and len(found) in (1, 4)
    assert list(warc.read_archive(warc.leading_frame(b"x" * 50)[:20]))[0]["error"].startswith("dictionary")
    assert list(warc.read_archive(b"garbage"))[0]["error"]
