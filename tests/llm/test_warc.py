import base64
import hashlib
import struct
from collections import Counter

import pytest
import zstandard

from claimtide.llm import warc

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (2, "http://b2/", "<p>one</p>"),
    (3, None, None), (4, "http://c/\r\nX: y", ""), (None, "http://d/", "<p>one</p>"), (None, "http://e/", "alone"),
    (5, "http://f/é", "é" * 400_000), (6, "http://g/", "WARC/1.1\r\n\r\n\r\n\r\n"), (7, "http://h/", "é" * 400_000),
    (8, "http://i/", "solo"), (8, "http://i/", "solo"),
]
SCHEMA = "page_id long, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(least=0):
    largest = {}
    for i, _, t in PAGES:
        t = t or ""
        largest[t] = max((x for x in (largest.get(t), i) if x is not None), default=None)
    out = Counter()
    for i, _, t in PAGES:
        t = t or ""
        revisit = len(t.encode()) >= least and i != largest[t]
        out[i, len(t.encode()), sha(t), "revisit" if revisit else "response", largest[t] if revisit else None] += 1
    return out


@pytest.mark.parametrize("least,archive_bytes", [(0, 32 << 20), (5, 100)])
def test_round_trip(spark, least, archive_bytes):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    folder, manifest = warc.archive_pages(pages, least_bytes=least, archive_bytes=archive_bytes)
    rows = warc.read_archives(spark, folder, manifest, payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected(least)
    kept = {(r.page_id, bytes(r.payload)) for r in rows if r.record_type == "response"}
    assert kept <= {(i, (t or "").encode()) for i, _, t in PAGES}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    urls = {r.page_id: r.url for r in rows}
    assert urls[3] is None and urls[4] == "http://c/%0D%0AX: y" and urls[5] == "http://f/é"


def test_empty_and_clashing_columns(spark):
    folder, manifest = warc.archive_pages(spark.createDataFrame([], SCHEMA))
    assert manifest.count() == 0 and warc.read_archives(spark, folder, manifest).count() == 0
    pages = spark.createDataFrame([(1, "u", "x", "mine", 3, "y")], SCHEMA + ", payload string, head int, content string")
    folder, manifest = warc.archive_pages(pages)
    assert [r.payload_bytes for r in warc.read_archives(spark, folder, manifest).collect()] == [1]


def test_stray_archives_are_not_read(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    folder, manifest = warc.archive_pages(pages)
    before = warc.read_archives(spark, folder, manifest).count()
    again, more = warc.archive_pages(pages, folder=folder)
    assert again == folder and warc.read_archives(spark, folder, more).count() == before


def records():
    return [warc.build_record("response", i, f"u{i}", b"<p>%d</p>" % i * 40, None) for i in range(300)]


@pytest.mark.parametrize("trained", [True, False])
def test_frames(trained):
    made = records()
    dictionary = warc.train_dictionary(made, 4096) if trained else b""
    known = zstandard.ZstdCompressionDict(dictionary) if trained else None
    assert bool(dictionary) == trained
    frames = [zstandard.ZstdCompressor(dict_data=known).compress(r) for r in made]
    archive = warc.archive_start(dictionary) + b"".join(frames)
    assert list(warc.records(archive)) == made
    skipped = warc.archive_start(dictionary) + frames[0] + struct.pack("<II", 0x184D2A51, 3) + b"abc" + frames[1]
    assert list(warc.records(skipped)) == made[:2]
    with pytest.raises(ValueError):
        list(warc.records(archive[:-3]))
    if trained:  # the dictionary may itself be compressed
        packed = zstandard.compress(dictionary)
        start = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed
        assert list(warc.records(start + frames[0])) == made[:1]
        with pytest.raises(ValueError):
            list(warc.records(archive[:100]))


def test_broken_records_are_refused():
    good = warc.build_record("response", 1, "u", b"abc", None)
    assert warc.read_response(good)["payload"] == b"abc"
    revisit = warc.build_record("revisit", 1, "u", b"abc", 9)
    assert warc.read_response(revisit)["refers_to"] == 9 and warc.read_response(revisit)["payload_bytes"] == 3
    for bad in (good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"abc", b"abd"),
                good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"WARC-Type:", b"WARC-Type "), b"",
                revisit.replace(b"WARC-Refers-To", b"WARC-Refers-No")):
        with pytest.raises(ValueError):
            warc.read_response(bad)


def test_dictionary_of_few_samples_is_left_out():
    assert warc.train_dictionary([]) == b"" and warc.train_dictionary([b"a"]) == b""


def test_a_folder_without_a_scheme_lies_where_spark_puts_it(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path / "a")) == f"file://{tmp_path}/a"
    assert warc.qualified(spark, f"file:{tmp_path}/b") == warc.qualified(spark, f"file://{tmp_path}/b") == f"file://{tmp_path}/b"
    with pytest.raises(Exception):
        warc.qualified(spark, "nowhere://host/folder")
