import base64
import hashlib
import random

import pytest

from celltrace.llm import warc
from celltrace.llm.scratch import Scratch
from tests.llm.helpers import nothing, with_clashes

PAGES = "page_id long, url string, html string"


def pages():
    rnd = random.Random(2)
    rows = [(i, f"http://h{i % 3}.example/{i}?q=\r\nX: y", rnd.choice(["<p>same</p>", "", None, f"<p>{i} é 中\r\n\r\n</p>", "big " * 50_000])) for i in range(80)]
    return rows + [(80, None, "alone"), (None, "u", "<p>same</p>"), (None, "u", "only without ids"), (None, "v", "only without ids"), (90, "w", "twice"), (90, "w", "twice"), (89, "w", "twice")]


def expected(rows, least=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = max(ids) if ids and len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
def test_archives_read_back(spark, least):
    rows = pages()
    frame = with_clashes(spark.createDataFrame(rows, PAGES).repartition(3))
    assert sorted(map(tuple, warc.archive_report(frame, min_bytes=least).collect()), key=str) == expected(rows, least)


def test_records_by_offset_and_whole_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    rows = pages()
    index = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), Scratch(spark).path("warc"))
    html = {i: h or "" for i, _, h in rows}
    found = index.collect()
    assert len(found) == len(rows) and max(r.frame for r in found) > 5 and any(r.offset for r in found)
    for r in found:
        name, url, record, kind, size, digest, refers, payload = warc.read_record(r.file, r.frame, r.offset)
        assert (name, record, kind) == (r.id, r.record_id, r.record_type)
        if kind == "response" and name is not None:
            assert payload.decode() == html[int(name)]
        if kind == "revisit":
            assert payload is None and html[int(refers)] == (html[int(name)] if name else "<p>same</p>")
        assert url is None or "\n" not in url
    payloads = [r.payload for r in warc.read_archives(index).collect()]
    assert sum(p is not None for p in payloads) == sum(r.record_type == "response" for r in found)


def test_text_ids(spark):
    rows = [("a\r\nb: c%41", "u", "x"), ("é", "u", "x"), ("", "u", "y")]
    found = warc.archive_report(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found) == [("", "response", None), ("a\r\nb: c%41", "revisit", "é"), ("é", "response", None)]


def test_empty_table(spark):
    assert warc.archive_report(nothing(spark, PAGES)).collect() == []


def test_damaged_payload_is_refused():
    data = warc.record("1", None, b"abc", 3, warc.base32_sha1(b"abd"), None)
    header, block, end = warc.parse(data)
    assert end == len(data)
    with pytest.raises(ValueError):
        warc._fields(header, block)
