"""WARC archives: exact round trip of hostile payloads, revisits against a plain reading."""

import base64
import gzip
import hashlib

import pytest

from opslens.llm import warc
from opslens.session import scratch_path

PAYLOADS = ["", "a", "\r\n", "\r\n\r\n", "x\r\n\r", "\r\r\n\r\n\n", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
            "é ß" * 300, "b" * 200_000, "a", None, "tail\r\n", "\n\n\r\n\r\n\r\n"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(50 - i, f"http://h/{i}?a b\r\nX: y", p, "clash") for i, p in enumerate(PAYLOADS)]
    rows += [(50, "http://h/0", "", "z"), (None, None, "a", "n"), (49, "http://h/1", "a", "again"), (49, "http://h/1", "a", "again")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")


def plain(rows):
    out, first = [], {}
    for r in rows:
        body = (r.html or "").encode()
        key = (r.page_id is None, r.page_id)
        if body not in first or key < first[body]:
            first[body] = key
    done = set()
    for r in sorted(rows, key=lambda r: (r.page_id is None, r.page_id or 0)):
        body = (r.html or "").encode()
        is_first = (r.page_id is None, r.page_id) == first[body] and body not in done
        done.add(body) if is_first else None
        out.append((str(r.page_id), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "response" if is_first else "revisit", None if is_first else first[body][1]))
    return sorted(out, key=str)


def test_revisits_match_plain_reading(pages):
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in warc.deduplicated_pages(pages).collect()]
    assert sorted(got, key=str) == plain(pages.collect())


def test_round_trip_and_files(spark, pages):
    raw, clean = scratch_path(spark, "t-raw"), scratch_path(spark, "t-clean")
    warc.write_archive(pages.coalesce(2), raw)
    back = warc.read_archive(spark, raw).collect()
    want = sorted((str(r.page_id), (r.html or "").encode()) for r in pages.collect())
    assert sorted((str(r.page_id), bytes(r.payload)) for r in back) == want
    assert len({r.record_id for r in back}) == len(back)
    assert all("\r" not in (r.uri or "") for r in back)
    warc.resolve_revisits(spark, raw, clean)
    heads = {r.record_id: r for r in warc.read_archive(spark, clean).collect()}
    assert set(heads) == {r.record_id for r in back}
    revisits = [r for r in heads.values() if r.record_type == "revisit"]
    assert revisits and all(heads[r.refers_to].record_type == "response" and r.payload is None for r in revisits)
    # resolving again changes no decision: revisits keep pointing at the response of their digest
    again = scratch_path(spark, "t-again")
    warc.resolve_revisits(spark, clean, again)
    assert {(r.record_id, r.record_type, r.refers_to) for r in warc.read_archive(spark, again).collect()} == {
        (r.record_id, r.record_type, r.refers_to) for r in heads.values()}


def test_small_payloads_stay_responses(spark, pages):
    got = warc.deduplicated_pages(pages, min_bytes=2).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 2)


def test_files_are_plain_warc(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archive(spark.createDataFrame([(1, "http://a/", "hi\r\n\r\nyou")], "page_id bigint, url string, html string"), path)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*.gz"))
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
    assert data.startswith(b"WARC/1.1\r\n") and int(fields[b"Content-Length"]) == len(rest) - 4
    assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(b"hi\r\n\r\nyou").digest())


def test_truncated_archives_fail_and_empty_ones_do_not(spark, pages):
    with pytest.raises(ValueError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 10", b"abc"])))
    assert warc.deduplicated_pages(pages.limit(0)).count() == 0
