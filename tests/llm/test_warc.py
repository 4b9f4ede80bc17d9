import hashlib

import pytest

from trailseq.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string, revisit boolean, size int"


def pages(spark):
    big, other = "é" * 700, "x" * 1000
    rows = [(1, "http://a b\r\n/", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", "small"), (5, "u", "small"),
            (6, "u", None), (7, "u", ""), (8, "u", other), (9, "u", "y" * 300_000), (None, "u", other), (None, "v", "z" * 999)]
    return spark.createDataFrame([(*r, "clash", True, 1) for r in rows], SCHEMA), rows


def test_round_trip(spark):
    docs, rows = pages(spark)
    archive = warc.write(docs)
    records = warc.read(spark, archive).collect()
    assert len(records) == len(rows)
    stored = archive.payloads(spark).collect()
    assert len(stored) == len({(h or "") for _, _, h in rows})
    payloads = sorted((r.page_id or 0, bytes(r.payload)) for r in records)
    assert payloads == sorted((i or 0, (h or "").encode()) for i, _, h in rows)
    for r in records:
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(head.split(b"Content-Length: ")[1])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and body == body[:length] + b"\r\n\r\n"
        assert body[:length] == (b"" if b"Type: revisit" in head else bytes(r.payload))


def test_index(spark):
    docs, rows = pages(spark)
    got = warc.index(warc.read(spark, warc.write(docs))).collect()
    kinds = {}
    for r in got:
        kinds.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    assert kinds[1] == kinds[2] == [("revisit", 3)] and kinds[3] == [("response", None)] * 2
    assert all(kinds[i] == [("response", None)] for i in (4, 5, 6, 7, 8, 9))
    assert sorted(kinds[None], key=str) == [("response", None), ("revisit", 8)]
    digests = {r.page_id: (r.payload_digest, r.payload_bytes) for r in got}
    assert digests[7] == (hashlib.sha1(b"").hexdigest(), 0) and digests[1][1] == 1400


def test_empty_and_damaged(spark):
    docs, _ = pages(spark)
    assert warc.read(spark, warc.write(docs.where("false"))).count() == 0
    archive = warc.write(docs)
    spark.createDataFrame([("0" * 64, bytearray(b"wrong"))], "payload_key string, payload binary").write.mode(
        "append").parquet(f"{archive.path}/payloads")
    spark.createDataFrame([(99, "h", "0" * 64)], "page_id bigint, header string, payload_key string").write.mode(
        "append").parquet(f"{archive.path}/headers")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read(spark, archive).collect()
