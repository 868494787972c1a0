"""Archives: exact round trip, copies, and records written by others."""

import base64
import gzip
import hashlib
import random

import pytest

from care_episodes.llm import warc
from tests.llm.helpers import rows

HTML = [
    None, "", "<p>a</p>", "<p>a</p>", "line\r\nbreaks\r\n", "\r\n", "\r", "\n", "ends in \r", "\r\r\n\r\n\r", "WARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n",
    "ñ漢🙂" * 50, "x" * 300, "\r\n" * 200, "nul \x00 in it", "a\u0085b c", "0", "5\r\nabcde\r\n",
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages_of(spark, html, ids=None):
    ids = list(range(len(html))) if ids is None else ids
    data = [(i, f"http://host/{k} a\r\nX: y" if k % 4 else None, h, "mine") for k, (i, h) in enumerate(zip(ids, html))]
    return spark.createDataFrame(data, "page_id long, url string, html string, record string")


def expected(html):
    top = {h or "": i for i, h in enumerate(html)}
    return [(i, len((h or "").encode()), digest(h), "response" if top[h or ""] == i else "revisit", None if top[h or ""] == i else top[h or ""]) for i, h in enumerate(html)]


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_round_trip(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(warc, "BATCH_BYTES", 1000)
    rng = random.Random(chunk)
    html = HTML + ["".join(rng.choice("ab\r\n é漢") for _ in range(rng.randrange(400))) for _ in range(60)]
    pages = pages_of(spark, html)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in rows(warc.round_trip(pages)))
    assert got == expected(html)
    warc.write_archives(pages, str(tmp_path / "w"))
    read = rows(warc.read_archives(spark, str(tmp_path / "w")))
    parts = {}
    for r in sorted(read, key=lambda r: r["chunk"]):
        parts.setdefault(int(r["page_id"]), []).append(r["data"])
        assert len(r["data"]) <= max(chunk, 4)
    for i, size, _, kind, _ in expected(html):
        assert b"".join(parts[i]) == ((html[i] or "").encode() if kind == "response" else b"")
    assert {r["url"] for r in read if r["page_id"] == "2"} == {"http://host/2%20a%0D%0AX:%20y"}


def test_files_are_archives(spark, tmp_path):
    warc.write_archives(pages_of(spark, ["<p>one</p>", "<p>one</p>", "two"]).coalesce(1), str(tmp_path / "w"))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*")))
    at, kinds = 0, []
    while at < len(text):  # by Content-Length alone
        head, _, rest = text[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        block = rest[: int(fields[b"Content-Length"])]
        assert head.startswith(b"WARC/1.1\r\n") and block.startswith(b"HTTP/1.1 200 OK\r\n")
        assert rest[len(block) : len(block) + 4] == b"\r\n\r\n"
        kinds.append(fields[b"WARC-Type"])
        if kinds[-1] == b"revisit":
            assert fields[b"WARC-Refers-To"].startswith(b"<urn:page:1:") and block.endswith(b"\r\n\r\n")
        at += len(head) + 4 + len(block) + 4
    assert sorted(kinds) == [b"response", b"response", b"revisit"]


def test_ids_that_are_null_repeated_or_text(spark):
    pages = pages_of(spark, ["same", "same", "same", "own", "other"], [None, 4, 4, None, None])
    got = sorted(((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in rows(warc.round_trip(pages))), key=str)
    assert got == sorted([(4, "response", None), (4, "revisit", 4), (-1, "revisit", 4), (-1, "response", None), (-1, "response", None)], key=str)
    texts = spark.createDataFrame([("a:b>~ é", "x"), ("~", "x"), ("", "y")], "page_id string, html string").selectExpr("*", "cast(null as string) as url")
    got = {(r["page_id"], r["refers_to"]) for r in rows(warc.round_trip(texts))}
    assert got == {("~", None), ("a:b>~ é", "~"), ("", None)}
    assert rows(warc.round_trip(pages.limit(0))) == []
    small = sorted(r["record_type"] for r in rows(warc.round_trip(pages, least_bytes=5)))
    assert small == ["response"] * 5


def test_plain_bodies_and_broken_files(spark, tmp_path):
    def record(payload, extra="", kind="resource", declared=None):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:1>\r\n{extra}Content-Length: {len(payload) if declared is None else declared}\r\n\r\n{payload}\r\n\r\n".encode()

    for payload in ("plain\r\nbody\r\n", "", "\r\n\r\n", "x\r"):
        folder = tmp_path / f"f{len(payload)}{payload[:1].isalpha()}"
        folder.mkdir()
        http = "HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + payload
        (folder / "a.warc.gz").write_bytes(gzip.compress(record(payload) + record(http, "Content-Type: application/http; msgtype=response\r\n", "response")))
        got = rows(warc.read_archives(spark, str(folder)))
        assert [(r["data"], r["n_bytes"], r["digest"]) for r in got] == [(payload.encode(), len(payload), digest(payload))] * 2
    for name, data in (("cut", record("abc")[:-8]), ("size", record("abcdef", declared=3)), ("digest", record("abc", "WARC-Payload-Digest: sha1:AAAA\r\n")), ("text", b"no archive\r\n")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="record|chunk|payload"):
            rows(warc.read_archives(spark, str(folder)))
