"""Archives: hand-written ARC files of both versions, an exact round trip, and revisits against plain Python."""

from __future__ import annotations

import glob
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest

from tariffloom.llm import warc

LONG = "<p>é</p>\r\n\r\nWARC/1.0\r\nWARC-Type: x \n\n1 0 x\n" * 60


def brute(rows, least=1000):
    payloads = [(h or "").encode() for _, _, h in rows]
    groups = defaultdict(list)
    for (i, _, _), p in zip(rows, payloads, strict=True):
        groups[p].append(i)
    out = Counter()
    for p, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            again = len(p) >= least and k < len(ids) - 1
            out[i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", ids[-1] if again else None] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    out = [
        (1, "http://a b/é\n", None), (2, None, ""), (3, "", LONG), (4, "http://x/%20", LONG), (4, "http://x", LONG), (None, "http://y", LONG),
        (5, "u", "short"), (6, "u", "short"), (7, "filedesc://x", LONG + "!"), (8, "u", LONG + "!"),
        (9, "u 0.0.0.0 20180801000000 text/html 5", "z" * 3000), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "x" * 1000), (13, "u", "x" * 1000),
        (14, "http://big", "long text " * 300_000), (None, None, None),
    ]
    return out + [(100 + k, f"http://h/{k}", "copy" * 500) for k in range(200)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    odd = [(*r, "r", "s", b"c") for r in rows]
    return spark.createDataFrame(odd, "page_id long, url string, html string, record_type string, value string, content binary").repartition(4)


@pytest.mark.parametrize("most", [8 << 20, 0])
def test_round_trip(spark, pages, rows, monkeypatch, tmp_path, most):
    """With the revisits known to every task, and joined where they are too many for that."""
    small = warc.broadcast_if_small
    monkeypatch.setattr(warc, "broadcast_if_small", lambda df, size: small(df, size) if most else (df, False))
    folder = str(tmp_path / "warc")
    got = warc.archived(pages, folder).drop("record_id").collect()
    assert Counter(map(tuple, got)) == brute(rows)
    found, infos = {}, 0
    for path in glob.glob(folder + "/*.gz"):
        for fields, block in warc.warc_records(warc.opened(open(path, "rb").read())):
            assert fields["warc-record-id"] not in found and fields["warc-date"] == "2018-08-01T00:00:00Z"
            found[fields["warc-record-id"]] = (fields, block)
            infos += fields["warc-type"] == "warcinfo"
    assert len(found) == len(rows) + infos and infos > 1
    for fields, block in found.values():
        if fields["warc-type"] == "revisit":
            other, whole = found[fields["warc-refers-to"]]
            assert other["warc-payload-digest"] == fields["warc-payload-digest"] and other["warc-type"] == "response"
            assert block.endswith(b"\r\n\r\n") and len(warc.split_http(whole)[1]) == int(fields["warc-payload-length"])
        if fields["warc-type"] != "warcinfo":
            assert found[fields["warc-warcinfo-id"]][0]["warc-type"] == "warcinfo"


def test_no_page(pages):
    assert warc.archived(pages.limit(0)).collect() == []


def arc(version, records, opening=True):
    extra = "" if version == 1 else "200 abc - 0 f.arc "
    body = f"{version} 0 Someone\n{warc.FIELDS[version]}\n".encode()
    out = f"filedesc://f.arc 0.0.0.0 19960923142103 text/plain {extra}{len(body)}\n".encode() + body + b"\n" if opening else b""
    for url, date, mime, block in records:
        out += f"{url} 1.2.3.4 {date} {mime} {extra}{len(block)}\n".encode() + block + b"\n"
    return out


RECORDS = [
    ("http://a.org/x y", "19970301120000", "text/html; charset=utf-8", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<html>\n\n\xff\x00"),
    ("dns:a.org", "19970301120001", "text/dns", b"19970301120001\na.org. 300 IN A 1.2.3.4\n"), ("http://b.org/", "19970399999999", "no-type", b""),
]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("opening", [True, False])
def test_versions(version, opening):
    data = arc(version, RECORDS, opening)
    for content in (data, gzip.compress(data), gzip.compress(data[:50]) + gzip.compress(data[50:])):
        found = list(warc.arc_records(warc.opened(content)))
        assert [(r.url, r.date, r.mime, r.block) for r in found if not r.opens] == RECORDS
        assert [r.opens for r in found].count(True) == opening
        for r in found:
            assert data[r.offset:].startswith(r.url.encode())


def test_synthesis():
    records = list(warc.arc_records(io.BytesIO(arc(1, RECORDS))))
    made = b"".join(warc.converted(r, "f.arc", "i", None) + b"\r\n" for r in records)
    found = list(warc.warc_records(io.BytesIO(made)))
    assert [f["warc-type"] for f, _ in found] == ["warcinfo", "response", "resource", "resource"]
    assert [b for _, b in found[1:]] == [r[3] for r in RECORDS]
    assert [f["warc-date"] for f, _ in found] == ["1996-09-23T14:21:03Z", "1997-03-01T12:00:00Z", "1997-03-01T12:00:01Z", "1970-01-01T00:00:00Z"]
    assert found[1][0]["warc-target-uri"] == "http://a.org/x%20y" and found[2][0]["content-type"] == "text/dns"
    assert found[1][0]["warc-payload-digest"] == "sha1:" + hashlib.sha1(b"<html>\n\n\xff\x00").hexdigest()
    assert found[1][0]["warc-block-digest"] == "sha1:" + hashlib.sha1(RECORDS[0][3]).hexdigest()
    assert len({f.get("warc-record-id") for f, _ in found}) == 4


def test_broken_lengths():
    data = arc(1, RECORDS)
    with pytest.raises(ValueError, match="declares"):
        list(warc.arc_records(io.BytesIO(data[:data.index(b" 300 IN")])))
    with pytest.raises(ValueError, match="no header line"):
        list(warc.arc_records(io.BytesIO(data + b"what is this\n")))
