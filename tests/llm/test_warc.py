from __future__ import annotations

import gzip
import hashlib
import io
import random
import uuid
import zlib

import pytest
from helpers import pages

from tidemill.llm import warc as wa
from tidemill.storage import scratch_path


def folder(spark):
    return f"{scratch_path(spark, 'warc-test')}/{uuid.uuid4().hex}"


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, payload in data:
        same = [j for j, other in data if other == payload and j is not None]
        first = min(same) if same and len(payload) >= 100 and i is not None else i
        digest = hashlib.sha256(payload).hexdigest()
        out.append((i, len(payload), digest, *(("response", None) if first == i else ("revisit", first))))
    return sorted(out, key=str)


def found(frame):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=str)


@pytest.mark.parametrize("range_bytes", [wa.RANGE_BYTES, 701])
def test_round_trip(spark, range_bytes):
    random.seed(1)
    rows = [(i, f"http://x/{i}", "p" * random.choice([99, 100, 101, 400])) for i in range(80)]
    rows += [(200, None, None), (201, "u\r\nv: w", ""), (None, "n", "q" * 300), (None, "n", "q" * 300), (3, "dup", "p" * 400)]
    rows += [(300, "é", "é😀" * 60), (301, "lines", "a\r\n\r\nb\r\nWARC/1.1\r\n" * 20)]
    path = folder(spark)
    got = wa.archive(pages(spark, rows), path, range_bytes)
    assert found(got) == expected(rows)
    texts = {i: (h or "").encode() for i, _, h in rows}
    for row in got.filter("page_id IS NOT NULL AND page_id <> 3").collect():
        assert row["payload"] is None if row["record_type"] == "revisit" else bytes(row["payload"]) == texts[row["page_id"]]


def test_archives_are_plain_gzip_members(spark):
    path = folder(spark)
    wa.write_warc(wa.with_revisits(pages(spark, [(1, "a", "x" * 500), (2, "b", "x" * 500)]).coalesce(1)), path)
    from tidemill.storage import filesystem

    fs, where = filesystem(spark, path)
    names = [s.getPath().toUri().getPath() for s in fs.listStatus(where) if s.getPath().getName().endswith(".warc.gz")]
    data = b"".join(gzip.open(n).read() for n in names)
    assert data.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: revisit" in data


def test_empty_table(spark):
    assert wa.archive(pages(spark, []), folder(spark)).count() == 0


def test_members_end_with_a_zero_byte():
    big = random.Random(2).randbytes(17 << 20)
    for data in (b"", b"x", big):
        packed = wa.member(data)
        assert packed[-1] == 0 and gzip.decompress(packed) == data


def archive_with_decoys() -> tuple[bytes, list[int]]:
    """Members whose stored bytes hold magic numbers, and other gzip members between them."""
    decoys = [wa.MAGIC * 5, wa.member(b"no record"), wa.MAGIC + b"\x00" * 7 + b"WARC/"]
    data, starts = b"", []
    for i in range(30):
        block = decoys[i % 3] * (i % 5) + str(i).encode()
        head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(block)
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so the decoys stay visible
        starts.append(len(data))
        data += packer.compress(head + block + b"\r\n\r\n") + packer.flush()
        data += wa.member(b"not a record") if i % 4 == 0 else b""
    return data, starts


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 10**6])
def test_each_record_is_owned_by_one_range(monkeypatch, size):
    monkeypatch.setattr(wa, "CHUNK", 50)
    data, starts = archive_with_decoys()
    got = []
    for begin in range(0, len(data), size):
        got += list(wa.records(io.BytesIO(data), begin, min(begin + size, len(data))))
    inner = [g for g in got if g[0] in set(starts)]
    assert [g[0] for g in inner] == starts
    assert [int(g[2][-1:]) for g in inner] == [i % 10 for i in range(30)]
    if size == 10**6:
        assert len(got) == len(starts)


def test_a_cut_off_record_is_an_error():
    data, _ = archive_with_decoys()
    with pytest.raises(ValueError):
        list(wa.records(io.BytesIO(data[:-3]), 0, len(data)))
