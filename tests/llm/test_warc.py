import gzip
import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest

from tabvitals.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string"


def pages():
    rnd = random.Random(3)
    pool = ["WARC/1.1\r\n", "WARC/1.1", "\r\n\r\n", "W", "é", "WARC", "/1.1\r\n", "a", "\r\n", "日本"]
    rows = []
    for i in range(60):
        text = "".join(rnd.choices(pool, k=rnd.choice([0, 1, 5, 30, 200, 1500])))
        rows.append((i if i % 17 else None, f"http://x/{i}\r\n%0D" if i % 5 else None, text if i % 29 else None, "x"))
    copies = [(1000 + i, "u", "copy " * 300, "x") for i in range(20)]
    short = [(2000 + i, "u", "short", "x") for i in range(3)]
    return rows + copies + [copies[-1], (None, "u", "copy " * 300, "x")] + short


def expected(rows):
    data = [(k, u, (t or "").encode()) for k, u, t, _ in rows]
    out = []
    for key, url, payload in data:
        keys = [k for k, _, p in data if p == payload and len(payload) >= 1000 and k is not None]
        owner = max(keys) if len([1 for _, _, p in data if p == payload]) > 1 and keys else None
        revisit = owner is not None and owner != key
        out.append(
            (key, url, len(payload), hashlib.sha1(payload).hexdigest(),
             "revisit" if revisit else "response", owner if revisit else None)
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [7, 64, 1 << 20])
def test_round_trip(spark, tmp_path, limit):
    frame = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    out = warc.round_trip(frame, str(tmp_path / "archives"), limit=limit).collect()
    got = [
        (r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out
    ]
    assert sorted(got, key=str) == expected(pages())
    assert max(r.n_chunks for r in out) >= 6_000 // limit


def test_chunks_carry_digests(spark):
    rows = [(1, "u", "0123456789" * 10, "x")]
    found = warc.chunked(warc.typed(spark.createDataFrame(rows, SCHEMA), "page_id", "url", "html"), 30)
    chunks = found.orderBy("chunk_no").collect()
    assert [len(c.chunk) for c in chunks] == [30, 30, 30, 10]
    data = b"0123456789" * 10
    assert [c.digest_so_far for c in chunks] == [
        hashlib.sha1(data[:n]).hexdigest() for n in (30, 60, 90, 100)
    ]
    assert b"".join(c.chunk for c in chunks) == data


def test_files_are_archives(spark, tmp_path):
    frame = spark.createDataFrame([(7, "http://x/", "<p>é</p>", "x")], SCHEMA).coalesce(1)
    warc.round_trip(frame, str(tmp_path / "a"))
    (file,) = [f for f in (tmp_path / "a").glob("part-*.gz") if gzip.open(f).read()]
    data = gzip.open(file).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n")
    head, block = data.split(b"\r\n\r\n", 1)
    assert b"\r\nContent-Length: " + str(len(block) - 4).encode() in head
    assert block.endswith("<p>é</p>".encode() + b"\r\n\r\n")


def test_changed_archives_are_noticed(spark, tmp_path):
    frame = spark.createDataFrame([(7, "http://x/", "0123456789" * 10, "x")], SCHEMA).coalesce(1)
    warc.write(warc.chunked(warc.typed(frame, "page_id", "url", "html"), 30), str(tmp_path / "a"))
    (file,) = [f for f in (tmp_path / "a").glob("part-*.gz") if gzip.open(f).read()]
    data = gzip.open(file).read()
    broken = tmp_path / "b"
    broken.mkdir()
    (broken / "part-0.gz").write_bytes(gzip.compress(data.replace(b"0123456789", b"0123456780", 1)))
    with pytest.raises(Exception, match="has been changed"):
        warc.checked(warc.read(spark, str(broken))).collect()


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(empty, str(tmp_path / "a")).count() == 0


def test_payloads_are_not_copied_whole():
    whole = (b"x" * 999_990 + b"WARC/1.1\r\n") * 32
    cell = pa.array([whole], pa.binary())[0]
    running = hashlib.sha1()
    tracemalloc.start()
    for number, last, digest, end, chunk in warc.pieces(cell, 1 << 20):
        running.update(chunk)
        assert digest == running.hexdigest() and last == (end == len(whole))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert last and number >= 32 and digest == hashlib.sha1(whole).hexdigest()
    assert peak < 4 << 20
    for empty in (pa.scalar(None, pa.binary()), pa.scalar(b"", pa.binary())):
        assert [p[1:] for p in warc.pieces(empty, 10)] == [(True, hashlib.sha1().hexdigest(), 0, b"")]
