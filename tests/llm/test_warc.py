"""WARC archives: exact round trips."""

import gzip
import hashlib
import random
import zlib

import pytest

from hazardpanel.llm import warc


def round_trip(spark, pages, path, **kw):
    warc.write_monolithic(pages, f"{path}/mono")
    warc.normalise(spark, f"{path}/mono", f"{path}/out", **kw)
    return warc.read_records(spark, f"{path}/out")


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = len(p) >= 100 and h in first and first[h] != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [200, 1 << 22])
def test_round_trip(spark, tmp_path, chunk):
    rng = random.Random(2)
    body = lambda n: "".join(rng.choices("<p>éab \r\n😀\0&;", k=n))
    rows = [(i, f"http://x/{i}", body(rng.randint(0, 400))) for i in range(60)]
    rows += [(100 + i, "http://copy/\r\nWARC-Type: x", rows[i % 9][2]) for i in range(30)]
    rows += [(200, None, None), (201, "u", ""), (None, "u", rows[3][2]), (None, "u", "only here " * 30), (202, "u", "x" * 99), (203, "u", "x" * 99),
             (204, "u", "y" * 100), (204, "u", "y" * 100), (205, "u", "y" * 100), (206, "u", "long \r\n\r\n" * 100_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, refers_to string").repartition(4)
    got = round_trip(spark, pages, tmp_path, chunk=chunk).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    # each file is one stream before, a member per record after, with the same content
    mono = [p.read_bytes() for p in tmp_path.glob("mono/*.gz")]
    for data in mono:
        z = zlib.decompressobj(31)
        z.decompress(data)
        assert z.eof and not z.unused_data
    after = {p.parent.name.partition("=")[2]: p.read_bytes() for p in tmp_path.glob("out/archives/*/*.txt")}
    assert sorted(gzip.decompress(d) for d in after.values()) == sorted(map(gzip.decompress, mono))
    for r in got:
        assert gzip.decompress(after[r.archive][r.offset:])[:8] == b"WARC/1.1"


def test_streams_of_any_members_and_damage():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"z" * n) for n in (0, 5, 100_000)]
    whole = b"".join(records)
    for data in (gzip.compress(whole), b"".join(map(gzip.compress, records)), gzip.compress(whole[:70]) + gzip.compress(whole[70:]), gzip.compress(whole) + warc.END):
        for step in (1, 1000, 1 << 20) if len(data) < 5000 else (1000,):
            assert list(warc.split_records(warc.inflate(data, step))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflate(gzip.compress(whole)[:-20])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([whole[:-10]])))


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string"), tmp_path).collect() == []


def test_archives_close_by_bytes(spark, tmp_path, monkeypatch):
    """A file holds at most rows_per_file rows of row_bytes and the record that fills one."""
    monkeypatch.setattr(warc, "RECORDS_AT_ONCE", 7)
    rows = [(i, f"u{i}", chr(97 + i % 26) * (i % 50) + str(i) * (2000 if i % 40 == 0 else 40)) for i in range(1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_monolithic(pages, f"{tmp_path}/mono", rows_per_file=4, row_bytes=5000)
    sizes = [len(gzip.decompress(p.read_bytes())) for p in tmp_path.glob("mono/*.gz")]
    assert len(sizes) > 10 and max(sizes) < 4 * (5000 + 9000)
    warc.normalise(spark, f"{tmp_path}/mono", f"{tmp_path}/out", chunk=3000)
    got = warc.read_records(spark, f"{tmp_path}/out").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
