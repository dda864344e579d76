import gzip
import hashlib
import io
from pathlib import Path

import numpy as np
from hypothesis import given, strategies as st

from oreflow.llm import warc

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    payloads = [(page_id, (html or "").encode()) for page_id, _, html in rows]
    out = []
    for page_id, payload in payloads:
        same = [p for p, other in payloads if other == payload and p is not None]
        keeper = max(same) if len(payload) >= 1000 and same and [x for _, x in payloads].count(payload) > 1 else None
        revisit = keeper is not None and page_id != keeper
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def sample():
    long, other = "<p>é\r\n\r\nWARC/1.1\r\n" * 80, "x" * 1000
    rows = [(i, f"http://a.example/{i}", f"<html>{i}" + "y" * (i * 37 % 2500)) for i in range(60)]
    rows += [(100 + i, "http://copy.example/", long) for i in range(40)]
    rows += [(200, "http://ñ.example/a b\r\nX: y", other), (201, None, other), (202, "", "z" * 999), (203, "u", "z" * 999)]
    rows += [(204, "u", None), (205, "u", ""), (None, "u", other), (None, "u", "q" * 2000), (None, "v", "q" * 2000), (300, "u", "r" * 1500),
             (300, "v", "r" * 1500), (301, "u", "é" * 500), (302, "u", "é" * 500), (400, "big", "w" * 9_000_000), (401, "big", "w" * 9_000_000)]
    return rows


def test_written_and_read_back(spark):
    rows = sample()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert shown(warc.write_and_read(pages)) == expected(rows)


def test_archives_are_whole_files(spark, tmp_path):
    rows = sample()
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    index = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=4000).collect()
    files = sorted((tmp_path / "w" / "archives").iterdir())
    assert len(files) > 3 and {r["archive"] for r in index} == {f.name for f in files}
    for file in files:
        raw = file.read_bytes()
        mine = sorted((r for r in index if r["archive"] == file.name), key=lambda r: r["offset"])
        # members stand one behind the other after the archive's own record
        assert [r["offset"] for r in mine[1:]] + [len(raw)] == [r["offset"] + r["length"] for r in mine]
        assert gzip.GzipFile(fileobj=io.BytesIO(raw)).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        for r in mine:
            page_id, _, kind, refers, size, digest, payload = warc.read_record(gzip.decompress(raw[r["offset"] : r["offset"] + r["length"]]))
            assert (page_id, kind, refers, size, digest) == (r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["digest"])
    by_id = {(r["page_id"], r["url"]) for r in index}
    assert by_id == {(a, b) for a, b, _ in rows}


def test_selection_and_uri(spark, tmp_path):
    rows = sample()
    folder = (tmp_path / "w").as_uri()
    index = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(2), folder)
    chosen = warc.read_records(index.filter("page_id IN (3, 17, 139, 100, 200)"), folder)
    got = {r["page_id"]: r for r in chosen.collect()}
    texts = {a: (c or "").encode() for a, _, c in rows}
    assert set(got) == {3, 17, 139, 100, 200}
    assert all(bytes(got[i]["payload"]) == texts[i] for i in (3, 17, 139))
    assert got[100]["payload"] is None and got[100]["refers_to"] == 139
    assert got[200]["url"] == "http://%C3%B1.example/a%20b%0D%0AX:%20y"


def test_changed_archive_is_refused(spark, tmp_path):
    data = bytearray(warc.record(1, "u", b"hello", 5, hashlib.sha1(b"hello").hexdigest()))
    assert warc.read_record(bytes(data))[-1] == b"hello"
    for broken in (data.replace(b"hello", b"hellp"), data[:-1], b"x" + data):
        try:
            warc.read_record(bytes(broken))
        except ValueError:
            continue
        raise AssertionError("read a broken record")


@given(st.lists(st.tuples(st.integers(0, 500), st.integers(1, 200)), max_size=30), st.integers(0, 60), st.integers(50, 400))
def test_ranges(steps, gap, most):
    offsets, lengths, place = [], [], 0
    for skip, size in steps:
        offsets.append(place + skip)
        lengths.append(size)
        place += skip + size
    ranges = warc.coalesce_ranges(np.array(offsets, np.int64), np.array(lengths, np.int64), gap, most)
    assert [i for _, _, a, b in ranges for i in range(a, b)] == list(range(len(offsets)))
    for low, high, a, b in ranges:
        assert low == offsets[a] and high == offsets[b - 1] + lengths[b - 1] and (high - low <= most or b - a == 1)
        assert all(offsets[i + 1] - offsets[i] - lengths[i] <= gap for i in range(a, b - 1))


def test_empty_table_and_other_columns(spark):
    assert warc.write_and_read(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, "u", "t", 5, "s", "k")], SCHEMA + ", salt int, same string, digest string")
    assert shown(warc.write_and_read(odd)) == expected([(1, "u", "t")])
