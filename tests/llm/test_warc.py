import io
import struct
import zipfile

import pytest

from polidata.llm import queries, warc


def test_query_matches_oracle(shipped, sf, con):
    from polidata.llm.oracle import ORACLE
    got = queries.QUERIES["op1_warc"](shipped, sf)
    cur = con.execute(ORACLE["op1_warc"])
    cols = [d[0] for d in cur.description]
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in got.select(*cols).collect())


def test_round_trip_of_odd_rows(shipped):
    rows = [(1, "http://a/\r\nX: y", "dup"), (2, None, "dup"), (2, None, "dup"), (3, "u", None), (4, "u", ""), (None, "u", "dup"), (None, "v", "only"),
            (5, "u", "é\r\n\r\nWARC/1.1\r\n" * 1000)]
    pages = shipped.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    manifest = warc.write_archives(pages, archive_bytes=200)
    got = {(r["record_id"], r["record_type"], r["refers_to"], bytes(r["payload"]).decode() if r["payload"] is not None else None)
           for r in warc.read_archives(manifest, range_bytes=100).collect()}
    p = "urn:page:"
    assert got == {(p + "1", "response", None, "dup"), (p + "2", "revisit", p + "1", None), (p + "3", "response", None, ""), (p + "4", "revisit", p + "3", None),
                   (p + "None", "revisit", p + "1", None), (p + "None", "response", None, "only"), (p + "5", "response", None, rows[-1][2])}
    assert warc.page_records(pages).count() == len(rows)
    assert warc.page_records(pages.limit(0)).count() == 0


def test_smaller_payloads_are_all_responses(shipped):
    pages = shipped.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r["record_id"]: r["record_type"] for r in warc.read_archives(warc.write_archives(pages, min_revisit_bytes=3)).collect()}
    assert [kinds[f"urn:page:{i}"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]


def zip64(entries):
    """A ZIP file whose sizes, offsets and end are all given by ZIP64 records."""
    out, central = io.BytesIO(), b""
    for name, data in entries:
        at = out.tell()
        out.write(b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data)
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central += b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = out.tell()
    out.write(central)
    end64 = out.tell()
    out.write(b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(entries), len(entries), len(central), start))
    out.write(b"PK\x06\x07" + struct.pack("<IQI", 0, end64, 1))
    out.write(b"PK\x05\x06" + struct.pack("<HHHHIIH", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 3) + b"end")
    return out.getvalue()


def test_directories_of_zip_and_zip64():
    for make in (zip64, plain_zip):
        data = make([(b"a", b"first"), (b"dir/b", b"second!")])
        f = io.BytesIO(data)
        found = {m.name: m for m in warc.directory(f, len(data))}
        start = warc.data_start(f, found["dir/b"])
        assert set(found) == {"a", "dir/b"} and data[start: start + found["dir/b"].size] == b"second!"


def plain_zip(entries, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in entries:
            z.writestr(name.decode(), data)
    return out.getvalue()


def test_damage_is_reported():
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no zip"), 6)
    data = plain_zip([(b"a", b"x" * 100)], zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError):
        warc.data_start(io.BytesIO(data), warc.directory(io.BytesIO(data), len(data))[0])
    record = warc.record_bytes("urn:page:1", "u", b"payload", None)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"paYload"))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-8])
