import io
import zlib

import pytest

from docmill.llm.warc import BadArchive, archive_round_trip, read_archives, read_records, sha256, write_archives, write_record


def record(i, payload, refers_to=None, url="http://a/b"):
    return write_record(i, url, payload, sha256(payload), refers_to)


class Trickle(io.RawIOBase):
    """A source that gives a few bytes at a time."""

    def __init__(self, data, step):
        self.data, self.step = data, step

    def read(self, n=-1):
        out, self.data = self.data[: self.step], self.data[self.step :]
        return out


PAYLOADS = [b"", b"x" * 5000, "é\r\n\r\n".encode() * 40, bytes(range(256)) * 300]


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_records_come_back(step):
    data = b"".join(record(i, p) for i, p in enumerate(PAYLOADS)) + record(9, PAYLOADS[1], 1)
    found = list(read_records(Trickle(data, step)))
    assert [r.payload for r in found] == [*PAYLOADS, b""]
    assert found[-1].headers["warc-type"] == "revisit"
    assert found[-1].http["content-length"] == "5000"


def repacked(data, change):
    return zlib.compress(change(zlib.decompress(data, 31)), wbits=31)


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d.replace(b"payload", b"pAyload"),
        lambda d: d[:-4],
        lambda d: d + b"more",
        lambda d: d.replace(b"WARC/1.1", b"WARC/9.9"),
    ],
)
def test_damage_is_found(change):
    with pytest.raises(BadArchive):
        list(read_records(io.BytesIO(repacked(record(1, b"payload" * 30), change))))


def test_a_cut_archive_is_found():
    with pytest.raises(BadArchive):
        list(read_records(io.BytesIO(record(1, b"payload" * 30)[:-20])))


def test_round_trip_of_odd_rows(spark, tmp_path):
    same = "s" * 120
    rows = [
        (3, "u", same), (1, "u", same), (2, None, same), (1, "u", same), (None, "u", same), (5, "a\nb", None),
        (6, "u", "short"), (7, "u", "short"), (None, "u", "z" * 200), (None, "u", "z" * 200), (8, "é", "é" * 60),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "1 AS payload", "'x' AS _digest", "2 AS records")
    found = archive_round_trip(pages).collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in found)
    assert got == sorted([
        ("3", 120, "revisit", 1), ("1", 120, "response", None), ("2", 120, "revisit", 1), ("1", 120, "response", None),
        ("None", 120, "revisit", 1), ("5", 0, "response", None), ("6", 5, "response", None), ("7", 5, "response", None),
        ("None", 200, "response", None), ("None", 200, "response", None), ("8", 120, "response", None),
    ])
    folder = f"file://{tmp_path}/archives"
    manifest = write_archives(pages, folder, archive_bytes=200)
    full = read_archives(manifest, folder, with_payload=True).collect()
    assert sorted(bytes(r.payload).decode() for r in full if r.record_type == "response") == sorted(
        [same, same, "", "short", "short", "z" * 200, "z" * 200, "é" * 60]
    )
    assert archive_round_trip(pages.filter("false")).collect() == []
