import pytest
from llm_fixtures import without_rows
from pyspark.sql import functions as F

from lexmill.llm import warc


def test_both_versions_are_read_by_declared_length():
    tricky = [b"", b"\n", b"http://x 0.0.0.0 20240101000000 text/html 5\nabcde\n", b"\r\n\r\nWARC/1.1\r\n", "é".encode() * 5]
    for version in (b"1", b"2"):
        archive = warc.arc_head(version, "a.arc", "20240101000000")
        archive += b"".join(warc.arc_record(version, i, f"http://h/{i} x\n", body, "20240101000000") for i, body in enumerate(tricky))
        got = list(warc.parse_arc(archive + b"\n"))
        assert [r.block.partition(b"\r\n\r\n")[2] for r in got] == tricky
        assert [r.url for r in got] == [f"http://h/{i}%20x%0A" for i in range(5)]
        with pytest.raises(ValueError):
            list(warc.parse_arc(archive[:-3]))
        assert list(warc.parse_arc(warc.unzipped(warc.zipped(archive)))) == got


def test_a_record_with_other_fields_is_refused():
    archive = warc.arc_head(b"1", "a.arc", "20240101000000") + b"http://h 0.0.0.0 text/html 3\nabc\n"
    with pytest.raises(ValueError):
        list(warc.parse_arc(archive))


def test_damaged_warc_is_refused():
    record = warc.warc_record("http://h", "0.0.0.0", "20240101000000", 1, warc.base32_sha1(b"abc"), None, b"HTTP/1.1 200 OK\r\n\r\n", b"abc")
    head, block = next(warc.parse_warc(record))
    assert head["warc-date"] == "2024-01-01T00:00:00Z" and block.endswith(b"abc")
    with pytest.raises(ValueError):
        list(warc.parse_warc(record.replace(b"abc", b"abd")))


def test_pages_through_both_formats(spark, tmp_path):
    rows = [(3, "http://a", "same"), (1, "http://b c", "same"), (2, None, None), (4, "", ""), (5, "http://d", "\nWARC/1.1\r\n\r\n漢"), (None, "http://e", "same"),
            (7, "http://f", "x" * 200_000), (1, "http://b c", "same"), (None, "u", "lone"), (None, "v", "lone")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, digest string, first string").repartition(3)
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(pages, "page_id", "url", "html", arc)
    warc.arc_to_warc(spark, arc, out)
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, out).collect()), key=repr)
    assert got == sorted([
        (3, 4, "revisit", 1), (1, 4, "response", None), (1, 4, "response", None), (None, 4, "revisit", 1), (2, 0, "response", None), (4, 0, "revisit", 2),
        (5, len("\nWARC/1.1\r\n\r\n漢".encode()), "response", None), (7, 200_000, "response", None), (None, 4, "response", None), (None, 4, "response", None)], key=repr)
    assert {r["payload_digest"] for r in warc.read_warc(spark, out).where(F.col("payload_bytes") == 0).collect()} == {warc.base32_sha1(b"")}
    empty = [str(tmp_path / n) for n in ("arc0", "warc0")]
    warc.write_arc(without_rows(pages), "page_id", "url", "html", empty[0])
    warc.arc_to_warc(spark, *empty)
    assert warc.read_warc(spark, empty[1]).count() == 0


def test_small_payloads_can_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")], "page_id long, url string, html string")
    warc.write_arc(pages, "page_id", "url", "html", str(tmp_path / "arc"))
    warc.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), min_bytes=3)
    assert {r["page_id"]: r["record_type"] for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
