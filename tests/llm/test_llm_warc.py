import pytest

from indicata.llm.warc import archived, chunked, dechunked, http_payload, read_index, read_responses, records_of, write_archive


def pages(spark):
    big = "é\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(1, "u1", big), (2, None, big), (3, "u3", big), (4, "u4", "x" * 999), (5, "u5", "x" * 999), (6, "u6", None), (7, "a\r\nb", ""), (8, "u8", "y" * 1000), (9, "u9", "y" * 1000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), big


def test_round_trip(spark, tmp_path):
    frame, big = pages(spark)
    path = f"file://{tmp_path}/archive"
    write_archive(frame, path, segment=1000, chunk=300, records=7)
    assert {r["page_id"]: r["payload"].decode() for r in read_responses(spark, path).collect()} == {3: big, 4: "x" * 999, 5: "x" * 999, 6: "", 7: "", 9: "y" * 1000}
    index = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read_index(spark, path).collect()}
    size = len(big.encode())
    assert index[1] == index[2] == ("revisit", 3, size) and index[3] == ("response", None, size)
    assert index[8] == ("revisit", 9, 1000) and index[4][0] == index[5][0] == "response" and index[6][2] == 0


def test_repeated_rows_and_ids(spark):
    frame = spark.createDataFrame([(5, "u", "z" * 2000)] * 3 + [(None, "u", "z" * 2000), (4, "u", "z" * 2000)], "page_id long, url string, html string")
    found = sorted(map(str, archived(frame).select("page_id", "record_type", "refers_to").collect()))
    assert sum("response" in f for f in found) == 3 and sum("refers_to=5" in f for f in found) == 2


@pytest.mark.parametrize("size", [0, 1, 299, 300, 301, 5000])
def test_chunks(size):
    payload = bytes(k % 251 for k in range(size))
    assert dechunked(chunked(payload, 300)) == payload


def test_broken_framing_is_an_error():
    with pytest.raises(ValueError):
        dechunked(b"5\r\nabc")
    with pytest.raises(ValueError):
        http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n")
    with pytest.raises(ValueError):
        list(records_of(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


def test_a_missing_segment_is_an_error(spark, tmp_path):
    head = "WARC/1.1\r\nWARC-Type: {}\r\nWARC-Record-ID: <{}>\r\n{}Content-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "part-0").write_text(head.format("response", 1, "WARC-Segment-Number: 1\r\n") + head.format("continuation", 2, "WARC-Segment-Origin-ID: <1>\r\nWARC-Segment-Number: 3\r\nWARC-Segment-Total-Length: 9\r\n"), newline="")
    with pytest.raises(Exception, match="missing or repeated"):
        read_responses(spark, f"file://{tmp_path}").collect()
