"""Archives: written, read back, revisits resolved."""

import base64
import gzip
import hashlib

import pytest

from tierwork.llm import warc

END = "\r\n\r\n"
NASTY = [
    "<p>one</p>", "", None, "\r\n", END, END + END, "\r\r\n\r\n", "x\r\n", "x\r\n\r", "\nx\n\n", "\r",
    "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", "é漢🙂\x00", "x" * 300_000,
    ("line\r\n\r\n" * 5_000), "<p>one</p>", None, "\r\n",
]
SCHEMA = "page_id long, url string, html string, payload string, digest string, value string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", "b", "c") for i, u, h in rows], SCHEMA)


def expected(rows):
    first: dict[str, int] = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    found = []
    for page, _, html in rows:
        payload = (html or "").encode()
        own = first.get(html or "") == page
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind, refers = ("response", None) if own else ("revisit", first[html or ""])
        found.append((page, len(payload), digest, kind, refers))
    return found


def key(row):
    return str(tuple(row))


def test_nasty_payloads(spark, tmp_path):
    rows = [(100 - i, f"http://x/{i} a\r\nb", html) for i, html in enumerate(NASTY)] + [(None, None, "<p>one</p>")]
    path = str(tmp_path / "archives")
    found = warc.revisit_resolution(pages_of(spark, rows), path).collect()
    assert sorted(map(key, found)) == sorted(map(key, expected(rows)))
    records = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    for page, _, html in rows[:-1]:
        record = records[str(page)]
        if record["record_type"] == "response":
            assert bytes(record["payload"]) == (html or "").encode()
            assert record["payload_digest"] == base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    text = b"".join(gzip.open(x).read() for x in tmp_path.rglob("*.gz"))
    assert text.count(b"\r\nWARC-Profile: ") == sum(r["record_type"] == "revisit" for r in found)


def test_a_payload_of_many_pages_is_kept_once(spark):
    rows = [(i, f"u{i}", "same" if i % 3 else f"own {i}") for i in range(300)]
    found = warc.revisit_resolution(pages_of(spark, rows)).collect()
    assert sorted(map(key, found)) == sorted(map(key, expected(rows)))
    assert sum(r["record_type"] == "revisit" for r in found) == 199


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "v", "only null"), (None, "v", "only null")]
    found = warc.revisit_resolution(pages_of(spark, rows)).collect()
    assert len(found) == 4 and {r["record_type"] for r in found} == {"response"}


def test_empty_table(spark):
    assert warc.revisit_resolution(pages_of(spark, [])).collect() == []


def test_a_revisit_without_its_response(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages_of(spark, [(1, "u", "a"), (2, "u", "a")]), path)
    records = warc.read_archives(spark, path).filter("record_type = 'revisit'")
    (found,) = warc.resolved(records).collect()
    assert found["page_id"] == "2" and found["refers_to"] is None and found["payload_bytes"] is None


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_records_from_pieces_of_any_kind(size):
    """The parser takes what stands between line ends, wherever these are."""
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: i\r\nPage-Id: 1\r\nWARC-Target-URI: u\r\n"
    block = "HTTP/1.1 200 OK\r\n\r\n" + "a\r\n\r\n" * size
    record = f"{head}WARC-Payload-Digest: sha1:X\r\nContent-Length: {len(block)}{END}{block}{END}"
    pieces = (record * 3).encode().split(END.encode())[:-1]
    found = list(warc.parsed(("f", piece) for piece in pieces))
    assert [r["payload"] for r in found] == [("a\r\n\r\n" * size).encode()] * 3
    with pytest.raises(ValueError, match="ends within a record"):
        list(warc.parsed(("f", piece) for piece in pieces[:-1]))


@pytest.mark.parametrize("html", ["x\r\n", "\r\n", "x\r\n\r\n", "x\r\n\r\n\r\n", "x\r", "\r\nx\n\r\n"])
def test_a_last_payload_that_ends_in_line_ends(spark, tmp_path, html):
    """A file for every row, so that each record is the last of its file."""
    rows = [(i, f"u{i}", f"{i}{html}") for i in range(3)] + [(9, "u", html)]
    path = str(tmp_path / "archives")
    pages = pages_of(spark, rows)
    for row in rows:
        records = warc.archive_records(pages.filter(pages["page_id"] == row[0])).coalesce(1)
        records.write.mode("append").option("lineSep", warc.END).option("compression", "gzip").text(path)
    found = {int(r["page_id"]): bytes(r["payload"]).decode() for r in warc.read_archives(spark, path).collect()}
    assert found == {i: text for i, _, text in rows}


def test_what_is_left_of_a_record_still_stops_the_reader():
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: i\r\nPage-Id: 1\r\nWARC-Target-URI: u\r\n"
    block = "HTTP/1.1 200 OK\r\n\r\nbody\r\n"
    record = f"{head}WARC-Payload-Digest: sha1:X\r\nContent-Length: {len(block)}{END}{block}{END}".encode()
    end = END.encode()

    def pieces(file, data):
        """As Spark cuts a file: nothing stands behind the last separator."""
        cut = data.split(end)
        return [(file, piece) for piece in (cut if cut[-1] else cut[:-1])]

    both = [*pieces("f", record * 2), *pieces("g", record)]
    assert [r["payload"] for r in warc.parsed(iter(both))] == [b"body\r\n"] * 3
    for file, data in (("f", record[:-1]), ("f", record[:-2]), ("f", record[:-6])):
        with pytest.raises(ValueError):
            list(warc.parsed(iter([*pieces(file, data), *pieces("g", record)])))
