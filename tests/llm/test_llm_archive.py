import base64
import hashlib

from quarrylake.llm import warc

PAGES = [
    (0, "http://a/", "<p>one</p>", "x"), (1, "http://b/", "<p>öne</p>", "x"), (2, "http://a/\r\nEvil: 1", "<p>one</p>", "x"),
    (3, None, None, "x"), (4, "u", "", "x"), (None, "v", "<p>one</p>", None), (5, "w", "big" * 50_000, "x"), (5, "w", "big" * 50_000, "x"),
]


def read(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    archive = warc.write_archive(pages, **options)
    return archive, warc.read_archive(spark, archive).collect()


def test_every_page_is_a_record_and_the_first_of_equal_payloads_the_response(spark):
    _, got = read(spark, PAGES)
    assert len(got) == len(PAGES)
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, []).append(r)
    for page_id, _, html, _ in PAGES:
        body = (html or "").encode()
        for r in by_id[page_id]:
            assert r.payload_bytes == len(body)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    kinds = {i: sorted((r.record_type, r.refers_to) for r in rows) for i, rows in by_id.items()}
    assert kinds[0] == [("response", None)] and kinds[2] == [("revisit", 0)] and kinds[None] == [("revisit", 0)]
    assert kinds[3] == [("response", None)] and kinds[4] == [("revisit", 3)]
    assert kinds[5] == [("response", None), ("revisit", 5)]


def test_small_payloads_are_all_responses(spark):
    _, got = read(spark, PAGES, least_bytes=11)
    assert sorted(r.page_id for r in got if r.record_type == "revisit") == [5]


def test_records_come_back_byte_for_byte_and_payloads_are_stored_once(spark):
    archive, _ = read(spark, PAGES)
    assert archive.payloads(spark).count() == len({(p[2] or "").encode() for p in PAGES})
    records = {(bytes(r.record), bytes(r.payload)) for r in warc.restored(spark, archive).collect()}
    assert len(records) == len(PAGES)  # record ids differ
    heads = {bytes(r.head) for r in archive.records(spark).collect()}
    for record, payload in records:
        head = next(h for h in heads if record.startswith(h))
        body = record[len(head):-4]
        outer, inner = head.split(b"\r\n\r\n")[:2]
        fields = dict(line.split(b": ", 1) for line in outer.split(b"\r\n")[1:])
        assert body == (b"" if fields[b"WARC-Type"] == b"revisit" else payload)
        assert int(fields[b"Content-Length"]) == len(inner) + 4 + len(body)
        assert b"Evil" not in fields


def test_an_empty_table_is_an_empty_archive(spark):
    assert read(spark, [])[1] == []
