import base64
import gzip
import hashlib

import pytest

from eventlake.llm import warc

SCHEMA = "page_id long, url string, html string, path string"


def plain(rows, least=0):
    best = {}
    for page, _, html, _ in rows:
        if page is not None:
            best[html or ""] = max(page, best.get(html or "", page))
    out = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        response = best.get(html or "") if len(body) >= least else None
        first = response is None or response == page
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if first else "revisit", None if first else response))
    return sorted(out, key=str)


def odd_rows():
    rows = [(i, f"http://h{i % 7}.example.com/p/{i}?q={i}", f"<p>{i % 40}</p>", "x") for i in range(200)]
    return [
        *rows, (900, None, None, None), (901, "", "", "x"), (902, "not a url", "é𝔘" * 5000, "x"), (903, "http://[bad", "x", "x"),
        (904, "http://a.b/x y\r\nInjected: 1", "Content-Length: 5\r\n\r\nabc", "x"), (199, rows[199][1], rows[199][2], "x"),
        (None, "http://h1.example.com/n", "<p>1</p>", "x"), (None, "http://only.example.com/", "only here", "x"), (-5, "ftp://f/", "only there", "x"),
    ]


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip(spark, least):
    rows = odd_rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    names = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    got = [tuple(r[x] for x in names) for r in warc.archive_round_trip(spark, table, least).collect()]
    assert sorted(got, key=str) == plain(rows, least)


def test_payloads_come_back_and_files_are_gzip_members(spark, tmp_path):
    rows = odd_rows()
    lines = warc.write_archives(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/a")
    got = warc.read_records(lines, payloads=True).collect()
    texts = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id is not None}
    assert all(bytes(texts[i]) == (h or "").encode() for i, _, h, _ in rows if i in texts)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("a/*.warc.gz"))
    assert whole.count(b"WARC/1.1\r\n") == len(rows) and b"\r\nInjected" not in whole


def by_key(rows, urls):
    wanted = {warc.url_key(u) for u in urls}
    return sorted(i for i, u, *_ in rows if warc.url_key(u) in wanted)


def looked_up(spark, tmp_path, rows, urls):
    """The page ids found, the blocks that were read, and all blocks."""
    lines = warc.write_archives(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/a")
    directory = warc.write_index(lines, f"{tmp_path}/i")
    asked = spark.createDataFrame([(u, "x") for u in urls], "url string, path string").repartition(3)
    read = {(r.path, r.offset) for r in warc.find_blocks(asked, directory).collect()}
    found = warc.read_records(warc.lookup(asked, directory)).collect()
    return sorted(r.page_id for r in found), read, directory.collect()


def test_lookup_by_directory_and_range_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 10)
    rows = [(i, f"http://h{i % 50}.example.com/p", f"<p>{i}</p>", "x") for i in range(400)]
    urls = ["https://h0.EXAMPLE.com/p", "http://h7.example.com:80/p#x", "http://h49.example.com/p", "http://nowhere.example.com/",
            "http://h7.example.com/p", "", None]
    got, read, blocks = looked_up(spark, tmp_path, rows, urls)
    assert got == by_key(rows, urls) and len(got) == 24
    # a key of eight lines lies in three blocks at most (two, or the ends of two files)
    assert 3 <= len(read) <= 9 < len(blocks)
    keys = [k for b in sorted(blocks) for k in (b.first_key, b.last_key)]
    assert keys == sorted(keys)


def test_lookup_of_a_key_that_fills_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 10)
    long_ = "http://long.example.com/" + "y" * 5000
    rows = [(i, "http://hot.example.com/" if i % 3 else f"http://h{i}.example.com/", f"{i}", "x") for i in range(600)]
    rows += [(1000 + i, long_ + str(i % 3), "long", "x") for i in range(60)] + [(2000 + i, None, "none", "x") for i in range(30)]
    urls = ["http://hot.example.com/"] * 50 + [long_ + "1", long_ + "7", None, "http://h3.example.com/", "http://[bad"]
    got, read, blocks = looked_up(spark, tmp_path, rows, urls)
    assert got == by_key(rows, urls) and len(got) == 400 + 20 + 30 + 1
    assert len({path for path, _ in read}) > 2 and len(read) < len(blocks)


def test_lookup_in_an_empty_index_and_of_no_urls(spark, tmp_path):
    assert looked_up(spark, tmp_path / "e", [], ["http://a/", None])[0] == []
    assert looked_up(spark, tmp_path / "n", odd_rows(), [])[:2] == ([], set())


def test_a_changed_payload_is_noticed():
    member = gzip.decompress(warc.record(1, "http://a/", b"payload", "A" * 32, 7, None))
    with pytest.raises(ValueError):
        warc.parsed(gzip.compress(member))


def test_keys():
    key = warc.url_key
    assert key("HTTP://user@A.Example.com:80/x?y#z") == "com,example,a)/x?y"
    assert key("https://a.example.com:8080") == "com,example,a:8080)/"
    assert key(None) == key("") == "" and " " not in key("a b\tc\n")


def test_empty_table(spark):
    assert warc.archive_round_trip(spark, spark.createDataFrame([], SCHEMA)).collect() == []
