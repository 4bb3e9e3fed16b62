"""WARC archives of pages and a two-level index of their captures.

Archives hold one gzip member per record. Equal payloads are stored once: the page with the
largest page_id has the response, the others are revisits that name it. The index has a line per
record, sorted by reversed-host URL key, in gzip blocks of LINES lines; a directory holds the
first and last key and the byte range of each block, beside its file of blocks. A lookup takes a
table of URLs: by the key ranges of the files, one row per task that wrote the index, each distinct
key goes to the files that can hold it; tasks search these files' directories by bisection, read
the blocks that can hold their keys, and then the records' byte ranges.

Tasks write files of their own names into the shared folder; the tables of index lines and of
blocks say which files count.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.packed_ids import open_folder
from eventlake.llm.tables import new_path, parts, stored

#: Bytes after which a task starts another archive; index lines in a block; bytes read at once.
ARCHIVE, LINES, READ = 1 << 30, 1000, 1 << 23
DIRECTORY = ".directory"
DATE = "2024-01-01T00:00:00Z"
#: Characters of keys that the bounds of a file's keys have at most.
BOUND = 256
LINE = "key string, page_id long, path string, offset long, length long"
BLOCK = "first_key string, last_key string, path string, offset long, length long, lines long"
WANTED = "key string, path string, offset long, length long"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: http://a.Example.com/x?y is com,example,a)/x?y.
    Scheme, user, default port and fragment are left out; control characters and blanks are
    quoted. A null URL has the empty key, one that cannot be split is its own key."""
    url = quote(url or "", safe="".join(map(chr, range(33, 127))))
    try:
        parts_ = urlsplit(url)
        host, port = parts_.hostname or "", parts_.port
    except ValueError:
        return url
    if not host:
        return url
    place = ",".join(reversed(host.split(".")))
    default = {"http": 80, "https": 443}.get(parts_.scheme)
    place += f":{port}" if port and port != default else ""
    return f"{place}){parts_.path or '/'}" + (f"?{parts_.query}" if parts_.query else "")


def base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def record(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; refers_to makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    content = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(content)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + content + b"\r\n\r\n", 4, mtime=0)


def parsed(member: bytes) -> dict:
    """The fields of a record; a response whose payload does not have its digest raises."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    content = rest[: int(fields["Content-Length"])]
    http, _, payload = content.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload), base32(hashlib.sha1(payload).hexdigest())) != (size, digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one that was written")

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def write_archives(
    pages: DataFrame,
    folder: str,
    revisit_from: int = 0,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes a record per page and returns its index line (key, page_id, path, offset, length).

    The payload is the html in UTF-8, empty if it is null. Payloads under revisit_from bytes are
    never revisits. Rows that repeat the largest page_id of a payload are all responses. A page
    without page_id revisits a page that has one; if none has, all are responses."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    longest = rows.select("page_id", "sha1", F.octet_length("payload").alias("size"))
    winners = longest.where(f"size >= {int(revisit_from)}").groupBy("sha1").agg(F.max("page_id").alias("response"))
    joined = rows.join(stored(winners, "responses"), "sha1", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = out = path = None
        at = 0
        for batch in batches:
            lines = []
            for row in batch.to_pylist():
                if out is None or at >= ARCHIVE:
                    if out:
                        out.close()
                    path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    system, place = open_folder(path)
                    system.create_dir(os.path.dirname(place), recursive=True)
                    out = system.open_output_stream(place, compression=None)
                page, response = row["page_id"], row["response"]
                refers_to = None if response is None or response == page else response
                payload = row["payload"]
                member = record(page, row["url"], payload, base32(row["sha1"]), len(payload), refers_to)
                out.write(member)
                lines.append((url_key(row["url"]), page, path, at, len(member)))
                at += len(member)
            yield _batch(lines, LINE)
        if out:
            out.close()

    return stored(joined.mapInArrow(write, LINE), "lines")


def write_index(lines: DataFrame, folder: str) -> DataFrame:
    """Writes index lines in key order as compressed blocks, and beside each file of blocks its
    directory; returns the directory of all blocks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at = f"{folder}/{uuid.uuid4().hex}.cdx.gz", None, 0
        held: list[tuple] = []
        entries: list[tuple] = []

        def flush() -> tuple:
            nonlocal out, at
            if out is None:
                system, place = open_folder(path)
                system.create_dir(os.path.dirname(place), recursive=True)
                out = system.open_output_stream(place, compression=None)
            text = "".join(f"{key} {json.dumps(rest)}\n" for key, *rest in held)
            block = gzip.compress(text.encode(), 6, mtime=0)
            out.write(block)
            at += len(block)
            entries.append((held[0][0], held[-1][0], at - len(block), len(block)))
            return (held[0][0], held[-1][0], path, at - len(block), len(block), len(held))

        for batch in batches:
            blocks = []
            columns = (batch.column(c).to_pylist() for c in ("key", "page_id", "path", "offset", "length"))
            for line in zip(*columns, strict=True):
                held.append(line)
                if len(held) == LINES:
                    blocks.append(flush())
                    held = []
            yield _batch(blocks, BLOCK)
        last = [flush()] if held else []
        if out:
            out.close()
            system, place = open_folder(path + DIRECTORY)
            with system.open_output_stream(place, compression=None) as file:
                file.write(gzip.compress("".join(f"{json.dumps(x)}\n" for x in entries).encode(), 6, mtime=0))
        yield _batch(last, BLOCK)

    order = ["key", "page_id", "path", "offset"]
    ordered = lines.repartitionByRange(parts(lines.sparkSession), *order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(write, BLOCK), "blocks")


def file_directory(path: str) -> list[list]:
    """[first_key, last_key, offset, length] of the blocks of a file, in key order."""
    system, place = open_folder(path + DIRECTORY)
    with system.open_input_file(place) as file:
        return [json.loads(line) for line in gzip.decompress(file.read()).decode().splitlines()]


def block_lines(path: str, offset: int, length: int) -> list[tuple]:
    """(key, page_id, path, offset, length) of a block's lines."""
    system, place = open_folder(path)
    with system.open_input_file(place) as file:
        text = gzip.decompress(file.read_at(length, offset)).decode()
    split = (line.split(" ", 1) for line in text.splitlines())
    return [(key, *json.loads(rest)) for key, rest in split]


def _keys(urls: DataFrame, url: str) -> DataFrame:
    """The distinct keys of URLs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(url_key(x),) for x in batch.column(0).to_pylist()], "key string")

    return urls.select(F.col(url).cast("string").alias("url")).distinct().mapInArrow(run, "key string").distinct()


def _file_ranges(directory: DataFrame) -> list[tuple[str, str, str]]:
    """(low, high, path) of every file of blocks, in key order: bounds of its keys of at most BOUND
    characters. There are no more files than shuffle partitions when the index was written."""
    low = F.substring(F.min("first_key"), 1, BOUND).alias("low")
    high = F.concat(F.substring(F.max("last_key"), 1, BOUND), F.lit("\x7f")).alias("high")
    return sorted(tuple(r) for r in directory.groupBy("path").agg(low, high).select("low", "high", "path").collect())


def find_blocks(urls: DataFrame, directory: DataFrame, url: str = "url") -> DataFrame:
    """(key, path, offset, length): the blocks that can hold the captures of each distinct key of
    the URLs, by key within a file. Blocks are found by bisection in the directory of the file;
    a key that lies between two blocks has none."""
    ranges = _file_ranges(directory)
    highs = [x[1] for x in ranges]

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                at = bisect.bisect_left(highs, key)
                while at < len(ranges) and ranges[at][0] <= key:
                    found.append((ranges[at][2], key))
                    at += 1
            yield _batch(found, "path string, key string")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, entries, last = None, [], []
        for batch in batches:
            found = []
            for where, key in zip(batch.column("path").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if where != path:
                    path, entries = where, file_directory(where)
                    last = [x[1] for x in entries]
                at = bisect.bisect_left(last, key)
                while at < len(entries) and entries[at][0] <= key:
                    found.append((key, path, entries[at][2], entries[at][3]))
                    at += 1
            yield _batch(found, WANTED)

    wanted = _keys(urls, url).mapInArrow(files, "path string, key string")
    placed = wanted.repartitionByRange(parts(urls.sparkSession), "path", "key").sortWithinPartitions("path", "key")
    return placed.mapInArrow(blocks, WANTED)


def lookup(urls: DataFrame, directory: DataFrame, url: str = "url") -> DataFrame:
    """The index lines of all captures of the URLs, each once however often a URL occurs. Null and
    empty URLs have the empty key; URLs without captures have no line."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lines, keys = None, [], []
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                key, *now = row.values()
                if now != block:
                    block, lines = now, block_lines(*now)
                    keys = [x[0] for x in lines]
                found += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
                if len(found) >= 10 * LINES:
                    yield _batch(found, LINE)
                    found = []
            yield _batch(found, LINE)

    return find_blocks(urls, directory, url).mapInArrow(read, LINE)


def _ranges(lines: Iterable[dict]) -> Iterator[list[dict]]:
    """Lines whose records lie behind each other in a file, up to READ bytes."""
    held: list[dict] = []
    for line in lines:
        if held:
            last = held[-1]
            apart = (line["path"], line["offset"]) != (last["path"], last["offset"] + last["length"])
            if apart or line["offset"] - held[0]["offset"] > READ:
                yield held
                held = []
        held.append(line)
    if held:
        yield held


def read_records(lines: DataFrame, payloads: bool = False) -> DataFrame:
    """The records that index lines point to, by range reads in archive order; without payloads
    unless asked for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = file = None
        for batch in batches:
            for run in _ranges(batch.to_pylist()):
                if run[0]["path"] != path:
                    if file:
                        file.close()
                    path = run[0]["path"]
                    system, place = open_folder(path)
                    file = system.open_input_file(place)
                base = run[0]["offset"]
                data = file.read_at(run[-1]["offset"] + run[-1]["length"] - base, base)
                found = [parsed(data[x["offset"] - base : x["offset"] - base + x["length"]]) for x in run]
                yield _batch([(*list(x.values())[:-1], x["payload"] if payloads else None) for x in found], RECORD)

    by_file = lines.repartition(parts(lines.sparkSession), "path").sortWithinPartitions("path", "offset")
    return by_file.mapInArrow(read, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame, revisit_from: int = 0, url: str = "url") -> DataFrame:
    """Writes the pages' archives and index into the shared folder, looks all pages' URLs up in the
    index and reads the records it names."""
    folder = new_path(spark, "warc")
    directory = write_index(write_archives(pages, f"{folder}/archives", revisit_from, url=url), f"{folder}/index")
    return read_records(lookup(pages, directory, url)).drop("payload")


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.strip().split(" ") for x in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])
