"""Token ids packed into the fewest bits the vocabulary needs.

A file holds, in this order:
  blocks         of BLOCK ids each (the last may be shorter), every id in `width` bits, lowest
                 bit first; ids are padded with zeros to a multiple of 64, so that a block is a
                 whole number of 64-bit words and 64 ids always fill `width` of them;
  block offsets  of all blocks and of their end, unsigned 64-bit;
  document ids   signed 64-bit, 0 for a document without an id;
  start of ids   of all documents and of their end, unsigned 64-bit, counted in ids;
  named          a bit for every document, lowest first: whether it has an id;
  trailer        magic, width, ids in a block, number of blocks, documents and ids.
All numbers are little-endian. Any range of ids is read by two offsets and one range read.

Files are written by tasks straight into the shared folder, under names of their own; a table of
the files written says which count, so that a task that ran twice leaves an unused file only.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.chunks import ChunkTable, Ids, blank_lists, slices
from eventlake.llm.tables import parts, settle, stored

BLOCK = 4096
MAGIC = b"PACKIDS2"
TRAILER = struct.Struct("<8sIIQQQ")
#: Ids read at once.
RUN = 1 << 20


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system that works the same on the driver and on executors, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit in {width} bits")
    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, dtype=np.uint64)
    padded[: len(ids)] = ids
    columns = padded.reshape(rows, 64)
    words = np.zeros((rows, width), dtype="<u8")
    for i in range(64):
        word, bit = divmod(i * width, 64)
        words[:, word] |= columns[:, i] << np.uint64(bit)
        if bit + width > 64:
            words[:, word + 1] |= columns[:, i] >> np.uint64(64 - bit)
    return words.tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    """All ids of whole blocks, the padding included."""
    words = np.frombuffer(data, dtype="<u8").reshape(-1, width)
    out = np.empty((len(words), 64), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, bit = divmod(i * width, 64)
        value = words[:, word] >> np.uint64(bit)
        if bit + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - bit))
        out[:, i] = value & mask
    return out.reshape(-1)


class Writer:
    """Appends documents; memory holds one block and the index."""

    def __init__(self, file, width: int) -> None:
        self.file, self.width = file, width
        self.held: list[np.ndarray] = []
        self.n_held = self.at = 0
        self.offsets, self.documents, self.starts = [0], [], [0]

    def _flush(self, all_: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, dtype=np.uint32)
        upto = len(ids) if all_ else len(ids) // BLOCK * BLOCK
        for first in range(0, upto, BLOCK):
            packed = pack(ids[first : min(first + BLOCK, upto)], self.width)
            self.file.write(packed)
            self.at += len(packed)
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def add(self, document: int | None, ids: np.ndarray) -> None:
        self.documents.append(document)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= RUN:
            self._flush(False)

    def close(self) -> None:
        self._flush(True)
        named = np.array([x is not None for x in self.documents], dtype=bool)
        documents = [x or 0 for x in self.documents]
        for values, kind in ((self.offsets, "<u8"), (documents, "<i8"), (self.starts, "<u8")):
            self.file.write(np.array(values, dtype=kind).tobytes())
        self.file.write(np.packbits(named, bitorder="little").tobytes())
        sizes = len(self.offsets) - 1, len(self.documents), self.starts[-1]
        self.file.write(TRAILER.pack(MAGIC, self.width, BLOCK, *sizes))
        self.file.close()


class Reader:
    """Random access to a file's ids."""

    def __init__(self, uri: str) -> None:
        system, path = open_folder(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        magic, self.width, self.block, blocks, documents, self.n_ids = TRAILER.unpack(
            self.file.read_at(TRAILER.size, size - TRAILER.size)
        )
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a file of packed ids")
        counts = blocks + 1, documents, documents + 1
        length = 8 * sum(counts) + -(-documents // 8)
        index = self.file.read_at(length, size - TRAILER.size - length)
        cut = np.cumsum([0, *counts]) * 8
        self.offsets = np.frombuffer(index[: cut[1]], dtype="<u8").astype(np.int64)
        self.documents = np.frombuffer(index[cut[1] : cut[2]], dtype="<i8")
        self.starts = np.frombuffer(index[cut[2] : cut[3]], dtype="<u8").astype(np.int64)
        bits = np.frombuffer(index[cut[3] :], dtype=np.uint8)
        self.named = np.unpackbits(bits, count=documents, bitorder="little").astype(bool)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop (exclusive) of the file."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        data = self.file.read_at(int(self.offsets[last] - self.offsets[first]), int(self.offsets[first]))
        return unpack(data, self.width)[start - first * self.block : stop - first * self.block]

    def document(self, position: int) -> np.ndarray:
        return self.ids(int(self.starts[position]), int(self.starts[position + 1]))

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id or None, its first id, its ids) in the order written, read in runs of
        blocks."""
        done = 0
        while done < len(self.documents):
            upto = max(done + 1, int(np.searchsorted(self.starts, self.starts[done] + RUN, side="right")) - 1)
            base = int(self.starts[done])
            run = self.ids(base, int(self.starts[upto]))
            for i in range(done, upto):
                start = int(self.starts[i])
                name = int(self.documents[i]) if self.named[i] else None
                yield name, start, run[start - base : int(self.starts[i + 1]) - base]
            done = upto


#: Chunks encoded in one call. The library is slow on a word it has not seen, so a worker keeps
#: many words, and looks up many bytes of text at once.
CALL, KEPT, SLICE = 500, 700_000, 5 << 20
#: A blank in the spelling of byte-level vocabularies.
BLANK = "\u0120"
#: ASCII signs but the apostrophe, which can start a contraction; letters up to here are Latin,
#: and letters by any version of Unicode.
SIGNS, LATIN_END = string.punctuation.replace("'", ""), "\u0250"


class Encoder:
    """Encodes chunks of text, many in a call, and keeps a table of them."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        #: Whether an id begins with a blank, as byte-level vocabularies write it.
        self.blank = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.blank[[i for x, i in vocabulary.items() if x.startswith(BLANK)]] = True
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        if any(len(x.split()) != 1 or x.strip() != x for x in self.special):
            raise ValueError("added tokens with white space cannot be found in chunks of text")
        self.table = ChunkTable(self._chunks, KEPT)

    def _alone(self, chunks: list[str]) -> Ids:
        return Ids.of([x.ids for x in self.library.encode_batch_fast(chunks, add_special_tokens=False)])

    def _chunks(self, chunks: list[str]) -> Ids:
        """A word and the signs behind it are always tokens apart, so they are encoded apart,
        and each only once; but for the added tokens, which may be made of both."""
        text = "\n".join(chunks)
        whole = [t for t in self.special if t in text]
        stems, tails = chunks.copy(), [""] * len(chunks)
        for i, x in enumerate(chunks):
            if x[-1:] in SIGNS and not any(t in x for t in whole):
                stem = x.rstrip(SIGNS)
                if stem and stem[-1].isalpha() and stem[-1] < LATIN_END:
                    stems[i], tails[i] = stem, x[len(stem) :]
        numbers = dict.fromkeys(chain(stems, tails))
        pieces = self._pieces(list(numbers))
        numbers = dict(zip(numbers, range(len(numbers)), strict=True))
        get = numbers.__getitem__
        code = np.array([list(map(get, stems)), list(map(get, tails))]).T
        return Ids(pieces.gather(code.reshape(-1)), pieces.lengths[code].sum(axis=1))

    def _pieces(self, pieces: list[str]) -> Ids:
        """Words behind a blank go to the library many at a time, which costs a third: each is
        tokens of its own, of which the first, and no other, begins with the blank."""
        word = np.array([x[:1] == " " and x[1:].isalpha() for x in pieces], dtype=bool)
        order, found = [], []
        for kind, encode in ((True, self._words), (False, self._alone)):
            rows = np.flatnonzero(word == kind)
            order.append(rows)
            for first in range(0, len(rows), CALL):
                found.append(encode([pieces[i] for i in rows[first : first + CALL]]))
        return Ids.joined(found).reordered(np.argsort(np.concatenate(order)))

    def _words(self, words: list[str]) -> Ids:
        encoded = self.library.encode_batch_fast(["".join(words)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, dtype=np.uint32)
        first = np.flatnonzero(self.blank[ids])
        if len(first) != len(words):
            return self._alone(words)
        return Ids(ids, np.diff(first, append=len(ids)))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        return self.table.ids(blank_lists(texts))


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str) -> Encoder:
    """One for each Python worker: its table serves all tasks that the worker runs."""
    return Encoder(tokenizer)


def write_packed(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    vocabulary: int,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encodes every text, appends end_id and writes packed files in ascending doc_id order.

    Returns the files (part, path, n_ids): the ids of all files, taken by part, are the ids of
    all documents by doc_id. A null or empty text is its end_id alone. Rows that repeat a doc_id
    stand beside each other, ordered by text. Rows with a null doc_id come after all others, by a
    hash of their text, which deals them over files; copies of one text are also dealt by the
    partition they come from, as they are alike. tokenizer is a path that every machine has."""
    width = bits_for(vocabulary)
    settle(documents.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = np.array([end_id], dtype=np.uint32)
        part = TaskContext.get().partitionId()
        writer = None
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            if names and writer is None:
                system, place = open_folder(path)
                system.create_dir(os.path.dirname(place), recursive=True)
                writer = Writer(system.open_output_stream(place), width)
            done = 0
            for group in slices(batch.column("text"), SLICE):
                for ids in encoder.encode(group):
                    writer.add(names[done], np.concatenate([ids, end]))
                    done += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int64()), "path": [path], "n_ids": pa.array([writer.starts[-1]], pa.int64())}
            )

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    unnamed, name = F.col("doc_id").isNull(), F.col("doc_id").asc_nulls_last()
    rows = rows.withColumn("place", F.when(unnamed, F.xxhash64("text")))
    rows = rows.withColumn("origin", F.when(unnamed, F.spark_partition_id()))
    ordered = (
        rows.repartitionByRange(parts(documents.sparkSession), name, "place", "origin")
        .sortWithinPartitions(name, "place", "text")
        .select("doc_id", "text")
    )
    return stored(ordered.mapInArrow(write, "part long, path string, n_ids long"), "files")


def read_packed(spark: SparkSession, files: DataFrame, unnamed: bool = False) -> DataFrame:
    """(doc_id, start, ids) of every document in the files that has an id, and with unnamed of
    those without one too, which come last; start counts the ids of all documents before it, ids
    are little-endian unsigned 32-bit integers. No files give no rows. The driver sees one row
    per file."""
    before, listed = 0, []
    for file in files.orderBy("part").collect():
        listed.append((file.path, before))
        before += file.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                rows, n = [], 0
                for document, start, ids in Reader(path):
                    if document is None and not unnamed:
                        continue
                    rows.append((document, base + start, ids.astype("<u4").tobytes()))
                    n += len(ids)
                    if n > RUN:
                        yield _rows(rows)
                        rows, n = [], 0
                yield _rows(rows)

    schema = "path string, base long"
    if not listed:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    places = spark.createDataFrame(listed, schema).repartition(len(listed))
    return places.mapInArrow(read, "doc_id long, start long, ids binary")


def _rows(rows: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
    doc, start, ids = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"]
    )
