"""SentencePiece encoding and decoding by a table of distinct marked words.

Where no piece of the vocabulary has a whitespace marker behind another character, no merge
crosses the start of a marked word, and a text's ids are its words' ids in order. Each task
segments a distinct word once (tables of bounded size) and gathers ids by position. A model that
does not have this property, or normalizes text, gets whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from eventlake.llm.chunks import ChunkTable, Ids, marked_lists, slices
from eventlake.llm.tables import freed, settle

def splits_at_markers(model: str) -> bool:
    """Whether words can be segmented one by one with the same result."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    rules = proto.normalizer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    own = not rules.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix
    return bool(plain and own and not any(re.search("[^▁]▁", x.piece) for x in proto.pieces))


class Encoder:
    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.by_word = splits_at_markers(model)
        self.marker = [self.library.piece_to_id("▁")]
        self.ends = [np.array([x], dtype=np.uint32) for x in (self.library.bos_id(), self.library.eos_id())]
        self.table = ChunkTable(self._words)

    def _words(self, words: list[str]) -> Ids:
        found = self.library.encode(words, num_threads=1)
        return Ids.of([ids if word else self.marker for word, ids in zip(words, found, strict=True)])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids with the begin and end ids."""
        if self.by_word:
            found = self.table.ids(marked_lists(texts))
        else:
            found = (np.array(x, dtype=np.uint32) for x in self.library.encode(texts.to_pylist(), num_threads=1))
        for ids in found:
            yield np.concatenate([self.ends[0], ids, self.ends[1]])

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def encode_decode(
    documents: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Every row with two more columns in place of its text: the ids, little-endian unsigned
    32-bit integers with the begin and end ids, and the library's decode of them.

    A null or empty text has the begin and end ids only and decodes to the empty text. Other
    columns and repeated rows stay as they are; columns of the new names are replaced. model is
    a path that every machine has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            done = 0
            for group in slices(batch.column(text)):
                found = list(encoder.encode(group))
                added = [
                    pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()),
                    pa.array([encoder.decode(x) for x in found], pa.string()),
                ]
                part = [batch.column(c).slice(done, len(group)) for c in others]
                yield pa.RecordBatch.from_arrays([*part, *added], [*others, ids, decoded])
                done += len(group)

    settle(documents.sparkSession)
    others = [c for c in documents.columns if c not in (text, ids, decoded)]
    fields = [documents.schema[c] for c in others]
    schema = StructType(fields + [StructField(ids, BinaryType()), StructField(decoded, StringType())])
    return documents.select(*(F.col(f"`{c}`") for c in [*others, text])).mapInArrow(freed(run), schema)
