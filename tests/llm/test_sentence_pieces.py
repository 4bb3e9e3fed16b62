import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import chunks
from eventlake.llm.sentence_pieces import Encoder, encode_decode, splits_at_markers

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = Encoder(MODEL)
ODD = ["", " ", "   ", " a", "a ", "a  b", "▁", "a▁ b", "a ▁b", "▁ ▁", "x\ny \n z", " x 　y", "a\x00b", "<s> </s>",
       "ﬁ ① É é", "日本 語", "𝔘 🙂", "w" * 4000, "1 2  3   4    5", "\t tab \t"]


def plain(text):
    return [LIBRARY.bos_id(), *LIBRARY.encode(text), LIBRARY.eos_id()]


def test_this_model_splits_at_markers():
    assert splits_at_markers(MODEL)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert next(ENCODER.encode(pa.array([text]))).tolist() == plain(text)


@given(st.lists(st.text(alphabet=st.sampled_from("abé▁ \n.1日"), max_size=25), max_size=5))
@settings(max_examples=300, deadline=None)
def test_as_the_library(texts):
    assert [x.tolist() for x in ENCODER.encode(pa.array(texts, pa.string()))] == [plain(x) for x in texts]


def test_whole_texts_where_words_do_not_stand_alone():
    other = Encoder(MODEL)
    other.by_word = False
    assert [x.tolist() for x in other.encode(pa.array(ODD))] == [plain(x) for x in ODD]


def test_a_full_table(monkeypatch):
    monkeypatch.setattr(chunks, "KEPT", 5)
    small = Encoder(MODEL)
    for _ in range(2):
        for text in ("a b c d", "e f g h i j k", "a b e f"):
            assert next(small.encode(pa.array([text]))).tolist() == plain(text)


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, *ODD])] + [(None, "no id", "x"), (1, "again", None), (1, "again", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in encode_decode(table, MODEL).collect()), key=str)
    assert got == sorted(((i, plain(t or ""), LIBRARY.decode(plain(t or ""))) for i, t, _ in rows), key=str)
    assert encode_decode(table.limit(0), MODEL).collect() == []
