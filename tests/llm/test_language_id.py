import itertools
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from eventlake.llm import language_id as li

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


def piece_numbers(pieces):
    """Piece by text, from the same public file."""
    import regex
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {library.id_to_piece(i).lower() for i in range(library.get_piece_size())}
    return {x for x in texts if regex.fullmatch(r"▁?\p{L}+", x)}


def small_model():
    model = li.Model(PIECES, ["a", "b"])
    rng = np.random.default_rng(0)
    model.share[:-1] = rng.random(model.share[:-1].shape) / 1000
    return model


def plain_log(model, pieces, known, word):
    """The sum over every way to cut the marked word."""
    marked = "▁" + word
    total = np.zeros(2)
    for cuts in itertools.product((False, True), repeat=len(marked) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
        ways, start = np.ones(2), 0
        for end in ends:
            part = marked[start:end]
            share = np.zeros(2)
            if part in known:
                found = dict(pieces.at(li._points([part.replace("▁", "")]) if part[0] == "▁" else li._points([part])[:, 1:]))
                share = model.share[found[len(part)][0, 0]]
            if len(part) == 1:
                share = share + li.UNKNOWN
            ways = ways * share
            start = end
        total += ways
    return np.log(total)


@pytest.mark.parametrize("word", ["a", "the", "nation", "über", "ñoñó", "ωx"])
def test_forward_sums_all_segmentations(word):
    model, pieces = small_model(), li.Pieces(PIECES)
    want = plain_log(model, pieces, piece_numbers(pieces), word)
    assert np.allclose(model.log_scores([word], pieces)[0], want)


def plain_sums(model, numbers, word):
    """The forward sums of a marked word of any length, by logarithms and one piece at a time."""
    marked, sums = "▁" + word, [np.zeros(len(model.languages))]
    for end in range(1, len(marked) + 1):
        ways = [sums[end - 1] + np.log(li.UNKNOWN)]
        for start in range(max(0, end - 40), end):
            if marked[start:end] in numbers:
                ways.append(sums[start] + np.log(model.share[numbers[marked[start:end]]]))
        sums.append(np.logaddexp.reduce(ways))
    return sums[-1]


@pytest.fixture(scope="module")
def numbers():
    """The number of every piece."""
    pieces, known = li.Pieces(PIECES), piece_numbers(None)
    out = {}
    for x in known:
        points = li._points([x.replace("▁", "")])
        found = dict(pieces.at(points if x[0] == "▁" else points[:, 1:]))
        out[x] = found[len(x)][0, 0]
    return out


def test_no_length_is_cut(numbers, monkeypatch):
    """Words of 30 letters and more, texts without blanks over several stretches, every piece."""
    model, pieces = small_model(), li.Pieces(PIECES)
    assert pieces.longest == max(map(len, numbers)) > 8
    rng = np.random.default_rng(4)
    words = ["donaudampfschifffahrtsgesellschaftskapitän", "日本語の文章には空白がない" * 60, "a" * 700, "ñ"]
    words += ["".join(rng.choice(list("etaoinshrdlu"), n)) for n in (30, 40, 41, 256, 255, 257, 600)]
    words += [max(numbers, key=len).strip("▁") * 5]
    got = model.log_scores(words, pieces)
    want = np.array([plain_sums(model, numbers, w) for w in words])
    assert np.allclose(got, want, rtol=1e-9)
    for name, value in (("LETTERS", 100), ("SPAN", 17)):
        monkeypatch.setattr(li, name, value)
        assert np.allclose(model.log_scores(words, pieces), want, rtol=1e-9)


def test_whole_texts(numbers, monkeypatch):
    """Texts against the plain sums of their words, whatever is kept and taken at once."""
    model = small_model()
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["Haus", "the", "donaudampfschiff" * 4, "été", "日本" * 30, "x", "of"], n)) for n in (1, 7, 40, 3)]
    want = []
    for text in texts:
        total = sum(plain_sums(model, numbers, w) for w in li.words_of(text))
        best = int(total.argmax())
        want.append((model.languages[best], 1 / np.exp(total - total[best]).sum()))
    for kept in (1 << 17, 4):
        monkeypatch.setattr(li, "KEPT", kept)
        got = list(li.Scorer(model)([*texts, None, "12"]))
        assert [g[0] for g in got] == [w[0] for w in want] + ["und"] * 2
        assert np.allclose([g[1] for g in got[:-2]], [w[1] for w in want], rtol=1e-6)


def test_fit_raises_the_likelihood():
    model, pieces = li.Model(PIECES, ["a"]), li.Pieces(PIECES)
    words, counts = ["the", "nation", "then", "other"], np.array([5.0, 2.0, 3.0, 1.0])
    before = model.log_scores(words, pieces)[:, 0] @ counts
    model.fit(0, words, counts, pieces)
    assert model.log_scores(words, pieces)[:, 0] @ counts > before
    assert math.isclose(model.share[:-1, 0].sum(), 1)


def test_words():
    assert li.words_of("Éa1b_c d-E 日本 ²½") == ["éa", "b", "c", "d", "e", "日本"]
    assert [len(x) for x in li.words_of("x" * 60)] == [60]
    assert li.words_of(None) == li.words_of("12 .") == []


def test_held_out_accuracy_and_input_columns(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.trained(documents, PIECES)
    rows = {r.doc_id: r for r in documents.collect()}
    found = li.identified(documents.select("doc_id", "text"), model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    out = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum(r.lang_pred == rows[r.doc_id].lang for r in out) / len(out)
    assert right > 0.98
    # lang and source are no inputs
    blind = documents.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    again = {r.doc_id: r for r in li.identified(blind, model).collect()}
    assert all(again[r.doc_id].lang_pred == r.lang_pred and again[r.doc_id].score == r.score for r in found)
    assert again[found[0].doc_id].lang == "xx"


def test_odd_rows(spark):
    rows = [(i, "le chat est de la maison que" if i % 2 else "the house of and that is", "fr" if i % 2 else "en", 1.0) for i in range(60)]
    rows += [(100, None, "en", 0.0), (101, "", None, 0.0), (102, "12 34 !", "fr", 0.0), (None, "the and of", None, 0.0),
             (103, "q" * 50_000, None, 0.0), (104, "the house", "und", 0.0), (104, "the house", "und", 0.0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = li.trained(table, PIECES)
    assert model.languages == ["en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identified(table, model).collect()}
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[None][0] == got[104][0] == "en" and got[1][0] == "fr" and got[103][0] in ("en", "fr")
    nothing = li.trained(table.limit(0), PIECES)
    assert {r.lang_pred for r in li.identified(table, nothing).collect()} == {"und"}
    assert li.identified(table.limit(0), model).collect() == []


def test_the_fold(spark):
    got = spark.range(2000).select("id", li.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
