"""Language identification by unigrams over pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary, of whatever length; each language has a
probability per piece, learned by expectation maximisation. A word, a run of letters of any length,
has as its probability in a language the sum over all ways to cut it into pieces of the product of
their probabilities, which the forward algorithm gives without listing them: a letter's sum needs
those of as many letters before it as the longest piece has, whether they lie in the same stretch
of memory or not. A text's score is the product over its words. Tasks score each distinct word
once (tables of bounded size) and add up by position.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from eventlake.llm.chunks import slices
from eventlake.llm.tables import freed, settle
from eventlake.llm.words import BASE, mix

#: Training only: documents and distinct words per language, rounds, and the letters that a word is
#: cut into so that its sums stay within range. Scoring cuts no word.
DOCUMENTS, WORDS, ROUNDS, STRETCH = 400, 20000, 3, 24
#: Probability of a letter that no piece covers; what every piece is given beside its counts.
UNKNOWN, SMOOTH = 1e-7, 0.02
#: Factor per letter that keeps products within range, and letters after which sums are scaled anew.
SCALE, RESCALE = 64.0, 16
#: Training words at once; letters scored at once, in how long a stretch; bytes of text at once.
BATCH, LETTERS, SPAN, RUN = 4096, 1 << 16, 256, 1 << 18
#: Words kept with their scores, and the letters of one that is.
KEPT, KEPT_LETTERS = 1 << 17, 40
UNDETERMINED = "und"

#: Stands behind words in a table of code points; no piece has it.
_NO_LETTER = 1 << 40

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; the start marker before each is not written."""
    return _WORD.findall((text or "").lower())


def _points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, behind a marker (0)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)
    return np.concatenate([np.zeros((len(words), 1), np.uint32), flat], axis=1).astype(np.uint64)


@lru_cache(maxsize=2)
def vocabulary(model: str) -> tuple[np.ndarray, ...]:
    """Sorted hashes of the pieces by length (in code points, the marker included)."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = {library.id_to_piece(i).lower() for i in range(library.get_piece_size())}
    letters = [x for x in pieces if regex.fullmatch(r"▁?\p{L}+", x)]
    by_length: list[list[int]] = [[] for _ in range(max(map(len, letters), default=0) + 1)]
    for piece in letters:
        code = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in piece:
                code = code * BASE + np.uint64(0 if c == "▁" else ord(c)) + np.uint64(1)
        by_length[len(piece)].append(int(code))
    return tuple(mix(np.array(sorted(set(x)), dtype=np.uint64)) for x in by_length)


class Pieces:
    """Numbers of the pieces that occur in words."""

    def __init__(self, model: str) -> None:
        found = [np.sort(x) for x in vocabulary(model)]
        self.codes = found
        self.first = np.cumsum([0, *[len(x) for x in found]])
        self.size = int(self.first[-1])
        self.longest = len(found) - 1

    def at(self, points: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """For each length, the piece number (size if there is none) at every start."""
        out, code = [], np.zeros(points.shape, dtype=np.uint64)
        for length in range(1, min(self.longest, points.shape[1]) + 1):
            last = points[:, length - 1 :]
            code = code[:, : last.shape[1]] * BASE + last + np.uint64(1)
            known = self.codes[length]
            if not len(known):
                continue
            mixed = mix(code)
            place = np.minimum(np.searchsorted(known, mixed), len(known) - 1)
            out.append((length, np.where(known[place] == mixed, place + self.first[length], self.size)))
        return out


class Model:
    """Piece probabilities per language; the last row is for an uncovered letter."""

    def __init__(self, model: str, languages: list[str]) -> None:
        self.vocabulary, self.languages = model, languages
        size = Pieces(model).size
        self.share = np.full((size + 1, len(languages)), 1.0 / max(1, size))
        self._unknown()

    def _unknown(self) -> None:
        self.share[-1] = 0

    def forward(self, found: list[tuple[int, np.ndarray]], n: int, share: np.ndarray) -> np.ndarray:
        """Scaled sums over segmentations of every start of every word."""
        words = found[0][1].shape[0] if found else 0
        alpha = np.zeros((n + 1, words, share.shape[1]))
        alpha[0] = 1
        by_length = dict(found)
        for end in range(1, n + 1):
            total = alpha[end - 1] * (UNKNOWN * SCALE)
            for length in by_length:
                if length <= end:
                    total += alpha[end - length] * share[by_length[length][:, end - length]] * SCALE**length
            alpha[end] = total
        return alpha

    def backward(self, found: list[tuple[int, np.ndarray]], n: int, share: np.ndarray) -> np.ndarray:
        beta = np.zeros((n + 1, found[0][1].shape[0], share.shape[1]))
        beta[n] = 1
        for start in range(n - 1, -1, -1):
            total = beta[start + 1] * (UNKNOWN * SCALE)
            for length, piece in found:
                if start + length <= n:
                    total += beta[start + length] * share[piece[:, start]] * SCALE**length
            beta[start] = total
        return beta

    def log_scores(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        first = 0
        while first < len(order):
            longest = len(words[order[first]])
            # words of about the same length at once, few of them if they are long
            last = first + max(1, LETTERS // (longest + 1))
            last = next((i for i in range(first, min(last, len(order))) if len(words[order[i]]) > longest + longest // 8), min(last, len(order)))
            out[order[first:last]] = self._sums([words[i] for i in order[first:last]], pieces)
            first = last
        return out

    def _sums(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """Log sums over all segmentations, stretch by stretch; only the sums of as many letters as
        the longest piece has are kept. Each word's sums are scaled for each language alone."""
        lengths = np.array([len(x) + 1 for x in words])
        most, reach = int(lengths[-1]), pieces.longest
        points = np.full((len(words), most), _NO_LETTER, dtype=np.uint64)
        for row, word in enumerate(words):
            points[row, 0] = 0
            points[row, 1 : lengths[row]] = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out = np.zeros((len(words), len(self.languages)))
        logs = np.zeros_like(out)
        # sums before the letters of a stretch: place i holds those up to letter first - reach + i
        sums = np.zeros((reach + SPAN + 1, *out.shape))
        sums[reach] = 1
        for first in range(0, most, SPAN):
            last, back = min(most, first + SPAN), min(first, reach - 1)
            found = pieces.at(points[:, first - back : last])
            for end in range(first + 1, last + 1):
                at = reach + end - first
                total = sums[at - 1] * (UNKNOWN * SCALE)
                for length, piece in found:
                    start = end - length - (first - back)
                    if 0 <= start < piece.shape[1]:
                        total += sums[at - length] * self.share[piece[:, start]] * SCALE**length
                sums[at] = total
                done = np.flatnonzero(lengths == end)
                out[done] = np.log(total[done]) + logs[done]
                if end % RESCALE == 0:
                    factor = np.where(total > 0, total, 1.0)
                    sums[max(0, at - reach) : at + 1] /= factor
                    logs += np.log(factor)
            sums[: reach + 1] = sums[last - first : last - first + reach + 1].copy()
        return out - lengths[:, None] * np.log(SCALE)

    def fit(self, language: int, words: list[str], counts: np.ndarray, pieces: Pieces) -> None:
        """Expectation maximisation on the counted words of a language."""
        lengths = np.array([len(x) for x in words])
        share = self.share[:, [language]].copy()
        for _ in range(ROUNDS):
            expected = np.zeros(pieces.size + 1)
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                for at in range(0, len(rows), BATCH):
                    part = rows[at : at + BATCH]
                    found = pieces.at(_points([words[i] for i in part]))
                    alpha = self.forward(found, n + 1, share)
                    beta = self.backward(found, n + 1, share)
                    weight = counts[part] / alpha[n + 1][:, 0]
                    for length, piece in found:
                        starts = n + 2 - length
                        mass = alpha[:starts, :, 0] * beta[length : length + starts, :, 0] * weight
                        mass *= share[piece[:, :starts].T, 0] * SCALE**length
                        expected += np.bincount(piece[:, :starts].T.reshape(-1), mass.reshape(-1), pieces.size + 1)
            expected[-1] = 0
            smooth = expected[:-1] + SMOOTH
            share[:-1, 0] = smooth / smooth.sum()
        self.share[:, [language]] = share


class Scorer:
    """Scores texts by a table of distinct words, of one size from the start. Words too long to be
    kept are scored whenever they come."""

    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, Pieces(model.vocabulary)
        self.codes: dict[str, int] = {}
        self.table = np.empty((KEPT, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        new = [x for x in words if x not in self.codes]
        if len(self.codes) + len(new) > KEPT:
            self.codes.clear()
            new = list(words)
        if new:
            first = len(self.codes)
            self.table[first : first + len(new)] = self.model.log_scores(new, self.pieces)
            self.codes.update(zip(new, range(first, first + len(new)), strict=True))

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """The likeliest language of each text and its probability among the languages."""
        documents = [words_of(x) for x in texts]
        every = {w for words in documents for w in words if len(w) <= KEPT_LETTERS}
        at_once = len(every) <= KEPT // 2
        if at_once:
            self._learn(every)
        for words in documents:
            if not words or not self.model.languages:
                yield UNDETERMINED, 0.0
                continue
            short = [w for w in words if len(w) <= KEPT_LETTERS]
            total = np.zeros(len(self.model.languages))
            for at in range(0, len(short), KEPT // 2):
                part = short[at : at + KEPT // 2]
                if not at_once:
                    self._learn(set(part))
                code = np.fromiter(map(self.codes.__getitem__, part), dtype=np.int64, count=len(part))
                total += self.table[code].sum(axis=0)
            if len(short) < len(words):
                long = Counter(w for w in words if len(w) > KEPT_LETTERS)
                total += np.array(list(long.values())) @ self.model.log_scores(list(long), self.pieces)
            best = int(total.argmax())
            yield self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def held_out(doc_id: str, modulus: int = 5, remainder: int = 0):
    """Rows kept away from training: by the crc32 of the id as text. Null ids are not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def trained(
    documents: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """A model of the languages that occur among documents that are not held out: per language
    about DOCUMENTS of them, by a hash of the id, and their WORDS most frequent words. Null
    texts, languages and ids do not train; the language `und` is not learned."""
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        (F.col("lang") != UNDETERMINED) & F.col("id").isNotNull()
    )
    rows = rows.where(~held_out("id"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("text").alias("n")).collect() if r.n}
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    share = F.lit(0.0)
    for language, n in counts.items():
        share = F.when(F.col("lang") == language, min(1.0, DOCUMENTS / n)).otherwise(share)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for language, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(value)
                found.update((language, w[i : i + STRETCH]) for w in words for i in range(0, len(w), STRETCH))
            rows = [(language, word, n) for (language, word), n in found.items()]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])

    sample = rows.where((draw < share) & F.col("text").isNotNull()).select("lang", "text")
    found = sample.mapInArrow(freed(split), "lang string, word string, n long")
    total = found.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    kept = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= WORDS).collect()
    model = Model(vocabulary, languages)
    pieces = Pieces(vocabulary)
    for i, language in enumerate(languages):
        own = sorted((r.word, r.n) for r in kept if r.lang == language)
        if own:
            model.fit(i, [word for word, _ in own], np.array([n for _, n in own], dtype=np.float64), pieces)
    return model


def identified(
    documents: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Every row with two more columns: the likeliest language and its probability among the
    learned ones; `und` and 0 for a null text, one without letters, or if none was learned.
    Other columns and repeated rows stay as they are; columns of the new names are replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [x for part in slices(batch.column(text), RUN) for x in scorer(part.to_pylist())]
            columns = list(zip(*found, strict=True)) if found else [(), ()]
            added = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())]
            kept = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, *added], [*others, lang_pred, score])

    settle(documents.sparkSession)
    others = [c for c in documents.columns if c not in (lang_pred, score)]
    rows = documents.select(*(F.col(f"`{c}`") for c in others))
    schema = StructType(rows.schema.fields + [StructField(lang_pred, StringType()), StructField(score, DoubleType())])
    return rows.mapInArrow(freed(run), schema)
