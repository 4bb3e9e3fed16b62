"""Personal data by weak supervision, in DataFrame operations.

Base spans are what four fixed patterns and their tests find; they always stay. Beside them,
looser patterns propose candidates: local phone numbers, social security numbers, e-mail
addresses written out, names of persons, secrets (runs of 16 or more letters and digits, both of
them), and numbers of 13 to 19 digits that are no base card. Labelers vote on each candidate for
(1), against (-1) or not at all (0): a strict pattern, a gazetteer (for secrets: a key word and an
assignment right before), the words before it, its edges, and the entropy of its characters.
Expectation maximisation over the counts of vote patterns estimates how reliable each labeler
is; its posteriors train a logistic classifier over votes, kind and length, which decides on
every candidate. What reaches the driver is one row per pattern of votes and features, at most a
few hundred whatever the input.

Starts of matches are running sums over the lengths of what lies between matches (split) and of
the matches (regexp_extract_all): both find the same ones, leftmost and non-overlapping.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of base spans in the order of the contract, and of added spans.
BASE = ("email", "ip", "card", "phone")
ADDED = ("email_text", "phone_local", "ssn", "person", "secret", "number")
KINDS = (*BASE, *ADDED)

#: The base patterns, fixed by the contract. A match can only start where the run of characters
#: that its first part takes starts, or where the match before ended (\G): from inside a run the
#: rest is the same. Saying so, and possessive quantifiers, keep long runs linear; the matches
#: are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Frequent given names and top-level domains (the gazetteers), and words before a span that
#: speak for a kind or against any.
NAMES = (
    "Barbara Carlos Charles Christopher David Elizabeth François Heinrich James Jennifer Jessica Jonathan"
    " Joseph Jürgen Karen Klaus Linda Margaret Michael Nicolas Patricia Pierre Richard Robert Sarah Susan"
    " Thomas William Wolfgang Yolanda"
).split()
DOMAINS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "io")
FOR = {
    "email_text": r"mail|contact|write|reach",
    "phone_local": r"call|phone|tel|fax|mobile|cell|dial",
    "ssn": r"ssn|social|security",
    "person": r"name|dear|contact|regards|signed|sincerely|mr|mrs|ms|dr",
    "secret": r"token|secret|password|passwd|credential|bearer|auth|api.?key|access.?key|private.?key",
    "number": r"card|credit|visa|account|iban|konto",
}
#: Strict secrets: hexadecimal digits of a usual length, or capitals, small letters and digits.
SECRET = r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).{20,})$"
ASSIGNED = rf"(?:{FOR['secret']})[a-z_]*[\"']? ?(?:=|:|=>) ?[\"']?$"
AGAINST = r"version|order|invoice|isbn|item|page|chapter|model|part|serial|token"
CONTEXT = 40
#: Bits a character from which on characters look drawn at random, and below which they do not.
RANDOM, REGULAR = 3.0, 2.5

_NAME = "|".join(NAMES)
CANDIDATES = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]++)++"
    r"|(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
    rf"|(?<![A-Za-z])(?=[A-Z])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? |(?:{_NAME}) )[A-Z][a-z]++"
    r"|(?<![A-Za-z0-9_+/.%@=-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+=*+(?![A-Za-z0-9@])"
    r"|(?<![0-9.+-])(?<![0-9]\x20)[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
)

LABELERS = ("strict", "gazetteer", "context", "edges", "entropy")
#: Votes expected of a good labeler before any is seen (for, none, against), by class.
EXPECTED = {1: {1: 4.0, 0: 3.0, -1: 1.0}, 0: {1: 1.0, 0: 3.0, -1: 4.0}}
ROUNDS, STEPS, KEEP = 30, 200, 0.5


def _matched(found: Column, between: Column) -> Column:
    """array<struct<start, end, value>> of the matches found, given what lies between them."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["b"])
        end = start + F.length(pair["m"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b"))
    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, first, add, lambda x: x["spans"])).otherwise(empty)


def _with_matches(rows: DataFrame, text: str, pattern: str, name: str, needs: str | None = None) -> DataFrame:
    """Adds the spans of a pattern; a text without `needs` is not searched."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if needs:
        found = F.when(F.contains(F.col(text), F.lit(needs)), found).otherwise(F.array().cast("array<string>"))
    # one projection finds the matches, the next uses them several times
    rows = rows.withColumn(name, found)
    return rows.withColumn(name, _matched(F.col(name), F.split(F.col(text), pattern, -1)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda x: F.ltrim(x, F.lit("0")))
        return F.forall(
            parts, lambda x: F.when(F.length(x) <= 3, F.concat(F.lit("0"), x).cast("int") <= 255).otherwise(False)
        )
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _test(kind: str) -> Callable[[Column], Column]:
    return lambda span: _passes(kind, span["value"])


def _entropy(value: Column) -> Column:
    """Bits a character."""
    size = F.length(value)

    def add(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(value, char, F.lit("")))) / size
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(value, "")), F.lit(0.0), add)


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _free_prefix(columns: Iterable[str]) -> str:
    """Names that begin with it are no column's yet."""
    prefix = "_pii_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def _base(rows: DataFrame, prefix: str) -> DataFrame:
    """Adds a column per base kind with the spans that pass its test."""
    for kind, needs in (("email", "@"), ("ip", "."), ("card", None), ("phone", "+")):
        name = prefix + kind
        rows = _with_matches(rows, f"{prefix}text", PATTERNS[kind], name, needs)
        rows = rows.withColumn(name, F.filter(name, _test(kind)))
    return rows


def _labeled(text: Column, span: Column) -> Column:
    """Kind, features and votes of a candidate."""
    value = span["value"]
    kind = (
        F.when(F.rlike(value, F.lit(r"[(\[]at[)\]]")), "email_text")
        .when(F.rlike(value, F.lit(r"^(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/-]{16,}=*$")), "secret")
        .when(F.rlike(value, F.lit(r"^[0-9](?:[\x20-]?[0-9]){12,18}$")), "number")
        .when(F.rlike(value, F.lit(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")), "ssn")
        .when(F.rlike(value, F.lit(r"^[(0-9]")), "phone_local")
        .otherwise("person")
    )
    start = span["start"]
    before = F.lower(
        F.substr(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
    )
    left = F.when(start > 0, F.substr(text, start, F.lit(1))).otherwise("")
    right = F.substr(text, span["end"] + 1, F.lit(1))
    strict = (
        F.when(kind == "email_text", F.rlike(value, F.lit(r"[(\[](?:dot)[)\]]|\.[A-Za-z]{2,}$")))
        .when(kind == "ssn", F.rlike(value, F.lit(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")))
        .when(kind == "phone_local", F.rlike(value, F.lit(r"^\(?[2-9][0-9]{2}\)?([ .-])[2-9][0-9]{2}[ .-][0-9]{4}$")))
        .when(kind == "secret", F.rlike(value, F.lit(SECRET)))
        .when(kind == "number", F.when(F.length(_digits(value)) < 16, _luhn(_digits(value))).otherwise(False))
        .otherwise(F.rlike(value, F.lit(r" [A-Z][a-z]{2,}$")))
    )
    gazetteer = (
        F.when(kind == "email_text", F.when(F.rlike(value, F.lit(rf"(?:{'|'.join(DOMAINS)})$")), 1).otherwise(-1))
        .when(kind == "person", F.when(F.rlike(value, F.lit(rf"^(?:{_NAME}) ")), 1).otherwise(0))
        .when(kind == "secret", F.when(F.rlike(before, F.lit(ASSIGNED)), 1).otherwise(-1))
        .when(kind == "number", F.when(F.rlike(value, F.lit("^[3-6]")), 0).otherwise(-1))
        .otherwise(0)
    )
    speaks = F.lit(False)
    for name, words in FOR.items():
        speaks = F.when(kind == name, F.rlike(before, F.lit(rf"\b(?:{words})"))).otherwise(speaks)
    context = F.when(speaks, 1).when(F.rlike(before, F.lit(rf"\b(?:{AGAINST})")), -1).otherwise(0)
    apart = ~F.rlike(left, F.lit(r"[\p{L}0-9]")) & ~F.rlike(right, F.lit(r"[\p{L}0-9]"))
    length = span["end"] - start
    bits = F.when(kind == "secret", _entropy(value))
    return F.struct(
        start.alias("start"),
        span["end"].alias("end"),
        kind.alias("kind"),
        F.when(length <= 12, 0).when(length <= 24, 1).otherwise(2).alias("length"),
        F.when(strict, 1).otherwise(-1).alias("strict"),
        gazetteer.alias("gazetteer"),
        context.alias("context"),
        F.when(apart, 0).otherwise(-1).alias("edges"),
        F.when(bits >= RANDOM, 1).when(bits < REGULAR, -1).otherwise(0).alias("entropy"),
    )


def _candidates(documents: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds the base spans and the labeled candidates that touch none of them."""
    rows = _base(documents.withColumn(f"{prefix}text", F.coalesce(F.col(text), F.lit(""))), prefix)
    found = f"{prefix}found"
    rows = _with_matches(rows, f"{prefix}text", CANDIDATES, found)
    taken = f"{prefix}taken"
    rows = rows.withColumn(taken, F.concat(*(F.col(prefix + k) for k in BASE)))

    def apart(x: Column) -> Column:
        return ~F.exists(taken, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))

    # named twice, so that the base spans are found once a text and not once a candidate
    free = F.when(F.size(taken) == 0, F.col(found)).otherwise(F.filter(found, apart))
    return rows.withColumn(found, F.transform(free, lambda x: _labeled(F.col(f"{prefix}text"), x)))


def reliabilities(counts: Iterable[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict], dict]:
    """Expectation maximisation over counted vote patterns: the share of true candidates, each
    labeler's vote probabilities by class, and the posterior of every pattern."""
    counts = list(counts)
    share = 0.5
    labelers = len(counts[0][0]) if counts else 0
    start = {c: {v: n / sum(e.values()) for v, n in e.items()} for c, e in EXPECTED.items()}
    table = [dict(start) for _ in range(labelers)]
    posterior: dict = {}
    for _ in range(ROUNDS):
        for votes, _n in counts:
            odds = math.log(share / (1 - share))
            odds += sum(math.log(t[1][v] / t[0][v]) for t, v in zip(table, votes, strict=True))
            posterior[votes] = 1 / (1 + math.exp(-odds))
        true = sum(n * posterior[v] for v, n in counts)
        share = (true + 2) / (sum(n for _, n in counts) + 4)
        for i, labeler in enumerate(table):
            for c in (1, 0):
                seen = dict(EXPECTED[c])
                for votes, n in counts:
                    seen[votes[i]] += n * (posterior[votes] if c else 1 - posterior[votes])
                labeler[c] = {v: x / sum(seen.values()) for v, x in seen.items()}
    return share, table, posterior


def features(kind: str, length: int, votes: tuple[int, ...]) -> list[float]:
    return [
        1.0,
        *(float(kind == k) for k in ADDED),
        float(length),
        *(float(v > 0) for v in votes),
        *(float(v < 0) for v in votes),
    ]


def fitted(documents: DataFrame, text: str = "text") -> list[float]:
    """Weights of the span classifier, trained on the posteriors over all candidates of the table.
    Without candidates all weights are zero but for the first, which rejects."""
    rows = _candidates(documents.select(F.col(text).alias("text")), "text", "_pii_")
    # an inner explode infers a filter on the array, which would find all spans a second time
    seen = rows.select(F.explode_outer("_pii_found").alias("c")).where("c is not null").select("c.*")
    seen = seen.groupBy("kind", "length", *LABELERS).agg(F.count("*").alias("n")).collect()
    data = [(r.kind, r.length, tuple(r[x] for x in LABELERS), r.n) for r in sorted(seen)]
    by_votes: dict = {}
    for _, _, votes, n in data:
        by_votes[votes] = by_votes.get(votes, 0) + n
    _, _, posterior = reliabilities(sorted(by_votes.items()))
    weights = [0.0] * len(features(ADDED[0], 0, (0,) * len(LABELERS)))
    if not data:
        return [-10.0, *weights[1:]]
    inputs = [(features(kind, length, votes), posterior[votes], n) for kind, length, votes, n in data]
    total = sum(n for _, _, n in inputs)
    for _ in range(STEPS):
        slope = [0.01 * w for w in weights]
        for x, truth, n in inputs:
            guess = 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x, strict=True))))
            for i, v in enumerate(x):
                slope[i] += n / total * (guess - truth) * v
        weights = [w - 1.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _accepted(candidate: Column, weights: list[float]) -> Column:
    terms = [F.lit(1.0), *(F.when(candidate["kind"] == k, 1.0).otherwise(0.0) for k in ADDED)]
    terms.append(candidate["length"].cast("double"))
    terms += [F.when(candidate[x] > 0, 1.0).otherwise(0.0) for x in LABELERS]
    terms += [F.when(candidate[x] < 0, 1.0).otherwise(0.0) for x in LABELERS]
    total = F.lit(0.0)
    for weight, term in zip(weights, terms, strict=True):
        total = total + F.lit(weight) * term
    return 1 / (1 + F.exp(-total)) >= KEEP


def with_spans(documents: DataFrame, weights: list[float], text: str = "text", name: str = "spans") -> DataFrame:
    """Adds the spans of every text: array<struct<place, start, end, kind, base>>, by kind as
    listed in KINDS (place) and then by start; positions count code points, ends are exclusive.

    A null or empty text has none. Rows, repeated ones too, and all other columns stay as they
    are; a column of the new name is replaced."""
    own = [c for c in documents.columns if c != name]
    prefix = _free_prefix(documents.columns)
    rows = _candidates(documents, text, prefix)

    def placed(spans: Column, kind: str, base: bool) -> Column:
        fields = F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"), F.lit(base).alias("base")
        return F.transform(spans, lambda x: F.struct(fields[0], x["start"], x["end"], *fields[1:]))

    added = F.filter(f"{prefix}found", lambda x: _accepted(x, weights))
    spans = [placed(F.col(prefix + k), k, True) for k in BASE]
    spans += [placed(F.filter(added, of_kind(k)), k, False) for k in ADDED]
    return rows.select(*(F.col(f"`{c}`") for c in own), F.array_sort(F.concat(*spans)).alias(name))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap the first
    counts, and the rest of the others goes with it."""
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["end"], x["kind"])))

    def replace(state: Column, span: Column) -> Column:
        at = state["at"]
        new = F.concat(
            state["out"],
            F.substr(text, at + 1, span["start"] - at),
            F.lit("["),
            F.upper(span["kind"]),
            F.lit("]"),
        )
        out = F.when(span["start"] >= at, new).otherwise(state["out"])
        return F.struct(F.greatest(at, span["end"]).alias("at"), out.alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text)))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(by_start, first, replace, finish)).otherwise(text)
