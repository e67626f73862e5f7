"""Personal data by weak supervision.

Base spans come from four fixed rules (email, ip, card, phone).  Beyond them,
candidate spans (written-out email addresses, phone numbers without a country
code, grouped or mistyped card numbers, versions of IP addresses in brackets)
are voted on by labelling functions of three sorts: patterns of the span
itself, gazetteers (mail hosts' endings, area words, units) and the context
around it.  A labeller votes for, against, or not at all.

How reliable each labeller is comes from expectation-maximisation over the
counts of all vote patterns of all texts, counted by Spark; a pattern table
has at most 3^labellers rows per kind.  Base spans take part in it with their
own votes, which anchors what a true span looks like.  The posterior of each
pattern then labels a bounded sample of candidates, and a logistic span
classifier over shape, context and vote features is trained on it.  Candidates
it scores at `threshold` or more become spans; base spans always stay.

Defined cases: null counts as empty; without candidates nothing is added.
Overlapping added spans of a kind: the earlier, then the longer stays, and
none may overlap a base span.  Rows are judged one by one; other columns stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import hash_sample, small_batches, strings, table, written

KINDS = ("email", "ip", "card", "phone")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DIGIT = re.compile("[0-9]")

# Candidates beyond the base rules.
_USER, _HOST, _PART = r"[A-Za-z0-9._%+-]{2,64}", r"[A-Za-z0-9-]{2,63}", r"[A-Za-z0-9-]{2,24}"
LOOSE = {
    "email": re.compile(rf"{_USER} ?[\[({{<] ?(?:at|@) ?[\])}}>] ?{_HOST}(?: ?[\[({{<]? ?(?:\.|dot) ?[\])}}>]? ?{_PART}){{1,4}}"
                        rf"|{_USER} at {_HOST}(?: dot {_PART}){{1,4}}|{_USER} ?@ ?{_HOST}(?: ?\. ?{_PART}){{1,4}}", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])|(?<![0-9])[0-9]{4}(?:[ ./-][0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
                        r"|(?<![0-9])00[0-9]{1,3}(?:[ ./-][0-9]{2,4}){2,5}(?![0-9])"),
}
# what any match of LOOSE["email"] holds, lower-cased: every bracket it takes, with and without a blank
_WRITTEN_OUT = ("@", " dot ", *(f"{b}{blank}at" for b in "[({<" for blank in ("", " ")))

# Gazetteers (fixed lists).
HOST_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "de", "fr", "es", "uk", "eu", "io")
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write", "reach", "address", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "from", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "contact", "reach", "sms"),
}
AGAINST = ("version", "order", "invoice", "isbn", "issue", "page", "total", "id", "serial", "token", "hash", "chapter")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches of EMAIL, tried only where an @ stands."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.fullmatch(text[start - 1]):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base rules, by start, then kind as listed."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


# candidates and their labellers -----------------------------------------------

VOTERS = ("shape", "checksum or ending", "context before", "context after", "neighbours", "counter words")


@dataclass(frozen=True)
class Settings:
    context: int = 40
    rounds: int = 60
    #: The bounded sample of each kind that its span classifier is trained on.
    sample: int = 20_000
    epochs: int = 300
    threshold: float = 0.8


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Loose matches that overlap no base span, at most one at a place and kind."""
    low, taken, at, out = text.lower(), [(a, b) for a, _, b in base], 0, []
    kinds = ["email"] if any(x in low for x in _WRITTEN_OUT) else []
    kinds += ["ip", "card", "phone"] if _DIGIT.search(text) else []
    for kind in kinds:
        out += [(m.start(), kind, m.end()) for m in LOOSE[kind].finditer(text)]
    out.sort(key=lambda x: (x[0], KINDS.index(x[1])))
    free = []
    for a, kind, b in out:
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at == len(taken) or taken[at][0] >= b:
            free.append((a, kind, b))
    return free


def votes(text: str, start: int, kind: str, end: int, s: Settings) -> tuple[int, ...]:
    """One vote of each labeller: 1 for, -1 against, 0 none."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    before = re.findall(r"[a-z-]+", text[max(0, start - s.context):start].lower())
    after = re.findall(r"[a-z-]+", text[end:end + s.context].lower())
    if kind == "email":
        shape = 1 if "@" in span or re.search(r"[\[({<] ?(at|@) ?[\])}>]", span, re.I) else -1
        check = 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in HOST_ENDINGS else -1
    elif kind == "ip":
        parts = re.findall("[0-9]+", span)
        shape = 1 if len(parts) == 4 and " " not in span else -1
        check = 1 if all(int(p) <= 255 for p in parts) else -1
    elif kind == "card":
        shape = 1 if 14 <= len(digits) <= 19 else -1
        check = 1 if luhn(digits) else -1
    else:
        shape = 1 if span[0] in "+(" or re.fullmatch(r"[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}", span) else -1
        check = 1 if 10 <= len(digits) <= 15 and digits.lstrip("0")[:1] not in ("", "1") else -1 if len(digits) < 10 else 0
    near = lambda words: any(w.strip("-") in CONTEXT[kind] for w in words)
    left, right = text[start - 1:start], text[end:end + 1]
    touches = (left.isalnum() or right.isalnum() or (left in "-./_=#" and left != "") or right in ("-", "/", "_", "="))
    return (shape, check, 1 if near(before[-4:]) else 0, 1 if near(after[:2]) else 0, -1 if touches else 1,
            -1 if any(w in AGAINST for w in before[-3:]) else 0)


@dataclass(frozen=True)
class Model:
    #: kind -> weights of the span classifier (bias first), and what EM found
    weights: dict[str, np.ndarray]
    reliability: dict[str, np.ndarray] = field(default_factory=dict)


def reliabilities(patterns: dict[tuple[int, ...], float], anchored: dict[tuple[int, ...], float], rounds: int):
    """Expectation-maximisation over vote patterns and their counts.

    Each labeller has, for true and for false spans, a chance of each vote;
    `anchored` patterns are known to be true.  Returns the share of true
    candidates, the chances [labeller, true?, vote], and each pattern's posterior.
    """
    rows = np.array(list(patterns) + list(anchored), int).reshape(-1, len(VOTERS)) + 1
    n = np.array([*patterns.values(), *anchored.values()], float)
    known = np.arange(len(n)) >= len(patterns)
    # start from the majority of votes
    post = np.where(known, 1.0, 1 / (1 + np.exp(-(rows - 1).sum(axis=1).astype(float))))
    index = np.arange(rows.shape[1])[None, :]
    for _ in range(rounds):
        free = n * ~known
        share = (1 + (free * post).sum()) / (2 + free.sum())
        chance = np.empty((rows.shape[1], 2, 3))
        for v in range(3):
            here = rows == v
            chance[:, 1, v] = 1 + (n * post) @ here
            chance[:, 0, v] = 1 + (n * (1 - post)) @ here
        chance /= chance.sum(axis=2, keepdims=True)
        odds = math.log(share / (1 - share)) + np.log(chance[index, 1, rows] / chance[index, 0, rows]).sum(axis=1)
        new = np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return share, chance, dict(zip(patterns, post[:len(patterns)], strict=True))


FEATURES = 1 + 3 * len(VOTERS) + 8


def features(text: str, start: int, kind: str, end: int, vote: tuple[int, ...], s: Settings) -> np.ndarray:
    span = text[start:end]
    out = np.zeros(FEATURES)
    out[0] = 1
    for k, v in enumerate(vote):
        out[1 + 3 * k + v + 1] = 1
    n = len(span)
    line = text[max(0, start - s.context):end + s.context]
    out[1 + 3 * len(VOTERS):] = (
        sum(map(str.isdigit, span)) / n, sum(map(str.isalpha, span)) / n, span.count(" ") / n,
        min(n, 60) / 60, ":" in text[max(0, start - 3):start], text[end:end + 1] in (",", ".", ";", "\n", ""),
        sum(map(str.isdigit, line)) / len(line), span.count("@"))
    return out


def span_classifier(x: np.ndarray, p: np.ndarray, s: Settings) -> np.ndarray:
    """Logistic regression on soft labels."""
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, s.epochs + 1):
        g = x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -50, 50))) - p) / len(p) + 1e-3 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def learn(df: DataFrame, text: str = "text", s: Settings = Settings()) -> Model:
    small_batches(df.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for t in strings(b.column(0)):
                t = t or ""
                base = base_spans(t)
                for known, spans in ((True, base), (False, candidates(t, base))):
                    for a, kind, e in spans:
                        v = votes(t, a, kind, e, s)
                        x = b"" if known else features(t, a, kind, e, v, s).astype(np.float32).tobytes()
                        rows.append((kind, known, bytes(c + 1 for c in v), x))
            kinds, known, vote, x = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(known, pa.bool_()),
                                              pa.array(vote, pa.binary()), pa.array(x, pa.binary())],
                                             names=["kind", "known", "vote", "x"])

    spans = df.select(text).mapInArrow(found, "kind string, known boolean, vote binary, x binary")
    # votes decide the label, so equal (votes, features) are one row with a count
    spans = written(df.sparkSession, spans.groupBy("kind", "known", "vote", "x").agg(F.count("*").alias("n")), "candidates")
    # 3^6 rows a kind at most
    counts = spans.groupBy("kind", "known", "vote").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    weights, reliability = {}, {}
    asked = {r["kind"] for r in counts if not r["known"]}
    for kind in KINDS:
        if kind not in asked:
            continue
        read = lambda known: {tuple(x - 1 for x in r["vote"]): r["n"] for r in counts  # noqa: B023, E731
                              if r["kind"] == kind and r["known"] == known}
        free, anchored = read(False), read(True)
        # true spans weigh as much as candidates at most, however many there are
        weight = min(1.0, sum(free.values()) / max(1, sum(anchored.values())))
        _, chance, post = reliabilities(free, {k: n * weight for k, n in anchored.items()}, s.rounds)
        # a sample of its own, so that a rare kind is learned beside frequent ones
        size = sum(r["rows"] for r in counts if r["kind"] == kind and not r["known"])
        rows = hash_sample(spans.filter((F.col("kind") == kind) & ~F.col("known")), ["vote", "x"], s.sample, size).collect()
        x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], float)
        p = np.array([post[tuple(v - 1 for v in r["vote"])] for r in rows])
        weights[kind], reliability[kind] = span_classifier(x, p, s), chance
    return Model(weights, reliability)


def added_spans(text: str, base: list[tuple[int, str, int]], model: Model, s: Settings) -> list[tuple[int, str, int]]:
    out, end_of = [], dict.fromkeys(KINDS, 0)
    for a, kind, e in candidates(text, base):
        if kind not in model.weights or a < end_of[kind]:
            continue
        x = features(text, a, kind, e, votes(text, a, kind, e, s), s)
        if x @ model.weights[kind] >= math.log(s.threshold / (1 - s.threshold)):
            out.append((a, kind, e))
            end_of[kind] = e
    return out


def personal_data(spark: SparkSession, df: DataFrame, model: Model, text: str = "text", out: str = "pii",
                  s: Settings = Settings()) -> DataFrame:
    """`df` with an array column `out` of spans (start, kind, end, base), by
    start, then kind as listed."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few weights per kind

    @F.arrow_udf("array<struct<start:int,kind:string,end:int,base:boolean>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_())]))
        for texts in batches:
            rows = []
            for t in strings(texts):
                base = base_spans(t or "")
                more = added_spans(t or "", base, shared.value, s)
                every = [(*x, True) for x in base] + [(*x, False) for x in more]
                every.sort(key=lambda x: (x[0], KINDS.index(x[1])))
                rows.append([dict(zip(("start", "kind", "end", "base"), x, strict=True)) for x in every])
            yield pa.array(rows, kind)

    return df.withColumn(out, spans.asNondeterministic()(F.col(text)))


def listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """`df` with every span in `text` replaced by <kind>; overlapping spans are
    one, named by the first.  Texts without spans are left as they are."""

    @F.arrow_udf("string")
    def replaced(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for t, found in zip(strings(texts), lists, strict=True):
            parts, at = [], 0
            for x in found.as_py() or ():
                if x["start"] >= at:
                    parts += [t[at:x["start"]], f"<{x['kind']}>"]
                at = max(at, x["end"])
            out.append("".join([*parts, t[at:]]) if parts else t)
        return pa.array(out, pa.string())

    return df.withColumn(text, replaced.asNondeterministic()(F.col(text), F.col(spans)))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = personal_data(spark, docs, learn(docs))
    base = F.filter("pii", lambda x: x.base)

    def count(kind: str) -> F.Column:
        return F.size(F.filter(base, lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    return marked.select("doc_id", *map(count, KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                         listed(F.col("pii")).alias("spans"),
                         F.size(F.filter("pii", lambda x: ~x.base)).cast("long").alias("n_added"))
