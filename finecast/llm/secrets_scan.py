"""Secrets in text: fixed patterns, and strings that a battery of tests finds random."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finecast.llm.shared import present, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

#: Strings that the battery looks at: unbroken, with the symbols that it needs at least (two cells of five).  From
#: there on, evidence decides.
SHORTEST = 10
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
#: Parts of a run that are looked at besides the whole: of ``name=value``, and what stands between the characters
#: that an alphabet lacks.
PARTS = tuple(re.compile(rf"[{own}]+(?:=+\Z)?") for own in (r"A-Za-z0-9+/_-", r"A-Za-z0-9+/", r"A-Za-z0-9_-", r"A-Za-z0-9"))
#: Share of false finds among the strings reported, and level of the randomness tests.
FALSE_SHARE, LEVEL = 0.05, 0.001
#: Grid of log10 evidence; evidence is rounded down to it, which keeps the control valid.
STEP, HIGH = 0.05, 4000

#: Encodings from the narrowest: the first whose alphabet holds the whole string is taken.
ENCODINGS = tuple(
    (name, {c: i for i, c in enumerate(chars)})
    for name, chars in (
        ("digits", "0123456789"),
        ("hex", "0123456789abcdef"),
        ("HEX", "0123456789ABCDEF"),
        ("lower", "abcdefghijklmnopqrstuvwxyz"),
        ("UPPER", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
        ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
        ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
        ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
        ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    )
)
#: Classes of the text model: 26 letters without case, digits, + / _ -, all else.
_CLASSES = 29
_CLASS = np.full(256, 28, np.int64)
for _i in range(26):
    _CLASS[65 + _i] = _CLASS[97 + _i] = _i
_CLASS[48:58] = 26
_CLASS[[43, 47, 95, 45]] = 27


def _word_model() -> np.ndarray:
    """log10 probability of a letter after another in words of whatever language: vowels and consonants in turn, each by usual frequency."""
    share = np.array([8, 1.5, 3, 4, 12.5, 2, 2, 4, 7.5, 0.3, 1, 4.5, 2.7, 7, 7, 2, 0.15, 6.5, 6.5, 8, 3, 1.2, 1.5, 0.2, 1.2, 0.5])
    vowel = np.isin(np.arange(26), [0, 4, 8, 14, 20])
    out = np.full((_CLASSES, _CLASSES), 0.001)
    for before, to_vowel in ((vowel, 0.15), (~vowel, 0.55)):
        row = np.where(vowel, to_vowel * share / share[vowel].sum(), (1 - to_vowel) * share / share[~vowel].sum())
        out[:26][before, :26] = row
    out[:26, 27] = 0.1
    out[26:, :26] = share / share.sum()
    return np.log10(out / out.sum(axis=1, keepdims=True))


_WORDS = _word_model()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def other_strings(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidate strings that touch no base span: runs, and the parts of runs (which may overlap)."""
    out = []
    for m in CANDIDATE.finditer(text):
        spans, run = [m.span()], m[0]
        if not run.isalnum():
            spans += sorted({(m.start() + p.start(), m.start() + p.end()) for part in PARTS for p in part.finditer(run) if p.end() - p.start() >= SHORTEST} - {m.span()})
        out += [(a, b) for a, b in spans if not any(s < b and a < e for s, e, _ in base)]
    return out


def infer(string: str) -> tuple[str, np.ndarray, int] | None:
    """Encoding, symbol numbers and alphabet size; padding is no symbol.  None where no alphabet fits."""
    body = string.rstrip("=")
    used = set(body)
    for name, alphabet in ENCODINGS:
        if used <= alphabet.keys():
            return name, np.array([alphabet[c] for c in body]), len(alphabet)
    return None


def battery(x: np.ndarray, size: int) -> tuple[float, float, float]:
    """p-values of a uniform random string for: uniform use of the alphabet, runs about the middle, lag-one correlation.

    The alphabet is cut into as many equal cells as keep five symbols in each.
    """
    n = len(x)
    cells = max(2, min(size, n // 5))
    seen = np.bincount(x * cells // size, minlength=cells)
    expected = np.bincount(np.arange(size) * cells // size, minlength=cells) / size * n
    chi = float(((seen - expected) ** 2 / expected).sum())
    df = cells - 1
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    up = x >= size / 2
    a, b = int(up.sum()), int((~up).sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = math.erfc(abs(1 + int((up[1:] != up[:-1]).sum()) - mean) / math.sqrt(2 * var))
    else:
        runs = 2.0 ** (1 - n)
    d = x - (size - 1) / 2
    power = float((d * d).sum())
    r = float((d[1:] * d[:-1]).sum()) / power if power else 1.0
    serial = math.erfc(abs(r) * math.sqrt(n) / math.sqrt(2))
    return uniform, runs, serial


def evidence(string: str, size: int, model: np.ndarray) -> float:
    """log10 likelihood ratio of a uniform random string against the text model: an e-value, which grows with length."""
    raw = np.frombuffer(string.encode("ascii"), np.uint8)
    c = _CLASS[raw]
    cased = (raw >= 65) & (raw <= 90)
    text = model[c[:-1], c[1:]].sum() + model[28, c[0]]
    turned = (cased[1:] != cased[:-1]) & (c[1:] < 26) & (c[:-1] < 26)
    inside = np.concatenate([[False], c[:-2] < 26])
    if not (c == 26).any() and not (turned & inside).any():
        # Shaped like words: it has to be unlikely as words of another language than the corpus's, too.
        text = max(text, _WORDS[c[:-1], c[1:]].sum() + _WORDS[28, c[0]])
    text -= math.log10(10) * (c == 26).sum() + math.log10(4) * (c == 27).sum()
    text += int(turned.sum()) * math.log10(0.05)
    return -len(string) * math.log10(size) - text


_FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("base", T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("k", T.IntegerType())]))),
        T.StructField("others", T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("string", T.StringType())]))),
        T.StructField("pairs", T.ArrayType(T.LongType())),
    ]
)


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each document, and one for each batch with its counts of neighbouring character classes."""
    for b in batches:
        rows, pairs = [], np.zeros(_CLASSES * _CLASSES, np.int64)
        for i, text in zip(b["doc_id"], b["body"], strict=True):
            base = base_spans(text)
            others = [(s, e, text[s:e]) for s, e in other_strings(text, base)]
            c = _CLASS[np.frombuffer(text.encode(), np.uint8)]
            if len(c) > 1:
                pairs += np.bincount(c[:-1] * _CLASSES + c[1:], minlength=_CLASSES * _CLASSES)
            rows.append((i, base, others, None))
        rows.append((None, None, None, pairs))
        out = pd.DataFrame(rows, columns=["doc_id", "base", "others", "pairs"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def text_model(found: DataFrame) -> np.ndarray:
    """log10 probability of a character class after another, from all text of the corpus (a fixed number of values)."""
    counts = np.ones((_CLASSES, _CLASSES))
    for r in found.select(F.posexplode("pairs").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[divmod(r["k"], _CLASSES)] += r["n"]
    return np.log10(counts / counts.sum(axis=1, keepdims=True))


def weigh(string: str, model: np.ndarray) -> int | None:
    """Evidence in steps; None where no encoding fits, where evidence speaks for text (which is never reported), or where a
    test of the battery fails (the level holds for the three together)."""
    got = infer(string)
    if got is None or len(got[1]) < 2:
        return None
    found = evidence(string.rstrip("="), got[2], model)
    if found <= 0 or min(battery(got[1], got[2])) < LEVEL / 3:
        return None
    return math.floor(min(HIGH, found) / STEP)


def least_evidence(weights: DataFrame, false_share: float = FALSE_SHARE) -> float | None:
    """Smallest evidence (in steps) that is reported, by the e-value form of false-discovery control.

    Of m strings, the k with the most evidence are reported for the largest k
    whose k-th e-value is at least m / (k * false_share).  Evidence stands on a
    grid, so the counts are a bounded number of rows.
    """
    m = weights.count()
    rows = weights.where("w IS NOT NULL").groupBy("w").count().collect()
    best, k = None, 0
    for r in sorted(rows, key=lambda r: -r["w"]):
        k += r["count"]
        if r["w"] * STEP >= math.log10(m / (k * false_share)):
            best = r["w"]
    return best


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", false_share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, spans): for every row all secrets as (s, e, k), by start and then kind (``KINDS``).

    One pass over the whole texts finds base spans, candidate strings and the
    counts of a text model; only these are written.  A string is random when the
    tests for its inferred encoding accept it (chi-squared, runs, serial
    correlation) and its evidence against the text model passes the
    false-discovery control over all strings of the corpus.  Evidence is a
    likelihood ratio and so grows with length: short strings need a stronger one.
    Positions are code points, ends exclusive.  Null text counts as empty;
    repeated rows have equal results; an empty table gives no rows.
    """
    found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), present(F.col(text)).alias("body")).mapInPandas(_find, _FOUND)
    found = written(found, "secrets")
    model = text_model(found)
    rows = found.where("pairs IS NULL").select("doc_id", "base", "others")

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def weighed(others: pd.Series) -> pd.Series:
        seen: dict[str, int | None] = {}
        for row in others:
            for o in row:
                if o["string"] not in seen:
                    seen[o["string"]] = weigh(o["string"], model)
        return pd.Series([[seen[o["string"]] for o in row] for row in others])

    some = F.size("others") > 0
    rows = written(rows.withColumn("w", F.when(some, weighed("others")).otherwise(F.expr("cast(array() as array<long>)"))), "evidence")
    least = least_evidence(rows.where(some).select(F.explode("w").alias("w")), false_share)
    if least is None:
        return rows.select("doc_id", F.col("base").alias("spans"))
    passed = f"filter(arrays_zip(others, w), x -> x.w >= {least})"
    kind = KINDS.index("random")
    passed = f"array_sort(transform({passed}, x -> struct(x.others.s AS s, x.others.e AS e, {kind} AS k)))"
    # A run and its parts make one span.
    joined = f"IF(size(a) > 0 AND element_at(a, -1).e > x.s, concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).s AS s, greatest(element_at(a, -1).e, x.e) AS e, {kind} AS k))), concat(a, array(x)))"
    random = F.expr(f"aggregate({passed}, cast(array() AS array<struct<s: int, e: int, k: int>>), (a, x) -> {joined})")
    spans = F.expr("array_sort(concat(base, random), (a, b) -> CASE WHEN a.s <> b.s THEN a.s - b.s ELSE a.k - b.k END)")
    return rows.withColumn("random", random).select("doc_id", spans.alias("spans"))


def secrets_report(docs: DataFrame, **options) -> DataFrame:
    kinds = "element_at(array('assign', 'access', 'hex', 'random'), x.k + 1)"
    joined = f"concat_ws(',', transform({{}}, x -> concat({kinds}, ':', x.s, ':', x.e)))"
    count = lambda k: F.expr(f"cast(size(filter(spans, x -> x.k = {k})) as long)")
    return scan(docs, **options).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(F.expr(joined.format("filter(spans, x -> x.k < 3)")).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )
