"""Secret scans: three fixed patterns, and a randomness battery over every other long token.

The battery looks at maximal runs of token characters and infers an encoding
(hex, base32, base36, base62, base64); without one the token is left alone. It
then asks two things:

1. May it be random? Chi-squared uniformity over the alphabet, a runs test
   around the alphabet's middle and the lag-1 serial correlation must not reject that.
2. Could ordinary text explain it? Two p-values under a model of ordinary
   identifiers: the chi-squared distance from uniform is as small as seen, and
   the character class changes as often as seen. Twice the smaller one is the p-value.

The p-values of all tokens of the corpus go through the Benjamini-Hochberg step-up
per length class (long tokens carry more evidence and must not lend it to
short ones), on a histogram of log p, so a few hundred counts reach the driver. Each
distinct token is one test however often it occurs, so copies do not move the cut.

Defined cases: null text is empty and has no spans; repeated rows repeat; an
empty table gives none; texts are read whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from orderlens.llm.common import map_rows, rows_in

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")

LENGTH_CLASSES = (20, 32, 48, 80)
FALSE_DISCOVERY = 1e-3
RANDOM_LEVEL = 1e-3
BINS_PER_DECADE, LAST_BIN = 10, 400
MEMO_TOKENS = 200_000

# Relative letter frequencies of English prose, in per cent.
LETTERS = dict(
    a=8.2, b=1.5, c=2.8, d=4.3, e=12.7, f=2.2, g=2.0, h=6.1, i=7.0, j=0.15, k=0.77, l=4.0, m=2.4,
    n=6.7, o=7.5, p=1.9, q=0.095, r=6.0, s=6.3, t=9.1, u=2.8, v=0.98, w=2.4, x=0.15, y=2.0, z=0.074,
)
DIGIT_SHARE, UPPER_SHARE, MARK_SHARE = 0.15, 0.1, 0.05
CLASS_CHANGE = 0.15  # chance that two neighbours of an ordinary identifier differ in class

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
MEMBERS = {name: frozenset(chars) for name, chars in ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding(token: str) -> str | None:
    """The narrowest alphabet that holds the token; digits and letters must both occur."""
    chars = set(token)
    if not any(c in DIGITS for c in chars) or not any(c in LOWER or c in UPPER for c in chars):
        return None
    for name, members in MEMBERS.items():
        if chars <= members:
            mixed = name not in ("base62", "base64", "base64url") or chars & set(LOWER) and chars & set(UPPER)
            return name if mixed else None
    return None


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, df: int) -> float:
    """P(chi-squared >= x), by the cube-root normal approximation."""
    spread = 2 / (9 * df)
    return _normal_tail(((max(x, 0.0) / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def _class(char: str) -> int:
    return 0 if char in DIGITS else 1 if char in LOWER else 2 if char in UPPER else 3


@lru_cache(maxsize=None)
def _ordinary(name: str) -> tuple[float, float, float]:
    """Sums of q, q^2, q^3 deviations of ordinary identifiers over an alphabet: (sum q^2, sum q^3, size)."""
    weights = []
    for char in ALPHABETS[name]:
        kind = _class(char)
        if kind == 0:
            weights.append(DIGIT_SHARE / 10)
        elif kind == 3:
            weights.append(MARK_SHARE / 2)
        else:
            only_upper = not any(c in LOWER for c in ALPHABETS[name])
            share = LETTERS[char.lower()] / 100
            weights.append(share * (1 if only_upper or kind == 1 else UPPER_SHARE))
    total = sum(weights)
    q = [w / total for w in weights]
    return sum(x * x for x in q), sum(x**3 for x in q), len(q)


@lru_cache(maxsize=4096)
def _changes_tail(changes: int, pairs: int) -> float:
    """P(at least so many class changes) for an ordinary identifier."""
    log = [
        math.lgamma(pairs + 1) - math.lgamma(k + 1) - math.lgamma(pairs - k + 1)
        + k * math.log(CLASS_CHANGE) + (pairs - k) * math.log1p(-CLASS_CHANGE)
        for k in range(changes, pairs + 1)
    ]
    top = max(log)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in log))


def battery(token: str) -> float | None:
    """p-value of an ordinary explanation, or None where no encoding fits or randomness is rejected."""
    name = encoding(token)
    if name is None:
        return None
    alphabet = ALPHABETS[name]
    place = {c: i for i, c in enumerate(alphabet)}
    codes = [place[c] for c in token]
    n, size = len(codes), len(alphabet)
    counts = [0] * size
    for code in codes:
        counts[code] += 1
    square = sum(c * c for c in counts)
    chi = square * size / n - n

    half = [code * 2 >= size for code in codes]
    high = sum(half)
    low = n - high
    if not high or not low:
        return None
    runs = 1 + sum(a != b for a, b in zip(half, half[1:]))
    expected = 1 + 2 * high * low / n
    variance = max((expected - 1) * (expected - 2) / (n - 1), 1e-9)
    middle = (size - 1) / 2
    serial = sum((a - middle) * (b - middle) for a, b in zip(codes, codes[1:])) / ((size * size - 1) / 12)
    tests = (
        _chi_tail(chi, size - 1),
        2 * _normal_tail(abs(runs - expected) / math.sqrt(variance)),
        2 * _normal_tail(abs(serial) / math.sqrt(n - 1)),
    )
    if min(tests) * len(tests) < RANDOM_LEVEL:
        return None

    two, three, _ = _ordinary(name)
    mean = size * (1 - two) + n * (size * two - 1)
    # Leading terms of the variance of sum(count^2) under a multinomial draw, scaled like chi.
    spread = size * size * max(2 * (two - two * two) + 4 * (n - 1) * (three - two * two), 1e-9) * (n - 1) / n
    close = _normal_tail((mean - chi) / math.sqrt(spread))
    classes = [_class(c) for c in token]
    changes = sum(a != b for a, b in zip(classes, classes[1:]))
    return min(1.0, max(2 * min(close, _changes_tail(changes, n - 1)), 1e-300))


def length_class(length: int) -> int:
    return sum(length >= low for low in LENGTH_CLASSES) - 1


def bin_of(p: float) -> int:
    return min(LAST_BIN, int(-math.log10(p) * BINS_PER_DECADE))


def candidates(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, length class, bin of p) of the tokens that pass the randomness tests; bin -1: tested and failed."""
    for match in TOKEN.finditer(text):
        token = match[0]
        if encoding(token) is not None:
            p = battery(token)
            yield match.start(), match.end(), length_class(len(token)), -1 if p is None else bin_of(p)


def thresholds(docs: DataFrame, level: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Length class -> first accepted bin, from the distinct tokens of all rows."""

    def gather(batches: Iterator[pa.RecordBatch]):
        seen: set[bytes] = set()
        for (text,) in rows_in(batches):
            text = text or ""
            for start, end, kind, place in candidates(text):
                token = xxhash.xxh3_128_digest(text[start:end].encode())
                if token in seen:
                    continue
                if len(seen) >= MEMO_TOKENS:
                    seen.clear()
                seen.add(token)
                yield token, kind, place

    # Tasks repeat each other's tokens; length class and bin follow from the token.
    tokens = map_rows(docs.select("text"), gather, "token binary, kind int, place int").distinct()
    # At most len(LENGTH_CLASSES) * (LAST_BIN + 2) rows.
    totals = {(r["kind"], r["place"]): r["count"] for r in tokens.groupBy("kind", "place").count().collect()}
    accepted = {}
    for kind in range(len(LENGTH_CLASSES)):
        tested = sum(n for (k, _), n in totals.items() if k == kind)
        above = 0
        for place in range(LAST_BIN, -1, -1):
            above += totals.get((kind, place), 0)
            if above and 10 ** (-place / BINS_PER_DECADE) <= level * above / tested:
                accepted[kind] = place
    return accepted


def spans(text: str, accepted: dict[int, int]) -> tuple[list, list]:
    """(fixed, all) spans as (start, kind number, end); battery spans inside a fixed one add nothing."""
    fixed = base_spans(text)
    found = list(fixed)
    for start, end, kind, place in candidates(text):
        inside = any(a <= start and end <= b for a, _, b in fixed)
        if kind in accepted and place >= accepted[kind] and not inside:
            found.append((start, 3, end))
    return fixed, sorted(found)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def secret_spans(docs: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row of ``docs``."""
    accepted = thresholds(docs, level)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]):
        for doc, text in rows_in(batches):
            fixed, found = spans(text or "", accepted)
            n = [sum(k == i for _, k, _ in found) for i in range(len(KINDS))]
            yield doc, *n, hashlib.sha256(joined(fixed).encode()).hexdigest(), joined(found)

    ddl = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return map_rows(docs.select("doc_id", "text"), scan, ddl)


def redacted(text: str, accepted: dict[int, int], mask: str = "[SECRET]") -> str:
    """The text with every merged span replaced by the mask."""
    parts, upto = [], 0
    for start, _, end in spans(text, accepted)[1]:
        if end <= upto:
            continue
        if start >= upto:
            parts += [text[upto:start], mask]
        upto = end
    return "".join([*parts, text[upto:]]) if parts else text


def redact(docs: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with secrets masked in ``text``; all columns and rows stay."""
    accepted = thresholds(docs, level)
    place = docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t, accepted) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)
