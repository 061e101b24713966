"""Secret scan: fixed key patterns, and a battery of randomness tests on every other key-like run.

Patterns (spans in code points, end exclusive, leftmost and non-overlapping per kind):
``assign`` a credential name, ``:`` or ``=``, and a value of 8 or more characters; ``access`` an access key id
of 16 or more; ``hex`` 32 or more lower-case hexadecimal digits.

Battery. Candidates are runs of ``MIN_RANDOM`` or more characters of ``[A-Za-z0-9+/_-]``, with the ``=`` that pad
them at the end. Pattern spans are cut out of the text first and an inner ``=`` divides, so the value of
``name=value`` and each rest of a run beside a pattern span are runs of their own. The encoding is inferred as
the smallest alphabet that holds the run: decimal, hexadecimal, letters of one case, base 32, base 36, letters
of both cases, base 58, 62 and 64 (also URL-safe). Hyphens between groups of equal length (4 or more), or of the lengths of a UUID, are
left out of the test. Under "drawn at random from that alphabet" three statistics have known distributions: the
chi-squared distance of the symbol counts from uniform (in as many equal parts of the alphabet as the length
feeds with ten expected symbols each), the number of runs above and below the middle of the alphabet, and
the serial correlation of neighbours. The least of the three p-values, times three, is the run's p-value.
The order of the symbols does not matter to random keys; letters stand in the order of how common they are in prose,
so that words fill the first parts and are told apart with few letters.
A run is *cleared* as ordinary when randomness is rejected. Long documents hold many runs, so rejections
follow Benjamini-Hochberg over the document at level ``FDR``, each p-value weighted by the run's length
(longer runs carry more evidence). Words are written in letters of one case, so runs of that alphabet are cleared at
``WORD_LEVEL`` times the level: 9 of 10 random keys of such letters are found, and fewer words taken for keys.
What is not cleared is a span of kind ``random``.

Defined cases: a null text is empty and has no spans; every row is scanned by itself, so repeated rows, null
ids and empty tables need no rule; other columns are ignored. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

KINDS = ("assign", "access", "hex", "random")
MIN_RANDOM = 20
FDR = 0.01
WORD_LEVEL = 10

# fixed patterns and least lengths
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_RUN = re.compile(rf"([A-Za-z0-9+/_-]{{{MIN_RANDOM},}})(?:=+(?![A-Za-z0-9+/_=-]))?")
# letters from common to rare in European prose: a fixed order
_LOWER = "eansitrodluchmgpbfvwykzjqx"
_UPPER = _LOWER.upper()
_DIGITS = "0123456789"


def _without(symbols: str, missing: str) -> str:
    return "".join(c for c in symbols if c not in missing)


# from small to large; a run belongs to the first that holds it
_ALPHABETS = tuple(
    {char: place for place, char in enumerate(symbols)}
    for symbols in (
        _DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _LOWER + "234567", _UPPER + "234567", _LOWER + _DIGITS,
        _UPPER + _DIGITS, _LOWER + _UPPER, _without(_LOWER + _UPPER + _DIGITS, "0OIl"), _LOWER + _UPPER + _DIGITS,
        _LOWER + _UPPER + _DIGITS + "+/",
    )
)
_URL_SAFE = str.maketrans("-_", "+/")
_UUID = [8, 4, 4, 4, 12]

Span = tuple[str, int, int]


def pattern_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def randomness(symbols: list[int], size: int) -> float:
    """p-value of "independent uniform symbols out of ``size``", from three tests."""
    n = len(symbols)
    parts = max(2, min(size, n // 10))
    counts = Counter(s * parts // size for s in symbols)
    widths = Counter(s * parts // size for s in range(size))
    chi = sum((counts[p] - n * w / size) ** 2 / (n * w / size) for p, w in widths.items())
    free = parts - 1
    # cube root of chi-squared is close to normal; only an excess speaks against uniform
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    p_uniform = 0.5 * math.erfc(z / math.sqrt(2))

    high = [s >= size // 2 for s in symbols]
    above = sum(high)
    below = n - above
    if above and below:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 1 + 2 * above * below / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    middle = sum(symbols) / n
    total = sum((s - middle) ** 2 for s in symbols)
    lagged = sum((a - middle) * (b - middle) for a, b in zip(symbols, symbols[1:]))
    p_serial = _two_sided((lagged / total + 1 / n) * math.sqrt(n)) if total else 0.0
    return min(1.0, 3 * min(p_uniform, p_runs, p_serial))


def _ungrouped(body: str) -> str:
    """The run without the hyphens of a grouped key (``XXXXX-XXXXX-XXXXX``, a UUID)."""
    groups = body.split("-")
    lengths = [len(g) for g in groups]
    grouped = len(groups) > 1 and all(g.isalnum() for g in groups) and (lengths == _UUID or lengths == [max(4, lengths[0])] * len(groups))
    return "".join(groups) if grouped else body


def _encoded(body: str) -> tuple[list[int], int]:
    """Symbols of a run in the smallest alphabet that holds all of it; the last one holds every run."""
    body = _ungrouped(body).translate(_URL_SAFE)
    present = set(body)
    places = next(a for a in _ALPHABETS if present <= a.keys())
    return [places[c] for c in body], len(places)


def _cut(text: str, taken: list[Span]) -> str:
    """The text with blanks in place of the spans."""
    out, at = [], 0
    for _, start, end in sorted(taken, key=lambda s: s[1]):
        out += [text[at:start], " " * (end - max(at, start))]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _weight(symbols: list[int], size: int) -> float:
    """How readily a run is cleared, before the level is shared out."""
    return len(symbols) * (WORD_LEVEL if size == len(_LOWER) else 1)


def random_spans(text: str, taken: list[Span]) -> list[Span]:
    """Runs that the battery does not clear, outside the spans already found."""
    tested = []
    for m in _RUN.finditer(_cut(text, taken)):
        encoded = _encoded(m[1])
        tested.append((randomness(*encoded), len(encoded[0]), _weight(*encoded), *m.span()))
    if not tested:
        return []
    mean = sum(n for _, n, _, _, _ in tested) / len(tested)
    weighted = sorted(((p * mean / w, start, end) for p, _, w, start, end in tested))
    cleared = max((k for k, (p, _, _) in enumerate(weighted, 1) if p <= FDR * k / len(weighted)), default=0)
    return [("random", start, end) for _, start, end in weighted[cleared:]]


def all_spans(text: str | None) -> list[Span]:
    """Every span of a text by start, then kind."""
    found = pattern_spans(text or "")
    found += random_spans(text or "", found)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the kind of its first one in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPAN = T.StructType().add("kind", "string").add("start", "integer").add("end", "integer")


@pandas_udf(T.StructType().add("spans", T.ArrayType(_SPAN)).add("clean_text", "string"))
def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            spans = all_spans(text)
            rows.append(([{"kind": k, "start": a, "end": b} for k, a, b in spans], redact(text, spans) if spans else text))
        yield pd.DataFrame(rows, columns=["spans", "clean_text"])


def scan_column(text: Column | str) -> Column:
    """Struct of ``spans`` and of ``clean_text``, the text with its spans replaced (null stays null)."""
    return _scan(text)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` of every row; spans by start, then kind."""
    return docs.select(F.col(id_col), _scan(F.col(text_col)).alias("s")).select(id_col, F.col("s.spans").alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(scanned: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts per fixed kind, a digest of the pattern spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return scanned.select(
        id_col, *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
