"""Secret scans: fixed patterns, and windows of high entropy in candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import bounded_batches

#: The kinds in the order in which equal starts are listed, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_HEX_LONG = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: What a window of each class must reach: bits a character, changes between lower case, upper case and digits, groups of
#: digits; and how many of +/_=- and how many pairs of lower-case neighbours it may hold. Words, names, versions and paths
#: change seldom, hold one number, are parted often or have many neighbours.
LIMITS = {"hex": (2.9, 3, 2, 0, WINDOW), "one_case": (3.4, 5, 2, 1, WINDOW), "mixed": (3.6, 7, 1, 2, 5)}
#: Digits and letters that a window of hex digits has at least.
HEX_LEAST = (4, 3)
#: Words of documentation: windows that touch one, or the REACH characters on either side of it, are no secrets.
ALLOWED = re.compile(
    r"example|sample|placeholder|dummy|changeme|xxxx|0123456789|123456789|abcdefgh|test[_-]?key|your[_-]", re.I)
REACH = WINDOW
#: Named digests, by their bytes: hex digits, perhaps cut short, or base64 of the full length. Windows that touch one are no secrets.
DIGESTS = {"md5": 16, "sha1": 20, "sha256": 32, "sha384": 48, "sha512": 64}
DIGEST = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"{name}[-_=](?:[0-9a-f]{{1,{2 * n}}}|[A-Za-z0-9+/_-]{{{-(-4 * n // 3)}}}={{0,2}})(?![A-Za-z0-9+/])"
    for name, n in DIGESTS.items()) + ")", re.I)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: What stands before the '//' of a URL, and what ends its host and path: a blank, a quote, a bracket, or '?', after which values come.
SCHEME = re.compile(r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*\Z")
LONGEST_SCHEME = 32
URL_END = re.compile(r"[\s?\"'<>()\[\]{}]")

_PLOGP = [0.0] + [k * math.log2(k) for k in range(1, WINDOW + 1)]
_KIND = {**dict.fromkeys("abcdefghijklmnopqrstuvwxyz", 0), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
         **dict.fromkeys("0123456789", 2)}
_OTHER = 3
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")


class Window:
    """Counts of the last characters of a string, kept up as one comes in and one goes out."""

    def __init__(self, s: str, width: int = WINDOW) -> None:
        self.s, self.width, self.end = s, width, 0
        self.counts: dict[str, int] = {}
        self.total = 0.0  # sum of k log k
        self.kinds = [0, 0, 0, 0]
        self.changes = self.groups = self.calm = self.not_hex = 0

    def _count(self, c: str, by: int) -> None:
        k = self.counts.get(c, 0)
        self.total += _PLOGP[k + by] - _PLOGP[k]
        self.counts[c] = k + by
        self.kinds[_KIND.get(c, _OTHER)] += by
        self.not_hex += by * (c not in _HEX_DIGITS)

    def _pair(self, i: int, by: int) -> None:
        """The step from character i to the next: a change of kind, the beginning of a number, two small letters."""
        x, y = _KIND.get(self.s[i], _OTHER), _KIND.get(self.s[i + 1], _OTHER)
        self.changes += by * (x != y and _OTHER not in (x, y))
        self.groups += by * (x != 2 and y == 2)
        self.calm += by * (x == y == 0)

    def step(self) -> bool:
        """One character further; whether the window is full."""
        i, start = self.end, self.end - self.width
        if start >= 0:
            self._count(self.s[start], -1)
            self._pair(start, -1)
        self._count(self.s[i], 1)
        if i > max(start, -1) + 1 or (start < 0 and i > 0):
            self._pair(i - 1, 1)
        self.end += 1
        return self.end >= self.width

    def bits(self) -> float:
        return math.log2(self.width) - self.total / self.width

    def secret(self) -> bool:
        """Whether the characters look drawn at random, by the limits of their class."""
        lower, upper, digits, other = self.kinds
        letters = lower + upper
        if not digits or not letters:
            return False
        if not self.not_hex and not (lower and upper):
            if digits < HEX_LEAST[0] or letters < HEX_LEAST[1]:
                return False
            kind = "hex"
        else:
            kind = "mixed" if lower and upper else "one_case"
        bits, changes, groups, parts, calm = LIMITS[kind]
        first = _KIND.get(self.s[self.end - self.width], _OTHER) == 2  # a number at the window's start begins there
        return (other <= parts and self.calm <= calm and self.changes >= changes and self.groups + first >= groups
                and self.bits() >= bits - 1e-9)


def window_spans(s: str, least: float | None = None, width: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``width`` characters that look like secrets, or with at least ``least`` bits a character."""
    window, spans = Window(s, width), []
    for _ in s:
        if not window.step():
            continue
        if window.secret() if least is None else window.bits() >= least - 1e-9:
            start = window.end - width
            if spans and start <= spans[-1][1]:
                spans[-1][1] = window.end
            else:
                spans.append([start, window.end])
    return [(a, b) for a, b in spans]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping in each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    return sorted(found)


def urls(text: str) -> list[tuple[int, int]]:
    """Spans of scheme, host and path of the URLs of a text; what follows a '?' is not part of them."""
    found, at = [], text.find("://")
    while at >= 0:
        scheme = SCHEME.search(text[max(0, at - LONGEST_SCHEME) : at])
        stop = at + 3
        if scheme:
            end = URL_END.search(text, stop)
            stop = end.start() if end else len(text)
            found.append((at - len(scheme[0]), stop))
        at = text.find("://", stop)
    return found


def unlisted(s: str, listed: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of a candidate that the allow-list and ``listed`` leave; windows inside one touch nothing allow-listed."""
    listed = listed + [(m.start() - REACH, m.end() + REACH) for m in ALLOWED.finditer(s)]
    listed += [m.span() for m in DIGEST.finditer(s)]
    at = 0
    for a, b in sorted(listed):
        if a > at:
            yield at, a
        at = max(at, b)
    if at < len(s):
        yield at, len(s)


def widened(s: str, a: int, b: int) -> tuple[int, int]:
    """A span with the letters and digits that adjoin it: windows at a key's edges may miss a limit."""
    while a > 0 and s[a - 1].isalnum():
        a -= 1
    while b < len(s) and s[b].isalnum():
        b += 1
    return a, b


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of stretches that look random, but for URLs, UUIDs and what the allow-list takes out.

    Every window of a candidate is judged by its own class: its entropy, and how often its characters change between lower case,
    upper case and digits. Paths, file names, slugs, versions and names of packages have as many bits a character but few changes.
    """
    found, known = [], None
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if UUID.fullmatch(s):
            continue
        if known is None:
            known = urls(text)
        inside = [(max(a - m.start(), 0), b - m.start()) for a, b in known if a < m.end() and b > m.start()]
        for at, end in unlisted(s, inside):
            part, last = s[at:end], 0
            for a, b in window_spans(part):
                a, b = widened(part, a, b)
                if b > last:
                    found.append((m.start() + at + max(a, last), 3, m.start() + at + b))
                    last = b
    return found


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row; one pass, no shuffle.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive. Null and empty texts have no spans
    and the digest of an empty string; a null id stays null; repeated rows are scanned each; other
    columns are not read. Time is linear in the text.
    """
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(shown(base).encode()).hexdigest(),
                             shown(sorted(base + entropy_spans(text)))))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # an id travels as text: pandas would turn a batch with a null id into floats
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.withColumn("doc_id", F.col("doc_id").cast("string"))
        .mapInPandas(scan, "doc_id string, n_assign bigint, n_access bigint, n_hex bigint, "
                           "base_sha256 string, spans string")
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def mask(text: str, word: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping spans become one."""
    out, at = [], 0
    for a, _, b in sorted(base_spans(text) + entropy_spans(text)):
        if b <= at:
            continue
        if a >= at:
            out.append(text[at:a])
            out.append(word)
        at = b
    return "".join(out) + text[at:] if out else text


def masked(text: Column) -> Column:
    """Column: the text without its secrets; null stays null."""
    @F.pandas_udf("string")
    def hide(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mask(t) if isinstance(t, str) else None)

    return hide(text)
