"""Secrets in texts: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax: ``name = "literal"``, ``"name":
"literal"``, ``name: str = "literal"``, ``name := 'literal'``, ``name => "literal"``,
``export NAME=literal``, ``name: literal`` as a line of its own. A value is a chain of
literals and names joined by ``+`` or by standing side by side. Names assigned to are
constants: a value that names one stands for its literals, also over several steps and
if the constant is defined further down. A literal is scored by the most sensitive name
that it reaches and by its own shape.
"""

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# The patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

# Parts of names that make a target sensitive, and how much.
SENSITIVE = (
    ("password", 1.0), ("passwd", 1.0), ("passphrase", 1.0), ("pwd", 0.9), ("secret", 1.0), ("credential", 0.9),
    ("token", 0.9), ("apikey", 1.0), ("accesskey", 1.0), ("privatekey", 1.0), ("authkey", 1.0), ("encryptionkey", 1.0),
    ("signingkey", 1.0), ("bearer", 0.8), ("authorization", 0.8),
)
# Names that are sensitive as a whole part of a name only.
SENSITIVE_PARTS = {"pass": 0.9}
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# Literals that only stand for a secret.
PLACEHOLDERS = frozenset(
    ("changeme", "password", "passwd", "secret", "token", "example", "placeholder", "undefined", "optional",
     "required", "string", "default", "redacted", "masked", "hidden", "disabled", "enabled")
)

# Each kind of reference begins and ends in one way only, a name after $ with the whole
# word, and none begins with a sign that may stand between two: a text is matched in one way.
_REFERENCE = (
    r"(?:\$\{[^{}]*\}|\$\([^()]*\)|\$[A-Za-z_]++(?![0-9])|\$[A-Z_]++[0-9][A-Z0-9_]*+(?![a-z])"
    r"|%\([^()]*\)[a-z]|%\w++%|<[^<>]*>|\{\{[^{}]*\}\}|\{%[^{}]*%\}|\{\w*+\})"
)
#: One or more references to what is filled in elsewhere, and nothing else.
_FILLED_IN = re.compile(rf"{_REFERENCE}(?:[-_.:/@]*+{_REFERENCE})*+", re.ASCII)

_TOKEN = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
    |(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)
    |(?P<bind>:=|=>|=(?!=)|:(?!:))
    |(?P<plus>\+)
    |(?P<blank>[\x20\t]+)
    |(?P<end>[\n,;{}()\[\]])
    |(?P<other>.)""",
    re.ASCII | re.VERBOSE | re.DOTALL,
)
_LINE = re.compile(
    r"""^[\x20\t]*(?:-[\x20\t]+)?(?:(?:export|set|env)[\x20\t]+)?
    (?P<name>[A-Za-z_][\w.-]*)[\x20\t]*[=:][\x20\t]*(?P<value>[^\s"'`=:(){}\[\],;][^\s"'`(){}\[\],;]*)[\x20\t]*\r?$""",
    re.ASCII | re.VERBOSE | re.MULTILINE,
)


@dataclass(frozen=True)
class Settings:
    #: Smallest length of a literal, and smallest score.
    least: int = 6
    score: float = 0.5


def base_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of the fixed patterns, in code points."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        # The length is judged after the match, which a longer one could not replace.
        found += [(m.start(), m.end(), "assign", 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is a whole run: the pattern is greedy and starts at its start.
    found += [(m.start(), m.end(), "hex", 1.0) for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    plain = re.sub(r"[^a-z0-9]", "", name.lower())
    whole = (SENSITIVE_PARTS.get(part.lower(), 0.0) for part in _PART.findall(name))
    return max((*(weight for part, weight in SENSITIVE if part in plain), *whole), default=0.0)


#: Characters up to which literals that are judged together are also put together.
TOGETHER = 256


class Literals:
    """Some literals of a text, each place once, as far as it decides about them together."""

    def __init__(self, text: str, spans: set[tuple[int, int]]):
        self.spans = sorted(spans)
        pieces = [(start, text[start:end]) for start, end in self.spans if end > start]
        self.counts: Counter = Counter()
        for _, piece in pieces:
            self.counts.update(piece)
        self.length = sum(self.counts.values())
        #: All of them if they are short, and the first ones, in order of their places.
        self.pieces = pieces if self.length <= TOGETHER else []
        self.first = pieces[:8]
        self.filled_in = all(_FILLED_IN.fullmatch(piece) for _, piece in pieces)


def literal_score(parts: list[Literals], settings: Settings, spaces: bool = False) -> float:
    """Literals of different places as one value: 0 for what cannot be a secret, up to 1 by
    the variety of the characters. Spaces in it are allowed only where ``spaces`` says so."""
    length = sum(part.length for part in parts)
    counts: Counter = Counter()
    for part in parts:
        counts.update(part.counts)
    if length < settings.least or any(c.isspace() and not (spaces and c == " ") for c in counts):
        return 0.0
    if length <= TOGETHER:
        whole = "".join(piece for _, piece in sorted(p for part in parts for p in part.pieces))
        if whole.lower() in PLACEHOLDERS or _FILLED_IN.fullmatch(whole):
            return 0.0
    elif all(part.filled_in for part in parts):
        return 0.0
    if "".join(piece for _, piece in sorted(p for part in parts for p in part.first)).startswith(("http://", "https://")):
        return 0.0
    if len(counts) <= 2:
        return 0.0
    entropy = -sum(n / length * math.log2(n / length) for n in counts.values())
    kinds = sum(any(test(c) for c in counts) for test in (str.isdigit, str.islower, str.isupper)) + any(
        not c.isalnum() for c in counts
    )
    return min(1.0, 0.25 + entropy / 8 + 0.1 * kinds)


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(target, parts of the value); a part is ("", start, end) of a literal or (name, -1, -1)."""
    found = []
    for m in _LINE.finditer(text):
        found.append((m["name"], [("", m.start("value"), m.end("value"))]))
    target, parts, binding, joined = None, [], False, True
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "blank":
            continue
        if kind in ("string", "name"):
            literal = kind == "string"
            start, end = (m.start() + 1, m.end() - 1) if literal else (m.start(), m.end())
            if binding and (joined or (literal and parts and not parts[-1][0])):
                parts.append(("", start, end) if literal else (m[0], -1, -1))
                joined = False
                continue
            if binding and parts:
                found.append((target, parts))
            target, parts, binding = text[start:end], [], False
        elif kind == "bind" and target is not None:
            if binding and m[0] == "=" and len(parts) == 1 and parts[0][0]:
                parts, joined = [], True  # what stood there was a type
            elif binding and parts and not parts[-1][0]:
                # "a": "b", or a literal that is a key itself
                found.append((target, parts))
                target, parts, binding = None, [], False
            else:
                parts, binding, joined = [], True, True
        elif kind == "plus" and binding:
            joined = True
        else:
            if binding and parts:
                found.append((target, parts))
            target, parts, binding = None, [], False
    if binding and parts:
        found.append((target, parts))
    return found


def literal_spans(text: str, settings: Settings) -> list[tuple[int, int, str, float]]:
    """(start, end, "literal", score) of literals that reach a sensitive name."""
    low = text.lower()
    if not ("=" in text or ":" in text) or not any(
        hint in low for hint in ("pass", "pwd", "secret", "cred", "token", "key", "bearer", "auth")
    ):
        return []
    pairs = assignments(text)
    constants: dict[str, list[tuple[str, int, int]]] = {}
    for target, parts in pairs:
        constants.setdefault(target, []).extend(parts)
    for name, parts in constants.items():
        constants[name] = list(dict.fromkeys(parts))

    def own(parts: list[tuple[str, int, int]]) -> set[tuple[int, int]]:
        # A bare word on a line of its own may be the name of a constant.
        return {
            (start, end) for name, start, end in parts
            if not name and (text[start:end] not in constants or text[start - 1] in "\"'`")
        }

    stands_for: dict[str, str | None] = {}
    ends: dict[str, str] = {}

    def followed(name: str) -> str:
        """The last of a chain of names that only stand for one another."""
        seen: set[str] = set()
        while name not in seen and name not in ends:
            seen.add(name)
            if name not in stands_for:
                parts = constants.get(name, ())
                named = {other for other, _, _ in parts if other}
                stands_for[name] = named.pop() if len(named) == 1 and not own(parts) else None
            if stands_for[name] is None:
                break
            name = stands_for[name]
        name = ends.get(name, name)
        ends.update(dict.fromkeys(seen, name))
        return name

    # What some names reach is gathered once, however many values name them.
    known: dict[frozenset[str], tuple[Literals, set[tuple[int, int]]]] = {}

    def reached(names: frozenset[str]) -> tuple[Literals, set[tuple[int, int]]]:
        if names not in known:
            spans, seen, left = set(), set(names), list(names)
            while left:
                parts = constants.get(left.pop(), ())
                spans |= own(parts)
                more = {name for name, _, _ in parts if name} - seen
                seen |= more
                left += more
            known[names] = Literals(text, spans), spans
        return known[names]

    best: dict[tuple[int, int], float] = {}
    best_of: dict[frozenset[str], float] = {}
    judged: dict[tuple, float] = {}
    for target, parts in pairs:
        sensitive = name_score(target)
        if not sensitive:
            continue
        names = frozenset(followed(name) for name, _, _ in parts if name)
        others, places = reached(names) if names else (None, set())
        mine = own(parts) - places
        # Parts of one value are judged together: short pieces may add up to a secret.
        spaces = "passphrase" in re.sub("[^a-z]", "", target.lower())
        key = (names, spaces)
        if mine or key not in judged:
            together = ([Literals(text, mine)] if mine else []) + ([others] if others else [])
            judged_now = literal_score(together, settings, spaces)
            if not mine:
                judged[key] = judged_now
        else:
            judged_now = judged[key]
        score = sensitive * judged_now
        if score >= settings.score:
            for span in mine:
                best[span] = max(best.get(span, 0.0), score)
            if names:
                best_of[names] = max(best_of.get(names, 0.0), score)
    for names, score in best_of.items():
        for span in known[names][1]:
            best[span] = max(best.get(span, 0.0), score)
    return [(start, end, "literal", score) for (start, end), score in best.items() if end > start]


def secret_spans(text: str | None, settings: Settings = Settings()) -> list[tuple[int, int, str, float]]:
    """All spans by start, then kind; a literal inside a base span is not listed again."""
    if not text:
        return []
    spans = base_spans(text)
    covered = sorted((start, end) for start, end, _, _ in spans)
    starts, reach = [start for start, _ in covered], list(accumulate((end for _, end in covered), max))
    for span in literal_spans(text, settings):
        before = bisect_right(starts, span[0])
        if not before or reach[before - 1] < span[1]:
            spans.append(span)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))


def find_secrets(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, spans (start, end, kind, score; end exclusive).

    Positions are code points. A null or empty text has no spans. Repeated rows and
    rows without an id are reported each. Other columns of the input are not looked at.
    An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("start", "end", "kind", "score"), s)) for s in secret_spans(text.as_py(), settings)]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, SPANS)], names=["doc_id", "spans"])

    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInArrow(
        run, "doc_id long, spans array<struct<start: int, end: int, kind: string, score: double>>"
    )
