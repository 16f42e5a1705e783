"""Secret scan with a trigram index.

Each rule is a regular expression. From its parse tree comes a Boolean query over trigrams that every match must
contain. Texts are indexed in segments of some megabytes: a posting list per trigram that any rule asks for.
A rule's query intersects and unites posting lists, and only the texts that remain are searched with the
expression itself. A rule without mandatory trigrams searches all texts. Segments live inside a task, so that
nothing is shuffled and memory is bounded by a segment and the longest text.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as node
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEGMENT = 4 << 20
STRINGS = 64
ALL = ("all",)


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose `group` has at least `least` bytes."""

    kind: str
    pattern: bytes
    flags: int = 0
    group: int = 0
    least: int = 0


# The base rules. Runs of hexadecimal digits carry their least length in the expression; runs are
# maximal, so this finds the same spans.
BASE = (
    Rule(
        "assign",
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE, 2, 8,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", least=16),
    Rule("hex", rb"[0-9a-f]{32,}"),
)
# Widely known shapes of keys.
MORE = (
    Rule("private_key", rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", rb"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


def trigram_query(pattern: bytes, flags: int = 0) -> tuple:
    """What the lowered text of any match must hold: ("all",), ("tri", trigram), ("and" or "or", queries)."""
    exact, needs = _walk(parser.parse(pattern, flags))
    return _both([*needs, _strings(exact)])


def _walk(items: object) -> tuple[set[bytes], list[tuple]]:
    """The possible strings of the trailing literal run, and the queries of all before it."""
    exact, needs = {b""}, []

    def times(more: set[bytes]) -> None:
        nonlocal exact
        if len(exact) * len(more) > STRINGS:
            stop()
        exact = {a + b for a in exact for b in more}

    def stop() -> None:
        nonlocal exact
        needs.append(_strings(exact))
        exact = {b""}

    for op, value in items:
        found = _strings_of(op, value)
        if found is not None:
            times(found)
            continue
        stop()
        if op is node.SUBPATTERN:
            inner, before = _walk(value[3])
            needs += [*before, _strings(inner)]
        elif op is node.BRANCH:
            needs.append(("or", [_both([*before, _strings(inner)]) for inner, before in map(_walk, value[1])]))
        elif op in (node.MAX_REPEAT, node.MIN_REPEAT, node.POSSESSIVE_REPEAT) and value[0]:
            inner, before = _walk(value[2])
            needs += [*before, _strings(inner)]
    return exact, needs


def _strings_of(op: object, value: object) -> set[bytes] | None:
    """All strings that one item stands for, lowered, if they are few."""
    if op is node.LITERAL:
        return {bytes([value]).lower()}
    if op is node.IN and all(o is node.LITERAL for o, _ in value):
        return {bytes([v]).lower() for _, v in value}
    if op is node.SUBPATTERN:
        inner, before = _walk(value[3])
        return inner if not before else None
    if op is node.BRANCH:
        parts = [_walk(p) for p in value[1]]
        return set().union(*(p for p, _ in parts)) if not any(before for _, before in parts) else None
    if op is node.MAX_REPEAT and (value[0], value[1]) == (0, 1):
        inner, before = _walk(value[2])
        return inner | {b""} if not before else None
    return None


def _strings(exact: set[bytes]) -> tuple:
    if min(map(len, exact)) < 3:
        return ALL
    return ("or", [_both([("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(exact)])


def _both(queries: list[tuple]) -> tuple:
    needed = [q for q in queries if not _free(q)]
    return ("and", needed) if needed else ALL


def _free(query: tuple) -> bool:
    if query[0] == "or":
        return any(map(_free, query[1]))
    return query == ALL


def trigrams_in(query: tuple) -> set[bytes]:
    if query[0] == "tri":
        return {query[1]}
    return set().union(*map(trigrams_in, query[1])) if len(query) > 1 else set()


def postings(raw: np.ndarray, offsets: np.ndarray, numbers: np.ndarray, count: int) -> list[np.ndarray]:
    """For each trigram the sorted texts of a segment that hold it, in either case.

    `raw` are the bytes of the texts one after another, text i from offsets[i] to offsets[i + 1]; `numbers` maps
    each of the 2^24 trigrams to 1 + its number, 0 for those that no rule asks for.
    """
    low = np.where((raw >= 0x41) & (raw <= 0x5A), raw | 0x20, raw)
    code = low[:-2].astype(np.int32)
    code <<= 8
    code |= low[1:-1]
    code <<= 8
    code |= low[2:]
    number = numbers[code]
    at = np.flatnonzero(number)
    number = number[at]
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 2 < offsets[text + 1]
    both = np.unique(number[inside].astype(np.int64) * len(offsets) + text[inside])
    cuts = np.searchsorted(both, np.arange(1, count + 2) * len(offsets))
    return [both[a:b] % len(offsets) for a, b in zip(cuts, cuts[1:])]


def answer(query: tuple, lists: dict[bytes, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """The texts of a segment that satisfy a query."""
    if query == ALL:
        return everything
    if query[0] == "tri":
        return lists[query[1]]
    found = [answer(q, lists, everything) for q in query[1]]
    out = found[0]
    for more in found[1:]:
        out = np.intersect1d(out, more, True) if query[0] == "and" else np.union1d(out, more)
    return out


class Scanner:
    """The rules' queries and compiled expressions, and the trigrams that they ask for."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        self.trigrams = sorted(set().union(*(trigrams_in(q) for _, _, q in self.rules)))
        self.numbers = np.zeros(1 << 24, np.int16)
        self.numbers[[int.from_bytes(t, "big") for t in self.trigrams]] = np.arange(1, len(self.trigrams) + 1)

    def segment(self, texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
        """For each text its spans (start byte, rule number, end byte), sorted."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        lists = postings(raw, offsets, self.numbers, len(self.trigrams)) if len(raw) > 2 else [np.zeros(0, np.int64)] * len(self.trigrams)
        by_trigram, everything = dict(zip(self.trigrams, lists)), np.arange(len(texts))
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, expression, query) in enumerate(self.rules):
            for at in answer(query, by_trigram, everything).tolist():
                spans[at] += [
                    (m.start(), number, m.end()) for m in expression.finditer(texts[at])
                    if m.end(rule.group) - m.start(rule.group) >= rule.least
                ]
        return map(sorted, spans)

    def texts(self, texts: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
        """Each text, null as an empty one, with its spans."""
        held, size = [], 0
        for value in texts.cast(pa.binary()):
            held.append(value.as_py() or b"")
            size += len(held[-1])
            if size >= SEGMENT:
                yield from zip(held, self.segment(held))
                held, size = [], 0
        yield from zip(held, self.segment(held))


def spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array of (kind, start, stop) in code points, stop exclusive, by start and then the order of the rules.

    Null and empty texts have none.
    """
    made: list[Scanner] = []

    @F.arrow_udf("array<struct<kind:string,start:bigint,stop:bigint>>")
    def of(texts: pa.Array) -> pa.Array:
        made[:] = made or [Scanner(rules)]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        out = []
        for text, found in made[0].texts(texts):
            points = _code_points(text) if found else []
            out.append([{"kind": rules[n].kind, "start": points[a], "stop": points[b]} for a, n, b in found])
        return pa.array(out, pa.list_(kind))

    return of(text)


def _code_points(text: bytes) -> np.ndarray:
    """For each byte position the number of code points before it."""
    return np.r_[0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)]


def redacted(text: Column, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with each stretch of overlapping spans replaced by `mark`; null stays null."""
    made: list[Scanner] = []

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        made[:] = made or [Scanner(rules)]
        out = []
        for text, found in made[0].texts(texts):
            parts, done = [], 0
            for a, _, b in found:
                if a >= done:
                    parts += [text[done:a], mark.encode()]
                done = max(done, b)
            out.append(b"".join([*parts, text[done:]]).decode() if found else text.decode())
        return pa.array(out, pa.string(), mask=np.asarray(texts.is_null()))

    return of(text)


def listed(found: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
