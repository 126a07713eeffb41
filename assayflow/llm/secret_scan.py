"""Operator 8, secret scans by grammar inference.

Base spans of three kinds (assign, access, hex) follow fixed patterns and always stay.
For every labelled credential format a probabilistic automaton is inferred: its labelled strings
form a prefix tree, whose states are merged, red-blue order, wherever a Hoeffding test finds their
outgoing frequencies compatible.  One more is inferred from ordinary names, words and numbers, the background.  Candidates are the substrings of a run of token characters that start
with the run or after a separator in it, so that a credential is found behind ``KEY=``, in an address or in a path.
One whose first places an automaton knows is scored by the mean log likelihood per symbol under it, up to each place where it can end: the
end of the run, a separator, or a character that the format doesn't have.  It is a credential of that format when its length is one that labelled strings
have, its score reaches the format's own level, set on labelled strings kept out of the inference, and what follows the mark is likelier under
the format than under the background.  The longest such end counts; of formats whose spans overlap the one furthest above its level does.
Spans are added whether or not a base span covers them, as they name the format.

Symbols are characters and their place at the start of a token, where formats have their marks, and
character classes after it.  Labelled strings are generated from public formats
with a fixed seed, so that the automata don't depend on the corpus.

Edge cases: a null text is an empty one without spans; positions count code points;
repeated rows get the same spans; long texts are read whole; an empty table gives no rows; a column named as
``out`` is replaced, other columns pass through.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base kinds in order of report, and their patterns.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Publicly documented credential formats, their marks and what follows: parts of an alphabet with lengths, and separators.
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_LETTERS, _DIGITS, _BASE64, _HEXITS = _ALNUM[:52], _ALNUM[52:], _ALNUM + "_-", "0123456789abcdef"
FORMATS = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), ((_ALNUM, 36, 36),)),
    "gitlab": (("glpat-",), ((_BASE64, 20, 20),)),
    "google": (("AIza",), ((_BASE64, 35, 35),)),
    "huggingface": (("hf_",), ((_LETTERS, 34, 34),)),
    "jwt": (("eyJhbGciOi",), ((_ALNUM, 10, 40), ".", (_BASE64, 30, 80), ".", (_BASE64, 43, 43))),
    "npm": (("npm_",), ((_ALNUM, 36, 36),)),
    "sendgrid": (("SG.",), ((_BASE64, 22, 22), ".", (_BASE64, 43, 43))),
    "shopify": (("shpat_", "shpss_"), ((_HEXITS, 32, 32),)),
    "slack": (("xoxb-", "xoxp-"), ((_DIGITS, 10, 13), "-", (_DIGITS, 10, 13), "-", (_ALNUM, 24, 24))),
    "stripe": (("sk_live_", "rk_live_", "sk_test_"), ((_ALNUM, 24, 32),)),
}
PREFIX, FLOOR, ALPHA = 4, 1e-4, 0.5
#: Labelled strings of a format for the inference, and as many for its level.
LABELLED = 120
_TOKEN = r"[A-Za-z0-9+/_.=-]"
_START = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind as listed."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _class(c: str) -> str:
    return "d" if c in "0123456789" else "U" if "A" <= c <= "Z" else "l" if "a" <= c <= "z" else c


def symbols(token: str, prefix: int = PREFIX) -> list[str]:
    """Characters of the first ``prefix`` places with their place, then classes; marks are kept."""
    return [f"{i}{c}" for i, c in enumerate(token[:prefix])] + [_class(c) for c in token[prefix:]]


class Automaton:
    """A probabilistic automaton inferred from labelled strings by state merging."""

    def __init__(self, strings: list[list[str]], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.end, self.total = [0], [0]
        for s in strings:
            at = 0
            for c in s:
                self.total[at] += 1
                self.count[at][c] = self.count[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({}), self.count.append({}), self.end.append(0), self.total.append(0)
                at = self.next[at][c]
            self.total[at] += 1
            self.end[at] += 1
        self._scale = math.sqrt(0.5 * math.log(2 / alpha))
        self.states = [0]
        blue = sorted(set(self.next[0].values()))
        while blue:
            q = blue.pop(0)
            match = next((p for p in self.states if self._compatible(p, q)), None)
            if match is None:
                self.states.append(q)
            else:
                for p in self.states:
                    for c, to in self.next[p].items():
                        if to == q:
                            self.next[p][c] = match
                self._fold(match, q)
            blue = sorted({to for p in self.states for to in self.next[p].values()} - set(self.states))

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self._scale * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.total[p], self.total[q]
            if not n or not m:
                continue
            if self._differ(self.end[p], n, self.end[q], m):
                return False
            for c in {*self.count[p], *self.count[q]}:
                if self._differ(self.count[p].get(c, 0), n, self.count[q].get(c, 0), m):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    todo.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree below ``q`` to ``p``."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.end[p] += self.end[q]
            self.total[p] += self.total[q]
            for c, k in self.count[q].items():
                self.count[p][c] = self.count[p].get(c, 0) + k
                if c in self.next[p]:
                    todo.append((self.next[p][c], self.next[q][c]))
                else:
                    self.next[p][c] = self.next[q][c]

    def step(self, at: int, c: str) -> tuple[float, int]:
        """Log likelihood of a symbol in a state, and the state after it; an unseen symbol has a floor and leaves the state as it is."""
        n = self.total[at]
        return math.log(max(self.count[at].get(c, 0) / n if n else 0, FLOOR)), self.next[at].get(c, at)

    def stop(self, at: int) -> float:
        """Log likelihood of the end in a state."""
        n = self.total[at]
        return math.log(max(self.end[at] / n if n else 0, FLOOR))

    def score(self, s: list[str]) -> float:
        """Mean log likelihood per symbol, the end included."""
        at, total = 0, 0.0
        for c in s:
            x, at = self.step(at, c)
            total += x
        return (total + self.stop(at)) / (len(s) + 1)

    def knows(self, s: list[str]) -> bool:
        """Whether a labelled string begins with the symbols ``s``."""
        at = 0
        for c in s:
            if c not in self.next[at]:
                return False
            at = self.next[at][c]
        return True


def labelled(name: str, n: int, seed: int = 11) -> list[str]:
    r = random.Random(f"{seed} {name}")
    marks, parts = FORMATS[name]
    part = lambda p: p if isinstance(p, str) else "".join(r.choice(p[0]) for _ in range(r.randint(p[1], p[2])))
    return [r.choice(marks) + "".join(map(part, parts)) for _ in range(n)]


def ordinary(n: int, seed: int = 12) -> list[str]:
    """Names, paths, numbers and placeholders of 12 to 60 characters, which no credential looks like."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioubcdfghklmnprstvw") for _ in range(r.randint(2, 9)))
    number = lambda: str(r.randint(0, 10 ** r.randint(1, 8)))
    makers = [word, word, word, lambda: word().title(), lambda: word().upper(), number, lambda: r.choice("xX0a1*-") * r.randint(3, 12)]
    out = []
    while len(out) < n:
        sep, make = r.choice(["_", "-", ".", "/", "", ""]), r.choice([makers[:3], makers[3:4], makers[4:5], makers[5:6], makers[6:], makers])
        text = sep.join(r.choice(make)() for _ in range(r.randint(2, 8)))
        if 12 <= len(text) <= 60:
            out.append(text)
    return out


class Format(NamedTuple):
    """What was learned of a format: automaton, level, lengths, symbols after the mark, and the places that the mark fixes."""

    automaton: Automaton
    level: float
    shortest: int
    longest: int
    body: frozenset[str]
    prefix: int

    def match(self, token: str, background: Automaton) -> tuple[float, int] | None:
        """Score above the level and length of the longest start of ``token`` that is a credential and can end there."""
        at, total, other, ordinary_total, best = 0, 0.0, 0, 0.0, None
        tail = 0.0
        for i in range(min(len(token), self.longest) + 1):
            c = None if i == len(token) else f"{i}{token[i]}" if i < self.prefix else _class(token[i])
            stop = c is None or (i >= self.prefix and c not in self.body and c not in self.automaton.next[at])
            if i >= self.shortest and token[i - 1] != "." and (stop or not token[i].isalnum()):
                score = (total + self.automaton.stop(at)) / (i + 1)
                if score >= self.level and tail > ordinary_total:
                    best = (score - self.level, i)
            if stop:
                break
            x, at = self.automaton.step(at, c)
            total += x
            if i >= self.prefix:
                y, other = background.step(other, c)
                tail, ordinary_total = tail + x, ordinary_total + y
        return best


class Scanner(NamedTuple):
    formats: dict[str, Format]
    background: Automaton


@functools.cache
def fit(n: int = LABELLED) -> Scanner:
    """For every format its automaton and the level that its own strings reach, and the background."""
    out = {}
    for name, (marks, parts) in FORMATS.items():
        prefix, strings = min(PREFIX, *map(len, marks)), labelled(name, 2 * n)
        automaton = Automaton([symbols(s, prefix) for s in strings[:n]])
        level = min(automaton.score(symbols(s, prefix)) for s in strings[n:]) - 0.1
        lengths = [len(s) for s in strings]
        # Extreme lengths of a format with several parts are rare among labelled strings.
        room = (max(lengths) - min(lengths)) // 8
        body = frozenset(c for s in strings for c in map(_class, s[prefix:]))
        out[name] = Format(automaton, level, min(lengths) - room, max(lengths) + room, body, prefix)
    return Scanner(out, Automaton([symbols(s, 0) for s in ordinary(2 * n)]))


def _disjoint(found: list[tuple[float, str, int, int]]) -> list[tuple[float, str, int, int]]:
    """The spans that are left when each, best first, displaces those that overlap it."""
    out, starts, ends = [], [], []
    for span in sorted(found, reverse=True):
        if bisect_left(starts, span[3]) == bisect_right(ends, span[2]):
            insort(starts, span[2]), insort(ends, span[3]), out.append(span)
    return out


def spans(text: str | None, scanner: Scanner) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, whether it is a base one), by start, then kind as listed."""
    if not text:
        return []
    out = [(k, a, b, True) for k, a, b in base_spans(text)]
    # A run that is shorter than every labelled string holds none.
    for m in re.finditer(f"{_TOKEN}{{{min(f.shortest for f in scanner.formats.values())},}}", text):
        found, done = [], {}
        for start in _START.finditer(m[0]):
            at = start.start()
            for name, form in scanner.formats.items():
                head = m[0][at : at + form.prefix]
                if at >= done.get(name, 0) and len(head) == form.prefix and form.automaton.knows(symbols(head)):
                    hit = form.match(m[0][at : at + form.longest + 1], scanner.background)
                    if hit:
                        done[name] = at + hit[1]
                        found.append((hit[0], name, m.start() + at, m.start() + at + hit[1]))
        out += [(name, a, b, False) for _, name, a, b in _disjoint(found)]
    order = [*KINDS, *FORMATS]
    return sorted(out, key=lambda s: (s[1], order.index(s[0]), s[2]))


def find(docs: DataFrame, scanner: Scanner | None = None, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``, an array of structs ``kind, start, end, base``."""
    scanner = scanner or fit()

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b, "base": o} for k, a, b, o in spans(t, scanner)] for t in texts])

    return docs.withColumn(out, found(F.col(text_col)))
