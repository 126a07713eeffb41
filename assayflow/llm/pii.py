"""Operator 6, personal data by a semi-Markov conditional random field.

Base spans of four kinds (email, ip, card, phone) follow fixed patterns and checks
and always stay.  The field adds spans that the patterns miss, such as masked addresses
(``name [at] host [dot] org``), phones without a plus and addresses with masked dots.

Around digits, ``@``, masked signs and dots a window of ``LONGEST`` tokens on each side is cut out.  Every run of up to
``LONGEST`` tokens in it that starts and ends on a likely token is a candidate, scored
per kind by features of the whole span (digit count, grouping, checksum, octets,
separators, the word before).  ``LONGEST`` bounds an entity, as the model demands; a token is a run of digits or of letters of any length, and a run ends at
two blanks.  A dynamic programme over token positions and the label of the segment before chooses
boundaries and kinds jointly, with a weight for each pair of neighbouring labels; other tokens are segments of length one.  Weights are
fitted by the conditional likelihood (forward and backward sums over all
segmentations) of generated examples and counterexamples, with a fixed seed, so they
don't depend on the corpus.

Edge cases: a null text is an empty one without spans; positions count code points;
repeated rows get the same spans; long texts are read whole, in linear time; an empty table gives no rows;
a column named as ``out`` is replaced, other columns pass through.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in order of report, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts: the lookbehind saves the other attempts.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 24
_TRIGGER = re.compile(r"[0-9]+|@|[\[({]\x20?(?:[aA][tT]|@|[dD][oO][tT]|\.)\x20?[\])}]|\b[dD][oO][tT]\b")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
_HINTS = {"mail": "email", "email": "email", "contact": "email", "tel": "phone", "phone": "phone", "call": "phone", "fax": "phone", "mobile": "phone", "card": "card", "visa": "card", "pan": "card", "ip": "ip", "server": "ip", "address": "ip"}


# Common ends of host names.
_TOP = frozenset(("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "nl", "uk", "eu"))
_AT, _DOT = r"(?:[\[({]\s?(?:at|@)\s?[\])}]|(?<=\s)at(?=\s))", r"(?:\.|[\[({]\s?(?:dot|\.)\s?[\])}]|(?<=\s)dot(?=\s))"
_MASKED_AT, _MASKED_DOT = re.compile(_AT), re.compile(rf"\s?{_DOT}\s?")
_LAST = re.compile(rf"[\w)\]}}]\s?{_DOT}\s?([a-z]{{2,}})$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind, then start."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append(("email", start, low := match.end()))
        at = text.find("@", max(at + 1, low))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def span_features(words: list[str], span: str, before: str, after: str) -> list[str]:
    """Features of a whole candidate span, of whatever kind."""
    d = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    seps = "".join(sorted(set(re.sub(r"[\w]", "", span))))
    size = len(d)
    size = "7-" if size < 7 else "7-9" if size < 10 else str(size) if size < 17 else "17-19" if size < 20 else "20+"
    letters = sum(w.isalpha() for w in words)
    lower = span.lower()
    signs = span.count("@") + len(_MASKED_AT.findall(lower.replace("@", "")))
    at, last = bool(signs), _LAST.search(lower)
    dot = bool(last)
    out = [f"size {size}", f"seps {seps}", f"at {at} dot {dot} letters {min(letters, 5)}", f"shape {'-'.join(str(len(g)) for g in groups) if len(groups) < 6 else 'many'}"]
    out += [f"plus {span[0] == '+'} size {size}", f"letters {letters > 0}", f"glued {bool(before and before[-1].isalnum())}{bool(after and after[:1].isalnum())}", f"tail {after[:1] in '.-' and after[1:2].isalnum()}"]
    bare = bool(re.search(r"\s(?:at|dot)\s", lower))
    out.append(f"words apart {bool(re.search(r'[^\W\d_]\s[^\W_]', re.sub(r'\s(?:at|dot)\s', '.', lower)))} {bare}")
    out.append(f"bare {bare} top {bool(last and last[1] in _TOP)} signs {min(signs, 2)}")
    out.append(f"inside a name {bool(re.search(r'[^\W_][._%+-]$', before))} {span[0].isalpha()}")
    if len(d) >= 13:
        out.append(f"luhn {luhn(d)} {13 <= len(d) <= 19}")
    masked = _MASKED_DOT.sub(".", lower)
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", masked):
        out.append(f"octets {all(len(p) <= 3 and int(p) <= 255 for p in masked.split('.'))}")
    hint = re.search(r"([^\W\d_]+)\W*$", before)
    out.append(f"hint {_HINTS.get(hint[1].lower(), '-') if hint else '-'}")
    out.append("bias")
    return out


def _starts(token: str) -> bool:
    return token[0] in "0123456789+(" or token[0].isalpha()


#: Labels of tokens outside of entities, and of what is before the first one.
OTHER, START = "O", "^"


class Window:
    """Tokens of a piece of text and its candidate segments with their features."""

    def __init__(self, text: str, base: int = 0):
        self.text, self.base = text, base
        tokens = list(_TOKEN.finditer(text))
        self.spans = [(m.start(), m.end()) for m in tokens]
        words = [m[0] for m in tokens]
        self.other = [["O|digit" if w[0] in "0123456789" else "O|at" if w == "@" else "O|word"] for w in words]
        self.segments: list[list[tuple[int, str, list[str]]]] = [[] for _ in range(len(words) + 1)]
        low = [w.lower() for w in words]
        dots = [i for i, w in enumerate(low) if w == "dot"]
        dotted = [bisect_left(dots, i + LONGEST) > bisect_right(dots, i) for i in range(len(words))]
        sign = [w == "@" or (w == "at" and i > 0 and (words[i - 1] in "[({" or dotted[i])) for i, w in enumerate(low)]
        strong = [s or w[0] in "0123456789" for s, w in zip(sign, words, strict=True)]
        for i, w in enumerate(words):
            if not _starts(w) or not any(strong[i : i + LONGEST]):
                continue
            hit, digits, signs = False, 0, 0
            for j in range(i, min(len(words), i + LONGEST)):
                if j > i and self.spans[j][0] - self.spans[j - 1][1] > 1:
                    break
                hit |= strong[j]
                digits += len(words[j]) if words[j][0] in "0123456789" else 0
                signs += sign[j]
                last = words[j][0]
                if not hit or not (last in "0123456789" or last.isalpha()) or (not signs and (digits < 4 or last.isalpha())):
                    continue
                if signs and not any(x.isalpha() for x in words[j - 1 : j + 1]):
                    continue
                span = text[self.spans[i][0] : self.spans[j][1]]
                before, after = text[max(0, self.spans[i][0] - 24) : self.spans[i][0]], text[self.spans[j][1] : self.spans[j][1] + 2]
                found = span_features(words[i : j + 1], span, before, after)
                for kind in KINDS:
                    if (kind == "email") == bool(signs):
                        self.segments[j + 1].append((i, kind, [f"{kind}|{f}" for f in found]))

    def scored(self, w: dict[str, float]):
        """For each end position its segments as (start, kind, features, score)."""
        for end in range(1, len(self.spans) + 1):
            o = self.other[end - 1]
            yield end, [(end - 1, OTHER, o, sum(w.get(f, 0.0) for f in o))] + [(s, k, f, sum(w.get(x, 0.0) for x in f)) for s, k, f in self.segments[end]]

    def best(self, w: dict[str, float]) -> list[tuple[str, int, int]]:
        """The segments of the best path over positions and labels, without those of other tokens."""
        top: list[dict[str, tuple]] = [{START: (0.0, None)}]
        for _, segments in self.scored(w):
            own: dict[str, tuple] = {}
            for s, k, _, v in segments:
                score, before = max((x + w.get(f"{a}>{k}", 0.0), a) for a, (x, _) in top[s].items())
                if k not in own or own[k][0] < score + v:
                    own[k] = (score + v, (s, before))
            top.append(own)
        out, end = [], len(self.spans)
        label = max(top[end], key=lambda k: (top[end][k][0], k))
        while end:
            s, before = top[end][label][1]
            if label != OTHER:
                out.append((label, self.base + self.spans[s][0], self.base + self.spans[end - 1][1]))
            end, label = s, before
        return out[::-1]

    def gradient(self, w: dict[str, float], gold: set[tuple[str, int, int]]) -> dict[str, float]:
        """Of the log likelihood of the segmentation that has exactly ``gold``."""
        ends = list(self.scored(w))
        ahead: list[dict[str, float]] = [{START: 0.0}]
        for _, segments in ends:
            own: dict[str, list[float]] = defaultdict(list)
            for s, k, _, v in segments:
                own[k] += [x + w.get(f"{a}>{k}", 0.0) + v for a, x in ahead[s].items()]
            ahead.append({k: _log_sum(x) for k, x in own.items()})
        total = _log_sum(list(ahead[-1].values()))
        back: list[dict[str, float]] = [{k: -math.inf for k in x} for x in ahead]
        back[-1] = dict.fromkeys(ahead[-1], 0.0)
        true = [START] + [next((k for k, a, b in gold if a <= x and y <= b), OTHER) for x, y in self.spans]
        out: dict[str, float] = defaultdict(float)
        for end, segments in reversed(ends):
            for s, k, features, v in segments:
                is_true = true[end] == OTHER if k == OTHER else (k, self.spans[s][0], self.spans[end - 1][1]) in gold
                whole = 0.0
                for a, x in ahead[s].items():
                    step = w.get(f"{a}>{k}", 0.0) + v + back[end][k]
                    p = math.exp(x + step - total)
                    whole += p
                    out[f"{a}>{k}"] += (is_true and a == true[s]) - p
                    back[s][a] = step if back[s][a] == -math.inf else _log_sum([back[s][a], step])
                for f in features:
                    out[f] += is_true - whole
        return out


def _log_sum(x: list[float]) -> float:
    m = max(x)
    if len(x) == 1:
        return m
    return m + math.log(sum(math.exp(y - m) for y in x)) if m > -math.inf else m


def examples(n: int, seed: int = 3) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Generated windows with their personal data, and counterexamples without any."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(2, 9)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    octet = lambda: str(r.randint(0, 255))
    ends = ["com", "org", "net", "de", "edu"]

    def card() -> str:
        d = r.choice("3456") + num(r.choice([14, 14, 14, 13, 15]) - 0)
        d += next(c for c in "0123456789" if luhn(d + c))
        return r.choice([d, " ".join(d[i : i + 4] for i in range(0, len(d), 4)), "-".join(d[i : i + 4] for i in range(0, len(d), 4))])

    def broken() -> str:
        d = card()
        return d[:-1] + r.choice([c for c in "0123456789" if c != d[-1]])

    def email() -> str:
        if r.random() < 0.25:
            local = r.choice([word(), word(), f"{word()} dot {word()}", f"{word()}{num(2)}", f"{word()}.{word()}"])
            host = r.choice([word(), word(), f"{word()} dot {word()}", f"{word()}-{word()}"])
            return f"{local} at {host} dot {r.choice(ends)}"
        o, c = r.choice(["[]", "()", "{}"])
        at, dot = r.choice([("@", "."), (f" {o}at{c} ", f" {o}dot{c} "), (f"{o}at{c}", "."), (f" {o}at{c} ", ".")])
        local = r.choice(["", "." + word(), num(2), f".{word()}.{word()}", f"_{word()}{num(2)}", f"-{word()}_{word()}"])
        host = r.choice([word(), word(), f"{word()}-{word()}", f"{word()}{word()}{word()}{word()}{word()}", f"{word()}{dot}{word()}"])
        return f"{word()}{local}{at}{host}{dot}{r.choice(['com', 'org', 'net', 'de'])}"

    def phone() -> str:
        return r.choice([f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"+{num(2)} {num(3)} {num(4)} {num(3)}"])

    def ip() -> str:
        return r.choice([".", ".", "[.]", " [dot] "]).join(octet() for _ in range(4))

    def nothing() -> str:
        return r.choice([
            f"{r.randint(1900, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{num(2)}.{num(2)}.{r.randint(1900, 2030)}", num(r.randint(1, 9)), f"{num(1)}.{num(1)}.{num(1)}", f"{num(2)}:{num(2)}",
            f"{num(3)},{num(3)}", num(16)[:-1] + "x", broken(), broken(), broken(), "".join(r.choice("0123456789abcdef") for _ in range(r.choice([18, 32, 40]))), f"{r.randint(300, 999)}.{octet()}.{octet()}.{octet()}", f"{num(1)}.{num(1)}.{num(1)}.{num(1)}.{num(1)}", f"{num(4)}-{num(4)}", f"{num(2)}/{num(2)}/{num(4)}", f"isbn {num(3)}-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
            f"@{word()}", f"{word()} @ {word()}", f"{word()} at {word()} dot {word()}", f"{word()} at {word()} {word()} dot {r.choice(ends)}", f"{word()} at {word()} the dot {word()}", f"{word()} at noon", num(20), f"{num(4)} {num(4)}", f"{num(5)}", f"{word()} (at) {word()}", f"{num(3)} {num(3)} {num(3)} {num(3)} {num(3)} {num(3)} {num(3)}", f"{num(1)} {num(2)} {num(1)} {num(3)}", f"page {num(3)}-{num(3)}", num(10), num(11), num(12),
        ])

    out = []
    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    hints = {"email": ["mail", "contact"], "phone": ["call", "tel", "phone"], "card": ["card", "visa"], "ip": ["ip", "server"]}
    for _ in range(n):
        text, gold = " ".join(word() for _ in range(r.randint(1, 3))) + " ", set()
        for _ in range(r.choice([1, 1, 2])):
            kind = r.choice([*KINDS, None, None, None])
            if kind:
                text += r.choice([f"{r.choice(hints[kind])}: ", "", "", ""])
            value = makers[kind]() if kind else nothing()
            if kind:
                gold.add((kind, len(text), len(text) + len(value)))
            text += value + r.choice([" ", ", ", ". "]) + " ".join(word() for _ in range(r.randint(1, 3))) + r.choice([" ", ". "])
        out.append((text, gold))
    return out


@functools.cache
def fit(n: int = 700, epochs: int = 6) -> dict[str, float]:
    """Weights by stochastic gradients with adaptive steps."""
    data = [(Window(text), gold) for text, gold in examples(n)]
    w: dict[str, float] = defaultdict(float)
    square: dict[str, float] = defaultdict(lambda: 1e-2)
    for _ in range(epochs):
        for window, gold in data:
            for f, g in window.gradient(w, gold).items():
                g -= 1e-3 * w[f]
                square[f] += g * g
                w[f] += 0.5 * g / math.sqrt(square[f])
    return dict(w)


def _ahead(text: str, end: int) -> int:
    """Where the ``LONGEST`` tokens after ``end`` end; a run doesn't go on behind a wider gap."""
    for n, m in enumerate(_TOKEN.finditer(text, end)):
        if n == LONGEST or m.start() - end > 1:
            break
        end = m.end()
    return end


def _back(text: str, start: int, low: int) -> int:
    """Where the ``LONGEST`` tokens before ``start`` start, ``low`` at least."""
    size = 256
    while True:
        a = max(low, start - size)
        tokens = [m.span() for m in _TOKEN.finditer(text, a, start)]
        at, n = start, 0
        for x, y in reversed(tokens):
            if n == LONGEST or at - y > 1:
                return at
            if x > a or a == low:
                at, n = x, n + 1
        if a == low:
            return at
        size *= 4


def windows(text: str, near: int = 64) -> Iterator[Window]:
    """Pieces of text that hold every run of ``LONGEST`` tokens with a trigger; those that touch are one."""
    start = end = None
    for m in _TRIGGER.finditer(text):
        if end is None:
            start = _back(text, m.start(), 0)
        elif m.start() - end > near:
            a, b = _back(text, m.start(), end), _ahead(text, end)
            if a > b + 1:
                yield _window(text, start, b)
                start = a
        end = m.end()
    if end is not None:
        yield _window(text, start, _ahead(text, end))


def _window(text: str, start: int, end: int) -> Window:
    """The piece with what the features see before and after it."""
    a, b = start, min(len(text), end + 2)
    while a > 0 and a > start - 24 and (a > start - 12 or not text[a].isspace()):
        a -= 1
    return Window(text[a:b], a)


def spans(text: str | None, weights: dict[str, float]) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, whether it is a base one), by kind as listed, then start."""
    if not text:
        return []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], sorted(b for _, b in taken)
    out = [(k, a, b, True) for k, a, b in base]
    for window in windows(text):
        if any(window.segments):
            # Disjoint from every base span: as many base spans start before its end as end before its start.
            out += [(k, a, b, False) for k, a, b in window.best(weights) if bisect_left(starts, b) == bisect_right(ends, a)]
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, weights: dict[str, float] | None = None, text_col: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``, an array of structs ``kind, start, end, base``."""
    weights = weights or fit()

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b, "base": o} for k, a, b, o in spans(t, weights)] for t in texts])

    return docs.withColumn(out, found(F.col(text_col)))
