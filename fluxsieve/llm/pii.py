"""Personal data by fixed rules and a semi-Markov conditional random field.

Rules give the base spans (email, ip, card, phone). The field scores whole candidate segments, by features
of the segment and of its neighbourhood, and a dynamic program over segments of bounded length chooses
boundaries and types jointly; it adds spans the rules miss (spelled-out addresses, local phone numbers,
national identity numbers) and never removes or overlaps a base span.

Candidate segments start and end at tokens, hold a digit or an "at" sign or word in any case, have LONGEST tokens at most, and stay
within a line; everything else can only be outside, so the program runs on the neighbourhoods of such tokens: runs of numbers
with 7 digits, or 4 and three dots, which every type needs, and what is around an "at". The weights are learnt here by
gradient ascent on the likelihood of a small generated corpus (no person's data), once a process.

Scale: one pass without a shuffle. The program keeps a few numbers a token of a neighbourhood and makes the segments of one
token at a time, so time and memory grow in proportion to a text, also where it is one run.

Defined results: a null text is the empty text and has no spans; an empty table gives no rows; equal
texts give equal spans; rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import random
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Base kinds in the order in which spans that start together are listed; the field's own kinds follow.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_words", "phone_local", "ssn")
RANK = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else _DOUBLED[int(d)] for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; leftmost matches of a kind don't overlap."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        # only the run of local characters before this sign can begin a match, at its first free place
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end(), 0))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), m.end(), 3))
    found.sort(key=lambda x: (x[0], x[2]))
    return [(a, b, KINDS[k]) for a, b, k in found]


#: A neighbourhood for the field: a run of digits and the marks that numbers are written with, or what is around an "at".
_RUN = re.compile(r"[+(]?[0-9][0-9+().\x20-]*[0-9]")
_AT = re.compile(r"(?ai)(?:@|[(\[]\x20?at\x20?[)\]]|(?<=\x20)at(?=\x20))\x20*")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DOT = re.compile(r"(?ai)\x20*(?:\.|[(\[]\x20?dot\x20?[)\]])\x20*|\x20+dot\x20+")
#: Words that stand before "at" in prose, and last labels that are common.
_PROSE = frozenset("look looks looked looking meet meets met arrive arrived stay stayed stop stopped see sold start started us them it is are was were be here there not only work works worked laugh aim point stare shop sit read find found open hosted available end begin him her me you and or".split())
_LAST = frozenset("com org net edu gov info io biz eu de fr es it uk us ch nl co test example invalid".split())
_MARKS = re.compile("[+().]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
#: Tokens in a segment, at most; a card of single spaced digits has 37.
LONGEST = 40
_CUES = {
    "phone": ("phone", "tel", "call", "mobile", "fax"), "card": ("card", "visa", "credit", "payment"),
    "ip": ("ip", "host", "server", "address"), "ssn": ("ssn", "social", "security"), "email": ("mail", "contact", "write"),
}
_CUE_OF = {w: k for k, ws in _CUES.items() for w in ws}
_TYPES = ("ip", "card", "phone", "phone_local", "ssn")
_ALL = (*_TYPES, "email_words")


def _cue(text: str, start: int) -> str:
    for w in reversed(re.findall(r"[A-Za-z]+", text[max(0, start - 24) : start].lower())[-3:]):
        if w in _CUE_OF:
            return _CUE_OF[w]
    return ""


def _features(text: str, start: int, end: int, kind: str, cue: str) -> list[str]:
    """Of a whole segment as one type."""
    span = text[start:end]
    digits = _digits(span)
    n = len(digits)
    shape = "".join(str(min(len(x), 9)) if x.isdigit() else x for x in _TOKEN.findall(span)) if len(span) <= 32 else span
    before, after = text[start - 1 : start], text[end : end + 1]
    out = [f"{kind}:bias", f"{kind}:shape={shape}" if len(shape) <= 16 else f"{kind}:long", f"{kind}:plus={span[0] == '+'}", f"{kind}:cue={cue}"]
    out.append(f"{kind}:digits={'few' if n < 9 else 'some' if n < 12 else 'many' if n <= 19 else 'over'}")
    out.append(f"{kind}:luhn={12 <= n <= 19 and luhn(digits)}:{n >= 12}")
    out.append(f"{kind}:ip={n <= 12 and bool(m := _IP.fullmatch(span)) and all(int(p) <= 255 for p in m[0].split('.'))}")
    out.append(f"{kind}:cut={(before.isalnum() or before in '.-' and before != '')}{after.isalnum()}")
    out.append(f"{kind}:spaces={min(3, span.count(' '))}")
    return out


def _allowed(span: str, n: int) -> list[str]:
    """The types a span with n digits can be at all: bounds the segments, not their scores."""
    out = []
    if n <= 12 and span.count(".") == 3 and " " not in span:
        out.append("ip")
    if span[0] == "+":
        return [*out, "phone"] if 9 <= n <= 15 else out
    if 12 <= n <= 19 and not _MARKS.search(span):
        out.append("card")
    if n == 10:
        out.append("phone_local")
    if n == 9 and len(span) == 11:
        out.append("ssn")
    return out


Address = tuple[list[int], tuple[int, int], list[tuple[int, str]]]


def _addresses(text: str, taken: list[tuple[int, int]]) -> Iterator[Address]:
    """For each "at" outside the base spans (taken, in order), if a dot follows: places where an address can start, where the sign stands, and
    places where the address can end, with the dots up to there."""
    if "@" not in text and "at" not in text.lower():
        return
    starts_, reached = [x for x, _ in taken], [0, *itertools.accumulate((y for _, y in taken), max)]
    for m in _AT.finditer(text):
        i = bisect_left(starts_, m.end())
        low, high = reached[i], starts_[i] if i < len(starts_) else len(text)
        left = m.start()
        while left > low and text[left - 1] == " ":
            left -= 1
        a = left
        while a > low and text[a - 1] in _LOCAL:
            a -= 1
        starts = [a + t.start() for t in _TOKEN.finditer(text[a:left]) if t[0].isalnum()][-LONGEST:]
        ends: list[tuple[int, str]] = []
        dots, label = "", _LABEL.match(text, m.end(), high)
        while label and len(ends) < LONGEST and (dot := _DOT.match(text, label.end(), high)) and (label := _LABEL.match(text, dot.end(), high)):
            mark = dot[0].lower().strip()
            dots += "." if dot[0] == "." else "s" if mark == "." else "w" if mark == "dot" else "b"
            ends.append((label.end(), dots))
        if starts and ends:
            yield starts, (left, m.end()), ends


def _address_features(text: str, start: int, sign: tuple[int, int], end: int, dots: str) -> list[str]:
    """Of a whole segment as an address in words."""
    mark = text[sign[0] : sign[1]].lower()
    style = "word" if mark.strip() == "at" else "sign" if "@" in mark else "bracket"
    last = re.split(r"[^A-Za-z0-9-]", text[sign[1] : end])[-1]
    how = "known" if last.lower() in _LAST else "short" if last.isalpha() and len(last) <= 4 else "other"
    kinds = "".join(sorted(set(dots)))
    out = ["email_words:bias", f"email_words:at={style}", f"email_words:dots={kinds}", f"email_words:at={style}:dots={kinds}:last={how}", f"email_words:last={how}:{'s' in dots and last[:1].isupper()}"]
    out.append(f"email_words:prose={style == 'word' and text[start : sign[0]].lower() in _PROSE}")
    out.append(f"email_words:cut={start > 0 and text[start - 1] in _LOCAL}")
    out.append(f"email_words:more={bool((d := _DOT.match(text, end)) and (x := _LABEL.match(text, d.end())) and x[0].lower() in _LAST)}")
    out.append(f"email_words:cue={_cue(text, start)}")
    return out


class Window:
    """A neighbourhood: the bounds of its tokens, and the segments that start at each of them, made when they are asked for."""

    def __init__(self, text: str, start: int, end: int, addresses: list[Address]):
        self.text = text
        self.bounds = array("q", (m.start() + start for m in _TOKEN.finditer(text[start:end])))
        self.bounds.append(end)
        self.addresses: dict[int, list[tuple[int, list[str]]]] = {}
        for starts, sign, ends in addresses:
            for b, dots in ends:
                j = bisect_left(self.bounds, b)
                for a in starts:
                    i = bisect_left(self.bounds, a)
                    if self.bounds[i] == a and self.bounds[j] == b and j - i <= LONGEST:
                        self.addresses.setdefault(i, []).append((j, _address_features(text, a, sign, b, dots)))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def segments(self, i: int) -> Iterator[tuple[int, str, list[str]]]:
        """(end, type or "", features) of the segments from token i."""
        text, bounds = self.text, self.bounds
        a = bounds[i]
        yield i + 1, "", ["out:digits" if text[a].isdigit() else "out:word" if text[a].isalpha() else "out:mark"]
        if text[a] in "0123456789+(":
            n, cue = 0, None
            for j in range(i, min(i + LONGEST, len(bounds) - 1)):
                if text[bounds[j]].isdigit():
                    n += bounds[j + 1] - bounds[j]
                    if n > 19:
                        break
                    if n >= 4:
                        for k in _allowed(text[a : bounds[j + 1]], n):
                            cue = _cue(text, a) if cue is None else cue
                            yield j + 1, k, _features(text, a, bounds[j + 1], k, cue)
        for j, features in self.addresses.get(i, ()):
            yield j, "email_words", features

    def best(self, w: dict[str, float]) -> list[tuple[int, int, str]]:
        """The best segmentation, by dynamic programming, as (start, end, type) of what isn't outside; ties go to the earliest start, then
        to the segment listed first."""
        n = len(self)
        top, origin, kinds = array("d", [-math.inf]) * (n + 1), array("q", [0]) * (n + 1), bytearray(n + 1)
        top[0] = 0.0
        for i in range(n):
            here = top[i]
            for j, kind, features in self.segments(i):
                s = here + sum(w.get(f, 0.0) for f in features)
                if s > top[j]:
                    top[j], origin[j], kinds[j] = s, i, RANK[kind] + 1 if kind else 0
        out = []
        while n:
            if kinds[n]:
                out.append((self.bounds[origin[n]], self.bounds[n], KINDS[kinds[n] - 1]))
            n = origin[n]
        return out[::-1]


def _scores(segs: list, w: dict[str, float]) -> list[float]:
    return [sum(w.get(f, 0.0) for f in s[3]) for s in segs]


def _gradient(n: int, segs: list, gold: set[tuple[int, int, str]], w: dict[str, float], grad: dict[str, float]) -> None:
    """Adds observed less expected features: forward and backward sums over all segmentations."""
    s = _scores(segs, w)
    order = sorted(range(len(segs)), key=lambda k: segs[k][0])

    def add(a: float, b: float) -> float:
        if a == -math.inf:
            return b
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))

    f = [0.0] + [-math.inf] * n
    for k in order:
        i, j = segs[k][:2]
        f[j] = add(f[j], f[i] + s[k])
    b = [-math.inf] * n + [0.0]
    for k in sorted(range(len(segs)), key=lambda k: -segs[k][1]):
        i, j = segs[k][:2]
        b[i] = add(b[i], b[j] + s[k])
    for k, (i, j, kind, feats) in enumerate(segs):
        d = ((i, j, kind) in gold) - math.exp(min(0.0, f[i] + s[k] + b[j] - f[n]))
        for x in feats:
            grad[x] = grad.get(x, 0.0) + d


def generated(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Lines of invented words, numbers that are no personal data, and invented entities, with their spans."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        d = r.choice("3456") + num(r.choice((11, 14, 14, 14, 17)))
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = r.choice(("", "", " ", "-"))
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def name() -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))

    def address() -> str:
        """In words, or with a sign that the rule for plain addresses misses."""
        style = r.randrange(5)
        at, dot = (r.choice((" at ", " AT ")), r.choice((" dot ", " DOT ", ".")), ) if style < 2 else (r.choice((" (at) ", "(at)", " (AT) ", "[at]", " [at] ")), r.choice((" (dot) ", "(dot)", " [dot] ", " dot ", ".")))
        if style == 4:
            at, dot = r.choice(((" @ ", "."), ("@ ", "."), ("@", " dot "), ("@", "(dot)"), (" @ ", " dot ")))
        return r.choice((name(), name(), f"{name()}.{name()}", f"{name()}{num(2)}")) + at + dot.join([name() for _ in range(r.choice((1, 1, 2)))] + [r.choice(sorted(_LAST))])

    def prose() -> str:
        """What has an "at" and a dot but is no address."""
        verb = r.choice((r.choice(sorted(_PROSE)), name()))
        return r.choice((f"{verb} at {name()}. {name().title()} {name()}", f"{verb} at {name()}. {name().title()}", f"{verb} at {name()} dot {name()}", f"{r.choice(sorted(_PROSE))} at {name()}.{r.choice(sorted(_LAST))}", f"{verb} at {name()}.{name()}ing", f"{verb} at {name()}. {name()} it"))

    make = {
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), "card": card,
        "phone": lambda: "+" + r.choice((f"1 ({num(3)}) {num(3)}-{num(4)}", f"{r.randint(20, 99)} {num(3)} {num(4)}", f"{r.randint(20, 99)}-{num(2)}-{num(4)}-{num(3)}", f"{r.randint(20, 99)}{num(9)}")),
        "phone_local": lambda: r.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}")),
        "ssn": lambda: f"{num(3)}-{num(2)}-{num(4)}", "email_words": lambda: address(),
    }
    plain = (lambda: num(r.randint(1, 9)), lambda: f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: ".".join(str(r.randint(0, 20)) for _ in range(r.randint(2, 3))), lambda: num(r.randint(10, 22)), lambda: f"{r.randint(1, 999)}.{num(2)}", lambda: f"{r.randint(300, 999)}.{num(1)}.{num(3)}.{num(2)}", lambda: " ".join(num(r.randint(1, 4)) for _ in range(r.randint(4, 9))), prose, prose, prose)
    words = ["for", "the", "note", "was", "of", "number", "order", "in", *(x for ws in _CUES.values() for x in ws)]
    out = []
    for _ in range(n):
        text, spans = r.choice(words) + " ", []
        for _ in range(r.randint(1, 3)):
            kind = r.choice(("", "", "", *_ALL))
            piece = make[kind]() if kind else r.choice(plain)()
            if kind == "email_words" and text[-2].isalnum() and r.random() < 0.5:
                text = text[:-1] + ": "
            elif kind and r.random() < 0.4:
                text += r.choice(_CUES.get(kind.split("_")[0], ("note",))) + " "
            if kind:
                spans.append((len(text), len(text) + len(piece), kind))
            text += piece + r.choice((" ", " ", f" {r.choice(words)} "))
        out.append((text, spans))
    return out


def _numbers(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Number runs with 7 digits or more, or 4 and three dots, without the base spans (taken, in order)."""
    if not _DIGITS.search(text):
        return
    at = 0
    for m in _RUN.finditer(text):
        a, end = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        i = at
        while True:
            over = i < len(taken) and taken[i][0] < end
            b = min(taken[i][0], end) if over else end
            part = text[a:b]
            digits = sum(map(len, _DIGITS.findall(part)))
            if digits >= 7 or digits >= 4 and part.count(".") >= 3:
                yield a, b
            if not over:
                break
            a = max(a, taken[i][1])
            i += 1


def _windows(text: str, taken: list[tuple[int, int]]) -> Iterator[Window]:
    """Neighbourhoods with the addresses in them; what overlaps is one."""
    parts = [(a, b, []) for a, b in _numbers(text, taken)]
    parts += [(x[0][0], x[2][-1][0], [x]) for x in _addresses(text, taken)]
    parts.sort(key=lambda x: x[:2])
    at = 0
    while at < len(parts):
        a, b, found = parts[at]
        found = list(found)
        at += 1
        while at < len(parts) and parts[at][0] < b:
            b = max(b, parts[at][1])
            found += parts[at][2]
            at += 1
        yield Window(text, a, b, found)


@functools.cache
def weights(lines: int = 400, rounds: int = 25, seed: int = 5) -> dict[str, float]:
    """Learnt by gradient steps on the likelihood, with a Gaussian prior. Deterministic."""
    cases = []
    for text, spans in generated(lines, seed):
        for window in _windows(text, []):
            bounds = window.bounds
            segs = [(i, *x) for i in range(len(window)) for x in window.segments(i)]
            at = {p: i for i, p in enumerate(bounds)}
            inside = [(at[x], at[y], k) for x, y, k in spans if x in at and y in at]
            covered = {i for i, j, _ in inside for i in range(i, j)}
            gold = {*inside, *((i, i + 1, "") for i in range(len(bounds) - 1) if i not in covered)}
            if gold <= {s[:3] for s in segs}:
                cases.append((len(bounds) - 1, segs, gold))
    w: dict[str, float] = {}
    sums: dict[str, float] = {}
    for _ in range(rounds):
        grad: dict[str, float] = {}
        for n, segs, gold in cases:
            _gradient(n, segs, gold, w, grad)
        for k, g in grad.items():
            g -= 0.05 * w.get(k, 0.0)
            sums[k] = sums.get(k, 1e-6) + g * g
            w[k] = w.get(k, 0.0) + 0.7 * g / math.sqrt(sums[k])
    return w


def added_spans(text: str, base: list[tuple[int, int, str]], w: dict[str, float]) -> list[tuple[int, int, str]]:
    """What the field finds beside the base spans, whose places the neighbourhoods leave out."""
    return [x for window in _windows(text, sorted({(a, b) for a, b, _ in base})) for x in window.best(w)]


def spans(text: str | None, w: dict[str, float]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans, both by start and kind."""
    text = text or ""
    base = base_spans(text)
    more = added_spans(text, base, w)
    return base, sorted(base + more, key=lambda x: (x[0], RANK[x[2]])) if more else base


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
_ARROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])


def find(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> SCHEMA, a row for each row; n_spans counts all spans."""
    w = weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {f.name: [] for f in _ARROW}
            for text in batch["text"]:
                base, every = spans(text.as_py(), w)
                kinds = [k for *_, k in base]
                for k in BASE:
                    rows[f"n_{k}"].append(kinds.count(k))
                rows["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows["spans"].append(_joined(every))
                rows["n_spans"].append(len(every))
            rows["doc_id"] = batch["doc_id"].cast(pa.int64())
            yield pa.RecordBatch.from_pydict(rows, schema=_ARROW)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact(text: str | None, mark: str = "[{}]") -> str | None:
    """The text with every span replaced by its kind; overlapping spans become one."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind in spans(text, weights())[1]:
        if a >= at:
            out += [text[at:a], mark.format(kind.upper())]
        at = max(at, b)
    return "".join([*out, text[at:]])
