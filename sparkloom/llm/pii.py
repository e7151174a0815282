"""Personal data and secrets: base patterns, and a semi-Markov conditional random field.

The field labels whole segments of white-space tokens - a plain token, or an
entity of up to ``LONGEST`` tokens - from features of the whole segment (its
digit shape, check sum, octets, run of key characters, the word before it, long
numbers beside it).  One dynamic program over segment ends picks boundaries and
types together.  Only stretches around tokens with a digit or an at sign can
hold an entity; elsewhere every token is plain.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import map_arrow, slices

# The base patterns, possessive where giving back can't help, and
# anchored at the first digit of a run, where a leftmost match begins.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

LONGEST = 6
#: Tokens decoded at a time, and those looked at beside them.
WINDOW, MARGIN = 4096, 4 * LONGEST
#: What the field finds: the base kinds and credentials.
ENTITIES = (*KINDS, "secret")
_LABELS = ("O", *ENTITIES)
_TOKEN = re.compile(r"\S+")
_TRIGGER = re.compile(r"[0-9@]")
_DASHES = ("-", "–", "—")
_BLANK = re.compile(r"\n[^\S\n]*\n")
_EDGE = ".,;:!?()[]{}<>\"'"
_CUES = {"tel": "phone", "phone": "phone", "call": "phone", "mobile": "phone", "fax": "phone", "card": "card", "visa": "card", "credit": "card", "ip": "ip", "host": "ip", "address": "ip", "server": "ip", "email": "email", "mail": "email", "contact": "email", "version": "number", "section": "number", "page": "number", "order": "number", "no": "number", "on": "date", "since": "date", "price": "number", "usd": "number"}
_CUES |= {x: "secret" for x in ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key", "key", "bearer", "auth", "authorization")}
_CUES |= {x: "hash" for x in ("commit", "sha", "sha1", "sha256", "md5", "digest", "hash", "checksum", "uuid", "id", "build", "revision")}
_BETWEEN = ("=", ":", ":=", "=>", "is")
_ASSIGNED = re.compile(r"([A-Za-z_][\w-]*)(:=|=>|=|:)(?!/)(.{6,})", re.S)
_KEY = re.compile(r"[A-Za-z0-9+/_=.-]*[A-Za-z0-9]")
# How some providers begin their keys.
_ISSUED = re.compile(r"(AKIA|ghp_|gho_|sk-|xox[abp]-|glpat-|AIza)[A-Za-z0-9_-]{12,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, each found from its at sign."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, in code points, by start, then kind."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _shape(core: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 5)}", core))


def _longest(core: str) -> str:
    """The longest run of characters that keys are made of."""
    return max(_KEY.findall(core), key=len, default="")


@lru_cache(maxsize=20_000)
def _features(core: str, before: str, n: int, crowd: bool = False) -> tuple[str, ...]:
    """Features of a whole segment; ``crowd``: a long number stands right beside it."""
    digits = "".join(c for c in core if c in "0123456789")
    run = _longest(core) if n == 1 else ""
    mixed = len(run) >= 12 and bool(re.search("[A-Za-z]", run)) and bool(_DIGIT.search(run))
    shape = "key" if mixed else _shape(core)[:24]
    out = ["bias", f"n{n}", f"cue:{before}", f"shape:{shape}", f"digits:{min(len(digits), 20)}"]
    if mixed:
        out += [f"run:{min(len(run) // 8, 6)}", f"key:{before}", "hex" if re.fullmatch("[0-9A-Fa-f-]+", run) else "no-hex"]
        if _ISSUED.match(run):
            out.append("issued")
    if crowd:
        out += ["crowd", f"crowd{n}"]
    if core.startswith("+"):
        out.append("plus")
    if re.search(r"[A-Za-z]", core):
        out.append("letters")
    if 14 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "no-luhn")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts):
        out.append("octets" if all(int(p) <= 255 for p in parts) else "no-octets")
    if emails(core) == [(0, len(core))]:
        out.append("mailbox")
    if re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", core):
        out.append("dial")
    return tuple(out)


_NUMBER = re.compile(r"[^0-9A-Za-z]*[0-9]{10,}[^0-9A-Za-z]*")


@dataclass
class Field:
    """Weights by (label, feature) and (label, label before)."""

    weights: dict[tuple[str, str], float]

    def score(self, label: str, features: tuple[str, ...]) -> float:
        w = self.weights
        return sum(w.get((label, f), 0.0) for f in features)

    def lattice(self, tokens: list[str]) -> list[list[tuple[int, str, tuple[str, ...], float]]]:
        """For each end the segments (start, label, features, score) that end there."""
        hot = [bool(_TRIGGER.search(t)) for t in tokens]
        number = [False, *(bool(_NUMBER.fullmatch(t)) for t in tokens), False]
        cues = ["", *(_CUES.get(t.strip(_EDGE).lower(), "") for t in tokens)]
        for i in range(2, len(cues)):
            if tokens[i - 1] in _BETWEEN:
                cues[i] = cues[i - 1]
        out: list[list] = [[] for _ in range(len(tokens) + 1)]
        for i in range(len(tokens)):
            f = _features(tokens[i].strip(_EDGE), cues[i], 1, number[i] or number[i + 2]) if hot[i] else ("bias", "cold")
            out[i + 1].append((i, "O", f, self.score("O", f)))
            if hot[i]:
                for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
                    if hot[j - 1]:
                        f = _features(trim(" ".join(tokens[i:j]))[0], cues[i], j - i, number[i] or number[j + 1])
                        out[j] += [(i, k, f, self.score(k, f)) for k in ENTITIES]
        return out

    def segment(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """``decode`` of ``WINDOW`` tokens at a time, each seen with ``MARGIN`` tokens on either side."""
        if len(tokens) <= WINDOW:
            return self.decode(tokens)
        out: list[tuple[int, int, str]] = []
        for lo in range(0, len(tokens), WINDOW):
            base = max(0, lo - MARGIN)
            for i, j, k in self.decode(tokens[base : lo + WINDOW + MARGIN]):
                if lo <= base + i < lo + WINDOW and (not out or out[-1][1] <= base + i):
                    out.append((base + i, base + j, k))
        return out

    def decode(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """Best segmentation: entities as (first token, token after, kind)."""
        best: list[dict[str, tuple[float, tuple | None]]] = [{"O": (0.0, None)}]
        for j, segments in enumerate(self.lattice(tokens)[1:], 1):
            here: dict[str, tuple[float, tuple | None]] = {}
            for i, k, _, s in segments:
                for before, (v, _) in best[i].items():
                    total = v + s + self.weights.get((k, "after:" + before), 0.0)
                    if k not in here or total > here[k][0]:
                        here[k] = total, (i, before)
            best.append(here)
        out, j = [], len(tokens)
        k = max(best[j], key=lambda x: best[j][x][0])
        while j:
            i, before = best[j][k][1]
            if k != "O":
                out.append((i, j, k))
            j, k = i, before
        return out[::-1]

    @staticmethod
    def train(sentences: list[tuple[list[str], list[tuple[int, int, str]]]], epochs: int = 12, rate: float = 0.2, decay: float = 1e-3) -> "Field":
        """Gradient of the conditional log-likelihood: observed less expected features."""
        field = Field(defaultdict(float))
        w = field.weights
        for epoch in range(epochs):
            step = rate / (1 + 0.2 * epoch)
            for tokens, entities in sentences:
                lattice = field.lattice(tokens)
                n = len(tokens)
                ahead: list[dict[str, float]] = [{"O": 0.0}] + [{} for _ in range(n)]
                for j in range(1, n + 1):
                    terms: dict[str, list[float]] = defaultdict(list)
                    for i, k, _, s in lattice[j]:
                        for b, v in ahead[i].items():
                            terms[k].append(v + s + w.get((k, "after:" + b), 0.0))
                    ahead[j] = {k: _sum(v) for k, v in terms.items()}
                behind: list[dict[str, float]] = [defaultdict(lambda: -1e30) for _ in range(n)] + [{k: 0.0 for k in _LABELS}]
                gathered: list[dict[str, list[float]]] = [defaultdict(list) for _ in range(n)]
                for j in range(n, 0, -1):
                    if j < n:
                        behind[j] = {b: _sum(v) for b, v in gathered[j].items()}
                    for i, k, _, s in lattice[j]:
                        for b in ahead[i]:
                            gathered[i][b].append(s + w.get((k, "after:" + b), 0.0) + behind[j].get(k, -1e30))
                total = _sum(list(ahead[n].values()))
                update: dict[tuple[str, str], float] = defaultdict(float)
                for j in range(1, n + 1):
                    for i, k, f, s in lattice[j]:
                        for b, v in ahead[i].items():
                            p = exp(min(0.0, v + s + w.get((k, "after:" + b), 0.0) + behind[j].get(k, -1e30) - total))
                            if p > 1e-6:
                                update[k, "after:" + b] -= p
                                for x in f:
                                    update[k, x] -= p
                at, before = 0, "O"
                marks = {i: (j, k) for i, j, k in entities}
                while at < n:
                    j, k = marks.get(at, (at + 1, "O"))
                    f = next(f for i, label, f, _ in lattice[j] if i == at and label == k)
                    update[k, "after:" + before] += 1
                    for x in f:
                        update[k, x] += 1
                    at, before = j, k
                for x, g in update.items():
                    w[x] += step * (g - decay * w[x])
        field.weights = dict(w)
        return field


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + log(sum(exp(v - top) for v in values))


def trim(text: str) -> tuple[str, int]:
    """Without punctuation at the edges (a leading parenthesis of a number stays); what was cut before."""
    core = text.rstrip(".,;:!?]}>\"'" + ("(" if "(" in text else "()"))
    if core.count(")") > core.count("("):
        core = core.rstrip(")")
    left = len(core) - len(core.lstrip(".,;:!?)[]{}<>\"'"))
    return core[left:], left


def examples(n: int = 800, seed: int = 5) -> list[tuple[list[str], list[tuple[int, int, str]]]]:
    """Made-up sentences with known entities, in the base forms and others, and look-alikes."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(2, 9)))

    def card(valid: bool) -> str:
        body = r.choice("456") + digits(14)
        last = next(str(c) for c in range(10) if luhn(body + str(c)))
        number = body + (last if valid else str((int(last) + r.randrange(1, 10)) % 10))
        return r.choice((number, " ".join(number[i : i + 4] for i in range(0, 16, 4)), "-".join(number[i : i + 4] for i in range(0, 16, 4))))

    blob = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k - 2)) + digits(1) + r.choice("abcdef")
    hexes = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k - 2)) + digits(1) + r.choice("abcdef")
    key = lambda: r.choice((lambda: hexes(r.choice((32, 40, 40, 64))), lambda: hexes(40).upper(), lambda: blob(r.randrange(16, 48))))()
    octets = lambda: ".".join(str(r.randrange(1, 256)) for _ in range(4))
    made = {
        "email": lambda: f"{word()}{r.choice(('.', '_', ''))}{r.choice((word(), digits(2)))}@{word()}{digits(1)}.{r.choice(('com', 'org', 'example.com'))}",
        "ip": octets,
        "card": lambda: card(True),
        "secret": lambda: r.choice((key, key, lambda: f"AKIA{''.join(r.choice('ABCDEFGHJKLMNPQRSTUVWXYZ234567') for _ in range(15))}7", lambda: f"ghp_{blob(36)}", lambda: f"sk-{blob(40)}"))(),
        "phone": lambda: r.choice((f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(3)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}")),
    }
    plain = (lambda: digits(r.randrange(1, 7)), lambda: f"{r.randrange(1, 4)}.{r.randrange(9)}.{r.randrange(9)}", lambda: f"20{digits(2)}-{r.randrange(10, 13)}-{digits(2)}", lambda: card(False), lambda: f"{word()}={digits(3)}{word()}{digits(4)}", lambda: f"{r.randrange(300, 999)}.{r.randrange(300, 999)}.{digits(2)}.{digits(3)}", lambda: f"@{word()}", lambda: f"{digits(3)}-{digits(2)}", lambda: digits(10), lambda: f"{digits(3)} {digits(3)}", lambda: f"${digits(2)}.{digits(2)}", lambda: " ".join(card(True).replace(" ", "").replace("-", "") for _ in range(r.randrange(2, 5))), lambda: hexes(r.choice((32, 40))), lambda: f"{r.choice(('commit', 'md5', 'sha1', 'id', 'checksum'))} {r.choice(('', '= ', ': '))}{hexes(r.choice((12, 32, 40, 64)))}", lambda: f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}", lambda: f"{word()}{digits(3)}{word()}{digits(4)}{word()}")
    out = []
    for _ in range(n):
        tokens, marks = [word() for _ in range(r.randrange(1, 4))], []
        for _ in range(r.randrange(1, 4)):
            if r.random() < 0.5:
                kind = r.choice(ENTITIES)
                made_up = made[kind]()
                if kind == "secret":
                    if not _ISSUED.match(made_up) or r.random() < 0.5:
                        tokens.append(r.choice([c for c, k in _CUES.items() if k == kind]))
                        if r.random() < 0.7:
                            tokens.append(r.choice(_BETWEEN))
                    made_up = r.choice(("{}", '"{}"', "'{}'", '"{}"!!')).format(made_up)
                elif r.random() < 0.4:
                    tokens.append(r.choice([c for c, k in _CUES.items() if k == kind]))
                parts = (made_up + r.choice(("", "", ".", ","))).split(" ")
                marks.append((len(tokens), len(tokens) + len(parts), kind))
            else:
                if r.random() < 0.3:
                    tokens.append(r.choice([c for c, k in _CUES.items() if k in ("number", "date")]))
                parts = r.choice(plain)().split(" ")
            tokens += parts + [word() for _ in range(r.randrange(1, 3))]
        out.append((tokens, marks))
    return out


def train(n: int = 800) -> Field:
    """The field fitted to ``examples``."""
    return Field.train(examples(n))


def undashed(tokens: list[tuple[str, int, int]]) -> list[tuple[str, int, int]] | None:
    """Numbers with a lone dash between them as one token; None where there are none."""
    out, i = [], 0
    while i < len(tokens):
        if 0 < i < len(tokens) - 1 and tokens[i][0] in _DASHES and out[-1][0][-1] in "0123456789)" and tokens[i + 1][0][0] in "0123456789(":
            out[-1] = (f"{out[-1][0]}-{tokens[i + 1][0]}", out[-1][1], tokens[i + 1][2])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out if len(out) < len(tokens) else None


def unassigned(tokens: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``name=value`` as three tokens."""
    out = []
    for t, s, e in tokens:
        m = _ASSIGNED.fullmatch(t)
        out += [(m[k], s + m.start(k), s + m.end(k)) for k in (1, 2, 3)] if m and _TRIGGER.search(m[3]) and m[1].lower() in _CUES else [(t, s, e)]
    return out


def field_spans(text: str, field: Field) -> list[tuple[str, int, int]]:
    """Entities of the field, decoded around every token that can begin or end one.

    White space of any length but a blank line, and one other token, may lie
    between two such tokens.  Where numbers have lone dashes between them, they
    are decoded as one token too; what that adds must not meet the rest.
    """
    out: list[tuple[str, int, int]] = []
    region: list[re.Match] = []
    last = -10

    def flush() -> None:
        seen = []
        for tokens in (plain := unassigned([(t[0], *t.span()) for t in region]), undashed(plain)):
            if tokens is None:
                continue
            for i, j, kind in field.segment([t[0] for t in tokens]):
                s, e = tokens[i][1], tokens[j - 1][2]
                core, left = trim(text[s:e])
                if kind == "secret":
                    core = _longest(text[s:e])
                    left = text[s:e].find(core)
                span = (kind, s + left, s + left + len(core))
                if tokens is plain or not any(span[1] < y and x < span[2] for _, x, y in seen):
                    seen.append(span)
        out.extend(seen)

    hot = _TRIGGER.search(text)
    at = 0
    while hot:
        start = text.rfind(" ", at, hot.start()) + 1 or at
        start = max(start, text.rfind("\n", at, hot.start()) + 1, text.rfind("\t", at, hot.start()) + 1)
        token = _TOKEN.search(text, start)
        while token.end() <= hot.start():
            token = _TOKEN.search(text, token.end())
        if region:
            between = _TOKEN.search(text, last)
            cold = between.start() < token.start()
            if (cold and _TOKEN.search(text, between.end()).start() < token.start()) or _BLANK.search(text, last, token.start()):
                flush()
                region = []
            elif cold:
                region.append(between)
        if not region:
            off = max(at, token.start() - 60)
            before = re.search(r"(\S+)\s+(?:(\S+)\s+)?$", text[off : token.start()])
            if before:
                region.append(_TOKEN.search(text, off + before.start(1)))
                if before[2]:
                    region.append(_TOKEN.search(text, off + before.start(2)))
        region.append(token)
        last = at = token.end()
        hot = _TRIGGER.search(text, token.end())
    if region:
        flush()
    return out


def find(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans); a span of the field that meets a base span is dropped."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    more = [x for x in field_spans(text, field) if not any(x[1] < e and s < x[2] for _, s, e in base)]
    return base, sorted(base + more, key=lambda x: (x[1], ENTITIES.index(x[0]), x[2]))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span, or run of meeting spans, replaced by its first kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, s, e = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < e:
            e = max(e, spans[i][2])
            i += 1
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


class _Find:
    def __init__(self, field, masked: bool):
        self.field, self.masked = field, masked

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = self.field.value
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                found = [find(t, field) for t in texts]
                counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in found], pa.int64()) for kind in KINDS]
                digest = pa.array([hashlib.sha256(_join(b).encode()).hexdigest() for b, _ in found])
                secrets = pa.array([sum(k == "secret" for k, _, _ in s) for _, s in found], pa.int64())
                cols = [batch.column(0), *counts, digest, pa.array([_join(s) for _, s in found]), secrets, pa.array([bool(s) for _, s in found], pa.bool_())]
                names = ["row", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_secret", "found"]
                if self.masked:
                    cols.append(pa.array([mask(t, s) if v else None for t, (_, s), v in zip(texts, found, batch.column(1).is_valid().to_pylist(), strict=True)], pa.string()))
                    names.append("masked")
                yield pa.RecordBatch.from_arrays(cols, names=names)


def detect(docs: DataFrame, field: Field | None = None, text_col: str = "text", carry: list[str] | None = None, masked: bool = False) -> DataFrame:
    """``carry`` columns and n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, found, and ``masked`` text if asked.

    The first counts and ``base_sha256`` are of the base patterns; ``spans``
    holds these and what the field adds (these kinds and ``secret``, which
    ``n_secret`` counts; ``found``: whether there is any), as kind:start:end in code points, end exclusive,
    by start, then kind.  A null text is empty and its masked text null.  All
    rows are looked at, also repeated ones and those without an id; columns
    not carried are ignored.
    """
    keep = carry or ["doc_id"]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row")
    src = docs.select(row, F.col(text_col).cast("string").alias("text"))
    kind = src.schema["row"].dataType.simpleString()
    names = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_secret", "found", *["masked"] * masked]
    schema = ", ".join([f"row {kind}", *[f"n_{k} bigint" for k in KINDS], "base_sha256 string", "spans string, n_secret bigint, found boolean", *["masked string"] * masked])
    out = map_arrow(src, _Find(docs.sparkSession.sparkContext.broadcast(field or train()), masked), schema)
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)], *names)
