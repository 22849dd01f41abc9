"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns with their checks (email, ip, card, phone).
A pattern reads one place only: digits that touch another number are lost to it,
although the same number stands alone elsewhere. So every run of characters that
holds a digit or an @ is a token with a label (none or a kind). Tokens that
touch are neighbours in a chain; tokens of a document that repeat or resemble
each other, at any distance, are joined by skip edges and share potentials.
Loopy message passing over both gives every token's label; base spans are
observed. Labelled tokens outside the base spans become further spans.

Potentials are counted over the whole corpus, with the base spans as labels
(piecewise training): log shares of labels by token form, and log odds that
joined tokens agree. The driver gets the counts of forms only.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

# Kinds in the order of their spans; label 0 is none.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = 1, 2, 3, 4
LABELS = len(KINDS) + 1
# Digits of a card and of a phone number.
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: Rounds of message passing, share of the old message kept, smoothing, and the log weight of an observed label.
ROUNDS, DAMPING, SMOOTH, OBSERVED = 16, 0.3, 0.5, 30.0
#: Least digits that a phone number resembling another one may have, and digits that must be the same.
SHORT_PHONE, ALIKE = 7, 7
#: Tokens whose messages are passed at once.
GRAPH_TOKENS = 100_000

_ANY = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_RUN = re.compile(r"[A-Za-z0-9@._%+()-]*")
_DIGITS = re.compile("[^0-9]+")
_EMAIL_TOKEN = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_NUMBER = re.compile(r"[0-9+().-]+")
_GAP = re.compile(r"[ ().-]{1,3}")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def _is_ip(s: str) -> bool:
    parts = [x.lstrip("0") for x in s.split(".")]
    return all(len(x) <= 3 and int(x or "0") <= 255 for x in parts)


def _is_card(digits: str) -> bool:
    return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)


def candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, label, holds) of every match of the four patterns, leftmost and non-overlapping for each kind."""
    at = text.find("@")
    low = 0
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        low = found.end() if found else at + 1
        if found:
            yield start, low, EMAIL, True
        at = text.find("@", low)
    for m in _IP.finditer(text):
        yield m.start(), m.end(), IP, _is_ip(m.group())
    for m in _CARD.finditer(text):
        yield m.start(), m.end(), CARD, _is_card(_DIGITS.sub("", m.group()))
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), PHONE, PHONE_DIGITS[0] <= len(_DIGITS.sub("", m.group())) <= PHONE_DIGITS[1]


def token_spans(text: str) -> Iterator[tuple[int, int]]:
    """Runs of name and number characters that hold a digit or an @, without marks at their ends."""
    low = 0
    while m := _ANY.search(text, low):
        start = low + len(text[low:m.start()].rstrip(_LOCAL + "@()"))
        end = _RUN.match(text, m.end()).end()
        low = end
        core = text[start:end]
        while core:
            cut = core.lstrip("._%-)")
            start += len(core) - len(cut)
            core = cut.rstrip("._%-(+")
            if core[-1:] == ")" and "(" not in core:
                core = core[:-1]
            elif core[:1] == "(" and ")" not in core:
                start, core = start + 1, core[1:]
            elif core == cut:
                break
        if core:
            yield start, start + len(core)


def token_form(core: str) -> str:
    """What unary potentials see of a token: its kind of number or name, and its marks."""
    digits = _DIGITS.sub("", core)
    if "@" in core:
        return "email" if _EMAIL_TOKEN.fullmatch(core) else "at"
    if _DOTTED.fullmatch(core):
        return "ip" if _is_ip(core) else "dotted"
    if not _NUMBER.fullmatch(core):
        return "mixed"
    marks = "".join(c for c in "+(-." if c in core)
    n = len(digits)
    if CARD_DIGITS[0] <= n <= CARD_DIGITS[1]:
        return ("card" if luhn(digits) else "long") + marks
    return f"{'1-3' if n < 4 else '4-6' if n < 7 else '7-9' if n < 10 else '10-13' if n < 14 else '20-'}{marks}"


def likeness(core: str) -> str:
    """Tokens of a document with the same likeness are joined."""
    if "@" in core:
        return core.lower()
    digits = _DIGITS.sub("", core)
    if _DOTTED.fullmatch(core) or not _NUMBER.fullmatch(core) or len(digits) < ALIKE:
        return core
    return "#" + digits[-ALIKE:]


@dataclass
class Tokens:
    """A document's tokens and edges. ``label``: an observed kind, 0 for none, -1 inside a longer match that failed."""

    base: list[tuple[int, int, int]] = field(default_factory=list)
    span: list[tuple[int, int]] = field(default_factory=list)
    form: list[str] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    alike: list[tuple[int, int]] = field(default_factory=list)
    joined: list[tuple[int, int]] = field(default_factory=list)


def analysed(text: str) -> Tokens:
    """Base spans, tokens and edges; each token is joined to the last one like it, so edges grow with the text."""
    doc = Tokens()
    if not _ANY.search(text):
        return doc
    matches: list[list[tuple[int, int, int, bool]]] = [[] for _ in range(LABELS)]
    for c in candidates(text):
        matches[c[2]].append(c)
    doc.base = [c[:3] for own in matches for c in own if c[3]]
    last: dict[str, int] = {}
    first = [0] * LABELS  # matches of a kind don't overlap: those before this one end before the token
    for k, (start, end) in enumerate(token_spans(text)):
        core = text[start:end]
        label = 0
        for kind, own in enumerate(matches):
            while first[kind] < len(own) and own[first[kind]][1] <= start:
                first[kind] += 1
            at = first[kind]
            while at < len(own) and own[at][0] < end and label <= 0:
                a, b, _, holds = own[at]
                if holds:
                    label = kind
                elif b - a > end - start:
                    label = -1
                at += 1
        doc.span.append((start, end))
        doc.form.append(token_form(core))
        doc.label.append(label)
        key = likeness(core)
        if key in last:
            doc.alike.append((last[key], k))
        last[key] = k
        if k and _GAP.fullmatch(text, doc.span[k - 1][1], start):
            doc.joined.append((k - 1, k))
    return doc


@dataclass(frozen=True)
class Potentials:
    """Log potentials: of labels by token form, of agreeing neighbours, and of agreeing tokens that are alike."""

    unary: dict[str, np.ndarray]
    unseen: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def counted(docs: Iterable[str]) -> Counter:
    """What the potentials are learned from: labels by form, and agreement of joined labels."""
    total: Counter = Counter()
    for text in docs:
        doc = analysed(text)
        total.update(("form", f, y) for f, y in zip(doc.form, doc.label) if y >= 0)
        for name, pairs in (("chain", doc.joined), ("skip", doc.alike)):
            for a, b in pairs:
                y, z = doc.label[a], doc.label[b]
                if y > 0 and z > 0 if name == "chain" else y >= 0 and z >= 0 and (y or z):
                    total[name, "", int(y == z)] += 1
    return total


def learned(total: Counter) -> Potentials:
    """Potentials from counts; a form that was never met counts as none, the surer the more forms are known."""
    shares = np.full(LABELS, SMOOTH)
    forms: dict[str, np.ndarray] = {}
    for (name, form, y), n in total.items():
        if name == "form":
            shares[y] += n
            forms.setdefault(form, np.zeros(LABELS))[y] += n
    shares /= shares.sum()
    unary = {f: np.log((n + LABELS * SMOOTH * shares) / (n.sum() + LABELS * SMOOTH)) for f, n in forms.items()}
    unseen = np.full(LABELS, SMOOTH)
    unseen[0] += len(forms)
    odds = {name: np.log((total[name, "", 1] + SMOOTH) / (total[name, "", 0] + SMOOTH)) for name in ("chain", "skip")}
    chain = np.where(np.eye(LABELS, dtype=bool), max(odds["chain"], 0.0), 0.0)
    chain[0] = chain[:, 0] = 0.0  # only that two entities touch says something
    return Potentials(unary, np.log(unseen / unseen.sum()), chain, np.eye(LABELS) * max(odds["skip"], 0.0))


def marginals(unary: np.ndarray, u: np.ndarray, v: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log beliefs of nodes by loopy sum-product. Edge e joins u[e] and v[e] with log potentials pair[e][label of u, of v].

    Without loops and with enough rounds the beliefs are exact. Rounds are fixed,
    so a document's result does not depend on what is computed beside it.
    """
    ahead, back = np.zeros((len(u), unary.shape[1])), np.zeros((len(u), unary.shape[1]))
    belief = unary.copy()

    def passed(x: np.ndarray) -> np.ndarray:
        top = x.max(axis=1, keepdims=True)
        out = top[:, 0] + np.log(np.exp(x - top).sum(axis=1))
        return out - out.max(axis=1, keepdims=True)

    for _ in range(rounds if len(u) else 0):
        new_ahead = passed((belief[u] - back)[:, :, None] + pair)
        new_back = passed((belief[v] - ahead)[:, :, None] + pair.transpose(0, 2, 1))
        ahead, back = DAMPING * ahead + (1 - DAMPING) * new_ahead, DAMPING * back + (1 - DAMPING) * new_back
        belief = unary.copy()
        np.add.at(belief, v, ahead)
        np.add.at(belief, u, back)
    return belief


def token_labels(docs: list[Tokens], model: Potentials) -> list[np.ndarray]:
    """Most likely label of every token of every document."""
    ends = np.cumsum([0] + [len(d.span) for d in docs])
    unary = np.zeros((ends[-1], LABELS))
    u, v, pair = [], [], []
    for d, at in zip(docs, ends):
        for k, (form, y) in enumerate(zip(d.form, d.label)):
            unary[at + k] = model.unary.get(form, model.unseen)
            if y > 0:
                unary[at + k] -= OBSERVED
                unary[at + k, y] += 2 * OBSERVED
        for edges, table in ((d.joined, model.chain), (d.alike, model.skip)):
            u += [at + a for a, _ in edges]
            v += [at + b for _, b in edges]
            pair += [table] * len(edges)
    beliefs = marginals(unary, np.array(u, np.int64), np.array(v, np.int64), np.array(pair).reshape(-1, LABELS, LABELS))
    found = beliefs.argmax(axis=1)
    return [found[a:b] for a, b in zip(ends, ends[1:])]


def added_spans(text: str, doc: Tokens, found: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of labelled tokens that no base span touches.

    Touching tokens of a number make one span. A card must pass its check, an
    email and an ip be whole; a phone number begins with a plus, or ends like a
    phone number found elsewhere in the document.
    """
    known = {likeness(text[a:b]) for (a, b), y in zip(doc.span, doc.label) if y == PHONE}
    touching = {b for _, b in doc.joined}
    out, k = [], 0
    while k < len(found):
        label, first = int(found[k]), k
        k += 1
        if not label or doc.label[first] > 0:
            continue
        if label in (CARD, PHONE):
            while (k in touching and found[k] == label and doc.label[k] <= 0
                   and not (label == CARD and _is_card(_DIGITS.sub("", text[doc.span[first][0]:doc.span[k - 1][1]])))):
                k += 1
        start, end = doc.span[first][0], doc.span[k - 1][1]
        core = text[start:end]
        digits = _DIGITS.sub("", core)
        alike = any(likeness(text[a:b]) in known for a, b in doc.span[first:k])
        whole = {EMAIL: lambda: bool(_EMAIL_TOKEN.fullmatch(core)),
                 IP: lambda: bool(_DOTTED.fullmatch(core)) and _is_ip(core),
                 CARD: lambda: _is_card(digits),
                 PHONE: lambda: (core[0] == "+" and PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]
                                 or alike and SHORT_PHONE <= len(digits) <= PHONE_DIGITS[1])}[label]()
        if whole:
            out.append((start, end, label))
    taken = sorted(doc.base)
    free, at, reach = [], 0, 0
    for start, end, label in out:  # both ascending
        while at < len(taken) and taken[at][0] < end:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= start:
            free.append((start, end, label))
    return free


def listed(spans: Iterable[tuple[int, int, int]]) -> str:
    """kind:start:end by start, then kind as listed; code points, end exclusive."""
    return ",".join(f"{KINDS[y - 1]}:{a}:{b}" for a, b, y in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def learn(docs: DataFrame) -> Potentials:
    """Potentials from all documents; Spark adds the counts of forms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            total.update(counted(t.as_py() for t in batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
             pa.array([k[2] for k in total], pa.int32()), pa.array(total.values(), pa.int64())], names=["name", "form", "y", "n"])

    rows = (texts(docs).mapInArrow(run, "name string, form string, y int, n long")
            .groupBy("name", "form", "y").agg(F.sum("n").alias("n")).collect())  # forms are a few dozen
    return learned(Counter({(r["name"], r["form"], r["y"]): r["n"] for r in rows}))


def personal_data(docs: DataFrame, model: Potentials | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    Counts and base_sha256 are of the base spans, ``spans`` holds all. Without
    ``model``, potentials are learned from ``docs``. A null text is empty; a text
    without a digit or @ has no spans. Repeated rows and null ids each give a
    row. An empty table gives no rows. Other columns are not read.
    """
    model = model or learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = batch.column(1).to_pylist()
            rows: list[tuple] = []
            held: list[tuple[str, Tokens]] = []

            def labelled() -> None:
                for (text, doc), found in zip(held, token_labels([d for _, d in held], model)):
                    more = added_spans(text, doc, found)
                    kinds = [y for _, _, y in doc.base]
                    base = listed(doc.base)
                    rows.append((*(kinds.count(y) for y in range(1, LABELS)), hashlib.sha256(base.encode()).hexdigest(),
                                 listed([*doc.base, *more]), len(more)))
                held.clear()

            waiting = 0
            for text in read:
                held.append((text, analysed(text)))
                waiting += len(held[-1][1].span)
                if waiting > GRAPH_TOKENS:
                    labelled()
                    waiting = 0
            labelled()
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
