"""Personal data: fixed patterns, and a linear-chain conditional random field for the forms they miss.

The field labels every white-space token of a line by its shape and word, and
those of its neighbours. It is trained on a small table that TEMPLATES and a
fixed seed render, and decoded by Viterbi in numpy batches. Only tokens that can
be part of a best labelling go through Viterbi: where the best stretch around a
token that could be personal data scores less than the same stretch left out,
whatever stands beside it, the token is outside in every best labelling. What
remains are runs that advance together.

Spans are code points, end exclusive. A span of the field is dropped where it
meets a pattern's span. Defined results: a null text is empty and has no spans;
repeated rows each give a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern: the longest local part before an @, then a domain with a dot."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append((begin, found.end()))
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns, in order of start, then kind."""
    out = [(b, e, 0) for b, e in emails(text)] if "@" in text else []
    if any(d in text for d in "0123456789"):
        if text.count(".") > 2:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                    out.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# ------------------------------------------------------------------ the field

#: O, then begin and inside of each kind.
LABELS = 1 + 2 * len(KINDS)
#: Fixed training templates: {name} is filled in; text in << >> is of the kind named before the bar.
TEMPLATES = (
    "call <<phone|({d3}) {d3}-{d4}>> now", "tel. <<phone|{d3}-{d3}-{d4}>> or write", "phone: <<phone|{d3}.{d3}.{d4}>> today",
    "ring <<phone|00{d2} {d2} {d3} {d2} {d2}>> please", "mobile <<phone|(0{d2}) {d4} {d4}>>", "fax <<phone|({d3}) {d3}-{d4}>>, thanks",
    "mail <<email|{w}(at){w}.com>> soon", "write to <<email|{w}[at]{w}.org>> for", "<<email|{w}.{w}(at){w}.{w}.net>> answers",
    "<<email|{w}{d2}[at]{w}[dot]com>> is", "mail <<email|{w}(at){w}(dot)com>>", "send <<email|{w}.{d2}@{w}>> it",
    "host <<ip|{h4}:{h4}:{h4}:{h4}:{h4}:{h4}:{h4}:{h4}>> is down", "from <<ip|{h4}:{h4}::{h4}>> on",
    "card <<card|{d4}.{d4}.{d4}.{d4}>> expires", "paid by <<card|{d4}/{d4}/{d4}/{d4}>> ok", "number <<card|{d4}_{d4}_{d4}_{d4}>>",
    "of <<phone|+{d1} ({d3}) {d3}-{d4}>> <<card|{d16}>> and", "de <<phone|+{d1} ({d3}) {d3}-{d4}>> in", "<<card|{d16}>> <<phone|+{d1} ({d3}) {d3}-{d4}>> {w}",
    "by <<card|{d16}>> <<ip|{o}.{o}.{o}.{o}>> {w}", "<<ip|{o}.{o}.{o}.{o}>> <<card|{d16}>>", "to <<email|{w}.{d2}@{w}{d1}.{w}.com>> <<ip|{o}.{o}.{o}.{o}>>",
    "<<phone|+{d1} ({d3}) {d3}-{d4}>> <<ip|{o}.{o}.{o}.{o}>> {w}", "<<phone|+{d1} ({d3}) {d3}-{d4}>> <<email|{w}.{d2}@{w}{d1}.{w}.com>>",
    "<<phone|+{d1} ({d3}) {d3}-{d4}>> <<card|{d16}>> <<ip|{o}.{o}.{o}.{o}>> {w}", "<<card|{d16}>> <<card|{d16}>>", "<<phone|+{d1} ({d3}) {d3}-{d4}>> <<phone|+{d1} ({d3}) {d3}-{d4}>>",
    "paid <<card|{d4} {d4} {d4} {d4}>> <<phone|+{d1} ({d3}) {d3}-{d4}>>", "paid <<card|{d4}-{d4}-{d4}-{d4}>> <<ip|{o}.{o}.{o}.{o}>>", "at <<ip|{o}.{o}.{o}.{o}>>, {w}", "no <<card|{d16}>>. {w}",
    "version {d1}.{d1} of {w}", "version {d1}.", "since {y} and {y}", "in {y}-0{d1}-{d2} at {d2}:{d2}", "price {d3}.{d2} each", "{d1},{d3},{d3} people",
    "token = \"{h4}{h4}{h4}{h4}{h4}{h4}{h4}{h4}{h4}{h4}\"", "password={h4}{h4}{h4}{h4}{h2}", "key AKIA{A4}{A4}{A4}{A4} of", "chapter {d2} page {d3}",
    "(see {d2})", "[{d1}] {w}", "{w} ({y}) {w}", "C++ and +{d1} more", "#{d4} {w}", "{d2}%%% {w}", "@{w} said", "{d4} items", "id {d4}{d4} of {d4}", "{w} @ {d2} each",
    "{w}{d2} x{d1}", "room {d3}-{d2}", "about {d2}/{d2}/{y} it", "({w})", "[{w}]", "10.{d1} and 4.0.", "{d3} {d3} {d2}", "{d4}-{d4}", "{d1}.{d1}.{d2} build", "({d1}) {w} ({d1})",
    "mail <<email|{w} at {w} dot com>> for", "{w} <<email|{w} at {w} dot org>>, {w}", "write to <<email|{w} dot {w} at {w} dot net>> soon", "{w} <<email|{w} at {w} dot {w} dot com>> {w}",
    "{w} {w} {w} {w} {w}", "{w} at {w} and {w}", "the {w} at the {w}", "{w} dot {w}", "at {w}, dot", "{w} to {w} for {w}", "now {w} or {w}", "the {w} com {w}", "{w} is on {w}",
)
COPIES, EPOCHS, RATE, DECAY = 12, 120, 0.1, 1e-4


def training_table(seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The labelled token lists: every template COPIES times with random fillings."""
    rng = np.random.default_rng(seed)

    def pick(alphabet: str, n: int) -> str:
        return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), n))

    def fill(m: re.Match) -> str:
        kind, n = m[1][0], int(m[1][1:] or 0)
        if kind == "w":
            return pick("abcdefghijklmnopqrstuvwxyz", int(rng.integers(3, 10)))
        if kind == "o":
            return str(rng.integers(1, 255))
        if kind == "y":
            return str(rng.integers(1900, 2031))
        return pick({"d": "0123456789", "h": "0123456789abcdef", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"}[kind], n)

    rows = []
    for _ in range(COPIES):
        for template in TEMPLATES:
            words, labels = [], []
            for part in re.split(r"(<<.*?>>)", template):
                kind, body = part[2:-2].split("|") if part.startswith("<<") else ("", part)
                for k, word in enumerate(re.sub(r"\{(\w\d*)\}", fill, body).split()):
                    if kind == "" and labels and labels[-1] and len(word) == 1 and word in ",.;":
                        words[-1] += word
                        continue
                    words.append(word)
                    labels.append(1 + 2 * KINDS.index(kind) + (k > 0) if kind else 0)
            rows.append((words, labels))
    return rows


_SHAPE = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "9" for c in "0123456789"}})
_RUNS = re.compile(r"(a+|A+|9+)")
_OPEN = frozenset("0123456789@+([")


#: The neighbours at the ends of a line.
FIRST, LAST = "<s>", "</s>"


def open_token(word: str) -> bool:
    """Whether a token is told by its shape, not by its word, to its neighbours."""
    return not _OPEN.isdisjoint(word)


def shape(word: str) -> str:
    """Letters and digits by kind; digit runs keep their length up to 5, letter runs become one."""
    if len(word) > 80:
        return "long"
    flat = word.rstrip(",;:.!?").translate(_SHAPE)
    return _RUNS.sub(lambda m: m[0][0] + (str(min(len(m[0]), 5)) if m[0][0] == "9" else ""), flat)


def _plain(word: str) -> str:
    return word.lower().strip(".,:;")[:12]


def own_features(word: str) -> tuple[str, ...]:
    s = shape(word)
    n = sum(c.isdigit() for c in word)
    marks = "".join(sorted({c for c in s if not c.isalnum()}))
    return "s=" + s, f"n={min(n, 20)}", "m=" + marks, f"l={min(len(word), 45) // 5}", "w=" + ("" if open_token(word) else _plain(word))


def beside(word: str) -> tuple[str, str]:
    """What a token's neighbour tells of it: the kind of neighbour, and its shape or word."""
    return (shape(word),) * 2 if open_token(word) else ("w", _plain(word))


def paired(s: str, before: tuple[str, str], after: tuple[str, str]) -> tuple[str, ...]:
    return "b=" + before[0], "a=" + after[0], f"sb={s}|{before[1]}", f"sa={s}|{after[1]}"


def observations(words: list[str], k: int) -> tuple[str, ...]:
    """The features of a token: its own shape, form and word, and its neighbours'."""
    before = beside(words[k - 1] if k else FIRST)
    after = beside(words[k + 1] if k + 1 < len(words) else LAST)
    return own_features(words[k]) + paired(shape(words[k]), before, after)


class Field:
    """Weights by feature and label, and between labels; label 0 stands at both ends of a run."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.names, self.weights, self.steps = names, weights, steps

    def decode(self, runs: list[list[tuple[str, ...]]]) -> list[list[int]]:
        """The best labels of each run."""
        known = self.names.get
        rows = np.array([self.weights[[known(x, 0) for x in token]].sum(axis=0) for run in runs for token in run]).reshape(-1, LABELS)
        length = np.array([len(run) for run in runs], np.int64)
        begin, order, out = np.cumsum(length) - length, np.argsort(-length, kind="stable"), np.zeros(len(rows), np.int8)
        self.best_of_runs(rows, np.arange(len(rows)), begin[order], length[order], out)
        return [x.tolist() for x in np.split(out, np.cumsum(length)[:-1])]

    def best_of_runs(self, rows: np.ndarray, row: np.ndarray, begin: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
        """Viterbi over runs of any lengths, the longest first, that begin at places of row; labels go to out."""
        if not len(begin):
            return
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")
        best, back = rows[row[begin]] + self.steps[0], []
        for t in range(1, length[0]):
            m = active[t]
            options = best[:m, :, None] + self.steps
            back.append(options.argmax(axis=1).astype(np.int8))
            best[:m] = options.max(axis=1) + rows[row[begin[:m] + t]]
        label = (best + self.steps[:, 0]).argmax(axis=1)
        for t in range(length[0] - 1, -1, -1):
            m = active[t]
            out[begin[:m] + t] = label[:m]
            if t:
                label[:m] = back[t - 1][np.arange(m), label[:m]]

    def margins(self) -> tuple[float, float]:
        """What steps can add, against steps between outside labels, to each token of a span, and once at its ends."""
        starts = [0, *range(1, LABELS, 2)]
        inside = max(self.steps[a, b] for b in range(2, LABELS, 2) for a in (b - 1, b)) - self.steps[0, 0]
        enter = (self.steps[:, starts[1:]] - self.steps[:, :1]).max()
        leave = (self.steps[1:][:, starts] - self.steps[0, starts]).max()
        return float(max(inside, 0.0)), float(max(enter + leave, enter + leave - inside))


def _allowed() -> np.ndarray:
    """Steps between labels: an inside follows its own kind only."""
    steps = np.zeros((LABELS, LABELS))
    for inside in range(2, LABELS, 2):
        steps[:, inside] = -1e4
        steps[[inside - 1, inside], inside] = 0
    return steps


@lru_cache(maxsize=1)
def trained() -> Field:
    """Maximum likelihood with weight decay, by full-batch Adam; deterministic, on the driver, in seconds."""
    samples = []
    for words, labels in training_table():
        samples.append(([observations(words, k) for k in range(len(words))], labels))
    names: dict[str, int] = {}
    counts: dict[str, int] = defaultdict(int)
    for tokens, _ in samples:
        for token in tokens:
            for x in token:
                counts[x] += 1
    for x, n in counts.items():
        if n > 1:
            names[x] = len(names) + 1
    fixed = _allowed()
    theta = [np.zeros((len(names) + 1, LABELS)), np.zeros((LABELS, LABELS))]
    groups = defaultdict(list)
    for sample in samples:
        groups[len(sample[1])].append(sample)
    batches = [
        (np.array([[[names.get(x, 0) for x in t] for t in tokens] for tokens, _ in group]), np.array([y for _, y in group]))
        for group in groups.values()
    ]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for epoch in range(1, EPOCHS + 1):
        gradient = [DECAY * len(samples) * x for x in theta]
        for index, y in batches:
            _gradient(theta[0], theta[1] + fixed, index, y, gradient)
        for k in range(2):
            g = gradient[k] / len(samples)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            theta[k] -= RATE * (m[k] / (1 - 0.9**epoch)) / (np.sqrt(v[k] / (1 - 0.99**epoch)) + 1e-8)
            if k == 0:
                theta[0][0] = 0
    return Field(names, theta[0], theta[1] + fixed)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(weights: np.ndarray, steps: np.ndarray, index: np.ndarray, y: np.ndarray, out: list) -> None:
    """Adds expected minus observed feature counts of a batch of runs of one length."""
    n, length = y.shape
    emit = weights[index].sum(axis=2)
    ahead, behind = [emit[:, 0] + steps[0]], [np.broadcast_to(steps[:, 0], (n, LABELS))]
    for t in range(1, length):
        ahead.append(_log_sum(ahead[-1][:, :, None] + steps[None], 1) + emit[:, t])
        behind.append(_log_sum(steps[None] + (emit[:, length - t] + behind[-1])[:, None, :], 2))
    behind = behind[::-1]
    total = _log_sum(ahead[-1] + steps[:, 0], 1)
    for t in range(length):
        p = np.exp(ahead[t] + behind[t] - total[:, None])
        p[np.arange(n), y[:, t]] -= 1
        np.add.at(out[0], index[:, t].reshape(-1), np.repeat(p, index.shape[2], axis=0))
        if t:
            pair = np.exp(ahead[t - 1][:, :, None] + steps[None] + (emit[:, t] + behind[t])[:, None, :] - total[:, None, None]).sum(axis=0)
            np.subtract.at(pair, (y[:, t - 1], y[:, t]), 1)
            out[1] += pair
    first = np.exp(ahead[0] + behind[0] - total[:, None]).sum(axis=0)
    np.subtract.at(first, y[:, 0], 1)
    out[1][0] += first
    last = np.exp(ahead[-1] + np.broadcast_to(steps[:, 0], (n, LABELS)) - total[:, None]).sum(axis=0)
    np.subtract.at(last, y[:, -1], 1)
    out[1][:, 0] += last


_LINE, _WORD = re.compile(r"[^\n]+"), re.compile(r"\S+")
_AT, _SPELLED = re.compile(r"@|[(\[]at[)\]]", re.IGNORECASE), re.compile(r"\w+(?:\s+dot\s+\w+)*\s+at\s+\w+(?:\s+dot\s+\w+)+", re.IGNORECASE)
_COLONS = re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}")
#: Tokens that are labelled together, and words whose features are remembered.
PIECE, REMEMBERED = 1 << 18, 1 << 18


def fits(found: str, kind: int) -> bool:
    """Whether what the field found can be of its kind.

    A card number passes Luhn's check, a phone number has 7 to 15 digits, a mail
    address has a sign for @ or is spelled out with at and dot, an IP address has digits or groups between colons.
    """
    digits = "".join(c for c in found if "0" <= c <= "9")
    if KINDS[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if KINDS[kind] == "phone":
        return 7 <= len(digits) <= 15
    return bool(_AT.search(found) or _SPELLED.fullmatch(found)) if KINDS[kind] == "email" else bool(digits) or _COLONS.fullmatch(found) is not None


class Reader:
    """A field with the scores of the words and neighbours met so far.

    A feature that training never met weighs nothing, so words that differ only in such features share their scores.
    """

    def __init__(self, field: Field):
        self.field = field
        self.per_token, self.per_span = field.margins()
        self.shapes = {x[3:].split("|", 1)[0] for x in field.names if x[:3] in ("sb=", "sa=")}
        self.sides = [{x.split("|", 1)[1] for x in field.names if x[:3] == name} for name in ("sb=", "sa=")]
        self.lexicon = set().union(*self.sides, (x[2:] for x in field.names if x[:2] == "w="))
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.usual: dict[tuple, tuple] = {}
        self.seen: tuple[dict, dict, dict] = ({}, {}, {})
        self.numbers = np.zeros((0, 3), np.int64)
        self.fresh: list[tuple[int, int, int]] = []
        self.ends = [self.word(w) for w in (FIRST, LAST)]

    def word(self, word: str) -> int:
        """The number of a word; its own, left and right features have numbers of their own."""
        at = self.words[word] = len(self.words)
        core = word.rstrip(",;:.!?")
        # most words: ASCII letters in lower case or with one capital, and none that training knows
        if core.isascii() and core.isalpha() and (core.islower() or core.istitle()) and len(word) <= 80 and _plain(word) not in self.lexicon:
            key = (core.islower(), len(core) > 1, min(len(word), 45) // 5)
            if key not in self.usual:
                self.usual[key] = self.told(word)
            self.fresh.append(self.usual[key])
        else:
            self.fresh.append(self.told(word))
        return at

    def told(self, word: str) -> tuple[int, ...]:
        known, s = self.field.names.get, shape(word)
        side, told = beside(word)
        of = ((s if s in self.shapes else None, tuple(known(x, 0) for x in own_features(word))), *((known(f"{c}={side}", 0), told if told in t else None) for c, t in zip("ba", self.sides)))
        return tuple(seen.setdefault(x, len(seen)) for seen, x in zip(self.seen, of))

    def scores(self, words: list[str], firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, row of each token): scores by label of the tokens of lines that begin at firsts."""
        if len(self.words) > REMEMBERED:
            self.forget()
        for w in set(words).difference(self.words):
            self.word(w)
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if self.fresh:
            self.numbers = np.concatenate([self.numbers, np.array(self.fresh, np.int64)])
            self.fresh = []
        own, left, right = self.numbers.T
        before, after = np.empty_like(at), np.empty_like(at)
        before[1:], after[:-1] = left[at[:-1]], right[at[1:]]
        before[firsts], after[np.append(firsts[1:], len(at)) - 1] = left[self.ends[0]], right[self.ends[1]]
        n_left, n_right = len(self.seen[1]), len(self.seen[2])
        kinds, row = np.unique((own[at] * n_left + before) * n_right + after, return_inverse=True)
        forms = [list(x) for x in self.seen]
        known, weights, rows = self.field.names.get, self.field.weights, np.empty((len(kinds), LABELS))
        for k, kind in enumerate(kinds.tolist()):
            s, index = forms[0][kind // n_right // n_left]
            (b, b_told), (a, a_told) = forms[1][kind // n_right % n_left], forms[2][kind % n_right]
            index = [*index, b, a]
            if s is not None:
                index += [known(f"sb={s}|{b_told}", 0) if b_told is not None else 0, known(f"sa={s}|{a_told}", 0) if a_told is not None else 0]
            rows[k] = weights[index].sum(axis=0)
        return rows, row

    def labels(self, words: list[str], firsts: np.ndarray) -> np.ndarray:
        """The label of every token of lines that begin at firsts."""
        rows, row = self.scores(words, firsts)
        gain = (rows[:, 1:].max(axis=1) - rows[:, 0] + self.per_token)[row]
        total = np.cumsum(gain)
        until = total - np.minimum.accumulate(np.concatenate(([0.0], total[:-1])))
        since = np.maximum.accumulate(total[::-1])[::-1] - total + gain
        may = until + since - gain + self.per_span >= -1e-6
        edge = np.zeros(len(row) + 1, bool)
        edge[firsts] = True
        begin = np.flatnonzero(may & (np.concatenate(([True], ~may[:-1])) | edge[:-1]))
        end = np.flatnonzero(may & (np.concatenate((~may[1:], [True])) | edge[1:])) + 1
        out = np.zeros(len(row), np.int8)
        long_first = np.argsort(begin - end, kind="stable")
        self.field.best_of_runs(rows, row, begin[long_first], (end - begin)[long_first], out)
        return out


def field_spans(texts: list[str], field: Field | Reader) -> list[list[tuple[int, int, int]]]:
    """(start, end, kind number) that the field finds in each text, trimmed of punctuation at the ends."""
    reader = field if isinstance(field, Reader) else Reader(field)
    out: list = [[] for _ in texts]
    words: list[str] = []
    owners: list[int] = []
    starts: list[int] = []
    firsts: list[int] = []

    def flush() -> None:
        labels = reader.labels(words, np.array(firsts)) if words else np.zeros(0, np.int8)
        for at in np.flatnonzero(labels % 2).tolist():
            stop = at + 1
            while stop < len(labels) and labels[stop] and labels[stop] % 2 == 0:
                stop += 1
            text, kind, b, e = texts[owners[at]], int(labels[at]) // 2, starts[at], starts[stop - 1] + len(words[stop - 1])
            while e > b and not text[e - 1].isalnum():
                e -= 1
            while b < e and not text[b].isalnum() and text[b] not in "+(":
                b += 1
            if fits(text[b:e], kind):
                out[owners[at]].append((b, e, kind))
        for x in (words, owners, starts, firsts):
            x.clear()

    for k, text in enumerate(texts):
        for line in _LINE.finditer(text):
            n = len(words)
            for w in _WORD.finditer(text, line.start(), line.end()):
                words.append(w[0])
                starts.append(w.start())
            if len(words) > n:
                firsts.append(n)
                owners.extend([k] * (len(words) - n))
            if len(words) >= PIECE:
                flush()
    flush()
    return [sorted(x) for x in out]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, e, k in spans)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): counts and base of the patterns, spans of both."""
    field = trained()
    sent = docs.sparkSession.sparkContext.broadcast((field.names, field.weights, field.steps))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Reader(Field(*sent.value))
        for part in parts:
            rows = []
            texts = part["text"].tolist()
            for doc_id, base, more in zip(part["doc_id"], map(base_spans, texts), field_spans(texts, own)):
                free = [s for s in more if s[0] < s[1] and all(s[1] <= b or e <= s[0] for b, e, _ in base)]
                counts = np.bincount([k for _, _, k in base], minlength=4)
                rows.append((doc_id, *map(int, counts), written(base), written(sorted(base + free, key=lambda s: (s[0], s[2])))))
            yield pd.DataFrame(rows, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"
    return shared.mapped(shared.whole_text(docs, "doc_id"), run, schema)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op10_pii(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
