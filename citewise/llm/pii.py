"""Personal data: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find emails, IP addresses, payment cards and phone numbers exactly as
documented at base_spans. The field labels the tokens (pieces between white space) of
each line from word-shape features of a token and its neighbours. It is trained by
gradient ascent on a small labelled table and decoded by Viterbi, all lines of a chunk
side by side in numpy. Labelled runs that keep the bounds of their kind and overlap no
pattern span are added; pattern spans stay.

Positions are code points, ends exclusive. Defined results: a NULL or empty text has no
spans. Of overlapping spans the pattern's stays; of the field's, the first in the text. A
text of any length is searched whole, line by line; shapes of tokens are cut at 64
characters as features, the spans are not. Rows that repeat are searched each. Other
columns and empty tables pass. A field without training labels nothing.
"""

from __future__ import annotations

import hashlib
import re
import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import TokenTable, code_points, map_texts, new_name
from .pretokens import LETTER, classes

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
Span = tuple[int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> list[Span]:
    """Looks left and right of each @, so that long runs are read once."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > after and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                after = domain.end()
        at = text.find("@", max(at + 1, after))
    return out


def ips(text: str) -> list[Span]:
    """Four parts at a time of each chain of digits and dots."""
    out = []
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        edge = m.start()
        for i in range(0, len(parts) - 3, 4):
            own = ".".join(parts[i : i + 4])
            if is_ip(own):
                out.append((edge, edge + len(own)))
            edge += len(own) + 1
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped."""
    return {
        "email": emails(text),
        "ip": ips(text),
        "card": [m.span() for m in _CARD.finditer(text) if is_card(m[0])],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15] if "+" in text else [],
    }


def written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


# --- the field ---------------------------------------------------------------------------


def shapes() -> np.ndarray:
    """Every code point as a letter (x), a digit (9), or itself."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    table[classes() == LETTER] = ord("x")
    table[ord("0") : ord("9") + 1] = ord("9")
    return table


def shaped(text: str, table: np.ndarray) -> str:
    return table[code_points(text)].tobytes().decode("utf-32-le", "surrogatepass")


def once(shape: str) -> str:
    """Runs of one character as one."""
    return re.sub(r"(.)\1+", r"\1", shape)


def token_features(shape: str) -> list[str]:
    """Features of a token, given as its shape."""
    digits = shape.count("9")
    core = shape.strip(".,;:!?()[]<>{}\"'#$%&*")
    held = re.sub(r"(.)\1{4,}", r"\1\1\1\1+", core)[:24]
    return [
        f"short={once(shape[:64])[:16]}",
        f"shape={held}",
        f"core={once(core[:64])[:16]}",
        f"digits={digits if digits < 8 else 8 + digits // 4}",
        f"marks={''.join(sorted(set(re.findall(r'[@+().:$%=/-]', shape))))}",
        f"plain={not shape.strip('.,;:!?').strip('x')}",
    ]


@dataclass
class Field:
    """Weights: own, previous and next token's features by label; transitions."""

    index: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    move: np.ndarray

    def scores(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What tokens say of themselves, of their successor and of their predecessor."""
        cells = [(i, self.index[f]) for i, t in enumerate(tokens) for f in token_features(t) if f in self.index]
        rows, columns = np.array(cells, np.int64).reshape(-1, 2).T
        out = []
        for w in (self.own, self.before, self.after):
            s = np.zeros((len(tokens), len(LABELS)))
            np.add.at(s, rows, w[columns])
            out.append(s)
        return tuple(out)


def labelled_examples(n: int = 800, seed: int = 5) -> list[list[tuple[str, str]]]:
    """A small labelled table, by rule: lines of words as they stand in running text, most
    with one item, either personal data in a usual form or something that only resembles
    it (dates, prices, versions, identifiers, references)."""
    r = np.random.default_rng(seed)
    pick = lambda *x: x[r.integers(len(x))]
    d = lambda k: "".join(str(x) for x in r.integers(0, 10, k))
    stem = lambda: "".join(pick("ba", "ter", "in", "so", "li", "und", "é", "ña", "st", "on") for _ in range(r.integers(1, 5)))
    plain = lambda: stem().encode("ascii", "ignore").decode() or "x"
    tail = lambda: pick("", "", "", "", ".", ",", ";", ")", "!!", "$$$", "***")

    def word() -> str:
        """A word of running text, with what may stand around it."""
        w = stem()
        shape = r.integers(0, 40)
        if shape < 5:
            return w + pick(".", ",", ";", ":", "!", "?", "...")
        if shape < 12:
            return pick(
                f"({w})", f"({w}", f"{w})", f'"{w}"', f"'{w}", f"{w}-{stem()}", f"{w}/{stem()}", f"{w}'s", f"{w}.{stem()}",
                f"{w}{pick('#', '%', '$', '&', '*') * r.integers(1, 5)}", "-", "--", "|", "=", "+", f"+{w}", f"{w}+", f"@{w}", f"#{w}",
                f"<{w}>", f"{w}_{stem()}", f"{w}({stem()})", f"{w}[{d(1)}]", "x.x.", f"{w}.{pick('py', 'html', 'txt')}", f"{w}:{stem()}",
                "@", f"{w}@", "(+)", f"[{w}]", "&", "*", f"{w}{d(1)}", f"{w}.,", f"{w}.)",
            )
        if shape < 15:
            return pick(d(1), d(2), d(3), d(4), f"{d(1)}.", f"{d(2)}%", f"{d(1)},{d(3)}", f"{d(2)}.{d(2)}", f"{d(2)}th", f"({d(2)})", f"[{d(2)}]")
        return w

    e = lambda: f"{plain()}{pick('.', '_', '', '-')}{plain()}{pick('', d(2))}@{plain()}{pick('', d(1))}.{pick('com', 'example.org', 'net', 'co.uk')}"
    quad = lambda: ".".join(str(r.integers(0, pick(10, 100, 256))) for _ in range(4))
    out = []
    for i in range(n):
        area, line = d(3), f"{d(3)}-{d(4)}"
        at = pick("(at)", "[at]", " [at] ")
        far = [f"{plain()}{pick('.', '')}{plain()}{at}{plain()}.{pick('com', 'org')}{tail()}"]
        kind, items = [
            ("email", [e() + tail()]),
            ("email", pick([pick(f"<{e()}>", f"({e()})", f"mailto:{e()}", f'"{e()}"')], far, far)),
            ("ip", [pick("", "(", "") + quad() + tail()]),
            ("card", pick([d(16) + tail()], [d(16) + tail()], [d(16)], [d(4), d(4), d(4), d(4) + tail()], ["-".join(d(4) for _ in range(4)) + tail()], ["-".join(d(4) for _ in range(4)) + tail()], [d(4), d(6), d(5) + tail()], [d(15) + tail()])),
            ("phone", pick([f"+{d(1)}", f"({area})", line + tail()], [f"+{d(2)}", d(3), d(7) + tail()], [f"+{d(r.integers(9, 15))}" + tail()], [f"+{d(12)}" + tail()], [f"+{d(2)}", d(2), d(4), d(4) + tail()], [f"+{d(1)}-{area}-{line}{tail()}"])),
            ("phone", pick([f"({area})", line + tail()], [f"{area}-{line}{tail()}"], [f"({area}){line}{tail()}"], [f"{area}.{d(3)}.{d(4)}{tail()}"])),
            ("other", pick([d(4)], [f"{d(2)}.{d(1)}"], [f"{d(1)},{d(3)},{d(3)}"], [f"{d(2)}:{d(2)}:{d(2)}"], [f"v{d(1)}.{d(1)}.{d(1)}"], [f"{d(1)}.{d(1)}.{d(1)}"], [f"{d(4)}-{d(4)}"], [f"http://{plain()}.{plain()}.org/{d(3)}"], [f"https://{plain()}.com/{plain()}?{plain()}={d(2)}"])),
            ("other", pick([f"{d(4)}-{d(2)}-{d(2)}"], ["token", "=", f'"{r.bytes(12).hex()}"'], [f"password={r.bytes(8).hex()}"], [f"${d(3)}.{d(2)}"], ["|"], [d(9)], [f"{r.bytes(4).hex()}-{r.bytes(2).hex()}-{r.bytes(6).hex()}"], [f"{d(2)}/{d(2)}/{d(4)}"], [f"{d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}"], [d(5), d(4), d(3)], ["function", f"{plain()}({plain()},", f"{plain()})", "{"], [f"{plain()}@{plain()}"], [f"{d(1)}.{d(1)}.{d(1)}.{d(1)}.{d(1)}"])),
        ][i % 8]
        items = [t for item in items for t in item.split(" ")]
        left, right = ([word() for _ in range(r.integers(0, 7))] for _ in range(2))
        out.append([(t, "other") for t in left] + [(t, kind) for t in items] + [(t, "other") for t in right])
        if i % 4 == 0:
            out.append([(word(), "other") for _ in range(r.integers(3, 14))])
    return out


def train(sentences: list[list[tuple[str, str]]], steps: int = 120, rate: float = 0.15, l2: float = 1e-3) -> Field:
    """Maximum likelihood by adaptive gradient steps, with forward-backward sums."""
    sentences = [s for s in sentences if s]
    if not sentences:
        none = np.zeros((0, len(LABELS)))
        return Field({}, none, none, none, np.zeros((len(LABELS), len(LABELS))))
    table = shapes()
    names = sorted({f for s in sentences for t, _ in s for f in token_features(shaped(t, table))})
    index = {f: i for i, f in enumerate(names)}
    size, n, width = len(LABELS), len(sentences), max(map(len, sentences), default=1)
    x = np.zeros((n, width, len(names)), np.float32)
    gold, mask = np.zeros((n, width), np.int64), np.zeros((n, width), bool)
    for i, s in enumerate(sentences):
        for t, (token, label) in enumerate(s):
            x[i, t, [index[f] for f in token_features(shaped(token, table))]] = 1
            gold[i, t], mask[i, t] = LABELS.index(label), True
    shift = lambda a, k: np.concatenate([np.zeros_like(a[:, :1]), a[:, :-1]] if k > 0 else [a[:, 1:], np.zeros_like(a[:, :1])], 1)
    seen = np.concatenate([x, shift(x, 1), shift(x, -1)], 2)
    w, move = np.zeros((3 * len(names), size), np.float32), np.zeros((size, size))
    squares = [np.full_like(w, 1e-8), np.full_like(move, 1e-8)]
    onehot = np.eye(size)[gold] * mask[:, :, None]
    for _ in range(steps):
        emit = seen @ w
        forward, backward = np.zeros((n, width, size)), np.zeros((n, width, size))
        forward[:, 0] = emit[:, 0]
        add = lambda a, axis: np.log(np.exp(a - a.max(axis, keepdims=True)).sum(axis)) + a.max(axis)
        for t in range(1, width):
            step = add(forward[:, t - 1, :, None] + move, 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = add(move + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        whole = add(forward[:, -1], 1)
        one = np.exp(forward + backward - whole[:, None, None]) * mask[:, :, None]
        two = np.exp(forward[:, :-1, :, None] + move + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]) * mask[:, 1:, None, None]
        g_w = np.tensordot(seen, (onehot - one).astype(np.float32), ([0, 1], [0, 1])) / n - l2 * w
        g_m = (np.einsum("nta,ntb->ab", onehot[:, :-1], onehot[:, 1:]) - two.sum((0, 1))) / n - l2 * move
        for value, g, sq in ((w, g_w, squares[0]), (move, g_m, squares[1])):
            sq += g * g
            value += rate * g / np.sqrt(sq)
    k = len(names)
    return Field(index, w[:k], w[k : 2 * k], w[2 * k :], move)


def viterbi(emit: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels of consecutive lines of tokens, of the given sizes, side by side."""
    out = np.zeros(len(emit), np.int64)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    live = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), "right")
    best, back = None, []
    ends: list[np.ndarray] = []
    for t, n in enumerate(live.tolist()):
        if t:
            ends.append(best[n:])
            paths = best[:n, :, None] + move
            back.append(paths.argmax(1).astype(np.int8))
            best = paths.max(1) + emit[start[:n] + t]
        else:
            best = emit[start[:n]].copy()
    if best is None:
        return out
    ends.append(best)
    label = np.zeros(0, np.int64)
    for t in range(len(live) - 1, -1, -1):
        # Lines that end here begin their way back; they come after the longer ones.
        own = ends[t].argmax(1)
        label = np.concatenate([label, own])
        out[start[: live[t]] + t] = label
        if t:
            label = back[t - 1][np.arange(live[t]), label].astype(np.int64)
    return out


_EDGE = ".,;:!?<>\"'[]{}|"


def valid(kind: str, text: str) -> bool:
    """The bounds that a labelled run must keep: how many digits, of which size, and the
    checksum of cards. Its form is the field's matter."""
    digits = len(digits_of(text))
    if kind == "ip":
        parts = re.split(r"[^0-9]+", text.strip(_EDGE + "()"))
        return len(parts) == 4 and all(p and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= digits <= 19 and luhn(digits_of(text))
    return 7 <= digits <= 15 if kind == "phone" else 5 <= len(text) <= 254


class Finder:
    """Spans of whole texts: those of the patterns, and those the field adds."""

    def __init__(self, field: Field):
        self.field = field
        self.shapes = shapes()
        self.table = TokenTable(field.scores, 200_000)

    def __call__(self, texts: list[str | None]) -> list[tuple[dict, dict]]:
        texts = [t or "" for t in texts]
        whole = "\n".join(texts)
        base = [base_spans(t) for t in texts]
        found = [{k: list(v) for k, v in b.items()} for b in base]
        starts, ends, line = self.cut(whole)
        if len(starts):
            seen = shaped(whole, self.shapes)
            rows = self.table.rows([seen[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
            own, before, after = self.table.values
            emit = own[rows]
            joined = line[1:] == line[:-1]
            emit[1:][joined] += before[rows[:-1]][joined]
            emit[:-1][joined] += after[rows[1:]][joined]
            label = viterbi(emit, np.unique(line, return_counts=True)[1], self.field.move)
            at = np.cumsum([0, *(len(t) + 1 for t in texts)])
            for kind, a, b in self.runs(label, starts, ends, line):
                while a < b and whole[a] in _EDGE:
                    a += 1
                while b > a and whole[b - 1] in _EDGE:
                    b -= 1
                i = int(np.searchsorted(at, a, "right")) - 1
                a, b = a - int(at[i]), b - int(at[i])
                taken = any(a < y and x < b for spans in found[i].values() for x, y in spans)
                if a < b and not taken and valid(kind, texts[i][a:b]):
                    found[i][kind].append((a, b))
        return list(zip(base, found))

    @staticmethod
    def cut(whole: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and line numbers of the tokens."""
        points = code_points(whole)
        white = (points <= 32) | (points == 0xA0) | (points == 0x3000)
        edge = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        return starts, ends, np.cumsum(points == 10)[starts] if len(starts) else starts

    @staticmethod
    def runs(label, starts, ends, line):
        marked = np.flatnonzero(label)
        if not len(marked):
            return
        new = np.concatenate([[True], (np.diff(marked) > 1) | (label[marked[1:]] != label[marked[:-1]]) | (line[marked[1:]] != line[marked[:-1]])])
        first = marked[new]
        last = marked[np.concatenate([new[1:], [True]])]
        for i, j in zip(first.tolist(), last.tolist()):
            yield LABELS[label[i]], int(starts[i]), int(ends[j])


def find(docs: DataFrame, field: Field, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """The id columns, counts and digest of the pattern spans, and all spans."""

    def make():
        finder = Finder(field)

        def work(texts):
            found = finder(texts)
            out = {f"n_{k}": [len(base[k]) for base, _ in found] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            out["spans"] = [written(spans) for _, spans in found]
            return out

        return work

    added = "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string"
    return map_texts(docs, id_cols, text_col, make, added)


def merged(spans: dict[str, list[Span]]) -> list[tuple[int, int, str]]:
    """Spans in order; overlapping ones become one, under the first one's kind."""
    out: list[tuple[int, int, str]] = []
    for a, b, kind in sorted((a, b, k) for k in KINDS for a, b in spans[k]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, kind))
    return out


def redact(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """docs with every span of the text replaced by its kind, as in <EMAIL>; a NULL text
    stays NULL. Other columns stay as they are."""

    clean = new_name(docs, "clean")

    def make():
        finder = Finder(field)

        def work(texts):
            out = []
            for text, (_, spans) in zip(texts, finder(texts)):
                parts, at = [], 0
                for a, b, kind in merged(spans):
                    parts += [text[at:a], f"<{kind.upper()}>"]
                    at = b
                out.append(None if text is None else "".join([*parts, text[at:]]))
            return {clean: out}

        return work

    rest = [c for c in docs.columns if c != text_col]
    return map_texts(docs, rest, text_col, make, f"{clean} string").withColumnRenamed(clean, text_col).select(docs.columns)
