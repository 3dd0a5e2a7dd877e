"""Personal data found by rules and by boosted trees over loose candidates.

Rules give the base spans: e-mail addresses, IP addresses, card and phone
numbers in their strict forms. Generators then propose, with high recall,
overlapping spans in looser forms (written-out signs, other separators, no
leading plus). Each candidate is described by its own format and by the text
around it, and gradient-boosted trees give it a score. Scores are calibrated,
per kind, on candidates that the trees were not fitted on; candidates above the
threshold that overlap no base span are selected, best first.

The trees learn without hand-made labels: base spans rewritten into loose forms,
in the context where they stand, are positive; candidates that the rules reject
are negative. They are fitted on a bounded sample, at most ``CANDIDATES``
candidates of texts chosen by a hash; every text is searched, whole.

A null text is empty and has no spans. Ids may be null or repeat: every row is
searched on its own. Without positive or without negative candidates nothing is
added to the base. Other columns may have any names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import stretches, tidied

KINDS = ("email", "ip", "card", "phone")
TEXTS = 50_000  # texts looked through for the sample, about
CANDIDATES = 20_000
PRECISION = 0.9  # of what is added, as calibrated
TEXT_BYTES = 16 << 20

# Fixed patterns of the base spans; runs are never given back, so long ones cost no more than their length.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Generators: a kind, and a form that it may take. One kind's forms may overlap.
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?| dot )"
_HOST = rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}"
GENERATORS = [
    (0, re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}}\s?[\[({{]\s?(?:at|@)\s?[\])}}]\s?{_HOST}")),
    (0, re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}}(?:\s@\s?|@\s){_HOST}")),
    (0, re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}} at {_HOST}")),
    (1, re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?(?:[\[({](?:\.|dot)[\])}]|,|\. | \.| dot )\s?[0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){12,18}(?![0-9])")),
    (3, re.compile(r"(?<![0-9A-Za-z])[(+]{0,2}[0-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])")),
]
# What any base span or generator's form holds, and so what a text without any span lacks. Letters apart, all
# of it is a digit, a sign, or "at" in brackets; any character may stand where the forms allow a space.
HOPEFUL = r"(?s)[0-9@]| at |[\[({].?at.?[\])}]"
# Words that speak for a kind when they stand ahead of a candidate, and words that speak against all.
HINTS = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "addr", "from"),
    "card": ("card", "visa", "credit", "pay", "master"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell"),
}
AGAINST = ("version", "isbn", "token", "key", "hash", "order", "id", "no.", "page", "build", "=")
AROUND = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The base spans as (kind, start, end), in code points, by kind and then start."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            last = found.end()
        at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(_small(p) for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def candidates(text: str, base: list) -> list[tuple[int, int, int]]:
    """Loose candidates of all kinds that overlap no base span; they may overlap each other."""
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for kind, form in GENERATORS:
        k = 0
        for m in form.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            # Base spans of different kinds may overlap each other, so a few are looked at.
            if not any(s < m.end() and e > m.start() for s, e in taken[max(0, k - 4) : k + 4]):
                out.append((kind, m.start(), m.end()))
    return out


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of a candidate, and what stands around it."""
    digits = _digits(span)
    seps = [c for c in span if not c.isalnum()]
    low = before.lower()
    groups = re.findall(r"[0-9]+", span)
    return [
        kind,
        len(span),
        len(digits),
        sum(c.isalpha() for c in span),
        len(seps),
        len(set(seps)),
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("(") + span.count("["),
        span.startswith("+"),
        len(digits) >= 13 and luhn(digits),
        bool(groups) and all(_small(g) for g in groups),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(set(digits)),
        any(h in low for h in HINTS[KINDS[kind]]),
        any(h in low for h in AGAINST),
        before[-1:].isalnum(),
        after[:1].isalnum(),
        before[-1:] in ("", "\n"),
        after[:1] in ("", "\n"),
        sum(c.isdigit() for c in before),
        sum(c.isdigit() for c in after),
        sum(c.isalpha() for c in before),
    ]


def _rewritten(kind: int, span: str):
    """A base span in loose forms."""
    if kind == 0:
        name, _, domain = span.partition("@")
        yield f"{name} at {domain}"
        yield f"{name} [at] " + domain.replace(".", " [dot] ")
        yield f"{name}(at){domain}"
        yield f"{name} @ {domain}"
    elif kind == 1:
        yield span.replace(".", "[.]")
        yield span.replace(".", " . ")
        yield span.replace(".", " dot ")
    elif kind == 2:
        digits = _digits(span)
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        yield ".".join(fours)
        yield "/".join(fours)
        yield "  ".join(fours)
    else:
        yield span.removeprefix("+")
        yield "00" + span.removeprefix("+").replace("(", "").replace(")", "")
        yield re.sub(r"^\+[0-9]{1,3}[ .-]+", "", span)


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features, and each kind's calibration."""

    edges: list
    trees: list = field(default_factory=list)
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple = (1.1,) * len(KINDS)

    DEPTH = 3
    ROUNDS = 40
    RATE = 0.2
    BINS = 16

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        x = self.binned(x)
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for column, cut_at, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.DEPTH):
                node = 2 * node + 1 + (x[rows, column[node]] >= cut_at[node])
            out += leaf[node - (2**self.DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -50, 50)))


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to the logistic loss by Newton steps, level by level over histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, Trees.BINS + 1)[1:-1])) for j in range(x.shape[1])]
    model = Trees(edges, start=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    b, score = model.binned(x), np.full(len(y), model.start)
    n, bins = x.shape[1], Trees.BINS + 1
    for _ in range(Trees.ROUNDS):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        inner = 2**Trees.DEPTH - 1
        column, cut_at = np.zeros(inner, np.int64), np.full(inner, bins)
        node = np.zeros(len(y), np.int64)
        for level in range(Trees.DEPTH):
            first = 2**level - 1
            here = node - first
            for k in range(2**level):
                at = np.flatnonzero(here == k)
                if len(at) < 4:
                    continue
                flat = (b[at] + np.arange(n) * bins).ravel()
                g = np.bincount(flat, np.repeat(grad[at], n), n * bins).reshape(n, bins)
                h = np.bincount(flat, np.repeat(hess[at], n), n * bins).reshape(n, bins)
                left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                all_g, all_h = grad[at].sum(), hess[at].sum()
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                best = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[best] > 1e-6:
                    column[first + k], cut_at[first + k] = best[0], best[1] + 1
            node = 2 * node + 1 + (b[np.arange(len(y)), column[node]] >= cut_at[node])
        of = node - inner
        leaf = -np.bincount(of, grad, inner + 1) / (np.bincount(of, hess, inner + 1) + 1) * Trees.RATE
        score += leaf[of]
        model.trees.append((column, cut_at, leaf))
    return model


def fit(docs: DataFrame, text_col: str = "text") -> Trees | None:
    """The model, or None where the sample has no two classes of candidates."""
    n = docs.count()
    text = F.col(f"`{text_col}`")
    order = F.xxhash64(text, F.lit("pii"))
    some = docs.select(text.alias("text"), order.alias("o")).where(text.isNotNull())
    some = some.where(F.pmod("o", F.lit(1 << 30)) < int(min(1.0, TEXTS / max(n, 1)) * (1 << 30)) + 1)
    some = some.where(F.col("text").rlike(HOPEFUL))

    def run(batches):
        for batch in batches:
            rows = []
            for t, o in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base = base_spans(t)
                spans = [(k, s, e, False) for k, s, e in candidates(t, base)] + [(*x, True) for x in base]
                for kind, s, e, is_base in spans:
                    before, after = t[max(0, s - AROUND) : s], t[e : e + AROUND]
                    forms = _rewritten(kind, t[s:e]) if is_base else [t[s:e]]
                    for form in forms:
                        rows.append((o, is_base, [float(v) for v in features(kind, form, before, after)]))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.bool_(), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(columns, ["o", "y", "x"])

    found = some.mapInArrow(tidied(run), "o long, y boolean, x array<double>").distinct()
    found = found.orderBy("o", "y", "x").limit(CANDIDATES).collect()
    y = np.array([r["y"] for r in found], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in found])
    # A third of the texts is kept from the trees, for calibration.
    kept = np.array([r["o"] for r in found]) % 3 == 0
    if kept.all() or not kept.any() or y[~kept].min() == y[~kept].max():
        kept = np.zeros(len(y), bool)
    model = boosted(x[~kept], y[~kept])
    seen_x, seen_y = (x[kept], y[kept]) if kept.any() else (x, y)
    model.slope, model.shift = _platt(model.raw(seen_x), seen_y)
    p = model.probability(seen_x)
    model.thresholds = tuple(_threshold(p[seen_x[:, 0] == k], seen_y[seen_x[:, 0] == k]) for k in range(len(KINDS)))
    return model


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, w = np.column_stack([raw, np.ones(len(raw))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        w = w - np.clip(np.linalg.solve(hess, x.T @ (p - target)), -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The smallest probability, one half at least, above which the precision holds."""
    order = np.argsort(-p, kind="stable")
    if not len(order) or not y.any():
        return 0.5 if len(order) == 0 else max(0.5, float(np.nextafter(p.max(), 2)))
    right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    ok = np.flatnonzero(right >= PRECISION)
    return max(0.5, float(p[order[ok[-1]]])) if len(ok) else max(0.5, float(np.nextafter(p.max(), 2)))


def spans_of(text: str, model: Trees | None) -> tuple[list, list]:
    """Base spans, and all spans, both as (kind, start, end) by kind and then start."""
    base = base_spans(text)
    loose = candidates(text, base) if model else []
    if not loose:
        return base, base
    around = [(k, text[s:e], text[max(0, s - AROUND) : s], text[e : e + AROUND]) for k, s, e in loose]
    p = model.probability(np.array([features(*a) for a in around], float))
    added: list = []
    # The selected ones, best first, as long as they overlap nothing selected: places are marked, so it is one step each.
    marked: set = set()
    for i in np.argsort(-p, kind="stable").tolist():
        kind, s, e = loose[i]
        if p[i] >= model.thresholds[kind] and not any(c in marked for c in range(s, e)):
            marked.update(range(s, e))
            added.append((kind, s, e))
    return base, sorted([*base, *added])


def _searched(texts: pa.Array, model):
    """Spans of each text; most texts hold no digit and no sign, and are told apart at once."""
    hopeful = np.asarray(pc.match_substring_regex(texts, HOPEFUL))
    for text, hope in zip(texts.to_pylist(), hopeful.tolist()):
        yield spans_of(text, model) if hope else ([], [])


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, spans`` for every row: arrays of ``kind, start, end``, and both written out."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in stretches(batch, 1, TEXT_BYTES):
                found = list(_searched(part.column(1).fill_null(""), held.value))
                counts = [[sum(k == i for k, _, _ in base) for base, _ in found] for i in range(len(KINDS))]
                columns = [*counts, [_written(b) for b, _ in found], [_written(a) for _, a in found]]
                types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
                made = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names)

    names = ["id", *(f"n_{k}" for k in KINDS), "base", "spans"]
    schema = "id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(tidied(run), schema)


def redacted(text: str, spans) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """The rows with personal data replaced in the text, all other columns as they came. A null text stays null."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in stretches(batch, at, TEXT_BYTES):
                texts = part.column(at)
                found = _searched(texts.fill_null(""), held.value)
                made = [t if t is None or not s else redacted(t, s) for t, (_, s) in zip(texts.to_pylist(), found)]
                columns = [pa.array(made, part.schema.field(at).type) if i == at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(tidied(run), docs.schema)
