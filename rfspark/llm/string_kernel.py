"""Toxicity scores from a subsequence string kernel machine with Nyström landmarks.

The kernel of two strings sums, over all subsequences of three characters that
they share, a weight that decays with the gaps inside; so an insult with
characters put in between, or with one replaced, stays close to the plain one.
A gap spans at most ``SPAN`` characters. Strings are words; long words are cut
into overlapping windows, and runs of single characters are joined first.

Training: sentences of labelled texts. A sentence of a clean text is clean; a
sentence of a toxic text counts as toxic if it holds a word that is far more
frequent in toxic texts. Landmarks are such words, and frequent clean ones. A
support vector machine (squared hinge) is trained on the Nyström features of
words; a toxic sentence is as toxic as its worst word, so in each round it is
represented by the word that the last machine liked most. A text's score is a
probability, calibrated on the texts of the sample, from the margins of its
worst words and from how many lie on the toxic side.

Because the margin is linear in the kernel's own features, the landmarks fold
into one table of weights over three characters, and scoring whole tables costs
a few look-ups for each distinct word of a batch.

The machine is fitted on a bounded sample: at most ``texts`` labelled texts and
``sentences`` sentences of each class, chosen by a hash of the id; every text is
scored, whole. A null text is empty; a text without words has a score like any
other, from margins at the floor. Labels other than 0 and 1, and labels without
a text, are left out; a repeated label counts as one text more. Without labels
of both classes every score is half the share of toxic ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import cut, stretches, tidied, words_of

CODES = 64  # characters told apart
SPAN = 7
DECAY = 0.5
WINDOW = 16
RISING = np.array([True, True, True, True, False, True, False])  # evidence that can only speak for toxic
FLOOR = -0.5  # margins below this are no evidence
TEXT_BYTES = 4 << 20
LANDMARKS = 128  # of each class
SENTENCE = 400  # characters at most; a longer one is cut
# Signs written in place of a letter.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]


def _code_table() -> np.ndarray:
    """A code for every character: letters, digits and Latin accents one each, all others a few."""
    table = 61 + np.arange(0x110000, dtype=np.int32) % 3
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789" + "àáâäçèéêëìíîïñòóôöùúûüßœ"):
        table[ord(c)] = i + 1
        if len(c.upper()) == 1:
            table[ord(c.upper())] = i + 1
    for sign, letter in STANDS_FOR.items():
        table[ord(sign)] = table[ord(letter)]
    table[0] = 0  # marks where a string begins and ends
    return table


CODE = _code_table()


SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def windows_of(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words cut into windows, and the word each window is of.

    Signs around a word are no part of it; a word with signs inside comes twice,
    with them and without.
    """
    out, owner = [], []
    for i, w in enumerate(words):
        w = w.strip(SIGNS)
        forms = (w,) if w.isalnum() or not w else (w, "".join(filter(str.isalnum, w)))
        for form in forms:
            if len(form) <= WINDOW:
                out.append(form)
                owner.append(i)
            else:
                for at in range(0, len(form) - WINDOW // 2, WINDOW // 2):
                    out.append(form[at : at + WINDOW])
                    owner.append(i)
    return out, np.array(owner, np.int64)


def _flat(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all strings end to end, each between two marks, the string of each code, and sizes."""
    size = np.fromiter(map(len, strings), np.int64, len(strings)) + 2
    joined = "\0" + "\0\0".join(strings) + "\0" if strings else ""
    codes = CODE[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes, np.repeat(np.arange(len(strings)), size), size


def _weights(size: np.ndarray) -> np.ndarray:
    """The norm a string of each length is scaled by."""
    total = np.zeros(len(size))
    for a, b in STEPS:
        total += np.maximum(size - a - b, 0) * DECAY ** (2 * (a + b - 2))
    return np.sqrt(np.maximum(total, 1e-12))


def _each(codes, owner):
    """For each pair of steps: the features of all places, whether they lie in one string, and the weight."""
    for a, b in STEPS:
        s = a + b
        if len(codes) > s:
            feature = (codes[:-s] * CODES + codes[a : len(codes) - b]) * CODES + codes[s:]
            yield feature, owner[:-s] == owner[s:], DECAY ** (s - 2)


def features(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised features as (string, feature, value) triples."""
    codes, owner, size = _flat(strings)
    rows, cols, values = [], [], []
    for feature, inside, weight in _each(codes, owner):
        at = np.flatnonzero(inside)
        rows.append(owner[at])
        cols.append(feature[at])
        values.append(np.full(len(at), weight))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rows, cols, values = map(np.concatenate, (rows, cols, values))
    return rows, cols, values / _weights(size)[rows]


def kernel(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """The normalised kernel of some strings with the landmarks."""
    r, c, v = features(landmarks)
    known, back = np.unique(c, return_inverse=True)
    marks = np.zeros((len(known), len(landmarks)))
    np.add.at(marks, (back, r), v)
    marks = marks.astype(np.float32)
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    for at in range(0, len(strings), 200):  # a few hundred floats for each feature of these
        r, c, v = features(strings[at : at + 200])
        where = np.minimum(np.searchsorted(known, c), len(known) - 1)
        hit = np.flatnonzero(known[where] == c)
        hit = hit[np.argsort(r[hit], kind="stable")]
        if len(hit):
            rows, first = np.unique(r[hit], return_index=True)
            out[at + rows] = np.add.reduceat(marks[where[hit]] * v[hit, None].astype(np.float32), first, axis=0)
    return out


@dataclass
class Machine:
    """A fitted machine: weights over character triples, bias, and calibration."""

    weights: np.ndarray
    bias: float
    slope: np.ndarray | None = None
    centre: np.ndarray | None = None
    shift: float = 0.0

    def margins(self, strings: list[str]) -> np.ndarray:
        codes, owner, size = _flat(strings)
        sums = np.zeros(len(codes))
        for feature, inside, weight in _each(codes, owner):
            value = self.weights[feature]
            value *= weight
            value *= inside
            sums[: len(value)] += value
        total = np.zeros(0)
        if len(strings):
            total = np.add.reduceat(sums, np.cumsum(size) - size)
        return total / _weights(size) + self.bias

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """What a text's score rests on, a row each.

        The margins of its three worst different words, how many words lie on the
        toxic side, how many words it has, and the share of the one in the other
        (the counts on a log scale).
        """
        codes, words, starts = words_of(texts)
        n = len(starts) - 1
        text = np.repeat(np.arange(n), np.diff(starts))
        names = words.cast(pa.large_string()).to_pylist()
        own = self._words(names)
        each = own[codes] if len(codes) else np.zeros(0)
        joined, whose = self._spelled(codes, words, names, starts)
        extra = self._words(joined)
        best = np.full((n, 3), FLOOR)
        np.maximum.at(best[:, 0], text[each > FLOOR], each[each > FLOOR])
        hot = np.flatnonzero(each > FLOOR)
        pair = np.unique(np.column_stack([text[hot], codes[hot]]), axis=0).reshape(-1, 2)
        whose_all = np.concatenate([pair[:, 0], whose[extra > FLOOR]])
        margin = np.concatenate([own[pair[:, 1]] if len(pair) else np.zeros(0), extra[extra > FLOOR]])
        order = np.lexsort((-margin, whose_all))
        whose_all, margin = whose_all[order], margin[order]
        new = np.flatnonzero(np.diff(whose_all, prepend=-1))
        nth = np.arange(len(whose_all)) - np.repeat(new, np.diff(np.append(new, len(whose_all))))
        for k in range(3):
            best[whose_all[nth == k], k] = margin[nth == k]
        toxic = np.bincount(text[each > 0], minlength=n) + np.bincount(whose[extra > 0], minlength=n)
        size = np.diff(starts)
        return np.column_stack([best, np.log1p(toxic), np.log1p(size), np.log1p(1000 * toxic / np.maximum(size, 1))])

    def _words(self, names: list[str]) -> np.ndarray:
        """The margin of each word: its worst window's."""
        out = np.full(len(names), -np.inf)
        if names:
            strings, owner = windows_of(names)
            np.maximum.at(out, owner, self.margins(strings))
        return out

    @staticmethod
    def _spelled(codes, words, names, starts):
        """Runs of three or more single characters, joined, and the text each is of."""
        single = np.asarray(pc.equal(pc.utf8_length(words.cast(pa.large_string())), 1))[codes]
        if not single.any():
            return [], np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        at = np.flatnonzero(single)
        new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(text[at], prepend=-1) != 0))
        size = np.diff(np.append(new, len(at)))
        runs = [(at[n], z) for n, z in zip(new, size) if z >= 3]
        joined = ["".join(names[c] for c in codes[a : a + z]) for a, z in runs]
        return joined, np.array([text[a] for a, _ in runs], np.int64)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((evidence - self.centre) @ self.slope + self.shift, -500, 500)))


def constant(share: float) -> Machine:
    """A machine that gives every text the same score, below one half."""
    return Machine(np.zeros(CODES**3, np.float32), -1.0, np.zeros(6), np.zeros(6), float(np.log(max(share, 1e-9) / (2 - share))))


def _nystrom(strings: list[str], marks: list[str], root: np.ndarray) -> np.ndarray:
    """The strings' features over the landmarks, and a constant, filled in place."""
    out = np.ones((len(strings), len(marks) + 1), np.float32)
    for at in range(0, len(strings), 2000):
        out[at : at + 2000, :-1] = kernel(strings[at : at + 2000], marks) @ root
    return out


def train(
    sentences: list[tuple[list[str], int]], toxic_words: list[str], hard=None, rounds: int = 3, ridge: float = 1e-4
) -> Machine:
    """A machine from labelled sentences (their words) and words tied to toxic texts.

    ``hard`` gives, for a machine, clean words that it finds most toxic; after
    each round they join the clean examples, and the first of them the landmarks.
    """
    clean = {}
    for words, label in sentences:
        if not label:
            for w in windows_of(words)[0]:
                clean[w] = clean.get(w, 0) + 1
    often = sorted(clean, key=lambda w: (-clean[w], w))
    liked = set(windows_of(toxic_words)[0])
    marks = [w for w in dict.fromkeys(windows_of(toxic_words)[0]) if len(w) >= 3][:LANDMARKS]
    marks += [w for w in often if len(w) >= 3 and w not in liked][: LANDMARKS // 2]
    positive = [sorted(w for w in set(windows_of(words)[0]) if len(w) > 2) for words, label in sentences if label]
    positive = [words for words in positive if words]
    names = sorted({w for words in positive for w in words})
    place = {w: i for i, w in enumerate(names)}
    negative = sorted(set(clean) - liked)
    score = np.array([1.0 if w in liked else 0.0 for w in names])
    machine = None
    for turn in range(rounds):
        value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        root = (vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T).astype(np.float32)
        high = _nystrom(names, marks, root)
        chosen = [place[max(words, key=lambda w: score[place[w]])] for words in positive]
        at, count = np.unique(chosen, return_counts=True)
        n = len(negative)
        x = _nystrom([*negative, *(names[i] for i in at)], marks, root)
        y = np.concatenate([-np.ones(n), np.ones(len(at))])
        share = np.concatenate([np.full(n, 1 / max(n, 1)), count / count.sum()])
        weights = _squared_hinge(x, y, share, ridge)
        del x
        score = high @ weights
        # Margins are linear in the kernel with the landmarks, so in its features.
        r, c, v = features(marks)
        table = np.zeros(CODES**3)
        np.add.at(table, c, v * (root @ weights[:-1])[r])
        machine = Machine(table.astype(np.float32), float(weights[-1]))
        if hard and turn + 1 < rounds:
            found = [w for w in dict.fromkeys(windows_of(hard(machine))[0]) if w not in liked]
            marks += [w for w in found if len(w) >= 3 and w not in set(marks)][: LANDMARKS // 2]
            negative = sorted({*negative, *found})
    return machine


def _squared_hinge(x, y, share, ridge):
    """The primal solution by Newton steps: only examples inside the margin count."""
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-9
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        inside = np.flatnonzero(y * (x @ weights.astype(x.dtype)) < 1)
        left, right = penalty.copy(), np.zeros(x.shape[1])
        for at in range(0, len(inside), 4096):
            some = inside[at : at + 4096]
            rows = x[some].astype(np.float64)
            scaled = rows * share[some, None]
            left += scaled.T @ rows
            right += scaled.T @ y[some]
        solved = np.linalg.solve(left, right)
        if np.allclose(solved, weights, atol=1e-7):
            break
        weights = weights + 0.7 * (solved - weights)
    return weights


def calibrated(machine: Machine, evidence: np.ndarray, labels: np.ndarray) -> Machine:
    """The probability, by ridge logistic regression on the evidence with softened targets."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    centre, spread = evidence.mean(axis=0), np.maximum(evidence.std(axis=0), 1e-6)
    x = np.column_stack([(evidence - centre) / spread, np.ones(len(evidence))])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-9
    # More evidence never makes a text less toxic: a slope that would be negative is left out.
    used = np.ones(x.shape[1], bool)
    while True:
        w, some = np.zeros(x.shape[1]), x[:, used]
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (some * (p * (1 - p))[:, None]).T @ some + np.diag(ridge[used])
            step = np.linalg.solve(hess, some.T @ (p - target) + ridge[used] * w[used])
            w[used] -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        wrong = (w < 0) & RISING
        if not wrong.any():
            break
        used &= ~wrong
    return Machine(machine.weights, machine.bias, w[:-1] / spread, centre, float(w[-1]))


def _sentences(text: str):
    for s in re.split(r"(?<=[.!?])\s+|\n", text):
        for at in range(0, max(len(s), 1), SENTENCE):
            yield s[at : at + SENTENCE]


def fit(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", texts=4000, sentences=2500
) -> Machine:
    """A machine from labelled texts; ``labels`` holds only the rows to learn from."""
    spark = docs.sparkSession
    told = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    told = told.where("id is not null and toxic in (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in told.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return constant(float(1 in sizes))
    place = F.pmod(F.xxhash64("id", F.lit("texts")), F.lit(1 << 30))
    one, other = (told.where(F.col("toxic") == k).orderBy(place, "id").limit(texts) for k in (0, 1))
    # 2 * texts short rows at most, so they are sent to the texts and not the texts to them.
    told = F.broadcast(cut(one.unionByName(other), "toxicity"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    rows = cut(rows.join(told, "id").select("id", "toxic", "text"), "toxicity")

    def word_rows(batches):
        for batch in batches:
            codes, words, starts = words_of(batch.column(2))
            text = np.repeat(np.arange(len(batch)), np.diff(starts))
            pairs = np.unique(text * (len(words) + 1) + codes)
            toxic = batch.column(1).take(pa.array(pairs // (len(words) + 1)))
            yield pa.RecordBatch.from_arrays(
                [words.cast(pa.string()).take(pa.array(pairs % (len(words) + 1))), toxic], ["word", "toxic"]
            )

    held = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(held) < 2:
        return constant(float(1 in held))
    found = rows.mapInArrow(tidied(word_rows), "word string, toxic int").where(F.length("word") <= 2 * WINDOW).groupBy("word")
    found = cut(found.agg(F.sum("toxic").alias("up"), F.sum(1 - F.col("toxic")).alias("down")), "toxicity")
    tied = F.log((F.col("up") + 0.5) / (F.col("down") + 0.5)) + float(np.log(held[0] / held[1]))
    best = found.where("up >= 3").withColumn("tied", tied).where("tied > 3.0")
    best = [r["word"] for r in best.orderBy(F.desc(F.col("tied") * F.sqrt("up")), "word").limit(2 * LANDMARKS).collect()]

    def sentence_rows(batches):
        liked = set(best)
        for batch in batches:
            out = [], []
            for toxic, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for s in _sentences(text):
                    words = s.encode("utf-8", "surrogatepass").lower().decode("utf-8", "replace").split()
                    if words and (not toxic or any(w in liked for w in words)):
                        out[0].append(" ".join(words))
                        out[1].append(toxic)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32())], ["words", "toxic"])

    told = rows.mapInArrow(tidied(sentence_rows), "words string, toxic int").distinct()
    order = F.xxhash64("words", F.lit("sentences"))
    picked = [
        (r["words"].split(), r["toxic"])
        for k in (0, 1)
        for r in told.where(F.col("toxic") == k).orderBy(order, "words").limit(sentences).collect()
    ]
    if not best or len({label for _, label in picked}) < 2:
        return constant(held[1] / (held[0] + held[1]))

    def hard(machine):
        def scored(batches):
            for batch in batches:
                names = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(machine._words(names))], ["word", "margin"])

        words = found.where(tied < 0.5).select("word").mapInArrow(tidied(scored), "word string, margin double")
        return [r["word"] for r in words.orderBy(F.desc("margin"), "word").limit(1500).collect()]

    machine = train(picked, best, hard)
    seen = scores(rows, machine, "id", "text", "toxic").collect()
    return calibrated(machine, np.array([r["evidence"] for r in seen]), np.array([r["toxic"] for r in seen]))


def scores(docs: DataFrame, machine: Machine, id_col="doc_id", text_col="text", *also) -> DataFrame:
    """``id``, the ``evidence`` and the ``score`` for every row, and the columns named."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        model = held.value
        for batch in batches:
            for part in stretches(batch, 1, TEXT_BYTES):
                found = model.evidence(part.column(1))
                score = model.probability(found) if model.slope is not None else np.zeros(len(found))
                where = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
                listed = pa.ListArray.from_arrays(where, pa.array(found.ravel()))
                rest = [part.column(i) for i in range(2, part.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), listed, pa.array(score), *rest], ["id", "evidence", "score", *also]
                )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`") for c in also]
    )
    extra = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in also)
    return rows.mapInArrow(tidied(run), f"id long, evidence array<double>, score double{extra}")


def keep_clean(docs: DataFrame, machine: Machine, text_col="text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below the threshold, with the columns they came with."""
    held = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in stretches(batch, at, TEXT_BYTES):
                model = held.value
                yield part.filter(pa.array(model.probability(model.evidence(part.column(at))) < threshold))

    return docs.mapInArrow(tidied(run), docs.schema)
