"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear support vector machine.

A text is the set of its windows: words (letters only), what stands between marks inside them, and short neighbouring
words put together, so that insults spelt apart are seen whole. A window carries marks of its begin and end, runs of one
letter count once, and a word with one letter between all others is also looked at without it. The kernel of two windows counts common subsequences of KERNEL symbols, each weighted by DECAY to the
length it spans in both, over their own kernels to the power NORM; gaps and inserted letters cost little. The kernel is
computed wherever it can differ from zero. Landmarks are drawn at random from the windows of labelled sentences, the more
likely the more surely their frequency differs between the classes (odds by the cube of its chi-square); some are
drawn from windows of clean sentences, the more likely the more they are like those. Kernel values to them, whitened, are the features of a linear
machine over windows; a text's score is its highest window's margin, calibrated.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import ship, trim
from reachlab.llm._learn import fitted, logistic, probability, remainder, scored

ship(__name__)

KERNEL = 6
DECAY = 0.9
#: Share of a landmark's symbols that a window must hold, in order, to be like it at all.
PART = 0.65
#: The kernel is divided by both windows' own kernels to this power: 0 would favour long windows, 0.5 erase gapped ones.
NORM = 0.2
#: Landmarks, and how many of them are drawn from windows that clean sentences hold more often, by likeness to the others.
LANDMARKS, ALIKE = 96, 24
COST = 200000.0
#: A window stands for toxic texts in training if this share of them holds it, in so many different sentences, and it is so much rarer in others.
SHARE, SURE, RATIO = 0.01, 5, 20
#: What clean windows weigh in training, all in all, against 1 for toxic ones.
CAUTION = 6
#: Labelled texts of each class that fitting uses at most.
PER_CLASS = 1200
MODULUS, HELD_OUT = 4, 2
#: Margins are cut off here: the machine's own for clean windows, and twice that for toxic ones.
LOWEST, HIGHEST = -1.0, 2.0
#: From this score on a text counts as toxic.
THRESHOLD = 0.3
#: Longer words are looked at in windows of twice this many letters that overlap by half: subsequences that span more weigh next to nothing.
SPAN = 24
#: Neighbouring words of so many characters each are also looked at together in twos, and of so many in all in threes.
SHORT = {2: 3, 3: 6}
#: Characters of texts, and windows, that are looked at in one go.
CHARS, BLOCK = 1_000_000, 8_000

OUTER = ".,;:!?\"'()"
BEGIN, END = "\x02", "\x03"
_JUNK = re.compile(r"[\W\d_]+")
_APART = re.compile(r"(?<![^\W_])[^\W\d_](?:[^\w\n]{1,3}[^\W\d_]){2,}(?![^\W_])")
_RUN = re.compile(r"(.)\1+")
_SHORTS = re.compile(r"(?<!\S)\S{1,3}(?:[ \t]\S{1,3})+(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+")


def _codes(words: list[str]) -> np.ndarray:
    width = max(map(len, words), default=1)
    return np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.uint32).reshape(len(words), width)


def _pair_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of rows s[i], t[i] (character codes, 0 for none).

    A common subsequence's q-th symbol has q - 1 before it and KERNEL - q behind, so of each level only a band is filled.
    """
    if len(s) and max(s.max(), t.max()) < 1 << 16:
        s, t = s.astype(np.uint16), t.astype(np.uint16)  # half as much to compare
    s, t = np.array(s.T, order="C"), np.array(t.T, order="C")  # pairs last: every step is over adjacent numbers
    rows, cols, n = len(s) - KERNEL + 1, len(t) - KERNEL + 1, s.shape[1]
    if rows < 1 or cols < 1:
        return np.zeros(n, np.float32)
    decay, square = np.float32(DECAY), np.float32(DECAY * DECAY)
    none, spare = np.zeros(n, np.float32), np.empty(n, np.float32)
    same: dict[tuple[int, int], np.ndarray] = {}
    s[s == 0] = 1  # none is like nothing

    def alike(i: int, j: int) -> np.ndarray:
        if (i, j) not in same:
            same[i, j] = (s[i] == t[j]).astype(np.float32)
            same[i, j] *= square
        return same[i, j]

    def level(q: int, before: list[list[np.ndarray]] | None) -> list[list[np.ndarray]]:
        """Weights of common subsequences of q + 1 symbols that end at each cell of the band."""
        got = []
        for a in range(rows):
            row = []
            for b in range(cols):
                hit = alike(q + a, q + b)
                row.append(hit if before is None else np.multiply(before[a][b], hit, out=before[a][b]))
            got.append(row)
        return got

    match = level(0, None)
    for q in range(1, KERNEL):
        above = [none] * (cols + 1)
        sums = []
        for a in range(rows):
            line = [none]
            for b in range(cols):  # all that ends here or before, decayed by the distance
                x = above[b + 1] + line[b]
                x *= decay
                x += match[a][b]
                if a and b:
                    np.multiply(above[b], square, out=spare)
                    x -= spare
                line.append(x)
            above = line
            sums.append(line[1:])
        match = level(q, sums)
    return sum(x for row in match for x in row)


def _self(codes: np.ndarray) -> np.ndarray:
    step = 4000
    got = [_pair_kernel(codes[i : i + step], codes[i : i + step]) for i in range(0, len(codes), step)]
    return np.maximum(np.concatenate([*got, np.zeros(0, np.float32)]), 1e-12)


class Kernel:
    """Kernel values of windows to landmarks.

    A value is zero if the longest common subsequence is shorter than KERNEL, or by definition than PART of the landmark:
    letters put in never shorten it. So it is if fewer symbols, repeated ones counted, are common; only other pairs are computed.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.codes = _codes(landmarks)
        self.sizes = np.array([len(w) for w in landmarks])
        self.need = np.maximum(KERNEL, np.ceil(PART * self.sizes).astype(int))
        self.norm = _self(self.codes) ** -NORM
        self.planes = max((max(Counter(w).values()) for w in landmarks), default=1)
        self.bits = self._bits(self.codes)
        self.symbols = np.unique(self.codes)
        places = (self.codes[None] == self.symbols[:, None, None]) & (self.codes > 0)[None]
        #: For each symbol (none of them last) and landmark a bit for every place that holds it.
        self.places = np.r_[(places * (np.uint64(1) << np.arange(self.codes.shape[1], dtype=np.uint64))).sum(2, dtype=np.uint64), np.zeros((1, len(landmarks)), np.uint64)]

    def _common(self, at: np.ndarray, w: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of windows w and landmarks z, a bit for each place of a landmark."""
        rest = np.full(len(w), ~np.uint64(0))
        for column in at.T:
            hit = rest & self.places[column[w], z]
            rest = (rest + hit) | (rest - hit)
        return np.bitwise_count(~rest)

    def _bits(self, codes: np.ndarray) -> list[np.ndarray]:
        """A bit for each symbol's remainder; in the k-th plane, of symbols that stand there k times or more."""
        rows = np.sort(np.where(codes > 0, codes % 61 + 1, 0), axis=1)
        seen = np.ones(rows.shape, np.int64)
        for j in range(1, rows.shape[1]):
            seen[:, j] = np.where(rows[:, j] == rows[:, j - 1], seen[:, j - 1] + 1, 1)
        bit = np.uint64(1) << rows.astype(np.uint64)
        return [np.bitwise_or.reduce(np.where((rows > 0) & (seen == k), bit, np.uint64(0)), axis=1) for k in range(1, self.planes + 1)]

    def __call__(self, windows: list[str]) -> np.ndarray:
        out = np.zeros((len(windows), len(self.landmarks)), np.float32)
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        for at in range(0, len(order), BLOCK):
            part = order[at : at + BLOCK]
            codes = _codes([windows[i] for i in part])
            common = sum(np.bitwise_count(a[:, None] & b[None]).astype(np.uint8) for a, b in zip(self._bits(codes), self.bits, strict=True))
            w, z = np.nonzero(common >= self.need)
            row = np.searchsorted(self.symbols, codes)
            row[row == len(self.symbols)] = 0
            row = np.where((self.symbols[row] == codes) & (codes > 0), row, len(self.symbols))
            near = np.concatenate([self._common(row, w[i : i + BLOCK], z[i : i + BLOCK]) for i in range(0, len(w), BLOCK)] or [w]) >= self.need[z]
            w, z = w[near], z[near]
            by = np.argsort(self.sizes[z], kind="stable")  # like lengths together: less padding
            w, z = w[by], z[by]
            values = np.zeros(len(w), np.float32)
            for i in range(0, len(w), 4000):
                own, at_ = w[i : i + 4000], z[i : i + 4000]
                width = self.sizes[at_].max()
                values[i : i + 4000] = _pair_kernel(codes[own], self.codes[at_][:, :width])
            hit = np.unique(w[values > 0])
            own = np.zeros(len(part), np.float32)
            own[hit] = _self(codes[hit]) ** -NORM
            out[np.array(part)[w], z] = values * own[w] * self.norm[z]
        return out


def _windows(word: str) -> list[str]:
    """The kernel's windows of a word of letters; none if it is too short for any common subsequence."""
    w = _RUN.sub(r"\1", word)
    if len(w) + 2 < KERNEL:
        return []
    plain = _windows(w[::2]) if len(w) > 6 and w.count(w[1]) >= len(w) // 2 and len(set(w[1::2])) == 1 else []  # one letter between all others
    w = BEGIN + w + END
    return [w, *plain] if len(w) <= 2 * SPAN else [*(w[i : i + 2 * SPAN] for i in range(0, len(w) - SPAN, SPAN)), *plain]


def windows_of(raw: str) -> list[str]:
    """Windows of a raw word, or of neighbouring raw words: their letters together, and of a single word those between marks."""
    if raw.isalpha():
        return _windows(raw)
    joined = _JUNK.sub("", raw)
    pieces = [joined] if " " in raw else dict.fromkeys([joined, *_JUNK.split(raw)])
    return [w for p in pieces for w in _windows(p)]


def bag(text: str) -> set[str]:
    """Distinct raw words of a text, short neighbours, and what letters set apart come to together."""
    low = text.lower()
    got = {w.strip(OUTER) for w in set(low.split())}.union(_JUNK.sub("", m) for m in _APART.findall(low))
    for run in _SHORTS.findall(low):
        words = run.split()
        got.update([f"{a} {b}" for a, b in pairwise(words)])
        if len(words) > 2:
            got.update([f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:], strict=False) if len(a) + len(b) + len(c) <= SHORT[3]])
    return got


def gapped(window: str) -> list[str]:
    """A window with a letter put in at each place, and at all of them at once."""
    inner = window[1:-1]
    one = [BEGIN + inner[:i] + x + inner[i:] + END for i in range(1, len(inner)) for x in "xe"]
    full = [BEGIN + x.join(inner) + END for x in "xe"]
    return [*one, *full * max(1, len(one) // 4)]  # so that those spoilt throughout count half as much as all others


class Model:
    """Landmarks, weights of kernel values and calibration. Raw words that were looked at are remembered as far as memory is bounded."""

    KEEP = 1_000_000

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, calibration: np.ndarray):
        self.kernel, self.weights, self.bias, self.calibration = Kernel(landmarks) if landmarks else None, weights, bias, calibration
        self.forget()

    def forget(self) -> None:
        #: Margins of raw words above the lower bound, and 64-bit hashes of all others.
        self.hot: dict[str, float] = {}
        self.cold: set[int] = set()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"hot": {}, "cold": set()}

    def _learn(self, raw: list[str]) -> None:
        """Margins of raw words, some at a time."""
        for i in range(0, len(raw), BLOCK):
            part = raw[i : i + BLOCK]
            held = [windows_of(r) for r in part]
            fresh = list({w for h in held for w in h})
            margin = self.kernel(fresh) @ self.weights + self.bias
            above = {w: m for w, m in zip(fresh, margin.tolist(), strict=True) if m > LOWEST}
            for r, h in zip(part, held, strict=True):
                if best := [above[w] for w in h if w in above]:
                    self.hot[r] = max(best)
                else:
                    self.cold.add(hash(r))

    def margin(self, texts: list[str]) -> np.ndarray:
        """Highest margin over each text's windows, at least LOWEST and at most HIGHEST: beyond those there is nothing more to tell."""
        if self.kernel is None:
            return np.clip(np.full(len(texts), self.bias), LOWEST, HIGHEST)
        out, i = [], 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n + len(texts[j]) <= CHARS):
                n += len(texts[j])
                j += 1
            bags = [bag(t) for t in texts[i:j]]
            if len(self.cold) > self.KEEP or len(self.hot) > self.KEEP // 10:
                self.forget()
            self._learn([w for w in set().union(*bags) - self.hot.keys() if hash(w) not in self.cold])
            out += [max([self.hot[w] for w in self.hot.keys() & b], default=LOWEST) for b in bags]
            i = j
        return np.minimum(out, HIGHEST)

    def score(self, texts: list[str]) -> np.ndarray:
        return probability(self.calibration, self.margin(texts)[:, None])


def _train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by Newton's method, halving steps that do not help."""
    a = np.c_[x, np.ones(len(x))].astype(float)
    c = cost * weight / weight.sum()
    reg = np.r_[np.ones(x.shape[1]), 1e-3]
    w = np.zeros(a.shape[1])
    loss = lambda w: (reg * w * w).sum() / 2 + (c * np.maximum(0, 1 - y * (a @ w)) ** 2).sum()
    now = loss(w)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (a @ w))
        on = slack > 0
        step = np.linalg.solve(np.diag(reg) + 2 * (a[on] * c[on, None]).T @ a[on], reg * w - 2 * a.T @ (c * y * slack))
        t = 1.0
        while (new := loss(w - t * step)) > now and t > 1e-4:
            t /= 2
        w = w - t * step
        if now - new <= 1e-9 * now:
            break
        now = new
    return w[:-1], float(w[-1])


def _sentences(texts: list[str]) -> Counter:
    """How many different sentences hold each window: what copies share counts once."""
    seen = {s.strip() for t in texts for s in _SENTENCE.split(t.lower())}
    return Counter(w for s in seen for w in {w for raw in bag(s) for w in windows_of(raw)})


def _draw(windows: list[str], worth: np.ndarray, n: int) -> list[str]:
    """n windows drawn without replacement with odds by worth; the draw depends on nothing but the windows."""
    u = np.array([(zlib.crc32(f"landmark {w}".encode("utf-8", "replace")) + 1) / 4294967298 for w in windows])
    order = np.argsort(np.log(u) / np.maximum(worth, 1e-12), kind="stable")
    return [windows[i] for i in order[::-1][:n]]


def _whiten(kernel: Kernel) -> np.ndarray:
    gram = kernel(kernel.landmarks).astype(float)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))


def fit(texts: list[str], labels: list[int], ids: list[int], weights: list[float] | None = None, landmarks: int = LANDMARKS, alike: int = ALIKE, rounds: int = 6) -> Model:
    """weights: what each text stands for. One class only, or no telling window, gives a model with a constant score."""
    weights = weights or [1.0] * len(texts)
    first = {t: i for i, t in reversed(list(enumerate(texts)))}  # copies would make chance words look telling
    texts, labels, ids, weights = ([v[i] for i in sorted(first.values())] for v in (texts, labels, ids, weights))
    y = np.array(labels, int)
    constant = Model([], np.zeros(0), 0.0, logistic(np.zeros((len(y), 1)), y, np.array(weights)))
    if not len(y) or y.min() == y.max():
        return constant
    d1, d0 = (_sentences([t for t, v in zip(texts, y, strict=True) if v == k]) for k in (1, 0))
    n1, n0 = (max(1, sum(len(_SENTENCE.split(t)) for t, v in zip(texts, y, strict=True) if v == k)) for k in (1, 0))
    held = [{w for raw in bag(t) for w in windows_of(raw)} for t in texts]
    vocab = sorted(d1.keys() | d0.keys() | set().union(*held))
    a, b = np.array([d1[w] for w in vocab], float), np.array([d0[w] for w in vocab], float)
    if not len(vocab):
        return constant
    pooled = (a + b + 1) / (n1 + n0 + 2)
    z = (a / n1 - b / n0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    chosen = _draw(vocab, np.maximum(z, 0) ** 6, landmarks - alike)
    close = Kernel(chosen)(vocab).max(1)
    chosen += _draw(vocab, np.where(z < 0, close, 0.0) ** 6, alike)
    texts1 = Counter(w for h, v in zip(held, y, strict=True) if v for w in h)
    often = np.array([texts1[w] for w in vocab]) >= SHARE * y.sum()
    start = np.where(often & (a >= SURE) & (a / n1 > RATIO * b / n0), z, 0.0)
    at = {w: i for i, w in enumerate(vocab)}
    bags = [np.array([at[w] for w in sorted(h)], int) for h in held]
    check = np.array([zlib.crc32(f"calibrate {i}".encode()) % 4 == 0 for i in ids])
    if not (start > 0).any():
        return constant
    spoilt = sorted(g for i in np.flatnonzero(start) for g in gapped(vocab[i]) if g not in at)

    def machine(chosen: list[str]) -> tuple[np.ndarray, float, np.ndarray]:
        kernel = Kernel(chosen)
        white = _whiten(kernel)
        mapped, spoilt_x = kernel(vocab) @ white, kernel(spoilt) @ white if spoilt else np.zeros((0, len(chosen)))
        score = start
        worst: list[np.ndarray] = [np.zeros(0, int)] * len(bags)  # of clean texts, what any round has found to look worst
        for _ in range(rounds):
            x, lab, wt = [np.zeros((1, len(chosen)))], [np.array([-1.0])], [np.array([1.0])]
            for k, (own, v, apart) in enumerate(zip(bags, y, check, strict=True)):
                if apart or not len(own):
                    continue
                if v:
                    best = own[start[own] > 0]  # a text without any teaches nothing
                else:
                    best = worst[k] = np.union1d(worst[k], own[np.argsort(-score[own], kind="stable")[:3]])
                if len(best):
                    x.append(mapped[best])
                    lab.append(np.full(len(best), 1.0 if v else -1.0))
                    wt.append(np.full(len(best), 1.0 / len(best)))
            x.append(spoilt_x)
            lab.append(np.ones(len(spoilt)))
            wt.append(np.full(len(spoilt), 2.0 * max(1, y.sum()) / max(1, len(spoilt))))
            x, lab, wt = np.concatenate(x), np.concatenate(lab), np.concatenate(wt)
            wt = np.where(lab > 0, wt / max(wt[lab > 0].sum(), 1e-9), CAUTION * wt / wt[lab < 0].sum())
            w, bias = _train_svm(x, lab, wt, COST)
            score = mapped @ w + bias
        return white @ w, bias, score

    beta, bias, score = machine(chosen)
    doc = np.clip([score[s].max(initial=bias) for s in bags], LOWEST, HIGHEST)
    cal = check if len(set(y[check])) == 2 else np.ones(len(y), bool)
    return Model(chosen, beta, bias, logistic(doc[cal][:, None], y[cal], np.array(weights)[cal]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    learn = lambda rows: fit(rows["text"].tolist(), rows["label"].astype(int).tolist(), rows["id"].tolist(), rows["weight"].tolist())
    return fitted(docs, labels, label, remainder(id_col, MODULUS) != HELD_OUT, per_class, learn, id_col, text_col)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 from THRESHOLD on).

    Null, empty and wordless texts get the score of a text without a telling word. Rows are scored by text alone,
    repeated rows alike; a null id is not held out.
    """
    score = lambda texts: {"score": model.score(texts)}
    out = scored(docs, score, "score double", id_col, text_col, remainder(id_col, MODULUS) == HELD_OUT)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs' rows whose text scores below THRESHOLD, all columns kept, whatever their names.

    Null, empty and wordless texts stay unless a text without a telling word is toxic; repeated rows stay or go alike. An
    empty table stays empty.
    """

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts.fillna("").tolist()) < THRESHOLD)
        model.forget()
        trim()

    ok = F.pandas_udf(judge, "boolean")

    return docs.filter(ok(F.col(text_col)))
