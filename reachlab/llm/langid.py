"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Subwords are runs of 2 to 4 bytes of the text with A-Z lower-cased and other ASCII than letters taken as spaces. A
text's vector is the mean of its subwords' embeddings. Once trained, embeddings and output weights are one table of a row of
class scores per hash bucket. A temperature fitted on set-apart rows calibrates the scores; texts whose
score is below what nearly all set-apart texts reach are marked as rejected.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import ship
from reachlab.llm._learn import fitted, remainder, scored

ship(__name__)

BUCKETS = 1 << 16
DIM = 16
ORDERS = (2, 3, 4)
EPOCHS = 4
#: Labelled texts of each language that fitting uses at most.
PER_CLASS = 800
#: Share of set-apart, rightly identified texts that rejection may refuse.
REFUSED = 0.005
MODULUS = 5
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)
_PAD = b" " * max(ORDERS)
#: Bytes hashed in one go.
CHUNK = 1 << 20


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' folded bytes, each between spaces so that no subword spans two, and where each starts."""
    raw = [_PAD + t.encode("utf-8", "replace") for t in texts]
    starts = np.cumsum([0, *map(len, raw)])
    return _FOLD[np.frombuffer(b"".join([*raw, _PAD]), np.uint8)], starts


def _buckets(flat: np.ndarray, end: int) -> list[np.ndarray]:
    """For each order, the bucket of the subword at each place before end."""
    out = []
    h = flat.astype(np.uint32)
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * np.uint32(257) + flat[n - 1 :]
        if n in ORDERS:
            out.append((((h + np.uint32(n * 7919)) * np.uint32(2654435761)) >> np.uint32(16))[:end].astype(np.int64) % BUCKETS)
    return out


class Model:
    def __init__(self, classes: list, table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, floor: float = 0.0):
        self.classes, self.table, self.bias, self.temperature, self.floor = classes, table, bias, temperature, floor

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.classes)))
        i = 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n < CHUNK):
                n += len(texts[j])
                j += 1
            flat, starts = _flat(texts[i:j])
            for h in _buckets(flat, starts[-1]):
                for k in range(len(self.classes)):
                    out[i:j, k] += np.add.reduceat(self.table[k][h], starts[:-1], dtype=np.float64)
            out[i:j] /= (len(ORDERS) * np.diff(starts))[:, None]
            i = j
        return out + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return _softmax(self.logits(texts) / self.temperature)

    def score(self, texts: list[str]) -> dict[str, object]:
        if not self.classes:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts)), "rejected": np.ones(len(texts), bool)}
        p = self.probabilities(texts)
        best = p.argmax(1)
        top = p[np.arange(len(p)), best]
        return {"lang_pred": [self.classes[b] for b in best], "score": top, "rejected": top < self.floor}


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and their shares."""
    out = []
    for t in texts:
        flat, starts = _flat([t])
        b, n = np.unique(np.concatenate(_buckets(flat, starts[-1])), return_counts=True)
        out.append((b, (n / n.sum()).astype(np.float32)))
    return out


def fit(texts: list[str], labels: list, ids: list, seed: int = 1, rate: float = 2.0, batch: int = 32) -> Model:
    classes = sorted(set(labels))
    if not classes:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    y = np.array([classes.index(v) for v in labels])
    apart = np.array([zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in ids])
    if len(set(y[~apart])) < len(classes):
        apart[:] = False
    feats = _counts(texts)
    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((BUCKETS, DIM)) / DIM).astype(np.float32)
    out, bias = np.zeros((DIM, len(classes)), np.float32), np.zeros(len(classes), np.float32)
    train = np.flatnonzero(~apart)
    share = np.bincount(y[train], minlength=len(classes))
    weight = (len(train) / len(classes) / np.maximum(share, 1))[y].astype(np.float32)  # languages count alike
    steps, at = EPOCHS * -(-len(train) // batch), 0
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            lr = rate * (1 - at / steps)
            at += 1
            b = np.concatenate([feats[r][0] for r in rows])
            v = np.concatenate([feats[r][1] for r in rows])
            sizes = np.array([len(feats[r][0]) for r in rows])
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            x = np.add.reduceat(emb[b] * v[:, None], first)
            p = _softmax(x @ out + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[rows][:, None] / len(rows)
            back = p @ out.T
            out -= lr * x.T @ p
            bias -= lr * p.sum(0)
            np.add.at(emb, b, -lr * len(rows) * v[:, None] * np.repeat(back, sizes, axis=0))
    model = Model(classes, np.ascontiguousarray((emb @ out).T), bias.astype(float))
    if apart.any():
        logits, truth = model.logits([texts[i] for i in np.flatnonzero(apart)]), y[apart]
        grid = np.geomspace(0.02, 20, 60)
        loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(logits / model.temperature)
        right = p.argmax(1) == truth
        model.floor = float(np.quantile(p[right].max(1), REFUSED)) if right.any() else 0.0
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "lang", per_class: int = PER_CLASS) -> Model:
    """Learns from text and non-null label of rows that are not held out: at most per_class of each language."""
    learn = lambda rows: fit(rows["text"].tolist(), rows["label"].tolist(), rows["id"].tolist())
    return fitted(docs, docs.select(id_col, label), label, remainder(id_col, MODULUS) != 0, per_class, learn, id_col, text_col)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (0 to 1), rejected (the score is too low to be trusted).

    Null texts and texts without a letter are "und" with score 0 and rejected. Rows are judged by text alone,
    repeated rows alike; a null id is not held out; no labelled row at all makes all "und".
    """
    own = docs.select(F.col(id_col).alias("__i"), F.col(text_col).alias("__t"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    # without a letter there is nothing to read: such texts pass as null, and are told apart by it
    own = own.select(F.col("__i").alias(id_col), F.when(F.col("__letters"), F.col("__t")).alias(text_col))

    def score(texts: list[str]) -> dict[str, object]:
        got = model.score(texts)
        none = np.array([not t for t in texts], bool)
        return {
            "lang_pred": [UNKNOWN if n else v for n, v in zip(none, got["lang_pred"], strict=True)],
            "score": np.where(none, 0.0, got["score"]), "rejected": got["rejected"] | none,
        }

    return scored(own, score, "lang_pred string, score double, rejected boolean", id_col, text_col, remainder(id_col, MODULUS) == 0, 1000)
