"""Quality by compression: zstandard with dictionaries built from good and from bad labelled texts.

Each part of a text is compressed with either dictionary. The difference of the compressed sizes, over the text's
size, says which kind the text is like; with the compressed sizes themselves it is calibrated by logistic regression on set-apart rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import ship
from reachlab.llm._learn import fitted, logistic, probability, remainder, scored

ship(__name__)

#: Labelled texts of each class that fitting uses at most.
PER_CLASS = 3000
MODULUS = 5
THRESHOLD = 0.3
DICTIONARY = 1 << 16
LEVEL = 3
#: Bytes compressed at a time: in longer runs a text's own past would outweigh the dictionary.
PART = 2048


def _parts(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i : i + PART] for i in range(0, len(raw), PART)] or [b""]


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; of too few or too small samples, their own end."""
    parts = [p for t in texts for p in _parts(t) if p]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[-DICTIONARY:] or b"\0" * 8


class Model:
    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray):
        self.good, self.bad, self.weights = good, bad, weights
        self._made = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    def _compressors(self) -> list:
        if self._made is None:
            made = []
            for raw in (self.good, self.bad):
                kind = zstandard.DICT_TYPE_AUTO
                d = zstandard.ZstdCompressionDict(raw, dict_type=kind)
                d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
            made.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False))
            self._made = made
        return self._made

    def features(self, texts: list[str]) -> np.ndarray:
        good, bad, plain = (c.compress for c in self._compressors())
        rows = []
        for t in texts:
            parts = _parts(t)
            size = max(1, sum(map(len, parts)))
            g, b, p = (sum(len(f(x)) for x in parts) for f in (good, bad, plain))
            d, ratio = (b - g) / size, p / size
            rows.append((d, (b - g) / (b + g), min(g, b) / size, ratio, 1 / np.sqrt(size)))
        x = np.array(rows).reshape(len(rows), 5)
        return np.c_[x, x[:, 1] * x[:, 3], x[:, 1] ** 2, x[:, 3] ** 2, x[:, 2] ** 2]

    def score(self, texts: list[str]) -> np.ndarray:
        return probability(self.weights, self.features(texts))


def fit(texts: list[str], labels: list[int], ids: list, weights: list[float] | None = None) -> Model:
    """weights: what each text stands for, as the classes are sampled apart."""
    y = np.array(labels, int)
    apart = np.array([zlib.crc32(f"calibrate {i}".encode()) % 2 == 0 for i in ids], bool)
    half = lambda v: [t for t, l, a in zip(texts, y, apart, strict=True) if l == v and not a]
    model = Model(_dictionary(half(1)), _dictionary(half(0)), np.zeros(10))
    x = model.features([t for t, a in zip(texts, apart, strict=True) if a])
    mean, spread = (x.mean(0), np.maximum(x.std(0), 1e-9)) if len(x) else (np.zeros(9), np.ones(9))
    w = logistic((x - mean) / spread, y[apart], np.array(weights)[apart] if weights else None, ridge=1e-4)
    slopes = w[1:] / spread
    model.weights = np.r_[w[0] - slopes @ mean, slopes]
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> Model:
    learn = lambda rows: fit(rows["text"].tolist(), rows["label"].astype(int).tolist(), rows["id"].tolist(), rows["weight"].tolist())
    return fitted(docs, labels, label, remainder(id_col, MODULUS) != 0, per_class, learn, id_col, text_col)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1, higher: better), predicted (1 from THRESHOLD on).

    Null texts count as empty, and empty texts get the score of theirs. Rows are scored by text alone, repeated
    rows alike; a null id is not held out. Without labelled rows all get one constant score.
    """
    score = lambda texts: {"score": model.score(texts)}
    out = scored(docs, score, "score double", id_col, text_col, remainder(id_col, MODULUS) == 0)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
