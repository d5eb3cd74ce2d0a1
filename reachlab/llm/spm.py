"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A normalised text falls into words that no merge can cross. Each distinct word of a batch is encoded once: all words'
symbols lie in one flat array; a round looks up the rank of every neighbouring pair, takes each word's smallest rank,
merges all its pairs of that rank from the left at once, and compacts the array; words without a pair drop out. Merging at once
is what merging one by one would give as long as no merge makes a pair of that rank or a smaller one beside it: at the
first that does, the word's further merges wait for the next round.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import parts, ship, trim

ship(__name__)

MARK = "▁"
#: Bytes, about, of words and their codes that a task keeps between batches.
CACHE = 32 << 20
#: Characters of new words merged in one go, a longer word alone; bytes of texts coded in one go.
FLAT, TEXTS = 1 << 18, 1 << 20


class PieceBpe:
    """A BPE model with byte fallback, read from a SentencePiece model file by the library's own loader.

    Only models that this engine covers are taken: identity normaliser, dummy prefix, white space kept, no
    user-defined symbols, and no piece with a space mark after another character.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        probe = " a  \tb ﬁ "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model's normaliser is not the identity with a dummy prefix")
        self.eos, self.unk = sp.eos_id(), sp.unk_id()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.silent = frozenset(i for i in range(n) if sp.is_control(i))
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        #: What each id shows; bytes have to be put together first.
        self.shown = [None if i in self.bytes else "" if i in self.silent else " ⁇ " if i == self.unk else self.pieces[i].replace(MARK, " ") for i in range(n)]
        self.byte_id = np.zeros(256, np.int64)
        for i, b in self.bytes.items():
            self.byte_id[b] = i
        normal = [i for i in range(n) if i not in self.silent and i not in self.bytes and i != self.unk]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece has a space mark inside")
        self.ids = {self.pieces[i]: i for i in normal}
        # equal scores are equal ranks: the leftmost pair then wins
        scores = np.array([sp.get_score(i) for i in normal])
        order = np.unique(-scores, return_inverse=True)[1]
        rank = dict(zip(normal, order.tolist(), strict=True))
        loose = sorted({c for i in normal for c in self.pieces[i]} - self.ids.keys())
        self.char = {p: i for p, i in self.ids.items() if len(p) == 1} | {c: n + k for k, c in enumerate(loose)}
        self.size = n + len(loose)
        symbol = self.ids | {c: n + k for k, c in enumerate(loose)}
        cuts = ((p[:k], p[k:], i) for i in normal for p in (self.pieces[i],) for k in range(1, len(p)))
        pairs = np.fromiter(((symbol[a] * self.size + symbol[b], rank[i], i) for a, b, i in cuts if a in symbol and b in symbol), np.dtype((np.int64, 3)))
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.pair_key = pairs[:, 0].copy()
        self.pair_rank = np.append(pairs[:, 1], NO_PAIR)
        self.pair_id = np.append(pairs[:, 2], -1)
        self.loose = {i: c for c, i in self.char.items() if i >= n}
        # characters in no piece stand alone, so words can be cut around them; line ends are the common ones
        self.cut = "\n" if "\n" not in self.char else ""
        self.word = re.compile(f"{MARK}+[^{MARK}{self.cut}]*|[^{MARK}{self.cut}]+" + (f"|{self.cut}+" if self.cut else ""))

    def words(self, text: str) -> list[str]:
        return self.word.findall(MARK + text.replace(" ", MARK)) if text else []

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the pair table, or the row after the last if the pair is no piece."""
        key = left * self.size + right
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        ok = (self.pair_key[at] == key) & (left < self.size) & (right < self.size)
        return np.where(ok, at, len(self.pair_key))

    def _rounds(self, words: list[str]) -> list[list[int]]:
        sizes = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        chars, where = np.unique(codes, return_inverse=True)
        sym = np.array([self.char.get(chr(c), self.size + c) for c in chars.tolist()], np.int64)[where]
        owner = np.repeat(np.arange(len(words)), sizes)
        row = self._find(sym[:-1], sym[1:])
        row[owner[:-1] != owner[1:]] = len(self.pair_key)
        pair = np.r_[row, len(self.pair_key)]
        done_sym, done_owner = [], []
        while len(sym):
            rank = self.pair_rank[pair]
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts = np.diff(np.r_[heads, len(sym)])
            least = np.minimum.reduceat(rank, heads)
            live = np.repeat(least < NO_PAIR, counts)
            if not live.all():
                done_sym.append(sym[~live])
                done_owner.append(owner[~live])
                sym, owner, pair, rank = sym[live], owner[live], pair[live], rank[live]
                heads, counts, least = None, counts[least < NO_PAIR], least[least < NO_PAIR]
                if not len(sym):
                    break
            level = np.repeat(least, counts)
            hit = np.flatnonzero(rank == level)
            # of pairs that share a symbol every other one, from the left; a pair never reaches into the next word
            new_run = np.r_[True, np.diff(hit) > 1]
            place = np.arange(len(hit))
            at = hit[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]
            merged, own = self.pair_id[pair[at]], owner[at]
            left, right = np.maximum(at - 1, 0), np.minimum(at + 2, len(sym) - 1)
            follows = np.r_[False, at[1:] == at[:-1] + 2]  # the symbol before it has just been merged
            before = np.where(follows, np.r_[merged[:1], merged[:-1]], sym[left])
            ranks = [
                np.where((at > 0) & (owner[left] == own), self.pair_rank[self._find(before, merged)], NO_PAIR),
                np.where((at + 2 < len(sym)) & (owner[right] == own), self.pair_rank[self._find(merged, sym[right])], NO_PAIR),
            ]
            early = (np.minimum(*ranks) <= level[at]).cumsum()
            early = np.r_[0, early[:-1]]  # merges before it, in any word, that make an early pair
            first = np.r_[True, own[1:] != own[:-1]]
            keep = early == np.maximum.accumulate(np.where(first, early, 0))
            at, merged = at[keep], merged[keep]
            sym[at] = merged
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # their places once the right halves are gone
            sym, owner, pair = sym[keep], owner[keep], pair[keep]
            for i in (new, new - 1):
                i = i[(i >= 0) & (i < len(sym) - 1)]
                pair[i] = np.where(owner[i] == owner[i + 1], self._find(sym[i], sym[i + 1]), len(self.pair_key))
            pair[new[new == len(sym) - 1]] = len(self.pair_key)
        sym = np.concatenate([*done_sym, sym])
        owner = np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]
        flat, ends = sym[order].tolist(), [0, *ends.tolist(), len(sym)]
        got = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for i in set(owner[sym >= len(self.pieces)].tolist()):
            got[i] = self._bytes(got[i])
        return got

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, each given once."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))  # like lengths take like numbers of rounds
        start = 0
        while start < len(order):
            stop, n = start, 0
            while stop < len(order) and (stop == start or n + len(words[order[stop]]) <= FLAT):
                n += len(words[order[stop]])
                stop += 1
            for i, ids in zip(order[start:stop], self._rounds([words[i] for i in order[start:stop]]), strict=True):
                out[i] = ids
            start = stop
        return out

    def _bytes(self, symbols: list[int]) -> list[int]:
        """Symbols that are no piece become the bytes of their characters."""
        got: list[int] = []
        for s in symbols:
            if s < len(self.pieces):
                got.append(s)
            else:
                got.extend(self.byte_id[b] for b in (self.loose[s] if s < self.size else chr(s - self.size)).encode())
        return [int(x) for x in got]

    def encode(self, text: str | None) -> list[int]:
        words = self.words(text or "")
        return [i for ids in self.encode_words(words) for i in ids] + [self.eos] if words else [self.eos]

    def pieces_text(self, ids: list[int]) -> str:
        """Text of ids, the dummy prefix still on it. Bytes that are no UTF-8 become U+FFFD one by one."""
        try:
            return "".join([self.shown[i] for i in ids])
        except TypeError:  # there are bytes
            pass
        out, raw = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(raw[i : i + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                i += n
            raw.clear()

        for i in ids:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            flush()
            out.append(self.shown[i])
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The library's decode(ids): the dummy prefix goes if the first piece that shows starts with it."""
        text, first = self.pieces_text(ids), next((i for i in ids if i not in self.silent), self.unk)
        return text[1:] if first != self.unk and self.pieces[first][0] == MARK else text


NO_PAIR = 1 << 40


class _Known:
    """Codes of words: their ids as text, and what they decode to. Forgotten when they outgrow CACHE."""

    def __init__(self, model: PieceBpe):
        self.model, self.codes, self.bytes = model, {}, 0
        self.digits = [str(i) for i in range(len(model.pieces))]

    def __call__(self, words: set[str]) -> dict[str, tuple[str, str]]:
        fresh = list(words - self.codes.keys())
        if self.bytes > CACHE:
            self.codes, self.bytes, fresh = {}, 0, list(words)
        for w, ids in zip(fresh, self.model.encode_words(fresh), strict=True):
            self.codes[w] = got = (" ".join([self.digits[i] for i in ids]), self.model.pieces_text(ids))
            self.bytes += 300 + len(w) + len(got[0]) + len(got[1])
        return self.codes


OUTPUTS = {"ids": "string", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def _coder(model_file: str, outputs: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceBpe(model_file)
        known = _Known(model)
        eos = str(model.eos)
        for batch in batches:
            for part in parts(batch, 1, TEXTS):
                split = [model.words(t or "") for t in part.column(1).to_pylist()]
                codes = known(set().union(*split))
                ids = [" ".join([*[codes[w][0] for w in ws], eos]) for ws in split]
                back = ["".join([codes[w][1] for w in ws]) for ws in split]
                back = [t[1:] if t[:1] == " " else t for t in back]
                got = {"ids": ids, "decoded": back}
                for name, texts in (("ids_sha256", ids), ("decoded_sha256", back)):
                    if name in outputs:
                        got[name] = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                n = pa.array([t.count(" ") + 1 for t in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n, *[pa.array(got[o], pa.string()) for o in outputs]], names=["__id", "n_tokens", *outputs])
        known.codes = {}
        trim()

    return run


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per input row: id, n_tokens, and the outputs, of ids (array of int), decoded, and the SHA-256 of either.

    Null and empty texts give the end id alone and decode to "". Rows are coded one by one, repeated ones included; a null
    id stays null. Only the id and the text are read, whatever other columns there are. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    out = rows.mapInArrow(_coder(model_file, outputs), ", ".join(["__id long", "n_tokens long", *[f"{o} {OUTPUTS[o]}" for o in outputs]]))
    cols = [F.col(c) if c != "ids" else F.split("ids", " ").cast("array<int>").alias("ids") for c in out.columns[1:]]
    return out.select(F.col("__id").alias(id_col), *cols)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
