"""SentencePiece encoding and decoding by batched Viterbi.

The pieces and scores of a SentencePiece model file give the segmentation of
greatest total score (the unigram criterion; for a model trained by merges the
scores are the negative merge ranks). Spaces become U+2581 and one is put in
front. No piece of the models we accept goes on after a word, so texts are cut
into words, each distinct word of a worker is encoded once, and words of one
length advance together: hashes of their substrings probe the sorted hashes of
the pieces, and vectorised maxima keep back pointers. Characters without a
piece become byte pieces.

The criterion "merges" instead repeats the best merge of adjacent symbols, with
the same batches and probes: for models of the merge kind it gives the ids that
the library's encoder gives.

Defined results: a null or empty text has no pieces and decodes to an empty
text; U+2581 in a text decodes as a space, as in the format itself; equal totals
go to the longest last piece; repeated rows each give a row; an empty table
gives an empty result; other columns are ignored, or pass unchanged in a stage.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm import shared

SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_A = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words that a worker keeps, and words of one length that advance together.
KEPT, TOGETHER = 400_000, 1 << 15
UNKNOWN_PENALTY = np.float32(10)
_BITS, _NONE = 20, -(2**30)


def default_model() -> str:
    """The piece file of the public tokenizers on this machine; on a cluster, pass one that all executors have."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


class Pieces:
    """A model's pieces as sorted substring hashes, and its words' encodings so far."""

    def __init__(self, model: bytes, criterion: str = "viterbi"):
        import sentencepiece

        self.cut = {"viterbi": self.best, "merges": self.merged}[criterion]

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [i for i in range(lib.vocab_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        texts = [lib.id_to_piece(i) for i in plain]
        if any(SPACE in t.lstrip(SPACE) for t in texts):
            raise ValueError("a piece goes on after a space")
        scores = np.array([lib.get_score(i) for i in plain], np.float32)
        self.longest = max(map(len, texts))
        hashes = np.array([self._hash(t) for t in texts], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.scores = hashes[order], np.array(plain, np.int32)[order], scores[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have one hash")
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.unknown = scores.min() - UNKNOWN_PENALTY
        self.bytes_at = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.as_bytes = [b""] * lib.vocab_size()
        for i, t in zip(plain, texts):
            self.as_bytes[i] = t.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes_at):
            self.as_bytes[i] = bytes([b])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.begin = np.zeros(1, np.int64)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_A) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h ^ len(text)

    def merged(self, words: list[str]) -> list[np.ndarray]:
        """The piece numbers of words of one length, as the library's merge encoder has them.

        All words merge their best adjacent pair together, the leftmost of equal
        ones, until no pair is a piece.
        """
        n, length = len(words), len(words[0])
        rows, depth = np.arange(n), min(length, self.longest)
        score = np.full((n, length, depth + 1), -np.inf, np.float32)
        number = np.full((n, length, depth + 1), -1, np.int32)
        for end, (row, col, at, width) in enumerate(self._known_substrings(words), 1):
            size = width - col
            score[row, end - size, size] = self.scores[at]
            number[row, end - size, size] = self.ids[at]
        after = np.tile(np.arange(1, length + 1), (n, 1))  # where the symbol that begins here ends; 0: none begins
        while True:
            end = np.where(after > 0, np.take_along_axis(np.pad(after, ((0, 0), (0, 1))), after, axis=1), 0)
            size = end - np.arange(length)
            fits = (after > 0) & (end > 0) & (size <= depth)
            pair = np.where(fits, np.take_along_axis(score, np.where(fits, size, 0)[:, :, None], axis=2)[:, :, 0], np.float32(-np.inf))
            at = pair.argmax(axis=1)
            live = np.flatnonzero(pair[rows, at] > -np.inf)
            if not len(live):
                break
            at, middle = at[live], after[live, at[live]]
            after[live, at] = after[live, middle]
            after[live, middle] = 0
        out = []
        for k, w in enumerate(words):
            begins = np.flatnonzero(after[k])
            found = number[k, begins, after[k, begins] - begins]
            if (found < 0).any():
                found = np.concatenate([self.bytes_at[list(w[b].encode("utf-8", "surrogatepass"))] if i < 0 else [i] for b, i in zip(begins, found)])
            out.append(found.astype(np.int32))
        return out

    def _known_substrings(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """For each end: words, columns (of width, the longest substring first) and sorted positions of the pieces that end there."""
        n, length = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length).astype(np.uint64) + np.uint64(1)
        span = np.zeros((n, 0), np.uint64)
        for end in range(1, length + 1):
            c = chars[:, end - 1]
            span = np.concatenate([span * _A + c[:, None], c[:, None]], axis=1)[:, -self.longest :]
            width = span.shape[1]
            keys = span ^ np.arange(width, 0, -1, dtype=np.uint64)
            row, col = np.nonzero(self.bitmap[(keys >> np.uint64(64 - _BITS)).astype(np.int64)])
            probe = keys[row, col]
            at = np.minimum(np.searchsorted(self.hashes, probe), len(self.hashes) - 1)
            hit = self.hashes[at] == probe
            yield row[hit], col[hit], at[hit], width

    def best(self, words: list[str]) -> list[np.ndarray]:
        """The piece numbers of words of one length."""
        n, length = len(words), len(words[0])
        score = np.full((length + 1, n), -np.inf, np.float32)
        score[0] = 0
        back = np.zeros((length + 1, n), np.int32)
        piece = np.full((length + 1, n), -1, np.int32)
        rows = np.arange(n)
        for end, (row, col, at, width) in enumerate(self._known_substrings(words), 1):
            own = np.full((n, width), -np.inf, np.float32)
            ids = np.full((n, width), -1, np.int32)
            own[row, col] = self.scores[at]
            ids[row, col] = self.ids[at]
            own[:, -1] = np.where(ids[:, -1] < 0, self.unknown, own[:, -1])
            total = own + score[end - width : end].T
            choice = total.argmax(axis=1)
            score[end] = total[rows, choice]
            back[end] = end - width + choice
            piece[end] = ids[rows, choice]
        return self._traced(words, back, piece)

    def _traced(self, words: list[str], back: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
        """Follow the back pointers of all words together; characters without a piece are put in afterwards."""
        n, rows = len(words), np.arange(len(words))
        at, steps = np.full(n, len(back) - 1), []
        while at.any():
            steps.append(np.where(at > 0, np.where(piece[at, rows] >= 0, piece[at, rows], -at), _NONE))
            at = np.where(at > 0, back[at, rows], 0)
        table = np.stack(steps[::-1], axis=1)
        used = table != _NONE
        out = np.split(table[used], np.cumsum(used.sum(axis=1))[:-1])
        for k in np.flatnonzero(((table < 0) & used).any(axis=1)):
            parts = [self.bytes_at[list(words[k][-i - 1].encode("utf-8", "surrogatepass"))] if i < 0 else [i] for i in out[k].tolist()]
            out[k] = np.concatenate(parts)
        return [x.astype(np.int32) for x in out]

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, those of one length together."""
        groups = defaultdict(list)
        for w in words:
            groups[len(w)].append(w)
        lengths, flat = [], []
        at = len(self.known)
        for length, members in groups.items():
            step = max(1, min(TOGETHER, (1 << 22) // (length * 8)))
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for w, ids in zip(part, self.cut(part)):
                    self.known[w] = at
                    at += 1
                    lengths.append(len(ids))
                    flat.append(ids)
        if flat:
            self.flat = np.concatenate([self.flat, *flat])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(lengths)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > KEPT:
            self.clear()
        cut = [_UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known) if cut else set()
        if new:
            self.learn(sorted(new))
        out = []
        for words in cut:
            u = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            first = self.begin[u]
            n = self.begin[u + 1] - first
            step = np.cumsum(n)
            at = np.repeat(first - (step - n), n) + np.arange(step[-1] if len(step) else 0)
            out.append(self.flat[at])
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.as_bytes.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _pieces(model: bytes, criterion: str) -> Pieces:
    return Pieces(model, criterion)


#: Characters of texts that are encoded at once.
SLICE = 1 << 20


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield begin, k + 1
            begin, size = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encoded(docs: DataFrame, model: bytes | None = None, criterion: str = "viterbi") -> DataFrame:
    """(doc_id, n_pieces, ids_sha256, round_trip): ids are hashed as little-endian 32-bit integers."""
    data = model if model is not None else Path(default_model()).read_bytes()
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(sent.value, criterion)
        for part in parts:
            texts, rows = part["text"].tolist(), []
            for b, e in _slices(texts):
                for t, ids in zip(texts[b:e], pieces.encode(texts[b:e])):
                    same = pieces.decode(ids) == t.replace(SPACE, " ")
                    rows.append((len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), same))
            out = pd.DataFrame(rows, columns=["n_pieces", "ids_sha256", "round_trip"])
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            yield out

    return shared.mapped(shared.whole_text(docs, "doc_id"), run, "doc_id long, n_pieces long, ids_sha256 string, round_trip boolean")


def with_pieces(docs: DataFrame, model: bytes | None = None, criterion: str = "viterbi") -> DataFrame:
    """docs with the column pieces, the numbers of its text's pieces, in place of a column of that name; text becomes what they decode to."""
    import pyarrow as pa

    data = model if model is not None else Path(default_model()).read_bytes()
    sent = docs.sparkSession.sparkContext.broadcast(data)
    docs = docs.select(*[docs[c] for c in docs.columns if c != "pieces"])
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent.value, criterion)
        for part in parts:
            texts = [t or "" for t in part.column(at).to_pylist()]
            for b, e in _slices(texts):
                ids = pieces.encode(texts[b:e])
                columns = [c.slice(b, e - b) for c in part.columns]
                columns[at] = pa.array([pieces.decode(i) for i in ids], columns[at].type)
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "pieces"])

    return docs.mapInArrow(run, schema)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
