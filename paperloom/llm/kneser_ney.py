"""Interpolated modified Kneser-Ney scoring, trigrams by default.

A first pass counts the words and numbers them, frequent words first. A second
counts n-grams of these numbers: workers send each shard (by context hash) the
counts of a chunk, a shard's task adds them up and writes sorted hash arrays to
the shared folder, and what it knows of the next lower order goes on to shards
of that order, down to the words. Workers that score memory-map the arrays
read-only, one shard at a time, so a model of any size costs them no memory of
their own. The shared folder must be mounted as a file system for that.

A sorted hash array holds 32 bits of each hash; the shard and a bucket of about
16 hashes stand for those above. An n-gram never seen is taken for another with
a probability of some 4 in 10**9. A context is kept only where it counts more
than once: another that is itself an n-gram of the next lower order counts once.

Tokens: ASCII white space splits words, A-Z are lower-cased, an end token
follows the last word, start tokens stand before the first. Orders below the
highest count distinct tokens to the left; an n-gram that begins with a start
token, which nothing else precedes, keeps its count. Words interpolate with the
uniform distribution over the V known tokens and one unknown.

Defined results: a null text is empty and has one token, the end; repeated rows
count and are scored as often as they occur; a null doc_id hashes as an empty
string; with no training rows every token has the uniform probability; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

FOLDS, HELD = 5, 1
ORDER = 3
#: Tokens counted or scored at once by a worker.
CHUNK = 1 << 21
#: Bytes of text for each shard, so that a counting task holds what its memory allows at any size of the corpus.
SHARD_BYTES = 1 << 24
END = np.uint64(0xC3A5C85C97CB3127)
#: The number of the start token; words have larger ones.
START = 0
#: Hashes of a bucket, about, as a power of two.
BUCKET = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the words, then of the end token."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (u ^ (u >> np.uint64(29))) * _MIX + w
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def context_keys(columns: list[np.ndarray]) -> np.ndarray:
    key = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        key = pair_keys(key, column.astype(np.uint64) + _MIX)
    return key


def gram_keys(context: np.ndarray, w: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Keys whose upper bits are the context's, so that they sort by shard."""
    bits = np.uint64(64) - shift
    return (context >> shift << shift) | (pair_keys(context, w.astype(np.uint64) + _MIX) >> bits)


def windows(w: np.ndarray, begins: np.ndarray, order: int) -> list[np.ndarray]:
    """Columns of the n-grams that end at every token; the start token fills what lies before a text."""
    columns = [w]
    for _ in range(order - 1):
        back = np.empty_like(columns[0])
        back[1:] = columns[0][:-1]
        back[begins] = START
        columns.insert(0, back)
    return columns


def _begins(tokens: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *[len(t) for t in tokens[:-1]]])


def _composite(columns: list[np.ndarray]) -> np.ndarray:
    """One key for columns of numbers, in their lexicographic order."""
    d = max(int(x.max(initial=0)) for x in columns) + 1
    key, size = columns[0].astype(np.uint64), d
    for column in columns[1:]:
        if size * d >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            size = len(key)
        key = key * np.uint64(d) + column.astype(np.uint64)
        size *= d
    return key


def _firsts(ranked: np.ndarray) -> np.ndarray:
    """Where a value begins in sorted values."""
    return np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): order sorts the keys, first has the positions in it where a key begins."""
    order = np.argsort(keys)
    return order, _firsts(keys[order])


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, each as the planes of its bytes, as many as its largest value needs."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        width = max(1, -(-int(column.max(initial=0)).bit_length() // 8))
        planes = column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        parts += [bytes([width]), np.ascontiguousarray(planes).tobytes()]
    return b"".join(parts)


def _unpack(blob: bytes, n: int, at: int = 0) -> tuple[list[np.ndarray], int]:
    """n columns packed at a place of blob, and the place behind them."""
    size, out = int.from_bytes(blob[at : at + 8], "little"), []
    at += 8
    for _ in range(n):
        width = blob[at]
        full = np.zeros((size, 4 if width <= 4 else 8), np.uint8)
        full[:, :width] = np.frombuffer(blob, np.uint8, width * size, at + 1).reshape(width, size).T
        out.append(full.view("<u4" if width <= 4 else "<u8")[:, 0])
        at += 1 + width * size
    return out, at


def _slices(shard: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    cuts = np.searchsorted(shard, np.arange(n + 1))
    return [(k, int(b), int(e)) for k, (b, e) in enumerate(zip(cuts, cuts[1:])) if e > b]


def _blobs(shard: np.ndarray, n: int, *columns: np.ndarray) -> pd.DataFrame:
    """(shard, blob) of rows sorted by shard."""
    rows = [(k, zstandard.compress(_pack(*(x[b:e] for x in columns)), 1)) for k, b, e in _slices(shard, n)]
    return pd.DataFrame(rows, columns=["shard", "blob"])


def _columns(parts: Iterator[pd.DataFrame], n: int) -> tuple | None:
    """(shard, columns) of the blobs of one shard; None where nothing came."""
    shard, found = None, []
    for part in parts:
        for at_shard, blob in zip(part["shard"], part["blob"]):
            shard = int(at_shard)
            found.append(_unpack(zstandard.decompress(blob), n)[0])
    return None if shard is None else (shard, [np.concatenate(x) for x in zip(*found)])


def _sent(columns: list[np.ndarray], values: list[np.ndarray], shift: np.uint64, n: int) -> pd.DataFrame:
    """(shard, blob) of n-grams sorted by their columns: each context once, with the number of its n-grams."""
    heads = columns[:-1]
    change = np.zeros(len(heads[0]), bool)
    change[:1] = True
    for x in heads:
        change[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(change)
    runs = np.diff(np.append(first, len(change)))
    heads = [x[first] for x in heads]
    shard = (context_keys(heads) >> shift).astype(np.uint16 if n <= 1 << 16 else np.uint32)
    by = np.argsort(shard, kind="stable")
    by_gram = np.argsort(np.repeat(shard, runs), kind="stable")
    ends = np.append(0, np.cumsum(runs[by]))
    rows = []
    for k, b, e in _slices(shard[by], n):
        c, g = by[b:e], by_gram[ends[b] : ends[e]]
        blob = _pack(*(x[c] for x in heads), runs[c]) + _pack(columns[-1][g], *(v[g] for v in values))
        rows.append((k, zstandard.compress(blob, 1)))
    return pd.DataFrame(rows, columns=["shard", "blob"])


def _received(parts: Iterator[pd.DataFrame], k: int, n_values: int) -> tuple | None:
    """(shard, columns, values) of what _sent sent to one shard; None where nothing came."""
    shard, found = None, []
    for part in parts:
        for at_shard, blob in zip(part["shard"], part["blob"]):
            shard, plain = int(at_shard), zstandard.decompress(blob)
            (*heads, runs), at = _unpack(plain, k)
            tails, _ = _unpack(plain, 1 + n_values, at)
            found.append([*(np.repeat(x, runs.astype(np.int64)) for x in heads), *tails])
    if shard is None:
        return None
    out = [np.concatenate(x) for x in zip(*found)]
    return shard, out[:k], [x.astype(np.int64) for x in out[k:]]


def _summed(columns: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Distinct n-grams in order, the sums of their values, and how many rows each had."""
    order, first = _groups(_composite(columns))
    at = order[first]
    return [x[at] for x in columns], [np.add.reduceat(v[order], first) for v in values], np.diff(np.append(first, len(order)))


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """A task that runs again replaces its files by the same ones."""
    part = f"{folder}/.{name}.{os.getpid()}.{np.random.default_rng().integers(1 << 62)}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, f"{folder}/{name}.npy")


def _parts(keys: np.ndarray, shift: np.uint64, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, next 32 bits) of keys whose bits from shift on are the shard."""
    rest = keys << (np.uint64(64) - shift)
    bucket = rest >> np.uint64(64 - bits) if bits else np.zeros_like(rest)
    return bucket.astype(np.int64), (rest << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


def _save_table(folder: str, name: str, keys: np.ndarray, shift: np.uint64, **values: np.ndarray) -> None:
    """A sorted hash array of one shard and the values of its keys."""
    by = np.argsort(keys)
    bits = (len(keys) >> BUCKET).bit_length()
    bucket, low = _parts(keys[by], shift, bits)
    ends = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    _save(folder, f"{name}-ends", ends.astype(np.uint32 if len(keys) < 1 << 32 else np.uint64))
    _save(folder, f"{name}-keys", low)
    for value, x in values.items():
        _save(folder, f"{name}-{value}", _small(x[by]))


def _look_up(keys: np.ndarray, ends: np.ndarray, low: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(which of the keys are known, where), by binary searches of all buckets together."""
    bucket, want = _parts(keys, shift, (len(ends) - 1).bit_length() - 1)
    b, stop = ends[bucket].astype(np.int64), ends[bucket + 1].astype(np.int64)
    e, last = stop, len(low) - 1
    for _ in range(int((stop - b).max(initial=0)).bit_length()):
        mid = (b + e) >> 1
        less = (b < e) & (low[np.minimum(mid, last)] < want)
        b, e = np.where(less, mid + 1, b), np.where(less, e, np.minimum(mid, e))
    hit = np.flatnonzero((b < stop) & (low[np.minimum(b, last)] == want))
    return hit, b[hit]


def train(docs: DataFrame, shards: int | None = None, order: int = ORDER) -> dict:
    """Count the texts of docs; returns the model: its folder, order, shards, totals and discounts.

    shards is a power of two and bounds what a counting task holds; by default
    it follows the bytes of the texts, with at least spark.sql.shuffle.partitions.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    texts = shared.whole_text(docs)
    want = shards
    if not want:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        want = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    bits = max(1, (want - 1).bit_length())
    n, shift = 1 << bits, np.uint64(64 - bits)
    path = shared.table_path(spark, "kneser-ney")
    folder = shared.local_path(path)
    os.makedirs(folder)
    shared.when_done_forget(spark, path)

    def chunks(parts: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
        held, size = [], 0
        for part in parts:
            for text in part["text"]:
                held.append(token_hashes(text))
                size += len(held[-1])
                if size >= CHUNK:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def chunk_words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tokens in chunks(parts):
            known, c = np.unique(np.concatenate(tokens), return_counts=True)
            yield _blobs(known >> shift, n, known, c)

    def numbered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Words of a shard by falling counts: rank r of shard s has the number 1 + r n + s."""
        came = _columns(parts, 2)
        if came is None:
            return
        shard, (w, c) = came
        order, first = _groups(w)
        w, c = w[order[first]], np.add.reduceat(c[order].astype(np.int64), first)
        by = np.argsort(-c, kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        _save(folder, f"word-{shard}", w)
        _save(folder, f"word-rank-{shard}", _small(rank))
        _save(folder, f"word-total-{shard}", _small(c[by]))
        yield pd.DataFrame([[len(w), int(c.sum())]], columns=["v", "n"])

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tokens in chunks(parts):
            known, back = np.unique(np.concatenate(tokens), return_inverse=True)
            columns = windows(word_numbers(folder, known, shift, n)[0][back], _begins(tokens), order)
            columns, _, c = _summed(columns, [])
            yield _sent(columns, [c], shift, n)

    def level(k: int):
        """The task that keeps the k-grams of a shard and sends on what the next lower order needs: rows to the left, and counts."""

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            came = _received(parts, k, 1 if k == order else 2)
            if came is None:
                return
            shard, columns, values = came
            columns, values, _ = _summed(columns, values)
            c, total = values[0], values[-1]
            if k < order:
                c = np.where(columns[0] == START, total, c)
            context = context_keys(columns[:-1])
            _save_table(folder, f"gram-{k}-{shard}", gram_keys(context, columns[-1], shift), shift, count=c)
            _save(folder, f"gram-stats-{k}-{shard}", np.array([(c == x).sum() for x in (1, 2, 3, 4)], np.int64))
            first = _firsts(context)
            sums = [np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c > 2)]
            kept = (sums[0] > 1) | (columns[0][first] == START)
            _save_table(folder, f"context-{k}-{shard}", context[first][kept], shift, total=sums[0][kept], kinds=np.stack(sums[1:], axis=1)[kept])
            del context, sums
            if k > 2:
                lower, (total,), left = _summed(columns[1:], [total])
                yield _sent(lower, [left, total], shift, n)
            else:
                (w,), _, left = _summed(columns[1:], [])
                to = (w.astype(np.int64) - 1) % n
                by = np.argsort(to, kind="stable")
                yield _blobs(to[by], n, w[by], left[by])

        return run

    def words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        came = _columns(parts, 2)
        if came is None:
            return
        shard, (w, more) = came
        left = np.zeros(len(np.load(f"{folder}/word-total-{shard}.npy", mmap_mode="r")), np.int64)
        np.add.at(left, (w.astype(np.int64) - 1) // n, more.astype(np.int64))
        _save(folder, f"word-left-{shard}", _small(left))
        yield pd.DataFrame([[int(left.sum()), *(int((left == k).sum()) for k in (1, 2, 3, 4))]], columns=["left", "m1", "m2", "m3", "m4"])

    def sums(of: DataFrame, task, columns: str):
        made = of.repartitionById(n, F.col("shard")).mapInPandas(task, ", ".join(f"{c} long" for c in columns.split()))
        return made.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in made.columns]).first()

    blob = "shard int, blob binary"
    all_words = sums(texts.mapInPandas(chunk_words, blob), numbered, "v n")
    sent = texts.mapInPandas(count, blob)
    for k in range(order, 1, -1):
        sent = sent.repartitionById(n, F.col("shard")).mapInPandas(level(k), blob)
    row = {**all_words.asDict(), **sums(sent, words, "left m1 m2 m3 m4").asDict()}
    cuts = {1: discounts(row["m1"], row["m2"], row["m3"], row["m4"])}
    for k in range(2, order + 1):
        files = (f"{folder}/gram-stats-{k}-{shard}.npy" for shard in range(n))
        cuts[k] = discounts(*np.sum([np.zeros(4), *(np.load(f) for f in files if os.path.exists(f))], axis=0))
    # what the words' discounts leave to the uniform distribution
    taken = np.array([row["m1"], row["m2"], row["v"] - row["m1"] - row["m2"]]) @ np.array(cuts[1])
    return {
        "folder": folder, "order": order, "shards": n, "shift": int(shift), "v": row["v"], "n": row["n"], "left": row["left"],
        "low_mass": float(taken) / row["left"] if row["left"] else 1.0, "discounts": cuts,
    }


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Chen and Goodman's discounts of counts 1, 2 and 3 or more, within 0 and the count."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [k - (k + 1) * y * b / a if a else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(float(min(max(d, 0.0), k)) for k, d in enumerate(raw, 1))


def _map(folder: str, name: str) -> np.ndarray | None:
    path = f"{folder}/{name}.npy"
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def word_numbers(folder: str, known: np.ndarray, shift: np.uint64, n: int, *values: str) -> tuple[np.ndarray, ...]:
    """The numbers of sorted word hashes, zero where a word is not known, and what is kept of the words."""
    numbers = np.zeros(len(known), np.int64)
    outs = [np.zeros(len(known), np.int64) for _ in values]
    for k, b, e in _slices(known >> shift, n):
        at = _map(folder, f"word-{k}")
        if at is not None:
            pos = np.minimum(np.searchsorted(at, known[b:e]), len(at) - 1)
            hit = np.flatnonzero(at[pos] == known[b:e])
            rank = _map(folder, f"word-rank-{k}")[pos[hit]].astype(np.int64)
            numbers[b + hit] = 1 + rank * n + k
            for out, value in zip(outs, values):
                out[b + hit] = _map(folder, f"word-{value}-{k}")[rank]
    return numbers, *outs


class Model:
    """The arrays of a trained model; those of a shard are memory-mapped while it is searched."""

    def __init__(self, told: dict):
        self.__dict__.update(told)

    def _find(self, keys: np.ndarray, name: str, **values: int) -> list[np.ndarray]:
        """The values of sorted keys, with their numbers of columns; zero where a key is not known."""
        shift = np.uint64(self.shift)
        outs = [np.zeros((len(keys), width) if width > 1 else len(keys), np.int64) for width in values.values()]
        for k, b, e in _slices(keys >> shift, self.shards):
            low = _map(self.folder, f"{name}-{k}-keys")
            if low is not None and len(low):
                hit, pos = _look_up(keys[b:e], _map(self.folder, f"{name}-{k}-ends"), low, shift)
                for out, value in zip(outs, values):
                    out[b + hit] = _map(self.folder, f"{name}-{k}-{value}")[pos]
        return outs

    def score(self, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: log10 probability, base score, known tokens."""
        begins, shift = _begins(tokens), np.uint64(self.shift)
        known, back = np.unique(np.concatenate(tokens), return_inverse=True)
        number, total, left = word_numbers(self.folder, known, shift, self.shards, "total", "left")
        base = np.log10((total + 0.5) / (self.n + 0.5 * (self.v + 1)))
        p = _interpolated(left, self.left, self.discounts[1], 1 / (self.v + 1), self.low_mass)[back]
        # the start token has the number 0 too, but stands only where no word can
        w, c = np.where(number > 0, number, -1)[back], total[back]
        columns = windows(w, begins, self.order)
        for k in range(2, self.order + 1):
            # a context is known if it is an n-gram itself, or stands at the begin of a text
            seen = np.empty(len(c), bool)
            seen[1:] = c[:-1] > 0
            seen[begins] = self.n > 0
            at = np.flatnonzero(seen)
            context = context_keys([x[at] for x in columns[self.order - k : -1]])
            order, first = _groups(context)
            of_total, kinds = self._find(context[order[first]], f"context-{k}", total=1, kinds=3)
            once = of_total == 0
            of_total[once], kinds[once, 0] = 1, 1
            of = np.empty(len(at), np.int64)
            of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
            c = np.zeros(len(w), np.int64)
            can = np.flatnonzero(w[at] > 0)
            keys = gram_keys(context[can], w[at[can]], shift)
            by = np.argsort(keys)
            (c[at[can[by]]],) = self._find(keys[by], f"gram-{k}", count=1)
            mass = (kinds @ np.array(self.discounts[k])) / of_total
            p[at] = _interpolated(c[at], of_total[of], self.discounts[k], p[at], mass[of])
        add = lambda x: np.add.reduceat(x, begins)
        return add(np.log10(p)), add(base[back]), add((number > 0)[back].astype(np.int64))


def _interpolated(c: np.ndarray, total, discount: tuple, lower, mass) -> np.ndarray:
    taken = np.array((0.0, *discount))[np.minimum(c, 3)]
    return np.maximum(c - taken, 0) / np.maximum(total, 1) + mass * lower


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, score, base_score): one row per row of docs."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps = Model(model)

        def flush(ids: list, tokens: list) -> pd.DataFrame:
            p, base, known = maps.score(tokens)
            return pd.DataFrame({"doc_id": ids, "n_tokens": [len(t) for t in tokens], "n_known": known, "score": p, "base_score": base})

        ids, tokens, size = [], [], 0
        for part in parts:
            for doc_id, text in zip(part["doc_id"], part["text"]):
                ids.append(doc_id)
                tokens.append(token_hashes(text))
                size += len(tokens[-1])
                if size >= CHUNK:
                    yield flush(ids, tokens)
                    ids, tokens, size = [], [], 0
        if ids:
            yield flush(ids, tokens)

    return shared.mapped(shared.whole_text(docs, "doc_id"), run, "doc_id long, n_tokens long, n_known long, score double, base_score double")


def fold(of: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def op8_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(fold(FOLDS) != HELD))
    return score(docs, model).select(
        "doc_id", (fold(FOLDS) == HELD).alias("held_out"), "n_tokens", "n_known",
        F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score",
    )
