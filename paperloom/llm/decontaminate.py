"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive tokens whose zeros are ignored, so that
a passage with substituted words still shares masked hashes with the benchmark.
The hashes of the benchmark and of the documents are joined, and each hit is
verified along its diagonal: the passages overlap if some window of WINDOW
tokens (or the whole item, if shorter) has IDENTITY of its tokens equal, place
by place. The seeds are chosen so that every overlap of that kind is hit: each
arrangement of the allowed substitutions in a window, or in a shorter item,
leaves the ones of some seed untouched.

Tokens are lower-cased runs of letters and digits. Items are dealt into blocks
of bounded size; each block is one pass over the documents, so a benchmark of
any size fits in memory.

Defined results: items with fewer than MIN_ITEM tokens take no part; null texts
are empty; rows that repeat a doc_id and text have the same result; an empty
benchmark marks nothing; an empty table gives an empty result; other columns
are ignored, or pass unchanged where rows are filtered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

#: Seeds of whole windows: weight 7 or 8 within 11 or 12 tokens; covering() adds what they leave.
MASKS = ("11101100111", "110110011011", "111011010011", "11111111")
WINDOW, IDENTITY, MIN_ITEM = 13, 0.8, 3
#: Characters of benchmark text in a block.
BLOCK_CHARS = 8_000_000
#: Tokens of documents that are hashed at once.
CHUNK = 1 << 20
#: Contaminated documents up to which their keys are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
_TOKEN = re.compile(r"[^\W_]+")
_BITS = 22


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def allowed(n: int) -> int:
    """Tokens of n that may differ."""
    return n - int(np.ceil(IDENTITY * n - 1e-9))


@lru_cache
def covering(n: int, masks: tuple[str, ...] = ()) -> tuple[str, ...]:
    """masks, and more of weight 4 to 6, so that every arrangement of the allowed substitutions in n tokens leaves one untouched at some place."""
    lost = allowed(n)
    weight = max(min(4, n), min(6, n - lost - 1))
    tries = ["".join("1" if k in ones else "0" for k in range(max(ones) + 1)) for rest in combinations(range(1, n), weight - 1) if (ones := {0, *rest})]

    def hit(mask: str) -> set[tuple[int, ...]]:
        places = [{at + k for k, x in enumerate(mask) if x == "1"} for at in range(n - len(mask) + 1)]
        return {a for a in arrangements if any(p.isdisjoint(a) for p in places)}

    arrangements = set(combinations(range(n), lost))
    chosen = list(masks)
    for mask in masks:
        arrangements -= hit(mask)
    while arrangements:
        best = max(tries, key=lambda mask: len(hit(mask)))
        chosen.append(best)
        arrangements -= hit(best)
    return tuple(chosen)


def _randoms(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False) | np.uint64(1)


class SeedIndex:
    """Masked hashes of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        words = [(i, tokens(text or "")) for i, text in items]
        words = [(i, w) for i, w in words if len(w) >= MIN_ITEM]
        self.vocabulary: dict[str, int] = {}
        name = self.vocabulary.setdefault
        self.ids = [i for i, _ in words]
        self.items = [np.array([name(x, len(self.vocabulary) + 1) for x in w], np.int64) for _, w in words]
        self.randoms = _randoms(len(self.vocabulary) + 1, 1)
        seeds = [(m, WINDOW) for m in covering(WINDOW, masks)]
        seeds += [(m, n) for n in sorted({len(w) for w in self.items if len(w) < WINDOW}) for m in covering(n)]
        self.masks = [np.flatnonzero(np.array(list(m)) == "1") for m, _ in seeds]
        self.tables = []
        for mask, (_, size) in zip(self.masks, seeds):
            found = []
            for k, w in enumerate(self.items):
                if min(WINDOW, len(w)) == size:
                    h = self.hashes(w, mask)
                    found.append((h, np.full(len(h), k), np.arange(len(h))))
            h, k, at = map(np.concatenate, zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
            order = np.argsort(h, kind="stable")
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.tables.append((h[order], k[order], at[order], bitmap))

    def hashes(self, w: np.ndarray, mask: np.ndarray) -> np.ndarray:
        n = max(0, len(w) - int(mask[-1]))
        out = np.zeros(n, np.uint64)
        r = self.randoms[w]
        for j, at in enumerate(mask):
            out = out * np.uint64(0x9E3779B97F4A7C15) + r[at : at + n] if j else r[at : at + n].copy()
        return out ^ (out >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)

    def hits(self, w: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Distinct (item, diagonal, text) of all seeds' hits; the diagonal is the item's start among the tokens."""
        out = []
        for mask, (h, k, at, bitmap) in zip(self.masks, self.tables):
            mine = self.hashes(w, mask)
            maybe = np.flatnonzero(bitmap[(mine >> np.uint64(64 - _BITS)).astype(np.int64)])
            low, high = np.searchsorted(h, mine[maybe]), np.searchsorted(h, mine[maybe], "right")
            n = high - low
            pos = np.repeat(maybe, n)
            entry = np.repeat(low, n) + np.arange(len(pos)) - np.repeat(np.cumsum(n) - n, n)
            text = np.searchsorted(begins, pos, "right") - 1
            out.append(np.stack([k[entry].astype(np.int64), pos - at[entry].astype(np.int64), text], axis=1))
        return np.unique(np.concatenate(out), axis=0)

    def verify(self, w: np.ndarray, item: int, start: int, begin: int, end: int) -> tuple[int, int, int] | None:
        """(first token, end, equal tokens) of the windows that overlap within w[begin:end], or None."""
        own = self.items[item]
        low, high = max(start, begin), min(start + len(own), end)
        size = min(WINDOW, len(own))
        if high - low < size:
            return None
        same = np.concatenate(([0], np.cumsum(w[low:high] == own[low - start : high - start])))
        good = np.flatnonzero(same[size:] - same[:-size] >= IDENTITY * size - 1e-9)
        if not len(good):
            return None
        first, last = int(good[0]), int(good[-1]) + size
        return low - begin + first, low - begin + last, int(same[last] - same[first])


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """(doc_id, tkey, item_id, first, end, equal): verified overlaps in tokens; tkey is the text's hash."""
    spark = docs.sparkSession
    test = shared.whole_text(benchmark, "item_id").where("item_id is not null")
    chars = test.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    keyed = shared.whole_text(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    schema = "doc_id long, tkey long, item_id long, first long, end long, equal long"
    found = []
    for block in range(blocks):
        part = test.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = spark.sparkContext.broadcast(SeedIndex([tuple(r) for r in part.collect()], masks))

        def scan(parts: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            seeds = index.value
            known = seeds.vocabulary.get

            def flush(rows: list, words: list) -> pd.DataFrame:
                w = np.concatenate(words)
                begins = np.cumsum([0, *[len(x) for x in words[:-1]]])
                ends = begins + np.array([len(x) - 1 for x in words])
                out = []
                for item, start, d in seeds.hits(w, begins).tolist():
                    if span := seeds.verify(w, item, start, int(begins[d]), int(ends[d])):
                        out.append((*rows[d], seeds.ids[item], *span))
                return pd.DataFrame(out, columns=["doc_id", "tkey", "item_id", "first", "end", "equal"])

            rows, words, size = [], [], 0
            for part in parts:
                for doc_id, tkey, text in zip(part["doc_id"], part["tkey"], part["text"]):
                    ids = [known(x, 0) for x in tokens(text)]
                    ids.append(0)
                    rows.append((doc_id, tkey))
                    words.append(np.array(ids, np.int64))
                    size += len(ids)
                    if size >= CHUNK:
                        yield flush(rows, words)
                        rows, words, size = [], [], 0
            if rows:
                yield flush(rows, words)

        found.append(shared.stored(shared.mapped(keyed, scan, schema), "seed-hits")[0])
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, item_ids, n_overlaps, longest): one row per row of docs."""
    hits = overlaps(docs, benchmark).groupBy("doc_id", "tkey").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.countDistinct("item_id", "first").alias("n_overlaps"),
        F.max(F.col("end") - F.col("first")).alias("longest"),
    )
    keys = docs.select(docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("tkey"))
    joined = keys.alias("k").join(hits.alias("h"), F.expr("k.doc_id <=> h.doc_id and k.tkey = h.tkey"), "left")
    return joined.select(
        "k.doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("n_overlaps", F.lit(0)).alias("n_overlaps"), F.coalesce("longest", F.lit(0)).alias("longest"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any overlap."""
    bad, _ = shared.stored(overlaps(docs, benchmark).select(F.col("doc_id").alias("id"), "tkey").distinct(), "seed-bad")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    # rows travel as structs, so that no column of theirs can clash
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("here")).alias("d")
    left = own.join(bad.alias("b"), F.expr("d.row.doc_id <=> b.id and d.here = b.tkey"), "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return mark(read("documents"), read("benchmark"))
