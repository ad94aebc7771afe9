"""SimHash near-deduplication by tiled exact comparison.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles. Fingerprints within a Hamming radius are linked and documents take the
smallest identifier of their connected group.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; repeated rows each give a row; a
null doc_id links like any other but is no component, which is null where all are;
an empty table gives an empty result; other columns are ignored.

similar() links texts by the Jaccard similarity of their sets of word shingles:
fingerprints within a wide radius are candidates only, and each is checked on
the sets themselves. A text of up to a shingle's words has one shingle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Mean number of fingerprints of a block; a task compares two blocks.
BLOCK = 65_536
#: Fingerprints of one side of a tile within a task.
TILE = 512
#: Hashes that are turned into bits at once.
CHUNK = 1 << 17
#: Of random sets with a Jaccard similarity of 0.8, 99 of 100 have fingerprints within these bits (98.8 % at 1000 shingles, 99.5 % at 9).
WIDE_RADIUS = 16
#: Numbers of shingles up to which there are levels.
MOST_SHINGLES = 1 << 40
#: Shingle hashes that a task holds in memory beyond those of one check.
HELD = 1 << 22


def text_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased (A-Z) ASCII-white-space words, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), seed)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    return np.fromiter((digest(line[b:e], seed) for b, e in zip(begins, stops)), np.uint64, len(stops))


def majority(hashes: np.ndarray) -> int:
    """Unsigned 64-bit integer whose bit is set where over half of the hashes have it."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            fps = [majority(text_hashes(t, size, seed)) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "fp": np.array(fps, np.uint64).view(np.int64)})

    return shared.mapped(shared.whole_text(docs, "doc_id"), run, "doc_id long, fp long")


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect what all pairs of (id, fp) within the radius connect; fp must be distinct.

    Fingerprints are blocked by population count, hashed into sub-blocks where a
    count is frequent. Only block pairs whose counts differ by the radius at most
    are compared, each in one task, which returns a spanning forest of the links
    it found and never the pairs themselves.
    """
    sent = _block_pairs(prints.select("id", "fp", F.bit_count("fp").cast("int").alias("pop")), "pop", radius, block)
    if sent is None:
        return prints.select(F.col("id").alias("a"), F.col("id").alias("b"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ids, fps = rows["id"].to_numpy(np.int64), rows["fp"].to_numpy(np.int64).view(np.uint64)
        side = rows["right"].to_numpy(bool)
        parent = forest(fps, side, key[0] == key[1], radius)
        joined = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"a": ids[joined], "b": ids[parent[joined]]})

    return sent.groupBy("x", "y").applyInPandas(compare, "a long, b long")


def _block_pairs(prints: DataFrame, by: str, reach: int, block: int) -> DataFrame | None:
    """The rows once for each pair of blocks (x, y) that they take part in; right tells the side. None without rows.

    Values of the column by are blocks, or several where they are frequent; blocks whose values differ by reach at most are paired.
    """
    subs = {r[by]: -(-r["n"] // block) for r in prints.groupBy(by).agg(F.count("*").alias("n")).collect()}
    if not subs:
        return None
    # at most some hundred rows: blocks get consecutive numbers, ordered by value
    first, total = {}, 0
    for value in sorted(subs):
        first[value], total = total, total + subs[value]
    at = F.create_map(*[F.lit(x) for p in first for x in (p, first[p])])
    n_sub = F.create_map(*[F.lit(x) for p in subs for x in (p, subs[p])])
    low = {p: min(first[q] for q in first if abs(p - q) <= reach) for p in first}
    high = {p: max(first[q] + subs[q] - 1 for q in first if abs(p - q) <= reach) for p in first}
    low_of = F.create_map(*[F.lit(x) for p in low for x in (p, low[p])])
    high_of = F.create_map(*[F.lit(x) for p in high for x in (p, high[p])])
    own = (at[F.col(by)] + F.pmod(F.xxhash64("fp"), n_sub[F.col(by)]).cast("int")).cast("int")
    spread = prints.withColumn("own", own).withColumn("other", F.explode(F.sequence(low_of[F.col(by)], high_of[F.col(by)])))
    sides = F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("right")
    return spread.select(*[c for c in prints.columns if c != by], *sides)


def forest(fps: np.ndarray, right: np.ndarray, same: bool, radius: int, tile: int = TILE) -> np.ndarray:
    """Union-find parents after comparing the left with the right fingerprints (same: all with each other).

    Both sides are sorted by the population counts of their four 16-bit words. A
    pair's counts differ by its Hamming distance at most, so a tile pair is skipped
    when its ranges of counts lie further apart, summed over words.
    """
    parent = np.arange(len(fps))
    words = np.ascontiguousarray(fps).view("<u2").reshape(-1, 4)
    pops = np.bitwise_count(words).astype(np.int16)
    order = np.lexsort((pops[:, 3], pops[:, 2], pops[:, 1], pops[:, 0]))
    sides = (order, order) if same else (order[~right[order]], order[right[order]])

    def tiles(index: np.ndarray) -> list:
        out = []
        for k in range(0, len(index), tile):
            part = index[k : k + tile]
            out.append((part, fps[part], pops[part].min(axis=0), pops[part].max(axis=0)))
        return out

    lefts = tiles(sides[0])
    rights = lefts if same else tiles(sides[1])
    if not lefts or not rights:
        return parent
    lo, hi = np.array([t[2] for t in rights]), np.array([t[3] for t in rights])
    for k, (ids, values, low, high) in enumerate(lefts):
        gap = np.maximum(np.maximum(lo - high, low - hi), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        for m in near[near >= k] if same else near:
            other, theirs = rights[m][:2]
            i, j = np.nonzero(np.bitwise_count(values[:, None] ^ theirs[None, :]) <= radius)
            if len(i) > (len(ids) if same and m == k else 0):
                shared.unite(parent, ids[i], other[j])
    return shared.find_roots(parent, np.arange(len(parent)))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of docs."""
    prints, _ = shared.stored(fingerprints(docs, size, seed), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("id"))
    found = shared.components(links(classes, radius, block), "simhash-links")
    named = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component_id")
    )
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def level_starts(percent: int) -> np.ndarray:
    """Smallest numbers of shingles of the levels: sets that are percent alike, not equal, are of one level or of neighbours."""
    starts = [-(-percent // (100 - percent))]
    while starts[-1] < MOST_SHINGLES:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, np.int64)


def sketches(docs: DataFrame, folder: str, size: int, seed: int, percent: int) -> DataFrame:
    """(doc_id, s1, s2, n, level, fp, file, at) of each text's set of shingle hashes; the sets go to files of the folder.

    s1 and s2 stand for the set, n is its size, and at its place in the file.
    """
    starts = level_starts(percent)
    schema = "doc_id long, s1 long, s2 long, n long, level int, fp long, file string, at long"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, at = f"{os.getpid()}-{np.random.default_rng().integers(1 << 62)}", 0
        with open(f"{folder}/{name}", "wb") as file:
            for part in parts:
                rows = []
                for t in part["text"]:
                    found = np.unique(text_hashes(t, size, seed))
                    raw = found.tobytes()
                    file.write(raw)
                    rows.append((xxhash.xxh64_intdigest(raw, 1), xxhash.xxh64_intdigest(raw, 2), majority(found), len(found), at))
                    at += len(found)
                s1, s2, fp, n, place = zip(*rows) if rows else [()] * 5
                signed = lambda x: np.array(x, np.uint64).view(np.int64)
                level = np.searchsorted(starts, np.array(n, np.int64), "right").astype(np.int32)
                yield pd.DataFrame({"doc_id": part["doc_id"], "s1": signed(s1), "s2": signed(s2), "n": np.array(n, np.int64), "level": level,
                                    "fp": signed(fp), "file": name, "at": np.array(place, np.int64)})

    return shared.mapped(shared.whole_text(docs, "doc_id"), run, schema)


def similar_links(sets: DataFrame, folder: str, radius: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect what all pairs of the distinct sets within the radius connect that are percent alike.

    Sets are blocked by their size. A task compares two blocks and checks
    candidates on the sets while their groups are apart, and returns a forest.
    """
    sent = _block_pairs(sets.where("level > 0").select("id", "fp", "n", "file", "at", "level"), "level", 1, block)
    if sent is None:
        return sets.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ids, files, at, n = rows["id"].to_numpy(np.int64), rows["file"].to_numpy(), rows["at"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)

        held, size = {}, 0

        def of(k: int) -> np.ndarray:
            nonlocal size
            if k not in held:
                if size > HELD:
                    held.clear()
                    size = 0
                held[k] = np.fromfile(f"{folder}/{files[k]}", np.uint64, n[k], offset=8 * at[k])
                size += n[k]
            return held[k]

        def alike(i: int, others: np.ndarray) -> np.ndarray:
            own = of(i)
            theirs = np.concatenate([of(k) for k in others.tolist()])
            found = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(found.astype(np.int64), np.cumsum(n[others]) - n[others])
            return 100 * both >= percent * (n[i] + n[others] - both)

        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        parent = similar_forest(fps, n, rows["right"].to_numpy(bool), key[0] == key[1], radius, percent, alike)
        joined = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"a": ids[joined], "b": ids[parent[joined]]})

    return sent.groupBy("x", "y").applyInPandas(compare, "a long, b long")


def similar_forest(fps: np.ndarray, n: np.ndarray, right: np.ndarray, same: bool, radius: int, percent: int, alike, tile: int = TILE) -> np.ndarray:
    """As forest(), of pairs within the radius that alike(i, array of j) holds for; both sides are sorted by set size and far sizes skipped."""
    parent = np.arange(len(fps))
    order = np.argsort(n, kind="stable")
    sides = (order, order) if same else (order[~right[order]], order[right[order]])

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for at in range(0, len(sides[0]), tile):
        mine = sides[0][at : at + tile]
        sizes = n[sides[1]]
        begin = np.searchsorted(sizes, -(-n[mine[0]] * percent // 100))
        end = np.searchsorted(sizes, n[mine[-1]] * 100 // percent, "right")
        for start in range(max(begin, at) if same else begin, end, tile):
            other = sides[1][start : min(start + tile, end)]
            i, j = np.nonzero(np.bitwise_count(fps[mine][:, None] ^ fps[other][None, :]) <= radius)
            i, j = mine[i], other[j]
            fit = (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent) & (i != j)
            i, j = i[fit], j[fit]
            apart = np.flatnonzero(shared.find_roots(parent, i) != shared.find_roots(parent, j))
            for run in np.split(apart, np.flatnonzero(np.diff(i[apart])) + 1) if len(apart) else []:
                a, left, step = int(i[run[0]]), j[run], 1
                # one at a time where they join, as most then need no check; more at once where they do not
                while len(left := left[shared.find_roots(parent, left) != root(a)]):
                    now, left = left[:step], left[step:]
                    good = now[alike(a, now)]
                    step = 1 if len(good) else min(4 * step, tile)
                    shared.unite(parent, np.full(len(good), a), good)
    return shared.find_roots(parent, np.arange(len(parent)))


def similar(docs: DataFrame, size: int, percent: int, radius: int = WIDE_RADIUS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(doc_id, component_id): one row per row of docs; linked are texts whose shingle sets have percent of their union in common."""
    spark = docs.sparkSession
    path = shared.table_path(spark, "shingle-sets")
    folder = shared.local_path(path)
    os.makedirs(folder)
    shared.when_done_forget(spark, path)
    prints, _ = shared.stored(sketches(docs, folder, size, seed, percent), "shingles")
    one = F.min(F.struct(F.col("doc_id").alias("id"), "n", "level", "fp", "file", "at")).alias("one")
    sets, _ = shared.stored(prints.groupBy("s1", "s2").agg(one).select("s1", "s2", "one.*"), "shingle-classes")
    found = shared.components(similar_links(sets, folder, radius, percent, block), "shingle-links")
    shared.forget(spark, path)
    named = sets.join(found.withColumnRenamed("node", "id"), "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, ["s1", "s2"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, percent: int | None = None, **options) -> DataFrame:
    """The rows of docs that stay when each connected group keeps its smallest doc_id.

    Groups are those of near_duplicates(), or with a percent those of similar().
    All rows of that doc_id stay; rows without doc_id stay too.
    """
    known = docs.where("doc_id is not null")
    found = near_duplicates(known, **options) if percent is None else similar(known, percent=percent, **options)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
