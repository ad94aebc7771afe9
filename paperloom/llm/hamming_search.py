"""Nearest neighbours by multi-index hashing.

Vectors become binary codes: the signs after a learned rotation (iterative
quantisation on a bounded sample, from several starts). A code is cut into
substrings, each with an index of its own. By the pigeonhole principle a code
within a Hamming radius has a substring within radius / substrings, so probing
every substring's index that near retrieves every code within the radius; those
are reranked by the inner product of the original vectors in double precision.
The radius grows for a query that finds too few.

Rows are dealt by identifier into blocks of bounded size, each with its own
indexes; the stated queries meet every block. Defined results: rows without
identifier, and vectors that are null, of another than the most common length,
zero, or with null or non-finite components take no part; ties go to the smaller
vec_id; rows of the query's own vec_id are no candidates; repeated rows are
candidates each and ask once, of several vectors with one vec_id the smallest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, EVERY = 20, 20
#: Bits of a code, of a substring, and the Hamming radius that is searched at first.
BITS, SUB, RADIUS, WIDER = 128, 16, 55, 8
#: The radius grows until this many times k codes are found: among few vectors the nearest are further off.
ENOUGH = 25
#: Vectors from which the rotation is learned, those of the smallest hashes.
SAMPLE, ROUNDS = 16_384, 25
#: Mean vectors and queries of a block.
BLOCK, QUERIES = 32_768, 32_768


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): iterative quantisation on the principal axes, from as many random starts as the bits need."""
    mean = sample.mean(axis=0)
    x = sample - mean
    dims = x.shape[1]
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes.T if len(axes) == dims else np.eye(dims)
    z, parts = x @ axes, []
    for start in range(-(-bits // dims)):
        rotation = np.linalg.qr(np.random.default_rng(start).normal(size=(dims, dims)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(z @ rotation).T @ z)
            rotation = (u @ v).T
        parts.append(axes @ rotation)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def encode(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as rows of SUB-bit substrings."""
    signs = (x - mean) @ projection > 0
    return np.packbits(signs, axis=1, bitorder="little").view("<u2")


class Block:
    """The substring indexes of a block's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, begins = np.unique(codes[order, j], return_index=True)
            self.parts.append((order, values, np.append(begins, len(order))))
        self.seen = np.zeros(len(codes), bool)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every position whose code is within the radius."""
        near = radius // len(self.parts)
        self.seen[:] = False
        for value, (order, values, begins) in zip(code, self.parts):
            hit = np.bitwise_count(values ^ value) <= near
            lengths = np.diff(begins)
            self.seen[order[np.repeat(hit, lengths)]] = True
        found = np.flatnonzero(self.seen)
        distance = np.bitwise_count(self.codes[found] ^ code).sum(axis=1, dtype=np.int64)
        return found[distance <= radius]


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, model: tuple, k: int, radius: int) -> list[tuple]:
    """(query_id, vec_id, score) of the k best that each query finds in the block, or all if fewer."""
    block, codes, out = Block(encode(x, *model)), encode(q, *model), []
    for query, vector, code in zip(q_ids, q, codes):
        reach = radius
        while True:
            found = block.within(code, reach)
            found = found[ids[found] != query]
            if len(found) >= ENOUGH * k or reach >= code.size * SUB:
                break
            reach += WIDER
        scores = (x[found] * vector).sum(axis=1)
        best = np.lexsort((ids[found], -scores))[:k]
        out += [(int(query), int(ids[found[b]]), float(scores[b])) for b in best]
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    lengths = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    size = lengths[0]["n"] if lengths else 0
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where((F.size("embedding") == size) & finite & F.exists("embedding", lambda v: v != 0))


def search(vectors: DataFrame, every: int = EVERY, k: int = K, radius: int = RADIUS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose vec_id is divisible by every, against all rows."""
    data = usable(vectors)
    schema = "query_id long, vec_id long, score double"
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = learn(np.array([r["embedding"] for r in sample]))
    total, wanted = data.agg(F.count("*"), F.count_if(F.expr(f"vec_id % {every} = 0"))).first()
    blocks, groups = max(1, -(-total // BLOCK)), max(1, -(-wanted // QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    deal_q = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    asked = data.where(f"vec_id % {every} = 0").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    left = asked.withColumn("g", deal_q).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = data.withColumn("b", deal(blocks)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            out = search_block(queries["vec_id"].to_numpy(), np.stack(queries["embedding"]), rows["vec_id"].to_numpy(), np.stack(rows["embedding"]), model, k, radius)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInPandas(meet, schema)
    # few rows for each query and block
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id", "score")))
    ranked = found.groupBy("query_id").agg(F.slice(best, 1, k).alias("best")).select("query_id", F.posexplode("best").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def op3_hamming_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
