"""Quality scores by a regularised quadratic discriminant.

A document becomes statistics of its whole text, transformed towards normal
distributions. Each class has a mean and a covariance that is shrunk towards the
pooled one and a multiple of the identity; a score is the logistic of the
difference of Mahalanobis log densities, from Cholesky factors that are computed
once. Class moments are sums over all labelled rows; only they reach the driver.

Defined results: a null text is empty and gets a score like any other; labels
that are null or other than 0 and 1 are left out, repeated ones count each;
without labels of both classes every score is the share of label 1 (0.5 without
any); repeated rows each give a row; an empty table gives an empty result; other
columns are ignored, or pass unchanged where rows are filtered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm import shared

FOLDS, HELD = 4, 2
THRESHOLD = 0.7
#: Weights of the pooled covariance and of the identity in a class covariance.
POOL, RIDGE = 0.2, 0.02
_CLASS = np.full(256, 9, np.int64)  # other bytes, beyond ASCII
for _name, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:", b"!?", b"|/\\<>[]{}()=_+-", b"#$%&*@^~\"'`")):
    _CLASS[list(_bytes)] = _name
STATISTICS = 15
COLUMNS = [f"x{k}" for k in range(STATISTICS)]
ZIP_BLOCK = 1 << 16
#: Bytes of usual prose, by class, that are added to each text's own.
PRIOR = 2.0 * np.array([76, 2.5, 0.2, 16, 0.5, 3, 0.1, 0.1, 0.1, 1.5])


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text."""
    data = text.encode("utf-8", "surrogatepass")
    size = len(data)
    kinds = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=10)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, n_lines = len(words), len(lines)
    kinds = kinds + PRIOR  # short texts lean towards usual shares
    share = kinds / kinds.sum()
    packed = sum(len(zlib.compress(data[k : k + ZIP_BLOCK], 1)) for k in range(0, size, ZIP_BLOCK))
    letters = kinds[0] + kinds[1]
    log = lambda x: float(np.log1p(1000 * x))
    return [
        float(np.log1p(n)),
        float(np.log((size + 120) / (n + 20))),
        log(kinds[1] / max(letters, 1)),
        log(share[2]),
        log(share[3]),
        log(share[4]),
        log(share[5]),
        log(share[6]),
        log(share[7]),
        log(share[8]),
        log(share[9]),
        float(np.log((len(set(words)) + 1) / (n + 1))),
        float(np.log((packed + 20) / (size + 20))),
        float(np.log((len(set(lines)) + 1) / (n_lines + 1))),
        float(np.log1p(n / (n_lines + 1))),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x0, x1, ...): one row per row of docs."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            values = np.array([statistics(t) for t in part["text"]]).reshape(-1, STATISTICS)
            out = pd.DataFrame(values.astype(np.float32), columns=COLUMNS)
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            yield out

    kinds = ", ".join(f"{c} float" for c in COLUMNS)
    return shared.mapped(shared.whole_text(docs, "doc_id"), run, f"doc_id long, {kinds}")


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products by class, of (label, x0, ...); 2 x (1 + p + p (p + 1) / 2) sums."""
    x = [F.col(c).cast("double") for c in COLUMNS]
    pairs = [(i, j) for i in range(STATISTICS) for j in range(i, STATISTICS)]
    sums = [F.count("*"), *[F.sum(c) for c in x], *[F.sum(x[i] * x[j]) for i, j in pairs]]
    out = {}
    for row in rows.groupBy("label").agg(*[s.alias(f"m{k}") for k, s in enumerate(sums)]).collect():
        n, total = float(row[1]), np.array(row[2 : 2 + STATISTICS])
        square = np.zeros((STATISTICS, STATISTICS))
        for (i, j), value in zip(pairs, row[2 + STATISTICS :]):
            square[i, j] = square[j, i] = value
        out[int(row["label"])] = n, total, square
    return out


def fit(by_class: dict[int, tuple[float, np.ndarray, np.ndarray]], pool: float = POOL, ridge: float = RIDGE) -> dict:
    """The classes' log priors, means, Cholesky factors and log determinants."""
    total = sum(m[0] for m in by_class.values())
    if len(by_class) < 2:
        return {"share": by_class[1][0] / total if 1 in by_class else 0.0 if 0 in by_class else 0.5}
    means = {k: s / n for k, (n, s, _) in by_class.items()}
    scatter = {k: q - n * np.outer(means[k], means[k]) for k, (n, _, q) in by_class.items()}
    pooled = sum(scatter.values()) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    model = {"scale": scale, "classes": {}}
    for k, (n, _, _) in by_class.items():
        cov = (1 - pool) * scatter[k] / n + pool * pooled
        cov = cov / np.outer(scale, scale)
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / STATISTICS, 1e-6) * np.eye(STATISTICS)
        factor = np.linalg.cholesky(cov)
        model["classes"][k] = np.log(n / total), means[k] / scale, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()
    return model


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    """Of label 1, for rows of statistics."""
    if "share" in model:
        return np.full(len(x), model["share"])
    z, density = x / model["scale"], {}
    for k, (prior, mean, inverse, log_det) in model["classes"].items():
        density[k] = prior - 0.5 * (log_det + (((z - mean) @ inverse.T) ** 2).sum(axis=1))
    return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def fold(of: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score): learnt from the labels of the folds that are not held out."""
    known, _ = shared.stored(features(docs), "quality")
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    model = fit(moments(known.join(marks, "doc_id").where(fold(FOLDS) != HELD)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": probability(model, part[COLUMNS].to_numpy(float))})

    return shared.mapped(known, run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score reaches the threshold."""
    own = docs.columns
    known, _ = shared.stored(features(docs), "quality")
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    model = fit(moments(known.join(marks, "doc_id").where(fold(FOLDS) != HELD)))
    at = own.index("text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        for part in parts:
            texts = part.column(at).to_pylist()
            x = np.array([statistics(t or "") for t in texts]).reshape(-1, STATISTICS)
            yield part.filter(pa.array(probability(model, x.astype(np.float32).astype(float)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    out = scored(read("documents"), read("labels"))
    return out.select(
        "doc_id", (fold(FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
