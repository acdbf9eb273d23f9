"""Quality scores: a Gaussian kernel over document statistics by random Fourier features.

Statistics of a whole text (shares of letter case, symbols, repeated words
and lines, lengths) are standardized and mapped to ``FEATURES`` random cosines,
whose products approximate a Gaussian kernel.  Every partition sums its part
of the normal equations, Spark adds the parts, and the driver solves one small
ridge system.  Rows kept out of that fit calibrate the score by isotonic
regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, give_back

FEATURES = 200
RIDGE = 1e-3
#: Raw scores are calibrated in bins of this width between LOW and HIGH.
BIN, LOW, HIGH = 0.0005, -0.5, 1.5

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "lower", "digit", "space", "newline",
    "full_stop_comma", "other_symbol", "high_byte", "distinct_words", "repeated_neighbour",
    "distinct_lines", "line_words", "end_symbol",
)
N = len(STATISTICS)

_kind = np.full(256, 7)  # other symbols and control bytes
_kind[65:91], _kind[97:123], _kind[48:58] = 0, 1, 2
_kind[[9, 11, 12, 13, 32]], _kind[10], _kind[[44, 46]], _kind[128:] = 3, 4, 5, 6


def text_statistics(texts: list[bytes]) -> np.ndarray:
    """(texts, N); zeros for an empty text."""
    out = np.zeros((len(texts), N), np.float32)
    for i, b in enumerate(texts):
        if not b:
            continue
        n = len(b)
        counts = np.bincount(_kind, np.bincount(np.frombuffer(b, np.uint8), minlength=256), 8)
        upper, lower, digit, space, newline, stop, high, symbol = counts.tolist()
        words = b.lower().split()
        w = max(1, len(words))
        lines = b.split(b"\n")
        out[i] = (
            np.log1p(n), np.log1p(len(words)), min(40.0, (n - space - newline) / w),
            upper / n, lower / n, digit / n, space / n, newline / n, stop / n, symbol / n,
            high / n, len(set(words)) / w**0.8, sum(map(eq, words, words[1:])) / w,
            len(set(lines)) / len(lines), min(200.0, w / len(lines)),
            float(_kind[b[-1]] == 7),
        )
    return out


def _texts(column) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]


def statistics(
    docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), to: str = "stats"
) -> DataFrame:
    """The columns ``carry`` and an array ``to`` with the statistics of the whole text.

    Null and empty texts have zeros.  Rows and their order stay; columns that are not carried
    are ignored.
    """
    kept = docs.select(*carry)
    schema = T.StructType(
        [*kept.schema, T.StructField(to, T.ArrayType(T.FloatType(), containsNull=False))]
    )
    names = schema.names

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = _texts(batch.column(batch.num_columns - 1))
            flat = pa.array(text_statistics(texts).ravel(), pa.float32())
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * N)
            column = pa.ListArray.from_arrays(
                ends, flat, type=pa.list_(pa.field("element", pa.float32(), nullable=False))
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=names)
        give_back()

    bound_batches(docs.sparkSession)
    return docs.select(*carry, F.col(text).alias("_text")).mapInArrow(work, schema)


@dataclass
class Quality:
    """Scores statistics (rows, N)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores
    values: np.ndarray  # calibrated

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return cosines(stats, self.mean, self.scale) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def cosines(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel as wide as sqrt(N), and a constant."""
    rng = np.random.default_rng(11)
    w = rng.normal(0, 1 / np.sqrt(N), (N, FEATURES))
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.sqrt(2 / FEATURES) * np.cos(x @ w + shift)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (knots, values), values rising.  x is sorted."""
    blocks: list[list[float]] = []  # sum of y, weight, sum of weight * x
    for xi, ti, wi in zip(x, total, weight):
        blocks.append([ti, wi, wi * xi])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (
        np.array([b[2] / b[1] for b in blocks]),
        np.array([b[0] / b[1] for b in blocks]),
    )


def _matrix(batch) -> np.ndarray:
    return batch.column(0).values.to_numpy(zero_copy_only=False)[
        batch.column(0).offset * N :
    ].reshape(-1, N)[: batch.num_rows]


def fit(rows: DataFrame, calibrates: Column, stats: str = "stats", label: str = "y") -> Quality | None:
    """Fit on labelled rows (``stats``, ``label`` 0 or 1); None unless both labels occur.

    Rows where ``calibrates`` holds fit the calibration, the others the ridge scores; if either
    part lacks a label, both use all rows.  Rows with a null label or null statistics are left out.
    """
    rows = rows.select(
        F.col(stats).alias("s"),
        F.col(label).cast("double").alias("y"),
        F.coalesce(calibrates, F.lit(False)).alias("later"),
    ).filter("s IS NOT NULL AND y IN (0, 1)")
    seen = {(r["later"], r["y"]) for r in rows.select("later", "y").distinct().collect()}
    if len({y for _, y in seen}) < 2:
        return None
    split = len(seen) == 4
    first = rows.filter(~F.col("later")) if split else rows
    last = rows.filter("later") if split else rows
    at = [F.get("s", F.lit(i)) for i in range(N)]
    moments = first.select(
        *(f(c).alias(f"{k}{i}") for i, c in enumerate(at) for k, f in (("m", F.avg), ("d", F.stddev_pop)))
    ).first()
    mean = np.array([moments[f"m{i}"] for i in range(N)])
    scale = np.maximum([moments[f"d{i}"] for i in range(N)], 1e-6)

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = cosines(_matrix(batch), mean, scale)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        row, column = np.divmod(np.arange(total.size, dtype=np.int32), FEATURES + 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(total.ravel())],
            names=["row", "column", "value"],
        )

    # FEATURES squared cells from every partition, and as many in all.
    cells = (
        first.select("s", "y")
        .mapInArrow(sums, "row int, column int, value double")
        .groupBy("row", "column")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    system[cells["row"], cells["column"]] = cells["value"]
    gram, right = system[:, :-1], system[:, -1]
    count = max(1.0, gram[-1, -1])
    weights = np.linalg.solve(gram + RIDGE * count / FEATURES * np.eye(len(gram)), right)
    model = Quality(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def bins(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), LOW, HIGH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.round(raw / BIN).astype(np.int32), pa.int32()), batch.column(1)],
                names=["bin", "y"],
            )

    # At most (HIGH - LOW) / BIN bins.
    found = (
        last.select("s", "y")
        .mapInArrow(bins, "bin int, y double")
        .groupBy("bin")
        .agg(F.sum("y").alias("y"), F.count("*").alias("n"))
        .toPandas()
        .sort_values("bin")
    )
    model.knots, model.values = isotonic(
        found["bin"].to_numpy() * BIN, found["y"].to_numpy(), found["n"].to_numpy()
    )
    return model


def score(
    rows: DataFrame,
    model: Quality | None,
    stats: str = "stats",
    carry: tuple[str, ...] = ("doc_id",),
    to: str = "score",
    text: str | None = None,
) -> DataFrame:
    """The columns ``carry`` and ``to``: the calibrated chance of label 1; 0.5 without a model.

    With ``text`` the statistics are those of that column, made in the same task and worker.
    """
    kept = rows.select(*carry)
    schema = T.StructType([*kept.schema, T.StructField(to, T.DoubleType())])
    names = schema.names

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = batch.select([batch.num_columns - 1])
            if model is None:
                values = np.full(len(batch), 0.5)
            else:
                # As exact as statistics that are kept as floats.
                x = _matrix(x) if text is None else text_statistics(_texts(x.column(0))).astype(np.float32)
                values = model(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], names=names)
        if text is not None:
            give_back()

    bound_batches(rows.sparkSession)
    source = stats if text is None else text
    return rows.select(*carry, F.col(source).alias("_stats")).mapInArrow(work, schema)
