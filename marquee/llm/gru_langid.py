"""Language identification by a bidirectional GRU over bytes, in numpy.

The network reads windows of ``WINDOW`` bytes in both directions, gives every
position a probability for each language, and a document's probabilities are
the mean over its letter positions.  It is trained on the driver by
backpropagation through time on a bounded sample of labelled rows, and then
labels whole texts inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, give_back

WINDOW = 64
HIDDEN = 8
#: The training sample: at most about this many documents of a language, SNIPPETS pieces of
#: SNIPPET_CHARS characters from anywhere in each.
DOCS_PER_LANGUAGE = 400
#: Languages a model learns at most.
MAX_LANGUAGES = 200
SNIPPETS = 4
SNIPPET_CHARS = 96
STEPS = 350
#: Windows a task computes at once.
SLICE = 2048
UNDETERMINED = "und"

_fold = np.arange(256)
_fold[65:91] += 32  # A-Z
#: Positions that count: ASCII letters and bytes of longer characters.
_letter = np.zeros(256, np.float32)
_letter[97:123] = _letter[65:91] = _letter[128:] = 1


@dataclass
class BiGru:
    languages: list[str]
    hidden: int = HIDDEN
    seed: int = 7
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng, h = np.random.default_rng(self.seed), self.hidden
        for d in "fb":
            self.p["E" + d] = rng.normal(0, 0.3, (256, 3 * h))
            self.p["U" + d] = rng.normal(0, 0.3, (h, 2 * h))
            self.p["V" + d] = rng.normal(0, 0.3, (h, h))
        self.p["W"] = rng.normal(0, 0.3, (2 * h, len(self.languages)))
        self.p["c"] = np.zeros(len(self.languages))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, d: str, keep: bool = False):
        """States (T, B, H) of direction ``d`` over bytes x (T, B); and what BPTT needs."""
        n, h_ = self.hidden, np.zeros((x.shape[1], self.hidden), np.float32)
        E, U, V = (self.p[k + d] for k in "EUV")
        states = np.empty((*x.shape, n), np.float32)
        steps = []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            g = E[x[t]]
            a = h_ @ U
            a += g[:, : 2 * n]
            a *= 0.5  # sigmoid by tanh
            np.tanh(a, out=a)
            a *= 0.5
            a += 0.5
            z, r = a[:, :n], a[:, n:]
            c = (r * h_) @ V
            c += g[:, 2 * n :]
            np.tanh(c, out=c)
            if keep:
                steps.append((t, h_, a, c))
            h_ = h_ - c
            h_ *= z
            h_ += c
            states[t] = h_
        return states, steps

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(T, B, languages) for bytes x (T, B)."""
        n = self.hidden
        logits = self._run(x, "f")[0] @ self.p["W"][:n]
        logits += self._run(x, "b")[0] @ self.p["W"][n:]
        logits += self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over letter positions of x (T, B) with classes y (B)."""
        n, (T_, B) = self.hidden, x.shape
        runs = {d: self._run(x, d, keep=True) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        logits = both @ self.p["W"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        weight = _letter[x][..., None]
        weight /= max(1.0, weight.sum())
        right = prob[:, np.arange(B), y]
        loss = float(-(np.log(right + 1e-12) * weight[..., 0]).sum())
        prob[:, np.arange(B), y] -= 1
        prob *= weight
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["W"] = both.reshape(-1, 2 * n).T @ prob.reshape(-1, prob.shape[2])
        grad["c"] = prob.sum(axis=(0, 1))
        back = prob @ self.p["W"].T
        for d, part in (("f", back[..., :n]), ("b", back[..., n:])):
            U, V = self.p["U" + d], self.p["V" + d]
            dh = np.zeros((B, n), np.float32)
            for t, before, a, c in reversed(runs[d][1]):
                dh = dh + part[t]
                z, r = a[:, :n], a[:, n:]
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (before - c) * z * (1 - z)
                drh = dc @ V.T
                da = np.concatenate([dz, drh * before * r * (1 - r)], axis=1)
                grad["V" + d] += (r * before).T @ dc
                grad["U" + d] += before.T @ da
                np.add.at(grad["E" + d], x[t], np.concatenate([da, dc], axis=1))
                dh = dh * z + drh * r + da @ U.T
        return loss, grad

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = 256) -> None:
        """Adam over random batches of windows x (N, T)."""
        rng = np.random.default_rng(self.seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i in range(1, steps + 1):
            at = rng.integers(0, len(x), min(batch, len(x)))
            _, grad = self.gradients(np.ascontiguousarray(x[at].T), y[at])
            rate = 0.02 * (1 - 0.9 * i / steps)
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                step = rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-7)
                self.p[k] -= step.astype(np.float32)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages): mean probability over all letter positions of whole texts.

        A text is cut into windows; the last one of a longer text ends with it, and positions
        that the window before has labelled do not count again.  Rows without letters are zero.
        """
        starts, owners, fresh, buffers, at = [], [], [], [], 0
        for i, b in enumerate(texts):
            if not b:
                continue
            size = max(len(b), WINDOW)
            first = np.arange(0, size, WINDOW)
            own = np.minimum(first, size - WINDOW)
            starts.append(own + at)
            fresh.append(first - own)
            owners.append(np.full(len(own), i))
            buffers.append(b.ljust(WINDOW, b" "))
            at += size
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        if not buffers:
            return total
        data = np.frombuffer(b"".join(buffers), np.uint8)
        starts, fresh, owners = map(np.concatenate, (starts, fresh, owners))
        span = np.arange(WINDOW)
        for k in range(0, len(starts), SLICE):
            x = data[span[:, None] + starts[None, k : k + SLICE]]
            weight = _letter[x] * (span[:, None] >= fresh[None, k : k + SLICE])
            # einsum: sum over positions, weighted
            pooled = np.einsum("tbl,tb->bl", self.probabilities(_fold[x]), weight)
            own = owners[k : k + SLICE]
            for j in range(pooled.shape[1]):
                total[:, j] += np.bincount(own, pooled[:, j], len(texts))
            count += np.bincount(own, weight.sum(axis=0), len(texts))
        return total / np.maximum(count, 1)[:, None]


def train(
    rows: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    steps: int = STEPS,
) -> BiGru | None:
    """Fit on a sample of ``rows``; None where no row has a text with letters and a language.

    The sample holds about ``docs_per_language`` documents of each language, picked by the
    hash of their id, and of each ``SNIPPETS`` snippets from all over the text.  Where ``lang`` has
    more than ``MAX_LANGUAGES`` values, those with most documents are learnt (ties by name): the
    sample and the model then stay bounded, whatever a dirty column holds.
    """
    usable = rows.select(
        F.col(doc).alias("d"), F.col(text).alias("t"), F.col(lang).alias("l")
    ).filter("d IS NOT NULL AND l IS NOT NULL AND t IS NOT NULL")
    most = usable.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MAX_LANGUAGES)
    counts = {r["l"]: r["count"] for r in most.collect()}
    if not counts:
        return None
    share = F.create_map(
        *(F.lit(v) for k, n in counts.items() for v in (k, min(1.0, docs_per_language / n)))
    )
    picked = usable.filter(F.pmod(F.xxhash64("d"), F.lit(1 << 30)) < share[F.col("l")] * (1 << 30))
    spread = F.greatest(F.lit(1), F.char_length("t") - SNIPPET_CHARS)
    sample = picked.select(
        "l",
        *(
            F.substring(
                F.col("t"),
                F.pmod(F.xxhash64("d", F.lit(i)), spread).cast("int") + 1,
                F.lit(SNIPPET_CHARS),
            ).alias(f"s{i}")
            for i in range(SNIPPETS)
        ),
    ).collect()
    languages = sorted(counts)
    windows, classes = [], []
    for r in sorted(sample):
        for i in range(SNIPPETS):
            b = r[f"s{i}"].encode()[:WINDOW].ljust(WINDOW, b" ")
            x = np.frombuffer(b, np.uint8)
            if _letter[x].any():
                windows.append(_fold[x])
                classes.append(languages.index(r["l"]))
    if not windows:
        return None
    model = BiGru(languages)
    model.fit(np.stack(windows), np.array(classes), steps)
    return model


def identify(
    docs: DataFrame, model: BiGru | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``carry`` with ``lang_pred`` and ``score`` of every whole text.

    ``score`` is the pooled probability of ``lang_pred``.  A text that is null, empty or
    without any letter is ``und`` with score 0, and so is every text if there is no model.
    Equal probabilities go to the language first in order.  Repeated rows give repeated rows;
    columns that are not in ``carry`` are ignored, and carried ones may not be called
    ``lang_pred`` or ``score``.
    """
    kept = docs.select(*carry)
    schema = T.StructType(
        [*kept.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    names = schema.names

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            read = batch.column(batch.num_columns - 2)
            lettered = batch.column(batch.num_columns - 1).to_pylist()
            texts = [
                t.as_buffer().to_pybytes() if ok and t.is_valid else b""
                for t, ok in zip(read, lettered)
            ]
            if model is None:
                best, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            else:
                p = model.documents(texts)
                at = p.argmax(axis=1)
                best = [model.languages[i] if ok else UNDETERMINED for i, ok in zip(at, lettered)]
                score = np.where(lettered, np.minimum(1, p.max(axis=1)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    pa.array(best, pa.string()),
                    pa.array(score, pa.float64()),
                ],
                names=names,
            )
        give_back()

    bound_batches(docs.sparkSession)
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(
        *carry, F.col(text).alias("_text"), has_letter.alias("_letters")
    ).mapInArrow(work, schema)
