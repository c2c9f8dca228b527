"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Each byte has a learned vector;
learned filters run over the chunk, and each keeps its largest response in the chunk. A hidden
layer reads these; its values' mean, maximum and minimum over all chunks of the document make one
probability. Training is plain back-propagation with Adam on the whole texts of a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, map_texts
from .labelled import bounded_texts, class_counts, copy_bands, sample_labels, without_copies

#: Remainder of crc32(doc_id) modulo HELD_OUT[0] whose labels are never used.
HELD_OUT = (5, 0)
#: Labelled rows of each class at most, and chunks that are worked on at once, which bounds memory whatever a text's length.
EXAMPLES, AT_ONCE = 1500, 32
#: Bytes of the sample's texts together, at most.
EXAMPLE_BYTES = 64 << 20
#: Bytes of a chunk and from one chunk's start to the next's; of a filter and from one place to the next.
CHUNK, STEP, WIDTH, STRIDE = 256, 224, 8, 2
#: Sizes of a byte's vector, of the filters and of the hidden layer; rounds of training; documents of one step.
VECTOR, FILTERS, HIDDEN, ROUNDS, BATCH = 6, 48, 24, 14, 32
#: The share of the training texts of which only a few words are shown, as very short documents are rare.
SNIPPETS = 0.12


def chunks(data: bytes) -> np.ndarray:
    """All overlapping chunks as rows of byte values + 1; 0 fills up the last one. At least one row."""
    n = max(1, 1 + -(-(len(data) - CHUNK) // STEP)) if len(data) > CHUNK else 1
    flat = np.zeros((n - 1) * STEP + CHUNK, np.int16)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    flat[: len(data)] += 1
    return np.lib.stride_tricks.as_strided(flat, (n, CHUNK), (flat.strides[0] * STEP, flat.strides[0]))


@dataclass
class QualityModel:
    weights: dict[str, np.ndarray]
    shift: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 0) -> QualityModel:
        r = np.random.RandomState(seed)
        draw = lambda *s, n: (r.standard_normal(s) / np.sqrt(n)).astype(np.float32)
        zero = lambda n: np.zeros(n, np.float32)
        return cls({
            "bytes": draw(257, VECTOR, n=1),
            "filters": draw(WIDTH * VECTOR, FILTERS, n=WIDTH * VECTOR), "filters_b": zero(FILTERS),
            "hidden": draw(FILTERS, HIDDEN, n=FILTERS), "hidden_b": zero(HIDDEN),
            "out": draw(3 * HIDDEN, 1, n=3 * HIDDEN), "out_b": zero(1),
        })

    def windows(self, x: np.ndarray) -> np.ndarray:
        """chunks x places x (WIDTH * VECTOR)."""
        v = np.ascontiguousarray(self.weights["bytes"][x])
        n, size = len(x), v.itemsize * VECTOR
        places = (CHUNK - WIDTH) // STRIDE + 1
        return np.lib.stride_tricks.as_strided(v, (n, places, WIDTH * VECTOR), (size * CHUNK, size * STRIDE, v.itemsize))

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Each filter's largest response in each chunk."""
        w = self.weights
        out = np.empty((len(x), FILTERS), np.float32)
        for at in range(0, len(x), AT_ONCE):  # small enough for the processor's cache
            win = self.windows(x[at : at + AT_ONCE])
            response = win.reshape(-1, WIDTH * VECTOR) @ w["filters"]
            out[at : at + AT_ONCE] = response.reshape(len(win), -1, FILTERS).max(1)
        return np.maximum(out + w["filters_b"], 0)

    def chance(self, h: np.ndarray) -> float:
        """From the hidden values of all chunks of a document to its score."""
        w = self.weights
        z = float(np.concatenate((h.mean(0), h.max(0), h.min(0))) @ w["out"][:, 0] + w["out_b"][0]) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def score(self, text: str | None) -> float:
        """Null texts count as empty, and those are one chunk without bytes."""
        w = self.weights
        x = chunks((text or "").encode())
        return self.chance(np.tanh(self.pooled(x) @ w["hidden"] + w["hidden_b"]))

    def gradients(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over the documents; ``doc`` gives each chunk's document, ascending."""
        w, n_docs = self.weights, len(y)
        top, raw = np.empty((len(x), FILTERS), np.int64), np.empty((len(x), FILTERS), w["filters"].dtype)
        for at in range(0, len(x), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            win = self.windows(x[some])
            response = (win.reshape(-1, WIDTH * VECTOR) @ w["filters"]).reshape(len(win), -1, FILTERS)
            top[some] = response.argmax(1)
            raw[some] = np.take_along_axis(response, top[some][:, None], 1)[:, 0] + w["filters_b"]
        p = np.maximum(raw, 0)
        h = np.tanh(p @ w["hidden"] + w["hidden_b"])
        first = np.searchsorted(doc, np.arange(n_docs))
        count = np.bincount(doc, minlength=n_docs).astype(np.float32)
        mean = np.add.reduceat(h, first) / count[:, None]
        high, low = np.maximum.reduceat(h, first), np.minimum.reduceat(h, first)
        f = np.concatenate((mean, high, low), 1)
        z = f @ w["out"][:, 0] + w["out_b"][0]
        dz = ((1 / (1 + np.exp(-z)) - y) / n_docs).astype(np.float32)
        g = {"out": (f.T @ dz)[:, None], "out_b": dz.sum(keepdims=True)}
        df = dz[:, None] * w["out"][:, 0]
        dh = df[doc, :HIDDEN] / count[doc, None] + df[doc, HIDDEN : 2 * HIDDEN] * (h == high[doc]) + df[doc, 2 * HIDDEN :] * (h == low[doc])
        dh *= 1 - h * h
        g["hidden"], g["hidden_b"] = p.T @ dh, dh.sum(0)
        dp = (dh @ w["hidden"].T) * (raw > 0)
        g["filters_b"] = dp.sum(0)
        g["filters"] = np.zeros_like(w["filters"])
        by_byte = np.zeros((FILTERS, WIDTH, 257))
        for at in range(0, len(x), AT_ONCE):  # only the window with the largest response learns
            part, steep = x[at : at + AT_ONCE], dp[at : at + AT_ONCE]
            seen = part[np.arange(len(part))[:, None, None], top[at : at + AT_ONCE, :, None] * STRIDE + np.arange(WIDTH)]  # chunks x filters x bytes
            g["filters"] += np.einsum("cfv,cf->vf", w["bytes"][seen].reshape(len(part), FILTERS, -1), steep, optimize=True)
            where = np.arange(FILTERS * WIDTH).reshape(FILTERS, WIDTH) * 257 + seen
            by_byte += np.bincount(where.ravel(), np.repeat(steep.ravel(), WIDTH), by_byte.size).reshape(by_byte.shape)
        g["bytes"] = np.einsum("fwb,wvf->bv", by_byte, w["filters"].reshape(WIDTH, VECTOR, FILTERS), optimize=True).astype(w["bytes"].dtype)
        return g

    @classmethod
    def fit(cls, examples: list[tuple[int, int, bytes]], rows: dict[int, int], seed: int = 0) -> QualityModel:
        """examples: (doc_id, label, text) in any order; rows: labelled rows of each class in all, for the base rate.

        Without examples of both classes every score is near the base rate.
        """
        examples = sorted(examples, key=lambda e: e[:2])
        model = cls.fresh(seed)
        n = [sum(e[1] == y for e in examples) for y in (0, 1)]
        base = np.log((rows[1] + 0.5) / (rows[0] + 0.5))
        if not all(n):
            model.weights["out"][:] = 0
            model.shift = float(base)
            return model
        data = [(chunks(e[2]), e[1]) for e in examples]
        r = np.random.RandomState(seed + 1)
        by_class = [[i for i, e in enumerate(data) if e[1] == y] for y in (0, 1)]
        first = {k: np.zeros_like(v) for k, v in model.weights.items()}
        second = {k: np.zeros_like(v) for k, v in model.weights.items()}
        steps_each = max(40, len(data) // BATCH)
        total, step = ROUNDS * steps_each, 0
        for step in range(1, total + 1):
            picked = np.concatenate([r.choice(c, BATCH // 2) for c in by_class])
            parts = []
            for i in picked:  # a text is seen in part and in whole, as long and short ones come
                x = data[i][0]
                if r.rand() < SNIPPETS:
                    one = x[r.randint(len(x))]
                    held = int(np.count_nonzero(one))
                    start = r.randint(max(1, held - 12))
                    one = one[start : min(held, start + r.randint(12, 120))]
                    parts.append(np.pad(one, (0, CHUNK - len(one)))[None])
                    continue
                parts.append(x if r.rand() < 0.5 else x[np.sort(r.choice(len(x), r.randint(1, len(x) + 1), replace=False))])
            doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
            g = model.gradients(np.concatenate(parts), doc, np.array([data[i][1] for i in picked], np.float32))
            rate = 0.004 * min(1, step / 50) * (1 - step / (total + 1)) + 1e-5
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                a, b = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                model.weights[k] = (model.weights[k] * (1 - 1e-4) - rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
        model.shift = float(base)  # trained on classes of equal size
        return model


def fit_model(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learns from the whole texts of EXAMPLES labelled rows of each class and EXAMPLE_BYTES in all at most; copies among them count once.

    Of several texts with one id the first in code-point order is read; ids without a text count as empty texts. Without
    labels of both classes every score is near the base rate, without any labels it is 0.5.
    """
    rows = class_counts(labels, "quality", *HELD_OUT)
    sample = bounded_texts(sample_labels(labels, "quality", *HELD_OUT, EXAMPLES), docs, EXAMPLE_BYTES)
    seen = map_texts(sample.select("doc_id", "label", "text", F.col("text").alias("of")), ["doc_id", "label", "text"], lambda: lambda text: (copy_bands(text),), "bands array<long>").toArrow().to_pylist()
    kept = without_copies([(r["doc_id"], r["label"], r["bands"]) for r in seen])
    examples = [(r["doc_id"], r["label"], (r["text"] or "").encode()) for r in seen if r["doc_id"] in kept]
    del seen
    model = QualityModel.fit(examples, rows)
    del examples
    give_back()
    return model


def score_texts(df: DataFrame, keep: list[str], model: QualityModel) -> DataFrame:
    """``keep``, then the score of each row's ``text``.

    Null texts count as empty, and those are one chunk without bytes. Texts are read whole, whatever their length. Repeated
    rows come out repeated, equal texts with equal scores. An empty frame gives no rows. Columns that are not in ``keep`` are
    dropped, whatever their names.
    """

    def make():
        return lambda text: (model.score(text),)

    return map_texts(df.select(*keep, F.col("text").alias("scored_text")), keep, make, "score double")
