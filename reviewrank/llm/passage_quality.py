"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of equal word counts. Every passage is encoded as features of its form and
a hidden layer; a gated attention layer weighs the passages (Ilse et al., "Attention-based Deep Multiple
Instance Learning", 2018); the weighted passage representation is scored. Weights are learned from
document labels only, by gradient descent over a bounded sample of labelled documents, in one task.

Features are encoded where the texts are; what leaves the tasks is a score. Passages of a text are encoded
in blocks and pooled by a running, rescaled sum, so a text of any length takes constant memory.

Defined cases: a null or blank text is one empty passage; with no labelled row, or one class only, the
score is the share of label 1 (a half without any); contradicting labels of one document both count;
repeated rows are scored one by one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewrank.llm.arrays import drawn

#: Documents of the training sample at most (about, by hash of doc_id), and passages of each while training.
SAMPLE_DOCS, SAMPLE_PASSAGES = 4_000, 64
PASSAGE_WORDS, HIDDEN, ATTENTION, EPOCHS, RATE = 60, 16, 8, 150, 0.01
HASHED = 24


def _encoder(passage_words: int) -> Callable[[str | None], Iterator[np.ndarray]]:
    """Features of a text's passages, in blocks of rows; nested to be shipped by value."""

    def shape(part: list[str]) -> list[float]:
        import zlib

        text = " ".join(part)
        n, size = max(len(part), 1), max(len(text), 1)
        upper = sum(map(str.isupper, text))
        letters = sum(map(str.isalpha, text))
        digits = sum(map(str.isdigit, text))
        marks = size - letters - digits - (len(part) - 1)
        symbols = sum(map(text.count, "#*$%&|<>"))
        kinds = len(set(part))
        repeats = sum(a == b for a, b in zip(part, part[1:]))
        pairs = len(set(zip(part, part[1:])))
        first = [
            upper / size, letters / size, digits / size, marks / size, symbols / size,
            text.count("!") / n, text.count(".") / n, text.count(",") / n,
            kinds / n, pairs / n, repeats / n, size / n / 10,
            sum(not any(map(str.isalpha, w)) for w in part) / n,
            sum(len(w) <= 3 for w in part) / n, len(part) / passage_words,
        ]
        hashed = [0.0] * hashed_size
        for w in part:
            hashed[zlib.crc32(w[-1:].encode("utf-8", "surrogatepass")) % hashed_size] += 1 / n
        return first + hashed

    hashed_size = HASHED

    def encode(text: str | None) -> Iterator[np.ndarray]:
        import numpy as np

        words = (text or "").split()
        for i in range(0, max(len(words), 1), 64 * passage_words):
            block = words[i : i + 64 * passage_words]
            parts = [block[j : j + passage_words] for j in range(0, max(len(block), 1), passage_words)]
            yield np.array([shape(p) for p in parts])

    return encode


FEATURES = 15 + HASHED


def _trainer(hidden: int, attention: int, epochs: int, rate: float) -> Callable:
    def fit(bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Adam over the mean log loss; all bags in one batch, bounded by the sample."""
        import numpy as np

        x = np.concatenate(bags)
        sizes = np.array([len(b) for b in bags])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        bag = np.repeat(np.arange(len(bags)), sizes)
        mean, spread = x.mean(0), x.std(0) + 1e-6
        x = np.clip((x - mean) / spread, -6, 6)
        rng = np.random.default_rng(7)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
        p = {"W": draw(x.shape[1], hidden), "b": np.zeros(hidden), "V": draw(hidden, attention), "U": draw(hidden, attention), "w": draw(attention), "o": draw(hidden), "c": np.zeros(1)}
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)) / len(labels)
        for t in range(1, epochs + 1):
            h = np.tanh(x @ p["W"] + p["b"])
            v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
            e = (v * u) @ p["w"]
            a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
            a /= np.add.reduceat(a, starts)[bag]
            z = np.add.reduceat(a[:, None] * h, starts)
            y = 1 / (1 + np.exp(-(z @ p["o"] + p["c"])))
            d = (y - labels) * weight
            dz = d[:, None] * p["o"]
            da = (dz[bag] * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, starts)[bag])
            dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
            dh = (a[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            g = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de, "o": z.T @ d, "c": d.sum(keepdims=True)}
            for k in p:
                grad = g[k] + 1e-4 * p[k] * (k != "c")
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return p | {"mean": mean, "spread": spread}

    return fit


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, np.ndarray]:
    """Weights from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality``), which need not be balanced.

    The sample is chosen by the hash of doc_id before any text is read; it is trained in one task.
    """
    marked = labels.where("quality is not null").select("doc_id", "quality")
    rows = marked.count()
    if not rows:
        return {"constant": np.array([0.5])}
    share = drawn(sample_docs, rows, F.lit("quality"), "doc_id")
    sample = docs.select("doc_id", "text").join(marked.where(share), "doc_id")
    encode, fit = _encoder(PASSAGE_WORDS), _trainer(HIDDEN, ATTENTION, EPOCHS, RATE)
    most, features = SAMPLE_PASSAGES, FEATURES

    def bags(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                x = np.concatenate([*encode(text)])
                # An even choice of passages while training; scoring uses all of them.
                out.append(x[np.linspace(0, len(x) - 1, min(len(x), most)).astype(int)].astype("f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(out, pa.binary())], ["doc_id", "quality", "bag"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = sample.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(bags, f"doc_id {kind}, quality int, bag binary")

    def learn(batches: Iterator) -> Iterator:
        import io

        import numpy as np
        import pyarrow as pa

        rows = sorted((r["doc_id"], r["quality"], r["bag"]) for b in batches for r in b.to_pylist())
        y = np.array([r[1] for r in rows], float)
        if len(set(y)) < 2:
            model = {"constant": np.array([y.mean() if len(y) else 0.5])}
        else:
            model = fit([np.frombuffer(r[2], "f4").reshape(-1, features).astype(float) for r in rows], y)
        held = io.BytesIO()
        np.savez(held, **model)
        yield pa.RecordBatch.from_arrays([pa.array([held.getvalue()])], ["model"])

    import io

    packed = encoded.repartition(1).mapInArrow(learn, "model binary").first()
    return dict(np.load(io.BytesIO(bytes(packed["model"]))))


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (``doc_id, text``), over all passages."""
    encode = _encoder(PASSAGE_WORDS)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def judge(text: str | None) -> float:
            if "constant" in model:
                return float(model["constant"][0])
            top, weight, pooled = -np.inf, 0.0, 0.0
            for x in encode(text):
                h = np.tanh(np.clip((x - model["mean"]) / model["spread"], -6, 6) @ model["W"] + model["b"])
                e = (np.tanh(h @ model["V"]) / (1 + np.exp(-(h @ model["U"])))) @ model["w"]
                new = max(top, e.max())
                a, scale = np.exp(e - new), np.exp(top - new)
                weight, pooled, top = weight * scale + a.sum(), pooled * scale + a @ h, new
            return float(1 / (1 + np.exp(-(pooled / weight @ model["o"] + model["c"][0]))))

        for batch in batches:
            found = [judge(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
