"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of whole texts. Every passage is encoded as shares of character classes, word statistics and a hashed
bag of words, and mapped to a hidden vector. Gated attention weighs the passages; the weighted vector gives the score. All weights
are learned together from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import BLANK, LOWER, encoded, groups, map_slices, slices, span_hashes, spans_of

PASSAGE = 64
BAG = 32
HIDDEN = 16
#: Labelled documents that the model is fitted on, and passages of each, at most; scoring covers every document and passage.
FIT_DOCUMENTS, FIT_PASSAGES = 6000, 64
EPOCHS = 40
LIMIT = 0.3

_MARKS = b".,!?|*$%&#-:;'\"()/<>="
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:], _CLASS[BLANK] = 0, 1, 2, 3, 4
for _i, _b in enumerate(_MARKS):
    _CLASS[_b] = 6 + _i
_CLASSES = 6 + len(_MARKS)
WIDTH = _CLASSES + 5 + BAG


def passages(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: first, last + 1, a row of features per passage, and where each text's passages begin.

    A passage has PASSAGE words; a text without words has one passage of zeros.
    """
    raw = [encoded(t) for t in texts]
    for begin, end in groups(raw):
        data = np.frombuffer(b"\n".join(raw[begin:end]) + b"\n", np.uint8)
        first, last = spans_of(data)
        starts = np.cumsum([0, *(len(t) + 1 for t in raw[begin:end])])
        words = np.searchsorted(first, starts)
        count = np.diff(words)
        bags = np.maximum(1, -(-count // PASSAGE))
        offsets = np.concatenate(([0], np.cumsum(bags)))
        doc = np.repeat(np.arange(end - begin), count)
        of_word = offsets[doc] + (np.arange(len(first)) - words[doc]) // PASSAGE
        total = int(offsets[-1])
        # bytes belong to the passage of the last word that began before them
        of_byte = np.repeat(offsets[:-1], np.diff(starts))
        if len(first):
            step = np.zeros(len(data), np.int64)
            step[first[1:]] = np.diff(of_word)
            step[0] = of_word[0]
            own = np.cumsum(step)
            of_byte = np.maximum(own, of_byte)
        shares = np.bincount(of_byte * _CLASSES + _CLASS[data], minlength=total * _CLASSES).reshape(total, _CLASSES).astype(np.float32)
        size = np.bincount(of_byte, minlength=total).astype(np.float32)
        shares /= np.maximum(size, 1)[:, None]
        n = np.bincount(of_word, minlength=total).astype(np.float32)
        low = span_hashes(LOWER[data], first, last)
        order = np.lexsort((low, of_word))
        new = np.ones(len(low), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
        distinct = np.bincount(of_word[order][new], minlength=total)
        upper = (data[first] >= 65) & (data[first] <= 90) if len(first) else np.zeros(0, bool)
        caps = upper & (data[np.maximum(last - 1, 0)] < 91) & (last - first > 2) if len(first) else upper
        more = np.stack([
            np.log1p(n) / 5, distinct / np.maximum(n, 1), np.bincount(of_word, last - first, total) / np.maximum(n, 1) / 10,
            np.bincount(of_word, upper, total) / np.maximum(n, 1), np.bincount(of_word, caps, total) / np.maximum(n, 1),
        ], axis=1)
        bag = np.bincount(of_word * BAG + (low % np.uint64(BAG)).astype(np.int64), minlength=total * BAG).reshape(total, BAG)
        bag = bag / np.maximum(n, 1)[:, None]
        yield begin, end, np.hstack([shares * 4, more, bag]).astype(np.float32), offsets


def _sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts[:-1], axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Hidden vectors, gates, attention and probabilities of bags of passages."""
    h = np.tanh(((x - m["mean"]) / m["scale"]) @ m["encode"] + m["encode_b"])
    t, g = np.tanh(h @ m["content"]), _sigmoid(h @ m["gate"])
    s = (t * g) @ m["attend"]
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    e = np.exp(s - np.maximum.reduceat(s, starts[:-1])[doc])
    a = e / _sums(e, starts)[doc]
    z = _sums(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "doc": doc, "p": _sigmoid(z @ m["score"] + m["score_b"])}


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """All weights by Adam on the log loss of whole documents; the same input gives the same model."""
    random = np.random.default_rng(seed)
    m = {
        "encode": random.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), "encode_b": np.zeros(HIDDEN),
        "content": random.normal(0, 0.3, (HIDDEN, HIDDEN)), "gate": random.normal(0, 0.3, (HIDDEN, HIDDEN)),
        "attend": random.normal(0, 0.3, HIDDEN), "score": random.normal(0, 0.3, HIDDEN), "score_b": np.zeros(1),
    }
    learned = list(m)
    m["mean"], m["scale"] = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(WIDTH), np.ones(WIDTH))
    moment = {k: (np.zeros_like(m[k]), np.zeros_like(m[k])) for k in learned}
    step, n = 0, len(y)
    for _ in range(epochs if n else 0):
        for docs in np.array_split(random.permutation(n), max(1, n // 128)):
            rows = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in docs])
            own = np.concatenate(([0], np.cumsum(starts[docs + 1] - starts[docs])))
            f = forward(m, x[rows], own)
            h, t, g, a, doc = f["h"], f["t"], f["g"], f["a"], f["doc"]
            miss = (f["p"] - y[docs]) / len(docs)
            dz = miss[:, None] * m["score"]
            da = (h * dz[doc]).sum(1)
            ds = a * (da - _sums(a * da, own)[doc])
            gated = ds[:, None] * m["attend"]
            dt, dg = gated * g * (1 - t * t), gated * t * g * (1 - g)
            dh = a[:, None] * dz[doc] + dt @ m["content"].T + dg @ m["gate"].T
            pre = dh * (1 - h * h)
            found = {
                "encode": ((x[rows] - m["mean"]) / m["scale"]).T @ pre, "encode_b": pre.sum(0), "content": h.T @ dt, "gate": h.T @ dg,
                "attend": (t * g).T @ ds, "score": f["z"].T @ miss, "score_b": miss.sum(keepdims=True),
            }
            step += 1
            for k in learned:
                d = found[k] + 1e-4 * m[k]
                first, second = moment[k]
                first += 0.1 * (d - first)
                second += 0.001 * (d * d - second)
                m[k] = m[k] - 0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return m


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """A model from labelled rows that aren't held out.

    At most FIT_DOCUMENTS ids are taken, by a hash of the id, one row of each and FIT_PASSAGES passages of that, spread evenly over the
    whole text, so at most 100 MB reach the driver. Null labels are left out; of several labels of a document the highest counts.
    Without labels the model scores about one half.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("y"))
    some = known.filter(~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCUMENTS)
    texts = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min_by(F.struct("text", "y"), F.xxhash64("text")).alias("row")).select("doc_id", "row.*")

    def features(batches):
        for df in batches:
            ids, y = df["doc_id"].tolist(), df["y"].tolist()
            for begin, end, x, starts in passages(df["text"].tolist()):
                rows = []
                for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist()), begin):
                    at = np.unique(np.linspace(a, b - 1, min(FIT_PASSAGES, b - a)).astype(np.int64))
                    rows.append((int(ids[i]), int(y[i]), x[at].tobytes()))
                yield pd.DataFrame(rows, columns=["doc_id", "y", "x"])

    rows = map_slices(one, features, "doc_id long, y int, x binary").toPandas()
    rows = rows.sort_values("doc_id").reset_index(drop=True)
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["x"]]
    starts = np.concatenate(([0], np.cumsum([len(b) for b in bags]))).astype(np.int64)
    return fit(np.concatenate(bags) if bags else np.zeros((0, WIDTH), np.float32), starts, rows["y"].to_numpy(float))


def with_scores(docs: DataFrame, model: dict[str, np.ndarray], column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; a null text scores as an empty one."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            p = [forward(held.value, x, starts)["p"] for _, _, x, starts in passages(batch.column(at).to_pylist())]
            made = pa.array(np.concatenate(p) if p else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{column}` double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; a null id is not held out.

    Repeated rows are scored each, null texts as empty ones. No rows give no rows. Texts are read whole. Other columns are not looked at.
    """
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
