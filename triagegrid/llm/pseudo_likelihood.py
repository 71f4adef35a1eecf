"""LM scoring by masked pseudo-likelihood.

Words belong to classes: the most frequent words have one each, all others share classes by their form. A network sees the classes
beside a masked word and predicts its class; it is trained on how often each class stands between each pair of classes in all
documents. Classes farther off scale that prediction: for each place, by how much more often a class goes with one there than the network
expects from the neighbours of the same words (a step of iterative scaling, from counts of all words). The word itself is predicted
given its class by its share of the class among all other words of the corpus, the masked one left out, from a table that stays in
Spark. A document's score is the sum of the log-probabilities of all its words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import LOWER, encoded, groups, map_slices, mix, signed, slices, span_hashes, spans_of, stored

#: Classes: 0 is the edge of a text, then the frequent words, then FORMS classes of other words. They bound the counts to CLASSES**3.
CLASSES, FORMS = 128, 31
HIDDEN = 32
EPOCHS = 60
_FREQUENT = CLASSES - FORMS - 1
#: Places of the farther classes, the words by which their counts are smoothed, and the largest shift of a log-probability.
FAR, SMOOTH, SHIFT = (-2, 2), 4.0, 8.0
#: What every word of a class counts before the corpus is looked at.
UNSEEN = 0.1
#: The most frequent words whose shares each task holds; those of all others are joined. It changes speed, not results.
HELD = 100_000


def _words(texts: list[str | None]):
    """For ranges of texts: first, last + 1, hashes of words, their form classes and where each text's words begin."""
    raw = [encoded(t) for t in texts]
    for begin, end in groups(raw):
        data = LOWER[np.frombuffer(b"\n".join(raw[begin:end]) + b"\n", np.uint8)]
        first, last = spans_of(data)
        tail = data[np.maximum(last - 1, 0)] if len(first) else np.zeros(0, np.uint8)
        letter = (tail >= 97) & (tail <= 122)
        length = np.minimum((last - first) // 3, 4)
        kind = np.where(letter, 0, np.where(tail >= 128, 1, np.where((tail >= 48) & (tail <= 57), 2, np.where(tail == 46, 3, np.where(tail == 44, 4, 5)))))
        form = 1 + _FREQUENT + (kind * 5 + length) % FORMS
        starts = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in raw[begin:end])]))
        yield begin, end, span_hashes(data, first, last), form, starts


def _count_words(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def counted():
        words, form = (np.concatenate(x) for x in zip(*held))
        x, at, n = np.unique(words, return_index=True, return_counts=True)
        return pd.DataFrame({"word": signed(x), "form": form[at].astype(np.int32), "n": n.astype(np.int64)})

    for df in batches:
        for _, _, words, form, _ in _words(df["text"].tolist()):
            held.append((words, form))
            size += len(words)
            if size > 2_000_000:
                yield counted()
                held, size = [], 0
    if size:
        yield counted()


def word_counts(texts: DataFrame) -> DataFrame:
    """Every word of all texts: word (hash), form (class by its form), n."""
    counted = map_slices(texts, _count_words, "word long, form int, n long")
    return stored(counted.groupBy("word").agg(F.max("form").alias("form"), F.sum("n").alias("n")), "words")


def frequent_words(counts: DataFrame) -> np.ndarray:
    """Hashes of the words that have a class of their own, sorted."""
    return np.sort(np.array([r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(_FREQUENT).collect()], np.int64).view(np.uint64))


def word_shares(counts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Log of each word's share of its class, one occurrence left out: word, n, share. Words with a class of their own are left out."""
    rest = counts.filter(~F.col("word").isin(signed(frequent).tolist()))
    whole = rest.groupBy("form").agg(F.sum("n").alias("whole"), F.count("*").alias("kinds"))
    share = (F.col("n") - 1 + UNSEEN) / (F.col("whole") - 1 + UNSEEN * F.col("kinds"))
    return rest.join(F.broadcast(whole), "form").select("word", "n", F.log(share).alias("share"))


def classes_of(words: np.ndarray, form: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return form
    at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return np.where(frequent[at] == words, 1 + at, form)


def _contexts(cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes before and after each word; 0 at the edges of its text."""
    before, after = np.zeros_like(cls), np.zeros_like(cls)
    before[1:], after[:-1] = cls[:-1], cls[1:]
    edges = starts[:-1][np.diff(starts) > 0]
    before[edges] = 0
    after[starts[1:][np.diff(starts) > 0] - 1] = 0
    return before, after


def _at(cls: np.ndarray, starts: np.ndarray, offset: int) -> np.ndarray:
    """Class that stands ``offset`` words after each word; 0 beyond its text."""
    n = np.repeat(starts[1:], np.diff(starts)), np.repeat(starts[:-1], np.diff(starts))
    at = np.arange(len(cls)) + offset
    return np.where((at >= n[1]) & (at < n[0]), cls[np.clip(at, 0, max(len(cls) - 1, 0))], 0)


def window_counts(texts: DataFrame, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """How often each class stands between each pair of classes in all texts, and with each class at each of the places FAR.

    The third part has, in a table, how often each pair of neighbours goes with each class at a place: number of the place, pair, class
    there, n. Each task adds its own counts.
    """
    held = texts.sparkSession.sparkContext.broadcast(frequent)
    beside = CLASSES**3 + len(FAR) * CLASSES**2
    cells = beside + len(FAR) * CLASSES**3

    def count(batches):
        total = np.zeros(cells, np.int32)
        for df in batches:
            for _, _, words, form, starts in _words(df["text"].tolist()):
                if len(words):
                    cls = classes_of(words, form, held.value)
                    before, after = _contexts(cls, starts)
                    pair = before * CLASSES + after
                    found = [pair * CLASSES + cls]
                    for i, offset in enumerate(FAR):
                        far = _at(cls, starts, offset)
                        found += [CLASSES**3 + i * CLASSES**2 + far * CLASSES + cls, beside + i * CLASSES**3 + pair * CLASSES + far]
                    for at in found:
                        at, n = np.unique(at, return_counts=True)
                        total[at] += n.astype(np.int32)
        at = np.flatnonzero(total)
        for begin in range(0, len(at), 200_000):
            yield pd.DataFrame({"at": at[begin : begin + 200_000].astype(np.int32), "n": total[at[begin : begin + 200_000]]})

    rows = stored(map_slices(texts, count, "at int, n int"), "windows")
    found = rows.filter(F.col("at") < beside).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(beside)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    near, far = out[: CLASSES**3].reshape(CLASSES * CLASSES, CLASSES), out[CLASSES**3 :].reshape(len(FAR), CLASSES, CLASSES)
    return near, far, rows.filter(F.col("at") >= beside).select((F.col("at") - beside).alias("at"), "n")


def expected(joint: DataFrame, table: np.ndarray) -> np.ndarray:
    """How often the network expects each class with each class at each of the places FAR."""
    held = joint.sparkSession.sparkContext.broadcast(table)
    size = len(FAR) * CLASSES

    def add(batches):
        share, total = np.exp(held.value), np.zeros((size, CLASSES))
        for df in batches:
            at, n = df["at"].to_numpy(np.int64), df["n"].to_numpy(np.float32)
            row = at // CLASSES**3 * CLASSES + at % CLASSES
            order = np.argsort(row, kind="stable")
            edge = np.searchsorted(row[order], np.arange(size + 1))
            for k in np.flatnonzero(np.diff(edge)):
                own = order[edge[k] : edge[k + 1]]
                total[k] += n[own] @ share[at[own] % CLASSES**3 // CLASSES]
        yield pd.DataFrame({"place": np.arange(size), "total": total.tolist()})

    rows = joint.mapInPandas(add, "place int, total array<double>")
    rows = rows.select("place", F.posexplode("total").alias("cls", "n")).groupBy("place", "cls").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((size, CLASSES))
    out[rows["place"].to_numpy(), rows["cls"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(len(FAR), CLASSES, CLASSES)


def shifts(far: np.ndarray, expect: np.ndarray) -> np.ndarray:
    """Log of how much more often than the network expects a class goes with one at each of the places FAR, smoothed."""
    expect = expect + 1e-6
    prior = SMOOTH * expect / expect.sum(2, keepdims=True)
    return np.clip(np.log((far + prior) / (expect + prior)), -SHIFT, SHIFT).astype(np.float32)


def _parts(cls: np.ndarray, starts: np.ndarray, table: np.ndarray, size: int = 4096):
    """Pieces of the words: their place, the network's log-probabilities of all classes and the classes at the places FAR."""
    before, after = _contexts(cls, starts)
    pair, far = before * CLASSES + after, [_at(cls, starts, offset) for offset in FAR]
    for begin in range(0, len(cls), size):
        piece = slice(begin, begin + size)
        yield piece, table[pair[piece]], [x[piece] for x in far]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def train(counts: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> np.ndarray:
    """Log-probabilities of each class for every pair of neighbours, from a network of two embeddings, a hidden layer and a softmax."""
    random = np.random.default_rng(seed)
    pairs = np.arange(CLASSES * CLASSES)
    left, right = pairs // CLASSES, pairs % CLASSES
    m = [random.normal(0, 0.3, s) for s in ((CLASSES, HIDDEN), (CLASSES, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES))]
    total = counts.sum(0) + 1.0
    m.append(np.log(total / total.sum()))
    m = [x.astype(np.float32) for x in m]
    moment = [(np.zeros_like(x), np.zeros_like(x)) for x in m]
    seen = np.flatnonzero(counts.sum(1))
    weight = counts[seen].astype(np.float32)
    step = 0
    for _ in range(epochs if len(seen) else 0):
        for rows in np.array_split(random.permutation(len(seen)), max(1, len(seen) // 2048)):
            a, b, w = left[seen[rows]], right[seen[rows]], weight[rows]
            w = w / w.sum()
            h = np.tanh(m[0][a] + m[1][b] + m[2])
            out = np.exp(_log_softmax(h @ m[3] + m[4])) * w.sum(1, keepdims=True) - w
            pre = (out @ m[3].T) * (1 - h * h)
            found = [np.zeros_like(m[0]), np.zeros_like(m[1]), pre.sum(0), h.T @ out, out.sum(0)]
            np.add.at(found[0], a, pre)
            np.add.at(found[1], b, pre)
            step += 1
            for i, d in enumerate(found):
                first, second = moment[i]
                first += 0.1 * (d - first)
                second += 0.001 * (d * d - second)
                m[i] = m[i] - np.float32(0.01) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return _log_softmax(np.tanh(m[0][left] + m[1][right] + m[2]) @ m[3] + m[4]).astype(np.float32)


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over all words), per_word for every row of ``docs``.

    A text without words, or a null one, has the sum 0 and no mean. Repeated rows are scored each and all count in training. Ids
    are passed through as they are. No rows give no rows. Texts are read whole, however long. Columns other than doc_id and text are
    not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select("text")
    counts = word_counts(texts)
    frequent = frequent_words(counts)
    shares = word_shares(counts, frequent)
    top = shares.orderBy(F.desc("n"), "word").limit(HELD).select("word", "share").toPandas().sort_values("word")
    near, far, joint = window_counts(texts, frequent)
    table = train(near)
    shift = shifts(far, expected(joint, table))
    held = spark.sparkContext.broadcast((frequent, table, shift, top["word"].to_numpy(np.int64), top["share"].to_numpy(np.float64)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        known, table, shift, top_words, top_shares = held.value
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            for begin, end, words, form, starts in _words(batch.column(1).to_pylist()):
                cls, size = classes_of(words, form, known), end - begin
                p = np.zeros(len(cls) + 1)
                for piece, z, far in _parts(cls, starts, table) if len(cls) else ():
                    for s, x in zip(shift, far):
                        z += s[x]
                    p[1:][piece] = z[np.arange(len(z)), cls[piece]] - np.log(np.exp(z).sum(1))
                word = signed(words)
                rare = cls > _FREQUENT
                if len(top_words):
                    found = np.minimum(np.searchsorted(top_words, word), len(top_words) - 1)
                    met = rare & (top_words[found] == word)
                    p[1:][met] += top_shares[found[met]]
                    rare &= ~met
                p = np.cumsum(p)
                # One row for each text, whose word stands for nothing, and one for each word whose share isn't held.
                of = (row + np.repeat(np.arange(size), np.diff(starts)))[rare]
                ids = row + np.arange(size)
                n_rare = len(of)
                nothing = pa.nulls(n_rare, batch.column(0).type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((ids, of))),
                        pa.concat_arrays([batch.column(0).slice(begin, size), nothing]),
                        pa.array(np.concatenate((np.diff(starts), np.zeros(n_rare))).astype(np.int64)),
                        pa.array(np.concatenate((p[starts[1:]] - p[starts[:-1]], np.zeros(n_rare)))),
                        pa.array(np.concatenate((signed(mix(ids.astype(np.uint64))), word[rare]))),
                        pa.array(np.concatenate((np.zeros(size), np.ones(n_rare))).astype(np.int32)),
                    ],
                    names=["row", "doc_id", "n_words", "classes", "word", "n"],
                )
                row += size

    rows = docs.select("doc_id", "text").mapInArrow(score, f"row long, doc_id {kind}, n_words long, classes double, word long, n int")
    total = F.sum(F.col("classes") + F.col("n") * F.coalesce("share", F.lit(0.0)))
    scored = rows.join(shares.select("word", "share"), "word", "left").groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.sum("n_words").alias("n_words"), total.alias("log_likelihood")
    )
    mean = F.try_divide("log_likelihood", "n_words").alias("per_word")
    return scored.select("doc_id", "n_words", "log_likelihood", mean)
