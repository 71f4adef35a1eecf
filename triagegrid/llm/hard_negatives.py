"""Hard negatives by angular triangle filtering.

Every vector's angles to a set of reference directions are computed once and stored with it. For an anchor and a candidate, the
angle between them lies between the largest difference and the smallest sum of their angles to one reference, so its cosine lies in
an interval; with both lengths, and widened for rounding, that bounds the integer score from both sides. Only candidates whose
bounds overlap a window that is still open are scored in integers.

Vectors are sorted by dimension, label and nearest reference and cut into blocks of equal size, so a hot label or direction is many
blocks. A block keeps the range of its angles and lengths; pairs of an anchor block and a candidate block whose bounds overlap no
window never meet.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm.common import stored
from triagegrid.operators.order_index import OrderIndex

#: Reference directions and the sample that they and the first thresholds come from; both only change how much is ruled out.
REFERENCES = 24
SAMPLE = 2048
BLOCK = 4096
ANCHOR_BLOCK = 512
#: By how much bounds are widened: relative to the product of the lengths, and at least.
SLACK = 1e-6
_EXACT = float(2**53)
_LIMITS = "label_range array<int>, low array<double>, high array<double>, lengths array<double>, windows array<double>"
_PACKED = f"block long, dim int, rows binary, ids binary, labels binary, vectors binary, angles binary, more binary, {_LIMITS}"
_NAMES = [field.split()[0] for field in _PACKED.split(", ")]
#: Pairs of vectors whose bounds a task holds at once.
_CELLS = 1_000_000


def labelled_vectors(embeddings: DataFrame, flip_every: int = 7, classes: int = 10) -> DataFrame:
    """(row, vec_id, label, v): floor(256 * x) of each component, and a number that tells rows of one id apart.

    Rows without an id or a label, and rows whose vector is null or holds a null or non-finite component, are left out. Where the id
    is divisible by ``flip_every`` the label moves on by one.
    """
    x = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("e")
    )
    usable = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % flip_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    kept = x.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & usable)
    v = F.transform("e", lambda c: F.floor(256 * c))
    return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", label.cast("int").alias("label"), v.alias("v"))


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a vector of length 0 has direction 0."""
    x = vectors.astype(float)
    length = np.sqrt(np.square(x).sum(1))
    return x / np.maximum(length, 1e-300)[:, None], length


def spread_directions(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions of the sample with large angles between them."""
    x, length = unit(sample)
    x = x[length > 0]
    if not len(x):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(count, len(x)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def angles(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(vectors)[0] @ references.T, -1, 1))


def score_bounds(nearest: np.ndarray, farthest: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores from bounds of angles and of the products of lengths, widened for rounding."""
    low, high = np.cos(np.minimum(farthest, np.pi)), np.cos(np.clip(nearest, 0, np.pi))
    room = SLACK * most + 1
    return np.where(low < 0, low * most, low * least) - room, np.where(high < 0, high * least, high * most) + room


def pair_bounds(a: np.ndarray, a_length: np.ndarray, c: np.ndarray, c_length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of every anchor (rows) and candidate (columns) from their angles to the references."""
    nearest = np.zeros((len(a), len(c)))
    farthest = np.full((len(a), len(c)), np.pi)
    for r in range(a.shape[1]):
        x, y = a[:, r, None], c[None, :, r]
        np.maximum(nearest, np.abs(x - y), out=nearest)
        both = x + y
        np.minimum(farthest, np.minimum(both, 2 * np.pi - both), out=farthest)
    product = a_length[:, None] * c_length
    return score_bounds(nearest, farthest, product, product)


def integer_scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of one vector with several, in doubles where they hold all sums."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, len(a))
    return (c.astype(float) @ a.astype(float)).astype(np.int64) if top < _EXACT else c @ a


def first_ones(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


class Block:
    """One packed block: rows, ids, labels, vectors, angles, lengths and what else was stored with each vector."""

    def __init__(self, raw, prefix: str = ""):
        get = lambda name: getattr(raw, prefix + name)
        self.rows, self.ids = np.frombuffer(get("rows"), np.int64), np.frombuffer(get("ids"), np.int64)
        self.labels = np.frombuffer(get("labels"), np.int32)
        n = len(self.rows)
        shape = lambda raw, kind: np.frombuffer(raw, kind).reshape(n, -1) if len(raw) else np.zeros((n, 0), kind)
        self.vectors, self.angles, self.more = shape(get("vectors"), np.int64), shape(get("angles"), float), shape(get("more"), np.int64)
        self.lengths = unit(self.vectors)[1]


def bounded(a: Block, c: Block):
    """Number, lower and upper score bounds of each anchor of a block."""
    wide = max(1, _CELLS // max(1, len(c.rows)))
    for begin in range(0, len(a.rows), wide):
        low, high = pair_bounds(a.angles[begin : begin + wide], a.lengths[begin : begin + wide], c.angles, c.lengths)
        yield from zip(range(begin, begin + len(low)), low, high)


def best_positives(a: Block, c: Block, k: int) -> list[tuple]:
    """(anchor row, candidate id, score): the k best of the block for each anchor among other rows of its label.

    ``more`` holds a score below which no candidate is wanted.
    """
    out = []
    for i, low, high in bounded(a, c):
        left = np.flatnonzero((c.labels == a.labels[i]) & (c.rows != a.rows[i]) & (high >= a.more[i, 0]))
        if len(left) > k:  # k candidates reach the k-th highest lower bound
            left = left[high[left] >= np.partition(low[left], -k)[-k]]
        scores = integer_scores(a.vectors[i], c.vectors[left])
        for at in first_ones(scores, c.ids[left], k):
            if scores[at] >= a.more[i, 0]:
                out.append((int(a.rows[i]), int(c.ids[left[at]]), int(scores[at])))
    return out


def window_negatives(a: Block, c: Block, k: int) -> list[tuple]:
    """(anchor row, number of the positive, candidate id, score): the k first of the block in each window, other labels only.

    ``more`` holds the lower and upper ends of an anchor's windows in turn; a window whose lower end is above its upper end is empty.
    """
    out = []
    for i, low, high in bounded(a, c):
        ends = a.more[i].reshape(-1, 2)
        overlaps = np.zeros(len(c.rows), bool)
        for begin, end in ends:
            if begin <= end:
                overlaps |= (high >= begin) & (low <= end)
        left = np.flatnonzero(overlaps & (c.labels != a.labels[i]))
        if not len(left):
            continue
        scores, ids = integer_scores(a.vectors[i], c.vectors[left]), c.ids[left]
        for number, (begin, end) in enumerate(ends):
            inside = np.flatnonzero((scores >= begin) & (scores <= end))
            for at in inside[first_ones(scores[inside], ids[inside], k)]:
                out.append((int(a.rows[i]), number, int(ids[at]), int(scores[at])))
    return out


def blocks_of(vectors: DataFrame, size: int, shared, more) -> DataFrame:
    """Vectors (row, vec_id, label, v, further columns) as packed blocks of at most ``size`` rows of one dimension, alike ones together.

    ``more`` gives a whole number array for a block's frame; see ``best_positives`` and ``window_negatives``.
    """

    def nearest(batches):
        for df in batches:
            cell = np.zeros(len(df), np.int64)
            dims = df["v"].map(len).to_numpy()
            for dim in set(dims.tolist()):
                at = np.flatnonzero(dims == dim)
                references = shared.value["references"].get(dim)
                if references is not None and len(references):
                    cell[at] = angles(np.array(df["v"].iloc[at].tolist(), np.int64), references).argmin(1)
            yield df.assign(dim=dims.astype(np.int32), cell=cell)

    def pack(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        block, dim = key
        x = np.array(df["v"].tolist(), np.int64).reshape(len(df), dim)
        references = shared.value["references"].get(dim, np.zeros((0, dim)))
        far, length, extra = angles(x, references), unit(x)[1], more(df, x)
        labels = df["label"].to_numpy(np.int32)
        whole = [labels.min(), labels.max()], far.min(0), far.max(0), [length.min(), length.max()]
        windows = extra.reshape(len(df), -1, 2) if extra.shape[1] > 1 else np.zeros((0, 1, 2))
        windows = windows[windows[:, :, 0] <= windows[:, :, 1]]
        limits = [windows[:, 0].min(), windows[:, 1].max()] if len(windows) else []
        if extra.shape[1] == 1:
            limits = [extra.min()]
        packed = [df["row"].to_numpy(np.int64), df["vec_id"].to_numpy(np.int64), labels, x, far, extra.astype(np.int64)]
        ranges = [[int(v) for v in whole[0]], *(np.asarray(w, float).tolist() for w in (*whole[1:], limits))]
        return pd.DataFrame([(block, dim, *(p.tobytes() for p in packed), *ranges)], columns=_NAMES)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    placed = vectors.mapInPandas(nearest, f"{fields}, dim int, cell long")
    order = OrderIndex(placed, ["dim", "label", "cell", F.xxhash64("row")]).numbered("place")
    dealt = order.withColumn("block", F.floor(F.col("place") / size).cast("long"))
    return stored(dealt.groupBy("block", "dim").applyInPandas(pack, _PACKED), "blocks")


def _meeting(anchors: DataFrame, candidates: DataFrame, same_label: bool) -> DataFrame:
    """(a_block, block, dim): pairs of blocks whose bounds leave room for a wanted score. Only ranges travel here, no vectors."""
    limits = ["block", "dim", "label_range", "low", "high", "lengths", "windows"]
    left = anchors.select(*[F.col(c).alias(c if c == "dim" else f"a_{c}") for c in limits])
    pairs = left.join(candidates.select(*limits[:-1]), "dim")
    a, c = F.col("a_label_range"), F.col("label_range")
    alike = (a[0] <= c[1]) & (c[0] <= a[1])
    pairs = pairs.filter(alike if same_label else (a[0] != a[1]) | (c[0] != c[1]) | (a[0] != c[0]))

    def with_room(batches):
        for df in batches:
            keep = []
            for r in df.itertuples(index=False):
                if not len(r.a_windows):
                    keep.append(False)
                    continue
                al, ah, cl, ch = (np.asarray(x, float) for x in (r.a_low, r.a_high, r.low, r.high))
                nearest = np.maximum(np.maximum(cl - ah, al - ch), 0).max(initial=0)
                both = np.maximum(ah + ch, 0)
                sure = np.where(both <= np.pi, both, np.where(al + cl >= np.pi, 2 * np.pi - (al + cl), np.pi))
                least, most = r.a_lengths[0] * r.lengths[0], r.a_lengths[1] * r.lengths[1]
                low, high = score_bounds(np.array(nearest), np.array(sure.min(initial=np.pi)), np.array(least), np.array(most))
                keep.append(bool(high >= r.a_windows[0] and (len(r.a_windows) < 2 or low <= r.a_windows[1])))
            yield df.loc[keep, ["a_block", "block", "dim"]]

    return pairs.mapInPandas(with_room, "a_block long, block long, dim int")


def _searched(anchors: DataFrame, candidates: DataFrame, same_label: bool, search, schema: str) -> DataFrame:
    """What ``search`` finds in all pairs of blocks that may hold something."""
    packed = ["rows", "ids", "labels", "vectors", "angles", "more"]
    left = anchors.select(F.col("block").alias("a_block"), "dim", *[F.col(c).alias(f"a_{c}") for c in packed])
    pairs = _meeting(anchors, candidates, same_label).join(candidates.select("block", "dim", *packed), ["block", "dim"])
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for df in batches:
            for r in df.itertuples(index=False):
                yield pd.DataFrame(search(Block(r, "a_"), Block(r)), columns=names)

    return pairs.join(left, ["a_block", "dim"]).repartition(F.col("block"), F.col("a_block")).mapInPandas(run, schema)


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 5, every: int = 100, share: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. Their positives are the best other rows of their label, and the hard
    negatives of a positive are the best rows of other labels that score at most as high and at least ``share`` per cent of it.
    Only vectors of one length are compared. A row that is given twice counts twice, as anchor, too. Scores are exact while they
    fit in a long. Anchors without positives, and positives without negatives, give no rows; neither do empty tables. Columns other
    than vec_id, label and embedding are not looked at.
    """
    spark = embeddings.sparkSession
    vectors = stored(labelled_vectors(embeddings), "vectors")
    rows = vectors.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).collect()
    sample = {}
    for dim in {len(r.v) for r in rows}:
        own = [r for r in rows if len(r.v) == dim]
        sample[dim] = (
            np.array([r.row for r in own], np.int64), np.array([r.vec_id for r in own], np.int64),
            np.array([r.label for r in own], np.int32), np.array([r.v for r in own], np.int64).reshape(len(own), dim),
        )
    shared = spark.sparkContext.broadcast({"sample": sample, "references": {d: spread_directions(s[3], REFERENCES) for d, s in sample.items()}})
    floor = np.iinfo(np.int64).min

    def least_positive(df: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        """Per anchor a score that enough positives of the sample reach."""
        out = np.full((len(df), 1), floor)
        if x.shape[1] in shared.value["sample"]:
            s_rows, _, s_labels, s = shared.value["sample"][x.shape[1]]
            for i, (row, label) in enumerate(zip(df["row"], df["label"])):
                scores = integer_scores(x[i], s[(s_labels == label) & (s_rows != row)])
                if len(scores) >= positives:
                    out[i] = np.partition(scores, -positives)[-positives]
        return out

    def windows(df: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        """Per positive the lower and the upper end of its window, the lower one raised to what enough negatives of the sample reach."""
        out = np.tile(np.array([1, 0]), (len(df), positives))
        for i, (label, scores) in enumerate(zip(df["label"], df["scores"])):
            known = np.zeros(0, np.int64)
            if x.shape[1] in shared.value["sample"]:
                _, _, s_labels, s = shared.value["sample"][x.shape[1]]
                known = integer_scores(x[i], s[s_labels != label])
            for number, score in enumerate(scores):
                begin = -(-share * int(score) // 100)
                inside = known[(known >= begin) & (known <= score)]
                if len(inside) >= negatives:
                    begin = int(np.partition(inside, -negatives)[-negatives])
                out[i, 2 * number : 2 * number + 2] = begin, score
        return out

    anchors = vectors.filter(F.col("vec_id") % every == 0)
    candidates = blocks_of(vectors, BLOCK, shared, lambda df, x: np.zeros((len(df), 0), np.int64))
    asked = blocks_of(anchors, ANCHOR_BLOCK, shared, least_positive)
    found = _searched(asked, candidates, True, lambda a, c: best_positives(a, c, positives), "row long, positive_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id")
    ranked = found.withColumn("number", F.row_number().over(order) - 1).filter(F.col("number") < positives)
    chosen = stored(ranked, "positives")
    lists = chosen.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "score"))), lambda p: p["score"]).alias("scores"))
    open_anchors = blocks_of(anchors.join(lists, "row"), ANCHOR_BLOCK, shared, windows)
    hits = _searched(
        open_anchors, candidates, False, lambda a, c: window_negatives(a, c, negatives), "row long, number int, negative_id long, negative_score long"
    )
    order = Window.partitionBy("row", "number").orderBy(F.desc("negative_score"), "negative_id")
    first = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = chosen.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return first.join(named, ["row", "number"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )
