"""N-gram Jaccard join by vertical partitioning.

The global order of shingles puts light ones first, by hash, and those that many texts hold last, by how many do. All shingles of all
texts are counted, packed into arrays of digests that are dealt over the tasks by their upper bits, and the counts are kept as a sketch of
logarithms of fixed size; what shares a cell there only moves a shingle within the order. The order is cut into fragments: light shingles by hash
range, and the rest. Two texts that link must share one of the first shingles of their sets in this order, so candidates
come from those; the overlap of a candidate pair is counted in every fragment separately and summed per pair.

Texts with equal sets are one class, which stands for its copies from the start. Classes that share a leading shingle are first
paired with one hub of the shingle, and then, while that helps, those outside its largest component with one member of that,
taken among those that have most of their leading shingles in common with others; all this is linear in the rows. Only where a shingle
is then still shared by several components are their classes paired across components. A passage has many shingles that the same classes
share; these make each pair once, at the first of them. So no link between components is lost and a large group of near copies needs
no pairs within itself.

Each class carries the parities of its shingles' counts in MARKS cells. Cells in which two sets differ are at most as many as
the shingles that only one of them has, so they bound the overlap from above; candidates below the bound never fetch their sets.

Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm.common import id_filter, map_slices, mix, passes, shingle_sets, signed, stored, word_hashes

SIZE = 5
SHARE = 75
#: Shingles that fewer classes hold are light.
REPEATED = 16
#: Cells of the sketch of frequencies, a byte each.
SKETCH = 1 << 21
#: Shingles are counted by this many low bits, of which those above the first 32 say with which others; the cell is part of them.
DIGEST = 42
LIGHT_FRAGMENTS = 4
#: Rounds in which classes outside the largest component of a shingle try one of its members each go on while pairs across components
#: would be more than so many per row, and the last round has left at most this part of them. They change the work, not the result.
PAIRS, USEFUL = 16, 0.7
#: Cells of the parities of a set; more cells tell larger sets apart.
MARKS = 1024
_POOL = 1_000_000


def least_overlap(n: int, share: int) -> int:
    """Shingles that any partner of a set of n has in common with it."""
    return -(-n * share // 100)


def least_shared(n: int, m: int, share: int) -> int:
    """Shingles that linked sets of n and m have in common."""
    return -(-(n + m) * share // (100 + share))


def signature(shingles: np.ndarray) -> int:
    """A hash of a set; its sign keeps it a long."""
    if not len(shingles):
        return 0
    both = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    total = np.array([np.add.reduce(both), np.bitwise_xor.reduce(mix(both)), np.uint64(len(shingles))])
    total = mix(total[:1] ^ mix(total[1:2] ^ mix(total[2:])))
    return int(signed(mix(total))[0])


def marks_of(shingles: np.ndarray) -> np.ndarray:
    """The parities of the number of shingles in each cell, 64 to a long."""
    cells = np.bincount((shingles % np.uint64(MARKS)).astype(np.int64), minlength=MARKS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def sets_of(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    for _, _, words, starts in word_hashes(texts):
        yield from shingle_sets(words, starts, size)


def _read_sets(size: int) -> Callable:
    """Rows for each text: id, set size, class, parities."""

    def run(batches):
        for df in batches:
            sets = [(len(x), signature(x), marks_of(x)) for x in sets_of(df["text"].tolist(), size)]
            n, cls, marks = zip(*sets) if sets else ((), (), ())
            yield pd.DataFrame({"doc_id": df["doc_id"], "n": n, "cls": cls, "marks": marks})

    return run


def _packed(size: int) -> Callable:
    """The digests of all shingles by their upper bits: those that one class of a pool holds, and the others with how many do."""

    def packed(pool: list[np.ndarray]) -> pd.DataFrame:
        x, n = np.unique(np.concatenate(pool) & np.uint64((1 << DIGEST) - 1), return_counts=True)
        low, n = x.astype(np.uint32), n.astype(np.uint32)
        pieces, starts = np.unique((x >> np.uint64(32)).astype(np.int32), return_index=True)
        rows = []
        for piece, a, b in zip(pieces.tolist(), starts.tolist(), [*starts[1:].tolist(), len(x)]):
            several = n[a:b] > 1
            rows.append((piece, low[a:b][~several].tobytes(), low[a:b][several].tobytes(), n[a:b][several].tobytes()))
        return pd.DataFrame(rows, columns=["piece", "once", "often", "n"])

    def run(batches):
        pool, pooled, seen = [], 0, set()
        for df in batches:
            for x in sets_of(df["text"].tolist(), size):
                cls = signature(x)
                if len(x) and cls not in seen:
                    pool.append(x)
                    pooled += len(x)
                    seen.add(cls)
                if pooled > _POOL:
                    yield packed(pool)
                    pool, pooled, seen = [], 0, set()
        if pooled:
            yield packed(pool)

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells and levels of the shingles that are not light, from packed digests that come in the order of their pieces."""

    def counted(piece: int, values: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        x, at = np.unique(np.concatenate(values), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts))
        cell = (x[n >= REPEATED].astype(np.int64) | (piece << 32)) % SKETCH
        level = np.minimum(255, np.floor(8 * np.log2(n[n >= REPEATED]))).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(level)], ["cell", "level"])

    now, values, counts = None, [], []
    for batch in batches:
        for piece, once, often, n in zip(*(c.to_pylist() for c in batch.columns)):
            if piece != now and values:
                yield counted(now, values, counts)
                values, counts = [], []
            now = piece
            single = np.frombuffer(once, np.uint32)
            values += [single, np.frombuffer(often, np.uint32)]
            counts += [np.ones(len(single), np.uint32), np.frombuffer(n, np.uint32)]
    if values:
        yield counted(now, values, counts)


def frequent_cells(texts: DataFrame, size: int) -> DataFrame:
    """(cell, level) of each cell of the sketch that holds a shingle of at least REPEATED classes, from all texts.

    The level is the logarithm of how many hold the most frequent one. Copies that are read apart count each.
    """
    dealt = map_slices(texts, _packed(size), "piece int, once binary, often binary, n binary").repartition("piece")
    levels = dealt.sortWithinPartitions("piece").mapInArrow(_levels, "cell int, level int")
    return levels.groupBy("cell").agg(F.max("level").alias("level"))


class Order:
    """The global order: by level, which is 0 for light shingles and grows with the logarithm of the frequency, then by hash."""

    def __init__(self, levels: DataFrame):
        """``levels`` has the cells whose level is not 0; SKETCH bytes are held by the driver and each executor."""
        cells = levels.toArrow()
        held = np.zeros(SKETCH, np.uint8)
        held[cells["cell"].to_numpy()] = cells["level"].to_numpy().astype(np.uint8)
        self.held = levels.sparkSession.sparkContext.broadcast(held)

    def level(self, shingles: np.ndarray) -> np.ndarray:
        return self.held.value[(shingles % np.uint64(SKETCH)).astype(np.int64)]


def _leading(size: int, share: int, order: Order) -> Callable:
    """The leading shingles of each class in the global order.

    ``room`` is the most that a set can share from this shingle on. It is negative where that is too little for a partner of the same
    size or a larger one, as of two linked sets the smaller shares a shingle before that place.
    """

    def rows(parts: list[tuple]) -> pd.DataFrame:
        key, cls, often, room = (np.concatenate(x) for x in zip(*parts))
        return pd.DataFrame({"key": signed(key), "cls": cls, "often": often, "room": room})

    def run(batches):
        seen = set()
        for df in batches:
            parts, held = [], 0
            for x in sets_of(df["text"].tolist(), size):
                s, n = signature(x), len(x)
                if not n or s in seen:
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(s)
                level = order.level(x)
                first = np.argsort(level, kind="stable")[: n - least_overlap(n, share) + 1]  # sets are sorted by hash
                room = np.arange(n, n - len(first), -1, dtype=np.int32)
                room[room < least_shared(n, n, share)] *= -1
                parts.append((x[first], np.full(len(first), s, np.int64), level[first] > 0, room))
                held += len(first)
                if held > 500_000:
                    yield rows(parts)
                    parts, held = [], 0
            if parts:
                yield rows(parts)

    return run


def _segments(size: int, order: Order, bits, first: bool) -> Callable:
    """The first fragment, or all others, of the sets of texts that the filter lets through."""

    def run(batches):
        for df in batches:
            df = df[passes(bits.value, df["doc_id"].to_numpy(np.int64))]
            for begin in range(0, len(df), 200):
                part = df.iloc[begin : begin + 200]
                out = []
                for doc, x in zip(part["doc_id"].tolist(), sets_of(part["text"].tolist(), size)):
                    piece = np.where(order.level(x) == 0, (x >> np.uint64(62)).astype(np.int64) % LIGHT_FRAGMENTS, LIGHT_FRAGMENTS)
                    out += [(doc, int(f), signed(x[piece == f])) for f in np.unique(piece) if (f == 0) == first]
                yield pd.DataFrame(out, columns=["doc_id", "fragment", "shingles"])

    return run


def _known(bits) -> Callable:
    def run(batches):
        for df in batches:
            yield df[passes(bits.value, df["doc_id"].to_numpy(np.int64))]

    return run


def possible(pairs: DataFrame, marks: DataFrame, share: int) -> DataFrame:
    """Candidate pairs whose parities (doc_id, n, marks) leave room for a link."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    held = marks.mapInPandas(_known(id_filter(ids, "doc_id")), "doc_id long, n long, marks array<long>")
    left = held.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("marks").alias("x"))
    right = held.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("marks").alias("y"))
    fit = _room_for_link(F.col("na") + F.col("nb"), share)
    return pairs.join(left, ["a", "na"]).join(right, ["b", "nb"]).filter(fit).select("a", "na", "b", "nb").distinct()


def _room_for_link(sizes: F.Column, share: int) -> F.Column:
    """Whether the parities x and y of two sets leave room for the overlap of a link, given the sum of their sizes."""
    differ = F.aggregate(F.zip_with("x", "y", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, v: s + v)
    return (100 + share) * (sizes - differ) >= 2 * share * sizes


def links(pairs: DataFrame, texts: DataFrame, marks: DataFrame, size: int, share: int, order: Order) -> DataFrame:
    """Of candidate pairs (a, na, b, nb) of document ids with their set sizes, those whose summed fragment overlaps reach the share.

    Pairs whose parities rule a link out go first. The first fragment is counted for all others; those that can't reach the share even if the rest is equal go. The other fragments
    are counted for the rest.
    """

    def overlaps(pairs: DataFrame, first: bool) -> DataFrame:
        ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        read = _segments(size, order, id_filter(ids, "doc_id"), first)
        parts = stored(map_slices(texts, read, "doc_id long, fragment int, shingles array<long>"), "segments")
        left = parts.select(F.col("doc_id").alias("a"), "fragment", F.col("shingles").alias("x"))
        right = parts.select(F.col("doc_id").alias("b"), "fragment", F.col("shingles").alias("y"))
        joined = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"])
        sizes = {"more": F.size(F.array_intersect("x", "y")), "xs": F.size("x"), "ys": F.size("y")}
        once = joined.groupBy("b", "fragment", "a").agg(*(F.max(v).alias(n) for n, v in sizes.items()))  # a row may be given twice
        return once.groupBy("a", "b").agg(*(F.sum(n).alias(n) for n in sizes))

    def reaches(shared: F.Column) -> F.Column:
        return (100 + share) * shared >= share * (F.col("na") + F.col("nb"))

    zero = F.lit(0)
    pairs = stored(possible(pairs, marks, share), "pairs")
    begun = pairs.join(overlaps(pairs, True), ["a", "b"], "left").na.fill(0, ["more", "xs", "ys"])
    begun = begun.withColumn("rest", F.least(F.col("na") - F.col("xs"), F.col("nb") - F.col("ys")))
    left = stored(begun.filter(reaches(F.col("more") + F.col("rest"))).select("a", "b", "na", "nb", F.col("more").alias("begun")), "pairs")
    done = left.join(overlaps(left, False), ["a", "b"], "left")
    return done.filter(reaches(F.col("begun") + F.coalesce("more", zero))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component) for every end of an edge: the smallest id that it reaches.

    Each round gives an id the smallest label among its neighbours and their labels' labels, so labels halve their way.
    """
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.col("doc_id"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("doc_id")).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, F.col("doc_id") == F.col("a")).select("doc_id", "component", F.least("component", "near").alias("new"))
        jump = labels.select(F.col("doc_id").alias("new"), F.col("component").alias("far"))
        found = stored(
            step.join(jump, "new", "left").select("doc_id", F.least("new", "far").alias("component"), F.col("component").alias("old")), "labels"
        )
        if found.filter("component <> old").isEmpty():
            return labels
        labels = found.select("doc_id", "component")


def _one_of_equal_keys(rows: DataFrame) -> DataFrame:
    """Rows (key, cls, room, more) of one key for all keys that the same classes share, with the room of each class at the first of them.

    The order is one for all, so the first such key is the first for every class, and what a pair could share from there on bounds it.
    """
    rows = rows.groupBy(*[c for c in rows.columns if c != "room"]).agg(F.max_by("room", F.abs("room")).alias("room"))
    rows = stored(rows, "open")
    sums = [F.bit_xor(F.xxhash64("cls", F.lit(seed))).alias(f"s{seed}") for seed in (1, 2)]
    alike = rows.groupBy("key").agg(F.count("*").alias("classes"), *sums, F.max(F.abs("room")).alias("reach"))
    alike = alike.groupBy("classes", "s1", "s2").agg(F.max_by("key", F.struct("reach", "key")).alias("key"))
    return rows.join(alike.select("key"), "key", "left_semi")


def jaccard_components(docs: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Null and empty texts have no shingles and link with nothing. Repeated texts are one class, so they link. Rows without an id
    are dropped; a row given twice comes out twice. No rows give no rows. Other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    first = stored(map_slices(texts, _read_sets(size), "doc_id long, n long, cls long, marks array<long>"), "sets")
    sets = first.select("doc_id", "n", "cls")
    order = Order(frequent_cells(texts, size))
    of_set = first.filter("n > 0").groupBy("cls", "n")
    classes = stored(of_set.agg(F.min("doc_id").alias("doc_id"), F.any_value("marks").alias("marks")), "classes")
    marks = classes.select("doc_id", "n", "marks")

    leading = stored(map_slices(texts, _leading(size, share, order), "key long, cls long, often boolean, room int"), "leading")
    ends = {"hub": F.min(F.when(F.col("room") > 0, F.struct("cls", "room"))), "low": F.min("cls"), "high": F.max("cls")}
    several = "hub IS NOT NULL AND low <> high"
    often = leading.filter("often").select("key", "cls", "room")
    hubs = often.groupBy("key").agg(*(x.alias(n) for n, x in ends.items())).filter(several)
    light = leading.filter("NOT often").select("key", "cls", "room")
    whole = light.withColumns({n: x.over(Window.partitionBy("key")) for n, x in ends.items()})
    columns = ["key", "cls", "room", "hub"]
    shared = stored(often.join(hubs, "key").filter(several).select(columns).union(whole.filter(several).select(columns)), "shared")

    def sized(pairs: DataFrame) -> DataFrame:
        """Pairs of classes as pairs of their smallest ids, where sizes and room allow a link."""
        a = classes.select(F.col("cls").alias("p"), F.col("doc_id").alias("a"), F.col("n").alias("na"))
        b = classes.select(F.col("cls").alias("q"), F.col("doc_id").alias("b"), F.col("n").alias("nb"))
        fit = 100 * F.least("na", "nb") >= share * F.greatest("na", "nb")
        room = (100 + share) * F.col("room") >= share * (F.col("na") + F.col("nb"))
        return pairs.join(a, "p").join(b, "q").filter(fit & room).select("a", "na", "b", "nb")

    room = F.max(F.least(F.abs("room"), F.col("hub.room"))).alias("room")
    near = shared.filter("cls <> hub.cls").groupBy(F.col("cls").alias("p"), F.col("hub.cls").alias("q")).agg(room)
    tried = stored(sized(near), "pairs")
    found = stored(links(tried, texts, marks, size, share, order), "links")
    joined = components(found)

    lead = F.col("n") - F.ceil(F.col("n") * share / 100) + 1
    central = shared.groupBy("cls").agg(F.count("*").alias("common"))
    classes = classes.join(central, "cls", "left").withColumn("central", F.floor(20 * F.coalesce("common", F.lit(0)) / lead)).drop("common")
    classes = stored(classes, "classes")

    def placed(joined: DataFrame) -> DataFrame:
        """Rows of shared shingles with the component of their class, where a shingle has several components."""
        of_class = classes.join(joined, "doc_id", "left").select(
            "cls", "n", "central", F.coalesce("component", "doc_id").alias("component")
        )
        rows = stored(shared.select("key", "cls", "room").join(of_class, "cls"), "placed")
        mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
        return stored(rows.join(mixed, "key"), "open")

    rows, before, step = placed(joined), None, 0
    while True:
        load, held = rows.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.sum("n")).first()
        if not held or load <= PAIRS * held or (before and load > USEFUL * before):
            break
        hub = F.max(F.struct("central", F.xxhash64("cls", F.lit(step)).alias("by"), F.col("cls").alias("q"), F.col("room").alias("t"))).alias("hub")
        parts = rows.groupBy("key", "component").agg(F.count("*").alias("classes"), hub)
        top = parts.groupBy("key").agg(F.max(F.struct("classes", "component", "hub")).alias("top"))
        room = F.max(F.least(F.abs("room"), F.abs("top.hub.t"))).alias("room")
        other = rows.join(top, "key").filter((F.col("component") != F.col("top.component")) & (F.greatest("room", "top.hub.t") > 0))
        near = other.groupBy(F.col("cls").alias("p"), F.col("top.hub.q").alias("q")).agg(room)
        now = stored(sized(near), "pairs")
        if now.isEmpty():
            break
        tried = tried.union(now)
        found = stored(found.union(links(now, texts, marks, size, share, order)), "links")
        joined = components(found)
        rows, before, step = placed(joined), load, step + 1

    rows = _one_of_equal_keys(rows)
    # Sizes of linked sets differ by at most the share, so a pair's size classes are equal or neighbours.
    width = np.log(100 / share) + 1e-4
    rows = rows.join(classes.select("cls", "marks"), "cls").withColumn("by_size", F.floor(F.log(F.col("n")) / width).cast("int"))
    p = rows.select("key", F.col("cls").alias("p"), F.col("component").alias("c"), F.col("n").alias("m"), F.col("room").alias("r"), F.col("marks").alias("x"),
                    F.explode(F.array(*[F.col("by_size") + i for i in (-1, 0, 1)])).alias("by_size"))
    q = rows.select("key", F.col("cls").alias("q"), F.col("component").alias("d"), F.col("n").alias("k"), F.col("room").alias("t"), F.col("marks").alias("y"), "by_size")
    fit = (100 * F.least("m", "k") >= share * F.greatest("m", "k")) & (F.greatest("r", "t") > 0)
    fit = fit & ((100 + share) * F.least(F.abs("r"), F.abs("t")) >= share * (F.col("m") + F.col("k")))
    fit = fit & _room_for_link(F.col("m") + F.col("k"), share)
    across = p.join(q, ["key", "by_size"]).filter((F.col("c") < F.col("d")) & fit).groupBy("p", "q").agg(F.lit(1 << 40).alias("room"))
    known = tried.select("a", "b").union(tried.select("b", "a"))
    across = stored(sized(across).join(known, ["a", "b"], "left_anti"), "pairs")
    more = found if across.isEmpty() else stored(found.union(links(across, texts, marks, size, share, order)), "links")
    final = joined if more is found else components(more)

    of_class = classes.join(final, "doc_id", "left").select("cls", F.coalesce("component", "doc_id").alias("component_id"))
    return sets.join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
