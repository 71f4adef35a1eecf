"""Divergence of sources by late string materialization.

Terms travel as fixed-width digests: tasks count digests per language and source, and only those counts are shuffled. Beside them each task
writes the smallest and the largest string of every digest it met. Of digests that may be kept, these are combined: where they differ,
different terms share the digest, and those terms alone are counted again by a long digest each. Strings are joined back just for the
terms of the result.

All shares are whole numbers: 1 + floor(SCALE * (count + 5) / (N + 5 * V)).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm.common import GROUP_BYTES, LOWER, encoded, groups, id_filter, passes, signed, slices, span_hashes, stored
from triagegrid.llm.common import _slices as pieces_at_blanks
from triagegrid.operators.order_index import OrderIndex

#: Bytes of terms: letters, and everything beyond ASCII.
TERM = np.zeros(256, bool)
TERM[65:91] = TERM[97:123] = TERM[128:] = True
#: Documents of a language that must hold a term.
LEAST_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP = 50
#: Counts and strings that a task holds before it writes them.
POOL = 1_000_000
ROWS = 100_000
#: Shares (sources times terms) of one block of the pairwise sums.
CELLS = 250_000
_COUNTS = "lang string, source string, digest long, n long, docs long, low string, high string"


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each term in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = TERM[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def distinct_terms(data: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of lower-cased bytes: begins; number of each one's term; and per term its digest and an example.

    Terms that share a digest are told apart by their bytes.
    """
    begin, end = term_spans(data)
    if not len(begin):
        return begin, begin, np.zeros(0, np.int64), begin
    digest = signed(span_hashes(data, begin, end) >> np.uint64(64 - bits))
    found, example, number = np.unique(digest, return_index=True, return_inverse=True)
    length = end - begin
    same = length == length[example[number]]
    at = np.flatnonzero(TERM[data])
    shift = np.repeat(np.where(same, begin[example[number]] - begin, 0), length)
    differ = np.add.reduceat(data[at] != data[at + shift], np.cumsum(np.append(0, length[:-1])))
    odd = np.flatnonzero(~same | (differ > 0))
    if len(odd):
        more: dict[tuple, int] = {}
        extra = []
        for i in odd.tolist():
            key = (int(digest[i]), data[begin[i] : end[i]].tobytes())
            if key not in more:
                more[key] = len(found) + len(more)
                extra.append(i)
            number[i] = more[key]
        found = np.append(found, np.array([d for d, _ in more], np.int64))
        example = np.append(example, extra)
    return begin, number, found, np.stack([begin[example], end[example]], 1)


def gathered(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of several spans, one after the other."""
    shift = np.repeat(begin - (np.cumsum(length) - length), length)
    return data[np.arange(len(shift)) + shift]


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Places in sorted keys at which a new one begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


class Pool:
    """Counts per group and digest, and the strings of digests, of one task."""

    def __init__(self):
        self.parts, self.size = [], 0
        self.words, self.met = [], 0
        self.more: dict[int, tuple[bytes, bytes]] = {}

    def add(self, *part: np.ndarray) -> None:
        """Group, digest, n and docs."""
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > POOL:
            self.combine()

    def combine(self) -> None:
        group, digest, n, docs = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((digest, group))
        group, digest, n, docs = group[order], digest[order], n[order], docs[order]
        first = firsts(group, digest)
        self.parts = [(group[first], digest[first], np.add.reduceat(n, first), np.add.reduceat(docs, first))]
        self.size = len(first)

    def counts(self, names: list[tuple], most: int) -> Iterator[pa.RecordBatch]:
        """The counts, if they are more than that many, and then no more."""
        if self.size > most:
            self.combine()
        if self.size > most:
            (group, digest, n, docs), self.parts, self.size = self.parts[0], [], 0
            langs, sources = (pa.array(x, pa.string()) for x in zip(*names))
            for a in range(0, len(group), ROWS):
                b = slice(a, a + ROWS)
                at = pa.array(group[b].astype(np.int32))
                lang, source = (pa.DictionaryArray.from_arrays(at, x).dictionary_decode() for x in (langs, sources))
                none = pa.nulls(len(at), pa.string())
                yield _batch(lang, source, pa.array(digest[b]), pa.array(n[b]), pa.array(docs[b]), none, none)

    def remember(self, found: np.ndarray, span: np.ndarray, data: np.ndarray) -> None:
        length = span[:, 1] - span[:, 0]
        self.words.append((found, length, gathered(data, span[:, 0], length)))
        self.met += len(found)
        if self.met > POOL:
            self.unite()

    def unite(self) -> None:
        """Each digest once, with its string; the smallest and largest ones of a digest that stands for several go to ``more``."""
        digest, length, text = (np.concatenate(x) for x in zip(*self.words))
        begin = np.cumsum(length) - length
        order = np.argsort(digest, kind="stable")
        digest, length, begin = digest[order], length[order], begin[order]
        first = firsts(digest)
        of = np.repeat(first, np.diff(np.append(first, len(digest))))
        alike = length == length[of]
        own, other = gathered(text, begin, length), gathered(text, np.where(alike, begin[of], begin), length)
        ends = np.cumsum(length)
        alike &= np.add.reduceat((own != other).astype(np.int32), ends - length) == 0 if len(own) else True
        for i in np.flatnonzero(~alike).tolist():
            strings = [text[begin[k] : begin[k] + length[k]].tobytes() for k in (i, of[i])]
            strings += self.more.get(int(digest[i]), ())
            self.more[int(digest[i])] = min(strings), max(strings)
        self.words = [(digest[first], length[first], gathered(text, begin[first], length[first]))]
        self.met = len(first)

    def strings(self, most: int) -> Iterator[pa.RecordBatch]:
        """The strings, if they are more than that many, and then no more."""
        if self.met > most:
            self.unite()
        if self.met <= most:
            return
        (digest, length, text), self.words, self.met = self.words[0], [], 0
        ends = np.cumsum(length)
        for a in range(0, len(digest), ROWS):
            b = slice(a, a + ROWS)
            begin = int(ends[a] - length[a])
            offsets = np.append(0, ends[b] - begin).astype(np.int32)
            low = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text[begin : int(ends[b][-1])].tobytes()))
            yield _words(pa.array(digest[b]), low, pa.nulls(len(low), pa.string()))
        if self.more:
            low, high = ([x.decode("utf-8", "replace") for x in ends] for ends in zip(*self.more.values()))
            yield _words(pa.array(list(self.more), pa.int64()), pa.array(low, pa.string()), pa.array(high, pa.string()))
            self.more = {}


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), [field.split()[0] for field in _COUNTS.split(", ")])


def _words(digest: pa.Array, low: pa.Array, high: pa.Array) -> pa.RecordBatch:
    zero, none = pa.array(np.zeros(len(digest), np.int64)), pa.nulls(len(digest), pa.string())
    return _batch(none, none, digest, zero, zero, low, high)


def _counted(bits: int, only=None) -> Callable:
    """Rows of counts (lang, source, digest, n, docs) and of strings (digest, low, high if it differs); with a filter, counts of the
    strings whose digest it passes."""

    def run(batches):
        pool, names, number_of = Pool(), [], {}
        for batch in slices(batches):
            keys = list(zip(*(batch.column(k).to_pylist() for k in ("lang", "source"))))
            for key in keys:
                if key not in number_of:
                    number_of[key] = len(names)
                    names.append(key)
            group_of = np.array([number_of[k] for k in keys], np.int64)
            raw = [encoded(t) for t in batch.column("text").to_pylist()]
            for a, b in groups(raw):
                texts, owners = raw[a:b], np.arange(a, b)
                if b - a == 1 and len(raw[a]) > GROUP_BYTES:
                    texts = list(pieces_at_blanks(raw[a], GROUP_BYTES))
                    owners = np.full(len(texts), a)
                # Pieces of one long text are counted apart and added up, so that it is one document.
                parts = [(texts, owners)] if len(texts) == b - a else [([t], owners[:1]) for t in texts]
                met: list[tuple] = []
                for some, owner in parts:
                    data = LOWER[np.frombuffer(b"\n".join(some), np.uint8)]
                    begin, number, found, span = distinct_terms(data, bits)
                    if not len(begin):
                        continue
                    starts = np.cumsum([0, *(len(t) + 1 for t in some)])
                    doc = owner[np.searchsorted(starts, begin, "right") - 1]
                    if only is None:
                        pool.remember(found, span, data)
                        pair, times = np.unique(doc * len(found) + number, return_counts=True)
                        met.append((pair // len(found), found[pair % len(found)], times))
                        continue
                    for k in np.flatnonzero(passes(only.value, found)).tolist():
                        text = data[slice(*span[k])].tobytes().decode("utf-8", "replace")
                        owners_of, times = np.unique(doc[number == k], return_counts=True)
                        met += [(d, int(found[k]), text, n) for d, n in zip(owners_of.tolist(), times.tolist())]
                if only is not None:
                    yield _as_rows(met, names, group_of)
                elif met:
                    doc, digest, n = (np.concatenate(x) for x in zip(*met))
                    if len(met) > 1 or bits < 64:  # pieces of one document, or terms that share a digest, count once
                        order = np.lexsort((digest, doc))
                        doc, digest, n = doc[order], digest[order], n[order]
                        first = firsts(doc, digest)
                        doc, digest, n = doc[first], digest[first], np.add.reduceat(n, first)
                    pool.add(group_of[doc], digest, n, np.ones(len(doc), np.int64))
                    yield from pool.counts(names, POOL // 2)
                    yield from pool.strings(POOL // 2)
        yield from pool.counts(names, 0)
        yield from pool.strings(0)

    return run


def _as_rows(met: list[tuple], names: list[tuple], group_of: np.ndarray) -> pa.RecordBatch:
    """Counts of single strings; one row per document and string."""
    total: dict[tuple, int] = {}
    for doc, digest, text, n in met:
        total[doc, digest, text] = total.get((doc, digest, text), 0) + n
    rows = [(*names[group_of[d]], digest, n, 1, text, text) for (d, digest, text), n in total.items()]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return _batch(*(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)))


def whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28,0)")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exact."""
    over, under = whole(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), whole(total) + whole(kept) * F.lit(PRIOR).cast("decimal(2,0)")
    return (F.lit(1) + F.call_function("div", over, under)).cast("long")


def term_counts(texts: DataFrame, least_docs: int = LEAST_DOCS, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, digest, split, n, docs) of terms that may be kept, and their strings (digest, split, item).

    ``texts`` has lang, source and text without nulls. ``split`` is empty for a digest of one term and that term's SHA-256 otherwise.
    """
    texts = texts.select("lang", "source", "text")
    parts = stored(texts.mapInArrow(_counted(bits), _COUNTS), "term-parts")
    digests = parts.filter("low IS NULL").select("lang", "source", "digest", "n", "docs")
    counts = stored(digests.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    often = counts.groupBy("lang", "digest").agg(F.sum("docs").alias("in_docs")).filter(F.col("in_docs") >= least_docs).select("lang", "digest")
    often = stored(often, "often")
    once = often.select("digest").distinct()
    bits_of = id_filter(once, "digest")

    def known(batches):
        for df in batches:
            yield df[passes(bits_of.value, df["digest"].to_numpy(np.int64))]

    words = parts.filter("low IS NOT NULL").select("digest", "low", "high").mapInPandas(known, "digest long, low string, high string")
    words = words.join(once, "digest", "left_semi").groupBy("digest").agg(F.min("low").alias("low"), F.max(F.coalesce("high", "low")).alias("high"))
    words = stored(words, "terms")
    counts = counts.join(often, ["lang", "digest"]).withColumn("split", F.lit(""))
    single = words.filter("low = high").select("digest", F.lit("").alias("split"), F.col("low").alias("item"))
    several = words.filter("low <> high").select("digest")
    if several.isEmpty():
        return counts.select("lang", "source", "digest", "split", "n", "docs"), single
    again = texts.mapInArrow(_counted(bits, id_filter(several, "digest")), _COUNTS).join(several, "digest", "left_semi")
    again = again.withColumn("split", F.sha2("low", 256)).groupBy("lang", "source", "digest", "split")
    again = stored(again.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.min("low").alias("item")), "term-splits")
    split = again.groupBy("digest", "split").agg(F.min("item").alias("item"))
    columns = ["lang", "source", "digest", "split", "n", "docs"]
    return counts.join(several, "digest", "left_anti").select(columns).union(again.select(columns)), single.union(split)


def _block_sums(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
    """Summed differences of shares over the terms of a block for every two sources of a language."""
    base = df[df["term"] < 0].sort_values("group")
    held = df[df["term"] >= 0]
    group, zero = base["group"].to_numpy(np.int64), base["p"].to_numpy(np.int64)
    terms, column = np.unique(held["term"].to_numpy(np.int64), return_inverse=True)
    table = np.repeat(zero[:, None], len(terms), 1)
    table[np.searchsorted(group, held["group"].to_numpy(np.int64)), column] = held["p"].to_numpy(np.int64)
    out = [(group[i], group[i + 1 :], np.abs(table[i + 1 :] - table[i]).sum(1)) for i in range(len(group) - 1)]
    size = [len(g) for _, g, _ in out]
    flat = lambda n: np.concatenate([x[n] for x in out]) if out else np.zeros(0, np.int64)
    return pd.DataFrame({"group": np.repeat(np.array([g for g, _, _ in out], np.int64), size), "other": flat(1), "value": flat(2)})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank for all groups of ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language and the summed absolute difference of the shares of all kept terms. Part ``term``: the
    ``top`` terms that a group holds more of than its language. Null texts, languages and sources are empty ones; groups without terms
    take part in the pairs. Rows given twice are two documents. No rows give no rows. Texts are read whole. Other columns are not looked at.
    The pairs are as many as the square of a language's sources, as asked.
    """
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts, strings = term_counts(clean, least_docs, bits)
    counts = stored(counts, "counts")
    kept = counts.groupBy("lang", "digest", "split").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("in_docs"))
    kept = OrderIndex(kept.filter(F.col("in_docs") >= least_docs), ["lang", "digest", "split"]).numbered("term").drop("in_docs")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    held = stored(counts.join(kept, ["lang", "digest", "split"]).select("lang", "source", "digest", "split", "term", "n", "lang_n"), "held")

    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = OrderIndex(clean.select("lang", "source").distinct(), ["lang", "source"]).numbered("group")
    named = named.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    named = stored(named.na.fill(0, ["total", "kept", "lang_total"]), "groups")

    shared = held.join(named, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    shares = stored(shared.select("lang", "source", "group", "digest", "split", "term", p.alias("p"), q.alias("q")), "shares")

    # Terms: by value first, ties included; strings are joined to what is left.
    by = Window.partitionBy("lang", "source")
    above = shares.filter("p > q").withColumn("value", F.col("p") - F.col("q")).withColumn("place", F.rank().over(by.orderBy(F.desc("value"))))
    above = above.filter(F.col("place") <= top).join(strings, ["digest", "split"])
    order = by.orderBy(F.desc("value"), "item")
    terms = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    # Pairs: blocks of terms, small enough for all sources of a language.
    sizes = named.groupBy("lang").agg(F.count("*").alias("sources"))
    width = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("sources"))).cast("long")
    dealt = shares.join(sizes, "lang").select("lang", F.floor(F.col("term") / width).cast("long").alias("block"), "group", "term", "p")
    none = share(F.lit(0), F.col("total"), F.col("kept"))
    base = dealt.select("lang", "block").distinct().join(named, "lang").select("lang", "block", "group", F.lit(-1).cast("long").alias("term"), none.alias("p"))
    sums = dealt.union(base).groupBy("lang", "block").applyInPandas(_block_sums, "group long, other long, value long")
    sums = sums.groupBy("group", "other").agg(F.sum("value").alias("value"))
    both = sums.union(sums.select("other", "group", "value"))
    one = named.select("lang", "source", "group")
    two = named.select("lang", F.col("source").alias("item"), F.col("group").alias("other"))
    pairs = one.join(two, "lang").filter("group <> other").join(both, ["group", "other"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
    pairs = pairs.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.union(terms)
