"""Benchmark decontamination by templates.

Words become a template: numbers, names and units are replaced by typed placeholders, all else is lower-cased. Windows of
the templates of benchmark items are hash-joined with those of documents, and so are windows of the lower-cased words as they are, by
which copies are found whatever their numbers, names, capitals and line breaks. What stands in the placeholders must
then agree: over the windows of one occurrence of an item in a document, or over all that they share, a value of the item always meets
the same value of the document. So copies and re-parameterised questions are caught, and windows that only look alike are not.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import LOWER, encoded, groups, id_filter, map_slices, passes, signed, span_hashes, stored, window_hashes

WINDOW = 8
#: Fewest words of a window that are no placeholders, and windows of an item that a document shares at least.
LITERAL, SHARED = 4, 6
#: Fewest words of an item that is searched for: shorter ones are common phrases and would be found nearly everywhere.
LEAST_WORDS = 5
# Units of measure and currency.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs pound pounds oz ounce ounces ton tons l ml liter liters litre "
    "litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar dollars "
    "cent cents euro euros percent degree degrees kmh mph volt volts watt watts"
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x1B873593CC9E2D51, 0x2545F4914F6CDD1D, 0x3C6EF372FE94F82B))
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:\n\r")] = True
_raw = np.frombuffer(UNITS.encode(), np.uint8)
_edge = np.flatnonzero(np.diff(np.concatenate(([0], (_raw != 32).astype(np.int8), [0]))))
UNIT_HASHES = np.sort(span_hashes(_raw, _edge[::2], _edge[1::2]))


def templates(texts: list[str | None]):
    """For each text: the hashes of its template, of what stands there, and of its words.

    A run of names is one placeholder, and a number with its separators is one.
    """
    raw = [encoded(t) for t in texts]
    for begin, end in groups(raw):
        data = np.frombuffer(b"\n".join(raw[begin:end]) + b"\n", np.uint8)
        mark = np.diff(np.concatenate(([0], _WORD[data].astype(np.int8), [0])))
        first, last = np.flatnonzero(mark == 1), np.flatnonzero(mark == -1)
        word = span_hashes(LOWER[data], first, last)
        if len(first):
            head = data[first]
            number = (head >= 48) & (head <= 57)
            second = data[np.minimum(first + 1, len(data) - 1)]
            stops = np.concatenate(([0], np.cumsum(_STOP[data])))
            inside = np.zeros(len(first), bool)
            inside[1:] = stops[first[1:]] == stops[last[:-1]]
            name = inside & (head >= 65) & (head <= 90) & (last - first > 1) & ((second < 65) | (second > 90))
            after = np.zeros(len(first), bool)
            after[1:] = number[:-1]
            at = np.minimum(np.searchsorted(UNIT_HASHES, word), len(UNIT_HASHES) - 1)
            unit = after & (UNIT_HASHES[at] == word)
            form = np.select([number, unit, name], [NUMBER, UNIT, NAME], word)
            others = np.concatenate(([0], np.cumsum((data != 32) & (data != 45))))
            on = np.zeros(len(first), bool)
            between = data[last[:-1]]
            on[1:] = number[1:] & number[:-1] & (first[1:] - last[:-1] == 1) & ((between == 44) | (between == 46))
            on[1:] |= name[1:] & name[:-1] & (others[first[1:]] == others[last[:-1]])
            heads = np.flatnonzero(~on)
            begins, ends = first[heads], last[np.append(heads[1:], len(first)) - 1]
            form, value = form[heads], span_hashes(LOWER[data], begins, ends)
        else:
            form, value, begins = word, word, first
        edges = np.cumsum([0, *(len(t) + 1 for t in raw[begin:end])])
        starts, plain = np.searchsorted(begins, edges).tolist(), np.searchsorted(first, edges).tolist()
        for i in range(end - begin):
            yield form[starts[i] : starts[i + 1]], value[starts[i] : starts[i + 1]], word[plain[i] : plain[i + 1]]


def windows(form: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows; those with too few literal words are 0."""
    found = window_hashes(form, size)
    literal = np.concatenate(([0], np.cumsum((form != NUMBER) & (form != NAME) & (form != UNIT))))
    if len(found):
        found[(literal[size:] - literal[:-size])[: len(found)] < min(LITERAL, size)] = 0
    return found


def _rows(key, form: np.ndarray, value: np.ndarray, word: np.ndarray, sizes: list[int], bits=None) -> list[tuple]:
    """Template windows of the positive sizes, and plain ones of the negative sizes, which have no slots."""
    out = []
    for size in sizes:
        n = abs(size)
        found = windows(form, n) if size > 0 else window_hashes(word, n)
        keep = found != 0 if size > 0 else np.ones(len(found), bool)
        if bits is not None and len(found):
            keep &= passes(bits, signed(found))
        hashes = signed(found)
        for i in np.flatnonzero(keep).tolist():
            held = value[i : i + n][form[i : i + n] != value[i : i + n]] if size > 0 else value[:0]
            out.append((key, i, size, int(hashes[i]), signed(held).tolist()))
    return out


def item_windows(items: DataFrame) -> DataFrame:
    """Template and plain windows of benchmark items (item_id, at, size, hash, slots); an item shorter than a window is one.

    Items of fewer than LEAST_WORDS words have none; ``short_items`` lists them.
    """

    def run(batches):
        for df in batches:
            out = []
            for key, (form, value, word) in zip(df["item_id"].tolist(), templates(df["text"].tolist())):
                if len(word) >= LEAST_WORDS:
                    out += _rows(key, form, value, word, [min(WINDOW, len(form)), -min(WINDOW, len(word))])
            yield pd.DataFrame(out, columns=["item_id", "at", "size", "hash", "slots"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    return map_slices(rows, run, "item_id long, at int, size int, hash long, slots array<long>")


def short_items(items: DataFrame) -> DataFrame:
    """The items that have too few words to be searched for: item_id, n_words. Null texts have none."""

    def run(batches):
        for df in batches:
            n = [len(word) for _, _, word in templates(df["text"].tolist())]
            yield pd.DataFrame({"item_id": df["item_id"], "n_words": n})

    rows = map_slices(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, n_words int")
    return rows.filter(F.col("n_words") < LEAST_WORDS)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold an item's passage: doc_id, item_id, n_windows, n_item_windows, exact.

    ``exact`` is whether enough windows hold the item's own values. Null and empty texts hold nothing; rows without an id are left
    out; repeated rows count once. An empty benchmark or an empty table gives no rows. Texts are read whole, however long. Items shorter than LEAST_WORDS words
    are not searched for. Other columns are not looked at.
    """
    asked = stored(item_windows(items).distinct(), "items")
    sizes = [r["size"] for r in asked.select("size").distinct().collect()]
    bits = id_filter(asked, "hash")

    def run(batches):
        for df in batches:
            ids, out = df["doc_id"].tolist(), []
            for key, (form, value, word) in zip(ids, templates(df["text"].tolist())):
                out += _rows(key, form, value, word, sizes, bits.value)
            yield pd.DataFrame(out, columns=["doc_id", "at", "size", "hash", "slots"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    met = map_slices(rows, run, "doc_id long, at int, size int, hash long, slots array<long>")
    place = F.when(F.col("size") > 0, F.col("at")).alias("place")
    met = met.select("doc_id", "size", "hash", F.col("slots").alias("own"), place)
    pairs = met.distinct().join(asked, ["size", "hash"])
    # Each template window counts for its occurrence, told by the item's place in the document, and for the document as a whole (null).
    both = F.array(F.lit(None).cast("int"), F.col("place") - F.col("at"))
    pairs = pairs.withColumn("begin", F.explode(F.when(F.col("size") > 0, both).otherwise(F.slice(both, 1, 1))))
    plain, template = (F.count_distinct(F.when(x, F.col("at"))) for x in (F.col("size") < 0, F.col("size") > 0))
    every = asked.groupBy("item_id").agg(plain.alias("n_item_windows"), template.alias("n_templates"))
    slot = F.explode_outer(F.arrays_zip("slots", "own"))
    keys = ["doc_id", "item_id", "begin", "at", "size"]
    slots = pairs.select(*keys, slot.alias("slot")).select(*keys, "slot.slots", "slot.own")
    found = slots.groupBy("doc_id", "item_id", "begin").agg(
        F.count_distinct("at").alias("n_windows"),
        F.count_distinct("slots").alias("values"),
        F.count_distinct("slots", "own").alias("meetings"),
        plain.alias("n_exact"),
        template.alias("n_alike"),
    )
    agreed = F.max(F.when(F.col("values") == F.col("meetings"), F.col("n_alike"))).alias("n_agreed")
    found = found.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("n_exact").alias("n_exact"), agreed)
    copied = F.col("n_exact") >= F.least(F.lit(SHARED), "n_item_windows")
    reset = F.coalesce((F.col("n_agreed") > 0) & (F.col("n_agreed") >= F.least(F.lit(SHARED), "n_templates")), F.lit(False))
    return found.join(every, "item_id").filter(copied | reset).select("doc_id", "item_id", "n_windows", "n_item_windows", copied.alias("exact"))
