"""Mixing sources to target weights by repetition rates.

Words are summed per source. Weights share out all words; a target above a source's most repetitions stops there and the excess goes
to the others by weight. A source's rate is its target by its size: each of its documents is emitted floor(rate) times, and once
more when a hash of its id falls below the fraction. All shares are whole numbers over one denominator, so nothing is rounded
before a document's draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import stored, unused
from triagegrid.operators.order_index import OrderIndex

WEIGHTS = (5, 2, 1)
#: Times that a document may be repeated at most.
MOST = 3
SEED = "mix"
#: Hex digits of a document's draw; doubles hold as many exactly.
DIGITS = 13


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and the controls 9 to 13; null has none."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on the id alone; a text without an id draws by its own digest."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**DIGITS))


def whole(c: Column | str | int) -> Column:
    """As a decimal, which holds products of corpus sizes and weights."""
    return (F.lit(c) if isinstance(c, int) else F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def source_rates(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source (null is one, the last): weight, source_size, target, copies (of every document) and fraction (of one more).

    Sources are numbered in code point order and take the weights in turn. The sources stay in a table; each round sends two sums
    to the driver and stops those whose target is above the limit. Sources without words have target 0 and no copies.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    order = OrderIndex(sizes, [F.col("source").asc_nulls_last()]).numbered("number")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")).cast("long")
    sources = stored(order.select("source", "source_size", weight.alias("weight")), "sources")
    total = int(sources.agg(F.sum(whole("source_size"))).first()[0] or 0)

    def stopped(num: int, den: int) -> Column:
        return whole("weight") * whole(num) > whole("source_size") * whole(most * den)

    share, everyone = (total, 0), None
    while share != everyone:
        everyone = share
        over = stopped(*share) if share[1] else F.lit(False)
        held, free = sources.agg(
            F.sum(F.when(over, whole("source_size") * most)), F.sum(F.when(~over, whole("weight")))
        ).first()
        # No source is left only if there are no words at all.
        share = (total - int(held or 0), int(free or 1))
    num, den = share
    over = stopped(num, den)
    part, size = whole("weight") * whole(num), whole("source_size") * whole(den)
    copies = F.when(F.col("source_size") == 0, 0).when(over, most).otherwise(F.floor((part - part % size) / size))
    fraction = F.when((F.col("source_size") == 0) | over, 0.0).otherwise((part % size).cast("double") / size.cast("double"))
    target = F.when(over, F.col("source_size") * most).otherwise(part.cast("double") / F.lit(float(den)))
    return sources.select(
        "source", "weight", "source_size", target.cast("double").alias("target"),
        copies.cast("long").alias("copies"), fraction.alias("fraction"),
    )


def with_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, source, more) with one further column, a struct: size, source_size, target, copies.

    The struct is the last column; its name, ``mix``, gets underscores in front while ``docs`` has one of that name. Null and empty
    texts have size 0 and are copied like others of their source. Repeated rows draw alike; rows without an id draw by their
    text. No rows give no rows. The rates are joined by source; a source with very many rows is split by the adaptive skew join
    where the rates are too large to broadcast.
    """
    rates = stored(source_rates(docs.select("source", "text"), weights, most), "rates")
    key, rate = unused(docs, "mix_source"), unused(docs, "mix_rate")
    rates = rates.select(F.col("source").alias(key), F.struct("source_size", "target", "copies", "fraction").alias(rate))
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col(key)), "left")
    rate = F.col(rate)
    once_more = (draw(F.col("doc_id"), F.col("text"), seed) < rate["fraction"]).cast("long")
    mix = F.struct(
        word_count(F.col("text")).alias("size"), rate["source_size"].alias("source_size"), rate["target"].alias("target"),
        (rate["copies"] + once_more).alias("copies"),
    )
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], mix.alias(unused(docs, "mix")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its copies say, with the same columns."""
    out = with_copies(docs, **options)
    name = out.columns[-1]
    times = F.explode(F.array_repeat(F.lit(0), F.col(name)["copies"].cast("int")))
    return out.withColumn(name, times).drop(name)
