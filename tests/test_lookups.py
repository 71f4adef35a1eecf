from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from triagegrid.operators import lists, predicates
from triagegrid.operators import lookups as L


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_left_by_key_keeps_rows_without_a_key(spark):
    df = frame(spark, [("a", 1), ("b", None), ("c", 3), ("d", None)], "n STRING, k BIGINT")
    dim = frame(spark, [(1, "one"), (None, "none"), (2, "two")], "id BIGINT, label STRING")
    got = L.left_by_key(df, "k", dim, "id", {"label": "label"}, ["n"])
    assert rows_of(got) == [("a", 1, "one"), ("b", None, None), ("c", 3, None), ("d", None, None)]


def test_left_by_key_spreads_null_keys(spark):
    """Rows without a key are shuffled by their hash, so they do not meet in one partition."""
    df = spark.range(4000).select(F.col("id").cast("string").alias("n"), F.lit(None).cast("bigint").alias("k"))
    dim = spark.range(10).select(F.col("id"), F.lit("x").alias("label"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = L.left_by_key(df, "k", dim, "id", {"label": "label"}, ["n"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(s["count"] for s in sizes) < 2000


def test_lookup_strict(spark):
    df = frame(spark, [(1,), (2,), (None,)], "k BIGINT")
    same = frame(spark, [(1, "a"), (1, "a"), (2, "b")], "id BIGINT, v STRING")
    assert rows_of(L.lookup(df, "k", same, "id", "v", "out", strict=True)) == [(1, "a"), (2, "b"), (None, None)]
    differing = frame(spark, [(1, "a"), (1, "b")], "id BIGINT, v STRING")
    assert rows_of(L.lookup(df, "k", differing, "id", "v", "out")) == [(1, "a"), (2, None), (None, None)]
    with pytest.raises(Exception, match="more than one v for 1"):
        L.lookup(df, "k", differing, "id", "v", "out", strict=True).collect()
    unasked = frame(spark, [(8, "a"), (8, "b"), (2, "b")], "id BIGINT, v STRING")
    assert rows_of(L.lookup(df, "k", unasked, "id", "v", "out", strict=True)) == [(1, None), (2, "b"), (None, None)]


def test_backfilled_parent(spark):
    df = frame(spark, [("w1", 1, "TT-9"), ("w2", 1, None), ("w3", 2, None), ("w4", None, None), ("w5", 7, None)],
               "w STRING, p BIGINT, o STRING")
    tt = frame(spark, [(1, "TT-1"), (2, "TT-2b"), (2, "TT-2a")], "ticketid BIGINT, orderid STRING")
    got = {r.w: r.o for r in lists.backfilled_parent(df, "o", "p", tt, ["w"]).collect()}
    assert got == {"w1": "TT-9", "w2": "TT-1", "w3": "TT-2a;TT-2b", "w4": "", "w5": ""}


def test_backfill_of_a_hot_ticket(spark, monkeypatch):
    monkeypatch.setattr(lists.child_lists, "__defaults__", (",", 5, None))
    df = frame(spark, [("w1", 1, None), ("w2", 2, None)], "w STRING, p BIGINT, o STRING")
    tt = spark.range(20).select(F.lit(1).cast("bigint").alias("ticketid"), F.col("id").cast("string").alias("orderid"))
    got = lists.backfilled_parent(df, "o", "p", tt, ["w"]).collect()
    found = [v for r in got if r.w == "w1" for v in r.o.split(";")]
    assert sorted(found) == sorted(str(i) for i in range(20)) and len([r for r in got if r.w == "w1"]) == 4
    assert [r.o for r in got if r.w == "w2"] == [""]


def users(spark):
    rows = [(5, "Ann", "TSC"), (3, "Ann", "WFS"), (1, "Bob", "FFS"), (9, "TSC", "OPM"), (8, "Cy", None)]
    return frame(spark, rows, "user_id BIGINT, fullname STRING, user_default_group STRING")


def test_default_group(spark):
    df = frame(spark, [("Ann",), ("Bob",), ("WFS",), ("TSC",), ("Cy",), ("nobody",), (None,)], "t STRING")
    got = {r.t: r.g for r in L.default_group(df, "t", L.group_directory(users(spark)), "g").collect()}
    assert got == {"Ann": "WFS", "Bob": "FFS", "WFS": "WFS", "TSC": "OPM", "Cy": "NA", "nobody": "NA", None: "NA"}


def test_processor_group(spark):
    texts = ["Bob", "Bob;zz", "zz;Bob", "zz;NOC_1;TSC_2", None, "WFS"]
    df = frame(spark, [(t,) for t in texts], "t STRING")
    got = {r.t: r.g for r in L.processor_group(df, "t", L.group_directory(users(spark)), "g").collect()}
    assert got == {"Bob": "FFS", "Bob;zz": "FFS", "zz;Bob": "NA", "zz;NOC_1;TSC_2": "TSC_2", None: "NA", "WFS": "WFS"}
    plain = {r.t: r.g for r in L.processor_group(df, "t", L.group_directory(users(spark)), "g", codes=[]).collect()}
    assert plain["zz;NOC_1;TSC_2"] == "NA"


def test_branch_lookup_failed_branch_gives_null(spark):
    df = frame(spark, [("A1-1", None), ("A1-x", "S9"), (None, "A1-2"), (None, "raw"), ("own", "raw")], "s STRING, o STRING")
    dim = frame(spark, [("A1-1", "SITE1"), ("A1-2", "SITE2")], "id STRING, site STRING")
    s, o = F.col("s"), F.col("o")
    branches = [(s.like("%A1%"), s, True), (o.like("%A1%"), o, True), (s.isNull(), o, False), (F.lit(True), s, False)]
    got = [r.out for r in L.branch_lookup(df, branches, dim, "id", "site", "out").collect()]
    assert sorted(got, key=repr) == sorted(["SITE1", None, "SITE2", "raw", "own"], key=repr)


def test_either_key_lookup(spark):
    dim = frame(spark, [("a", "P1"), ("b", "P1"), ("c", "P2")], "id STRING, province STRING")
    df = frame(spark, [("a", "b"), ("a", None), (None, "c"), ("x", "y")], "k1 STRING, k2 STRING")
    got = L.either_key_lookup(df, ("k1", "k2"), dim, "id", "province", "p")
    assert [r.p for r in got.orderBy("k1", "k2").collect()] == ["P2", "P1", "P1", None]
    mixed = frame(spark, [("a", "c")], "k1 STRING, k2 STRING")
    with pytest.raises(Exception, match="two values of province"):
        L.either_key_lookup(mixed, ("k1", "k2"), dim, "id", "province", "p").collect()
    assert L.either_key_lookup(mixed, ("k1", "k2"), dim, "id", "province", "p", strict=False).first().p == "P1"


def test_first_match_and_keys_only(spark):
    df = frame(spark, [("a",), ("b",)], "k STRING")
    hits = frame(spark, [("a", "2"), ("a", "1"), ("z", "0")], "h STRING, v STRING")
    assert rows_of(L.first_match(df, "k", hits, "h", "v", "out")) == [("a", "1"), ("b", "")]
    assert rows_of(L.keys_only(df, "k", hits, "h")) == [("a",)]
    assert L.keys_only(df, "k", hits.where("false"), "h").count() == 0


def groups(spark):
    return frame(spark, [(10, "G10"), (11, "G11")], "group_id BIGINT, groupname STRING")


def reference_names(text, known):
    """The slot rule worked out one id at a time."""
    out = []
    for ident in text.split(";"):
        name = known.get(ident.strip(), "")
        if name or out:
            out.append(name)
    return ";".join(out)


def test_id_lists(spark):
    people = frame(spark, [(1, "Ann"), (10, "Shadow")], "user_id BIGINT, fullname STRING")
    texts = ["10;11", "99;10;1", "10;99;1", "10;1;99", "99;98", "1;10;1", "10", None, "99;99;11;99"]
    df = frame(spark, [(t, t) for t in texts], "a STRING, b STRING")
    known = {"10": "G10", "11": "G11", "1": "Ann"}
    got = lists.resolve_id_lists(df, ["a"], groups(spark), people)
    for row in got.collect():
        assert row.a == (reference_names(row.b, known) if row.b and ";" in row.b else row.b)


def test_id_lists_strip_prefixes(spark):
    people = frame(spark, [(1, "Ann")], "user_id BIGINT, fullname STRING")
    df = frame(spark, [("user:1;group:10", "group:10;group:11"), ("user:1", None)], "a STRING, b STRING")
    got = lists.resolve_id_lists(df, ["a", "b"], groups(spark), people, prefixes={"a": ["user:", "group:"], "b": ["group:"]})
    assert rows_of(got) == [("Ann;G10", "G10;G11"), ("user:1", None)]


def test_child_lists(spark):
    kids = frame(spark, [(1, "c", 3), (1, "a", 1), (1, None, 2), (2, None, 1), (None, "x", 1), (3, "z", 1)],
                 "p BIGINT, v STRING, o INT")
    made = lists.child_lists(kids, "p", {"vs": ("v", "o")})
    assert rows_of(made) == [(1, 0, "a,c"), (2, 0, None), (3, 0, "z")]
    parents = frame(spark, [(1,), (2,), (4,)], "t BIGINT")
    assert rows_of(lists.with_child_lists(parents, "t", made, "p")) == [(1, "a,c"), (2, None), (4, None)]
    few = lists.child_lists_of(parents, "t", kids, "p", {"vs": ("v", "o")})
    assert [r.p for r in few.orderBy("p").collect()] == [1, 2]


def blocks_by_hand(rows, names, size):
    """Blocks of (parent, {list: [(order, value)]}) in plain Python."""
    out = []
    for p in {r[0] for r in rows if r[0] is not None}:
        own = {n: sorted((r[k], r[v]) for r in rows if r[0] == p and r[v] is not None) for n, v, k in names}
        for block in range(max(1, *[-(-len(x) // size) for x in own.values()])):
            cut = {n: [str(v) for _, v in x[block * size : (block + 1) * size]] for n, x in own.items()}
            out.append((p, block, *[",".join(cut[n]) if cut[n] else None for n, _, _ in names]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_every_parent_has_blocks_in_child_order(spark, size):
    """Parents with no, few and very many children, ties and copies: one rule, whatever the number of items in a block."""
    rng = random.Random(size)
    rows = [(p, rng.choice(["a", "b", None]), rng.randint(0, 3), rng.randint(0, 9)) for p in [*range(12)] * 3 + [5] * 60 + [None] * 4]
    rows += [(20, None, 1, 1), (21, "x", 0, 4), (22, "x", 0, 4), (22, "x", 0, 4)]
    kids = frame(spark, rows, "p BIGINT, v STRING, o INT, w INT")
    made = lists.child_lists(kids, "p", {"vs": ("v", "o"), "ws": ("w", "w")}, block_items=size)
    assert made.columns == ["p", "piece", "vs", "ws"]
    assert rows_of(made) == blocks_by_hand(rows, [("vs", 1, 2), ("ws", 3, 3)], size)


def test_a_hot_parent_is_spread_over_tasks(spark):
    """A third of the rows under one parent, most of them copies of one child."""
    kids = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 400).alias("p"), F.greatest(F.col("id"), F.lit(3000)).alias("v")
    )
    made = lists.child_lists(kids, "p", {"vs": ("v", "v")}, block_items=100)
    hot = made.where("p = -1").orderBy("piece").collect()
    assert [r.piece for r in hot] == list(range(20)) and {len(r.vs.split(",")) for r in hot} == {100}
    items = [int(v) for r in hot for v in r.vs.split(",")]
    assert items == sorted(max(i, 3000) for i in range(0, 6000, 3))
    rest = made.where("p <> -1").collect()
    assert len(rest) == len({r.p for r in rest}) == 400 and {r.piece for r in rest} == {0}


def test_fan_out_of_a_hot_key_stays_whole(spark):
    """Key 1 has 900 distinct matches and 500 copies of one more; all come out, spread over parts."""
    df = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k BIGINT, n STRING")
    many = spark.range(900).select(F.lit(1).cast("bigint").alias("m"), F.col("id").alias("s"))
    many = many.unionByName(spark.range(500).select(F.lit(1).cast("bigint").alias("m"), F.lit(-7).cast("bigint").alias("s")))
    many = many.unionByName(frame(spark, [(2, 5), (2, 5), (2, None), (None, 9), (8, 1)], "m BIGINT, s BIGINT"))
    wanted = df.join(many, F.col("k") == F.col("m"), "left").select("k", "n", "s")
    for hot_rows in (1, 7, 100, 10_000):
        got = L.fan_out_left(df, "k", many, "m", {"s": "s"}, ["n"], hot_rows)
        assert got.columns == ["k", "n", "s"]
        assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_pieces_do_not_multiply_a_fan_out(spark):
    parents = frame(spark, [(1,), (2,)], "t BIGINT")
    kids = spark.range(40).select(F.lit(1).cast("bigint").alias("p"), F.col("id").alias("v"))
    made = lists.child_lists(kids, "p", {"vs": ("v", "v")}, block_items=10)
    pieces = made.count()
    many = spark.range(30).select(F.lit(1).cast("bigint").alias("m"), F.col("id").alias("s"))
    df = lists.with_child_lists(parents, "t", made, "p", piece="piece")
    out = L.fan_out_left(df, lists.first_piece_key("t", "piece"), many, "m", {"s": "s"}, ["t", "piece"], 7)
    rows = out.where("t = 1").collect()
    assert pieces > 1 and len(rows) == 30 + pieces - 1
    assert sorted(r.s for r in rows if r.s is not None) == list(range(30))
    assert [int(v) for _, vs in sorted({(r.piece, r.vs) for r in rows}) for v in vs.split(",")] == list(range(40))
    assert [r.s for r in out.where("t = 2").collect()] == [None]


def test_range_ends_and_open_tickets(spark):
    rows = [
        ("start", "2021-12-08 16:00:00"),
        ("end", "2021-12-09 16:00:00"),
        ("after", "2021-12-09 16:00:01"),
        ("null", None),
    ]
    df = frame(spark, rows, "n STRING, t STRING").select("n", F.col("t").cast("timestamp").alias("t"))
    start, end = "2021-12-09 00:00:00", "2021-12-10 00:00:00"
    assert rows_of(df.where(predicates.in_local_range(df, "t", start, end)).select("n")) == [("end",), ("start",)]
    half = predicates.in_local_range(df, "t", start, end, half_open=True)
    assert rows_of(df.where(half).select("n")) == [("start",)]


def test_title_patterns(spark):
    df = frame(spark, [(t,) for t in ["Minor TSC", "Minor TSCx", "Minor", None, "lower Minor"]], "t STRING")
    kept = df.where(predicates.like_any("t", ["%Minor%"]) & predicates.like_none("t", ["%lower%", "%TSC_%"]))
    assert rows_of(kept) == [("Minor TSC",), ("Minor",)]


def test_not_recovered(spark):
    df = frame(spark, [("null", None), ("epoch", "1970-01-01 00:00:00"), ("real", "2021-01-01 00:00:00")], "n STRING, t STRING")
    df = df.select("n", F.col("t").cast("timestamp").alias("t"))
    assert rows_of(df.where(predicates.not_recovered(df, "t")).select("n")) == [("epoch",), ("null",)]


def test_years_of_recovery_are_bounds_of_a_stored_column(spark, tmp_path):
    times = ["1969-12-31 23:59:59", "1970-01-01 00:00:00", "1970-12-31 15:59:59", "1970-12-31 16:00:00", "1971-01-01 00:00:00", None]
    df = frame(spark, [(t,) for t in times], "s STRING").select("s", F.col("s").cast("timestamp").alias("t"))
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    stored = df.where(predicates.not_recovered(df, "t"))
    assert [r.s for r in stored.orderBy("s").collect()] == [None, *times[1:4]]
    assert [r.s for r in df.where(predicates.not_recovered(df, "t", "Asia/Manila")).orderBy("s").collect()] == [None, *times[:3]]
    plan = stored._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(IsNull(t),And(GreaterThanOrEqual(t," in plan and "year(" not in plan


def test_stacked_lookups_equal_single_ones(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 2, 3, 9, None]), rng.choice(["a", "b", "zz", None]), rng.choice([1, 1, 1, 2])) for i in range(200)]
    df = frame(spark, rows, "i BIGINT, k BIGINT, t STRING, h INT")
    numbers = frame(spark, [(1, "one"), (2, "two"), (2, "deux"), (None, "none"), (3, None)], "id BIGINT, label STRING")
    texts = frame(spark, [("a", "A"), ("b", "B"), ("1", "no number")], "id STRING, label STRING")
    got = L.stacked_lookups(df, "i", [
        L.Ask("n", "k", numbers, "id", "label"), L.Ask("m", F.col("h"), numbers, "id", "label"), L.Ask("x", "t", texts, "id", "label"),
        L.Ask("strict", F.when(F.col("k") != 2, F.col("k")), numbers, "id", "label", strict=True),
    ])
    want = L.lookup(df, "k", numbers, "id", "label", "n")
    want = L.lookup(want, F.col("h"), numbers, "id", "label", "m")
    want = L.lookup(want, "t", texts, "id", "label", "x")
    want = L.lookup(want, F.when(F.col("k") != 2, F.col("k")), numbers, "id", "label", "strict")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    with pytest.raises(Exception, match="more than one label for 2"):
        L.stacked_lookups(df, "i", [L.Ask("s", "k", numbers, "id", "label", strict=True)]).collect()
    doubled = L.stacked_lookups(df.withColumn("i", F.lit(1).cast("bigint")), "i", [L.Ask("n", "k", numbers, "id", "label")])
    assert rows_of(doubled.select("k", "n")) == rows_of(L.lookup(df, "k", numbers, "id", "label", "n").select("k", "n"))
