"""Each stage of the pipeline against brute force: which rows stay, and with which texts."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import PRIVATE, brute_contaminated
from triagegrid.llm import common, quality, secret_scan
from triagegrid.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _score double, score string, row int, key long, ids string, n_tokens int"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not there")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "x", 1, 2, "y", 3) for i, t in rows], SCHEMA)


def staged(spark, n, rows, folder=FOLDER):
    docs = stored(frame(spark, rows), "docs")
    out = stored(corpus_pipeline.STAGES[n][1](spark, docs, folder), "stage")
    return docs, out


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


ODD = [(None, "no id at all here"), (None, None), (1, None), (2, ""), (3, " \t"), (4, "x" * 200_000), (5, "five words of some text"), (5, "five words of some text")]


def test_quality_stage(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, FOLDER, "documents").collect()] + ODD
    docs, out = staged(spark, 0, rows)
    model = quality.train(docs, common.table(spark, FOLDER, "labels"))
    want = []
    for i, t in rows:
        (_, _, x, starts), = quality.passages([t])
        if quality.forward(model, x, starts)["p"][0] >= quality.LIMIT:
            want.append((i, t))
    assert out.columns == docs.columns and texts_of(out) == sorted(want, key=repr) and 0 < len(want) < len(rows)


def test_group_stage(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(10 + i, " ".join([*base[: 80 - 2 * i], *(f"v{i}x{k}" for k in range(2 * i))])) for i in range(8)]
    rows += [(100, " ".join(base[::-1])), (90, " ".join(base[::-1]).upper()), (7, "one text"), (7, "quite another text of more words"), *ODD]
    docs, out = staged(spark, 1, rows)
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        if i is not None and i != 7:
            sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    group[a] = group[b] = min(group[a], group[b])
    want = sorted({(i, t) for i, t in rows if i is not None and group.get(i, i) == i}, key=repr) + [(i, t) for i, t in rows if i is None]
    assert out.columns == docs.columns and texts_of(out) == sorted(want, key=repr) and len(want) < len(rows) - 3
    assert {tuple(r)[2:] for r in out.where("doc_id = 5").collect()} == {("en", "s", 23, 0.5, "x", 1, 2, "y", 3)}


def test_benchmark_stage(spark):
    items = [(r.item_id, r.text) for r in common.table(spark, FOLDER, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in common.table(spark, FOLDER, "documents").collect()][:120]
    rows += [(7, f"before {items[0][1]} after"), (7, "a clean text of that id"), (None, items[1][1]), (8, items[2][1]), (8, items[2][1]), *ODD]
    docs, out = staged(spark, 2, rows)
    held = {i for i, _ in brute_contaminated(list(enumerate(t for _, t in rows)), items)}
    want = [r for k, r in enumerate(rows) if k not in held]
    assert out.columns == docs.columns and texts_of(out) == sorted(want, key=repr) and len(held) >= 4


def test_secret_stage(spark):
    rows = [(20, "a password=abcdefgh1 b"), (21, f"x {PRIVATE.hex()} y {PRIVATE.hex()}"), *ODD]
    docs, out = staged(spark, 3, rows)
    want = []
    for i, t in rows:
        if t is not None:
            base, more = secret_scan.spans_of(t)
            hidden = {k for a, _, b in base + more for k in range(a, b)}
            t = re.sub("\0+", "[secret]", "".join("\0" if k in hidden else c for k, c in enumerate(t)))
        want.append((i, t))
    assert out.columns == docs.columns and texts_of(out) == sorted(want, key=repr)
    assert out.where(F.coalesce(F.length("text"), F.lit(0)) != F.coalesce("n_chars", F.lit(0))).count() == 0
    assert (20, "a [secret] b") in want and (21, "x [secret] y [secret]") in want


def test_token_stage(spark):
    docs, out = staged(spark, 4, ODD)
    assert out.columns == [c for c in docs.columns if c != "text"] + ["_ids", "_n_tokens"] and out.count() == len(ODD)
    from triagegrid.llm.pieces import decode_documents

    back = decode_documents(out, column="_ids")
    assert texts_of(back) == sorted(((i, t or "") for i, t in ODD), key=repr)


@pytest.mark.parametrize("n", range(5))
def test_empty_tables(spark, n):
    docs, out = staged(spark, n, [])
    assert out.count() == 0


def test_whole_pipeline(spark):
    ids = [r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()]
    docs = {r.doc_id for r in common.table(spark, FOLDER, "documents").select("doc_id").collect()}
    assert len(ids) == len(set(ids)) and set(ids) < docs and len(ids) > len(docs) // 3
