"""Source divergence against brute force, with digests so short that most terms collide, and edge cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from triagegrid.llm import common, source_divergence

SCHEMA = "text string, lang string, source string, item string, digest long"


def frame(spark, rows):
    return spark.createDataFrame([(t, y, s, "x", 1) for t, y, s in rows], SCHEMA)


def brute(rows, least=30, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))
        counts[lang, source].update(terms)
        docs[lang].update(terms.keys())
    out = []
    order = lambda items: sorted(items, key=lambda x: (-x[1], x[0].encode()))
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        every = Counter()
        for other in (s for y, s in groups if y == lang):
            every.update({t: counts[lang, other][t] for t in kept})

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = shares(counts[lang, source]), shares(every)
        pairs = []
        for other in (s for y, s in groups if y == lang and s != source):
            r = shares(counts[lang, other])
            pairs.append((other, sum(abs(p[t] - r[t]) for t in kept)))
        terms = [(t, p[t] - q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        out += [(lang, source, "pair", i, v, k) for k, (i, v) in enumerate(order(pairs), 1)]
        out += [(lang, source, "term", i, v, k) for k, (i, v) in enumerate(order(terms)[:top], 1)]
    return sorted(out)


def got(spark, rows, **options):
    return sorted(tuple(r) for r in source_divergence.audit(frame(spark, rows), **options).collect())


def corpus(seed=0, n=240):
    random = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "aAbBcéßxyz" for b in ("", "um", "é", "ing", "'s", "漢字")]
    rows = []
    for i in range(n):
        source = ["a", "b", None, "é", "z"][i % 5]
        weights = random.dirichlet(np.full(len(words), 0.3 + (i % 5)))
        rows.append((" ".join(random.choice(words, 25, p=weights)), ["en", "de", None][i % 3], source))
    return rows


@pytest.mark.parametrize("bits", [64, 3])
def test_equal_to_brute_force(spark, bits, monkeypatch):
    rows = corpus()
    rows += [(None, "en", "silent"), ("", "xx", "one"), (" 1 2 ", "xx", "two"), ("rare", "yy", None)]
    monkeypatch.setattr(source_divergence, "CELLS", 40)
    want = brute(rows, least=12, top=7)
    assert len(want) > 100 and got(spark, rows, least_docs=12, top=7, bits=bits) == want


def test_ties_at_the_last_rank(spark):
    rows = [("alpha beta gamma delta", "en", "a")] * 30 + [("omega", "en", "b")] * 30
    want = brute(rows, top=2)
    assert [r[3] for r in want if r[1] == "a" and r[2] == "term"] == ["alpha", "beta"] and got(spark, rows, top=2) == want


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "GROUP_BYTES", 64)
    monkeypatch.setattr(source_divergence, "GROUP_BYTES", 64)
    long = ("word " * 400 + "x" * 3000 + " ") * 3
    rows = [(long, "en", "a"), (long, "en", "a"), ("word", "en", "b"), (None, None, None), ("w1w2-w3_w4 É", "en", "b")]
    assert got(spark, rows, least_docs=2) == brute(rows, least=2)
    assert got(spark, rows, least_docs=2, bits=2) == brute(rows, least=2)
    assert got(spark, []) == [] and got(spark, rows) == brute(rows)


def test_terms_that_share_a_digest_are_told_apart():
    data = common.LOWER[np.frombuffer(b"ab cd ab e cd e fgh ab", np.uint8)]
    begin, number, found, span = source_divergence.distinct_terms(data, 1)
    text = data.tobytes()
    terms = [text[a:b] for a, b in span.tolist()]
    assert [terms[k] for k in number.tolist()] == text.split() and len(set(terms)) == 4 and len(found) == 4 and set(found.tolist()) <= {0, 1}


def test_pool_gives_everything_once(monkeypatch):
    monkeypatch.setattr(source_divergence, "POOL", 10)
    pool, rows = source_divergence.Pool(), []
    random = np.random.default_rng(5)
    want = Counter()
    for _ in range(30):
        group, digest = random.integers(0, 3, 6), random.integers(0, 9, 6)
        want.update(zip(group.tolist(), digest.tolist()))
        pool.add(group, digest, np.ones(6, np.int64), np.ones(6, np.int64))
        rows += list(pool.counts([("x", str(g)) for g in range(3)], 5))
    rows += list(pool.counts([("x", str(g)) for g in range(3)], 0))
    have = Counter()
    for batch in rows:
        for r in batch.to_pylist():
            have[int(r["source"]), r["digest"]] += r["n"]
    assert have == want


def test_pool_keeps_the_ends_of_each_digest(monkeypatch):
    monkeypatch.setattr(source_divergence, "POOL", 7)
    pool = source_divergence.Pool()
    for text in (b"ab cd ef", b"cd gh", b"x cd ab zz ab", "\u00e9 ab".encode()):
        data = np.frombuffer(text, np.uint8)
        _, _, found, span = source_divergence.distinct_terms(data, 1)
        pool.remember(found, span, data)
    ends = {}
    for batch in pool.strings(0):
        for r in batch.to_pylist():
            low, high = ends.get(r["digest"], (r["low"], r["low"]))
            ends[r["digest"]] = min(low, r["low"]), max(high, r["high"] or r["low"])
    want = {}
    for t in ("ab", "cd", "ef", "gh", "x", "zz", "\u00e9"):
        d = int(source_divergence.distinct_terms(np.frombuffer(t.encode(), np.uint8), 1)[2][0])
        low, high = want.get(d, (t, t))
        want[d] = min(low, t), max(high, t)
    assert ends == want


def test_filters_grow_with_their_ids(spark):
    ids = spark.range(0, 40_000, 3)
    held = common.id_filter(ids, "id").value
    assert common.passes(held, np.arange(0, 40_000, 3)).all() and common.passes(held, np.arange(1, 40_000, 3)).mean() < 0.15
    assert len(held) * 64 >= 16 * ids.count() and not common.passes(common.id_filter(ids.limit(0), "id").value, np.arange(9)).any()
