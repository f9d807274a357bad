"""Exact dedup, line dedup, mixing and quality rules against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter, defaultdict

import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F

from rivet.llm import quality
from rivet.llm.exact_dedup import exact_dedup
from rivet.llm.line_dedup import deduplicated, line_dedup
from rivet.llm.mixing import emit, mix_sources
from rivet.llm.quality import measures, quality_rules

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE = " \t\n\x0b\f\r"


def lower(t):
    return (t or "").translate(LOWER)


def split_words(t):
    return [w for w in re.split("[ \t-\r]+", t or "") if w]


def exact_by_hand(rows, keep):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lower(t)].append(i)
    out = Counter()
    for i, t, *_ in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        k = keep(ids) if ids else None
        out[(i, k, len(groups[lower(t)]), i == k, hashlib.sha256(lower(t).encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, keep, weak):
    """With a one-digit hash every hash has collisions; bytes decide."""
    rows = odd_rows()
    kw = {"content_hash": lambda c: F.substring(F.md5(c.cast("binary")), 1, 1).cast("binary")} if weak else {}
    got = Counter(map(tuple, exact_dedup(documents(spark, rows), keep=keep, **kw).collect()))
    assert got == exact_by_hand(rows, min if keep == "smallest" else max)


def lines_by_hand(rows, least=20, docs=3):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            holders[lower(x.strip(SPACE))].add(i)
    out = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            k = lower(x.strip(SPACE))
            ids = [h for h in holders[k] if h is not None]
            if len(k) < least or len(holders[k]) < docs or i == (max(ids) if ids else None):
                kept.append(x)
        out[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def test_line_dedup(spark):
    rows = odd_rows()
    out = deduplicated(documents(spark, rows), keep="last")
    assert Counter(map(tuple, out.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())) == lines_by_hand(rows)


def test_line_bitmaps_are_run_lengths(spark):
    rows = odd_rows()
    for r in line_dedup(documents(spark, rows), keep="last").collect():
        assert sum(r["keep_runs"]) == r["n_lines"] and sum(r["keep_runs"][1::2]) == r["n_dropped"]
        assert all(n > 0 for n in r["keep_runs"][1:-1])


def test_line_dedup_first_occurrence(spark):
    rows = [(i, "x" * 30 + "\nown line %d" % i) for i in range(5)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup(documents(spark, rows), keep="first").collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1}


def targets_by_hand(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        share = (total - sum(target.values())) / sum(w[s] for s in free)
        above = {s for s in free if w[s] * share > cap * sizes[s]}
        if not above:
            return target | {s: w[s] * share for s in free}
        target |= {s: cap * sizes[s] for s in above}
        free -= above
    return target


def test_mix_targets_copies_and_reruns(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 7}" if i % 3 else "hot") for i in range(3000)]
    rows += [(9000 + i, "w w w", None) for i in range(5)] + [(9900, None, "empty"), (9901, "x", "tiny")]
    df = documents(spark, rows)
    out = mix_sources(df, split_rows=64).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(split_words(t))
    want = targets_by_hand(sizes)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["copies"] <= 3
        rate = want[r["source"]] / max(sizes[r["source"]], 1)
        assert r["copies"] in (math.floor(rate), math.floor(rate) + 1)
        taken[r["source"]] += r["copies"] * r["size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.06 * t, 100), s
    again = mix_sources(df.repartition(7), split_rows=64)
    assert sorted(map(str, map(tuple, again.collect()))) == sorted(map(str, map(tuple, out)))
    copies = {r["doc_id"]: r["copies"] for r in out}
    emitted = emit(df, mix_sources(df, split_rows=64))
    assert emitted.columns == df.columns
    got = {r["doc_id"]: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}


def test_mix_draws_are_fair(spark):
    """Over seeds, a document's extra copy comes with the source's fraction."""
    df = documents(spark, [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(60)], clash=False)
    hits, rate = Counter(), None
    for seed in range(30):
        for r in mix_sources(df, seed=seed).collect():
            if r["source"] == "a":
                rate = r["target"] / r["source_size"]
                hits[r["doc_id"]] += r["copies"] - math.floor(rate)
    mean = sum(hits.values()) / (30 * 30)
    assert abs(mean - (rate - math.floor(rate))) < 0.05


def test_mix_offsets_a_long_text(spark):
    """Sources with one text of most words meet their target to a short text, whether it is
    drawn or not, and every text comes as often as its source's fraction says."""
    rows = [(s * 100 + i, "w " * (300 if i == 0 else 10), f"s{s:03d}") for s in range(720) for i in range(41)]
    out = mix_sources(documents(spark, rows, clash=False), weights=(3, 2, 1)).collect()
    taken, hits = Counter(), Counter()
    for r in out:
        taken[r["source"], r["target"]] += r["copies"] * r["size"]
        if r["target"] != r["source_size"]:  # a fraction of one half
            hits[r["size"]] += r["copies"] - r["target"] // r["source_size"]
    assert max(abs(words - target) for (_, target), words in taken.items()) <= 10
    # 480 draws of a long text; as the words of a source are fixed, short texts move by 300 / 400 of its excess
    assert abs(hits[300] / 480 - 0.5) < 0.07 and abs(hits[10] / 19200 - 0.5) < 0.07 * 300 / 400 + 0.01


def measured_by_hand(t):
    w = split_words(t)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + o for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for o in range(3)}
    lines = [x for x in (t or "").split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines),
            len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    rows = odd_rows() + [(200, "a b c a b c a b c"), (201, "x x x x"), (202, "## $ %\n## $ %"), (203, "a b"),
                         (204, "p q r s p q r t q r s")]
    got = Counter(tuple(r)[2:] for r in measures(documents(spark, rows), "doc_id", "text", "source").collect())
    assert got == Counter(measured_by_hand(t) for _, t, *_ in rows)


def test_measures_with_interleaved_collisions(spark):
    """The first windows of these pairs share 40 bits of their hashes; each
    text has one of them before and after the other."""
    pairs = [(630076, 995378), (1045777, 1498020), (279699, 1902338)]
    rows = [(i, f"w{a} x y one w{b} x y two w{a} x y three") for i, (a, b) in enumerate(pairs)]
    got = {r["id"]: r["n_repeat_words"] for r in measures(documents(spark, rows), "doc_id", "text", "source").collect()}
    assert got == {0: 6, 1: 6, 2: 6}


def test_window_places_have_room_for_any_text():
    assert quality.PLACE >= (1 << 31) - 1 and quality.PLACE_BITS == quality.PLACE.bit_length()


def test_host_verdicts(spark):
    """A symbol-ridden document passes on a clean host and fails on a bad one;
    a clean document stays on either."""
    clean = " ".join(f"word{i}" for i in range(80))
    odd = " ".join(f"word{i}##" for i in range(80))
    rows = [(i, clean, "good") for i in range(40)] + [(100, odd, "good")]
    rows += [(200 + i, odd, "bad") for i in range(30)] + [(300, clean, "bad"), (301, "short", "good"), (302, None, None)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules(documents(spark, rows)).collect()}
    assert got[0] == (False, True) and got[100] == (False, True)
    assert got[200] == (False, False) and got[300] == (False, True)
    assert got[301] == (True, False) and got[302] == (True, False)


def test_empty_tables(spark):
    df = documents(spark, [(1, "x")]).filter("false")
    for op in (exact_dedup, line_dedup, mix_sources, quality_rules):
        assert op(df).collect() == []
