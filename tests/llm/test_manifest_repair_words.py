"""Merkle manifest, conversation repair and word BPE against brute force."""

from __future__ import annotations

import hashlib
import heapq
import os
import random
import re
import time
import zlib

import public_tokenizers
import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivet.llm import conversations as C
from rivet.llm import merkle as M
from rivet.llm.automaton import Encoder, WordTokenizer, encode_words
from rivet.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


# Merkle manifest

def manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    (doc_id, source, lang, n_chars, text) rows, node by node."""
    def leaf(values):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        ways, places = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, p in enumerate(places):
                first = p - p % 3
                ways[k].append((nodes[first:p], nodes[p + 1:first + 3]))
                places[k] = p // 3
            nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        return nodes[0], ways

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: tree([h for _, h in groups[s]]) for s in names}
    root, over = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over, strict=True):
        subroot, ways = trees[s]
        for (r, own), way in zip(groups[s], ways, strict=True):
            h = own
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                h = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in way + above:
                h = H(*left, h, *right)
            proof = H(*[x for left, right in way + above for x in left + right])
            out.append((r[0], own, subroot, root, proof, h, h == root))
    return ordered(out)


def manifest_query(spark, docs, tmp_path, name):
    docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return ordered(map(tuple, LLM_QUERIES["op11_merkle_manifest"](spark, f"{tmp_path}/{name}").collect()))


@pytest.mark.parametrize("name", ["odd", "one", "empty", "blocks", "lone"])
def test_manifest_equals_brute_force(spark, tmp_path, name):
    rng = random.Random(2)
    rows = {"odd": odd_rows(), "one": [(1, "a\nb", None)], "empty": [],
            # a hot source of more than two blocks of blocks, and many of one row
            "blocks": [(i, f"t{i}\n{rng.random()}", "hot") for i in range(800)] + [(1000 + i, "x", f"s{i}") for i in range(90)],
            "lone": [(i, "t\n", f"s{i}") for i in range(4)]}[name]
    docs = documents(spark, rows)
    got = manifest_query(spark, docs, tmp_path, name)
    want = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got == (manifest(want) if want else [])


def test_proof_fails_for_any_other_value(spark):
    docs = documents(spark, [(i, f"text {i}", f"s{i % 3}") for i in range(30)])
    for field, value in (("lang", F.lit("de")), ("n_chars", F.col("n_chars") + 1), ("source", F.lit(None).cast("string"))):
        out = M.merkle_manifest(docs, presented={field: value})
        assert out.filter("folded_root = root").isEmpty()
    assert M.merkle_manifest(docs).filter("folded_root <> root").isEmpty()


# Conversation repair

def cheapest(rows):
    """Report of ordered (turn, role, text) rows: all edits, cheapest first."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not (a[1] and b[1])
                  for a, b in zip(rows, rows[1:], strict=False))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    heap, done = [(0, "", 0, ())], set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in out)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return gaps, *counts, illegal, cost, audit, H("\n".join(f"{r}:{t}" for r, t in out))
        if (i, audit) in done:
            continue
        done.add((i, audit))

        def push(c, letter, j, more=()):
            way = initials + "".join(r[:1] for r, _ in more)
            if re.fullmatch("s?(ua)*u?", way):
                heapq.heappush(heap, (cost + c, audit + letter, j, (*out, *more)))
        if i < len(rows):
            _, role, text = rows[i]
            late = 3 * (faults[i] == "truncated")
            push(4, "D", i + 1)
            if faults[i] not in ("blank", "duplicate"):
                if role:
                    push(late, "K", i + 1, ((role, text),))
                for other in ("user", "assistant"):
                    push(3 + late, "R", i + 1, ((other, text),))
        if len(out) < 2 * len(rows) + 3:
            for other in ("user", "assistant"):
                push(3, "I", i, ((other, ""),))


def talk(seed=3, n=120):
    rng = random.Random(seed)
    texts = ["Hi.", "Hi.", "Yes!", "no end", "", " \n", None]
    return [(conv or None, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             rng.choice([*texts, f"Why? {rng.random()}."])) for conv in range(n) for t in range(rng.randint(1, 6))]


def in_order(rows):
    bare = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    return sorted(bare, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


@pytest.mark.parametrize("chunk", [1024, 2, 1])
def test_repair_equals_exhaustive_search(spark, chunk):
    rows = talk()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit(1))
    got = {r[0]: tuple(r)[1:] for r in C.repair_report(df.repartition(4), chunk=chunk).collect()}
    assert got == {c: cheapest(in_order([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}


def test_repaired_rows_and_their_digest(spark):
    df = spark.createDataFrame(talk(5), "conv_id long, turn long, role string, text string")
    rows = {}
    for r in C.repaired_rows(df, chunk=2).collect():
        rows.setdefault(r["conv_id"], {})[r["place"]] = f"{r['role']}:{r['text']}"
    for r in C.repair_report(df).collect():
        lines = rows.get(r["conv_id"], {})
        assert sorted(lines) == list(range(len(lines)))
        assert r["repaired_sha256"] == H("\n".join(lines[k] for k in sorted(lines)))
        initials = "".join(lines[k][0] for k in sorted(lines))
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_one_long_conversation(spark):
    """A conversation of most rows is cut; its edits are those of one piece."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["So.", f"n{t % 50}", f"Yes {t}."])) for t in range(3000)]
    rows += [(2, 0, "user", "Hm?"), (2, 1, "assistant", "Hm.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, C.repair_report(df, chunk=5000).collect()))
    assert whole == sorted(map(tuple, C.repair_report(df, chunk=256).collect()))
    assert whole[1][6:8] == (0, "KK")


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_report(df).isEmpty() and C.repaired_rows(df).isEmpty()


def test_damaged_query_keeps_every_conversation(spark, tmp_path):
    """Conversations without a row after the damage, null ids and nulls."""
    dropped = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    rows = [(c, 0, "user", "gone?") for c in dropped] + [(None, None, None, None), (None, 0, "user", "Hi."), (900, 0, "user", "a. b! c?")]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    got = {r["conv_id"]: r for r in LLM_QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c in dropped:
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", H(""))


def test_damage_cases(spark):
    rows = [(c, 0, "system", "a. b! c?") for c in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {}
    for r in C.damage(df).collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c in range(200):
        case = zlib.crc32(f"{c}:0".encode()) % 20
        own = ("system", "a. b! c?")
        assert got.get(c, []) == {0: [], 1: [("system", "")], 2: [("system", "a b c")], 3: [own, own], 4: [("user", own[1])]}.get(case, [own])


# Word BPE

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return WordTokenizer(FILE)


def library(texts):
    own = Tokenizer.from_file(FILE)
    return [(len(e.ids), " ".join(map(str, e.ids)), own.decode(e.ids, skip_special_tokens=False))
            for e in own.encode_batch(texts, add_special_tokens=False)]


def test_words_equal_the_library(tokenizer):
    rng = random.Random(1)
    texts = [s.replace("</w>", "") for s in tokenizer.labels.values()]
    texts += ["".join(rng.choices("abcdeéthinrstougl'’123 ÀÉ\n", k=200)) for _ in range(500)]
    texts += ["a<|endoftext|>b <|startoftext|><|ENDOFTEXT|> it's I'M ΣΑΣ İstanbul é", "", " \n", "<|endoftext|>", "x<|endoftext|",
              "\x1c\x1d\x85 　x", "漢字 हिन्दी 😀👍🏽 ﬁ Å"]
    texts += ["".join(rng.choices("abcdefgh", k=5000)), "ab" * 3000, "a" * 4001]
    assert list(Encoder(tokenizer).encode(texts)) == library(texts)


def test_automaton_accepts_one_path(tokenizer):
    """Every arc sequence the table allows is the encoding of its own word:
    pairs of labels are allowed exactly if the library leaves them alone."""
    import numpy as np
    rng, a = random.Random(4), tokenizer.automaton
    inner = [i for i, s in tokenizer.labels.items() if not s.endswith("</w>") and i < 49406]
    final = [i for i, s in tokenizer.labels.items() if s.endswith("</w>") and re.fullmatch("[a-z]+</w>", s)]
    inner = [i for i in inner if re.fullmatch("[a-z]+", tokenizer.labels[i])]
    pairs = [(rng.choice(inner), rng.choice(final)) for _ in range(4000)]
    allowed = a.allowed(a.enters[[u for u, _ in pairs]].astype(np.int64), np.array([v for _, v in pairs]))
    words = [tokenizer.labels[u] + tokenizer.labels[v][:-4] for u, v in pairs]
    assert allowed.tolist() == [ids == f"{u} {v}" for (u, v), (_, ids, _) in zip(pairs, library(words), strict=True)]
    assert 0 < allowed.sum() < len(pairs)


def test_a_long_word_takes_linear_time(tokenizer):
    rng = random.Random(6)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300_000))
    began = time.time()
    (n, ids, decoded), = Encoder(tokenizer).encode([word])
    assert time.time() - began < 60
    assert decoded.replace(" ", "") == word + "</w>" and n == len(ids.split())
    assert (n, ids, decoded) == library([word])[0]


def test_encode_words_query_columns(spark, tmp_path):
    rows = odd_rows()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op13_word_bpe"](spark, str(tmp_path)).collect()
    want = [(r[0], n, H(ids), H(d)) for r, (n, ids, d) in zip(rows, library([r[1] or "" for r in rows]), strict=True)]
    assert ordered(map(tuple, got)) == ordered(want)
    assert encode_words(documents(spark, rows).limit(0), FILE).isEmpty()


@needs_data
def test_digests_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(r["doc_id"], n, H(ids), H(d)) for r, (n, ids, d) in zip(docs, library([r["text"] or "" for r in docs]), strict=True)]
    assert ordered(map(tuple, LLM_QUERIES["op13_word_bpe"](spark, SF).collect())) == ordered(want)
