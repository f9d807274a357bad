"""The exact pair filter of near-dedup: no linked pair lost, and pairs that
only share a frequent passage never meet."""

import random

from rivet.llm.setsketch import _prefix_pairs

SCHEMA = "cls binary, root binary, text string"


def _nodes(spark, texts):
    keys = [i.to_bytes(4, "big") for i in range(len(texts))]
    return spark.createDataFrame([(k, k, t) for k, t in zip(keys, texts, strict=True)], SCHEMA)


def _set(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_no_linked_pair_is_lost(spark):
    r = random.Random(5)
    texts = []
    for base in range(12):  # families of near copies, from a few words to a few hundred
        words = [f"w{r.randrange(10_000)}" for _ in range(r.choice([6, 12, 40, 160, 400]))]
        for _ in range(6):
            cut = r.randrange(0, max(1, len(words) // 3))
            texts.append(" ".join([*words[cut:], *(f"x{r.randrange(10_000)}" for _ in range(r.randrange(0, len(words) // 6 + 1)))]))
    texts = sorted(set(texts))
    met = {(int.from_bytes(p["a"], "big"), int.from_bytes(p["b"], "big")) for p in _prefix_pairs(_nodes(spark, texts), 75).collect()}
    sets = [_set(t) for t in texts]
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
              if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(linked) > 20 and linked <= met


def test_a_frequent_passage_brings_no_pairs(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [passage + " " + " ".join(f"own{d}_{i}" for i in range(20)) for d in range(300)]
    assert _prefix_pairs(_nodes(spark, texts), 75).isEmpty()
