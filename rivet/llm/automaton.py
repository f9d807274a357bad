"""Word BPE by a tokenization automaton.

The merge table is compiled, once on the driver, into a deterministic
automaton over tokens that accepts the BPE encoding of every word and nothing
else. Compilation starts with one state that allows every base symbol after
every other and applies one merge gadget per merge (u, v) -> w, in rank order:
the state q entered by u is split off without its arc v, so u can no longer be
followed by v; every state with an arc u gets an arc w; and w enters the state
that v entered. Merges that no word can reach (q has no arc v) add nothing.

Whether a state has an arc w depends only on the tokens at w's left end, so
labels are numbered in depth-first order of the tree "left part of", later
merges first. One gadget then forbids one range of labels, and a state's row
of the transition table is a short list of forbidden ranges instead of one
entry per token. The state entered is a function of the label alone.

A word is read once from left to right. As the automaton is deterministic and
every prefix of a word has one encoding, each place is reached by one path:
from each reached place the labels that match there are looked up in a trie of
symbols and tried in the table. The path's labels are the ids; decoding writes
the labels' strings. Cost is linear in the word's length, however long it is.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet.llm.bpe import Words
from rivet.llm.secrets import blocks

CACHE_WORDS = 200_000  # words whose encoding a task keeps
CACHE_BYTES = 32 << 20  # of those words, ids and labels
LONG_WORD = 256  # symbols; longer words are read one at a time
BATCH_SYMBOLS = 200_000  # of new words read side by side
BLOCK_BYTES = 4 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable
    in Latin-1 and no space, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def unassigned() -> str:
    """Ranges of a character class: letters and digits of the ``regex``
    library that Python's Unicode tables do not have yet. The tokenizer
    library has its own tables; letters that only some of the three know are
    the one case where words can be cut differently."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    new = [ord(c) for c in "".join(regex.findall(r"[\p{L}\p{N}]+", every)) if unicodedata.category(c) == "Cn"]
    starts = [c for c, before in zip(new, [-1, *new], strict=False) if c != before + 1]
    ends = [c for c, after in zip(new, [*new[1:], -1], strict=True) if after != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True)) or r"\x00"


class Automaton:
    """Transition table of a merge table.

    ``vocabulary`` maps token strings to ids, ``merges`` are pairs of strings
    in rank order and ``suffix`` marks a word's last symbol.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        chars = byte_characters()
        self.inner = np.array([vocabulary[c] for c in chars], np.int32)
        self.final = np.array([vocabulary[c + suffix] for c in chars], np.int32)
        base = [*self.inner.tolist(), *self.final.tolist()]
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        place, end_of = self._number(base, pairs)
        live = self._compile(base, pairs, place, end_of, max(vocabulary.values()) + 1)
        self._trie(base, [p for p in pairs if p[2] in live])
        self.place = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, at in place.items():
            self.place[token] = at

    @staticmethod
    def _number(base: list[int], pairs: list[tuple[int, int, int]]):
        """Place of each label in depth-first order and, for each label, the
        ranks of the labels that start with it next and where their ranges end."""
        children: dict[int, list[tuple[int, int]]] = {}
        for rank in range(len(pairs) - 1, -1, -1):  # later merges first
            children.setdefault(pairs[rank][0], []).append((rank, pairs[rank][2]))
        place: dict[int, int] = {}
        end_of: dict[int, tuple[list[int], list[int]]] = {}
        stack = [(b, False) for b in reversed(base)]
        while stack:
            token, done = stack.pop()
            if done:
                mine = children[token]
                ends = [*[place[c] for _, c in mine[1:]], len(place)]
                end_of[token] = [r for r, _ in mine], ends
                continue
            place[token] = len(place)
            if token in children:
                stack.append((token, True))
                stack.extend((c, False) for _, c in reversed(children[token]))
        return place, end_of

    def _compile(self, base, pairs, place, end_of, n_tokens: int) -> set[int]:
        """Apply the merge gadgets; returns the labels that some word uses."""
        enters = dict.fromkeys(base, 0)  # state that a label enters
        split_from, low, high = [-1], [0], [0]  # of each state: the state it is a copy of, less one range
        live = set(base)

        def allows(state: int, at: int) -> bool:
            while state > 0:
                if low[state] <= at < high[state]:
                    return False
                state = split_from[state]
            return True

        for rank, (u, v, w) in enumerate(pairs):
            if u not in live or v not in live or not allows(enters[u], place[v]):
                continue
            q = enters[u]
            # v itself, and all labels that start with v and are made from now on
            ranks, ends = end_of.get(v, ([], []))
            later = bisect_right(ranks, -rank, key=lambda r: -r)
            split_from.append(q)
            low.append(place[v])
            high.append(ends[later - 1] if later else place[v] + 1)
            enters[w] = enters[v]  # before the split: uu may be followed by u
            enters[u] = len(low) - 1
            live.add(w)

        used: dict[int, int] = {0: 0}  # states that some label enters, numbered anew
        rows: list[list[tuple[int, int]]] = [[]]
        self.enters = np.zeros(n_tokens, np.int32)
        for token, state in enters.items():
            if state not in used:
                used[state] = len(rows)
                ranges = []
                while state > 0:
                    ranges.append((low[state], high[state]))
                    state = split_from[state]
                rows.append(_joined(ranges))
            self.enters[token] = used[enters[token]]
        self.width = len(place)
        self.lows = np.array([s * self.width + a for s, r in enumerate(rows) for a, _ in r], np.int64)
        self.highs = np.array([s * self.width + b for s, r in enumerate(rows) for _, b in r], np.int64)
        return live

    def _trie(self, base: list[int], pairs: list[tuple[int, int, int]]) -> None:
        """Labels by their symbols: (node, symbol) -> node, node -> label."""
        number = {b: i for i, b in enumerate(base)}  # symbols as 0 .. n - 1
        self.symbol = np.full(max(base) + 1, -1, np.int64)
        self.symbol[base] = np.arange(len(base))
        self.n_symbols = len(base)
        spelt = {b: (number[b],) for b in base}
        self.next: dict[int, int] = {}
        label = [-1]
        for u, v, w in pairs:
            spelt[w] = spelt[u] + spelt[v]
        for token, symbols in spelt.items():
            node = 0
            for s in symbols:
                key = node * self.n_symbols + s
                if key not in self.next:
                    self.next[key] = len(label)
                    label.append(-1)
                node = self.next[key]
            label[node] = token
        self.label = np.array(label, np.int32)
        order = np.array(sorted(self.next), np.int64)
        self.keys, self.children = order, np.array([self.next[k] for k in order.tolist()], np.int64)

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = node * self.n_symbols + symbol
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.children[at], -1)

    def allowed(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Whether each state has an arc with the label."""
        if not len(self.lows):
            return np.ones(len(state), bool)
        key = state * np.int64(self.width) + self.place[label]
        at = np.searchsorted(self.lows, key, side="right") - 1
        return (at < 0) | (key >= self.highs[at])

    def _row(self, state: int) -> tuple[list[int], list[int]]:
        a, b = np.searchsorted(self.lows, [state * self.width, (state + 1) * self.width])
        return (self.lows[a:b] - state * self.width).tolist(), (self.highs[a:b] - state * self.width).tolist()

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word (at least one byte long)."""
        out: list = [None] * len(words)
        batch, size = [], 0
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._read_one(w)
                continue
            batch.append(i)
            size += len(w)
            if size >= BATCH_SYMBOLS:
                self._read(words, batch, out)
                batch, size = [], 0
        if batch:
            self._read(words, batch, out)
        return out

    def _read(self, words: list[bytes], wanted: list[int], out: list) -> None:
        """Words side by side, one place of all of them at a time."""
        length = np.array([len(words[i]) for i in wanted])
        n_words, total = len(wanted), int(length.sum())
        begin = np.cumsum(length) - length
        raw = np.frombuffer(b"".join([words[i] for i in wanted]), np.uint8)
        symbol = self.symbol[self.inner[raw]]
        last = begin + length - 1
        symbol[last] = self.symbol[self.final[raw[last]]]
        word = np.repeat(np.arange(n_words), length)
        left = np.repeat(begin + length, length) - np.arange(total)  # symbols from here to the word's end

        at, node = np.arange(total), self._step(np.zeros(total, np.int64), symbol)
        found, reach = [], 1
        while len(at):
            label = self.label[node]
            hit = label >= 0
            found.append((at[hit], np.full(int(hit.sum()), reach), label[hit]))
            more = left[at] > reach
            at, node = at[more], node[more]
            node = self._step(node, symbol[at + reach])
            ok = node >= 0
            at, node, reach = at[ok], node[ok], reach + 1
        start, span, label = (np.concatenate(x) for x in zip(*found, strict=True))
        local = start - begin[word[start]]
        order = np.argsort(local, kind="stable")
        start, span, label, local = start[order], span[order], label[order], local[order]
        cuts = np.searchsorted(local, np.arange(int(local[-1]) + 2))

        source = start + word[start]  # a word of n symbols has n + 1 places
        state = np.full(total + n_words, -1, np.int64)
        state[begin + np.arange(n_words)] = 0
        via, back = np.zeros(total + n_words, np.int64), np.zeros(total + n_words, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            s, t, k = source[a:b], span[a:b], label[a:b]
            q = state[s]
            ok = q >= 0
            s, t, k, q = s[ok], t[ok], k[ok], q[ok]
            ok = self.allowed(q, k)
            s, k = s[ok], k[ok]
            target = s + t[ok]
            state[target], via[target], back[target] = self.enters[k], k, s

        here, who = begin + length + np.arange(n_words), np.arange(n_words)
        first = begin + np.arange(n_words)
        steps = []
        while len(who):
            steps.append((who, via[here]))
            here = back[here]
            more = here != first[who]
            here, who = here[more], who[more]
        who = np.concatenate([w for w, _ in steps])
        ids = np.concatenate([x for _, x in steps])
        order = np.lexsort((-np.repeat(np.arange(len(steps)), [len(w) for w, _ in steps]), who))
        ids = ids[order].tolist()
        stops = np.cumsum(np.bincount(who, minlength=n_words)).tolist()
        for i, a, b in zip(wanted, [0, *stops], stops, strict=False):
            out[i] = ids[a:b]

    def _read_one(self, word: bytes) -> list[int]:
        """One word, place by place."""
        symbols = self.symbol[self.inner[np.frombuffer(word, np.uint8)]].tolist()
        symbols[-1] = int(self.symbol[self.final[word[-1]]])
        n, width = len(symbols), self.n_symbols
        state, via, back = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        label_of, place, enters = self.label.tolist(), self.place, self.enters
        rows: dict[int, tuple[list[int], list[int]]] = {}
        for at in range(n):
            if state[at] < 0:
                continue
            if state[at] not in rows:
                rows[state[at]] = self._row(state[at])
            lows, highs = rows[state[at]]
            node, to = 0, at
            while to < n:
                node = self.next.get(node * width + symbols[to], -1)
                if node < 0:
                    break
                to += 1
                label = label_of[node]
                if label >= 0:
                    p = int(place[label])
                    i = bisect_right(lows, p) - 1
                    if i < 0 or p >= highs[i]:
                        state[to], via[to], back[to] = int(enters[label]), label, at
        ids, at = [], n
        while at:
            ids.append(via[at])
            at = back[at]
        return ids[::-1]


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


class WordTokenizer:
    """A tokenizer file of the kind: NFC, white space, lower case; words by a
    pattern; byte-level BPE with a mark at the word's end; no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, splits = told["model"], told["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in told["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"] \
                or model["type"] != "BPE" or not model["end_of_word_suffix"] or told["decoder"]:
            raise ValueError(f"not a lower-case word BPE file: {path}")
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(vocabulary, merges, model["end_of_word_suffix"])
        self.pattern = splits[0]["pattern"]["Regex"].replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
        new = unassigned()
        self.exact = "(?V1)" + re.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{new}]]", self.pattern)
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.labels = {i: s for s, i in [*vocabulary.items(), *self.special.items()]}

    def decode(self, ids: list[int]) -> str:
        """The labels of the path, one space between."""
        return " ".join([self.labels[i] for i in ids])


class Encoder:
    """A tokenizer with the words that this task has met so far."""

    def __init__(self, tokenizer: WordTokenizer):
        self.tokenizer = tokenizer
        self.words = Words(tokenizer.pattern)
        self.words.full = regex.compile(tokenizer.exact)
        self.at_special = re.compile("(" + "|".join(map(re.escape, tokenizer.special)) + ")") if tokenizer.special else None
        self.known: dict[str, tuple[int, str, str]] = {}
        self._forget(set())

    def _forget(self, all_but: set[str]) -> None:
        """Drop every word but these and the special tokens."""
        special = {w: (1, str(i), w) for w, i in self.tokenizer.special.items()}
        self.known = special | {w: self.known[w] for w in all_but if w in self.known}
        self.size = sum(len(w) + len(x[1]) + len(x[2]) for w, x in self.known.items())

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text."""
        out = []
        for i, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if i % 2:
                out.append(part)
            elif part:
                if not part.isascii():
                    # lower-cased one character at a time: no special sigma at a word's end
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                out += self.words(part.lower())
        return out

    def learn(self, words: set[str]) -> None:
        """Encode words not met before; all others make room where needed."""
        if len(self.known) + len(words) > CACHE_WORDS or self.size > CACHE_BYTES:
            self._forget(words)
        new = [w for w in words if w not in self.known]
        for w, ids in zip(new, self.tokenizer.automaton.encode([w.encode() for w in new]), strict=True):
            found = len(ids), " ".join(map(str, ids)), self.tokenizer.decode(ids)
            self.known[w] = found
            self.size += len(w) + len(found[1]) + len(found[2])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by one space, decoded text) of each text."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            found = list(map(self.known.__getitem__, words))
            yield sum([x[0] for x in found]), " ".join([x[1] for x in found]), " ".join([x[2] for x in found])


def encode_words(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_tokens, ids (decimal, joined by one
    space) and decoded (the ids' labels, joined by one space).

    The table is compiled on the driver and broadcast; its size is bounded by
    the vocabulary's. Null text is the empty text, with no ids and an empty
    decoded text. Texts and words of any length are read whole, in time linear
    in their length. Strings of special tokens become their ids. Ids may be
    null or repeat; ties do not arise, each row is encoded by itself; other
    columns are ignored, whatever their names. An empty table gives an empty
    result.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(WordTokenizer(tokenizer_file))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(shipped.value)  # and with it the words kept: they go when the task ends
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts, BLOCK_BYTES):
                n, ids, decoded = zip(*own.encode(texts[a:b]), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(decoded, pa.string())], schema.fieldNames())
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
