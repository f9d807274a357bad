"""Repeat removal with a run-length compressed Burrows-Wheeler index.

A byte is removed when a string of ``length`` bytes covering it also starts in
a document with a smaller id.

The texts are written once, in blocks by a hash of the row; every later step
reads its block there, and only what it is told of it travels.

Finding what may repeat. Every window of ``length`` bytes has an anchor, the
leftmost least hash among its 16-byte grams, so equal windows have equal
anchors at equal places, and the same 17 bytes before or after them. A block
sends each bucket the hashes of its anchors with those bytes, sorted and as
gaps; the bucket returns one bit for each, whether another block has it too.
Only around shared anchors are the bytes looked at: a piece is the stretch of
all consecutive windows that have one anchor.

Deciding what repeats. A block sends each of its different pieces once, with
its smallest id there, to the group of the anchor, where equal pieces become
one. Of the different pieces of one anchor, those of smaller ids get a
run-length Burrows-Wheeler transform with a sample at every run's ends, and
those of larger ids are streamed through it from their ends: matching
statistics give, for every place, the length of the longest match and a row
of the index. Where the match is ``length`` bytes or more, the least id of the
rows that share them tells whether a smaller id has the window. Anchors with
very many different contexts (the rim of a hot passage) are split into whole
windows, which meet by their hash instead.

Exact copies of a whole document are settled by digest beforehand.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet.llm.secrets import blocks
from rivet.llm.setsketch import mix
from rivet.llm.text import written, written_by

GRAM = 16
CHUNK_BYTES = 256 << 10  # hashed at once
BLOCK_BYTES = 4 << 20  # of text for each block
BUCKET_BYTES = 32 << 20  # of text for each anchor bucket
GROUP_BYTES = 16 << 20  # of text for each group of pieces
INDEX_BYTES = 1 << 20  # of different pieces for each index
HOT_PIECES = 16384  # different contexts of one anchor beyond which it is split by windows
LOCAL_PIECES = 8  # fewer of them in a block are not counted


# ---- anchors -------------------------------------------------------------

def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of every 16-byte gram."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    x = np.ascontiguousarray(eight).view(np.uint64)[:, 0]
    return mix(x[:-8] * np.uint64(0x9E3779B97F4A7C15) + x[8:])


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, first window, last window, left, right) of the runs
    of windows of one anchor place, in order; together they cover all windows.

    ``left`` and ``right`` hash the anchor's gram with the bytes before and
    after it, so many that every window holds the one or the other whole; 0
    where the text ends before. Equal windows have one of them in common.
    """
    found = [_anchors_of(texts, a, b, length) for a, b in blocks(texts, CHUNK_BYTES) if any(texts[a:b])]
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2, *(np.zeros(0, np.uint64),) * 2)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _anchors_of(texts: list[bytes], a: int, b: int, length: int) -> tuple[np.ndarray, ...]:
    """``anchors`` of some texts, hashed as one; no window crosses their ends."""
    size = np.array([len(t) for t in texts[a:b]])
    ends = np.cumsum(size)
    data = b"".join(texts[a:b])
    # padded, so that each place of the data begins a gram and a window
    h = _grams(np.frombuffer(data + bytes(length + GRAM), np.uint8))
    n, width = len(data), length - GRAM + 1
    least, step = h, 1
    while 2 * step <= width:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    if step < width:
        rest = width - step
        least = np.minimum(least[:len(least) - rest], least[rest:])
    least = least[:n]
    # a run ends where the least hash changes, or where its place leaves the window
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (h[:n - 1] == least[:-1])
    new[(ends - size)[size > 0]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    row = np.searchsorted(ends, first, side="right")
    within = first <= ends[row] - length
    first, last, row = first[within], last[within], row[within]
    last = np.minimum(last, ends[row] - length)
    value = least[first]
    place = np.empty(len(first), np.int64)
    for s in range(0, len(first), 1 << 14):
        some = slice(s, s + (1 << 14))
        place[some] = first[some] + (h[first[some, None] + np.arange(width)] == value[some, None]).argmax(axis=1)
    begin, end = (ends - size)[row], ends[row]
    reach = width // 2
    contexts = []
    for offsets in ([-o for o in range(reach, 0, -GRAM)], [*range(GRAM, reach, GRAM), reach]):
        there = (place + offsets[0] >= begin) & (place + offsets[-1] + GRAM <= end)
        context = value[there]
        for o in offsets:
            context = mix(context * np.uint64(31) + h[place[there] + o])
        contexts.append(np.zeros(len(value), np.uint64))
        contexts[-1][there] = context | np.uint64(1)
    return row + a, value, first - begin, last - begin, contexts[0], contexts[1]


class Block:
    """The rows of one block of documents in order of id and text, and the
    anchors of those that are no copies. Made anew from the same rows it is
    the same, so that other steps can name its rows and contexts by number."""

    def __init__(self, table: pa.Table, copies: pa.Table):
        gone = set(zip(copies.column("n").to_pylist(), copies.column("a").to_pylist(), strict=True))
        rows = zip(*(table.column(c).to_pylist() for c in ("id", "text", "digest")), strict=True)
        rows = sorted((i, t.encode("utf-8", "surrogatepass"), d) for i, t, d in rows)
        self.ids = np.array([i for i, _, _ in rows], np.int64)
        self.texts = [t for _, t, _ in rows]
        self.copy = [(i, d) in gone for i, _, d in rows]

    def find(self, length: int, buckets: int) -> None:
        """Anchors, and their contexts as sorted distinct numbers: the bucket
        of the anchor, then 32 bits of the context."""
        texts = [b"" if c else t for t, c in zip(self.texts, self.copy, strict=True)]
        self.row, self.value, self.first, self.last, left, right = anchors(texts, length)
        bucket = self.value % np.uint64(buckets) << np.uint64(32)
        both, n = np.concatenate((left, right)), len(self.value)
        at = np.flatnonzero(both)
        self.number, where = np.unique(np.concatenate((bucket, bucket))[at] | both[at] >> np.uint64(32), return_inverse=True)
        self.number_of = np.full(2 * n, -1)
        self.number_of[at] = where
        self.pair = mix(left * np.uint64(31) + right)

    def cuts(self) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of the contexts."""
        bucket = (self.number >> np.uint64(32)).astype(np.int64)
        cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
        return [(int(bucket[s]), s, e) for s, e in zip(cut[:-1], cut[1:], strict=True)]

    def varied(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchors that have ``least`` or more different contexts here, and how many."""
        value, where, count = np.unique(self.value, return_inverse=True, return_counts=True)
        often = np.flatnonzero(count[where] >= least)
        pairs = np.unique(np.stack((where[often].astype(np.uint64), self.pair[often])), axis=1)[0].astype(np.int64)
        at, count = np.unique(pairs, return_counts=True)
        return value[at[count >= least]], count[count >= least]

    def shared(self, masks: dict[int, bytes]) -> np.ndarray:
        """Places of the anchors with a context that another document has, in
        another block (``masks`` by bucket) or in this one."""
        known = np.zeros(len(self.number) + 1, bool)
        for bucket, s, e in self.cuts():
            known[s:e] = np.unpackbits(np.frombuffer(masks[bucket], np.uint8), count=e - s)
        there = np.flatnonzero(self.number_of >= 0)
        row, at = np.concatenate((self.row, self.row))[there], self.number_of[there]
        low, high = np.full(len(known), len(self.texts)), np.full(len(known), -1)
        np.minimum.at(low, at, row)
        np.maximum.at(high, at, row)
        known |= low < high
        known[-1] = False
        n = len(self.value)
        return np.flatnonzero(known[self.number_of[:n]] | known[self.number_of[n:]])


def _packed(value: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as their gaps, byte by byte of equal weight."""
    return np.diff(value, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32)[:, 0]
    return np.cumsum(gaps, dtype=np.uint32)


SIDE = "blk long, kind int, n long, a binary, b binary, c binary, d binary"  # what a block is told; kinds:
COPY, MASK, PLACES, ANSWER = range(4)


def _side(kind: int, **columns: list) -> pa.Table:
    n = len(columns["blk"])
    kinds = {"blk": pa.int64(), "n": pa.int64()}
    return pa.table({c: pa.array([kind] * n, pa.int32()) if c == "kind" else pa.array(columns.get(c, [None] * n), kinds.get(c, pa.binary()))
                     for c in ("blk", "kind", "n", "a", "b", "c", "d")})


def _of(side: pa.Table, kind: int) -> pa.Table:
    return side.filter(pc.equal(side.column("kind"), kind))


def _numbers(data: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind)


def shared_contexts(texts: DataFrame, copies: DataFrame, length: int, buckets: int) -> DataFrame:
    """For each block and bucket, one bit for each context of the block in
    order (whether another block has it too), and the bucket's hot anchors."""
    hot_pieces = HOT_PIECES
    least = min(LOCAL_PIECES, hot_pieces)

    def contexts(table: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(table, side)
        block.find(length, buckets)
        cuts = block.cuts()
        value, count = block.varied(least)
        own = (value % np.uint64(buckets)).astype(np.int64)
        return pa.table({
            "bucket": pa.array([b for b, _, _ in cuts], pa.int64()),
            "blk": pa.array([table.column("blk")[0].as_py()] * len(cuts), pa.int64()),
            "contexts": pa.array([_packed(block.number[s:e].astype(np.uint32)) for _, s, e in cuts], pa.binary()),
            "varied": pa.array([value[own == b].tobytes() for b, _, _ in cuts], pa.binary()),
            "counts": pa.array([count[own == b].astype(np.int64).tobytes() for b, _, _ in cuts], pa.binary())})

    def common(table: pa.Table) -> pa.Table:
        own = [_unpacked(x) for x in table.column("contexts").to_pylist()]
        every = np.sort(np.concatenate(own))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        value, at = np.unique(_numbers(table.column("varied").to_pylist(), np.uint64), return_inverse=True)
        count = np.bincount(at, _numbers(table.column("counts").to_pylist(), np.int64), len(value))
        hot = value[count > hot_pieces].tobytes()
        masks = [np.packbits(twice[np.minimum(np.searchsorted(twice, v), len(twice) - 1)] == v if len(twice)
                             else np.zeros(len(v), bool)).tobytes() for v in own]
        return _side(MASK, blk=table.column("blk").to_pylist(), n=table.column("bucket").to_pylist(),
                     a=masks, b=[hot] * len(own))
    rows = texts.groupBy("blk").cogroup(copies.groupBy("blk")).applyInArrow(
        contexts, "bucket long, blk long, contexts binary, varied binary, counts binary")
    return rows.groupBy("bucket").applyInArrow(common, SIDE)


# ---- pieces --------------------------------------------------------------

def piece_rows(texts: DataFrame, side: DataFrame, length: int, buckets: int, groups: int) -> DataFrame:
    """Rows of two kinds. Of a block and a group of anchors: grp, blk, number
    of the first piece, and of the different pieces around shared anchors
    their anchors, least ids, sizes and bytes. Of a block (grp below 0): where
    its pieces lie (row, start, size, number of the piece and whether a
    smaller id of the block has it)."""
    def run(table: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(table, _of(side, COPY))
        block.find(length, buckets)
        told = _of(side, MASK)
        hit = block.shared(dict(zip(told.column("n").to_pylist(), told.column("a").to_pylist(), strict=True)))
        hot = set(_numbers(told.column("b").to_pylist(), np.uint64).tolist())
        known: dict[bytes, int] = {}
        key, least, rows, starts, sizes, numbers = [], [], [], [], [], []
        for r, v, s, e in zip(*(c[hit].tolist() for c in (block.row, block.value, block.first, block.last)), strict=True):
            parts = [(w, w + length) for w in range(s, e + 1)] if v in hot else [(s, e + length)]
            for a, b in parts:
                piece = block.texts[r][a:b]
                k = known.setdefault(piece, len(known))
                if k == len(key):
                    key.append(int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest()) if v in hot else v)
                    least.append(r)
                rows.append(r)
                starts.append(a)
                sizes.append(b - a)
                numbers.append(k)
        pieces, key = list(known), np.array(key, np.uint64)
        ids, least = block.ids, np.array(least, np.int64)
        group = (key % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        heads = np.flatnonzero(np.diff(group[order], prepend=-1)).tolist()
        spans = list(zip(heads, [*heads[1:], len(order)], strict=True)) if heads else []
        size = np.array([len(p) for p in pieces], np.int32)
        rows, k = np.array(rows, np.int64), np.array(numbers, np.int64)
        later = ids[rows] > ids[least[k]]
        blk = table.column("blk")[0].as_py()
        m = len(spans) + 1
        return pa.table({
            "grp": pa.array([int(group[order[s]]) for s, _ in spans] + [-1 - blk], pa.int64()),
            "blk": pa.array([blk] * m, pa.int64()),
            "base": pa.array([s for s, _ in spans] + [None], pa.int64()),
            "a": pa.array([key[order[s:e]].tobytes() for s, e in spans] + [rows.astype(np.uint32).tobytes()], pa.binary()),
            "b": pa.array([ids[least[order[s:e]]].tobytes() for s, e in spans] + [np.array(starts, np.uint32).tobytes()], pa.binary()),
            "c": pa.array([size[order[s:e]].tobytes() for s, e in spans] + [np.array(sizes, np.uint32).tobytes()], pa.binary()),
            "d": pa.array([b"".join([pieces[i] for i in order[s:e].tolist()]) for s, e in spans]
                          + [(number[k] * 2 + later).astype(np.uint32).tobytes()], pa.binary())})
    return texts.groupBy("blk").cogroup(side.groupBy("blk")).applyInArrow(
        run, "grp long, blk long, base long, a binary, b binary, c binary, d binary")


# ---- the index -----------------------------------------------------------

class RunIndex:
    """Run-length Burrows-Wheeler transform of a set of strings.

    Rows are the suffixes in order, each string ended by its own terminator.
    Kept are the runs of equal preceding bytes (head row, byte, rank of the
    byte before it) and, for each run, the text places of its first and last
    row. With ``ids`` of the strings, also the least id of each stretch of
    rows that share ``length`` bytes.
    """

    def __init__(self, strings: list[bytes], length: int, ids: np.ndarray | None = None):
        self.length = length
        size = np.array([len(s) for s in strings])
        ends = np.cumsum(size + 1) - 1
        self.text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int64) + 1
        self.text[ends] = 0  # symbols: bytes plus one, 0 ends a string
        stop = np.repeat(ends, size + 1)  # the terminator after each place
        n = len(self.text)
        place = np.arange(n)
        # prefix doubling from the first few symbols; a suffix ends with its string
        def ranks(key: np.ndarray) -> np.ndarray:
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
            return rank

        half, window = min(6, length), None
        key = np.zeros(n, np.int64)
        for j in range(half):
            at = np.minimum(place + j, n - 1)
            key = key << 9 | np.where(place + j <= stop, self.text[at], 0)
        rank = ranks(key)
        while True:
            if half * 2 > length and window is None:
                # two overlapping halves tell windows of exactly ``length`` bytes apart
                window = rank * (n + 1) + rank[np.minimum(place + length - half, n - 1)]
            if half > size.max():
                break
            far = np.minimum(place + half, n - 1)
            rank = ranks(rank * (n + 1) + np.where(place + half <= stop, rank[far] + 1, 0))
            half *= 2
        # suffixes alike to their end: in order of their strings
        rank = ranks(rank * (len(strings) + 1) + np.repeat(np.arange(len(strings)), size + 1))
        sa = np.empty(n, np.int64)
        sa[rank] = place
        rows = np.where(place + length <= stop, window, -1)[sa]
        self.stretch = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        if ids is not None:
            self.least = np.minimum.reduceat(np.repeat(ids, size + 1)[sa], self.stretch)
        before = np.where(sa > 0, self.text[sa - 1], 0)
        head = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.n, self.head, self.byte = n, head, before[head]
        tail = np.append(head[1:], n)
        self.run_of = np.repeat(np.arange(len(head), dtype=np.int32), tail - head)
        self.first, self.last = sa[head], sa[tail - 1]  # the sampled run ends
        # runs by byte, in order: rank before each run and where a byte's runs begin
        self.order = np.argsort(self.byte, kind="stable")
        by = self.byte[self.order]
        length_ = (tail - head)[self.order]
        self.by_start = np.searchsorted(by, np.arange(258))
        total = np.cumsum(length_) - length_
        self.to_row = np.empty(len(head), np.int64)  # LF of a run's first row
        self.to_row[self.order] = total
        self.key = by * n + head[self.order]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of two text places each, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        k = 0
        while len(live):
            live = live[k < most[live]]
            i, j = a[live] + k, b[live] + k
            ok = (i < self.n) & (j < self.n)
            ok[ok] = (self.text[i[ok]] == self.text[j[ok]]) & (self.text[i[ok]] > 0)
            live = live[ok]
            out[live] += 1
            k += 1
        return out

    def matching_statistics(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(row, length) for every place of the joined patterns: the longest
        match of the pattern from there, and a row whose suffix starts with it.

        All patterns are streamed at once, from their ends. A step goes to
        the row of the preceding byte; where the row's run has another byte,
        to the nearest run end of that byte above or below, whichever sample
        agrees with the match so far on more bytes.
        """
        size = np.array([len(p) for p in patterns])
        at = np.cumsum(size) - size
        text = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64) + 1
        rows, lengths = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        row = np.zeros(len(patterns), np.int64)
        length = np.zeros(len(patterns), np.int64)
        sample = np.full(len(patterns), self.first[0])  # text place of the row
        order = np.argsort(-size, kind="stable")
        for back in range(1, (size.max() if len(size) else 0) + 1):
            live = order[:np.searchsorted(-size[order], -back, side="right")]
            c = text[at[live] + size[live] - back]
            r, s, k = row[live], sample[live], length[live]
            run = self.run_of[r].astype(np.int64)
            hit = self.byte[run] == c
            if not hit.all():
                miss = np.flatnonzero(~hit)
                cm, rm = c[miss], r[miss]
                # the byte's runs in order; the next one below the row, and the one above
                low, high = self.by_start[cm], self.by_start[cm + 1]
                down = self._next(cm, rm)
                up = down - 1
                has_down, has_up = down < high, up >= low
                d_run = self.order[np.minimum(down, len(self.order) - 1)]
                u_run = self.order[np.maximum(up, 0)]
                d_len = np.where(has_down, self.common(self.first[d_run], s[miss], np.where(has_down, k[miss], 0)), -1)
                u_len = np.where(has_up, self.common(self.last[u_run], s[miss], np.where(has_up, k[miss], 0)), -1)
                below = d_len >= u_len
                none = ~has_down & ~has_up
                r[miss] = np.where(below, self.head[d_run], self._tails(u_run))
                s[miss] = np.where(below, self.first[d_run], self.last[u_run])
                k[miss] = np.maximum(np.maximum(d_len, u_len), 0)
                run[miss] = np.where(below, d_run, u_run)
                absent = miss[none]
            else:
                absent = np.zeros(0, np.int64)
            r = self.to_row[run] + (r - self.head[run])
            s, k = s - 1, k + 1
            r[absent], s[absent], k[absent] = 0, self.first[0], 0
            row[live], sample[live], length[live] = r, s, k
            rows[at[live] + size[live] - back] = r
            lengths[at[live] + size[live] - back] = k
        return rows, lengths

    def _tails(self, run: np.ndarray) -> np.ndarray:
        return np.append(self.head[1:], self.n)[run] - 1

    def _next(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Place in ``order`` of the byte's first run that starts after the row."""
        return np.searchsorted(self.key, c * self.n + row, side="right")

    def least_id(self, row: np.ndarray) -> np.ndarray:
        """Least id of the strings that have the ``length`` bytes at these rows."""
        return self.least[np.searchsorted(self.stretch, row, side="right") - 1]


def earlier_windows(pieces: list[bytes], key: np.ndarray, ids: np.ndarray, length: int,
                    index_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, place) of the windows that a piece of the same key and a
    smaller id has too, in order.

    The pieces of one key that are not of its largest id are indexed, those
    not of its smallest id are streamed; a match of ``length`` bytes finds the
    smallest id. An index holds whole keys, of about ``index_bytes``; a window
    that only a piece of another key in it has counts as well.
    """
    order = np.lexsort((ids, key))
    head = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, np.int64)
    tail = np.append(head[1:], len(order)) - 1
    of = np.repeat(np.arange(len(head)), tail - head + 1)
    low, high = ids[order[head]][of], ids[order[tail]][of]
    use = np.flatnonzero(low < high)
    order, of, low, high = order[use], of[use], low[use], high[use]
    size = np.array([len(pieces[i]) for i in order.tolist()], np.int64)
    begin = np.cumsum(size) - size
    new = np.append(True, of[1:] != of[:-1])[:len(of)]
    begin = np.maximum.accumulate(np.where(new, begin, 0))
    cut = np.flatnonzero(np.diff(begin // index_bytes, prepend=-1)).tolist()
    found = [(np.zeros(0, np.int64),) * 2]
    for s, e in zip(cut, [*cut[1:], len(order)], strict=True) if cut else []:
        some, own = order[s:e], ids[order[s:e]]
        indexed, streamed = some[own < high[s:e]], some[own > low[s:e]]
        index = RunIndex([pieces[i] for i in indexed.tolist()], length, ids[indexed])
        texts = [pieces[i] for i in streamed.tolist()]
        rows, lengths = index.matching_statistics(texts)
        size = np.array([len(t) for t in texts])
        hit = np.flatnonzero(lengths >= length)
        piece = np.repeat(np.arange(len(texts)), size)[hit]
        early = index.least_id(rows[hit]) < ids[streamed][piece]
        hit, piece = hit[early], piece[early]
        found.append((streamed[piece], hit - (np.cumsum(size) - size)[piece]))
    piece, place = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(piece, kind="stable")
    return piece[order], place[order]


# ---- the operator --------------------------------------------------------

def _runs(count: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of ``count`` places each, joined."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)


def answers(rows: DataFrame, length: int) -> DataFrame:
    """What each block is told of its pieces: their places, the numbers of
    those that a smaller id has whole, and (piece, place) of single windows."""
    index_bytes = INDEX_BYTES

    def run(table: pa.Table) -> pa.Table:
        blk = table.column("blk").to_pylist()
        a, b, c, d = (table.column(x).to_pylist() for x in "abcd")
        if table.column("grp")[0].as_py() < 0:
            return _side(PLACES, blk=blk, a=a, b=b, c=c, d=d)
        key, ids, size = _numbers(a, np.uint64), _numbers(b, np.int64), _numbers(c, np.int32)
        known: dict[bytes, int] = {}
        text, ends = b"".join(d), np.cumsum(size, dtype=np.int64)
        at = np.array([known.setdefault(text[e - n:e], len(known)) for e, n in zip(ends.tolist(), size.tolist(), strict=True)], np.int64)
        first = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(first, at, ids)
        own = np.zeros(len(known), np.uint64)
        own[at] = key
        piece, place = earlier_windows(list(known), own, first, length, index_bytes)
        count = np.bincount(piece, minlength=len(known))
        begin = np.cumsum(count) - count
        whole, k, places = [], [], []
        s = 0
        for base, n in zip(table.column("base").to_pylist(), [len(x) // 4 for x in c], strict=True):
            mine, later = at[s:s + n], ids[s:s + n] > first[at[s:s + n]]
            whole.append((base + np.flatnonzero(later)).astype(np.uint32).tobytes())
            some = np.flatnonzero(~later & (count[mine] > 0))
            k.append(np.repeat(base + some, count[mine[some]]).astype(np.uint32).tobytes())
            places.append(place[_runs(count[mine[some]], begin[mine[some]])].astype(np.uint32).tobytes())
            s += n
        return _side(ANSWER, blk=blk, a=whole, b=k, c=places)
    return rows.groupBy("grp").applyInArrow(run, SIDE)


def _removed(block: Block, side: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the removed runs in the texts joined with one byte after
    each, and where each text begins there."""
    size = np.array([len(t) for t in block.texts])
    offset = np.cumsum(size + 1) - size - 1
    places, told = _of(side, PLACES), _of(side, ANSWER)
    row, start, length_, number = (_numbers(places.column(c).to_pylist(), np.uint32).astype(np.int64) for c in "abcd")
    whole, k, place = (_numbers(told.column(c).to_pylist(), np.uint32).astype(np.int64) for c in "abc")
    number, later = number >> 1, number & 1 > 0
    start = start + offset[row]
    all_of = later | np.isin(number, whole)
    order = np.argsort(k, kind="stable")
    k, place = k[order], place[order]
    low = np.searchsorted(k, number)
    count = np.where(all_of, 0, np.searchsorted(k, number, side="right") - low)
    single = np.repeat(start, count) + place[_runs(count, low)]
    copies = np.flatnonzero(block.copy)
    begin = np.concatenate((start[all_of], single, offset[copies]))
    end = np.concatenate(((start + length_)[all_of], single + length, offset[copies] + size[copies]))
    covered = np.cumsum(np.bincount(begin, minlength=size.sum() + len(size) + 1)
                        - np.bincount(end, minlength=size.sum() + len(size) + 1)) > 0
    edge = np.flatnonzero(np.diff(covered, prepend=False))
    return edge.reshape(-1, 2), offset


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 50) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, removed, kept_sha256.

    ``removed`` holds the maximal runs (start, end) of bytes of the UTF-8
    text that a string of ``length`` bytes covers which also starts in a row
    with a smaller id (an integer). kept_sha256 is the digest of the other
    bytes. Null text is the empty text. Rows with a null id have no place in
    the order: they lose nothing and count nowhere. Rows that repeat an id do
    not count against each other. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    total = own.filter("id is not null").agg(F.sum("n_bytes")).first()[0] or 0
    blocks_, buckets = max(1, -(-total // BLOCK_BYTES)), max(1, -(-total // BUCKET_BYTES))
    groups = max(1, -(-total // GROUP_BYTES))
    placed = own.filter("id is not null").withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = written_by(placed.withColumn("blk", F.pmod(F.xxhash64("id", "digest"), F.lit(blocks_))),
                       "repeat-texts", "blk", -(-blocks_ // 2))

    long = texts.filter(F.col("n_bytes") >= length).select("blk", "id", "digest")
    firsts = (long.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .filter("first < last").select("digest", "first"))
    copies = written(long.join(firsts, "digest").filter(F.col("id") > F.col("first")).select(
        "blk", F.lit(COPY).alias("kind"), F.col("id").alias("n"), F.col("digest").alias("a"),
        *[F.lit(None).cast("binary").alias(c) for c in "bcd"]), "repeat-copies")

    masks = shared_contexts(texts, copies, length, buckets)
    told = answers(piece_rows(texts, copies.unionByName(masks), length, buckets, groups), length)

    def cut(table: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(table, _of(side, COPY))
        runs, offset = _removed(block, side, length)
        row = np.searchsorted(offset, runs[:, 0], side="right") - 1
        runs = (runs - offset[row][:, None]).tolist()
        ends = np.cumsum(np.bincount(row, minlength=len(offset))).tolist()
        spans, digests, s = [], [], 0
        for text, e in zip(block.texts, ends, strict=True):
            kept, last = hashlib.sha256(), 0
            for a, b in runs[s:e]:
                kept.update(text[last:a])
                last = b
            kept.update(text[last:])
            spans.append([{"start": a, "end": b} for a, b in runs[s:e]])
            digests.append(kept.hexdigest())
            s = e
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array([len(t) for t in block.texts], pa.int64()),
                         "removed": pa.array(spans, kind), "kept_sha256": pa.array(digests, pa.string())})
    out = texts.groupBy("blk").cogroup(copies.unionByName(told).groupBy("blk")).applyInArrow(
        cut, "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string")
    loose = own.filter("id is null").select(
        "id", "n_bytes", F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return out.unionByName(loose).withColumnRenamed("id", id_col)
