"""Byte-level BPE encoding and decoding with DuckDB inside each task.

Texts are split into words by the tokenizer's pattern. A word that a Python
worker has not met yet becomes rows (word, position, token), one per byte, in
a DuckDB table. A recursive query joins neighbouring tokens with the merge
table and contracts each word's leftmost pair of minimum rank until no pair
of any word can merge; ordered aggregation then writes the word's ids and,
joined with the vocabulary, the bytes they decode to.

A long word is first cut where no token of the vocabulary that occurs in it
spans the cut: no merge can ever cross there, so the pieces are encoded as
words of their own. That keeps the work on long words in proportion to their
length.

The plan is one map without a shuffle. A task keeps the words it has encoded,
at most ``CACHE_WORDS``, and encodes new ones in bounded batches; it gives
words and database back when it ends, so memory grows neither with the table
nor with the number of tasks a worker has run.
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import re
from collections.abc import Iterator

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_WORDS = 100_000
BATCH_BYTES = 400_000  # of new words in one recursive query
LONG_WORD = 128  # bytes; longer words are cut, and pieces still longer take the query that contracts several pairs a step
BLOCK_BYTES = 4 << 20

# One step: of each word still changing, the leftmost pair of minimum rank is
# found as the least (rank, position, next position); its left token becomes
# the merged one, its right token goes, and the neighbours' pointers follow.
SHORT_WORDS = """
WITH RECURSIVE step(word, pos, tok, npos, ntok, live) AS (
  SELECT word, pos, tok, lead(pos) OVER w, lead(tok) OVER w, true
  FROM bytes_in WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL
  SELECT s.word, s.pos,
         CASE WHEN s.pos = b.pos THEN b.rank ELSE s.tok END,
         CASE WHEN s.pos = b.pos THEN b.after_pos ELSE s.npos END,
         CASE WHEN s.pos = b.pos THEN b.after_tok WHEN s.npos = b.pos THEN b.rank ELSE s.ntok END,
         b.rank IS NOT NULL
  FROM step s LEFT JOIN (
    SELECT a.word, a.pos, a.rank, a.gone, n.npos AS after_pos, n.ntok AS after_tok
    FROM (SELECT word, (least >> 20) & 1048575 AS pos, (least >> 40)::INT AS rank, least & 1048575 AS gone
          FROM (SELECT p.word, min((m.rank::BIGINT << 40) | (p.pos << 20) | p.npos) AS least
                FROM step p JOIN merges m ON m.l = p.tok AND m.r = p.ntok WHERE p.live GROUP BY p.word)) a
    JOIN step n ON n.word = a.word AND n.pos = a.gone) b ON b.word = s.word
  WHERE s.live AND (b.gone IS NULL OR s.pos <> b.gone)
)
SELECT word, pos, tok FROM step WHERE NOT live
"""

# As above for long words, where one contraction a step would take a step for
# every byte. A merged token that starts or ends no token of lower rank can
# not bring forth an earlier merge; then all pairs of that rank are
# contracted in one step, from the left without overlap, as they would be one
# after the other.
LONG_WORDS = """
WITH RECURSIVE step(word, pos, tok, live) AS (
  SELECT word, pos, tok, true FROM bytes_in
  UNION ALL
  SELECT word, pos, CASE WHEN hit THEN best ELSE tok END, best IS NOT NULL
  FROM (
    SELECT *, coalesce(lag(hit) OVER w, false) AS gone FROM (
      SELECT *, coalesce(pair = best AND CASE WHEN safe THEN (row_number() OVER (PARTITION BY word, run, pair = best ORDER BY pos)) % 2 = 1
                                     ELSE pos = first END, false) AS hit FROM (
        SELECT *, min(CASE WHEN pair = best THEN pos END) OVER (PARTITION BY word) AS first,
               place - row_number() OVER (PARTITION BY word, pair = best ORDER BY pos) AS run FROM (
          SELECT p.*, m.rank AS pair, m.safe, min(m.rank) OVER (PARTITION BY word) AS best FROM (
            SELECT word, pos, tok, lead(tok) OVER w AS ntok, row_number() OVER w AS place
            FROM step WHERE live WINDOW w AS (PARTITION BY word ORDER BY pos)) p
          LEFT JOIN merges m ON m.l = p.tok AND m.r = p.ntok)))
    WINDOW w AS (PARTITION BY word ORDER BY pos))
  WHERE NOT gone
)
SELECT word, pos, tok FROM step WHERE NOT live
"""

ENCODED = """
SELECT e.word, string_agg(e.tok::VARCHAR, ' ' ORDER BY e.pos) AS ids,
       string_agg(t.hex, '' ORDER BY e.pos) AS hex
FROM ({}) e JOIN tokens t ON t.id = e.tok GROUP BY e.word
"""

# Letters and digits of the first 256 code points; a text of those only can be
# split by the standard library, which is faster.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGIT = "0-9²³¹¼½¾"


class Words:
    """The words of a text by a tokenizer's pattern."""

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTER}{_DIGIT}]").replace(
            r"\p{L}", f"[{_LETTER}]").replace(r"\p{N}", f"[{_DIGIT}]")
        self.narrow = re.compile(narrow) if r"\p" not in narrow else None
        self.wide = re.compile("[^\x00-\x1b\x20-ÿ]")  # \x1c-\x1f differ as white space

    def __call__(self, text: str) -> list[str]:
        if self.narrow is None or self.wide.search(text):
            return self.full.findall(text)
        return self.narrow.findall(text)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Vocabulary and merge table in DuckDB, and the words met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.words = Words(pattern)
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.db, self.finder, self.vocabulary = None, None, list(ranks)
        ends: dict[int, int] = {}  # lowest rank of a longer token that starts or ends with a token
        merges = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                for part in (left, right):
                    if part is not None:
                        ends[part] = min(ends.get(part, rank), rank)
                if left is not None and right is not None:
                    merges.append((left, right, rank))
        self.one = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        l, r, rank = (pa.array(x, pa.int32()) for x in zip(*merges, strict=True))
        safe = pa.array([ends.get(m[2], 1 << 30) > m[2] for m in merges])
        self.fixed = {"merges": pa.table({"l": l, "r": r, "rank": rank, "safe": safe}),
                      "tokens": pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                                          "hex": pa.array([t.hex() for t in ranks])})}

    def close(self) -> None:
        """Forget the words and give the database's memory back."""
        self.ids.clear()
        self.decoded.clear()
        self.finder = None
        if self.db is not None:
            self.db.close()
            self.db = None
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    def _table(self, name: str, given: pa.Table) -> None:
        self.db.register("given", given)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _pieces(self, word: str) -> list[str]:
        """Parts of a long word, cut between characters where no token that
        occurs in its bytes spans the cut."""
        if self.finder is None:
            self.finder = ahocorasick.Automaton()
            for token in self.vocabulary:
                if len(token) > 1:
                    self.finder.add_word(token.decode("latin-1"), len(token))
            self.finder.make_automaton()
        raw = word.encode()
        spans = np.array([(end + 1 - n, end) for end, n in self.finder.iter(raw.decode("latin-1"))], np.int64).reshape(-1, 2)
        change = np.bincount(spans[:, 0] + 1, minlength=len(raw) + 2)[:len(raw) + 2] \
            - np.bincount(spans[:, 1] + 1, minlength=len(raw) + 2)[:len(raw) + 2]
        free = np.cumsum(change)[1:len(raw)] == 0  # of the cut before byte 1, 2, ...
        starts = (np.frombuffer(raw, np.uint8)[1:] & 0xC0) != 0x80
        cuts = [0, *(np.flatnonzero(free & starts) + 1).tolist(), len(raw)]
        return [raw[a:b].decode() for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode(self, words: list[str], query: str) -> None:
        if self.db is None:
            self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})
            for name, given in self.fixed.items():
                self._table(name, given)
        raw = [w.encode() for w in words]
        length = np.array([len(w) for w in raw])
        word = np.repeat(np.arange(len(raw), dtype=np.int32), length)
        start = np.repeat(np.cumsum(length) - length, length)
        self._table("bytes_in", pa.table({"word": word, "pos": np.arange(len(word)) - start,
                                          "tok": self.one[np.frombuffer(b"".join(raw), np.uint8)]}))
        found = self.db.sql(ENCODED.format(query)).to_arrow_table()
        for i, ids, hexes in zip(*(found.column(c).to_pylist() for c in range(3)), strict=True):
            self.ids[words[i]], self.decoded[words[i]] = ids, bytes.fromhex(hexes)

    def learn(self, words: set[str]) -> None:
        """Encode words not met before; the oldest make room. Pieces of long
        words count as words."""
        over = len(self.ids) + len(words) - CACHE_WORDS
        if over > 0:
            for w in [w for w in self.ids if w not in words][:over]:
                del self.ids[w], self.decoded[w]
        new = sorted(words.difference(self.ids))
        cut = {w: self._pieces(w) for w in new if len(w.encode()) > LONG_WORD}
        new = sorted({*(w for w in new if w not in cut), *(p for parts in cut.values() for p in parts)}.difference(self.ids))
        for query, group in ((SHORT_WORDS, [w for w in new if len(w.encode()) <= LONG_WORD]),
                             (LONG_WORDS, [w for w in new if len(w.encode()) > LONG_WORD])):
            batch, size = [], 0
            for w in group:
                batch.append(w)
                size += len(w)
                if size >= BATCH_BYTES:
                    self._encode(batch, query)
                    batch, size = [], 0
            if batch:
                self._encode(batch, query)
        for w, parts in cut.items():
            ids, decoded = " ".join([self.ids[p] for p in parts]), b"".join([self.decoded[p] for p in parts])
            self.ids[w], self.decoded[w] = ids, decoded

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        """(number of ids, ids joined by one space, their bytes) of each text."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            ids = " ".join(map(self.ids.__getitem__, words))
            yield ids.count(" ") + bool(ids), ids, b"".join(map(self.decoded.__getitem__, words))


_ENCODERS: dict[tuple[str, str], Encoder] = {}  # of this Python worker, by vocabulary and pattern; without words


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_tokens, ids (decimal, joined by one
    space) and decoded (the bytes the ids stand for).

    ``vocabulary`` is the path of a rank file that every machine has. Null
    text is the empty text, with no ids. Ids may be null or repeat; other
    columns are ignored, whatever their names. An empty table gives an empty
    result.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from rivet.llm.bpe import encoder  # the module's own cache, not a shipped copy
        from rivet.llm.secrets import blocks

        own = encoder(vocabulary, pattern)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in blocks(texts, BLOCK_BYTES):
                    n, ids, decoded = zip(*own.encode(texts[a:b]), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                         pa.array(decoded, pa.binary())], schema.fieldNames())
        finally:
            own.close()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
