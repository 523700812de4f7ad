"""Byte-pair encoding and decoding with word-end tokens, by a contiguous rank array.

The vocabulary file (JSON of the ``tokenizers`` library, BPE with ``end_of_word_suffix``) is a
parameter.  A text is cut at special tokens, each part is normalised (NFC, white space, lower
case) and split into words by the file's pattern; a word becomes byte symbols, and adjacent symbols
merge by rank.  For a word, one list holds the parts and a parallel list the ranks of adjacent
pairs: take the leftmost minimum, delete a boundary, refresh the two neighbouring ranks.  That is
quadratic, so words of more than ``LONG_WORD`` bytes use a heap over a linked list, with the
same result.  Words repeat, so each Python worker keeps a bounded cache of encoded words.

Defined cases: null and empty texts have no ids; repeated rows are encoded one by one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.llm.textarrays import slices

LONG_WORD = 200
#: words of at most so many bytes are merged together, so many at a time
TABLE_BYTES, TABLE_ROWS = 32, 4096
#: cached words per worker; the cache is emptied when full
CACHE_WORDS = 500_000
NO_RANK = 1 << 62
# the pattern's white space: Unicode's White_Space property (the language's own \s differs)
WHITE_LATIN = "\\t-\\r \\x85\\xa0"
WHITE = WHITE_LATIN + "\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """Printable stand-in character of each byte: itself if printable Latin-1, else U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Grown:
    """Integers appended one block at a time to an array that doubles when full."""

    def __init__(self) -> None:
        self.data, self.used = np.empty(1024, np.int64), 0

    def extend(self, block: np.ndarray) -> None:
        total = self.used + len(block)
        if total > len(self.data):
            room = np.empty(2 * total, np.int64)
            room[:self.used] = self.data[:self.used]
            self.data = room
        self.data[self.used:total] = block
        self.used = total

    def array(self) -> np.ndarray:
        return self.data[:self.used]


@functools.lru_cache(maxsize=4)
def members(kind: str) -> np.ndarray:
    """Whether each code point has general category ``kind`` in the Unicode tables of the tokenizers
    library (the language's own and other modules' tables are of other Unicode versions)."""
    from tokenizers import Regex, pre_tokenizers

    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    found = np.zeros(sys.maxunicode + 2, bool)
    runs = pre_tokenizers.Split(Regex(f"[^\\p{{{kind}}}]+"), "removed").pre_tokenize_str("".join(map(chr, points)))
    for run, _ in runs:
        found[[ord(c) for c in run]] = True
    return found


@functools.lru_cache(maxsize=4)
def character_class(kind: str, end: int = sys.maxunicode + 1) -> str:
    """Ranges of the characters below ``end`` of a general category, for a regular expression."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], members(kind)[:end], [False]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


@functools.lru_cache(maxsize=1)
def newer_capitals() -> dict[int, str]:
    """Lower case of letters that the library knows and the language's tables don't."""
    from tokenizers import normalizers

    lower = normalizers.Lowercase()
    new = [c for c in map(chr, np.flatnonzero(members("L"))) if unicodedata.category(c) == "Cn"]
    return {ord(c): small for c in new if (small := lower.normalize_str(c)) != c}


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + suffix] for c in chars]
        #: (left id, right id) -> rank; rank -> merged id
        self.ranks = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(model["merges"])}
        self.merged = [vocab[a + b] for a, b in model["merges"]]
        self.base = max(vocab.values()) + 1
        keys = np.array([a * self.base + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        self.merged_ids = np.array(self.merged, np.int64)
        inner, last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        self.symbols = np.stack([inner, last])
        #: rank of two bytes inside a word, and of a word's last two
        self.byte_ranks = np.stack([self.find(np.repeat(inner, 256), np.tile(x, 256)).reshape(256, 256)
                                    for x in (inner, last)])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(max(vocab.values()), *self.special.values()) + 1
        self.tokens = [""] * size
        for text, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = text
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # letters and numbers are tried first: no other alternative begins with one
        first = (r"[\p{L}]+", r"[\p{N}]")
        split = "|".join(sorted(split.split("|"), key=lambda x: x not in first)) if "|".join(first) in split else split
        # letters and numbers as ranges
        self.words, self.latin_words = (
            re.compile(split.replace("\\s", white).replace("\\p{L}", character_class("L", end))
                       .replace("\\p{N}", character_class("N", end)))
            for white, end in ((WHITE, sys.maxunicode + 1), (WHITE_LATIN, 256)))
        capitals = newer_capitals()
        self.newer = re.compile("[" + "".join(map(chr, capitals)) + "]") if capitals else None
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.flat, self.start, self.count = Grown(), Grown(), Grown()
        for s, i in self.special.items():
            self._add([s], np.array([i]), np.array([1]))

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.row.update(zip(words, range(self.count.used, self.count.used + len(words)), strict=True))
        self.start.extend(self.flat.used + np.cumsum(counts) - counts)
        self.count.extend(counts)
        self.flat.extend(ids)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids (NO_RANK where they don't merge)."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def merge_table(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of short words given as bytes; every word merges its lowest rank in each round.

        One row per word holds its parts, another the ranks of adjacent parts.  A round finds each
        row's leftmost minimum, deletes that boundary and refreshes the ranks on both sides; rows
        without a rank left are done.
        """
        n, wide = len(lengths), int(lengths.max(initial=1))
        cols = np.arange(wide)
        inside = cols < lengths[:, None]
        raw = data[np.where(inside, starts[:, None] + cols, 0)]
        ends = (cols == lengths[:, None] - 1).astype(np.int64)
        parts = self.symbols[ends, raw]
        ranks = np.full((n, wide), NO_RANK, np.int64)
        if wide > 1:
            ranks[:, :-1] = np.where(inside[:, 1:], self.byte_ranks[ends[:, 1:], raw[:, :-1], raw[:, 1:]], NO_RANK)
        out = np.zeros((n, wide), np.int64)
        counts = lengths.copy()
        rows, size = np.arange(n), lengths.copy()
        while len(rows):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            done = low == NO_RANK
            if done.any():
                out[rows[done]], counts[rows[done]] = parts[done], size[done]
                rows, size, at, low, parts, ranks = (x[~done] for x in (rows, size, at, low, parts, ranks))
                if not len(rows):
                    break
            every, new = np.arange(len(rows)), self.merged_ids[low]
            parts[:, :-1] = np.where(cols[:-1] > at[:, None], parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(cols[:-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            parts[every, at] = new
            size -= 1
            k = np.flatnonzero(at + 1 < size)
            ranks[k, at[k]] = self.find(new[k], parts[k, at[k] + 1])
            k = np.flatnonzero(at > 0)
            ranks[k, at[k] - 1] = self.find(parts[k, at[k] - 1], new[k])
        return out[cols < counts[:, None]], counts

    def learn(self, words: list[str]) -> None:
        """Encode words and put them in the cache: short ones by table, others one by one."""
        words = sorted(words, key=len)
        raw = [self.lowered(w).encode("utf-8") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        short = lengths <= TABLE_BYTES
        rows = np.flatnonzero(short)
        for some in np.array_split(rows, max(1, -(-len(rows) // TABLE_ROWS))) if len(rows) else ():
            data = np.frombuffer(b"".join(raw[i] for i in some), np.uint8)
            ends = np.cumsum(lengths[some])
            self._add([words[i] for i in some], *self.merge_table(data, ends - lengths[some], lengths[some]))
        for i in np.flatnonzero(~short):
            ids = self.encode_word(words[i])
            self._add([words[i]], np.array(ids), np.array([len(ids)]))

    def merge(self, ids: list[int]) -> list[int]:
        """Merge adjacent parts by rank; ids is changed in place and returned."""
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        find, merged = self.ranks.get, self.merged
        ranks = [find(p, NO_RANK) for p in itertools.pairwise(ids)]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            part = ids[i] = merged[low]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find((part, ids[i + 1]), NO_RANK)
            if i:
                ranks[i - 1] = find((ids[i - 1], part), NO_RANK)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        find, n = self.ranks.get, len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(find(p), i, *p) for i, p in enumerate(itertools.pairwise(ids)) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the parts has merged since
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (hit := find((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (hit, k, ids[k], ids[after[k]]))
        return [x for x in ids if x >= 0]

    def lowered(self, word: str) -> str:
        """A word without the capitals that only the library knows."""
        if word.isascii() or not self.newer or not self.newer.search(word):
            return word
        return word.translate(newer_capitals())

    def encode_word(self, word: str) -> list[int]:
        raw = self.lowered(word).encode("utf-8")
        return self.merge([*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]])

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens; white space only separates them, whatever its kind."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            # composed already, and small character sets match faster
            return self.latin_words.findall(text.lower())
        # one character at a time: no final-sigma rule
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text)."""
        if len(self.row) > CACHE_WORDS:
            self.clear()
        every: list[str] = []
        sizes = []
        for text in texts:
            before = len(every)
            if text:
                if self.cut is not None and "<|" in text:
                    for part in self.cut.split(text):
                        if part in self.special:
                            every.append(part)
                        else:
                            every += self.split(part)
                else:
                    every += self.split(text)
            sizes.append(len(every) - before)
        self.learn(list(set(every).difference(self.row)))
        rows = np.fromiter(map(self.row.__getitem__, every), np.int64, len(every))
        flat, start, count = self.flat.array(), self.start.array(), self.count.array()
        counts = count[rows]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(start[rows] - ends + counts, counts) + np.arange(total)].astype(np.uint32)
        running = np.concatenate([[0], ends])
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return ids, np.diff(running[first])

    def decode(self, ids) -> str:
        """Tokens joined by spaces: the vocabulary has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The worker's encoder for a vocabulary file (read once per worker)."""
    return WordBpe(path)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) per document, whole texts."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = load(path)
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                ids, counts = coder.encode_batch(part.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text beside the ids."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = load(path)
        tokens = np.array(coder.tokens, dtype=object)
        for batch in batches:
            at = 0
            column = batch.column("ids")
            lengths = np.diff(column.offsets.to_numpy())
            total = np.cumsum(lengths)
            while at < batch.num_rows:
                done = total[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(total, done + (1 << 19), side="right")))
                part = batch.slice(at, to - at)
                words = tokens[part.column("ids").flatten().to_numpy()]
                ends = total[at:to] - done
                texts = [" ".join(words[e - n:e]) for e, n in zip(ends, lengths[at:to], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "decoded"])
                at = to

    return encoded.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def op8_report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    out = decode(encode(docs, vocabulary), vocabulary)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
