"""Best-fit packing of token sequences by exact-complement hashing.

The plan works on the counts of pieces by length, at most ``capacity`` numbers at any scale. A sequence
starts with the longest piece; lookups of single, pair and triple length sums find pieces that fill its
gap exactly; without any the longest fitting piece goes in and the search goes on. A pattern is used as
often as its lengths are available. Pieces then find their place from their rank among equal lengths.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import blob, id_column, in_groups, map_rows, written

CAPACITY, END_ID = 4096, 1
TOKENIZER = "word_bpe_49k.json"
#: Marks that follow letters as one unit of the tokenizer.
_MARKS = b".,;:!?\")]}*#$%&|-_/+=~"
#: Rows of equal length that one task ranks.
RANK_ROWS = 50_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str, as_text: bool):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = as_text
    return tokenizer


class Encoder:
    """Token ids, as little-endian bytes, of words between ASCII white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words.
    Words not met before are encoded together: plain letters of Latin-1, which lower one by one and are
    one unit each, in one text, other words alone. Special tokens written in a text, which hold no white
    space, are letters and marks like any other if ``as_text``, else their own ids.
    """

    def __init__(self, path: str, limit: int = 300_000, as_text: bool = True):
        self.tokenizer = _tokenizer(path, as_text)
        self.limit = limit
        # Two generations each: what is met again outlives the change.
        self.words: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.old_cores: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}

    def alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Encodes what is missing of ``words``."""
        if len(self.words) > self.limit:
            self.words, self.old_words = {}, self.words
        if len(self.cores) > self.limit:
            self.cores, self.old_cores = {}, self.cores
        if len(self.marks) > self.limit:
            self.marks = {}
        missing = words - self.words.keys()
        known = missing & self.old_words.keys()
        self.words.update((w, self.old_words[w]) for w in known)
        missing -= known
        # Plain words by their letters and marks; flat lists, as a list of many tuples is slow to free.
        plain: list[bytes] = []
        cores: list[bytes] = []
        ends: list[bytes] = []
        for raw in missing:
            core = raw.rstrip(_MARKS)
            if core.isalpha():  # of bytes: ASCII letters alone
                low = core.lower()
            else:
                text = core.decode()
                if not text.isalpha() or max(text) >= "\u0100":
                    self.words[raw] = self.alone(raw.decode())
                    continue
                low = text.lower().encode()
            plain.append(raw)
            cores.append(low)
            ends.append(raw[len(core) :])
        wanted = set(cores) - self.cores.keys()
        known_cores = wanted & self.old_cores.keys()
        self.cores.update((c, self.old_cores[c]) for c in known_cores)
        self._together(list(wanted - known_cores))
        for mark in set(ends) - self.marks.keys():
            self.marks[mark] = self.alone(mark.decode())
        letters, marks, words = self.cores, self.marks, self.words
        for raw, core, mark in zip(plain, cores, ends):
            words[raw] = letters[core] + marks[mark] if mark else letters[core]

    def _together(self, cores: list[bytes]) -> None:
        for at in range(0, len(cores), 1000):
            some = cores[at : at + 1000]
            found = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
            unit = np.array(found.word_ids)
            ids = np.array(found.ids, "<u4").tobytes()
            border = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]).tolist()
            if len(border) != len(some):
                raise ValueError("a plain word is more than one unit to the tokenizer")
            for core, a, b in zip(some, border, [*border[1:], len(unit)]):
                self.cores[core] = ids[4 * a : 4 * b]

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        split = [(text or b"").split() for text in texts]
        # Many small objects and no cycles: the cycle collector would only walk the caches.
        gc.disable()
        try:
            self.learn(set().union(*split))
        finally:
            gc.enable()
        for words in split:
            yield b"".join(map(self.words.__getitem__, words))


def token_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; a null text is empty."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        # Of this task alone: a worker kept for other work holds no words.
        encoder = Encoder(path or tokenizer_path(), as_text=False)
        end = np.array([end_id], "<u4").tobytes()
        for held in in_groups(rows):
            for (doc_id, _), ids in zip(held, encoder.encode([text for _, text in held])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)
                    yield (*row, part) if with_ids else row

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_rows(docs.select(id_column(docs), blob()), run, schema, 256 if with_ids else 4096)


class _Counts:
    """Pieces left by length, with lookups of what sums exactly to a gap."""

    def __init__(self, counts: np.ndarray):
        self.n = counts.astype(np.int64)
        self._sums: np.ndarray | None = None

    def largest(self, most: int) -> int:
        held = np.flatnonzero(self.n[: most + 1])
        return int(held[-1]) if len(held) else 0

    def change(self, length: int, by: int) -> None:
        before = self.n[length] > 0
        self.n[length] += by
        if before != (self.n[length] > 0):
            self._sums = None

    def pair(self, gap: int) -> tuple[int, ...]:
        small = np.arange(1, gap // 2 + 1)
        fits = (self.n[small] > 0) & (self.n[gap - small] > 0)
        if gap % 2 == 0 and gap and self.n[gap // 2] < 2:
            fits[-1] = False
        found = np.flatnonzero(fits)
        return (int(gap - small[found[-1]]), int(small[found[-1]])) if len(found) else ()

    def triple(self, gap: int) -> tuple[int, ...]:
        if self._sums is None:  # lengths that two held lengths sum to
            size = 2 * len(self.n)
            spectrum = np.fft.rfft((self.n > 0).astype(float), size)
            self._sums = np.fft.irfft(spectrum * spectrum, size)[: len(self.n)] > 0.5
        held = np.flatnonzero(self.n[: gap + 1])
        for length in held[self._sums[gap - held]][::-1]:
            self.n[length] -= 1
            rest = self.pair(gap - int(length))
            self.n[length] += 1
            if rest:
                return (int(length), *rest)
        return ()

    def complement(self, gap: int) -> tuple[int, ...]:
        if gap < len(self.n) and self.n[gap] > 0:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: pieces of it in a sequence}, sequences) that use every piece once.

    ``counts[l]`` is the number of pieces of length l. Each pattern uses up one length at least.
    """
    left, patterns = _Counts(counts), []
    while longest := left.largest(capacity):
        pattern: dict[int, int] = {}
        gap = capacity

        def take(length: int) -> None:
            pattern[length] = pattern.get(length, 0) + 1
            left.change(length, -1)

        take(longest)
        gap -= longest
        while gap:
            exact = left.complement(gap)
            for length in exact:
                take(length)
            if exact:
                break
            best = left.largest(gap)
            if not best:
                break
            take(best)
            gap -= best
        times = 1 + min(int(left.n[length]) // n for length, n in pattern.items())
        for length, n in pattern.items():
            left.change(length, -n * (times - 1))
        patterns.append((pattern, times))
    return patterns


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, pieces in a sequence, offset)."""
    rank: dict[int, int] = {}
    slots: dict[int, list] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length, n in pattern.items():
            slots.setdefault(length, []).append((rank.get(length, 0), sequence, n, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 among pieces of equal length. A hot length is ranked in blocks."""
    blocks = max(1, -(-pieces.count() // RANK_ROWS))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "block").agg(F.count("*").alias("n"))
    firsts = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("place", F.row_number().over(own))
        .join(firsts, ["length", "block"])
        .withColumn("rank", F.col("first") + F.col("place") - 1)
        .drop("block", "first", "place")
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Only documents longer than ``capacity`` are cut. Null texts are empty and hold the end token alone;
    null ids and repeated rows are packed like any other row; an empty table gives an empty result.
    """
    pieces = written(token_pieces(docs, path, capacity, end_id), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    slots = _slots(plan(counts, capacity))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, piece, start, length, crc, rank in rows:
            table = slots[length]
            first, sequence, n, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1].tolist()
            at = rank - first
            yield doc_id, piece, start, length, crc, sequence + at // n, offset + at % n * length

    columns = ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return map_rows(
        columns, run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
