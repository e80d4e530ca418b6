"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed terms. A randomised SVD of all document passages together with
the benchmark's, both of set energy, gives a latent space; its sketch is summed over all passages in one
pass. Windows of every document are compared with every benchmark passage in that space. What is close is
checked word by word: longest common subsequence with the whole item, and whether the item's last sentence
(its answer) stands there, which accepts looser paraphrases of the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import blob, id_column, map_rows, release, summed, written

#: Latent dimensions, extra sketch columns; words of a block and of a document passage.
RANK, EXTRA, BLOCK, PASSAGE = 64, 8, 8, 32
#: Hash slots; rows that slots the benchmark does not use share; items that one search pass carries, passages that
#: windows are compared with at once. The space and the answer are the same whatever these two are.
SLOTS, SHARED, SEARCH_ITEMS, PRODUCTS = 1 << 20, 4096, 8192, 512
#: Terms handled at once: their rows of the term space then stay in a core's cache.
BATCH = 4_000
#: Share of the sketch's energy that the benchmark's passages have.
BENCHMARK_ENERGY = 0.8
#: Gate of a window: its cosine with a passage, and the share of the passage's latent length it must hold. At the
#: worst place a window lacks two words of a passage; both lie well below what ``COMMON_WITH_ANSWER`` of the rest
#: gives, as the words that are kept may be the lighter ones.
COSINE, COEFFICIENT = 0.35, 0.3
#: Least longest-common-subsequence share of an item; with the answer found; of the answer itself.
COMMON, COMMON_WITH_ANSWER, ANSWER = 0.7, 0.5, 0.8
_FOUND = "doc_id bigint, version bigint, item_id bigint, cosine double, first_word int, n_words int, common double, answered boolean"
_EDGE = b".,;:!?\"'()[]"
_SENTENCE = re.compile(rb"[.!?\n]+")


_IS_SPACE, _IS_EDGE = np.zeros(256, bool), np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_EDGE[list(_EDGE)] = True
#: An odd base and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


class Hasher:
    """Term hashes of many lower-case texts at once.

    The bytes of a block are summed up with powers of a base, modulo 2**64; the difference at a word's ends,
    divided by the power of its start, depends on the word alone.
    """

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, 0), _powers(_UNBASE, 0)

    def words(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, words before each border) of the texts between ``borders`` of ``data``.

        Words end at white space and borders; marks at their ends are dropped if anything else is left.
        """
        n = len(data)
        if n >= len(self.up):
            self.up, self.down = _powers(_BASE, n), _powers(_UNBASE, n)
        full = ~_IS_SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[borders] = True
        before, after = np.r_[False, full[:-1]], np.r_[full[1:], False]
        starts = np.flatnonzero(full & (~before | cut[:-1]))
        ends = np.flatnonzero(full & (~after | cut[1:])) + 1
        # The next byte from the start, and the last one before the end, that is no mark.
        plain = ~_IS_EDGE[data]
        at = np.arange(n)
        ahead = np.minimum.accumulate(np.where(plain, at, n)[::-1])[::-1]
        behind = np.maximum.accumulate(np.where(plain, at, -1))
        first, last = ahead[starts] if n else starts, behind[ends - 1] + 1 if n else ends
        kept = first < ends
        first, last = np.where(kept, first, starts), np.where(kept, last, ends)
        with np.errstate(over="ignore"):
            total = np.r_[np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n])]
            h = (total[last] - total[first]) * self.down[first]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(32)).astype(np.uint32), np.searchsorted(starts, borders)


def terms(texts: list[bytes]) -> list[np.ndarray]:
    """Term hashes of lower-case texts."""
    borders = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    held, at = Hasher().words(np.frombuffer(b"".join(texts), np.uint8), borders)
    return [held[a:b] for a, b in zip(at, at[1:])]


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer row is a run of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def tokens(docs: DataFrame, block: int = 1 << 16) -> DataFrame:
    """(doc_id, version, terms): 32-bit hashes of the lower-case words, marks at their ends dropped.

    Blocks of text that fit into a core's cache are hashed as arrays, from Arrow buffer to Arrow buffer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        try:
            for batch in batches:
                texts = pc.fill_null(batch.column(2), b"")
                sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
                for a, b in _blocks(sizes, block):
                    part = pa.array(texts.slice(a, b - a), pa.binary())
                    borders = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + b - a + 1].astype(np.int64)
                    data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[borders[0] : borders[-1]]
                    held, at = hasher.words(data, borders - borders[0])
                    values = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(held)])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), values], ["doc_id", "version", "terms"])
        finally:
            release()

    low = F.lower(F.col("text").cast("string")).cast("binary").alias("text")
    columns = docs.select(id_column(docs), F.xxhash64(blob()).alias("version"), low)
    return columns.mapInArrow(run, "doc_id bigint, version bigint, terms binary")


@dataclass
class Item:
    item_id: object
    terms: np.ndarray
    answer: np.ndarray
    #: (first word, words) of the passages that are looked for.
    parts: list[tuple[int, int]]


def items(rows) -> list[Item]:
    """From (item_id, lower-case text) rows; items without words are left out."""
    found = []
    for item_id, text in rows:
        raw = (text or "").encode()
        held, *sentences = terms([raw, *[s for s in _SENTENCE.split(raw) if s.strip()]])
        if not len(held):
            continue
        answer = sentences[-1] if len(sentences) > 1 else held[-max(1, len(held) // 3) :]
        n = -(-len(held) // (BLOCK * 8))
        size = -(-len(held) // n)
        found.append(Item(item_id, held, answer, [(a, min(size, len(held) - a)) for a in range(0, len(held), size)]))
    return found


def _slots(values: np.ndarray) -> np.ndarray:
    return values >> np.uint32(12)


class Space:
    """Rows of the term space: one for each slot of the benchmark, the others share."""

    def __init__(self, benchmark: list[Item]):
        used = np.unique(_slots(np.concatenate([item.terms for item in benchmark])))
        self.row = (np.arange(SLOTS) % SHARED).astype(np.int32)
        self.row[used] = SHARED + np.arange(len(used))
        self.size = SHARED + len(used)

    def rows(self, values: np.ndarray) -> np.ndarray:
        return self.row[_slots(values)]


def _batched(rows: Iterator[tuple], most: int = BATCH) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows, all their terms, borders): documents in groups of about ``most`` terms."""
    held, size = [], 0
    for row in rows:
        held.append((*row[:-1], np.frombuffer(row[-1], np.uint32)))
        size += len(held[-1][-1])
        if size >= most:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple]):
    borders = np.r_[0, np.cumsum([len(r[-1]) for r in held])]
    return held, np.concatenate([r[-1] for r in held]), borders


def _starts(borders: np.ndarray, width: int) -> np.ndarray:
    """Starts of consecutive pieces of ``width`` words that never cross a document's border."""
    lengths = np.diff(borders)
    n = -(-lengths // width)
    first = np.repeat(borders[:-1], n)
    return first + width * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def document_frequency(table: DataFrame, space: Space) -> tuple[np.ndarray, int]:
    """Documents that hold each row of the term space, and passages, over all documents."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        counts, passages = np.zeros(space.size, np.int64), 0
        for (raw,) in rows:
            held = np.frombuffer(raw, np.uint32)
            counts[np.unique(space.rows(held))] += 1
            passages += -(-len(held) // PASSAGE)
        yield -1, passages
        yield from ((int(i), int(counts[i])) for i in np.flatnonzero(counts))

    parts = map_rows(table.select("terms"), run, "row int, n bigint")
    counts, passages = np.zeros(space.size), 0
    for row, n in parts.groupBy("row").agg(F.sum("n")).collect():  # one row for each of the term space
        if row < 0:
            passages = n
        else:
            counts[row] = n
    return counts, passages


def _sketch(rows: np.ndarray, starts: np.ndarray, weight: np.ndarray, test: np.ndarray, out: np.ndarray) -> None:
    """Adds A'A * test of unit-length passages to ``out``, but for the terms' weights on both sides:
    ``test`` comes multiplied by them and ``out`` is multiplied at the end."""
    w = weight[rows]
    ends = np.r_[starts[1:], len(rows)]
    length2 = np.maximum(np.add.reduceat(w * w, starts), 1e-9)
    z = np.empty((len(starts), test.shape[1]), np.float32)
    # Some passages, then some terms at a time, so that what is gathered stays in a core's cache.
    step = max(1, BATCH // PASSAGE)
    for at in range(0, len(starts), step):
        some = starts[at : at + step]
        z[at : at + step] = np.add.reduceat(test[rows[some[0] : ends[min(at + step, len(ends)) - 1]]], some - some[0], axis=0)
    z /= length2[:, None]
    passage = np.repeat(np.arange(len(starts)), ends - starts)
    order = np.argsort(rows.astype(np.uint16) if len(out) < 1 << 16 else rows, kind="stable")
    held, passage = rows[order], passage[order]
    border = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    at = 0
    while at < len(border):
        # Whole terms: up to the last border within reach, one at least.
        stop = max(at + 1, int(np.searchsorted(border, border[at] + BATCH)))
        upto = border[stop] if stop < len(border) else len(held)
        some = border[at:stop]
        out[held[some]] += np.add.reduceat(z[passage[some[0] : upto]], some - some[0], axis=0)
        at = stop


def latent_space(table: DataFrame, benchmark: list[Item], space: Space, weight: np.ndarray, passages: int) -> np.ndarray:
    """(term rows x RANK) leading right singular directions, by a one-pass randomised SVD."""
    columns, block = RANK + EXTRA, 512
    test = np.random.default_rng(17).standard_normal((space.size, columns)).astype(np.float32)
    weight32 = weight.astype(np.float32)
    weighted = test * weight32[:, None]

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        out = np.zeros((space.size, columns), np.float32)
        for _, values, borders in _batched(rows, 16 * BATCH):
            starts = _starts(borders, PASSAGE)
            if len(starts):
                _sketch(space.rows(values), starts, weight32, weighted, out)
        for key, at in enumerate(range(0, space.size, block)):
            yield key, out[at : at + block].tobytes()

    sketch = np.zeros((space.size, columns))
    for key, data in summed(map_rows(table.select("terms"), run, "key int, data binary", 16)).collect():
        part = np.frombuffer(data, np.float32).reshape(-1, columns)
        sketch[key * block : key * block + len(part)] = part
    own = np.zeros((space.size, columns), np.float32)
    values = np.concatenate([item.terms for item in benchmark])
    borders = np.r_[0, np.cumsum([len(item.terms) for item in benchmark])]
    _sketch(space.rows(values), borders[:-1], weight32, weighted, own)
    sketch = (1 - BENCHMARK_ENERGY) * sketch / max(1, passages) + BENCHMARK_ENERGY * own / len(benchmark)
    sketch *= weight[:, None]
    core = test.T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > max(values.max(), 1e-30) * 1e-7
    directions, _, _ = np.linalg.svd(sketch @ (vectors[:, kept] / np.sqrt(values[kept])), full_matrices=False)
    return directions[:, :RANK]


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Checker:
    """Decides on (item, place) candidates word by word."""

    def __init__(self, benchmark: list[Item]):
        self.items = benchmark
        self.bags = [Counter(item.terms.tolist()) for item in benchmark]

    def check(self, i: int, part: int, doc: np.ndarray, start: int) -> tuple[int, int, float, bool] | None:
        """(first word, words, common share, answer found) if the item stands about ``start``."""
        item = self.items[i]
        n = len(item.terms)
        slack = n // 4 + 2 * BLOCK
        first = max(0, start - item.parts[part][0] - slack)
        held = doc[first : start - item.parts[part][0] + n + slack]
        bag, words = self.bags[i], held.tolist()
        both = bag.keys() & set(words)
        # No subsequence is longer than what the bags share, and that is no more than the item has of these.
        if sum(map(bag.__getitem__, both)) < COMMON_WITH_ANSWER * n:
            return None
        counts = Counter(words)
        if sum(min(counts[x], bag[x]) for x in both) < COMMON_WITH_ANSWER * n:
            return None
        share = common_length(item.terms, held) / n
        if share < COMMON_WITH_ANSWER:
            return None
        answered = common_length(item.answer, held) >= ANSWER * len(item.answer)
        if share >= (COMMON if n >= BLOCK else 0.9) or answered and n >= 2 * BLOCK:
            return first, len(held), share, answered
        return None


def _search(table: DataFrame, benchmark: list[Item], space: Space, weight: np.ndarray, directions: np.ndarray) -> DataFrame:
    project = (directions * weight[:, None]).astype(np.float32)
    asked = [(i, p) for i, item in enumerate(benchmark) for p in range(len(item.parts))]
    vectors = np.array(
        [project[space.rows(benchmark[i].terms[a : a + n])].sum(0) for i, p in asked for a, n in [benchmark[i].parts[p]]]
    )
    norms = np.linalg.norm(vectors, axis=1)
    project = np.vstack([project, np.zeros((1, project.shape[1]), np.float32)])
    # Longer than the passage by three words at least: of the windows at every block start one lacks two at most.
    lengths = np.array([benchmark[i].parts[p][1] for i, p in asked])
    blocks = -(-(lengths + BLOCK // 2 - 1) // BLOCK)
    groups = []
    for size in np.unique(blocks):
        of_size = np.flatnonzero((blocks == size) & (norms > 1e-6))
        # Passages of like length together: the shortest of them bounds the windows that are compared.
        of_size = of_size[np.argsort(norms[of_size], kind="stable")]
        for own in np.array_split(of_size, -(-len(of_size) // PRODUCTS) or 1):
            if not len(own):
                continue
            groups.append((int(size), own, (vectors[own] / norms[own, None]).T.copy(), norms[own]))
    checker = Checker(benchmark)

    def windows(values: np.ndarray, borders: np.ndarray):
        """(query, start word, cosine) of windows close to a benchmark passage."""
        starts = _starts(borders, BLOCK)
        # Blocks of full length, filled up by a row of zeros, are summed faster than pieces of any length.
        n = np.diff(borders)
        shift = BLOCK * np.r_[0, np.cumsum(-(-n // BLOCK))[:-1]] - borders[:-1]
        placed = np.full(BLOCK * len(starts), space.size, np.int32)
        placed[np.arange(len(values)) + np.repeat(shift, n)] = space.rows(values)
        sums = project[placed].reshape(-1, BLOCK, project.shape[1]).sum(1)
        total = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
        last = np.cumsum(-(-np.diff(borders) // BLOCK))
        owner = np.searchsorted(borders, starts, "right") - 1
        end = last[owner]
        at = np.arange(len(starts))
        for size, own, queries, lengths in groups:
            z = np.subtract(total[np.minimum(at + size, end)], total[:-1], out=np.empty_like(sums), casting="same_kind")
            norm = np.sqrt(np.einsum("ij,ij->i", z, z)) + 1e-6
            # No product exceeds the product of the norms.
            able = norm >= COEFFICIENT * lengths.min()
            here, z, norm = at[able], z[able], norm[able]
            dots = z @ queries
            w, q = np.nonzero(dots >= COEFFICIENT * lengths)
            close = dots[w, q] >= COSINE * norm[w]
            w, q = w[close], q[close]
            yield from zip(own[q].tolist(), starts[here[w]].tolist(), owner[here[w]].tolist(), (dots[w, q] / norm[w]).tolist())

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for held, values, borders in _batched(rows):
            if not len(values):
                continue
            near: dict[tuple[int, int], list] = {}
            for q, start, owner, cosine in windows(values, borders):
                i, part = asked[q]
                near.setdefault((owner, i), []).append((cosine, start - int(borders[owner]), part))
            for (owner, i), places in near.items():
                doc_id, version, doc = held[owner]
                for cosine, start, part in sorted(places, reverse=True):
                    if found := checker.check(i, part, doc, start):
                        yield doc_id, version, benchmark[i].item_id, cosine, *found
                        break

    return map_rows(table, run, _FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it.

    doc_id, version (hash of the text), item_id, cosine, first_word, n_words (of the place compared),
    common (share of the item's words found in order), answered. Null and empty texts and items find
    nothing; rows without doc_id are searched and reported with a null id; repeated documents and items
    are reported each; an empty table on either side gives an empty result. The benchmark is a set of queries
    that the driver holds, four bytes a word.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
    held = items(sorted(rows.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
    if not held:
        return spark.createDataFrame([], _FOUND)
    table = written(tokens(docs), "terms")
    space = Space(held)
    counts, passages = document_frequency(table, space)
    weight = np.log1p(max(1.0, counts.max()) / (counts + 1.0))
    directions = latent_space(table, held, space, weight, passages)
    out = None
    for at in range(0, len(held), SEARCH_ITEMS):
        found = _search(table, held[at : at + SEARCH_ITEMS], space, weight, directions)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    found = contaminated(docs, benchmark).select(F.col("version").alias("__version")).distinct()
    return docs.join(found, F.xxhash64(blob()) == F.col("__version"), "left_anti")
