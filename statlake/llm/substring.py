"""Repeated passages by prefix-partitioned suffix trees over words.

Only suffixes that start at content-chosen words are kept: of every window of ``width`` words the least
hash of ``GRAM`` consecutive words in it names its anchor, so two equal windows have equal anchors. The
anchors that two documents share are live; each sends its suffix and the words before it to a group. A
group is a prefix of the suffix of one, three or ``GRAM`` words, as long as it takes to fit into memory.
In a group, suffixes and reversed left contexts are sorted; runs of common prefixes (the internal nodes of
their trees) of 50 words together are the repeats, compared word by word. An anchor too frequent for any
prefix is dealt over several tasks, which exchange digests of its windows instead.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import WordCache, blob, id_column, map_rows, shuffle_width, written

WIDTH, GRAM = 50, 10
#: Suffixes that one task holds at a time.
GROUP_ROWS = 20_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPANS = "array<struct<start:int,stop:int>>"


def _hashes(words: list[bytes], cache: WordCache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def _word_cache() -> WordCache:
    return WordCache(lambda word: xxhash.xxh64_intdigest(word, 7))


def anchors(words: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(position, first window, last window, hash) arrays of the anchors of one document's word hashes."""
    none = np.zeros(0, np.int64)
    if len(words) < width:
        return none, none, none, np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - gram + 1, np.uint64)
        for j in range(gram):
            h = h * _MULTIPLIER + words[j : len(words) - gram + 1 + j]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    choices = width - gram + 1
    at, span = np.arange(len(h)), 1

    def lesser(a, b):
        return np.where(h[b] < h[a], b, a)

    while 2 * span <= choices:
        at = lesser(at[: len(at) - span], at[span:])
        span *= 2
    if span < choices:
        at = lesser(at[: len(at) - (choices - span)], at[choices - span :])
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    position = at[starts]
    return position, starts, np.r_[starts[1:], len(at)] - 1, h[position]


def _signed(values: np.ndarray) -> list[int]:
    return values.astype(np.uint64).view(np.int64).tolist()


def _anchor_rows(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """One row per document with windows: key and arrays over its anchors."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        cache = _word_cache()
        for doc_id, version, text in rows:
            words = _hashes((text or b"").split(), cache)
            position, first, last, h = anchors(words, width, gram)
            if not len(position):
                continue
            one = words[position]
            three = one ^ (words[position + 1] * _MULTIPLIER) ^ (words[position + 2] << np.uint64(17))
            yield doc_id, version, position.tolist(), first.tolist(), last.tolist(), _signed(h), _signed(one >> np.uint64(33)), _signed(three >> np.uint64(33))

    schema = (
        "doc_id bigint, version bigint, position array<int>, first array<int>, last array<int>, "
        "hash array<bigint>, one array<int>, three array<int>"
    )
    return map_rows(docs, run, schema, 512)


def _groups(each: DataFrame, group_rows: int) -> DataFrame:
    """(hash, key, shards): the group of each live anchor."""
    live = written(
        each.groupBy("hash")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), F.max("one").alias("one"), F.max("three").alias("three"))
        .filter("low < high"),
        "live-anchors",
    )
    ones = live.groupBy("one").agg(F.sum("n").alias("n1"))
    threes = live.groupBy("one", "three").agg(F.sum("n").alias("n3"))
    sized = live.join(ones, "one").join(threes, ["one", "three"])
    key = (
        F.when(F.col("n1") <= group_rows, F.xxhash64(F.lit(1), "one"))
        .when(F.col("n3") <= group_rows, F.xxhash64(F.lit(3), "one", "three"))
        .otherwise(F.xxhash64(F.lit(10), "hash"))
    )
    shards = F.ceil(F.col("n") / group_rows).cast("int")
    return sized.select("hash", key.alias("key"), shards.alias("shards"))


def _suffixes(docs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """(key, shards, doc_id, version, first, offset, words): live suffixes with their left context.

    ``words`` are those of all windows of the anchor, ``offset`` is the anchor's place in them.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, version, text, live in rows:
            words = (text or b"").split()
            for one in live:
                first, last = one["first"], one["last"]
                yield one["key"], one["shards"], doc_id, version, first, one["position"] - first, b" ".join(words[first : last + width])

    schema = "key bigint, shards int, doc_id bigint, version bigint, first int, offset int, words binary"
    return map_rows(docs.join(found, ["doc_id", "version"]), run, schema, 2048)


def _ranks(table: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows and how many leading words each shares with the row before it.

    Sorting by the first words settles most rows; ``skip`` marks the groups' borders, never shared.
    """
    order = np.lexsort((*table.T[::-1], skip))
    held = table[order]
    same = held[1:] == held[:-1]
    common = np.where(same.all(1), table.shape[1], same.argmin(1))
    common[skip[order][1:] != skip[order][:-1]] = -1
    return order, np.r_[-1, common]


def repeated_windows(rows: list[tuple], width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """(row, first windows) of windows that also start in a document of smaller id in ``rows``.

    ``rows`` has key, doc_id, offset and words of suffixes; different keys never match.
    """
    n = len(rows)
    ids: dict[bytes, int] = {}
    flat: list[int] = []
    starts = np.zeros(n + 1, np.int64)
    for i, (_, _, _, words) in enumerate(rows):
        flat.extend([ids.setdefault(w, len(ids)) for w in words.split(b" ")])
        starts[i + 1] = len(flat)
    data = np.array(flat, np.int32)
    docs = np.array([r[1] for r in rows], np.int64)
    offset = np.array([r[2] for r in rows], np.int64)
    windows = starts[1:] - starts[:-1] - width + 1
    _, group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    anchor = starts[:-1] + offset

    def table(at: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return np.where(inside, data[np.clip(at, 0, len(data) - 1)], -1)

    reach = np.arange(width)
    right = anchor[:, None] + reach
    right = table(right, right < starts[1:, None])
    back = np.arange(1, width)
    left = anchor[:, None] - back
    left = table(left, left >= starts[:-1, None])
    (right_order, right_common), (left_order, left_common) = _ranks(right, group), _ranks(left, group)
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    right_node, left_node = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(int(offset.max()) + 1 if n else 0):
        held = np.flatnonzero((offset >= o) & (offset - o < windows))
        if len(held) < 2:
            continue
        right_node[right_order] = np.cumsum(right_common < width - o)
        left_node[left_order] = np.cumsum(left_common < o)
        node = right_node[held] * (n + 1) + left_node[held]
        order = np.argsort(node, kind="stable")
        border = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])
        least = np.minimum.reduceat(docs[held][order], border)
        least = np.repeat(least, np.diff(np.r_[border, len(held)]))
        later = order[docs[held][order] > least]
        if len(later):
            hits.append((held[later], offset[held[later]] - o))
    if hits:
        row, window = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((window, row))
        row, window = row[order], window[order]
        border = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        for a, b in zip(border, np.r_[border[1:], len(row)]):
            yield int(row[a]), window[a:b]


def _spans(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word spans that windows at sorted ``starts`` cover."""
    border = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + width])
    ends = np.r_[border[1:], len(starts)] - 1
    return [(int(starts[a]), int(starts[b]) + width) for a, b in zip(border, ends)]


def _tree_spans(suffixes: DataFrame, width: int, group_rows: int) -> DataFrame:
    """(doc_id, version, spans) from groups that fit into memory."""

    def solved(held: list[tuple]) -> Iterator[tuple]:
        rows = [(key, doc_id, offset, words) for key, doc_id, _, _, offset, words in held]
        for i, windows in repeated_windows(rows, width):
            _, doc_id, version, first, _, _ = held[i]
            yield doc_id, version, [{"start": a, "stop": b} for a, b in _spans(first + windows, width)]

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        for row in rows:
            # Whole keys, as many as fit.
            if len(held) >= group_rows // 2 and row[0] != held[-1][0]:
                yield from solved(held)
                held = []
            held.append(row)
        if held:
            yield from solved(held)

    columns = suffixes.select("key", "doc_id", "version", "first", "offset", "words")
    dealt = columns.repartition(shuffle_width(columns), "key").sortWithinPartitions("key")
    return map_rows(dealt, run, f"doc_id bigint, version bigint, spans {_SPANS}", 2048)


def _digest_spans(suffixes: DataFrame, width: int) -> DataFrame:
    """The same for anchors too frequent for one task: windows meet by digest, least ids are summed up
    before the shuffle."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, version, first, words in rows:
            words = words.split(b" ")
            for s in range(len(words) - width + 1):
                yield doc_id, version, first + s, xxhash.xxh3_128_digest(b" ".join(words[s : s + width]))

    columns = suffixes.select("doc_id", "version", "first", "words")
    windows = map_rows(columns, run, "doc_id bigint, version bigint, start int, digest binary")
    windows = written(windows, "hot-windows")
    least = windows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    found = windows.join(least, "digest").filter("least < doc_id")
    span = F.struct(F.col("start"), (F.col("start") + width).cast("int").alias("stop"))
    return found.select("doc_id", "version", F.array(span).alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text), text as bytes; rows of equal id and text have equal spans."""
    return docs.select(id_column(docs), F.xxhash64(blob()).alias("version"), blob())


def repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, version, spans): word spans covered by windows that a document of smaller id also has.

    Spans may overlap. Rows without id neither lose words nor make others lose them.
    """
    keyed = _keyed(docs.filter(F.col("doc_id").isNotNull()))
    rows = written(_anchor_rows(keyed, width, gram), "anchors")
    arrays = ["position", "first", "last", "hash", "one", "three"]
    each = rows.select("doc_id", "version", F.explode(F.arrays_zip(*arrays)).alias("a")).select("doc_id", "version", "a.*")
    groups = _groups(each.select("doc_id", "hash", "one", "three"), group_rows)
    found = (
        each.select("doc_id", "version", "position", "first", "last", "hash")
        .join(groups, "hash")
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("key", "shards", "position", "first", "last")).alias("live"))
    )
    suffixes = written(_suffixes(keyed, found, width), "suffixes")
    trees = _tree_spans(suffixes.filter("shards = 1"), width, group_rows)
    hot = _digest_spans(suffixes.filter("shards > 1"), width)
    return trees.unionByName(hot).groupBy("doc_id", "version").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _covered(spans, n: int) -> np.ndarray:
    covered = np.zeros(n, bool)
    for span in spans or ():
        covered[span["start"] : span["stop"]] = True
    return covered


def digests(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    A null text has no words. Rows without id keep all words; rows of equal id are judged each, and none
    counts as smaller than the other. An empty table gives an empty result; other columns are ignored.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, spans in rows:
            words = (text or b"").split()
            n = len(words)
            if spans:
                words = [words[i] for i in np.flatnonzero(~_covered(spans, n))]
            yield doc_id, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()

    joined = _keyed(docs).join(repeats(docs, **params), ["doc_id", "version"], "left")
    return map_rows(joined.select("doc_id", "text", "spans"), run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def cut(text: bytes, spans) -> bytes:
    """``text`` without the words of ``spans``; the white space between the words kept stays."""
    words = [m.span() for m in _WORD.finditer(text)]
    kept = np.flatnonzero(~_covered(spans, len(words))).tolist()
    parts, before = [], None
    for i in kept:
        if before is None:
            start = words[i][0] if i else 0
        elif before == i - 1:
            start = words[before][1]
        else:
            parts.append(b" ")
            start = words[i][0]
        parts.append(text[start : words[i][1]])
        before = i
    if before is not None and before == len(words) - 1:
        parts.append(text[words[before][1] :])
    return b"".join(parts)


def deduplicated(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, which may become empty; all rows stay.

    Texts that lose nothing stay as they are, null included.
    """
    columns = docs.columns
    spans = repeats(docs, **params).select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("spans").alias("__spans"))
    match = (F.col("doc_id").cast("bigint") == F.col("__id")) & (F.xxhash64(blob()) == F.col("__version"))
    joined = docs.join(spans, match, "left").drop("__id", "__version")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, found = batch.column("text").to_pylist(), batch.column("__spans").to_pylist()
            new = [t if t is None or not s else cut(t.encode(), s).decode() for t, s in zip(texts, found)]
            arrays = [pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    from pyspark.sql.types import StructType

    return joined.mapInArrow(run, StructType([docs.schema[c] for c in columns]))
