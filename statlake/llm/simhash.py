"""SimHash near-duplicates with vantage-point trees.

Two fingerprints that differ in at most three bits differ in at most one bit of their upper or of their
lower half. Each half has its own vantage-point tree under the Hamming distance, with radius one. A tree
fitted on a sample sends every distinct fingerprint to the shard of its ball; one within the radius
beyond a ball's border also goes inside it, so every linked pair meets in some shard. Shards go on
splitting by vantage points of their own and compare what is left exactly, over all 64 bits. A shard too
large for one task (a dense ball of near copies, or a table beyond the trees' leaves) is dealt into
blocks by hash, and every two of its blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import blob, id_column, map_rows, sampled, written

BITS, RADIUS, HALF_RADIUS = 64, 3, 1
#: Fingerprints from which the sending trees are fitted, about; rows wanted in a shard.
TREE_SAMPLE, SHARD_ROWS, MOST_SHARDS = 131_072, 4_000, 16_384
#: Fingerprints of a block of a shard that is too large for one task; every two blocks meet.
BLOCK_ROWS = 262_144
_SMALL, _MATRIX = 256, 1024


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """Unsigned 64-bit SimHash of word shingles; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist())]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 32_768):
        part = np.array(hashes[at : at + 32_768], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, version, fp): a hash of the text and the fingerprint as a signed 64-bit number."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, version, text in rows:
            fp = fingerprint(text, size)
            yield doc_id, version, fp - (1 << 64) if fp >> 63 else fp

    columns = docs.select(id_column(docs), F.xxhash64(blob()).alias("version"), blob())
    return map_rows(columns, run, "doc_id bigint, version bigint, fp bigint")


def _apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _vantage(values: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and border of the ball that splits ``values`` with the fewest copies.

    None if every choice would leave a side with nearly all of them.
    """
    best = None
    step = max(1, len(values) // 512)
    seen = values[::step]
    for point in values[:: max(1, len(values) // 6)][:6]:
        counts = np.bincount(_apart(seen, point), minlength=BITS + 1)
        inside = np.cumsum(counts)
        border = int(np.searchsorted(inside, len(seen) / 2))
        for mu in (border - 1, border):
            if mu >= 0:
                left = inside[min(BITS, mu + radius)]
                right = len(seen) - inside[mu]
                cost = max(left, right) + left + right
                if right and left < len(seen) and (best is None or cost < best[0]):
                    best = (cost, point, mu, max(left, right))
    if best is None or best[3] > 0.9 * len(seen):
        return None
    return best[1], best[2]


def build_tree(values: np.ndarray, radius: int, shards: int):
    """Nested (point, border, inside, outside) with shard numbers as leaves, from a sample."""
    numbers = iter(range(10**9))
    least = max(4, len(values) // max(1, shards))

    def grow(held: np.ndarray, depth: int):
        split = _vantage(held, radius) if len(held) > least and depth < 40 else None
        if split is None:
            return next(numbers)
        point, mu = split
        inside = _apart(held, point) <= mu
        return point, mu, grow(held[inside], depth + 1), grow(held[~inside], depth + 1)

    return grow(values, 0)


def route(tree, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions of the values in it); border values are in more than one shard."""
    waiting = [(tree, np.arange(len(values)))]
    while waiting:
        node, at = waiting.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at
            continue
        point, mu, inside, outside = node
        d = _apart(values[at], point)
        waiting.append((inside, at[d <= mu + radius]))
        waiting.append((outside, at[d > mu]))


def links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one, other) that connect what is linked among ``values`` (distinct, unsigned).

    Branches of a local tree prune what the triangle inequality rules out. Inside a dense group only
    a spanning forest is given, not every pair.
    """
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    ones, others = [], []
    # (values, stage): stage 0 splits by the upper half, 1 by the lower half, 2 by all bits.
    waiting = [(values, 0), (values, 1)] if len(values) > _SMALL else [(values, 2)]
    while waiting:
        held, stage = waiting.pop()
        if len(held) < 2:
            continue
        if len(held) > _SMALL:
            keys = held >> high if stage == 0 else held & low if stage == 1 else held
            radius = RADIUS if stage == 2 else HALF_RADIUS
            split = _vantage(keys, radius)
            if split is not None:
                d = _apart(keys, split[0])
                waiting.append((held[d <= split[1] + radius], stage))
                waiting.append((held[d > split[1]], stage))
                continue
            if stage < 2 and len(held) > _MATRIX:
                waiting.append((held, 2))
                continue
        a, b = _compare(held)
        ones.append(a)
        others.append(b)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *ones]), np.concatenate([empty, *others])


def _compare(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(held) <= _MATRIX:
        i, j = np.nonzero(np.triu(_apart(held[:, None], held[None, :]) <= RADIUS, 1))
        if len(i) <= 4 * len(held):
            return held[i], held[j]
    # A search from each unreached value; what it reaches is compared once.
    rest, one, other = held.copy(), [], []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            near = _apart(rest, front[-1]) <= RADIUS
            point = front.pop()
            if near.any():
                reached = rest[near]
                one.append(np.full(len(reached), point))
                other.append(reached)
                rest = rest[~near]
                front.extend(reached)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *one]), np.concatenate([empty, *other])


def paired_blocks(sent: DataFrame, block_rows: int) -> DataFrame:
    """(shard, low, high, fp): the rows of ``sent`` (shard, fp) for every two blocks of their shard.

    A shard of at most ``block_rows`` rows is one block and is not copied. Row counts come from all rows;
    there is one for each leaf of the two trees at most, so the large ones are a small table.
    """
    counts = sent.groupBy("shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    large = counts.filter("blocks > 1")
    known = sent.join(F.broadcast(large), "shard", "left").select("shard", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    own = known.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    each = own.select("shard", "fp", "own", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return each.filter("blocks = 1 or other <> own").select(
        "shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )


def near_links(distinct: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that connect all within the radius."""
    n = distinct.count()
    if not n:
        return distinct.sparkSession.createDataFrame([], "a bigint, b bigint")
    shards = int(np.clip(-(-n // SHARD_ROWS), 1, MOST_SHARDS))
    taken = sampled(distinct, min(TREE_SAMPLE, 16 * shards + 64), n, "fp").select("fp").collect()
    sample = np.array(sorted(r["fp"] for r in taken), np.int64).view(np.uint64)
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    trees = [build_tree(sample >> high, HALF_RADIUS, shards), build_tree(sample & low, HALF_RADIUS, shards)]

    def send(batches):
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            values = fps.view(np.uint64)
            for half, keys in enumerate((values >> high, values & low)):
                for shard, at in route(trees[half], keys, HALF_RADIUS):
                    for start in range(0, len(at), 8192):
                        some = fps[at[start : start + 8192]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), 2 * shard + half, np.int64)), pa.array(some)], ["shard", "fp"]
                        )

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(group["fp"].to_numpy()).view(np.uint64)
        a, b = links(values)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = written(distinct.select("fp").mapInArrow(send, "shard bigint, fp bigint"), "shards")
    return paired_blocks(sent, block_rows).groupBy("shard", "low", "high").applyInPandas(meet, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of (a, b) edges, the root the least node.

    Alternating large and small stars; each round is a written table, and rounds grow with the
    logarithm of the size of a component.
    """

    def star(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").distinct()

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    current = written(star(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    before = None
    while (now := state(current)) != before:
        before = now
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = star(
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        current = written(star(small), "edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def classes(docs: DataFrame, size: int = 3) -> tuple[DataFrame, DataFrame]:
    """Written tables: (doc_id, version, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    prints = written(fingerprints(docs, size), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(near_links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints, written(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Rows without id link the others
    but lend no component_id (null if no row of the component has an id); repeated rows each appear.
    An empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    prints, found = classes(docs, size)
    return prints.join(found, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, size: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one of smallest id.

    Among equal ids the one of least text hash; of rows of equal id and text one. A row without id stays
    only if no row of its component has an id.
    """
    return best_of_each(docs, *classes(docs, size))


def best_of_each(docs: DataFrame, prints: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, from (doc_id, version, fp) of its rows and (fp, root)."""
    rows = prints.groupBy("doc_id", "version", "fp").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id"), F.col("version"), F.col("copies"))
    firsts = rows.groupBy("fp").agg(F.min(order).alias("best"))
    best = firsts.join(found.select("fp", "root"), "fp").groupBy("root").agg(F.min("best").alias("best"))
    kept = best.select(
        F.col("best.doc_id").alias("__id"), F.col("best.version").alias("__version"), F.col("best.copies").alias("__copies")
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(blob()) == F.col("__version"))
    joined = docs.join(kept, same)
    single = joined.filter("__copies = 1").select(*docs.columns)
    repeated = joined.filter("__copies > 1").dropDuplicates(["__id", "__version"]).select(*docs.columns)
    return single.unionByName(repeated)
