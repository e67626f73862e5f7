"""SimHash near-duplicates linked through BK-trees.

Fingerprints: words of ASCII-lower-cased text, shingles of `shingle_words`
words (repeats included), XXH64 with seed 42, one majority vote per bit.

Links: fingerprints of at most `max_bits` differing bits.  All trees are made
of distinct fingerprints, so copies cost nothing.  Trees are sharded by parts
of the fingerprint: 64 bits are cut into `max_bits` + 2 parts, and two linked
fingerprints agree on two parts at least, so every pair of parts gives one
shard key and each link lies inside some shard.  A shard above `shard_limit`
fingerprints is split again on the bits its key does not fix (`max_bits` + 1
parts, one of which must agree), for `splits` rounds; its size is then bounded
by the few bits left.  No fingerprint table is broadcast or collected: a
shard's tree is built and asked in the task that holds the shard.

In a tree children are keyed by their integer Hamming distance to the parent,
and a search with radius r follows only the edges d-r to d+r.  A shard gives
a spanning forest of its links, never all pairs, so output is linear in its
members.  Components come from alternating stars over those links.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other.  Repeated rows share a fingerprint and so a component.  A null
doc_id never names a component; a component of such rows only has null.  The
result has the columns doc_id, fingerprint, component_id whatever else the
input holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import small_batches, table, written
from casefile.llm.components import components

SHINGLE_WORDS, MAX_BITS = 3, 2
SEED = 42
#: Fingerprints a shard may hold before it is split by more of its bits.
SHARD_LIMIT = 2000
#: Shingles hashed at a time: bounds the memory of one text.
SHINGLE_BLOCK = 200_000


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - shingle_words + 1
    if not words:
        return 0
    if n < 1:
        words, n, shingle_words = [b" ".join(words)], 1, 1
    votes = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLE_BLOCK):
        part = words[at:min(n, at + SHINGLE_BLOCK) + shingle_words - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(shingle_words)), strict=False))
        h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """`df` with the fingerprint of `text` as a (signed) long column."""

    @F.arrow_udf("long")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    small_batches(df.sparkSession)
    return df.withColumn(out, hashed.asNondeterministic()(F.col(text)))


# shards -------------------------------------------------------------------------

def cut(width: int, parts: int) -> list[tuple[int, int]]:
    """`width` bits as `parts` nearly equal (shift, bits) fields."""
    edges = [width * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _field(value, shift: int, bits: int):
    return F.shiftrightunsigned(value, shift).bitwiseAND((1 << bits) - 1)


def sharded(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, shard, rest, width): a row for each pair of agreeing parts; `rest`
    packs the bits that the key does not fix."""
    fields = cut(64, max_bits + 2)
    rows = []
    for i in range(len(fields)):
        for j in range(i):
            free = [f for k, f in enumerate(fields) if k not in (i, j)]
            key = F.xxhash64(F.lit(i * 100 + j), _field(F.col("fp"), *fields[i]), _field(F.col("fp"), *fields[j]))
            rows.append(F.struct(key.alias("shard"), _packed(F.col("fp"), free).alias("rest"),
                                 F.lit(sum(b for _, b in free)).alias("width")))
    return fps.select("fp", F.explode(F.array(*rows)).alias("s")).select("fp", "s.*")


def _packed(value, fields: list[tuple[int, int]]):
    out, at = F.lit(0).cast("long"), 0
    for shift, bits in fields:
        out = out.bitwiseOR(F.shiftleft(_field(value, shift, bits), at))
        at += bits
    return out


def split_shards(rows: DataFrame, large: DataFrame, max_bits: int, width: int) -> DataFrame:
    """Rows of the shards in `large`, dealt anew by parts of their free bits."""
    out = []
    for k, part in enumerate(fields := cut(width, max_bits + 1)):
        free = [f for f in fields if f != part]
        out.append(F.struct(F.xxhash64("shard", F.lit(k), _field(F.col("rest"), *part)).alias("shard"),
                            _packed(F.col("rest"), free).alias("rest"), F.lit(sum(b for _, b in free)).alias("width")))
    return (rows.filter(F.col("width") == width).join(large.select("shard", "width"), ["shard", "width"], "left_semi")
            .select("fp", F.explode(F.array(*out)).alias("s")).select("fp", "s.*"))


def shard_rows(spark: SparkSession, fps: DataFrame, max_bits: int, limit: int) -> DataFrame:
    """(fp, shard) of all shards with two members or more."""
    small = None
    rows = written(spark, sharded(fps, max_bits), "shards")
    while True:
        sizes = rows.groupBy("shard", "width").agg(F.count("*").alias("n"))
        sizes = written(spark, sizes.filter("n > 1"), "shard-sizes")
        # a key that fixes all but `max_bits` + 1 bits cannot be split to any use
        large = sizes.filter((F.col("n") > limit) & (F.col("width") > max_bits + 1))
        kept = rows.join(sizes.join(large, ["shard", "width"], "left_anti"), ["shard", "width"], "left_semi")
        kept = kept.select("fp", "shard")
        small = kept if small is None else small.unionAll(kept)
        widths = [r["width"] for r in large.select("width").distinct().collect()]  # one per cut of the key
        if not widths:
            return small
        parts = [split_shards(rows, large, max_bits, w) for w in widths]
        for more in parts[1:]:
            parts[0] = parts[0].unionAll(more)
        rows = written(spark, parts[0], "shards")


# trees --------------------------------------------------------------------------

class Forest:
    """One BK-tree for each shard of a run of rows sorted by shard.

    Built level by level: the first member that waits below an edge becomes
    the node, the others go on to its child at their distance from it.
    """

    def __init__(self, fps: np.ndarray, shard_start: np.ndarray):
        n = len(fps)
        self.fps = fps
        shard = np.zeros(n, np.int64)
        shard[shard_start] = 1
        self.root = shard_start[np.cumsum(shard) - 1]
        self.edge_from, self.edge_dist, self.edge_to = [], [], []
        waiting, group = np.arange(n), self.root.copy()
        first = shard_start
        while True:
            stays = np.ones(len(waiting), bool)
            stays[np.searchsorted(waiting, first)] = False
            # `group` holds, for each waiting member, the node above it
            waiting, group = waiting[stays], group[stays]
            if not len(waiting):
                break
            dist = np.bitwise_count(fps[waiting] ^ fps[group]).astype(np.int64)
            key = group * 65 + dist
            order = np.argsort(key, kind="stable")
            new = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
            node = waiting[order[new]]  # the least waiting member below the edge
            self.edge_from.append(group[order[new]])
            self.edge_dist.append(dist[order[new]])
            self.edge_to.append(node)
            below = np.empty(len(waiting), np.int64)
            below[order] = np.repeat(node, np.diff(np.concatenate((new, [len(order)]))))
            group, first = below, np.sort(node)
        none = np.empty(0, np.int64)
        source, dist, child = (np.concatenate([none, *x]) for x in (self.edge_from, self.edge_dist, self.edge_to))
        order = np.argsort(source * 65 + dist, kind="stable")
        self.edge_key, self.child = (source * 65 + dist)[order], child[order]

    def within(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Members at most `radius` from the members in `query`, in their own trees."""
        who, node = query, self.root[query]
        left, right = [], []
        while len(who):
            dist = np.bitwise_count(self.fps[who] ^ self.fps[node]).astype(np.int64)
            hit = (dist <= radius) & (who != node)
            left.append(who[hit])
            right.append(node[hit])
            low = np.searchsorted(self.edge_key, node * 65 + np.maximum(dist - radius, 0))
            high = np.searchsorted(self.edge_key, node * 65 + np.minimum(dist + radius, 64), side="right")
            many = high - low
            ends = np.cumsum(many)
            at = np.repeat(low - (ends - many), many) + np.arange(many.sum())
            who, node = np.repeat(who, many), self.child[at]
        none = np.empty(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])


def spanning_links(fps: np.ndarray, shard: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each linked member to the least position of its component."""
    start = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    forest = Forest(fps, start)
    label = np.arange(len(fps))
    size = np.diff(np.concatenate((start, [len(fps)])))
    cost = np.cumsum(np.repeat(size, size))  # a search meets its whole shard at worst
    for part in np.split(np.arange(len(fps)), np.searchsorted(cost, np.arange(2_000_000, cost[-1], 2_000_000))):
        a, b = forest.within(part, max_bits)
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label = label[label]
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return linked, label[linked]


def shard_links(rows: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): a spanning forest of the links inside each shard."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_s, held_f, size = [], [], 0

        def flush(last: bool):
            nonlocal held_s, held_f, size
            s, f = np.concatenate(held_s), np.concatenate(held_f)
            end = len(s) if last else int(np.searchsorted(s, s[-1]))  # the last shard may go on
            held_s, held_f, size = [s[end:]], [f[end:]], len(s) - end
            if end:
                a, b = spanning_links(f[:end].view(np.uint64), s[:end], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(f[a]), pa.array(f[b])], names=["a", "b"])

        for batch in batches:
            held_s.append(batch.column(0).to_numpy())
            held_f.append(batch.column(1).to_numpy())
            size += len(batch)
            if size >= 100_000:
                yield from flush(False)
        if held_s:
            yield from flush(True)

    return (rows.select("shard", "fp").repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(links, "a long, b long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_fp) of every row of `docs`;
    component_fp names a component also where all its ids are null."""
    marked = written(spark, fingerprints(docs.select("doc_id", "text"), shingle_words=shingle_words)
                     .select("doc_id", "fp"), "fingerprints")
    fps = written(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(spark, shard_links(shard_rows(spark, fps.select("fp"), max_bits, shard_limit), max_bits))
    named = fps.join(found, fps.fp == found.node, "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = written(spark, named, "labels")
    best = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = written(spark, named.join(best, "label").select(F.col("fp").alias("f"), "component_id", "label"), "components")
    return marked.join(by_fp, F.col("fp") == F.col("f")).select(
        "doc_id", _hex("fp").alias("fingerprint"), "component_id", _hex("label").alias("component_fp"))


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that name their component, one for each component.

    Texts are not grouped: the ids to drop are joined away.  Rows whose id
    occurs more than once, or that have none, are told apart by their
    fingerprints; of equals the one whose text hashes least stays, and a row
    without id stays only where no row of its component has one.
    """
    found = written(spark, near_duplicates(spark, docs, shingle_words, max_bits), "near-duplicates")
    ids = found.filter(F.col("doc_id").isNotNull())
    repeated = written(spark, ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated")
    gone = ids.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").unionAll(repeated).distinct()
    plain = docs.filter(F.col("doc_id").isNotNull()).join(written(spark, gone, "dropped"), "doc_id", "left_anti")

    odd = docs.filter(F.col("doc_id").isNull()).unionAll(docs.join(repeated, "doc_id", "left_semi").select(docs.columns))
    odd = odd.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), "text")
    odd = fingerprints(odd, shingle_words=shingle_words).select("row", "_id", "text", _hex("fp").alias("_fp"))
    names = found.select("doc_id", "fingerprint", "component_id", "component_fp").distinct()
    kept = (odd.join(names, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_fp") == F.col("fingerprint")))
            .filter(F.col("_id").eqNullSafe(F.col("component_id")))
            .groupBy("component_fp").agg(F.min_by("row", F.xxhash64("text")).alias("row")).select("row.*"))
    return plain.select(docs.columns).unionAll(kept.select(docs.columns))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
