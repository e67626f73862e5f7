"""The prefix trie of conversations, built as adaptive radix trees.

A turn is a fixed-width big-endian id: a digest of its role and text, then the
bytes of its text.  A conversation is the ids of its turns, one after another,
and so a byte string whose prefixes at multiples of WIDTH are its trie nodes.

Conversations are sorted by (key, conv_id) with one range exchange.  Each task
puts its slice into a radix tree with path compression and label tables that
grow with the number of children, and walks it: only depths that end a turn
are nodes.  A node whose conversations all lie within the slice is finished
there.  The others lie on the path of the slice's first or last key; these two
paths, with what is known of their nodes, are all that a slice passes on.
Paths of FAN_IN neighbouring slices are put into a tree in the same way, until
one slice is left.  Neither a hot prefix nor a hot conversation gathers in one
task: its rows are spread over slices, and a task holds RUN_BYTES of keys at a
time, whatever its slice's size.  The ids of conversations that end in one node
leave a slice as joined pieces, which are hashed in order, a piece at a time.

Defined cases: turns are ordered by turn (null first), then role, then text;
null roles and texts are empty; repeated rows are turns of their own; rows
without conv_id belong to no conversation.  No conversations have no nodes,
not even a root.  Other columns are ignored.  All turns of a conversation meet
in one row, as 20 bytes each.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import small_batches, table, written

#: A turn's id: 16 bytes of digest, 4 bytes with the length of its text.
DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
#: Key bytes in one tree of a slice, and slices whose paths one task joins.
RUN_BYTES, FAN_IN = 2_000_000, 64
#: Turns that a conversation can take from another one, and how ids are paired.
HEAD_TURNS, FAMILY = 8, 5

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
STATS = "array<struct<n:long,least:long,kids:long,leaves:long,saved:long,id:binary>>"
FOLDED = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
          "ends_sha256 string, id binary, parent_id binary, kind string, slice long, seq long, key binary, stats " + STATS
          + ", text string")


# --- conversations as keys


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, id): every turn with its id in hex."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text)), 2 * LENGTH, "0")
    return (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
                    F.concat(F.md5(named.cast("binary")), size).alias("id")))


def _key(turns: Column) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: t.id), ""))


def keys(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv_id, key).  Texts are shuffled only for conversations in which the
    order of equal turns of one role depends on them."""
    turns = turn_ids(conversations)
    t = F.col("t")
    tie = F.exists(F.sequence(F.lit(1), F.size(t)), lambda i: F.get(t, i).turn.eqNullSafe(t[i - 1].turn)
                   & (F.get(t, i).role == t[i - 1].role) & (F.get(t, i).id != t[i - 1].id))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "id"))).alias("t"))
    convs = written(spark, listed.select("conv_id", _key(t).alias("key"), F.coalesce(tie, F.lit(False)).alias("tied")), "conversations")
    tied = convs.filter("tied").select("conv_id")
    if tied.isEmpty():
        return convs.select("conv_id", "key")
    by_text = (turns.join(tied, "conv_id", "left_semi").groupBy("conv_id")
               .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "id"))).alias("t")))
    return convs.filter("not tied").select("conv_id", "key").unionAll(by_text.select("conv_id", _key(t).alias("key")))


def rebuilt(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv_id, key) of the rebuilt conversations: the first h turns of
    conversation c - c % 5, then c's own turns after its first h."""
    convs = written(spark, keys(spark, conversations), "keys")
    source = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("source"), F.substring("key", 1, HEAD_TURNS * WIDTH).alias("head"))
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1)).cast("int") * WIDTH
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), cut)
    rest = F.substring(F.col("key"), cut + 1, F.octet_length("key"))
    return convs.withColumn("source", source).join(heads, "source", "left").select("conv_id", F.concat(head, rest).alias("key"))


# --- the radix tree


class Node:
    """A tree node: the bytes that lead to it from its parent, and its children
    by their first byte.  `labels` holds up to 16 sorted bytes, then a table of
    256 places into `kids`; above 48 children `kids` itself is the table."""

    __slots__ = ("prefix", "labels", "kids", "stat")

    def __init__(self, prefix: bytes) -> None:
        self.prefix, self.labels, self.kids, self.stat = prefix, bytearray(), [], None

    def find(self, label: int) -> Node | None:
        labels = self.labels
        if labels is None:
            return self.kids[label]
        if len(labels) == 256:
            return self.kids[labels[label] - 1] if labels[label] else None
        at = labels.find(label)
        return self.kids[at] if at >= 0 else None

    def add(self, kid: Node) -> None:
        label, labels = kid.prefix[0], self.labels
        if labels is not None and len(labels) < 16:
            at = bisect_left(labels, label)
            labels.insert(at, label)
            self.kids.insert(at, kid)
            return
        if labels is not None and len(labels) == 16:
            self.labels = bytearray(256)
            for place, known in enumerate(labels):
                self.labels[known] = place + 1
        if self.labels is not None and len(self.kids) == 48:
            table = [None] * 256
            for known in self.kids:
                table[known.prefix[0]] = known
            self.labels, self.kids = None, table
        if self.labels is None:
            self.kids[label] = kid
        else:
            self.kids.append(kid)
            self.labels[label] = len(self.kids)

    def replace(self, old: Node, new: Node) -> None:
        self.kids[self.kids.index(old)] = new

    def children(self) -> list[Node]:
        return self.kids if self.labels is not None else [k for k in self.kids if k is not None]


def common(a: bytes, b: bytes) -> int:
    """How many first bytes of a and b are equal."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # the first difference is in [low, high]
    while low < high:
        mid = (low + high) // 2
        if a[low:mid + 1] == b[low:mid + 1]:
            low = mid + 1
        else:
            high = mid
    return low


def reach(node: Node, at: int, key: bytes, end: int) -> Node:
    """The tree node of key[:end], made if need be, below `node` at depth `at`."""
    while at < end:
        kid = node.find(key[at])
        if kid is None:
            kid = Node(key[at:end])
            node.add(kid)
            return kid
        same = len(kid.prefix) if end - at >= len(kid.prefix) and key.startswith(kid.prefix, at) else common(
            kid.prefix, key[at:min(end, at + len(kid.prefix))])
        if same < len(kid.prefix):  # the path is cut where the keys part
            upper = Node(kid.prefix[:same])
            node.replace(kid, upper)
            kid.prefix = kid.prefix[same:]
            upper.add(kid)
            kid = upper
        node, at = kid, at + same
    return node


class Stat:
    """What is known of a trie node beside its children in the tree: its own
    conversations and its finished children.  `id`: of a node that was open."""

    __slots__ = ("n", "least", "kids", "leaves", "saved", "ends", "id")

    def __init__(self, n=0, least=None, kids=0, leaves=0, saved=0, id=None) -> None:
        self.n, self.least, self.kids, self.leaves, self.saved, self.ends, self.id = n, least, kids, leaves, saved, [], id

    def add(self, other: Stat) -> None:
        self.n += other.n
        if self.least is None or (other.least is not None and other.least < self.least):
            self.least = other.least
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends += other.ends
        self.id = self.id or other.id


def prefix_ids(key: bytes) -> list[bytes]:
    """An id for each turn-aligned prefix of the key, the empty one first."""
    h = hashlib.md5(b"")
    out = [h.digest()]
    for at in range(0, len(key), WIDTH):
        h.update(key[at:at + WIDTH])
        out.append(h.copy().digest())
    return out


class Slice:
    """Sorted keys of one slice: rows in, finished nodes and open paths out."""

    def __init__(self, number: int, first: bytes | None = None) -> None:
        self.number, self.seq, self.left, self.last = number, 0, first, first
        self.root, self.bytes = Node(b""), 0
        self.nodes: list[list] = []  # NODE + id, parent_id
        self.pieces: list[tuple] = []  # id, seq, text

    def conversation(self, key: bytes, conv_id: int) -> None:
        stat = Stat(1, conv_id)
        stat.ends.append(str(conv_id))
        self._put(reach(self.root, 0, key, len(key)), stat)
        self._seen(key)
        self.bytes += len(key) + WIDTH

    def path(self, key: bytes, stats: list[Stat]) -> None:
        """Facts of the last len(stats) nodes on the way to `key`."""
        node, at = self.root, 0
        for depth, stat in enumerate(stats, len(key) // WIDTH + 1 - len(stats)):
            node, at = reach(node, at, key, depth * WIDTH), depth * WIDTH
            self._put(node, stat)
        self._seen(key)

    def _seen(self, key: bytes) -> None:
        self.left = key if self.left is None else self.left
        self.last = key

    @staticmethod
    def _put(node: Node, stat: Stat) -> None:
        if node.stat is None:
            node.stat = stat
        else:
            node.stat.add(stat)

    def finish(self, whole: bool = False) -> list[tuple[bytes, list[Stat]]]:
        """Walks the tree: finished nodes go to `nodes`; the facts of the open
        ones, by first and last key, are returned (none are open if `whole`)."""
        left, last = (None, None) if whole else (self.left, self.last)
        ids = [] if whole else [prefix_ids(left), prefix_ids(last)]
        open_paths: list[list[Stat]] = [[], []]  # deepest first
        # a frame: node, depth in bytes before it, bytes that lead to it and their
        # common length with either key, children left, facts of finished children
        stack = [self._frame(self.root, 0, b"", (0, 0), left, last)]
        while stack:
            frame = stack[-1]
            if frame[4]:
                kid = frame[4].pop()
                stack.append(self._frame(kid, frame[1], frame[2], frame[3], left, last))
                continue
            stack.pop()
            node, end, path, same, _, facts, waiting = frame
            start = end - len(node.prefix)
            depth = end - end % WIDTH
            while depth > start or (end == 0 and depth == 0):
                stat = Stat()
                if depth == end and node.stat is not None:
                    stat = node.stat
                stat.add(facts)
                which = -1 if whole else 0 if depth <= same[0] else 1 if depth <= same[1] else -1
                if which >= 0:
                    mine = ids[which][depth // WIDTH]
                    for row in waiting:
                        row[-1] = mine
                    stat.id = mine
                    self._piece(stat)
                    open_paths[which].append(stat)
                    facts, waiting = Stat(), []
                else:
                    size = int.from_bytes(path[len(path) - (end - depth) - LENGTH:len(path) - (end - depth)]) if depth else 0
                    row = self._node(stat, depth // WIDTH, size)
                    for child in waiting:
                        child[2] = stat.least
                    facts, waiting = Stat(stat.n, stat.least, 1, row[5], row[6]), [row]
                depth -= WIDTH
            if stack:
                stack[-1][5].add(facts)
                stack[-1][6].extend(waiting)
        self.root, self.bytes = Node(b""), 0
        paths = [(key, stats[::-1]) for key, stats in zip((left, last), open_paths) if stats]
        return paths

    @staticmethod
    def _frame(node: Node, start: int, path: bytes, same: tuple[int, int], left: bytes | None, last: bytes | None) -> list:
        end = start + len(node.prefix)
        if left is not None:
            same = tuple(start + common(node.prefix, key[start:end]) if s == start else s for s, key in zip(same, (left, last)))
        # the bytes back to the turn's beginning are enough
        return [node, end, path[-WIDTH:] + node.prefix, same, list(node.children()), Stat(), []]

    def _piece(self, stat: Stat) -> None:
        if stat.ends:
            self.pieces.append((stat.id, self.seq, ",".join(stat.ends)))
            self.seq += 1
            stat.ends = []

    def _node(self, stat: Stat, depth: int, size: int) -> list:
        sha = hashlib.sha256(",".join(stat.ends).encode()).hexdigest() if stat.id is None else None
        if stat.id is not None:  # its other pieces have left this tree
            self._piece(stat)
        row = [stat.least, depth, None, stat.n, stat.kids, stat.leaves if stat.kids else 1,
               stat.saved + (stat.n - 1) * size, sha, stat.id, None]
        self.nodes.append(row)
        return row

    def rows(self, paths: list[tuple[bytes, list[Stat]]]) -> Iterator[pa.RecordBatch]:
        """What is finished, and the given open paths, as rows of FOLDED."""
        names = [x.strip().split(" ")[0] for x in FOLDED.split(", stats ")[0].split(",")] + ["stats", "text"]
        out = [dict(zip([*NODE, "id", "parent_id"], row), kind="node") for row in self.nodes]
        out += [dict(id=id, kind="piece", slice=self.number, seq=seq, text=text) for id, seq, text in self.pieces]
        for key, stats in paths:
            facts = [dict(n=s.n, least=s.least, kids=s.kids, leaves=s.leaves, saved=s.saved, id=s.id) for s in stats]
            out.append(dict(kind="path", slice=self.number, seq=self.seq, key=key, stats=facts))
            self.seq += 1
        self.nodes, self.pieces = [], []
        schema = _arrow_schema()
        for at in range(0, len(out), 10_000):
            part = out[at:at + 10_000]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in part], schema=schema)


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    plain = [x.strip().split(" ") for x in FOLDED.split(", stats ")[0].split(",")]
    stat = pa.struct([("n", pa.int64()), ("least", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()),
                      ("saved", pa.int64()), ("id", pa.binary())])
    return pa.schema([(n, kinds[t]) for n, t in plain] + [("stats", pa.list_(stat)), ("text", pa.string())])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trees of one sorted partition of (conv_id, key)."""
    part = Slice(TaskContext.get().partitionId())
    for batch in batches:
        for conv_id, key in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist()):
            part.conversation(key, conv_id)
            if part.bytes > RUN_BYTES:
                paths = part.finish()
                yield from part.rows([])
                for path in paths:
                    part.path(*path)
    if part.left is not None:
        yield from part.rows(part.finish())


def _fold(whole: bool):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The open paths of neighbouring slices, sorted by (group, slice, seq)."""
        group = None
        for batch in batches:
            for row in batch.to_pylist():
                if group is None or row["group"] != group.number:
                    if group is not None:
                        yield from group.rows(group.finish(whole))
                    group = Slice(row["group"])
                group.path(row["key"], [Stat(**s) for s in row["stats"]])
        if group is not None:
            yield from group.rows(group.finish(whole))

    return fold


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ends_sha256) of pieces sorted by (id, slice, seq), a piece at a time."""
    schema = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])
    current, sha = None, None
    for batch in batches:
        done = []
        for id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if id != current:
                if sha is not None:
                    done.append((current, sha.hexdigest()))
                current, sha = id, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([sha.hexdigest()])], schema=schema)


# --- the trie


def trie(spark: SparkSession, convs: DataFrame) -> DataFrame:
    """The NODE rows of conversations given as (conv_id, key), ids distinct."""
    small_batches(spark)
    ordered = (written(spark, convs.select("conv_id", "key"), "rebuilt")
               .repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"))
    folded = [written(spark, ordered.mapInArrow(_slices, FOLDED), "slices")]
    while True:
        paths = folded[-1].filter("kind = 'path'")
        slices = paths.agg(F.max("slice")).first()[0]
        if slices is None:  # no conversation, or all joined
            break
        whole = slices < FAN_IN
        grouped = (paths.select(F.expr(f"slice div {FAN_IN}").alias("group"), "slice", "seq", "key", "stats")
                   .repartition("group").sortWithinPartitions("group", "slice", "seq"))
        folded.append(written(spark, grouped.mapInArrow(_fold(whole), FOLDED), "paths"))
    rows = folded[0]
    for more in folded[1:]:
        rows = rows.unionAll(more)
    nodes = rows.filter("kind = 'node'")
    # nodes on the slices' paths: few, and the planner knows their table's size
    shared = written(spark, nodes.filter(F.col("id").isNotNull()).select(F.col("id").alias("s_id"), F.col("conv_id").alias("s_conv")), "shared")
    ends = (rows.filter("kind = 'piece'").select("id", "slice", "seq", "text")
            .repartition("id").sortWithinPartitions("id", "slice", "seq").mapInArrow(_hashed, "id binary, ends_sha256 string"))
    ends = written(spark, ends.select(F.col("id").alias("e_id"), F.col("ends_sha256").alias("e_sha")), "ends")
    done = F.col("parent_id").isNull() & F.col("ends_sha256").isNotNull()
    left = (nodes.filter(~done)
            .join(shared, F.coalesce("parent_id", "id") == F.col("s_id"), "left")
            .join(ends, F.coalesce("id", "parent_id") == F.col("e_id"), "left")
            .withColumn("parent_conv_id", F.when(F.col("parent_id").isNotNull(), F.col("s_conv")).otherwise(F.col("parent_conv_id")))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", "e_sha", F.sha2(F.lit(b""), 256))))
    return nodes.filter(done).select(NODE).unionAll(left.select(NODE))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark, rebuilt(spark, table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
             lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda s, x: CASE WHEN x >= 0 THEN xor(s, x)
                             ELSE xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END) END),
           4294967295::BIGINT) % 9 AS h
  FROM t),
r AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(s.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM h c LEFT JOIN h s ON s.conv_id = c.conv_id - c.conv_id % 5),
p AS (
  SELECT conv_id, d, len(turns) AS n, sha256(list_slice(turns, 1, d)::JSON::VARCHAR) AS k,
         CASE WHEN d > 0 THEN sha256(list_slice(turns, 1, d - 1)::JSON::VARCHAR) END AS pk,
         CASE WHEN d > 0 THEN strlen(turns[d].t) ELSE 0 END AS bytes
  FROM r, unnest(range(0, len(turns) + 1)) AS x(d)),
nodes AS (
  SELECT k, d, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM p GROUP BY k, d),
kids AS (SELECT pk AS k, count(*) AS n FROM nodes WHERE pk IS NOT NULL GROUP BY pk),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
-- a node and the nodes above it: the prefixes of any one of its conversations
above AS (SELECT DISTINCT n.k AS k, p.k AS top FROM full_nodes n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d),
sub AS (
  SELECT top AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
         sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM above JOIN full_nodes USING (k) GROUP BY top)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sub USING (k) LEFT JOIN full_nodes u ON u.k = f.pk
"""
