"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its 128-bit key is the running exclusive-or of hashes of
(place, role, text), so a parent's key is known to each child. Counts of members and their least id are
one aggregate over (node, member) rows with map-side combine.

Subtree totals never join nodes with their ancestors. Nodes through which more than ``limit`` turns pass
form a small tree at the top; every subtree that hangs below it goes to one shard, whole, and a shard
holds many. Spark sorts a shard's nodes externally by reverse level order; the task sends each node's
totals to its parent through a priority queue that spills sorted runs when it outgrows memory, and
reads them when the parent comes up. Totals of shard roots are summed by parent and the same pass runs
once over the top tree. The runs are anonymous files of the running task, read by no other; a lost task
is repeated from its input. A hot first turn, or a group of copies, is many subtrees of the top tree or
few nodes with large counts.

Ids of the members that end in a node are hashed in numerical order: chunks of ids are joined where a
range of the sorted (node, id) rows lies, and only chunks, in order, pass through one hash.

Turns are ordered by turn (null first), then role and text, so ties have one order and repeated rows
stay as repeated turns. Null role or text counts as empty. Rows with a null conversation id belong to
no conversation. An empty table gives no nodes, not even a root. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import crc32_sql, crc32_table_sql, map_arrow

FAMILY = 5         # conversations that take their first turns from the first of them
HEADS = 9          # number of first turns taken: 0 to HEADS - 1
LIMIT = 4096       # turns through a node of a shard, at least
TOP = 4096         # the share of all turns that makes a node belong to the top tree is one in so many
QUEUE = 500_000    # messages a task holds before it spills
CHUNK = 1 << 16    # characters of joined ids
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
Message = tuple[int, int, int, int, int, int]  # -depth, key, key, children, leaves, saved


class SpillingQueue:
    """Priority queue of fixed-size messages: a heap in memory, sorted runs in anonymous files beyond ``limit``."""

    BLOCK = 4096

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []
        self.spilled = 0

    def push(self, message: Message) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.heap.sort()
            run = tempfile.TemporaryFile()
            np.array(self.heap, dtype=np.int64).tofile(run)
            run.seek(0)
            rows = self._read(run)
            heapq.heappush(self.runs, (next(rows), self.spilled, rows))
            self.spilled += 1
            self.heap = []

    def _read(self, run) -> Iterator[Message]:
        with run:
            while (block := np.fromfile(run, dtype=np.int64, count=6 * self.BLOCK)).size:
                yield from map(tuple, block.reshape(-1, 6).tolist())

    def take(self, place: tuple[int, int, int]) -> Iterator[Message]:
        """Messages to ``place``, which go; places are asked for in ascending order."""
        while self.heap and self.heap[0][:3] == place:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:3] == place:
            message, number, rows = self.runs[0]
            following = next(rows, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, rows))
            yield message


def forward(nodes: Iterable[tuple], queue: SpillingQueue) -> Iterator[tuple[int, int, int]]:
    """(children, leaves, saved) of each node, which come by reverse level order, then key.

    A node is (depth, key, key, parent key, parent key, own saving, children, leaves, saving, last) with what
    it has from other shards; ``last`` says that its parent is not among these nodes."""
    for depth, a, b, up_a, up_b, own, children, leaves, saved, last in nodes:
        saved += own
        for _, _, _, c, l, s in queue.take((-depth, a, b)):
            children += c
            leaves += l
            saved += s
        leaves = leaves or 1  # without children it is a leaf itself
        if not last:
            queue.push((1 - depth, up_a, up_b, 1, leaves, saved))
        yield children, leaves, saved


def turns_in_order(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, role, text), pos from 1."""
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "role", "text")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, size) of every conversation and its turns (conv_id, pos, size, x1, x2, bytes) after the first ones
    of its family's first conversation have taken the place of its own."""
    said = [F.xxhash64(F.lit(n), "role", "text").alias(f"t{n}") for n in (1, 2)]
    hashed = materialize(turns.select("conv_id", "pos", *said, F.octet_length("text").cast("bigint").alias("bytes")), "turns")
    sizes = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    named = sizes.select("conv_id", "n", first.alias("first"), heads.alias("h"))
    theirs = sizes.where(first == F.col("conv_id")).select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    plan = materialize(named.join(theirs, "first", "left").withColumn("taken", F.least("h", F.coalesce("first_n", F.lit(0))))
                       .withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt")
    own = (hashed.join(plan.select("conv_id", "h", "taken", "size"), "conv_id").where("pos > h")
           .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "size", "t1", "t2", "bytes"))
    heads_of = hashed.where((first == F.col("conv_id")) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "first")
    lent = (heads_of.join(plan.where("taken > 0").select("first", F.col("conv_id"), "taken", "size"), "first").where("pos <= taken")
            .select("conv_id", "pos", "size", "t1", "t2", "bytes"))

    def salted(n: int) -> Column:
        return F.xxhash64(F.lit(n), "pos", f"t{n}")

    return plan.select("conv_id", "size"), own.unionByName(lent).select("conv_id", "pos", "size", salted(1).alias("x1"), salted(2).alias("x2"), "bytes")


def _limit(rows: int, limit: int | None) -> int:
    return max(LIMIT, rows // TOP) if limit is None else limit


def nodes(turns: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes but for the root, and their (node, member) rows.

    (k1, k2, p1, p2, depth, conv_id, n_convs, bytes, shard): ``shard`` names the subtree below the top tree, null in it."""
    path = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keyed = turns.select("conv_id", "pos", "size", "bytes", "x1", "x2", F.bit_xor("x1").over(path).alias("k1"), F.bit_xor("x2").over(path).alias("k2"))
    rows = materialize(keyed.select("conv_id", "pos", "size", "bytes", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"),
                                    F.col("k2").bitwiseXOR(F.col("x2")).alias("p2")), "trie-rows")
    found = rows.groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("pos").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.sum(F.col("size") - F.col("pos")).alias("below"))
    found = materialize(found, "trie-nodes")
    limit = _limit(found.agg(F.sum("n_convs")).first()[0] or 0, limit)
    # The conversation that names a node passes through all nodes above it: its deepest node of the top
    # tree says where the node's subtree begins.
    top = found.where(F.col("below") > limit).select("k1", "k2")
    deepest = rows.join(top, ["k1", "k2"], "left_semi").groupBy("conv_id").agg(F.max("pos").alias("deepest"))
    begins = (rows.select("conv_id", "pos", "k1", "k2").join(deepest, "conv_id", "left").where(F.col("pos") == F.coalesce("deepest", F.lit(0)) + 1)
              .select("conv_id", F.col("pos").alias("begin"), F.struct("k1", "k2").alias("root")))
    placed = found.join(begins, "conv_id", "left").select(
        *[c for c in found.columns if c != "below"], F.when((F.col("below") <= limit) & (F.col("depth") >= F.col("begin")), F.col("root")).alias("shard"),
        (F.coalesce(F.col("depth") == F.col("begin"), F.lit(False)) & (F.col("below") <= limit)).alias("shard_root"))
    return materialize(placed, "trie-placed"), rows


IN = ["depth", "k1", "k2", "p1", "p2", "own", "in_children", "in_leaves", "in_saved"]
OUT = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, shard_root boolean"


def totals(placed: DataFrame, queue: int = QUEUE) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens; each partition holds whole subtrees, sorted by reverse level order."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for b in batches:
            found = list(forward(zip(*[b.column(c).to_pylist() for c in [*IN, "shard_root"]]), waiting))
            if found:
                more = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([*b.columns[:5], b.column("conv_id"), b.column("n_convs"), *more, b.column("shard_root")],
                                                 names=[c.split()[0] for c in OUT.split(", ")])

    sorted_ = placed.sortWithinPartitions(F.desc("depth"), "k1", "k2").select(*IN, "conv_id", "n_convs", "shard_root")
    return map_arrow(sorted_, of, OUT)


def _own(df: DataFrame) -> DataFrame:
    """With the saving of the node itself; nothing has come from elsewhere yet."""
    return df.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes"))


def ends(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes in which conversations end; ``rows``: k1, k2, conv_id."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, size = None, 0, [], 0
        out: list[tuple] = []
        for b in batches:
            for a, k, c in zip(*[x.to_pylist() for x in b.columns]):
                if (a, k) != now or size > chunk:
                    if ids:
                        out.append((*now, first, ",".join(ids)))
                    now, first, ids, size = (a, k), c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if len(out) > 200:
                yield made(out)
                out = []
        if ids:
            out.append((*now, first, ",".join(ids)))
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["k1", "k2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            out = []
            for a, k, ids in zip(*[x.to_pylist() for x in b.columns]):
                if (a, k) == now:
                    state.update(b",")
                else:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = (a, k), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["k1", "k2", "ends_sha256"])
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names=["k1", "k2", "ends_sha256"])

    by_range = rows.select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    chunks = materialize(map_arrow(by_range, joined, "k1 long, k2 long, first long, ids string"), "end-chunks")
    by_node = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
    return map_arrow(by_node, hashed, "k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, limit: int | None = None, queue: int = QUEUE, chunk: int = CHUNK, **columns: str) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    sizes, turns = rebuilt(turns_in_order(conversations, **columns))
    placed, rows = nodes(turns, limit)
    zero = F.lit(0).cast("bigint")
    none = {c: zero for c in IN[6:]}
    below = _own(placed.where(F.col("shard").isNotNull())).withColumns(none).repartition("shard")
    low = materialize(totals(below, queue), "trie-shards")
    # The top tree: few nodes, with the totals of the shard roots that hang from them.
    sent = low.where("shard_root").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("in_children"), F.sum("n_leaves").alias("in_leaves"),
                                                          F.sum("saved_tokens").alias("in_saved"))
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in ("k1", "k2")], *[zero.alias(c) for c in ("p1", "p2")], zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"))
    high = placed.where(F.col("shard").isNull()).select(*root.columns).unionByName(root)
    high = _own(high).join(sent.withColumnsRenamed({"p1": "k1", "p2": "k2"}), ["k1", "k2"], "left")
    high = high.fillna(0, IN[6:]).withColumn("shard_root", F.col("depth") == 0).repartition(1)
    every = materialize(low.unionByName(totals(high, queue)), "trie-totals")
    ended = rows.where("pos = size").select("k1", "k2", "conv_id").unionByName(sizes.where("size = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    parents = every.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    named = every.join(parents, ["p1", "p2"], "left").join(ends(ended, chunk), ["k1", "k2"], "left")
    return named.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"))


SQL = rf"""
with crc_table as ({crc32_table_sql()}),
o as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as said from conversations where conv_id is not null),
l as (select conv_id, list(said order by pos) as ts from o group by conv_id),
h as (select conv_id, ts, conv_id - conv_id % {FAMILY} as first, {crc32_sql('conv_id::varchar')} % {HEADS} as h from l, crc_table),
r as (select h.conv_id, list_concat(coalesce(f.ts[1:h.h], []), h.ts[h.h + 1:]) as ts from h left join l f on f.conv_id = h.first),
e as (select conv_id, len(ts) as size, unnest(range(len(ts) + 1)) as depth, ts from r),
m as (select conv_id, size, depth, ts[1:depth] as path from e),
n as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = depth), '')) as ends_sha256 from m group by path, depth),
k as (select path[1:depth - 1] as path, count(*) as c from n where depth > 0 group by all),
g as (select n.*, coalesce(k.c, 0) as n_children, case when depth > 0 then (n_convs - 1) * octet_length(encode(n.path[depth].text)) else 0 end as own
  from n left join k using (path)),
a as (select path[1:d] as path, own, n_children from (select *, unnest(range(depth + 1)) as d from g)),
t as (select path, count(*) filter (where n_children = 0) as n_leaves, sum(own)::bigint as saved_tokens from a group by path)
select g.conv_id, g.depth, p.conv_id as parent_conv_id, g.n_convs, g.n_children, t.n_leaves, t.saved_tokens, g.ends_sha256
from g join t using (path) left join g p on g.depth > 0 and p.path = g.path[1:g.depth - 1]
"""
