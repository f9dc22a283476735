"""Conversation prefix trie with subtree totals by time-forward processing.

A node is a distinct beginning of conversations: the first d turns (role, text). Its key is the depth and two
polynomial sums of the turns' hashes (64 bits, and 31 modulo a prime), so keys of all beginnings of a conversation come from
one running sum. Rows lie in ranges of (conversation, turn); a conversation of any length spreads over partitions,
and a second pass adds what the partitions before hold of it.

The trie is cut into paths: the member whose hashed id is least represents a node, and the nodes with one representative
are a piece of that conversation's path. Going down, the representative changes about ln(conversations) times at most on
average, whatever the trie's shape. Shards are bands of paths, ``BAND`` levels each, dealt by hash.

1. Within shards: nodes are externally sorted by reverse level order. A node takes the messages to it from a
   spilling priority queue, adds its own value, and sends the total to its parent, forward in time.
2. Across shard roots: a path's total goes to the node of every path above it where the conversation leaves that path, summed by
   that node; totals of a path's lower bands go to the last node of the band above.
3. What has come from other shards moves up, by the same processing, in those shards that have received something.

No step holds a path, a subtree or a group of copies in memory: groups are counted within tasks first, and members' ids are
joined in chunks and hashed in order as a stream.

Defined cases: turns are ordered by turn (null first), then by role and text; repeated rows are turns one after
the other; null role or text is empty; rows without conv_id belong to no conversation; extra columns are ignored; an
empty table has no nodes. Ids may be negative; ``c % 100`` has the sign of c, as in SQL.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.session import cut_lineage

BAND = 1 << 16  # levels of a path in one shard
QUEUE = 1 << 18  # messages in memory before a queue spills
IDS = 12  # bits of the ids that share a chunk of members
FAMILY, SHARED = 100, 6  # the contract's rebuilding: conversations of a family, and the modulus of shared turns

_PRIME = (1 << 31) - 1
_BASES = (0x9E3779B97F4A7C15, 1_103_515_245)
_LOW = 12


# ---- running sums over sorted rows --------------------------------------------------------------------------------
class _Powers:
    """Powers of the two bases for arrays of positions: a table of low bits times a few high ones."""

    def __init__(self, base: int, mod: int):
        self.base, self.mod = base, mod
        self.low = np.array([pow(base, i, mod) for i in range(1 << _LOW)], np.uint64)

    def of(self, positions: np.ndarray) -> np.ndarray:
        high, where = np.unique(positions >> _LOW, return_inverse=True)
        up = np.array([pow(self.base, int(h) << _LOW, self.mod) for h in high], np.uint64)
        out = up[where] * self.low[positions & ((1 << _LOW) - 1)]
        return out if self.mod == 1 << 64 else out % np.uint64(self.mod)


class _State:
    """What a task knows of the conversation at hand: turns so far and the two sums."""

    def __init__(self, conv=None, count=0, s=0, t=0):
        self.conv, self.count, self.s, self.t = conv, count, s, t

    def then(self, other: "_State") -> "_State":
        """This state followed by one that was counted from 0."""
        s = (self.s + pow(_BASES[0], self.count, 1 << 64) * other.s) % (1 << 64)
        t = (self.t + pow(_BASES[1], self.count, _PRIME) * other.t) % _PRIME
        return _State(other.conv, self.count + other.count, s, t)


def _advance(batch: pa.RecordBatch, state: _State, powers) -> tuple[dict, _State]:
    """Running values of a batch's rows, after ``state``, and the state behind them."""
    conv = batch.column("conv_id").to_numpy()
    n, a, b = (batch.column(c).to_numpy() for c in ("n", "a", "b"))
    heads = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
    sizes = np.diff(heads, append=len(conv))
    follows = state.conv is not None and state.conv == conv[0]
    start = state if follows else _State()

    def running(values: np.ndarray, carry: int) -> np.ndarray:
        total = np.cumsum(values)
        base = np.concatenate([[values.dtype.type(0)], total])[heads]
        base[:1] -= np.array([carry], values.dtype)
        return total - np.repeat(base, sizes)

    d = running(n, start.count)
    ps, pt = powers
    u, p = a.view(np.uint64), np.uint64(_PRIME)
    s = running(u * ps.of(d), start.s)
    t = running((b.view(np.uint64) >> np.uint64(33)) * pt.of(d) % p, start.t) % p
    # The beginning one turn shorter.
    return {"d": d, "s": s.view(np.int64), "t": t.astype(np.int64), "ps": (s - u * ps.of(d)).view(np.int64),
            "pt": ((t + p - (b.view(np.uint64) >> np.uint64(33)) * pt.of(d) % p) % p).astype(np.int64)}, _State(
                int(conv[-1]), int(d[-1]), int(s[-1]), int(t[-1]))


def _tables() -> tuple[_Powers, _Powers]:
    return _Powers(_BASES[0], 1 << 64), _Powers(_BASES[1], _PRIME)


def running(rows: DataFrame, order: list[Column], *unused: str) -> DataFrame:
    """``rows`` (conv_id, n, a, b, ...) with d, the turns of the conversation up to the row (n each), and the sums s and t.

    ps and pt are the sums without the row's turn. Columns ``unused`` only order the rows. One state for each partition
    reaches the driver.
    """
    spark = rows.sparkSession
    keys = [F.col("conv_id"), *order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()).drop(*unused))

    def summary(batches):
        powers, state, first, part = _tables(), _State(), None, None
        for b in batches:
            if b.num_rows:
                part, first = (b.column("part")[0].as_py(), b.column("conv_id")[0].as_py()) if part is None else (part, first)
                state = _advance(b, state, powers)[1]
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, first, state.conv, state.count)] + [pa.array([str(state.s)]), pa.array([state.t])],
                                             names=["part", "first", "last", "count", "s", "t"])

    states = placed.select("conv_id", "n", "a", "b", "part").mapInArrow(summary, "part bigint, first bigint, last bigint, count bigint, s string, t bigint")
    carried, before = {}, _State()
    for r in sorted(states.collect(), key=lambda r: r["part"]):  # one row for each partition
        own = _State(r["last"], r["count"], int(r["s"]), r["t"])
        if before.conv == r["first"]:
            carried[r["part"]] = (before.conv, before.count, before.s, before.t)
            own = before.then(own) if r["last"] == r["first"] else own
        before = own
    known = spark.sparkContext.broadcast(carried)

    def finish(batches):
        powers, state = _tables(), None
        for b in batches:
            if not b.num_rows:
                continue
            if state is None:
                state = _State(*known.value.get(b.column("part")[0].as_py(), ()))
            got, state = _advance(b, state, powers)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(v) for v in got.values())], names=[*b.schema.names, *got])

    new = "d bigint, s bigint, t bigint, ps bigint, pt bigint"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return placed.mapInArrow(finish, f"{schema}, {new}").drop("part")


# ---- turns --------------------------------------------------------------------------------------------------------
def turn_hash(role: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes of a turn."""
    return [F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b")]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, chars): every turn as its hashes and length, numbered from 1 in its conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", role, text)
    same = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))  # repeated rows shrink within tasks
    hashed = same.select("*", *turn_hash(F.col("role"), F.col("text")), F.length("text").cast("bigint").alias("chars"))
    return running(hashed, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turn", "role", "text").select("conv_id", F.explode(F.sequence(F.col("d") - F.col("n") + 1, F.col("d"))).alias("pos"), "a", "b", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The contract's conversations: the first h turns of conversation c - c % 100, then c's own after its first h; part 0 and 1."""
    shared = lambda c: F.crc32(c.cast("string").cast("binary")) % SHARED
    family = lambda c: c - c % FAMILY
    c = F.col("conv_id")
    heads = turns.where((c % FAMILY == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "family")
    # At most FAMILY conversations ask for the few first turns of one.
    first = (turns.where("pos = 1").select("conv_id", family(c).alias("family")).join(heads, "family")
             .where(F.col("pos") <= shared(c)).select("conv_id", F.lit(0).alias("part_no"), "pos", "a", "b", "chars"))
    own = turns.where(F.col("pos") > shared(c)).select("conv_id", F.lit(1).alias("part_no"), "pos", "a", "b", "chars")
    return first.unionByName(own)


def memberships(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, d, s, t, ps, pt, a, b, chars): each conversation's nodes, the root included."""
    rows = running(turns.withColumn("n", F.lit(1).cast("bigint")), [F.col("part_no"), F.col("pos")])
    zero = F.lit(0).cast("bigint")
    root = convs.select("conv_id", *[zero.alias(x) for x in ("d", "s", "t")], *[F.lit(None).cast("bigint").alias(x) for x in ("ps", "pt", "a", "b")], zero.alias("chars"))
    return rows.select(*root.columns).unionByName(root)


# ---- time-forward processing ----------------------------------------------------------------------------------------
class SpillingQueue:
    """A priority queue of integer tuples whose later part moves to sorted runs on disk when it has more than ``limit`` items."""

    def __init__(self, width: int, limit: int = QUEUE):
        self.heap, self.width, self.limit, self.runs = [], width, limit, []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            kept = self.limit // 4
            file = tempfile.TemporaryFile()  # no name: it goes with the task
            np.array(self.heap[kept:], np.int64).tofile(file)
            file.seek(0)
            del self.heap[kept:]
            run = self._read(file)
            heapq.heappush(self.runs, (next(run), len(self.runs), run))

    def _read(self, file) -> Iterator[tuple]:
        while True:
            block = np.frombuffer(file.read(8 * self.width * 4096), np.int64).reshape(-1, self.width)
            if not len(block):
                file.close()
                return
            yield from map(tuple, block.tolist())

    def pop_until(self, key: tuple) -> Iterator[tuple]:
        """Takes out, in order, the items that begin with ``key`` or less."""
        k = len(key)
        while True:
            memory, disk = bool(self.heap and self.heap[0][:k] <= key), bool(self.runs and self.runs[0][0][:k] <= key)
            if memory and not (disk and self.runs[0][0] < self.heap[0]):
                yield heapq.heappop(self.heap)
            elif disk:
                item, i, run = self.runs[0]
                following = next(run, None)
                if following is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (following, i, run))
                yield item
            else:
                return


def _forward(limit: int):
    """Arrow function over rows (rep, d, node, top, leaves, saved, ...) by descending d, then rep: subtree totals within the shard.

    Rows with node = 0 are messages from other shards to the node after them.
    """
    def run(batches):
        queue = SpillingQueue(4, limit)
        for b in batches:
            rep, d, node, top, leaves, saved = (b.column(c).to_pylist() for c in ("rep", "d", "node", "top", "leaves", "saved"))
            for i in range(len(rep)):
                key = (-d[i], rep[i])
                if not node[i]:
                    queue.push((*key, leaves[i], saved[i]))
                    continue
                for _, _, x, y in queue.pop_until(key):
                    leaves[i] += x
                    saved[i] += y
                if not top[i]:
                    queue.push((1 - d[i], rep[i], leaves[i], saved[i]))
            new = {"leaves": pa.array(leaves, pa.int64()), "saved": pa.array(saved, pa.int64())}
            out = pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names)
            yield out.filter(pa.array([x == 1 for x in node], pa.bool_()))

    return run


def within_shards(rows: DataFrame, limit: int = QUEUE) -> DataFrame:
    """Totals of every node over the nodes below it in its shard; ``rows`` may hold messages."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "rep", F.floor(F.col("d") / BAND)).sortWithinPartitions(F.desc("d"), "rep", "node")
    return dealt.mapInArrow(_forward(limit), dealt.schema)


def _across(tops: DataFrame, leaves_path: DataFrame) -> DataFrame:
    """(rep, d, leaves, saved): what other shards send to each node.

    ``tops`` are the shard roots with their totals; ``leaves_path`` holds, for each conversation and each path above its own, the last common d.
    """
    total = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    paths = tops.groupBy("rep").agg(*total)
    from_paths = leaves_path.join(paths.withColumnRenamed("rep", "conv_id"), "conv_id").groupBy("rep", "d").agg(*total)
    # Lower bands of the same path: one row for each band.
    band = F.floor(F.col("d") / BAND).alias("band")
    bands = (tops.select("rep", band, "leaves", "saved").unionByName(from_paths.select("rep", band, "leaves", "saved"))
             .groupBy("rep", "band").agg(*total))
    below = Window.partitionBy("rep").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    carried = bands.select("rep", ((F.col("band") + 1) * BAND - 1).alias("d"), *[F.sum(c).over(below).alias(c) for c in ("leaves", "saved")]).where("leaves is not null")
    return from_paths.unionByName(carried).groupBy("rep", "d").agg(*total)


NODE = ["d", "s", "t"]


def trie(turns: DataFrame, convs: DataFrame, limit: int = QUEUE) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the conversations ``convs`` with ``turns`` (conv_id, part_no, pos, a, b, chars).

    Nodes: key d, s, t; conv_id (least member), parent_conv_id, n_convs, n_children, n_leaves, saved (characters of turns that
    sharing saves) and the hashes a, b of the last turn. Ends: conv_id and the key of its last node.
    """
    members = cut_lineage(memberships(turns, convs))
    first = F.min(F.struct(F.xxhash64("conv_id"), "conv_id"))["conv_id"]
    found = cut_lineage(members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), first.alias("rep"), *[F.min(c).alias(c) for c in ("chars", "ps", "pt", "a", "b")]))
    children = found.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("ps").alias("s"), F.col("pt").alias("t")).agg(F.count(F.lit(1)).alias("n_children"))
    above = found.select((F.col("d") + 1).alias("d"), F.col("s").alias("ps"), F.col("t").alias("pt"), F.col("conv_id").alias("parent_conv_id"), F.col("rep").alias("up"))
    n_children = F.coalesce(F.col("n_children"), F.lit(0).cast("bigint"))
    nodes = found.join(children, NODE, "left").join(above, ["d", "ps", "pt"], "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", n_children.alias("n_children"), "a", "b", "rep", F.lit(1).alias("node"),
        (F.col("up").isNull() | (F.col("up") != F.col("rep")) | (F.col("d") % BAND == 0)).alias("top"),
        (n_children == 0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    local = cut_lineage(within_shards(nodes, limit))
    leaves_path = members.join(found.select(*NODE, "rep"), NODE).where("rep <> conv_id").groupBy("conv_id", "rep").agg(F.max("d").alias("d"))
    sent = cut_lineage(_across(local.where("top").select("rep", "d", "leaves", "saved"), leaves_path))
    # Shards that have received something, without their own values.
    band = F.floor(F.col("d") / BAND).alias("band")
    reached = local.select("rep", "d", "top", F.lit(1).alias("node"), F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"), band).join(
        sent.select("rep", band).distinct(), ["rep", "band"], "left_semi").drop("band")
    moved = within_shards(reached.unionByName(sent.select("*", F.lit(0).alias("node"), F.lit(False).alias("top"))), limit)
    more = moved.select("rep", "d", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    zero = F.lit(0).cast("bigint")
    done = local.join(more, ["rep", "d"], "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "a", "b", (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"))
    last = F.max_by(F.struct("d", "s", "t"), "d")
    return done, members.groupBy("conv_id").agg(last.alias("k")).select("conv_id", "k.*")


def conversation_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of the conversations as they are; ``with_turns`` adds each node's last turn."""
    turns = cut_lineage(ordered_turns(conversations))
    return trie(turns.withColumn("part_no", F.lit(0)), turns.where("pos = 1").select("conv_id"))


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with role and text of the last turn (null at the root)."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    said = conversations.select(role, text).select(*turn_hash(F.col("role"), F.col("text")), "role", "text")
    return nodes.join(said.groupBy("a", "b").agg(F.min("role").alias("role"), F.min("text").alias("text")), ["a", "b"], "left")


def members_digest(ends: DataFrame) -> DataFrame:
    """(d, s, t, ends_sha256): SHA-256 of the ids that end at a node, in order, joined by commas.

    Ids are joined in chunks of at most 2^IDS first; a node's chunks pass its task as a stream.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunked = ends.groupBy(*NODE, F.shiftright("conv_id", IDS).alias("chunk")).agg(ids.alias("ids"))

    def run(batches):
        key, digest = None, None
        for b in batches:
            out = []
            for d, s, t, ids in zip(*(b.column(c).to_pylist() for c in (*NODE, "ids"))):
                if (d, s, t) == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (d, s, t), hashlib.sha256()
                digest.update(ids.encode())
            if out:
                yield _digests(out)
        if key is not None:
            yield _digests([(*key, digest.hexdigest())])

    return chunked.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").mapInArrow(run, "d bigint, s bigint, t bigint, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*NODE, "ends_sha256"])


def report(conversations: DataFrame) -> DataFrame:
    turns = cut_lineage(ordered_turns(conversations))
    nodes, ends = trie(rebuilt(turns), turns.where("pos = 1").select("conv_id"))
    none = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(members_digest(ends), NODE, "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
