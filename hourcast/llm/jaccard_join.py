"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; two link when ``100 * |x and y| >= share * |x or y|``. Documents with the
same set are one class, so copies never meet. The join is exact:

1. Hot shingles: the most frequent shingles (at most ``HOT``, a broadcast of fixed size) come last in one
   global order of all shingles; the others are ordered by fingerprint. Any such order gives right results;
   this one keeps passages that many documents share out of most prefixes.
2. Prefixes: linked sets share a shingle among the first ``n - ceil(share * n) + 1`` of each. Only these are
   shuffled, packed by bucket; a bucket keeps the shingles that two classes of fitting sizes or more have. A class
   whose shared shingles can't add up to what any of these sizes requires is done.
   The list of a very common shingle is dealt to several buckets.
3. Groups: a class joins the leader with which it shares most of them. A group is cut into blocks of about
   ``BLOCK`` classes, or ``GROUP_SHINGLES`` shingles, of one leader and size class: the columns of the token-group matrix.
4. Hub round: in each leader's group all classes are held against one block. What links there is settled,
   which leaves large groups of near copies with a few components.
5. Exact round: a class is a query to every block with which it shares enough prefix shingles to reach the
   required overlap with any set of the block's sizes, unless both are one component already. A task opens a
   block: it counts how many of the query's shingles lie in the block's union, drops the query when that
   bound is too small, and otherwise takes its exact overlap with the block's members.

Links are emitted as a spanning forest of each block (never all pairs); components come from star rounds. No
candidate is capped: a block with many queries is served by several tasks.

Defined cases: null, empty and wordless texts have an empty set and link with nothing. A text with fewer words
than a shingle has the whole sequence as its only shingle. Repeated rows and null ids are documents like any
other; the component is the least non-null ``doc_id``. Further columns are ignored by ``components`` and kept
by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.components import connected
from hourcast.llm.keyfilter import KeyFilter, hit, maybe_in
from hourcast.llm.spill import bucket_keys, forget, group_starts, pack, packed_batch, unpack
from hourcast.llm.textbatch import (SPACE_WORDS, Rolling, by_document, chunks, documents, free_name, give_back, lower_ascii, mix, row_key, utf8,
                                    word_hashes, word_spans)
from hourcast.session import cut_lineage

WORDS = 5
SHARE = 80  # percent
HOT = 1 << 16  # shingles that come last in the order: 0.5 MB
BLOCK = 256  # classes in a block
QUERIES = 1024  # queries that one task holds against a block
GROUP_SHINGLES = 1 << 21  # of a block's classes, and of the queries that one task holds against it: 16 MB each
SPLIT = 1 << 18  # classes from which on a hot shingle's list is dealt to several buckets
_FLUSH = 1 << 19  # shingles that a task gathers before it passes them on
_CLASS = 12  # bytes of a class id: 4 of the set's size, big-endian, and 8 of its hash

# A prefix shingle of a class: 48 bits of the shingle (a collision only adds a candidate), and the class.
_POSTING = np.dtype([("token", "<u4"), ("token2", "<u2"), ("cls", f"S{_CLASS}")])


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def shingle_sets(part: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text of a batch."""
    data, offsets = utf8(part.column("text"))
    data = lower_ascii(data)
    starts, ends, doc = word_spans(data, offsets, SPACE_WORDS)
    roll = Rolling(word_hashes(data, starts, ends))
    bounds = by_document(doc, part.num_rows)
    at = np.arange(max(0, len(starts) - words + 1))
    full = roll.spans(at, at + words)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= words:
            out.append(np.unique(full[lo:hi - words + 1]))
        else:
            out.append(roll.spans(np.array([lo]), np.array([hi])) if hi > lo else np.zeros(0, np.uint64))
    return out


def _class(x: np.ndarray) -> bytes:
    """Class id of a set. It never ends in a zero byte, which numpy would cut from a byte string."""
    d = bytearray(hashlib.blake2b(x.tobytes(), digest_size=_CLASS - 4).digest())
    d[-1] |= 1
    return min(len(x), (1 << 32) - 1).to_bytes(4, "big") + bytes(d)


def _sizes(cls: np.ndarray) -> np.ndarray:
    return np.frombuffer(np.ascontiguousarray(cls).tobytes(), np.uint8).reshape(-1, _CLASS)[:, :4].copy().view(">u4").ravel().astype(np.int64)


def _size_of(cls: str):
    return F.conv(F.hex(F.substring(cls, 1, 4)), 16, 10).cast("bigint")


def class_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, row_key, n_shingles and cls (null for an empty set) for every row."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part, words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([_class(x) if len(x) else None for x in sets], pa.binary())],
                    names=["doc_id", "row_key", "n_shingles", "cls"])

    return documents(docs).withColumn("row_key", row_key()).mapInArrow(
        run, "doc_id bigint, row_key bigint, n_shingles bigint, cls binary")


class Hot(np.ndarray):
    """Sorted shingles; ``counts`` holds how often each was seen, where that is known."""

    counts: np.ndarray | None = None


def hot_shingles(docs: DataFrame, words: int = WORDS, limit: int = HOT) -> np.ndarray:
    """Shingles that are frequent within tasks, the most frequent ``limit`` of them, with their counts. Which ones they
    are touches the order of shingles and the dealing of lists only, and with it the speed, never the result."""

    def run(batches):
        seen, held, n = set(), [], 0

        def flush():
            tokens, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= 3
            return pa.RecordBatch.from_arrays([pa.array(tokens[keep].astype(np.int64)), pa.array(count[keep].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for part in chunks(batch):
                for x in shingle_sets(part, words):
                    c = hash(x.tobytes())
                    if len(x) and c not in seen:
                        seen.add(c)
                        held.append(x)
                        n += len(x)
                if n >= 2 * _FLUSH:
                    yield flush()
                    seen, held, n = set(), [], 0
        if held:
            yield flush()

    top = (documents(docs).mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(limit))
    rows = top.collect()
    tokens, n = np.array([r["token"] for r in rows], np.int64).astype(np.uint64), np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(tokens)
    hot = tokens[order].view(Hot)
    hot.counts = n[order]
    return hot


def _ordered(x: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return x
    place = np.minimum(np.searchsorted(hot, x), len(hot) - 1)
    is_hot = hot[place] == x
    return np.concatenate([x[~is_hot], x[is_hot]]) if is_hot.any() else x


def shared_prefixes(docs: DataFrame, hot: np.ndarray, words: int = WORDS, share: int = SHARE,
                    split: int | None = None) -> DataFrame:
    """(token, cls, leader): prefix shingles that a class shares with another one of a size it could link with.

    Each shingle has one representative class; a class's leader represents most of its shingles. Rows of a class
    whose shingles can't add up to the number that a link with any of these sizes takes are left out.

    The list of a hot shingle (seen ``split`` times or more) is dealt to several buckets by class, so no task gets it whole. There
    the shingle itself is the representative, and the least requirement of any size that could link is taken.
    """
    keys = bucket_keys(docs, bucket_bytes=8 << 20, per_partition=4)  # a list takes several times its bytes while it is settled
    context = docs.sparkSession.sparkContext
    hot_value = context.broadcast(np.asarray(hot))  # at most HOT values
    counts, split = getattr(hot, "counts", None), split or SPLIT
    dealt = {} if counts is None else {int(t) >> 16: int(_ceil(int(n), split)) for t, n in zip(hot, counts) if n >= split}
    split_value = context.broadcast((np.array(sorted(dealt), np.uint64), np.array([dealt[t] for t in sorted(dealt)], np.uint64)))  # at most HOT

    def post(batches):
        seen, tokens, classes, n = set(), [], [], 0

        def flush():
            rec, token = np.empty(n, _POSTING), np.concatenate(tokens) >> np.uint64(16)
            rec["token"], rec["token2"] = token & np.uint64(0xFFFFFFFF), token >> np.uint64(32)
            rec["cls"] = np.repeat(np.array([c for c, _ in classes]), [k for _, k in classes])
            lists, parts = split_value.value
            if len(lists):
                at = np.minimum(np.searchsorted(lists, token), len(lists) - 1)
                many = np.flatnonzero(lists[at] == token)
                own = np.frombuffer(np.ascontiguousarray(rec["cls"][many]).tobytes(), np.uint8).reshape(-1, _CLASS)[:, 4:].copy().view("<u8").ravel()
                token[many] = mix(token[many] * np.uint64(31) + own % parts[at[many]])
            return packed_batch(list(pack(token, rec, keys)))

        for batch in batches:
            for part in chunks(batch):
                for x in shingle_sets(part, words):
                    if not len(x) or (c := _class(x)) in seen:
                        continue
                    seen.add(c)
                    k = len(x) - _ceil(share * len(x), 100) + 1
                    tokens.append(_ordered(x, hot_value.value)[:k])
                    classes.append((c, k))
                    n += k
                if n >= _FLUSH:
                    yield flush()
                    tokens, classes, n = [], [], 0
        if n:
            yield flush()

    def settle(table: pa.Table) -> pa.Table:
        rec = unpack(table, _POSTING)
        token = rec["token"].astype(np.int64) | rec["token2"].astype(np.int64) << 32
        order = np.argsort(token, kind="stable")
        token = token[order]
        dealt = lambda t: np.isin(t, split_value.value[0].astype(np.int64))
        many = _repeated(token) | dealt(token)
        token, cls = token[many], rec["cls"][order][many]
        order = np.lexsort((cls, token))
        token, cls = token[order], cls[order]
        one = group_starts(token, cls)  # a class that several tasks have posted counts once
        many = _repeated(token[one]) | dealt(token[one])
        token, cls = token[one][many], cls[one][many]
        if not len(token):
            return pa.table({"token": pa.array([], pa.int64()), "cls": pa.array([], pa.binary()), "rep": pa.array([], pa.binary()), "need": pa.array([], pa.int32())})
        # Each list is in order of size. A link with any of its classes takes least with the smallest or largest
        # one that x could link with.
        n, at = _sizes(cls), np.arange(len(token))
        key = (np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) << 32) + n
        low = np.searchsorted(key, key - n + -(-share * n // 100), side="left")
        high = np.searchsorted(key, key - n + 100 * n // share, side="right") - 1
        ok = low < high  # x itself lies between them
        smallest, largest = np.where(low == at, np.minimum(at + 1, high), low), np.where(high == at, np.maximum(at - 1, low), high)
        need = np.minimum(_need(share, n, n[smallest]), _need(share, n, n[largest]))
        own = cls.view(np.uint8).reshape(-1, _CLASS)[:, 4:].copy().view(">u8").ravel()
        order = np.lexsort((own, token))
        first = group_starts(token)
        rep = np.repeat(cls[order][first], np.diff(np.append(first, len(token))))
        part = dealt(token)
        if part.any():
            ok |= part
            need = np.where(part, np.minimum(_need(share, n, -(-share * n // 100)), _need(share, n, 100 * n // share)), need)
            stand = np.zeros((int(part.sum()), _CLASS), np.uint8)
            stand[:, 3:_CLASS - 1] = token[part].astype("<u8").view(np.uint8).reshape(-1, 8)
            stand[:, -1] = 1
            rep[part] = np.frombuffer(stand.tobytes(), f"S{_CLASS}")
        return pa.table({"token": pa.array(token[ok]), "cls": pa.array(cls[ok].tolist(), pa.binary()), "rep": pa.array(rep[ok].tolist(), pa.binary()),
                         "need": pa.array(np.maximum(need[ok] - 1, 1).astype(np.int32))})

    packed = documents(docs).mapInArrow(post, "bucket int, cell binary")
    lists = packed.repartition(len(keys), "bucket").groupBy("bucket").applyInArrow(settle, "token bigint, cls binary, rep binary, need int")
    # A link of x that takes k shingles shows k rows of x with a need of k or less.
    own = Window.partitionBy("cls")
    lists = lists.withColumn("needs", F.sort_array(F.collect_list("need").over(own)))
    lists = lists.where(F.exists(F.transform("needs", lambda v, i: v <= i + 1), lambda v: v)).drop("needs", "need")
    lists = lists.withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("cls", "rep")))
    return lists.withColumn("leader", F.max(F.struct("same", "rep")).over(own)["rep"]).select("token", "cls", "leader")


def _need(share: int, n, m):
    """Least number of shared prefix shingles of linked sets of n and m shingles, whichever prefix ends first."""
    both = -(-share * (n + m) // (100 + share))
    return np.minimum(1 - -(-share * n // 100), 1 - -(-share * m // 100)) + both


def _repeated(token: np.ndarray) -> np.ndarray:
    """Which of the sorted tokens stand there twice or more."""
    same = token[1:] == token[:-1]
    out = np.zeros(len(token), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def class_sets(docs: DataFrame, table: DataFrame, info: DataFrame, words: int = WORDS) -> DataFrame:
    """``info`` (one row for each wanted cls) with the classes' sets; ``table`` is the class_table of ``docs``.

    One document stands for a class. A bit filter picks the documents whose set is shuffled; the join is exact.
    """
    one = table.where("cls is not null").groupBy("cls").agg(F.min(F.struct("doc_id", "row_key")).alias("r"))  # copies shrink within tasks
    stand = one.join(info.select("cls"), "cls", "left_semi").select("r.doc_id", "r.row_key")
    maybe = KeyFilter(cut_lineage(stand), "doc_id", "row_key")
    mask = maybe.mask

    def run(batches):
        seen = set()
        for batch in batches:
            batch = batch.filter(pa.array(hit(mask.value, batch.column("slot").to_numpy())))
            for part in chunks(batch):
                out = {_class(x): x.tobytes() for x in shingle_sets(part, words) if len(x)}
                new = [c for c in out if c not in seen]
                seen.update(new)
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), pa.array([out[c] for c in new], pa.binary())], names=["cls", "set"])

    rows = docs.select("text", maybe.slot("doc_id", row_key()).alias("slot"))
    sets = rows.mapInArrow(run, "cls binary, set binary")
    return sets.join(info, "cls").dropDuplicates(["cls"])


def _open(rows: DataFrame, share: int) -> DataFrame:
    """Spanning links (a, b) of each (block, salt). rows: block, salt, member (else query), within, cls, comp, n, set.

    ``within`` marks members that are held against each other as well.
    """

    def run(table: pa.Table) -> pa.Table:
        t = table.to_pydict()
        # A class that stands here as a member is no second time a query.
        at_of = {}
        for i in sorted(range(len(t["cls"])), key=lambda i: not t["member"][i]):
            at_of.setdefault(t["cls"][i], i)
        rows_ = list(at_of.values())
        members = [i for i in rows_ if t["member"][i]]
        sets = {i: np.frombuffer(t["set"][i], np.uint64) for i in rows_}
        parent: dict[bytes, bytes] = {}

        def root(c):
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        a, b = [], []
        if members:
            # The block's column of the token-group matrix: its union, and who has each shingle.
            token = np.concatenate([sets[i] for i in members])
            owner = np.repeat(np.arange(len(members)), [len(sets[i]) for i in members])
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = group_starts(token)
            union, ends = token[first], np.append(first[1:], len(token))
            sizes = np.array([t["n"][i] for i in members])
            # A shingle that only the query itself has doesn't count for it as a member.
            alone = ends - first == 1
            for i in rows_:
                x, n, own = sets[i], t["n"][i], t["member"][i]
                if own and not t["within"][i]:
                    continue
                place = np.minimum(np.searchsorted(union, x), len(union) - 1)
                inside = place[union[place] == x]
                bound = int((~alone[inside]).sum()) if own else len(inside)
                if 100 * bound < share * n:
                    continue
                length = ends[inside] - first[inside]
                flat = np.repeat(first[inside] - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(int(length.sum()))
                common = np.bincount(owner[flat], minlength=len(members))
                for j in np.flatnonzero(100 * common >= share * (sizes + n - common)):
                    k = members[j]
                    if k != i and root(t["comp"][i]) != root(t["comp"][k]):
                        parent[root(t["comp"][i])] = root(t["comp"][k])
                        a.append(t["cls"][i])
                        b.append(t["cls"][k])
        give_back()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    # Dealt by both: a block's salts would otherwise stay together where a join has dealt its rows by block.
    return rows.repartition("block", "salt").groupBy("block", "salt").applyInArrow(run, "a binary, b binary")


def _parts(rows: int):
    """Parts of a group (with sets of n shingles) that hold about ``rows`` classes and ``GROUP_SHINGLES`` at most, as an aggregate."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / rows, F.sum("n") / GROUP_SHINGLES))


def _salted(members: DataFrame, queries: DataFrame, *extra: str) -> DataFrame:
    """Rows for ``_open``: blocks with many queries, or long ones, get several tasks, each with the block's members."""
    salts = queries.groupBy("block").agg(_parts(QUERIES).cast("int").alias("salts"))
    cols = ["block", "salt", "member", "within", "cls", "comp", "n", *extra]
    q = (queries.join(salts, "block").withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int"))
         .withColumns({"member": F.lit(False), "within": F.lit(False)}).select(cols))
    m = (members.join(salts, "block", "left")
         .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)))
         .withColumn("member", F.lit(True)).withColumn("within", F.col("within") & (F.col("salt") == 0)).select(cols))
    return m.unionByName(q)


def _blocks(info: DataFrame, key: list[str]) -> DataFrame:
    """``info`` (cls, n, leader, ...) with blocks of about ``BLOCK`` classes of equal ``key`` and size class, and their sizes' range."""
    info = info.withColumn("size_class", F.floor(F.log(F.col("n")) / F.log(F.lit(1.05))))
    key = [*key, "size_class"]
    count = info.groupBy(*key).agg(_parts(BLOCK).alias("splits"), F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return (info.alias("i").join(count.alias("c"), on).select("i.*", "c.splits", "c.n_min", "c.n_max")
            .withColumn("block", F.xxhash64(*key, F.pmod(F.xxhash64("cls"), F.col("splits")))).drop("splits", "size_class"))


def _asks(lists: DataFrame, info: DataFrame, share: int) -> DataFrame:
    """(cls, comp, n, block): queries to blocks that may hold a set to link with. One of two blocks asks the other.

    Blocks of other leaders are asked when the query shares enough prefix shingles with the block's union to reach
    the required overlap with a set of the block's sizes, blocks of the query's own leader whenever sizes allow.
    Classes of one component are never held against each other again.
    """
    lo = F.greatest(F.expr(f"ceil({share} * n / 100)"), F.col("n_min"))
    hi = F.least(F.expr(f"floor(100 * n / {share})"), F.col("n_max"))
    open_ = (F.col("block") < F.col("g_block")) & (lo <= hi) & (F.col("g_big").isNull() | (F.col("g_big") != F.col("comp_id")))
    # Ids as 64-bit hashes: equal ones of different classes would only add a query.
    slim = info.select("cls", "n", F.xxhash64("leader").alias("lead"), F.xxhash64("comp").alias("comp_id"),
                       F.when(F.col("big").isNotNull(), F.xxhash64("big")).alias("g_big"), "block", "blocks", "n_min", "n_max")
    tokens = lists.select("token", "cls").join(slim, "cls")
    q = tokens.select("token", F.xxhash64("cls").alias("q"), "n", "lead", "comp_id", "block")
    matrix = tokens.select("token", F.col("lead").alias("g_lead"), "g_big", F.col("block").alias("g_block"), "n_min", "n_max").distinct()
    overlap = lambda m: F.ceil(share * (F.col("n") + m) / (100 + share))
    need = F.least(1 - F.ceil(share * F.col("n") / 100) + overlap(lo), 1 - F.ceil(share * hi / 100) + overlap(hi))
    # Pairs of leaders that share a shingle come first: queries meet blocks of other leaders only, never all of their own.
    leads = tokens.select("token", "lead").distinct()
    pairs = leads.join(leads.withColumnRenamed("lead", "g_lead"), "token").where("lead <> g_lead")
    found = (q.join(pairs, ["token", "lead"]).join(matrix, ["token", "g_lead"]).where(open_)
             .groupBy("q", "g_block").agg(F.count(F.lit(1)).alias("shared"), F.min(need).alias("need"))
             .where(F.col("shared") >= F.col("need") - 1).select("q", "g_block"))
    # Within a leader's group the same for large components: queries meet blocks of other components only.
    large = slim.where("blocks > 1").withColumn("part", F.coalesce("g_big", F.lit(0)))
    blocks = large.select("lead", "g_big", F.col("part").alias("g_part"), F.col("block").alias("g_block"), "n_min", "n_max").distinct()
    parts = large.select("lead", "part").distinct()
    apart = parts.join(parts.withColumnRenamed("part", "g_part"), "lead").where("part <> g_part or part = 0")
    own = large.drop("g_big", "n_min", "n_max").join(apart, ["lead", "part"]).join(blocks, ["lead", "g_part"]).where(open_)
    found = found.unionByName(own.select(F.xxhash64("cls").alias("q"), "g_block"))
    return (info.withColumn("q", F.xxhash64("cls")).join(found.distinct(), "q").select("cls", "comp", "n", F.col("g_block").alias("block")))


def links(docs: DataFrame, table: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """Links (a, b) between classes that connect exactly the components of all links; no more than a forest per block."""
    lists = cut_lineage(shared_prefixes(docs, hot_shingles(docs, words), words, share))
    leaders = lists.select("cls", "leader").distinct()
    for _ in range(2):  # leaders follow their own leader
        up = leaders.select(F.col("cls").alias("leader"), F.col("leader").alias("upper"))
        leaders = leaders.join(up, "leader", "left").select("cls", F.coalesce("upper", "leader").alias("leader"))
    info = leaders.withColumn("n", _size_of("cls"))
    group = info.groupBy("leader").agg(_parts(BLOCK).alias("blocks"))
    info = cut_lineage(info.join(group, "leader"))
    at = cut_lineage(class_sets(docs, table, info, words))
    forget(docs.sparkSession)

    # Hub round: one block of each leader's group, and all others of the group as its queries.
    here = at.withColumns({"block": F.xxhash64("leader"), "comp": F.col("cls"), "within": F.lit(True),
                           "hub": F.pmod(F.xxhash64("cls"), F.col("blocks")) == 0})
    found = cut_lineage(_open(_salted(here.where("hub"), here.where("not hub"), "set"), share))

    # Blocks of the matrix: one leader, one large component or none, one size class.
    comp = connected(found)
    forget(docs.sparkSession)
    big = comp.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= BLOCK // 4).select("root")
    info = (info.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
            .join(big.withColumn("big", F.col("root")), "root", "left").drop("root"))
    info = cut_lineage(_blocks(info, ["leader", "big"]))

    # Exact round: queries to blocks that they may link into, and large groups' blocks against themselves.
    asks = cut_lineage(_asks(lists, info, share))
    forget(docs.sparkSession)
    whole = info.select("cls", "comp", "n", "block", ((F.col("blocks") > 1) & F.col("big").isNull()).alias("within"))
    members = whole.join(asks.select("block").distinct().withColumn("asked", F.lit(True)), "block", "left").where("within or asked").drop("asked")
    more = _open(_salted(members, asks).join(at.select("cls", "set"), "cls"), share)
    return found.unionByName(more)


def components(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id and root (a class of the component; null for an empty set) for every row."""
    table = cut_lineage(class_table(docs, words))
    found = cut_lineage(links(docs, table, words, share))
    forget(docs.sparkSession)
    comp = connected(found)
    least = table.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc"))
    rooted = least.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    top = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = rooted.join(top, "root").select("cls", "root", "component_id")
    return (table.join(named, "cls", "left")
            .select("doc_id", "row_key", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root"))


def keep_one(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """``docs`` with one document of each component: the one with the least id (a null id only where there is no other).

    Of rows that repeat it one stays. Texts without words belong to no component and all stay. All columns stay.
    """
    stays, key, copy = (free_name(docs, n) for n in ("stays", "row_key", "copy"))
    comp = cut_lineage(components(docs, words, share)).where("root is not null")
    one = comp.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("s")).select("s.doc_id", "s.row_key", F.lit(True).alias("stays"))
    k, o = comp.groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias("n")).alias("k"), one.alias("o")
    special = (k.join(o, F.col("k.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("k.row_key") == F.col("o.row_key")), "left")
               .select("k.doc_id", "k.row_key", "k.n", F.coalesce("o.stays", F.lit(False)).alias(stays)))
    # Rows that go, and rows that stand there several times and of which one stays; all others are kept as they are.
    special = cut_lineage(special.where(f"n > 1 or not `{stays}`"))
    maybe = maybe_in(special, "doc_id", "row_key")
    d = docs.withColumn(key, row_key())
    rest, s = d.where(maybe("doc_id", key)).alias("d"), special.select("doc_id", "row_key", stays).alias("s")
    rest = rest.join(s, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col(f"d.{key}") == F.col("s.row_key")), "left").select("d.*", f"s.{stays}")
    rest = rest.where(f"`{stays}` is null or `{stays}`")
    if special.where(f"`{stays}`").limit(1).count():
        first = Window.partitionBy("doc_id", key).orderBy(key)
        rest = rest.withColumn(copy, F.row_number().over(first)).where(f"`{stays}` is null or `{copy}` = 1").drop(copy)
    return d.where(~maybe("doc_id", key)).unionByName(rest.drop(stays)).drop(key)


def report(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", "n_shingles", "component_id")
