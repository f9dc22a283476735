"""Suffix-array dedup: repeated byte strings of ``WIDTH`` or more, by difference covers and fingerprint classes.

A byte is removed when a ``WIDTH``-byte string over it also starts anywhere else in the corpus. Sorting all
suffixes would show every such string as a tie of ``WIDTH`` bytes, but needs a record for every byte. Instead:

1. Cover sample. D is a perfect difference cover modulo v: any two positions meet in D at one common shift
   below v. Only suffixes at sample positions become records (18 of 307), with a fingerprint (key) of their next
   ``WIDTH - v + 1`` bytes and one of all bytes within reach of a shift.
2. Buckets. Records are spread over hash buckets by their key, a fingerprint; a task sorts one bucket by it at a
   time. Suffix order and ranks of the cover samples are not needed, as only equality is asked for. Long ties settle right there: where the whole reach is equal as well, all ``WIDTH``-byte strings that the
   sample position stands for repeat, and no suffix between samples is ever looked at.
3. What stays open - strings near the ends of a repeat - is done again with a finer cover (v = 31), and what is
   still open with every position (v = 1). Each level reads only texts that have open places.

Two equal strings meet at a sample position of both, so one of them is settled there or both are handed on (one
record stands for a settled class); nothing is missed. Ties are compared by two fingerprints of 48 and 40 bits, each from a hash of its own: at v = 1,
where key and reach cover the same bytes, they still make 88 bits.

Within a task a key is passed on at most twice, however often the task holds it, so a passage or copy in any
share of all documents gives a bucket no more than two records from each flush of a task.

Defined cases: a null text is an empty one. Repeated rows repeat their text: all of it goes if it has ``WIDTH``
bytes. Null ids are kept. Texts are rows' own: strings never cross from one to the next. Kept bytes may cut a
character in two; ``clean`` therefore gives bytes. Further columns are ignored.
"""

from __future__ import annotations

from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.keyfilter import maybe_in
from hourcast.llm.spill import bucket_keys, group_starts, pack, packed_batch
from hourcast.llm.textbatch import Rolling, chunks, mix, row_key, utf8
from hourcast.session import cut_lineage

WIDTH = 400
LEVELS = (17, 5, 0)  # cover orders q: v = q*q + q + 1; 0: every position
_FLUSH_BYTES = 24 << 20

# A sample suffix: key of its bytes (48 bits), key of its reach (40 bits), its row, its position, and
# whether its task holds it twice. A range: row, string starts [start, end), settled or open.
_RECORD = np.dtype([("key", "<u8"), ("reach", "<u8"), ("id", "<i8"), ("row_key", "<u4"), ("pos", "<u4"), ("twice", "u1")])
_RANGE = np.dtype([("id", "<i8"), ("row_key", "<u4"), ("settled", "u1"), ("start", "<u4"), ("end", "<u4")])
_NO_ID = -(1 << 63)  # stands for a null doc_id


@cache
def difference_cover(q: int) -> tuple[int, tuple[int, ...]]:
    """(v, D): a perfect difference cover modulo v = q*q + q + 1 for a prime q, from a linear recurrence modulo q."""
    if q == 0:
        return 1, (0,)
    v = q * q + q + 1
    for a, b, c in product(range(q), range(q), range(1, q)):
        x = [0, 0, 1]
        while len(x) < v:
            x.append((a * x[-1] + b * x[-2] + c * x[-3]) % q)
        d = [i for i in range(v) if x[i] == 0]
        if len(d) == q + 1 and len({(i - j) % v for i in d for j in d}) == v:
            return v, tuple(d)
    raise ValueError(f"no cover of order {q}")


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as sorted disjoint ranges."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, far = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(starts[1:] > far[:-1]) + 1
    return starts[np.concatenate([[0], new])], far[np.append(new - 1, len(far) - 1)]


def _sample(n_bytes: np.ndarray, q: int, width: int, openings) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of the sample suffixes of each text; within reach of ``openings`` where these are given."""
    v, d = difference_cover(q)
    rows, places = [], []
    for i, n in enumerate(n_bytes):
        last = n - width + v - 1  # the last position with width - v + 1 bytes
        if n < width:
            continue
        p = (np.arange(0, last + 1, v)[:, None] + np.array(d)[None, :]).ravel()
        p = p[p <= last]
        if openings is not None:
            starts, ends = openings[i]  # string starts [start, end) that are open
            if not len(starts):
                continue
            at = np.searchsorted(starts, p, side="right") - 1  # the last range that starts at or below p
            p = p[(at >= 0) & (ends[np.maximum(at, 0)] > p - v + 1)]
        rows.append(np.full(len(p), i))
        places.append(p)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(places)


def _ranges(blob: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    r = np.frombuffer(blob or b"", "<i8").reshape(-1, 2)
    return _merge(r[:, 0], r[:, 1])


def _level(texts: DataFrame, q: int, width: int, buckets: np.ndarray) -> DataFrame:
    """id, row_key, settled, open: ranges of string starts, as packed (start, end) pairs, for rows that have any.

    texts: id, row_key, text and, below the first level, open (packed ranges).
    """
    v, _ = difference_cover(q)
    gathered = buckets[::4]  # ranges are few beside suffix records
    inner = "open" in texts.columns

    def post(batches):
        ids, row_keys, keys, reaches, rows, places, held = [], [], [], [], [], [], 0

        def flush():
            rec = np.empty(sum(map(len, keys)), _RECORD)
            rec["key"], rec["reach"] = np.concatenate(keys), np.concatenate(reaches)
            row = np.concatenate(rows)
            rec["id"], rec["row_key"], rec["pos"] = np.concatenate(ids)[row], np.concatenate(row_keys)[row], np.concatenate(places)
            rec = rec[np.lexsort((rec["reach"], rec["key"]))]
            group, cls, in_class, in_group = _ties(rec)
            rec["twice"] = np.repeat(in_class > 1, in_class)
            first = np.zeros(len(rec), bool)
            first[cls] = True
            several = np.repeat(in_group, np.diff(np.append(group, len(rec)))) > 1
            # Settled here: classes of two or more. Open here, where a key has several reaches: one record of each
            # class - its only one, or the one that stands for a settled class. Of each key at most two go on.
            send = np.zeros(len(rec), bool)
            send[group] = True
            send[cls[np.searchsorted(cls, group)[in_group > 1] + 1]] = True
            known = np.concatenate([_stands_for(rec[rec["twice"] > 0], v, True), _stands_for(rec[several & first], v, False)])
            sent = rec[send]
            cells = [(b, b"R" + _squeeze_records(np.frombuffer(x, _RECORD))) for b, x in pack(sent["key"] >> np.uint64(8), sent, buckets)]
            cells += [(b, b"L" + _squeeze(np.frombuffer(x, _RANGE))) for b, x in pack(_row_token(known), known, buckets)]
            return packed_batch(cells)

        for batch in batches:
            for part in chunks(batch):
                data, offsets = utf8(part.column("text"))
                n_bytes = np.diff(offsets)
                openings = [_ranges(x) for x in part.column("open").to_pylist()] if inner else None
                row, pos = _sample(n_bytes, q, width, openings)
                if len(row):
                    roll = Rolling.of_bytes(data, strong=True)
                    at, size = offsets[row] + pos, n_bytes[row]
                    left, right = np.minimum(pos, v - 1), np.minimum(size - pos, width)
                    clip = (left * (2 * width) + right).astype(np.uint64)
                    keys.append(roll.spans(at, at + width - v + 1) >> np.uint64(16))
                    reaches.append((roll.second_spans(at - left, at + right) ^ mix(clip)) >> np.uint64(24))
                    rows.append(row + sum(map(len, ids)))
                    places.append(pos)
                ids.append(part.column("id").to_numpy())
                row_keys.append(part.column("row_key").to_numpy())
                held += len(row) * 512 + len(data)
                if held >= _FLUSH_BYTES and keys:
                    yield flush()
                    ids, row_keys, keys, reaches, rows, places, held = [], [], [], [], [], [], 0
        if keys:
            yield flush()

    def settle(table: pa.Table) -> pa.Table:
        cells = table.column("cell").to_pylist()
        known = [np.frombuffer(_stretch(c[1:]), _RANGE) for c in cells if c[:1] == b"L"]
        recs = [_stretch_records(c[1:]) for c in cells if c[:1] == b"R"]
        if recs:
            rec = np.concatenate(recs)
            rec = rec[np.lexsort((rec["reach"], rec["key"]))]
            group, cls, in_class, in_group = _ties(rec)
            settled = np.repeat((in_class > 1) | (np.maximum.reduceat(rec["twice"], cls) > 0), in_class)
            several = np.repeat(in_group, np.diff(np.append(group, len(rec)))) > 1
            first = np.zeros(len(rec), bool)
            first[cls] = True
            known += [_stands_for(rec[settled], v, True), _stands_for(rec[several & first], v, False)]
        known = np.concatenate(known)
        batch = packed_batch([(b, _squeeze(np.frombuffer(x, _RANGE))) for b, x in pack(_row_token(known), known, gathered)])
        return pa.Table.from_batches([batch])

    def gather(table: pa.Table) -> pa.Table:
        known = np.concatenate([np.frombuffer(_stretch(c), _RANGE) for c in table.column("cell").to_pylist()])
        known = _joined(known)
        cut = group_starts(known["id"], known["row_key"])
        out = {"id": known["id"][cut], "row_key": known["row_key"][cut].astype(np.int64), "settled": [], "open": []}
        for part in np.split(known, cut[1:]):
            pairs = np.stack([part["start"], part["end"]], axis=1).astype("<i8")
            out["settled"].append(pairs[part["settled"] > 0].tobytes())
            out["open"].append(pairs[part["settled"] == 0].tobytes())
        return pa.table({k: pa.array(x, pa.binary()) if k in ("settled", "open") else pa.array(x) for k, x in out.items()})

    packed = texts.select("id", "row_key", "text", *(["open"] if inner else [])).mapInArrow(post, "bucket int, cell binary")
    ranges = packed.repartition(len(buckets), "bucket").groupBy("bucket").applyInArrow(settle, "bucket int, cell binary")
    return ranges.repartition(len(gathered), "bucket").groupBy("bucket").applyInArrow(gather, "id bigint, row_key bigint, settled binary, open binary")


def _ties(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of equal keys and of equal (key, reach) in sorted records; records of each class, classes of each key."""
    group, cls = group_starts(rec["key"]), group_starts(rec["key"], rec["reach"])
    return group, cls, np.diff(np.append(cls, len(rec))), np.diff(np.append(np.searchsorted(cls, group), len(cls)))


def _row_token(r: np.ndarray) -> np.ndarray:
    return mix(r["id"].astype(np.uint64) + r["row_key"].astype(np.uint64))


def _joined(r: np.ndarray) -> np.ndarray:
    """Union of the ranges of each row and kind, sorted. Ends may lie past the last start; users clip them."""
    if not len(r):
        return r
    r = r[np.lexsort((r["start"], r["settled"], r["row_key"], r["id"]))]
    head = group_starts(r["id"], r["row_key"], r["settled"])
    group = np.zeros(len(r), np.int64)
    group[head[1:]] = 1
    group = np.cumsum(group)
    shift = group * (1 << 33)  # ranges of different rows can't touch
    far = np.maximum.accumulate(r["end"].astype(np.int64) + shift)
    new = np.concatenate([[True], r["start"][1:].astype(np.int64) + shift[1:] > far[:-1]])
    at = np.flatnonzero(new)
    out = r[at].copy()
    last = np.append(at[1:] - 1, len(r) - 1)
    out["end"] = far[last] - shift[last]
    return out


def _stands_for(rec: np.ndarray, v: int, settled: bool) -> np.ndarray:
    """The string starts that sample positions stand for."""
    r = np.empty(len(rec), _RANGE)
    r["id"], r["row_key"], r["settled"] = rec["id"], rec["row_key"], settled
    r["end"] = rec["pos"] + 1
    r["start"] = np.maximum(rec["pos"].astype(np.int64) - (v - 1), 0)
    return _joined(r)


def _squeeze(r: np.ndarray) -> bytes:
    """Sorted records, column by column, compressed."""
    raw = b"".join(np.ascontiguousarray(r[n]).tobytes() for n in r.dtype.names)
    return len(r).to_bytes(4, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _stretch(cell: bytes, dtype: np.dtype = _RANGE) -> bytes:
    n, size = int.from_bytes(cell[:4], "little"), int.from_bytes(cell[4:12], "little")
    raw, at, out = pa.decompress(cell[12:], size, codec="zstd", asbytes=True), 0, np.empty(n, dtype)
    for name in dtype.names:
        out[name] = np.frombuffer(raw, dtype[name], n, at)
        at += n * dtype[name].itemsize
    return out.tobytes()


_PACKED = np.dtype([("key", "<u4"), ("key2", "<u2"), ("reach", "<u4"), ("reach2", "u1"), ("step", "u1"), ("pos", "<u4"), ("twice", "u1")])
_ROW = np.dtype([("id", "<i8"), ("row_key", "<u4")])


def _squeeze_records(rec: np.ndarray) -> bytes:
    rec = rec[np.lexsort((rec["pos"], rec["row_key"], rec["id"]))]
    head = group_starts(rec["id"], rec["row_key"])
    rows = np.empty(len(head), _ROW)
    rows["id"], rows["row_key"] = np.diff(rec["id"][head], prepend=0), rec["row_key"][head]
    p = np.empty(len(rec), _PACKED)
    p["key"], p["key2"] = rec["key"] & np.uint64(0xFFFFFFFF), rec["key"] >> np.uint64(32)
    p["reach"], p["reach2"] = rec["reach"] & np.uint64(0xFFFFFFFF), rec["reach"] >> np.uint64(32)
    p["step"], p["pos"], p["twice"] = 0, np.diff(rec["pos"], prepend=np.uint32(0)), rec["twice"]
    p["step"][head] = 1
    a = _squeeze(rows)
    return len(a).to_bytes(4, "little") + a + _squeeze(p)


def _stretch_records(cell: bytes) -> np.ndarray:
    n = int.from_bytes(cell[:4], "little")
    rows = np.frombuffer(_stretch(cell[4:4 + n], _ROW), _ROW)
    p = np.frombuffer(_stretch(cell[4 + n:], _PACKED), _PACKED)
    rec = np.empty(len(p), _RECORD)
    rec["key"] = p["key"].astype(np.uint64) | p["key2"].astype(np.uint64) << np.uint64(32)
    rec["reach"] = p["reach"].astype(np.uint64) | p["reach2"].astype(np.uint64) << np.uint64(32)
    row = np.cumsum(p["step"].astype(np.int64)) - 1
    rec["id"], rec["row_key"] = np.cumsum(rows["id"])[row], rows["row_key"][row]
    rec["pos"], rec["twice"] = np.cumsum(p["pos"].astype(np.uint32), dtype=np.uint32), p["twice"]
    return rec


def _rows(docs: DataFrame) -> DataFrame:
    """id (doc_id, or a stand-in for null), row_key (32 bits of the text's hash) and text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("id"),
                       row_key().bitwiseAND(F.lit(0xFFFFFFFF)).alias("row_key"), "text")


def _picked(rows: DataFrame, named: DataFrame, columns: list[str]) -> DataFrame:
    """id, row_key, text and ``columns`` of the rows that ``named`` names.

    A bit filter keeps most other texts out of the shuffle; the join is exact.
    """
    maybe = maybe_in(named, "id", "row_key")
    return rows.where(maybe("id", "row_key")).join(named.select("id", "row_key", *columns), ["id", "row_key"])


def repeated_starts(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """id, row_key and starts: packed ranges of the positions whose ``width`` bytes start elsewhere too."""
    found, rows = [], _rows(docs)
    texts, buckets = rows, bucket_keys(rows)
    for i, q in enumerate(levels):
        got = cut_lineage(_level(texts, q, width, buckets))
        found.append(got.where(F.octet_length("settled") > 0).select("id", "row_key", "settled"))
        if i + 1 < len(levels):
            texts = _picked(rows, got.where(F.octet_length("open") > 0), ["open"])
    all_ = found[0]
    for f in found[1:]:
        all_ = all_.unionByName(f)
    one = all_.groupBy("id", "row_key").agg(F.collect_list("settled").alias("s"))
    return one.select("id", "row_key", F.unhex(F.array_join(F.transform("s", F.hex), "")).alias("starts"))


def clean(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """id, row_key, n_removed, n_spans, kept (bytes) and kept_chars (characters that begin in them) of the rows that lose any byte."""
    rows = _rows(docs)
    starts = cut_lineage(repeated_starts(docs, width, levels))

    def run(batches):
        for batch in batches:
            removed, spans, kept, chars = [], [], [], []
            for text, blob in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                raw = text.encode()
                s, e = _ranges(blob)
                s, e = _merge(s, np.minimum(e - 1, len(raw) - width) + width)
                out, at = [], 0
                for a, b in zip(s, e):
                    out.append(raw[at:a])
                    at = b
                kept.append(b"".join([*out, raw[at:]]))
                removed.append(len(raw) - len(kept[-1]))
                spans.append(len(s))
                chars.append(np.count_nonzero(np.frombuffer(kept[-1], np.uint8) & 0xC0 != 0x80))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_key"), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(chars, pa.int64())],
                                             names=["id", "row_key", "n_removed", "n_spans", "kept", "kept_chars"])

    schema = "id bigint, row_key bigint, n_removed bigint, n_spans bigint, kept binary, kept_chars bigint"
    return _picked(rows, starts, ["starts"]).mapInArrow(run, schema)


def report(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row (``left_over`` adds what is kept of it)."""
    return left_over(docs, width, levels).drop("kept_bytes", "kept_chars")


def left_over(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The columns of ``report``, then kept_bytes and kept_chars: the length of what is kept, in bytes and characters.

    A document that loses nothing has its text's own length there.
    """
    lost = (clean(docs, width, levels).groupBy("id", "row_key")
            .agg(F.first("n_removed").alias("n_removed"), F.first("n_spans").alias("n_spans"), F.first(F.sha2("kept", 256)).alias("sha"),
                 F.first("kept_chars").alias("kept_chars")))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = _rows(docs).select("id", "row_key", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("own"),
                             F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("n_chars"))
    n_removed = F.coalesce("n_removed", F.lit(0)).cast("bigint")
    return own.join(lost, ["id", "row_key"], "left").select(
        F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "n_bytes", n_removed.alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"),
        (F.col("n_bytes") - n_removed).alias("kept_bytes"), F.coalesce("kept_chars", "n_chars").alias("kept_chars"))
