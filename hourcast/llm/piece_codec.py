"""SentencePiece encoding and decoding by vectorised merge rounds.

Covers BPE models with byte fallback, identity normalisation and a leading space mark, such as the public 32k one;
``PieceModel`` compares itself with the library on probe texts and refuses any other model.

A chunk of texts becomes code points; it is cut into words wherever two neighbouring code points are neighbours in
no piece, so that no merge reaches across a cut. Distinct words are encoded once for each chunk: their symbols lie in one
flat array, with the rank of the merge of each symbol and the next. A round takes the least rank of each word
(``reduceat``), merges all its occurrences at once, leftmost first where they overlap, and compacts the array;
words without a further merge leave it. The library merges one pair at a time, so a merge that makes a pair of
a rank as good must be followed by that pair: occurrences to the right of such a merge wait for the next round.

Documents are independent of each other: no shuffle, and a task holds one chunk of texts.

Defined cases: a null text counts as empty and has no ids but the end id. U+2581 is the mark of a space, as in the
library, and is decoded to a space. Repeated rows and null doc_ids give rows of their own, and an empty table none. Further
columns stay; columns with the names of results are replaced. In ``decode``, control ids are empty, bytes that
are not UTF-8 become U+FFFD one by one, null ids count as an empty list, and unknown ids raise an error.
"""

from __future__ import annotations

import heapq
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.textbatch import give_back

MARK = "▁"
END_ID = 2
NONE = np.int64(1) << 60  # rank of a pair that is no piece
LONG = 4096  # symbols of a word from which merges go through a heap, one at a time
CHUNK = 1 << 19  # characters encoded at once

PROBES = ("", " ", "  a  b ", "Hello world", "é 中文\U0001f600 ", "\n\t\r\x00", "<s></s><unk><0x41>", "x▁y", "a" * 40 + " " * 40)


class PieceModel:
    """Vocabulary of a model file as arrays."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        # Symbols: the ids of pieces, then the characters that occur in pieces only.
        symbol = {pieces[i]: i for i in plain}
        for c in sorted({c for i in plain for c in pieces[i]} - symbol.keys()):
            symbol[c] = n + len(symbol)  # not an id
        self.unknown = max([n, *symbol.values()]) + 1  # a code point c without a symbol is unknown + c
        self.n_ids = n
        self.of_point = self.unknown + np.arange(0x110000, dtype=np.int32)  # symbol of each code point
        self.lone = {i: ord(s) for s, i in symbol.items() if i >= n}
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_point[ord(s)] = i
        # Equal scores have equal ranks.
        ranks = {s: r for r, s in enumerate(sorted({-lib.get_score(i) for i in plain}))}
        rows = [(symbol[p[:k]], symbol[p[k:]], ranks[-lib.get_score(i)], i)
                for i in plain for p in (pieces[i],) for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.pair_keys, self.pair_ranks, self.pair_symbols = (table[:, 0] << 32) | table[:, 1], table[:, 2], table[:, 3]
        self.slots = np.full(1 << max(16, (8 * len(table)).bit_length()), -1, np.int32)  # open addressing
        self.slot_shift = np.uint64(65 - len(self.slots).bit_length())
        for i, at in enumerate(self._slot(self.pair_keys).tolist()):
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at] = i
        # Cells of neighbours within pieces. Two pairs may share a cell: a cut less changes no result.
        near = [(ord(a), ord(b)) for i in plain for a, b in zip(pieces[i], pieces[i][1:])]
        self.joins = np.zeros(1 << 20, bool)
        self.joins[self._cell(*np.array(near or [(0, 0)], np.int64).T)] = True
        # Bytes of each id when decoded; the space mark is a space.
        shown = [bytes([int(pieces[i][3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else lib.decode([i]).encode() if lib.is_unknown(i)
                 else pieces[i].replace(MARK, " ").encode() for i in range(n)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_at = np.concatenate([[0], np.cumsum([len(x) for x in shown])])
        self.marked = np.array([p.startswith(MARK) for p in pieces])
        ids, bounds = self.encode(list(PROBES))
        if [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] != lib.encode(list(PROBES)):
            raise ValueError(f"{path}: not a BPE model with byte fallback, identity normalisation and a leading space mark")

    # ---- pairs and symbols ------------------------------------------------------------------------------------------
    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.slot_shift).astype(np.int64)

    def _cell(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 7919 + b) % len(self.joins)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair (``NONE`` where it is no piece)."""
        key = (left << 32) | right
        slot = self._slot(key)
        at = self.slots[slot]
        open_ = np.flatnonzero((at >= 0) & (self.pair_keys[at] != key))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.slots)
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] >= 0) & (self.pair_keys[at[open_]] != key[open_])]
        return np.where(at >= 0, self.pair_ranks[at], NONE), self.pair_symbols[at]

    # ---- encoding ---------------------------------------------------------------------------------------------------
    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text's."""
        parts, size, group, held = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), [], 0

        def flush():
            ids, bounds = self._encode([b for _, b in group])
            np.add.at(size, [i for i, _ in group], np.diff(bounds))
            parts.append(ids)

        for i, t in enumerate(texts):
            for block in self._blocks(MARK + t.replace(" ", MARK)) if t else ():
                group.append((i, block))
                held += len(block)
                if held >= CHUNK:
                    flush()
                    group, held = [], 0
        if group:
            flush()
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(size)])

    def _blocks(self, marked: str):
        """A marked text in blocks of about ``CHUNK`` characters, cut where words are cut."""
        start = 0
        while len(marked) - start > 2 * CHUNK:
            end = start + CHUNK
            while end < len(marked) and self.joins[self._cell(ord(marked[end - 1]), ord(marked[end]))]:
                end += 1
            yield marked[start:end]
            start = end
        if start < len(marked):
            yield marked[start:]

    def _encode(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all blocks in a row, and the bounds of each block's."""
        sizes = np.array([len(t) for t in marked], np.int64)
        points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if not len(points):
            return np.zeros(0, np.int32), bounds
        start = np.ones(len(points), bool)
        start[1:] = ~self.joins[self._cell(points[:-1], points[1:])]
        start[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(start)
        words, which = self._distinct(points, starts)
        symbols, first, count = self._merged(points, starts, words)
        # Symbols of every word of the texts, in order.
        reps = count[which]
        flat = symbols[np.repeat(first[which] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())]
        per_text = np.concatenate([[0], np.cumsum(reps)])[np.searchsorted(starts, bounds)]
        return self._ids(flat, per_text)

    @staticmethod
    def _distinct(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First occurrence of each distinct word, and every word's number among them."""
        data = points.astype("<u4").tobytes()
        offsets = np.append(starts, len(points)).astype(np.int64) * 4
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        which = pc.dictionary_encode(words).indices.to_numpy()
        return np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1)), which  # numbers follow first occurrences

    def _merged(self, points: np.ndarray, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Final symbols of the words, and each word's first one and number of them."""
        lengths = np.diff(np.append(starts, len(points)))[words]
        owner = np.repeat(np.arange(len(words)), lengths)
        at = np.repeat(starts[words] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        symbols = self.of_point[points[at]].astype(np.int64)
        done_owner, done = [], []
        for w in np.flatnonzero(lengths > LONG):
            got = self._one_by_one(symbols[owner == w])
            done_owner.append(np.full(len(got), w))
            done.append(got)
        short = lengths[owner] <= LONG
        for o, s in self._rounds(owner[short], symbols[short]):
            done_owner.append(o)
            done.append(s)
        owner, symbols = np.concatenate(done_owner), np.concatenate(done)
        order = np.argsort(owner, kind="stable")
        count = np.bincount(owner, minlength=len(words))
        return symbols[order], np.cumsum(count) - count, count

    def _rounds(self, owner: np.ndarray, symbols: np.ndarray):
        """Merge rounds over flat symbol arrays; yields (word of each symbol, symbols) of the words that are done."""
        rank, merged = self._neighbours(owner, symbols, np.arange(len(symbols)))
        while len(symbols):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(heads, append=len(symbols))
            least = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            over = least == NONE
            if over.any():
                yield owner[over], symbols[over]
                live = ~over
                owner, symbols, rank, merged, least = owner[live], symbols[live], rank[live], merged[live], least[live]
                if not len(symbols):
                    return
            chosen = self._leftmost(rank == least)
            chosen = self._until_better(chosen, owner, symbols, merged, least)
            symbols[chosen] = merged[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            touched = np.cumsum(keep)[chosen] - 1
            owner, symbols, rank, merged = owner[keep], symbols[keep], rank[keep], merged[keep]
            touched = np.concatenate([touched, np.maximum(touched - 1, 0)])
            rank[touched], merged[touched] = self._neighbours(owner, symbols, touched)

    def _neighbours(self, owner: np.ndarray, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging the symbols at ``at`` with the next one of the same word."""
        after = np.minimum(at + 1, len(symbols) - 1)
        rank, merged = self._pairs(symbols[at], symbols[after])
        return np.where((owner[at] == owner[after]) & (after > at), rank, NONE), merged

    @staticmethod
    def _leftmost(candidate: np.ndarray) -> np.ndarray:
        """Positions of candidates that no earlier one overlaps: every second one of a run."""
        at = np.flatnonzero(candidate)
        new = np.diff(at, prepend=-2) != 1
        run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - run) % 2 == 0]

    def _until_better(self, chosen: np.ndarray, owner: np.ndarray, symbols: np.ndarray, merged: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Of each word's chosen positions those up to the first whose merge makes a pair of the same or a lower rank."""
        last = len(symbols) - 1
        new, before, after = merged[chosen], np.maximum(chosen - 1, 0), np.minimum(chosen + 2, last)
        left = symbols[before].copy()
        joined = np.flatnonzero(chosen[1:] == chosen[:-1] + 2) + 1  # the left neighbour has just been merged
        left[joined] = new[joined - 1]
        limit = least[chosen]
        to_left = (self._pairs(left, new)[0] <= limit) & (owner[before] == owner[chosen]) & (before < chosen)
        to_right = (self._pairs(new, symbols[after])[0] <= limit) & (owner[after] == owner[chosen]) & (after == chosen + 2)
        better = to_left | to_right
        seen = np.cumsum(better) - better
        first = np.flatnonzero(np.diff(owner[chosen], prepend=-1))
        return chosen[seen == np.repeat(seen[first], np.diff(first, append=len(chosen)))]

    def _one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges for one long word, from a heap of (rank, position)."""
        n = len(symbols)
        s, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        pair = {}

        def rank(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in pair:
                r, m = self._pairs(np.array([a]), np.array([b]))
                pair[a, b] = int(r[0]), int(m[0])
            return pair[a, b]

        heap = [(rank(s[i], s[i + 1])[0], i, s[i], s[i + 1]) for i in range(n - 1)]
        heap = [h for h in heap if h[0] != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue  # one of the two has been merged since
            s[i], s[j], after[i] = rank(a, b)[1], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := rank(s[x], s[y])[0]) != NONE:
                    heapq.heappush(heap, (r, x, s[x], s[y]))
        return np.array([x for x in s if x >= 0], np.int64)

    def _ids(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols; a character that is no piece becomes the ids of its UTF-8 bytes."""
        odd = symbols >= self.n_ids
        if not odd.any():
            return symbols.astype(np.int32), bounds
        values, where = np.unique(symbols[odd], return_inverse=True)
        encoded = [chr(self.lone.get(int(v), int(v) - self.unknown)).encode() for v in values]
        size = np.ones(len(symbols), np.int64)
        size[odd] = np.array([len(e) for e in encoded])[where]
        ends = np.cumsum(size)
        out = np.zeros(int(ends[-1]), np.int32)
        out[(ends - size)[~odd]] = symbols[~odd]
        table = np.zeros((len(values), 4), np.uint8)
        for i, e in enumerate(encoded):
            table[i, :len(e)] = list(e)
        for k in range(4):
            some = size[odd] > k
            out[(ends - size)[odd][some] + k] = self.byte_ids[table[where[some], k]]
        return out, np.concatenate([[0], ends])[bounds]

    # ---- decoding ---------------------------------------------------------------------------------------------------
    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of id lists that lie in a row."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.n_ids):
            raise ValueError("an id is not in the model")
        ids = ids.astype(np.int64)
        size = np.diff(self.shown_at)[ids]
        ends = np.cumsum(size)
        data = self.shown[np.repeat(self.shown_at[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ids) else 0)]
        at = np.concatenate([[0], ends])[bounds]
        out = []
        whole = data.tobytes()
        for i in range(len(bounds) - 1):
            part = whole[at[i]:at[i + 1]]
            own = ids[bounds[i]:bounds[i + 1]]
            filled = np.flatnonzero(size[bounds[i]:bounds[i + 1]])
            if len(filled) and self.marked[own[filled[0]]]:
                part = part[1:]  # the leading mark
            try:
                out.append(part.decode())
            except UnicodeDecodeError:
                out.append(self._repaired(part))
        return out

    @staticmethod
    def _repaired(data: bytes) -> str:
        """UTF-8 in which every byte that belongs to no character counts as U+FFFD."""
        return data.decode(errors="surrogateescape").translate({0xDC00 + b: "�" for b in range(128, 256)})


@cache
def model(path: str) -> PieceModel:
    return PieceModel(path)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _own(df: DataFrame, result: str) -> list:
    return [F.col(f"`{c}`") for c in df.columns if c != result]


def encode(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """``docs`` with ids, the ids of each whole text (and the end id)."""
    @F.arrow_udf("array<int>")
    def run(text: pa.Array) -> pa.Array:
        ids, bounds = model(path).encode(text.to_pylist())
        if end:
            ids, bounds = np.insert(ids, bounds[1:], END_ID), bounds + np.arange(len(bounds))
        give_back()
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))

    return docs.select(*_own(docs, "ids"), run(F.coalesce(F.col("text"), F.lit(""))).alias("ids"))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with decoded, the text of ids."""
    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        known, out = model(path), []
        for i in range(0, len(ids), 256):
            part = ids.slice(i, 256)
            bounds = np.concatenate([[0], pc.list_value_length(part).to_numpy(zero_copy_only=False)]).cumsum()
            out += known.decode(part.flatten().to_numpy(zero_copy_only=False), bounds)
        return pa.array(out, pa.string())

    return tokens.select(*_own(tokens, "decoded"), run(F.coalesce(F.col("ids"), F.array().cast("array<int>"))).alias("decoded"))


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    path = path or model_path()
    done = decode(encode(docs.select("doc_id", "text"), path), path)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
