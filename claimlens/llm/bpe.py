"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece exactly one vocabulary token can be the last one of
its encoding: the one that fits the last token of the shorter prefix it leaves.
Storing that token per prefix encodes the piece, lets bytes be appended without
redoing what stands, and limits the work after an edit to the bytes behind it.
Two tokens fit when merging their joined bytes gives just these two tokens.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .frames import Batches, text_of
from .words import BYTE_BASE, BYTE_VALUE, U64, Powers, flat, mix, pieces, release, span_hash, spans

# the splitting pattern that ``Cutter`` carries out with array operations
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# entries of a worker's piece table; it is emptied when full
CACHE_PIECES = 200_000
# longer pieces are encoded by themselves
LONG_PIECE = 48
MEMO = 1 << 20
CACHE_PAIRS = 1_000_000
# text encoded at a time; the tables for it take about a hundred times as much
ENCODE_BYTES = 1 << 20


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks of a file with one ``base64 rank`` pair per line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


BYTES = Powers(BYTE_BASE)
LETTER, NUMBER, BLANK, OTHER = range(4)


class Cutter:
    """Piece boundaries of ``KNOWN_PATTERN`` for many texts at once, on UTF-8 bytes."""

    _kinds: np.ndarray | None = None

    def __init__(self) -> None:
        if Cutter._kinds is None:
            points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            kinds = np.full(0x110000, OTHER, np.uint8)
            for kind, wanted in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
                kinds[[ord(c) for c in regex.findall(wanted, points)]] = kind
            Cutter._kinds = kinds

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which pieces begin; every non-empty text begins one."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        if not len(lead):
            return lead
        point = data[lead].astype(np.int32)
        for low, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
            at = np.flatnonzero((point >= low) & (point < 0x100) & (data[lead] >= low) & (data[lead] < (low >> 1 | 0x80)))
            value = data[lead[at]].astype(np.int32) & bits
            for k in range(1, more + 1):
                value = value << 6 | (data[lead[at] + k].astype(np.int32) & 0x3F)
            point[at] = value
        kind = self._kinds[point]
        n = len(point)
        opens = np.zeros(n + 1, bool)
        opens[np.searchsorted(lead, offsets)] = True
        opens = opens[:n]
        before = np.empty(n, np.uint8)
        before[0], before[1:] = OTHER, kind[:-1]
        after_solid = np.zeros(n, bool)
        after_solid[:-1] = (kind[1:] != BLANK) & ~opens[1:]
        after_space = np.zeros(n, bool)
        after_space[1:] = point[:-1] == 0x20
        blank = kind == BLANK
        cut = opens | np.where(blank, (before != BLANK) | after_solid, (kind != before) & ~after_space)
        # contractions: an apostrophe that opens a piece, with its letters
        last = np.append(point, [0, 0, 0])
        closed = np.append(opens, [True, True, True])
        for p in np.flatnonzero((point == 0x27) & cut):
            if closed[p + 1]:
                continue
            one, two = chr(last[p + 1]), "" if closed[p + 2] else chr(last[p + 1]) + chr(last[p + 2])
            length = 1 if one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
            if length:
                cut[p + 1 : p + 1 + length] = False
                if p + 1 + length < n:
                    cut[p + 1 + length] = True
        return lead[cut]


@dataclass
class Prefixes:
    """Encoded bytes with the last token of every prefix (``last[i]`` ends at byte i)."""

    data: bytearray = field(default_factory=bytearray)
    last: list[int] = field(default_factory=lambda: [-1])

    def copy(self) -> Prefixes:
        return Prefixes(bytearray(self.data), list(self.last))


class Joins:
    """The prefix tables of many pieces at once.

    ``valid`` undoes merges backwards in time: while tokens a and b stand side by
    side, the later of their last merges is taken back; if meanwhile the two parts
    at the seam could have merged earlier than that, a and b cannot be neighbours.
    """

    def __init__(self, engine: Encoder):
        ranks = engine.ranks
        size = max(ranks.values(), default=0) + 1
        self.left, self.right = np.arange(size), np.arange(size)
        self.order = np.full(size, -1, np.int64)
        usable = np.zeros(size, bool)
        pairs: dict[int, int] = {}
        for data, rank in ranks.items():
            usable[rank] = engine.fits(-1, rank)
            if len(data) > 1:
                self.order[rank] = rank
                for i in range(1, len(data)):
                    a, b = ranks.get(data[:i]), ranks.get(data[i:])
                    if a is not None and b is not None:
                        pairs[a << 32 | b] = rank
                if usable[rank]:
                    self.left[rank], self.right[rank] = engine.halves(data)
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)
        names = [(data, rank) for data, rank in ranks.items() if usable[rank]]
        data, offsets = flat(pa.array([d for d, _ in names], pa.large_binary()))
        prefix, down = spans(BYTE_VALUE[data], BYTES)
        value = span_hash(prefix, down, offsets[:-1], offsets[1:])
        order = np.argsort(value)
        self.token_hash, self.token_rank = value[order], np.array([r for _, r in names])[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[value >> U64(42)] = True
        self.memo_key, self.memo_ok = np.full(MEMO, -1, np.int64), np.zeros(MEMO, bool)
        self.longest = max((len(d) for d, _ in names), default=1)

    def valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Can token b follow token a inside one piece?"""
        key = a << 32 | b
        slot = (mix(key.astype(U64)) >> U64(44)).astype(np.int64)
        ok = self.memo_ok[slot]
        todo = np.flatnonzero(self.memo_key[slot] != key)
        if len(todo):
            fresh, back = np.unique(key[todo], return_inverse=True)
            found = self._walk(fresh >> 32, fresh & 0xFFFFFFFF)
            ok[todo] = found[back]
            slot = (mix(fresh.astype(U64)) >> U64(44)).astype(np.int64)
            self.memo_key[slot] = fresh
            # two fresh keys may share a slot; the one that stands there wins
            mine = self.memo_key[slot] == fresh
            self.memo_ok[slot[mine]] = found[mine]
        return ok

    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            joined = (self.pair_key[at] == key) & (self.pair_rank[at] < limit)
            ok[live[joined]] = False
            order_a, order_b = self.order[a], self.order[b]
            go = ~joined & ((order_a >= 0) | (order_b >= 0))
            live, a, b, order_a, order_b = live[go], a[go], b[go], order_a[go], order_b[go]
            undo_a = order_a > order_b
            # of equal merges the left one comes first
            limit = np.where(undo_a, order_a, order_b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def encode(self, cut: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        data, offsets = flat(pa.array(cut, pa.large_binary()))
        prefix, down = spans(BYTE_VALUE[data], BYTES)
        depth = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1
        ends, sizes, tokens = [], [], []
        for length in range(1, min(self.longest, int(depth.max())) + 1):
            end = np.flatnonzero(depth >= length) + 1
            value = span_hash(prefix, down, end - length, end)
            maybe = np.flatnonzero(self.filter[value >> U64(42)])
            end, value = end[maybe], value[maybe]
            at = np.minimum(np.searchsorted(self.token_hash, value), len(self.token_hash) - 1)
            hit = self.token_hash[at] == value
            ends.append(end[hit])
            sizes.append(np.full(int(hit.sum()), length))
            tokens.append(self.token_rank[at[hit]])
        end, size, token = np.concatenate(ends), np.concatenate(sizes), np.concatenate(tokens)
        step = depth[end - 1]
        order = np.argsort(step, kind="stable")
        end, size, token, step = end[order], size[order], token[order], step[order]
        edge = np.searchsorted(step, np.arange(1, step[-1] + 2))
        # last[p]: the last token of the prefix that ends before byte p of the joined data
        last = np.full(len(data) + 1, -1, np.int64)
        last_size = np.zeros(len(data) + 1, np.int64)
        for i in range(len(edge) - 1):
            e, n, t = (x[edge[i] : edge[i + 1]] for x in (end, size, token))
            good = n == i + 1
            inner = np.flatnonzero(~good)
            good[inner] = self.valid(last[e[inner] - n[inner]], t[inner])
            last[e[good]], last_size[e[good]] = t[good], n[good]
        # read every piece backwards; write ids from the right
        at, live = offsets[1:].copy(), np.arange(len(cut))
        owners, steps, ids = [], [], []
        k = 0
        while len(live):
            here = at[live]
            owners.append(live)
            steps.append(np.full(len(live), -k))
            ids.append(last[here])
            at[live] = here - last_size[here]
            live = live[at[live] > offsets[live]]
            k += 1
        owner, back, token = np.concatenate(owners), np.concatenate(steps), np.concatenate(ids)
        if (token < 0).any():
            raise ValueError("the vocabulary lacks a single byte")
        order = np.lexsort((back, owner))
        packed = token[order].astype("<u4").tobytes()
        edges = (4 * np.searchsorted(owner[order], np.arange(len(cut) + 1))).tolist()
        return [packed[a:b] for a, b in zip(edges, edges[1:])]


class Encoder:
    """Encoding and decoding with a rank table and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.cutter = Cutter() if pattern == KNOWN_PATTERN else None
        self.token: dict[int, bytes] = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        last = max(ranks.values(), default=-1) + 1
        self.token_size = np.array([len(self.token.get(i, b"")) for i in range(last)], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_size)[:-1]]).astype(np.int64)
        self.token_data = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(last)), np.uint8)
        # by left token << 32 | right token: a number takes a third of the memory of a pair
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.joins: Joins | None = None

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """Tokens of a short byte string by merging the pair of lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            options = [(self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(options)
            if rank == 1 << 62:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[x] for x in parts]

    def halves(self, data: bytes) -> list[int]:
        """The two tokens whose merge makes ``data``."""
        return self.merged(data, down_to=2)

    def fits(self, left: int, right: int) -> bool:
        """Can ``right`` follow ``left`` (-1: nothing) inside one piece?"""
        if left < 0:
            if right not in self.alone:
                self.alone[right] = self.merged(self.token[right]) == [right]
            return self.alone[right]
        key = int(left) << 32 | int(right)
        if key not in self.pairs:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merged(self.token[left] + self.token[right]) == [left, right]
        return self.pairs[key]

    def append(self, state: Prefixes, more: bytes) -> Prefixes:
        """Extend ``state`` in place by the bytes of the same piece; earlier entries stay as they are."""
        ranks, last, data, fits = self.ranks, state.last, state.data, self.fits
        begin = len(data)
        data += more
        whole = bytes(data)
        for end in range(begin + 1, len(whole) + 1):
            for start in range(max(0, end - self.longest), end):
                token = ranks.get(whole[start:end])
                if token is not None and fits(last[start], token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        return state

    def edit(self, state: Prefixes, start: int, end: int, new: bytes) -> Prefixes:
        """The state after bytes start..end gave way to ``new``; prefixes before ``start`` are reused."""
        tail = bytes(state.data[end:])
        kept = Prefixes(state.data[:start], state.last[: start + 1])
        return self.append(kept, new + tail)

    def tokens(self, state: Prefixes) -> list[int]:
        """Token ids of the whole state, read back from the last prefix."""
        out, end = [], len(state.data)
        while end:
            out.append(state.last[end])
            end -= len(self.token[out[-1]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is a token stays whole, as merging never gets to split it."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tokens(self.append(Prefixes(), data))

    def encode_pieces(self, cut: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces; tokens stay whole, short pieces go through ``Joins`` together."""
        if self.joins is None:
            self.joins = Joins(self)
        out: list[bytes | None] = [None] * len(cut)
        short = []
        for i, data in enumerate(cut):
            if data in self.ranks or len(data) > LONG_PIECE:
                out[i] = np.array(self.encode_piece(data), "<u4").tobytes()
            else:
                short.append(i)
        if short:
            for i, ids in zip(short, self.joins.encode([cut[i] for i in short])):
                out[i] = ids
        return out

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, first id of each text with one closing entry)."""
        if self.cutter is None:
            parts = [[x.encode() for x in self.split.findall(t)] for t in texts.fill_null("").to_pylist()]
            data, edges = flat(pa.array([x for part in parts for x in part], pa.large_binary()))
            begin, end = edges[:-1], edges[1:]
            first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        else:
            data, offsets = flat(texts)
            begin = self.cutter.starts(data, offsets)
            end = np.append(begin[1:], len(data))
            first = np.searchsorted(begin, offsets)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(first), np.int64)
        # every distinct piece of the batch once
        value = span_hash(*spans(BYTE_VALUE[data], BYTES), begin, end)
        _, index, back = np.unique(value, return_index=True, return_inverse=True)
        raw = data.tobytes()
        cut = [raw[a:b] for a, b in zip(begin[index].tolist(), end[index].tolist())]
        ids = list(map(self.known.get, cut))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            if len(self.known) + len(missing) > CACHE_PIECES:
                self.known.clear()
            for i, x in zip(missing, self.encode_pieces([cut[i] for i in missing])):
                ids[i] = x
                if len(cut[i]) <= LONG_PIECE:
                    self.known[cut[i]] = x
        sizes = np.array(list(map(len, ids)), np.int64) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        offset = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=offset[1:])
        out, edges = gather(pool, offset[back], sizes[back])
        if not np.array_equal(self.decode(out), data):
            raise ValueError("two pieces of a batch share their 64-bit hash")
        return out, edges[first]

    def encode(self, text: str) -> list[int]:
        return self.encode_many(pa.array([text], pa.large_string()))[0].tolist()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of some ids."""
        ids = np.asarray(ids, np.int64)
        return gather(self.token_data, self.token_at[ids], self.token_size[ids])[0]

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each id."""
        return self.token_size[ids]


def gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """pool[start:start + size] of all entries, joined, and where each begins (with the total)."""
    edges = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=edges[1:])
    return pool[np.arange(edges[-1]) + np.repeat(start - edges[:-1], size)], edges


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(lines: bytes, pattern: str) -> Encoder:
    """One encoder per worker, vocabulary and pattern."""
    key = (hash(lines), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(load_ranks(lines), pattern)
    return _encoders[key]


def encode_documents(
    docs: DataFrame, vocabulary: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True
) -> DataFrame:
    """The ``keep`` columns with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and the ``ids`` of every whole text.

    ``vocabulary`` is the content of a rank file (under a megabyte; it travels as a
    broadcast). Every match of ``pattern`` is encoded by itself; no special tokens.
    Null counts as the empty text, which has no tokens. No shuffle.
    """
    rows = docs.select(*keep, text_of().alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
    names = list(keep)
    lines = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Batches) -> Batches:
        engine = encoder(lines.value, pattern)
        for batch in batches:
            for piece in pieces(batch, "__text", ENCODE_BYTES):
                ids, first = engine.encode_many(piece.column("__text"))
                decoded = engine.decode(ids).tobytes()
                at = np.zeros(len(ids) + 1, np.int64)
                np.cumsum(engine.sizes(ids), out=at[1:])
                at, raw, edges = at[first].tolist(), ids.tobytes(), (4 * first).tolist()
                columns = [
                    *[piece.column(c) for c in names],
                    pa.array(np.diff(first)),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(edges, edges[1:])], pa.string()),
                    pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                ]
                out = [*names, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    out.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=out)
                # nothing of this piece stays while the next one is worked on
                del piece, ids, first, decoded, at, raw, edges, columns
            release()

    schema = f"{fields}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def decode_documents(rows: DataFrame, vocabulary: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the ``text`` of ``ids``; bytes that are no UTF-8 become U+FFFD."""
    chosen = rows.select(*keep, "ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.drop("ids").schema)
    names = list(keep)
    lines = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Batches) -> Batches:
        engine = encoder(lines.value, pattern)
        for batch in batches:
            texts = [engine.decode(x or []).tobytes().decode(errors="replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "text"])

    return chosen.mapInArrow(run, f"{fields}, text string")
