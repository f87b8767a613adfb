"""SentencePiece (BPE) encoding with seeded merge-dropout, and its lossless decoding.

The model file gives pieces and scores. Text is cut before each run of blanks, which no piece crosses, so words are
merged apart from each other. Among a word's candidate merges the best score goes first, the leftmost among equals.
Every candidate is judged once, when it arises: a hash keyed by seed, document, word number, position and merged
piece skips it with the given probability. This equals an agenda that pops candidates and passes over the skipped
ones. Words of one length form a matrix, and each round makes the next merge of all of them, so the work is NumPy
over arrays, not a loop over words. Words above `MATRIX` characters, which are few, go through a heap; both choose by
score, then place.

With probability 0 the ids are the library's own, except that U+2581 (the model's blank) in a text goes to byte
pieces, so that it is told from a blank. Characters without a piece are bytes too; hence decoding returns the text.

Edge cases: null text gives null ids and decodes to null; empty text gives no ids; a null doc_id hashes as 0; equal
rows get equal ids; very long texts are one slice of their own; extra columns are kept by `encode` and `decode`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textarrays import U64, mix, slices

DROPOUT, SEED = 0.1, 7
BLANK = 0x2581
SLICE = 1 << 18
MATRIX, PLACE_BITS = 32, 5
NEVER = np.int32(2**31 - 1)
OTHER = 0xFFFFFFFF


class Vocabulary:
    """Tables made from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int64)
        text = [b""] * n
        for i, p in enumerate(pieces):
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                text[i] = bytes([int(p[3:5], 16)])
            elif not special[i]:
                text[i] = p.replace(chr(BLANK), " ").encode()
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        merges = [(ids[p[:k]], ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        if n > 1 << 20 or self.rank.max() >= 1 << (31 - PLACE_BITS):
            raise ValueError("a pair packs two pieces of 20 bits, a candidate its rank above the place")
        self._hash([a << 20 | b for a, b, _ in merges], [c for _, _, c in merges])
        self.lengths = np.array([len(t) for t in text], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])

    def _hash(self, keys: list[int], values: list[int]) -> None:
        """Open addressing, so that looking up a whole array of pairs takes few gathers."""
        self.bits = max(10, (8 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        k, v = np.array(keys, np.int64), np.array(values, np.int32)
        at = self._slot(k)
        while len(k):
            free = self.keys[at] < 0
            _, one = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            one = one[free[one]]
            self.keys[at[one]], self.values[at[one]] = k[one], v[one]
            left = np.ones(len(k), bool)
            left[one] = False
            k, v, at = k[left], v[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, k: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((k.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that a and b make, or -1."""
        k = a.astype(np.int64) << 20 | b
        bad = (a < 0) | (b < 0)
        at = self._slot(k)
        found = self.keys[at]
        out = np.where((found == k) & ~bad, self.values[at], -1)
        more = np.flatnonzero((found != k) & (found >= 0) & ~bad)
        while len(more):
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[more]]
            hit = found == k[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of a slice, and where each row's begin."""
    chars = np.frombuffer(bytes(data).decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return chars, begins[offsets]


def _limit(dropout: float) -> int:
    return min(int(dropout * 2.0**64), (1 << 64) - 1)


def merge_long(v: Vocabulary, symbols: np.ndarray, salt: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, positions) after all merges of one word, by a heap of candidates: time grows with length times logarithm."""
    n = len(symbols)
    sym = symbols.tolist()
    with np.errstate(over="ignore"):
        keys = mix(U64(salt) + np.arange(n, dtype=U64))
        limit = _limit(dropout)

        def judged(at: list[int], a: list[int], b: list[int]) -> list[tuple]:
            m = v.merged(np.array(a, np.int64), np.array(b, np.int64))
            hashes = mix(keys[at] ^ (m.astype(U64) * U64(0x9E3779B97F4A7C15)))
            return [(int(v.rank[x]), p, x, l, r) for p, x, h, l, r in zip(at, m.tolist(), hashes.tolist(), a, b, strict=True) if x >= 0 and (not dropout or h >= limit)]

        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        agenda = judged(list(range(n - 1)), sym[:-1], sym[1:]) if n > 1 else []
        heapify(agenda)
        while agenda:
            _, p, piece, a, b = heappop(agenda)
            q = after[p]
            if sym[p] != a or q < 0 or sym[q] != b:
                continue
            sym[p], sym[q], after[p] = piece, -9, after[q]
            if after[q] >= 0:
                before[after[q]] = p
            ends = [(x, y) for x, y in ((before[p], p), (p, after[p])) if x >= 0 and y >= 0]
            for c in judged([x for x, _ in ends], [sym[x] for x, _ in ends], [sym[y] for _, y in ends]) if ends else ():
                heappush(agenda, c)
    left = np.flatnonzero(np.array(sym) != -9)
    return np.array(sym)[left], left


def _judge(v: Vocabulary, a: np.ndarray, b: np.ndarray, key: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, piece, order) of the candidates that left and right symbols make and their hash doesn't skip."""
    m = v.merged(a, b)
    some = np.flatnonzero(m >= 0)
    m = m[some]
    if limit:
        with np.errstate(over="ignore"):
            kept = mix(key[some] ^ (m.astype(U64) * U64(0x9E3779B97F4A7C15))) >= U64(limit)
        some, m = some[kept], m[kept]
    return some, m, v.rank[m]


def _merge_matrix(v: Vocabulary, sym: np.ndarray, salts: np.ndarray, limit: int) -> np.ndarray:
    """Symbols after all merges of words of one length, a word a column; a piece stands where its first character stood, the
    rest of its places hold -2. Candidates are ordered by score, then by place, as in `merge_long`."""
    size, n = sym.shape
    out = np.full((size, n), -2, np.int32)
    word = np.arange(n)
    # Flat, place by place; a last row stands for the words' ends.
    sym = np.concatenate([sym, np.full((1, n), -9, np.int32)]).ravel()
    after = np.repeat(np.arange(1, size + 2, dtype=np.int32), n)
    before = np.repeat(np.arange(-1, size, dtype=np.int32), n)
    cand, piece = np.full(size * n, NEVER), np.zeros(size * n, np.int32)
    with np.errstate(over="ignore"):
        keys = mix(salts[None, :] + np.arange(size, dtype=U64)[:, None]).ravel() if limit else np.zeros(size * n, U64)
        some, m, rank = _judge(v, sym[: (size - 1) * n], sym[n : size * n], keys, limit)
    cand[some], piece[some] = rank << PLACE_BITS | some // n, m
    while True:
        best = cand.reshape(size, -1).min(axis=0)
        live = np.flatnonzero(best != NEVER)
        if len(live) < 0.7 * len(best):
            over = np.flatnonzero(best == NEVER)
            out[:, word[over]] = sym.reshape(size + 1, -1)[:size].take(over, axis=1)
            sym, after, before, cand, piece, keys = (x.reshape(-1, len(best)).take(live, axis=1).ravel() for x in (sym, after, before, cand, piece, keys))
            word, best, live = word[live], best[live], np.arange(len(live))
        n = len(word)
        if not n:
            return out
        win = best[live] & ((1 << PLACE_BITS) - 1)
        at = win * n + live
        right = after[at] * n + live
        beyond = after[right]
        sym[at], sym[right], after[at] = piece[at], -2, beyond
        beyond = beyond * n + live
        before[beyond] = win
        cand[at] = NEVER
        whole = beyond < size * n
        cand[right[right < size * n]] = NEVER
        left = before[at]
        has = left >= 0
        left = left[has] * n + live[has]
        cand[left] = NEVER
        first, second = np.concatenate([left, at[whole]]), np.concatenate([at[has], beyond[whole]])
        some, m, rank = _judge(v, sym[first], sym[second], keys[first], limit)
        first = first[some]
        cand[first], piece[first] = rank << PLACE_BITS | first // n, m


def encode_slice(v: Vocabulary, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids as int32, bounds by row) of whole texts. salts: a 64-bit key per row."""
    n = len(offsets) - 1
    chars, at = _code_points(data, offsets)
    full = np.diff(at) > 0
    # Each row that is not empty gets a blank before it.
    begin = at[:-1] + np.cumsum(full) - full
    total = len(chars) + int(full.sum())
    own = np.ones(total, bool)
    own[begin[full]] = False
    text = np.full(total, BLANK, np.uint32)
    text[own] = np.where(chars == BLANK, OTHER, np.where(chars == 32, BLANK, chars))
    head = text == BLANK
    head[1:] &= ~head[:-1]
    head |= ~own
    starts = np.flatnonzero(head)
    size = np.diff(np.append(starts, total))
    row = np.flatnonzero(full)[np.searchsorted(begin[full], starts, side="right") - 1]
    number = np.arange(len(starts)) - np.searchsorted(row, row)
    with np.errstate(over="ignore"):
        salt = mix(salts[row] + number.astype(U64))
    sym = np.where(text < 0x110000, v.char_ids[np.where(text < 0x110000, text, 0)], -1).astype(np.int32)
    limit = _limit(dropout)
    done = np.full(total, -2, np.int32)
    by_size = np.argsort(size, kind="stable")
    cuts = np.searchsorted(size[by_size], np.arange(1, MATRIX + 2))
    for length, a, b in zip(range(1, MATRIX + 1), cuts[:-1], cuts[1:], strict=True):
        words = by_size[a:b]
        if not len(words):
            continue
        where = starts[words] + np.arange(length)[:, None]
        done[where] = _merge_matrix(v, sym[where], salt[words], limit)
    for w in by_size[cuts[-1] :].tolist():
        ids, pos = merge_long(v, sym[starts[w] : starts[w] + size[w]], int(salt[w]), dropout)
        done[starts[w] + pos] = ids
    where = np.flatnonzero(done != -2)
    ids = done[where]
    odd = ids == -1
    if odd.any():  # characters without a piece become bytes
        coded = [chr(BLANK if c == OTHER else c).encode() for c in text[where[odd]].tolist()]
        reps = np.ones(len(ids), np.int64)
        reps[odd] = [len(c) for c in coded]
        spread = np.repeat(odd, reps)
        where, ids = np.repeat(where, reps), np.repeat(ids, reps)
        ids[spread] = v.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    return ids, np.searchsorted(where, np.append(begin, total))


def decode_slice(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by row): the pieces' bytes without the blank that encoding puts first."""
    length = v.lengths[ids]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    out = v.bytes[np.arange(total) + np.repeat(v.offsets[ids] - (ends - length), length)]
    offsets = np.concatenate([[0], ends])[bounds]
    full = np.flatnonzero(np.diff(bounds))
    first = ids[bounds[:-1][full]]
    lead = (v.lengths[first] > 0) & (v.bytes[np.minimum(v.offsets[first], len(v.bytes) - 1)] == 32) & ~v.is_byte[first]
    cut = np.zeros(len(bounds), np.int64)
    cut[full + 1] = lead
    keep = np.ones(total, bool)
    keep[offsets[:-1][full[lead]]] = False
    return out[keep], offsets - np.cumsum(cut)


def _salts(ids: pa.Array, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.asarray(pc.fill_null(ids.cast(pa.int64()), 0)).view(U64) * U64(0xD1342543DE82EF95) + mix(np.array([seed], U64)))


def _texts(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray, null: pa.Array) -> pa.Array:
    data, offsets = decode_slice(v, ids, bounds)
    text = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return pc.if_else(null, pa.scalar(None, pa.string()), text.cast(pa.binary()).cast(pa.string()))


def encode(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str | None = None, decoded: str | None = None) -> DataFrame:
    """`docs` (doc_id, text and any others) with `ids` added: array<int>; and, where `decoded` names a column, the text
    that the ids decode to, in the same pass and worker."""
    path = model or default_model()
    names = docs.columns
    id_at, text_at = names.index("doc_id"), names.index("text")
    schema = docs.select(*names).schema.add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            text = batch.column(text_at)
            salts = _salts(batch.column(id_at), seed)
            for lo, hi, data, offsets in slices(text, SLICE):
                ids, bounds = encode_slice(v, data, offsets, salts[lo:hi], dropout)
                null = pc.is_null(text.slice(lo, hi - lo))
                cols = [*(batch.column(i).slice(lo, hi - lo) for i in range(len(names))), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids), mask=null)]
                if decoded:
                    cols.append(_texts(v, ids, bounds, null))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, out: str = "decoded", model: str | None = None) -> DataFrame:
    """`encoded` with the text of its `ids` added."""
    path = model or default_model()
    names = encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                ids = part.column(at)
                empty = pc.fill_null(ids, pa.scalar([], ids.type))
                bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(empty).to_numpy(zero_copy_only=False))]).astype(np.int64)
                text = _texts(v, empty.flatten().to_numpy(zero_copy_only=False).astype(np.int64), bounds, pc.is_null(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*names, out])

    return encoded.mapInArrow(run, encoded.select(*names).schema.add(out, T.StringType()))
