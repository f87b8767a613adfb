"""Token ids in Arrow IPC files of fixed-size-list batches.

Documents are range-partitioned by doc_id, so that files in name order hold all ids in ascending doc_id order. A file
is a run of equal-length sequences: `ids` is a fixed-size list of uint16 or uint32 (by vocabulary size) and `mask` a
fixed-size list of booleans that is false on the padding of the file's last sequence. The schema's metadata name the
sequence length. Beside it an index file holds doc_id, first id and number of ids of each document. Both are written
under a temporary name and renamed, so a task that runs again leaves the same file. Readers map a local file and
slice its buffers without copying: sequence i of batch b is a view of the file's pages.

Words recur, so each worker encodes a word (cut at white space, ASCII letters lower-cased, a comma or stop after a
letter apart) once with the library and keeps its ids in a bounded table: the tokenizer splits at those places
anyway. Texts that hold "<|" may spell special tokens and go to the library whole.

Edge cases: null texts are empty, and an empty text has only the end id; rows with a null doc_id come first; rows
that repeat a doc_id follow each other in the order of their texts; an empty table writes no files; extra columns
are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .textarrays import IS_SPACE, slices

SEQUENCE, END_ID = 2048, 1
BATCH_ROWS = 64
KEPT_WORDS = 600_000
TARGET_PARTITION_ROWS = 10_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of words, from the library once each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.kept: dict[bytes, bytes] = {}
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.splitter, self.split_id = next(iter(special.items()))
        kind = json.loads(self.library.to_str())
        suffix = kind["model"].get("end_of_word_suffix")
        self.plain, self.word_end = Tokenizer.from_file(path), None
        if suffix:
            self.plain.normalizer = normalizers.Sequence([])
            self.word_end = np.zeros(max(self.library.get_vocab().values()) + 1, bool)
            self.word_end[[i for piece, i in self.library.get_vocab().items() if piece.endswith(suffix)]] = True
        # Words apart equal words together only where white space is dropped and nothing is put around a text.
        self.by_words = "Lowercase" in json.dumps(kind["normalizer"]) and "\\\\s+" in json.dumps(kind["normalizer"]) and kind["pre_tokenizer"]["pretokenizers"][0]["behavior"] == "Removed"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Encodes new words, some thousand in one text: words of plain letters parted by blanks, others by a special token."""
        if len(self.kept) + len(words) > KEPT_WORDS:
            self.kept.clear()
        texts = {w: w.decode() for w in words}
        # Letters below U+0250 in lower case: normalising leaves them as they are, and each is one pre-token.
        plain = [w for w, t in texts.items() if t.isalpha() and (t.isascii() or max(t) < "\u0250" and t == t.lower())] if self.word_end is not None else []
        rest = list(texts.keys() - set(plain))
        for group, tool, joint in [*((plain[i : i + 2000], self.plain, " ") for i in range(0, len(plain), 2000)), *((rest[i : i + 2000], self.library, self.splitter) for i in range(0, len(rest), 2000))]:
            e = tool.encode_batch_fast([joint.join(texts[w] for w in group)], add_special_tokens=False)[0]
            ids = np.array(e.ids, np.int64)
            ends = np.flatnonzero(self.word_end[ids]) + 1 if joint == " " else np.append(np.flatnonzero(ids == self.split_id), len(ids))
            if len(ends) != len(group):
                raise ValueError("the tokenizer joins or splits words in another way than thought")
            starts = np.append(0, ends[:-1] + (joint != " "))
            flat, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            self.kept.update((w, flat[a:b]) for w, a, b in zip(group, (starts * size).tolist(), (ends * size).tolist(), strict=True))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Ids of each row of a slice, and how many."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if not self.by_words or b"<|" in raw:
            out = self._whole([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        else:
            low = raw.lower()  # bytes: ASCII letters only
            b = np.frombuffer(low, np.uint8)
            letter = (b >= 97) & (b <= 122)
            apart = np.flatnonzero(letter[:-1] & ((b[1:] == 44) | (b[1:] == 46))) + 1
            row_end = np.zeros(len(b) + 1, bool)
            row_end[offsets] = True
            apart = apart[~row_end[apart]]
            marks = np.concatenate([apart, offsets[1:-1]])
            text = np.insert(b, marks, np.where(np.arange(len(marks)) < len(apart), 32, 10)).tobytes() if len(marks) else low
            words = text.split()
            own = set(words)
            new = own.difference(self.kept)
            if new:
                self._learn(list(new if len(self.kept) + len(new) <= KEPT_WORDS else own))
            got = list(map(self.kept.__getitem__, words))
            padded = np.frombuffer(text, np.uint8)
            inside = ~IS_SPACE[padded]
            starts = np.flatnonzero(inside & np.append(True, ~inside[:-1])) if len(inside) else np.zeros(0, np.int64)
            shift = offsets[1:-1] + np.searchsorted(np.sort(apart), offsets[1:-1]) + np.arange(n - 1)
            cut = np.concatenate([[0], np.searchsorted(starts, shift), [len(starts)]]).tolist()
            out = [b"".join(got[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
        return out, np.array([len(x) for x in out], np.int64) // self.dtype.itemsize


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    fields = [pa.field("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), pa.field("mask", pa.list_(pa.bool_(), length))]
    return pa.schema(fields, metadata={"sequence": str(length)})


class _Sequences:
    """Writes a stream of ids as batches of equal-length sequences."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.schema, self.dtype, self.length = sequence_schema(dtype, length), dtype, length
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held, self.size, self.total = [], 0, 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.dtype.itemsize
        if self.size >= BATCH_ROWS * self.length * self.dtype.itemsize:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        step = BATCH_ROWS * self.length
        whole = len(flat) // step * step
        for a in range(0, whole, step):
            self._batch(flat[a : a + step], step)
        rest = flat[whole:]
        if last and len(rest):
            self._batch(rest, len(rest))
            rest = rest[:0]
        self.held, self.size = [rest.tobytes()], rest.nbytes

    def _batch(self, ids: np.ndarray, real: int) -> None:
        n = -(-real // self.length) * self.length
        full = np.zeros(n, self.dtype)
        full[:real] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, np.arange(n) < real)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        self.writer.close()


def _write(path: str, folder: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        enc = encoder(path)
        names = {kind: f"{root}/{kind}-{part:08d}.arrow" for kind in ("ids", "index")}
        end = np.array([END_ID], enc.dtype).tobytes()
        sink = store.open_output_stream(f"{names['ids']}.{attempt}")
        out = _Sequences(sink, enc.dtype, length)
        docs = 0
        index = store.open_output_stream(f"{names['index']}.{attempt}")
        schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
        with pa.ipc.new_file(index, schema) as where:
            for batch in batches:
                for lo, hi, data, offsets in slices(batch.column("text")):
                    ids, counts = enc.encode(data, offsets)
                    first = out.total + np.concatenate([[0], np.cumsum(counts + 1)[:-1]])
                    where.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(first), pa.array(counts + 1)], schema=schema))
                    out.add(b"".join(x for i in ids for x in (i, end)))
                    docs += hi - lo
        out.close()
        sink.close()
        index.close()
        for name in names.values():
            store.move(f"{name}.{attempt}", name)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, docs, out.total)], names=["part", "docs", "tokens"])

    return run


def write_tokens(docs: DataFrame, folder: str, sequence: int = SEQUENCE, tokenizer: str | None = None, partitions: int | None = None) -> DataFrame:
    """Encodes and writes all documents below `folder` (a URI that driver and executors reach). Returns the manifest:
    part, docs, tokens and `start`, the ids in all files before; it has a row for each file."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.length("text"), F.xxhash64("text"))
    parts = ordered.mapInArrow(_write(tokenizer or default_tokenizer(), folder, sequence), "part long, docs long, tokens long").collect()
    rows, start = [], 0
    for r in sorted(parts):
        rows.append((r.part, r.docs, r.tokens, start))
        start += r.tokens
    return spark.createDataFrame(rows, "part long, docs long, tokens long, start long")


def read_ids(table: pa.Table) -> np.ndarray:
    """All ids of a file, padding left out; a view of its buffers where one batch holds them."""
    chunks = [c.flatten().to_numpy() for c in table.column("ids").chunks]
    real = sum(int(pc.sum(c.flatten().cast(pa.int64())).as_py()) for c in table.column("mask").chunks)
    return (chunks[0] if len(chunks) == 1 else np.concatenate(chunks))[:real] if chunks else np.zeros(0, np.uint16)


class TokenFile:
    """Random access to one file: sequence i as a view of the mapped pages."""

    def __init__(self, uri: str):
        store, path = _file_system(uri)
        self.source = pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = int(self.reader.schema.metadata[b"sequence"])
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else BATCH_ROWS

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence i."""
        batch = self.reader.get_batch(i // self.rows)
        at = i % self.rows
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)[at * self.length : (at + 1) * self.length]
        return ids, batch.column("mask")[at].values.to_numpy(zero_copy_only=False)

    def tokens(self, first: int, count: int) -> np.ndarray:
        """Ids first to first + count, whatever sequences they span."""
        step = self.rows * self.length
        parts = []
        while count > 0:
            batch = self.reader.get_batch(first // step).column("ids").flatten().to_numpy()
            piece = batch[first % step : first % step + count]
            parts.append(piece)
            first, count = first + len(piece), count - len(piece)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), strict=True):
                store, root = _file_system(folder)
                file = TokenFile(f"{folder}/ids-{part:08d}.arrow")
                with store.open_input_file(f"{root}/index-{part:08d}.arrow") as source, pa.ipc.open_file(source) as reader:
                    for k in range(reader.num_record_batches):
                        index = reader.get_batch(k)
                        first, count = index.column("first").to_numpy(), index.column("n_tokens").to_numpy()
                        if not len(first):
                            continue
                        ids = file.tokens(int(first[0]), int(count.sum())).astype("<u4")
                        ends = np.cumsum(count)
                        raw = memoryview(ids).cast("B")
                        sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), count.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([index.column("doc_id"), pa.array(start + first), pa.array(count), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = manifest.select("part", "start").repartition(max(1, manifest.count()), "part")
    return files.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, sequence: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """Writes to the shared folder, then reads the files back."""
    folder = Scratch(docs.sparkSession, "tokens").path("files")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    return read_tokens(write_tokens(docs, folder, sequence, tokenizer), folder)
