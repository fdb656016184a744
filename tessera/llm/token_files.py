"""Token-id shards with a minimal perfect hash index from document keys to offsets.

A shard is two files.  NAME.bin holds raw ids, document after document, as
little-endian integers of 2 or 4 bytes.  NAME.idx holds a header and arrays:
the perfect hash (level sizes, bitmaps, listed rest), then for each slot the
key's 32-bit fingerprint, its first document and its number of documents, then
for each document its key and where its ids begin.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prefix_sums, shared_folder
from .perfect_hash import PerfectHash, stamps

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Characters of text that make a shard, about; it only sets the number of files.
SHARD_CHARS = 16_000_000
#: Distinct chunks whose ids a worker remembers; others are encoded again.
CACHE_MAX = 500_000
MAGIC = b"TSRIDX02"


def worker_store() -> dict:
    """What a reused Python worker keeps between tasks."""
    return sys.modules.setdefault("_tessera_worker_store", types.ModuleType("_tessera_worker_store")).__dict__


#: Marks at the end of a word are a piece of their own for the vocabulary, so they can be split off.  The letters
#: before them are those of basic and extended Latin, but for U+0130: its lower case is a letter and a mark, which joins
#: marks after it.  The look back stands after the first mark, so that a search only stops at marks.
_END_MARKS = re.compile("[!#$%&*.,:;?](?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][!#$%&*.,:;?])(?=[!#$%&*.,:;?]*(?:[ \\n]|\\Z))")
#: Marks that compose with ASCII letters, some of them with one case only.
_COMBINING = re.compile("[\u0300-\u036f]")


def spaced(text: str) -> str:
    """The text with its chunks apart by single blanks: pieces whose ids, in order, are the text's ids.

    The vocabulary's pre-tokenizer drops white space, never joins across it and
    takes marks after a letter as a new piece; its normalizer lowers case.
    Lower case here makes equal chunks meet more often; it is left out where it
    could matter: before control strings and beside combining marks.
    """
    if "<|" not in text:
        if text.isascii():
            text = text.lower()
        elif not _COMBINING.search(text):
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return _END_MARKS.sub(r" \g<0>", text).replace("\n", " ")


class Encoder:
    """Ids of whole texts, by way of chunks whose ids are remembered."""

    def __init__(self, name: str):
        # a task has its own core: the library's threads would only add work
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {"": b""}

    @classmethod
    def get(cls, name: str) -> Encoder:
        kept = worker_store().setdefault("encoders", {})
        if name not in kept:
            kept[name] = cls(name)
        return kept[name]

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        found = [self.known.get(c) for c in chunks]
        todo = [k for k, x in enumerate(found) if x is None]
        for at in range(0, len(todo), 4096):
            some = todo[at : at + 4096]
            for k, e in zip(some, self.tokenizer.encode_batch_fast([chunks[k] for k in some], add_special_tokens=False), strict=True):
                found[k] = np.array(e.ids, dtype=self.kind).tobytes()
        for k in todo[: max(0, CACHE_MAX - len(self.known))]:
            self.known[chunks[k]] = found[k]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text: its distinct chunks are looked up once and gathered into place."""
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([spaced(t) for t in texts], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        known = self.ids_of(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // self.kind.itemsize
        start, every = np.cumsum(size) - size, np.frombuffer(b"".join(known), self.kind)
        at = coded.indices.to_numpy()
        sizes = size[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = every[np.repeat(start[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        edges = ends[lists.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]


def groups_by_size(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """Runs of texts of about `most` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def key_hashes(keys: list[int | None]) -> np.ndarray:
    """64-bit keys; null has a key of its own, which is checked against the listed keys."""
    return np.array([0x6E756C6C6B657921 if k is None else k & (2**64 - 1) for k in keys], dtype=np.uint64)


def pack_index(keys: list[int | None], ends: np.ndarray, width: int) -> bytes:
    """keys: of the documents, equal ones together; ends: ids up to the end of each."""
    null = np.array([k is None for k in keys], dtype=bool)
    hashed = key_hashes(keys)
    first = np.flatnonzero(np.concatenate([[True], (hashed[1:] != hashed[:-1]) | (null[1:] != null[:-1])])) if keys else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([first, [len(keys)]]))
    # one long may share the null's hash: then the first of both is indexed and covers the other's documents
    unique, at = np.unique(hashed[first], return_index=True)
    mph = PerfectHash.build(unique)
    slot = mph.slot(unique)
    stamp, lead, many = np.zeros(len(unique), "<u4"), np.zeros(len(unique), "<u8"), np.zeros(len(unique), "<u4")
    stamp[slot], lead[slot], many[slot] = stamps(unique), first[at], count[at]
    parts = [*mph.arrays(), stamp, lead, many, hashed.astype("<u8"), null.astype("u1"), np.concatenate([[0], ends]).astype("<u8")]
    header = np.array([width, *(len(p) for p in parts)], dtype="<u8")
    return MAGIC + header.tobytes() + b"".join(p.tobytes() for p in parts)


class Shard:
    """A shard's files: keyed access by ranged reads, and the documents in order.

    A lookup hashes the key with the perfect hash, which is read when the shard
    is opened (about three bits for each key); the slot's fingerprint, place and
    ids are then read from their offsets, a few bytes each, at any shard size.
    """

    KINDS = ("<u8", "<u8", "<u8", "<u4", "<u8", "<u4", "<u8", "u1", "<u8")
    STAMP, LEAD, MANY, KEYS, NULL, STARTS = range(3, 9)

    def __init__(self, index: Callable[[int, int], bytes], payload: Callable[[int, int], bytes]):
        """index, payload: functions that read (offset, number of bytes) of the two files."""
        self.index, self.payload = index, payload
        head = index(0, 8 + 8 * (1 + len(self.KINDS)))
        if head[:8] != MAGIC:
            raise ValueError("not an index of this format")
        width, *self.sizes = np.frombuffer(head, "<u8", offset=8).astype(np.int64).tolist()
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.at = (len(head) + np.cumsum([0, *(n * np.dtype(k).itemsize for k, n in zip(self.KINDS, self.sizes, strict=True))])).tolist()
        self.mph = PerfectHash.of(*(self.part(k) for k in range(3)))

    @classmethod
    def open(cls, base: str, whole: bool = False) -> Shard:
        """whole: read both files at once, for a scan."""
        fs, path = pafs.FileSystem.from_uri(base)
        files = [fs.open_input_file(path + end) for end in (".idx", ".bin")]
        if whole:
            views = [memoryview(f.read()) for f in files]
            return cls(*(lambda at, n, v=v: v[at : at + n] for v in views))
        return cls(*(lambda at, n, f=f: f.read_at(n, at) for f in files))

    def part(self, k: int, first: int = 0, n: int | None = None) -> np.ndarray:
        """Entries first.. of an array of the index."""
        kind = np.dtype(self.KINDS[k])
        n = self.sizes[k] - first if n is None else n
        return np.frombuffer(self.index(self.at[k] + first * kind.itemsize, n * kind.itemsize), kind)

    def document(self, i: int) -> np.ndarray:
        a, b = self.part(self.STARTS, i, 2).tolist()
        return np.frombuffer(self.payload(a * self.kind.itemsize, (b - a) * self.kind.itemsize), self.kind)

    def find(self, key: int | None) -> list[np.ndarray]:
        """The ids of every document with that key; none if there is no such key."""
        k = key_hashes([key])
        s = int(self.mph.slot(k)[0])
        if s < 0 or self.part(self.STAMP, s, 1)[0] != stamps(k)[0]:
            return []
        first, n = int(self.part(self.LEAD, s, 1)[0]), int(self.part(self.MANY, s, 1)[0])
        if bool(self.part(self.NULL, first, 1)[0]) != (key is None) or self.part(self.KEYS, first, 1)[0] != k[0]:
            return []
        return [self.document(i) for i in range(first, first + n)]

    def scan(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, first id's place, ids) of every document, each reached through the perfect hash by its key."""
        keys, null, starts = self.part(self.KEYS), self.part(self.NULL), self.part(self.STARTS).astype(np.int64)
        slot = self.mph.slot(keys)
        if not (self.part(self.STAMP)[slot] == stamps(keys)).all():
            raise ValueError("a listed key is not in the index")
        lead, many = self.part(self.LEAD)[slot].astype(np.int64), self.part(self.MANY)[slot].astype(np.int64)
        place = np.arange(len(keys))
        if not ((lead <= place) & (place < lead + many)).all():
            raise ValueError("a document is outside its key's range")
        ids = np.frombuffer(self.payload(0, int(starts[-1]) * self.kind.itemsize), self.kind)
        for i, (k, absent) in enumerate(zip(keys.astype(np.int64).tolist(), null.tolist(), strict=True)):
            yield None if absent else k, int(starts[i]), ids[starts[i] : starts[i + 1]]


MANIFEST = "shard long, base string, nulls boolean, first_key long, last_key long, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Encode whole texts into shards in ascending key order, nulls first; a row of MANIFEST for each shard.

    The row: base (path without ending), whether a null key is in it, the range
    of its other keys, and its numbers of documents and ids.  Null texts are
    empty and still end in end_id.  Repeated keys stand together in one shard
    under one index entry.  An empty table writes no shard.  Files are written
    under a temporary name and moved, so a repeated task leaves one good copy.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    chars = docs.agg(F.sum(F.coalesce(F.length(text_col), F.lit(0)) + 200)).first()[0] or 0
    parts = max(1, -(-chars // shard_chars))
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    ordered = rows.repartitionByRange(parts, F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), F.xxhash64("t"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, path = pafs.FileSystem.from_uri(folder)
        base, mark = f"{path}/shard-{shard:06d}", uuid.uuid4().hex
        encoder, keys, sizes = Encoder.get(tokenizer), [], []
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        with fs.open_output_stream(f"{base}.{mark}.bin") as out:
            for b in batches:
                keys += b.column(0).to_pylist()
                for some in groups_by_size(b.column(1).to_pylist()):
                    for ids in encoder.encode(some):
                        out.write(ids + end)
                        sizes.append(len(ids) // encoder.kind.itemsize + 1)
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        if not keys:
            fs.delete_file(f"{base}.{mark}.bin")
            return
        with fs.open_output_stream(f"{base}.{mark}.idx") as out:
            out.write(pack_index(keys, ends, encoder.kind.itemsize))
        for end_of in ("bin", "idx"):
            fs.move(f"{base}.{mark}.{end_of}", f"{base}.{end_of}")
        named = [k for k in keys if k is not None]
        row = [shard, f"{folder}/shard-{shard:06d}", keys[0] is None, named[0] if named else None, named[-1] if named else None, len(keys), int(ends[-1])]
        kinds = [pa.int64(), pa.string(), pa.bool_(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["shard", "base", "nulls", "first_key", "last_key", "n_docs", "n_ids"])

    return ordered.mapInArrow(run, MANIFEST)


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with `before`: the ids in all shards before each; summed in runs of shards, then over the runs."""
    return prefix_sums(manifest, "n_ids", "before", "shard")


def find_documents(manifest: DataFrame, key: int | None) -> list[np.ndarray]:
    """The ids of every document with that key: the manifest names the one shard whose range holds it."""
    held = F.col("nulls") if key is None else F.lit(key).between(F.col("first_key"), F.col("last_key"))
    return [ids for r in manifest.where(held).select("base").collect() for ids in Shard.open(r.base).find(key)]


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the written files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(k, before + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for k, at, ids in Shard.open(base, whole=True).scan()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    table = with_starts(manifest).select("base", "before").repartition(max(1, manifest.count()))
    return table.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write token files and their manifest to a shared folder; describe each document as read back from them.

    A row for each row of docs: null keys come first, repeated keys together,
    null and empty texts have their end id only, very long texts are encoded
    whole, other columns are not read, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    write_token_files(docs, folder, **options).write.parquet(f"{folder}/manifest")
    return read_documents(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"))
