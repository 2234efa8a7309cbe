"""Token ids in binary shards, each document compressed alone with a shared zstandard dictionary.

Texts are encoded by a ``tokenizers`` file, an end id is appended, and the ids become little-endian numbers of two
bytes (four, if the vocabulary needs them). A dictionary trained on such arrays of a bounded sample makes even short
documents compress well alone, so that one document is read without its neighbours.

A shard holds, one after another::

    b"TOKSHRD1"
    one zstandard frame per document
    index: document ids (int64), whether each id is there (uint8), tokens of each document (int64),
           frame starts and the end of the last (int64)
    footer of 72 bytes: start of the index, documents, tokens (int64 each), bytes per id (int64),
           SHA-256 of the dictionary, b"TOKSHRD1"

Documents are range partitioned and sorted by id; a task writes its shard under a name no other attempt uses and
returns one manifest row, so a repeated task leaves at most an unlisted file. The manifest (one row per shard) is
written as Parquet beside the shards, and names the shards in order; places of documents are sums over it.

Rules: the string of an added token in a text is that token, as the library has it by default; a null or empty text
holds the end id alone; rows without doc_id come first; rows that repeat a doc_id follow
one another in the order of their texts; an empty table gives no shards. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from jobscape.llm.common import chunks, text_bytes
from jobscape.llm.words import pattern_tokenizer

MAGIC = b"TOKSHRD1"
FOOTER = "<qqqq32s8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
READ_BYTES = 8 << 20


@lru_cache(2)
def encoder(path: str) -> tuple[Callable[[list[str | None] | pa.Array], tuple[np.ndarray, np.ndarray]], int]:
    """An encoder per worker process (ids of all texts end to end, and how many each has), and bytes per id."""
    ids_of = pattern_tokenizer(path)

    def encode(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return ids_of(*text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())))

    return encode, 2 if ids_of.tokenizer.get_vocab_size() <= 1 << 16 else 4


def _serialized(path: str, texts: pa.Array, end_id: int) -> Iterator[bytes]:
    ids_of, width = encoder(path)
    flat, sizes = ids_of(texts)
    ends = np.cumsum(sizes)
    flat = np.insert(flat, ends, end_id).astype(f"<u{width}").tobytes()
    at = (np.append(0, ends) + np.arange(len(sizes) + 1)) * width
    return (flat[a:b] for a, b in zip(at.tolist(), at[1:].tolist()))


def train_dictionary(
    docs: DataFrame, tokenizer: str, end_id: int = 0, sample_docs: int = 512, sample_chars: int = 16_384, size: int = 65_536
) -> bytes:
    """A dictionary for the id arrays of ``docs``, trained on the documents with the smallest hashed ids.

    The sample is bounded by ``sample_docs`` documents of ``sample_chars`` characters; it only shapes the
    compression. Samples too few to train on serve as the dictionary themselves.
    """
    picked = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = docs.join(F.broadcast(picked), "doc_id", "left_semi").select(F.substring("text", 1, sample_chars).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = list(_serialized(tokenizer, batch.column("text"), end_id))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    samples = sorted(bytes(r.ids) for r in rows.mapInArrow(run, "ids binary").limit(4 * sample_docs).collect())
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


def write_shards(docs: DataFrame, folder: str, tokenizer: str, dictionary: bytes, end_id: int = 0) -> DataFrame:
    """Writes the shards and the manifest of ``docs`` to an unused folder; returns the manifest."""
    spark = docs.sparkSession
    digest = hashlib.sha256(dictionary).digest()
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        pack = zstandard.ZstdCompressor(level=3, **_dictionary(dictionary))
        ids, tokens, starts, at, width = [], [], [], len(MAGIC), encoder(tokenizer)[1]
        out = None
        for batch in chunks(batches, "text"):
            if out is None:
                out = store.open_output_stream(f"{root}/{name}")
                out.write(MAGIC)
            ids += batch.column("doc_id").to_pylist()
            for raw in _serialized(tokenizer, batch.column("text"), end_id):
                frame = pack.compress(raw)
                out.write(frame)
                tokens.append(len(raw) // width)
                starts.append(at)
                at += len(frame)
        if out is None:
            return
        out.write(np.array([i or 0 for i in ids], "<i8").tobytes() + np.array([i is not None for i in ids], np.uint8).tobytes())
        out.write(np.array(tokens, "<i8").tobytes() + np.array([*starts, at], "<i8").tobytes())
        out.write(struct.pack(FOOTER, at, len(ids), sum(tokens), width, digest, MAGIC))
        out.close()
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "file": name, "n_docs": len(ids), "n_tokens": sum(tokens), "dictionary_sha256": digest.hex()}]
        )

    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").write.parquet(f"{folder}/dictionary-{digest.hex()}")
    manifest = ordered.mapInArrow(run, "shard long, file string, n_docs long, n_tokens long, dictionary_sha256 string")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _index(file: pa.NativeFile) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, bytes]:
    """Document ids, whether they are there, tokens, frame bounds, bytes per id and the dictionary's hash."""
    size = file.size()
    file.seek(size - FOOTER_BYTES)
    at, n, _, width, digest, magic = struct.unpack(FOOTER, file.read(FOOTER_BYTES))
    if magic != MAGIC:
        raise ValueError("not a token shard")
    file.seek(at)
    raw = file.read(size - FOOTER_BYTES - at)
    return (
        np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool), np.frombuffer(raw, "<i8", n, 9 * n),
        np.frombuffer(raw, "<i8", n + 1, 17 * n), width, digest,
    )


def _unpacker(dictionary: bytes, digest: bytes) -> zstandard.ZstdDecompressor:
    if hashlib.sha256(dictionary).digest() != digest:
        raise ValueError("the shard was written with another dictionary")
    return zstandard.ZstdDecompressor(**_dictionary(dictionary))


def read_document(folder: str, name: str, nth: int, dictionary: bytes) -> np.ndarray:
    """Ids of one document of a shard; only the index and its frame are read."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{name}") as file:
        _, _, _, bounds, width, digest = _index(file)
        file.seek(int(bounds[nth]))
        frame = file.read(int(bounds[nth + 1] - bounds[nth]))
    return np.frombuffer(_unpacker(dictionary, digest).decompress(frame), f"<u{width}").astype(np.uint32)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian uint32) of every document."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    # A manifest row stands for a whole shard: one task for each.
    files = placed.select("file", "base", "dictionary_sha256").repartition(max(1, manifest.count()))
    hashes = [r[0] for r in manifest.select("dictionary_sha256").distinct().limit(2).collect()]
    if len(hashes) > 1:
        raise ValueError("the manifest names several dictionaries")
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary-{hashes[0]}").first()[0]) if hashes else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for name, base in ((r["file"], r["base"]) for b in batches for r in b.to_pylist()):
            with store.open_input_file(f"{root}/{name}") as file:
                ids, there, tokens, bounds, width, digest = _index(file)
                unpack = _unpacker(dictionary, digest)
                begin = base + np.cumsum(tokens) - tokens
                start = 0
                while start < len(ids):
                    end = max(int(np.searchsorted(bounds, bounds[start] + READ_BYTES, "right")) - 1, start + 1)
                    file.seek(int(bounds[start]))
                    raw = file.read(int(bounds[end] - bounds[start]))
                    at = (bounds[start : end + 1] - bounds[start]).tolist()
                    found = [np.frombuffer(unpack.decompress(raw[a:b]), f"<u{width}") for a, b in zip(at, at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[start:end], mask=~there[start:end]),
                            pa.array(begin[start:end]),
                            pa.array([len(f) for f in found], pa.int64()),
                            pa.array([f.astype("<u4").tobytes() for f in found], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    start = end

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
