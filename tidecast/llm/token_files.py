"""Token ids in binary files, each document compressed on its own with a
zstandard dictionary that all files share.

Layout of a file: MAGIC, the dictionary's SHA-256 (32 bytes), the bytes of an
id (1: 2 or 4); then one zstandard frame for each document, in ascending
order of ``doc_id``; then the index (Arrow IPC: doc_id, offset, size,
n_tokens), its length (8 bytes) and MAGIC. A reader finds a short document by
its offset and decompresses nothing else.

Files are written by tasks straight to the shared folder under names that no
other attempt uses; the manifest, a Spark table, lists the files of the tasks
that succeeded, with the ids in all earlier files. Only listed files are read.

The dictionary is a model trained on a bounded, documented sample: about
``SAMPLE_DOCS`` documents, chosen by a hash of their id (twice as many at
most), and at most ``SAMPLE_IDS`` ids of each. Everything else covers all documents. Where there are too few
samples to train on, the dictionary is empty.

Defined results: a null or empty text is the end id alone; null ids come
first; documents with equal ids are ordered by their text; an empty table
gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import encoder, written
from tidecast.session import scratch_path

MAGIC = b"TOKZ0001"
END_ID = 2
SAMPLE_DOCS, SAMPLE_IDS = 2000, 1024
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3

MANIFEST = "part int, file string, n_docs long, n_tokens long, n_bytes long"
DOCS = "doc_id long, start long, ids binary"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Any store pyarrow knows; Hadoop writes local paths as file:/..."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _packed(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids


def _unpacked(data: bytes, width: int) -> bytes:
    return np.frombuffer(data, "<u2").astype("<u4").tobytes() if width == 2 else data


def id_width(vocabulary: str, end_id: int) -> int:
    return 2 if max(encoder(vocabulary).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> bytes:
    """A dictionary for serialized id arrays, from the bounded sample."""
    import zstandard

    width, tail = id_width(vocabulary, end_id), int(end_id).to_bytes(4, "little")
    every = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) \
        .select(F.substring("text", 1, 8 * SAMPLE_IDS).alias("text")).limit(2 * SAMPLE_DOCS).collect()
    arrays = [_packed((ids + tail)[:4 * SAMPLE_IDS], width)
              for ids in encoder(vocabulary).encode([r["text"] for r in sample])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _codec(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents below ``path``; returns the manifest with the ids
    in earlier files (``start``)."""
    dictionary = train_dictionary(docs, vocabulary, end_id)
    store, root = _filesystem(path)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    digest, width = hashlib.sha256(dictionary).digest(), id_width(vocabulary, end_id)
    tail = int(end_id).to_bytes(4, "little")
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name = None, ""
        ids_, offsets, sizes, counts = [], [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                target, base = _filesystem(path)
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                out = target.open_output_stream(f"{base}/{name}")
                out.write(MAGIC + digest + bytes([width]))
                at = len(MAGIC) + len(digest) + 1
                compress = _codec(shared.value)[0].compress
            for ids in encoder(vocabulary).encode(batch.column("text").to_pylist()):
                frame = compress(_packed(ids + tail, width))
                out.write(frame)
                offsets.append(at)
                sizes.append(len(frame))
                counts.append(len(ids) // 4 + 1)
                at += len(frame)
            ids_.append(batch.column("doc_id"))
        if out is None:
            return
        index = pa.table({"doc_id": pa.chunked_array(ids_), "offset": pa.array(offsets, pa.int64()),
                          "size": pa.array(sizes, pa.int64()), "n_tokens": pa.array(counts, pa.int64())})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        data = sink.getvalue()
        out.write(data + len(data).to_bytes(8, "little") + MAGIC)
        out.close()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name],
            "n_docs": [len(counts)], "n_tokens": [sum(counts)], "n_bytes": [at + len(data) + 8 + len(MAGIC)]})

    # Range partitions in ascending order; the text's hash splits a hot id.
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")) \
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest = written(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    earlier = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(earlier, F.lit(0)))  # one row for each file


def read_index(data, size: int) -> tuple[pa.Table, bytes, int]:
    """Index, dictionary hash and id width of an open file of ``size`` bytes."""
    data.seek(size - 8 - len(MAGIC))
    end = data.read(8 + len(MAGIC))
    if end[8:] != MAGIC:
        raise ValueError("not a token file")
    length = int.from_bytes(end[:8], "little")
    data.seek(size - 8 - len(MAGIC) - length)
    index = pa.ipc.open_stream(data.read(length)).read_all()
    data.seek(0)
    head = data.read(len(MAGIC) + 33)
    return index, head[len(MAGIC):-1], head[-1]


def read_dictionary(path: str, digest: bytes) -> bytes:
    store, root = _filesystem(path)
    with store.open_input_stream(f"{root}/dictionary") as data:
        dictionary = data.read()
    if hashlib.sha256(dictionary).digest() != digest:
        raise ValueError("the dictionary is not the one the file was written with")
    return dictionary


def read_document(path: str, file: str, at: int) -> bytes:
    """Ids of the ``at``-th document of a file, read by its offset alone."""
    store, root = _filesystem(path)
    with store.open_input_file(f"{root}/{file}") as data:
        index, digest, width = read_index(data, data.size())
        row = index.slice(at, 1).to_pylist()[0]
        data.seek(row["offset"])
        frame = data.read(row["size"])
    return _unpacked(_codec(read_dictionary(path, digest))[1].decompress(frame), width)


def read_token_files(manifest: DataFrame, path: str, batch_rows: int = 500) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids of every document
    in the listed files, one task for each file or several."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(path)
        for row in (r for b in batches for r in b.to_pylist()):
            with store.open_input_file(f"{root}/{row['file']}") as data:
                index, digest, width = read_index(data, row["n_bytes"])
                decompress = _codec(read_dictionary(path, digest))[1].decompress
                start = row["start"]
                for part in index.to_batches(max_chunksize=batch_rows):
                    offset, size = part.column("offset").to_pylist(), part.column("size").to_pylist()
                    if not offset:
                        continue
                    data.seek(offset[0])  # documents of a batch lie in a row
                    block = data.read(offset[-1] + size[-1] - offset[0])
                    ids = [_unpacked(decompress(block[o - offset[0]:o - offset[0] + s]), width)
                           for o, s in zip(offset, size)]
                    lengths = np.array(part.column("n_tokens"))
                    starts = start + np.concatenate([[0], np.cumsum(lengths)[:-1]])
                    start += int(lengths.sum())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "ids"])

    files = max(1, manifest.count())
    return manifest.repartitionByRange(files, "part").mapInArrow(load, DOCS)


def token_folder(docs: DataFrame) -> str:
    return scratch_path(docs.sparkSession, "token-files")
