"""Token ids in binary shard files with one zstandard dictionary.

A folder holds

* ``dictionary.zdict``: the dictionary, trained on the serialized ids of a bounded sample,
* ``shard-NNNNN.bin``: magic, SHA-256 of the dictionary, bytes per id, then one compressed frame per document,
* ``shard-NNNNN.idx``: per document its frame's offset and length, its number of ids and its identifier's validity and value,
* ``manifest.json``: shards in order, with documents, ids and ids before them.

Documents are in ascending order of identifier (null first; equal ones by their ids).
A frame opens alone with the dictionary, so reading one short document costs one index
record and one frame.  A file is written under a name of its own and then renamed, so a
repeated or lost task leaves the same file.  Files are reached through pyarrow's file
systems, by the scheme of the folder's URI.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize, scratch_root
from catalith.llm.common import chosen, stored, whole
from catalith.llm.registry import query
from catalith.llm.segments import encoder

#: Documents whose ids train the dictionary, bytes given to the training, and size of the dictionary.
SAMPLE, SAMPLE_BYTES, DICTIONARY = 2000, 8 << 20, 64 << 10
MAGIC = b"ZTOK0001"
HEADER = len(MAGIC) + 32 + 1
INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("tokens", "<u8"), ("known", "<u1"), ("doc", "<i8")])
LEVEL = 3


def open_fs(uri: str):
    """pyarrow file system and path of a folder URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A zstandard dictionary; empty if the samples are too few or too small to train one."""
    import zstandard

    total, used = 0, []
    for s in samples:
        used.append(s)
        total += len(s)
        if total >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 10)), used).as_bytes()
    except zstandard.ZstdError:
        return b""


def compressor(dictionary: bytes):
    import zstandard

    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)  # else each short frame digests the dictionary anew
    return zstandard.ZstdCompressor(dict_data=made)


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() if width == 2 else ids


def write_files(docs: DataFrame, path: str, folder: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode ``docs`` and write the folder; returns the manifest ``(shard, docs, tokens, before)``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tail = np.array([end_id], dtype="<u4").tobytes()

    # Only the dictionary is fitted on the sample; every document is encoded and written.
    sample = chosen(rows, F.col("k"), SAMPLE).select("t").limit(2 * SAMPLE).toLocalIterator()
    enc, samples, total = encoder(path), [], 0
    for r in sample:
        samples.append(narrow(enc.ids(r["t"]) + tail, width))
        total += len(samples[-1])
        if total >= SAMPLE_BYTES:
            break
    dictionary = train(samples)
    digest = hashlib.sha256(dictionary).digest()
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary.zdict") as f:
        f.write(dictionary)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(path), compressor(dictionary)
        for b in batches:
            made = [(len(ids) // 4, pack.compress(narrow(ids, width))) for ids in (enc.ids(t) + tail for t in b.column("t").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array([m[0] for m in made], type=pa.int64()),
                                              pa.array([m[1] for m in made], type=pa.binary())], names=["k", "tokens", "frame"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"shard-{TaskContext.get().partitionId():05d}"
        own = uuid.uuid4().hex
        fs, root = open_fs(folder)
        index, offset, tokens = [], HEADER, 0
        with fs.open_output_stream(f"{root}/.{own}.bin") as f:
            f.write(MAGIC + digest + bytes([width]))
            for b in batches:
                for k, n, frame in zip(b.column("k").to_pylist(), b.column("tokens").to_pylist(), b.column("frame")):
                    data = frame.as_py()
                    f.write(data)
                    index.append((offset, len(data), n, k is not None, k or 0))
                    offset += len(data)
                    tokens += n
        with fs.open_output_stream(f"{root}/.{own}.idx") as f:
            f.write(np.array(index, dtype=INDEX).tobytes())
        for end in ("bin", "idx"):
            fs.move(f"{root}/.{own}.{end}", f"{root}/{name}.{end}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(index)]), pa.array([tokens])], names=["shard", "docs", "tokens"])

    made = stored(rows.mapInArrow(frames, "k long, tokens long, frame binary"), "frames")
    # The bounds of a range are sampled to the driver: a hash stands for the frame there.
    order = ["k", "tokens", F.xxhash64("frame")]
    written = materialize(made.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        shards, "shard string, docs long, tokens long"), "manifest")
    # One row per shard.
    listed, before = [], 0
    for r in sorted(written.filter("docs > 0").collect(), key=lambda r: r["shard"]):
        listed.append((r["shard"], r["docs"], r["tokens"], before))
        before += r["tokens"]
    with fs.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"dictionary_sha256": digest.hex(), "bytes_per_id": width, "shards": [
            dict(zip(("shard", "docs", "tokens", "before"), x)) for x in listed]}).encode())
    return spark.createDataFrame(listed, "shard string, docs long, tokens long, before long")


def checked_dictionary(folder: str) -> bytes:
    fs, root = open_fs(folder)
    with fs.open_input_stream(f"{root}/dictionary.zdict") as f:
        return f.read()


def read_frames(folder: str, shard: str, wanted: Iterator[int] | None = None, at_once: int = 1 << 22) -> Iterator[tuple[int | None, int, bytes]]:
    """``(identifier, number of ids, ids)`` of a shard's documents, or of the ``wanted`` places only."""
    dictionary = checked_dictionary(folder)
    fs, root = open_fs(folder)
    with fs.open_input_file(f"{root}/{shard}.idx") as f:
        index = np.frombuffer(f.read(), dtype=INDEX)
    if wanted is not None:
        index = index[list(wanted)]
    with fs.open_input_file(f"{root}/{shard}.bin") as f:
        head = f.read(HEADER)
        if head[:len(MAGIC)] != MAGIC or head[len(MAGIC):-1] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{shard}: not a token file of this dictionary")
        opened, base, held = decompressor(dictionary), 0, b""
        for x in index:
            a, b = int(x["offset"]), int(x["offset"] + x["length"])
            if a < base or b > base + len(held):
                f.seek(a)
                base, held = a, f.read(b - a if wanted is not None else max(at_once, b - a))
            raw = opened.decompress(held[a - base:b - base])
            ids = np.frombuffer(raw, dtype=f"<u{head[-1]}").astype("<u4").tobytes()
            if len(ids) != 4 * int(x["tokens"]):
                raise ValueError(f"{shard}: index and frame disagree")
            yield (int(x["doc"]) if x["known"] else None), int(x["tokens"]), ids


def read_document(folder: str, shard: str, place: int) -> tuple[int | None, int, bytes]:
    """One document by its place in a shard: one index record and one frame are used."""
    return next(iter(read_frames(folder, shard, iter([place]))))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of all documents of a folder; a task per shard, read in steps."""
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, start in zip(b.column("shard").to_pylist(), b.column("before").to_pylist()):
                held: list[tuple] = []
                size = 0
                for doc, n, ids in read_frames(folder, shard):
                    held.append((doc, start, n, ids))
                    start += n
                    size += len(ids)
                    if size > 8 << 20:
                        yield batch_of(held)
                        held, size = [], 0
                yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])

    tasks = max(1, manifest.count())
    return manifest.repartition(tasks, "shard").mapInArrow(opened, "doc_id long, start long, n_tokens long, ids binary")


@query("op8_token_files")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as P

    out = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    manifest = write_files(docs, P.path("word_bpe_49k.json"), out)
    rows = read_files(manifest, out)
    return stored(rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")), "read_back")
