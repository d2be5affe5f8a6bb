"""Token-id files: zstandard frames with a shared dictionary and an offset index.

One dictionary is trained on the serialized id arrays of a sample of
documents.  Each document is a frame of its own, compressed with it, so that
a short document can be read alone: the index at a file's end has every
frame's place, and its head has the dictionary's hash.

File: MAGIC, id width (1 byte), SHA-256 of the dictionary, frames, index
(one _ENTRY a document, in order), then _TAIL.  Ids are little-endian
unsigned integers of that width.

Documents are range-partitioned and sorted by id; each task streams its
range into one file under a temporary name and renames it when complete, so
a task that is run again leaves no half file and the same contents.

Nulls and edge cases: a null or empty text has the end id alone.  Null ids
come first; rows with equal ids are ordered by text.  An empty table gives
no documents.  Columns but the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitaldf.llm.common import saved, text_or_empty
from vitaldf.llm.tokens import text_encoder
from vitaldf.session import shared_dir

MAGIC = b"TOKENZ01"
DICTIONARY_BYTES = 64 << 10
#: documents that the dictionary is trained on, and ids taken of each: the bound of the sample
SAMPLE_DOCS, SAMPLE_IDS = 512, 4096
LEVEL = 3
_ENTRY = np.dtype([("id", "<i8"), ("known", "u1"), ("at", "<u8"), ("size", "<u8"), ("tokens", "<u8")])
_TAIL = struct.Struct("<QQ8s")  # place of the index, documents, MAGIC
_BATCH_BYTES = 4 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path on it; Hadoop writes ``file:/x`` for ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(raw: bytes, width: int) -> bytes:
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, width: int) -> bytes:
    """A dictionary from the documents with the smallest hashes."""
    @F.pandas_udf("binary")
    def sample(texts):
        encode = text_encoder(tokenizer).document
        return texts.map(lambda t: _narrow(encode(t)[:4 * SAMPLE_IDS], width))

    n = max(1, docs.count())
    h = F.xxhash64("id", "text")
    chosen = (docs.where(F.pmod(h, F.lit(n)) < 2 * SAMPLE_DOCS).orderBy(h).limit(SAMPLE_DOCS)
              .select(sample("text").alias("ids")))
    arrays = [bytes(r["ids"]) for r in chosen.collect()]  # at most SAMPLE_DOCS * SAMPLE_IDS ids
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:  # too few or too small arrays to train on: used as they are
        return b"".join(arrays)[-DICTIONARY_BYTES:]


def _write(batches: Iterator[pa.RecordBatch], path: str, folder: str, dictionary: bytes,
           width: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    encode = text_encoder(path).documents
    coder = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    name = f"part-{context.partitionId():06d}.tokens"
    store, place = _opened(folder)
    draft = f"{place}/_{name}-{context.taskAttemptId()}"
    entries, at, total, out = [], 0, 0, None
    for b in batches:
        for key, ids in zip(b.column(0).to_pylist(), encode(b.column(1)), strict=True):
            if out is None:
                out = store.open_output_stream(draft)
                head = MAGIC + bytes([width]) + hashlib.sha256(dictionary).digest()
                out.write(head)
                at = len(head)
            frame = coder.compress(_narrow(ids, width))
            out.write(frame)
            entries.append((key or 0, key is not None, at, len(frame), len(ids) // 4))
            at += len(frame)
            total += len(ids) // 4
    if out is None:
        return
    index = np.array(entries, _ENTRY)
    out.write(index.tobytes())
    out.write(_TAIL.pack(at, len(index), MAGIC))
    out.close()
    # an attempt that was lost after its move left the same file: not every store replaces it
    if store.get_file_info(f"{place}/{name}").type != fs.FileType.NotFound:
        store.delete_file(f"{place}/{name}")
    store.move(draft, f"{place}/{name}")
    yield pa.RecordBatch.from_pydict({"file": [name], "docs": [len(index)], "tokens": [total]})


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Write the files; a table of (file, docs, tokens), in order of the file names."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    width = 2 if text_encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(source, tokenizer, width)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "hash string, bytes binary"
                          ).coalesce(1).write.parquet(f"{folder}/dictionary")
    order = ["id", F.xxhash64("text")]
    files = (source.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(partial(_write, path=tokenizer, folder=folder, dictionary=dictionary, width=width),
                         "file string, docs long, tokens long"))
    return saved(files, "token_files")


class TokenFile:
    """One file: its index, and the ids of any document of it."""

    def __init__(self, path: str, dictionary: bytes):
        store, place = _opened(path)
        self.file = store.open_input_file(place)
        self.file.seek(self.file.size() - _TAIL.size)
        index_at, n, magic = _TAIL.unpack(self.file.read(_TAIL.size))
        self.file.seek(0)
        head = self.file.read(len(MAGIC) + 33)
        if magic != MAGIC or head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is no token file")
        if head[len(MAGIC) + 1:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} needs another dictionary")
        self.width = head[len(MAGIC)]
        self.file.seek(index_at)
        self.index = np.frombuffer(self.file.read(n * _ENTRY.itemsize), _ENTRY)
        self.decoder = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, i: int) -> bytes:
        """Ids of the i-th document: one seek and one frame."""
        entry = self.index[i]
        self.file.seek(int(entry["at"]))
        return _wide(self.decoder.decompress(self.file.read(int(entry["size"]))), self.width)


def _read(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    names = ["id", "start", "n_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for b in batches:
        for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            file, rows, held = TokenFile(f"{folder}/{name}", dictionary), [], 0
            for i, entry in enumerate(file.index):
                n, ids = int(entry["tokens"]), file.ids(i)
                rows.append((int(entry["id"]) if entry["known"] else None, start, n, ids))
                start += n
                held += len(ids)
                if held >= _BATCH_BYTES or i == len(file.index) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows, held = [], 0


def read_token_files(spark: SparkSession, folder: str, files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: the id, ``start`` (ids before it), ``n_tokens`` and ``ids``."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])
    # a row for each file, with the ids of all files before it
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    dealt = starts.repartition(max(1, files.count()), "file")
    return dealt.mapInArrow(partial(_read, folder=folder, dictionary=dictionary),
                            "id long, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def encode_to_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a new folder of the shared folder and read them back."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    return read_token_files(spark, folder, write_token_files(docs, tokenizer, folder, id_col, text_col), id_col)
