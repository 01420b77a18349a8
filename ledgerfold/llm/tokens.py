"""Operator 3: token counts by a separator scan over flat, unindexed token files.

A file is documents' token ids one after another, little-endian and of a fixed width, each document ended by the
identifier `eos`; there is no index.  Blocks of a fixed number of tokens are read by their offset, without regard to
files' sizes or to documents.  Each block is searched for separators at once, on its own.  Prefix scans over the blocks
of a file (running sum of lengths, running maximum of the last separator) then stitch the documents that go on across
blocks, however many.  Only the blocks' summaries are scanned, a few numbers for BLOCK tokens.

`write_token_files` makes such files from documents, in the shared folder, a few for each task; a task that is run again
writes under other names, and only files of tasks that counted are listed.  What it lists is the files, and which
documents it put into each, in order; where these begin is for the scan to find.

Executors read ranges of files in local folders and of what pyarrow has file systems for (HDFS, S3, GCS).  Files in
other stores come whole, by Spark's reader, which takes up to 2 GB each.

Null and empty texts are documents of no tokens.  A document at the end of a file without a separator counts as well
(`ended` false).  Rows that repeat are documents of their own.  Empty tables give empty results.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, fields, ship
from .kernels import pieces

#: Tokens of a block, and of a file that write_token_files makes.
BLOCK = 1 << 18
FILE = 1 << 23
#: Tokens that one task reads.
TASK = 1 << 23
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOS = 50256
#: Fixed value: how the vocabulary's tokenizer cuts text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of so much white space are cut off before PATTERN, which would try each of their places, sees them.
LONG_BLANKS = re.compile("[%s]{1024,}" % "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))
RANGED = ("file", "hdfs", "s3", "s3a", "gs")


class Encoder:
    """A byte-level BPE of ranks as in a .tiktoken file; it travels as bytes and is built where it is used."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN, eos: int = EOS):
        with open(path, "rb") as f:
            self.raw = f.read()
        self.pattern, self.eos, self.inner = pattern, eos, None
        self.width = 2 if max(eos, len(self.raw.splitlines()) - 1) < 1 << 16 else 4

    def __getstate__(self):
        return self.__dict__ | {"inner": None}

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.inner is None:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in self.raw.splitlines() if line)}
            self.inner = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        """PATTERN takes a run of white space before a word but for its last character, and one at the end whole; so a
        long run is a piece of its own, and what is left and right of it is cut as it would be with it."""
        long = list(LONG_BLANKS.finditer(text)) if self.pattern == PATTERN and len(text) >= 1024 else []
        if not long:
            return self.inner.encode_ordinary(text)
        out, at = [], 0
        for m in long:
            end = m.end() if m.end() == len(text) else m.end() - 1
            out += self.inner.encode_ordinary(text[at : m.start()])
            out += self.inner._encode_single_piece(text[m.start() : end].encode())
            at = end
        return out + self.inner.encode_ordinary(text[at:])


# ---- files ----


def opened(path: str, mode: str):
    """A binary file to read ("rb") or write ("wb"), by a URL that Spark knows too."""
    scheme, _, rest = path.partition(":") if re.match(r"[a-z0-9]+:/", path) else ("file", "", path)
    if scheme == "file":
        local = "/" + rest.lstrip("/")
        if mode == "wb":
            os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, mode)
    from pyarrow import fs

    host, _, name = rest.removeprefix("//").partition("/")
    if scheme == "hdfs":
        store, name = fs.FileSystem.from_uri(f"hdfs://{host or 'default'}/")[0], "/" + name
    else:
        store, name = (fs.GcsFileSystem() if scheme == "gs" else fs.S3FileSystem()), f"{host}/{name}"
    return store.open_input_file(name) if mode == "rb" else store.open_output_stream(name)


def file_batches(batches: Iterator[pa.RecordBatch], encoder, folder: str, size: int) -> Iterator[pa.RecordBatch]:
    """Writes the documents' tokens into files of about size tokens; (path, tokens, ids) of each file."""
    from pyspark import TaskContext

    code, own, n = encoder.value, f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", 0
    out, path, written, ids = None, "", 0, []

    def done():
        out.close()
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([written], pa.int64()), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids))], names=["path", "tokens", "ids"])

    for part, texts in pieces(batches):
        coded = code.encode([t.decode("utf-8", "replace") for t in texts])
        ends = np.cumsum([len(c) + 1 for c in coded])
        tokens = np.empty(int(ends[-1]), f"<u{code.width}")
        for c, e in zip(coded, ends):
            tokens[e - 1 - len(c) : e - 1], tokens[e - 1] = c, code.eos
        if out is None:
            path, written, ids, n = f"{folder}/{own}-{n:04d}.tokens", 0, [], n + 1
            out = opened(path, "wb")
        out.write(tokens.tobytes())
        written += len(tokens)
        ids.append(part.column(0))
        if written >= size:
            yield done()
            out = None
    if out is not None:
        yield done()


def write_token_files(docs: DataFrame, encoder: Encoder, ws: Workspace, size: int = FILE) -> DataFrame:
    """path, tokens, ids: the files made, and the documents in each, in order."""
    ship(docs.sparkSession)
    sent, folder = docs.sparkSession.sparkContext.broadcast(encoder), f"{ws.root}/files"
    kind = f"path string, tokens long, ids array<{docs.schema['doc_id'].dataType.simpleString()}>"
    files = ws.put(fields(docs, "doc_id", "text").mapInArrow(lambda it: file_batches(it, sent, folder, size), kind), "listed")
    sent.destroy()
    return files


def range_batches(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[pa.RecordBatch]:
    """The tokens of blocks (path, block)."""
    path, file = None, None
    for batch in batches:
        for p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != path:
                if file:
                    file.close()
                path, file = p, opened(p, "rb")
            file.seek(n * size * width)
            raw = file.read(size * width)
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([n], pa.int64()), pa.array([raw], pa.binary())], names=["stream", "block", "tokens"])
    if file:
        file.close()


def whole_batches(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            buffer = raw.as_buffer()
            for n, i in enumerate(range(0, len(buffer), size * width)):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([buffer[i : i + size * width].to_pybytes()], pa.binary())], names=["stream", "block", "tokens"])


def blocks_in(files: DataFrame, width: int, size: int = BLOCK) -> DataFrame:
    """stream (the path), block, tokens of files (path, bytes), each block read by its offset, by any task."""
    ship(files.sparkSession)
    total = files.agg(F.sum("bytes")).first()[0] or 0
    blocks = files.where(F.col("bytes") > 0).select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / (size * width)))).alias("block"))
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // (TASK * width)))
    spread = blocks.repartition(tasks, "path", F.floor(F.col("block") * size / TASK)).sortWithinPartitions("path", "block")
    return spread.mapInArrow(lambda it: range_batches(it, size, width), "stream string, block long, tokens binary")


def read_token_files(spark: SparkSession, path: str, width: int = 2, size: int = BLOCK) -> DataFrame:
    """Blocks of the flat files of token ids of width bytes that path names."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    scheme = re.match(r"([a-z0-9]+):/", path)
    if scheme and scheme[1] not in RANGED:
        return files.select("path", "content").mapInArrow(lambda it: whole_batches(it, size, width), "stream string, block long, tokens binary")
    return blocks_in(files.select("path", F.col("length").alias("bytes")), width, size)


# ---- scan ----


def scan_batches(batches: Iterator[pa.RecordBatch], eos: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, first, last, inner = [], [], [], []
        for raw in batch.column(2):
            tokens = np.frombuffer(raw.as_buffer(), f"<u{width}")
            at = np.flatnonzero(tokens == eos)
            length.append(len(tokens))
            first.append(int(at[0]) if len(at) else None)
            last.append(int(at[-1]) if len(at) else None)
            inner.append(np.diff(at) - 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(length, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(inner, pa.list_(pa.int64()))], names=["stream", "block", "length", "first", "last", "inner"])


def count_tokens(blocks: DataFrame, eos: int = EOS, width: int = 2, ws: Workspace | None = None) -> DataFrame:
    """stream, nth (of the document in the stream, from 0), n_tokens, ended."""
    ws = ws or Workspace(blocks.sparkSession, "tokens")
    found = ws.put(blocks.mapInArrow(lambda it: scan_batches(it, eos, width), "stream string, block long, length long, first long, last long, inner array<long>"), "scan")
    before = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    n = F.when(F.col("first").isNull(), 0).otherwise(F.size("inner") + 1)
    # the scans see the blocks' numbers only, the lists of lengths are joined again
    scans = found.select("stream", "block", "length", "first", "last", n.alias("n")).withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    scans = scans.withColumn("previous", F.coalesce(F.max(F.col("start") + F.col("last")).over(before), F.lit(-1))).withColumn("nth", F.coalesce(F.sum("n").over(before), F.lit(0)))
    head = scans.where(F.col("first").isNotNull()).select("stream", "block", "nth", (F.col("start") + F.col("first") - F.col("previous") - 1).alias("head"))
    rows = found.select("stream", "block", "inner").join(head, ["stream", "block"])
    each = rows.select("stream", "nth", F.posexplode(F.concat(F.array("head"), "inner")).alias("i", "n_tokens"))
    done = each.select("stream", (F.col("nth") + F.col("i")).alias("nth"), "n_tokens", F.lit(True).alias("ended"))
    ends = scans.groupBy("stream").agg(F.sum("length").alias("all"), F.max(F.col("start") + F.col("last")).alias("last"), F.sum("n").alias("nth"))
    rest = (F.col("all") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens")
    return done.unionAll(ends.select("stream", "nth", rest, F.lit(False).alias("ended")).where(F.col("n_tokens") > 0))


def document_tokens(docs: DataFrame, encoder: Encoder, file: int = FILE, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens of every row of docs, by way of flat files."""
    ws = Workspace(docs.sparkSession, "tokens")
    files = write_token_files(docs, encoder, ws, file)
    width = encoder.width
    counts = count_tokens(blocks_in(files.select("path", (F.col("tokens") * width).alias("bytes")), width, block), encoder.eos, width, ws)
    named = files.select(F.col("path").alias("stream"), F.posexplode("ids").alias("nth", "doc_id"))
    return named.join(counts.where("ended").hint("merge"), ["stream", "nth"]).select("doc_id", "n_tokens")


def op3_tokens(spark, sf_dir: str) -> DataFrame:
    return document_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), Encoder())
