"""Operator 8: substring dedup with a log-structured fingerprint index.

Removes each word that lies in a window of `length` words whose sequence also starts in a document with a smaller id.

Index: every piece of text of a batch is flushed as sorted immutable runs of window fingerprints, one for each bucket
(see passages: a window is posted under its anchor, with fingerprints of all windows around that).  A batch is
deduplicated by merging its runs with those of history, bucket by bucket.  Contexts that meet in 48 + 48 bits are
verified by 64 more; where an anchor's contexts differ, each window is verified by two independent 64-bit hashes of its
words.  Runs of a batch become history; when there are more than FANOUT sets of runs they are compacted into one, in
which each context has its earliest document only.

The query feeds the table in BATCHES batches by id, through history, merges and compaction.  Results don't depend on how
the documents come in batches, as long as batches come in the order of their ids; a batch is also held against older
documents with larger ids, which it does not change.  History's texts are read again only for documents that share an
anchor, but not its context, with the batch: from where the batch came from if that stays (`lasting`), else from a copy.

Null texts and texts of fewer words than a window lose nothing; see passages for rows without a doc_id (they lose
nothing and repeat nothing) and for rows that share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, Workspace, fields, ship
from .kernels import BLANK, Words, pieces
from .passages import FOUND, RUN, Scheme, answered, ask, buckets_for, covered, gather, pack_run, posting_batches, repeats, settle_group, unpack_run, with_answers

SCHEME = Scheme("word", 13, 5, False)
FANOUT = 1
BATCHES = 3
INDEX_BUCKETS = 64


def compact_group(bucket: pa.Table) -> pa.Table:
    """One sorted run, with each context's postings in its earliest document."""
    run = [np.concatenate(x) for x in zip(*map(unpack_run, bucket.column("packed").to_pylist()))]
    order, _, first = repeats(*run, False)
    return pa.table({"bucket": bucket.column("bucket").slice(0, 1), "doc_id": pa.array([None], pa.int64()), "packed": pa.array([pack_run(*(x[order[first]] for x in run))], pa.binary())})


def cut_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for part, texts in pieces(batches):
        col = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names) if n in ("hits", "answers", "n_words")}
        words = Words(texts, BLANK)
        n_words, removed, kept_text, starts, ends = [], [], [], [], []
        for i in range(len(texts)):
            lo, hi = words.doc_at[i], words.doc_at[i + 1]
            some = bool(col["hits"][i])
            a, b = covered(int(hi - lo), scheme, col["hits"][i], col["answers"][i]) if some else (none, none)
            n_words.append(int(hi - lo) if some else col["n_words"][i])
            removed.append(int((b - a).sum()))
            starts.append(a)
            ends.append(b)
            if some:
                base = words.off[i]
                left = [k for x, y in zip([lo, *(lo + b)], [*(lo + a), hi]) for k in range(x, y)]
                kept_text.append(b" ".join(texts[i][words.start[k] - base : words.end[k] - base] for k in left))
            else:
                kept_text.append(None)
        sha = [hashlib.sha256(t).hexdigest() if t is not None else own for t, own in zip(kept_text, part.column(part.schema.get_field_index("sha")).to_pylist())]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "starts", "ends"])


class FingerprintIndex:
    """What earlier batches held, in the shared folder: sets of runs, and where their documents are."""

    def __init__(self, spark: SparkSession, scheme: Scheme = SCHEME, buckets: int = INDEX_BUCKETS):
        ship(spark)
        self.ws, self.scheme, self.buckets = Workspace(spark, "substrings"), scheme, buckets
        self.runs: list[tuple[str, DataFrame]] = []
        self.history: list[DataFrame] = []
        self.made = 0

    def _put(self, df: DataFrame, kind: str) -> tuple[str, DataFrame]:
        self.made += 1
        return f"{kind}-{self.made}", self.ws.put(df, f"{kind}-{self.made}")

    def add(self, docs: DataFrame, keep: bool = True, lasting: bool = False) -> DataFrame:
        """Per document of the batch: doc_id, n_words, n_removed, kept_sha256, and starts and ends of the removed runs of
        words.  With keep the batch becomes history; lasting: docs can be read again as they are, so no copy is made."""
        scheme, buckets = self.scheme, self.buckets
        docs = fields(docs, "doc_id", "text")
        key = docs.schema["doc_id"].dataType.simpleString()
        own = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        runs = own.mapInArrow(lambda it: posting_batches(it, scheme, buckets), RUN)
        name, fresh = self._put(runs, "runs") if keep else ("", runs)
        merged = fresh.withColumn("new", F.lit(True))
        for _, old in self.runs:
            merged = merged.unionAll(old.withColumn("new", F.lit(False)))
        found = merged.groupBy("bucket").applyInArrow(lambda t: settle_group(t, scheme), FOUND)
        text = F.coalesce("text", F.lit(""))
        words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
        plain = [("n_words", F.size(words).cast("long")), ("sha", F.sha2(F.array_join(words, " "), 256))]
        everything, used = docs.withColumn("new", F.lit(True)), []
        if self.history:
            at, found = self._put(found, "found")
            used.append(at)
            asked_about = found.select(F.col("doc_id").alias("__asked")).distinct()
            for old in self.history:  # only what is asked about is read again
                everything = everything.unionAll(old.join(asked_about.hint("merge"), F.col("doc_id") == F.col("__asked"), "left_semi").withColumn("new", F.lit(False)))
        table = gather(everything, found, self.ws, plain, "new", name=f"gathered-{self.made}")
        answers = answered(ask(table, scheme, buckets), scheme)
        kind = f"doc_id {key}, n_words long, n_removed long, kept_sha256 string, starts array<int>, ends array<int>"
        out = with_answers(table.where("new"), answers).drop("new").mapInArrow(lambda it: cut_batches(it, scheme), kind)
        if keep:
            _, out = self._put(out, "out")
            for n in (*used, f"gathered-{self.made - 1}"):
                self.ws.drop(n)
            self.history.append(own if lasting else self._put(own, "docs")[1])
            self.runs.append((name, fresh.where(F.col("doc_id").isNull())))
            if len(self.runs) > FANOUT:
                self.compact()
        return out

    def compact(self) -> None:
        merged = self.runs[0][1]
        for _, old in self.runs[1:]:
            merged = merged.unionAll(old)
        done = self._put(merged.groupBy("bucket").applyInArrow(compact_group, RUN), "runs")
        for name, _ in self.runs:
            self.ws.drop(name)
        self.runs = [done]


def batches_of(docs: DataFrame, n: int) -> list[DataFrame]:
    """docs in n parts by ranges of doc_id, of about as many rows; rows without a doc_id are in the first."""
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / n for i in range(1, n)])).first()[0] or []
    cuts, key = sorted(set(cuts)), F.col("doc_id").cast("long")
    if not cuts:
        return [docs]
    parts = [docs.where(key.isNull() | (key <= cuts[0]))]
    parts += [docs.where((key > a) & (key <= b)) for a, b in zip(cuts[:-1], cuts[1:])]
    return [*parts, docs.where(key > cuts[-1])]


def deduplicated(docs: DataFrame, n: int = BATCHES, scheme: Scheme = SCHEME) -> DataFrame:
    """The results of add() for all of docs, fed to an index in n batches; docs has to be readable again."""
    index, out = FingerprintIndex(docs.sparkSession, scheme, buckets_for(docs)), None
    parts = batches_of(fields(docs, "doc_id", "text"), n)
    for i, part in enumerate(parts):
        one = index.add(part, keep=i < len(parts) - 1, lasting=True)
        out = one if out is None else out.unionAll(one)
    return out


def op8_substrings(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("starts", "ends")
