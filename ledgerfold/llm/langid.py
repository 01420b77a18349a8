"""Operator 2: language identification by cross-parsing.

Each language has a suffix automaton of labelled text.  A text is parsed greedily into the longest phrases that the
automaton knows; the language that needs the fewest phrases, each weighed by the logarithm of the length of what it was
learned from, wins.  All blocks of a batch are walked through all automata at once: one step reads one symbol of each.

Learned from a bounded sample: of each language, the SAMPLE_DOCS training documents with the lowest hashes, up to
SAMPLE_SYMBOLS symbols in all, and with many languages their even share of ALL_SYMBOLS.  Predictions read whole texts (in blocks of BLOCK symbols, at whose ends a phrase ends
too).  Symbols are lower-case letters, all that the samples hold; runs of anything else are one blank.  Transitions
beyond the WIDTH most frequent symbols are kept sparsely, so thousands of letters don't widen the table.

The bounded sample travels to the executors, and each of their Python workers builds the automata once; the driver
holds no automaton.

Null texts and texts without a letter are "und" with score 0.  Without any labelled text all are "und".  Ties go to
the language first in code-point order.  Repeated rows each get their result.  A null doc_id is neither learned from
nor held out.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fields, ship
from .kernels import pieces

SAMPLE_DOCS = 64
SAMPLE_SYMBOLS = 40_000
#: Of all languages together, so that many languages don't make a larger model.
ALL_SYMBOLS = 400_000
#: Symbols with a column of their own in the table of transitions.
WIDTH = 94
BLOCK = 4096
NAMES = ("lang_pred", "score", "phrase_rate", "n_symbols")
FAILED = np.int32(1 << 30)


@cache
def is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def symbols(texts: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, the first of each text (with the total at the end), and whether it has a letter.

    0 is the blank between words, the highest symbol any letter outside the alphabet.
    """
    lowered = [t.lower() for t in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = alphabet[code]
    at = np.concatenate([[0], np.cumsum(size)])
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    keep[at[:-1][size > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[at]
    letters = np.concatenate([[0], np.cumsum(sym != 0)])[at]
    return sym[keep], kept, np.diff(letters) > 0


def alphabet_of(texts: list[str]) -> np.ndarray:
    """Code point to symbol: each letter of the texts gets one, the most frequent first."""
    counts = Counter(c for t in texts for c in t.lower() if c.isalpha())
    out = np.where(is_letter(), len(counts) + 1, 0).astype(np.min_scalar_type(len(counts) + 1))
    for i, (c, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
        out[ord(c)] = i + 1
    return out


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that knows every substring of the text; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


class Model:
    """All automata in one table: table[state * width + symbol] is the next state times width, with FAILED set where a
    phrase ends before the symbol and the next one begins with it.

    Symbols beyond WIDTH share the last column with letters not learned.  Their transitions are sorted keys, state *
    letters + symbol, with what they lead to; first[language, symbol] is what follows where a state has none."""

    def __init__(self, samples: dict[str, list[str]]):
        self.alphabet = alphabet_of([t for v in samples.values() for t in v])
        self.letters = int(self.alphabet.max()) + 1  # with the blank and the symbol of letters not learned
        self.dense = min(self.letters - 1, WIDTH + 1)
        self.narrow = np.minimum(np.arange(self.letters), self.dense).astype(np.int32)
        self.width = self.dense + 1
        self.langs, starts, weights, tables, firsts, keys, nexts, base = [], [], [], [], [], [], [], 0
        for lang in sorted(samples):
            sym, _, _ = symbols(samples[lang], self.alphabet)
            own = sym[: min(SAMPLE_SYMBOLS, ALL_SYMBOLS // len(samples) + 1)].tolist()
            if not any(own):
                continue
            moves = suffix_automaton(own)
            t = np.full((len(moves), self.width), -1, np.int64)
            first = np.zeros(self.letters, np.int64)
            for s, m in enumerate(moves):
                if self.letters > self.width:
                    rare = {c: to for c, to in m.items() if c >= self.dense}
                    keys += [(base + s) * self.letters + c for c in rare]
                    nexts += [(base + to) * self.width for to in rare.values()]
                    if s == 0:
                        first[list(rare)] = list(rare.values())
                    m = {c: to for c, to in m.items() if c < self.dense}
                t[s, list(m)] = list(m.values())
            root = np.where(t[0] >= 0, t[0], 0)
            t = np.where(t >= 0, (t + base) * self.width, ((root + base) * self.width)[None, :] | int(FAILED))
            tables.append(t.astype(np.int32))
            firsts.append((((first + base) * self.width) | int(FAILED)).astype(np.int32))
            starts.append(base * self.width)
            weights.append(np.log2(len(own) + 1.0))
            self.langs.append(lang)
            base += len(moves)
        if base * self.width >= int(FAILED):
            raise ValueError("too many languages for one table; lower SAMPLE_SYMBOLS")
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.starts, self.weights = np.array(starts, np.int32), np.array(weights)
        self.first = np.array(firsts, np.int32)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.nexts = np.array(keys, np.int64)[order], np.array(nexts, np.int32)[order]

    def rare(self, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """(language, block) -> what the table would hold for symbols beyond WIDTH."""
        key = (state // self.width).astype(np.int64) * self.letters + sym
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nexts[at], self.first[:, sym])

    def phrases(self, sym: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(text, language) -> number of phrases."""
        k, size = len(self.langs), np.diff(at)
        n_blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(size)), n_blocks)
        first = np.repeat(at[:-1], n_blocks) + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
        length = np.minimum(BLOCK, at[owner + 1] - first)
        order = np.argsort(-length, kind="stable")
        first, length, owner = first[order], length[order], owner[order]
        alive = np.searchsorted(-length, -np.arange(BLOCK), side="left")  # blocks longer than i
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        count = np.ones((k, len(owner)), np.int32)
        whole, sym = sym, self.narrow[sym]
        beyond = len(self.keys) > 0 and bool((sym == self.dense).any())
        for i in range(int(length.max(initial=0))):
            a = alive[i]
            now = sym[first[:a] + i]
            x = self.table[state[:, :a] + now]
            if beyond and len(at_rare := np.flatnonzero(now == self.dense)):
                x[:, at_rare] = self.rare(state[:, at_rare], whole[first[at_rare] + i].astype(np.int64))
            count[:, :a] += x >> 30
            state[:, :a] = x & (FAILED - 1)
        out = np.zeros((len(size), k), np.int64)
        np.add.at(out, owner, count.T)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, phrases per symbol in the language, and symbols, of each text."""
        sym, at, letters = symbols(texts, self.alphabet)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts)), np.diff(at)
        count = self.phrases(sym, at)
        cost = count * self.weights
        best = cost.argmin(axis=1)
        row = np.arange(len(texts))
        low = cost[row, best]
        cost[row, best] = np.inf
        second = cost.min(axis=1)
        score = np.where(np.isinf(second), 1.0, 1 - low / np.maximum(np.where(np.isinf(second), 1, second), 1e-9))
        rate = count[row, best] / np.maximum(np.diff(at), 1)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, letters)], np.where(letters, np.clip(score, 0, 1), 0.0), np.where(letters, rate, 1.0), np.diff(at)


class Samples:
    """The learned-from text of each language; model() builds the automata, once in a process."""

    _built: tuple[str, Model] | None = None

    def __init__(self, texts: dict[str, list[str]]):
        self.texts = texts
        self.name = hashlib.blake2b(repr(sorted(texts.items())).encode("utf-8", "surrogatepass")).hexdigest()

    def model(self) -> Model:
        if Samples._built is None or Samples._built[0] != self.name:
            Samples._built = None
            Samples._built = self.name, Model(self.texts)
        return Samples._built[1]


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, per_lang: int = SAMPLE_DOCS) -> Samples:
    """The bounded sample described above; documents that are held out, and texts without a letter, have no part."""
    own = fields(docs, "doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}"))
    ids = own.select("doc_id", "lang").distinct().withColumn("h", F.xxhash64("doc_id", F.lit(5)))
    for salted in (F.pmod("h", F.lit(32)), F.lit(0)):  # the lowest of a part first, so no language is one group in one task
        lowest = Window.partitionBy("lang", salted).orderBy(F.shiftright("h", 10), "h", "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(lowest)).where(F.col("nth") <= per_lang)
    picked = {r["doc_id"] for r in ids.select("doc_id").collect()}  # per_lang for each language
    if not picked:
        return Samples({})
    rows = own.where(F.col("doc_id").isin(sorted(picked))).select("doc_id", "lang", F.substring("text", 1, SAMPLE_SYMBOLS).alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        own_texts = samples.setdefault(r["lang"], [])
        if (have := sum(map(len, own_texts))) < SAMPLE_SYMBOLS:
            own_texts.append(r["text"][: max(SAMPLE_SYMBOLS // 8, SAMPLE_SYMBOLS - have if have > SAMPLE_SYMBOLS * 7 // 8 else 0)] + " ")
    return Samples(samples)


def predict_batches(batches: Iterator[pa.RecordBatch], samples, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches):
        lang, score, rate, size = samples.value.model().predict([t.decode("utf-8", "replace") for t in texts])
        told = (pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64()), pa.array(size, pa.int64()))
        yield pa.RecordBatch.from_arrays([*part.columns, *told], names=[*part.schema.names, *names])


def annotated(docs: DataFrame, samples: Samples, names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """The rows of docs with all their columns and, under these names, language, score (by how much, relatively, the best
    language beats the next), phrases per symbol in the language, and symbols.  Nothing is shuffled or joined."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(samples)
    kind = T.StructType([*docs.schema.fields, *(T.StructField(n, t()) for n, t in zip(names, (T.StringType, T.DoubleType, T.DoubleType, T.LongType)))])
    return docs.mapInArrow(lambda it: predict_batches(it, sent, names), kind)


def identify(docs: DataFrame, samples: Samples) -> DataFrame:
    """doc_id and the columns NAMES."""
    return annotated(fields(docs, "doc_id", "text"), samples).drop("text")


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, learn(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
