"""Benchmark decontamination with an FM-index for each shard of the training documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, table

WINDOW = 13
SHARD_WORDS = 1 << 19  # words of an index at most, but for one longer document
SAMPLE = 8  # every 8th position of a run is kept
BENCHMARK_BYTES = 64 << 20  # of test text that is held in memory at a time
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and all that isn't ASCII, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class Phrases:
    """The distinct windows of some test items, as symbols from 1 on; 0 stands for every other word."""

    def __init__(self, items: list[tuple], size: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.names = sorted({str(k) for k, _ in items})
        place = {k: i for i, k in enumerate(self.names)}
        for name, text in items:
            own = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            for k in range(max(1, len(own) - size + 1) if own else 0):
                found.setdefault(tuple(own[k : k + size]), set()).add(place[str(name)])
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        self.table = np.zeros((len(found), size), np.int64)  # read from the right: column 0 holds the last word
        for row, w in zip(self.table, found, strict=True):
            row[: len(w)] = w[::-1]
        self.item_counts = np.array([len(x) for x in found.values()], np.int64)
        self.item_starts = np.cumsum(self.item_counts) - self.item_counts
        self.items = np.array([i for x in found.values() for i in sorted(x)], np.int64)


class WaveletMatrix:
    """Ranks of symbols before positions, for many pairs at a time; a prefix sum for each bit of the alphabet."""

    def __init__(self, text: np.ndarray, top: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, top.bit_length()) - 1, -1, -1):
            ones = text >> bit & 1
            sums = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            self.levels.append((bit, sums, len(text) - int(sums[-1])))
            text = np.concatenate((text[ones == 0], text[ones == 1]))
        self.first = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))
        self.final = text

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, sums, zeros in self.levels:
            ones = sums[at]
            at = np.where(symbols >> bit & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._walk(symbols, at) - self.first[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order; 0 ends a run, and equal runs are told apart by where they end.

    Prefix doubling, in which only suffixes whose place isn't settled are sorted again.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    step, todo = 0, np.arange(n)
    while len(todo):
        at = order[todo]  # places whose suffixes are still equal in their first `step` words, by group
        far = np.minimum(at + step, n - 1)
        group = rank[at] if step else np.zeros(len(at), np.int64)
        key = rank[far]
        inner = np.lexsort((key, group))
        at, group, key = at[inner], group[inner], key[inner]
        order[todo] = at
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
        starts = todo[new]  # a group's rank is its first place
        rank[at] = starts[np.cumsum(new) - 1]
        alone = new & np.concatenate((new[1:], [True]))
        todo = todo[~alone]
        step = 2 * step or 1
    return order


class FmIndex:
    """Backward search and sampled location over runs of symbols, each ended by 0."""

    def __init__(self, text: np.ndarray, run_starts: np.ndarray, top: int, sample: int = SAMPLE):
        order = suffix_order(text)
        self.last = text[order - 1]  # the word before each suffix
        self.ranks = WaveletMatrix(self.last, top)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        run = np.zeros(len(text), np.int64)
        run[run_starts] = run_starts
        since = np.arange(len(text)) - np.maximum.accumulate(run)
        self.marked = (since % sample == 0)[order]
        self.marks = np.concatenate(([0], np.cumsum(self.marked))).astype(np.int64)
        self.places = order[self.marked]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of those that occur: rows of suffixes that begin with the phrase."""
        alive = np.arange(len(phrases.lengths))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), len(self.last), np.int64)
        done: list[tuple[np.ndarray, ...]] = []
        for k in range(phrases.table.shape[1]):
            c = phrases.table[alive, k]
            low = self.before[c] + self.ranks.rank(c, low)
            high = self.before[c] + self.ranks.rank(c, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
            whole = phrases.lengths[alive] == k + 1
            done.append((alive[whole], low[whole], high[whole]))
            alive, low, high = alive[~whole], low[~whole], high[~whole]
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))  # type: ignore[return-value]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row: steps back until a sampled one; a run's first position is sampled."""
        out, steps, todo = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(todo):
            here = self.marked[rows]
            out[todo[here]] = self.places[self.marks[rows[here]]] + steps
            rows, todo = rows[~here], todo[~here]
            c = self.last[rows]
            rows = self.before[c] + self.ranks.rank(c, rows)
            steps += 1
        return out


def _shard(docs: list[list[bytes]], phrases: Phrases, sample: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each document the merged hit spans (n x 2, in words) and the places of items that occur in it."""
    none = (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    if not phrases.shortest:
        return [none] * len(docs)
    get = phrases.symbols.get
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    first = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()), np.int64)
    for at, d in zip(first.tolist(), docs, strict=True):
        text[at : at + len(d)] = [get(w, 0) for w in d]
    # Words outside the test vocabulary end a run, and a run shorter than the shortest window can hold none.
    edge = np.diff(np.concatenate(([0], (text > 0).view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= phrases.shortest
    starts, lengths = starts[long], (ends - starts)[long] + 1  # with the 0 that follows
    if not len(starts):
        return [none] * len(docs)
    place = np.cumsum(lengths) - lengths
    source = np.repeat(starts - place, lengths) + np.arange(int(lengths.sum()))  # of each position of the index
    index = FmIndex(text[source], place, len(phrases.symbols), sample)
    which, low, high = index.search(phrases)
    many = high - low
    rows = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    at = source[index.locate(rows)]
    which = np.repeat(which, many)
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    edge = np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).view(np.int8))))
    spans = np.column_stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
    owner = np.searchsorted(first, spans[:, 0], "right") - 1
    found = np.unique(np.column_stack((np.searchsorted(first, at, "right") - 1, which)), axis=0)
    n = phrases.item_counts[found[:, 1]]
    entry = np.repeat(phrases.item_starts[found[:, 1]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    pairs = np.unique(np.column_stack((np.repeat(found[:, 0], n), phrases.items[entry])), axis=0)
    out = [none] * len(docs)
    for d in np.unique(owner).tolist():
        out[d] = (spans[owner == d] - first[d], pairs[pairs[:, 0] == d, 1])
    return out


def merge(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans as one; any order."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    return np.column_stack((spans[new, 0], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(spans) - 1]))]))


def find(texts: list[str | None], blocks: list[Phrases], shard_words: int = SHARD_WORDS, sample: int = SAMPLE) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(number of words, merged hit spans in words, ids of items) of each text, through an index of each shard."""
    some: list[list[bytes]] = []

    def done() -> Iterator[tuple[int, np.ndarray, list[str]]]:
        parts = [_shard(some, p, sample) for p in blocks]
        for i, d in enumerate(some):
            spans = merge(np.concatenate([x[i][0] for x in parts])) if len(parts) > 1 else parts[0][i][0] if parts else np.zeros((0, 2), np.int64)
            yield len(d), spans, sorted({p.names[k] for p, x in zip(blocks, parts, strict=True) for k in x[i][1].tolist()})

    size = 0
    for t in texts:
        some.append(words_of(t))
        size += len(some[-1])
        if size >= shard_words:
            yield from done()
            some, size = [], 0
    yield from done()


def phrase_blocks(benchmark: DataFrame, most: int = BENCHMARK_BYTES) -> list[Phrases]:
    """The test items' windows, in blocks of at most `most` bytes of text. Held by every task, so the total is checked."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > 8 * most:
        raise ValueError(f"{size} bytes of test text: split the benchmark table and run once for each part")
    blocks, some, held = [], [], 0
    for name, text in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        some.append((name, text))
        held += len(text)
        if held > most:
            blocks.append(Phrases(some))
            some, held = [], 0
    return [*blocks, Phrases(some)] if some else blocks


def contamination(docs: DataFrame, benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    Items of one id are one item. Null texts have no words; an item without words has no window, and one with fewer
    than 13 words is one window. `spans` are the merged hit ranges in words, end exclusive, to remove. Each document is
    judged where it is read: there's no shuffle, and a repeated row or a null id is one more row.
    """
    blocks = docs.sparkSession.sparkContext.broadcast(phrase_blocks(benchmark))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, int((s[:, 1] - s[:, 0]).sum()), x, s) for n, s, x in find(batch.column(1).to_pylist(), blocks.value, shard_words)]
            cols = [
                batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(",".join(r[2]).encode()).hexdigest() for r in rows], pa.string()), pa.array([r[1] > 0 and 20 * r[1] >= r[0] for r in rows], pa.bool_()),
                pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3].tolist() for r in rows], pa.list_(pa.list_(pa.int64()))),
            ]
            yield pa.record_batch(cols, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<array<long>>")


def op2_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "spans")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contamination() calls contaminated; all others stay as they are. No shuffle."""
    blocks = spark.sparkContext.broadcast(phrase_blocks(table(spark, sf_dir, "benchmark")))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [(n, int((s[:, 1] - s[:, 0]).sum())) for n, s, _ in find(batch.column(at).to_pylist(), blocks.value)]
            yield batch.filter(pa.array([not (h and 20 * h >= n) for n, h in hit], pa.bool_()))
        released()

    return docs.mapInArrow(run, docs.schema)
