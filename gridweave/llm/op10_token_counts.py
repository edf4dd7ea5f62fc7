"""Token counts; huge documents are encoded in overlapping chunks that are spliced where both must agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .encoders import vocabulary

CHUNK, OVERLAP = 1 << 15, 1 << 9  # bytes
LIMIT = 4096


class Counter:
    """Counts of a sentencepiece model for whole texts.

    `cuts`: whether no piece of the vocabulary holds a word mark after another character. Then no merge reaches over
    the place before a space that follows something else, and what stands left and right of it is encoded alike
    wherever a chunk begins: such a place, if a token of both chunks begins there, is a proven boundary.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = "▁"
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.cuts = not any(mark in p.lstrip(mark) for p in pieces)
        self.chunk, self.overlap = chunk, overlap

    def short(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def _starts(self, raw: bytes, a: int, b: int) -> np.ndarray:
        """Where the tokens of the chunk a..b begin, as byte offsets of the document."""
        found = self.model.encode(raw[a:b].decode(), return_type="proto")
        return np.fromiter((p.begin for p in found.pieces), np.int64, len(found.pieces)) + a

    def long(self, raw: bytes) -> int:
        """The count for one huge document, given as UTF-8."""
        n, count, done = len(raw), 0, 0  # tokens that begin before `done` are counted
        a, b = 0, self._edge(raw, self.chunk)
        left = self._starts(raw, a, b)
        while b < n:
            width, cut = self.overlap, -1
            end = self._edge(raw, min(n, b + self.chunk - self.overlap))
            while cut < 0:
                start = self._edge(raw, max(done, b - width))
                if start <= done:  # no boundary after `done`: one longer chunk from there on, with what stood before it
                    start = a
                    right = self._starts(raw, a, end)
                    break
                right = self._starts(raw, start, end)
                cut = self._common(raw, left, right, start, b)
                width *= 2
            if cut >= 0:
                count += int(np.count_nonzero((left >= done) & (left < cut)))
                done = cut
            a, b, left = start, end, right
        return count + int(np.count_nonzero(left >= done))

    @staticmethod
    def _edge(raw: bytes, at: int) -> int:
        """The nearest start of a character at or before `at`."""
        while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
            at -= 1
        return at

    @staticmethod
    def _common(raw: bytes, left: np.ndarray, right: np.ndarray, start: int, b: int) -> int:
        """The proven boundary nearest the middle of the overlap start..b at which a token of either side begins; or -1."""
        both = np.intersect1d(left[left > start + 1], right[(right > start + 1) & (right < b)])
        both = [x for x in both.tolist() if raw[x] == 0x20 and raw[x - 1] != 0x20]
        return min(both, key=lambda x: abs(2 * x - start - b), default=-1)

    def count(self, text: str | None) -> int:
        raw = (text or "").encode()
        if len(raw) <= self.chunk or not self.cuts:
            return self.short([text or ""])[0]
        return self.long(raw)


def token_counts(docs: DataFrame, vocab: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row, as whole-text encoding gives them.

    Null and empty texts have no bytes and tokens. A text of over `chunk` bytes is encoded in chunks that overlap by
    `overlap` bytes; without a proven boundary there, the overlap doubles, back to the last splice if need be. A row's
    result hangs on its text alone, so repeated rows and null ids are kept as they are.
    """
    path = vocab or vocabulary("piece_bpe_32k.model")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, chunk, overlap)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = np.array([len(t.encode()) for t in texts], np.int64)
            counts = np.zeros(len(texts), np.int64)
            small = np.flatnonzero((sizes <= chunk) | (not counter.cuts))
            for k in range(0, len(small), 64):
                counts[small[k : k + 64]] = counter.short([texts[i] for i in small[k : k + 64]])
            for i in np.flatnonzero((sizes > chunk) & counter.cuts):
                counts[i] = counter.long(texts[i].encode())
            yield pa.record_batch([batch.column(0), pa.array(sizes), pa.array(counts), pa.array(counts > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
