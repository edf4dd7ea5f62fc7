"""Packing token pieces into fixed windows by minimum bin slack."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, table
from .encoders import part_encoder, vocabulary

WINDOW = 2048
END = 1
GROUP = 2048  # documents whose remainders are packed together; a documented bound, the number of groups grows


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most counts[l] of each, whose sum comes closest to room without passing it.

    Subset sums are bits of one integer; each length is added in powers of two up to its count, the integer before
    each step is kept, and the steps that lead to the best sum are read backwards. It ends early on an exact fill.
    """
    mask, sums = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((length, take, sums))
            sums = (sums | sums << (take * length)) & mask
            left, part = left - take, part * 2
        if sums >> room & 1:
            break
    best, used = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            used[length] = used.get(length, 0) + take
            best -= take * length
    return used


def pack(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; no sequence is longer than window, and offsets leave no gap.

    The longest piece left opens a window, and best_fill() fills the rest of it from all lengths left; the same
    pattern is repeated as often as counts allow.
    """
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    pools: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        pools.setdefault(int(lengths[i]), []).append(i)
    counts = {x: len(own) for x, own in pools.items()}
    n = 0
    for first in sorted(pools, reverse=True):
        while counts.get(first):
            counts[first] -= 1
            used = best_fill(counts, window - first)
            counts[first] += 1
            used[first] = used.get(first, 0) + 1
            for _ in range(min(counts[x] // k for x, k in used.items())):
                at = 0
                for x in sorted(used, reverse=True):
                    for _ in range(used[x]):
                        i = pools[x].pop()
                        seq[i], offset[i] = n, at
                        at += x
                n += 1
                for x, k in used.items():
                    counts[x] -= k
            for x in [x for x in used if not counts[x]]:
                del counts[x]
    return seq, offset


def packed(docs: DataFrame, vocab: str | None = None, window: int = WINDOW, group: int = GROUP, with_ids: bool = False, lean: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with with_ids its ids.

    Each text (null: empty) is encoded whole and ended with id 1, so every document has a piece. A document is cut
    after every `window` ids; whole windows are sequences of their own, and what remains is packed with the remainders
    of about `group` documents. Groups are dealt by a hash of id and start, so neither a source nor one long document
    makes a large group. A repeated id is packed as often as it stands there; a null id is kept. A lean encoder takes less
    memory and more time, with the same ids.
    """
    path, run = vocab or vocabulary("word_bpe_49k.json"), uuid.uuid4().hex
    n_groups = max(1, math.ceil(docs.count() / group))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = part_encoder(path, True, run, lean=lean)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[] for _ in range(6 + with_ids)]
            for name, raw in zip(batch.column(0).to_pylist(), coder.encode(t.as_py() for t in batch.column(1)), strict=True):
                raw += end
                n = len(raw) // 4
                for at in range(0, n, window):
                    own = raw[4 * at : 4 * (at + window)]
                    row = (zlib.crc32(b"%s:%d" % (str(name).encode(), at)) % n_groups, name, at, len(own) // 4, zlib.crc32(own), n)
                    for col, x in zip(rows, (*row, own) if with_ids else row, strict=True):
                        col.append(x)
            kinds = [pa.int32(), batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds, strict=False)], names=["grp", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(rows)])
        released()

    extra = ", ids binary" if with_ids else ""
    cols = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{extra}"

    def place(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        seq, offset = pack(own["length"].to_numpy(), window)
        return own.assign(sequence_id=seq + (np.int64(own["grp"].iloc[0]) << 32), offset=offset).drop(columns="grp")

    out = docs.select("doc_id", F.col("text")).mapInArrow(pieces, f"grp int, {cols}")
    return out.groupBy("grp").applyInPandas(place, f"{cols}, sequence_id long, offset long")


def op3_min_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What packed() returns for the documents that earlier stages kept; lean, as their workers still hold memory."""
    return packed(docs, lean=True)
