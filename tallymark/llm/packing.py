"""Best-fit packing of token sequences with certified bin counts.

Documents are cut into pieces of at most one sequence. Pieces are dealt into partitions of bounded size; each partition is
packed by best-fit decreasing and holds its number of sequences against lower bounds from dual-feasible functions. What
lies in unfilled sequences of partitions above their bound, and the emptiest sequence of every other one, is dealt anew
and packed again until one partition is left or nothing is gained.

Defined cases: null and empty texts are the end token alone; repeated rows are packed each; null ids stay; an empty table
gives an empty result; of the input only the key and the text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import STEP, mixed
from tallymark.llm.tokens import encoder
from tallymark.session import written

LENGTH = 2048
END = 0
#: Pieces that one partition packs.
PARTITION_PIECES = 200_000
#: Rounds of exchange after the first.
ROUNDS = 4

PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32, a number ``deal`` that spreads pieces evenly, and the ids if wanted."""
    kind = dict(docs.dtypes)[key]

    def cut(batches):
        own, seen = encoder(tokenizer_path, False), 0
        tail = np.array([end], np.uint32)
        for batch in batches:
            row, piece, start, size, crc, kept, at = [], [], [], [], [], [], 0
            for _, ids, bounds in own.batches(batch.column("text")):
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    doc = np.concatenate((ids[a:b], tail)).astype("<u4")
                    for i, s in enumerate(range(0, len(doc), length)):
                        part = doc[s : s + length]
                        row.append(at)
                        piece.append(i)
                        start.append(s)
                        size.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part.astype(np.int32))
                    at += 1
            deal = mixed(np.arange(seen, seen + len(row), dtype=np.uint64) * STEP + np.uint64(len(row))) >> np.uint64(2)
            seen += len(row)
            columns = [batch.column("key").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(deal.view(np.int64))]
            names = [key, "piece", "start", "length", "ids_crc32", "deal"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    schema = f"`{key}` {kind}, {PIECE}, deal bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, room: int) -> int:
    """Sequences that any packing needs: the best of the dual-feasible functions u(k) and of those that round up what is over a cut."""
    if not len(lengths):
        return 0
    size, count = np.unique(lengths, return_counts=True)
    best = -(-int((size * count).sum()) // room)
    for k in range(1, 21):
        whole = (k + 1) * size % room == 0
        best = max(best, -(-int((np.where(whole, k * size, (k + 1) * size // room * room) * count).sum()) // (k * room)))
    for cut in size[size * 2 <= room]:
        value = np.where(size > room - cut, room, np.where(size < cut, 0, size))
        best = max(best, -(-int((value * count).sum()) // room))
    return best


def best_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and what stays free in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, free = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_: list[list[int]] = [[] for _ in range(room + 1)]
    mask = 0  # of the amounts of room that some bin has left
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = open_[left].pop()
            if not open_[left]:
                mask &= ~(1 << left)
        else:
            left, b = room, len(free)
            free.append(room)
        bins[i], offsets[i] = b, room - left
        left -= size
        free[b] = left
        if left:
            open_[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def packer(room: int, round_: int, last: bool):
    """Packs one partition; ``open`` marks what goes into the next round."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, free = best_fit_decreasing(lengths, room)
        bound = lower_bound(lengths, room)
        if last:
            again = np.zeros(len(free), bool)
        elif len(free) > bound:
            again = free > 0
        else:
            again = np.arange(len(free)) == np.argmax(free)
        place = table.column("place")[0].as_py()
        table = table.drop_columns(["place"])
        for name, column in (
            ("sequence_id", bins + (round_ << 56) + (place << 32)), ("offset", offsets), ("open", again[bins]), ("place", np.full(len(bins), place)),
            ("bins", np.full(len(bins), len(free))), ("bound", np.full(len(bins), bound)),
        ):
            table = table.append_column(name, pa.array(column))
        return table

    return pack


def pack(parts: DataFrame, room: int = LENGTH, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces with ``length`` and ``deal``."""
    columns = parts.columns
    rest, done = parts, []
    for round_ in range(rounds + 1):
        n = rest.count()
        places = max(1, -(-n // partition_pieces))
        last = places == 1 or round_ == rounds
        dealt = rest.select(*columns, F.pmod(F.xxhash64("deal", F.lit(round_)), F.lit(places)).alias("place"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
        out = dealt.groupBy("place").applyInArrow(packer(room, round_, last), f"{schema}, sequence_id bigint, offset bigint, open boolean, place bigint, bins bigint, bound bigint")
        out = written(out)
        done.append(out.filter(~F.col("open")))
        rest = out.filter(F.col("open"))
        if last or rest.isEmpty():
            break
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result.select(*[c for c in columns if c != "deal"], "sequence_id", "offset")


def packed_documents(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, with_ids: bool = False,
    partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS,
) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of each piece of each document, and its ids if wanted."""
    return pack(written(pieces(docs, tokenizer_path, key, text, length, end, with_ids)), length, partition_pieces, rounds)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and all ids in order; ``packed`` must hold ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
