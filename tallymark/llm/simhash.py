"""Near-duplicate documents by SimHash, compared in bit slices.

A document's fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of its word shingles. Two
fingerprints are linked when at most three bits differ.

Equal fingerprints are one node. The 64 bits are cut into five parts; two linked fingerprints agree in two parts at least, so
each of the ten ways to choose two parts gives a table of buckets, and no link is lost. A bucket with more than ``LIMIT``
members is cut again by the bits that its members may still differ in, the same way; after three cuts at most 15 bits are
free, so no bucket can hold more than 32,768 fingerprints.

Inside the buckets the fingerprints are stored as bit planes: one word holds one bit of 64 fingerprints. A query flips the
planes where its own bit is set and adds them up in two carry-save counters and an overflow, so 64 distances grow with a few
bitwise operations; a word is abandoned as soon as all its fingerprints overflow. Members linked to the first one of their
bucket need no comparison of their own. A bucket returns one edge for each member at most.

Defined cases: null, empty and wordless texts have fingerprint zero and are linked like any other; rows that repeat an id are
linked by their own texts and share the id; null ids take part but name no component (null if no member has an id); an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.minmax import components
from tallymark.session import written

WORDS = 3
SEED = 42
PARTS, AGREE, LEVELS = 5, 2, 3
LIMIT = 1 << 15
#: Pairs of a query and a word of 64 fingerprints that are compared at once.
SLICE = 1 << 16

_ALL = np.uint64(2**64 - 1)
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """Fingerprint of one UTF-8 text, A-Z in lower case; a long text is handled in pieces."""
    counts, total, at, tail = np.zeros(64, np.int64), 0, 0, []
    data = data.lower()
    while at < len(data):
        to = at + _PIECE
        space = _SPACE.search(data, to) if to < len(data) else None
        to = space.start() if space else len(data)
        found = tail + data[at:to].split()
        at = to
        if len(found) < words and at < len(data):
            tail = found
            continue
        if not found:
            continue
        size = min(words, len(found)) if not total else words
        if len(found) < size:
            break
        line = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in spans), np.uint64, len(found) - size + 1)
        by_byte = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[8 * k : 8 * k + 8] += np.bincount(by_byte[:, k], minlength=256) @ _BITS
        total += len(hashes)
        tail = found[-(words - 1) :] if words > 1 else []
    return sum(1 << b for b in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """id and fp, the fingerprint as a signed number."""
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def sign(batches):
        for batch in batches:
            found = np.array([fingerprint(value.as_buffer().to_pybytes(), words) for value in batch.column("text")], np.uint64)
            yield pa.record_batch([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(sign, "id bigint, fp bigint")


def ways(free: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The sets of bits that a bucket may fix, of those that are still free."""
    parts = np.array_split(np.array(free), PARTS)
    return [tuple(np.concatenate(two).tolist()) for two in combinations(parts, AGREE)]


def free_bits(path: int) -> tuple[int, ...]:
    """Bits that may differ in the buckets of a table; ``path`` has a decimal digit for each cut, after a leading 1."""
    free = tuple(range(64))
    for digit in str(path)[1:]:
        fixed = set(ways(free)[int(digit)])
        free = tuple(b for b in free if b not in fixed)
    return free


def bucketed(points: DataFrame) -> DataFrame:
    """path, bits, fp of the ten buckets of each row (path, fp) at the next cut."""

    def place(batches):
        for batch in batches:
            paths, fps = batch.column("path").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            for path in np.unique(paths).tolist():
                own = fps[paths == path]
                for digit in range(len(ways(free_bits(path)))):
                    longer = 10 * path + digit
                    fixed = int(_ALL) - sum(1 << b for b in free_bits(longer))
                    yield pa.record_batch([pa.array(np.full(len(own), longer)), pa.array((own & np.uint64(fixed)).view(np.int64)), pa.array(own.view(np.int64))], names=["path", "bits", "fp"])

    return points.mapInArrow(place, "path bigint, bits bigint, fp bigint")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Planes (64 x words): bit i of word w in plane b is bit b of fingerprint 64 w + i."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_three(queries: np.ndarray, words: np.ndarray, planes: np.ndarray, free: tuple[int, ...]) -> np.ndarray:
    """For each pair of a query and a word: the set of the word's fingerprints that differ in at most three of the free bits."""
    out, alive = np.zeros(len(queries), np.uint64), np.arange(len(queries))
    ones, twos, over = (np.zeros(len(queries), np.uint64) for _ in range(3))
    for i, b in enumerate(free):
        differ = planes[b][words] ^ (np.uint64(0) - ((queries >> np.uint64(b)) & np.uint64(1)))
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if i % 6 == 5:
            on = over != _ALL
            if not on.all():
                alive, queries, words, ones, twos, over = (x[on] for x in (alive, queries, words, ones, twos, over))
                if not len(alive):
                    return out
    out[alive] = ~over
    return out


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the rows ``a`` and ``b`` are put together pair by pair; a label is the smallest row of its set."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
    return label


def bucket_links(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, free: tuple[int, ...]) -> np.ndarray:
    """Label of each fingerprint: the smallest row that it is connected with inside its bucket (starts[k] to ends[k])."""
    n, planes = len(fps), bit_planes(fps)
    label = np.arange(n)
    begin, end = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)

    def compare(rows: np.ndarray) -> None:
        """Link ``rows`` with all members of their buckets."""
        nonlocal label
        first, last = begin[rows] // 64, (end[rows] - 1) // 64
        upto = np.cumsum(last - first + 1)
        for low in range(0, int(upto[-1]) if len(upto) else 0, SLICE):
            pair = np.arange(low, min(low + SLICE, int(upto[-1])))
            which = np.searchsorted(upto, pair, side="right")
            row, word = rows[which], pair - (upto[which] - (last - first + 1)[which]) + first[which]
            found = within_three(fps[row], word, planes, free)
            hit = np.flatnonzero(found)
            lanes = np.unpackbits(found[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(lanes)
            row, other = row[hit][at], 64 * word[hit][at] + lane
            inside = (other >= begin[row]) & (other < end[row]) & (other != row)
            label = merged(label, row[inside], other[inside])

    compare(starts)
    compare(np.flatnonzero(label != begin))
    return label


def linked(members: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is linked inside the buckets of ``members`` (path, bits, fp); every bucket in one task."""
    rows = members.repartition("path", "bits").sortWithinPartitions("path", "bits", "fp")

    def edges(path: np.ndarray, bits: np.ndarray, fps: np.ndarray):
        new = np.ones(len(fps), bool)
        new[1:] = (path[1:] != path[:-1]) | (bits[1:] != bits[:-1])
        starts = np.flatnonzero(new)
        for p in np.unique(path[starts]).tolist():
            of = np.flatnonzero(path == p)
            low, high = of[0], of[-1] + 1
            own = starts[(starts >= low) & (starts < high)] - low
            label = bucket_links(fps[low:high], own, np.append(own[1:], high - low), free_bits(p))
            moved = np.flatnonzero(label != np.arange(high - low))
            yield pa.record_batch([pa.array(fps[low:high][label[moved]].view(np.int64)), pa.array(fps[low:high][moved].view(np.int64))], names=["a", "b"])

    def stream(batches):
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("path", "bits", "fp")]
            now[2] = now[2].view(np.uint64)
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(held[0]):
                continue
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut:
                yield from edges(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield from edges(*held)

    return rows.mapInArrow(stream, "a bigint, b bigint")


def links(points: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all that are linked."""
    out, points = None, points.select(F.lit(1).cast("bigint").alias("path"), "fp")
    for level in range(1, LEVELS + 1):
        each = written(bucketed(points))
        sizes = each.groupBy(F.col("path").alias("p"), F.col("bits").alias("k")).agg(F.count("*").alias("n")).filter("n > 1")
        placed = each.join(sizes, (F.col("path") == F.col("p")) & (F.col("bits") == F.col("k"))).select("path", "bits", "fp", "n")
        found = linked(placed.filter(F.col("n") <= limit) if level < LEVELS else placed)
        out = found if out is None else out.unionByName(found)
        if level < LEVELS:
            points = written(placed.filter(F.col("n") > limit).select("path", "fp"))
            if points.isEmpty():
                break
    return written(out.distinct())


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, limit: int = LIMIT) -> DataFrame:
    """Per row: key, fingerprint (16 hexadecimal digits), component_id (the smallest id that can be reached)."""
    marks = written(fingerprints(docs, key, text, words))
    classes = written(marks.groupBy("fp").agg(F.min("id").alias("low")))
    groups = components(links(classes, limit))
    named = classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    lowest = named.groupBy(F.col("label").alias("of")).agg(F.min("low").alias("component_id"))
    final = named.join(lowest, F.col("label") == F.col("of")).select(F.col("fp").alias("f"), "component_id")
    out = marks.join(final, F.col("fp") == F.col("f"), "left")
    return out.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
