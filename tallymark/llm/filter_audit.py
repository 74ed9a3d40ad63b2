"""How five document filters interact: what each removes in every order in which they can be applied.

Each document gets a mask of the filters that it fails. Equal masks are counted, so the orders only meet a small table for
each part of the corpus. There the step at which a mask is removed is a min-plus product: of the mask matrix (0 where the
filter fails, beyond the last step where not) and the matrix of the filters' positions in each order (the inverse
permutations). Counts are scattered by that step; a filter is redundant for what fails it and was removed before.

Copies (filter E) are found table-wide: counts by digest, part and mask come first, then the smallest id of each digest.

Defined cases: null texts are empty; a null part is the empty string; null ids are no copies and make none; rows that repeat
an id are no copies of each other; ids with several label rows count as good or toxic if one row says so; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Distinct words and capitals in percent of words and characters.
LEAST_DISTINCT, MOST_CAPITALS = 50, 2

ORDERS = np.array(list(permutations(range(len(FILTERS)))))
#: Step (from 1) of each filter in each order.
POSITIONS = np.argsort(ORDERS, axis=1) + 1
NEVER = len(FILTERS) + 1

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SYMBOL = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_INSIDE = bytes(range(0x80, 0xC0))
_PIECE = 1 << 20

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_failures(data: bytes) -> int:
    """Bits of A to D for one UTF-8 text."""
    words, distinct, at = 0, set(), 0
    while at < len(data):  # long texts in pieces that end between words
        to = at + _PIECE
        space = _SPACE.search(data, to) if to < len(data) else None
        to = space.start() if space else len(data)
        found = data[at:to].split()
        words += len(found)
        distinct.update(found)
        at = to
    capitals, points = len(data) - len(data.translate(None, _CAPITALS)), len(data.translate(None, _INSIDE))
    fails = (words < LEAST_WORDS, 100 * len(distinct) < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, bool(_SYMBOL.search(data)))
    return sum(1 << i for i, f in enumerate(fails) if f)


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """id, part, digest of the text, mask of A to D."""
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def check(batches):
        for batch in batches:
            digests, masks = [], []
            for value in batch.column("text"):
                data = value.as_buffer().to_pybytes()
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
                masks.append(own_failures(data))
            yield pa.record_batch([batch.column("id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())], names=["id", "part", "digest", "mask"])

    return rows.mapInArrow(check, "id bigint, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask of A to E, good, toxic, n: the documents of each part by what they fail and how they are labelled."""
    rows = failures(docs, key, text, part).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col(key).cast("bigint").alias("l_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, F.col("id") == F.col("l_id"), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    named = F.col("id").isNotNull()
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(F.min(F.when(named, F.struct("id", "n"))).alias("low"), F.sum("n").alias("n"), F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("nameless"))
    # The rows of an id may differ in nothing but their number, so those of the smallest id stand in ``low``.
    first = groups.groupBy(F.col("digest").alias("f_digest")).agg(F.min("low.id").alias("first"))
    groups = groups.join(first, F.col("digest") == F.col("f_digest"))
    own = F.col("nameless") + F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("mask").alias("m"), own.alias("c")), F.struct(F.col("mask").bitwiseOR(F.lit(copy)).alias("m"), (F.col("n") - own).alias("c"))))
    each = groups.select("part", "good", "toxic", both.alias("x")).filter("x.c > 0")
    return each.groupBy("part", F.col("x.m").alias("mask"), "good", "toxic").agg(F.sum("x.c").alias("n"))


def removal_steps(masks: np.ndarray) -> np.ndarray:
    """Step at which each mask is removed in each order (masks x orders), NEVER or more where nothing fails."""
    passes = np.where((masks[:, None] >> np.arange(len(FILTERS))) & 1, 0, NEVER)
    return (passes[:, None, :] + POSITIONS[None, :, :]).min(axis=2)


def order_counts(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Each count as an array (orders x steps)."""
    steps, size = removal_steps(masks), len(FILTERS)
    removed, good_lost, toxic_lost = (np.zeros((len(ORDERS), 2 * NEVER + 1), np.int64) for _ in range(3))
    at = np.broadcast_to(np.arange(len(ORDERS)), steps.shape)
    for out, weight in ((removed, n), (good_lost, n * good), (toxic_lost, n * toxic)):
        np.add.at(out, (at, steps), np.broadcast_to(weight[:, None], steps.shape))
    removed, good_lost, toxic_lost = (x[:, 1 : size + 1] for x in (removed, good_lost, toxic_lost))
    fails = (masks[:, None] >> np.arange(size)) & 1
    earlier = steps[:, :, None] < np.arange(1, size + 1)
    redundant = np.einsum("m,mos,mos->os", n, fails[:, ORDERS], earlier.astype(np.int64))
    alone = np.array([n[masks == 1 << f].sum() for f in range(size)], np.int64)
    shapley = np.array([removed[ORDERS == f].sum() for f in range(size)], np.int64)
    return {
        "kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": redundant, "unique_fails": alone[ORDERS],
        "good_lost": good_lost, "toxic_lost": toxic_lost, "shapley": shapley[ORDERS],
    }


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step and COUNTS: a row for each part, each order of the filters and each step."""
    names = ["".join(FILTERS[f] for f in o) for o in ORDERS]

    def audit(table: pa.Table) -> pa.Table:
        masks, n, good, toxic = (table.column(c).to_numpy().astype(np.int64) for c in ("mask", "n", "good", "toxic"))
        found, rows = order_counts(masks, n, good, toxic), ORDERS.size
        out = {
            "part": pa.array([table.column("part")[0].as_py()] * rows, pa.string()), "filter_order": pa.array(np.repeat(names, len(FILTERS)).tolist(), pa.string()),
            "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS)), pa.int32()),
        }
        return pa.table(out | {c: pa.array(found[c].ravel(), pa.int64()) for c in COUNTS})

    counts = mask_counts(docs, labels, key, text, part)
    return counts.groupBy("part").applyInArrow(audit, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))
