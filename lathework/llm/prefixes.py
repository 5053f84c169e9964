"""Exact candidates for likeness: prefixes of sets ordered by frequency.

All runs of words stand in one order, rare ones first. Two sets of likeness t or more share t / (1 + t) of their sizes' sum
at least, so the first runs that they share, in that order, lie near the beginning of both: the i-th of them within the
first n - ceil(t * n) + i of a set of n. Sets that don't meet there can't be alike, whatever their runs weigh; frequent
runs are reached only where rare ones can't decide. The order needs no exact counts, only that it never changes.

A frequent run is split by the sizes of sets: how many runs are left from it on bounds the size of a partner, so a set
asks only for partners of those sizes. A phrase that many texts share, but too short to make them alike, thus
brings none of them together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import materialise

SLOTS, SHIFT = 1 << 22, np.uint32(10)
CUT = 0xFFFF  # sizes are kept in 16 bits; a longer set passes every test of size
SPLIT = 128  # sets that hold a run from which on it is split by sizes
INDEX, PROBE = 1, 2


def frequency_order(sets: DataFrame, share: float = 0.00006, floor: int = 8) -> bytes:
    """The slots (22 bits of a run's hash) that ``share`` of all sets hold, with their level of frequency.

    ``sets`` has one binary column. Every set is counted; a partition reports what a third of ``share`` of its sets hold,
    and two at least, so levels depend a little on the partitioning; candidates are complete under any levels that stay.
    Less than runs per set / ``share`` slots are sent to the driver, whatever the number of sets.
    """

    def count(batches):
        n, c = 0, np.zeros(SLOTS, np.int32)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint32)
            at, m = np.unique(flat >> SHIFT, return_counts=True)
            c[at] += m.astype(np.int32)
            n += b.num_rows
        slots = np.flatnonzero(c >= max(2, share * n / 3))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, slots].astype(np.int32)), pa.array(np.r_[n, c[slots]].astype(np.int64))], ["slot", "n"])

    got = materialise(sets.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")), "slots")
    total = got.where("slot = -1").first()
    least = max(floor, share * (total.n if total else 0))
    level = lambda n: f"cast(least(1 + round(4 * log2(greatest({n} / {least!r}D, 1))), 255) as long)"
    rows = got.where((F.col("slot") >= 0) & (F.col("n") >= least)).select(F.expr(f"slot * 256L + {level('n')}").alias("x")).toArrow()
    split = sets.sparkSession.range(1).select(F.expr(level(SPLIT))).first()[0]
    return np.r_[np.uint32(split), rows.column("x").to_numpy().astype(np.uint32)].tobytes()


def levels_of(packed: bytes) -> tuple[np.ndarray, int]:
    """The level of each slot, and the level from which on runs are split by sizes."""
    x = np.frombuffer(packed, np.uint32)
    levels = np.zeros(SLOTS, np.uint8)
    levels[x[1:] >> np.uint32(8)] = x[1:] & np.uint32(255)
    return levels, int(x[0])


def _bin(n: np.ndarray) -> np.ndarray:
    """Sizes in steps of about 6 %, from 1 on; rises with the size."""
    return np.where(n < 16, n, 16 + np.floor(np.log(np.maximum(n, 16) / 16) / 0.06)).astype(np.int64)


def prefixes(flat: np.ndarray, starts: np.ndarray, threshold: float, levels: tuple[np.ndarray, int], shared: int, both_ways: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, key, set, side) in arrays: where each set is found (side INDEX), where it asks for others (PROBE), or both (their sum).

    A slot is a run (32 bits) and, of a run that is split, the sizes (16 bits, else 0). A key holds the size of the set and how many
    of its runs are left from this one on (16 bits each). Alike sets meet in ``shared`` slots at least, or in as many as
    ``required`` says. Without ``both_ways`` a set asks only for sets as large or larger where runs are split.
    """
    level, split = levels
    n = np.diff(starts)
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    order = np.sort(doc << np.uint64(40) | level[flat >> SHIFT].astype(np.uint64) << np.uint64(32) | flat.astype(np.uint64))
    place = np.arange(len(flat)) - np.repeat(starts[:-1], n)
    least = np.ceil(threshold * n - 1e-9).astype(np.int64)  # a partner's size
    near = place < np.repeat(np.minimum(n, n - least + shared), n)
    order, doc, all_, least = order[near], doc[near].astype(np.int64), np.repeat(n, n)[near], np.repeat(least, n)[near]
    left = all_ - place[near]
    slot = (order & np.uint64(0xFFFFFFFF)).astype(np.int64) << 16
    key = np.minimum(all_, CUT) << 16 | np.minimum(left, CUT)
    hot = (order >> np.uint64(32) & np.uint64(255)).astype(np.int64) >= split
    most = np.floor((left + shared - 1) * (1 + threshold) / threshold + 1e-9).astype(np.int64) - all_  # a partner's size
    most = np.minimum(np.where(all_ >= CUT, np.iinfo(np.int32).max, most), np.floor(all_ / threshold + 1e-9).astype(np.int64))
    lo, hi = _bin(np.maximum(least if both_ways else all_, 1)), _bin(np.maximum(most, 1))
    width = np.where(hot & (most >= np.where(both_ways, least, all_)), hi - lo + 1, 0)
    asks = np.repeat(np.flatnonzero(hot), width[hot])
    bins = lo[asks] + np.arange(len(asks)) - np.repeat(np.cumsum(width[hot]) - width[hot], width[hot])
    slots = np.r_[slot | np.where(hot, _bin(np.maximum(all_, 1)), 0), slot[asks] | bins]
    side = np.r_[np.where(hot, INDEX, INDEX + PROBE), np.full(len(asks), PROBE)].astype(np.int8)
    return slots, np.r_[key, key[asks]].astype(np.int64), np.r_[doc, doc[asks]], side


def required_sql(x: str, y: str, threshold: float, shared: int) -> str:
    """Of two key columns in one slot: how many such meetings the sets need to be alike; 0 where they can't be through it."""
    both = f"({threshold / (1 + threshold)!r}D * (shiftright({x}, 16) + shiftright({y}, 16)) - 1e-9D)"
    return f"cast(if(least({x} & {CUT}, {y} & {CUT}) + {shared - 1} >= {both}, least({shared}, ceil({both})), 0) as smallint)"
