"""Near duplicates: groups of rows whose texts share most of their word runs (multi-index hashing).

The fingerprint of a text is 64 minwise symbols of 16 bits; its Hamming distance (symbols that differ) over 64
estimates 1 - likeness. It is cut into 16 segments of 4 symbols; of each segment the ball of radius 1 in symbols is
enumerated (the 4 keys that leave one symbol open), and rows that meet under a key are candidates. Their complete
distances are computed (by the low byte of each symbol, which only lets more through), and the exact likeness of those
that are near enough decides every link.

Rows of a likeness J meet in a segment with a probability of J**4 + 4 * J**3 * (1 - J), so a pair at the threshold of
0.5 is found with 0.9975, one at 0.55 with 0.9997; frequent runs count like any other. What a large bucket leaves
unconnected is compared by an exact prefix filter (``prefixes``), which loses no pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.words import Shingler, class_ids, pair_likeness
from lathework.llm.components import components
from lathework.llm.minwise import signatures
from lathework.llm.prefixes import PROBE, frequency_order, levels_of, prefixes, required_sql
from lathework.session import materialise

SEGMENTS, WIDTH = 16, 4
SYMBOLS = SEGMENTS * WIDTH
FEW, BACK, WIDE = 32, 3, 256  # rows of a bucket that are paired at once; predecessors in a larger one; rows that are paired across components
SHARED = 4
FILTER_BITS = 1 << 23


def _prints(k: int):
    def run(batches):
        sh = Shingler(k)
        for b in batches:
            flat, starts = sh.sets(b.column(1).to_pylist())
            c1, c2 = class_ids(flat, starts)
            fp = signatures(flat, starts, SYMBOLS)
            hi, lo = (pa.array([r.tobytes() for r in x.astype(np.uint8)], pa.binary()) for x in (fp >> 8, fp & 0xFF))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c1), pa.array(c2), hi, lo], ["id", "c1", "c2", "hi", "lo"])

    return run


def ball_keys(fp: np.ndarray) -> np.ndarray:
    """64 keys of each fingerprint: per segment the members of its ball of radius 1, as 6 bits of table and 48 of symbols."""
    s = fp.reshape(len(fp), SEGMENTS, WIDTH).astype(np.int64)
    keys = np.empty((len(fp), SEGMENTS, WIDTH), np.int64)
    for open_ in range(WIDTH):
        x, y, z = (s[:, :, j] for j in range(WIDTH) if j != open_)
        keys[:, :, open_] = (x << 32) | (y << 16) | z
    table = np.arange(SYMBOLS, dtype=np.int64).reshape(SEGMENTS, WIDTH)
    return (keys | (table << 48)).reshape(len(fp), SYMBOLS)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SYMBOLS)


def _keys(batches):
    for b in batches:
        hi, lo = (_bytes(b.column(j)) for j in (1, 2))
        fp = hi.astype(np.uint16) << 8 | lo
        ids = np.repeat(np.asarray(b.column(0)), SYMBOLS)
        keys = ball_keys(fp).reshape(-1)
        for at in range(0, len(keys), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 17)]), pa.array(ids[at : at + (1 << 17)])], ["key", "id"])


def _bucket_pairs(batches):
    """Of rows sorted by key and id: (a, b, false), all pairs of a key of at most 32 rows.

    A larger key gives each row with the first (smallest) one and with the up to 3 rows before it, and its rows again, as
    (key, id, true). Memory is bounded whatever the size of a bucket: up to 32 rows are kept for the next batch.
    """

    def broad(out: list, kk, ii, lead, tail) -> np.ndarray:
        """Rows of one large bucket, whose first row is ``lead`` and whose last rows before are ``tail``."""
        i2 = np.concatenate([tail, ii])
        out.append((np.full(len(ii), lead), ii, np.zeros(len(ii), bool)))
        for d in range(1, BACK + 1):
            at = np.arange(max(d, len(tail)), len(i2))
            out.append((i2[at - d], i2[at], np.zeros(len(at), bool)))
        out.append((kk, ii, np.ones(len(kk), bool)))
        return i2[-BACK:]

    none = np.empty(0, np.int64)
    kept, lead, tail = (none, none), None, none  # rows of the last key; of a large one its first row and last rows
    for b in _ended(batches):
        out: list = []
        kk, ii = kept if b is None else (np.concatenate([kept[0], np.asarray(b.column(0))]), np.concatenate([kept[1], np.asarray(b.column(1))]))
        kept = (none, none)
        if lead is not None:  # the large bucket goes on
            m = int(np.searchsorted(kk, lead[0], "right"))
            if m:
                tail = broad(out, kk[:m], ii[:m], lead[1], tail)
                kk, ii = kk[m:], ii[m:]
            if len(kk):
                lead = None
        if len(kk):
            first = np.flatnonzero(np.r_[True, kk[1:] != kk[:-1]])
            ends = np.r_[first[1:], len(kk)]
            large = ends - first > FEW
            if b is not None and not large[-1]:
                kept = kk[first[-1] :], ii[first[-1] :]
                first, ends, large = first[:-1], ends[:-1], large[:-1]
            for s, e in zip(first[large], ends[large]):
                tail = broad(out, kk[s:e], ii[s:e], ii[s], none)
                if e == len(kk):
                    lead = kk[s], ii[s]
            small = np.repeat(~large, ends - first)
            kk, ii = kk[: len(small)][small], ii[: len(small)][small]
            at = np.arange(len(kk))
            for d in range(1, FEW):
                at = at[at >= d]
                at = at[kk[at] == kk[at - d]]
                if not len(at):
                    break
                out.append((ii[at - d], ii[at], np.zeros(len(at), bool)))
        if out:
            a, c, again = (np.concatenate(x) for x in zip(*out))
            keep = again | (a != c)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (a, c, again)], ["a", "b", "again"])


def _ended(batches):
    yield from batches
    yield None


def _agreement(batches):
    """Equal low bytes of two fingerprints: no fewer than their equal symbols."""
    for b in batches:
        x, y = (_bytes(b.column(j)) for j in (2, 3))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((x == y).sum(1).astype(np.int16))], ["a", "b", "same"])


def _sets(k: int, bits):
    def run(batches):
        sh, want = Shingler(k), np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for b in batches:
            hit = np.flatnonzero(want[np.asarray(b.column(2))])
            if len(hit):
                flat, starts = sh.sets(b.column(1).take(pa.array(hit)).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(hit)), pa.array([flat[s:e].tobytes() for s, e in zip(starts, starts[1:])], pa.binary())], ["id", "set"])

    return run


def _verify(threshold: float):
    def run(batches):
        for b in batches:
            ok = pa.array(pair_likeness(b.column(2).to_pylist(), b.column(3).to_pylist()) >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])

    return run


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    la = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    lb = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return pairs.join(la, "a", "left").join(lb, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").drop("ra", "rb")


def near_duplicate_groups(df: DataFrame, id_col: str, text_cols: list[str], k: int = 3, threshold: float = 0.5) -> DataFrame:
    """(group_id, id): one row for each member of a group but the smallest, which names it.

    Two rows are alike when the distinct runs of ``k`` words of their texts (``text_cols``, joined by a blank)
    have a likeness of ``threshold`` or more. Groups are what alike pairs connect. Null texts count as empty; texts
    without words are copies of each other; rows with a null id are left out, repeated ids are one row each;
    an empty table gives no rows; other columns are ignored.

    Copies (equal sets of word runs) are collapsed first by partial aggregation, so a group of copies of any size is
    one row in the index. Of a bucket all pairs are made up to 32 rows; a larger one links its rows with the first and 3 predecessors,
    and, where that leaves it in several components, pairs its rows across them, up to 256 rows. Rows of buckets still
    larger go through the prefix filter together, across components. So no bucket is cut and none makes all its pairs.
    """
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).where("id is not null")
    prints = materialise(rows.mapInArrow(_prints(k), "id long, c1 long, c2 long, hi binary, lo binary"), "prints")
    classes = prints.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.max("id").alias("most")).where("most > rep").select("c1", "c2", "rep")
    copies = prints.select("id", "c1", "c2").join(classes, ["c1", "c2"]).where("id <> rep").select("id", "rep")
    reps = materialise(prints.groupBy("c1", "c2").agg(F.min("id").alias("id"), F.first("hi").alias("hi"), F.first("lo").alias("lo")).select("id", "hi", "lo"), "classes")

    # Agreement of two texts at the threshold has a deviation of half a symbol times sqrt(64); beyond four of them nothing is alike.
    low = int((threshold - 4 * (threshold * (1 - threshold) / SYMBOLS) ** 0.5) * SYMBOLS)

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs whose distance, by the low bytes of all symbols, doesn't rule them out."""
        fa, fb = (reps.select(F.col("id").alias(x), F.col("lo").alias("f" + x)) for x in "ab")
        got = pairs.join(fa, "a").join(fb, "b").select("a", "b", "fa", "fb").mapInArrow(_agreement, "a long, b long, same short")
        return materialise(got.where(F.col("same") >= low).select("a", "b"), "near")

    keys = reps.mapInArrow(_keys, "key long, id long")
    met = materialise(keys.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_bucket_pairs, "a long, b long, again boolean"), "met")
    pairs = materialise(met.where("not again").groupBy("a", "b").agg(F.count("*").alias("n")), "pairs")
    # the partner that each row meets most often first, then what that leaves unconnected
    best = pairs.groupBy("b").agg(F.max(F.struct("n", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    roots = components(_exact(rows, near(best), k, threshold))
    large = _spanning(met.where("again").select(F.col("a").alias("key"), F.col("b").alias("id")), roots)
    within = _near_within(large.where(F.col("n") <= WIDE), reps, low)
    rest = materialise(near(_across(pairs.select("a", "b"), roots)).union(within).distinct(), "rest")
    roots = components(roots.union(_exact(rows, rest, k, threshold)))
    wide = _spanning(large.where(F.col("n") > WIDE).select("key", "id"), roots)
    if not wide.isEmpty():
        roots = components(roots.union(_prefix_links(rows, wide.select("id", "root").distinct(), k, threshold)))
    # members of classes follow their representative
    label = roots.select(F.col("node").alias("rep"), "root")
    out = copies.join(label, "rep", "left").select(F.coalesce("root", "rep").alias("group_id"), "id")
    return out.union(roots.select(F.col("root").alias("group_id"), F.col("node").alias("id")))


def _spanning(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, root, n): the rows of large buckets whose n rows aren't all in one component yet.

    A family of near duplicates, however large, is one component through the first row of its bucket and is left out.
    Of buckets that hold the same rows (texts that agree in a whole segment meet under its 4 keys) one stays.
    """
    got = large.join(labels, large.id == labels.node, "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    same = [F.expr(f"bit_xor(xxhash64(id, {i}))").alias(f"h{i}") for i in (1, 2)]
    keys = got.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), *same).where("lo < hi")
    keys = keys.groupBy("h1", "h2", "n").agg(F.min("key").alias("key")).select("key", "n")
    return materialise(got.join(keys, "key"), "large")


def _near_within(large: DataFrame, reps: DataFrame, low: int) -> DataFrame:
    """(a, b): rows of one key and different components that agree in ``low`` symbols (by their low bytes), for keys of at most ``WIDE`` rows.

    Fingerprints go to the rows of a bucket, not to its pairs: what is shuffled grows with rows, and only near pairs leave a bucket.
    """
    rows = large.select("key", "id", "root").join(reps, "id").select("key", "id", "root", "lo")
    return rows.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_bucket_near(low), "a long, b long")


def _bucket_near(low: int):
    """Of rows (key, id, root, lo) sorted by key and id the near pairs of each key. The rows of the last key are kept for the next batch."""

    def near(b: pa.RecordBatch) -> pa.RecordBatch:
        key, ids, root = (np.asarray(b.column(j)) for j in range(3))
        lo = _bytes(b.column(3))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        out = [(np.empty(0, np.int64),) * 2]
        for s, e in zip(first, np.r_[first[1:], len(key)]):
            x = np.ascontiguousarray(lo[s:e].T)
            same = np.zeros((e - s, e - s), np.uint8)
            for symbol in x:
                same += symbol[:, None] == symbol
            x, y = np.nonzero(np.triu((same >= low) & (root[s:e, None] != root[s:e]), 1))
            out.append((ids[s + x], ids[s + y]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    def run(batches):
        kept = None
        for b in batches:
            if not b.num_rows:
                continue
            if kept is not None:
                b = pa.Table.from_batches([kept, b]).combine_chunks().to_batches()[0]
            key = np.asarray(b.column(0))
            end = int(np.searchsorted(key, key[-1]))
            if end:
                yield near(b.slice(0, end))
            kept = b.slice(end)
        if kept is not None:
            yield near(kept)

    return run


def _slots(threshold: float, packed):
    def run(batches):
        levels = levels_of(packed.value)
        for b in batches:
            sets = b.column(2).to_pylist()
            starts = np.cumsum([0] + [len(x) // 4 for x in sets])
            slot, key, at, side = prefixes(np.frombuffer(b"".join(sets), np.uint32), starts, threshold, levels, SHARED, False)
            ids, roots = (np.asarray(b.column(j))[at] for j in (0, 1))
            for i in range(0, len(slot), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 17)]) for x in (slot, key, ids, roots, side)], ["slot", "key", "id", "root", "side"])

    return run


def _prefix_links(rows: DataFrame, members: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b): the alike pairs across components among ``members`` (id, root)."""
    spark = rows.sparkSession
    texts = members.join(rows, "id").select("id", "root", "text")
    sets = materialise(texts.mapInArrow(_all_sets(k), "id long, root long, set binary"), "hot")
    packed = spark.sparkContext.broadcast(frequency_order(sets.select("set")))
    slots = materialise(sets.mapInArrow(_slots(threshold, packed), "slot long, key long, id long, root long, side byte"), "slots")
    x = slots.where(F.col("side") >= PROBE).select("slot", "side", F.col("key").alias("kx"), F.col("id").alias("x"), F.col("root").alias("rx"))
    y = slots.where(F.col("side") != PROBE).select("slot", F.col("key").alias("ky"), F.col("id").alias("y"), F.col("root").alias("ry"))
    # of a split run only the smaller set asks, of others both do
    once = f"if(side = {PROBE}, kx div 65536 < ky div 65536 or (kx div 65536 = ky div 65536 and x < y), x < y)"
    got = x.join(y, "slot").where(f"rx <> ry and {once}").withColumn("need", F.expr(required_sql("kx", "ky", threshold, SHARED))).where("need > 0")
    got = got.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "need")
    pairs = got.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("a", "b")
    sa, sb = (sets.select(F.col("id").alias(c), F.col("set").alias("s" + c)) for c in "ab")
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(_verify(threshold), "a long, b long")


def _all_sets(k: int):
    def run(batches):
        sh = Shingler(k)
        for b in batches:
            flat, starts = sh.sets(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([flat[s:e].tobytes() for s, e in zip(starts, starts[1:])], pa.binary())], ["id", "root", "set"])

    return run


def _exact(rows: DataFrame, pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs whose likeness reaches the threshold; only the texts that take part are brought to their pairs."""
    spark = rows.sparkSession
    bit = F.expr(f"pmod(xxhash64(id), {FILTER_BITS})")
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    words = ends.select(bit.alias("bit")).groupBy(F.expr("bit div 32").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("v")).collect()
    want = np.zeros(FILTER_BITS // 32, np.uint32)  # a filter of fixed size; the join below decides
    for w in words:
        want[w.w] = w.v
    packed = np.packbits(np.unpackbits(want.view(np.uint8), bitorder="little")).tobytes()
    sets = rows.select("id", "text", bit.cast("int").alias("bit")).mapInArrow(_sets(k, spark.sparkContext.broadcast(packed)), "id long, set binary")
    sa, sb = (sets.select(F.col("id").alias(x), F.col("set").alias("s" + x)) for x in "ab")
    # repeated ids would repeat pairs, which only repeats links
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(_verify(threshold), "a long, b long")
