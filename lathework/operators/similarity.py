"""Corroboration: observations of the same thing within a band of time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 1 << 21  # tokens of either side that a task holds
MEETINGS = 1 << 19  # meetings that are looked at together
CHECKED = 1 << 21  # tokens of pairs that are compared together
PACKED = 1 << 21  # tokens that a task packs together on their way to the cells


def similar_in_band(df: DataFrame, id_col: str, tokens: Column, time_col: str, threshold: float = 0.42, hours: float = 96.0) -> DataFrame:
    """(a, b, similarity) for a < b: token sets with a Jaccard similarity of ``threshold`` within ``hours``.

    Rows are laid into cells: a band of time with what asks for it, the rows of the band itself and of the next one. A band of
    more than ``CELL`` tokens is several cells, each with a part of its rows and a part of those that ask, so no task holds more than
    twice that. In a cell tokens are ordered by rarity and only the first of each row, as many as the threshold leaves room to
    miss, meet (prefix filter). A pair is in one cell and is decided there: only similar pairs leave it, none that reaches the
    threshold is lost. Tokens are compared by 64 bits of hash.
    """
    width = int(hours * 3600)
    laid, kind = _laid(df, id_col, tokens, time_col, F.lit(None).cast("string"), width)
    return laid.groupBy("band", "g", "s").applyInArrow(_similar(threshold, width), f"a {kind}, b {kind}, similarity double")


def peer_labels(df: DataFrame, id_col: str, tokens: Column, time_col: str, label: Column, threshold: float = 0.42, hours: float = 96.0) -> DataFrame:
    """(id, n_peers, labels): of each row that ``similar_in_band`` pairs with others their number and their distinct labels (strings, null ones left out).

    Pairs are counted in their cells. Rows of few tokens may have a large part of all rows as peers; what leaves a cell grows with
    rows and their labels, not with pairs.
    """
    width = int(hours * 3600)
    laid, kind = _laid(df, id_col, tokens, time_col, label, width)
    got = laid.groupBy("band", "g", "s").applyInArrow(_counted(threshold, width), f"id {kind}, n long, labels array<string>")
    # by id as they come, alike next to each other: a partial aggregate would sort them, and their labels would take three times the bytes
    return got.repartition("id").groupBy("id").agg(F.sum("n").alias("n_peers"), F.array_distinct(F.flatten(F.collect_list("labels"))).alias("labels"))


def _laid(df: DataFrame, id_col: str, tokens: Column, time_col: str, label: Column, width: int) -> tuple[DataFrame, str]:
    """(band, g, s, rows, words, codes): the rows (side, id, t, set, label) of each cell, packed; and the type of id."""
    base = df.select(F.col(id_col).alias("id"), F.unix_timestamp(time_col).alias("t"), F.array_distinct(tokens).alias("set"), label.alias("label")).where("id is not null and t is not null and size(set) > 0")
    base = base.select("id", "t", F.transform("set", lambda x: F.xxhash64(x)).alias("set"), "label", F.floor(F.col("t") / width).cast("long").alias("band"))
    sizes = base.groupBy("band").agg(F.sum(F.size("set")).alias("n")).where(F.col("n") > CELL // 2)
    held = {r.band: r.n for r in sizes.collect()}  # at most a row for CELL / 2 tokens
    parts = {j: -(-n // CELL) for j, n in held.items()}
    # a band that isn't in ``held`` has CELL / 2 at most
    asks = {j: -(-(held.get(j, CELL // 2) + held.get(j + 1, CELL // 2)) // CELL) for j in held.keys() | {j - 1 for j in held}}

    def of(x: dict[int, int], band: str) -> str:
        x = {j: n for j, n in x.items() if n > 1}
        return f"coalesce(element_at(map({', '.join(f'{j}L, {n}L' for j, n in sorted(x.items()))}), {band}), 1L)" if x else "1L"

    rows = base.withColumns({"g": F.expr(f"pmod(xxhash64(id, 1), {of(parts, 'band')})"), "s": F.expr(f"pmod(xxhash64(id, 2), {of(asks, 'band')})"), "r": F.expr(f"pmod(xxhash64(id, 2), {of(asks, 'band - 1')})")})
    cell = lambda band, g, s, side: f"struct({band} as band, {g} as g, {s} as s, cast({side} as tinyint) as side)"
    up_to = lambda n: f"sequence(0L, {n} - 1)"
    cells = F.expr(
        f"concat(transform({up_to(of(asks, 'band'))}, i -> {cell('band', 'g', 'i', 'if(i = s, 3, 1)')}), transform(filter({up_to(of(parts, 'band'))}, i -> i <> g), i -> {cell('band', 'i', 's', '2')}), "
        f"transform({up_to(of(parts, 'band - 1'))}, i -> {cell('band - 1', 'i', 'r', '2')}))"
    )
    laid = rows.select("id", "t", "set", "label", F.explode(cells).alias("c")).select("c.*", "id", "t", "set", "label")
    return laid.mapInArrow(_packed, "band long, g long, s long, rows binary, words binary, codes binary"), laid.schema["id"].dataType.simpleString()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a task those of a cell together: a hash that is in many of them is written once."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(pc.list_flatten(batch["set"]))
        if n >= PACKED:
            yield _packs(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield _packs(pa.Table.from_batches(held))


def _packs(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.sort_by([(c, "ascending") for c in ("band", "g", "s", "id")]).combine_chunks()
    at = [rows[c].to_numpy() for c in ("band", "g", "s")]
    starts = np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in at], 0)])
    packs = [_pack(rows.slice(i, j - i)) for i, j in zip(starts, np.r_[starts[1:], rows.num_rows], strict=True)]
    return pa.record_batch([*(pa.array(x[starts]) for x in at), *(pa.array(x, pa.binary()) for x in zip(*packs, strict=True))], ["band", "g", "s", "rows", "words", "codes"])


def _pack(cell: pa.Table) -> tuple[bytes, bytes, bytes]:
    """Rows without their sets; the hashes of these, frequent ones first; of each row the places of its own, ascending, each less the one before."""
    sets = cell["set"].combine_chunks()
    n = pc.list_value_length(sets).to_numpy().astype(np.int64)
    words, code, many = np.unique(pc.list_flatten(sets).to_numpy(), return_inverse=True, return_counts=True)
    order = np.argsort(-many, kind="stable")
    place = np.empty(len(many), np.int64)
    place[order] = np.arange(len(many))
    code = np.sort(np.repeat(np.arange(len(n)), n) << 32 | place[code]) & 0xFFFFFFFF
    step = np.diff(code, prepend=0)
    first = np.cumsum(n) - n
    step[first] = code[first]
    rows = pa.table({"side": cell["side"], "id": cell["id"], "t": cell["t"], "label": cell["label"].combine_chunks().dictionary_encode(), "n": pa.array(n, pa.int32())})
    with pa.ipc.new_stream(to := pa.BufferOutputStream(), rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    codes = np.ascontiguousarray(step.astype("<u4").view(np.uint8).reshape(-1, 4).T)  # high bytes are mostly 0
    return to.getvalue().to_pybytes(), words[order].tobytes(), pa.compress(codes, "zstd", asbytes=True)


def _unpacked(cell: pa.Table) -> pa.Table:
    """The rows (side, id, t, label, set) of a cell, of all its packs."""
    got = []
    for pack in cell.select(["rows", "words", "codes"]).to_pylist():
        rows = pa.ipc.open_stream(pack["rows"]).read_all()
        n = rows["n"].to_numpy().astype(np.int64)
        ends = np.cumsum(n)
        codes = np.frombuffer(pa.decompress(pack["codes"], 4 * int(ends[-1]), "zstd"), np.uint8)
        step = np.ascontiguousarray(codes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        code, first = np.cumsum(step), ends - n
        code -= np.repeat(code[first] - step[first], n)
        sets = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(np.frombuffer(pack["words"], np.int64)[code]))
        got.append(pa.table({"side": rows["side"], "id": rows["id"], "t": rows["t"], "label": rows["label"].cast(pa.string()), "set": sets}))
    return pa.concat_tables(got)


def _timed(cell: pa.Table) -> pa.Table:
    """In order of time: a row asks those before it."""
    return cell.take(pc.sort_indices(cell, [("t", "ascending"), ("id", "ascending")])).combine_chunks()


def _similar(threshold: float, width: int):
    """Of a cell's rows (id, t, set, side: 1 is asked, 2 asks, 3 both) the similar pairs."""

    def run(cell: pa.Table) -> pa.Table:
        cell = _timed(_unpacked(cell))
        ids = cell["id"]
        found = list(_pairs(cell, threshold, width))
        x, y, like = (np.concatenate([f[i] for f in found]) if found else np.empty(0, k) for i, k in enumerate((np.int64, np.int64, float)))
        u, v = ids.take(pa.array(x)), ids.take(pa.array(y))
        up = pc.less(u, v)
        got = pa.table({"a": pc.if_else(up, u, v), "b": pc.if_else(up, v, u), "similarity": like})
        return got.filter(pc.not_equal(u, v))  # an id that is repeated is no pair

    return run


def _counted(threshold: float, width: int):
    """Of a cell's rows, with ``label``, the number of similar rows and their labels; rows without such rows are left out."""

    def run(cell: pa.Table) -> pa.Table:
        cell = _timed(_unpacked(cell))
        ids, rows = cell["id"].combine_chunks(), cell.num_rows
        _, id_of = np.unique(pc.rank(ids, tiebreaker="dense").to_numpy(), return_inverse=True) if rows else (None, np.empty(0, np.int64))
        coded = cell["label"].combine_chunks().dictionary_encode()
        code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        n, seen = np.zeros(rows, np.int64), [np.empty(0, np.int64)]
        for x, y, _ in _pairs(cell, threshold, width):
            two = id_of[x] != id_of[y]  # an id that is repeated is no pair
            x, y = np.r_[x[two], y[two]], np.r_[y[two], x[two]]
            n += np.bincount(x, minlength=rows)
            seen.append(np.unique((x << 32 | code[y])[code[y] >= 0]))
            if len(seen) > 16:
                seen = [np.unique(np.concatenate(seen))]
        seen = np.unique(np.concatenate(seen))
        at = np.flatnonzero(n)
        ends = np.searchsorted(seen, np.r_[at << 32, rows << 32]).astype(np.int32)
        labels = pa.ListArray.from_arrays(pa.array(ends), coded.dictionary.take(pa.array(seen & 0xFFFFFFFF)))
        # rows of the same labels next to each other: they compress well
        mark = np.r_[0, np.cumsum(np.random.default_rng(0).integers(1 << 62, size=len(coded.dictionary))[seen & 0xFFFFFFFF])]
        order = np.argsort(mark[ends[1:]] - mark[ends[:-1]], kind="stable")
        return pa.table({"id": ids.take(pa.array(at)), "n": n[at], "labels": labels}).take(pa.array(order))

    return run


def _pairs(cell: pa.Table, threshold: float, width: int):
    """(x, y, similarity) in arrays: rows y before x, by at most ``width``, that are similar; rows are in order of time."""
    sets, t, side = cell["set"], cell["t"].to_numpy(), cell["side"].to_numpy()
    if not ((side & 1).any() and (side & 2).any()):
        return
    n = pc.list_value_length(sets).to_numpy().astype(np.int64)
    starts = np.r_[0, np.cumsum(n)]
    _, code, many = np.unique(pc.list_flatten(sets).to_numpy(), return_inverse=True, return_counts=True)
    place = np.empty(len(many), np.int64)
    place[np.argsort(many, kind="stable")] = np.arange(len(many))
    row = np.repeat(np.arange(len(n)), n)
    key = np.sort(row << 32 | place[code])
    code = key & 0xFFFFFFFF  # of each row, rare ones first
    bits = [np.bitwise_xor.reduceat(np.uint64(1) << (code.astype(np.uint64) * np.uint64(m) >> np.uint64(58)), starts[:-1]) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    at = np.arange(len(code)) - starts[row]
    near = at <= (n - np.ceil(n * threshold - 1e-9).astype(np.int64))[row]
    row, code_, left = row[near], code[near], (n[row] - at)[near]

    asked = np.flatnonzero(side[row] & 1)
    asked = asked[np.argsort(code_[asked] << 32 | row[asked])]
    post = code_[asked] << 32 | row[asked]
    p_row, p_left, p_bits = row[asked], left[asked], [b[row[asked]] for b in bits]
    # differing tokens that two rows may have, by their sizes: a share of the sum
    room = (n * ((1 - threshold) / (1 + threshold)) + 1e-4).astype(np.float32)
    p_room = room[p_row]

    ask = np.flatnonzero(side[row] & 2)
    a_row, a_code, a_left = row[ask], code_[ask], left[ask]
    lo = np.searchsorted(post, a_code << 32 | np.searchsorted(t, t - width)[a_row])
    many = np.searchsorted(post, a_code << 32 | a_row) - lo
    ask = np.flatnonzero(many > 0)
    a_row, a_code, a_left, lo, many = (v[ask] for v in (a_row, a_code, a_left, lo, many))
    ends = np.cumsum(many)
    i = 0
    while i < len(ends):
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + MEETINGS, "right")))
        m = many[i:j]
        at = np.repeat(lo[i:j] - (ends[i:j] - m - done), m) + np.arange(m.sum())
        own = a_row[i:j]
        ok = np.flatnonzero(np.bitwise_count(np.repeat(bits[0][own], m) ^ p_bits[0][at]) <= np.repeat(room[own], m) + p_room[at])
        at, e = at[ok], i + np.repeat(np.arange(j - i, dtype=np.int32), m)[ok]
        x, y = a_row[e], p_row[at]
        both = threshold / (1 + threshold) * (n[x] + n[y]) - 1e-6
        # what follows the first shared token is all that they can share besides
        ok = (np.minimum(a_left[e], p_left[at]) >= both) & (np.bitwise_count(bits[1][x] ^ p_bits[1][at]) <= room[x] + room[y])
        yield from _checked(x[ok], y[ok], a_code[e[ok]], n, starts, code, threshold)
        i = j


def _checked(x: np.ndarray, y: np.ndarray, met: np.ndarray, n: np.ndarray, starts: np.ndarray, code: np.ndarray, threshold: float):
    """Of the rows x and y that met under a token those that are similar and have it as their first in common: each pair once."""
    ends = np.cumsum(n[x] + n[y])
    i = 0
    while i < len(x):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHECKED, "right")))
        pair, of = np.r_[i:j, i:j], np.r_[x[i:j], y[i:j]]
        size = n[of]
        at = np.repeat(starts[of] - np.cumsum(size) + size, size) + np.arange(size.sum())
        key = np.sort(np.repeat(pair - i, size) << 32 | code[at])
        same = key[1:][key[1:] == key[:-1]]
        which = same >> 32
        both = np.bincount(which, minlength=j - i)
        first = np.full(j - i, -1)
        first[which[::-1]] = same[::-1] & 0xFFFFFFFF
        like = both / (n[x[i:j]] + n[y[i:j]] - both)
        ok = (like >= threshold) & (first == met[i:j])
        yield x[i:j][ok], y[i:j][ok], like[ok]
        i = j


def corroboration(n: Column) -> Column:
    """Score of n independent reports that agree."""
    return F.when(n >= 1, F.least(F.lit(0.92), F.lit(0.78) + 0.04 * (n - 1))).otherwise(F.lit(0.45))


def both_ways(pairs: DataFrame) -> DataFrame:
    """(id, peer): each pair (a, b) from both sides, of one reading."""
    return pairs.select(F.inline(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("peer")), F.struct(F.col("b").alias("id"), F.col("a").alias("peer")))))


def peers(pairs: DataFrame, df: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """(id, n_peers, n_sources): similar rows of each row, and distinct other sources among them."""
    both = both_ways(pairs)
    src = df.select(F.col(id_col).alias("peer"), F.col(source_col).alias("peer_source"))
    own = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    got = both.join(src, "peer").join(own, "id").groupBy("id").agg(F.count("*").alias("n_peers"), F.countDistinct(F.when(~F.col("peer_source").eqNullSafe(F.col("source")), F.col("peer_source"))).alias("n_sources"))
    return own.select("id").join(got, "id", "left").select("id", F.coalesce("n_peers", F.lit(0)).alias("n_peers"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def peer_counts(df: DataFrame, id_col: str, tokens: Column, time_col: str, source_col: str, threshold: float = 0.42, hours: float = 96.0) -> DataFrame:
    """What ``peers`` finds of the pairs of ``similar_in_band``, counted in their cells: no pair is a row of the plan. Ids are unique."""
    found = peer_labels(df, id_col, tokens, time_col, F.col(source_col).cast("string"), threshold, hours)
    got = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source")).join(found, "id", "left")
    others = F.size(F.filter("labels", lambda x: ~x.eqNullSafe(F.col("source"))))
    return got.select("id", F.coalesce("n_peers", F.lit(0)).alias("n_peers"), F.when(F.col("labels").isNotNull(), others).otherwise(0).cast("long").alias("n_sources"))
