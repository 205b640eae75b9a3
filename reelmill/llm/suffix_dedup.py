"""Suffix-array dedup: bytes covered by a string of fixed length that starts more than once in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, map_batches, mix64, session_of, written

#: Bytes of a repeated string, of a gram that stands for it, and of a piece of text that is worked on at once.
LENGTH, GRAM, PIECE = 400, 200, 1 << 20
#: Bytes of excerpts that one suffix array holds; excerpts, and their bytes, that a hash may bring to one task.
BATCH, CROWD, CROWD_BYTES = 1 << 20, 400, 1 << 22
#: Suffixes whose bytes are held for sorting at a time.
SORTED = 1 << 15
#: Fixed odd multiplier of the rolling hash.
BASE = 0x9E3779B97F4A7C15
SPANS = "array<struct<a:int,b:int>>"


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64."""

    def __init__(self, n: int):
        with np.errstate(over="ignore"):
            up = np.full(n + 1, np.uint64(BASE))
            down = np.full(n + 1, np.uint64(pow(BASE, -1, 2**64)))
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, k: int, powers: _Powers) -> np.ndarray:
    """A mixed hash of each k bytes."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:n], out=sums[1:])
    return mix64((sums[k:] - sums[:-k]) * powers.down[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours: prefix and suffix minima of blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def runs_of(data: np.ndarray, length: int, gram: int, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring window starts with the same least gram: (hash, first start, last start, gram occurs again).

    Equal windows have equal grams and so the same least hash: they are in runs of one hash.
    """
    h = gram_hashes(data, gram, powers)
    v = sliding_min(h, length - gram + 1)
    first = np.concatenate([[0], np.nonzero(v[1:] != v[:-1])[0] + 1])
    last = np.concatenate([first[1:], [len(v)]]) - 1
    value = v[first]
    # positions of grams that may be some run's: a bit a hash, then the hash itself
    bits = np.zeros(1 << 16, dtype=bool)
    bits[value & np.uint64(0xFFFF)] = True
    at = h[bits[h & np.uint64(0xFFFF)]]
    distinct, n = np.unique(at, return_counts=True)
    again = n[np.searchsorted(distinct, value)] > 1
    return value, first, last, again


def _smaller(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix: whether it is smaller than its successor, and how often its first byte repeats from there on.

    A run of equal bytes is decided by what follows it; the last suffix is larger than the empty one.
    """
    n = len(data)
    ends = np.append(np.nonzero(data[1:] != data[:-1])[0], n - 1)
    rises = np.append(data[ends[:-1]] < data[ends[:-1] + 1], False)
    lengths = np.diff(ends, prepend=-1)
    return np.repeat(rises, lengths), (np.repeat(ends, lengths) - np.arange(n) + 1).astype(np.int32)


def _sorted_directly(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Starts in the order of their suffixes' first ``length`` bytes: eight bytes at once, then ties by all of them.

    The bytes of at most about SORTED suffixes, or of one tie, are held at a time.
    """
    words = np.ndarray(len(text), dtype=">u8", buffer=text + bytes(8), strides=(1,))
    key = words[starts].astype(np.uint64)
    by = np.argsort(key, kind="stable")
    starts, key = starts[by], key[by]
    same = key[1:] == key[:-1]
    tied = np.append(same, False) | np.append(False, same)
    if not tied.any():
        return starts
    some, key = starts[tied], key[tied]
    cuts = np.append(np.nonzero(key[1:] != key[:-1])[0] + 1, len(some))
    out, at = [], 0
    while at < len(some):
        to = int(cuts[np.searchsorted(cuts, min(at + SORTED, len(some)))])
        out += sorted(some[at:to].tolist(), key=lambda i: text[i : i + length])
        at = to
    starts[tied] = out
    return starts


def two_stage(text: bytes, length: int = LENGTH) -> np.ndarray:
    """The suffix array: suffixes smaller than their successors are sorted, the others induced by a scan over the buckets.

    Comparison stops after ``length`` bytes, so suffixes that share as many are in any order. A bucket is scanned in
    strides: what a stride puts into the same bucket is the next one, so that a run of equal bytes takes as many.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    smaller, run = _smaller(data)
    direct = _sorted_directly(text, np.nonzero(smaller)[0], length)
    order = np.empty(n, dtype=np.int64)
    counts, sorted_counts = np.bincount(data, minlength=256), np.bincount(data[direct], minlength=256)
    ends = np.cumsum(counts)
    middle = ends - sorted_counts  # in each bucket, the induced suffixes come before the sorted ones
    order[np.arange(len(direct)) + (middle - np.cumsum(sorted_counts) + sorted_counts)[data[direct]]] = direct
    head = ends - counts

    def put(found: np.ndarray) -> None:
        first = data[found]
        by = np.argsort(first, kind="stable")
        k = np.bincount(first, minlength=256)
        order[np.arange(len(found)) + (head - np.cumsum(k) + k)[first[by]]] = found[by]
        np.add(head, k, out=head)

    def before(scanned: np.ndarray) -> np.ndarray:
        found = scanned[scanned > 0] - 1
        return found[~smaller[found]]

    put(np.array([n - 1]))
    for c in np.nonzero(counts)[0].tolist():
        done, strides = int(ends[c] - counts[c]), 0
        while done < head[c]:
            if strides == length and head[c] < middle[c]:
                # what is left of the bucket starts with more than ``length`` equal bytes
                left = np.nonzero((data == c) & ~smaller & (run > strides + 1))[0]
                order[head[c] : middle[c]] = left
                head[c] = middle[c]
                found = before(order[done : head[c]])
                put(found[data[found] != c])
                break
            upto = int(head[c])
            put(before(order[done:upto]))
            done, strides = upto, strides + 1
        put(before(order[middle[c] : ends[c]]))
    return order


def common_prefixes(text: bytes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes the suffixes at a and at b share, counted up to ``most``.

    Those that share the first eight bytes are compared whole, a few thousand at a time; of the rest, eight bytes at a
    time until they differ.
    """
    padded = text + bytes(most + 8)
    words = np.ndarray(len(text) + most, dtype="<u8", buffer=padded, strides=(1,))
    whole = np.ndarray(len(text), dtype=f"V{most}", buffer=padded, strides=(1,))
    shared, equal = np.zeros(len(a), dtype=np.int64), words[a] == words[b]
    alike = np.nonzero(equal)[0]
    for k in range(0, len(alike), 1 << 13):
        some = alike[k : k + (1 << 13)]
        equal[some] = whole[a[some]] == whole[b[some]]
    shared[equal] = most
    live = np.nonzero(~equal)[0]
    for at in range(0, most, 8):
        unlike = words[a[live] + at] ^ words[b[live] + at]
        ended = unlike != 0
        low = unlike[ended]
        low &= ~low + np.uint64(1)
        shared[live[ended]] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live = live[~ended]
        if not len(live):
            break
    return np.minimum(shared, most)


def repeated_spans(excerpts: list[tuple[bytes, bool]], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(excerpt, seen more than once) -> (place in the list, start, end) of the parts that repeated windows cover.

    The excerpts follow each other with a byte between them; in the suffix array, windows that share ``length`` bytes
    are neighbours, and only whole windows of an excerpt count.
    """
    text = b"\0".join(e for e, _ in excerpts)
    sizes = np.array([len(e) for e, _ in excerpts])
    base = np.cumsum(sizes + 1) - sizes - 1
    edge = np.zeros(len(text) + 2, dtype=np.int32)
    edge[base] += 1
    edge[base + sizes - length + 1] -= 1
    window = np.cumsum(edge[: len(text)]) > 0
    hit = np.zeros(len(text), dtype=bool)
    for (_, more), at, size in zip(excerpts, base.tolist(), sizes.tolist(), strict=True):
        if more:
            hit[at : at + size - length + 1] = True
    if not hit[window].all():
        order = two_stage(text, length)
        order = order[window[order]]
        same = common_prefixes(text, order[:-1], order[1:], length) >= length
        hit[order[:-1][same]] = True
        hit[order[1:][same]] = True
    starts = np.nonzero(hit)[0]
    edge[:] = 0
    edge[starts] += 1
    np.subtract.at(edge, starts + length, 1)
    inside = np.cumsum(edge) > 0
    turns = np.diff(inside.astype(np.int8), prepend=0)
    a, b = np.nonzero(turns > 0)[0], np.nonzero(turns < 0)[0]
    owner = np.searchsorted(base, a, side="right") - 1
    return owner, a - base[owner], b - base[owner]


def _runs(texts: DataFrame, length: int, gram: int, piece: int) -> DataFrame:
    """(tkey, text) -> a row for each run: tkey, v, s0, s1, again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(piece + length)
        for batch in batches:
            keys, parts, held = column(batch, "tkey"), [], 0
            for row, text in enumerate(column(batch, "text")):
                data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)
                for at in range(0, len(data) - length + 1, piece):
                    v, first, last, again = runs_of(data[at : at + piece + length - 1], length, gram, powers)
                    parts.append((np.full(len(v), row), v.view(np.int64), (first + at).astype(np.int32), (last + at).astype(np.int32), again))
                    held += len(v)
                if held > 50_000:
                    yield _run_batch(keys, parts)
                    parts, held = [], 0
            if parts:
                yield _run_batch(keys, parts)

    return map_batches(texts.select("tkey", "text"), run, "tkey binary, v long, s0 int, s1 int, again boolean")


def _run_batch(keys: pa.Array, parts: list[tuple]) -> pa.RecordBatch:
    rows, *cols = (np.concatenate(c) for c in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), *map(pa.array, cols)], names=["tkey", "v", "s0", "s1", "again"])


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """(tkey, text) -> a row for each run of equal neighbouring windows: tkey, w (a 128-bit digest of them), s0, s1."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tkey, text in zip(column(batch, "tkey").to_pylist(), column(batch, "text"), strict=True):
                data, first, before = text.as_buffer().to_pybytes(), 0, b""
                for s in range(len(data) - length + 1):
                    w = xxhash.xxh3_128_digest(data[s : s + length])
                    if w != before and s:
                        out.append((tkey, before, first, s - 1))
                        first = s
                    before = w
                    if len(out) > 20_000:
                        yield _window_batch(out)
                        out = []
                out.append((tkey, before, first, len(data) - length))
            if out:
                yield _window_batch(out)

    return map_batches(texts.select("tkey", "text"), run, "tkey binary, w binary, s0 int, s1 int")


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["tkey", "w", "s0", "s1"])


def _excerpts(texts: DataFrame, length: int) -> DataFrame:
    """(tkey, text, runs) -> a row for each run: tkey, v, s0, ekey, excerpt."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for tkey, text, runs in zip(column(batch, "tkey").to_pylist(), column(batch, "text"), column(batch, "runs"), strict=True):
                data = text.as_buffer().to_pybytes()
                for r in runs.as_py():
                    e = data[r["s0"] : r["s1"] + length]
                    out.append((tkey, r["v"], r["s0"], xxhash.xxh3_128_digest(e), e))
                    held += len(e)
                    if held > 1 << 22:
                        yield _excerpt_batch(out)
                        out, held = [], 0
            if out:
                yield _excerpt_batch(out)

    return map_batches(texts, run, "tkey binary, v long, s0 int, ekey binary, excerpt binary")


def _excerpt_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(cols, names=["tkey", "v", "s0", "ekey", "excerpt"])


def _repeats(excerpts: DataFrame, length: int) -> DataFrame:
    """(v, ekey, excerpt, many) -> (v, ekey, spans): the parts of each excerpt that repeated windows cover.

    The excerpts of a hash meet in one task, at most CROWD of them; windows of different hashes differ, so the groups
    of several hashes share a suffix array of about BATCH bytes.
    """

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        owner, a, b = repeated_spans([(e, many) for _, _, e, many in rows], length)
        each = np.bincount(owner, minlength=len(rows))
        some = np.nonzero(each)[0].tolist()
        return batch_of([rows[i] for i in some], each[some], a, b)

    def batch_of(rows: list[tuple], each: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["a", "b"])
        ends = pa.array(np.append(0, np.cumsum(each)).astype(np.int32))
        cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.ListArray.from_arrays(ends, pairs)]
        return pa.RecordBatch.from_arrays(cols, names=["v", "ekey", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole, group, size, key = [], [], [], 0, None

        def close() -> None:
            nonlocal size
            if all(r[3] for r in group):  # each excerpt of the hash occurs more than once: no need to look inside
                whole.extend(group)
            else:
                held.extend(group)
                size += sum(len(r[2]) for r in group)
            group.clear()

        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("v", "ekey", "excerpt", "many")), strict=True):
                if row[0] != key:
                    close()
                    key = row[0]
                    if size > BATCH:
                        yield spans(held)
                        held, size = [], 0
                group.append(row)
            if whole:
                yield batch_of(whole, np.ones(len(whole), dtype=np.int64), np.zeros(len(whole)), np.array([len(r[2]) for r in whole]))
                whole.clear()
        close()
        if whole:
            yield batch_of(whole, np.ones(len(whole), dtype=np.int64), np.zeros(len(whole)), np.array([len(r[2]) for r in whole]))
        if held:
            yield spans(held)

    dealt = excerpts.select("v", "ekey", "excerpt", "many").repartition("v").sortWithinPartitions("v")
    return map_batches(dealt, run, f"v long, ekey binary, spans {SPANS}")


def _all_of(excerpt: str) -> Column:
    return F.array(F.struct(F.lit(0).alias("a"), F.octet_length(excerpt).alias("b"))).cast(SPANS)


def _merged(found: DataFrame) -> DataFrame:
    """(tkey, a, b) -> (tkey, spans), ascending by start."""
    return found.groupBy("tkey").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))


def _joined(spans: str) -> Column:
    """Ascending spans of an excerpt with those that touch made one, so that each of its places has few."""
    last = lambda done: F.element_at(done, -1)
    wider = lambda done, s: F.struct(last(done)["a"].alias("a"), F.greatest(last(done)["b"], s["b"]).alias("b"))

    def add(done: Column, s: Column) -> Column:
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["b"] >= s["a"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider(done, s)))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast(SPANS), add)


def _same_windows(texts: DataFrame, length: int) -> DataFrame:
    """(tkey, text) -> (tkey, spans) by the digest of each window alone: what crowds come to when no gram can split them."""
    windows = written(_windows(texts, length))
    shared = windows.groupBy("w").agg(F.count("*").alias("n"), F.max(F.col("s1") - F.col("s0")).alias("more")).where("n > 1 or more > 0").select("w")
    return _merged(windows.join(shared, "w").select("tkey", F.col("s0").alias("a"), (F.col("s1") + length).alias("b")))


def repeats(texts: DataFrame, length: int, gram: int, piece: int, crowd: int = CROWD, crowd_bytes: int = CROWD_BYTES, first: DataFrame | None = None) -> DataFrame:
    """(tkey, text), both never null, rows of one tkey being equal -> (tkey, spans): what repeated windows cover.

    Copies of a text count as one. ``first`` (tkey, row) names the row of each text that is worked on; then the texts
    have a column row too.

    1. Each text gives runs of windows with the same least gram hash; hashes that only one text has once are dropped
    (a text is worked on in pieces of ``piece`` window starts; a hash in two pieces of it counts as there twice).
    2. The excerpts that hold the remaining runs are counted before they move and kept once. 3. The distinct excerpts
    of a hash meet in one task and get a suffix array. A hash with more than ``crowd`` of them, or more than
    ``crowd_bytes``, sends them back to step 1 with a longer gram, which leaves what surrounds a common passage behind
    and deals the rest to other hashes; once a gram is as long as a window, equal windows are found by their digests.
    """
    if gram >= length:
        return _same_windows(texts, length)
    runs = written(_runs(texts, length, gram, piece))
    # again knows its own piece only; equal rows of a text have equal places
    place = F.xxhash64("tkey", F.expr(f"s0 div {piece}"))
    shared = runs.groupBy("v").agg(F.max(F.col("again").cast("int")).alias("again"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    shared = shared.where("again = 1 or lo < hi").select("v")
    hits = runs.join(shared, "v").groupBy("tkey").agg(F.collect_set(F.struct("v", "s0", "s1")).alias("runs"))
    if first is None:
        cut = texts.select("tkey", "text").join(hits, "tkey")
    else:
        hits = hits.join(first.select("tkey", F.col("row").alias("first")), "tkey")
        cut = texts.join(hits, "tkey").where("row = first").select("tkey", "text", "runs")
    excerpts = written(_excerpts(cut, length))
    discard(runs)
    places = written(excerpts.select("tkey", "v", "s0", "ekey").distinct())
    at = F.xxhash64("tkey", "s0")
    distinct = written(excerpts.groupBy("v", "ekey", "excerpt").agg((F.min(at) < F.max(at)).alias("many")))
    discard(excerpts)
    sizes = distinct.groupBy("v").agg(F.count("*").alias("n"), F.sum(F.octet_length("excerpt")).alias("bytes"))
    crowds = written(sizes.where(f"n > {crowd} or n > 1 and bytes > {crowd_bytes}").select("v"))
    if crowds.isEmpty():
        spans = written(_repeats(distinct, length))
    else:
        spans = _repeats(distinct.join(crowds, "v", "left_anti"), length)
        crowded = distinct.join(crowds, "v", "left_semi")
        again = crowded.select(F.concat(F.unhex(F.lpad(F.hex("v"), 16, "0")), "ekey").alias("tkey"), F.col("excerpt").alias("text"), "v", "ekey", "many")
        again = written(again)
        inner = repeats(again.select("tkey", "text"), length, length - (length - gram) // 4, piece, crowd, crowd_bytes)
        known = again.where("not many").join(inner, "tkey").select("v", "ekey", _joined("spans").cast(SPANS).alias("spans"))
        spans = written(spans.union(crowded.where("many").select("v", "ekey", _all_of("excerpt").alias("spans"))).union(known))
    discard(distinct)
    found = places.join(spans, ["v", "ekey"]).select("tkey", F.explode("spans").alias("s"), "s0")
    return _merged(found.select("tkey", (F.col("s0") + F.col("s.a")).alias("a"), (F.col("s0") + F.col("s.b")).alias("b")))


def _stripped(data: bytes, spans: list[dict], min_words: int = 0) -> tuple[bytes, int]:
    """What ascending spans leave of some bytes, and how many pieces they take out: those with at least ``min_words``."""
    runs: list[list[int]] = []
    for s in spans:
        if runs and s["a"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s["b"])
        else:
            runs.append([s["a"], s["b"]])
    runs = [r for r in runs if not min_words or len(data[r[0] : r[1]].split()) >= min_words]
    ends = [0, *(x for r in runs for x in r), len(data)]
    return b"".join(data[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2)), len(runs)


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, whole_characters: bool = False, piece: int = PIECE, crowd: int = CROWD, min_words: int = 0) -> DataFrame:
    """The documents with all their columns, and _n_bytes, _n_removed, _n_spans, _kept (the remaining bytes).

    Texts are UTF-8 bytes, null ones empty. Each byte covered by a string of ``length`` bytes that also starts anywhere
    else, in any document, is removed; strings are judged on the input. Texts that occur more than once go whole if
    they are that long. Shorter texts stay. An empty table gives no rows. Ids play no part, so they may be null or
    repeat; a column of the input that is named like a result is replaced, any other name may occur. With
    ``whole_characters``, bytes of characters that were cut stay out of _kept. With ``min_words``, only maximal runs of
    such bytes that hold as many words (parts of one count) are removed, whole texts included.

    Distinct texts go through ``repeats``; the spans come back by the text's digest. Nothing of the corpus reaches the
    driver.
    """
    session_of(docs)
    of = lambda column: F.coalesce(column.cast("string"), F.lit(""))
    key = lambda text: F.unhex(F.md5(text.cast("binary")))
    text = of(F.col(f"`{text_col}`"))
    names = [c for c in docs.columns if c not in ("_n_bytes", "_n_removed", "_n_spans", "_kept")]
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name != text_col and "map<" not in f.dataType.simpleString()]
    texts = docs.where(F.octet_length(text) >= length).select(key(text).alias("tkey"), text.alias("text"), (F.xxhash64(*others) if others else F.lit(0).cast("long")).alias("row"))
    copies = written(texts.groupBy("tkey").agg(F.count("*").alias("n"), F.min("row").alias("row")))
    found = repeats(texts, length, gram, piece, crowd, first=copies)
    # of copies one was enough: their number is known
    whole = copies.where("n > 1").select("tkey", F.lit(True).alias("whole"))
    removal = found.join(whole, "tkey", "full").select("tkey", "spans", "whole")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), key(text).alias("tkey"))
    joined = keyed.join(removal, "tkey", "left")
    text = of(F.col("doc").getField(text_col))

    @F.pandas_udf("kept binary, removed long, spans long")
    def strip(text, spans):
        import pandas as pd

        rows = []
        for t, found in zip(text, spans, strict=True):
            data = (t or "").encode()
            kept, taken = _stripped(data, found, min_words)
            rows.append((kept.decode("utf-8", "ignore").encode() if whole_characters else kept, len(data) - len(kept), taken))
        return pd.DataFrame(rows, columns=["kept", "removed", "spans"])

    size = F.octet_length(text).cast("long")
    if min_words:
        joined = joined.select("doc", F.when(F.col("whole"), F.array(F.struct(F.lit(0).alias("a"), size.cast("int").alias("b"))).cast(SPANS)).otherwise(F.col("spans")).alias("spans"), F.lit(None).cast("boolean").alias("whole"))
    cut = F.col("whole").isNull() & F.col("spans").isNotNull()
    out = joined.withColumn("s", F.when(cut, strip(F.when(cut, text), F.coalesce(F.when(cut, F.col("spans")), F.array().cast(SPANS)))))
    return out.select(
        *[F.col("doc").getField(c).alias(c) for c in names],
        size.alias("_n_bytes"),
        F.when(F.col("whole"), size).otherwise(F.coalesce("s.removed", F.lit(0))).cast("long").alias("_n_removed"),
        F.when(F.col("whole"), 1).otherwise(F.coalesce("s.spans", F.lit(0))).cast("long").alias("_n_spans"),
        F.when(F.col("whole"), F.lit("").cast("binary")).otherwise(F.coalesce("s.kept", text.cast("binary"))).alias("_kept"),
    )


def removed_bytes(docs: DataFrame, length: int = LENGTH, piece: int = PIECE, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the sha256 of what stays."""
    out = without_repeats(docs.select("doc_id", "text"), length=length, piece=piece, crowd=crowd)
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
