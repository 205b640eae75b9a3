"""MinHash near-dedup: documents posted under each signature coordinate and value, collisions counted behind a rarest-first prefix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, hash64, map_batches, mix64, session_of, written
from .components import components
from .near_vectors import Forest

#: Coordinates of a signature; the chance at the threshold itself that too few of them agree; documents of a block.
COORDINATES, MISS, BLOCK = 64, 1e-5, 512
_RNG = np.random.default_rng(11)
_SCALE = _RNG.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def matches_needed(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most agreeing coordinates to ask for so that a pair at the threshold has fewer with a chance of at most ``miss``."""
    t, below = percent / 100, 0.0
    for m in range(coordinates):
        below += math.comb(coordinates, m) * t**m * (1 - t) ** (coordinates - m)
        if below > miss:
            return max(1, m)
    return coordinates


class WordHashes(dict):
    """Hashes of words, kept up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = hash64(word)
        return h


def shingle_set(text: str | None, words: int, known: WordHashes) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles: of all words together if there are fewer, none without words."""
    found = (text or "").encode().lower().split()  # of bytes: lower-cases A-Z, splits at ASCII white space
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.array([known[w] for w in found], dtype=np.uint64)
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mix64(out ^ h[i : len(h) - size + 1 + i], i)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash over the set."""
    least = np.full(COORDINATES, 2**32 - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[i : i + 4096, None] * _SCALE
        part += _SHIFT
        least = np.minimum(least, (part >> np.uint64(32)).min(0))
    return least.astype(np.uint32)


def _signed(docs: DataFrame, words: int, keep: tuple[str, ...]) -> DataFrame:
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in column(batch, "text"):
                s = shingle_set(text.as_py(), words, known)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(signature(s).view(np.int32) if len(s) else np.empty(0, dtype=np.int32))
            ends = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            values = pa.array(np.concatenate(tokens)) if tokens else pa.array([], pa.int32())
            cols = [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), values)]
            yield pa.RecordBatch.from_arrays([*cols, *[column(batch, c) for c in keep]], names=["doc_id", "n_shingles", "set_key", "signature", *keep])

    return map_batches(docs, run, "doc_id long, n_shingles long, set_key binary, signature array<int>" + "".join(f", {c} long" for c in keep))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _collisions(rows: list[tuple], cross: bool, needed: int) -> Forest:
    """A spanning forest of the pairs with enough agreeing coordinates. rows: (rep, component, side, low bytes of the signature)."""
    forest = _joined(rows)
    sigs = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8).reshape(len(rows), COORDINATES)
    side = np.array([r[2] for r in rows])
    for i in range(len(rows) - 1):
        near = (sigs[i + 1 :] == sigs[i]).sum(1) >= needed
        if cross:
            near &= side[i + 1 :] != side[i]
        for j in np.nonzero(near)[0].tolist():
            forest.link(i, i + 1 + j)
    return forest


def _joined(rows: list[tuple]) -> Forest:
    """Rows of one component hang together from the start."""
    forest, first = Forest(len(rows)), {}
    for i, r in enumerate(rows):
        forest.link(first.setdefault(r[1], i), i)
    forest.links.clear()
    return forest


def _links(rows: list[tuple], cross: bool, needed: int, percent: int) -> Forest:
    """Links that join what is not yet joined. rows: (rep, component, side, shingle set); cross: only pairs of two sides."""
    forest, sets = _joined(rows), [r[3] for r in rows]
    sizes, side = np.array([len(s) for s in sets]), np.array([r[2] for r in rows])
    sigs = np.stack([signature(s) for s in sets])
    pairs: list[tuple[int, int, int]] = []
    for i in range(len(rows) - 1):
        same = (sigs[i + 1 :] == sigs[i]).sum(1)
        lo, hi = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
        keep = (same >= needed) & (100 * lo >= percent * hi)
        if cross:
            keep &= side[i + 1 :] != side[i]
        for j in np.nonzero(keep)[0].tolist():
            if forest.root(i) != forest.root(i + 1 + j):
                if same[j] >= needed + (COORDINATES - needed) * 3 // 4:
                    if _similar(sets[i], sets[i + 1 + j], percent):
                        forest.link(i, i + 1 + j)
                else:
                    pairs.append((int(same[j]), i, i + 1 + j))
    # the likeliest first: most of the rest is joined by then
    for _, i, j in sorted(pairs, reverse=True):
        if forest.root(i) != forest.root(j) and _similar(sets[i], sets[j], percent):
            forest.link(i, j)
    return forest


def _met(rows: DataFrame, payload: list[str], load, link, cross: bool) -> DataFrame:
    """rows: g, i, j, rep, component, side, large and the payload; those of one (g, i, j) meet in one task, by rep.

    Returns the links (a, b), and for rows of large groups what they hang on here (g, rep, root).
    """
    names = ["a", "b", "g", "rep", "root"]

    def done(key: tuple, group: list[tuple], large: bool) -> list[tuple]:
        if len(group) > 1:
            forest = link(group, cross)
            found = [(group[x][0], group[y][0], None, None, None) for x, y in forest.links]
            return found + [(None, None, key[0], r[0], group[forest.root(i)][0]) for i, r in enumerate(group) if large]
        return [(None, None, key[0], r[0], r[0]) for r in group if large]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, of_large, found, known = None, [], False, [], WordHashes()
        batch_of = lambda found: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)
        for batch in batches:
            cols = [column(batch, c).to_pylist() for c in ("g", "i", "j", "rep", "component", "side", "large")]
            values = zip(*(column(batch, c).to_pylist() for c in payload), strict=True)
            for g, i, j, rep, component, side, large, value in zip(*cols, values, strict=True):
                if key != (g, i, j):
                    found += done(key, group, of_large)
                    key, group, of_large = (g, i, j), [], large
                value = load(value, known)
                if value is not None:
                    group.append((rep, component, side, value))
            if found:
                yield batch_of(found)
                found = []
        if found := done(key, group, of_large):
            yield batch_of(found)

    dealt = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "rep")
    return map_batches(dealt.select("g", "i", "j", "rep", "component", "side", "large", *payload), run, ", ".join(f"{n} long" for n in names))


def _linked(rows: DataFrame, payload: list[str], load, link, block: int) -> DataFrame:
    """rows: g (a group), rep and the payload, written -> links (a, b) that join all members of a group that link() joins.

    A group of over ``block`` rows is dealt into hash blocks. Blocks link inside; then representatives of what hangs
    together meet, again in blocks; only groups still apart send all their rows to pairs of blocks, and there only
    pairs of two components count. One that hangs together by then costs what its rows do, however large.
    """
    sizes = rows.groupBy("g").agg(F.count("*").alias("n")).where(f"n > {block}").select("g", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sizes = written(sizes)
    dealt = rows.join(sizes, "g", "left").withColumn("large", F.col("blocks").isNotNull()).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    one = dealt.select("*", F.col("block").alias("i"), F.col("block").alias("j"), F.col("rep").alias("component"), F.col("block").alias("side"))
    first = written(_met(one, payload, load, link, False))
    links = first.where("a is not null").select("a", "b")
    if sizes.isEmpty():
        links = written(links)
        discard(sizes, first)
        return links
    large = dealt.where("large")
    of = first.where("g is not null").select("g", "rep", "root")
    heads = of.where("rep = root").select("g", "rep")
    some = heads.groupBy("g").agg(F.ceil(F.count("*") / block).cast("int").alias("some"))
    again = large.join(heads, ["g", "rep"], "left_semi").join(some, "g").withColumn("component", F.col("rep"))
    again = again.withColumn("i", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("some")).cast("int")).withColumn("j", F.col("i")).withColumn("side", F.col("i"))
    second = written(_met(again, payload, load, link, False))
    links = links.union(second.where("a is not null").select("a", "b"))
    over = second.where("g is not null").select("g", F.col("rep").alias("root"), F.col("root").alias("component"))
    state = of.join(over, ["g", "root"]).select("g", "rep", "component")
    apart = over.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("g")
    state = large.join(apart, "g", "left_semi").join(state, ["g", "rep"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    again = state.select("*", other).where("other <> block").withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).withColumn("side", F.col("block"))
    third = written(_met(again.withColumn("large", F.lit(False)), payload, load, link, True))
    links = written(links.union(third.select("a", "b")))
    discard(sizes, first, second, third)
    return links


def _low_bytes(signature: str) -> Column:
    """A byte a coordinate: equal values have equal bytes, so no collision is missed."""
    return F.unhex(F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(256))), 2, "0")), ""))


def near_rows(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Documents whose sets link at Jaccard * 100 >= percent: (rows, groups), both written.

    rows: doc_id, n_shingles, set_key and the long columns ``keep`` of each row; set_key is null where the set is empty
    or the id null. groups: set_key, component (a number) and least, the smallest id of the component. Rows count by
    their sets, so that an id that repeats with another text is another document.

    1. Equal sets become one representative, with a number. 2. It is posted under each coordinate and value of its
    signature. A pair with enough agreeing coordinates shares one of the rarest (coordinates - needed + 1) of either;
    only postings in that prefix are merged, the longer lists are skipped. The members of a list count their
    collisions, by a byte a coordinate, and a spanning forest of the pairs with enough leaves it: never more rows than
    members. 3. The documents so connected are a cluster, whose texts meet; pairs with enough collisions of whole
    signatures are confirmed on whole shingle sets, the likeliest first, skipping what is joined already. ``_linked``
    says how long lists and large clusters are split. Tables are deleted as soon as what follows from them is written.
    """
    session_of(docs)
    needed = matches_needed(percent)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    signed = written(_signed(base, words, keep))
    usable = signed.where("doc_id is not null and set_key is not null")
    reps = usable.groupBy("set_key").agg(F.min("doc_id").alias("who"), F.any_value("signature").alias("signature"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()))
    rows = written(signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"), *keep))
    discard(signed)
    postings = reps.select("rep", F.posexplode("signature")).select("rep", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("col")).alias("token"))
    frequent = postings.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    mine = postings.join(frequent, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared"))
    # tokens that nobody shares are the rarest: they fill the prefix first
    few = mine.where(F.size("shared") >= needed).join(reps.select("rep", _low_bytes("signature").alias("low")), "rep")
    prefix = few.select("rep", "low", F.explode(F.slice("shared", 1, F.size("shared") - needed + 1)).alias("p"))
    prefix = written(prefix.select(F.col("p.token").alias("g"), "rep", "low"))
    sets = written(reps.select("set_key", "rep", "who"))
    discard(reps)
    candidates = _linked(prefix, ["low"], lambda v, _: v[0], lambda rows, cross: _collisions(rows, cross, needed), block)
    discard(prefix)
    clusters = components(candidates).select(F.col("node").alias("rep"), F.col("component").alias("g")).join(sets, "rep")
    texts = written(base.select("doc_id", "text").join(clusters, F.col("doc_id") == F.col("who")).select("g", "rep", "set_key", "text"))

    def load(value: tuple, known: WordHashes) -> np.ndarray | None:
        import xxhash

        shingles = shingle_set(value[1], words, known)
        return shingles if xxhash.xxh3_128_digest(shingles.tobytes()) == value[0] else None  # another text with the same id

    links = _linked(texts, ["set_key", "text"], load, lambda rows, cross: _links(rows, cross, needed, percent), block)
    discard(texts, candidates)
    joined = components(links)
    linked = joined.join(sets, F.col("node") == F.col("rep")).select("component", "rep", "set_key", "who")
    least = linked.groupBy("component").agg(F.min("who").alias("least")).hint("rebalance")
    linked = linked.join(least, "component").select("set_key", "component", "least")
    alone = sets.join(joined, F.col("node") == F.col("rep"), "left_anti").select("set_key", F.col("rep").alias("component"), F.col("who").alias("least"))
    groups = written(linked.union(alone))
    discard(sets, links)
    return rows, groups


def near_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. Documents link at Jaccard * 100 >= percent.

    Null, empty and blank texts have the empty set and link with nothing; with fewer words than a shingle the whole
    sequence is one. A null id links with nothing, its component is null and it is kept. Rows that repeat an id are
    judged by their texts, each for itself. Only id and text are read; an empty table gives no rows. ``near_rows`` has
    the method.
    """
    rows, groups = near_rows(docs, words, percent, id_col, text_col, block)
    out = rows.join(groups.select(F.col("set_key").alias("key"), "least"), F.col("set_key") == F.col("key"), "left")
    component = F.coalesce("least", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def oracle_sql(percent: int = 80) -> str:
    """Brute force over two-word shingles."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN list_transform(w, lambda x: [x]) ELSE list_transform(range(1, len(w)), lambda i: w[i:i + 1]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT s.doc_id, s.g, n.n FROM s JOIN n USING (doc_id)),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y FROM k a JOIN k b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
c AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(doc_id = coalesce(c, doc_id), true) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON doc_id = c.x
"""
