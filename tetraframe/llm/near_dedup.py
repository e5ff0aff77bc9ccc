"""MinHash near-dedup by a multi-index Hamming join.

Each distinct shingle set is a node and gets a signature of K symbols of b bits: the least of K hash functions over the set. Sets
that are alike to the given degree differ in at most t symbols, but for a chance below MISS, which fixes t. A signature is cut into
t // 2 + 1 chunks, so by the pigeonhole principle two signatures within t agree in some chunk but for one symbol at most; every
chunk is listed once for each place where that error may stand. All pairs within t meet in a list. Links are confirmed on the full
sets with integers and closed to components.

Groups are never expanded into all pairs:

1. In each list the first node is tried with the others, and the components of these links are formed.
2. Lists that still span several components and reach one another through components make a cluster. All pairs within t of different
   components lie in one cluster, so its nodes meet once, as one list, in place of up to 80 times. Only where clusters chain far
   (more nodes than a piece) and their lists are cheaper do the lists meet by themselves.
3. A cluster or list says which of its nodes have a partner within t in another component. In lists a pair is looked at in the first
   that it shares only. Rows out: one a cluster and node, or one a list and node, at most.
4. These nodes bring their full sets together, where intersections are counted, which gives the links of a spanning forest: fewer
   links than nodes. Components are closed once more.

A long list or cluster is cut into pieces that meet pairwise in separate tasks; nodes in its own component (a cluster's largest, or
that of a list's first node) meet the others only, not each other. No pair within t is left out for the size of its list. Where most
of a group is alike to a degree just below the bound, comparisons grow with the square of the group, and rows with its square over
the size of a piece. Dealing such a group out again by a second chunk would take two errors in each, some 150 keys a node, which is
more until a group has more than half a million distinct components.

Defined cases: null or empty text, or text without words, is the empty set and linked with nothing; a text with fewer words than
a shingle is one shingle; rows of one doc_id are nodes of their own where their texts differ; a null doc_id is linked with nothing
and kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import chunks, discard, hand_back, mix, set_apart, slices, stored, table, words

#: Symbols of a signature (16 bits each), and the largest chance to miss a pair at the least similarity.
K, MISS = 80, 1e-7
#: Nodes of a piece of a long list where signatures meet; nodes and bytes where sets meet.
PIECE, SET_PIECE, SET_BYTES = 4_096, 512, 16 << 20
#: In place of the number of a symbol in the low bits of a list's key: a cluster, whose pairs are all looked at there.
CLUSTER = 127
#: Most nodes whose ids are sent to all executors (40 bytes each); more are joined by a shuffle.
SENT_IDS = 500_000
#: Most edges (16 bytes each) that are left for one task after a round over all of them; more take further rounds.
REST = 1 << 18

_rng = np.random.default_rng(20240517)
_ODD = _rng.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(1, 1 << 63, K, dtype=np.uint64)


@functools.lru_cache
def most_different(num: int, den: int, k: int = K, miss: float = MISS) -> int:
    """The least t such that sets alike to num/den differ in more than t of k symbols with a chance below `miss`."""
    p = 1 - num / den
    tail, t = 1.0, -1
    while tail >= miss and t < k:
        t += 1
        tail -= math.comb(k, t) * p**t * (1 - p) ** (k - t)
    return t


def chunk_bounds(t: int, k: int = K) -> list[tuple[int, int]]:
    """t // 2 + 1 chunks, so that t errors leave one error at most in some chunk."""
    c = min(t // 2 + 1, k)
    return [(k * i // c, k * (i + 1) // c) for i in range(c)]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingles of each document as sorted 64-bit hashes."""
    h, n, _ = words(data, offsets)
    begin = np.concatenate([[0], np.cumsum(n)])
    out = []
    if len(h) >= width:
        s = h[: len(h) - width + 1].copy()
        for j in range(1, width):
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j])
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= width:
            x = np.sort(s[a : b - width + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            one = np.uint64(b - a)
            for w in h[a:b]:
                one = mix(np.array([one * np.uint64(0x9E3779B97F4A7C15) + w], np.uint64))[0]
            out.append(np.array([one], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hashes(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers; 0 for the empty set."""
    if not len(x):
        return 0, 0
    return tuple(int(mix(x ^ np.uint64(s)).sum(dtype=np.uint64).astype(np.int64)) for s in (0, 0x5851F42D4C957F2D))


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """K symbols of 16 bits for each set; none may be empty."""
    h = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), K), np.uint32)
    for i in range(K // 2):
        v = (h ^ _XOR[i]) * _ODD[i]
        v ^= v >> np.uint64(32)
        v *= _ODD[-1 - i]
        least[:, 2 * i] = np.minimum.reduceat((v >> np.uint64(32)).astype(np.uint32), at)
        least[:, 2 * i + 1] = np.minimum.reduceat((v ^ (v >> np.uint64(29))).astype(np.uint32), at)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


_MARKS = ("n_shingles", "h1", "h2", "t1", "t2")


def signed(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, t1, t2, sig): set size, 128-bit hashes of the set and of the text, signature (null for the empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                n, both, sig = [], [], []
                for _, _, data, offsets in chunks(batch.column("text").to_pylist(), 1 << 19):
                    sets = shingle_hashes(data, offsets, width)
                    full = [x for x in sets if len(x)]
                    rows = iter(signature(full)) if full else iter(())
                    for x in sets:
                        n.append(len(x))
                        both.append(set_hashes(x))
                        sig.append(next(rows).tobytes() if len(x) else None)
                h1, h2 = zip(*both) if both else ((), ())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, h1, h2)), batch.column("t1"), batch.column("t2"), pa.array(sig, pa.binary())], ["doc_id", *_MARKS, "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *text_hashes()).mapInArrow(sign, f"doc_id {kind}, {', '.join(f'{c} long' for c in _MARKS)}, sig binary")


def text_hashes() -> list:
    """128 bits of the text column, which tell rows of one doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2")]


def _symbols(raw) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint16).reshape(-1, K)


def list_keys(s: np.ndarray, t: int) -> np.ndarray:
    """The keys of each signature, by the symbol left out: a hash of its chunk's other symbols, whose low 7 bits are that symbol's number."""
    out = []
    for a, b in chunk_bounds(t):
        for gap in range(a, b):
            key = np.full(len(s), np.uint64(gap + 1), np.uint64)
            for j in range(a, b):
                if j != gap:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, j])
            out.append((key & ~np.uint64(127)) | np.uint64(gap))
    return np.stack(out, 1).astype(np.int64)


def keyed(nodes: DataFrame, t: int) -> DataFrame:
    """(key, id) for every node and list."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in slices(batches, 2048):
                k = list_keys(_symbols(part.column("sig").to_pylist()), t)
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), part.column("id").take(pa.array(np.repeat(np.arange(len(k)), k.shape[1])))], ["key", "id"])

    return nodes.select("id", "sig").mapInArrow(keys, "key long, id long")


def near_pairs(pairs: DataFrame, nodes: DataFrame, t: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most t symbols."""
    sig = nodes.select("id", "sig")
    both = pairs.join(sig.toDF("a", "_sa"), "a").join(sig.toDF("b", "_sb"), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            d = (_symbols(batch.column("_sa").to_pylist()) != _symbols(batch.column("_sb").to_pylist())).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(d <= t)) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "_sa", "_sb").mapInArrow(near, "a long, b long")


def full_sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, s): the full sets of some nodes, 8 bytes a shingle. ids: stored, distinct."""
    wanted = nodes.join(ids, "id", "left_semi").select("id", "rep", "h1", "h2")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(F.broadcast(wanted) if ids.count() <= SENT_IDS else wanted, "rep")

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                out = []
                for _, _, data, offsets in chunks(batch.column("text").to_pylist(), 1 << 19):
                    out += shingle_hashes(data, offsets, width)
                # A doc_id may stand for several texts: only the node's own set.
                own = [set_hashes(x) == h for x, h in zip(out, zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist()))]
                yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(own, pa.bool_())), pa.array([x.tobytes() for x, o in zip(out, own) if o], pa.binary())], ["id", "s"])

    return texts.select("id", "h1", "h2", "text").mapInArrow(derive, "id long, s binary").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs with den * intersection >= num * union."""
    both = pairs.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b").select("a", "b", "_sa", "_sb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_sa"), batch.column("_sb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if den * min(len(x), len(y)) < num * max(len(x), len(y)):
                    keep.append(False)
                    continue
                z = np.sort(np.concatenate([x, y]))
                shared = int((z[1:] == z[:-1]).sum())
                keep.append(den * shared >= num * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return both.mapInArrow(check, "a long, b long")


def reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of some edges, and the least end that each reaches."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(ids)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = top(x), top(y)
        root[max(x, y)] = min(x, y)
    return ids, ids[np.array([top(x) for x in root], np.int64)]


def last_hop(edges: DataFrame) -> DataFrame:
    """(a, _to): where each end of a bounded rest of edges goes, found in one task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in reached(*map(np.concatenate, zip(*held)))], ["a", "_to"])

    return edges.where("a < b").coalesce(1).mapInArrow(find, "a long, _to long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable by edges (a, b).

    In a round each end goes to the least of its neighbours and itself in a seeded order, then as that one goes; edges between
    the ends' places are what the next round takes, so that rounds shrink. At most one end of an edge stays where it is. Once no
    more than REST edges are left, one task closes them: each round is a dozen jobs for the driver, however few its edges.
    """
    spark, hops, places = edges.sparkSession, [], []
    both, last = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    while True:
        placed = lambda end: F.struct(F.xxhash64(F.lit(len(hops)), end).alias("_h"), F.col(end).alias("_id"))  # noqa: B023, E731
        least = both.groupBy("a").agg(F.min(placed("b")).alias("_m")).select("a", F.least(placed("a"), "_m")["_id"].alias("_to"))
        hop, place = stored(least.join(least.toDF("_to", "_next"), "_to").select("a", F.col("_next").alias("_to")), "hops")
        hops.append(hop)
        places.append(place)
        ends = both.join(hop, "a").select("b", F.col("_to").alias("_a")).join(hop.toDF("b", "_b"), "b")
        both, where = stored(ends.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges")
        discard(spark, last)
        last = where
        left = both.count()
        if left <= REST:
            break
    if left:
        hop, place = stored(last_hop(both), "hops")
        hops.append(hop)
        places.append(place)
    at = hops[0].toDF("id", "_at")
    for hop in hops[1:]:
        at = at.join(hop.toDF("_at", "_to"), "_at", "left").select("id", F.coalesce("_to", "_at").alias("_at"))
    tops = at.groupBy("_at").agg(F.min("id").alias("component"))
    labels, _ = stored(at.join(tops, "_at").select("id", "component"), "labels")
    discard(spark, last, *places)
    return labels


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the old components are found, and every node follows its own."""
    label = lambda end: labels.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    more = components(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))).select(F.col("id").alias("component"), F.col("component").alias("_top"))
    every = labels.unionByName(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(labels, "id", "left_anti").withColumn("component", F.col("id")))
    return every.join(more, "component", "left").select("id", F.coalesce("_top", "component").alias("component"))


# --- lists that span components -----------------------------------------------------------------------------------


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of equal key from batches in the order of the key."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = pa.Table.from_batches([batch.slice(lo, hi - lo)])
            if held and held[0].column(key)[0].as_py() != int(k[lo]):
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)
    held.clear()
    hand_back()


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, component, own): lists of more than two nodes that span components; own: in the component of the list's first node."""
    at = lists.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = F.min(F.struct("id", "component"))["component"].alias("_first")
    span = at.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("_n"), first)
    return at.join(span.where("_lo <> _hi AND _n > 2").select("key", "_first"), "key").select("key", "id", "component", (F.col("component") == F.col("_first")).alias("own"))


def gathered(lists: DataFrame) -> tuple[DataFrame, str]:
    """(key, id, component, own), stored: open lists, with one list in place of those of a cluster where that is cheaper. lists: stored.

    Lists are in a cluster if they reach one another through components. A cluster of more than a piece stays dealt by its lists
    where these take fewer rows or fewer comparisons.
    """
    # A list is named by the component of most of its nodes, which most lists of a group share: few links tie a cluster.
    parts = lists.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
    first = parts.groupBy("key").agg(F.max(F.struct("_n", "component"))["component"].alias("a"))
    reach = parts.select("key", F.col("component").alias("b")).join(first, "key").where("a <> b").select("a", "b")
    clusters = components(reach).select(F.col("id").alias("a"), F.col("component").alias("cluster"))
    at, at_place = stored(first.join(clusters, "a").select("key", "cluster"), "clusters")
    pieces = lambda n: F.ceil(F.col(n) / PIECE) * F.col(n)
    dealt = lists.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).join(at, "key")
    dealt = dealt.groupBy("cluster").agg(F.sum(pieces("_n")).alias("_rows"), F.sum(F.col("_n") * F.col("_n")).alias("_pairs"))
    nodes = lists.join(at, "key").groupBy("id").agg(F.min("component").alias("component"), F.min("cluster").alias("cluster"))
    sizes = nodes.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.groupBy("cluster").agg(F.sum("_n").alias("_n"), F.max(F.struct("_n", "component"))["component"].alias("_own"))
    whole = sizes.join(dealt, "cluster").where((pieces("_n") < F.col("_rows")) & ((F.col("_n") <= PIECE) | (F.col("_n") * F.col("_n") <= F.col("_pairs"))))
    rows = lists.join(at.join(whole.select("cluster", "_own"), "cluster", "left"), "key")
    one = rows.where("_own IS NOT NULL").select((F.shiftleft("cluster", 7) + CLUSTER).alias("key"), "id", "component", (F.col("component") == F.col("_own")).alias("own")).distinct()
    out = stored(rows.where("_own IS NULL").select("key", "id", "component", "own").unionByName(one), "gathered")
    discard(lists.sparkSession, at_place)
    return out


def met(rows: DataFrame, piece: int, size: str | None = None, most: int = 1) -> DataFrame:
    """Pieces of lists that meet: adds _meet (a number a meeting) and _side. rows: stored; key, id, component, own, ...

    A short list is one meeting. A long one is cut into pieces of `piece` nodes, or of `most` of the column `size`. Its nodes that are
    not `own` meet each other and the `own` ones; those don't meet among themselves, since they are one component.
    """
    number = lambda w: F.count_if(w) / piece if size is None else F.greatest(F.count_if(w) / piece, F.coalesce(F.sum(F.when(w, F.col(size))), F.lit(0)) / most)
    many = rows.groupBy("key").agg(*(F.greatest(F.lit(1), F.ceil(number(w))).cast("int").alias(n) for n, w in (("_own", F.col("own")), ("_out", ~F.col("own")))))
    rows = rows.join(many, "key")
    short = rows.where("_own = 1 AND _out = 1").drop("_own", "_out").withColumns({"_meet": F.xxhash64("key"), "_side": F.lit(-1)})
    long = rows.where("_own > 1 OR _out > 1").withColumn("_piece", F.pmod(F.xxhash64("id"), F.when(F.col("own"), F.col("_own")).otherwise(F.col("_out"))).cast("int"))
    meeting = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"))
    # Meetings are (x, y): pieces x and y of the others where x <= y, or piece y of the others with piece -1 - x of the own.
    outside = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("_out") - 1), lambda o: meeting(F.least(o, F.col("_piece")), F.greatest(o, F.col("_piece")), F.col("_piece") > o)),
        F.transform(F.sequence(F.lit(0), F.col("_own") - 1), lambda o: meeting(-1 - o, F.col("_piece"), F.lit(1))),
    )
    inside = F.transform(F.sequence(F.lit(0), F.col("_out") - 1), lambda o: meeting(-1 - F.col("_piece"), o, F.lit(0)))
    long = long.withColumn("_at", F.explode(F.when(F.col("own"), inside).otherwise(outside)))
    long = long.withColumns({"_meet": F.xxhash64("key", "_at.x", "_at.y"), "_side": F.when(F.col("_at.x") == F.col("_at.y"), F.lit(-1)).otherwise(F.col("_at.side"))}).drop("_own", "_out", "_piece", "_at")
    return short.unionByName(long)


def partners(sig: np.ndarray, comp: np.ndarray, side: np.ndarray, gap: int, t: int) -> np.ndarray:
    """Which of a meeting's nodes have a partner of another component within t whose first shared list is this one, `gap`; in a cluster any partner counts."""
    n, bounds = len(sig), chunk_bounds(t)
    starts = np.array([a for a, _ in bounds])
    own = next((c for c, (a, b) in enumerate(bounds) if a <= gap < b), None)
    found = np.zeros(n, bool)
    for at in range(0, n, 32):
        end = min(at + 32, n)
        ok = comp[at:end, None] != comp[None, :]
        if side[0] >= 0:
            ok &= side[at:end, None] != side[None, :]
        ok &= np.arange(at, end)[:, None] < np.arange(n)[None, :]
        i, j = np.nonzero(ok)
        for lo in range(0, len(i), 1 << 15):
            a, b = at + i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
            differ = sig[a] != sig[b]
            near = np.flatnonzero(differ.sum(1) <= t)
            if gap == CLUSTER:
                found[a[near]] = found[b[near]] = True
                continue
            if not len(near):
                continue
            by = np.add.reduceat(differ[near], starts, axis=1, dtype=np.int64)
            # The first chunk with one error at most, and there the list of the error's place, or the first one without an error.
            first = (by <= 1).argmax(1) == own
            lo_, hi_ = bounds[own]
            inside = differ[near][:, lo_:hi_]
            first &= np.where(inside.any(1), inside.argmax(1), 0) == gap - lo_
            keep = near[first]
            found[a[keep]] = found[b[keep]] = True
    return found


def wanted(rows: DataFrame, nodes: DataFrame, t: int) -> DataFrame:
    """(key, id, component, own) of open lists and clusters for which the node's full set is needed. rows: stored."""
    rows = met(rows, PIECE).join(nodes.select("id", "sig"), "id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for group in groups(batches, "_meet"):
            keep = partners(_symbols(group.column("sig").to_pylist()), group.column("component").to_numpy(), group.column("_side").to_numpy(), group.column("key")[0].as_py() & 127, t)
            if keep.any():
                out.append(group.select(["key", "id", "component", "own"]).filter(pa.array(keep)))
                n += int(keep.sum())
            if n > 50_000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, n = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    rows = rows.select("_meet", "_side", "key", "id", "component", "own", "sig").repartition("_meet").sortWithinPartitions("_meet")
    return rows.mapInArrow(find, "key long, id long, component long, own boolean").distinct()


def forest(sets: list[np.ndarray], ids: np.ndarray, comp: np.ndarray, side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links between sets of different components that are alike to num/den, as few as connect what all of them connect."""
    size = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    place = np.cumsum(shared) - 1
    pick = shared[column]
    row, column = owner[pick], place[column[pick]]
    both = np.zeros((len(sets), len(sets)))
    width = 2048
    cuts = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        m = np.zeros((len(sets), width), np.float32)
        m[row[lo:hi], column[lo:hi] - k * width] = 1
        both += m @ m.T
    alike = den * both >= num * (size[:, None] + size[None, :] - both)
    alike &= comp[:, None] != comp[None, :]
    if side[0] >= 0:
        alike &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(alike, 1))
    root = {c: c for c in set(comp.tolist())}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = top(int(comp[i])), top(int(comp[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return out


def linked(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links of spanning forests over the wanted nodes of each list. rows: stored, with n_shingles."""
    rows = met(rows, SET_PIECE, "n_shingles", SET_BYTES // 8).join(sets, "id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "_meet"):
            raw = group.column("s").combine_chunks()
            found = forest([np.frombuffer(x.as_buffer(), np.uint64) for x in raw], group.column("id").to_numpy(), group.column("component").to_numpy(), group.column("_side").to_numpy(), num, den)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    rows = rows.select("_meet", "_side", "id", "component", "s").repartition("_meet").sortWithinPartitions("_meet")
    return rows.mapInArrow(link, "a long, b long")


def _members(docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, str]:
    """(doc_id, n_shingles, h1, h2, t1, t2, component, rep), stored: for every row its component (null: linked with nothing) and the smallest doc_id in it."""
    spark = docs.sparkSession
    t = most_different(num, den)
    marks, marks_at = stored(signed(docs, width), "signatures")
    some = marks.where("sig IS NOT NULL AND doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("long"))
    # Nodes are numbered when they are written; the numbers hold from then on.
    nodes = some.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")).withColumn("id", F.monotonically_increasing_id())
    nodes, nodes_at = stored(nodes, "nodes")
    keys = keyed(nodes, t)
    shared = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key", "pivot")
    lists, lists_at = stored(keys.join(shared, "key").select("key", "id", "pivot"), "lists")
    first = lists.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    tried, tried_at = stored(near_pairs(first, nodes, t), "tried")
    ids, ids_at = stored(tried.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets, sets_at = stored(full_sets(docs, nodes, ids, width), "sets")
    labels = components(confirmed(tried, sets, num, den))
    spanning, spanning_at = stored(open_lists(lists.select("key", "id"), labels), "open")
    discard(spark, lists_at, tried_at)
    meeting, meeting_at = gathered(spanning)
    discard(spark, spanning_at)
    need, need_at = stored(wanted(meeting, nodes, t).join(nodes.select("id", "n_shingles"), "id"), "wanted")
    rest, rest_at = stored(need.select("id").distinct().join(ids, "id", "left_anti"), "ids")
    more, more_at = stored(full_sets(docs, nodes, rest, width), "sets")
    links, links_at = stored(linked(need, sets.unionByName(more), num, den).distinct(), "links")
    discard(spark, sets_at, more_at, need_at, meeting_at, ids_at, rest_at)
    labels = relabelled(labels, links)
    own = nodes.select("id", "h1", "h2", F.col("n_shingles").alias("_n"), "rep").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = own.groupBy("component").agg(F.min("rep").alias("_least"))
    own = own.join(least, "component").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_n", "component", F.col("_least").alias("rep"))
    found = marks.drop("sig").join(own, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("n_shingles") == F.col("_n")) & F.col("doc_id").isNotNull(), "left")
    out = stored(found.select("doc_id", *_MARKS, "component", "rep"), "members")
    discard(spark, marks_at, nodes_at, links_at)
    return out


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): components of documents alike to num/den or more on shingles of `width` words."""
    rows, _ = _members(docs, width, num, den)
    out = rows.select("doc_id", "n_shingles", F.coalesce("rep", F.col("doc_id").cast("long")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each component, of the smallest doc_id, then of the smallest hash of its text.

    Rows linked with nothing stay, one for each doc_id and text; so do all rows with a null doc_id.
    """
    docs, back = set_apart(docs, "doc_id", "text")
    rows, _ = _members(docs, width, num, den)
    rows = rows.where("doc_id IS NOT NULL").select("doc_id", "t1", "t2", "component")
    best = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("_b")).select("_b.*")
    kept = best.unionByName(rows.where("component IS NULL").drop("component").distinct())
    t1, t2 = text_hashes()
    own = docs.where("doc_id IS NOT NULL").withColumns({"_t1": t1, "_t2": t2})
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("t1").alias("_k1"), F.col("t2").alias("_k2"))
    own = own.join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_t1") == F.col("_k1")) & (F.col("_t2") == F.col("_k2")), "left_semi")
    return own.dropDuplicates(["doc_id", "_t1", "_t2"]).select(*docs.columns).unionByName(docs.where("doc_id IS NULL")).select(*back())


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike to 0.85 or more on three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, num=85)
