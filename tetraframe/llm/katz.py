"""Katz backoff language model over words, stored and evaluated as tables.

P(w | h) = d(c) * c(h, w) / c(h) where the pair was seen, else alpha(h) * P(w). The Good-Turing discounts d(1) .. d(5) come from
the corpus's counts of counts (Katz's formula, larger counts undiscounted), the unigram level gives unseen words the Good-Turing
mass of words seen once, and alpha(h) is exact: what the seen followers of h leave of the probability, over what they leave of the
unigram distribution. The context of a text's first word is the end token of the text before it.

Counts are exchanged as packed tables rather than rows of words. Documents form blocks of a few MB, which are stored once: a block
holds its distinct words as 64-bit hashes and its texts as numbers of them, and has its number in the table, so every later step
reads the same blocks whatever its tasks, and a lost executor changes nothing. For each bucket of following words a block writes its
distinct pairs once, with its own training counts; the bucket adds them up and answers each block with corpus counts. A word whose
pairs would overfill a bucket is spread over several by the hash of its context; its own count is put together afterwards. The sums
over the followers of each context are partial by bucket of the following word and meet in buckets of contexts. Every text of a
block is then evaluated from the answers, word by word, backing off where a pair was not seen in training.

Rows are one a block and bucket that share a word, so their number is that of blocks times buckets until a row holds few pairs;
buckets and blocks are large for that reason. Exchanges run in PASSES, each over a share of the buckets or blocks, so that one
pass's shuffle is on disk at a time.

Rows held out teach nothing and are scored like all others. Words are equal if their 64-bit hashes are.

Defined cases: null text is the empty text, one token (its end); texts of any length are read whole, and one longer than a block is
a block; repeated rows count and are scored each; a corpus without training tokens gives every token an equal chance of one in
V + 1 = 1; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import chunks, crc_mod, discard, from_planes, mix, planes, slices, stored, table, words

#: Bytes of a block's texts, pairs of a bucket, fewest buckets, passes of an exchange, largest count that is discounted.
BLOCK, PAIRS, FEWEST, PASSES, MOST = 6 << 20, 3 << 19, 64, 3, 5
END = np.uint64(0x51ED270B35AE1F1D)


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), kind)


def _counts(x: np.ndarray) -> bytes:
    """Counts, in the narrowest of three widths."""
    most = int(x.max(initial=0))
    kind = np.uint8 if most < 1 << 8 else np.uint32 if most < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + _pack(x.astype(kind))


def _uncounts(raw: bytes) -> np.ndarray:
    return _unpack(raw[1:], {1: np.uint8, 4: np.uint32, 8: np.uint64}[raw[0]]).astype(np.int64)


def _hashed(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Words of joined texts and their number by document, hashed some documents at a time."""
    h, n, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        with np.errstate(over="ignore"):
            own, count, _ = words(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        h.append(own)
        n.append(count)
        at = end
    return np.concatenate(h), np.concatenate(n)


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks of a scan of (doc_id, text, held_out): tokens of each document, distinct words, texts as numbers of words."""
    for batch in gathered(batches, BLOCK):
        for lo, hi, data, offsets in chunks(batch.column("text").to_pylist(), BLOCK):
            h, n = _hashed(data, offsets)
            # An end after each document's words.
            at = np.cumsum(n + 1) - 1
            tokens = np.empty(len(h) + len(n), np.uint64)
            inside = np.ones(len(tokens), bool)
            inside[at] = False
            tokens[inside], tokens[at] = h, END
            vocab, codes = np.unique(tokens, return_inverse=True)
            own = batch.slice(lo, hi - lo)
            held = own.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            yield {"sizes": n + 1, "vocab": vocab, "codes": codes.astype(np.uint32), "held": held, "ids": own.column("doc_id")}


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until their buffers hold `size` bytes."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in slices(batches):
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def blocks(docs: DataFrame) -> DataFrame:
    """A row a block, packed: ids and held-out flags of documents, tokens of each, distinct words, texts as numbers of words. Numbered when written."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _built(batches):
            size = pa.array([0, len(x["ids"])], pa.int32())
            ids, held = pa.ListArray.from_arrays(size, x["ids"]), pa.ListArray.from_arrays(size, pa.array(x["held"]))
            yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.binary()) for v in (_pack(x["sizes"]), _pack(x["vocab"]), planes(x["codes"]))), ids, held], ["sizes", "vocab", "codes", "ids", "held"])

    rows = docs.select("doc_id", "text", "held_out").mapInArrow(build, f"sizes binary, vocab binary, codes binary, ids array<{kind}>, held array<boolean>")
    return rows.withColumn("block", F.monotonically_increasing_id())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(number, words, codes, sizes, held) of stored blocks."""
    for batch in slices(batches, 1):
        row = {c: batch.column(c)[0].as_py() for c in batch.schema.names}
        yield row["block"], *_load(row)


def block_pairs(vocab: np.ndarray, codes: np.ndarray, sizes: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a block by (following word, context): context, word, training count, and the pair of each token."""
    end = np.uint32(np.searchsorted(vocab, END))
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = end
    pair = codes.astype(np.int64) * len(vocab) + before
    distinct, of = np.unique(pair, return_inverse=True)
    taught = np.repeat(~held, sizes)
    return (distinct % len(vocab)), (distinct // len(vocab)), np.bincount(of, taught, len(distinct)).astype(np.int64), of


def _spread(word: np.ndarray, context: np.ndarray, buckets: int, hot: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """The bucket of each pair: by its word, of hot words also by its context."""
    with np.errstate(over="ignore"):
        out = mix(word ^ np.uint64(0xA0761D6478BD642F))
        if len(hot):
            at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
            is_hot = hot[at] == word
            out = np.where(is_hot, mix(out + np.uint64(1) + mix(context) % ways[at].astype(np.uint64)), out)
    return (out % np.uint64(buckets)).astype(np.int64)


class Exchange:
    """What blocks and buckets agree on: numbers of buckets, hot words and over how many buckets each is spread."""

    def __init__(self, buckets: int, hot: np.ndarray, ways: np.ndarray):
        self.buckets, self.hot, self.ways = buckets, hot, ways

    def layout(self, vocab: np.ndarray, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of a block's pairs by bucket, and the bounds of the buckets in it."""
        b = _spread(vocab[word], vocab[context], self.buckets, self.hot, self.ways)
        order = np.argsort(b, kind="stable")
        return order, np.searchsorted(b[order], np.arange(self.buckets + 1))

    def context_layout(self, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a block's words as contexts."""
        with np.errstate(over="ignore"):
            b = (mix(vocab ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        return order, np.searchsorted(b[order], np.arange(self.buckets + 1))


def _load(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return _unpack(row["vocab"], np.uint64), from_planes(row["codes"]).astype(np.uint32), _unpack(row["sizes"], np.int64), np.array(row["held"], bool)


_COLUMNS = ("block", "sizes", "vocab", "codes", "held")


def crowded(kept: DataFrame, share: float) -> DataFrame:
    """(word, pairs): words that hold at least `share` of some block's distinct pairs, with their pairs over these blocks."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, vocab, codes, sizes, held in _rows(batches):
            _, word, _, _ = block_pairs(vocab, codes, sizes, held)
            n = np.bincount(word, minlength=len(vocab))
            big = np.flatnonzero(n >= max(64, share * len(word)))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(vocab[big], np.uint64(0)).view(np.int64)), pa.array(np.append(n[big], len(word)))], ["word", "pairs"])

    return kept.select(*_COLUMNS).mapInArrow(find, "word long, pairs long").groupBy("word").agg(F.sum("pairs").alias("pairs"))


def requests(kept: DataFrame, x: Exchange, part: int = 0, parts: int = 1) -> DataFrame:
    """(bucket, block, payload...): a block's distinct pairs for each bucket of a share: words, contexts of each, training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, vocab, codes, sizes, held in _rows(batches):
            context, word, count, _ = block_pairs(vocab, codes, sizes, held)
            order, cuts = x.layout(vocab, context, word)
            context, word, count = context[order], word[order], count[order]
            out = [[], [], [], [], [], []]
            for b in np.flatnonzero(np.diff(cuts)):
                if b % parts != part:
                    continue
                lo, hi = cuts[b], cuts[b + 1]
                first = np.flatnonzero(np.concatenate([[True], word[lo + 1 : hi] != word[lo : hi - 1]]))
                for k, v in enumerate((int(b), block, vocab[word[lo:hi][first]].tobytes(), _counts(np.diff(np.append(first, hi - lo))), vocab[context[lo:hi]].tobytes(), _counts(count[lo:hi]))):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "block", "words", "runs", "contexts", "counts"])

    return kept.select(*_COLUMNS).mapInArrow(ask, "bucket long, block long, words binary, runs binary, contexts binary, counts binary")


def _answer(pdf: pd.DataFrame, x: Exchange) -> pd.DataFrame:
    """Rows of a bucket: corpus counts for each block ('a'), sums by context for buckets of contexts ('c'), totals ('t'), hot words ('h')."""
    pdf = pdf.sort_values("block", ignore_index=True)
    ws, cs, ns, size, wsize = [], [], [], [], []
    for r in pdf.itertuples(index=False):
        w, runs = np.frombuffer(r.words, np.uint64), _uncounts(r.runs)
        c = np.frombuffer(r.contexts, np.uint64)
        ws.append(np.repeat(w, runs))
        cs.append(c)
        ns.append(_uncounts(r.counts))
        size.append(len(c))
        wsize.append((w, runs))
    word, context, n = np.concatenate(ws), np.concatenate(cs), np.concatenate(ns)
    order = np.lexsort((context, word))
    w, c, k = word[order], context[order], n[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
    first = np.flatnonzero(new)
    total = np.add.reduceat(k, first)
    of = np.empty(len(word), np.int64)
    of[order] = np.cumsum(new) - 1
    w, c = w[first], c[first]
    fresh = np.concatenate([[True], w[1:] != w[:-1]])
    wfirst = np.flatnonzero(fresh)
    wtotal = np.add.reduceat(total, wfirst)
    vocab = w[wfirst]
    wof = np.cumsum(fresh) - 1
    hot = np.isin(vocab, x.hot)
    rows = []
    cut = np.concatenate([[0], np.cumsum(size)])
    for i, block in enumerate(pdf["block"].tolist()):
        own = of[cut[i] : cut[i + 1]]
        rows.append(("a", block, int(pdf["bucket"].iat[0]), _counts(total[own]), _counts(wtotal[np.searchsorted(vocab, wsize[i][0])]), None))
    seen = total > 0
    # By context: followers with training counts 1..MOST, and the sum of the words' counts; hot words' counts are not known here.
    cc, t, hw = c[seen], total[seen], hot[wof[seen]]
    wt = np.where(hw, 0, wtotal[wof[seen]])
    by = np.argsort(cc, kind="stable")
    cc, t, wt, hw, word_of = cc[by], t[by], wt[by], hw[by], w[seen][by]
    if len(cc):
        at = np.flatnonzero(np.concatenate([[True], cc[1:] != cc[:-1]]))
        sums = np.stack([np.add.reduceat((t == j).astype(np.int64), at) for j in range(1, MOST + 1)] + [np.add.reduceat(np.where(t > MOST, t, 0), at), np.add.reduceat(wt, at)])
        contexts = cc[at]
        with np.errstate(over="ignore"):
            dest = (mix(contexts ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(x.buckets)).astype(np.int64)
            hdest = (mix(cc[hw] ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(x.buckets)).astype(np.int64)
        o = np.argsort(dest, kind="stable")
        ho = np.argsort(hdest, kind="stable")
        cuts, hcuts = np.searchsorted(dest[o], np.arange(x.buckets + 1)), np.searchsorted(hdest[ho], np.arange(x.buckets + 1))
        hc, hword = cc[hw][ho], word_of[hw][ho]
        for b in range(x.buckets):
            pick = o[cuts[b] : cuts[b + 1]]
            if len(pick):
                rows.append(("c", -1, b, contexts[pick].tobytes(), b"".join(len(v).to_bytes(4, "little") + v for v in (_counts(s[pick]) for s in sums)), None if hcuts[b] == hcuts[b + 1] else _pack(np.stack([hc[hcuts[b] : hcuts[b + 1]], hword[hcuts[b] : hcuts[b + 1]]]))))
    # Pairs and words by count, tokens, words; a hot word's own count waits.
    cold = wtotal[~hot]
    many = [int((total == j).sum()) for j in range(1, MOST + 2)] + [int((cold == j).sum()) for j in range(1, MOST + 2)] + [int(cold.sum()), int((cold > 0).sum())]
    rows.append(("t", -1, -1, np.array(many, np.int64).tobytes(), None, None))
    if hot.any():
        rows.append(("h", -1, -1, vocab[hot].tobytes(), wtotal[hot].astype(np.int64).tobytes(), None))
    return pd.DataFrame(rows, columns=["kind", "block", "bucket", "x", "y", "z"])


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts by count, 0..MOST+1 (the last for all larger): Katz's formula, or none where counts of counts don't allow it.

    n: numbers of types seen once, twice, ..., MOST + 1 times.
    """
    d = np.ones(MOST + 2)
    if not n[0]:
        return d
    common = (MOST + 1) * n[MOST] / n[0]
    for r in range(1, MOST + 1):
        if n[r - 1] and n[r] and common < 1:
            v = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
            if 0 < v < 1:
                d[r] = v
    # Something must be left for unseen followers even where no formula applies.
    if d[1] == 1:
        d[1] = 0.5 if n[0] else 1
    return d


class Model:
    """Totals, discounts, the unigram level and hot words' counts."""

    def __init__(self, totals: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray):
        pairs, singles = totals[: MOST + 1], totals[MOST + 1 : 2 * MOST + 2].copy()
        self.hot, self.hot_counts = hot, hot_counts
        for j in range(MOST + 1):
            singles[j] += int((hot_counts == j + 1).sum())
        self.tokens, self.types = int(totals[-2] + hot_counts.sum()), int(totals[-1] + (hot_counts > 0).sum())
        self.d = discounts(pairs.tolist())
        # Mass of unseen words: the share of tokens seen once, shared by one unknown word.
        self.unseen = min(0.5, max(singles[0], 1) / max(self.tokens, 1)) if self.tokens else 1.0

    def word(self, count: np.ndarray) -> np.ndarray:
        """Unigram probability of words with these training counts."""
        return np.where(count > 0, (1 - self.unseen) * count / max(self.tokens, 1), self.unseen)

    def counts_of(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Counts, with those of hot words put in."""
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
            counts = np.where(self.hot[at] == words, self.hot_counts[at], counts)
        return counts


def _alphas(sums: pd.DataFrame, asked: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Backoff weight and training count of each context that a block asks for."""
    parts, hots = [], []
    for r in sums.itertuples(index=False):
        c, values, at = np.frombuffer(r.x, np.uint64), [], 0
        for _ in range(MOST + 2):
            n = int.from_bytes(r.y[at : at + 4], "little")
            values.append(_uncounts(r.y[at + 4 : at + 4 + n]))
            at += 4 + n
        parts.append((c, np.stack(values)))
        if r.z is not None:
            h = _unpack(r.z, np.uint64).reshape(2, -1)
            hots.append((h[0], model.counts_of(h[1], np.zeros(h.shape[1], np.int64))))
    if parts:
        c = np.concatenate([p[0] for p in parts] + [h[0] for h in hots])
        v = np.concatenate([p[1] for p in parts] + [np.vstack([np.zeros((MOST + 1, len(h[0])), np.int64), h[1][None]]) for h in hots], 1)
        order = np.argsort(c, kind="stable")
        c, v = c[order], v[:, order]
        at = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        c, v = c[at], np.add.reduceat(v, at, axis=1)
    else:
        c, v = np.zeros(0, np.uint64), np.zeros((MOST + 2, 0), np.int64)
    r = np.arange(1, MOST + 1)
    count = (r[:, None] * v[:MOST]).sum(0) + v[MOST]
    kept = (model.d[1 : MOST + 1, None] * r[:, None] * v[:MOST]).sum(0) + v[MOST]
    left = 1 - kept / np.maximum(count, 1)
    rest = 1 - (1 - model.unseen) * v[MOST + 1] / max(model.tokens, 1)
    # A context all of whose followers keep their counts would leave nothing: its count is raised by a half, which is left.
    # The sign of its weight says so.
    bare = left <= 1e-12
    left = np.where(bare, 0.5 / (count + 0.5), left)
    alpha = left / np.maximum(rest, 1e-300) * np.where(bare, -1, 1)
    rows = []
    for q in asked.itertuples(index=False):
        want = np.frombuffer(q.words, np.uint64)
        at = np.minimum(np.searchsorted(c, want), max(len(c) - 1, 0))
        hit = (c[at] == want) if len(c) else np.zeros(len(want), bool)
        rows.append((q.block, int(q.bucket), _pack(np.where(hit, alpha[at] if len(c) else 1.0, 1.0)), _counts(np.where(hit, count[at] if len(c) else 0, 0))))
    return pd.DataFrame(rows, columns=["block", "bucket", "x", "y"])


def context_requests(kept: DataFrame, x: Exchange) -> DataFrame:
    """(bucket, block, words): a block's distinct words as contexts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, vocab, *_ in _rows(batches):
            order, cuts = x.context_layout(vocab)
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([block] * len(full), pa.int64()), pa.array([vocab[order[cuts[b] : cuts[b + 1]]].tobytes() for b in full], pa.binary())], ["bucket", "block", "words"])

    return kept.select(*_COLUMNS).mapInArrow(ask, "bucket long, block long, words binary")


def _evaluate(row, answers: dict[int, tuple[bytes, bytes]], contexts: dict[int, tuple[bytes, bytes]], x: Exchange, model: Model) -> list[np.ndarray]:
    """Per document of a block: tokens, tokens known, base score, score."""
    vocab, codes, sizes, held = _load(row)
    context, word, own, of = block_pairs(vocab, codes, sizes, held)
    order, cuts = x.layout(vocab, context, word)
    pair = np.zeros(len(word), np.int64)
    single = np.zeros(len(vocab), np.int64)
    for b, (counts, word_counts) in answers.items():
        pick = order[cuts[b] : cuts[b + 1]]
        pair[pick] = _uncounts(counts)
        w = word[pick]
        single[w[np.concatenate([[True], w[1:] != w[:-1]])]] = _uncounts(word_counts)
    single = model.counts_of(vocab, single)
    order, cuts = x.context_layout(vocab)
    alpha, times = np.ones(len(vocab)), np.zeros(len(vocab), np.int64)
    for b, (a, n) in contexts.items():
        pick = order[cuts[b] : cuts[b + 1]]
        alpha[pick], times[pick] = _unpack(a, np.float64), _uncounts(n)
    times, alpha = times + 0.5 * (alpha < 0), np.abs(alpha)
    uni = model.word(single)
    d = model.d[np.minimum(pair, MOST + 1)]
    # Katz's recursion, level by level: the pair where it was seen, else the context's weight times the word.
    direct = d * pair / np.maximum(times[context], 0.5)
    p = np.where(pair > 0, direct, alpha[context] * uni[word])
    logs = np.log10(p)
    v = model.types
    base = np.log10((single + 0.5) / (model.tokens + 0.5 * (v + 1)))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return [sizes, np.bincount(doc, single[codes] > 0, len(sizes)).astype(np.int64), np.bincount(doc, base[codes], len(sizes)), np.bincount(doc, logs[of], len(sizes))]


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); docs: doc_id, text, held_out."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    kept, kept_at = stored(blocks(docs), "blocks")
    # Crowded words: at most 1 / share words a block, and few of them are hot in the corpus.
    heavy, heavy_at = stored(crowded(kept, 1 / 512), "crowded")
    total = heavy.where("word = 0").agg(F.sum("pairs")).first()[0]
    if not total:
        return spark.createDataFrame([], schema)
    buckets = max(FEWEST, math.ceil(total / PAIRS))
    limit = total / buckets / 4
    rows = heavy.where((F.col("word") != 0) & (F.col("pairs") > limit)).collect()  # at most 4 words a bucket
    hot = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hot)
    x = Exchange(buckets, hot[order], np.array([math.ceil(r["pairs"] / limit) * 2 for r in rows], np.int64)[order] if rows else np.zeros(0, np.int64))
    kinds = "kind string, block long, bucket long, x binary, y binary, z binary"
    parts = [stored(requests(kept, x, k, PASSES).groupBy("bucket").applyInPandas(lambda pdf: _answer(pdf, x), kinds), "counts", ["kind"]) for k in range(PASSES)]
    answers = functools.reduce(DataFrame.unionByName, [p for p, _ in parts])
    totals = np.zeros(2 * MOST + 4, np.int64)
    for r in answers.where("kind = 't'").select("x").collect():  # a row a bucket
        totals += np.frombuffer(r["x"], np.int64)
    sums: dict[int, int] = {}
    for r in answers.where("kind = 'h'").select("x", "y").collect():  # hot words only
        for w, n in zip(np.frombuffer(r["x"], np.uint64).tolist(), np.frombuffer(r["y"], np.int64).tolist()):
            sums[w] = sums.get(w, 0) + n
    model = Model(totals, np.array(sorted(sums), np.uint64), np.array([sums[w] for w in sorted(sums)], np.int64))
    sides = answers.where("kind = 'c'").select("bucket", "x", "y", "z")
    alphas = sides.groupBy("bucket").cogroup(context_requests(kept, x).groupBy("bucket")).applyInPandas(lambda a, b: _alphas(a, b, model), "block long, bucket long, x binary, y binary")
    alphas, alphas_at = stored(alphas, "contexts")
    replies = answers.where("kind = 'a'").select("block", "bucket", "x", "y", F.lit(0).alias("k")).unionByName(alphas.withColumn("k", F.lit(1)))

    def evaluate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]  # every block has a row here, also one that no bucket answers
        got: list[dict] = [{}, {}]
        for r in right.itertuples(index=False):
            got[r.k][r.bucket] = r.x, r.y
        n, known, base, score = _evaluate(row, got[0], got[1], x, model)
        return pd.DataFrame({"ids": list(row["ids"]), "held": list(row["held"]), "n": n, "known": known, "base": base, "score": score})

    done = []
    for k in range(PASSES):
        own = F.pmod("block", F.lit(PASSES)) == k
        out = kept.where(own).groupBy("block").cogroup(replies.where(own).groupBy("block")).applyInPandas(evaluate, f"ids {kind}, held boolean, n long, known long, base double, score double")
        done.append(stored(out, "scores")[0])
    discard(spark, kept_at, heavy_at, alphas_at, *(at for _, at in parts))
    out = functools.reduce(DataFrame.unionByName, done)
    return out.select(F.col("ids").alias("doc_id"), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff scores of all documents, learned from those whose crc32(doc_id) mod 5 is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs.withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))))
