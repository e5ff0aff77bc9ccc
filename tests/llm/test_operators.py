"""The training-data operators against brute force on small tables."""

import collections
import hashlib
import math
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle
from tetraframe.llm import fingerprints, katz, langid, long_matches, mixing, near_dedup, ngram_tables, packing, registry, token_counts, topk, toxicity
from tetraframe.llm.common import words


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES)))
def test_empty_tables(spark, empty_folder, name):
    assert registry.QUERIES[name](spark, empty_folder).count() == 0


def test_fingerprints(spark, folder, rows):
    got = by_id(fingerprints.op1_fingerprints(spark, folder))
    order = sorted({i: t or "" for i, t, *_ in rows}.items(), reverse=True)
    form = lambda t: " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold()).split())
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        if i == 500:
            continue  # its next row is its copy
        half = len(t) // 2
        text = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(text.encode()).hexdigest())
        assert r["near_edited"] == float(form(text) == form(t)) and r["near_next"] == float(form(t) == form(after))
    assert {got[200 + k]["class_id"] for k in range(5)} == {11} and got[0]["fingerprint"] == got[1]["fingerprint"] == got[3]["fingerprint"]


def test_equal_digests_are_compared_by_bytes(spark):
    """A digest that is the same for all texts: classes come from the bytes alone."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A"), (4, "b"), (5, "c"), (6, None), (7, "")], "doc_id long, text string")
    forged = lambda form: F.lit("same")
    got = fingerprints.exact_classes(docs, docs.select("doc_id", F.lit("same").alias("fingerprint")), forged).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 3: 1, 2: 2, 4: 2, 5: 5, 6: 6, 7: 6}
    real = fingerprints.with_fingerprint(docs, "text", "fingerprint").select("doc_id", "fingerprint")
    assert {r["doc_id"]: r["class_id"] for r in fingerprints.exact_classes(docs, real).collect()} == {1: 1, 3: 1, 2: 2, 4: 2, 6: 6, 7: 6}


def test_next_rows_go_around_over_parts(spark):
    rows = [(i * 7 % 101, f"t{i}") for i in range(100)] + [(None, "none"), (50, "a"), (50, "b")]
    got = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), ["text"]).collect()
    order = [t for _, t in sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))]
    want = dict(zip(order, order[1:] + order[:1]))
    assert len(got) == len(rows) and {r["text"]: r["next_text"] for r in got} == want


def test_token_counts(spark, folder, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.vocabulary("byte_bpe_50k.json"))
    got = by_id(token_counts.op9_token_counts(spark, folder))
    for i, x, *_ in rows:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((x or "").encode()), n, n > 512)


def test_packing(spark, folder, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary("word_bpe_49k.json"))
    parts = packing.op10_packing(spark, folder).collect()
    got = collections.defaultdict(list)
    for r in parts:
        got[r["doc_id"]].append(r)
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        want = sorted((k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048)))
        assert set(want) == {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got[i]}
    assert len(parts) == sum(-(-(len(t.encode(x or "", add_special_tokens=False).ids) + 1) // 2048) for _, x, *_ in rows)
    bins = collections.defaultdict(list)
    for r in parts:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) <= sum(r["length"] for r in parts) / 2048 + 2


def test_sum_of_squares_rule():
    rng = np.random.default_rng(0)
    lengths, cap = rng.integers(1, 13, 200), 13
    where, offset = packing.sum_of_squares(lengths, cap)
    filled = collections.Counter()
    for n, b, o in zip(lengths.tolist(), where.tolist(), offset.tolist()):
        gaps = collections.Counter(cap - v for v in filled.values() if v < cap)
        cost = lambda g: sum(v * v for v in ((gaps + collections.Counter({g - n: 1} if g > n else {})) - collections.Counter({g: 1} if g in gaps and not (g == cap) else {})).values())  # noqa: B023, E731
        best = min(cost(g) for g in [*(g for g in gaps if g >= n), cap])
        assert o == filled[b] and cost(cap - filled[b]) == best
        filled[b] += n
    assert max(filled.values()) <= cap


def test_near_duplicates(spark, folder, rows):
    for width, num in ((3, 85), (5, 80)):
        sets = {}
        for i, t, *_ in rows:
            w = split(t)
            sets[i] = set(zip(*(w[k:] for k in range(width)))) if len(w) >= width else ({tuple(w)} if w else set())
        root = {i: i for i in sets}

        def top(i):
            while root[i] != i:  # noqa: B023
                i = root[i]  # noqa: B023
            return i

        for i in sets:
            for j in sets:
                if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                    a, b = sorted((top(i), top(j)))
                    root[b] = a
        got = by_id(near_dedup.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), width, num))
        for i in sets:
            assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), top(i), top(i) == i)


def test_chains_beyond_the_first_node_are_found(spark, monkeypatch):
    """Texts of which only neighbours are alike: no list's first node links them all."""
    monkeypatch.setattr(near_dedup, "PIECE", 4)
    monkeypatch.setattr(near_dedup, "SET_PIECE", 3)
    w = [f"t{k}" for k in range(160)]
    rows = [(k, " ".join(w[3 * k : 3 * k + 60])) for k in range(30)] + [(100 + k, " ".join(f"u{k}x{j}" for j in range(40))) for k in range(5)]
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert {got[k]["component_id"] for k in range(30)} == {0} and all(got[100 + k]["kept"] for k in range(5))


@pytest.mark.parametrize("piece", [4096, 40])
def test_copies_just_below_the_bound_meet_once(spark, monkeypatch, piece):
    """Rows that go to meetings follow the nodes of a group, not its nodes times the lists that they share; links are those of brute force."""
    import random

    rng, met, sent = random.Random(4), near_dedup.met, []

    def counted(rows, *size):
        out = met(rows, *size)
        sent.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "met", counted)
    monkeypatch.setattr(near_dedup, "PIECE", piece)
    base, texts = [f"v{k}" for k in range(140)], []
    for _ in range(150):
        w = list(base)
        for at in rng.sample(range(140), rng.randrange(2, 9)):
            w[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"o{k}x{j}" for j in range(40)) for k in range(5)]
    sets = [set(zip(*(t.split()[k:] for k in range(3)))) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85))
    assert [got[i]["component_id"] for i in range(len(texts))] == root and len(set(root)) > 20
    # A group over a piece meets in pairs of its pieces: at most one row for each piece.
    assert len(sent) == 2 and max(sent) <= len(texts) * (1 if piece > len(texts) else 5), sent


def test_pigeonhole_lists_meet():
    rng = np.random.default_rng(1)
    t = near_dedup.most_different(85, 100)
    a = rng.integers(0, 1 << 16, (200, near_dedup.K), dtype=np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(near_dedup.K, t, replace=False)
        row[at] ^= rng.integers(1, 1 << 16, t, dtype=np.uint16)
    with np.errstate(over="ignore"):
        x, y = near_dedup.list_keys(a, t), near_dedup.list_keys(b, t)
    assert (x == y).any(axis=1).all()


@pytest.mark.parametrize("hot", [4000, 1, 0])
def test_long_matches(spark, folder, rows, hot):
    n = 60
    docs = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(d[a : a + n] for d in docs for a in range(len(d) - n + 1))
    found = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    marks = long_matches.repeated_windows(found, n, hot)
    keyed = long_matches._keyed(found).join(marks, ["_k1", "_k2"], "left")
    got = {r["doc_id"]: long_matches.covered([(m["lo"], m["hi"]) for m in r["_marks"] or ()], n) for r in keyed.collect()}
    for (i, *_), d in zip(rows, docs):
        mark = np.zeros(len(d) + 2, bool)
        for a in range(len(d) - n + 1):
            if seen[d[a : a + n]] > 1:
                mark[a + 1 : a + n + 1] = True
        edge = np.flatnonzero(np.diff(mark.astype(int)))
        assert got[i] == list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def test_removed_bytes(spark, folder, rows):
    got = by_id(long_matches.op4_suffix_dedup(spark, folder))
    docs = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(d[a : a + 200] for d in docs for a in range(len(d) - 199))
    for (i, *_), d in zip(rows, docs):
        mark = bytearray(len(d))
        for a in range(len(d) - 199):
            if seen[d[a : a + 200]] > 1:
                mark[a : a + 200] = b"\1" * 200
        kept = bytes(c for c, m in zip(d, mark) if not m)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(d), len(d) - len(kept), hashlib.sha256(kept).hexdigest())


def test_suffixes_are_sorted():
    rng = np.random.default_rng(4)
    raw = [bytes(rng.integers(97, 99, int(n), dtype=np.uint8)) for n in rng.integers(1, 40, 60)] + [b"abab" * 9] * 3
    index = long_matches.RunLengthIndex(raw, 5)
    data, end = index.data.tobytes(), np.repeat(index.begin[1:], np.diff(index.begin))
    suffix = [data[i : end[i]] for i in range(len(data))]
    order = long_matches.sort_suffixes(index.data, end)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (suffix[i], i))
    def shared(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k
    at = {int(p): k for k, p in enumerate(order)}
    for i, v in enumerate(index.matching_statistics().tolist()):
        near = max((shared(suffix[i], suffix[order[at[i] + d]]) for d in (-1, 1) if 0 <= at[i] + d < len(order)), default=0)
        assert (v >= 5) == (near >= 5) and (near < 5 or v == near)


def test_katz(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(katz, "PAIRS", 200)
    monkeypatch.setattr(katz, "BLOCK", 4000)
    got = by_id(katz.op3_katz(spark, folder))
    texts = [(i, [*split(t), None]) for i, t, *_ in rows]
    uni, pair = collections.Counter(), collections.Counter()
    for i, w in texts:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            uni.update(w)
            pair.update(zip([None, *w], w))
    total, kinds = sum(uni.values()), len(uni)
    many = collections.Counter(pair.values())
    d = katz.discounts([many[k] for k in range(1, katz.MOST + 2)])
    unseen = min(0.5, max(sum(v == 1 for v in uni.values()), 1) / total)
    word = lambda w: (1 - unseen) * uni[w] / total if uni[w] else unseen
    after = collections.defaultdict(list)
    for (h, w), n in pair.items():
        after[h].append((w, n))
    alpha, times = {}, {}
    for h, f in after.items():
        n = times[h] = sum(k for _, k in f)
        left = 1 - sum(d[min(k, katz.MOST + 1)] * k for _, k in f) / n
        if left <= 1e-12:
            left, times[h] = 0.5 / (n + 0.5), n + 0.5
        alpha[h] = left / (1 - sum(word(w) for w, _ in f))
        assert abs(sum(d[min(k, katz.MOST + 1)] * k / times[h] for _, k in f) + alpha[h] * (1 - sum(word(w) for w, _ in f)) - 1) < 1e-9
    for i, w in texts:
        r = got[i]
        score = sum(math.log10(d[min(pair[h, a], katz.MOST + 1)] * pair[h, a] / times[h] if pair[h, a] else alpha.get(h, 1) * word(a)) for h, a in zip([None, *w], w))
        base = sum(math.log10((uni[a] + 0.5) / (total + 0.5 * (kinds + 1))) for a in w)
        assert abs(r["score"] - score) < 1e-6 and abs(r["base_score"] - base) < 1e-6
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(uni[a] > 0 for a in w), total, zlib.crc32(str(i).encode()) % 5 == 1)


def test_words_match_the_pattern():
    texts = ["", " ", "One  TWO\tthree\x0b", "été ÉTÉ", "a", "\n\n", "x\x1cy z"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    h, n, _ = words(data, offsets)
    assert n.tolist() == [len(split(t)) for t in texts]
    names = [w for t in texts for w in split(t)]
    assert len(set(h.tolist())) == len(set(names)) == len({(a, b) for a, b in zip(names, h.tolist())})


def test_topk_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    found = topk.op5_topk_search(spark, sf).toArrow()
    assert not difference(found, oracle(sf).sql(topk.OP5_SQL).to_arrow_table())


def test_topk_ties_nulls_and_pruning(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-3, 3, 4).astype(float).tolist()) for i in range(600)] + [(700, None), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan"), 0.0, 0.0, 0.0]), (1000, [1.0, 2.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = collections.defaultdict(list)
    for r in topk.op5_topk_search(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    good = {i: [math.floor(1024 * x) for x in v] + [0] * (4 - len(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    for q in [i for i in good if i % 100 == 0]:
        want = sorted(((i, sum(a * b for a, b in zip(good[q], v))) for i, v in good.items() if i != q), key=lambda x: (-x[1], x[0]))[:10]
        assert got[q] == want
    assert set(got) == {i for i in good if i % 100 == 0}
    base = rng.normal(size=(1, 8))
    blocks = [(np.arange(k * 50, k * 50 + 50), (1000 * base * (1 if k == 3 else -1) + rng.normal(size=(50, 8))).astype(np.int64)) for k in range(8)]
    *_, scored = topk.search_block((100 * base).astype(np.int64), np.array([-1]), blocks, 10)
    assert scored == 1


def test_grammar_marks_negation_and_report():
    g = toxicity.Grammar({"idiot$": 5.0, "loweib": 3.0})
    plain, negated, reported = (g.features(t) for t in ("You are an idiot.", "He is not an idiot.", "She said that you are an idiot."))
    assert plain[0] > 0 and plain[8] > 0 and negated[2] > 0 and negated[0] == 0 and reported[1] > 0
    assert g.features("He idiots around. Not. loweibung").sum() > 0 and g.features("idiotic pidiot").sum() == 0
    assert not g.features(None).any() and not g.features("").any()


def test_toxicity_learns_held_out_rows(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        w = [f"wort{rng.randrange(500)}" for _ in range(40)]
        if i % 6 == 0:
            w[rng.randrange(40)] = rng.choice(["idiot", "moron"])
            w[rng.randrange(40)] = "schuft" + rng.choice(["ig", "en", "isch"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 6 == 0)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = toxicity.op2_toxicity(spark, str(tmp_path)).where("held_out").collect()
    assert len(got) > 100 and sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxicity_bounds_keep_the_shares(spark):
    import random

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(2400):
        toxic = int(i % 9 == 0)
        w = [f"wort{rng.randrange(500)}" for _ in range(30)]
        if rng.random() < (0.7 if toxic else 0.05):
            w[3] = "schuftig"
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")

    def scores(**bounds):
        stems, w = toxicity.train(docs, known, **bounds)
        g = toxicity.Grammar(stems)
        return [float(1 / (1 + np.exp(-(g.features(t) @ w[:-1] + w[-1])))) for t in ("wort1 wort2", "wort1 schuftig wort2")]

    # 1:8 among all rows, 1:2 among the rows read: the scores are those of all rows.
    (clean, toxic), (few_clean, few_toxic) = scores(), scores(toxic_rows=120, clean_rows=240)
    assert abs(few_clean - clean) < 0.02 and abs(few_toxic - toxic) < 0.15
    x, y = np.array([[0.0], [1.0], [1.0], [0.0]]), np.array([0.0, 1.0, 0.0, 1.0])
    n = np.array([3, 2, 1, 1])
    assert np.allclose(toxicity.fit_logistic(x, y, counts=n.astype(float)), toxicity.fit_logistic(np.repeat(x, n, 0), np.repeat(y, n)))


def test_toxicity_of_nulls(spark, folder, rows):
    assert len(toxicity.op2_toxicity(spark, folder).collect()) == len(rows)


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.001"
    got = langid.op6_language_id(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.9


def test_texts_without_letters_are_undetermined(spark, folder):
    got = by_id(langid.op6_language_id(spark, folder))
    assert [got[i]["lang_pred"] for i in (0, 1, 3)] == ["und"] * 3 and got[10]["lang_pred"] in ("en", "fr")


def test_network_gradients():
    net = langid.ByteNetwork(["a", "b"])
    x, y = np.random.default_rng(0).integers(97, 110, (5, 12), dtype=np.uint8), np.array([0, 1, 1, 0, 1])
    g = net._step(x, y)
    loss = lambda: -net.log_probabilities(x)[np.arange(5), y].mean()
    for k, at in (("out", (3, 1)), ("filter3", (1, 2, 4)), ("bias2", (5,)), ("embed", (100, 2))):
        before = net.p[k][at]
        values = []
        for e in (1e-2, -1e-2):
            net.p[k][at] = before + e
            net.pairs = None
            values.append(loss())
        net.p[k][at] = before
        assert abs((values[0] - values[1]) / 2e-2 - g[k][at]) < 2e-2


def test_mixing_meets_its_targets(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = mixing.mixed(docs, repetition=2.0).collect()
    assert {r["doc_id"] for r in got} == {i for i, *_ in rows}
    tokens, weight = collections.Counter(), {}
    own = collections.Counter()
    for i, t, _, s in rows:
        own[s] += 1 + len(re.findall(r"[ \n\t\r]", t or ""))
    for r in got:
        tokens[r["source"]] += 1 + len(re.findall(r"[ \n\t\r]", r["text"] or ""))
        weight[r["source"]] = r["mix_weight"]
    assert abs(sum(weight.values()) - 1) < 1e-9
    passes = {s: weight[s] / own[s] for s in own}
    assert max(passes.values()) / min(passes.values()) <= 2.0 + 1e-6
    drawn = mixing.mixed(docs, entropy=1.2, repetition=None, budget=3000.0).collect()
    weight = {r["source"]: r["mix_weight"] for r in drawn}
    assert abs(-sum(w * math.log(w) for w in weight.values()) - 1.2) < 1e-3
    assert set(docs.columns) < set(mixing.mixed(docs).columns)


def test_mixing_is_native(spark, folder):
    plan = mixing.op8_mixing(spark, folder)._jdf.queryExecution().toString() + fingerprints.op1_fingerprints(spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def plain_features(stems, text):
    """The grammar's tags clause by clause, word by word, without automata."""
    g, out = toxicity.Grammar(stems), np.zeros(toxicity.FEATURES)
    anchors = sorted({*(s.rstrip("$") for s in stems), *toxicity.THREATS})
    for clause in re.split(r"[.!?;:\n]", (text or "").lower()):
        if not any(re.search(rf"(?<![^\W\d_]){re.escape(a)}", clause) for a in anchors):
            continue
        negated, reported, targeted, events = 0, False, False, 0.0
        for word in toxicity._WORD.findall(clause):
            kind, weight = g.symbol(word)
            targeted |= kind == toxicity.TARGET
            if kind in (toxicity.INSULT, toxicity.THREAT):
                out[(kind == toxicity.THREAT) * 4 + (negated > 0) * 2 + reported] += 1
                own = weight * (0.4 if negated else 1) * (0.5 if reported else 1)
                events, out[10] = events + own, max(out[10], own)
            negated = 3 if kind == toxicity.NEGATION else max(negated - 1, 0)
            reported |= kind == toxicity.REPORT
        if events:
            out[8] += targeted
            out[9] += events
    out[:10] = np.log1p(out[:10])
    return out


def test_scores_against_plain_clauses(spark, folder, rows):
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    stems, w = toxicity.train(docs, labels)
    got = by_id(toxicity.op2_toxicity(spark, folder))
    for i, t, *_ in rows:
        want = 1 / (1 + math.exp(-max(-30, min(30, float(plain_features(stems, t) @ w[:-1] + w[-1])))))
        assert abs(got[i]["score"] - want) < 1e-9 and got[i]["predicted"] == (want >= 0.3)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


@pytest.mark.parametrize("text", ["You idiot. He said he will kill you, never destroy loweibung", "not not not a b idiot; said idiot idiot", "idiot\nidiot you!", "IDIOT idiotic lowei loweiba", "I said no idiot, no one will kill them"])
def test_grammar_against_plain_clauses(text):
    stems = {"idiot$": 5.0, "loweib": 3.0}
    assert np.allclose(toxicity.Grammar(stems).features(text), plain_features(stems, text))


def test_each_transducer_changes_the_features():
    g = toxicity.Grammar({"idiot$": 5.0})
    texts = {"insult": ("idiot here", "nothing here"), "threat": ("I kill", "I sing"), "target": ("you idiot", "an idiot"), "negation": ("not idiot", "an idiot"), "report": ("said idiot", "an idiot")}
    for name, (a, b) in texts.items():
        assert not np.allclose(g.features(a), g.features(b)), name
    w = toxicity.UNTRAINED
    score = lambda t: float(g.features(t) @ w[:-1])
    assert score("you idiot") > score("an idiot") > score("said idiot") > score("not idiot") - 1 and score("I kill you") > score("I sing to you")


def test_null_ids_are_not_held_out(spark, tmp_path):
    spark.createDataFrame([(None, "some words here", "en"), (1, "some words here", "en"), (None, None, None)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (toxicity.op2_toxicity, langid.op6_language_id, katz.op3_katz):
        got = query(spark, str(tmp_path)).collect()
        assert len(got) == 3 and [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    got = fingerprints.op1_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == 3 and sorted(r["n_chars"] for r in got) == [0, 15, 15]


def test_languages_against_a_plain_forward_pass(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = langid.train(docs)
    got = by_id(langid.predicted(docs, net))
    for i, t, *_ in rows:
        if not re.search(r"[^\W\d_]", t or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), t.encode())
        logs = []
        for at in range(0, len(raw), langid.WINDOW):
            e = net.p["embed"][np.frombuffer(raw[at : at + langid.WINDOW].ljust(langid.WINDOW), np.uint8)].astype(float)
            pooled = []
            for w in langid.WIDTHS:
                r = np.stack([sum(e[k + j] @ net.p[f"filter{w}"][j] for j in range(w)) for k in range(langid.WINDOW - w + 1)])
                pooled.append(np.maximum(r.max(0) + net.p[f"bias{w}"], 0))
            z = np.concatenate(pooled) @ net.p["out"] + net.p["out_bias"]
            logs.append(z - np.log(np.exp(z).sum()))
            if len(logs) > 6:
                break
        if len(raw) > 6 * langid.WINDOW:
            continue
        p = np.exp(np.mean(logs, 0))
        p /= p.sum()
        assert got[i]["lang_pred"] == net.labels[int(p.argmax())] and abs(got[i]["score"] - p.max()) < 1e-4


def test_mixing_against_a_plain_budget(spark, folder, rows):
    """Exponent by bisection, weights by definition; every source fills its budget to within its last document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    n = {i: 1 + len(re.findall(r"[ \n\t\r]", t or "")) for i, t, *_ in rows}
    own, big = collections.Counter(), collections.Counter()
    for i, t, _, s in rows:
        own[s] += n[i]
        big[s] = max(big[s], n[i])
    total = sum(own.values())
    share = {s: v / total for s, v in own.items()}
    spread = lambda a: max(v ** (a - 1) for v in share.values()) / min(v ** (a - 1) for v in share.values())
    lo, hi = 0.0, 1.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if spread(mid) <= 2.0 else (mid, hi)
    z = sum(v**hi for v in share.values())
    passes = {s: v ** (hi - 1) / min(x ** (hi - 1) for x in share.values()) for s, v in share.items()}
    shown, seen = collections.Counter(), collections.Counter()
    for r in mixing.mixed(docs, repetition=2.0).collect():
        assert abs(r["mix_exponent"] - hi) < 1e-6 and abs(r["mix_weight"] - share[r["source"]] ** hi / z) < 1e-6
        shown[r["source"]] += n[r["doc_id"]]
        seen[r["doc_id"]] += 1
    for s in own:
        assert passes[s] * own[s] - 1e-3 <= shown[s] <= passes[s] * own[s] + big[s] + 1e-3
    for i, _, _, s in rows:
        if i != 500:  # two rows of one doc_id
            assert math.floor(passes[s] + 1e-6) <= seen[i] <= math.ceil(passes[s] - 1e-6)


def test_blocks_are_the_same_whatever_the_scan(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 3000)
    spark.read.parquet(f"{folder}/documents.parquet").repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    real = katz.stored

    def between(df, name, *rest):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k" if name == "counts" else before)  # other tasks than the scan before
        return real(df, name, *rest)

    monkeypatch.setattr(katz, "stored", between)
    try:
        for f in (folder, str(tmp_path)):
            seen.append({(r["doc_id"], r["n_tokens"]): round(r["score"], 9) for r in katz.op3_katz(spark, f).collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1]


def test_rows_of_one_id_with_other_texts_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "z y x w v u t"), (2, "a b c d e f g"), (3, "z y x w v u t")], "doc_id long, text string")
    got = near_dedup.deduplicated(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "a b c d e f g"), (1, "z y x w v u t")]
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == 4 and {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (3, 1)}


def test_recall_of_near_pairs_on_thousands(spark):
    """Edited copies at all degrees of likeness: every brute-force link is inside a component."""
    import random

    rng, texts = random.Random(8), []
    for f in range(40):
        base = [f"v{rng.randrange(5000)}" for _ in range(60)]
        for _ in range(50):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    sets = [set(zip(*(t.split()[k:] for k in range(3)))) for t in texts]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()}
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for f in range(40):
        for i in range(f * 50, f * 50 + 50):
            for j in range(f * 50, i):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    a, b = sorted((top(i), top(j)))
                    root[b] = a
    assert {i: top(i) for i in range(len(texts))} == got


def test_ngram_tables_agree_with_the_packed_model(spark, folder, rows, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    taught = docs.where("pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) <> 1")
    ngram_tables.save(ngram_tables.train(taught, 2), str(tmp_path / "model"))
    got = {(r["doc_id"], r["text"]): r for r in ngram_tables.scored(docs, ngram_tables.load(spark, str(tmp_path / "model"), 2)).collect()}
    for r in katz.op3_katz(spark, folder).collect():
        own = next(v for (i, _), v in got.items() if i == r["doc_id"])
        assert own["n_tokens"] == r["n_tokens"] and abs(own["score"] - r["score"]) < 1e-6 * max(1, abs(r["score"]))


def test_longer_contexts_are_normalised(spark):
    """Order 3: after every context the probabilities of all words and one unknown word sum to one."""
    docs = spark.createDataFrame([("a b c a b d",), ("a b c",), ("b c a",), (None,), ("c a b c",)], "text string")
    model = ngram_tables.train(docs, 3)
    grams, alphas, facts = ([{(r["context"], r["word"]): r["p"] for r in t.collect()} for t in model[0]], [{r["context"]: r["alpha"] for r in t.collect()} for t in model[1]], model[2])

    def p(context, word):
        if not context:
            return grams[0].get(("", word), facts["unseen"])
        h = " ".join(context)
        return grams[len(context)].get((h, word)) or alphas[len(context) - 1].get(h, 1.0) * p(context[1:], word)

    every = ["a", "b", "c", "d", "", "unknown"]
    for context in [(), ("a",), ("b",), ("a", "b"), ("b", "c"), ("", ""), ("", "a"), ("z", "a")]:
        assert abs(sum(p(context, w) for w in every) - 1) < 1e-9
    got = ngram_tables.scored(spark.createDataFrame([("a b zz",)], "text string"), model).first()
    want = [p(("", ""), "a"), p(("", "a"), "b"), p(("a", "b"), "zz"), p(("b", "zz"), "")]
    assert got["n_tokens"] == 4 and abs(got["score"] - sum(map(math.log10, want))) < 1e-9


def test_large_components_are_exact(spark):
    """Products of large components, whose sums pass 2**53 and whose bounds pass 2**62."""
    rng = np.random.default_rng(6)
    v = rng.integers(-300_000, 300_000, (600, 8)).astype(float)
    v[7] *= 10
    rows = topk.integer_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(rows, rows.where("vec_id % 200 = 7"), 5, shard=256).collect()}
    exact = [[int(c) * 1024 for c in x] for x in v]
    for q in (7, 207, 407):
        want = sorted((-sum(a * b for a, b in zip(exact[q], exact[i])), i) for i in range(600) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in want]


def test_a_block_that_all_queries_prefer(spark):
    """One block of long vectors is most promising to every query; its queries meet it in slices."""
    rng = np.random.default_rng(8)
    v = rng.normal(0, 1, (900, 6))
    v[:250] *= 50
    rows = topk.integer_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in topk.top_k(rows, rows.where("vec_id % 3 = 0"), 3, shard=256, per_block=40).collect()}
    whole = np.floor(v * 1024).astype(np.int64)
    for q in range(0, 900, 3):
        s = whole @ whole[q]
        s[q] = -(1 << 62)
        assert [got[q, k + 1] for k in range(3)] == sorted(range(900), key=lambda i: (-s[i], i))[:3]


def test_equal_rows_are_dealt_to_all_shards(spark):
    """4,000 equal pieces: no shard gets much more than its share."""
    parts = spark.range(4000, numPartitions=6).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    got = packing.pack(parts, 100, 8).collect()
    assert len(got) == 4000 and len({r["sequence_id"] for r in got}) <= 40 + 8
    assert collections.Counter(r["sequence_id"] % 8 for r in got).keys() == set(range(8))
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 4000


def test_packing_opens_a_sequence_only_where_none_has_room():
    lengths = np.sort(np.random.default_rng(4).integers(1, 1000, 3000))[::-1]
    where, offset = packing.sum_of_squares(lengths, 1000, sparing=True)
    load = {}
    for w, a, n in zip(where.tolist(), offset.tolist(), lengths.tolist()):
        if w not in load:
            assert all(x + n > 1000 for x in load.values())
        assert load.get(w, 0) == a
        load[w] = a + n
    assert max(load.values()) <= 1000 and len(load) <= 1.02 * lengths.sum() / 1000


def test_many_null_ids_are_mixed_like_others(spark):
    """4,000 rows without an id: their slots are spread, every row is shown once or twice."""
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"), F.lit("s").alias("source"))
    got = mixing.mixed(docs, repetition=2.0).groupBy("mix_slot").count().collect()
    assert sum(r["count"] for r in got) == 4000 and len(got) == 8 and max(r["count"] for r in got) < 600  # a slot for each of eight blocks


def test_a_long_text_is_cut_into_segments_in_stretches():
    """The windows and their choices are those of the whole text, whatever the stretch."""
    data = np.frombuffer(np.random.default_rng(2).integers(97, 100, 5000, np.uint8).tobytes(), np.uint8)
    expand = lambda parts: {(int(a) + i): int(h) for _, a, c, h, _ in zip(*parts) for i in range(int(c))}
    whole = expand(long_matches.segments(data, np.array([0, len(data)]), 200, 80))
    assert len(whole) == 4801
    for most in (200, 777, 4999):
        assert expand(long_matches.segments(data, np.array([0, len(data)]), 200, 80, most)) == whole
