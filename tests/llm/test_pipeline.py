"""The pipeline's stages against what they promise."""

import corpus_pipeline
from tetraframe.llm import near_dedup


def test_stages(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "mixing", "packing"]
    kept = {r["doc_id"] for r in seen["near_dedup"]}
    assert 11 in kept and not kept & {200, 201, 202, 203, 204} and not kept & set(range(101, 108))
    texts = {r["doc_id"]: r for r in seen["suffix_dedup"]}
    assert all(texts[300 + k]["n_chars"] == len(texts[300 + k]["text"]) < len(next(t for i, t, *_ in rows if i == 300 + k)) for k in range(4))
    assert {r["doc_id"] for r in seen["mixing"]} == set(texts)
    assert {r["doc_id"] for r in seen["packing"]} == set(texts)


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_nulls_and_repeated_rows_survive_dedup(spark, folder):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = near_dedup.deduplicated(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "None", "None"]


def test_stages_against_brute_force(spark, folder, rows):
    """Every stage against a plain version of it, on what the stage before kept."""
    import re
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from tests.llm.test_operators import plain_features, split
    from tetraframe.llm import toxicity
    from tetraframe.llm.token_counts import vocabulary

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    stems, w = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = corpus_pipeline.toxicity(spark, docs, folder)
    now = [r for r in docs.collect() if 1 / (1 + np.exp(-(plain_features(stems, r["text"]) @ w[:-1] + w[-1]))) < 0.3]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, now))

    kept, sets, root = corpus_pipeline.near_dedup(spark, kept, folder), {}, {}
    for r in now:
        words = split(r["text"])
        sets[r["doc_id"]] = set(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else ({tuple(words)} if words else set())
        root[r["doc_id"]] = r["doc_id"]

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    now = list({r["doc_id"]: r for r in now if top(r["doc_id"]) == r["doc_id"]}.values())
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, now))

    kept = corpus_pipeline.suffix_dedup(spark, kept, folder)
    raw, count = {r["doc_id"]: (r["text"] or "").encode() for r in now}, {}
    for d in raw.values():
        for a in range(len(d) - 199):
            count[d[a : a + 200]] = count.get(d[a : a + 200], 0) + 1
    texts = {}
    for i, d in raw.items():
        gone = np.zeros(len(d), bool)
        for a in range(len(d) - 199):
            if count[d[a : a + 200]] > 1:
                gone[a : a + 200] = True
        left = bytes(c for c, g in zip(d, gone) if not g).decode("utf-8", "ignore")
        if left or not gone.any():
            texts[i] = left
    found = {r["doc_id"]: r for r in kept.collect()}
    assert {i: r["text"] or "" for i, r in found.items()} == texts and all(r["n_chars"] == len(texts[i]) for i, r in found.items() if r["text"] is not None)

    mixed = corpus_pipeline.mixing(spark, kept, folder)
    shown = mixed.collect()
    assert {r["doc_id"] for r in shown} == set(texts) and all(r == found[r["doc_id"]] for r in shown)

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want, bins = [], {}
    for r in shown:
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r["doc_id"], k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    parts = corpus_pipeline.packing(spark, mixed, folder).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in parts) == sorted(want)
    for r in parts:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        assert sorted(b) == [(sum(n for _, n in sorted(b)[:k]), n) for k, (_, n) in enumerate(sorted(b))] and sum(n for _, n in b) <= 2048
    assert re.match("toxicity", corpus_pipeline.STAGES[0][0])


def test_stages_on_empty_and_clashing_tables(spark, empty_folder):
    empty = spark.read.parquet(f"{empty_folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, empty_folder).count() == 0, name
    names = ["_t1", "_t2", "_toxic", "_toxic_score", "_id", "_k1", "_marks", "_kept", "_n_removed", "_key", "_copy", "TEXT", "component"]
    clash = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11, *range(13)), (2, "g h i j k l", "en", "s", 11, *range(20, 33))], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, clash, empty_folder)
        assert got.columns == clash.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, clash.collect())), name
    assert corpus_pipeline.packing(spark, clash, empty_folder).count() == 2
    odd = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11, 0.5, 3, 7), (1, "a b c d e f", "en", "s", 11, 0.5, 3, 7), (2, None, None, None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long, score double, component long, n int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, empty_folder)
        assert got.columns == odd.columns and {r["doc_id"] for r in got.collect()} == {1, 2}, name


def test_near_dedup_meets_a_group_once(spark, monkeypatch):
    """Copies just below the bound: rows that go to meetings are no more than the documents."""
    import random

    rng, met, sent = random.Random(5), near_dedup.met, []

    def counted(rows, *size):
        out = met(rows, *size)
        sent.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "met", counted)
    texts = []
    for _ in range(100):
        w = [f"v{k}" for k in range(140)]
        for at in rng.sample(range(140), rng.randrange(2, 7)):
            w[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, "").count()
    assert 1 <= kept < len(texts) and len(sent) == 2 and max(sent) <= len(texts), (kept, sent)


def test_components_leave_the_driver_few_queries(spark, monkeypatch):
    """A chain and pairs: a round over all edges, then one task for a bounded rest; the same as by rounds alone."""
    import random

    rng, write, wrote = random.Random(6), near_dedup.stored, []

    def counted(df, name, *by):
        wrote.append(name)
        return write(df, name, *by)

    monkeypatch.setattr(near_dedup, "stored", counted)
    ids = rng.sample(range(1, 10**6), 600)
    chain, pairs = ids[:400], list(zip(ids[400::2], ids[401::2]))
    edges = spark.createDataFrame([rng.choice([(a, b), (b, a)]) for a, b in [*zip(chain, chain[1:]), *pairs]], "a long, b long").repartition(3)
    want = {i: min(chain) for i in chain} | {i: min(p) for p in pairs for i in p}
    assert {r["id"]: r["component"] for r in near_dedup.components(edges).collect()} == want
    assert wrote == ["edges", "hops", "edges", "hops", "labels"], wrote
    for rest in (0, 100):  # other sizes of the rest: more rounds
        monkeypatch.setattr(near_dedup, "REST", rest)
        assert {r["id"]: r["component"] for r in near_dedup.components(edges).collect()} == want, rest
    assert near_dedup.components(edges.limit(0)).count() == 0


def test_toxicity_leaves_the_driver_its_memory(spark, folder, monkeypatch):
    """What training took is handed back before documents are scored."""
    from tetraframe.llm import toxicity

    steps, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *x: (train(*x), steps.append("train"))[0])
    monkeypatch.setattr(toxicity, "hand_back", lambda: steps.append("hand back"), raising=False)
    corpus_pipeline.toxicity(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert steps == ["train", "hand back"]
