"""Sharding, periodic runs and the Merkle manifest against brute force on small tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle
from tetraframe.llm import merkle, periodic, sharding

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, _key int, _place string, _task int, number int"


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.fixture(scope="module")
def awkward(spark):
    """Null ids, texts and groups, repeated rows, repeated ids, a hot row, names that clash with the operators' own."""
    rows = [(None, "x Y", None, None, None, 1, "p", 2, 3), (None, "x Y", None, None, None, 1, "p", 2, 3), (7, None, "de", "s", 0, 1, "p", 2, 3), (7, "B", "de", "s", 1, 1, "p", 2, 3), (7, "", "é", "s", 0, 1, "p", 2, 3)]
    rows += [(1000 + i, f"Text {i} " * (i % 7), ("en", "fr", None, "zz", "z", "ab", "ac", "ad", "ae", "af")[i % 10], "s", i, i, "q", 0, 0) for i in range(300)]
    rows += [(5, "copied row", "en", "s", 10, 0, "q", 0, 0)] * 200
    return spark.createDataFrame(rows, AWKWARD).repartition(5)


# --- sharding ---------------------------------------------------------------------------------------------------


def test_shards_hold_every_row_once(spark, folder, rows):
    got = sharding.op11_sharding(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, *_ in rows)
    texts = {i: t or "" for i, t, *_ in rows}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 8, zlib.crc32(texts[r["doc_id"]].encode())) for r in got)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(24))
    counts = [len(slots[i]) for i in range(24)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("shards", [1, 7, 24, 1000])
def test_counts_are_even_for_any_number_of_shards(awkward, shards):
    got = sharding.sharded(awkward, shards, bucket_bytes=600).collect()
    counts = collections.Counter(r["shard"] for r in got)
    assert len(got) == awkward.count() and max(counts.values()) - (min(counts.values()) if len(counts) == shards else 0) <= 1
    assert sorted(map(repr, (r[:-2] for r in got))) == sorted(map(repr, map(tuple, awkward.collect())))


def test_order_depends_on_rows_and_seed_alone(spark, awkward):
    order = lambda df, **kw: [r[:-2] for r in sorted(sharding.sharded(df, 3, **kw).collect(), key=lambda r: (r["shard"], r["slot"]))]
    unique = awkward.dropDuplicates()
    first = order(unique, bucket_bytes=500)
    assert order(unique.repartition(11), bucket_bytes=500) == first
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert order(unique.coalesce(1), bucket_bytes=500) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert order(unique, bucket_bytes=500, seed=18) != first


def test_bucket_is_a_fisher_yates_permutation(spark, awkward):
    """One bucket: rows by content key, then the seeded permutation."""
    unique = awkward.dropDuplicates()
    names = unique.columns
    keyed = unique.select(sharding.content_key(unique, 17).alias("k"), *(F.col(n).alias(f"c{i}") for i, n in enumerate(names))).collect()
    by_key = [tuple(r)[1:] for r in sorted(keyed, key=lambda r: r["k"])]
    want = [by_key[i] for i in sharding.fisher_yates(len(by_key), 17, 0)]
    got = sharding.sharded(unique, 1, bucket_bytes=1 << 30).orderBy("slot").collect()
    assert [tuple(r)[:-2] for r in got] == want
    # every order of three rows comes about equally often
    orders = collections.Counter(tuple(sharding.fisher_yates(3, s, 5)) for s in range(3000))
    assert len(orders) == 6 and all(400 < n < 600 for n in orders.values())


def test_copies_of_one_row_are_spread_over_tasks(spark, awkward):
    rows, _ = sharding.shuffled(awkward, bucket_bytes=200)
    copies = rows.where("_c1 = 'copied row'").groupBy("_task").count().collect()
    total = rows.select("_task").distinct().count()
    assert len(copies) == total > 1 and max(r["count"] for r in copies) < 200 * 2 / total


def test_neighbours_part(spark):
    """Rows that stood side by side are in no relation afterwards: the places of pairs differ as random ones do."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    place = {r["doc_id"]: r["shard"] * 100 + r["slot"] for r in sharding.sharded(df, 40, bucket_bytes=4000).collect()}
    gaps = [abs(place[i] - place[i + 1]) for i in range(3999)]
    assert abs(np.mean(gaps) / (4000 / 3) - 1) < 0.06 and sum(g == 1 for g in gaps) < 20


def test_written_shards_are_read_back(spark, awkward, tmp_path):
    rows = sharding.sharded(awkward, 4, bucket_bytes=800)
    sharding.write_shards(rows, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))


def test_clashing_names_are_refused_or_renamed(spark):
    df = spark.createDataFrame([(1, "a", 5)], "doc_id long, text string, shard int")
    with pytest.raises(ValueError, match="other names"):
        sharding.sharded(df, 2)
    assert sharding.sharded(df, 2, names=("part", "place")).first() == (1, "a", 5, 0, 0)


# --- periodic runs ----------------------------------------------------------------------------------------------


def runs_by_loops(words):
    """Every maximal stretch of period q, long enough, whose smallest period is q."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_by_loops(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def some_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        kinds = rng.choice([1, 2, 3, 5, 30])
        words = []
        while len(words) < rng.choice([10, 24, 60, 150]):
            if rng.random() < 0.5:
                unit = [f"w{rng.randrange(kinds)}" for _ in range(rng.choice([1, 2, 3, 4, 7, 8, 9, 12, 17, 25]))]
                words += unit * rng.choice([1, 2, 3, 4, 9]) + unit[: rng.randrange(len(unit) + 1)]
            else:
                words += [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 9))]
        yield [w.encode() for w in words]


def test_runs_equal_plain_loops():
    seen = 0
    for words in some_texts(3, 400):
        got = periodic.runs_of(words)
        assert got == runs_by_loops(words), words
        assert periodic.collapsed(words, got) == kept_by_loops(words, got)
        seen += len(got)
    assert seen > 200


def test_runs_of_every_short_text_of_two_words():
    """All texts of 11 to 12 units over two words, repeated so that they are long enough."""
    for unit in itertools.product([b"a", b"b"], repeat=6):
        for tail in ([], [b"c"], list(unit[:3])):
            words = list(unit) * 5 + tail + list(unit[::-1]) * 4
            assert periodic.runs_of(words) == runs_by_loops(words)


def test_only_lags_that_hold_a_run_may_be_missing():
    """A lag that the grams leave out has no stretch at all."""
    for words in some_texts(8, 120):
        ids, n = periodic.numbers(words), len(words)
        tried, planes = set(periodic.lags(ids)), periodic.bit_planes(ids)
        smallest = {q for _, _, q in runs_by_loops(words)}
        assert smallest <= tried
        for lag in range(1, n // 3 + 1):
            if len(periodic.stretches(planes, n, lag)):
                assert any(lag % q == 0 for q in smallest)


def test_long_texts(spark):
    """A period of a third of a long text, one word two million times, and a long text without any run."""
    rng = random.Random(5)
    unit = [b"%d" % rng.randrange(10**6) for _ in range(100_000)]
    assert periodic.runs_of([b"x", *unit * 3, b"y"]) == [(1, 300_000, 100_000)]
    assert periodic.runs_of([b"a"] * 2_000_000) == [(0, 2_000_000, 1)]
    assert periodic.runs_of([b"%d" % rng.randrange(50_000) for _ in range(500_000)]) == []
    assert periodic.runs_of(unit * 2) == [] and periodic.runs_of([]) == [] and periodic.runs_of([b"a"] * 23) == []


def rewritten(i, text):
    words = split(text)
    h = zlib.crc32(str(i).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def test_periodic_query(spark, folder, rows, docs):
    more = docs.where("doc_id = 400").select(F.explode(F.sequence(F.lit(5000), F.lit(5060))).alias("doc_id"), F.substring("text", 1, 2000).alias("text"))
    place = folder + "-runs"
    docs.select("doc_id", "text").unionByName(more).write.mode("overwrite").parquet(f"{place}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{place}/documents.parquet").collect()]
    want = []
    for i, text in texts:
        words = rewritten(i, text)
        runs = runs_by_loops(words) if len(words) < 2000 else periodic.runs_of([w.encode() for w in words])
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha(lines), sha(" ".join(kept_by_loops(words, runs)))))
    got = periodic.op12_periodic_runs(spark, place)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(w[1] > 0 for w in want) > 5


def test_equal_strength_prefers_the_first():
    assert periodic.strongest([(0, 24, 8), (40, 24, 8), (90, 27, 9)]) == (0, 24, 8)
    assert periodic.strongest([(5, 60, 20), (5, 30, 10), (70, 31, 10)]) == (70, 31, 10)
    assert periodic.strongest([(5, 60, 20), (5, 30, 10)]) == (5, 30, 10) and periodic.strongest([]) is None


def test_runs_keep_other_columns(spark, awkward):
    got = periodic.detected(awkward)
    assert got.columns == [*awkward.columns, "_runs", "_best", "_collapsed"] and got.count() == awkward.count()
    with pytest.raises(ValueError, match="prefix"):
        periodic.detected(got)
    assert "r_runs" in periodic.detected(got, prefix="r_").columns
    assert got.where("text IS NULL").select("_runs", "_best", "_collapsed").first() == ([], None, "")


# --- Merkle manifest --------------------------------------------------------------------------------------------


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves):
    """The root and, for each leaf, its path of (before, after)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i // 8 * 8
            paths[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])))
            at[k] = i // 8
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def manifest_of(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    low = lambda t: t and re.sub("[A-Z]", lambda m: m.group().lower(), t)
    groups = collections.defaultdict(list)
    for i, source, lang, n, text in rows:
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        original = leaf_of(i, source, lang, n, text)
        groups[lang].append((i is not None, i or 0, original, leaf_of(i, source, lang, n, low(text)) if tampered else original))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inside = {g: tree_of([x[2] for x in sorted(groups[g])]) for g in order}
    root, across = tree_of([inside[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for (known, i, original, start), path in zip(sorted(groups[g]), inside[g][1]):
            path = path + across[k]
            node = start
            for before, after in path:
                node = sha(before + node + after)
            out.append((i if known else None, original, inside[g][0], root, sha("".join(b + a for b, a in path)), node, node == root))
    return sorted(map(repr, out))


def merkle_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_merkle_query(spark, folder, docs):
    got = merkle.op13_merkle(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == manifest_of(merkle_rows(docs))
    tables = oracle("/root/testdata/sf0.001")
    tables.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert difference(got.toArrow(), tables.sql(merkle.OP13_SQL).to_arrow_table()) == ""


def test_merkle_of_awkward_rows(spark, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op13_merkle(spark, str(tmp_path))
    want = manifest_of(merkle_rows(awkward))
    assert sorted(map(repr, map(tuple, got.collect()))) == want
    tables = oracle("/root/testdata/sf0.001")
    tables.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(map(repr, tables.sql(merkle.OP13_SQL).fetchall())) == want


@pytest.mark.parametrize("n", [1, 8, 65, 520])
def test_merkle_of_one_group(spark, n):
    """One group, so the root of the groups is its own; counts about the powers of the fanout."""
    rows = [(i, "s", "en", i, f"T{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(df).collect()
    root, paths = tree_of([leaf_of(*r) for r in rows])
    assert {(r["subroot"], r["root"]) for r in got} == {(root, root)}
    assert {r["doc_id"]: [(x["before"], x["after"]) for x in r["path"]] for r in got} == dict(enumerate(paths))


def test_any_change_leads_to_another_root(spark):
    rows = [(i, "s", "en" if i % 3 else None, i, f"T{i}") for i in range(40)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    root = lambda x: merkle.manifest(spark.createDataFrame(x, schema)).select("root").distinct().collect()
    base = root(rows)
    assert len(base) == 1 and root(rows[::-1]) == base
    for changed in (rows[:-1], [*rows, rows[-1]], [(*rows[0][:4], "t0"), *rows[1:]], [(*rows[0][:3], None, "T0"), *rows[1:]], [(0, None, None, 0, "T0"), *rows[1:]]):
        assert root(changed) != base


def test_other_fields_groups_and_fanouts(spark, awkward):
    got = merkle.manifest(awkward, fields=("text", "_place"), by="source", key="number", fanout=3)
    assert got.columns == ["number", "leaf", "subroot", "root", "path"] and got.count() == awkward.count()
    assert got.select(merkle.folded(F.col("leaf"), F.col("path")).alias("r"), "root").where("r <> root").count() == 0
