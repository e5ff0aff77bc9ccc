"""Small tables with the awkward cases: nulls, empty and long texts, copies, ties, extra columns with clashing names."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component long, block int"


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(11)
    base = [words(rng, 60) for _ in range(30)]
    passage = words(rng, 70, 10**6)
    out = [(0, None, None, None), (1, "", "en", "a"), (2, "One two", "en", "a"), (3, "   ", "fr", None), (4, "solo", "en", "b")]
    for i, t in enumerate(base):
        out.append((10 + i, t, ("en", "fr")[i % 2], f"s{i % 3}"))
    for i in range(8):  # near copies: a few words replaced
        w = base[0].split()
        w[5 + i] = "changed"
        out.append((100 + i, " ".join(w), "en", "s0"))
    out += [(200 + i, base[1], "fr", "s1") for i in range(5)]  # exact copies
    out += [(300 + i, f"{words(rng, 30)} {passage} {words(rng, 20)}", "en", "s2") for i in range(4)]
    out.append((400, words(rng, 9000), "en", "s0"))
    out.append((401, "Été  naïve\tﬁne ß İ 中文 <|endoftext|> it's  \n\n x", "fr", "s1"))
    out.append((402, "abc " * 300, "en", "s1"))
    out += [(500, "same row " * 40, "en", "s0")] * 2
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 0.5, i, 1) for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="session")
def folder(docs, spark, tmp_path_factory):
    """The same as a folder of tables, as queries read it."""
    place = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(10 + i, 1, int(i % 4 == 0)) for i in range(30)] + [(9999, 1, 1), (11, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return str(place)


@pytest.fixture(scope="session")
def empty_folder(docs, spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("empty")
    docs.limit(0).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{place}/embeddings.parquet")
    return str(place)
