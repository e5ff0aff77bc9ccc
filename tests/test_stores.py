"""Pages, chunks and containers: codecs by hand, files of any size, what a failed job leaves."""

import io
import os
import resource
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from tetraframe.sources import array_store as st
from tetraframe.sources import container_source as ct
from tetraframe.sources import hdf5
from tetraframe.sources import tiff
from tetraframe.sources import tiff_source as ts
from tetraframe.sources.stores import listed, located


def voxels(spark, a):
    """(t, z, y, x, value) of an array of 4 axes; zeros are left out."""
    at = np.argwhere(a)
    return spark.createDataFrame([(*map(int, p), float(a[tuple(p)])) for p in at], "t int, z int, y int, x int, value double")


def dense(rows, shape):
    p = rows.toPandas()
    out = np.full(shape, np.nan)
    out[p["t"], p["z"], p["y"], p["x"]] = p["value"]
    assert len(p) == out.size
    return out


@pytest.fixture(scope="module")
def numbers():
    return np.random.default_rng(5).integers(0, 3000, (2, 3, 7, 9)) * (np.random.default_rng(6).random((2, 3, 7, 9)) < 0.6)


# --- pages -------------------------------------------------------------------------------------------------------


@given(hs.one_of(hs.binary(max_size=3000), hs.lists(hs.sampled_from(b"ab"), max_size=9000).map(bytes), hs.integers(0, 60_000).map(bytes)))
@settings(max_examples=60, deadline=None)
def test_lzw_round_trip(data):
    assert tiff.unlzw(tiff.lzw(data)) == data


def test_lzw_by_hand():
    """Nine bytes worked out by hand: clear, 7, 258, 8, 8, 258, 6, 6, end, nine bits each."""
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    raw = int("".join(f"{c:09b}" for c in codes).ljust(88, "0"), 2).to_bytes(11, "big")
    assert tiff.unlzw(raw) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6]) and tiff.lzw(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == raw


def test_lzw_tables_start_anew():
    data = np.random.default_rng(1).integers(0, 256, 200_000, np.uint8).tobytes()
    assert tiff.unlzw(tiff.lzw(data)) == data


@pytest.mark.parametrize("kind", ["<u1", "<u2", "<i2", "<u4", "<f4", "<f8"])
@pytest.mark.parametrize("compression", ["none", "lzw", "zlib"])
@pytest.mark.parametrize("predictor", [False, True])
def test_pages_round_trip(kind, compression, predictor):
    if predictor and kind[1] == "f":
        pytest.skip("differences are for whole numbers")
    pages = [np.random.default_rng(k).integers(0, 200, (5, 7)).astype(kind) for k in range(3)]
    p = tiff.Pages(io.BytesIO(tiff.file_of_pages(iter(pages), compression, predictor, "slices=3\nspacing=2.0\n", (26738, 1, 3))))
    assert (p.count, p.depth) == (3, 3) and all((p.pixels(k) == pages[k]).all() for k in range(3))
    assert tiff.described(p.head[tiff.DESCRIPTION]) == {"slices": "3", "spacing": "2.0"} and p.head[tiff.X_RES][0] / p.head[tiff.X_RES][1] == 26738


def classic(order, tags, data):
    """A file of one directory with 32-bit offsets behind its data, which stand at 8."""
    words = lambda t, k, n, v: struct.pack(order + "HHI", t, k, n) + (struct.pack(order + "H2x", v) if k == 3 and n == 1 else struct.pack(order + "I", v))
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 8 + len(data))
    return head + data + struct.pack(order + "H", len(tags)) + b"".join(words(*t) for t in tags) + b"\0\0\0\0"


def test_pages_that_follow_one_directory():
    """Big-endian pages behind one directory that names three images; packed they are refused."""
    a = np.random.default_rng(2).integers(0, 65535, (3, 5, 7))
    text = b"images=3\nslices=3\n\0"
    data = a.astype(">u2").tobytes() + text
    tags = lambda packing: [(256, 3, 1, 7), (257, 3, 1, 5), (258, 3, 1, 16), (259, 3, 1, packing), (270, 2, len(text), 8 + a.size * 2), (273, 4, 1, 8), (279, 4, 1, 70)]
    p = tiff.Pages(io.BytesIO(classic(">", tags(1), data)))
    assert p.count == p.depth == 3 and all((p.pixels(k) == a[k]).all() for k in range(3))
    with pytest.raises(ValueError, match="plain pages"):
        tiff.Pages(io.BytesIO(classic(">", tags(8), data)))


def test_tiles_strips_and_what_is_not_read():
    a = np.arange(6 * 10, dtype="<u2").reshape(6, 10)
    tiles = [np.pad(a, ((0, 2), (0, 2)))[y : y + 4, x : x + 4] for y in (0, 4) for x in (0, 4, 8)]
    offsets = struct.pack("<6I", *(8 + 32 * k for k in range(6))) + struct.pack("<6I", *[32] * 6)
    data = b"".join(t.tobytes() for t in tiles)
    tags = [(256, 3, 1, 10), (257, 3, 1, 6), (258, 3, 1, 16), (259, 3, 1, 1), (322, 3, 1, 4), (323, 3, 1, 4), (324, 4, 6, 8 + len(data)), (325, 4, 6, 32 + len(data))]
    assert (tiff.Pages(io.BytesIO(classic("<", tags, data + offsets))).pixels(0) == a).all()
    strips = a.tobytes() + struct.pack("<6I", 8, 8 + 40, 8 + 80, 40, 40, 40)
    tags = [(256, 3, 1, 10), (257, 3, 1, 6), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 3, 8 + 120), (278, 3, 1, 2), (279, 4, 3, 20 + 120)]
    assert (tiff.Pages(io.BytesIO(classic("<", tags, strips))).pixels(0) == a).all()
    with pytest.raises(ValueError, match="compression 7"):
        tiff.Pages(io.BytesIO(classic("<", [(t, k, n, 7 if t == 259 else v) for t, k, n, v in tags], strips))).pixels(0)
    with pytest.raises(ValueError, match="not a TIFF"):
        tiff.Pages(io.BytesIO(b"PK" + bytes(20)))


@pytest.mark.parametrize("layout", ["stack", "volumes"])
def test_written_pages_come_back(spark, tmp_path, numbers, layout):
    """Slices and time points that hold nothing are zero; shares of a file's pages are read apart."""
    a = numbers.copy()
    a[0, 1] = 0
    ts.write_tiff(voxels(spark, a), str(tmp_path / "out"), layout, shape=(4, 7, 9), voxel_um=(2.0, 0.5, 0.25))
    files = sorted(os.listdir(tmp_path / "out"))
    assert files == (["hyperstack.tif"] if layout == "stack" else ["t0000_Channel 1.tif", "t0001_Channel 1.tif"])
    rows = ts.scan_tiff(spark, str(tmp_path / "out"), ("path", "t", "z", "y", "x", "value"), 200)
    if layout == "volumes":
        rows = rows.withColumn("t", F.regexp_extract("path", r"t(\d{4})_", 1).cast("int"))
    assert rows.rdd.getNumPartitions() > 2
    assert (dense(rows, (2, 4, 7, 9)) == np.concatenate([a, np.zeros((2, 1, 7, 9))], axis=1)).all()
    if layout == "stack":
        plan = rows.where("t = 1 AND z > 2 AND value > 5")._jdf.queryExecution().executedPlan().toString()
        assert "value" in plan.split("Filter")[1].split("\n")[0] and "z#" not in plan.split("Filter")[1].split("\n")[0]
        assert rows.where("t = 1 AND z = 2").count() == 63 and rows.where("t >= 2").count() == 0


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    """2.3 GB of pages in a sparse file: two of them are written, all are counted, a task reads the pages it is asked for."""
    ny, nx, pages = 1024, 1152, 980
    text = f"ImageJ=1.11a\nimages={pages}\nslices=98\nframes=10\n".encode() + b"\0"
    directory = struct.pack("<Q", 7) + b"".join(struct.pack("<HHQQ", *e) for e in [(256, 4, 1, nx), (257, 4, 1, ny), (258, 3, 1, 16), (259, 3, 1, 1), (270, 2, len(text), 300), (273, 16, 1, 4096), (279, 16, 1, ny * nx * 2)]) + bytes(8)
    path = tmp_path / "large.tif"
    with open(path, "wb") as f:
        f.write(tiff.HEADER + directory)
        f.seek(300)
        f.write(text)
        for page in (0, 979):
            f.seek(4096 + page * ny * nx * 2)
            f.write(np.full((ny, nx), page + 7, "<u2").tobytes())
    assert os.path.getsize(path) > 2 << 30
    rows = ts.scan_tiff(spark, str(path), ("t", "z", "value"))
    assert ts.scan_tiff_tags(spark, str(path)).first()["pages"] == pages
    last = rows.where("t = 9 AND z = 97").agg(F.count("*"), F.min("value"), F.max("value")).first()
    assert tuple(last) == (ny * nx, 986.0, 986.0)
    own = rows.where("z = 97").groupBy("t").agg(F.sum("value").alias("v")).orderBy("t").collect()
    assert [r["v"] for r in own] == [0.0] * 9 + [986.0 * ny * nx]
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss < 4 << 20  # KB; no child held the file twice


def test_a_failed_job_leaves_no_file(spark, tmp_path, numbers):
    ts.register(spark)
    rows = spark.createDataFrame([("a.tif", 16, 0, True, 2, 2, bytearray(8))], "file string, at long, after long, first boolean, ny int, nx int, data binary")
    save = lambda df, pages: df.write.format("tiff").mode("append").option("kind", "<u2").option("compression", "none").option("predictor", "false").option("description", "x").option("pages", pages).save(str(tmp_path / "out"))
    with pytest.raises(Exception, match="lack pages"):
        save(rows, 2)
    assert os.listdir(tmp_path / "out") == []
    with pytest.raises(Exception):  # noqa: B017
        save(rows.union(rows.withColumn("data", F.lit(None).cast("binary"))), 2)
    assert os.listdir(tmp_path / "out") == []
    save(rows, 1)
    assert os.listdir(tmp_path / "out") == ["a.tif"]


def test_addresses(tmp_path):
    (tmp_path / "a.tif").write_bytes(b"1")
    (tmp_path / ".hidden.tif").write_bytes(b"1")
    (tmp_path / "b.txt").write_bytes(b"22")
    for address in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert [(p.rsplit("/", 1)[1], n) for p, n in listed(address, (".tif",))] == [("a.tif", 1)]
        assert [n for _, n in listed(f"{address}/b.*")] == [2]
        assert located(f"{address}/a.tif")[1] == f"{tmp_path}/a.tif"


# --- chunks ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("layout", "codec", "form"), [("array", "zstd", 3), ("array", "none", 2), ("group", "gzip", 3), ("group", "zlib", 2), ("folder", "none", 3)])
def test_chunks_come_back(spark, tmp_path, numbers, layout, codec, form):
    path = str(tmp_path / "store")
    st.write_array_store(voxels(spark, numbers), path, layout, (2, 4, 5), codec=codec, form=form)
    rows = st.scan_array_store(spark, path)
    assert (dense(rows, numbers.shape) == numbers).all() and dict(rows.dtypes)["value"] == "bigint"
    few = st.scan_array_store(spark, path, 1).where("t = 1 AND z = 0 AND y < 4 AND x IN (0, 8)")
    assert few.rdd.getNumPartitions() == 2  # of 2 x 2 x 2 x 2 chunks
    assert {(r["y"], r["x"], r["value"]) for r in few.collect()} == {(y, x, numbers[1, 0, y, x]) for y in range(4) for x in (0, 8)}
    assert st.scan_array_store(spark, path).where("t = 7").count() == 0


def test_names_of_time_points_are_numbers(spark, tmp_path, numbers):
    """Children 2 and 10 are time points 0 and 1; floating values stay so."""
    path = tmp_path / "store"
    st.write_array_store(voxels(spark, numbers).withColumn("value", F.col("value") / 4), str(path), "folder", (2, 4, 5), "float32")
    os.rename(path / "1", path / "10")
    os.rename(path / "0", path / "2")
    (path / "notes").mkdir()
    rows = st.scan_array_store(spark, str(path))
    assert (dense(rows, numbers.shape) == numbers / 4).all() and dict(rows.dtypes)["value"] == "double"


def test_stores_that_are_not_read(spark, tmp_path, numbers):
    with pytest.raises(ValueError, match="compressor blosc"):
        st.parsed("p", '{"zarr_format": 2, "shape": [1], "chunks": [1], "dtype": "<u2", "compressor": {"id": "blosc"}}')
    with pytest.raises(ValueError, match="codec sharding"):
        st.parsed("p", '{"zarr_format": 3, "node_type": "array", "shape": [1], "data_type": "uint8", "chunk_grid": {"configuration": {"chunk_shape": [1]}}, "codecs": [{"name": "sharding"}]}')
    with pytest.raises(Exception, match="neither an array"):
        st.scan_array_store(spark, str(tmp_path)).count()
    st.write_array_store(voxels(spark, numbers), str(tmp_path / "once"))
    with pytest.raises(Exception, match="there already"):
        st.write_array_store(voxels(spark, numbers), str(tmp_path / "once"))


def test_a_failed_store_is_removed(spark, tmp_path):
    st.register(spark, st.ArrayStore)
    rows = spark.createDataFrame([("c/0", bytearray(b"1")), ("c/1", None)], "name string, data binary").repartition(2)
    with pytest.raises(Exception):  # noqa: B017
        rows.write.format("arraystore").mode("append").option("metadata", "{}").save(str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_levels_of_a_pyramid(spark, tmp_path, numbers):
    st.write_pyramid(voxels(spark, numbers), str(tmp_path / "p"), chunk=(2, 4, 4))
    ct.write_viewer_levels(voxels(spark, numbers), str(tmp_path / "p.h5"), chunk=(2, 4, 4))
    for level, f in enumerate((1, 2, 4)):
        want = numbers[:, ::f, ::f, ::f]
        assert (dense(st.scan_array_store(spark, str(tmp_path / "p" / str(level))), want.shape) == want).all()
        assert (dense(ct.scan_container(spark, str(tmp_path / "p.h5"), level), want.shape) == want).all()
    import json

    index = json.loads((tmp_path / "p" / "zarr.json").read_text())["attributes"]["ome"]["multiscales"][0]["datasets"]
    assert [(d["path"], d["coordinateTransformations"][0]["scale"][1]) for d in index] == [("0", 1.0), ("1", 2.0), ("2", 4.0)]


# --- containers --------------------------------------------------------------------------------------------------


def container_of(arrays, chunked=True, shuffle=False):
    """A file of some arrays, in chunks of 2 places along each axis or in one piece."""
    root, f = hdf5.Node(), io.BytesIO()
    f.seek(hdf5.START)
    for path, a in arrays.items():
        node = root.at(path)
        node.shape, node.kind = a.shape, a.dtype
        if not chunked:
            node.data = a.tobytes()
            continue
        node.chunk = (2,) * a.ndim
        for k in np.ndindex(*(-(-n // 2) for n in a.shape)):
            block = np.zeros(node.chunk, a.dtype)
            part = a[tuple(slice(2 * i, 2 * i + 2) for i in k)]
            block[tuple(map(slice, part.shape))] = part
            raw = hdf5.packed_block(block)
            node.index.append((tuple(2 * i for i in k), f.tell(), len(raw)))
            f.write(raw)
    f.write(b"\0" * (-f.tell() % 8))
    head, tail = hdf5.closing(root, f.tell())
    f.write(tail)
    f.seek(0)
    f.write(head)
    return f


@pytest.mark.parametrize("kind", ["<u1", "<i2", "<u2", "<i8", "<f4", "<f8"])
@pytest.mark.parametrize("chunked", [True, False])
def test_datasets_come_back(kind, chunked):
    rng = np.random.default_rng(3)
    arrays = {"a/b/c": rng.integers(0, 90, (3, 11, 17)).astype(kind), "Data": rng.integers(0, 90, (130, 3)).astype(kind)}
    c = hdf5.Container(container_of(arrays, chunked))
    found = dict(c.datasets())
    assert set(found) == set(arrays) and all((c.whole(found[k]) == v).all() and found[k].kind == v.dtype for k, v in arrays.items())
    assert c.find("a/b/none") is None and c.children(c.find("a")) == {"b": c.find("a/b")}


def test_a_tree_of_many_chunks():
    """5,000 chunks take three levels of nodes; each is found from its place."""
    a = np.arange(100 * 200, dtype="<i4").reshape(100, 200)
    c = hdf5.Container(container_of({"x": a}))
    d = dict(c.datasets())["x"]
    assert len(list(c.chunks(d, (0, 0), d.shape))) == 5000
    for at in ((0, 0), (98, 198), (50, 122), (2, 0)):
        ((offsets, *rest),) = c.chunks(d, at, at)
        assert offsets == at and (c.block(d, *rest) == a[at[0] : at[0] + 2, at[1] : at[1] + 2]).all()


def test_shuffled_chunks_and_newer_headers():
    """Bytes of a place side by side, then deflated; a header of the second version with links in it, laid out by hand."""
    import zlib

    a = np.arange(8, dtype="<u4").reshape(2, 4) * 1001
    c = hdf5.Container(container_of({"x": a}, False))
    d = hdf5.Dataset((2, 4), a.dtype, chunk=(2, 4), filters=(hdf5.SHUFFLE, hdf5.DEFLATE))
    raw = zlib.compress(a.reshape(-1).view(np.uint8).reshape(-1, 4).T.tobytes())
    c.f = io.BytesIO(raw)
    assert (c.block(d, 0, len(raw), 0) == a).all()
    link = lambda name, at: bytes([1, 0, len(name)]) + name + struct.pack("<Q", at)
    bodies = b"".join(struct.pack("<BHB", hdf5.LINK, len(m), 0) + m for m in (link(b"one", 700), link(b"two", 800)))
    header = b"OHDR" + bytes([2, 0, len(bodies)]) + bodies + bytes(4)
    block = hdf5.SIGNATURE + bytes([2, 8, 8, 0]) + struct.pack("<QQQQI", 0, hdf5.UNDEFINED, 900, 48, 0)
    c = hdf5.Container(io.BytesIO(block + header + bytes(100)))
    assert c.children(c.root) == {"one": 700, "two": 800}
    with pytest.raises(ValueError, match="not a container"):
        hdf5.Container(io.BytesIO(bytes(200)))


def test_layouts(spark, tmp_path):
    a = np.arange(2 * 2 * 4 * 3 * 5, dtype="<u2").reshape(2, 2, 4, 3, 5)
    (tmp_path / "i.ims").write_bytes(container_of({f"DataSet/ResolutionLevel 0/TimePoint {t}/Channel {c}/Data": a[k, j] for k, t in enumerate((2, 10)) for j, c in enumerate((0, 1))}).getvalue())
    (tmp_path / "f.h5").write_bytes(container_of({"image": a}, False).getvalue())
    (tmp_path / "g.h5").write_bytes(container_of({"data": a[0], "image": a}).getvalue())
    for name, want in (("i.ims", a), ("f.h5", a), ("g.h5", a[:1])):
        p = ct.scan_container(spark, str(tmp_path / name)).toPandas()
        got = np.full(want.shape, -1.0)
        got[p["t"], p["c"], p["z"], p["y"], p["x"]] = p["value"]
        assert len(p) == want.size and (got == want).all(), name
    few = ct.scan_container(spark, str(tmp_path)).where("c = 1 AND z = 3 AND x < 2")
    assert few.count() == (2 + 2 + 1) * 3 * 2
    (tmp_path / "long.h5").write_bytes(container_of({"data": np.zeros((33, 1, 2, 2), "<u2")}).getvalue())
    with pytest.raises(Exception, match="at most 32"):
        ct.scan_container(spark, str(tmp_path / "long.h5")).count()


def test_a_failed_container_leaves_nothing(spark, tmp_path):
    ct.register(spark, ct.ContainerSource)
    rows = spark.createDataFrame([("d", [0], hdf5.START, bytearray(b"1"))], "dataset string, offsets array<long>, at long, data binary")
    with pytest.raises(Exception, match="have come"):
        rows.write.format("container").mode("append").option("chunks", 2).option("datasets", "{}").option("attributes", "{}").save(str(tmp_path / "a.h5"))
    assert os.listdir(tmp_path) == []


def test_shapes_before_a_merge(spark, tmp_path):
    from tetraframe.sources.images import file_shapes

    for name, shape in (("a", (3, 4, 5)), ("b", (2, 4, 5)), ("c", (3, 4, 5))):
        (tmp_path / f"{name}.tif").write_bytes(tiff.file_of_pages(np.zeros(shape, "<u2")))
    assert sorted(map(tuple, file_shapes(ts.scan_tiff_tags(spark, str(tmp_path))).collect())) == [(2, 4, 5, 1), (3, 4, 5, 2)]
    (tmp_path / "d.tif").write_bytes(tiff.file_of_pages(np.zeros((3, 4, 6), "<u2")))
    with pytest.raises(Exception, match="differ in y or x"):
        file_shapes(ts.scan_tiff_tags(spark, str(tmp_path))).collect()
