"""The package source: every member once however packages are dealt, filters that reach it, kinds by a loop."""

import io
import random
import zipfile

import pytest

from linefold.sources import packages as P

RULES = [  # names of members, kind
    (["Contents/section0.xml", "a.txt"], "hwpx"),
    (["mimetype", "x.hwp", "b"], "hwpx"),
    (["mimetype", "a", "b", "c", "d", "x.hwp"], "zip_other"),
    (["Contents/a", "settings.xml"], "hwpx"),
    (["Contents/a", "other.xml"], "zip_other"),
    (["word/document.xml", "xl/workbook.xml"], "docx"),
    (["ppt/presentation.xml"], "pptx"),
    (["xl/workbook.xml"], "xlsx"),
    (["a.PNG", "b.jpeg", "c", "d"], "zip_images"),
    (["a.png", "b", "c"], "zip_other"),
    ([f"n{i}" for i in range(400)] + ["word/document.xml"], "zip_other"),
    (["version.xml"], "zip_other"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("packages")
    rnd = random.Random(1)
    for k, (names, _) in enumerate(RULES):
        (at / f"d{k % 3}").mkdir(exist_ok=True)
        with zipfile.ZipFile(at / f"d{k % 3}" / f"{k}.zip", "w") as z:
            for name in names:
                z.writestr(name, rnd.randbytes(rnd.randrange(300)))
    (at / "none.zip").write_bytes(b"no package")
    (at / "empty.zip").write_bytes(b"")
    (at / "left.txt").write_bytes(b"PK")
    return at


def members(folder):
    out = []
    for path in sorted(folder.rglob("*.zip")):
        try:
            with zipfile.ZipFile(io.BytesIO(path.read_bytes())) as z:
                out += [(str(path), i, m.filename, m.file_size, z.read(m)) for i, m in enumerate(z.infolist())]
        except zipfile.BadZipFile:
            out.append((str(path), None, None, None, None))
    return out


@pytest.mark.parametrize("size", [1 << 26, 1000, 150])
def test_every_member_once(spark, folder, size):
    """Also if a package is cut into many ranges, of which each task has some."""
    df = P.packages(spark, f"file://{folder}", task_bytes=size)
    got = [(r["path"], r["place"], r["part"], r["size"], None if r["content"] is None else bytes(r["content"])) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, members(folder)))
    assert df.rdd.getNumPartitions() == (1 if size > 10**6 else df.rdd.getNumPartitions()) and (size > 10**6 or df.rdd.getNumPartitions() > 5)


def test_filters_reach_the_source(folder):
    """Only members that the filters leave are read; what it cannot answer goes back to Spark."""
    reader = P.PackageReader({"path": f"file://{folder}"})
    own, other = P.StringStartsWith(("part",), "Contents/"), P.EqualTo(("path",), "x")
    assert list(reader.pushFilters([own, other])) == [other]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert {r[2] for r in rows} == {"Contents/section0.xml", "Contents/a"}


def test_filters_give_the_same_rows(spark, folder):
    df = P.packages(spark, f"file://{folder}")
    whole = members(folder)
    for where, test in (("part = 'mimetype'", lambda n: n == "mimetype"), ("part in ('a', 'b')", lambda n: n in ("a", "b")), ("part like 'Contents/%'", lambda n: n.startswith("Contents/")), ("part like '%.xml' and part like '%work%'", lambda n: n.endswith(".xml") and "work" in n)):
        assert df.where(where).count() == sum(m[2] is not None and test(m[2]) for m in whole)
    assert df.where("part is null").count() == 2


def test_directories_alone(spark, folder):
    df = P.packages(spark, f"file://{folder}", content=False)
    assert df.where("content is not null").count() == 0 and df.count() == len(members(folder))


def test_kinds(spark, folder):
    got = {r["path"].rsplit("/", 1)[1]: (r["kind"], r["images"]) for r in P.package_kinds(P.packages(spark, f"file://{folder}", content=False)).collect()}
    want = {f"{k}.zip": (kind, 2 if kind == "zip_images" else 0) for k, (_, kind) in enumerate(RULES)} | {"none.zip": ("error", 0), "empty.zip": ("error", 0)}
    assert got == want


def test_round_trip(spark, tmp_path):
    rows = [(p, i, f"m{i}", bytes([i]) * (i * 50)) for p in ("a", "b") for i in range(20)]
    P.write_packages(spark.createDataFrame(rows, "package string, place int, part string, content binary").repartition(5), f"file://{tmp_path}/out").collect()
    got = P.packages(spark, f"file://{tmp_path}/out").collect()
    assert sorted((r["path"][-5], r["place"], r["part"], bytes(r["content"])) for r in got) == rows
    assert P.packages(spark, f"file://{tmp_path}/nothing").count() == 0
