"""Files below a folder, listed and read by tasks: the rows are those of Spark's own readers."""

import gzip
import os

from pyspark.sql import functions as F

from stratawell.sources import folders, trajectory


def tree(root):
    """Folders of several depths and odd names; hidden and empty ones are passed over."""
    for folder in ("_wellInfo/1", "f/trajectory/n=1", "f/_u/c/_v", "f/bhaRun", "a b+c/message", ".hidden/mudLog", "empty/_none"):
        os.makedirs(root / folder)
    tags = {"_wellInfo/1/w.xml": "well", "f/trajectory/n=1/t.xml": "trajectory", "a b+c/message/m 1.xml": "message"}
    for name, tag in tags.items():
        (root / name).write_text(f'<docs><{tag} uid="{tag}1"><name>x</name></{tag}></docs>')
    (root / "f/bhaRun/none.xml").write_text("")
    (root / "f/bhaRun/b.xml.gz").write_bytes(gzip.compress(b'<docs><bhaRun uid="b1"/></docs>'))
    (root / "f/_u/c/_v/other.txt").write_bytes(b"\xff\n")
    for hidden in ("f/.x.xml", "f/_x.xml", ".hidden/mudLog/h.xml", "f/y._COPYING_"):
        (root / hidden).write_text("<docs/>")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_listed_and_read_by_tasks_as_by_spark(spark, tmp_path, monkeypatch):
    tree(tmp_path)
    found = rows(trajectory.route_documents(spark, f"{tmp_path}/"))
    read = [rows(part) for part in trajectory.read_routed_documents(spark, str(tmp_path))]
    monkeypatch.setattr(trajectory, "local_path", lambda *_: None)
    assert len(found) == 5 and found == rows(trajectory.route_documents(spark, f"{tmp_path}/"))
    assert read == [rows(part) for part in trajectory.read_routed_documents(spark, str(tmp_path))]
    assert len(read[0]) == 4 and len(read[1]) == 1


def test_the_driver_lists_no_folders(spark, tmp_path, monkeypatch):
    def listed(*_):
        raise AssertionError("listed by the driver")

    tree(tmp_path)
    monkeypatch.setattr(trajectory, "underscore_folders", listed)
    assert trajectory.route_documents(spark, str(tmp_path)).count() == 5
    documents, rejected = trajectory.read_routed_documents(spark, str(tmp_path))
    assert (documents.count(), rejected.count()) == (4, 1)


def test_each_row_becomes_a_file(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 1, "x"), ("a/b", 1, "x"), ("c", 2, "\u00fc")], "folder string, n long, value string")
    for _ in range(2):  # a repeated task writes the same files
        folders.write_files(df.coalesce(1), str(tmp_path / "t"))
    files = sorted((tmp_path / "t").rglob("part-*"))
    assert [f.read_text(encoding="utf-8") for f in files] == ["x\n", "x\n", "\u00fc\n"]
    back = spark.read.text(str(tmp_path / "t" / "*"), recursiveFileLookup=True)
    assert sorted(r[0] for r in back.select(F.col("value")).collect()) == ["x", "x", "\u00fc"]
