"""Files listed by tasks: the rows of Spark's readers, and no list on the driver."""

import gzip

import pytest

from strataseek.sources import files
from tests.helpers import plan_of

NAMES = ["a.txt", "b c.txt", "é%41.txt", "empty.txt", ".hid.txt", "_h.txt", "_k=1.txt", "x.txt._COPYING_", "n#1?.txt", "q[1]{2}.txt",
         "deep/er/z.txt", ".hd/a.txt", "_hd/a.txt", "_metadata1/a.txt", "_metadata.txt", "k=v/a.txt", "up.TXT", "page.html"]


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "in put%20x"
    (root / "none").mkdir(parents=True)
    for name in NAMES:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"" if name == "empty.txt" else name.encode() + b"\xff \r\n")
    return str(root)


def listed_by_tasks(spark, monkeypatch, folder, read):
    """Rows and schema as Spark's reader gives them, without a file of the folder in the driver's plan."""
    found = read(spark, folder)
    assert not [f for f in found.inputFiles() if "in%20put" in f or "in put" in f]
    with monkeypatch.context() as m:
        m.setattr(files, "list_files", lambda *a: None)
        want = read(spark, folder)
        assert found.schema == want.schema
        want = want.collect()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want)) and want
    return found


def test_inventory_is_listed_by_tasks(spark, monkeypatch, folder):
    found = listed_by_tasks(spark, monkeypatch, folder, lambda s, p: files.file_inventory(s, p, (".txt", ".html")))
    assert found.count() == 10
    # what tasks cannot list is read as before
    assert files.file_inventory(spark, f"{folder}/a.txt").count() == 1
    assert files.file_inventory(spark, f"{folder}/[ab]*.txt").count() == 2


def test_binary_files_are_listed_by_tasks_and_handed_on_in_small_batches(spark, monkeypatch, folder):
    monkeypatch.setattr(files, "_HELD_BYTES", 20)
    for glob in ("*", "{a,b c}.t[xy]t", "[!a]*"):
        listed_by_tasks(spark, monkeypatch, folder, lambda s, p: files.read_binary_files(s, p, glob))
    assert "arrow" not in plan_of(files.read_binary_files(spark, folder).select("path")).lower()  # not opened for its name


def test_whole_texts_are_listed_by_tasks(spark, monkeypatch, folder):
    for glob in ("*", "?.txt"):
        listed_by_tasks(spark, monkeypatch, folder, lambda s, p: files.read_whole_text(s, p, glob))


def test_compressed_texts_are_still_decompressed(spark, folder):
    with gzip.open(f"{folder}/z.txt.gz", "wt") as out:
        out.write("packed")
    assert "packed" in [r.raw_content for r in files.read_whole_text(spark, folder, "*").select("raw_content").collect()]
