"""Folder trees listed on executors."""

import os

import pytest

from trafficlens.sources import folders as FO


def tree(root, files, empty=()):
    for name, size in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(b"x" * size)
    for name in empty:
        os.makedirs(f"{root}/{name}", exist_ok=True)


def counts(spark, root):
    return {r["dir"]: tuple(r)[1:] for r in FO.folder_counts(spark, str(root)).collect()}


def test_counts_against_os_walk(spark, tmp_path):
    tree(tmp_path, {"A/x.pcap": 3, "A/y z%20.pcap": 5, "A/deep/er/z.pcap": 7, "A2/x.pcap": 11, "top.txt": 1,
                    "_hidden/a": 1, "A/.crc": 9, "A/_SUCCESS": 0}, ["Empty/inner"])
    expected = {}
    for folder, dirs, files in os.walk(tmp_path):
        dirs[:] = [d for d in dirs if d[0] not in "_."]
        files = [f for f in files if f[0] not in "_."]
        expected[folder] = [len(files), 0, 0]
        size = sum(os.path.getsize(f"{folder}/{f}") for f in files)
        for up, row in expected.items():
            if folder == up or folder.startswith(up + "/"):
                row[1] += len(files)
                row[2] += size
    assert counts(spark, tmp_path) == {"file:" + k: tuple(v) for k, v in expected.items()}
    assert counts(spark, f"file://{tmp_path}/") == counts(spark, tmp_path)


def test_empty_and_missing_root(spark, tmp_path):
    assert counts(spark, tmp_path) == {f"file:{tmp_path}": (0, 0, 0)}
    with pytest.raises(Exception, match="No such file"):
        counts(spark, tmp_path / "absent")


def test_folder_of_many_files_in_batches(spark, tmp_path, monkeypatch):
    tree(tmp_path, {f"A/{i}": 1 for i in range(250)} | {f"B/{i}/f": 1 for i in range(60)})
    monkeypatch.setattr(FO, "ENTRIES_AT_ONCE", 7)
    listed = FO.list_tree(spark, str(tmp_path))
    assert listed.where("not is_dir").count() == 310 and listed.where("is_dir").count() == 62
    assert listed.select("path").distinct().count() == 372


def test_a_loop_of_links_is_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "A").mkdir()
    os.symlink(tmp_path, tmp_path / "A" / "up")
    monkeypatch.setattr(FO, "MOST_LEVELS", 5)
    with pytest.raises(ValueError, match="levels"):
        FO.list_tree(spark, str(tmp_path))
