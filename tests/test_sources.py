"""Which files the arguments stand for."""

from __future__ import annotations

import pathlib

import pytest

from tallylog import read_lines
from tallylog.sources.files import source_files


def write(path: pathlib.Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def listed(spark, inputs):
    rows = source_files(spark, inputs).orderBy("position", "path").collect()
    return [(r["position"], pathlib.Path(r["path"].removeprefix("file:")).name) for r in rows]


@pytest.mark.parametrize("name", ["_a.log", ".b.log", "deep/er/_c.log", "_old/d.log", ".old/x/d.log", "e.log._COPYING_"])
def test_hidden_files_are_refused_by_name(spark, tmp_path, name):
    write(tmp_path / "a.log", "1\n")
    write(tmp_path / name, "2\n")
    hidden = next(part for part in name.split("/") if part.startswith(("_", ".")) or part.endswith("_"))
    for inputs in (str(tmp_path), [f"{tmp_path}/*"]):
        with pytest.raises(ValueError, match=f"hidden files.*{hidden}"):
            read_lines(spark, inputs)
        with pytest.raises(ValueError, match="hidden files"):
            source_files(spark, inputs)
    if "/" not in name:
        with pytest.raises(ValueError, match=f"hidden files.*{name}"):
            read_lines(spark, str(tmp_path / name))


def test_empty_markers_and_partition_folders_are_no_hidden_files(spark, tmp_path):
    write(tmp_path / "_SUCCESS", "")
    write(tmp_path / "_day=1/a.log", "1\n2\n")
    write(tmp_path / "_empty/_SUCCESS", "")
    assert read_lines(spark, str(tmp_path)).count() == 2


def test_a_folder_may_have_a_hidden_name_if_it_is_named(spark, tmp_path):
    write(tmp_path / "_logs/a.log", "1\n2\n")
    assert read_lines(spark, str(tmp_path / "_logs")).count() == 2


def test_arguments_keep_their_order(spark, tmp_path):
    for name in ("z.log", "a.log", "sub/m.log", "sub/b.log"):
        write(tmp_path / name, f"{name}\n")
    root = str(tmp_path)
    inputs = [f"{root}/z.log", f"{root}/none", f"{root}/sub", f"{root}/*.log", f"{root}/z.log", root]
    assert listed(spark, inputs) == [(0, "z.log"), (2, "b.log"), (2, "m.log"), (3, "a.log")]
    assert read_lines(spark, inputs).count() == 4


def test_a_hundred_arguments_one_missing(spark, tmp_path):
    paths = [write(tmp_path / f"{k:03}.log", f"{k}\n") for k in range(100)]
    paths[40] = str(tmp_path / "missing.log")
    assert listed(spark, reversed(paths)) == [(99 - k, f"{k:03}.log") for k in reversed(range(100)) if k != 40]
    assert read_lines(spark, paths).count() == 99


def test_names_that_look_like_globs(spark, tmp_path):
    write(tmp_path / "a[1].log", "1\n")
    write(tmp_path / "a1.log", "2\n")
    write(tmp_path / "d{x}/a b%20.log", "3\n")
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "a[1].log")).collect()] == ["1"]
    assert listed(spark, [str(tmp_path / "d{x}"), str(tmp_path / "a?.log")]) == [(0, "a b%20.log"), (1, "a1.log")]


def test_nothing_found(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for inputs in (str(tmp_path / "none"), [], [str(tmp_path / "*.log")], str(tmp_path / "empty")):
        with pytest.raises(FileNotFoundError):
            read_lines(spark, inputs)
