"""Reference files that can't be read are reported, and the others are read."""

from snowlit.sources.files import read_references, rejected_references


def test_broken_reference_files_are_named(spark, tmp_path):
    files = {"a": '[{"title": "T", "doi": "10.1/a"}]', "cut": '[{"title": "T"}, {"ti', "text": "no json", "none": "[]"}
    for name, value in files.items():
        (tmp_path / f"{name}.json").write_text(value)
    path = str(tmp_path)
    assert [(r.paper_id, r.doi) for r in read_references(spark, path).collect()] == [("a", "10.1/a")]
    assert {r.paper_id for r in rejected_references(spark, path).collect()} == {"cut", "text"}
    assert rejected_references(spark, f"{path}/absent").count() == 0
