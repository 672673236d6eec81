"""Later files bring columns and bad values by themselves, and nothing is lost."""

from linkloom.streaming import jobs
from test_streams import bronze, land, link


def test_later_columns_and_bad_values_are_kept(spark, tmp_path):
    land(tmp_path / "in", "a.json", [link(1, tags={"x": 1})])
    bronze(spark, tmp_path)
    bad = {**link(7, 0.9), "src_id": "seven"}
    land(tmp_path / "in", "b 1+2.json", [link(2, region="north", tags={"x": 1, "y": "new"}), "{not json", bad])
    rows = bronze(spark, tmp_path)
    good = {r["src_id"]: (r["region"], r["tags"]["y"]) for r in rows.filter("_corrupt_record is null").collect()}
    assert good == {1: (None, None), 2: ("north", "new")}
    aside = [r["_corrupt_record"] for r in jobs.rescued_rows(rows).collect()]
    assert len(aside) == 2 and "{not json" in aside and any("seven" in t for t in aside)
    silver = jobs.silver_rows(rows)
    assert sorted(r["src_id"] for r in silver.collect()) == [1, 2] and "_corrupt_record" not in silver.columns


def test_only_unseen_files_are_inferred(spark, tmp_path, monkeypatch):
    from linkloom.sources import landing

    land(tmp_path / "in", "a 1+2.json", [link(1)])
    bronze(spark, tmp_path)
    land(tmp_path / "in", "b.json", [link(2)])
    left = landing.unseen_files(spark, str(tmp_path / "in"), str(tmp_path / "ck_b"))
    assert [f.rsplit("/", 1)[1] for f in left] == ["b.json"]


def test_files_of_bad_lines_only_are_kept(spark, tmp_path):
    land(tmp_path / "in", "a.json", ["{bad", "", "{worse"])
    rows = bronze(spark, tmp_path)
    assert sorted(r["_corrupt_record"] for r in rows.collect()) == ["{bad", "{worse"]
    land(tmp_path / "in", "b.json", [link(1)])
    assert bronze(spark, tmp_path).filter("src_id = 1").count() == 1
