import json
import zipfile

import pytest

from linkloom.functions.draws import normal
from linkloom.model import drawn_model
from linkloom.sources import archives, landing, tables
from linkloom.streaming import jobs


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def link(i, p=0.7, **more):
    return {"src_id": i, "dst_id": i + 100, "Purchaser": f"p{i} LLC", "Seller": f"s{i} Inc", "probability": p, **more}


def bronze(spark, tmp_path, **options):
    jobs.bronze_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "schema"), str(tmp_path / "ck_b"),
        path=str(tmp_path / "bronze"), **options,
    )
    return jobs.read_evolved(spark, str(tmp_path / "bronze"))


def test_restart_adds_only_new_files(spark, tmp_path):
    land(tmp_path / "in", "a.json", [link(1), link(2, 0.5)])
    land(tmp_path / "in", "empty.json", [])
    assert bronze(spark, tmp_path).count() == 2
    assert bronze(spark, tmp_path).count() == 2
    land(tmp_path / "in", "b.json", [link(3)])
    assert sorted(r["src_id"] for r in bronze(spark, tmp_path).collect()) == [1, 2, 3]


def test_backlog_can_be_cut_into_batches(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", f"{i}.json", [link(i)])
    assert bronze(spark, tmp_path, max_files=1).count() == 3
    assert len(list((tmp_path / "ck_b" / "commits").glob("[0-9]*"))) == 3


def test_new_column_and_bad_line_survive(spark, tmp_path):
    land(tmp_path / "in", "a.json", [link(1)])
    bronze(spark, tmp_path)
    land(tmp_path / "in", "b.json", [link(2, region="north"), "{not json"])
    rows = bronze(spark, tmp_path, sample=str(tmp_path / "in" / "b.json")).collect()
    assert {r["src_id"]: r["region"] for r in rows if r["src_id"]} == {1: None, 2: "north"}
    version, schema = landing.stored_schema(spark, str(tmp_path / "schema"))
    assert version == 1 and "region" in schema.fieldNames()


def test_silver_and_gold_follow_bronze(spark, tmp_path):
    land(tmp_path / "in", "a.json", [link(1), link(2, 0.54), link(3, None)])
    bronze(spark, tmp_path)
    schema = spark.read.parquet(str(tmp_path / "bronze")).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "bronze"))
        jobs.silver_stream(stream, str(tmp_path / "ck_s"), path=str(tmp_path / "silver"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "bronze"))
        x = spark.range(200).selectExpr("id", "array(id / 100D, 1D) AS x")
        jobs.incremental_gold(stream, x, drawn_model((2, 2, 2)), str(tmp_path / "ck_g"), str(tmp_path / "gold"))

    for _ in range(2):
        run()
        silver = spark.read.parquet(str(tmp_path / "silver")).collect()
        assert [(r["src_id"], r["Purchaser"], r["Seller"]) for r in silver] == [(1, "p1", "s1")]
        gold = {r["src_id"]: r["probability"] for r in spark.read.parquet(str(tmp_path / "gold")).collect()}
        assert set(gold) == {1, 2, 3} and gold[1] >= 0.7 and gold[2] >= 0.54 and gold[3] is None


def test_stream_into_a_named_table(spark, tmp_path):
    land(tmp_path / "in", "a.json", [link(1), link(2)])
    for _ in range(2):
        jobs.bronze_stream(
            spark, str(tmp_path / "in"), str(tmp_path / "schema"), str(tmp_path / "ck"),
            path=str(tmp_path / "t"), table="bronze_named",
        )
    assert spark.table("bronze_named").count() == 2


def test_archives_are_unpacked_line_by_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LINES_PER_BATCH", 2)
    (tmp_path / "zips").mkdir()
    for z in range(2):
        with zipfile.ZipFile(tmp_path / "zips" / f"{z}.zip", "w") as out:
            out.writestr("folder/", "")
            out.writestr("folder/a.json", "\n".join(json.dumps(link(z * 10 + i)) for i in range(5)))
            out.writestr("empty.json", "")
    lines = archives.unpack_archives(archives.read_archives(spark, str(tmp_path / "zips")))
    assert lines.count() == 10 and {r["entry"] for r in lines.collect()} == {"folder/a.json"}
    archives.land_archives(spark, str(tmp_path / "zips"), str(tmp_path / "in"))
    assert sorted(r["src_id"] for r in bronze(spark, tmp_path).collect()) == [*range(5), *range(10, 15)]


def test_csv_becomes_a_typed_table_and_refreshes(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,score,name\n1,0.5,x\n2,0.75,y\n")
    t = tables.csv_to_table(spark, str(tmp_path / "s.csv"), "side_scores", str(tmp_path / "side"))
    assert dict(t.dtypes) == {"id": "int", "score": "double", "name": "string"}
    tables.overwrite_table(spark.range(3), "side_scores", str(tmp_path / "side"))
    assert spark.table("side_scores").columns == ["id"] and tables.preview(spark.table("side_scores"), ["id"], 2).count() == 2
