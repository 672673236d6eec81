"""Archives and records that arrive between runs."""

import io
import json
import zipfile
from collections import Counter

from linkloom.session import scratch_path, shared_file
from linkloom.sources import landing, widening
from linkloom.sources.archive_stream import stream_archives
from linkloom.streaming.jobs import append_stream


def put(folder, name, data):
    system, root = shared_file(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{name}") as out:
        out.write(data)


def test_records_widen_and_nothing_is_lost(spark):
    schema, checkpoint, path, folder = (scratch_path(spark, x) for x in ("schema", "ckpt", "records", "landing"))
    files = [
        ['{"id": 1, "p": 1}', "", "not json"],
        ['{"id": 2, "p": 1.5}', '{"id": 3, "p": 2, "more": {"a": 1}}'],
        ['{"id": 4, "p": "x"}', '{"id": 5, "p": null}', '{"id": 1, "p": 1}'],
        ["   "],
    ]
    for n, lines in enumerate(files):
        put(folder, f"{n}.json", "\n".join(lines).encode())
        for _ in range(2):  # the second run finds nothing new
            widening.land_records(spark, folder, schema, checkpoint, path)
    found = widening.read_records(spark, path, schema)
    assert dict(found.dtypes)["p"] == "double"
    good = Counter((r.id, r.p) for r in found.filter(f"{landing.RESCUED} is null").collect())
    assert good == Counter({(1, 1.0): 2, (2, 1.5): 1, (3, 2.0): 1, (5, None): 1})
    aside = {r[0] for r in found.filter(f"{landing.RESCUED} is not null").select(landing.RESCUED).collect()}
    assert aside == {"not json", '{"id": 4, "p": "x"}'}


def test_fractions_set_aside_return_when_the_type_has_widened(spark):
    """A record that didn't fit the types of its day is read with those of today, once."""
    schema, checkpoint, path, folder = (scratch_path(spark, x) for x in ("schema", "ckpt", "records", "landing"))
    put(folder, "0.json", b'{"id": 1, "tags": 7}\n{"id": 2, "tags": 8}')
    widening.land_records(spark, folder, schema, checkpoint, path)
    put(folder, "1.json", b'{"id": 3, "tags": "late"}')
    widening.land_records(spark, folder, schema, checkpoint, path)
    assert widening.read_records(spark, path, schema).filter(f"{landing.RESCUED} is not null").count() == 1
    version, old = landing.stored_schema(spark, schema)
    text = landing.T.StructType([f if f.name != "tags" else landing.T.StructField("tags", landing.T.StringType()) for f in old])
    landing.remember_schema(spark, schema, text)
    rows = widening.read_records(spark, path, schema)
    assert {(r.id, r.tags) for r in rows.collect()} == {(1, "7"), (2, "8"), (3, "late")}
    assert rows.filter(f"{landing.RESCUED} is not null").count() == 0


def test_archives_are_read_once_each(spark):
    folder, log, out, checkpoint = (scratch_path(spark, x) for x in ("archives", "log", "lines", "ckpt"))

    def archive(name, entries):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for entry, text in entries.items():
                z.writestr(entry, text)
        put(folder, name, data.getvalue())

    archive("a.zip", {"x.json": "1\r\n2\n", "folder/": "", "folder/y.json": json.dumps({"t": "ä"})})
    put(folder, "other.txt", b"not an archive")
    for _ in range(2):
        append_stream(stream_archives(spark, folder, log), checkpoint, path=out)
    assert sorted(r.line for r in spark.read.parquet(out).collect()) == ["1", "2", '{"t": "\\u00e4"}']
    archive("b.zip", {"z.json": "3\n", "empty.json": ""})
    append_stream(stream_archives(spark, folder, log), checkpoint, path=out)
    assert Counter(r.line for r in spark.read.parquet(out).collect()) == Counter(["1", "2", '{"t": "\\u00e4"}', "3"])
