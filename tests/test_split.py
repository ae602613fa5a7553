"""One document read by byte ranges against the reader of whole files."""

import json

import pytest

from lotweave import api
from lotweave.sources import catalog, split, vector
from lotweave.workspace import Workspace

SCHEMA = catalog.declared_schema("n,note", "INTEGER,VARCHAR(400)")
NOTES = ['plain', 'a "quoted" }{][ one', "back\\slash\\", '\\"}', "}}}}", "[[[", "", "ключ }\n\t{", '","features":[{"properties":{"n":99}}', "x" * 300]


def document(count, crs=None, indent=None, first=0):
    def feature(i):
        x = float(i % 50)
        ring = [[x, 40.0], [x + 1, 40.0], [x + 1, 41.0], [x, 41.0], [x, 40.0]]
        shape = {"type": "Polygon", "coordinates": [ring]} if i % 7 else None
        return {"type": "Feature", "properties": {"n": i, "note": NOTES[i % len(NOTES)], "deep": {"a": [{"b": {}}]}}, "geometry": shape}

    held = {"type": "FeatureCollection", "links": [{"features": [{"properties": {"n": -1}}]}], "bbox": [0, 1], "features": [feature(first + i) for i in range(count)]}
    if crs:
        held["crs"] = {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{crs}"}}
    return json.dumps({**held, "more": [{"properties": {"n": -2}}]}, ensure_ascii=False, indent=indent)


def content(pair):
    loaded, bad = pair
    return sorted(map(str, loaded.collect())), sorted(map(str, bad.collect()))


@pytest.fixture
def ranges_of(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


@pytest.mark.parametrize("size, indent", [(101, None), (900, 2), (1 << 20, 2)])
def test_ranges_of_any_size_give_the_whole_file(spark, tmp_path, ranges_of, size, indent):
    path = str(tmp_path / "d.geojson")
    (tmp_path / "d.geojson").write_text(document(21, indent=indent))
    expected = content(vector.read_geojson(spark, path, SCHEMA, 4326, 3857))
    ranges_of(size)
    assert split._fragments(spark, path).select("block").distinct().count() > (10 if size < 1000 else 0)
    got = content(split.read_geojson_split(spark, path, SCHEMA, 4326, 3857))
    assert got == expected and len(got[0]) == 18 and len(got[1]) == 3


def test_several_documents_with_their_own_systems(spark, tmp_path, ranges_of):
    for name, crs in (("a", 3857), ("b", None), ("c", 2913)):
        (tmp_path / f"{name}.geojson").write_text(document(9, crs, first=ord(name)))
    (tmp_path / "empty.geojson").write_text('{"type":"FeatureCollection","features":[]}\n')
    (tmp_path / "blank.geojson").write_text("")
    path = str(tmp_path / "*.geojson")
    ranges_of(200)
    for target in (None, 3857):
        got, expected = [content(read(spark, path, SCHEMA, None, target)) for read in (split.read_geojson_split, vector.read_geojson)]
        # the reader of whole files keeps the system's column in quarantine under another name and place
        assert len(got[0]) == len(expected[0]) == 22 and len(got[1]) == len(expected[1]) == 5
        assert got[0] == expected[0]


def test_import_of_a_split_document(spark, tmp_path, ranges_of):
    (tmp_path / "d.geojson").write_text(document(20, 4326))
    ranges_of(500)
    ws = Workspace(spark, str(tmp_path / "ws"))
    bad = api.import_vector(ws, str(tmp_path / "d.geojson"), "oregon", "d", t_srid=3857, split=True)
    rows = ws.staging("oregon", "d")
    assert bad.count() == 3 and rows.count() == 17 and rows.schema["n"].dataType.simpleString() == "int"


def test_walk_tells_strings_from_brackets():
    walk = split.Walk()
    assert [t[0] for t in walk.tokens('{"a]":[1,"b\\"[",{"c":2')] == ["{", "[", "{", "}"]
    assert walk.depth == 2 and not walk.in_string and walk.opened[1] == "a]"
    assert list(split.Walk(in_string=True).tokens("still inside [ {")) == []
    assert [t[0] for t in split.Walk(in_string=True).tokens('end", [')] == ["[", "}"]
    cut = split.Walk()
    assert list(cut.tokens('"open ')) == [] and cut.in_string
