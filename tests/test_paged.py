"""The paged source: cutting features, pruning, splitting; replay of single pages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lotweave import api
from lotweave.plans import layers
from lotweave.sources import catalog, paged
from lotweave.workspace import Workspace

RING = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]


def feature(name, **more):
    return {"properties": {"NAME": name, **more}, "geometry": {"type": "Polygon", "coordinates": [RING]}}


@pytest.mark.parametrize(
    "document",
    [
        {"features": []},
        {"features": [{"a": 1}]},
        {"crs": {"features": [1, {"x": "]"}]}, "features": [{"p": 'a"]}\\'}, {"q": {"r": [[1], {"s": "\\\\"}]}}], "after": ["{", {}]},
        {"features": [{"p": '\\" , "features": ['}], "exceededTransferLimit": True},
        {"error": None, "features": [{"error": {"code": 1}}]},
    ],
)
@pytest.mark.parametrize("indent", [None, 2])
def test_features_are_cut_as_they_stand(document, indent):
    data = json.dumps(document, indent=indent).encode()
    assert [json.loads(data[s:e]) for s, e in paged.feature_spans(data)] == document["features"]


@pytest.mark.parametrize("data", [b"", b" \n", b"<html>", b'{"error":{"code":500}}', b'{"features":[{"a":1}', b'{"features":{"a":1}}', b"[]", b'{"features":[{"a":"x}]}'])
def test_other_documents_fail(data):
    assert paged.feature_spans(data) is None


@pytest.fixture
def store(tmp_path):
    root = tmp_path / "pages"
    for layer in ("fpd", "a b"):
        for offset, n in ((0, 5), (5, 5), (10, 2)):
            folder = root / f"layer={layer}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{offset}.json").write_text(json.dumps({"features": [feature(f"{offset}-{i}", V=1.10) for i in range(n)]}))
        (folder / "12.json").write_text("")
        (folder / "17.json").write_text('{"features":[]}')
    return root


def test_scan_agrees_with_the_file_reader(spark, store):
    got, want = paged.scan(spark, str(store), max_records=5, split=2), paged._scan_by_spark(spark, str(store))
    assert got.columns == want.columns
    same = lambda df: sorted(map(str, df.withColumn("feature", F.get_json_object("feature", "$.properties")).collect()))
    # Spark's reader leaves the empty files out
    assert same(got.where("offset <> 12")) == same(want) and got.count() == 28
    summary = {(r.layer, r.offset): (r.status, r.features) for r in paged.page_summary(got).collect()}
    assert summary["fpd", 12] == ("failed", 0) and summary["fpd", 17] == ("ok", 0) and summary["a b", 10] == ("ok", 2)
    assert "1.10" not in json.dumps(1.10) and all('"V": 1.1' in r.feature for r in got.where("feature IS NOT NULL").collect())


def plan_of(spark, df):
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(formatted)


def test_filters_reach_the_source(spark, store):
    some = paged.scan(spark, str(store), "layer = 'fpd' AND offset >= 5 AND offset < 12", 5)
    plan = plan_of(spark, some)
    pushed = plan.split("PushedFilters: ")[1].splitlines()[0]
    assert "EqualTo(layer,fpd)" in pushed and "GreaterThanOrEqual(offset,5)" in pushed and "LessThan(offset,12)" in pushed
    assert "Filter (" not in plan  # the source answers all of it
    assert some.count() == 7 and some.rdd.getNumPartitions() == 2
    assert paged.scan(spark, str(store)).rdd.getNumPartitions() == 10


def test_filters_over_one_scan_do_not_mix(spark, store):
    whole = paged.scan(spark, str(store), F.col("layer") == "fpd")
    low, high = whole.where("offset = 0"), whole.where(F.col("offset").isin(5, 10))
    assert low.unionByName(high).unionByName(whole).count() == 5 + 7 + 14
    assert (low.count(), whole.count(), high.count()) == (5, 14, 7)


def test_large_pages_are_split(spark, tmp_path):
    folder = tmp_path / "layer=x"
    folder.mkdir()
    (folder / "0.json").write_text(json.dumps({"features": [feature(str(i)) for i in range(4500)]}))
    rows = paged.scan(spark, str(tmp_path), max_records=5000)
    assert rows.rdd.getNumPartitions() == 3
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in sizes) == [500, 2000, 2000]
    assert [r[0] for r in rows.select("position").orderBy("position").collect()] == list(range(4500))


@pytest.fixture
def entries(spark):
    entry = dict(state="oregon", layer="fpd", epsg=3857, outfields="NAME", dtypes="VARCHAR(25)", fetch=True, geom=True, max_records=5)
    return catalog.catalog_from_rows(spark, [entry])


def files_of(ws, page):
    folder = f"{ws.staging_path('oregon', 'fpd')}/_page={page}"
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in sorted(os.listdir(folder)) if f.endswith(".parquet")} if os.path.isdir(folder) else None


@pytest.mark.parametrize("whole_layer", [False, True])
def test_replay_replaces_its_own_pages(spark, tmp_path, entries, store, whole_layer):
    if whole_layer:  # a step that looks at other rows
        layers.register_hook("OR", "fpd", lambda df: df.withColumn("n", F.lit(df.count())), by_row=False)
    else:
        layers.register_hook("oregon", "fpd", lambda df: df.withColumn("n", F.length("NAME")))
    try:
        ws = Workspace(spark, str(tmp_path / "ws"))
        folder = store / "layer=fpd"
        (folder / "count.json").write_text('{"count": 19}')
        (folder / "5.json").write_text(json.dumps({"features": [feature("5-0")]}))  # short
        (folder / "10.json").write_text('{"error":{"code":1}}')
        for extra in ("12", "17"):
            (folder / f"{extra}.json").unlink()
        assert api.ingest(ws, "OR", entries, str(store), ["fpd"]) == {"fpd": "incomplete: 3 pages"}
        before = files_of(ws, 0)
        assert api.replay(ws, "OR", entries, str(store)) == {"fpd": "incomplete: 3 pages"}
        assert ws.staging("oregon", "fpd").count() == 6

        (folder / "5.json").write_text(json.dumps({"features": [feature(f"5-{i}") for i in range(5)]}))
        (folder / "10.json").write_text(json.dumps({"features": [feature(f"10-{i}") for i in range(4)]}))
        (folder / "0.json").unlink()  # pages that are in place are not asked for
        assert api.replay(ws, "OR", entries, str(store)) == {"fpd": "incomplete: 2 pages"}
        rows = ws.staging("oregon", "fpd").select("id", "NAME", "n").collect()
        assert sorted(r.id for r in rows) == list(range(14))
        assert {r.n for r in rows} == ({14} if whole_layer else {3, 4})
        assert {r.offset: r.status for r in ws.staging("oregon", "fpd_ledger").collect()} == {10: "short", 15: "missing"}
        if not whole_layer:
            assert before == files_of(ws, 0) and before

        (folder / "10.json").write_text(json.dumps({"features": [feature(f"10-{i}") for i in range(5)]}))
        (folder / "15.json").write_text(json.dumps({"features": [feature(f"15-{i}") for i in range(4)]}))
        assert api.replay(ws, "OR", entries, str(store), ["fpd", "other"]) == {"fpd": "ok", "other": "unknown"}
        assert ws.staging("oregon", "fpd").count() == 19 and ws.staging("oregon", "fpd_ledger").count() == 0
        assert api.replay(ws, "OR", entries, str(store)) == {"fpd": "ok"}
    finally:
        layers.register_hook("oregon", "fpd", layers._repaired)


def test_a_replayed_page_may_lose_its_rows(spark, tmp_path, entries, store):
    ws = Workspace(spark, str(tmp_path / "ws"))
    folder = store / "layer=fpd"
    (folder / "count.json").write_text('{"count": 12}')
    (folder / "5.json").write_text(json.dumps({"features": [feature("x")]}))
    api.ingest(ws, "OR", entries, str(store), ["fpd"])
    (folder / "5.json").write_text(json.dumps({"features": [{"properties": {"NAME": "x"}, "geometry": None}] * 5}))
    api.replay(ws, "OR", entries, str(store))
    assert files_of(ws, 5) is None and files_of(ws, 0) and ws.staging("oregon", "fpd_quarantine").count() == 5


def test_a_page_of_several_lines_is_one_page(spark, tmp_path):
    from lotweave.sources import pages

    folder = tmp_path / "layer=fpd"
    folder.mkdir()
    (folder / "offset=0.json").write_text('{\n "features": [\n ]\n}\n')
    rows = pages._stored_files(spark, str(tmp_path)).collect()
    assert [r.value for r in rows] == ['{\n "features": [\n ]\n}\n']


def test_paged_source_reads_every_layer_and_page(spark, tmp_path):
    """First pages and all five layers are part of the result; the page that holds an error is a row without a feature."""
    from lotweave.plans import queries

    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    tables = {
        "region": ([*enumerate(regions)], "r_regionkey long, r_name string"),
        "nation": ([(i, f"N{i}", i) for i in range(5)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(i, i) for i in range(5)], "c_custkey long, c_nationkey long"),
        "orders": ([(i, i % 5) for i in range(50)], "o_orderkey long, o_custkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = queries.paged_source(spark, str(tmp_path)).collect()
    assert sorted(r.NUMBER for r in got if r.status == "ok") == [i for i in range(50) if i % 5 != 2]
    assert [(r.layer, r.offset, r.position, r.NUMBER) for r in got if r.status != "ok"] == [("asia", 0, None, None)]
    assert {r.layer for r in got} == {name.lower() for name in regions}
