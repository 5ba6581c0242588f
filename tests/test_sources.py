import json
from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from refinery.queries.enrichment import raw_incidents
from refinery.operators.raw_json import infer_schema, parse_raw, to_raw
from refinery.sources.datasets import PAGE_SHAPES, Dataset
from refinery.sources.files import (
    clean_headers,
    csv_to_bronze,
    csv_to_raw,
    page_records,
    scan_csv,
    scan_pages,
    scan_table,
    with_lineage,
)


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json string").withColumn(
        "ingestion_time", F.lit(datetime(2024, 1, 1))
    )


BAD = ("{broken", "[]", None, "17", '"text"')


def test_schema_covers_late_and_nested_fields(spark):
    texts = ['{"id":1,"n":{"x":1.5}}'] * 300 + ['{"id":2,"n":{"late":"v"},"list":[{"a":true}]}']
    assert infer_schema(raw(spark, *texts, *BAD)) == (
        "STRUCT<id: BIGINT, list: ARRAY<STRUCT<a: BOOLEAN>>, n: STRUCT<late: STRING, x: DOUBLE>>"
    )
    parsed = parse_raw(raw(spark, *texts))
    assert parsed.where("n.late = 'v'").count() == 1


def test_conflicting_types_survive_as_variant(spark):
    parsed = parse_raw(raw(spark, '{"a":1}', '{"a":"x"}'))
    assert dict(parsed.dtypes)["a"] == "variant"
    assert rows(parsed.select(F.to_json("a"))) == [('"x"',), ("1",)]


def test_bad_json_is_null_and_counted(spark):
    parsed = parse_raw(raw(spark, '{"a":1}', *BAD), "a INT", unparsed="bad")
    assert parsed.columns == ["a", "bad", "ingestion_time"]
    assert parsed.where("a IS NOT NULL").count() == 1
    assert rows(parsed.where("bad IS NOT NULL").select("bad")) == [
        ('"text"',),
        ("17",),
        ("[]",),
        ("{broken",),
    ]


def test_no_rows_give_an_empty_frame(spark):
    assert parse_raw(raw(spark).where("false")).count() == 0
    assert parse_raw(raw(spark, *BAD)).count() == 0
    assert parse_raw(raw(spark), "a INT").columns == ["a", "ingestion_time"]


def test_raw_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(to_raw(df).first()["raw_json"]) == {"a": 1, "b": None}


RECORDS = [{"id": 1, "new": {"deep": [1, "x"]}}, {"id": 2, "é": None}]


@pytest.mark.parametrize(
    ("shape", "page"),
    [
        ("SINGLE", RECORDS),
        ("SINGLE", {"results": RECORDS}),
        ("OFFSET", RECORDS),
        ("NEXT", {"results": RECORDS, "next": "more"}),
        ("JIRA_NEXT", {"issues": RECORDS, "nextPageToken": "t"}),
        ("GRAPH_NEXT", {"value": RECORDS, "@odata.nextLink": "l"}),
        ("ODATA_NEXT", {"value": RECORDS}),
        ("TEMPO_NEXT", {"results": RECORDS, "metadata": {"next": "n"}}),
    ],
)
def test_page_shapes(spark, shape, page):
    pages = spark.createDataFrame([(json.dumps(page),), ("",), ("{}",), ("nope",)], "value string")
    found = [json.loads(r[0]) for r in page_records(pages, PAGE_SHAPES[shape]).collect()]
    assert sorted(found, key=lambda r: r["id"]) == RECORDS


def test_page_files(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps({"results": RECORDS}, indent=2))
    (tmp_path / "pages" / "2.json").write_text(json.dumps({"results": [{"id": 3}]}))
    assert scan_pages(spark, str(tmp_path / "pages"), ["$.results"]).count() == 3
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps({"results": [{"id": i}]}) for i in range(5)))
    assert scan_pages(spark, str(lines), ["$.results"], page_per_line=True).count() == 5


ODD_PAGES = [
    '{"results":[{"b":1.50,"a":"x\\u00e9\\n"},null,"s",3,[{"q":1}],{"c":{"z":1,"y":[1, 2]}}]}',
    '{"results":[{"n":12345678901234.1234567890123456789},{"n":-1e3},{"n":100.0}]}',
    '{"results":[{"n":[1,2.50]},{"n":99999999999999999999999999999999999999999}]}',
    '{"results":[{"n":[ -7 , 123456789012345678901234567890]},{"s":"a, 2.50"}]}',
    '{"results":["{\\"a\\":1}"]}',
    '{"results":[{"\\u0061":1,"\\"":{}}, {}]}',
    '{"results":[{"a":1}]} trailing',
    '{"Results":[{"a":0}],"results":[{"a":1}]}',
    '{"results":{}}', '{"results":null}', '{"results":[]}', '{"results":[{"a":1}', '{"results":[{"a":1,"a":2}]}',
    '{"results":[{"a":1}],"results":[{"a":2}]}', "{'results':[{'a':1}]}", '{"results":[{"a":NaN}]}',
    '[{"results":[{"q":1}]}]', '["results"]', "17", "", None,
]


@pytest.mark.parametrize("paths", [["$.results"], ["$.results", "$"], ["$"], ["$['results']"], ["$.results[0].c.y"]])
@pytest.mark.parametrize("fields", [None, {"a": "$.a", "deep": "$.c.z"}])
def test_records_of_odd_pages_are_those_of_the_variant(spark, paths, fields):
    pages = spark.createDataFrame([(p,) for p in ODD_PAGES], "value string")
    lists = [F.try_variant_get(F.try_parse_json("value"), p, "array<variant>") for p in paths]
    taken = [F.try_variant_get("r", p, "string") for p in (fields or {}).values()]
    wanted = pages.select(F.explode(F.coalesce(*lists)).alias("r")).select(F.to_json("r"), *taken)
    got = page_records(pages, paths, fields=fields)
    assert got.columns == ["raw_json", *(fields or {})]
    normal = lambda df: sorted(repr((json.dumps(json.loads(r[0], parse_float=str), sort_keys=True), *r[1:])) for r in df.collect())
    assert normal(got) == normal(wanted)


def test_records_are_copied_from_the_page_not_written_anew(spark):
    record = '{"b":1,"a":{"d":"1998-04-15T00:00:00.000+0000","c":null}}'
    pages = spark.createDataFrame([(f'{{"results":[{record}]}}',)], "value string")
    assert page_records(pages, ["$.results"]).first()["raw_json"] == record


def test_raw_incidents_filter_before_json(spark):
    folder = "/root/testdata/sf0.001"
    for half in (0, 1):
        chosen = raw_incidents(spark, folder, f"o_custkey % 2 = {half}")
        after = raw_incidents(spark, folder).where(f"CAST(get_json_object(raw_json, '$.id') AS BIGINT) % 2 = {half}")
        assert sorted(chosen.collect()) == sorted(after.collect()) != []


def dataset(**changes):
    return Dataset(
        **{
            "name": "tickets",
            "source": "desk",
            "path": "/landing",
            "pagination": "NEXT",
            "bronze_table": "b",
            "incremental_field": "modified",
            "params": {"fields": "a"},
            **changes,
        }
    )


def test_dataset_asks_for_new_records_only():
    mark = datetime(2024, 1, 2, 3, 4, 5, 678)
    assert dataset().pipeline == "desk_ingestion"
    assert dataset().request_params(mark) == {
        "fields": "a",
        "query": "modified>'2024-01-02T03:04:05.000678Z'",
    }
    assert dataset(pagination="ODATA_NEXT").request_params(mark) == {
        "fields": "a",
        "$filter": "modified gt 2024-01-02T03:04:05Z",
    }
    assert dataset().request_params(mark, full_load=True) == {"fields": "a"}
    assert dataset().request_params(None) == {"fields": "a"}
    assert dataset(incremental_field=None).request_params(mark) == {"fields": "a"}
    with pytest.raises(ValueError, match="pagination"):
        dataset(pagination="CIRCLE")


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "supply chain.csv"
    path.write_text("Product type,SKU,Price,When\nsoap,SKU1,1.5,2024-01-02\ncream,SKU2,,\n")
    return str(path)


def test_csv_inferred_and_declared(spark, csv):
    assert dict(scan_csv(spark, csv).dtypes)["Price"] == "double"
    declared = "`Product type` STRING, SKU STRING, Price FLOAT, When STRING"
    assert dict(scan_csv(spark, csv, declared).dtypes)["Price"] == "float"


def test_bronze_has_clean_headers_and_lineage(spark, csv):
    bronze = csv_to_bronze(spark, csv, "dev")
    assert bronze.columns[:3] == ["Product_type", "SKU", "Price"]
    row = bronze.first()
    assert row["_env"] == "dev" and row["_source_file"].endswith("supply%20chain.csv")
    assert row["_ingest_ts"] is not None
    assert with_lineage(bronze.drop("_env"), "test", F.lit("f")).first()["_env"] == "test"


def test_headers_must_not_collide(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="collide"):
        clean_headers(df)


def test_csv_rows_as_records(spark, csv):
    records = [json.loads(r["raw_json"]) for r in csv_to_raw(spark, csv).collect()]
    assert records == [
        {"Product type": "soap", "SKU": "SKU1", "Price": 1.5, "When": "2024-01-02"},
        {"Product type": "cream", "SKU": "SKU2", "Price": None, "When": None},
    ]


def test_table_scan(spark, new_table):
    name = new_table()
    spark.range(3).write.saveAsTable(name)
    assert scan_table(spark, name).count() == 3
