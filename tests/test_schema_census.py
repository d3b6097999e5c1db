import json

import pytest

from stratalake.operators.schema_census import paths_of, schema_census, schema_changes, schema_paths


@pytest.mark.parametrize(
    "schema, paths",
    [
        (None, []),
        ("BIGINT", [("$", "BIGINT")]),
        ("OBJECT<>", [("$", "OBJECT")]),
        ("OBJECT<a: OBJECT<b: ARRAY<DECIMAL(21,1)>, c: VOID>, `we ird.k`: DECIMAL(2,1)>", [("$", "OBJECT"), ("$.a", "OBJECT"), ("$.a.b", "ARRAY"), ("$.a.b[]", "DECIMAL"), ("$.a.c", "VOID"), ("$.we ird.k", "DECIMAL")]),
        ("ARRAY<ARRAY<OBJECT<x: STRING, y: OBJECT<>>>>", [("$", "ARRAY"), ("$[]", "ARRAY"), ("$[][]", "OBJECT"), ("$[][].x", "STRING"), ("$[][].y", "OBJECT")]),
    ],
)
def test_paths_of_a_schema(schema, paths):
    assert paths_of(schema) == paths


def nested(depth):
    return "{\"a\":" * depth + "1" + "}" * depth


@pytest.fixture(scope="module")
def documents(spark):
    rows = [("s", 1, '{"k":1,"a":{"b":[1,2.5],"c":null}}'), ("s", 1, '{"k":2}'), ("s", 2, '{"k":"x","a":{"b":[],"c":true},"n":{"m":[{"z":1}]}}'), ("s", 2, None), ("s", 2, "not json"), ("t", 1, "[]"), ("u", 1, "bad"), ("w", 1, nested(200))]
    return spark.createDataFrame(rows, "source string, day int, body string")


def test_census_and_changes(documents):
    census = schema_census(documents, ["source", "day"], "body")
    assert {(r.source, r.day): (r.documents, r.unreadable) for r in census.collect()} == {("s", 1): (2, 0), ("s", 2): (2, 1), ("t", 1): (1, 0), ("u", 1): (1, 1), ("w", 1): (1, 0)}
    paths = schema_paths(census, ["source", "day"])
    of = lambda source, day: {r.path: r.type for r in paths.filter(f"source = '{source}' and day = {day}").collect()}
    assert of("s", 1) == {"$": "OBJECT", "$.k": "BIGINT", "$.a": "OBJECT", "$.a.b": "ARRAY", "$.a.b[]": "DECIMAL", "$.a.c": "VOID"}
    assert of("u", 1).get("$") in (None, "VOID") and len(of("w", 1)) == 201
    found = schema_changes(paths.filter("day = 1 and source = 's'"), paths.filter("day = 2"), ["source"])
    assert {(r.path, r.change, r.old_type, r.new_type) for r in found.collect()} == {
        ("$.k", "retyped", "BIGINT", "STRING"), ("$.a.b[]", "retyped", "DECIMAL", "VOID"), ("$.a.c", "retyped", "VOID", "BOOLEAN"), ("$.n", "added", None, "OBJECT"),
        ("$.n.m", "added", None, "ARRAY"), ("$.n.m[]", "added", None, "OBJECT"), ("$.n.m[].z", "added", None, "BIGINT"),
    }
    back = schema_changes(paths.filter("day = 2"), paths.filter("day = 1 and source = 's'"), ["source"])
    assert {r.path for r in back.collect() if r.change == "removed"} == {"$.n", "$.n.m", "$.n.m[]", "$.n.m[].z"}


def test_types_that_do_not_fit(spark):
    docs = spark.createDataFrame([(1, json.dumps({"k": 1})), (1, json.dumps({"k": "x"}))], "g int, body string")
    assert {(r.path, r.type) for r in schema_paths(schema_census(docs, ["g"], "body"), ["g"]).collect()} == {("$", "OBJECT"), ("$.k", "VARIANT")}
    assert schema_paths(schema_census(docs.limit(0), ["g"], "body"), ["g"]).count() == 0
