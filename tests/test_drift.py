"""Fields of JSON lines against the declared ones."""

from tillworks.operators.drift import schema_drift

DECLARED = {"id": "text", "n": "number", "gone": "text"}


def report(spark, *lines):
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r.field: (r.kind, r.lines, r.nulls, r.status) for r in schema_drift(rows, DECLARED).collect()}


def test_new_missing_and_changed_fields(spark):
    got = report(spark, '{"id":"a","n":1,"x":true}', '{"id":null,"n":2.5,"x":false,"o":{"p":[1]}}', '{"id":"b","n":1e300,"l":[1,"a"]}')
    assert got == {
        "id": ("text", 3, 1, "declared"), "n": ("number", 3, 0, "declared"), "gone": (None, 0, 0, "missing"),
        "x": ("boolean", 2, 0, "new"), "o": ("object", 1, 0, "new"), "l": ("array", 1, 0, "new"),
    }


def test_types_that_do_not_go_together(spark):
    assert report(spark, '{"n":"1"}')["n"] == ("text", 1, 0, "changed")
    assert report(spark, '{"n":"1"}', '{"n":1}')["n"] == ("mixed", 2, 0, "changed")
    assert report(spark, '{"n":null}')["n"] == ("null", 1, 1, "declared")


def test_lines_without_fields(spark):
    nothing = {f: (None, 0, 0, "missing") for f in DECLARED}
    assert report(spark) == nothing
    assert report(spark, None, "", "{", "[1]", "3", "{}", '{"n":1,"n":2}') == nothing


def test_odd_names(spark):
    got = report(spark, '{"a.b":1,"ä ö":"x","":2,"' + "long" * 100 + '":null}')
    assert {k: v[0] for k, v in got.items() if v[3] == "new"} == {"a.b": "number", "ä ö": "text", "": "number", "long" * 100: "null"}
