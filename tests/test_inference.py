"""CSV types from the first rows: late values, null spellings, odd files."""

import pytest

from riskframe.sources.catalog import read_csv_table
from riskframe.sources.inference import infer_csv


def _csv(tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_late_values_read_as_null_and_are_counted(spark, tmp_path):
    path = _csv(tmp_path, "late.csv", ["n,x,flag,text"] + [f"{i},{i}.5,{'TRUE' if i % 2 else 'false'},t{i}" for i in range(30)] + ["1.5,abc,maybe,", "NA, n/a ,,NA", "7,1e3,true,z"])
    table = infer_csv(spark, path, sample_rows=30, null_spellings=["NA", "n/a"])
    assert dict(table.types) == {"n": "bigint", "x": "double", "flag": "boolean", "text": "string"}
    got = {r.column: (r.type, r.rows, r.nulls, r.unparsed) for r in table.failures().collect()}
    assert got == {"n": ("bigint", 33, 1, 1), "x": ("double", 33, 1, 1), "flag": ("boolean", 33, 1, 1), "text": ("string", 33, 2, 0)}
    df = table.read()
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "flag": "boolean", "text": "string"}
    assert [tuple(r) for r in df.collect()[-3:]] == [(None, None, None, None), (None, None, None, None), (7, 1000.0, True, "z")]
    assert table.read(["x"], 4).count() == 4 and table.read(["x"]).columns == ["x"]
    again = infer_csv(spark, path, sample_rows=33, null_spellings=["NA", "n/a"])
    assert dict(again.types) == {"n": "double", "x": "string", "flag": "string", "text": "string"}
    fixed = infer_csv(spark, path, sample_rows=30, null_spellings=["NA", "n/a"], types={"n": "double"})
    assert fixed.types["n"] == "double" and fixed.failures().where("column = 'n'").first().unparsed == 0
    with pytest.raises(ValueError):
        infer_csv(spark, path, types={"other": "double"})


def test_odd_files(spark, tmp_path):
    empty = infer_csv(spark, _csv(tmp_path, "empty.csv", ["a,b"]))
    assert dict(empty.types) == {"a": "string", "b": "string"} and empty.read().count() == 0 and empty.failures().count() == 2
    big = infer_csv(spark, _csv(tmp_path, "big.csv", ["a.b,null col", "9999999999999999999,NaN", "-3,null"]))
    assert dict(big.types) == {"a.b": "double", "null col": "string"}  # beyond 64 bits
    assert [r.unparsed for r in big.failures().collect()] == [0, 0]
    assert [r["null col"] for r in big.read().collect()] == [None, None]
    parts = tmp_path / "parts"
    parts.mkdir()
    _csv(parts, "a.csv", ["v", "1", "2"])
    _csv(parts, "b.csv", ["v", "3", "x"])
    assert infer_csv(spark, str(parts), sample_rows=3).types["v"] == "bigint" and infer_csv(spark, str(parts), sample_rows=4).types["v"] == "string"


def test_declared_types_take_null_spellings_too(spark, tmp_path):
    path = _csv(tmp_path, "typed.csv", ["k,x,s,other", "1,NA,NA,q", "n/a, 2.5,n/a,NA", ",,,", "3,-,-,-"])
    schema = "k long, x double, s string"
    from pyspark.sql.types import _parse_datatype_string

    df = read_csv_table(spark, path, _parse_datatype_string(schema), null_values=["NA", "n/a", "-"])
    assert df.dtypes == [("k", "bigint"), ("x", "double"), ("s", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, None, None), (None, 2.5, None), (None, None, None), (3, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|MALFORMED"):
        read_csv_table(spark, path, _parse_datatype_string(schema), null_values=["NA"]).collect()
    untyped = read_csv_table(spark, path, columns=["x", "k"], null_values=["NA", "n/a", "-"])
    assert untyped.dtypes == [("x", "double"), ("k", "bigint")] and [tuple(r) for r in untyped.collect()][:2] == [(None, 1), (2.5, None)]
    assert read_csv_table(spark, path).dtypes[3] == ("other", "string")
