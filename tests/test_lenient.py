"""The lenient scan gives the rows of ``pandas.read_csv(on_bad_lines='skip')``."""

import pandas as pd
import pytest

from tunelake.sources.charts import read_lenient_csv

FILES = {
    "a.csv": 'id,place,x\n1,"x\ny",2\n\n2,"a ""q"" b, c",3\n3\n4,p,5,6\n5,p,6,\n   \n6,NA,"7"\n7,"unq"\n"",,\n',
    "b.csv": '\n  \nplace,id\n"u\r\nv",8\nw,9,\n"multi\n\nline",10\n',
    "c.csv": "\ufeffx,id,zz,id\n1,2,3,4\n5,6\n",
    "d.csv": "place,id\n",
    "f.csv": 'place\n  \n" "\n""\nx\n\ny,\n',
    "e.csv": '"place",id\r\nr,11\r\n"s,t",12\r\n',
}


def rows(df):
    return sorted(repr(tuple(None if pd.isna(v) else v for v in r)) for r in df)


@pytest.mark.parametrize("names", [list(FILES), ["a.csv"], ["b.csv"], ["a.csv", "d.csv"], ["e.csv", "b.csv"], ["f.csv", "a.csv"]])
def test_records_and_headers_as_pandas_has_them(spark, tmp_path, names):
    for n in names:
        (tmp_path / n).write_text(FILES[n], newline="")
    got = read_lenient_csv(spark, str(tmp_path))
    want = [pd.read_csv(tmp_path / n, on_bad_lines="skip", dtype=str) for n in names]
    assert sorted(got.columns) == sorted(set().union(*(w.columns for w in want)))
    want = pd.concat(want).reindex(columns=got.columns)
    assert rows(got.collect()) == rows(want.itertuples(index=False))


def test_columns_are_bound_by_each_files_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("id,place\n1,x\n")
    (tmp_path / "2.csv").write_text("place,id,more\ny,2,z\n")
    got = read_lenient_csv(spark, str(tmp_path), ["place", "absent", "more"])
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("x", "-", "-"), ("y", "-", "z")]
    with pytest.raises(ValueError):
        read_lenient_csv(spark, str(tmp_path), max_headers=1)


def test_one_header_needs_no_join_and_lines_can_be_split(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("id,place\n" + "".join(f"{i}{j},p\n" for j in range(50)))
    df = read_lenient_csv(spark, str(tmp_path), multi_line=False)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString() and df.count() == 150


def test_no_files_give_typed_rows_only_for_asked_columns(spark, tmp_path):
    (tmp_path / "blank.csv").write_text("\n \n")
    assert read_lenient_csv(spark, str(tmp_path), ["id"]).count() == 0
    with pytest.raises(ValueError):
        read_lenient_csv(spark, str(tmp_path))
