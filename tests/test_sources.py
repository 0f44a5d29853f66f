import datetime as dt

import pytest

from outcomekit import session
from outcomekit.sources import customer_outcomes, read_csv, read_parquet, write_csv
from outcomekit.sources.checked import read_csv_checked
from outcomekit.sources.files import SourceNotFound


def test_missing_path_is_a_clear_error(spark, tmp_path):
    for read in (read_csv, read_parquet):
        with pytest.raises(SourceNotFound, match="nowhere"):
            read(spark, str(tmp_path / "nowhere"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, " ", 2.5), (2, "x, y", None)], "k int, s string, v double")
    write_csv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    back = read_csv(spark, str(tmp_path / "out"), df.schema)
    assert back.count() == 2 and back.where("s = 'x, y'").count() == 1
    assert read_csv(spark, str(tmp_path / "out")).dtypes[0] == ("k", "int")


def test_single_file_is_for_reports(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 10"):
        write_csv(spark.range(11).toDF("k"), str(tmp_path / "big"), single_file=True, max_single_rows=10)


def test_stage_reads_back_the_same_rows(spark):
    df = spark.range(100).selectExpr("id", "array(double(id)) AS v")
    staged = session.stage(df)
    assert staged.schema.simpleString() == df.schema.simpleString() and staged.exceptAll(df).count() == 0


def test_small_table_is_only_broadcast_when_small(spark):
    df = spark.range(100).toDF("k")
    small, large = session.small_table(df, 100), session.small_table(df, 99)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan(small) and "LocalRelation" not in plan(large)
    assert small.count() == large.count() == 100


def test_customer_outcomes_keep_features_and_outcome_apart(spark):
    day = lambda y, m, d: dt.datetime(y, m, d)
    orders = spark.createDataFrame(
        [
            (1, 1, "P", 10.5, day(2000, 1, 1), "1-URGENT"),
            (2, 1, "O", 20.25, day(2000, 3, 1), "5-LOW"),
            (3, 1, "O", 99.0, day(2001, 6, 1), "2-HIGH"),
            (4, 2, "O", 7.0, day(2000, 2, 1), "2-HIGH"),
            (5, 3, "P", 5.0, day(2001, 6, 2), "2-HIGH"),
        ],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    )
    lines = spark.createDataFrame([(2, "R"), (2, "R"), (4, "N")], "l_orderkey bigint, l_returnflag string")
    customer = spark.createDataFrame(
        [(1, 0, 5.0, "A"), (2, 0, -5.0, "B"), (3, 1, 0.0, "A"), (4, 1, 1.0, "B")],
        "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    nation = spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int")
    region = spark.createDataFrame([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string")
    out = customer_outcomes(customer, orders, lines, nation, region, cutoff=day(2000, 12, 31))
    got = {r.customer_id: r for r in out.collect()}
    one, two, three, four = (got[i] for i in (1, 2, 3, 4))
    assert (one.tenure, one.total_charges_raw, one.contract, one.paperless, one.has_returns, one.churn) == (
        12, "30.75", "5-LOW", "Yes", "Yes", "No",
    )
    assert one.monthly_charges == 30.75 / 12 and one.region == "EAST"
    assert (two.senior, two.has_returns, two.paperless, two.churn) == (1, "No", "No", "Yes")
    assert (three.tenure, three.total_charges_raw, three.contract, three.has_returns, three.churn) == (
        0, " ", "No orders", "No orders", "No",
    )
    assert (four.monthly_charges, four.churn) == (0.0, "Yes")


def _files(tmp_path, *texts):
    folder = tmp_path / "csv"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"part-{i}.csv").write_text(text)
    return str(folder)


def test_checked_csv_widens_what_the_sample_did_not_show(spark, tmp_path):
    head = "k,n,big,d,day,flag,s\n"
    # Spark reads the longest file first.
    path = _files(
        tmp_path,
        head + f"1,1,1,1.5,2020-01-01,true,{'x' * 200}\n2,2,2,2.5,2020-01-02,false,y\n",
        head + "3,2.5,9999999999,oops,2020-01-03 10:00:00,maybe,\n4,,007,1e2,,,z\n",
    )
    got = read_csv_checked(spark, path, sample_rows=2)
    assert {c: (of[0], of[1], of[2]) for c, of in got.columns.items()} == {
        "k": ("int", "int", 0), "n": ("int", "double", 1), "big": ("int", "bigint", 1), "d": ("double", "string", 1),
        "day": ("date", "timestamp", 1), "flag": ("boolean", "string", 1), "s": ("string", "string", 0),
    }
    rows = {r.k: r for r in got.rows.collect()}
    assert [rows[k].n for k in (1, 2, 3, 4)] == [1.0, 2.0, 2.5, None]
    assert [rows[k].big for k in (1, 2, 3, 4)] == [1, 2, 9999999999, 7]
    # Text as it was written, of values that fitted a number too.
    assert [rows[k].d for k in (1, 2, 3, 4)] == ["1.5", "2.5", "oops", "1e2"]
    assert [rows[k].flag for k in (1, 2, 3, 4)] == ["true", "false", "maybe", None]
    assert rows[1].day == dt.datetime(2020, 1, 1) and rows[3].day == dt.datetime(2020, 1, 3, 10)
    assert (got.n_rows, got.n_broken) == (4, 0) and got.report().count() == 7


def test_checked_csv_may_lose_a_stated_share(spark, tmp_path):
    path = _files(tmp_path, "k,v\n" + "".join(f"{i},{i}.5\n" for i in range(9)) + "9,n/a\n")
    strict, loose = (read_csv_checked(spark, path, sample_rows=3, allow=a) for a in (0.0, 0.1))
    assert strict.columns["v"] == ("double", "string", 1, 0) and loose.columns["v"] == ("double", "double", 1, 1)
    assert loose.rows.where("v IS NULL").count() == 1 and strict.rows.where("v = 'n/a'").count() == 1


def test_checked_csv_of_odd_files(spark, tmp_path):
    path = _files(tmp_path, "a.b,c\n1,2\n3\n4,5,6\n")
    got = read_csv_checked(spark, path)
    assert (got.n_rows, got.n_broken) == (3, 2) and got.rows.columns == ["a.b", "c"]
    assert sorted(r[0] for r in got.rows.collect()) == [1, 3, 4]
    (tmp_path / "bare").mkdir()
    (tmp_path / "bare" / "x.csv").write_text("a,b\n")
    bare = read_csv_checked(spark, str(tmp_path / "bare"))
    assert bare.n_rows == 0 and bare.rows.dtypes == [("a", "string"), ("b", "string")]
    with pytest.raises(SourceNotFound, match="nowhere"):
        read_csv_checked(spark, str(tmp_path / "nowhere"))


def test_checked_csv_reads_the_files_once(spark, tmp_path):
    path = _files(tmp_path, "k,v\n1,2\n2,x\n")
    plan = read_csv_checked(spark, path, sample_rows=1).rows._jdf.queryExecution().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan
