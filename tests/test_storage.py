import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.functions.keys import surrogate_key
from orewright.functions.numbers import safe_divide, stable_round
from orewright.session import work_folder
from orewright.sources import audit, files, tables


def text_file(tmp_path, name, body):
    path = tmp_path / name
    path.write_text(body)
    return str(path)


def test_headers_and_types_of_csv(spark, tmp_path):
    text_file(tmp_path, "t.csv", "id,amount,day\n1,2.50,2024-01-02\n")
    typed = files.read_csv(spark, str(tmp_path), "t", "id long, amount decimal(12,2), day date")
    assert [t for _, t in typed.dtypes] == ["bigint", "decimal(12,2)", "date"]
    assert dict(files.read_csv(spark, str(tmp_path), "t").dtypes)["id"] == "int"


def test_values_that_do_not_fit_become_null_and_quotes_stay(spark, tmp_path):
    path = text_file(tmp_path, "e.csv", 'id,name,salary,active\n1,"A",100,TRUE\n2,b,n/a,false\n3,,,\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("salary", T.LongType()), T.StructField("active", T.BooleanType())])
    assert values(files.read_typed_csv(spark, path, schema)) == [
        ("1", '"A"', 100, True), ("2", "b", None, False), ("3", None, None, None)]


def test_raw_landing_is_text_with_escapes(spark, tmp_path):
    path = text_file(tmp_path, "r.csv", 'a,b\n1,"x, \\"y\\""\n')
    assert values(files.land_raw(spark, path, ["a", "b"])) == [("1", 'x, "y"')]
    seed = files.load_seed(spark, path, ["a", "b"], {"a": "int"})
    assert dict(seed.dtypes) == {"a": "int", "b": "string"}


def test_stamps(spark, frame):
    row = tables.add_meta(frame([(1,)], "a int"), "x.csv", "2024-05-06", "2024-05-06 07:08:09").first()
    assert (row._source_file, row._batch_id, row._run_date) == ("x.csv", "20240506070809", "2024-05-06")


@pytest.fixture
def name(spark):
    import uuid
    table = f"t_{uuid.uuid4().hex}"
    yield table
    view = spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {table}")


def test_overwrite_append_and_merge(spark, frame, name):
    one, two = frame([(1,)], "a int"), frame([(2, "x")], "a int, b string")
    assert values(tables.write_table(one, name)) == [(1,)]
    assert values(tables.write_table(one, name, mode="append")) == [(1,), (1,)]
    with pytest.raises(ValueError):
        tables.write_table(two, name, mode="append")
    assert values(tables.write_table(two, name, mode="append", merge_schema=True)) == [(1, None), (1, None), (2, "x")]
    assert values(tables.write_table(one, name)) == [(1,)]


def test_a_table_can_be_rebuilt_from_itself(spark, frame, name):
    tables.write_table(frame([(1,), (2,)], "a int"), name)
    again = tables.replace_table(spark, name, tables.table(spark, name).filter("a > 1"))
    assert values(again) == [(2,)]
    assert values(tables.replace_table(spark, name, again)) == [(2,)]
    # A rebuilt table is still written to by its name.
    assert values(tables.write_table(frame([(3, "x")], "a int, b string"), name, mode="append", merge_schema=True)) == [(2, None), (3, "x")]
    assert values(tables.write_table(frame([(4,)], "a int"), name)) == [(4,)]


def test_references_copy_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    tables.write_path(frame([(1, "x")], "a int, k string"), path, partition_by=["k"])
    refs = tables.register_refs(spark, {"ref_p": path})
    assert spark.sql("SELECT a FROM ref_p WHERE k = 'x'").first().a == 1 and refs["ref_p"].count() == 1


def test_audit_rows_need_their_fields(spark, tmp_path):
    good = {"pipeline_name": "p", "pipeline_run_id": "1", "run_date": "d", "layer": "gold", "status": "SUCCESS",
            "error_message": "", "duration_seconds": ""}
    with pytest.raises(ValueError):
        audit.audit_rows(spark, [{**good, "status": ""}], "now")
    rows = audit.audit_rows(spark, [good, {**good, "duration_seconds": 5, "error_message": "x"}], "now")
    path = str(tmp_path / "audit")
    audit.append_audit(rows, path)
    assert audit.append_audit(rows, path).count() == 4
    assert values(rows, "error_message", "duration_seconds") == [("x", 5), (None, None)]


def test_the_work_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(base) and work_folder(spark, "x") != work_folder(spark, "x")


def test_keys_and_numbers(spark):
    df = spark.sql("SELECT 'a' a, CAST(NULL AS STRING) b, 0 z, 1.005D x")
    row = df.select(surrogate_key(F.col("a")), surrogate_key(F.col("a"), F.col("b")),
                    safe_divide(F.lit(1), F.col("z")), safe_divide(F.lit(1), F.col("z"), 0),
                    stable_round(F.col("x"), 2)).first()
    assert row[0] == "0cc175b9c0f1b6a831c399e269772661" and row[1] != row[0]
    assert tuple(row)[2:] == (None, 0.0, 1.01)


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.createDataFrame([("1", "x")], "b string, a string").write.csv(path, header=True)
    schema = T.StructType.fromDDL("a string, b int")
    assert files.read_typed_csv(spark, path, schema).collect() == [("x", 1)]
    assert files.read_csv(spark, str(tmp_path), "t", schema).collect() == [("x", 1)]
    assert files.land_raw(spark, path, ["a", "b"]).collect() == [("x", "1")]
    for columns in (["a"], ["a", "b", "c"], ["a", "c"]):
        with pytest.raises(ValueError, match="has columns"):
            files.load_seed(spark, path, columns)


def test_an_append_with_new_columns_leaves_old_files(spark, tmp_path):
    spark.sql(f"CREATE DATABASE grown LOCATION '{tmp_path}/grown'")
    tables.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), "grown.t")
    before = set((tmp_path / "grown/t").glob("*.parquet"))
    got = tables.write_table(spark.createDataFrame([(2, 2.5)], "a int, c double"), "grown.t", mode="append", merge_schema=True)
    assert values(got) == [(1, "x", None), (2, None, 2.5)]
    assert before < set((tmp_path / "grown/t").glob("*.parquet"))
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "a int, day string")
    tables.write_table(rows, "grown.p", partition_by=["day"])
    more = tables.write_table(rows.selectExpr("a + 2 AS a", "day", "a * 1.5D AS c"), "grown.p", mode="append", merge_schema=True)
    assert values(more, "a", "day", "c") == [(1, "x", None), (2, "y", None), (3, "x", 1.5), (4, "y", 3.0)]
    assert sorted(p.name for p in (tmp_path / "grown/p").glob("day=*")) == ["day=x", "day=y"]
    spark.sql("DROP DATABASE grown CASCADE")
