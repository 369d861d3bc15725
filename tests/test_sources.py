import pytest
from pyspark.sql.types import StructType

from plumbline.shared import literal_rows, scratch_path
from plumbline.sources import files, jdbc


def test_null_texts(spark):
    path = scratch_path(spark, "csv")
    texts = ["1", "NA", "", "NaN", "null", "na"]
    literal_rows(spark, "id bigint, x string", list(enumerate(texts))).coalesce(1).write.option("header", True).csv(path)
    schema = StructType.fromDDL("id BIGINT, x STRING")
    assert [r.x for r in sorted(files.read_csv(spark, path, schema).collect())] == ["1", None, None, None, None, "na"]
    store = files.read_csv(spark, path, StructType.fromDDL("id BIGINT, x BIGINT"), files.OBJECT_STORE_TOKENS)
    assert [r.x for r in sorted(store.collect())] == [1, None, None, None, None, None]


def test_unreadable_cell_is_an_error_unless_lenient(spark):
    path = scratch_path(spark, "csv")
    literal_rows(spark, "x string", [("one",)]).write.option("header", True).csv(path)
    schema = StructType.fromDDL("x BIGINT")
    with pytest.raises(Exception):
        files.read_csv(spark, path, schema).collect()
    assert files.read_csv(spark, path, schema, strict=False).first().x is None


def test_snapshot_of_one_run_is_replaced_alone(spark):
    base = scratch_path(spark, "store")
    files.snapshot(spark.range(3), base, "01")
    files.snapshot(spark.range(5), base, "02")
    files.snapshot(spark.range(4), base, "01")
    counts = files.read_snapshot(spark, base).groupBy("run_id").count().collect()
    assert len(counts) == 2 and files.read_snapshot(spark, base, "02").count() == 5


def test_jdbc_options():
    ranges = jdbc.Partitioning("id", 1, 1001, 8)
    options = jdbc.read_options("jdbc:x", "people", "public", ranges, {"user": "u"})
    assert options["dbtable"] == "public.people" and options["user"] == "u"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "id", "1", "1001", "8")
    assert jdbc.read_options("jdbc:x", "people")["dbtable"] == "people"
    assert jdbc.read_options(' "jdbc:x" ', "people")["url"] == "jdbc:x"


def test_jdbc_modes(spark):
    assert jdbc.MODES == {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    with pytest.raises(ValueError):
        jdbc.write_table(spark.range(1), "jdbc:x", "t", mode="upsert")


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("plumbline_listed")
    assert "plumbline_listed" in jdbc.list_catalog_tables(spark)
