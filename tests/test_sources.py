"""Readers, writers and the catalog."""

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.sources import scratch
from corbel.sources.catalog import create_database, database, save_table, transfer_tables
from corbel.sources.readers import (
    conform,
    from_rows,
    jdbc_options,
    jdbc_tables,
    number_range,
    quarantine,
    read_csv,
    read_format,
    read_jdbc,
    read_json,
    read_text,
    split_damaged,
    strict,
)
from corbel.sources.writers import (
    replace_partitions,
    write_csv,
    write_jdbc,
    write_json,
    write_json_arrays,
    write_parquet,
    write_partitioned,
    write_partitions,
    write_text,
    written_files,
)
from corbel.plans.catalogue import QUERIES
from corbel.plans.tables import table
from tests.conftest import plan_of, rows

CAR = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("power", T.LongType())]
)


@pytest.fixture
def broken(tmp_path):
    path = tmp_path / "cars.json"
    path.write_text('{"name": "a", "power": 1}\n{"name": "b", "pow\n')
    return str(path)


def test_failfast_and_quarantine(spark, broken):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json(spark, broken, CAR, **strict()).collect()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_format(spark, "json", CAR, **strict({"path": broken})).collect()
    schema, options = quarantine(CAR)
    found = read_json(spark, broken, schema, **options).collect()
    assert [row._corrupt_record for row in found] == [None, '{"name": "b", "pow']


def test_damaged_lines_are_split_once(spark, tmp_path):
    """Counts and single columns see the same damage as whole rows do."""
    path = tmp_path / "cars.json"
    lines = ['{"name": "a", "power": 1}', '{"name": "b", "pow', '{"name": "c", "power": "many"}',
             '{"name": "d"}', "7", '{"name": null, "power": 5, "more": 1}']
    path.write_text("\n".join(lines) + "\n")
    good, damaged = split_damaged(spark, "json", str(path), CAR)
    assert good.schema == CAR
    assert rows(good) == sorted([("a", 1), ("d", None), (None, 5)], key=repr)
    assert sorted(row.line for row in damaged.collect()) == sorted([lines[1], lines[2], lines[4]])
    assert good.count() == 3 and damaged.count() == 3 and len(rows(good.select("name"))) == 3
    path.write_text("")
    good, damaged = split_damaged(spark, "json", str(path), CAR)
    assert good.collect() == [] and damaged.collect() == []


def test_damaged_csv(spark, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text("name,power\na,1\nb,x\n")
    good, damaged = split_damaged(spark, "csv", str(path), CAR, header=True)
    assert rows(good) == [("a", 1)] and [row.line for row in damaged.collect()] == ["b,x"]


def test_borrowed_schema_and_inference(spark, tmp_path):
    path = str(tmp_path / "cars")
    write_json(spark.createDataFrame([("z", 3, None)], "name string, power long, nothing string"), path)
    inferred = read_json(spark, path)
    assert inferred.dtypes == [("name", "string"), ("power", "bigint")]
    assert rows(read_json(spark, path, inferred.schema)) == [("z", 3)]


def test_json_flags(spark, tmp_path):
    path = tmp_path / "q.json"
    path.write_text("{'day': '31/12/1999'}\n{'day': 'never'}\n")
    options = {"allowSingleQuotes": True, "dateFormat": "dd/MM/yyyy"}
    days = read_json(spark, str(path), "day DATE", **options).collect()
    assert [str(row.day) for row in days] == ["1999-12-31", "None"]


def test_multiline_array(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('[\n {"id": 1,\n "c": {"e": "x"}},\n {"id": 2}\n]')
    assert rows(read_json(spark, str(path), multiLine=True).select("id", "c.e")) == [(1, "x"), (2, None)]


def test_csv_schema_and_inference(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("symbol,date,price\nA,Jan 1 2000,1.5\nB,,2\n")
    typed = read_csv(spark, str(path), "symbol STRING, date DATE, price DOUBLE", dateFormat="MMM d yyyy", nullValue="")
    assert [(r.symbol, str(r.date), r.price) for r in typed.collect()] == [("A", "2000-01-01", 1.5), ("B", "None", 2.0)]
    assert dict(read_csv(spark, str(path)).dtypes)["price"] == "double"


def test_tsv_and_text(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", 1), ('q"q', 2), ("é", 3)], "t string, n long")
    write_csv(df, str(tmp_path / "tsv"), sep="\t")
    assert rows(read_csv(spark, str(tmp_path / "tsv"), df.schema, sep="\t")) == rows(df)
    write_text(df.select("t"), str(tmp_path / "text"))
    assert read_text(spark, str(tmp_path / "text")).columns == ["value"]


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "modes")
    one, two = spark.range(1), spark.range(2)
    write_parquet(one, path, "error")
    with pytest.raises(AnalysisException):
        write_parquet(two, path, "error")
    write_parquet(two, path, "ignore")
    assert spark.read.parquet(path).count() == 1
    write_parquet(two, path, "append")
    assert spark.read.parquet(path).count() == 3
    write_parquet(two, path, "overwrite")
    assert spark.read.parquet(path).count() == 2
    assert glob.glob(f"{path}/*.snappy.parquet")


def test_single_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "n int, kind string")
    write_partitioned(df, path, ["kind"])
    write_partitioned(df.filter("n = 3"), path, ["kind"], mode="append")
    replace_partitions(spark.createDataFrame([(9, "a"), (8, "c")], df.schema), path, ["kind"])
    found = spark.read.schema(df.schema).parquet(path)
    assert rows(found) == [(2, "b"), (3, "b"), (3, "b"), (8, "c"), (9, "a")]
    replace_partitions(df.limit(0), path, ["kind"])
    assert found.count() == 5
    write_partitioned(df.limit(1), path, ["kind"])
    assert rows(spark.read.schema(df.schema).parquet(path)) == [(1, "a")]


def test_written_files(spark, tmp_path):
    path = str(tmp_path / "files")
    write_partitions(spark.range(0, 300, numPartitions=4), path, 3)
    found = written_files(spark, path)
    assert found.columns == ["file", "rows"] and found.count() == files(path) == 3
    assert found.agg({"rows": "sum"}).first()[0] == 300
    assert "ReadSchema: struct<>" in plan_of(found)


def test_json_arrays(spark, tmp_path):
    df = spark.createDataFrame([(n, [f"{n}\n", None]) for n in range(500)], "n long, texts array<string>")
    for pretty in (False, True):
        path = str(tmp_path / f"arrays{pretty}")
        write_json_arrays(df, path, pretty)
        assert rows(read_json(spark, path, df.schema, multiLine=True)) == rows(df)


def test_json_arrays_are_bounded(spark, tmp_path):
    """Files hold about as many bytes as asked for, also of equal rows from one partition."""
    df = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("text"))
    path = tmp_path / "bounded"
    write_json_arrays(df, str(path), array_bytes=100_000)
    sizes = [part.stat().st_size for part in path.glob("part-*")]
    assert max(sizes) < 200_000 and sum(sizes) > 4_000_000
    assert rows(read_json(spark, str(path), df.schema, multiLine=True)) == rows(df)
    write_json_arrays(df.limit(0), str(path))
    assert read_json(spark, str(path), df.schema, multiLine=True).count() == 0


def test_json_arrays_are_made_behind_the_shuffle(spark, tmp_path, monkeypatch):
    """Rows are dealt out, not their JSON, and no array is gathered in one row."""
    from corbel.sources import writers

    plans = []
    monkeypatch.setattr(writers, "write_text", lambda lines, *args, **options: plans.append(plan_of(lines)))
    write_json_arrays(spark.range(9).select(F.col("id"), F.array("id").alias("ids")), str(tmp_path / "plan"))
    above, below = plans[0].split("Exchange", 1)
    assert "StructsToJson" in above and "StructsToJson" not in below and "collect_list" not in plans[0]


def test_json_arrays_in_rounds(spark, tmp_path, monkeypatch):
    """Each row is written in one of the rounds, also equal rows, and shuffles are cleared after it."""
    from corbel.sources import writers

    monkeypatch.setattr(writers, "ROUND_FILES", 1)
    modes = []
    write = writers.write_text
    monkeypatch.setattr(
        writers, "write_text", lambda df, path, mode, **options: modes.append(mode) or write(df, path, mode, **options)
    )
    df = spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 40).alias("n"), F.repeat(F.lit("ab "), 9).alias("text")
    )
    path = tmp_path / "rounds"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    write_json_arrays(
        df, str(path), array_bytes=5000, item=F.struct("n", F.upper("text").alias("text")),
        item_bytes=F.lit(50), rounds=3, compression="gzip",
    )
    assert modes == ["overwrite", "append", "append"] and spark.conf.get(cleanup, None) == before
    parts = list(path.glob("part-*"))
    assert len(parts) > 20 and all(part.suffix == ".gz" for part in parts)
    found = read_json(spark, str(path), "n LONG, text STRING", multiLine=True, mode="FAILFAST")
    assert rows(found) == rows(df.select("n", F.upper("text")))


def test_stored_once(spark, tmp_path):
    """A fixture is written once, again when its source changes or it is gone."""
    import shutil

    source, made = tmp_path / "source.txt", []
    source.write_text("one")

    def write(path):
        made.append(path)
        spark.range(1).write.mode("overwrite").parquet(path)

    first = scratch.stored_once(spark, str(source), "fixture", write)
    assert scratch.stored_once(spark, str(source), "fixture", write) == first
    source.write_text("longer")
    second = scratch.stored_once(spark, str(source), "fixture", write)
    assert second != first and made == [first, second]
    shutil.rmtree(second.removeprefix("file://"))
    assert scratch.stored_once(spark, str(source), "fixture", write) not in (first, second)


def files(path):
    return len(glob.glob(os.path.join(path, "part-*")))


def test_partition_counts(spark, tmp_path):
    df = spark.range(0, 3000, numPartitions=8)
    thirty, fifteen, grown, sized = (str(tmp_path / name) for name in ("a", "b", "c", "d"))
    write_partitions(df, thirty, 30)
    write_partitions(df.repartition(30), fifteen, 15, shuffle=False)
    # Merging never adds partitions.
    write_partitions(spark.range(0, 3000, numPartitions=4), grown, 15, shuffle=False)
    write_partitions(df, sized)
    assert [files(path) for path in (thirty, fifteen, grown)] == [30, 15, 4]
    assert files(sized) == 1
    assert spark.read.parquet(thirty, fifteen, grown, sized).count() == 12000


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "public.t", "d.Driver", "u", "p")
    assert plain["dbtable"] == "public.t" and "numPartitions" not in plain
    split = jdbc_options("jdbc:x", "t", "d", partition_column="id", bounds=(1, 9), partitions=4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "9", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "d", partitions=4)


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.seen = {}
        self.read = self.write = self

    def format(self, kind):
        self.seen["format"] = kind
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen

    save = load


def test_jdbc_calls():
    # No database is at hand that executors could share, so only the calls are checked.
    options = jdbc_options("jdbc:x", "t", "d", "u", "p")
    assert read_jdbc(Recorder(), options) == {"format": "jdbc", **options}
    assert jdbc_tables(Recorder(), options, "public")("staff")["dbtable"] == "public.staff"
    target = Recorder()
    write_jdbc(target, options, connections=4)
    assert target.seen == {
        "format": "jdbc", "mode": "error", **options, "batchsize": 10_000, "numPartitions": 4
    }


def test_local_rows(spark, capsys):
    tuples = [("a", 1), ("b", 2)]
    assert from_rows(spark, tuples).columns == ["_1", "_2"]
    assert from_rows(spark, tuples, ["make", "screen size"]).columns == ["make", "screen size"]
    by_row = from_rows(spark, [Row(name="a", power=1)], CAR)
    assert by_row.schema == CAR
    by_row.show(truncate=False)
    by_row.printSchema()
    assert "power" in capsys.readouterr().out
    assert from_rows(spark, tuples).take(1) == [("a", 1)]
    # Records of the lower-level API become a frame again with a schema.
    assert spark.createDataFrame(by_row.rdd, CAR).collect() == by_row.collect()


def test_number_range(spark):
    numbers = number_range(spark, 1, 10)
    assert numbers.columns == ["value"] and numbers.agg({"value": "sum"}).first()[0] == 55


def test_conform(spark):
    df = spark.sql("SELECT 'x' AS extra, CAST(1 AS INT) AS power, 'a' AS name")
    assert conform(df, CAR).collect() == [Row(name="a", power=1)]
    with pytest.raises(AnalysisException):
        conform(df.drop("name"), T.StructType([T.StructField("name", T.StringType(), False)]))
    with pytest.raises(AnalysisException):
        conform(spark.sql("SELECT array(1) AS name, 1L AS power"), CAR)


def test_databases_and_transfer(spark, tmp_path):
    create_database(spark, "shop", str(tmp_path / "shop's"))
    create_database(spark, "shop")
    assert "shop" in [item.name for item in spark.catalog.listDatabases()]
    assert ("shop",) in rows(spark.sql("SHOW DATABASES"))
    sources = {"staff": spark.range(3), "teams": spark.range(2)}
    before = spark.catalog.currentDatabase()
    with database(spark, "shop"):
        transfer_tables(spark, sources.__getitem__, sources, write=True)
        assert spark.read.table("staff").count() == 3
        save_table(spark.range(9), "staff")
        # The stored table is read, not the view.
        assert spark.read.table("staff").count() == 9
        assert spark.read.table("src_staff").count() == 3
    assert spark.catalog.currentDatabase() == before
    transfer_tables(spark, sources.__getitem__, ["teams"], view_prefix="only_view_")
    assert not spark.catalog.tableExists("teams") and spark.table("only_view_teams").count() == 2
    spark.sql("DROP DATABASE shop CASCADE")


def test_scratch_is_in_the_shared_folder(spark):
    path = scratch.scratch_path(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or scratch._local_root()
    assert path.startswith(f"{root}/x-") and os.listdir(path) == []
    assert path != scratch.scratch_path(spark, "x")


def test_scratch_without_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(Session, "x")


def test_partitioned_sink_gives_all_rows(spark):
    """Every order comes back from each layout, beside what was counted in its files."""
    sf_dir = "/root/testdata/sf0.001"
    df = QUERIES["sink_partitioned"](spark, sf_dir)
    keys = [row.o_orderkey for row in table(spark, sf_dir, "orders").collect()]
    for layout, files in (("shuffled", 30), ("merged", 15), ("measured", 1)):
        found = df.filter(F.col("layout") == layout).collect()
        assert sorted(row.o_orderkey for row in found) == sorted(keys)
        assert {(row.files, row.rows, row["keys"]) for row in found} == {(files, len(keys), sum(keys))}
