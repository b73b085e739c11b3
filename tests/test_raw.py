"""Raw zone: formats, lineage, order, and what makes a read fail."""

import re

import pytest
from records import record
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from haulmark.plans.contract import ContractError
from haulmark.plans.warehouse import Warehouse
from haulmark.schemas import RAW_SCHEMA
from haulmark.sources.lake import register_lake
from haulmark.sources.objects import ObjectStore
from haulmark.operators import keyed
from haulmark.operators.first_wins import first_attributes, first_rows
from haulmark.sources.raw import (
    ORDER,
    _lineage,
    positioned,
    raw_key,
    read_raw,
    write_raw,
    write_runs,
)
from workload import feed


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip_with_lineage(spark, frame, tmp_path, fmt):
    root = f"file:{tmp_path}"
    records = frame(record(1), record(2, status="failed", weather_condition=None))
    key = write_raw(records, root, "20240203", fmt)
    found = read_raw(spark, root)
    assert key == f"raw/shipments_20240203.{fmt}"
    assert [r["raw_file"] for r in found.select("raw_file").distinct().collect()] == [key]
    back = found.select(*RAW_SCHEMA)
    assert back.dtypes == records.dtypes
    assert back.exceptAll(records).isEmpty() and records.exceptAll(back).isEmpty()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_position_is_file_order(spark, frame, tmp_path, fmt):
    root = f"file:{tmp_path}"
    rows = [record(n, delay_minutes=n) for n in range(500)]
    write_raw(frame(*rows), root, "a", fmt)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")  # several blocks per file
    try:
        found = read_raw(spark, root).orderBy(*ORDER).select("delay_minutes").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[0] for r in found] == list(range(500))


def test_csv_runs_are_packed_and_plain_ones_read(spark, frame, tmp_path):
    """Less than half the plain text's size; rows of either are numbered in file order."""
    root = f"file:{tmp_path}"
    rows = frame(*[record(n, delay_minutes=n) for n in range(600)])
    packed, plain = write_raw(rows.repartitionByRange(3, "delay_minutes"), root, "a", "csv"), raw_key("b", "csv")
    rows.write.option("header", True).csv(f"{root}/{plain}")
    size = {key: sum(f.stat().st_size for f in (tmp_path / key).glob("part-*")) for key in (packed, plain)}
    assert size[packed] < size[plain] / 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")  # plain parts are split
    try:
        found = read_raw(spark, root).orderBy(*ORDER).select("raw_file", "delay_minutes").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in found] == [(key, n) for key in (packed, plain) for n in range(600)]


def test_both_formats_together(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a", "csv")
    write_raw(frame(record(2), record(3)), root, "b", "parquet")
    assert read_raw(spark, root).count() == 3
    assert read_raw(spark, root, formats=("csv",)).count() == 1
    assert read_raw(spark, root, run="b").count() == 2


def test_single_files_with_foreign_types(spark, frame, tmp_path):
    """One flat file per run, numbers as doubles and times as text."""
    loose = frame(record(1)).select(
        *[
            F.col(name).cast("double" if kind.startswith("decimal") else kind).alias(name)
            if kind != "timestamp"
            else F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss").alias(name)
            for name, kind in RAW_SCHEMA.items()
        ]
    )
    (tmp_path / "raw").mkdir()
    loose.toPandas().to_parquet(tmp_path / "raw" / "shipments_x.parquet", index=False)
    loose.toPandas().to_csv(tmp_path / "raw" / "shipments_y.csv", index=False)
    found = read_raw(spark, f"file:{tmp_path}")
    assert found.count() == 2
    assert found.select(*RAW_SCHEMA).exceptAll(frame(record(1), record(1))).isEmpty()


def test_no_raw_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, f"file:{tmp_path}")


def test_header_must_match(spark, frame, tmp_path):
    swapped = frame(record(1)).select(*reversed(RAW_SCHEMA))
    swapped.write.option("header", True).csv(f"file:{tmp_path}/{raw_key('a', 'csv')}")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        read_raw(spark, f"file:{tmp_path}").collect()


def test_missing_column(spark, frame, tmp_path):
    path = f"file:{tmp_path}/{raw_key('a', 'parquet')}"
    frame(record(1)).drop("region").write.parquet(path)
    with pytest.raises(ValueError, match="region"):
        read_raw(spark, f"file:{tmp_path}")


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"company_name": None}, "company_name is null"),
        ({"destination_city": None}, "destination_city is null"),
        ({"status": "x" * 21}, "status longer than 20"),
    ],
)
def test_contract_stops_the_load(spark, frame, tmp_path, change, rule):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1), record(2, **change)), root, "a")
    wh = Warehouse(spark, f"{root}/wh")
    with pytest.raises(ContractError, match=rule):
        wh.load(read_raw(spark, root))
    assert wh.commit()["load_id"] == 0
    assert wh.table("fact_shipments").count() == 0


def test_objects(spark, tmp_path):
    store = ObjectStore(spark, f"file:{tmp_path}")
    store.upload_bytes("raw/a.csv", b"one")
    store.upload_bytes("raw/deep/raw/b.csv", b"three")
    store.upload_bytes("other/c.csv", b"x")
    (tmp_path / "local.txt").write_bytes(b"local")
    store.upload_file("raw/from_disk.txt", str(tmp_path / "local.txt"))
    listed = {r["key"]: r["bytes"] for r in store.list_objects("raw/").collect()}
    assert listed == {"raw/a.csv": 3, "raw/deep/raw/b.csv": 5, "raw/from_disk.txt": 5}
    assert [r["key"] for r in store.list_objects("raw/a").collect()] == ["raw/a.csv"]
    assert store.download_bytes("raw/deep/raw/b.csv") == b"three"
    store.upload_bytes("raw/a.csv", b"replaced")
    assert store.download_bytes("raw/a.csv") == b"replaced"
    with pytest.raises(FileNotFoundError):
        store.download_bytes("raw/none")


def test_lake_table_infers_its_schema(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1), record(2)), root, "a")
    write_raw(frame(record(3)), root, "b")
    table = register_lake(spark, root, "raw_under_test")
    assert [name for name, _ in table.dtypes] == list(RAW_SCHEMA)
    assert spark.sql("SELECT count(*) FROM raw_under_test").first()[0] == 3
    register_lake(spark, root, "raw_under_test")  # again, files untouched
    assert spark.table("raw_under_test").count() == 3


def test_first_wins_over_rolled_files(spark, frame, tmp_path):
    """Counters beyond three digits, in tasks that write a file for each record."""
    root = f"file:{tmp_path}"
    rows = [
        record(n, company_name=f"C{n % 100}", plate_number=f"P{n:05d}", delay_minutes=n)
        for n in range(1200)
    ]
    write_raw(frame(*rows), root, "a", file_rows=1)
    found = read_raw(spark, root)
    assert found.agg(F.max("_counter")).first()[0] == 1199
    first = first_attributes(found, ["company_name"], ["plate_number", "delay_minutes"], ORDER)
    expected = {(f"C{n}", f"P{n:05d}", n) for n in range(100)}
    assert {tuple(r) for r in first.collect()} == expected
    whole = first_rows(found, ["company_name"], ORDER)
    assert {(r["company_name"], r["plate_number"], r["delay_minutes"]) for r in whole.collect()} == expected


def test_positions_number_records_in_order(spark, frame, tmp_path):
    """One ascending number over runs, formats and rolled files; nothing else is added."""
    root = f"file:{tmp_path}"
    rows = [record(n, delay_minutes=n) for n in range(40)]
    write_raw(frame(*rows[:12]), root, "a", file_rows=1)
    write_raw(frame(*rows[12:20]), root, "b", "csv")
    write_raw(frame(*rows[20:]), root, "c", file_rows=7)
    raw = read_raw(spark, root)
    placed = positioned(raw, f"{root}/files")
    assert sorted(placed.columns) == sorted([*RAW_SCHEMA, "raw_file", "_position"])
    found = placed.orderBy("_position").select("delay_minutes", "raw_file", "_position").collect()
    assert [r["delay_minutes"] for r in found] == list(range(40))
    assert len({r["_position"] for r in found}) == 40
    assert {r["raw_file"] for r in found} == {r[0] for r in raw.select("raw_file").collect()}


def test_landing_joins_do_not_sort_the_lines(spark, monkeypatch):
    """Tables too large to be broadcast are hashed; a sort of all lines spilled."""
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = feed.narrow_lines(spark, "/root/testdata/sf0.001")
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    

@pytest.mark.parametrize("most", [-1, keyed.BROADCAST_BYTES])
def test_lines_come_in_order_by_one_exchange(spark, monkeypatch, most):
    """Lines take their order over where both were dealt, as often as a join would find it."""
    sf_dir = "/root/testdata/sf0.001"
    read = feed.read

    def odd(spark, sf_dir, name):
        """An order twice, and an order without lines as well as lines without an order."""
        rows = read(spark, sf_dir, name)
        if name != "orders":
            return rows
        rows = rows.filter("o_orderkey != 11")
        return rows.unionByName(rows.filter("o_orderkey % 100 = 3"))

    monkeypatch.setattr(feed, "read", odd)
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", most)
    lines = feed.ordered_lines(spark, sf_dir)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning(l_orderkey") == 1
    assert "hashpartitioning(l_orderkey" not in plan
    columns = [*feed.LINE_ORDER, *feed.LINE_DETAILS, "s_nation", "c_nation", "r_name"]
    columns.remove("s_suppkey"), columns.remove("p_partkey")
    expected = feed.order_lines(spark, sf_dir).select(*columns).collect()
    found = lines.select(*columns).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    places = [tuple(row[name] for name in feed.LINE_ORDER) for row in found]
    assert places == sorted(places)


def test_runs_are_written_in_order_by_one_pass(spark, frame, tmp_path):
    """Records of two runs by turns; a run without records can be read as well."""
    root = f"file:{tmp_path}/zone"
    rows = frame(*[record(n, delay_minutes=n) for n in range(40)])
    run = F.when(F.col("delay_minutes") % 2 == 0, "b").otherwise("a")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_runs(rows.withColumn("_run", run), root, "_run", ["a", "b", "c"])
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    placed = positioned(read_raw(spark, root), f"{root}/files").orderBy("_position")
    found = [(r["raw_file"], r["delay_minutes"]) for r in placed.collect()]
    odd, even = range(1, 40, 2), range(0, 40, 2)
    assert found == [(raw_key("a", "parquet"), n) for n in odd] + [
        (raw_key("b", "parquet"), n) for n in even
    ]
    assert sorted(p.name for p in (tmp_path / "zone" / "raw").iterdir()) == [
        f"shipments_{name}.parquet" for name in "abc"
    ]


def test_positions_have_no_bounds(spark, tmp_path):
    """Numbers in file names are taken as they are; other names go by their text."""
    names = [
        "part-00000-aa-c000.parquet", "part-00000-aa-c1000.parquet", "part-00000-bb-c1000.parquet",
        "part-00001-a-c0-c000.parquet", "part-3000000-aa-c000.parquet",
    ]
    frame = spark.createDataFrame(
        [(f"file:/x/raw/shipments_r/{n}", n) for n in reversed(names)], "p string, n string"
    )
    meta = frame.select(F.struct(F.col("p").alias("file_path"), F.col("n").alias("file_name")).alias("_metadata"))
    placed = meta.select(
        *[c.alias(k) for k, c in _lineage(F.lit(1 << 50)).items()]
    )
    assert [r["_name"] for r in placed.orderBy(*ORDER).collect()] == names
    assert placed.select("_row").distinct().collect()[0][0] == 1 << 50


def test_runs_of_two_writers(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a")
    loose = frame(record(2)).withColumns(
        {"scheduled_pickup": F.date_format("scheduled_pickup", "yyyy-MM-dd'T'HH:mm:ss"),
         "cost_usd": F.col("cost_usd").cast("double")}
    )
    loose.write.parquet(f"{root}/{raw_key('b', 'parquet')}")
    found = read_raw(spark, root)
    assert found.select(*RAW_SCHEMA).exceptAll(frame(record(1), record(2))).isEmpty()
    frame(record(3)).drop("cost_usd").write.parquet(f"{root}/{raw_key('c', 'parquet')}")
    with pytest.raises(ValueError, match="shipments_c.*cost_usd"):
        read_raw(spark, root)


def test_lake_leaves_other_tables_alone(spark, frame, tmp_path):
    root = f"file:{tmp_path}"
    write_raw(frame(record(1)), root, "a")
    spark.sql("DROP TABLE IF EXISTS kept_by_a_user")
    spark.sql("CREATE TABLE kept_by_a_user USING parquet AS SELECT 7 AS x")
    with pytest.raises(ValueError, match="kept_by_a_user"):
        register_lake(spark, root, "kept_by_a_user")
    assert spark.table("kept_by_a_user").collect()[0][0] == 7
    spark.sql("DROP TABLE kept_by_a_user")
    register_lake(spark, root, "lake_elsewhere")
    write_raw(frame(record(1)), f"{root}/other", "a")
    with pytest.raises(ValueError, match="lake_elsewhere"):
        register_lake(spark, f"{root}/other", "lake_elsewhere")


def test_objects_without_replacement(spark, tmp_path):
    store = ObjectStore(spark, f"file:{tmp_path}")
    store.upload_bytes("c/1.json", b"one", replace=False)
    with pytest.raises(FileExistsError):
        store.upload_bytes("c/1.json", b"two", replace=False)
    assert store.download_bytes("c/1.json") == b"one"
    assert [n for n in store.names("c") if not n.startswith(".")] == ["1.json"]


def test_what_is_dealt_holds_no_key_twice_and_no_nation(spark, monkeypatch, capsys):
    """Parts that are not sent to every task are met before the exchange, nations behind it."""
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", -1)
    feed.ordered_lines(spark, "/root/testdata/sf0.001").explain("formatted")
    dealt = re.search(
        r"Input \[\d+\]: \[([^\]]*)\]\nArguments: rangepartitioning\(l_orderkey",
        capsys.readouterr().out,
    )
    names = {name.strip().split("#")[0] for name in dealt[1].split(",")}
    assert {"l_partkey", "p_type", "_order"} <= names
    assert not names & {"p_partkey", "s_suppkey", "c_nation", "r_name"}


def test_rolled_lines_are_dealt_once_to_the_tasks_asked_for(spark, tmp_path):
    """In record order over the tasks, without a join that deals the lines before."""
    made = {
        "region": "SELECT 0L AS r_regionkey, 'R' AS r_name",
        "nation": "SELECT 0L AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey",
        "customer": "SELECT id AS c_custkey, 'c' AS c_name, 0L AS c_nationkey, 'm' AS c_mktsegment FROM range(3)",
        "supplier": "SELECT id AS s_suppkey, 's' AS s_name, 0L AS s_nationkey FROM range(4)",
        "part": "SELECT id AS p_partkey, 't' AS p_type, 1L AS p_size FROM range(5)",
        "orders": "SELECT id AS o_orderkey, id % 3 AS o_custkey, TIMESTAMP_NTZ '1998-01-01' AS o_orderdate FROM range(40)",
        "lineitem": """SELECT id % 41 AS l_orderkey, id % 7 AS l_linenumber, id % 5 AS l_partkey,
            id % 4 AS l_suppkey, id AS l_quantity, 1 AS l_extendedprice, 1 AS l_shipdate,
            0 AS l_discount, 0 AS l_tax, 'r' AS l_returnflag, 'l' AS l_linestatus FROM range(400)""",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"file:{tmp_path}/{name}.parquet")
    lines = feed.ordered_lines(spark, f"file:{tmp_path}", 5)
    assert lines.rdd.getNumPartitions() == 5
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1
    found = [tuple(r) for r in lines.select(*feed.LINE_ORDER).collect()]
    plain = feed.order_lines(spark, f"file:{tmp_path}").select(*feed.LINE_ORDER).collect()
    assert found == sorted(tuple(r) for r in plain) and len(found) == 391
