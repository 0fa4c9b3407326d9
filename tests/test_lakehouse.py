import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeworks.plans import cube, kpis, silver
from lakeworks.plans.medallion import Medallion
from lakeworks.sources import lakehouse, views


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    run = Medallion(spark, str(tmp_path_factory.mktemp("lake")), "t_")
    run.land({name: views.bronze(spark, small, name) for name in views.COMMERCE})
    run.run()
    return run


def test_every_layer_is_stored(spark, run):
    def names(layer):
        return {t.name for t in spark.catalog.listTables(run.layers[layer]) if not t.isTemporary}

    assert names("bronze") == {f"{n}_bronze" for n in views.COMMERCE}
    assert names("silver") == {f"silver_{n}" for n in views.COMMERCE}
    assert len(names("gold")) == 17 and {"fact_orders", "cube_sales", "dim_date", "kpi_aov"} <= names("gold")


def test_lineage_follows_rows(spark, run):
    bronze = run.stored("bronze", "orders_bronze")
    files = [r[0] for r in bronze.select("source_file").distinct().collect()]
    assert files and all("/source/orders/" in f for f in files)
    assert bronze.select("ingested_at").distinct().count() == 1
    assert "ingested_at" in run.stored("silver", "silver_orders").columns


def test_a_rerun_replaces_rows(spark, run):
    before = run.stored("gold", "fact_orders").count()
    run.bronze()
    run.silver()
    run.fact()
    assert run.stored("gold", "fact_orders").count() == before


def test_overwrite_may_change_the_schema_or_refuse(spark, run):
    table = f"{run.layers['gold']}.scratch"
    lakehouse.save_same_schema(spark.range(3), table)
    assert lakehouse.save_same_schema(spark.range(5), table).count() == 5
    with pytest.raises(lakehouse.SchemaMismatch):
        lakehouse.save_same_schema(spark.range(5).withColumn("x", F.lit(1)), table)
    assert spark.table(table).count() == 5
    assert lakehouse.save(spark.range(2).withColumn("x", F.lit(1)), table).columns == ["id", "x"]
    spark.sql(f"DROP TABLE {table}")


def test_stored_tables_are_compressed_well(spark, run):
    for layer, name in (("source", "orders"), ("bronze", "orders_bronze"), ("silver", "silver_customers"), ("gold", "fact_orders")):
        files = [f.removeprefix("file://") for f in run.stored(layer, name).inputFiles()]
        assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_namespace_can_be_made_current(spark, tmp_path):
    lakehouse.create_namespace(spark, "t_current", str(tmp_path), use=True)
    assert spark.catalog.currentDatabase() == "t_current"
    spark.catalog.setCurrentDatabase("default")


def test_csv_types_inferred_or_declared(spark, tmp_path):
    path = lakehouse.write_csv(spark.createDataFrame([(1, True, 0.1), (2, False, None)], "a int, deal boolean, x double"), str(tmp_path / "c"))
    assert lakehouse.column_types(lakehouse.read_csv(spark, path)) == [("a", "int"), ("deal", "boolean"), ("x", "double")]
    assert lakehouse.column_types(lakehouse.read_csv(spark, path, "a string, deal string, x string"))[1] == ("deal", "string")
    assert lakehouse.shape(lakehouse.read_csv(spark, path)) == (2, 3)
    assert lakehouse.preview(lakehouse.read_csv(spark, path), 1).count() == 1


def test_typed_ingest_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1.25",), ("x",)], "price string")
    rows = lakehouse.typed(df, {"price": "decimal(12,2)", "absent": "int"}).collect()
    assert [str(r.price) for r in rows] == ["1.25", "None"]


def test_ingest_types_numbers_given_as_text(spark, tmp_path):
    run = Medallion(spark, str(tmp_path), "t_text_")
    rows = spark.createDataFrame([("EUR", "1.10", "2024-01-01"), ("USD", "?", "2024-01-01")], "currency_code string, exchange_rate_to_usd string, effective_date string")
    run.land({"exchange_rates": rows})
    stored = run.bronze(["exchange_rates"])["exchange_rates"]
    assert ("exchange_rate_to_usd", "decimal(9,4)") in lakehouse.column_types(stored)
    assert sorted(str(r.exchange_rate_to_usd) for r in stored.collect()) == ["1.1000", "None"]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_filters_and_columns_reach_the_scan(spark, run):
    scan = final_plan(kpis.completed_orders(run.stored("gold", "fact_orders")))
    assert "ReadSchema: struct<order_id:string,status:string>" in scan
    assert "EqualTo(status,completed)" in scan
    cleaned = final_plan(silver.silver_orders(run.stored("bronze", "orders_bronze")))
    assert "PushedFilters: [IsNotNull(order_id)]" in cleaned and "source_file" not in cleaned
    assert "BroadcastHashJoin" in cleaned and "Exchange hashpartitioning" not in cleaned


def test_cube_reads_the_fact_once(spark, run):
    sums = [F.sum(c) for c in ("total_orders", "total_revenue_usd", "avg_order_value")]
    plan = final_plan(cube.cube_sales(run.stored("gold", "fact_orders")).agg(*sums))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_global_kpis_shuffle_single_rows_only(spark, run):
    fact = run.stored("gold", "fact_orders")
    for kpi in (kpis.total_revenue, kpis.data_quality):
        assert "hashpartitioning" not in final_plan(kpi(fact))


def test_checked_overwrite_swaps_whole_tables(spark, tmp_path):
    lakehouse.create_namespace(spark, "checked", str(tmp_path / "checked"))
    table = "checked.rows"
    lakehouse.save(spark.range(6).selectExpr("id", "cast(id as string) as name", "1 as n"), table)
    verdicts = lakehouse.checked_overwrite(spark.table(table).where("id > 3"), table)  # reads what it replaces
    assert {r.verdict for r in verdicts.collect()} == {"same"} and spark.table(table).count() == 2
    other = spark.range(9).selectExpr("cast(id as int) as id", "1 as n", "2 as extra")
    got = {r.column_name: (r.old_type, r.new_type, r.verdict) for r in lakehouse.checked_overwrite(other, table).collect()}
    assert got == {
        "id": ("bigint", "int", "retyped"), "name": ("string", None, "dropped"), "n": ("int", "int", "moved"), "extra": (None, "int", "added"),
    }
    with pytest.raises(lakehouse.SchemaMismatch, match="name dropped"):
        lakehouse.save_same_schema(other, table)
    failing = spark.range(9).selectExpr("if(id = 7, cast(raise_error('bad row') as bigint), id) as id", "'x' as name", "1 as n")
    with pytest.raises(Exception, match="bad row"):
        lakehouse.checked_overwrite(failing, table)
    assert sorted(r.id for r in spark.table(table).collect()) == [4, 5]
    assert lakehouse.checked_overwrite(spark.table(table).where("id = 4"), table).count() == 3
    assert [r.id for r in spark.table(table).collect()] == [4]
    assert {r.name for r in spark.catalog.listTables("checked") if not r.isTemporary} == {"rows"}
    spark.sql("DROP DATABASE checked CASCADE")


def test_column_listing_and_preview(spark):
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    listed = lakehouse.column_listing({"t": frame, "e": frame.limit(0).drop("v")})
    assert [tuple(r) for r in listed.collect()] == [("t", 1, "k", "int"), ("t", 2, "v", "string"), ("e", 1, "k", "int")]
    assert [r.k for r in lakehouse.preview(frame, 1, ["k"]).collect()] == [1]


def test_csv_rejects_keep_every_record(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    good = [f'{i},{i / 4},2024-01-{i % 28 + 1:02d},"a, b",' for i in range(40)]
    bad = ["x1,1.5,2024-01-01,t,", "7,1.5", "8,zwei,gestern,t,", "1,2,2024-01-01,t,,more"]
    path.write_text("\n".join(["id,amount,day,note,none", *good, *bad]) + "\n")
    rows, rejects = lakehouse.read_csv_checked(spark, str(path))
    assert [t for _, t in lakehouse.column_types(rows)] == ["bigint", "double", "date", "string", "string"]
    assert rows.select("note").count() == rows.count() == 40  # also when few columns are read
    assert sorted(r.id for r in rows.collect()) == list(range(40)) and {r.note for r in rows.collect()} == {"a, b"}
    assert {r.record: r.reason for r in rejects.collect()} == {
        bad[0]: "id: x1 is no bigint", bad[1]: "not 5 fields", bad[2]: "amount: zwei is no double; day: gestern is no date", bad[3]: "not 5 fields",
    }
