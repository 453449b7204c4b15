"""Feeds and decoded events that are used more than once are computed once, and spread over tasks."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from sluice.functions import variant as V
from sluice.operators import apply as A, decode as X
from sluice.plans import registered as R
from sluice.sources import changes as C, derived as D


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path, day = str(tmp_path_factory.mktemp("tables")), datetime.datetime(1995, 5, 3)
    orders = [(k, k % 7, "O", 10.5 * k, day, 'odd "text" \\ \né' if k % 2 else "1-URGENT") for k in range(40)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{path}/orders.parquet")
    lines = [(k, n % 2, k + n, float(n), 3.25 * n) for k in range(40) for n in range(3)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double"
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_filter_on_the_body_does_not_write_it_again(spark, tables):
    for feed in (D.orders_feed(spark, tables), D.lines_feed(spark, tables), D.documented_feed(spark, tables)):
        assert plan(C.drop_empty(feed)).count("structstojson") == plan(feed).count("structstojson") > 0


def test_rows_are_spread_before_their_messages_are_written(spark, tables):
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert "repartitionbyexpression [o_orderkey" in plan(D.orders_feed(spark, tables)) and f"], {n}" in plan(D.orders_feed(spark, tables))
    assert "repartitionbyexpression [l_orderkey" in plan(D.lines_feed(spark, tables))


def test_messages_are_what_a_json_writer_gives(spark, tables):
    changes = D.order_changes(spark, tables)
    rows = changes.select("key", "operation", F.to_json("row").alias("row"), D.live_json(changes).alias("value")).collect()
    assert {r["operation"] for r in rows} == {"INS", "UPD", "DEL"}
    for r in rows:
        message = json.loads(r["value"])
        data = json.loads(message["data"]) if r["key"] % 2 == 0 else message["data"]
        assert message["operation"] == r["operation"]
        assert data["eventsource"]["pkkey"] == [{"columnname": "OrderID", "value": str(r["key"])}]
        current = data["eventrow"].get("current")
        if r["operation"] == "DEL":
            assert current is None
        elif r["key"] % 2 == 0:
            assert current == r["row"]
        else:
            assert {n: v for n, v in current.items() if v is not None} == json.loads(r["row"])


def test_configured_tables_are_decoded_in_one_pass(spark, tables):
    config = spark.createDataFrame(
        [("Orders", "OrderID", ["Product varchar(100)", "Quantity int"]), ("OrderLines", "OrderLineID", ["ProductID bigint"])],
        "table_name string, key_column string, column_list array<string>",
    )
    decoded = X.decode_live(D.two_table_feed(spark, tables))
    apart, once = A.route_by_config(decoded, config), A.route_by_config(decoded, config, keep=True)
    for name, df in once.items():
        assert "_orderkey" not in plan(df)
        assert df.dtypes == apart[name].dtypes and sorted(df.collect()) == sorted(apart[name].collect()) != []


@pytest.mark.parametrize("name", [
    "a3_route", "a3_route_by_schema", "a4_route_by_config", "a9_merge_orders", "a10_merge_order_lines",
    "a11_unknown_operation", "v19_update_latest",
])
def test_a_query_reads_its_decoded_events_back(spark, tables, name):
    assert "_orderkey" not in plan(R.queries()[name](spark, tables))


def test_text_is_read_without_spelling_out_a_schema(spark):
    kinds = ['"a"', '"\\u00e9 5"', '""', "5", "2.0", "2e0", "true", "null", '{"a":"b"}', '["a"]', "12345678901234567890"]
    rows = spark.createDataFrame([(k,) for k in kinds], "json string").selectExpr("json", "parse_json(json) AS v")
    read = rows.selectExpr("json", f"{V.text('v')} AS t", f"{V.is_bad_text('v')} AS bad", f"{V.is_bad_text('v', V.text('v'))} AS bad2")
    found = {r["json"]: r["t"] for r in read.collect()}
    assert found == {k: json.loads(k) if k.startswith('"') else None for k in kinds}
    assert all(r["bad"] == r["bad2"] for r in read.collect())
    assert "schema_of_variant" not in V.text("v")


def test_targets_read_no_lsn(spark, tables):
    assert "n/a" in plan(R.materialize(D.lines_feed(spark, tables), R.BOTH[1:]).ledger)
    for name in ("v6_top_order_lines", "v6_line_totals", "a21_materialize"):
        assert "n/a" not in plan(R.queries()[name](spark, tables))


def test_a_wave_that_is_read_twice_is_written_first(spark, tables, monkeypatch):
    plans, apply_batch = [], R.apply_batch

    def noted(state, messages):
        plans.append(plan(messages))
        return apply_batch(state, messages)

    monkeypatch.setattr(R, "apply_batch", noted)
    R.queries()["v2_latest_offset"](spark, tables)
    assert ["structstojson" in p for p in plans] == [True, False, False]
