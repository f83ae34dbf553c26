"""Driver contract, catalog sinks, bounded fetches and a rule property test."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.trips import frame, trip
from triplake.config import QualityRules
from triplake.operators.bronze import bronze
from triplake.operators.gold import time_patterns
from triplake.operators.silver import silver
from triplake.plans import sinks
from triplake.plans.inspect import fetch, preview


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_hour", "pickup_day_of_week", "trip_count", "avg_duration_min", "avg_fare"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    optional = set(entry._llm.queries()) if entry._llm else set()
    assert set(entry.queries()) - optional == set(entry.oracle_sql()) - optional


def test_managed_tables_and_catalog(spark):
    sinks.ensure_namespace(spark, "gold_test")
    assert sinks.namespace_exists(spark, "gold_test")
    assert "spark_catalog" in sinks.catalogs(spark)
    tp = time_patterns(silver(bronze(frame(spark, [trip()]))))
    sinks.save_as_table(tp, "gold_test.time_patterns")
    sinks.insert_into(tp, "gold_test.time_patterns")
    assert spark.table("gold_test.time_patterns").count() == 2
    sinks.ensure_namespace(spark, "spark_catalog.gold_test2")
    assert sinks.namespace_exists(spark, "gold_test2")
    sinks.require_tables(spark, ["gold_test.time_patterns"])
    with pytest.raises(LookupError, match="gold_test.no_such"):
        sinks.require_tables(spark, ["gold_test.time_patterns", "gold_test.no_such"])


def test_fetch_by_pages(spark):
    from triplake.plans.inspect import fetch_pages

    ordered = spark.range(1000, numPartitions=3).selectExpr("id", "cast(id as string) as t").orderBy(F.desc("id"))
    pages = list(fetch_pages(ordered, page_rows=100))
    assert all(len(p) <= 100 for p in pages) and len(pages) >= 10
    assert [i for p in pages for i in p["id"]] == list(range(999, -1, -1))
    assert fetch(spark.range(0)).empty and list(fetch(spark.range(0)).columns) == ["id"]
    kinds = spark.sql("select timestamp'2024-01-02 03:04:05' a, timestamp_ntz'2024-01-02 03:04:05' b, date'2024-01-02' c, cast(null as double) d")
    assert fetch(kinds).astype(str).equals(kinds.toPandas().astype(str))


def test_report_of_200_000_zones(spark):
    from triplake.operators.analytics import pareto_curve
    from triplake.plans.report import fetch_report

    n = 200_000
    zones = spark.range(n).select(
        F.col("id").alias("zone_id"), (n - F.col("id")).alias("pickups"), (2.0 * (n - F.col("id"))).alias("total_revenue"),
        F.lit(2.0).alias("avg_fare"), F.lit(1.0).alias("avg_distance_miles"))
    rows = fetch_report({"pareto_curve": pareto_curve(zones).orderBy("zone_rank")})["pareto_curve"]
    assert len(rows) == n and [r["zone_rank"] for r in rows[:3]] == [1, 2, 3] and rows[-1]["cum_pct"] == pytest.approx(100.0)


def test_create_or_replace_is_never_without_a_table(spark):
    """A reader beside replacements sees whole tables only."""
    import threading

    sinks.ensure_namespace(spark, "swap_test")
    whole = lambda k: spark.range(2000).select(F.lit(k).alias("k"), "id")
    sinks.save_as_table(whole(0), "swap_test.t", partition_by=["k"])
    seen, stop, errors = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.update((r["k"], r["n"]) for r in spark.table("swap_test.t").groupBy("k").agg(F.count("*").alias("n")).collect())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 5):
        sinks.save_as_table(whole(k), "swap_test.t", partition_by=["k"])
    stop.set()
    reader.join()
    assert not errors and seen and {n for _, n in seen} == {2000}
    from triplake.plans import tables

    assert len(tables.drop_superseded(spark, "swap_test.t")) == 4 and spark.table("swap_test.t").first()["k"] == 4


def test_switch_leaves_no_moment_without_a_table(spark):
    """Readers that only resolve the name, often enough to meet every step of
    a switch; the notes go with their version."""
    import threading

    from triplake.plans import tables

    sinks.ensure_namespace(spark, "swap_test")
    a, b = (tables.new_version(spark, "swap_test.resolved", spark.range(1).schema) for _ in range(2))
    tables.switch(spark, "swap_test.resolved", a, ["id"], {"k": "first", "only": "first"})
    stop, errors = threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                spark.table("swap_test.resolved")
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    for i in range(100):
        tables.switch(spark, "swap_test.resolved", (b, a)[i % 2], ["id"], {"k": str(i)})
    stop.set()
    for r in readers:
        r.join()
    assert not errors
    assert tables.current(spark, "swap_test.resolved") == tables.Version(a, {"k": "99"})


def test_failed_replacement_keeps_the_table(spark):
    sinks.ensure_namespace(spark, "swap_test")
    sinks.save_as_table(spark.range(3), "swap_test.kept")
    with pytest.raises(Exception, match="broken"):
        sinks.save_as_table(spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), "swap_test.kept")
    assert spark.table("swap_test.kept").count() == 3


T0 = dt.datetime(2018, 12, 31, 23, 0)
maybe = lambda s: st.one_of(st.none(), s)
ROW = st.tuples(
    maybe(st.integers(0, 4000)),  # pickup offset minutes from T0
    maybe(st.integers(-30, 800)),  # trip minutes
    maybe(st.sampled_from([-0.1, 0.0, 3.0, 199.99, 200.0])),
    maybe(st.sampled_from([-1.0, 0.0, 0.01, 15.0, 999.99, 1000.0])),
    maybe(st.sampled_from([0.0, 1.0, 5.0, 9.0, 10.0])),
)


def expected_keep(p, m, dist, amount, party):
    if p is None or m is None or dist is None or amount is None:
        return False
    pick = T0 + dt.timedelta(minutes=p)
    return (
        m > 0 and m < 720 and 0 <= dist < 200 and 0 < amount < 1000
        and (party is None or 1 <= party <= 9) and pick >= dt.datetime(2019, 1, 1)
    )


@settings(max_examples=4, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=120))
def test_rules_match_python_predicate(spark, rows):
    built = []
    for i, (p, m, dist, amount, party) in enumerate(rows):
        pick = None if p is None else T0 + dt.timedelta(minutes=p)
        drop = None if pick is None or m is None else pick + dt.timedelta(minutes=m)
        built.append(trip(VendorID=i, tpep_pickup_datetime=pick, tpep_dropoff_datetime=drop,
                          trip_distance=dist, total_amount=amount, passenger_count=party))
    kept = {r.VendorID for r in silver(bronze(frame(spark, built))).select("VendorID").collect()}
    want = {i for i, r in enumerate(rows) if expected_keep(*r)}
    assert kept == want


def test_create_table_with_declared_columns(spark):
    from triplake.contracts import BRONZE_SCHEMA

    sinks.ensure_namespace(spark, "bronze_test")
    sinks.create_table(spark, "bronze_test.tlc_trips_raw", BRONZE_SCHEMA)
    sinks.create_table(spark, "bronze_test.tlc_trips_raw", BRONZE_SCHEMA)  # replace
    t = spark.table("bronze_test.tlc_trips_raw")
    assert [f.name for f in t.schema] == [f.name for f in BRONZE_SCHEMA] and t.count() == 0


def test_preview_prints_schema_and_rows(spark, capsys):
    preview(spark.range(9), 2)
    out = capsys.readouterr().out
    assert "id: long" in out and "|1 " in out and "|5 " not in out


def test_session_reuse_leaves_the_active_one(spark):
    from triplake.session import get_spark

    assert get_spark() is spark
    with pytest.warns(UserWarning, match="spark.driver.memory"):
        get_spark(**{"spark.driver.memory": "3g"})
    other = get_spark(**{"spark.sql.shuffle.partitions": "3"})
    assert other.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from triplake.session import shared_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_scratch_scope_is_deleted(spark):
    import os

    from triplake.plans.materialize import materialize
    from triplake.session import scratch_path, scratch_scope

    with scratch_scope(spark):
        assert materialize(spark.range(3)).count() == 3
        inside = os.path.dirname(scratch_path(spark, "x")).replace("file:", "")
        assert os.path.isdir(inside)
    assert not os.path.exists(inside)


def test_sums_keep_all_decimals(spark):
    """1,000 trips at 10.004 are 10,004.00; parties of 1.4 have a mean of 1.4."""
    from triplake.operators.gold import trips_by_month

    rows = [trip(VendorID=i, total_amount=10.004, passenger_count=1.4) for i in range(1000)]
    r = trips_by_month(silver(bronze(frame(spark, rows)))).first()
    assert (r.total_revenue, r.avg_fare, r.avg_passengers) == (10004.0, 10.0, 1.4)


def test_means_divide_by_what_is_summed(spark):
    """A value that the exact sum cannot hold counts neither way."""
    from triplake.operators.gold import trips_by_month

    wide = QualityRules(max_amount=1e18, max_distance=1e18)
    rows = [trip(total_amount=10.0, trip_distance=2.0), trip(total_amount=1e13, trip_distance=4.0)]
    r = trips_by_month(silver(bronze(frame(spark, rows)), wide)).first()
    assert (r.trip_count, r.total_revenue, r.avg_fare, r.avg_distance_miles) == (2, 10.0, 10.0, 3.0)


def test_gold_tables_have_their_columns_and_one_scan(spark):
    from tests.conftest import SF_SMALL
    from triplake.contracts import GOLD_COLUMNS
    from triplake.operators import gold
    from triplake.plans.inspect import plan_text

    rows = entry._l_silver(spark, SF_SMALL)
    cells = gold.additive_cells(rows)
    assert plan_text(cells, "simple").count("FileScan") == 1
    for name, finish in gold.GOLD_FINISHERS.items():
        together, alone = finish(cells), gold.GOLD_BUILDERS[name](rows)
        assert tuple(together.columns) == GOLD_COLUMNS[name] == tuple(alone.columns)
        assert sorted(map(str, together.collect())) == sorted(map(str, alone.collect()))
