from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from shopfunnel import __main__ as cli
from shopfunnel.operators.checks import CheckFailure
from shopfunnel.plans import warehouse
from shopfunnel.plans.load import LoadRefused, load_month
from shopfunnel.schemas import ContractError
from shopfunnel.session import sized_shuffle, work_path
from shopfunnel.sources.csv import first_rows, input_bytes, input_files, month_file, scan_bronze
from shopfunnel.sources.tables import read_events

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
OCTOBER = [
    "2019-10-03 07:12:44 UTC,view,1,11,garden.tools.rake,oakley,9.5,7,s1",
    "2019-10-03 07:15:09 UTC,cart,1,11,garden.tools.rake,oakley,9.5,7,s1",
    "2019-10-02 00:00:00 UTC,view,2,12,,,3.0,8,s2",
    "2019-10-02 00:00:00 UTC,view,2,12,,,free,8,s2",
    "2019-10-02 00:00:00 UTC,view,x,12,,,3.0,8,s2",
    "2019-10-02 00:00:00 UTC,view,2,12,,,3.0,,s2",
    "2019-11-01 00:00:00 UTC,view,2,12,,,3.0,8,s2",
]


def write_csv(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_month_files():
    assert month_file("raw", "2019-10") == "raw/2019-Oct.csv"
    assert month_file("raw/", "2020-02") == "raw/2020-Feb.csv"
    for bad in ("10", "2019-13", "2019-1"):
        with pytest.raises(ValueError):
            month_file("raw", bad)


def test_csv_reading(spark, tmp_path):
    lines = [
        '2019-10-03 07:12:44 UTC,view,1,11,"",,9.5,7,s1',
        "2019-10-03 07:12:44 UTC,view,1",
        "2019-10-03 07:12:44 UTC,view,1,11,a,b,9.5,7,s1,extra",
    ]
    rows = scan_bronze(spark, write_csv(tmp_path / "odd.csv", lines)).collect()
    assert rows[0].category_code is None and rows[0].brand is None
    assert rows[1].product_id == "1" and rows[1].user_session is None
    assert rows[2].user_session == "s1"


def test_several_files_and_a_sample(spark, tmp_path):
    paths = [write_csv(tmp_path / f"{i}.csv", OCTOBER) for i in range(2)]
    assert scan_bronze(spark, paths).count() == 14
    for n in (0, 1, 6, 7, 8, 13, 14, 20):
        assert first_rows(spark, [paths[1], paths[0]], n).collect() == (scan_bronze(spark, paths[0]).collect() * 2)[:n]
    sizes = {r.path.rsplit("/", 1)[1]: r.bytes for r in input_files(spark, paths).collect()}
    assert sizes == {f"{i}.csv": (tmp_path / f"{i}.csv").stat().st_size for i in range(2)}
    assert input_bytes(spark, paths) == sum(sizes.values())


def test_a_sample_ends_inside_a_split(spark, tmp_path):
    """Small splits; files of other lengths before and after, one of them empty."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1KB")
    try:
        lines = [f"2019-10-01 00:00:00 UTC,view,{k},11,a,b,9.5,7,s{k}" for k in range(200)]
        cuts = [0, 50, 50, 170, 200]
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            write_csv(tmp_path / f"{k}.csv", lines[low:high])
        for n in (1, 49, 50, 51, 66, 67, 120, 169, 170, 171, 200, 300):
            rows = first_rows(spark, str(tmp_path), n)
            assert [r.product_id for r in rows.collect()] == [str(k) for k in range(min(n, 200))]
        assert len(first_rows(spark, str(tmp_path), 60).inputFiles()) == 3
    finally:
        spark.conf.set(key, before)


def test_absent_input_is_an_error(spark, tmp_path):
    for read in (scan_bronze, input_bytes):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "absent.csv"))


@pytest.mark.parametrize("versioned", [False, True])
def test_loading_a_month_twice(spark, tmp_path, versioned):
    path = write_csv(tmp_path / "2019-Oct.csv", OCTOBER)
    root, quarantine = str(tmp_path / "processed"), str(tmp_path / "quarantine")
    for _ in range(2):
        metrics = load_month(spark, path, root, "2019-10", quarantine, versioned=versioned)
        assert (metrics.total, metrics.cast_failed, metrics.processed) == (7, 2, 4)
        assert (metrics.dropped, metrics.misfiled) == (2, 1)
        assert metrics.total == metrics.processed + metrics.dropped + metrics.misfiled
        assert metrics.cast_failed_rate == 2 / 7
        rows = read_events(spark, root)
        assert rows.count() == 4 and {r.event_month for r in rows.collect()} == {"2019-10"}
        assert rows.filter("price is null").count() == 1
        bad = {r.failure_reason: r for r in spark.read.parquet(quarantine).collect()}
        assert set(bad) == {"price", "product_id", "event_month"}
        assert bad["price"].price_raw == "free" and bad["price"].product_id_raw == "2"
        assert bad["event_month"].event_time_raw == "2019-11-01 00:00:00 UTC"


@pytest.mark.parametrize("versioned", [False, True])
def test_a_corrected_delivery_clears_the_quarantine(spark, tmp_path, versioned):
    root, quarantine = str(tmp_path / "processed"), str(tmp_path / "quarantine")
    path = write_csv(tmp_path / "2019-Oct.csv", OCTOBER)
    load_month(spark, path, root, "2019-10", quarantine, versioned=versioned)
    metrics = load_month(spark, write_csv(tmp_path / "again.csv", OCTOBER[:3]), root, "2019-10", quarantine, versioned=versioned)
    assert metrics.cast_failed == 0 and metrics.processed_rate == 1.0
    assert read_events(spark, root).count() == 3
    assert spark.read.parquet(f"{quarantine}/event_month=2019-10").count() == 0


def test_a_malformed_month_is_refused_before_reading(spark, tmp_path):
    with pytest.raises(ValueError, match="2019-10"):
        load_month(spark, str(tmp_path / "absent.csv"), str(tmp_path / "out"), "10")


@pytest.mark.parametrize("versioned", [False, True])
def test_an_empty_file(spark, tmp_path, versioned):
    metrics = load_month(spark, write_csv(tmp_path / "x.csv", []), str(tmp_path / "out"), "2019-10", versioned=versioned)
    assert (metrics.total, metrics.cast_failed_rate, metrics.processed_rate) == (0, 0.0, 0.0)


def test_from_files_to_checked_tables(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "2019-Oct.csv", OCTOBER)
    write_csv(tmp_path / "2019-Nov.csv", [line.replace("2019-10-0", "2019-11-0") for line in OCTOBER[:3]])
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    arguments = ["--raw", str(tmp_path), "--processed", str(tmp_path / "out"), "--database", "shop", "--quarantine", str(tmp_path / "bad")]
    months = ["--month", "2019-10", "--month", "2019-11"]
    for _ in range(2):
        cli.main(arguments + months)
        monthly = spark.table(f"shop.{warehouse.MONTHLY_TABLE}")
        found = {(r.event_month, r.category_main): (r.view_count, r.cart_count) for r in monthly.collect()}
        assert found == {
            ("2019-10", "garden"): (1, 1),
            ("2019-10", None): (2, 0),
            ("2019-11", "garden"): (1, 1),
            ("2019-11", None): (1, 0),
        }
    assert spark.table(warehouse.STAGING_VIEW).count() == 7
    assert spark.table(f"shop.{warehouse.CLUSTERED}").count() == spark.table(f"shop.{warehouse.EXTERNAL}").count() == 7
    # A failing check comes after all models are written, a broken contract before.
    monkeypatch.setattr(warehouse.checks, "DAILY_CHECKS", (warehouse.checks.NotNull("overall_conversion_rate"),))
    assert all(failures == 0 for *_, failures in warehouse.build_models(spark, "shop"))
    monkeypatch.setattr(warehouse.checks, "DAILY_CHECKS", (warehouse.checks.NotNull("brand"),))
    with pytest.raises(CheckFailure, match="brand not_null: 2"):
        warehouse.build_models(spark, "shop")
    monkeypatch.setattr(warehouse, "FACT", warehouse.DAILY)
    with pytest.raises(ContractError, match="funnel_fact"):
        warehouse.build_models(spark, "shop")


def test_loaded_months_are_refreshed(spark, tmp_path):
    write_csv(tmp_path / "2019-Oct.csv", OCTOBER)
    write_csv(tmp_path / "2019-Nov.csv", [line.replace("2019-10-0", "2019-11-0") for line in OCTOBER[:3]])
    spark.sql("CREATE DATABASE shop_by_month")
    arguments = ["--raw", str(tmp_path), "--processed", str(tmp_path / "out"), "--database", "shop_by_month"]
    arguments += ["--quarantine", str(tmp_path / "bad"), "--versioned", "--refresh"]
    try:
        for months in (["2019-10", "2019-11"], ["2019-11"]):
            cli.main(arguments + [a for m in months for a in ("--month", m)])
            monthly = spark.table(f"shop_by_month.{warehouse.MONTHLY_TABLE}")
            found = {(r.event_month, r.category_main): r.view_count for r in monthly.collect()}
            november = {("2019-11", "garden"): 1, ("2019-11", None): 1} if len(months) == 2 else {("2019-11", None): 1}
            assert found == {("2019-10", "garden"): 1, ("2019-10", None): 2} | november
            write_csv(tmp_path / "2019-Nov.csv", ["2019-11-02 00:00:00 UTC,view,2,12,,,3.0,8,s2"])
    finally:
        spark.sql("DROP DATABASE shop_by_month CASCADE")


def test_shuffle_width_follows_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffle(spark, 1) as width:
        assert width == int(before) == int(spark.conf.get(key))
    with sized_shuffle(spark, 5 * 1024**3) as width:
        assert width == int(spark.conf.get(key)) == 40
    with sized_shuffle(spark, 100 * 1024**4) as width:
        assert width == 800 * 1024
    assert spark.conf.get(key) == before


def test_models_of_all_callers_get_the_width(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(warehouse, "sized_shuffle", lambda s, size: seen.append(size) or sized_shuffle(s, size))
    root = str(tmp_path / "out")
    load_month(spark, write_csv(tmp_path / "2019-Oct.csv", OCTOBER[:3]), root, "2019-10")
    spark.sql("CREATE DATABASE IF NOT EXISTS widths")
    warehouse.build_event_tables(spark, root, "widths")
    warehouse.build_models(spark, "widths")
    assert len(seen) == 1 and seen[0] > 0


def rows_of(spark, root):
    return sorted(map(str, read_events(spark, root).collect()))


@pytest.mark.parametrize("versioned", [False, True])
def test_strays_without_a_quarantine_are_refused(spark, tmp_path, versioned):
    root = str(tmp_path / "out")
    load_month(spark, write_csv(tmp_path / "good.csv", OCTOBER[:3]), root, "2019-10", versioned=versioned)
    before = rows_of(spark, root)
    with pytest.raises(LoadRefused, match="1 rows of another month and no quarantine"):
        load_month(spark, write_csv(tmp_path / "mixed.csv", OCTOBER), root, "2019-10", versioned=versioned)
    assert rows_of(spark, root) == before


@pytest.mark.parametrize("versioned", [False, True])
def test_a_delivery_of_another_month_leaves_the_month(spark, tmp_path, versioned):
    root, quarantine = str(tmp_path / "out"), str(tmp_path / "bad")
    load_month(spark, write_csv(tmp_path / "good.csv", OCTOBER[:3]), root, "2019-10", quarantine, versioned=versioned)
    before = rows_of(spark, root)
    wrong = write_csv(tmp_path / "wrong.csv", [line.replace("2019-10-0", "2019-11-0") for line in OCTOBER[:3]])
    with pytest.raises(LoadRefused, match="none of 3 rows"):
        load_month(spark, wrong, root, "2019-10", quarantine, versioned=versioned)
    assert rows_of(spark, root) == before and len(before) == 3
    load_month(spark, wrong, root, "2019-10", quarantine, may_empty=True, versioned=versioned)
    assert rows_of(spark, root) == []
    assert spark.read.parquet(f"{quarantine}/event_month=2019-10").count() == 3


@pytest.mark.parametrize("versioned", [False, True])
def test_a_month_from_several_files(spark, tmp_path, versioned):
    halves = [write_csv(tmp_path / f"{k}.csv", lines) for k, lines in enumerate((OCTOBER[:1], OCTOBER[1:3]))]
    out = str(tmp_path / "out")
    cli.main(["--raw", "-", "--processed", out, "--load-only", "--month", "2019-10=" + ",".join(halves)] + ["--versioned"] * versioned)
    assert read_events(spark, out).count() == 3


def test_work_folder_without_a_checkpoint_folder():
    class Session:
        def __init__(self, settings):
            self.conf = settings

    shared = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}
    assert work_path(Session(shared), "x").startswith("hdfs://shared/warehouse/_work/shopfunnel/x-")
    both = {**shared, "spark.checkpoint.dir": "hdfs://shared/scratch"}
    assert work_path(Session(both), "x").startswith("hdfs://shared/scratch/shopfunnel/x-")
