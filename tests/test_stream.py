from __future__ import annotations

from shopfunnel.operators import gate, layout, versions
from shopfunnel.session import written
from shopfunnel.sources.csv import scan_bronze
from shopfunnel.sources.tables import read_events, register_external
from shopfunnel.streaming import clean
from tests.test_load import OCTOBER, write_csv


def as_text(df):
    names = sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(names).collect())


def streamed(spark, tmp_path, *deliveries):
    inbox = tmp_path / "inbox"
    inbox.mkdir(exist_ok=True)
    for lines in deliveries:
        write_csv(inbox / f"{len(list(inbox.iterdir()))}.csv", lines)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    stream = clean.bronze_stream(spark, str(inbox), files_per_batch=1)
    clean.start(stream, good, str(tmp_path / "state"), bad).awaitTermination()
    return good, bad, str(inbox)


def test_stream_gives_the_rows_of_the_batch_gate(spark, tmp_path):
    for deliveries in ([OCTOBER[:4], OCTOBER[4:]], [OCTOBER], []):
        good, bad, inbox = streamed(spark, tmp_path, *deliveries)
        typed = gate.with_typed(scan_bronze(spark, inbox))
        assert as_text(read_events(spark, good)) == as_text(gate.with_partition_columns(gate.processed(typed)))
        assert as_text(spark.read.parquet(bad).drop("batch")) == as_text(gate.quarantined(typed))
    assert read_events(spark, good).count() == 10


def test_streamed_rows_are_a_dataset_like_any_other(spark, tmp_path):
    good, _, _ = streamed(spark, tmp_path, OCTOBER[:3], OCTOBER[2:])
    assert register_external(spark, "streamed_events", good).count() == read_events(spark, good).count() == 6
    spark.sql("DROP TABLE streamed_events")
    first = read_events(spark, good).filter("event_month = '2019-10'").limit(1)
    october = written(first, str(tmp_path / "delivery"))
    layout.replace_month(october, good, "2019-10")
    assert read_events(spark, good).filter("event_month = '2019-10'").count() == 1


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    rows = gate.with_partition_columns(gate.processed(gate.with_typed(scan_bronze(spark, write_csv(tmp_path / "x.csv", OCTOBER)))))
    root = str(tmp_path / "out")
    for batch in ("batch-1", "batch-1", "batch-2", "batch-2"):
        versions.append_batch(rows, root, batch)
    assert read_events(spark, root).count() == 2 * rows.count()
    days = {tuple(p.parent.parts[-2:]) for p in (tmp_path / "out").rglob("*.parquet")}
    assert len(list((tmp_path / "out").rglob("*.parquet"))) == 2 * len(days)
