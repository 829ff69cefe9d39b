"""Physical-plan shape checks for the scale properties the design relies on."""

from logweave.plans import catalog as C
from tests.conftest import SF_ORACLE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_counts_prunes_and_preaggregates(spark):
    plan = _plan(C.window_counts_batch(spark, SF_ORACLE))
    assert "partial_count" in plan  # map-side combine before the shuffle
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    for unused in ("user_id", "value", "props"):
        assert unused not in scan.split("ReadSchema")[-1]
    # the decoded-row filter stays above CollectMetrics: no inlined codec
    assert max(len(line) for line in plan.splitlines()) < 20000
    assert plan.index("Filter") < plan.index("CollectMetrics")


def test_decode_and_routing_have_no_shuffle(spark):
    for df in (C.decode_permissive(spark, SF_ORACLE), C.encode_roundtrip(spark, SF_ORACLE),
               C.processed_ok(spark, SF_ORACLE), C.dead_letter_table(spark, SF_ORACLE)):
        assert "Exchange" not in _plan(df)


def test_staged_ranges_reach_the_scan(spark):
    from logweave.sources import fixtures

    records = fixtures.log_records(spark, SF_ORACLE, keep_event_id=True)
    for late in (None, 13):
        plan = _plan(fixtures.staged_batches(records, 4, late)[2])
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        assert "GreaterThanOrEqual(event_id" in scan and "LessThan(event_id" in scan


def test_offset_ranges_reach_the_scan(spark):
    from logweave.session import new_run_dir
    from logweave.sources import fixtures
    from logweave.sources.log import read_log, write_log

    path = f"{new_run_dir(spark, 't-offset-plan')}/log"
    write_log(fixtures.log_records(spark, SF_ORACLE), path=path, by_offset=True)
    low, high = fixtures.offset_bounds(spark, SF_ORACLE)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # the whole filter in the plan's text
    try:
        plan = _plan(read_log(spark, {"startingOffsets": low, "endingOffsets": high}, path=path, streaming=False).select("offset"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    pushed = scan.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(offset" in pushed and "LessThan(offset" in pushed and "partition" in pushed


def test_inspection_reads_only_the_first_files(spark):
    first = C.parquet_inspect(spark, SF_ORACLE)
    files = first.inputFiles()
    assert files and len(files) < len(spark.read.parquet(files[0].rsplit("/", 1)[0]).inputFiles())
