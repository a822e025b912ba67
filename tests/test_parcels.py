"""Own histories of two tables with decimals, dates and a key of two columns, in batch and as a stream."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

import changeloom as cl
from changeloom.functions.names import natural_order
from changeloom.functions.types import coerce, is_bad_value
from changeloom.operators.apply import current_state
from changeloom.operators.checks import InputError
from changeloom.plans import replay as rp
from changeloom.streaming import follow

PARCEL = """CREATE TABLE `{table}` (
  `code` varchar(12) NOT NULL,
  `weight` decimal(9,3) DEFAULT NULL,
  `sent` date DEFAULT NULL,
  PRIMARY KEY (`code`)
);
"""
VISIT = """CREATE TABLE `{table}` (
  `stop` smallint NOT NULL,
  `day` date NOT NULL,
  `fee` decimal(12,2),
  `open` bool,
  PRIMARY KEY (`stop`,`day`)
);
"""
PARCEL_COLUMNS = [("code", "VARCHAR(12)"), ("weight", "DECIMAL(9,3)"), ("sent", "DATE")]
VISIT_COLUMNS = [("stop", "SMALLINT"), ("day", "DATE"), ("fee", "DECIMAL(12,2)"), ("open", "BOOL")]
MARCH = [date(2031, 3, d) for d in range(1, 9)]


def lines(table, *changes):
    return "".join(f"{op},{table},depot,{ts},{','.join(map(str, values))}\n" for op, ts, *values in changes)


@pytest.fixture
def two(workspace):
    """Dumped at position 4000: parcels K1, K2 and one visit."""
    workspace.snapshot("box", 4000, PARCEL, _1="K1,0.125,2031-03-01\nK2,17,\\N\n")
    workspace.snapshot("visit", 4000, VISIT, _1="stop,day,fee,open\n3,2031-03-01,9.90,1\n")
    return workspace.definition(3900, PARCEL_COLUMNS, "box").definition(3900, VISIT_COLUMNS, "visit")


def boxes(spark, out):
    return rows(cl.StateStore(spark, out).read("depot_box"))


def visits(spark, out):
    return rows(cl.StateStore(spark, out).read("depot_visit"))


def counts(result):
    return {(r.source_table, r.operation): r.n_operations for r in result.stats.collect()}


def test_both_tables_follow_their_changes(spark, two, out):
    two.checkpoint(5000)
    two.changes(
        3900,
        lines("box", ("U", 4100, "K2", 16.5, MARCH[3]), ("I", 4200, "K3", "\\N", MARCH[4])),
        lines("box", ("D", 4300, "K1", 0.125, MARCH[0])),
        lines("box", ("U", 4310, "K3", "2.001", MARCH[5]), ("U", 4311, "K3", "2.002", MARCH[5])),
        table="box", sub="2031-03-04",
    )
    two.changes(3900, lines("visit", ("D", 4150, 3, MARCH[0], 9.9, 1), ("I", 4150, 3, MARCH[1], "10.00", "no")), table="visit", sub="5")
    result = cl.replay(spark, str(two), out)
    assert boxes(spark, out) == [("K2", Decimal("16.500"), MARCH[3]), ("K3", Decimal("2.002"), MARCH[5])]
    assert visits(spark, out) == [(3, MARCH[1], Decimal("10.00"), False)]
    assert counts(result) == {("box", "upsert"): 4, ("box", "delete"): 1, ("visit", "upsert"): 1, ("visit", "delete"): 1}
    assert set(result.seconds) == {"snapshot", "plan", "land", "apply"}
    streams = {r.source_table: r for r in cl.StateStore(spark, out).streams().collect()}
    assert (streams["box"].last_file_index, streams["box"].last_date, streams["box"].last_commit_ts) == (3, "2031-03-04", 4311)
    assert (streams["visit"].partition_id, streams["visit"].last_commit_ts) == (5, 4150)


def test_rows_outside_of_the_bounds_wait_or_are_skipped(spark, two, out):
    two.checkpoint(4500)
    two.changes(3900, lines("box", ("U", 3950, "K1", 9, MARCH[1]), ("U", 4500, "K1", 8, MARCH[1]), ("U", 4501, "K1", 7, MARCH[1])), table="box")
    result = cl.replay(spark, str(two), out)
    assert boxes(spark, out)[0][1] == 8 and counts(result) == {("box", "upsert"): 1, ("box", "skipped"): 1}
    two.checkpoint(4600)
    assert counts(cl.replay(spark, str(two), out)) == {("box", "upsert"): 1, ("box", "skipped"): 2}
    assert boxes(spark, out)[0][1] == 7


def test_time_may_not_run_backwards_within_a_table(spark, two, out):
    two.checkpoint(5000)
    two.changes(3900, lines("visit", ("I", 4400, 8, MARCH[2], 1, 1), ("I", 4399, 8, MARCH[3], 1, 1)), table="visit")
    two.changes(3900, lines("box", ("I", 4398, "K9", 1, MARCH[2])), table="box")
    with pytest.raises(InputError, match="goes backwards"):
        cl.replay(spark, str(two), out)


def test_truncates_cut_what_came_before_them(spark, two, out):
    two.checkpoint(5000).definition(4400, PARCEL_COLUMNS, "box", query="truncate TABLE box").definition(3990, VISIT_COLUMNS, "visit", ddl_type=11)
    two.changes(3900, lines("box", ("U", 4399, "K1", 5, MARCH[0])), table="box")
    two.changes(4400, lines("box", ("I", 4401, "K7", 4, MARCH[6])), table="box")
    result = cl.replay(spark, str(two), out)
    assert boxes(spark, out) == [("K7", Decimal("4.000"), MARCH[6])]
    assert len(visits(spark, out)) == 1  # that truncate is older than the dump
    assert counts(result)[("box", "truncate")] == 1 and ("visit", "truncate") not in counts(result)


# --- nothing is lost ------------------------------------------------------------------------


def test_a_late_file_is_applied_or_refused(spark, two, tmp_path):
    two.checkpoint(4500)
    two.changes(3900, lines("box", ("U", 4300, "K1", 3, MARCH[0])), table="box")
    late = lines("box", ("U", 4250, "K2", 2, MARCH[0]))
    for name in ("strict", "lenient"):
        cl.replay(spark, str(two), str(tmp_path / name))
    two.checkpoint(4600).changes(3900, lines("box", ("U", 4300, "K1", 3, MARCH[0])), late, table="box")
    with pytest.raises(InputError, match="goes backwards"):
        cl.replay(spark, str(two), str(tmp_path / "strict"))
    cl.replay(spark, str(two), str(tmp_path / "lenient"), strict=False)
    assert [r[1] for r in boxes(spark, str(tmp_path / "lenient"))] == [3, 2]


def test_an_absent_file_is_read_when_it_comes(spark, two, out):
    two.checkpoint(4900)
    files = [lines("box", ("U", 4100 + i, "K1", i, MARCH[i])) for i in (1, 2, 3)]
    two.changes(3900, *files, table="box")
    gap = two.root / "increment/depot/box/3900/2026-05-25/CDC000002.csv"
    text = gap.read_text()
    gap.unlink()
    with pytest.raises(InputError, match="missing"):
        cl.replay(spark, str(two), out)
    cl.replay(spark, str(two), out, strict=False)
    assert boxes(spark, out)[0][1] == 1
    assert cl.StateStore(spark, out).streams().first().last_file_index == 1
    gap.write_text(text)
    cl.replay(spark, str(two), out, strict=False)
    assert boxes(spark, out)[0] == ("K1", Decimal("3.000"), MARCH[3])
    assert cl.StateStore(spark, out).streams().first().last_file_index == 3


def test_broken_definitions_are_set_aside(spark, two, out):
    two.checkpoint(4900).definition(4200, PARCEL_COLUMNS, "box", crc=7)
    two.changes(3900, lines("box", ("U", 4100, "K1", 1, MARCH[1])), table="box")
    two.changes(4200, lines("box", ("U", 4201, "K1", 2, MARCH[2])), table="box")
    cl.replay(spark, str(two), out, strict=False)
    assert boxes(spark, out)[0][1] == 1


def test_a_version_without_definition_holds_its_table(spark, two, tmp_path):
    two.definition(4100, PARCEL_COLUMNS, "box").checkpoint(4900)
    two.changes(4100, lines("box", ("U", 4110, "K1", 1, MARCH[1])), table="box")
    two.changes(4200, lines("box", ("U", 4201, "K1", 2, MARCH[2]), ("I", 4202, "K3", 2, MARCH[2])), table="box")
    two.changes(4300, lines("box", ("D", 4301, "K2")[:3], ).replace("K2", "K2,,"), table="box")
    two.definition(4300, PARCEL_COLUMNS, "box", ddl_type=11, query="TRUNCATE TABLE box")
    two.changes(3900, lines("visit", ("I", 4210, 4, MARCH[1], "1.50", 0)), table="visit")
    strict, lenient = str(tmp_path / "strict"), str(tmp_path / "lenient")
    for _ in range(2):
        with pytest.raises(InputError, match="without a definition"):
            cl.replay(spark, str(two), strict)
    assert [t.checkpoint for t in cl.StateStore(spark, strict).table_states().values()] == [0, 0]

    found = cl.replay(spark, str(two), lenient, strict=False)
    assert found.held == {("depot", "box"): 4200}
    assert {k[1]: t.checkpoint for k, t in cl.StateStore(spark, lenient).table_states().items()} == {"box": 4199, "visit": 4900}
    assert [r[1] for r in boxes(spark, lenient)] == [Decimal("1.000"), Decimal("17.000")] and len(visits(spark, lenient)) == 2
    again = cl.replay(spark, str(two), lenient, strict=False)
    assert (again.skipped, again.held) == ("nothing is new", found.held)
    held = cl.read_changes(spark, str(two), cl.catalog(spark, str(two)).where("source_table = 'box'").collect(), 4000, 4900, rp.Options(strict=False))
    assert [r.commit_ts for r in held.collect()] == [4110]

    two.definition(4200, PARCEL_COLUMNS, "box")
    for out in (strict, lenient):
        assert cl.replay(spark, str(two), out, strict=out == strict).held == {}
        assert boxes(spark, out) == [] and len(visits(spark, out)) == 2
        assert {t.checkpoint for t in cl.StateStore(spark, out).table_states().values()} == {4900}


def test_late_rows_of_a_defined_version_wait_below_the_frontier(spark, two, out):
    two.checkpoint(4900).changes(3900, lines("box", ("U", 4100, "K1", 1, MARCH[1]), ("U", 4250, "K1", 3, MARCH[3])), table="box")
    two.changes(4200, lines("box", ("U", 4201, "K1", 2, MARCH[2])), table="box")
    cl.replay(spark, str(two), out, strict=False)
    assert boxes(spark, out)[0][1] == 1
    two.definition(4200, PARCEL_COLUMNS, "box")
    assert cl.replay(spark, str(two), out, strict=False, commit_order="stream").skipped is None
    assert boxes(spark, out)[0][1] == 2


def test_folders_that_are_no_versions_hold_nothing(spark, two, out):
    two.checkpoint(4900).changes(3900, lines("box", ("U", 4100, "K1", 1, MARCH[1])), table="box")
    two.put("increment/depot/box/notes/meta/CDC.index", "CDC000001.csv\n").put("increment/depot/box/4400/readme", "")
    two.changes(5000, lines("box", ("U", 5001, "K1", 2, MARCH[2])), table="box")  # past the checkpoint
    two.changes(3800, lines("box", ("U", 4002, "K1", 2, MARCH[2])), table="box")  # before the baseline
    two.changes(4300, lines("other", ("U", 4301, 1, 2)), table="other")  # not managed
    assert cl.replay(spark, str(two), out).held == {}
    assert boxes(spark, out)[0][1] == 1


def test_bad_snapshot_rows_are_kept_aside(spark, workspace, out):
    workspace.snapshot("box", 4000, PARCEL, _1="K1,1,2031-03-01\nK2,x,2031-03-01\nK3,1\nK4,1.0005,\\N\n")
    with pytest.raises(Exception, match="wrong width|cannot read"):
        cl.replay(spark, str(workspace), out + "x")
    cl.replay(spark, str(workspace), out, on_error="quarantine")
    assert boxes(spark, out) == [("K1", Decimal("1.000"), MARCH[0])]
    bad = spark.read.parquet(f"{out}/quarantine/1/depot_box").select("rule", "record")
    assert rows(bad) == [("value of weight as DECIMAL(9,3)", "1.0005"), ("value of weight as DECIMAL(9,3)", "x"), ("width", "K3,1")]


def test_keys_that_are_null_are_equal(spark):
    before = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    place = {c: F.lit(1).cast("bigint") for c in ("table_version", "partition_id", "file_index", "block_start", "row_seq", "commit_ts")}
    changes = spark.createDataFrame([(None, 9, "U")], "k int, v int, op string").withColumns({**place, "date": F.lit("")})
    assert rows(current_state(before, changes, ["k"])) == [(2, 2), (None, 9)]


@pytest.mark.parametrize("table", ["w{x}", "a[b]", "q?*"])
def test_names_with_pattern_characters(spark, workspace, out, table):
    workspace.snapshot(table, 4000, PARCEL, _1="K1,1,\\N\n").checkpoint(4900).definition(3900, PARCEL_COLUMNS, table)
    workspace.changes(3900, lines(table, ("I", 4001, "K2", 2, MARCH[0])), table=table)
    cl.replay(spark, str(workspace), out)
    target = cl.catalog(spark, str(workspace)).first().target_table
    assert [r[0] for r in rows(cl.StateStore(spark, out).read(target))] == ["K1", "K2"]


def test_deeper_folders_are_no_partitions(spark, two, out):
    two.checkpoint(4900).changes(3900, lines("box", ("U", 4100, "K1", 1, MARCH[1])), table="box", sub="foo/7")
    cl.replay(spark, str(two), out)
    assert boxes(spark, out)[0][1] == Decimal("0.125")


def test_skipped_rows_are_counted_for_every_table(spark, workspace, out):
    names = [f"t{i:02d}" for i in range(36)]
    for i, name in enumerate(names):
        workspace.snapshot(name, 4000, PARCEL, _1="K1,1,\\N\n").definition(3900, PARCEL_COLUMNS, name)
        workspace.changes(3900, lines(name, *[("U", 3901 + k, "K1", k, MARCH[0]) for k in range(i % 3)], ("U", 4100, "K1", 5, MARCH[0])), table=name, sub="")
    workspace.checkpoint(4900)
    found = counts(cl.replay(spark, str(workspace), out, parallel_tables=8))
    assert {t: found.get((t, "skipped"), 0) for t in names} == {t: i % 3 for i, t in enumerate(names)}


def test_a_run_reports_what_it_leaves_out(spark, two, out):
    two.put("snapshot/depot.log-schema.sql", "CREATE TABLE `log` (\n  `a` int\n);")
    two.checkpoint(4900).definition(3900, PARCEL_COLUMNS[:2], "box")
    result = cl.replay(spark, str(two), out)
    assert result.keyless == [("depot", "log")] and result.duplicates == [("depot", "box", 3900, 2)]


def test_progress_of_another_format_is_refused(spark, two, out):
    two.checkpoint(4900)
    cl.replay(spark, str(two), out)
    import pathlib

    saved = sorted(pathlib.Path(out).glob("runs/*/tables.json"))[-1]
    saved.write_text(saved.read_text().replace('"format": 1', '"format": 2'))
    (saved.parent / ".tables.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="format"):
        cl.replay(spark, str(two), out)


# --- values ---------------------------------------------------------------------------------


def test_decimals_are_exact_or_bad(spark):
    df = spark.createDataFrame(
        [("12.34",), ("99.990",), ("-0.5",), ("1e2",), ("1.25e1",), ("1.255E0",), ("7",), ("12345678901234567890.5",)], "raw string"
    )
    kinds = ("decimal(10,1)", "decimal(12,2)", "DECIMAL", "numeric")
    found = df.select("raw", *[F.when(is_bad_value(F.col("raw"), k), "bad").otherwise(coerce(F.col("raw"), k, on_error="null").cast("string")).alias(k) for k in kinds])
    got = {r.raw: tuple(str(Decimal(x).normalize()) if x != "bad" else x for x in r[1:]) for r in found.collect()}
    assert got["12.34"] == ("bad", "12.34", "12.34", "12.34")
    assert got["99.990"] == ("bad", "99.99", "99.99", "99.99")
    assert got["-0.5"] == ("-0.5",) * 4
    assert got["1e2"][:2] == ("1E+2", "1E+2") and got["1.25e1"] == ("12.5",) * 4 and got["1.255E0"][:2] == ("bad", "bad")
    assert got["12345678901234567890.5"][2:] == ("12345678901234567890.5",) * 2


def test_bare_decimals_take_the_snapshots_type(spark, two, out):
    columns = [("code", "VARCHAR"), ("weight", "DECIMAL"), ("sent", "DATE"), ("tax", "NUMERIC")]
    two.checkpoint(4900).definition(4050, columns, "box")
    two.changes(4050, lines("box", ("U", 4100, "K1", "12.345", MARCH[1], "0.0000001")), table="box")
    cl.replay(spark, str(two), out)
    found = cl.StateStore(spark, out).read("depot_box")
    assert dict(found.dtypes)["weight"] == "decimal(9,3)" and dict(found.dtypes)["tax"] == "decimal(38,18)"
    assert found.where("code = 'K1'").first()[1:4:2] == (Decimal("12.345"), Decimal("0.0000001"))


def test_type_keys_are_exact(spark, two, out):
    from changeloom.sources.registry import parse_definitions

    text = '{"Columns": [{"Name": "a", "charset_type": "utf8", "other_type": "DATE", "type": "INT"}]}'
    files = spark.createDataFrame([(text,)], "text string")
    assert parse_definitions(files).first().columns[0].source_type == "INT"
    assert parse_definitions(files, ["other_type"]).first().columns[0].source_type == "DATE"


def test_natural_order_of_long_numbers(spark):
    texts = [f"t.{'0' * z}{n}.csv" for n in [1, 2, 9, 10, 99, 10**19, 10**20, 10**20 + 1, 10**21, 10**39] for z in (0, 2)]
    df = spark.createDataFrame([(t, i // 2) for i, t in enumerate(texts)], "t string, n int")
    ordered = df.select("n", natural_order(F.col("t")).alias("o")).orderBy("o").collect()
    assert [r.n for r in ordered] == sorted(r.n for r in ordered) and len({r.o for r in ordered}) == 10


# --- the stream does the same ---------------------------------------------------------------


def run_stream(spark, workspace, out, tmp_path, **options):
    query = follow(spark, str(workspace), out, str(tmp_path / "cp"), buckets=4, **options)
    query.awaitTermination()
    return query


def test_stream_takes_tables_with_any_name(spark, workspace, out, tmp_path):
    for name in ("_t", "box"):
        workspace.snapshot(name, 4000, PARCEL, _1="K1,1,\\N\n").definition(3900, PARCEL_COLUMNS, name)
        workspace.changes(3900, lines(name, ("U", 4100, "K1", 2, MARCH[0])), table=name)
    workspace.checkpoint(4900)
    run_stream(spark, workspace, out, tmp_path)
    for target in ("depot__t", "depot_box"):
        assert rows(cl.StateStore(spark, out, 4).read(target)) == [("K1", Decimal("2.000"), MARCH[0])]


def test_stream_fails_at_a_broken_row(spark, two, out, tmp_path):
    two.checkpoint(4900).changes(3900, "U,box,depot,soon,K1,2,2031-03-01\n", table="box")
    with pytest.raises(Exception, match="breaks rule"):
        run_stream(spark, two, out, tmp_path)


def test_stream_applies_when_only_the_checkpoint_moved(spark, two, out, tmp_path):
    two.checkpoint(4150).changes(3900, lines("box", ("U", 4100, "K1", 2, MARCH[0]), ("U", 4200, "K1", 3, MARCH[0])), table="box")
    run_stream(spark, two, out, tmp_path)
    assert rows(cl.StateStore(spark, out, 4).read("depot_box"))[0][1] == 2
    two.checkpoint(4300)
    run_stream(spark, two, out, tmp_path)
    assert rows(cl.StateStore(spark, out, 4).read("depot_box"))[0][1] == 3


def test_running_stream_applies_when_only_the_checkpoint_moved(spark, two, out, tmp_path):
    import time

    two.checkpoint(4150).changes(3900, lines("box", ("U", 4100, "K1", 2, MARCH[0]), ("U", 4200, "K1", 3, MARCH[0])), table="box")
    query = follow(spark, str(two), out, str(tmp_path / "cp"), buckets=4, available_now=False, every="1 second")
    try:
        store, end = cl.StateStore(spark, out, 4), time.time() + 90
        for checkpoint, weight in ((4150, 2), (4300, 3)):
            two.checkpoint(checkpoint)
            while rows(store.read("depot_box"))[0][1] != weight:
                assert time.time() < end and query.isActive
                time.sleep(0.5)
    finally:
        query.stop()


def test_late_versions_in_the_stream(spark, two, out, tmp_path):
    two.checkpoint(4900).definition(4100, PARCEL_COLUMNS, "box")
    two.changes(4100, lines("box", ("U", 4101, "K1", 2, MARCH[0])), table="box")
    run_stream(spark, two, out, tmp_path)
    two.checkpoint(4950).definition(3800, PARCEL_COLUMNS, "box").changes(3800, lines("box", ("U", 4940, "K1", 9, MARCH[0])), table="box")
    run_stream(spark, two, out, tmp_path)
    assert rows(cl.StateStore(spark, out, 4).read("depot_box"))[0][1] == 2
