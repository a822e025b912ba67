"""Behaviour of snapshot, change log and progress on small workspaces."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

import changeloom as cl
from changeloom.operators.checks import InputError
from changeloom.plans import replay as rp
from changeloom.sources import catalog as cat
from changeloom.sources import changelog as log
from changeloom.sources import registry as reg


def state(spark, out, table="depot_parcel"):
    return rows(cl.StateStore(spark, out).read(table))


# --- catalog --------------------------------------------------------------------------------


def test_catalog(spark, workspace):
    ddl = """/*!40101 SET NAMES binary*/;
CREATE TABLE `a+b` (
  `id` bigint(20) unsigned NOT NULL AUTO_INCREMENT,
  `t` datetime(3) DEFAULT CURRENT_TIMESTAMP(3),
  `amount` decimal(12, 2) NOT NULL COMMENT 'may be NULL, says ''x''',
  `kind` enum('a','b)c') DEFAULT 'a',
  `v` varchar(30) DEFAULT 'NOT NULL',
  PRIMARY KEY (`id`,`v`(10)) /*T![clustered_index] NONCLUSTERED */,
  KEY `k` (`t`)
) ENGINE=InnoDB;
"""
    workspace.put("snapshot/depot%2Ex.a+b-schema.sql", ddl)
    workspace.put("snapshot/deep/depot.c-schema.sql", ddl).put("snapshot/depot-schema-create.sql", "CREATE DATABASE x")
    row = cl.catalog(spark, str(workspace)).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.source_schema, row.source_table, row.target_table) == ("depot.x", "a+b", "depot_x_a_b")
    assert row.primary_key == ["id", "v"]
    assert [(c.name, c.source_type, c.nullable) for c in row.columns] == [
        ("id", "BIGINT(20) UNSIGNED", False),
        ("t", "DATETIME(3)", True),
        ("amount", "DECIMAL(12, 2)", False),
        ("kind", "ENUM('a','b)c')", True),
        ("v", "VARCHAR(30)", True),
    ]


def test_tables_without_key_are_reported_and_empty_catalog_fails(spark, workspace):
    workspace.put("snapshot/depot.log-schema.sql", "CREATE TABLE `log` (\n  `a` int\n);")
    found = cat.discover(spark, str(workspace))
    assert [r.source_table for r in cat.without_key(found).collect()] == ["log"]
    with pytest.raises(InputError, match="no table"):
        cl.catalog(spark, str(workspace))


def test_filter_to_nothing_and_name_mismatch_fail(spark, workspace):
    workspace.snapshot()
    with pytest.raises(InputError):
        cl.catalog(spark, str(workspace), ["depot.*", "!depot.parcel"])
    workspace.put("snapshot/depot.other-schema.sql", "CREATE TABLE `parcel` (\n `id` int,\n PRIMARY KEY (`id`)\n);")
    with pytest.raises(InputError, match="name_mismatch"):
        cl.catalog(spark, str(workspace))


# --- snapshot -------------------------------------------------------------------------------


def test_snapshot_maps_by_header_in_natural_order(spark, workspace):
    workspace.snapshot(_10="label,place\nLater,10\nNew,2\n", _2="place,label\n2,Old\n3,\"a \"\"q\"\",\nb\"\n")
    table = cl.catalog(spark, str(workspace)).first()
    assert rows(cl.read_snapshot(spark, str(workspace), table)) == [(10, "Later"), (2, "New"), (3, 'a "q",\nb')]


def test_snapshot_without_header_with_crlf(spark, workspace):
    workspace.snapshot(_1="1,lamp\r\n2,\\N\r\n3,\r\n")
    table = cl.catalog(spark, str(workspace)).first()
    found = cl.read_snapshot(spark, str(workspace), table, cl.Options(diagnostics="_cdc_"))
    assert rows(found) == [(1, "lamp", 0, "depot", "parcel"), (2, None, 0, "depot", "parcel"), (3, "", 0, "depot", "parcel")]


def test_row_equal_to_the_header_is_data_when_not_first(spark, workspace):
    ddl = "CREATE TABLE `{table}` (\n  `place` varchar(9) NOT NULL,\n  `label` varchar(9),\n  PRIMARY KEY (`place`)\n);"
    workspace.snapshot(ddl=ddl, _1="place,label\na,b\nplace,label\n", _2="c,d\n")
    table = cl.catalog(spark, str(workspace)).first()
    assert rows(cl.read_snapshot(spark, str(workspace), table)) == [("a", "b"), ("c", "d"), ("place", "label")]


def test_snapshot_width_is_checked(spark, workspace):
    workspace.snapshot(_1="1,lamp\n2\n")
    table = cl.catalog(spark, str(workspace)).first()
    with pytest.raises(Exception, match="wrong width"):
        cl.read_snapshot(spark, str(workspace), table).collect()
    kept = cl.read_snapshot(spark, str(workspace), table, cl.Options(on_error="quarantine"))
    assert rows(kept) == [(1, "lamp")]


def test_snapshot_position_must_stay(spark, workspace, out):
    workspace.snapshot(_1="1,lamp\n")
    assert cl.replay(spark, str(workspace), out).skipped == "there is no change log yet"
    workspace.snapshot(position=101)
    with pytest.raises(InputError, match="position is now 101"):
        cl.replay(spark, str(workspace), out)


# --- change log -----------------------------------------------------------------------------


def test_nothing_new_lists_nothing(spark, workspace, out, monkeypatch):
    workspace.snapshot().checkpoint(200).definition(120).changes(120, "I,parcel,depot,121,1,lamp\n")
    cl.replay(spark, str(workspace), out)
    monkeypatch.setattr(rp, "find_ranges", lambda *a: pytest.fail("listed"))
    monkeypatch.setattr(reg, "registry", lambda *a: pytest.fail("read"))
    assert cl.replay(spark, str(workspace), out).skipped == "nothing is new"


def test_files_and_versions_beyond_index_and_checkpoint_are_not_read(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120).definition(300)
    workspace.changes(120, "I,parcel,depot,121,1,lamp\n", "broken", latest=1)
    workspace.changes(300, "I,parcel,depot,301,9,Later\n")
    cl.replay(spark, str(workspace), out)
    assert state(spark, out) == [(1, "lamp")]


def test_old_versions_are_skipped(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(50).definition(90)
    workspace.changes(50, "I,parcel,depot,150,1,Late\n").changes(90, "I,parcel,depot,151,2,Good\n")
    cl.replay(spark, str(workspace), out)
    assert state(spark, out) == [(2, "Good")]


def test_several_writers_are_rejected(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120)
    workspace.put("increment/depot/parcel/120/2026-05-25/meta/CDC_w1.index", "CDC_w1_000001.csv\n")
    with pytest.raises(Exception, match="multi_writer"):
        cl.replay(spark, str(workspace), out)


def test_checksum_mismatch_fails(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120, crc=1)
    with pytest.raises(Exception, match="checksum_mismatch"):
        cl.replay(spark, str(workspace), out)


def test_known_checksum():
    import zlib

    doc = {
        "Table": "worker", "Schema": "test", "Version": 1, "TableVersion": 120, "Query": "", "Type": 0,
        "TableColumns": [{"ColumnName": "name", "ColumnType": "VARCHAR"}, {"ColumnName": "id", "ColumnType": "BIGINT"}],
        "TableColumnsTotal": 2,
    }
    assert zlib.crc32(reg.canonical_text(json.dumps(doc)).encode()) == 201152832
    assert reg.canonical_text("[1]") is None and reg.canonical_text("{") is None


def test_unknown_files_only_fail_when_asked(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120).put("increment/depot/parcel/meta/notes.txt", "x")
    with pytest.raises(InputError, match="unknown files"):
        cl.replay(spark, str(workspace), out, strict_unknown_files=True)
    assert cl.replay(spark, str(workspace), out).skipped is None


@pytest.mark.parametrize(
    "line, rule",
    [
        ("U,parcel,depot,125,1", "width"),
        ("X,parcel,depot,125,1,a", "operation"),
        ("U,other,depot,125,1,a", "identity"),
        ("U,parcel,depot,soon,1,a", "commit_ts"),
        ("U,parcel,depot,125,one,a", "value of place"),
        (",,,,,", "operation"),
    ],
)
def test_broken_rows_fail_or_are_kept_aside(spark, workspace, tmp_path, line, rule):
    workspace.snapshot().checkpoint(200).definition(120)
    workspace.changes(120, f"I,parcel,depot,121,1,lamp\n{line}\nI,parcel,depot,126,2,vase\n")
    with pytest.raises(Exception, match="breaks rule|cannot read"):
        cl.replay(spark, str(workspace), str(tmp_path / "a"))
    out = str(tmp_path / "b")
    cl.replay(spark, str(workspace), out, on_error="quarantine")
    assert state(spark, out) == [(1, "lamp"), (2, "vase")]
    bad = spark.read.parquet(f"{out}/quarantine/2/depot_parcel").collect()
    assert len(bad) == 1 and bad[0].rule.startswith(rule)


def test_header_blank_lines_fifth_field_quotes_and_crlf(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120)
    text = (
        'Operation,table,schema,ts,place,label\r\n\r\nI,parcel,depot,121,1,"say ""x"",\r\nthere"\r\n'
        'I,parcel,depot,122,true,2,"flag, ""q"""\r\nI,parcel,depot,123,3,\\N\r\nI,parcel,depot,124,4,\r\n'
    )
    workspace.changes(120, text)
    cl.replay(spark, str(workspace), out)
    assert state(spark, out) == [(1, 'say "x",\r\nthere'), (2, 'flag, "q"'), (3, None), (4, "")]


def test_partitions_with_and_without_dates(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120)
    workspace.changes(120, "I,parcel,depot,121,1,a\n", sub="")
    workspace.changes(120, "I,parcel,depot,122,2,b\n", sub="7")
    workspace.changes(120, "I,parcel,depot,123,3,c\n", sub="7/2026-05-25")
    workspace.changes(120, "I,parcel,depot,124,4,d\n", sub="1234/2026-05-26")
    cl.replay(spark, str(workspace), out)
    assert [r[0] for r in state(spark, out)] == [1, 2, 3, 4]
    streams = {(s.partition_id, s.last_date) for s in cl.StateStore(spark, out).streams().collect()}
    assert streams == {(0, ""), (7, "2026-05-25"), (1234, "2026-05-26")}


def test_interleaved_partitions_need_stream_order(spark, workspace, tmp_path):
    workspace.snapshot().checkpoint(200).definition(120)
    # the row moves from partition 2 to partition 1 at one commit time
    workspace.changes(120, "I,parcel,depot,130,1,moved\n", sub="1")
    workspace.changes(120, "I,parcel,depot,121,1,first\nD,parcel,depot,130,1,first\nI,parcel,depot,131,2,x\nD,parcel,depot,131,2,x\n", sub="2")
    with pytest.raises(InputError, match="goes backwards"):
        cl.replay(spark, str(workspace), str(tmp_path / "a"))
    out = str(tmp_path / "b")
    cl.replay(spark, str(workspace), out, commit_order="stream")
    assert state(spark, out) == [(1, "moved")]


def test_columns_added_dropped_and_widened(spark, workspace, out):
    ddl = "CREATE TABLE `{table}` (\n  `id` int NOT NULL,\n  `name` varchar(9),\n  `n` int,\n  PRIMARY KEY (`id`)\n);"
    workspace.snapshot(ddl=ddl, _1="1,a,10\n2,b,20\n").checkpoint(200)
    workspace.definition(120, [("id", "INT"), ("name", "VARCHAR"), ("n", "BIGINT"), ("day", "DATE")])
    workspace.changes(120, "U,parcel,depot,121,1,a,5000000000,2024-01-02\n")
    cl.replay(spark, str(workspace), out, buckets=2)
    found = cl.StateStore(spark, out, 2).read("depot_parcel")
    assert found.dtypes == [("id", "int"), ("name", "string"), ("n", "bigint"), ("day", "date")]
    assert [(r.id, r.n, str(r.day)) for r in found.orderBy("id").collect()] == [(1, 5000000000, "2024-01-02"), (2, 20, "None")]
    workspace.checkpoint(300).definition(250, [("id", "BIGINT"), ("n", "BIGINT")]).changes(250, "U,parcel,depot,251,2,7\n")
    cl.replay(spark, str(workspace), out, buckets=2)
    found = cl.StateStore(spark, out, 2).read("depot_parcel").orderBy("id").collect()
    assert [(r.id, r.name, r.n) for r in found] == [(1, "a", 5000000000), (2, None, 7)]


def test_lost_key_column_fails(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120, [("label", "VARCHAR")]).changes(120, "I,parcel,depot,121,x\n")
    with pytest.raises(InputError, match="lack key columns"):
        cl.replay(spark, str(workspace), out)


def test_columns_named_like_the_meta_columns(spark, workspace, out):
    ddl = "CREATE TABLE `{table}` (\n  `op` int NOT NULL,\n  `date` varchar(9),\n  `row_seq` int,\n  PRIMARY KEY (`op`)\n);"
    workspace.snapshot(ddl=ddl, _1="1,a,1\n").checkpoint(200).definition(120, [("op", "INT"), ("date", "VARCHAR"), ("row_seq", "INT")])
    workspace.changes(120, "U,parcel,depot,121,1,b,2\nI,parcel,depot,122,2,c,3\n")
    cl.replay(spark, str(workspace), out)
    assert state(spark, out) == [(1, "b", 2), (2, "c", 3)]


def test_duplicate_definition_takes_the_last_path(spark, workspace):
    workspace.snapshot().definition(120, query="a").definition(120, columns=[("place", "BIGINT"), ("label", "TEXT")], query="b")
    found = reg.registry(spark, str(workspace), cl.catalog(spark, str(workspace)), 200).collect()
    paths = sorted(p.name for p in (workspace.root / "increment/depot/parcel/meta").iterdir())
    assert len(found) == 1 and found[0].n_files == 2 and found[0].path.endswith(paths[-1])


def test_unmanaged_tables_are_left_alone(spark, workspace, out):
    workspace.snapshot().checkpoint(200).definition(120).changes(120, "I,parcel,depot,121,1,a\n")
    workspace.put("increment/depot/stranger/120/meta/CDC.index", "nonsense")
    cl.replay(spark, str(workspace), out)
    assert state(spark, out) == [(1, "a")]


def test_output_names_must_differ(spark, workspace, out):
    for name in ("a_b", "a+b"):
        workspace.snapshot(table=name)
    with pytest.raises(InputError, match="output name"):
        cl.replay(spark, str(workspace), out)


def test_checkpoint_metadata_is_checked(spark, workspace):
    assert log.checkpoint_bound(spark, str(workspace)) is None
    workspace.put("increment/metadata", '{"checkpoint-ts": "x"}')
    with pytest.raises(InputError):
        log.checkpoint_bound(spark, str(workspace))


def test_commit_order_across_chunks(spark):
    from changeloom.operators.checks import commit_order_violations

    n = 1000
    df = spark.range(n).select(
        F.lit("s").alias("source_schema"), F.lit("t").alias("source_table"), F.lit(1).cast("bigint").alias("table_version"),
        F.lit(0).cast("bigint").alias("partition_id"), F.lit("").alias("date"), (F.col("id") / 300).cast("bigint").alias("file_index"),
        F.lit(0).cast("bigint").alias("block_start"), F.col("id").alias("row_seq"),
        F.when(F.col("id").isin(0, 7, 299, 300, 555), F.col("id") - 3).otherwise(F.col("id")).alias("commit_ts"),
    )
    expected = [7, 299, 300, 555]
    for chunk in (1, 7, 100, 5000):
        found = commit_order_violations(df, chunk_rows=chunk)
        assert sorted(r.row_seq for r in found.collect()) == expected
    carry = spark.createDataFrame([("s", "t", 2)], "source_schema string, source_table string, last_commit_ts bigint")
    assert sorted(r.row_seq for r in commit_order_violations(df, carry=carry).collect()) == [0, 1, *expected]
