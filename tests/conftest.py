from __future__ import annotations

import json
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from changeloom.sources.registry import canonical_text  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


COLUMNS = [("place", "INT"), ("label", "TEXT")]
DDL = """CREATE TABLE `{table}` (
  `place` int NOT NULL,
  `label` text,
  PRIMARY KEY (`place`)
);
"""


class Workspace:
    """Writes small workspaces by hand."""

    def __init__(self, root: Path):
        self.root = root

    def __str__(self) -> str:
        return str(self.root)

    def put(self, name: str, text: str) -> "Workspace":
        path = self.root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
        return self

    def snapshot(self, table: str = "parcel", position: int = 100, ddl: str = DDL, **chunks: str) -> "Workspace":
        self.put("snapshot/metadata", f"SHOW MASTER STATUS:\n    Log: x\n    Pos: {position}\n    GTID:\n")
        self.put(f"snapshot/depot.{table}-schema.sql", ddl.format(table=table))
        for chunk, text in chunks.items():
            self.put(f"snapshot/depot.{table}.{chunk[1:]}.csv", text)
        return self

    def checkpoint(self, ts: int) -> "Workspace":
        return self.put("increment/metadata", json.dumps({"checkpoint-ts": ts}))

    def definition(self, version: int, columns=COLUMNS, table: str = "parcel", ddl_type: int = 0, query: str = "", crc=None) -> "Workspace":
        doc = {
            "Table": table, "Schema": "depot", "Version": 1, "TableVersion": version, "Query": query, "Type": ddl_type,
            "TableColumns": [{"ColumnName": n, "ColumnType": t} for n, t in columns], "TableColumnsTotal": len(columns),
        }
        text = json.dumps(doc)
        crc = zlib.crc32(canonical_text(text).encode()) if crc is None else crc
        return self.put(f"increment/depot/{table}/meta/schema_{version}_{crc}.json", text)

    def changes(self, version: int, *files: str, table: str = "parcel", sub: str = "2026-05-25", latest: int | None = None) -> "Workspace":
        base = f"increment/depot/{table}/{version}" + (f"/{sub}" if sub else "")
        for i, text in enumerate(files, 1):
            self.put(f"{base}/CDC{i:06d}.csv", text)
        return self.put(f"{base}/meta/CDC.index", f"CDC{(latest or len(files)):06d}.csv\n")


@pytest.fixture
def workspace(tmp_path) -> Workspace:
    return Workspace(tmp_path / "ws")


@pytest.fixture
def out(tmp_path) -> str:
    return str(tmp_path / "out")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
