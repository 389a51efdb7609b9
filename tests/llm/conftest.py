from __future__ import annotations

import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TYPES = {"doc_id": pa.int64(), "item_id": pa.int64(), "page_id": pa.int64(), "vec_id": pa.int64(), "toxic": pa.int32(), "label": pa.int32(), "embedding": pa.list_(pa.float32())}


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture
def tables(tmp_path):
    """A function that writes tables of plain rows and gives their folder."""

    def write(**rows: list[tuple]) -> str:
        for name, (columns, *values) in rows.items():
            data = {c: pa.array([v[i] for v in values], TYPES.get(c, pa.string())) for i, c in enumerate(columns)}
            pq.write_table(pa.table(data), str(Path(tmp_path, f"{name}.parquet")))
        return str(tmp_path)

    return write


def real(name: str, sf_dir: str = SF_DIR) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()
