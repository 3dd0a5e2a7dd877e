import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from rfspark.plans import registry
from tools.check import TABLES, norm

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "g9_epochs", "g2_adaptive_tolerance", "g5_retunes_announced_baseline", "g8_break_log", "s3_parse_headers",
    "s6_decode_int16_scaled", "m3_band_join", "r3_reblock", "p5_channel_power", "l3_throughput", "h2_block_health",
    "h1_flatten_tree", "m9_linked_chains", "m11_unreadable_files", "s10_load_spectra", "s10_load_compressed_spectra",
    "s8_histogram_planes", "s8_categories", "t3_connection_sessions", "t5_enriched_breaks",
]


def test_names_and_checks_line_up():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert len(registry.queries()) > 110


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    want = sorted((tuple(norm(r[k]) for k in order) for r in cur.fetchall()), key=repr)
    assert sorted(names) == columns and got == want


def test_entry_point_without_the_training_data_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "rfspark"), tmp_path / "rfspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(registry.queries())), "True"]
