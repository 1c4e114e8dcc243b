"""Silver views over bronze show what the ingest wrote; the entry module works without libraries of llm."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from clickmart.streaming.ingest import read_events, start_ingest
from tests.conftest import ROOT
from tests.test_ingest import GOOD


def test_live_views_follow_the_ingest(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for n in range(2):
        with open(os.path.join(src, f"{n}.json"), "w") as f:
            f.write("\n".join(json.dumps(dict(GOOD, event_id=f"E{n}-{i}", session_id=f"S{n}")) for i in range(5)) + "\n")
        q = start_ingest(read_events(spark, "text", src), f"{tmp_dir}/b", f"{tmp_dir}/r", f"{tmp_dir}/c", available_now=True, live_views=True)
        q.awaitTermination()
        q.stop()
        assert spark.sql("SELECT count(*) AS n FROM stg_clickstream_events").first().n == 5 * (n + 1)
        assert spark.sql("SELECT count(DISTINCT session_id) AS n FROM int_user_sessions").first().n == n + 1


def test_entry_module_without_a_library_of_llm():
    """A missing library takes away only the queries that need it."""
    code = "import sys; sys.modules['tiktoken'] = None; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'mart_user_behavior' in q)"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    n, sql, there = said.stdout.split()
    assert int(n) >= 47 and int(sql) >= 47 and there == "True"
