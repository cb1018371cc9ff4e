"""Lost tasks: the one-pass refresh and its publishing give the exact result when
a task dies mid-job and Spark retries it.

Runs in a child process, because it needs its own session with task retries
enabled (``local[4,4]``: up to 4 attempts per task). A test-only Python UDF
fails the first attempt of the input stage's first partition.
"""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from tunelake.plans import oracle
    from tunelake.plans.refresh import refresh_results, result_tables
    from tunelake.session import scratch_path
    from tunelake.sinks.publish import read_published
    from tunelake.sources.fixtures import chart_view

    import os, tempfile
    marker = os.path.join(tempfile.mkdtemp(prefix="retry-marker-"), "failed")

    @F.udf("string")
    def flaky(s):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            open(marker, "a").close()      # local mode: same machine as the driver
            raise RuntimeError("injected task loss")
        return s

    chart = chart_view(spark, "/root/testdata/sf0.001")
    faulty = chart.withColumn("country", flaky("country"))
    root = scratch_path(spark, "retry-results")
    refresh_results(faulty, root, oracle.FIXTURE_YEAR, oracle.FIXTURE_ARTIST_PREFIX)
    want = result_tables(chart, oracle.FIXTURE_YEAR, oracle.FIXTURE_ARTIST_PREFIX)

    def rows(df):
        return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
                      for r in df.collect())

    same = {{t: rows(read_published(spark, root, t)) == rows(df) for t, df in want.items()}}
    print("FAILED_ONCE " + json.dumps(os.path.exists(marker)))
    print("RESULT " + json.dumps(same))
""").format(root=ROOT)


def test_refresh_is_exact_after_a_lost_task():
    out = subprocess.run([sys.executable, "-c", CHILD], capture_output=True, text=True,
                         timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, out.stdout[-2000:] + out.stderr[-4000:]
    same = json.loads(line[0][len("RESULT "):])
    assert same and all(same.values()), same
    assert "FAILED_ONCE true" in out.stdout        # the failure really happened
