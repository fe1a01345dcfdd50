import os
import subprocess
import sys
import textwrap

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)

SCRIPT = textwrap.dedent(
    """
    import json, sys
    from test_sources import _tiles
    from rastercube.session import build_session
    from rastercube.sources.tiles import load_tiles

    folder = sys.argv[1]
    spark = build_session("local[2,3]", conf={"spark.sql.shuffle.partitions": "4"})
    tiles = _tiles(folder)
    recs = spark.createDataFrame([(p, d, n) for n, d, _, _, p in tiles], "path string, date string, name string")
    opts = dict(step=10, strip_rows=2)
    flaky = sorted(tuple(r) for r in load_tiles(spark, recs, decoder="flaky_decoder:FLAKY", **opts).collect())
    clean = sorted(tuple(r) for r in load_tiles(spark, recs, **opts).collect())
    print(json.dumps({"equal": flaky == clean, "rows": len(clean)}))
    spark.stop()
    """
)


def test_lost_task_is_retried_with_identical_rows(tmpdir_path):
    mark = os.path.join(tmpdir_path, "failed-once")
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([ROOT, HERE]), RASTERCUBE_FLAKY_MARK=mark)
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, tmpdir_path], cwd=HERE, env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert os.path.exists(mark)  # the first attempt did fail
    assert '"equal": true' in out.stdout.strip().splitlines()[-1]
