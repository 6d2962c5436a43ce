import subprocess
import sys

from tessera.session import scratch_path, shared_dir


def test_shared_folder_is_the_sessions_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and shared_dir(spark) == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(configured.rstrip("/"))  # never reused


def test_command_line_lists_every_key():
    import __spark_entry__ as E
    out = subprocess.run([sys.executable, "-m", "tessera", "list"], capture_output=True, text=True, timeout=120,
                         cwd=E._HERE)
    listed = {line.split()[0] for line in out.stdout.splitlines() if line.strip()}
    from tessera.plans import QUERIES

    assert listed == set(QUERIES) <= set(E.queries())
