import subprocess
import sys

import pytest
from pyspark import cloudpickle

from drivesync.operators import tree_sink
from drivesync.sources import tree
from drivesync.streaming import reassembly


@pytest.mark.parametrize("task", [
    reassembly.UploadTracker(1), tree._scan_folders("/x"),
    tree_sink._write_pieces("/x"), tree_sink._commit_files("/x"), tree_sink._remove_paths("/x"),
], ids=["tracker", "scan", "write", "commit", "remove"])
def test_tasks_load_without_the_package(task, tmp_path):
    """Executors may not have the package on their path."""
    (tmp_path / "task").write_bytes(cloudpickle.dumps(task))
    code = (
        "import sys, pickle; pickle.loads(open('task', 'rb').read());"
        "assert 'drivesync' not in sys.modules"
    )
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True, timeout=60)
