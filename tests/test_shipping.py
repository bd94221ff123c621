"""Functions for Python workers must load where this package is not installed."""

from __future__ import annotations

import os
import subprocess
import sys

from pyspark import cloudpickle

from countertide.operators import forest


def test_worker_functions_load_without_the_package(tmp_path):
    code = (
        "import sys\nfrom pyspark import cloudpickle\n"
        "f = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "import numpy as np\nprint(len(f(np.ones((4, 2)), np.random.default_rng(0), 3)))\n"
        "assert 'countertide' not in sys.modules"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(forest._grow), cwd=tmp_path, env=env, capture_output=True, check=False
    )
    assert done.returncode == 0, done.stderr.decode()
    assert done.stdout.strip() == b"1"
