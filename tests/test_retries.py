"""Task retries (what a lost executor causes): results stay exact and API
calls are not repeated once their responses are checkpointed. Runs in a
subprocess because the shared test session (``local[4]``) never retries."""

import json
import os
import subprocess
import sys

HELPER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "helpers", "retry_run.py")


def test_results_and_calls_survive_task_retries(tmp_path):
    calls, scratch = tmp_path / "calls", tmp_path / "scratch"
    calls.mkdir()
    proc = subprocess.run(
        [sys.executable, HELPER, str(calls), str(scratch)], capture_output=True, text=True, timeout=600
    )
    line = [x for x in proc.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, proc.stderr[-3000:]
    out = json.loads(line[-1][len("RESULT "):])
    # numbering under retried input and output stages equals row_number
    assert out["batches_equal"] and out["n_batches"] == 34 + 67
    # checkpointed responses: one call per request, whatever retries later
    assert out["checkpointed_requests"] == 40 and out["checkpointed_calls"] == 40
    # without the cut, each retried downstream task calls the API again
    assert out["plain_requests"] == 40 and out["plain_calls"] > 40
    # the flagship merge picks the same rows when its input tasks retry
    assert out["merge_rows"] > 0 and out["merge_equal"]
