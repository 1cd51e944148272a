import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/tests/", 1)[0]
BLOCK = """
import builtins, sys, warnings
real = builtins.__import__
def importing(name, *a, **k):
    if name == {blocked!r} or name.startswith({blocked!r} + "."):
        raise ImportError("blocked: " + name)
    return real(name, *a, **k)
builtins.__import__ = importing
warnings.simplefilter("ignore")
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert set(o) <= set(q)
print(len(q), sum(n.startswith("op") and n[2].isdigit() for n in q), "pipeline" in q)
"""


@pytest.mark.parametrize("blocked", ["xxhash", "public_tokenizers", "cinerank.llm"])
def test_a_missing_library_leaves_the_other_queries(blocked):
    out = subprocess.run([sys.executable, "-c", BLOCK.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, own, pipeline = out.stdout.split()
    assert int(n) >= 45 and own == "0" and pipeline == "False"
