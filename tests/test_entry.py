import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Block:
    def find_spec(self, name, *rest):
        if name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print(len(e.QUERIES), len(e.queries()), all(k in e.queries() for k in e.oracle_sql()))
"""


def test_entry_without_what_the_corpus_operators_need():
    for name in ("geoprofile.llm", "xxhash"):
        out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=HERE, capture_output=True, text=True, timeout=120)
        own, all_, known = out.stdout.split()[-3:]
        assert own == all_ and int(own) >= 36 and known == "True", out.stderr


def test_entry_without_the_pipeline():
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(name="corpus_pipeline")], cwd=HERE, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
