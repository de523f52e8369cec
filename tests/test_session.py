import hashlib
import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {repo!r})
from strata.session import build_session
from strata.sources.landing import file_md5, landing_files
spark = build_session("elsewhere", 1)
print("MD5", file_md5(landing_files(spark, {folder!r})).first().actual_md5)
"""


def test_tasks_find_the_package_from_another_folder(tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.csv").write_bytes(b"x,y\n1,2\n")
    code = CODE.format(repo=str(Path(__file__).resolve().parent.parent), folder=str(tmp_path / "data"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert f"MD5 {hashlib.md5(b'x,y' + bytes([10]) + b'1,2' + bytes([10])).hexdigest()}" in done.stdout, done.stderr[-2000:]
