import importlib.util
import os

from conftest import ROOT


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = load_entry()
    df = mod.entry(spark)
    out = df.collect()
    assert len(out) >= 5
    assert df.columns == ["country_name", "guests_country", "guest_pct"]


def test_registry_contract():
    mod = load_entry()
    q, sql = mod.queries(), mod.oracle_sql()
    assert len(q) >= 65
    assert set(sql) <= set(q)
    assert all(callable(f) for f in q.values())


def test_named_results_are_ordered(spark):
    from conftest import SF_SMALL
    q = load_entry().queries()
    top = [r["guests_country"] for r in q["guest_origin_top5_numeric"](spark, SF_SMALL).collect()]
    assert top == sorted(top, reverse=True)
    shares = [r["guests_country"] for r in q["guest_origin_share"](spark, SF_SMALL).collect()]
    assert shares == sorted(shares, reverse=True)
    months = [(r["hotel"], r["month_ord"]) for r in q["busy_months_normalised"](spark, SF_SMALL).collect()]
    assert months == sorted(months)


def test_entry_works_without_the_training_data_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = ("import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); "
            "assert len(q) >= 60 and set(s) <= set(q) and 'pipeline' not in q and not any(n.startswith('op1') for n in q)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, check=True)


def test_the_library_does_not_import_the_subpackage():
    import re
    for folder, _, files in os.walk(os.path.join(ROOT, "insight")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert not re.search(r"insight\.llm|corpus_pipeline", open(os.path.join(folder, f)).read()), f
