"""The entry point with and without the optional subpackage, and the direction of imports."""

import ast
import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).parent.parent


def names(prelude):
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r}); {prelude}; import __spark_entry__ as e; print(*e.queries())"
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()


def test_imports_without_the_optional_part():
    without = names("sys.modules['corpus_pipeline'] = None; sys.modules['silverloom.llm'] = None")
    assert "class_role_counts" in without and not any(n.startswith("op") or n == "pipeline" for n in without)


def test_nothing_else_imports_it():
    for path in (ROOT / "silverloom").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            found = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in name.split(".") or name == "corpus_pipeline" for name in found), path


def test_entry(spark):
    sys.path.insert(0, str(ROOT))
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["dataset", "role", "class_name", "num_boxes"] and out.count() > 0
