"""What the plans must not do, read from their source."""

import ast
import pathlib

import docquarry

ROOT = pathlib.Path(docquarry.__file__).parent
FILES = [*ROOT.rglob("*.py"), ROOT.parent / "__spark_entry__.py", ROOT.parent / "bench.py"]
FORBIDDEN = {"localCheckpoint", "crossJoin", "rdd", "foreachPartition", "mapPartitions", "toLocalIterator", "gettempdir"}


def test_no_forbidden_calls():
    for file in FILES:
        for node in ast.walk(ast.parse(file.read_text())):
            if isinstance(node, ast.Attribute):
                assert node.attr not in FORBIDDEN, f"{file}:{node.lineno}"


def test_only_the_entry_lets_a_missing_module_pass():
    for file in FILES:
        for node in ast.walk(ast.parse(file.read_text())):
            if isinstance(node, ast.ExceptHandler) and node.type is not None:
                names = {n.id for n in ast.walk(node.type) if isinstance(n, ast.Name)}
                assert not names & {"ImportError", "ModuleNotFoundError"} or file.name == "__spark_entry__.py", file


def test_nothing_outside_imports_the_optional_package():
    for file in ROOT.rglob("*.py"):
        if "llm" not in file.parts:
            assert "docquarry.llm" not in file.read_text(), file
