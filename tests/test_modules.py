"""What holds for every module."""

import ast
from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]


@pytest.mark.parametrize("path", sorted(p for p in ROOT.rglob("*.py") if ".git" not in p.parts), ids=lambda p: str(p.relative_to(ROOT)))
def test_no_name_is_defined_twice(path):
    tree = ast.parse(path.read_text())
    for body in [tree.body, *(n.body for n in tree.body if isinstance(n, ast.ClassDef))]:
        names = Counter(n.name for n in body if isinstance(n, ast.FunctionDef | ast.ClassDef))
        assert not [n for n, k in names.items() if k > 1]
