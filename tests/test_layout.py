"""What the library must not use, whatever the operator."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1] / "tidemark"
# The llm subpackage has rules of its own; nothing else may import it.
LIBRARY = sorted(p for p in ROOT.rglob("*.py") if "llm" not in p.relative_to(ROOT).parts)
UNWANTED = (
    r"\budf\b|pandas|\.rdd\b|\.toPandas\(|localCheckpoint|crossJoin|\.cache\(|\.persist\("
    r"|broadcast\(|\.toLocalIterator\(|\.foreach|\bexit\(|\.master\("
)
# Both collect a report, which has a row per rule.
MAY_COLLECT = {"contracts.py", "__main__.py"}


@pytest.mark.parametrize("path", LIBRARY, ids=lambda path: path.name)
def test_only_declarative_spark(path):
    code = path.read_text()
    assert not re.search(UNWANTED, code)
    assert ".collect()" not in code or path.name in MAY_COLLECT
    assert "print(" not in code
    assert not re.search(r"\bllm\b", code)
