"""The contract module without the corpus part, or without the libraries that only it needs."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import ROOT

from shelflake.catalogue import QUERIES

BLOCK = """
import sys, warnings
warnings.simplefilter("ignore")
for name in {names!r}:
    sys.modules[name] = None
import __spark_entry__ as contract
print(len(contract.queries()), len(contract.oracle_sql()))
"""


@pytest.mark.parametrize(
    "names",
    [
        ["tiktoken"],
        ["xxhash"],
        ["public_tokenizers"],
        ["sentencepiece", "tokenizers", "tiktoken", "xxhash", "public_tokenizers"],
        ["shelflake.llm"],
        ["corpus_pipeline"],
    ],
)
def test_the_rest_works_alone(names):
    code = BLOCK.format(names=names)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES))] * 2
