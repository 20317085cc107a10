"""Every registered query against its SQL counterpart, over whole tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import check
import __spark_entry__ as entry
from catalog import registered

SF = "/root/testdata/sf0.001"
# The SQL takes plain Newton steps, which do not converge on the 21 events of the smallest tables.
LARGER = {"cox_ph": "/root/testdata/sf0.01", "cox_summary": "/root/testdata/sf0.01",
          "cox_hazard_ratios": "/root/testdata/sf0.01", "dashboard_document": "/root/testdata/sf0.01",
          "dashboard_kpis": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES)))
def test_query(spark, name):
    folder = LARGER.get(name, SF)
    good, note = check.compare(spark, check.connect(folder), folder, name)
    assert good is not False, note


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("absent", ["basketlens.llm", "corpus_pipeline", "zstandard", "xxhash"])
def test_entry_without_the_operators_for_training_data(absent):
    """The folders, or a package that only they need, may be missing."""
    code = (f"import sys; sys.modules['{absent}'] = None; import __spark_entry__ as e; "
            "assert len(e.queries()) > 80 and not any(n.startswith('op1_') for n in e.queries()) and set(e.oracle_sql()) <= set(e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
