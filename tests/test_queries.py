import subprocess
import sys

import pytest

from axisforge.plans.oracles import SQL
from axisforge.plans.queries import QUERIES

from .conftest import ROOT, SF
from .oracle import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    compare(spark, SF, QUERIES[name], SQL[name])


def test_every_query_but_the_random_ones_has_sql():
    assert set(QUERIES) - set(SQL) == {"q23b_sequential_draws"}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 448
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_entry_works_without_what_the_optional_part_needs():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; assert 'q05_hemispheres' in e.queries() and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
