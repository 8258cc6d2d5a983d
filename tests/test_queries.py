"""Every registered query against its SQL, and the inventory covered by them."""

import os
import re

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import TESTDATA
from sfqueries import REGISTRY
from sfqueries.base import waits, with_backlog
from tallymart.operators import build_fact
from tallymart.plans.contracts import WAITING_MEASURES

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    q = REGISTRY[name]
    assert compare(spark, con, q.run, q.sql, TESTDATA) > 0


def test_contract():
    own = {n for n in entry_module.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own == set(REGISTRY)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def ids(prefix, last):
    return {f"{prefix}{i}" for i in range(1, last + 1)}


def test_every_inventory_id_has_a_query():
    wanted = set().union(
        ids("S", 13), ids("P", 9), ids("F", 9), ids("J", 4), ids("A", 27), ids("R", 7), ids("O", 3), ids("U", 2),
        ids("X", 20), ids("K", 8), ids("M", 3), ids("V", 8), ids("D", 6), ids("UD", 4),
    )
    covered = {i for q in REGISTRY.values() for i in q.covers}
    assert wanted - covered == set()
    assert all(re.fullmatch(r"(UD|[SPFJAROUXKMVD])\d+", i) for i in covered)


@pytest.mark.skipif(not os.path.isdir(SF001), reason="needs the sf0.01 tables")
def test_known_band_counts(spark):
    """Order lines by waiting band at sf0.01, found once with two engines."""
    rows = with_backlog(waits(spark, SF001).withColumn("pathways", F.lit(1).cast("bigint")))
    fact = build_fact(rows, ["report_month", "provider_org_code"], WAITING_MEASURES)
    totals = build_fact(fact, [], WAITING_MEASURES).first()
    assert fact.count() == 7899
    assert (totals.within_18_weeks, totals.over_18_weeks, totals.over_52_weeks, totals.over_104_weeks) == (
        5849,
        54151,
        43540,
        29719,
    )
