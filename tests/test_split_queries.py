"""Registered queries give the same rows when almost every repeated key is split."""

from __future__ import annotations

import pytest

from claimlake.operators import joins, masters, match, metrics
from claimlake.plans.catalog import QUERIES
from conftest import SF_DIR
from oracle_check import compare, duck
from claimlake.plans.oracle import ORACLE


@pytest.fixture()
def split_everything(monkeypatch):
    def split(left, right, on, how="left", right_unique=False, heavy=None):
        keys = [on] if isinstance(on, str) else list(on)
        both = None if right_unique or how == "left_anti" else right
        return joins.salted_join(left, right, on, how, right_unique,
                                 joins.heavy_keys(left, both, keys, heavy_rows=2))

    for module in (match, metrics, masters):
        monkeypatch.setattr(module, "salted_join", split)
    monkeypatch.setattr(joins.attach, "__defaults__", (3, False))
    monkeypatch.setattr(joins.attach_role, "__defaults__", (3,))


@pytest.mark.parametrize("name", [
    "a1_center_kpis", "w2_claim_totals", "w4_denial_count", "j5_claims_labels",
    "j6_remittance_labels", "j7_match_inner", "j13_join_masters", "j14_unlicensed_referrals",
    "p18_payment_status", "b12_matched_extract",
])
def test_split_query_equals_its_twin(spark, split_everything, name):
    problem, rows = compare(spark, duck(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name])
    assert problem is None and rows > 0


def test_keys_really_are_split(spark, split_everything):
    for name in ("j7_match_inner", "w4_denial_count"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "_salt_left" in plan, name
