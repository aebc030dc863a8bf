import pytest

from dialoom.llm.queries import oracle_sql, queries
from tests.compare import both

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(spark, name):
    got, want = both(spark, queries(), oracle_sql(), name, SF)
    assert got == want


def test_splits_keep_groups_and_sample_keeps_plans(spark):
    split = {r.dialogue_id: r.split for r in queries()["p1_splits"](spark, SF).collect()}
    groups: dict = {}
    for r in queries()["p1_found"](spark, SF).collect():
        groups.setdefault(r.group_id, set()).add(split[r.dialogue_id])
    assert all(len(v) == 1 for v in groups.values())
    assert {r.defect for r in queries()["p2_found"](spark, SF).collect()} <= {"empty", "truncated", "refusal", "copy", "other_language"}
    assert queries()["p6_pack"](spark, SF).count() > 0
