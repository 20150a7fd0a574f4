"""Every query over the driver's tables against DuckDB."""

import pytest
from conftest import SF, same_as_sql

from adjudica.plans import exported, imaging, measured, reviewed  # noqa: F401
from adjudica.plans.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    if name in ORACLE:
        same_as_sql(got, ORACLE[name])
    else:
        assert got.count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_kinds_of_one_check_share_a_join(spark):
    from __spark_entry__ import queries

    plan = queries()["suspicious_checks"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 3  # S03, S04 and S05; a join for each kind of issue made it seven


def test_nested_fields_reads_documents_once(spark):
    from __spark_entry__ import queries

    plan = queries()["nested_fields"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # images were joined to their own annotations, so that documents were made and parsed twice


def test_checks_of_masks_share_a_join(spark):
    from __spark_entry__ import queries

    plan = queries()["mask_checks"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 4  # masks, their files, declared sizes and images; a join for each kind of issue made it more


def test_documents_are_parsed_once(spark):
    from adjudica.plans.reviewed import _documents

    plan = _documents(spark, "/root/testdata/sf0.001").filter("doc.dataset is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # a condition on a parsed document parsed it again


def test_masks_are_made_of_frames_not_of_their_rows(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = imaging._scanned(spark, "/root/testdata/sf0.001")
    assert "Generate" not in plan(found["annotations"])  # names of masks took all rows of pixels of all masks
    for name in ("shape_masks", "drawn_masks"):
        assert "Generate" not in plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
