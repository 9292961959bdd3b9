"""Plans and intermediate sizes that have to hold when the tables grow."""

import pytest

from cinderlane.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_labels_send_only_masks_to_the_driver(spark):
    assert plan(QUERIES["command_labels"](spark, DATA)).count("BroadcastHashJoin") == 1


def test_parity_derives_labels_once(spark):
    assert "Generate" not in plan(QUERIES["label_parity"](spark, DATA))


def test_levels_of_parents_send_no_tables_to_the_driver(spark):
    assert "BroadcastHashJoin" not in plan(QUERIES["inherit_attributes"](spark, DATA))


def test_side_records_work_base_names_out_once(spark):
    import re

    text = QUERIES["side_records"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_replace", text)) == 2


def test_facts_read_a_text_once_a_level(spark):
    text = QUERIES["json_facts"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < text.lower().count("rlike") <= text.count("LogicalRDD")


def test_components_link_again_only_what_is_left(spark, monkeypatch):
    from cinderlane.operators import splits

    kept, cut = [], splits.cut
    monkeypatch.setattr(splits, "cut", lambda rows: kept.append(cut(rows)) or kept[-1])
    edges = [(i % 3, 1000 + i) for i in range(600)] + [((i + 1) % 3, 1000 + i) for i in range(600)] + [(7, 2000), (8, 8)]
    found = {r.node: r.root for r in splits.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {0: 0, 1: 0, 2: 0, 7: 7, 2000: 7, 8: 8} | {1000 + i: 0 for i in range(600)}
    assert max(d.count() for d in kept if d.columns == ["x", "y"]) <= 3


def shuffled_first(text, columns):
    """Whether what a plan reads is dealt by these columns before anything is summed."""
    import re

    lowest = [line for line in text.splitlines() if re.search("Exchange|Aggregate", line)][-1]
    return "REPARTITION_BY_COL" in lowest and all(c in lowest for c in columns)


def test_planes_and_sparse_rows_are_dealt_before_they_are_summed(spark):
    assert shuffled_first(plan(QUERIES["semantic_planes"](spark, DATA)), ["l_orderkey"])
    text = plan(QUERIES["sparse_grids"](spark, DATA))
    assert "REPARTITION_BY_COL" in text and text.count("hashpartitioning(o_custkey") == 2


def test_rebuilding_reads_written_deltas(spark):
    text = plan(QUERIES["entity_rebuild"](spark, DATA))
    assert "_then" not in text and text.count("Window") < 6


def test_a_board_is_packed_and_opened_without_turning_texts(spark):
    text = plan(QUERIES["derived_masks"](spark, DATA))
    assert "conv(" not in text and text.count("reverse(") <= 1 and "lpad(" not in text


def test_labels_carry_cells_and_not_boards(spark):
    text = plan(QUERIES["deployment_labels"](spark, DATA))
    assert "BroadcastHashJoin" not in text and "SortAggregate" not in text and "sym0" not in text


def test_labels_deal_narrow_rows_once_and_no_candidates(spark):
    import re

    text = plan(QUERIES["command_labels"](spark, DATA))
    dealt = re.findall(r"Exchange hashpartitioning\((\w+?)#\d+L?, \d+\), (\w+)", text)
    assert sorted(dealt) == [("l_orderkey", "REPARTITION_BY_COL"), ("o_orderkey", "REPARTITION_BY_COL"), ("o_orderkey", "REPARTITION_BY_COL")]
    assert text.count("Exchange hashpartitioning") == 3 and "SortMergeJoin" not in text and text.count("Sort [") == 1


def test_parity_deals_written_labels_no_more(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    assert "Exchange" not in plan(QUERIES["label_parity"](spark, DATA))
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
