"""What the queries' inputs move through shuffles."""

from lotkeeper.plans import intake, merging
from lotkeeper.plans import standins as S
from lotkeeper.sources.state import KeyedState

SF = "/root/testdata/sf0.001"


def test_the_number_of_merges_does_not_follow_the_number_of_tasks(spark, monkeypatch):
    merges, merge = [], KeyedState.merge
    monkeypatch.setattr(KeyedState, "merge", lambda self, *a: (merges.append(1), merge(self, *a))[1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        intake.stream_ingest(spark, SF)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(merges) <= 3


def test_listing_texts_are_made_after_the_last_line_of_an_ad_is_found(spark):
    plan = S.listings(spark, SF, tracked=True)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window", 1)
    assert "https://" in above and "https://" not in below


def test_the_state_of_a_merge_moves_once(spark):
    plan = merging.upsert_listings(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2
