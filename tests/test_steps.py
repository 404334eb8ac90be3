from pricekit.plans.steps import as_views, cluster_steps, cost_steps
from pricekit.queries import AMS, AS_OF, EMEA
from pricekit.sources import adapters
from tests.conftest import SMALL, rows


def test_views_of_the_jobs(spark):
    load = adapters.loader(spark, SMALL)
    names = as_views(cluster_steps(adapters.cluster_feeds(load), EMEA, AMS), "c")
    assert names == {s: f"c_{s}" for s in ("conformed", "allowed", "period", "result")}
    assert spark.table("c_period").count() == spark.table("c_result").count() > 0
    assert spark.sql("SELECT count(*) FROM c_allowed WHERE country_code NOT IN ('GB', 'FR', 'DE', 'US')").first()[0] == 0
    steps = cost_steps(adapters.cost_feed(load), None, None, AS_OF)
    as_views(steps, "k")
    kept = spark.sql("SELECT product_id, country_name FROM k_batch EXCEPT SELECT product_id, country_name FROM k_dropped")
    assert rows(kept) == rows(spark.table("k_result"), "product_id", "country_name")


def test_one_step_plans_only_its_part(spark):
    as_views(cost_steps(adapters.cost_feed(adapters.loader(spark, SMALL)), None, None, AS_OF), "p")
    plan = spark.sql("SELECT product_id FROM p_new")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
