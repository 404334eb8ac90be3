from pricekit.operators.expand import enrich, expand_by_rule
from pricekit.plans.rates import CATEGORY_RULES
from tests.conftest import rows


def test_expand_by_rule(spark):
    df = spark.createDataFrame([("pricing - IPG", 1), ("pricing - PSG", 2), ("other", 3)], "use_case string, id int")
    got = rows(expand_by_rule(df, "use_case", CATEGORY_RULES, "category"), "id", "category")
    assert got == [(1, "Print"), (2, "Business"), (2, "Consumer")]
    plan = expand_by_rule(df, "use_case", CATEGORY_RULES, "category")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_enrich_missing_and_duplicate_keys(spark):
    facts = spark.createDataFrame([("P1", 1), ("P2", 2), ("P3", 3)], "product_number string, x int")
    dim = spark.createDataFrame([("P1", "F1"), ("P2", "F2"), ("P2", "F2-ALT"), ("P9", "F9")],
                                "product_number string, family string")
    got = rows(enrich(facts, dim, "product_number", ["family"]), "x", "family")
    assert got == [(1, "F1"), (2, "F2"), (2, "F2-ALT"), (3, None)]
