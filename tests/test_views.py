"""The canonical views keep the sizes recorded in FIXTURES.md (sf0.001)."""

from pyspark.sql import functions as F

from matchday.plans import views as V

SF = "/root/testdata/sf0.001"


def test_view_sizes(spark):
    pm = V.player_match(spark, SF)
    assert pm.count() == 397
    assert pm.select("surname", "season", "round_no").distinct().count() == 397   # unique key
    fx = V.fixture(spark, SF)
    assert fx.count() == 1500 and fx.select("fixture_id").distinct().count() == 1500
    assert V.fixture_master(spark, SF).count() == 493
    assert fx.filter(F.col("home_team_id") == F.col("away_team_id")).count() == 0
    assert V.fixture_stats(spark, SF).count() == 6000
    assert V.team_map(spark, SF).count() == 19
