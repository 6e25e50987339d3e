import pytest

from stridelake.llm import queries
from tests.oracle import SF, differences


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    assert differences(spark, queries.QUERIES[name], queries.ORACLE[name]) == ([], [])


def test_every_clip_and_text_is_placed(spark):
    clips = queries.p2_assigned(spark, SF)
    assert clips.count() == clips.select("motion_id").distinct().count() == spark.read.parquet(f"{SF}/clip.parquet").select("motion_id").distinct().count()
    places = queries.p6_places(spark, SF)
    texts = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").select("doc_id").distinct().count()
    assert places.select("doc_id").distinct().count() == texts
    assert places.groupBy("container_id").sum("n_tokens").where("`sum(n_tokens)` > 4096").count() == 0
