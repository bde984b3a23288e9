import uuid

from stardw.llm import tables
from stardw.llm.components import components


def test_rounds_on_few_links_take_few_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tables, "work_folder", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    links = spark.range(3000).filter("id % 10 < 9").selectExpr("id AS a", "id + 1 AS b")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r.node: r.root for r in components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {n: n // 10 * 10 for n in range(3000)}
    rounds = [*tmp_path.glob("large-star-*"), *tmp_path.glob("small-star-*")]
    assert rounds
    for folder in rounds:
        assert len([*folder.glob("part-*")]) <= spark.sparkContext.defaultParallelism
