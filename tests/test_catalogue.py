"""The catalogue kept by key: equal results, and no shuffle of the catalogue."""

import pytest

from tapedeck.plans import enrichment
from tapedeck.registry.views import Views
from tapedeck.sources import catalogue as kept


def shuffled_scans(plan):
    """Tables that are shuffled between their scan and the first join above it."""
    found = []

    def walk(node, exchanged):
        name = node.nodeName()
        exchanged = False if "Join" in name else exchanged or "Exchange" in name
        if name.startswith("Scan") and exchanged and "catalogue_" in node.toString():
            found.append(node.toString())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k), exchanged)

    walk(plan, False)
    return found


@pytest.fixture(scope="module")
def views(spark, sf_dir):
    return Views(spark, sf_dir)


def test_copies_by_key_give_the_same_and_are_not_shuffled(spark, views, tmp_path):
    plain, root = views.catalogue, str(tmp_path / "kept")
    kept.keep_by_key(plain, root, 4)
    pairs = views.plays.select("artist_name", "track_name").na.drop().distinct().limit(300)
    held = pairs.toPandas()
    pairs = spark.createDataFrame(held)
    for fresh in (False, True):
        if fresh:  # another session knows nothing of the tables
            for name, key in kept.COPIES:
                spark.sql(f"drop table {kept._table_name(root, name, key)}")
        copies = kept.read_kept(spark, root)
        for phase in (
            lambda c: enrichment.first_matches(pairs, c), lambda c: enrichment.enrich_tracks(views.tracks, c),
            lambda c: enrichment.enrich_artists(views.artists, c), lambda c: enrichment.enrich_albums(views.albums, c),
        ):
            assert sorted(map(repr, phase(copies).collect())) == sorted(map(repr, phase(plain).collect()))
    limit, adaptive = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(50).selectExpr("id as track_rowid")
        for df in (enrichment.first_matches(pairs, copies), enrichment.catalogue_rows(rows, copies), enrichment.audio_features(views.tracks, copies)):
            assert shuffled_scans(df._jdf.queryExecution().executedPlan()) == []
        assert copies.by("tracks", "rowid").repartition(7)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
