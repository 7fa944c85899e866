"""Rows of loads are shuffled once for a write, without what can be worked out later."""

from starforge.operators import load
from starforge.plans import immigration, songplay, staged_load
from starforge.plans.catalog import Catalog
from starforge.sources import writers

EVENT = {
    "artist": "a", "firstName": "f", "gender": "F", "itemInSession": 1, "lastName": "l", "length": 2.0,
    "level": "paid", "location": "x", "page": "NextSong", "sessionId": 1, "song": "t ", "ts": 1_000, "userId": "1",
    "userAgent": "u",
}
SONG = {
    "artist_id": "A1", "artist_name": "a", "duration": 2.0, "song_id": "S1", "title": "t", "year": 2000,
}


def _log(spark):
    changes = [{}, {}, {"level": "free"}, {"itemInSession": 2}, {"sessionId": None, "userId": None}, {"song": "other"}]
    events = spark.createDataFrame([EVENT | c for c in changes], songplay.EVENT_SCHEMA)
    return events, spark.createDataFrame([SONG], songplay.CATALOGUE_SCHEMA)


def test_ids_of_plays_are_not_shuffled(spark, rows):
    events, songs = _log(spark)
    dealt = songplay.build_songplays(events, songs, dealt=True)
    text = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("md5") == 1 and text.index("md5") < text.index("Rebalance")
    plain = songplay.build_songplays(events, songs)
    assert rows(dealt) == rows(plain) and dealt.schema == plain.schema and plain.count() == 3


def test_parts_of_times_are_not_shuffled(spark, rows):
    events, _ = _log(spark)
    dealt = songplay.build_time(events, dealt=True)
    text = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("weekday") < text.index("Rebalance") and "weekday" not in text[text.index("Rebalance"):]
    assert rows(dealt) == rows(songplay.build_time(events)) and dealt.columns == songplay.build_time(events).columns


def test_plays_are_reduced_once(spark, rows, tmp_path, monkeypatch):
    """The load took the first row of each id again, over plays that are unique."""
    seen = []
    first = load.first_per_key
    monkeypatch.setattr(load, "first_per_key", lambda df, key, *a, **k: seen.append(list(key)) or first(df, key, *a, **k))
    events, songs = _log(spark)
    root = str(tmp_path / "star")
    for inserted in (3, 0):
        counts, _ = staged_load.load_songplay_star(events, songs, root)
        assert rows(counts.where("step = 'f_songplays'"), "inserted") == [(inserted,)]
    assert ["songplay_id", "start_time"] not in seen
    assert rows(spark.read.parquet(f"{root}/f_songplays").select("song_id", "user_id")) == sorted(
        [(None, "1"), ("S1", "1"), ("S1", None)], key=str  # of equal keys the first song
    )


def test_dealt_tables_are_written_without_a_shuffle(spark, rows, tmp_path, monkeypatch):
    dealt = []
    monkeypatch.setattr(writers, "deal", lambda df, *by: dealt.append(by) or df)
    built = spark.range(0, 20, 1, 2).selectExpr("id", "id div 10 AS m")
    catalog = Catalog(spark, str(tmp_path)).add("t", lambda c: built, ["m"], dealt=True)
    assert rows(catalog.get("t"), "id", "m") == rows(built) and not dealt
    entries = immigration.immigration_catalog(spark, str(tmp_path), *[lambda: None] * 5)._entries
    assert entries["f_i94_immigrations"].dealt
