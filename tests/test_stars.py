import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starforge.operators.joins import within
from starforge.plans import catalog, dictionary, immigration, query_tables, songplay, staged_load


def event(**values):
    base = dict(
        artist="X", auth="Logged In", firstName="Ann", gender="F", itemInSession=0, lastName="Lee", length=200.5,
        level="free", location="Reno, NV", method="PUT", page="NextSong", registration=1.5e12, sessionId=1,
        song="Song A", status=200, ts=1541105830796, userAgent="UA", userId="10",
    )
    return {**base, **values}


@pytest.fixture
def events(spark, tmp_path):
    lines = [
        event(),
        event(),  # sent twice
        event(itemInSession=1, ts=1541106000000, level="paid", song=" Song A "),
        event(itemInSession=2, ts=1541106100000, song="Unknown", artist="Y"),
        event(page="Home", artist=None, song=None, length=None, ts=1541107000000, itemInSession=3),
        event(page="Login", userId="", firstName=None, lastName=None, gender=None, artist=None, song=None, ts=1541100000000),
        event(userId="20", firstName="Bob", lastName="Ray", gender="M", sessionId=2, ts=1541200000000),
    ]
    path = tmp_path / "log.json"
    path.write_text("\n".join(json.dumps(e) for e in lines) + "\n")
    return spark.read.schema(songplay.EVENT_SCHEMA).json(str(path))


@pytest.fixture
def songs(spark):
    return spark.createDataFrame(
        [
            ("AR1", 1.5, "NV", None, "X", 200.5, 1, "SO1", "Song A", 1999),
            ("AR1", 1.5, "NV", None, "X", 201.5, 1, "SO2", "Song A", 0),
            ("AR2", None, "", None, "Z", 99.0, 1, "SO3", "Song C", 0),
        ],
        "artist_id string, artist_latitude double, artist_location string, artist_longitude double, artist_name string, "
        "duration double, num_songs int, song_id string, title string, year int",
    )


def test_songplays(events, songs, rows):
    fact = songplay.build_songplays(events, songs)
    assert rows(fact, "user_id", "song_id", "level") == [
        ("10", "SO1", "free"), ("10", "SO1", "paid"), ("10", None, "free"), ("20", "SO1", "free"),
    ]
    first = fact.where("level = 'free' and user_id = '10' and song_id is not null").first()
    assert first.start_time == dt.datetime(2018, 11, 1, 20, 57, 10, 796000)
    assert (first.year, first.month, len(first.songplay_id)) == (2018, 11, 32)
    assert fact.select("songplay_id").distinct().count() == 4
    again = songplay.build_songplays(events.repartition(3), songs.repartition(3))
    assert again.exceptAll(fact).isEmpty()


def test_songplays_with_duration_key(events, songs, rows):
    longer = songs.where("song_id != 'SO1'")
    assert rows(songplay.build_songplays(events, longer, key="title+artist+duration").where("song_id is not null")) == []
    assert songplay.build_songplays(events, longer).where("song_id = 'SO2'").count() == 3


def test_dimensions(events, songs, rows):
    assert rows(songplay.build_users_latest(events)) == [("10", "Ann", "Lee", "F", "free"), ("20", "Bob", "Ray", "M", "free")]
    fact = songplay.build_songplays(events, songs)
    assert songplay.build_user_tuples(events, fact).count() == 3
    assert songplay.build_time(events).count() == 6
    assert songplay.build_time(events, only_plays=True).count() == 4
    assert rows(songplay.build_artists(songs), "artist_id", "name") == [("AR1", "X"), ("AR2", "Z")]
    assert songplay.build_songs(songs).columns == ["song_id", "title", "artist_id", "year", "duration"]


def test_reports(events, songs, rows):
    fact = songplay.build_songplays(events, songs)
    assert rows(songplay.level_popularity(fact)) == [("free", 3, 1), ("paid", 1, 2)]
    assert rows(songplay.users_by_location(fact)) == [("Reno, NV", 4)]
    played = songplay.most_played(fact, songplay.build_songs(songs), songplay.build_artists(songs))
    assert rows(played) == [("X", "Song A", 1999, 3)]


def test_query_tables(events, rows, spark, tmp_path, plan):
    played = events.where("artist is not null")
    by_item = query_tables.item_by_session(played)
    assert rows(by_item.where("sessionId = 1 and itemInSession = 2"), "artist", "song", "length") == [("Y", "Unknown", 200.5)]
    listened = query_tables.lookup_table("items_of_user_session", str(tmp_path / "listened"))
    stored = listened.store(query_tables.items_of_user_session(played))
    assert "key_folder" not in stored.columns
    found = listened.get(spark, userId="10", sessionId=1)
    assert [r.itemInSession for r in found.collect()] == [0, 1, 2]
    text = plan(found)
    assert "PartitionFilters: [isnotnull(key_folder" in text and "PushedFilters: [IsNotNull(userId)" in text
    with pytest.raises(ValueError):
        listened.get(spark, userId="10")
    assert rows(query_tables.users_by_song(played).where("song = 'Song A'"), "user") == [("Ann Lee",), ("Bob Ray",)]


def test_event_csv_to_query_tables(spark, tmp_path, rows):
    header = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId"
    first = [
        'Faith,Logged In,Ann,F,4,Lee,495.3,free,"Reno, NV",PUT,NextSong,1.54E+12,338,Music,200,1.54111E+12,50',
        ',Logged In,Ann,F,5,Lee,,free,"Reno, NV",GET,Home,1.54E+12,338,,200,1.54111E+12,50',
    ]
    second = ['"A, B",Logged In,Bob,M,0,Ray,10.5,paid,"LA, CA",PUT,NextSong,1.54E+12,7,"Say ""hi""",200,1.54112E+12,9']
    for name, lines_ in (("d1.csv", first), ("d2.csv", second)):
        (tmp_path / name).write_text("\n".join([header, *lines_]) + "\n")
    played = query_tables.stage_event_csv(spark, f"{tmp_path}/*.csv", str(tmp_path / "full"))
    assert played.columns[0] == "artist" and len(played.columns) == 11
    by_item = query_tables.item_by_session(played)
    assert rows(by_item.where("sessionId = 338 and itemInSession = 4"), "artist", "song", "length") == [("Faith", "Music", 495.3)]
    assert rows(query_tables.users_by_song(played).where("song = 'Say \"hi\"'"), "user") == [("Bob Ray",)]


def test_staged_load_runs_twice_without_new_facts(events, songs, spark, tmp_path, rows):
    root = str(tmp_path / "star")
    first, report = staged_load.load_songplay_star(events, songs, root)
    assert rows(first, "step", "inserted") == [
        ("d_artists", 2), ("d_songs", 3), ("d_time", 4), ("d_users", 2),
        ("f_songplays", 4), ("staging_events", 7), ("staging_songs", 3),
    ]
    assert {r.status for r in report.collect()} == {"OK"}
    second, _ = staged_load.load_songplay_star(events, songs, root)
    assert second.where("step = 'f_songplays'").first().asDict() == {
        "step": "f_songplays", "before": 4, "after": 4, "inserted": 0,
    }
    third, _ = staged_load.load_songplay_star(
        events, songs, root, staging_mode="append_only", dim_mode="append_only"
    )
    assert rows(third, "step", "before", "inserted") == [
        ("d_artists", 2, 0), ("d_songs", 3, 0), ("d_time", 4, 0), ("d_users", 2, 0),
        ("f_songplays", 4, 0), ("staging_events", 7, 7), ("staging_songs", 3, 3),
    ]
    for modes in ({"fact_mode": "merge"}, {"dim_mode": "append_new"}, {"staging_mode": ""}):
        with pytest.raises(ValueError):
            staged_load.load_songplay_star(events, songs, root, **modes)


COUNTRIES = [
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'",
    "   236 =  'AFGHANISTAN'",
    "   403 =  'INVALID: AMERICAN SAMOA'",
    "   999 =  'INVALID: UNKNOWN'",
    "   311 =  'Collapsed Tanzania (should not show)'",
    "    54 =  'No Country Code (54)'",
]
PORTS = [
    "   'ALC'\t=\t'ALCAN, AK             '",
    "   'BAR'\t=\t'BAKER AAF - BAKER ISLAND, AK'",
    "   'MAP'\t=\t'MARIPOSA AZ           '",
    "   'WLL'\t=\t'WILMINGTON, DE        '",
    "   'DVD'\t=\t'DOVER-AFB, DE         '",
    "   'PDN'\t=\t'PASO DEL NORTE,TX     '",
    "   'XXX'\t=\t'NOT REPORTED/UNKNOWN  ' ",
    "   '888'\t=\t'UNIDENTIFED AIR / SEAPORT'",
    "   'UNK'\t=\t'UNKNOWN POE           '",
    "   'IWA'\t=\t'INVALID - IWAKUNI, JAPAN'",
    "   'DUR'\t=\t'LOUIS BOTHA, SOUTH AFRICA'",
    "   'CHN'\t=\t'No PORT Code (CHN)'",
    "   'MAA'\t=\t'Abu Dhabi'",
    "   'FRG'\t=\t'Collapsed (FOK) 06/15'",
    "   'DLV'\t=\t'DERBY LINE, VT (RT. 5)'",
    "   'DER'\t=\t'DERBY LINE, VT (I-91) '",
    "   'GTF'\t=\t'Collapsed into INT, MN'",
    "/* no label */",
]
BAD = ("Invalid Airport Entry", "Invalid State Code")


def lines(spark, text):
    return spark.createDataFrame([(line,) for line in text], "value string")


def test_countries(spark, rows):
    assert rows(immigration.stage_countries(lines(spark, COUNTRIES))) == [
        (236, "AFGHANISTAN"),
        (582, "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"),
        (999, "INVALID: UNKNOWN"),
    ]


def test_airports(spark, rows):
    got = {code: (name, state) for code, name, state in rows(immigration.stage_airports(lines(spark, PORTS)))}
    assert got == {
        "ALC": ("ALCAN", "AK"),
        "BAR": ("BAKER AAF - BAKER ISLAND", "AK"),
        "MAP": ("MARIPOSA", "AZ"),
        "WLL": ("WILMINGTON", "DE"),
        "PDN": ("PASO DEL NORTE", "TX"),
        "IWA": ("IWAKUNI", "JAPAN"),
        "DUR": ("LOUIS BOTHA", "SOUTH AFRICA"),
        "MAA": ("Abu Dhabi", "Invalid State Code"),
        "DLV": ("DERBY LINE VT (RT. 5)", "VT"),
        "DER": ("DERBY LINE VT (RT. 5)", "VT"),
        "GTF": ("Collapsed into INT", "MN"),
        **{code: BAD for code in ("DVD", "XXX", "888", "UNK", "CHN", "FRG")},
    }


CITY = "fields struct<state_code string, median_age double, male_population long, female_population long, total_population long, foreign_born long>"


@pytest.fixture
def star(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            (2016.0, 1.0, 236.0, "ALC", 20454.0, 20460.0, "AL", "20160101", "M", 1.0),
            (2016.0, 1.0, 236.0, "ALC", 20454.0, 20460.0, "AL", "20160101", "M", 1.0),  # duplicate
            (2016.0, 1.0, 582.0, "ALC", 20455.0, 20454.0, "XX", "20160102", None, 1.0),  # leaves before arrival
            (2016.0, 2.0, 236.0, "QQQ", 20490.0, None, None, None, None, 1.0),
            (2016.0, 2.0, None, "ALC", 20491.0, 30000.0, "AL", "20160207", "M", 1.0),  # leaves too late
        ],
        "i94yr double, i94mon double, i94cit double, i94port string, arrdate double, depdate double, "
        "i94addr string, dtadfile string, matflag string, count double",
    )
    cities = spark.createDataFrame([(("AL", 30.04, 10, 11, 21, 3),), (("AL", 31.0, 13, 12, 26, 4),)], CITY)
    states = ["\t'AL'='ALABAMA'", "\t'DC'='DIST. OF COLUMBIA'", "\t'99'='ALL OTHER CODES'"]
    return immigration.immigration_catalog(
        spark, str(tmp_path / "immigration"), lambda: raw, lambda: lines(spark, COUNTRIES),
        lambda: lines(spark, PORTS), lambda: lines(spark, states), lambda: cities,
    )


def test_staged_arrivals(star, rows):
    staged = star.get("st_i94_immigrations")
    none = dt.date(1900, 1, 1)
    got = rows(staged, "st_i94_id", "st_i94_cit", "st_i94_addr", "st_i94_depdate_iso", "st_i94_port_state_code", "st_i94_matflag")
    assert got == [
        (1, 236, "AL", dt.date(2016, 1, 7), "AK", "M"),
        (2, 582, "XX", none, "AK", "NA"),
        (3, 0, "AL", none, "AK", "M"),
        (4, 236, "99", none, "NA", "NA"),
    ]
    assert staged.where("st_i94_id = 4").first().st_i94_dtadfile == dt.date(9999, 12, 31)


def test_state_profile_and_calendars(star, rows):
    assert rows(star.get("d_state_destinations"), "d_sd_id", "d_sd_state_name", "d_sd_age_median", "d_sd_population_male") == [
        ("99", "All Other Codes", 0.0, 0), ("AL", "Alabama", 30.5, 11), ("DC", "Dist. Of Columbia", 0.0, 0),
    ]
    assert star.get("d_date_arrivals").count() == 38
    assert rows(star.get("d_date_departures"), "d_dd_id") == [(dt.date(1900, 1, 1),), (dt.date(2016, 1, 7),)]


def test_fact_and_questions(star, tmp_path, rows, spark):
    fact = star.get("f_i94_immigrations")
    assert rows(fact, "f_i94_id", "d_sd_id") == [(1, "AL"), (2, "99"), (3, "AL"), (4, "99")]
    answer = star.answer(immigration.QUESTIONS["origin_countries"], str(tmp_path / "answer"))
    assert rows(answer, "country_id", "immigrants", "immigrants_rank") == [(236, 2, 1), (582, 1, 2)]
    assert spark.read.json(str(tmp_path / "answer")).count() == 2
    assert rows(star.answer(immigration.QUESTIONS["arrival_airports"]), "airport_code", "immigrants") == [("ALC", 3)]
    months = star.answer(immigration.QUESTIONS["arrival_months"])
    assert rows(months) == [("2016/01", 2, 1), ("2016/02", 2, 1)]
    states = star.answer(immigration.QUESTIONS["destination_states"])
    assert rows(states, "state_code", "immigrants", "travel_rank") == [("99", 2, 1), ("AL", 2, 1)]
    left = star.answer(immigration.QUESTIONS["departure_months"])
    assert rows(left) == [("2016/01", "1900/01", 1), ("2016/01", "2016/01", 1), ("2016/02", "1900/01", 2)]
    assert rows(star.answer(immigration.QUESTIONS["stay_lengths"])) == [(6, 1, 1)]


def test_all_answers_of_one_star(star, rows, plan):
    got = rows(star.answers(immigration.QUESTIONS))
    top = next(json.loads(row) for q, r, row in got if (q, r) == ("origin_countries", 1))
    assert list(top) == ["country_id", "country", "immigrants"] and (top["country_id"], top["immigrants"]) == (236, 2)
    assert ("departure_months", None, '{"year_month_arrival":"2016/02","year_month_departure":"1900/01","immigrants":2}') in got
    for name, question in immigration.QUESTIONS.items():
        assert sum(q == name for q, _, _ in got) == star.answer(question).count()


def test_answers_for_a_period_read_its_months_only(star, rows, plan):
    january = catalog.Period(
        "d_date_arrivals", {"f_i94_year": "d_da_year", "f_i94_month": "d_da_month"}, lambda: F.col("d_da_month") == 1
    )
    question = immigration.QUESTIONS["arrival_months"]
    assert rows(star.answer(question, period=january)) == [("2016/01", 2, 1)]
    tables = star.build(*question.tables)
    picked = within(tables[question.fact], tables["d_date_arrivals"].where("d_da_month = 1"), january.columns)
    assert "dynamicpruning" in plan(picked)
    assert {q for q, _, _ in rows(star.answers({"months": question}, january))} == {"months"}


def test_catalog_builds_once_and_reuses_stored_tables(spark, tmp_path):
    built = []

    def builder(name, df):
        def build(_):
            built.append(name)
            return df
        return build

    root = str(tmp_path / "c")
    first = catalog.Catalog(spark, root).add("a", builder("a", spark.range(3)))
    first.add("b", lambda c: c.get("a").where("id > 0"))
    assert not first.is_stored("b") and first.get("b").count() == 2 and first.get("b").count() == 2
    assert built == ["a"] and first.is_stored("a") and first.names() == ["a", "b"]
    second = catalog.Catalog(spark, root).add("a", builder("a again", spark.range(9)))
    assert second.get("a").count() == 3 and built == ["a"]
    with pytest.raises(KeyError):
        second.get("missing")
    # A folder without the success marker is a failed write: it is built again.
    (tmp_path / "c" / "a" / "_SUCCESS").unlink()
    third = catalog.Catalog(spark, root).add("a", builder("a rebuilt", spark.range(5)))
    assert third.get("a").count() == 5


def test_data_dictionary(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    texts = ({"t": "a table"}, {("t", "id"): "key"})
    assert rows(dictionary.data_dictionary({"t": df}, *texts), "position", "column_description") == [(1, "key"), (2, "not set")]
    got = dictionary.data_dictionary({"t": df}, *texts, with_entries=True)
    assert rows(got) == [
        ("t", "a table", 1, "id", "key", "int", True, 2, 2),
        ("t", "a table", 2, "v", "not set", "string", True, 2, 1),
    ]
    assert rows(dictionary.export_dictionary(got, str(tmp_path / "dictionary"))) == rows(got)
