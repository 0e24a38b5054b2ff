import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.names import split_person_name
from matchday.functions.timez import to_local
from matchday.operators.worklist import expand_template, landing_name, parse_landing_name, season_label
from matchday.sources.html import extract_list_items, extract_list_items_parsed
from matchday.sources.json_api import (
    read_calendar_files,
    read_fixture_files,
    read_stat_files,
    unpack_envelope,
    unpack_stat_envelope,
)
from matchday.sources.landing import read_round_csvs


def test_round_csvs_mixed_headers(spark, tmpdir_path):
    cols = "team,name,surname,role,voto,gol,assist,rigore,rig_sbagliato,autogol,ammonizione,espulsione,fantavoto"
    with open(os.path.join(tmpdir_path, "a2019_m5.csv"), "w") as f:
        f.write(cols + "\n")
        f.write("Inter,Ann,Bee,D,6.5,1,0,0,0,0,0,0,9.5\n")
    with open(os.path.join(tmpdir_path, "a2019_m12.csv"), "w") as f:
        f.write("," + cols + "\n")
        f.write("0,Milan,,Cee,A,-,0,0,0,0,0,1,0,\n")
    out = {r["match"]: r for r in read_round_csvs(spark, tmpdir_path).collect()}
    assert (out[5]["season"], out[12]["season"]) == (2019, 2019)
    assert out[5]["team"] == "Inter" and out[5]["voto"] == 6.5 and out[5]["fantavoto"] == 9.5
    # the leading index column does not shift values; '-' -> NULL; empty name -> _unknown_
    assert out[12]["team"] == "Milan" and out[12]["name"] == "_unknown_" and out[12]["voto"] is None
    assert out[12]["ammonizione"] == 1.0


def test_round_csvs_of_many_fields_and_quotes(spark, tmpdir_path):
    cols = "team,name,surname,role,voto,gol,assist,rigore,rig_sbagliato,autogol,ammonizione,espulsione,fantavoto"
    with open(os.path.join(tmpdir_path, "a2020_m1.csv"), "w") as f:
        f.write(",".join(f"x{i}" for i in range(40)) + "," + cols + "\r\n")
        f.write(",".join(["1"] * 39) + ',"a, b",Inter,"Ann ""A""","Bee, C",D,6.5,1,0,0,0,0,0,0,9.5\r\n')
    row = read_round_csvs(spark, tmpdir_path).first()
    assert (row["team"], row["name"], row["surname"], row["voto"], row["fantavoto"]) == ("Inter", 'Ann "A"', "Bee, C", 6.5, 9.5)


def test_all_lists_of_a_page_are_read(spark):
    html = "".join(f'<ul><li><a href="/{i}">Ann Bee {i}</a></li></ul>' for i in range(30))
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    for extract in (extract_list_items, extract_list_items_parsed):
        assert extract(pages).count() == 30
        assert extract(pages, max_lists=20).count() == 20


def test_fixture_json_flatten(spark, tmpdir_path):
    recs = [
        {"fixture_id": 1, "league_id": 891, "event_timestamp": 1593604800, "status": "Match Finished",
         "statusShort": "FT", "homeTeam": {"team_id": 5, "team_name": "A"},
         "awayTeam": {"team_id": 6, "team_name": "B"}, "score": {"halftime": None},
         "goalsHomeTeam": 2, "goalsAwayTeam": 1},
        {"fixture_id": 2, "league_id": 891, "event_timestamp": 1593604800, "status": "Not Started",
         "statusShort": "NS", "homeTeam": {"team_id": 6, "team_name": "B"},
         "awayTeam": {"team_id": 5, "team_name": "A"}, "score": {"halftime": None},
         "goalsHomeTeam": None, "goalsAwayTeam": None},
    ]
    with open(os.path.join(tmpdir_path, "leagueid-891_teamid-5_.json"), "w") as f:
        json.dump(recs, f)
    rows = read_fixture_files(spark, tmpdir_path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["home_ht_goal"], r["away_ht_goal"], r["home_ft_goal"]) == (0, 0, 2)
    local = spark.createDataFrame([r]).select(to_local(F.col("event_date")).alias("l")).first()["l"]
    assert local.hour == 13  # 2020-07-01 12:00 UTC is 13:00 in London


def test_calendar_and_stats_files(spark, tmpdir_path):
    cal = os.path.join(tmpdir_path, "cal")
    os.makedirs(cal)
    with open(os.path.join(cal, "leagueid-891_round-7_.json"), "w") as f:
        json.dump([{"fixture_id": 1, "league_id": 891, "event_date": "2020-07-01T12:00:00+00:00",
                    "status": "Match Finished", "statusShort": "FT", "venue": "x"}], f)
    r = read_calendar_files(spark, cal).first()
    assert r["match"] == 7 and r["fixture_id"] == 1
    st = os.path.join(tmpdir_path, "stats")
    os.makedirs(st)
    with open(os.path.join(st, "fixtureid-1_.json"), "w") as f:
        json.dump({"fixture_stat": {"0": "Shots on Goal", "1": "Ball Possession"},
                   "home": {"0": "3", "1": "55%"}, "away": {"0": "2", "1": "45%"}}, f)
    with open(os.path.join(st, "fixtureid-2_.json"), "w") as f:
        json.dump({"fixture_stat": {"0": "Fouls"}, "home": {"0": "1"}, "away": {"0": "9"}}, f)
    master = spark.createDataFrame([(1,)], "fixture_id long")
    got = sorted(tuple(r) for r in read_stat_files(spark, st, master).collect())
    assert got == [(1, "Ball Possession", "55%", "45%"), (1, "Shots on Goal", "3", "2")]


def test_envelopes(spark):
    env = [('{"api": {"results": 2, "teams": [{"name": "A", "id": 1}, {"name": "B", "id": 2}]}}',),
           ('{"api": {"results": 0, "teams": []}}',)]
    df = spark.createDataFrame(env, "p string")
    item = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())])
    assert unpack_envelope(df, "p", "teams", item).count() == 2
    assert [r["id"] for r in unpack_envelope(df, "p", "teams", item, target_field="name", target="B").collect()] == [2]
    st = spark.createDataFrame(
        [('{"api": {"results": 1, "statistics": {"Fouls": {"home": "7", "away": "9"}}}}',)], "p string")
    assert [tuple(r) for r in unpack_stat_envelope(st, "p").collect()] == [("Fouls", "7", "9")]


def test_html_paths_agree_and_names(spark):
    html = ('<html><ul><li><a href="/p/1">Leo Messi</a></li><li><a href="/p/2">Zico</a></li></ul>'
            '<ul><li><a href="/p/3">Juan Pablo Sorin</a></li><li><a href="/p/4">-</a></li>'
            '<li><a href="/p/5">6.5</a></li></ul></html>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    a = sorted(tuple(r) for r in extract_list_items(pages).collect())
    b = sorted(tuple(r) for r in extract_list_items_parsed(pages).collect())
    assert a == b and len(a) == 5
    names = {r[4]: (r[5], r[6], r[7]) for r in a}
    assert names["Leo Messi"] == ("Leo", "Messi", None)
    assert names["Zico"] == ("", "Zico", None)
    assert names["Juan Pablo Sorin"] == ("Juan", "Pablo Sorin", None)
    assert names["-"][2] is None and names["6.5"][2] == 6.5


def test_worklist_names_and_templates(spark):
    df = spark.createDataFrame([(891, 7, 2019)], "league_id long, round_no int, season int")
    r = df.select(
        landing_name([("leagueid", F.col("league_id")), ("round", F.col("round_no"))]).alias("f"),
        expand_template("https://h/x/%%league_id%%/r/%%round%%", {"league_id": F.col("league_id"), "round": F.col("round_no")}).alias("u"),
        season_label(F.col("season")).alias("s"),
    ).first()
    assert r["f"] == "leagueid-891_round-7_.json" and r["u"] == "https://h/x/891/r/7" and r["s"] == "2019-20"
    m = df.select(parse_landing_name(F.lit("leagueid-891_round-7_.json")).alias("m")).first()["m"]
    assert m == {"leagueid": "891", "round": "7"}
    n, s = split_person_name(F.lit("A B C"))
    assert df.select(n.alias("n"), s.alias("s")).first() == ("A", "B C")


def test_sinks_and_empty_master(spark, tmpdir_path):
    from matchday.sources.landing import read_or_empty
    from matchday.sources.sinks import write_if_enough, write_table

    schema = T.StructType([T.StructField("season", T.IntegerType()), T.StructField("match", T.IntegerType()),
                           T.StructField("v", T.DoubleType())])
    empty = read_or_empty(spark, os.path.join(tmpdir_path, "missing"), schema)
    assert empty.count() == 0 and empty.schema == schema
    df = spark.createDataFrame([(2020, 1, 1.0), (2020, 1, 2.0), (2020, 2, 3.0)], schema)
    kept = write_if_enough(df, os.path.join(tmpdir_path, "marks"), ["season", "match"], min_rows=2)
    back = spark.read.parquet(os.path.join(tmpdir_path, "marks"))
    assert back.count() == 2 and kept.count() == 2
    assert {r["match"] for r in back.collect()} == {1}
    write_table(df, os.path.join(tmpdir_path, "all"), ["season"])
    assert spark.read.parquet(os.path.join(tmpdir_path, "all")).filter("season = 2020").count() == 3


def test_marks_page_layout(spark):
    from matchday.sources.html import extract_marks

    def item(link, role, cells):
        body = "".join(f'<div class="inParameter {k}">\n\t{c} </div>' for k, c in zip("abcdefghi", cells))
        return f'<li><span class="playerNameIn"><a href="{link}">x</a></span><span class="playerRole">{role}</span>{body}</li>'

    cells = ["6.5", "1", "0", "-", "0", "0", "1", "0", "9.5"]
    lists = '<ul class="menu"><li>no</li></ul><ul class="magicTeamList"><span class="teamNameIn">Inter</span><li>head</li>'
    lists += item("https://www.gazzetta.it/calcio/giocatori/duvan-zapata/928", "A", cells)
    lists += item("https://www.gazzetta.it/calcio/fantanews/statistiche/serie-a-2018-19/juan_de_la_cruz_77", "D", cells)
    lists += item("https://www.gazzetta.it/calcio/giocatori/ronaldo/1", "P", ["-"] * 9) + "</ul>"
    pages = spark.createDataFrame([(1, lists), (2, None), (3, "")], "page_id long, html string")
    rows = {r["surname"]: r for r in extract_marks(pages).collect()}
    assert set(rows) == {"zapata", "de la cruz", "ronaldo"}
    assert (rows["zapata"]["name"], rows["zapata"]["team"], rows["zapata"]["role"]) == ("duvan", "Inter", "A")
    assert (rows["zapata"]["voto"], rows["zapata"]["rigore"], rows["zapata"]["fantavoto"]) == (6.5, None, 9.5)
    assert rows["de la cruz"]["name"] == "juan" and rows["ronaldo"]["name"] == "" and rows["ronaldo"]["voto"] is None
