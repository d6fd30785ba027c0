"""Boundary cases of each operator."""

import datetime as dt
import http.server
import json
import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from playlog import catalog, model
from playlog.functions import calendar, exactmath, text
from playlog.operators import commit, distinct, merge, order, sessions
from playlog.plans import analytics, increments, normalize, pipeline
from playlog.sources import export, files, jdbc, paged, sqlscript
from playlog.streaming import ingest
from playlog.streaming import sessions as session_stream

T0 = dt.datetime(2024, 2, 4, 10, 0, 0)
AS_OF = dt.date(2024, 7, 1)


def events(spark, rows):
    """rows: (seconds after T0, artist, track, album, ms)"""
    data = [(T0 + dt.timedelta(microseconds=round(s * 1e6)), a, t, al, ms, f"id-{t}", f"x:track:id-{t}") for s, a, t, al, ms in rows]
    return spark.createDataFrame(data, "played_at timestamp_ntz, artist_name string, track_name string, album_name string, ms_played long, track_id string, track_uri string")


def starts(spark, seconds):
    df = events(spark, [(s, "a", "t", "al", 1000) for s in seconds])
    naive = sorted(r[0] for r in sessions.number_naive(df).select("session_id").collect())
    two = sorted(r[0] for r in sessions.number_global(df).select("session_id").collect())
    assert naive == two
    return two


def test_gap_of_exactly_thirty_minutes_parts(spark):
    assert starts(spark, [0, 1800]) == [1, 2]


def test_gap_a_microsecond_less_joins(spark):
    assert starts(spark, [0, 1799.999999]) == [1, 1]


def test_ties_share_a_session(spark):
    assert starts(spark, [0, 5000, 5000, 5000]) == [1, 2, 2, 2]


def test_sessions_cross_buckets_and_empty_ones(spark):
    assert starts(spark, [0, 3599, 3601, 4 * 3600, 4 * 3600 + 1799]) == [1, 2, 2, 3, 3]


def test_no_plays_no_sessions(spark):
    assert analytics.listening_sessions(events(spark, [])).count() == 0


def test_session_summary(spark):
    row = analytics.listening_sessions(events(spark, [(0, "a", "t", None, 60_300), (61, "b", "t", "x", 0)])).first()
    assert (row.session_length_minutes, row.streams, row.artists, row.albums, row.music_minutes) == (1, 2, 2, 1, 1.01)


def test_sessions_by_key(spark):
    df = sessions.number_by_key(events(spark, [(0, "a", "t", "x", 1), (10, "b", "t", "x", 1), (1801, "a", "t", "x", 1)]), "artist_name")
    assert sorted((r.artist_name, r.session_id) for r in df.collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_rounding_tie_goes_up(spark):
    df = spark.range(1).select(exactmath.minutes(F.lit(60_300)).alias("a"), exactmath.half_up(F.lit(60_300), F.lit(60_000)).alias("b"), exactmath.ratio(F.lit(5), F.lit(0)).alias("c"))
    assert tuple(df.first()) == (1.01, 1.01, None)


def test_one_play_has_no_daily_rate(spark):
    df = events(spark, [(0, "a", "t", None, 1)])
    assert analytics.loyalty(df).first().avg_streams_per_day is None
    row = analytics.repeats(df).first()
    assert row.avg_streams_per_day is None and row.album_name is None and row.avg_streams_per_active_day == 1.0


def test_null_album_is_a_group_but_not_counted(spark):
    df = events(spark, [(0, "a", "t", None, 1), (1, "a", "t", "x", 1)])
    assert analytics.loyalty(df).first().unique_albums == 1
    assert analytics.repeats(df).count() == 2


@pytest.mark.parametrize(("n", "days", "kept"), [(25, 90, 1), (24, 90, 0), (25, 89, 0)])
def test_forgotten_bounds(spark, n, days, kept):
    df = events(spark, [(0, "a", "t", "x", 1)] * n)
    assert analytics.forgotten(df, (T0 + dt.timedelta(days=days)).date()).count() == kept


def test_invariants(spark):
    df = events(spark, [(k * 700, f"a{k % 3}", f"t{k % 5}", "x", k) for k in range(60)])
    assert analytics.discovery(df).agg(F.sum("lifetime_streams")).first()[0] == 60
    assert analytics.listening_sessions(df).agg(F.sum("streams")).first()[0] == 60
    assert analytics.forgotten(df, dt.date(2030, 1, 1), 1).count() == analytics.loyalty(df).count() == 3


def test_calendar(spark):
    times = [dt.datetime(2021, 1, 1, 0), dt.datetime(2024, 2, 4, 13), dt.datetime(2024, 2, 4, 12), dt.datetime(2024, 2, 4, 23), dt.datetime(2024, 2, 4, 1)]
    rows = calendar.with_calendar(spark.createDataFrame([(t,) for t in times], "played_at timestamp_ntz")).collect()
    assert [r.hour_label for r in rows] == ["12 AM", "1 PM", "12 PM", "11 PM", "1 AM"]
    assert (rows[0].week, rows[0].year, rows[0].month_name, rows[1].weekday_number, rows[1].weekday_name) == (53, 2021, "January", 7, "Sunday")


def test_seconds_round_before_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 59, 600000),), (dt.datetime(2024, 1, 1, 20, 55, 13, 750000),)], "t timestamp_ntz").select(calendar.to_second("t").alias("played_at"))
    rows = calendar.with_calendar(df).collect()
    assert (rows[0].played_at, rows[0].date) == (dt.datetime(2024, 2, 1), dt.date(2024, 2, 1))
    assert rows[1].time == "20:55:14"


def test_widen_date(spark):
    df = spark.createDataFrame([("1999",), ("1999-05",), ("1999-05-07",), ("soon",), (None,)], "s string").select(calendar.widen_date("s"))
    assert [r[0] for r in df.collect()] == [dt.date(1999, 1, 1), dt.date(1999, 5, 1), dt.date(1999, 5, 7), None, None]


def test_text(spark):
    df = spark.createDataFrame([("svc:track:0012", [{"name": "A"}, {"name": None}, {"name": "B, C"}])], "u string, artists array<struct<name:string>>")
    assert tuple(df.select(text.track_id("u"), text.join_names("artists"), text.strip_zeros(text.track_id("u"))).first()) == ("0012", "A, B, C", "12")


def test_insert_ignore_twice(spark):
    spark.sql("DROP TABLE IF EXISTS t_ignore")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert merge.insert_ignore(first, "t_ignore", ["k"], ["v"]) == 2
    assert merge.insert_ignore(spark.createDataFrame([("z", 1), ("n", 3)], "v string, k int"), "t_ignore", ["k"], ["v"]) == 1
    assert merge.insert_ignore(first, "t_ignore", ["k"], ["v"]) == 0
    assert sorted(map(tuple, spark.table("t_ignore").collect())) == [(1, "a"), (2, "c"), (3, "n")]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, None)], "k int, v string")
    assert sorted(map(repr, map(tuple, merge.dedup_first(df, ["k"], ["v"]).collect()))) == ["(1, None)", "(None, 'a')"]
    assert merge.anti_join(df, df, ["k"]).count() == 0


def test_snapshot_replaces_its_own_source(spark):
    spark.sql("DROP TABLE IF EXISTS t_snap")
    merge.replace_table(spark.range(5), "t_snap")
    merge.replace_table(spark.table("t_snap").filter("id > 2"), "t_snap")
    assert spark.table("t_snap").count() == 2


def test_watermark_is_strict(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert merge.watermark(df, "x") == 3 and merge.watermark(df.filter("x > 9"), "x") is None
    assert merge.newer_than(df, "x", 2).count() == 1 and merge.newer_than(df, "x", None).count() == 3
    times = spark.createDataFrame([(T0,), (T0 + dt.timedelta(microseconds=1),)], "t timestamp_ntz")
    newer = merge.newer_than(times, "t", T0)
    assert newer.count() == 1 and "cast(t#" not in newer._jdf.queryExecution().optimizedPlan().toString()


def test_update_flag(spark):
    spark.sql("DROP TABLE IF EXISTS t_flag")
    spark.createDataFrame([("a", False), ("b", True), ("c", False), (None, None)], "id string, liked boolean").write.saveAsTable("t_flag")
    merge.update_flag("t_flag", spark.createDataFrame([("a",), ("a",), (None,)], "m string"), "id", "m", "liked")
    assert {r.id: r.liked for r in spark.table("t_flag").collect()} == {"a": True, "b": True, "c": False, None: False}


def _export_row(ts, uri, **more):
    return {"ts": ts, "ms_played": 1000, "master_metadata_track_name": "T", "master_metadata_album_artist_name": "A", "master_metadata_album_album_name": "B", "svc_track_uri": uri, "shuffle": True, "skipped": None} | more


def test_export_history(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([_export_row("2024-01-01T00:00:00Z", "svc:track:1", ms_played=9), _export_row("2024-01-01T00:00:01Z", None)]))
    (tmp_path / "a.json").write_text(json.dumps([_export_row("2024-01-01T00:00:00Z", "svc:track:1", ms_played=5), _export_row("2024-01-01T00:00:00.600Z", "svc:track:2")]))
    df = normalize.from_export(files.read_export(spark, str(tmp_path), "svc"))
    assert df.columns == model.names(model.EVENT)
    rows = {r.track_id: r for r in df.collect()}
    assert rows.keys() == {"1", "2"} and rows["1"].ms_played == 5 and rows["2"].time == "00:00:01" and rows["1"].source == "export"
    assert normalize.valid(df).count() == 2 and normalize.rejected(df).count() == 0


def test_no_export_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_export(spark, str(tmp_path), "svc")


def _item(key, at, k, **album):
    return {key: at, "track": {"id": f"i{k}", "uri": f"svc:track:i{k}", "name": f"N{k}", "duration_ms": 1000 * k, "artists": [{"name": "A"}, {"name": "B"}], "album": {"name": "L", "release_date": "1999"} | album}}


def _pages(folder, key, pages):
    folder.mkdir()
    for n, items in enumerate(pages):
        (folder / f"page-{n}.json").write_text(json.dumps({"items": items, "next": "more" if n + 1 < len(pages) else None}))
    return str(folder)


def test_paged_source_and_whole_run(spark, tmp_path):
    for t in (pipeline.EVENTS, pipeline.LIKED, pipeline.RECENT, pipeline.RUN_LOG, *pipeline.ANALYTICS):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    liked = _pages(tmp_path / "liked", "added_at", [[_item("added_at", f"2024-03-0{9 - k}T00:00:00Z", k) for k in range(1, 4)], [_item("added_at", "2024-03-01T00:00:00Z", 4)]])
    recent = _pages(tmp_path / "recent", "played_at", [[_item("played_at", "2024-03-10T10:00:00.250Z", 1), _item("played_at", "2024-03-10T09:00:00Z", 7)], [_item("played_at", "2020-01-01T00:00:00Z", 8)]])
    read = lambda mark: paged.read_items(spark, model.RAW_LIKED, mark, path=liked)
    plays = lambda: paged.read_items(spark, model.RAW_RECENT, path=recent, single="true")
    assert read(dt.datetime(2024, 3, 7)).count() == 1
    one = pipeline.run(spark, read, plays, f"file://{tmp_path}/out")
    assert (one.liked_downloaded, one.liked_inserted, one.recent_downloaded, one.recent_inserted) == (4, 4, 2, 2)
    two = pipeline.run(spark, read, plays)
    assert (two.liked_inserted, two.recent_downloaded, two.recent_inserted) == (0, 2, 0)
    assert {r.track_id: r.is_liked for r in spark.table(pipeline.EVENTS).collect()} == {"i1": True, "i7": False}
    assert spark.table("listening_session_summary").count() == 2
    raw = (tmp_path / "out" / f"{pipeline.EVENTS}.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfplayed_at,") and raw.count(b"\n") == 3
    with pytest.raises(ValueError):
        pipeline.run(spark, lambda m: (_ for _ in ()).throw(ValueError("no service")), plays)
    log = spark.table(pipeline.RUN_LOG).orderBy("run_id").collect()
    assert [(r.run_id, r.status) for r in log] == [(1, "Success"), (2, "Success"), (3, "Failed")] and log[2].error_message == "no service"


def test_empty_recent_page(spark, tmp_path):
    folder = _pages(tmp_path / "none", "played_at", [[]])
    df = normalize.from_recent(normalize.flatten_recent(paged.read_items(spark, model.RAW_RECENT, path=folder)))
    assert df.count() == 0 and df.columns == model.names(model.EVENT)


def test_migration(spark):
    legacy = spark.createDataFrame([(T0, 5, True, False, "T", "A", "B", "1")], model.LEGACY_EXPORT)
    api = spark.createDataFrame([(T0, "1", "svc:track:1", "T", "A", "B", 9), (T0, "2", "svc:track:2", "U", "A", "B", 9)], model.RECENT)
    liked = spark.createDataFrame([("1",)], "track_id string")
    rows = {r.track_id: r for r in normalize.migrate(legacy, api, liked, "svc").collect()}
    assert (rows["1"].source, rows["1"].ms_played, rows["1"].is_liked, rows["2"].source, rows["2"].is_liked) == ("export", 5000, True, "api", False)


def test_rebuild_refuses_unknown_names(spark):
    with pytest.raises(KeyError):
        pipeline.rebuild(spark, only=["nothing"])


def test_script(spark):
    script = "-- a; b\nCREATE OR REPLACE TEMP VIEW v AS SELECT 'x;''y' AS a; /* ; */ # c;\nSELECT a, `b;c` FROM (SELECT a, 1 AS `b;c` FROM v);;"
    assert len(sqlscript.split_statements(script)) == 2
    assert sqlscript.run_script(spark, script)[-1].first()["b;c"] == 1
    with pytest.raises(Exception):
        sqlscript.run_script(spark, "SELECT nothing FROM nowhere; SELECT 1")


def test_csv_export_and_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, True, 'a,"b"', None), (2, False, "ü", T0)], "k int, f boolean, s string, t timestamp_ntz")
    export.export_csv(df.orderBy("k"), f"{tmp_path}/x.csv")
    assert (tmp_path / "x.csv").read_bytes().decode("utf-8-sig").splitlines()[:2] == ["k,f,s,t", '1,1,"a,""b""",']
    back = files.read_csv(spark, f"{tmp_path}/x.csv", "k int, f int, s string, t timestamp_ntz").collect()
    assert back[0].s == 'a,"b"' and back[1].t == T0
    files.write_csv(df, f"{tmp_path}/raw")
    assert files.read_csv(spark, f"{tmp_path}/raw", df.schema).count() == 2


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_stream")
    source = tmp_path / "in"
    source.mkdir()
    rows = [_item("played_at", "2024-03-10T10:00:00Z", 1), _item("played_at", "2024-03-10T10:01:00Z", 2)]
    (source / "1.json").write_text("\n".join(map(json.dumps, rows)))
    for n in range(2):
        q = ingest.ingest_recent(ingest.stream_files(spark, str(source), model.RAW_RECENT), "t_stream", str(tmp_path / "check"))
        q.awaitTermination(60)
        (source / "2.json").write_text("\n".join(map(json.dumps, [rows[1], _item("played_at", "2024-03-10T10:02:00Z", 3)])))
    assert sorted(r.track_id for r in spark.table("t_stream").collect()) == ["i1", "i2", "i3"]


def test_streaming_sessions(spark, tmp_path):
    events(spark, [(0, "a", "t", "x", 1), (1800, "a", "t", "x", 1), (3599.9, "a", "t", "x", 1), (400_000, "b", "t", "x", 1)]).write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, "parquet")
    q = ingest.session_windows(stream, "artist_name").writeStream.format("memory").queryName("sess").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(90)
    assert sorted(r.streams for r in spark.table("sess").filter("artist_name = 'a'").collect()) == [1, 2]


def test_nan(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, s string")
    assert [r.v for r in files.without_nan(df).collect()] == [None, 1.0]


def test_folded_case(spark):
    df = events(spark, [(0, "Caf\u00e9", "t", "x", 1), (1, "CAFE", "t", "x", 1)])
    assert analytics.loyalty(df).count() == 2
    assert analytics.loyalty(text.fold_case(df, "artist_name")).count() == 1


def test_csv_times_with_and_without_fraction(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes(b'played_at,track_id,track_uri,track_name,artist_name,album_name,duration_ms\r\n2026-07-07 20:57:13,1,u,"a, b",A,L,5\r\n2026-07-07 20:55:13.750000,2,u,t,A,L,5\r\n')
    rows = files.read_csv(spark, f"{tmp_path}/r.csv", model.RECENT)
    assert [r.time for r in normalize.from_recent(rows).orderBy("track_id").collect()] == ["20:57:13", "20:55:14"]
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00.5Z",), ("later",), (None,)], "s string").select(calendar.parse_zulu("s"))
    assert [r[0] for r in df.collect()] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 500000), None, None]


def test_database_and_append(spark):
    merge.ensure_database(spark, "history")
    spark.sql("DROP TABLE IF EXISTS history.t")
    assert merge.append(spark.range(3), "history.t") == 3
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 3
    spark.sql("USE default")


class _Service(http.server.BaseHTTPRequestHandler):
    """Two pages behind a token that lasts for one page; the first answer to each page is that the service is busy."""

    seen: list[str] = []

    def _say(self, code, body=None, **headers):
        self.send_response(code)
        for k, v in headers.items():
            self.send_header(k.replace("_", "-"), v)
        self.end_headers()
        if body is not None:
            self.wfile.write(json.dumps(body).encode())

    def do_POST(self):
        form = self.rfile.read(int(self.headers["Content-Length"])).decode()
        assert "refresh_token=r" in form and "client_secret=s" in form
        self.seen.append("token")
        self._say(200, {"access_token": f"t{self.seen.count('token')}"})

    def do_GET(self):
        page = 2 if self.path.startswith("/two") else 1
        self.seen.append(f"{page}")
        if self.seen.count(f"{page}") == 1:
            self._say(*((429,) if page == 1 else (503,)), Retry_After="0")
        elif self.headers["Authorization"] != f"Bearer t{page}":
            self._say(401)
        else:
            self._say(200, {"items": [_item("played_at", f"2024-03-10T10:00:0{page}Z", page)], "next": f"http://127.0.0.1:{self.server.server_port}/two" if page == 1 else None})

    def log_message(self, *_):
        pass


def test_client_waits_and_renews_its_token(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    options = dict(url=f"{base}/one", token_url=f"{base}/token", refresh_token="r", client_id="c", client_secret="s", wait="0")
    try:
        assert sorted(r.track.id for r in paged.read_items(spark, model.RAW_RECENT, **options).collect()) == ["i1", "i2"]
        with pytest.raises(Exception, match="settings not found"):
            paged.read_items(spark, model.RAW_RECENT, **(options | {"client_secret": ""})).collect()
        with pytest.raises(Exception, match="503|429|401"):
            _Service.seen.clear()
            paged.read_items(spark, model.RAW_RECENT, url=f"{base}/one", token="old", retries="0").collect()
    finally:
        server.shutdown()


def test_a_lost_page_raises(spark, tmp_path):
    folder = _pages(tmp_path / "gap", "played_at", [[_item("played_at", "2024-03-10T10:00:00Z", 1)], []])
    (tmp_path / "gap" / "page-1.json").unlink()
    with pytest.raises(Exception):
        paged.read_items(spark, model.RAW_RECENT, path=folder).collect()
    assert paged.read_items(spark, model.RAW_RECENT, path=f"file://{folder}", single="true").count() == 1


def test_unreadable_rows_raise_or_go_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([_export_row("2024-01-01T00:00:00Z", "svc:track:1")]))
    (tmp_path / "b.json").write_text(json.dumps([_export_row("2024-01-02T00:00:00Z", "svc:track:2")])[:-20])
    with pytest.raises(Exception):
        normalize.from_export(files.read_export(spark, str(tmp_path), "svc")).collect()
    good, bad = files.split_corrupt(files.read_export(spark, str(tmp_path), "svc", corrupt="bad"), "bad")
    assert [r.track_id for r in normalize.from_export(good).collect()] == ["1"] and [r.file.rpartition("/")[2] for r in bad.collect()] == ["b.json"]
    (tmp_path / "x.csv").write_text("k,s\n1,a\n12x,b\n")
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_path}/x.csv", "k int, s string").collect()
    good, bad = files.split_corrupt(files.read_csv(spark, f"{tmp_path}/x.csv", "k int, s string", "bad"), "bad")
    assert [tuple(r) for r in good.collect()] == [(1, "a")] and [r.text for r in bad.collect()] == ["12x,b"]
    with pytest.raises(KeyError, match="URL"):
        files.settings(["URL", "USER"], {"USER": "me", "URL": ""})
    with pytest.raises(ValueError, match="name the uri field"):
        normalize.from_export(spark.createDataFrame([("1", "2")], "a_track_uri string, b_track_uri string"))


def test_nothing_is_taken_by_its_name(spark):
    """Tables whose names look like something of the library's stay, whatever is done beside them."""
    for t in ("t_half", "t_half__old_1", "t_half__new_1", "t_half__old_2023_archive"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    for t in ("t_half__old_1", "t_half__new_1", "t_half__old_2023_archive"):
        spark.range(9).write.saveAsTable(t)
    assert not merge.recover_table(spark, "t_half")
    for n in range(4):
        merge.replace_table(spark.range(n), "t_half")
        assert merge.recover_table(spark, "t_half") and spark.table("t_half").count() == n
    assert all(spark.table(t).count() == 9 for t in ("t_half__old_1", "t_half__new_1", "t_half__old_2023_archive"))


class _Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_take", "settle", "_point", "_publish", "vacuum"])
@pytest.mark.parametrize("kind", ["replace", "append"])
def test_a_crash_at_any_step_leaves_all_or_nothing(spark, monkeypatch, kind, step):
    spark.sql("DROP TABLE IF EXISTS t_crash")
    merge.replace_table(spark.range(3), "t_crash")
    merge.append(spark.range(3, 5), "t_crash")
    log = commit.TableLog(spark, "t_crash")
    seen, here = log.settle(), getattr(commit.TableLog, step)
    calls = []

    def crash(self, *args):
        calls.append(step)
        if step == "settle" and len(calls) == 1:  # the first one is the writer's look at the log
            return here(self, *args)
        if step == "_publish":  # after the first file
            names = [n for n in self._list(args[0]) if n.startswith("part-")]
            if not names:  # done before
                return None
            self.fs.rename(self._Path(f"{args[0]}/{names[0]}"), self._Path(f"{self.location()}/{names[0]}"))
        if step == "_point" and args[0]["at"] == self.location():
            return None
        raise _Crash

    monkeypatch.setattr(commit.TableLog, step, crash)
    more = spark.range(10, 16).repartition(3)
    change = (lambda: merge.replace_table(more, "t_crash")) if kind == "replace" else (lambda: merge.append(more, "t_crash"))
    if (kind, step) in (("replace", "_publish"), ("append", "_point")):
        change()
    else:
        with pytest.raises(_Crash):
            change()
    monkeypatch.undo()
    assert merge.recover_table(spark, "t_crash")
    old, new = list(range(5)), list(range(10, 16))
    ids = sorted(r.id for r in spark.table("t_crash").collect())
    assert ids == (old if step == "_take" else new if kind == "replace" else old + new)
    assert log.settle() == seen + (step != "_take")
    merge.append(spark.range(20, 21), "t_crash")
    assert sorted(r.id for r in spark.table("t_crash").collect()) == [*ids, 20]


def test_writers_at_once(spark):
    """Of replacements that saw the same rows one is carried out and the others say so; of loads every key is inserted once; and runs get numbers of their own."""
    from concurrent.futures import ThreadPoolExecutor

    for t in ("t_once", "t_keys", "t_runs"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    merge.replace_table(spark.range(2), "t_once")
    merge.append(spark.createDataFrame([], "run_id long, who int"), "t_runs")
    seen = commit.TableLog(spark, "t_once").settle()

    def replace(n):
        try:
            merge.replace_table(spark.range(n), "t_once", seen)
            return n
        except commit.ConcurrentChange:
            return None

    batch = lambda n: spark.range(n * 5, n * 5 + 10).selectExpr("id AS k", f"{n} AS v")
    with ThreadPoolExecutor(4) as pool:
        done = [n for n in pool.map(replace, (5, 6, 7)) if n]
        inserted = list(pool.map(lambda n: merge.insert_ignore(batch(n), "t_keys", ["k"], ["v"]), range(4)))
        numbers = list(pool.map(lambda n: merge.append_numbered("t_runs", spark.table("t_runs").schema, "run_id", lambda k: (k, n), spark), range(4)))
    assert len(done) == 1 and spark.table("t_once").count() == done[0]
    assert sum(inserted) == 25 and sorted(r.k for r in spark.table("t_keys").collect()) == list(range(25))
    assert sorted(numbers) == [1, 2, 3, 4] == sorted(r.run_id for r in spark.table("t_runs").collect())


def test_replaced_rows_stay_for_their_readers(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS t_kept")
    spark.range(4).write.saveAsTable("t_kept")  # not the library's own
    before = spark.table("t_kept")
    merge.replace_table(spark.range(5), "t_kept")
    first = spark.table("t_kept")
    merge.replace_table(spark.range(6).withColumn("more", F.lit("x")), "t_kept")
    assert first.count() == 5 and spark.table("t_kept").columns == ["id", "more"] and spark.table("t_kept").count() == 6
    with pytest.raises(Exception):
        before.count()
    for n in range(3):
        merge.replace_table(spark.range(n), "t_kept")
    log = commit.TableLog(spark, "t_kept")
    assert len(log._list(f"{log.root}/data")) == commit.KEEP
    monkeypatch.setattr(commit, "REMEMBER", 2)
    merge.append(spark.range(1), "t_kept")
    assert sorted(map(int, log._list(f"{log.root}/log"))) == [log.version() - 1, log.version()] and spark.table("t_kept").count() == 3


def test_a_small_batch_does_not_shuffle_the_table(spark):
    """The batch's ranges reach the scan, its keys travel to it, and the table's rows cross no exchange."""
    spark.sql("DROP TABLE IF EXISTS t_large")
    rows = spark.range(20_000).select((F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("played_at"), (F.col("id") % 50).cast("string").alias("track_id"), F.lit(1).alias("v"))
    rows = rows.withColumn("date", F.to_date("played_at"))
    assert merge.insert_ignore(rows, "t_large", model.EVENT_KEY, ["v"], model.EVENT_LOCATED) == 20_000
    some = rows.filter("v = 1").orderBy(F.desc("played_at")).limit(40)
    fresh = some.withColumn("track_id", F.concat("track_id", F.lit("x"))).limit(10)
    spark.sql("DROP TABLE IF EXISTS t_batch")
    some.unionByName(fresh).write.saveAsTable("t_batch")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    new = merge.unheld(spark.table("t_batch"), spark.table("t_large"), model.EVENT_KEY, model.EVENT_LOCATED)
    assert len(new.collect()) == 10
    plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    join = next(k for k, line in enumerate(plan) if "LeftSemi" in line)
    scan = next(k for k, line in enumerate(plan) if "FileScan" in line and "t_large" in line)
    assert "BroadcastHashJoin" in plan[join] and scan > join and not [line for line in plan[join:scan] if "Exchange" in line]
    assert "SortMergeJoin" not in "".join(plan) and all(f in plan[scan].split("PushedFilters")[1] for f in ("GreaterThanOrEqual(played_at", "LessThanOrEqual(played_at", "date"))
    assert merge.insert_ignore(spark.table("t_batch"), "t_large", model.EVENT_KEY, ["v"], model.EVENT_LOCATED) == 10
    assert merge.insert_ignore(spark.table("t_batch"), "t_large", model.EVENT_KEY, ["v"], model.EVENT_LOCATED) == 0


@pytest.mark.parametrize("keys", [1_000_000, 0])
def test_lookups_equal_the_anti_join(spark, monkeypatch, keys):
    monkeypatch.setattr(merge, "LOOKUP_KEYS", keys)
    base = spark.createDataFrame([(k if k % 7 else None, f"s{k % 5}", dt.date(2024, 1, 1 + k % 20), float(k)) for k in range(60)], "k long, s string, d date, x double")
    for kept in ("k % 3 = 0 OR k IS NULL", "k > 50", "k IS NULL", "k < -1", "x > 1"):
        batch = base.filter(kept).unionByName(spark.createDataFrame([(1000, "s1", None, 5.0), (None, "new", dt.date(2030, 1, 1), float("nan"))], base.schema))
        for key, located in ((["k", "s"], ()), (["x"], ()), (["d", "s"], ()), (["k", "d"], ("d",))):
            half = base.filter("k % 2 = 0 OR k IS NULL")
            got = merge.unheld(batch, half, key, located)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, merge.anti_join(batch, half, key).collect()))


def test_constraints_at_every_entry(spark):
    for t in ("t_checked", "t_aside"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    checks = merge.Checks(required=("k", "s"), one_of={"s": ("a", "b")}, at_most={"t": 3})
    rows = spark.createDataFrame([(1, "a", "xyz"), (2, "c", "x"), (None, "a", "x"), (3, "b", "long"), (4, None, None), (5, "b", None)], "k long, s string, t string")
    with pytest.raises(ValueError, match="break its constraints"):
        merge.append(rows, "t_checked", checks)
    assert merge.append(rows, "t_checked", checks, "t_aside") == 2
    assert merge.load(rows.withColumn("k", F.col("k") + 10), "t_checked", ["k"], ["t"], checks=checks, rejects="t_aside") == (6, 2, 4)
    assert sorted(r.k for r in spark.table("t_checked").collect()) == [1, 5, 11, 15]
    reasons = [r.reason for r in spark.table("t_aside").collect()]
    assert sorted(set(reasons)) == ["k is missing", "s is missing", "s is none of a, b", "t is longer than 3"] and len(reasons) == 8
    assert merge.load(spark.createDataFrame([(20, "a")], "k long, s string").withColumn("t", F.lit("t")), "t_checked", ["k"], ["t"], checks=merge.Checks(required=("gone",)), rejects="t_aside").rejected == 1


def test_a_source_is_read_once(spark, tmp_path):
    """However many steps a load has, and whatever the source would answer the second time."""
    spark.sql("DROP TABLE IF EXISTS t_live")
    merge.insert_ignore(spark.createDataFrame([(0, 0)], "k long, v long"), "t_live", ["k"], ["v"])
    asked = spark.sparkContext.accumulator(0)

    def answers(batches):
        asked.add(1)
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"k": [1, 2], "v": [1, 1]})

    live = spark.range(1, numPartitions=1).mapInArrow(answers, "k long, v long")
    assert merge.load(live, "t_live", ["k"], ["v"]) == (2, 2, 0) and asked.value == 1


def test_jobs_by_name(spark, tmp_path, capsys):
    from playlog.__main__ import main, source

    before = spark.catalog.currentDatabase()
    spark.sql("DROP DATABASE IF EXISTS jobs CASCADE")
    (tmp_path / "history").mkdir()
    rows = [_export_row(f"2024-01-01T00:00:0{k}Z", f"svc:track:{k}") for k in range(3)] + [_export_row("2024-01-01T00:00:09Z", "svc:track:9", master_metadata_track_name=None)]
    (tmp_path / "history" / "a.json").write_text(json.dumps(rows))
    (tmp_path / "history" / "b.json").write_text("[{")
    liked = _pages(tmp_path / "liked", "added_at", [[_item("added_at", "2024-03-09T00:00:00Z", 1)]])
    recent = _pages(tmp_path / "recent", "played_at", [[_item("played_at", "2024-03-10T10:00:00Z", 1)]])
    try:
        with pytest.raises(Exception):
            main(["--database", "jobs", "import", str(tmp_path / "history"), "--service", "svc"], spark)
        assert spark.table(pipeline.EVENTS).count() == 0
        main(["--database", "jobs", "import", str(tmp_path / "history"), "--service", "svc", "--keep-going"], spark)
        assert spark.table(pipeline.EVENTS).count() == 3 and sorted(r.reason for r in spark.table(pipeline.REJECTED).collect()) == ["incomplete", "unreadable"]
        main(["--database", "jobs", "run", "--liked", liked, "--recent", recent, "--export", f"file://{tmp_path}/out"], spark)
        main(["--database", "jobs", "rebuild", "artist_loyalty"], spark)
        main(["--database", "jobs", "export", f"file://{tmp_path}/again"], spark)
        assert (tmp_path / "again" / "artist_loyalty.csv").read_bytes() == (tmp_path / "out" / "artist_loyalty.csv").read_bytes()
        assert [r.status for r in spark.table(pipeline.RUN_LOG).orderBy("run_id").collect()] == ["Failed", "Success", "Success"]
        with pytest.raises(KeyError, match="SERVICE_CLIENT_ID"):
            source("https://service/recent")
    finally:
        spark.catalog.setCurrentDatabase(before)


@pytest.mark.parametrize("seed", range(4))
def test_sessions_equal_the_definition(spark, seed):
    rng = random.Random(seed)
    at, rows = 0, []
    for k in range(150):
        at += rng.choice([0, 0, 1, 60, 899, 1799, 1799.999999, 1800, 1801, 3600, 90_000]) - rng.choice([0, 0, 500])
        rows.append((at - 400_000, rng.choice("ab"), f"t{k}", "x", 1))
    df = events(spark, rows).persist()
    two = {r.track_name: r.session_id for r in sessions.number_global(df).collect()}
    assert two == {r.track_name: r.session_id for r in sessions.number_naive(df).collect()}
    by = {r.track_name: r.session_id for r in sessions.number_by_key(df, "artist_name").collect()}
    for a in "ab":
        own = df.filter(F.col("artist_name") == a)
        assert {r.track_name: r.session_id for r in sessions.number_naive(own).collect()}.items() <= by.items()
    nulls = df.withColumn("played_at", F.when(F.col("track_name") != "t3", F.col("played_at")))
    assert {r.track_name: r.session_id for r in sessions.number_global(nulls).collect()}["t3"] is None
    df.unpersist()


def test_first_rows_with_maps(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2}), (None, 5, None)], "k int, n int, m map<string,int>")
    assert sorted(((r.k, r.n, r.m) for r in merge.dedup_first(df, ["k"], ["n"]).collect()), key=repr) == [(1, 1, {"b": 2}), (None, 5, None)]


@pytest.mark.parametrize("seed", range(2))
def test_late_plays_give_the_sessions_of_all_plays(spark, tmp_path, seed):
    """Plays come in any order, however late, and join sessions that were given out; batches are run again after a restart."""
    rng = random.Random(seed)
    spark.sql("DROP TABLE IF EXISTS t_changes")
    at, rows = 0, []
    for _ in range(160):
        at += rng.choice([1, 60, 899, 1799, 1799.999999, 1800, 1801, 3600, 9_000_000])
        rows.append((at - 400_000, rng.choice("ab"), "t", "x", rng.randrange(1000)))
    rng.shuffle(rows)
    rows.append((None, "a", "t", "x", 1))
    df = events(spark, rows[:-1])
    source = tmp_path / "in"
    for k in range(4):
        part = events(spark, [r for r in rows[:-1][k::4]])
        part.unionByName(part.limit(1).withColumn("played_at", F.lit(None).cast("timestamp_ntz"))).coalesce(1).write.mode("append").parquet(str(source))
        q = session_stream.keep_sessions(ingest.stream_files(spark, str(source), df.schema, "parquet"), "t_changes", "artist_name", str(tmp_path / "check"))
        q.awaitTermination(120)
    want = analytics.listening_sessions_by(df, "artist_name").select("artist_name", "session_start", "session_end", "streams", F.round(F.col("music_minutes") * 0).alias("z")).drop("z")
    changes = spark.table("t_changes")
    got = session_stream.current_sessions(changes, "artist_name")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.sum("ms_played")).first()[0] == sum(r[4] for r in rows[:-1])
    assert changes.filter("gone").count() > 0
    again = changes.filter("batch = 2").unionByName(changes)
    assert sorted(map(tuple, session_stream.current_sessions(again, "artist_name").collect())) == sorted(map(tuple, got.collect()))


def test_paged_stream_reads_only_what_is_new(spark, tmp_path):
    items = [_item("played_at", f"2024-03-10T10:{k:02d}:00Z", k) for k in range(9)]
    newest_first = lambda n: [list(reversed(items[:n]))[k : k + 2] for k in range(0, n, 2)] or [[]]

    def run(pages, after=None):
        folder = tmp_path / "pages"
        if folder.exists():
            for f in folder.iterdir():
                f.unlink()
            folder.rmdir()
        _pages(folder, "played_at", pages)
        stream = paged.stream_items(spark, model.RAW_RECENT, after, path=str(folder), page_size="2")
        q = stream.select("track.id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        assert q.awaitTermination(90)
        if q.exception():
            raise q.exception()
        return sorted(r.id for r in spark.read.schema("id string").parquet(str(tmp_path / "out")).collect())

    assert run(newest_first(4), dt.datetime(2024, 3, 10, 10, 0)) == ["i1", "i2", "i3"]
    assert run(newest_first(4)) == ["i1", "i2", "i3"]
    assert run(newest_first(9)) == [f"i{k}" for k in range(1, 9)]
    assert run([[]]) == [f"i{k}" for k in range(1, 9)]
    assert run(newest_first(9)) == [f"i{k}" for k in range(1, 9)]


def test_database_load(spark):
    url = "jdbc:derby:memory:plays;create=true"
    properties = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    types = "track_id VARCHAR(50), track_name VARCHAR(255)"
    rows = spark.createDataFrame([(T0, f"i{k}", f"N{k}") for k in range(2500)] + [(T0, "i1", "A")], "played_at timestamp_ntz, track_id string, track_name string").repartition(3)
    put = lambda df, load: jdbc.insert_jdbc(df, url, "plays", ["played_at", "track_id"], ["track_name"], load, types, properties)
    assert put(rows, "first") == 2500
    assert put(rows, "first") == 0 and put(rows, "again") == 0
    more = spark.createDataFrame([(T0, "i5", "other"), (T0, "new", "x"), (T0, "new", "y")], rows.schema)
    assert put(more, "second") == 1
    found = {r.track_id: r.track_name for r in spark.read.jdbc(url, "plays", properties=properties).collect()}
    assert len(found) == 2501 and (found["i1"], found["i5"], found["new"]) == ("A", "N5", "x")
    with pytest.raises(ValueError, match="lack a value"):
        put(spark.createDataFrame([(None, "i0", "none")], rows.schema), "keyless")
    # a load that broke off between its rows and its commit: staged rows are there, the table isn't touched, and it is done when run again
    jdbc_rows = spark.createDataFrame([(T0, "late", "z")], rows.schema)
    jdbc_rows.write.options(createTableColumnTypes=types).jdbc(url, "plays_load_third", "append", properties)
    assert put(jdbc_rows, "third") == 1 and spark.read.jdbc(url, "plays", properties=properties).count() == 2502
    with pytest.raises(ValueError):
        put(rows, "a; DROP TABLE plays")


@pytest.mark.parametrize("partitions", [1, 5])
def test_places_are_those_of_the_whole_order(spark, partitions):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, 1, 2, 3, 50]), rng.random()) for k in range(500)]
    df = spark.createDataFrame(rows, "id long, a int, b double").repartition(partitions)
    got = order.with_place(df, [F.desc("a"), "b"])
    want = {r.id: r.place for r in df.selectExpr("id", "row_number() OVER (ORDER BY a DESC, b) AS place").collect()}
    assert {r.id: r.place for r in got.collect()} == want and got.schema["place"].dataType.simpleString() == "bigint"
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert order.with_place(df.limit(0), ["a"]).count() == 0


def test_distinct_counts_without_copies_of_rows(spark):
    rows = [(k % 3 if k % 7 else None, f"t{k % 11}" if k % 5 else None, k % 13, k % 4 if k % 13 else None, k) for k in range(400)]
    df = spark.createDataFrame(rows, "g int, t string, fine int, other int, v long")
    coarse = (F.col("fine") / 4).cast("int")
    got = distinct.distinct_counts(df, ["g"], {"n": ("sum", F.lit(1)), "most": ("max", F.col("v")), "least": ("min", F.col("v")), "all": ("sum", F.col("v"))}, [("ts", F.col("t"))], [("coarse", coarse), ("fine", F.col("fine"))], [("others", F.col("other"))])
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("most"), F.min("v").alias("least"), F.sum("v").alias("all"), F.count_distinct("t").alias("ts"), F.count_distinct(coarse).alias("coarse"), F.count_distinct("fine").alias("fine"), F.count_distinct("other").alias("others"))
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    assert "Expand" not in analytics.loyalty(events(spark, [(0, "a", "t", "x", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert distinct.distinct_counts(df.limit(0), ["g"], {}, [("ts", F.col("t"))]).count() == 0


def test_small_files_stay_few(spark, monkeypatch):
    """However many appends; a reader keeps the files that it began with."""
    monkeypatch.setattr(merge, "SMALL_FILES", 4)
    spark.sql("DROP TABLE IF EXISTS t_small")
    merge.append(spark.range(1), "t_small")
    for k in range(1, 26):
        reader = spark.table("t_small")
        merge.append(spark.range(k, k + 1, 1, 1), "t_small")
        assert len(commit.TableLog(spark, "t_small").sizes()) <= 9 and reader.count() == k
    assert sorted(r.id for r in spark.table("t_small").collect()) == list(range(26))
    monkeypatch.setattr(merge, "SMALL_BYTES", 0)  # large ones are let be
    assert merge.compact(spark, "t_small") == 0


def test_refreshed_analytics_equal_rebuilt_ones(spark):
    """After random increments, late and repeated plays, a refresh that broke off, one without news, and a compaction."""
    rng = random.Random(11)
    before = spark.catalog.currentDatabase()
    spark.sql("DROP DATABASE IF EXISTS refreshed CASCADE")
    merge.ensure_database(spark, "refreshed")
    try:
        pipeline.create_tables(spark)
        for step in range(5):
            rows = [(rng.choice([rng.randrange(40_000), rng.randrange(4_000_000)]), rng.choice("abcd"), f"t{rng.randrange(9)}", rng.choice([None, "x", "y"]), rng.randrange(400_000)) for _ in range(60)]
            batch = normalize.as_events(events(spark, rows), "api", None)
            if step != 3:
                merge.insert_ignore(batch, pipeline.EVENTS, model.EVENT_KEY, ["ms_played"], model.EVENT_LOCATED)
            if step == 2:  # sums are there, but no mark
                with pytest.MonkeyPatch.context() as m, pytest.raises(_Crash):
                    m.setattr(analytics, "discovery_of", lambda *_: (_ for _ in ()).throw(_Crash()))
                    increments.refresh(spark, pipeline.EVENTS, AS_OF)
            if step == 4:
                merge.replace_table(spark.table(pipeline.EVENTS), pipeline.EVENTS)
            increments.refresh(spark, pipeline.EVENTS, AS_OF)
            lots = spark.table(increments.MARKS).count()
            assert lots == (1, 2, 3, 3, 1)[step]
            own = spark.table(pipeline.EVENTS)
            want = {"artist_discovery": analytics.discovery(own), "artist_loyalty": analytics.loyalty(own), "forgotten_favorites": analytics.forgotten(own, AS_OF), "listening_session_summary": analytics.listening_sessions(own), "repeat_behavior": analytics.repeats(own)}
            for name, df in want.items():
                got = spark.table(name)
                assert got.columns == df.columns and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, df.collect()))), (step, name)
    finally:
        spark.catalog.setCurrentDatabase(before)


@pytest.mark.parametrize("keys", [1_000_000, 0])
def test_keys_that_fold_case(spark, monkeypatch, keys):
    """As under a database's collation; stored texts are those that came."""
    monkeypatch.setattr(merge, "LOOKUP_KEYS", keys)
    spark.sql("DROP TABLE IF EXISTS t_fold")
    rows = lambda *r: spark.createDataFrame(list(r), "k long, s string, v long")
    assert merge.load(rows((1, "Caf\u00e9", 2), (1, "CAFE", 1), (2, None, 1), (2, "x", 1)), "t_fold", ["k", "s"], ["v"], fold=["s"]) == (4, 3, 0)
    assert merge.load(rows((1, "cafe", 0), (2, "X", 0), (2, None, 5), (3, "X", 0)), "t_fold", ["k", "s"], ["v"], fold=["s"]) == (4, 1, 0)
    assert sorted(map(repr, map(tuple, spark.table("t_fold").collect()))) == sorted(map(repr, [(1, "CAFE", 1), (2, None, 1), (2, "x", 1), (3, "X", 0)]))
    assert spark.table("t_fold").schema["s"].dataType.simpleString() == "string"


class _Gate(http.server.BaseHTTPRequestHandler):
    """Gives tokens for one code, and pages for the token."""

    def do_POST(self):
        form = dict(p.split("=") for p in self.rfile.read(int(self.headers["Content-Length"])).decode().split("&"))
        good = form.get("grant_type") == "authorization_code" and form.get("code") == "c0de" or form.get("refresh_token") == "r1"
        self.send_response(200 if good else 400)
        self.end_headers()
        self.wfile.write(json.dumps({"access_token": "t1", "refresh_token": "r1"}).encode())

    def log_message(self, *_):
        pass


def test_first_authorization():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Gate)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    options = {"authorize_url": f"{base}/authorize", "token_url": f"{base}/token", "client_id": "me", "client_secret": "s", "redirect_uri": "http://here/back", "scope": "read", "wait": "0"}
    try:
        url = paged.authorization_url(options, "once")
        assert url.startswith(f"{base}/authorize?response_type=code&client_id=me&redirect_uri=http%3A%2F%2Fhere%2Fback&state=once") and "s3cret" not in url
        assert paged.first_tokens(options, "http://here/back?code=c0de&state=once", "once") == {"token": "t1", "refresh_token": "r1"}
        with pytest.raises(ValueError):
            paged.first_tokens(options, "http://here/back?code=c0de&state=other", "once")
        with pytest.raises(PermissionError, match="access_denied"):
            paged.first_tokens(options, "http://here/back?error=access_denied&state=once", "once")
        with pytest.raises(Exception, match="400"):
            paged.first_tokens(options, "http://here/back?code=wrong&state=once", "once")
        with pytest.raises(KeyError, match="redirect_uri"):
            paged.authorization_url(options | {"redirect_uri": ""}, "once")
    finally:
        server.shutdown()


def test_csv_rows_of_one_line_are_split(spark, tmp_path):
    (tmp_path / "big.csv").write_text("k,s\n" + "".join(f'{k},"a, ""{k}"""\n' for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = files.read_csv(spark, str(tmp_path / "big.csv"), "k int, s string", line_rows=True)
        assert df.rdd.getNumPartitions() > 2 and df.count() == 20_000 and df.filter("k = 7").first().s == 'a, "7"'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _largest(df):
    """Rows of the fullest partition, and of all."""
    n = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    return max(n), sum(n)


def test_equal_counts_of_repeats_are_sorted_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(*(F.col("id").cast("string").alias(c) for c in analytics.REPEAT_KEYS), F.lit(T0).cast("timestamp_ntz").alias("played_at"), F.lit(1).cast("long").alias("ms_played"))
        most, n = _largest(analytics.repeats(df.unionByName(df.limit(3))))
        assert n == 4000 and most < 2500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_places_of_equal_rows_are_counted_by_several_tasks(spark):
    from playlog.catalog_tables import _placed

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _placed(spark.range(4000).withColumn("n", F.when(F.col("id") < 10, 2).otherwise(1)), "-n", key=["id"])
        most, n = _largest(got)
        assert n == 4000 and most < 2500 and got.columns == ["n", "place"]
        assert {r.place for r in got.filter("n = 2").collect()} == set(range(1, 11)) and got.select("place").distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_page_files_are_read_by_many_tasks(spark, tmp_path):
    """As the chain says: up to the page without a next or the mark, whatever lies behind; and nothing of it is left out or broken in silence."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        pages = [[_item("played_at", f"2024-03-{28 - n}T0{9 - k}:00:00Z", 10 * n + k) for k in range(5)] for n in range(12)]
        folder = _pages(tmp_path / "many", "played_at", pages)
        read = lambda mark=None: paged.read_items(spark, model.RAW_RECENT, mark, path=folder)
        assert read().rdd.getNumPartitions() > 1 and sorted(r.track.id for r in read().collect()) == sorted(f"i{10 * n + k}" for n in range(12) for k in range(5))
        (tmp_path / "many" / "page-9.json").write_text('{"items": [')
        with pytest.raises(Exception):
            read().collect()
        assert sorted(r.track.id for r in read(dt.datetime(2024, 3, 26, 7)).collect()) == sorted(f"i{k}" for k in (*range(5), *range(10, 15), 20, 21))
        (tmp_path / "many" / "page-1.json").unlink()
        with pytest.raises(FileNotFoundError):
            read(dt.datetime(2024, 3, 26, 7))
        (tmp_path / "many" / "page-0.json").write_text('{"next": null}')
        with pytest.raises(Exception, match="no items"):
            read().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_guards_hold_no_page_of_all_rows(spark, monkeypatch):
    from playlog import catalog_tables

    written = []
    kept = catalog_tables._pages
    monkeypatch.setattr(catalog_tables, "_pages", lambda items, page, n, folder: written.append(items.groupBy(page).count().agg(F.max("count")).first()[0]) or kept(items, page, n, folder))
    monkeypatch.setattr(catalog_tables, "FILE_ROWS", 100)
    catalog_tables.guards(spark, "/root/testdata/sf0.001")
    assert written and max(written) <= 200


def test_a_large_batch_is_shuffled_once(spark, monkeypatch):
    """Keys of the table are grouped with the batch's rows, null keys and keys of another type too; no first rows are written beside."""
    monkeypatch.setattr(merge, "LOOKUP_KEYS", 2)
    written, kept = [], merge.written_once
    monkeypatch.setattr(merge, "written_once", lambda df, tag="batch": written.append(tag) or kept(df, tag))
    spark.sql("DROP TABLE IF EXISTS t_once")
    rows = lambda ks, v: spark.createDataFrame([(k, v + j) for k in ks for j in (1, 0)], "k int, v int")
    assert merge.load(rows([None, *range(10)], 0), "t_once", ["k"], ["v"]) == (22, 11, 0)
    assert merge.load(rows([None, *range(5, 15)], 10), "t_once", ["k"], ["v"]) == (22, 5, 0)
    assert merge.load(rows([None, *range(15)], 20), "t_once", ["k"], ["v"]) == (32, 0, 0)
    assert {(r.k, r.v) for r in spark.table("t_once").collect()} == {(k, 0) for k in (None, *range(10))} | {(k, 10) for k in range(10, 15)}
    assert written == ["batch"] * 3
    batch, base = spark.range(100).withColumn("v", F.lit(1)), spark.range(0, 100, 2).withColumn("k", F.col("id").cast("int"))
    own = merge.first_unheld(batch.withColumnRenamed("id", "k"), base, ["k"], ["v"])
    assert own.count() == 50 and own.schema["k"].dataType.simpleString() == "bigint"
    assert own._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_state_is_asked_by_blocks_of_slots():
    """1000 slots of a key in a few calls, and the same again from what was stored."""
    calls, kept = [], {}

    class State:
        def containsKey(self, k):
            calls.append(k)
            return k in kept

        def getValue(self, k):
            calls.append(k)
            return kept[k]

        def updateValue(self, k, v):
            calls.append(k)
            kept[k] = v

    class Handle:
        def getMapState(self, *_):
            return State()

    import pandas as pd

    gap = 1_800_000_000
    own = session_stream.Sessions(gap)
    own.init(Handle())
    send = lambda micros: list(own.handleInputRows(("a",), iter([pd.DataFrame({"micros": micros, "ms_played": [1] * len(micros)})]), None))[0]
    assert len(send([2 * k * gap for k in range(1000)])) == 1000 and len(calls) < 30
    late = send([gap - 1])
    assert late[["started", "ended", "streams", "ms_played", "gone"]].values.tolist() == [[0, gap - 1, 2, 2, False]]
    assert len(calls) < 60


def test_database_load_that_executors_reach(spark, tmp_path):
    from playlog.sources import sqlite

    path = f"file://{tmp_path}/db/x.db"
    put = lambda rows, load, kind="k int, v string, d double": sqlite.insert_sqlite(spark.createDataFrame(rows, kind).repartition(3), path, "t", ["k"], ["v"], load)
    assert put([(k, f"v{k}", k / 2) for k in range(2500)] + [(1, "a", None)], "one") == 2500
    assert put([(9999, "never", 0.0)], "one") == 0
    assert put([(5, "other", 1.0), (3000, "y", 1.0), (3000, None, 2.0)], "two") == 1
    with pytest.raises(Exception, match="lack a value"):
        put([(None, "x", 1.0)], "keyless")
    with pytest.raises(ValueError, match="no type"):
        put([(1, dt.date(2024, 1, 1))], "dated", "k long, v date")
    found = {r.k: (r.v, r.d) for r in sqlite.read_sqlite(spark, path, "t", spark.createDataFrame([], "k int, v string, d double").schema, "k").collect()}
    assert len(found) == 2501 and found[1] == ("a", None) and found[5] == ("v5", 2.5) and found[3000] == (None, 2.0)
    assert [p.name for p in (tmp_path / "db").iterdir()] == ["x.db"]


def test_dimensions_come_in_as_many_partitions_as_the_lines_need(spark, monkeypatch):
    """Joins that shuffle have tasks that don't grow with the lines; the rows are the same."""
    from playlog.operators import spread

    want = sorted(map(repr, catalog.star(spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(spread, "TASK_ROWS", 700)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.star(spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert all(re.search(rf"hashpartitioning\({key}#\d+L, 9\)", plan) for key in ("l_orderkey", "l_partkey", "l_suppkey")), plan
        assert sorted(map(repr, df.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_one_date_are_no_single_tasks(spark):
    """A load ranges its rows by the key too, so the sort and the files of one date are many tasks'."""
    spark.sql("DROP TABLE IF EXISTS t_one_date")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batch = spark.range(4000).select(F.lit(T0.date()).alias("date"), F.col("id").alias("k"))
        assert merge.load(batch, "t_one_date", ["k"], [], ["date"]) == (4000, 4000, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(commit.TableLog(spark, "t_one_date").sizes()) == 4 and spark.table("t_one_date").distinct().count() == 4000


def test_repeat_sums_and_totals_spread_with_the_rows(spark, monkeypatch):
    """Keys that are mostly unique are aggregated by as many tasks as there are rows for."""
    df = events(spark, [(k * 50_000, "a", f"t{k % 40}", None, k) for k in range(200)])
    want = sorted(map(repr, increments.repeat_totals(increments.repeat_sums(df)).collect()))
    monkeypatch.setattr(increments, "KEY_ROWS", 20)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sums = increments.repeat_sums(df)
        totals = increments.repeat_totals(sums)
        assert sums.rdd.getNumPartitions() == 10 and totals.rdd.getNumPartitions() == -(-sums.count() // 20) > 4
        assert sorted(map(repr, totals.collect())) == want and len(want) == 40
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("keys", [100_000, 0])
def test_touched_totals_and_all_totals_agree(spark, monkeypatch, keys):
    """Few touched keys travel, many make all totals anew; null keys, days played twice and artists of both lots."""
    monkeypatch.setattr(increments, "TOUCHED_KEYS", keys)
    monkeypatch.setattr(increments, "TOUCHED_PART", 0)
    rng = random.Random(5)
    rows = [(rng.randrange(90_000_000), rng.choice(["a", "b", None, *"cdefgh"]), f"t{rng.randrange(5)}", rng.choice([None, "x", "y"]), rng.randrange(9000)) for _ in range(300)]
    old, new = events(spark, rows[:250]), events(spark, [r for r in rows[250:] if r[1] in ("a", None, "h")] + rows[:2])
    both = old.unionByName(new)
    for keys_of, sums, make, whole in (
        (["artist_name"], increments.artist_sums, increments.artist_totals, analytics.artist_totals(both)),
        (analytics.REPEAT_KEYS, increments.repeat_sums, increments.repeat_totals, increments.repeat_totals(increments.repeat_sums(both))),
    ):
        got = increments._renewed(make(sums(old)), sums(old).unionByName(sums(new)), keys_of, new, make)
        assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (keys > 0)
        assert sorted(map(repr, (tuple(r[c] for c in whole.columns) for r in got.collect()))) == sorted(map(repr, map(tuple, whole.collect())))
