"""Stored files, landed answers, stored results."""

from __future__ import annotations

import json

import pytest
from conftest import OBSERVATIONS, tuples
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.operators import analyses as A
from monsoon.operators import observations as O
from monsoon.sinks.results import display, write_curated, write_document, write_json
from monsoon.sources.dimensions import cities, feeds
from monsoon.sources.inventory import inventory, rows_per_file, stored_files
from monsoon.sources.feeds import feed_entries, feed_rejects, feed_summaries
from monsoon.sources.weather import curated_weather, weather_files, weather_rejects, wrong_layout


def by_text(rows):
    return sorted(rows, key=repr)


def test_all_files_are_one_table(weather):
    rows = [(a, b, t, None if h is None else float(h), w, c, s) for a, b, t, h, w, c, s in OBSERVATIONS]
    assert by_text(tuples(weather)) == by_text(rows)


def test_arrays_on_one_line_read_the_same_either_way(spark, weather_dir, weather):
    whole = weather_files(spark, weather_dir, multi_line=True)
    assert by_text(tuples(whole)) == by_text(tuples(weather))


def test_a_record_per_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"kode_kota":"JKT"}\n{"kode_kota":"SBY"}\n')
    assert weather_files(spark, str(tmp_path)).count() == 2


def test_glob(spark, weather_dir):
    assert weather_files(spark, f"{weather_dir}/*.json").count() == 6


def test_empty_directory(no_weather):
    assert no_weather.count() == 0
    assert no_weather.schema == S.OBSERVATION


def test_whole_number_temperatures_stay_double(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"kode_kota":"JKT","temperature":30,"humidity":80.5}]')
    df = weather_files(spark, str(tmp_path))
    assert df.schema["temperature"].dataType.simpleString() == "double"
    row = df.first()
    assert (row.temperature, row.humidity) == (30.0, 80.5)


def test_the_row_set_does_not_depend_on_the_columns(spark, tmp_path):
    """One record without code and with one bad field: every analysis counts it."""
    (tmp_path / "a.json").write_text(
        '{"kode_kota":null,"humidity":"wet","temperature":36,"timestamp":"2026-05-06 10:00:00"}\n'
        '{"kode_kota":"JKT","temperature":36,"timestamp":"2026-05-06 10:30:00"}\n'
        '{"kode_kota":"SBY","tempera'
    )
    df = weather_files(spark, str(tmp_path))
    assert len(df.collect()) == 2
    assert tuples(A.total_events(df)) == [(2,)]
    assert tuples(A.extreme_total(df)) == [(2,)]
    assert [r.jumlah_event for r in A.hourly_trend(df).collect()] == [2]
    assert sum(r.jumlah_event for r in A.city_temperatures(df).collect()) == 2
    assert weather_rejects(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize(
    "name,text,by_line,whole",
    [
        ("array on one line", '[{"a":1},{"a":2}]\n', 0, 0),
        ("record per line", '{"a":1}\n{"a":2}\n', 0, 1),
        ("arrays per line", '[{"a":1}]\n[{"a":2}]\n', 0, 1),
        ("indented array", '[\n    {\n        "a": 1\n    }\n]\n', 1, 0),
        ("one record", '{"a":1}', 0, 0),
        ("nothing", "", 0, 0),
    ],
)
def test_wrong_layout(spark, tmp_path, name, text, by_line, whole):
    (tmp_path / "a.json").write_text(text)
    assert wrong_layout(spark, str(tmp_path)).count() == by_line
    assert wrong_layout(spark, str(tmp_path), multi_line=True).count() == whole


def test_unreadable_feeds_are_rejected(spark):
    good = "<rss><channel><title>t</title><item><link>a</link></item></channel></rss>"
    xml = [good, good[:-20], "no xml", None, "<feed><entry/></feed>"]
    raw = spark.createDataFrame([(i, f"u{i}", x, None) for i, x in enumerate(xml)], S.RAW_FEED)
    assert [r.link for r in feed_entries(raw).collect()] == ["a"]
    assert {(r.feed_url, r.alasan) for r in feed_rejects(raw).collect()} == {
        ("u1", "no_channel"), ("u2", "no_channel"), ("u3", "no_document"), ("u4", "no_channel")}


ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title type="text">berita</title>
<link href="https://a/"/>%s</feed>"""
ENTRIES = [
    ('<entry><title type="html">x &lt;b></title><link rel="self" href="s"/><link href="a"/><summary>r</summary>'
     "<published>2026-05-06T12:00:00Z</published></entry>", ("x <b>", "a", "r", "2026-05-06T12:00:00Z")),
    ('<entry><id>urn:1</id><link rel="enclosure" href="e"/><content>isi</content></entry>', (None, "urn:1", "isi", None)),
    ('<entry><link rel="alternate" type="application/json" href="j"/><link rel="alternate" type="text/html" href="h"/>'
     "<summary>r</summary><content>isi</content></entry>", (None, "h", "r", None)),
    ("<entry/>", (None, None, None, None)),
]


@pytest.mark.parametrize("n", range(len(ENTRIES) + 1))
def test_atom_entries(spark, n):
    """The first n entries; beside the feed, a channel and a feed that is cut off."""
    rss = "<rss><channel><title>t</title><item><link>c</link></item></channel></rss>"
    atom = ATOM % "".join(xml for xml, _ in ENTRIES[:n])
    xml = [atom, rss, atom[:-9]]
    raw = spark.createDataFrame([(i, f"u{i}", x, None) for i, x in enumerate(xml)], S.RAW_FEED)
    got = feed_entries(raw).filter("feed_ord = 0").orderBy("pos")
    assert tuples(got.select("title", "link", "description", "pubDate")) == [row for _, row in ENTRIES[:n]]
    assert {r.feed_title for r in got.collect()} <= {"berita"}
    assert [r.feed_url for r in feed_rejects(raw).collect()] == ["u2"]
    counts = {r.feed_url: (r.judul_feed, r.jumlah_artikel) for r in feed_summaries(raw).collect()}
    assert counts["u0"] == ("berita", n) and counts["u1"] == ("t", 1)


def test_indented_array_needs_multi_line(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"kode_kota": "JKT"}, {"kode_kota": "SBY"}], indent=4))
    assert weather_files(spark, str(tmp_path), multi_line=True).count() == 2


@pytest.mark.parametrize("multi_line", [False, True])
def test_truncated_file_goes_to_rejects(spark, tmp_path, multi_line):
    (tmp_path / "good.json").write_text('[{"kode_kota":"JKT","temperature":30.5}]')
    (tmp_path / "cut.json").write_text('[{"kode_kota":"SBY","tempera')
    df = weather_files(spark, str(tmp_path), multi_line)
    # The same rows whichever columns are asked for.
    assert df.count() == 1
    assert tuples(df.select("nama_kota")) == [(None,)]
    assert tuples(A.total_events(df)) == [(1,)]
    [(path, text)] = tuples(weather_rejects(spark, str(tmp_path), multi_line))
    assert path.endswith("cut.json") and text.startswith('[{"kode_kota":"SBY"')


def test_record_with_one_bad_field_is_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"kode_kota":"JKT","temperature":30.5,"weather_code":1.5}]')
    df = weather_files(spark, str(tmp_path))
    assert df.count() == 1 and df.first().temperature == 30.5
    assert weather_rejects(spark, str(tmp_path)).count() == 0


def test_dimensions(spark):
    assert tuples(cities(spark)) == S.CITIES
    assert tuples(feeds(spark)) == list(enumerate(S.FEEDS))


FULL = '{"current":{"temperature_2m":%s,"relative_humidity_2m":80,"wind_speed_10m":3.5,"weather_code":3}}'


def answers(spark, rows):
    df = spark.createDataFrame(rows, "kode string, body string")
    return df.withColumn("fetched_at", F.timestamp_seconds(F.lit(1778069096.5)))


def test_answers(spark):
    raw = answers(
        spark,
        [
            ("JKT", FULL % "30.5"),
            ("SBY", FULL % "null"),
            ("SMG", FULL % "1" + "\n"),
            ("MDN", "\t " + FULL % "1" + "\r\n"),
            ("MKS", FULL % "1" + "\t"),
            ("SMG", '{"current":{"relative_humidity_2m":80}}'),
            ("MDN", '{"error":true}'),
            ("MKS", "not json"),
            ("DPS", None),
            ("DPS", '{"current":5}'),
            ("DPS", "[" + FULL % "1" + "]"),
            ("JKT", FULL % "1" + " trailing"),
            ("JKT", (FULL % "1")[:-1]),
            ("JKT", (FULL % "1").replace('"', "'")),
            ("XXX", FULL % "20"),
        ],
    )
    checked = O.checked_responses(raw)
    accepted = {r.kode_kota: r for r in O.observations(checked).collect()}
    assert set(accepted) == {"JKT", "SBY", "SMG", "MDN", "MKS"}
    assert tuple(accepted["JKT"]) == (
        "JKT", "Jakarta", 30.5, 80.0, 3.5, 3, "2026-05-06T12:04:56.500000",
    )
    assert accepted["SBY"].temperature is None
    reasons = sorted((r.kode, r.alasan) for r in O.rejected(checked).collect())
    assert reasons == [
        ("DPS", "no_answer"),
        ("DPS", "no_current"),
        ("DPS", "no_current"),
        ("JKT", "no_current"),
        ("JKT", "no_current"),
        ("JKT", "no_current"),
        ("MDN", "no_current"),
        ("MKS", "no_current"),
        ("SMG", "missing_field"),
        ("XXX", "unknown_city"),
    ]
    assert O.observations(checked).schema == S.OBSERVATION


def test_city_table_of_the_caller(spark):
    raw = answers(spark, [("XXX", FULL % "20")])
    table = spark.createDataFrame([("XXX", "Elsewhere")], "kode string, nama string")
    assert O.observations(O.checked_responses(raw, table)).first().nama_kota == "Elsewhere"


def test_results_keep_null_fields_and_replace(spark, weather, tmp_path):
    path = str(tmp_path / "hasil")
    for _ in range(2):
        write_json(A.city_temperatures(weather), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 3
    assert {"suhu_avg": None}.items() <= next(x for x in lines if x["kode_kota"] == "DPS").items()


def test_document_sink(spark, tmp_path):
    write_document(spark.sql("SELECT '{}' AS dokumen"), str(tmp_path / "doc"))
    assert tuples(spark.read.text(str(tmp_path / "doc"))) == [("{}",)]


def test_curated_days(spark, weather, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(weather, path)
    stored = curated_weather(spark, path)
    days = dict(tuples(stored.groupBy(F.col("event_date").cast("string")).count()))
    assert days == {"2026-05-06": 4, None: 2}
    assert tuples(A.hourly_trend(stored)) == tuples(A.hourly_trend(weather))
    assert "try_cast" not in A.hourly_trend(stored)._jdf.queryExecution().executedPlan().toString()
    one_day = stored.filter("event_date = DATE'2026-05-06'")
    assert one_day.count() == 4
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_inventory(spark, weather_dir, weather):
    files = stored_files(spark, weather_dir).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in files) == [
        "2026-05-06_14-00-00.json",
        "2026-05-06_14-02-00.json",
    ]
    assert all(r.length > 0 and r.modificationTime for r in files)
    assert sorted(r.jumlah_event for r in rows_per_file(weather).collect()) == [2, 4]
    listed = inventory(stored_files(spark, weather_dir), weather).collect()
    assert sorted(r.jumlah_event for r in listed) == [2, 4]


def test_display(weather, capsys):
    display(A.hourly_trend(weather))
    shown = capsys.readouterr().out
    assert "jam: integer" in shown and "32.75" in shown
