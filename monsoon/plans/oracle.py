"""The same results in ANSI SQL over the same tables, written independently."""

from __future__ import annotations

# Observations.
W = """
w AS (
  SELECT event_id, ts, c.kode_kota, c.nama_kota,
    CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST(200 + (event_id * 7) % 180 AS DOUBLE) / CAST(10 AS DOUBLE) END AS temperature,
    CAST(40 + (event_id * 13) % 55 AS DOUBLE) AS humidity,
    value / CAST(10 AS DOUBLE) AS wind_speed,
    CAST(user_id % 100 AS BIGINT) AS weather_code,
    CASE WHEN event_id % 89 = 0 THEN 'garbage'
         WHEN event_id % 83 = 0 THEN CAST(NULL AS VARCHAR)
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp"
  FROM events JOIN (VALUES (0,'JKT','Jakarta'),(1,'SBY','Surabaya'),(2,'SMG','Semarang'),
    (3,'MDN','Medan'),(4,'MKS','Makassar'),(5,'DPS','Denpasar')) AS c(idx,kode_kota,nama_kota)
    ON user_id % 6 = c.idx
),
t AS (SELECT *, try_cast("timestamp" AS TIMESTAMP) AS ts_obj FROM w),
x AS (SELECT * FROM w WHERE wind_speed > 40 OR humidity > 90 OR temperature > 35)
"""

S1 = 'kode_kota, nama_kota, temperature, humidity, wind_speed, weather_code, "timestamp"'

# Articles.
N = """
n AS (
  SELECT doc_id,
    CASE WHEN doc_id % 50 = 0 THEN ''
         ELSE concat('https://news.example/', CAST(doc_id % 700 AS VARCHAR)) END AS link,
    left(text, 70) AS judul, left(text, 300) AS ringkasan, text AS isi,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 60),
             '%a, %d %b %Y %H:%M:%S +0000') AS waktu_terbit,
    source AS sumber, doc_id // 100 AS poll,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((doc_id // 100) * 300),
             '%Y-%m-%dT%H:%M:%S') AS "timestamp"
  FROM documents
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY doc_id) AS urut
  FROM n WHERE link <> ''
),
f AS (SELECT * FROM ranked WHERE urut = 1)
"""

S2 = 'judul, link, ringkasan, waktu_terbit, sumber, "timestamp"'


def mean(column: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST(AVG({column}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


CITY_STATS = f"""
city AS (
  SELECT kode_kota, nama_kota, {mean('temperature')} AS suhu_avg,
    MAX(temperature) AS suhu_tertinggi, MIN(temperature) AS suhu_terendah,
    COUNT(*) AS jumlah_event
  FROM w GROUP BY kode_kota, nama_kota
)
"""
EXTREME_STATS = """
ekstrem AS (
  SELECT kode_kota, nama_kota, COUNT(*) AS jumlah_event_ekstrem
  FROM x GROUP BY kode_kota, nama_kota
)
"""
HOURLY = f"""
trend AS (
  SELECT CAST(hour(ts_obj) AS INTEGER) AS jam, {mean('temperature')} AS suhu_avg,
    COUNT(*) AS jumlah_event
  FROM t WHERE ts_obj IS NOT NULL GROUP BY 1
)
"""

HOTTEST = "SELECT * FROM city WHERE suhu_avg IS NOT NULL ORDER BY suhu_avg DESC, kode_kota LIMIT 1"
WORST = "SELECT * FROM ekstrem ORDER BY jumlah_event_ekstrem DESC, kode_kota LIMIT 1"
COLDEST = "SELECT * FROM trend WHERE suhu_avg IS NOT NULL ORDER BY suhu_avg, jam LIMIT 1"

# The fixed sentences of the report, once more, for an independent check.
INSIGHTS = f"""
WITH {W}, {CITY_STATS}, {EXTREME_STATS}, {HOURLY},
a AS ({HOTTEST}), b AS ({WORST}), c AS ({COLDEST})
SELECT 'suhu' AS topik, coalesce((SELECT nama_kota || ' memiliki rata-rata suhu tertinggi ('
  || CAST(suhu_avg AS VARCHAR) || ' C). Kota ini perlu diprioritaskan untuk monitoring '
  || 'pengiriman pada jam panas.' FROM a),
  'Data suhu belum tersedia untuk dianalisis.') AS narasi
UNION ALL
SELECT 'ekstrem', coalesce((SELECT nama_kota || ' paling sering mengalami kondisi ekstrem ('
  || CAST(jumlah_event_ekstrem AS VARCHAR) || ' event). Rute melalui kota ini perlu dicek ulang '
  || 'sebelum pengiriman.' FROM b),
  'Tidak ada event ekstrem berdasarkan ambang wind_speed > 40 km/h, humidity > 90%, atau '
  || 'temperature > 35 C. Kondisi relatif aman pada data yang terkumpul.')
UNION ALL
SELECT 'tren', coalesce((SELECT 'Jam ' || lpad(CAST(jam AS VARCHAR), 2, '0')
  || ':00 memiliki rata-rata suhu terendah (' || CAST(suhu_avg AS VARCHAR)
  || ' C). Waktu ini dapat dipertimbangkan sebagai waktu pengiriman yang lebih nyaman.' FROM c),
  'Data timestamp belum cukup untuk membaca tren suhu per jam.')
"""

DOCUMENT = f"""
WITH {W}, {CITY_STATS}, {EXTREME_STATS}, {HOURLY}
SELECT CAST(to_json(struct_pack(
  suhu_kota := (SELECT list(struct_pack(kode_kota := kode_kota, nama_kota := nama_kota,
      suhu_avg := suhu_avg, suhu_tertinggi := suhu_tertinggi, suhu_terendah := suhu_terendah,
      jumlah_event := jumlah_event) ORDER BY suhu_avg DESC NULLS LAST, kode_kota) FROM city),
  ekstrem := (SELECT list(struct_pack(kode_kota := kode_kota, nama_kota := nama_kota,
      jumlah_event_ekstrem := jumlah_event_ekstrem)
      ORDER BY jumlah_event_ekstrem DESC, kode_kota) FROM ekstrem),
  tren_jam := (SELECT list(struct_pack(jam := jam, suhu_avg := suhu_avg,
      jumlah_event := jumlah_event) ORDER BY jam) FROM trend)
)) AS VARCHAR) AS dokumen
"""

def current(*ties: str) -> str:
    order = ", ".join(f"{tie} DESC NULLS LAST" for tie in ties)
    return f"""
WITH {W}, latest AS (
  SELECT *, row_number() OVER (PARTITION BY kode_kota ORDER BY ts_obj DESC, {order}) AS urut
  FROM t WHERE ts_obj IS NOT NULL
)
SELECT kode_kota, nama_kota, temperature, humidity, wind_speed, weather_code,
  strftime(ts_obj, '%Y-%m-%d %H:%M:%S') AS waktu,
  CASE WHEN temperature IS NULL THEN 'abu-abu' WHEN temperature < 22 THEN 'biru'
       WHEN temperature < 27 THEN 'hijau' WHEN temperature < 32 THEN 'kuning'
       ELSE 'merah' END AS warna,
  coalesce(wind_speed > 40 OR humidity > 90 OR temperature > 35, false) AS ekstrem
FROM latest WHERE urut = 1
"""


# Which landed answers are refused, decided from the values they were made of.
RAW = f"""
WITH {W}, r AS (
  SELECT *,
    CASE WHEN weather_code = 17 THEN 'XXX' ELSE kode_kota END AS kode,
    CASE WHEN "timestamp" IS NULL THEN 'no_answer'
         WHEN "timestamp" = 'garbage' OR weather_code = 13 THEN 'no_current'
         WHEN temperature IS NULL AND weather_code > 50 THEN 'missing_field'
         WHEN weather_code = 17 THEN 'unknown_city' END AS alasan,
    replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS diambil
  FROM w
)
"""

ACCEPTED = f"""{RAW}
SELECT event_id, kode_kota, nama_kota, temperature, humidity, wind_speed, weather_code,
  diambil AS "timestamp"
FROM r WHERE alasan IS NULL
"""

REJECTED = f"""{RAW}
SELECT event_id, kode, diambil AS fetched_at, alasan,
  CASE WHEN "timestamp" IS NULL THEN NULL
       WHEN "timestamp" = 'garbage' THEN 'not json'
       WHEN weather_code = 13 THEN '{{"error":true}}'
       WHEN temperature IS NULL AND weather_code > 50 THEN
         CAST(to_json(struct_pack("current" := struct_pack(relative_humidity_2m := humidity,
           wind_speed_10m := wind_speed, weather_code := weather_code))) AS VARCHAR)
       ELSE
         CAST(to_json(struct_pack("current" := struct_pack(temperature_2m := temperature,
           relative_humidity_2m := humidity, wind_speed_10m := wind_speed,
           weather_code := weather_code))) AS VARCHAR) END AS body
FROM r WHERE alasan IS NOT NULL
"""

NEW_VS_HISTORY = f"""
WITH {N}, half AS (SELECT (max(doc_id) + 1) // 2 AS m FROM documents),
later AS (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY doc_id) AS nomor
  FROM n WHERE link <> '' AND doc_id >= (SELECT m FROM half)
)
SELECT doc_id, {S2} FROM later WHERE nomor = 1
  AND link NOT IN (SELECT link FROM n WHERE doc_id < (SELECT m FROM half))
"""

NEW_PER_POLL = f"""
WITH {N}
SELECT p.poll, COUNT(f.link) AS artikel_baru
FROM (SELECT DISTINCT poll FROM n) AS p LEFT JOIN f ON f.poll = p.poll
GROUP BY p.poll
"""

# A period is nine polls.
DEDUP_WITHIN = f"""
WITH {N}, k AS (
  SELECT *, row_number() OVER (PARTITION BY link, CAST(poll AS BIGINT) // 9 ORDER BY doc_id) AS urutan
  FROM n WHERE link <> '')
SELECT doc_id, {S2} FROM k WHERE urutan = 1
"""

BATCH_COUNTS = f"""
WITH {N}, top AS (SELECT max(doc_id) + 1 AS m FROM documents),
taken AS (SELECT doc_id * 5 // m AS piece, COUNT(*) AS jumlah_event FROM n, top GROUP BY 1),
fresh AS (SELECT doc_id * 5 // m AS piece, COUNT(*) AS artikel_baru FROM f, top GROUP BY 1)
SELECT 'berita' AS stream, jumlah_event, coalesce(artikel_baru, 0) AS artikel_baru
FROM taken LEFT JOIN fresh USING (piece)
"""

PREVIEW = f"""
WITH {N}, nomor AS (
  SELECT *, row_number() OVER (PARTITION BY sumber ORDER BY doc_id) AS ke FROM n
)
SELECT doc_id, judul, link, left(isi, 200) AS ringkasan, waktu_terbit, sumber, "timestamp"
FROM nomor WHERE ke <= 3
"""

# An XML reader drops blanks around a text.
BLANKS = "chr(32) || chr(9) || chr(10) || chr(13)"

FEED_ENTRIES = f"""
WITH {N}
SELECT CAST(substr(sumber, 4) AS INTEGER) AS feed_ord,
  CAST(row_number() OVER (PARTITION BY sumber, poll ORDER BY doc_id) - 1 AS INTEGER) AS pos,
  trim(judul, {BLANKS}) AS judul, link, left(trim(isi, {BLANKS}), 300) AS ringkasan,
  waktu_terbit, sumber, "timestamp"
FROM n
"""

BOTH_KINDS = f"""
WITH entri AS ({FEED_ENTRIES})
SELECT feed_ord, pos, judul, link, ringkasan, sumber, "timestamp",
  CASE WHEN feed_ord % 2 = 0 THEN waktu_terbit
       ELSE strftime(strptime(waktu_terbit, '%a, %d %b %Y %H:%M:%S +0000'), '%Y-%m-%dT%H:%M:%SZ')
  END AS waktu_terbit
FROM entri
"""

FEED_COUNTS = f"""
WITH {N}
SELECT CAST(substr(sumber, 4) AS INTEGER) AS feed_ord,
  'https://feed.example/' || sumber || '.xml' AS feed_url, "timestamp" AS fetched_at,
  sumber AS judul_feed, CAST(COUNT(*) AS INTEGER) AS jumlah_artikel
FROM n GROUP BY sumber, poll, "timestamp"
"""

PEEK = f"""
WITH {W}, bus AS (
  SELECT replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS waktu,
    ts, kode_kota AS "key",
    CAST(to_json(struct_pack(event_id := event_id, kode_kota := kode_kota,
      nama_kota := nama_kota, temperature := temperature, humidity := humidity,
      wind_speed := wind_speed, weather_code := weather_code, "timestamp" := "timestamp"
    )) AS VARCHAR) AS isi
  FROM w
)
SELECT waktu, "key", left(isi, 120) AS "value" FROM bus ORDER BY ts, "key", isi LIMIT 5
"""

FEEDS_REJECTED = f"""
WITH {N}
SELECT DISTINCT 'https://feed.example/' || sumber || '.xml' AS feed_url,
  "timestamp" AS fetched_at, 'no_channel' AS alasan
FROM n WHERE CAST(substr(sumber, 4) AS INTEGER) % 3 = 0
"""

OBSERVATION_LINES = f"""
WITH {W}
SELECT event_id, '  ' || kode_kota || ' | ' || rpad(nama_kota, 10, ' ') || ' | '
  || coalesce(CAST(temperature AS VARCHAR), 'None') || '°C |  '
  || CAST(wind_speed AS VARCHAR) || ' km/h |  ' || CAST(humidity AS VARCHAR) || '%' AS baris
FROM w
"""


INVENTORY = f"""
WITH {W} SELECT TRUE AS ada_file, TRUE AS lengkap, COUNT(*) AS jumlah_event FROM w
"""


def statements() -> dict[str, str]:
    events = f"WITH {W} SELECT event_id, {S1} FROM w"
    return {
        "city_temperature_stats": f"WITH {W}, {CITY_STATS} SELECT * FROM city",
        "city_temperature_by_name": f"""
            WITH {W} SELECT nama_kota, {mean('temperature', 6)} AS suhu_avg,
              MAX(temperature) AS suhu_tertinggi, MIN(temperature) AS suhu_terendah
            FROM w GROUP BY nama_kota""",
        "total_events": f"WITH {W} SELECT COUNT(*) AS total_event FROM w",
        "extreme_events": f"WITH {W} SELECT event_id, {S1} FROM x",
        "extreme_by_city": f"WITH {W}, {EXTREME_STATS} SELECT * FROM ekstrem",
        "extreme_by_name": f"""
            WITH {W} SELECT nama_kota, COUNT(*) AS jumlah_event_ekstrem
            FROM x GROUP BY nama_kota""",
        "extreme_total": f"WITH {W} SELECT COUNT(*) AS total_ekstrem FROM x",
        "hourly_trend": f"WITH {W}, {HOURLY} SELECT * FROM trend",
        "hourly_trend_with_null": f"""
            WITH {W} SELECT CAST(hour(ts_obj) AS INTEGER) AS jam,
              {mean('temperature', 6)} AS suhu_avg FROM t GROUP BY 1""",
        "hottest_city": f"WITH {W}, {CITY_STATS} {HOTTEST}",
        "most_extreme_city": f"WITH {W}, {EXTREME_STATS} {WORST}",
        "coldest_hour": f"WITH {W}, {HOURLY} {COLDEST}",
        "flush_batch_counts": f"""
            WITH {W} SELECT strftime(time_bucket(INTERVAL 120 SECONDS, ts_obj),
              '%Y-%m-%d %H:%M:%S') AS batch_start, COUNT(*) AS jumlah_event
            FROM t WHERE ts_obj IS NOT NULL GROUP BY 1""",
        "current_temperature": current("event_id"),
        "observation_lines": OBSERVATION_LINES,
        "report_city_rows": f"WITH {W}, {CITY_STATS} SELECT * FROM city",
        "report_hour_rows": f"WITH {W}, {HOURLY} SELECT * FROM trend",
        "report_totals": f"""
            WITH {W} SELECT (SELECT COUNT(*) FROM w) AS total_event,
              (SELECT COUNT(*) FROM x) AS total_ekstrem""",
        "insight_sentences": INSIGHTS,
        "dashboard_document": DOCUMENT,
        "observations_from_raw": ACCEPTED,
        "rejected_raw": REJECTED,
        "articles_normalized": f"WITH {N} SELECT doc_id, {S2} FROM n WHERE link <> ''",
        "articles_first_seen": f"""
            WITH {N} SELECT doc_id, {S2}, substr(md5(link), 1, 8) AS kunci FROM f""",
        "articles_new_vs_history": NEW_VS_HISTORY,
        "articles_new_vs_stored": NEW_VS_HISTORY,
        "articles_new_per_poll": NEW_PER_POLL,
        "feed_preview": PREVIEW,
        "article_lines": f"WITH {N} SELECT doc_id, '  → ' || judul || '...' AS baris FROM n",
        "published_times": """
            SELECT doc_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 60),
              '%Y-%m-%dT%H:%M:%S') AS terbit FROM documents""",
        "latest_news": f"WITH {N} SELECT doc_id, {S2} FROM f ORDER BY doc_id DESC LIMIT 10",
        "feed_entries_from_xml": FEED_ENTRIES,
        "feed_entries_of_both_kinds": BOTH_KINDS,
        "feed_entry_counts": FEED_COUNTS,
        "bus_roundtrip": events,
        "bus_peek": PEEK,
        "article_bus_roundtrip": f"""
            WITH {N} SELECT doc_id, {S2}, substr(md5(link), 1, 8) AS "key" FROM f""",
        "results_json_roundtrip": events,
        "mixed_layouts": events,
        "mixed_layouts_curated": f"WITH {W} SELECT {S1} FROM w",
        "stored_rows_per_day": f"""
            WITH {W} SELECT CAST(CAST(ts_obj AS DATE) AS VARCHAR) AS event_date,
              COUNT(*) AS jumlah_event FROM t GROUP BY 1""",
        "stored_city_results": f"WITH {W}, {CITY_STATS} SELECT * FROM city",
        "stored_document": DOCUMENT,
        "stored_current": current("temperature", "humidity", "wind_speed", "weather_code"),
        "stored_news": f"WITH {N} SELECT {S2} FROM f ORDER BY doc_id DESC LIMIT 10",
        "file_inventory": INVENTORY,
        "file_inventory_kept": INVENTORY,
        "weather_rejected": f"""
            WITH {W} SELECT '{{"event_id":' || event_id || ', "kode_kota' AS isi
            FROM w WHERE "timestamp" = 'garbage'""",
        "messages_rejected": f"""
            WITH {W} SELECT 'weather-api' AS topic, kode_kota AS "key",
              'not json ' || event_id AS isi,
              replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS dikirim
            FROM w WHERE "timestamp" = 'garbage'""",
        "feeds_rejected": FEEDS_REJECTED,
        "stream_observations": ACCEPTED,
        "stream_rejected": REJECTED,
        "stream_store": events,
        "stream_once": events,
        "stream_resumed": events,
        "stream_dedup": f"WITH {N} SELECT link FROM f",
        "stream_first_seen": f"WITH {N} SELECT doc_id, {S2} FROM f",
        "stream_dedup_within": DEDUP_WITHIN,
        "stream_batch_counts": BATCH_COUNTS,
        "pipeline_news": f"WITH {N} SELECT {S2} FROM f",
    }
