"""DuckDB text of the registered queries, written from the definitions of the operators."""

from __future__ import annotations

from harkline.catalog import fixtures as fx
from harkline.catalog.queries import MODEL

LOG = f"log AS ({fx.RUN_LOG})"
ITEMS = f"items AS ({fx.MANIFEST_ITEMS})"
PAYLOADS = f"p AS ({fx.PAYLOADS})"
MEDIA = f"m AS ({fx.MEDIA_FILES})"
LISTED = "ext IN ('.flac', '.wav')"

ENTRIES = """entries AS (
  SELECT page_id AS pos, 'u' || page_id AS utt,
    CASE page_id % 10 WHEN 5 THEN 'cat ' || url || ' |'
      WHEN 6 THEN '/dir with space/' || page_id || '.flac' ELSE url END AS src,
    row_number() OVER (ORDER BY page_id) - 1 AS idx, count(*) OVER () AS total
  FROM pages WHERE page_id % 10 >= 4)"""

STATE = """marked AS (
  SELECT utt, status, CAST(retry_attempt AS BIGINT) AS a, pos,
    coalesce(max(CASE WHEN status = 'ok' THEN pos END) OVER (PARTITION BY utt), -1) AS lok
  FROM log WHERE status IN ('ok', 'fail')),
live AS (
  SELECT *, coalesce(max(CASE WHEN status = 'fail' AND a IS NOT NULL AND pos > lok THEN pos END)
    OVER (PARTITION BY utt), -1) AS lex FROM marked),
state AS (
  SELECT utt, bool_or(status = 'ok') AS done,
    CAST(coalesce(max(CASE WHEN pos = lex THEN a END), 0)
      + count(CASE WHEN status = 'fail' AND pos > lok AND pos > lex THEN 1 END) AS BIGINT) AS retry
  FROM live GROUP BY utt)"""

JOINED = """j AS (
  SELECT i.*, coalesce(s.done, false) AS done, coalesce(s.retry, 0) AS retry
  FROM items i LEFT JOIN state s ON i.utt = s.utt)"""

INDEX = f"""fx3 AS ({fx.SHARD_INDEX}),
ix AS (SELECT row_number() OVER (ORDER BY bin_index, start_byte_offset) - 1 AS idx, doc_id, bin_index,
  start_byte_offset AS start, file_size_bytes AS size,
  CAST(coalesce(sample_rate, -1) AS BIGINT) AS sr, CAST(coalesce(channels, -1) AS BIGINT) AS ch FROM fx3)"""

DURATION = "CASE WHEN coalesce(audio_duration, 0) <> 0 THEN audio_duration END"
OK = "coalesce(status = 'ok', false)"

METRICS = f"""lines AS ({fx.METRIC_LINES}),
v AS (SELECT snapshot_id, pos, line, CAST(regexp_extract(line, '([0-9.]+)$', 1) AS VARCHAR) AS t FROM lines WHERE line NOT LIKE '#%'),
metrics AS (
  SELECT l.snapshot_id,
    max(CASE WHEN line LIKE '%running%' THEN CAST(CAST(t AS DOUBLE) AS BIGINT) END) AS running,
    CAST(arg_max(CAST(t AS DOUBLE), pos) FILTER (line LIKE '%waiting%') AS BIGINT) AS waiting,
    max(CASE WHEN line LIKE '%swapped%' THEN CAST(CAST(t AS DOUBLE) AS BIGINT) END) AS swapped,
    max(CASE WHEN line LIKE '%cache_usage%' THEN CAST(t AS DOUBLE) END) AS gpu_cache_pct,
    max(CASE WHEN line LIKE '%generation%' THEN CAST(t AS DOUBLE) END) AS gen_throughput,
    max(CASE WHEN line LIKE '%avg_prompt%' THEN CAST(t AS DOUBLE) END) AS prompt_throughput,
    CAST(arg_min(CAST(t AS DOUBLE), pos) FILTER (line LIKE '%waiting%') AS BIGINT) AS first_waiting
  FROM (SELECT DISTINCT snapshot_id FROM lines) l LEFT JOIN v USING (snapshot_id) GROUP BY l.snapshot_id)"""

GPUS = f"""gl AS ({fx.GPU_LINES}),
g AS (SELECT pos, CAST(trim(split_part(line, ',', 1)) AS BIGINT) AS util, CAST(trim(split_part(line, ',', 2)) AS BIGINT) AS mem_used,
  CAST(trim(split_part(line, ',', 3)) AS BIGINT) AS mem_total, CAST(trim(split_part(line, ',', 4)) AS BIGINT) AS temp
  FROM gl WHERE len(string_split(line, ',')) >= 4)"""

MAGIC = """CASE doc_id % 8 WHEN 0 THEN 'audio/flac' WHEN 1 THEN 'audio/mpeg' WHEN 2 THEN 'audio/mpeg'
  WHEN 3 THEN 'audio/ogg' WHEN 5 THEN 'audio/mp4' ELSE 'audio/wav' END"""
URL = f"'data:' || {MAGIC} || ';base64,' || to_base64(content)"


def request(url: str) -> str:
    return (
        f"""'{{"model":"{MODEL}","messages":[{{"role":"user","content":[{{"type":"audio_url","audio_url":{{"url":"'"""
        f""" || {url} || '"}}}}]}}],"temperature":0.2,"max_tokens":400}}'"""
    )


REQUEST = request(URL)
CALLED = f"""called AS (SELECT doc_id, 'd' || doc_id AS utt, length(r) AS n, md5(r) AS h
  FROM (SELECT doc_id, {REQUEST} AS r FROM p) q)"""
STATUS = "CASE WHEN left(h, 1) IN ('0', '1') THEN 'fail' ELSE 'ok' END"
CAPTION = "CASE WHEN left(h, 1) NOT IN ('0', '1') THEN h END"
ERROR = "CASE left(h, 1) WHEN '0' THEN 'busy ' || left(h, 4) WHEN '1' THEN 'no content in response' END"

SPACE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(5760)||" + "||".join(
    f"chr({c})" for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY utt ORDER BY
  CASE WHEN status = 'ok' THEN 0 ELSE 1 END, CASE WHEN status = 'ok' THEN pos ELSE -pos END) AS rn
  FROM log WHERE utt IS NOT NULL),
merged AS (SELECT * FROM ranked WHERE rn = 1)"""

KEYS = """keys AS (SELECT utt, count(*) AS n, bool_or(status = 'ok') AS any_ok,
  arg_max(coalesce(status = 'ok', false), pos) AS last_ok FROM log GROUP BY utt)"""

PROGRESS = f"""{KEYS},
stats AS (SELECT count(*) AS total_lines,
  (SELECT count(*) FROM keys WHERE utt IS NOT NULL) AS unique_keys,
  (SELECT count(*) FROM keys WHERE utt IS NOT NULL AND any_ok) AS successful,
  (SELECT count(*) FROM keys WHERE utt IS NOT NULL AND NOT last_ok) AS failed,
  count(*) FILTER (utt IS NULL) AS null_key_lines,
  sum(CASE WHEN processing_time > 0 THEN processing_time ELSE 0 END) AS total_processing_time,
  coalesce(sum(audio_duration), 0) AS total_audio_duration
  FROM log)"""

RUN = f"""run AS (SELECT count(*) AS successful, sum(processing_time) AS spent, sum({DURATION}) AS audio
  FROM log WHERE status = 'ok')"""

SAMPLED = f"""drawn AS (SELECT *, coalesce(CAST('0x' || left(md5('0:' || utt), 8) AS BIGINT) < 1073741824, false) AS sampled FROM log),
weighted AS (SELECT pos, status, processing_time, ts, sampled,
  CASE WHEN sampled THEN {DURATION} END AS audio_duration,
  CASE WHEN sampled AND {DURATION} IS NOT NULL THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS sample_weight FROM drawn)"""


def throughput(source: str, audio: str) -> str:
    return f"""t AS (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS el, count(*) FILTER ({OK}) AS n,
  count(*) FILTER ({OK} AND {DURATION} IS NOT NULL) AS w, coalesce(sum(CASE WHEN {OK} THEN processing_time END), 0) AS pt,
  coalesce(sum(CASE WHEN {OK} THEN {audio} END), 0) AS audio FROM {source})"""


ORACLE: dict[str, str] = {
    "read_manifest": f"WITH {ENTRIES} SELECT idx, utt, src, pos % 10 = 5 AS is_command FROM entries",
    "manifest_profile": f"""WITH l AS (SELECT value, trim(value, {SPACE}) AS s FROM ({fx.MANIFEST_LINES}) x)
SELECT count(*) AS total, count(*) FILTER (s = '') AS blank, count(*) FILTER (s LIKE '#%') AS comment,
  count(*) FILTER (s <> '' AND s NOT LIKE '#%' AND NOT regexp_matches(s, '\\s')) AS malformed,
  count(*) FILTER (s NOT LIKE '#%' AND regexp_matches(s, '\\s')) AS entries,
  count(*) FILTER (s <> '' AND s NOT LIKE '#%') AS progress_total,
  count(*) FILTER (s <> '' AND value NOT LIKE '#%') AS split_total FROM l""",
    "list_media": f"""WITH {MEDIA} SELECT subset, stem AS utt, name,
  strlen(text) + CASE container WHEN 'flac' THEN 42 WHEN 'wav' THEN 56 ELSE 0 END AS length FROM m WHERE {LISTED}""",
    "read_shard_index": f"WITH {INDEX} SELECT idx, bin_index, start, size, sr, ch FROM ix",
    "shard_files": f"""WITH {INDEX} SELECT bin_index, format('arkive_{{:06d}}.bin', bin_index) AS name,
  CAST(sum(size) AS BIGINT) AS length FROM ix GROUP BY bin_index""",
    "read_results": """SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx,
  CASE event_id % 12 WHEN 3 THEN CAST(user_id AS VARCHAR) WHEN 4 THEN NULL ELSE 'u' || user_id END AS utt,
  CASE WHEN event_id % 12 IN (4, 6) THEN 'fail' ELSE 'ok' END AS status,
  CASE WHEN event_id % 12 >= 7 THEN 'c' || event_id END AS caption,
  CASE event_id % 12 WHEN 4 THEN 'x' WHEN 6 THEN 'e' END AS error,
  CASE event_id % 12 WHEN 6 THEN CAST(2 AS BIGINT) END AS retry_attempt,
  CASE WHEN event_id % 12 >= 7 THEN '{"total_tokens":' || event_id % 400 || '}' END AS usage
FROM events WHERE event_id % 12 >= 3""",
    "bad_records": """SELECT event_id AS pos, CASE event_id % 12 WHEN 1 THEN '{"utt": "u' || event_id || '", "status": "o'
  ELSE '["u' || event_id || '"]' END AS raw FROM events WHERE event_id % 12 IN (1, 2)""",
    "latest_run": "SELECT event_type AS run_id FROM events GROUP BY event_type ORDER BY max(ts) DESC LIMIT 1",
    "load_payload": f"""WITH {PAYLOADS} SELECT doc_id,
  CASE WHEN doc_id % 17 <> 0 AND doc_id % 19 <> 0 THEN md5(content) END AS digest,
  CASE WHEN doc_id % 17 <> 0 AND doc_id % 19 <> 0 THEN octet_length(content) END AS size,
  doc_id % 17 = 0 OR doc_id % 19 = 0 AS failed FROM p""",
    "slice_shards": f"""WITH {INDEX} SELECT idx, md5(text) AS digest, size AS compressed_size, CAST(NULL AS VARCHAR) AS error
FROM ix JOIN documents USING (doc_id)""",
    "lookup_items": f"""WITH {INDEX} SELECT idx, bin_index, start, size, sr, ch, md5(text) AS digest
FROM ix JOIN documents USING (doc_id) WHERE idx IN (SELECT doc_id FROM labels)""",
    "stored_items": f"WITH {INDEX} SELECT idx, bin_index, start, size, sr, ch FROM ix WHERE idx IN (SELECT doc_id FROM labels)",
    "stored_range": f"WITH {INDEX} SELECT idx, bin_index, start, size, sr, ch FROM ix WHERE idx BETWEEN 100 AND 699",
    "write_results": f"""WITH {LOG} SELECT utt, status, caption, error, processing_time, CAST(retry_attempt AS BIGINT) AS retry_attempt,
  audio_duration, audio_duration_error, '{{"total_tokens":' || pos || '}}' AS usage, pos % 4 AS chunk_id FROM log""",
    "write_captions_tsv": f"""WITH {LOG} SELECT utt, trim(replace(caption, chr(10), ' ')) AS caption
FROM log WHERE status = 'ok' AND utt IS NOT NULL""",
    "write_merged": f"""WITH {LOG}, {RANKED}, lines AS ({fx.LOG_LINES})
SELECT row_number() OVER (ORDER BY utt) - 1 AS idx, value AS raw FROM merged JOIN lines USING (pos)""",
    "write_chunks": f"""WITH {ENTRIES} SELECT CAST(floor(idx / ceil(total / 7)) AS INTEGER) AS chunk_id, utt, src FROM entries""",
    "write_manifest": f"WITH {MEDIA} SELECT subset, stem AS utt, name FROM m WHERE {LISTED}",
    "utt_from_path": "SELECT doc_id, doc_id || CASE WHEN doc_id % 7 = 4 THEN '.b' ELSE '' END AS utt FROM documents",
    "mime_by_extension": """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'audio/flac' WHEN 1 THEN 'audio/x-wav' WHEN 2 THEN 'audio/mpeg'
  WHEN 3 THEN 'audio/ogg' WHEN 4 THEN 'audio/x-wav' WHEN 5 THEN 'audio/wav' ELSE 'audio/mp4' END AS mime FROM documents""",
    "mime_by_magic": f"""SELECT doc_id, {MAGIC} AS mime,
  CASE WHEN doc_id % 8 = 6 THEN 'audio/mp4' ELSE {MAGIC} END AS mime_box FROM documents""",
    "data_url": f"WITH {PAYLOADS} SELECT doc_id, md5({URL}) AS digest, length({URL}) AS chars FROM p",
    "build_request": f"WITH {PAYLOADS} SELECT doc_id, md5({REQUEST}) AS digest, length({REQUEST}) AS chars FROM p",
    "parse_response": """SELECT event_id AS pos, CASE WHEN event_id % 6 >= 3 THEN event_type END AS content,
  CASE WHEN event_id % 6 > 3 THEN '{"total_tokens":' || event_id || '}' ELSE '{}' END AS usage FROM events""",
    "one_line_caption": f"SELECT doc_id, md5(trim(replace(text, chr(10), ' '), {SPACE})) AS digest FROM documents",
    "audio_probe": f"""WITH {MEDIA} SELECT subset, container,
  CASE WHEN container <> 'other' THEN rate END AS sample_rate,
  CASE container WHEN 'flac' THEN ch WHEN 'wav' THEN 1 END AS channels, count(*) AS files,
  round(sum(CASE container WHEN 'flac' THEN samples / rate WHEN 'wav' THEN strlen(text) / rate END), 9) AS seconds,
  count(*) FILTER (container = 'other') AS without_duration FROM m GROUP BY ALL""",
    "result_record": """WITH r AS (SELECT event_id AS pos, event_type, event_id % 5 = 0 AS lost,
  event_id % 5 <> 0 AND event_id % 6 >= 3 AS good FROM events)
SELECT 'u' || pos AS utt, CASE WHEN good THEN 'ok' ELSE 'fail' END AS status, CASE WHEN good THEN event_type END AS caption,
  CASE WHEN good THEN CASE WHEN pos % 6 > 3 THEN '{"total_tokens":' || pos || '}' ELSE '{}' END END AS usage,
  CASE WHEN lost THEN 'timed out' WHEN NOT good THEN 'no content in response' END AS error,
  0.5::DOUBLE AS processing_time, pos % 3 + 1 AS retry_attempt, CASE WHEN good THEN pos * 0.5::DOUBLE END AS audio_duration FROM r""",
    "global_index": "SELECT row_number() OVER (ORDER BY source, n_chars, doc_id) - 1 AS idx, doc_id FROM documents",
    "range_slice": f"WITH {INDEX} SELECT idx, bin_index, start, size, sr, ch FROM ix WHERE idx BETWEEN 100 AND 699",
    "assign_chunks": f"""WITH {ENTRIES}, c AS (SELECT idx, utt, CAST(floor(idx / ceil(total / 6)) AS INTEGER) AS chunk_id FROM entries)
SELECT *, 'manifest_chunk_' || lpad(CAST(chunk_id AS VARCHAR), 4, '0') AS chunk_name FROM c""",
    "chunk_ranges": """WITH t AS (SELECT count(*) AS total FROM documents), s AS (SELECT total, CAST(ceil(total / least(64, total)) AS BIGINT) AS size FROM t),
r AS (SELECT CAST(i AS INTEGER) AS chunk_id, i * size AS start_idx, least((i + 1) * size, total) AS end_idx, total FROM s, range(64) g(i))
SELECT chunk_id, start_idx, end_idx, 'ark_chunk_' || chunk_id || '_' || start_idx || '_' || end_idx AS run_id FROM r WHERE start_idx < total""",
    "chunk_summary": f"""WITH {ENTRIES} SELECT CAST(floor(idx / ceil(total / 16)) AS INTEGER) AS chunk_id, count(*) AS lines FROM entries GROUP BY 1""",
    "ok_filter": f"WITH {LOG} SELECT pos, utt, caption, processing_time FROM log WHERE status = 'ok'",
    "sample_weighted": f"WITH {LOG}, {SAMPLED} SELECT pos, sampled, audio_duration, sample_weight FROM weighted",
    "pending": f"""WITH {LOG}, {ITEMS}, {STATE}, {JOINED}
SELECT pos, utt, src, retry + 1 AS retry_attempt FROM j WHERE NOT done AND retry < 3""",
    "exhausted_items": f"WITH {LOG}, {ITEMS}, {STATE}, {JOINED} SELECT pos, utt, src FROM j WHERE retry >= 3",
    "shard_path_join": f"WITH {INDEX} SELECT idx, bin_index, format('arkive_{{:06d}}.bin', bin_index) AS name FROM ix",
    "forecast_datasets": f"""WITH {LOG}, {RUN}
SELECT CAST(pos AS INTEGER) AS pos, name, CAST(hours AS DOUBLE) AS audio_hours, round(hours / (audio / spent), 6) AS gpu_hours
FROM run, (VALUES (0, 'LibriSpeech-960h', 960), (1, '100h', 100), (2, '500h', 500), (3, '1000h', 1000), (4, '5000h', 5000)) AS t(pos, name, hours)""",
    "resume_state": f"WITH {LOG}, {STATE} SELECT utt, done, retry FROM state",
    "resume_report": f"""WITH {LOG}, {ITEMS}, {STATE}, {JOINED} SELECT count(*) AS total,
  (SELECT count(*) FROM state WHERE done) AS already_done, count(*) FILTER (retry >= 3) AS exhausted,
  count(*) FILTER (NOT done AND retry < 3) AS to_process FROM j""",
    "merge_results": f"WITH {LOG}, {RANKED} SELECT * EXCLUDE (rn, ts) FROM merged",
    "merge_last": f"""WITH {LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY utt ORDER BY pos DESC) AS rn FROM log WHERE utt IS NOT NULL)
SELECT * EXCLUDE (rn, ts) FROM r WHERE rn = 1""",
    "merge_stats": f"""WITH {LOG}, {KEYS} SELECT count(*) FILTER (utt IS NOT NULL) AS unique_keys,
  count(*) FILTER (utt IS NOT NULL AND any_ok) AS successful, count(*) FILTER (utt IS NOT NULL AND NOT any_ok) AS failed,
  CAST(coalesce(sum(n - 1) FILTER (utt IS NOT NULL), 0) AS BIGINT) AS duplicates_resolved,
  CAST(coalesce(sum(n) FILTER (utt IS NULL), 0) AS BIGINT) AS missing_key FROM keys""",
    "throughput_stats": f"""WITH {LOG}, {SAMPLED}, {throughput('weighted', 'audio_duration * sample_weight')}
SELECT round(el, 6) AS elapsed_seconds, n AS processed, round(n / el, 6) AS samples_per_sec, round(n / el * 3600, 6) AS samples_per_hour,
  round(audio / el, 6) AS rtf_wall, w AS samples_with_duration, n - w AS samples_without_duration,
  round(100.0 * w / greatest(n, 1), 6) AS with_duration_pct, round(pt, 6) AS total_processing_time, round(audio / 3600, 6) AS audio_hours FROM t""",
    "duration_error_hist": f"""WITH {LOG} SELECT audio_duration_error, count(*) AS samples FROM log
WHERE status = 'ok' AND coalesce(audio_duration, 0) = 0 AND audio_duration_error <> '' GROUP BY 1""",
    "gpu_hours_estimate": f"""WITH {LOG}, {throughput('log', DURATION)}, e AS (SELECT count(*) AS total FROM events)
SELECT total AS total_samples, CASE WHEN n >= 10 AND n / el * 3600 >= 0.1 THEN round(total / (n / el * 3600), 6) END AS gpu_hours_total,
  CASE WHEN n >= 10 AND n / el * 3600 >= 0.1 THEN round(960 / (audio / el), 6) END AS gpu_hours_960h FROM t, e""",
    "run_metrics": f"""WITH {LOG}, {RUN} SELECT successful, round(spent, 6) AS total_processing_time, round(audio, 6) AS total_audio_duration,
  round(audio / spent, 6) AS rtf_latency, round(spent / successful, 6) AS avg_processing_time FROM run""",
    "throughput_rate": f"""WITH {LOG}, {RUN} SELECT round(successful / spent, 6) AS samples_per_sec,
  round(3600 * successful / spent, 6) AS samples_per_hour, round(86400 * successful / spent, 6) AS samples_per_gpu_day FROM run""",
    "progress_stats": f"""WITH {LOG}, {PROGRESS} SELECT total_lines, unique_keys, successful, failed, null_key_lines,
  round(total_processing_time, 6) AS total_processing_time, round(total_audio_duration, 6) AS total_audio_duration,
  (SELECT utt FROM log ORDER BY pos DESC LIMIT 1) AS last_key,
  (SELECT CASE WHEN {OK} THEN 'ok' ELSE 'not ok' END FROM log ORDER BY pos DESC LIMIT 1) AS last_outcome FROM stats""",
    "progress_report": f"""WITH {LOG}, {PROGRESS}, e AS (SELECT *, (SELECT 40 * count(*) FROM pages WHERE page_id % 10 >= 3) AS expected,
  total_processing_time / total_lines AS avg, total_audio_duration / 86400 AS rtf FROM stats),
f AS (SELECT *, expected - successful AS remaining, (expected - successful) * avg AS eta FROM e)
SELECT expected, remaining,
  CASE WHEN eta < 3600 THEN printf('%.0f minutes', eta / 60) WHEN eta < 86400 THEN printf('%.1f hours', eta / 3600)
    ELSE printf('%.1f days', eta / 86400) END AS eta_label,
  round(100.0 * successful / unique_keys, 6) AS successful_pct, round(100.0 * failed / unique_keys, 6) AS failed_pct,
  round(avg, 6) AS avg_seconds, round(100.0 * successful / expected, 6) AS progress_pct, round(1 / avg, 6) AS samples_per_sec,
  round(3600 / avg, 6) AS samples_per_hour, round(eta, 6) AS eta_seconds, round(rtf, 6) AS rtf_file_span, round(960 / rtf, 6) AS gpu_hours_960h FROM f""",
    "retry_distribution": f"""WITH {LOG} SELECT coalesce(retry_attempt, 1) AS retry_attempt, count(*) AS lines,
  round(100.0 * count(*) / (SELECT count(*) FROM log), 6) AS pct FROM log GROUP BY 1""",
    "error_histogram": f"""WITH {LOG} SELECT left(coalesce(error, 'Unknown error'), 100) AS error_type, count(*) AS lines, min(pos) AS first_pos
FROM log WHERE NOT {OK} GROUP BY 1""",
    "running_counts": f"""WITH {LOG} SELECT pos, status, CAST(sum(CASE WHEN {OK} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS ok_so_far,
  CAST(sum(CASE WHEN {OK} THEN 0 ELSE 1 END) OVER w AS BIGINT) AS fail_so_far FROM log WINDOW w AS (ORDER BY pos)""",
    "checkpoint_series": f"""WITH {LOG}, c AS (SELECT pos + 1 AS processed, CAST(sum(CASE WHEN {OK} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS ok_so_far,
  CAST(sum(CASE WHEN {OK} THEN 0 ELSE 1 END) OVER w AS BIGINT) AS fail_so_far,
  CAST(count(CASE WHEN {OK} THEN {DURATION} END) OVER w AS BIGINT) AS with_duration,
  sum(CASE WHEN {OK} THEN {DURATION} END) OVER w AS audio FROM log WINDOW w AS (ORDER BY pos))
SELECT processed, ok_so_far, fail_so_far, with_duration, round(audio, 6) AS audio_seconds, round(audio / with_duration, 8) AS avg_audio_seconds
FROM c WHERE processed % 100 = 0""",
    "recent_rate": """WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n, epoch_us(max(ts)) / 1e6 AS mtime FROM events GROUP BY ALL),
s AS (SELECT user_id, mtime, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY hour) AS BIGINT) AS total_lines FROM h),
d AS (SELECT *, total_lines - lag(total_lines) OVER w AS dl, mtime - lag(mtime) OVER w AS dt FROM s WINDOW w AS (PARTITION BY user_id ORDER BY mtime))
SELECT user_id, total_lines, round(mtime, 3) AS mtime, CASE WHEN dl > 0 AND dt > 0 THEN round(dl / dt, 6) END AS recent_per_sec,
  CASE WHEN dl > 0 AND dt > 0 THEN round(dl / dt * 3600, 4) END AS recent_per_hour FROM d""",
    "last_processed": f"WITH {LOG} SELECT utt AS last_key, status AS last_status FROM log ORDER BY pos DESC LIMIT 1",
    "top_errors": f"""WITH {LOG}, h AS (SELECT left(coalesce(error, 'Unknown error'), 100) AS error_type, count(*) AS lines, min(pos) AS first_pos
  FROM log WHERE NOT {OK} GROUP BY 1)
SELECT error_type, CASE WHEN length(error_type) > 60 THEN left(error_type, 60) || '...' ELSE error_type END AS label, lines,
  greatest((SELECT count(*) FROM h) - 5, 0) AS others FROM h ORDER BY lines DESC, first_pos LIMIT 5""",
    "sorted_index": f"WITH {INDEX} SELECT bin_index, start, size, sr, ch FROM ix",
    "sorted_keys": f"WITH {LOG}, {RANKED} SELECT utt, status, pos FROM merged",
    "union_logs": f"""WITH {LOG} SELECT utt, status, caption, pos FROM log UNION ALL
SELECT utt, status, CASE WHEN status = 'ok' THEN 'c' || pos END, pos + (SELECT max(pos) + 1 FROM log) FROM log""",
    "distinct_keys": f"WITH {LOG} SELECT DISTINCT utt FROM log WHERE utt IS NOT NULL",
    "annotate": f"""WITH {PAYLOADS}, {CALLED} SELECT utt, {STATUS} AS status, {CAPTION} AS caption,
  CASE WHEN {STATUS} = 'ok' THEN '{{"total_tokens":' || n || '}}' END AS usage, {ERROR} AS error, CAST(1 AS BIGINT) AS retry_attempt FROM called""",
    "annotate_retry": f"""WITH {PAYLOADS}, {CALLED} SELECT utt, {STATUS} AS status, {CAPTION} AS caption, {ERROR} AS error, a AS retry_attempt
FROM called, range(1, 4) t(a) WHERE a = 1 OR {STATUS} = 'fail'""",
    "stream_progress": f"""WITH {LOG}, {PROGRESS} SELECT total_lines, unique_keys, successful, failed, null_key_lines,
  (SELECT utt FROM log ORDER BY pos DESC LIMIT 1) AS last_key FROM stats""",
    "stream_merge": f"""WITH {LOG}, {RANKED} SELECT utt, status, CASE WHEN status = 'ok' THEN 'c' || pos END AS caption,
  CAST(retry_attempt AS BIGINT) AS retry_attempt FROM merged""",
    "stream_recent_rate": """SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, count(*) AS lines,
  round(count(*) / 3600, 6) AS recent_per_sec FROM events GROUP BY 1""",
    "stream_resume": f"WITH {LOG}, {STATE} SELECT utt, done, retry FROM state",
    "stream_metrics": f"""WITH {METRICS}, q AS (SELECT snapshot_id, coalesce(running, 0) + coalesce(waiting, 0) AS n FROM metrics
  WHERE coalesce(running, waiting, swapped, gpu_cache_pct, gen_throughput, prompt_throughput) IS NOT NULL)
SELECT 'queue' AS source, snapshot_id AS snapshot, CASE WHEN n < 100 THEN 'queue_low' ELSE 'queue_high' END AS alert, n AS value FROM q WHERE n < 100 OR n > 2000""",
    "stream_gpu_alerts": f"""WITH {GPUS}, a AS (SELECT 'gpu_util_low' AS alert, util AS value FROM g WHERE util < 50
UNION ALL SELECT 'gpu_temp_high', temp FROM g WHERE temp > 80) SELECT alert, value, count(*) AS times FROM a GROUP BY ALL""",
    "stream_closed_rate": """SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, count(*) AS lines FROM events
WHERE epoch(date_trunc('hour', ts)) + 3600 + 86400 <= (SELECT epoch(max(ts)) FROM events) GROUP BY 1""",
    "stream_annotate": "",
    "parse_metrics": f"WITH {METRICS} SELECT *, CAST(0 AS BIGINT) AS bad_lines FROM metrics",
    "queue_shares": f"""WITH {METRICS}, q AS (SELECT snapshot_id, coalesce(running, 0) AS r, coalesce(waiting, 0) AS w, coalesce(swapped, 0) AS s FROM metrics)
SELECT snapshot_id, r + w + s AS total_requests, round(r / nullif(r + w + s, 0), 6) AS running_share,
  round(w / nullif(r + w + s, 0), 6) AS waiting_share, round(s / nullif(r + w + s, 0), 6) AS swapped_share FROM q""",
    "parse_gpu": f"WITH {GPUS} SELECT pos, util, mem_used, mem_total, temp, round(100.0 * mem_used / mem_total, 6) AS mem_pct FROM g",
    "telemetry_alerts": f"""WITH {METRICS}, {GPUS}, q AS (SELECT snapshot_id, coalesce(running, 0) + coalesce(waiting, 0) AS n FROM metrics
  WHERE coalesce(running, waiting, swapped, gpu_cache_pct, gen_throughput, prompt_throughput) IS NOT NULL)
SELECT 'queue' AS source, snapshot_id AS snapshot, CASE WHEN n < 100 THEN 'queue_low' ELSE 'queue_high' END AS alert, n AS value FROM q WHERE n < 100 OR n > 2000
UNION ALL SELECT 'gpu', pos, 'gpu_util_low', util FROM g WHERE util < 50
UNION ALL SELECT 'gpu', pos, 'gpu_temp_high', temp FROM g WHERE temp > 80""",
}

# The stream sends files: the type in the URL goes by file name, and every 17th is missing.
_BY_NAME = """CASE doc_id % 7 WHEN 0 THEN 'audio/flac' WHEN 1 THEN 'audio/x-wav' WHEN 2 THEN 'audio/mpeg'
  WHEN 3 THEN 'audio/ogg' WHEN 4 THEN 'audio/x-wav' WHEN 5 THEN 'audio/wav' ELSE 'audio/mp4' END"""
_SENT = request(f"'data:' || {_BY_NAME} || ';base64,' || to_base64(content)")
ORACLE["stream_annotate"] = f"""WITH {PAYLOADS}, called AS (SELECT doc_id, 'd' || doc_id AS utt, doc_id % 17 = 0 AS unreadable, md5({_SENT}) AS h FROM p),
s AS (SELECT *, CASE WHEN unreadable THEN 'fail' ELSE {STATUS} END AS status FROM called)
SELECT utt, status, CASE WHEN status = 'ok' THEN h END AS caption,
  CAST(CASE WHEN status = 'ok' THEN 1 ELSE 3 END AS BIGINT) AS retry_attempt, unreadable FROM s"""
