"""DuckDB SQL oracles, one per registered query, written independently of
the Spark code from the fixture definition (tables are the pre-registered
views over the test parquet files)."""

from __future__ import annotations

# Fixed values shared with the fixture mapping (see sources/fixtures.py).
POISON = "(event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 79 = 0)"
TOPIC = "'messages'"

MESSAGES = f"""
  SELECT event_id, user_id,
         CAST(event_id AS VARCHAR) AS id,
         event_type AS text,
         date_trunc('millisecond', ts) AS createdAt,
         CAST(user_id % 4 AS INTEGER) AS partition,
         {POISON} AS poison
  FROM events
"""


def _staged(n: int, late_mod: int | None = None) -> str:
    """Messages with their staged batch (equal event_id ranges) and arrival."""
    late = f"CASE WHEN event_id % {late_mod} = 0 AND rb < {n - 1} THEN 1 ELSE 0 END" if late_mod else "0"
    return f"""
  SELECT *, rb + {late} AS arrival FROM (
    SELECT m.*, CAST(floor((event_id - lo) * {n} / (hi - lo + 1)) AS INTEGER) AS rb
    FROM ({MESSAGES}) m, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events) bounds)
"""


def _hour_counts(where: str = "TRUE") -> str:
    return f"""
  SELECT date_trunc('hour', createdAt) AS window_start,
         date_trunc('hour', createdAt) + INTERVAL 1 HOUR AS window_end,
         text,
         CAST(count(*) AS BIGINT) AS count
  FROM ({MESSAGES}) m WHERE NOT poison AND {where}
  GROUP BY ALL
"""


_FINAL_WATERMARK = f"(SELECT max(createdAt) FROM ({MESSAGES}) x WHERE NOT poison) - INTERVAL 2 HOUR"
_APPEND = f"SELECT * FROM ({_hour_counts()}) c WHERE window_end <= {_FINAL_WATERMARK}"

_LATE = f"""
  WITH a AS ({_staged(4, 13)}),
  kept AS (SELECT * FROM a WHERE NOT poison),
  mx AS (SELECT arrival, max(createdAt) AS mx FROM kept GROUP BY arrival),
  wm AS (SELECT arrival,
                max(mx) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  - INTERVAL 2 HOUR AS wm
         FROM mx),
  k AS (SELECT kept.*, wm.wm, date_trunc('hour', createdAt) + INTERVAL 1 HOUR AS we
        FROM kept JOIN wm USING (arrival))
"""

def _varint_hex(z: str) -> str:
    """Hex text of the varint of a non-negative BIGINT expression ``z``."""
    parts = []
    for j in range(9):
        more = f"CASE WHEN ({z}) >> {7 * (j + 1)} > 0 THEN 128 ELSE 0 END"
        byte = f"printf('%02X', ((({z}) >> {7 * j}) & 127) | {more})"
        parts.append(byte if j == 0 else f"CASE WHEN ({z}) >> {7 * j} > 0 THEN {byte} ELSE '' END")
    return " || ".join(parts)


# The routed log: poison kind, the first broken rule, and the value's bytes as hex.
_ROUTED = f"""
  SELECT *,
         CASE WHEN poison THEN NULL
              WHEN text NOT IN ('click', 'purchase', 'signup', 'view') THEN 'unknown event type'
              WHEN extract(hour FROM createdAt) < 12 THEN 'created before noon' END AS broken,
         CASE WHEN event_id % 97 = 0 THEN 'raw_text' WHEN event_id % 89 = 0 THEN 'null'
              WHEN event_id % 83 = 0 THEN 'header_only' WHEN event_id % 79 = 0 THEN 'truncated' END AS poison_kind
  FROM ({MESSAGES}) m
"""

_FRAME = "'0000000001'"
_ID_FIELD = f"{_varint_hex('2 * strlen(id)')} || hex(id)"
_FULL_HEX = (f"{_FRAME} || {_ID_FIELD} || {_varint_hex('2 * strlen(text)')} || hex(text) || "
             f"{_varint_hex('2 * epoch_ms(createdAt)')}")
_DLT = f"""
  SELECT *,
         CASE poison_kind WHEN 'raw_text' THEN hex('not avro ' || id) || 'FF' || repeat('2D', 70) WHEN 'null' THEN NULL
                          WHEN 'header_only' THEN {_FRAME}
                          WHEN 'truncated' THEN {_FRAME} || {_ID_FIELD}
                          ELSE {_FULL_HEX} END AS value_hex,
         coalesce(broken, 'value is not a framed message') AS failure
  FROM ({_ROUTED}) r
  WHERE poison OR broken IS NOT NULL
"""
_CTRL = "chr(0) || chr(0) || chr(0) || chr(0) || chr(1)"

SQL: dict[str, str] = {
    "window_counts_batch": _hour_counts(),
    "decode_permissive": f"""
  SELECT id, text, createdAt, {TOPIC} AS topic, partition, event_id AS "offset", createdAt AS "timestamp"
  FROM ({MESSAGES}) m WHERE NOT poison
""",
    "encode_roundtrip": f"SELECT id, text, createdAt FROM ({MESSAGES}) m",
    "encode_roundtrip_documents": """
  SELECT CAST(doc_id AS VARCHAR) AS id,
         CAST(length(text) AS INTEGER) AS n_chars,
         CAST(strlen(text) AS INTEGER) AS n_bytes,
         sha256(text) AS text_sha256,
         make_timestamp(doc_id * 1000000) AS createdAt
  FROM documents
""",
    "decode_metrics": f"""
  SELECT rb AS batch, CAST(count(*) AS BIGINT) AS received,
         CAST(count(*) FILTER (WHERE poison) AS BIGINT) AS skipped
  FROM ({_staged(3)}) s GROUP BY rb
""",
    "window_counts_append": _APPEND,
    "window_counts_upsert": _hour_counts(),
    "upsert_table_read": _hour_counts() + " ORDER BY window_start, text",
    "late_data": _LATE + """
  SELECT date_trunc('hour', createdAt) AS window_start, we AS window_end, text,
         CAST(count(*) AS BIGINT) AS count
  FROM k WHERE wm IS NULL OR we > wm GROUP BY ALL
""",
    "resume_from_checkpoint": _APPEND,
    "parquet_inspect": f"SELECT * FROM ({_APPEND}) a ORDER BY window_start, text LIMIT 100",
    "processed_ok": f"""
  SELECT id, text, createdAt, partition, event_id AS "offset" FROM ({_ROUTED}) r WHERE NOT poison AND broken IS NULL
""",
    "dead_letter_table": f"""
  SELECT 'messages-dlt' AS dlt_topic, partition AS dlt_partition, CAST(user_id AS VARCHAR) AS key, id AS own_header,
         'messages' AS original_topic, partition AS original_partition, event_id AS original_offset,
         'message-consumers' AS consumer_group, createdAt AS original_timestamp,
         CASE WHEN poison THEN 'logweave.errors.UndecodableRecord' ELSE 'logweave.errors.InvalidRecord' END AS exception_fqcn,
         CASE WHEN NOT poison THEN 'logweave.errors.BrokenRule' END AS cause_fqcn,
         failure AS exception_message, value_hex
  FROM ({_DLT}) d
""",
    "dead_letter_inspect": f"""
  SELECT 'messages-dlt' AS dlt_topic, partition AS dlt_partition, event_id AS dlt_offset, 'messages' AS original_topic,
         partition AS original_partition, event_id AS original_offset, 'message-consumers' AS consumer_group,
         CASE WHEN poison THEN 'logweave.errors.UndecodableRecord' ELSE 'logweave.errors.BrokenRule' END AS root_exception,
         failure AS message,
         CASE WHEN poison_kind IS NULL THEN 'message' WHEN poison_kind = 'null' THEN 'null' ELSE 'raw' END AS value_kind,
         CAST(strlen(value_hex) // 2 AS INTEGER) AS value_bytes,
         lower(left(value_hex, 128)) AS preview_hex,
         CASE poison_kind WHEN 'raw_text' THEN 'not avro ' || id || chr(65533) || repeat('-', 54 - strlen(id)::INTEGER)
                          WHEN 'header_only' THEN {_CTRL}
                          WHEN 'truncated' THEN {_CTRL} || chr(CAST(2 * strlen(id) AS INTEGER)) || id END AS preview_text,
         CASE WHEN NOT poison THEN id END AS message_id,
         CASE WHEN NOT poison THEN text END AS message_text,
         CASE WHEN NOT poison THEN createdAt END AS message_created_at
  FROM ({_DLT}) d
""",
}
SQL["dead_letter_stream"] = SQL["dead_letter_table"]

# Resends (see sources/fixtures.py): a copy in the same batch is always dropped; one in the next batch
# is dropped while its first copy's state lives, and a row at or before the watermark in any case.
_ARRIVED = f"""
  WITH m AS (SELECT * FROM ({_staged(4)}) s WHERE NOT poison),
  sent AS (SELECT *, createdAt AS sent_at, rb AS in_batch, FALSE AS again FROM m
    UNION ALL SELECT *, createdAt + INTERVAL 7 DAY, rb + 1, TRUE FROM m WHERE event_id % 5 = 0 AND event_id % 7 <> 0 AND rb < 3),
  clock AS (SELECT createdAt AS t, rb AS b FROM m UNION ALL SELECT createdAt + INTERVAL 30 MINUTE, rb FROM m WHERE event_id % 7 = 0
    UNION ALL SELECT sent_at, in_batch FROM sent WHERE again),
  wm AS (SELECT b, max(max(t)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 HOUR AS wm FROM clock GROUP BY b)
"""
SQL["dedupe_by_id"] = _ARRIVED + """
  SELECT id, text, createdAt FROM sent JOIN wm ON b = in_batch
  WHERE (wm IS NULL OR sent_at > wm) AND (NOT again OR createdAt + INTERVAL 2 HOUR <= wm)
"""
SQL["open_windows"] = f"SELECT * FROM ({_hour_counts()}) c WHERE window_end > {_FINAL_WATERMARK}"
SQL["log_offset_range"] = f"""
  SELECT CASE WHEN event_id < lo + (partition + 1) * span // 10 THEN 0 WHEN event_id < lo + (partition + 6) * span // 10 THEN 1 ELSE 2 END AS slice,
         id, text, createdAt, partition, event_id AS "offset"
  FROM ({MESSAGES}) m, (SELECT min(event_id) AS lo, max(event_id) - min(event_id) + 1 AS span FROM events) bounds WHERE NOT poison
"""
SQL["fan_out"] = f"""
  WITH r AS (SELECT *, date_trunc('hour', createdAt) AS hour FROM ({_ROUTED}) x),
  ok AS (SELECT hour, text AS what, CAST(count(*) AS BIGINT) AS n FROM r WHERE NOT poison AND broken IS NULL GROUP BY ALL)
  SELECT 'messages' AS target, * FROM ok UNION ALL SELECT 'counts', * FROM ok
  UNION ALL SELECT 'dead_letters', hour, coalesce(broken, 'value is not a framed message'), CAST(count(*) AS BIGINT)
  FROM r WHERE poison OR broken IS NOT NULL GROUP BY ALL
"""
SQL["watermark_progress"] = _LATE + """
  SELECT mx.arrival AS batch, mx.mx AS max_event_time, wm.wm AS watermark FROM mx JOIN wm USING (arrival)
"""
