"""The same results in plain SQL over the given tables, one text per query."""

from __future__ import annotations

# Pieces that several texts share.

_ROW_BYTES_LINEITEM = "68 + strlen(l_returnflag) + strlen(l_linestatus)"
_ROW_BYTES_ORDERS = "32 + strlen(o_orderstatus) + strlen(o_orderpriority)"

_ANSWERED = """
  SELECT conv_id, turn, text, 'r' || conv_id || '-' || turn AS request_id,
         greatest(0, CAST(ceil(length(text) / 40.0) AS INTEGER) - 1) AS last
  FROM conversations WHERE role = 'assistant'
"""

_DELTAS = f"""
  SELECT *, substr(text, CAST(k * 40 + 1 AS INTEGER), 40) AS delta
  FROM (SELECT *, unnest(generate_series(0, last)) AS k FROM ({_ANSWERED}) a) b
"""

# End of every session (sequence number of its last message that is read).
_ENDS = """
  SELECT conv_id, max(turn) AS last_turn,
         CASE WHEN max(turn) >= 1 AND conv_id % 11 = 0 THEN 16
              WHEN max(turn) >= 2 AND conv_id % 7 = 0 THEN 26
              WHEN max(turn) >= 3 AND conv_id % 2 = 0 THEN 35 END AS end_seq
  FROM conversations GROUP BY conv_id
"""

_MESSAGES = f"""
  SELECT c.conv_id AS session_id, c.turn * 10 + nth AS seq, e.end_seq,
         CASE nth WHEN 0 THEN CASE WHEN c.turn = 0 THEN 'created' ELSE 'unknown' END
                 WHEN 1 THEN 'audio' WHEN 2 THEN 'audio' WHEN 3 THEN 'unknown' WHEN 4 THEN 'audio'
                 WHEN 5 THEN CASE WHEN c.turn = 3 AND c.conv_id % 2 = 0 THEN 'finished' ELSE 'done' END
                 WHEN 6 THEN CASE WHEN c.turn = 2 AND c.conv_id % 7 = 0 THEN 'close'
                                  WHEN c.turn = 1 AND c.conv_id % 11 = 0 THEN 'error'
                                  ELSE 'other' END
                 WHEN 7 THEN CASE WHEN c.turn = 1 THEN 'invalid' ELSE 'unknown' END
                 ELSE 'ignored' END AS event_class,
         CASE nth WHEN 1 THEN c.text WHEN 2 THEN CAST(c.turn AS VARCHAR)
                 WHEN 4 THEN '' END AS piece,
         nth = 4 AND c.conv_id % 13 = 5 AND c.turn = 1 AS bad
  FROM (SELECT *, unnest(generate_series(0, 9)) AS nth FROM conversations) c
  JOIN ({_ENDS}) e ON c.conv_id = e.conv_id
"""

_READ = f"SELECT * FROM ({_MESSAGES}) m WHERE end_seq IS NULL OR seq <= end_seq"


def _audio(part: int) -> str:
    good = "CASE WHEN bad THEN 0 ELSE strlen(piece) END"
    return f"""
      SELECT session_id, CAST(seq // {part} AS BIGINT) AS part, CAST(sum({good}) AS BIGINT) AS n_bytes,
             CAST(sum({good}) AS DOUBLE) / 48000 AS seconds,
             CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
             md5(string_agg(CASE WHEN bad THEN '' ELSE piece END, '' ORDER BY seq)) AS audio_md5
      FROM ({_READ}) r WHERE event_class = 'audio' GROUP BY session_id, seq // {part}
    """


_LATE = f"""
  SELECT session_id, count(*) AS n_late FROM ({_MESSAGES}) m WHERE seq > end_seq GROUP BY session_id
"""

_LIFECYCLE = f"""
  SELECT conv_id AS session_id, TRUE AS opened,
         coalesce(end_seq = 35, FALSE) AS finished,
         coalesce(end_seq = 26, FALSE) AS closed_by_server,
         coalesce(end_seq = 16, FALSE) AS error,
         CAST(coalesce(end_seq, last_turn * 10 + 9) AS BIGINT) AS last_seq
  FROM ({_ENDS}) e
"""

_ORDERS_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_URL_PARTS = """
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)', 1) AS site,
         regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)', 2) AS path,
         regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query
"""

ORACLES = {
    "a1_conform_to_catalog": """
        SELECT o_orderkey, o_totalprice, o_orderdate,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS INTEGER) END AS code,
               nullif(o_orderstatus, 'F') AS status,
               concat_ws(',', CASE WHEN o_orderkey % 3 <> 0 THEN 'code' END,
                              CASE WHEN o_orderstatus = 'F' THEN 'status' END) AS bad_columns
        FROM orders""",
    "a2_snapshot_session": """
        SELECT 'lineitem' AS "table", 'l_returnflag=R' AS "partition", count(*) AS record_count,
               CAST(10 AS BIGINT) AS n_columns, CAST(1 AS BIGINT) AS n_keys, 'normal' AS status
        FROM lineitem WHERE l_returnflag = 'R'""",
    "a2_read_session": f"""
        SELECT CAST(1 AS INTEGER) AS version, 'o_orderstatus=O' AS "partition", count(*) AS record_count,
               CAST(sum({_ROW_BYTES_ORDERS}) AS BIGINT) AS raw_size, 'normal' AS status
        FROM orders WHERE o_orderstatus = 'O'""",
    "a3_read_partition": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag, l_linestatus
        FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "a4_read_row_range": f"""
        SELECT {_ORDERS_COLUMNS} FROM (
          SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)
        WHERE rn >= n // 3 AND rn < n // 3 + n // 5""",
    "a4_read_row_range_two_keys": f"""
        SELECT {_ORDERS_COLUMNS} FROM (
          SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS rn,
                 count(*) OVER () AS n FROM orders)
        WHERE rn >= n // 10 AND rn < n // 10 + n // 2""",
    "a4_read_row_range_top": """
        SELECT * FROM events ORDER BY event_id LIMIT 500 OFFSET 100""",
    "a5_decode_frames": f"""
        SELECT {_ORDERS_COLUMNS}, CAST(NULL AS VARCHAR) AS frame_error FROM orders""",
    "a6_map_batches": """
        SELECT count(*) AS n_rows, TRUE AS sized FROM orders""",
    "b1_assign_blocks": """
        SELECT CAST(l_orderkey % 8 AS INTEGER) AS block_id, count(*) AS n FROM lineitem GROUP BY 1""",
    "b2_stage_blocks": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate, o_orderkey % 8 AS block_id
        FROM orders""",
    "b3_copy_partition": f"""
        SELECT CAST(l_orderkey % 8 AS INTEGER) AS block_id, count(*) AS record_count,
               CAST(sum({_ROW_BYTES_LINEITEM}) AS BIGINT) AS raw_size
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "b3_commit_upload": f"""
        SELECT o_orderkey % 8 AS block_id, CAST(1 AS INTEGER) AS version,
               count(*) AS record_count, CAST(sum({_ROW_BYTES_ORDERS}) AS BIGINT) AS raw_size
        FROM orders GROUP BY 1""",
    "b3_commit_resent_blocks": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 4 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice
        FROM orders""",
    "b4_append": f"""
        SELECT {_ORDERS_COLUMNS} FROM orders""",
    "b4_overwrite": f"""
        SELECT {_ORDERS_COLUMNS} FROM orders WHERE o_orderkey % 2 = 0""",
    "b4_overwrite_partition": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_custkey END AS o_custkey,
               o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 200000""",
    "b4_earlier_version": f"""
        SELECT {_ORDERS_COLUMNS} FROM orders WHERE o_orderkey % 2 = 1""",
    "b5_latest_blocks": """
        SELECT user_id AS upload_id, event_type AS block_id, event_id, ts, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                       ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "b6_oversize_guard": """
        SELECT doc_id, CASE WHEN strlen(text) > 4096 THEN 'text' END AS oversize_field FROM documents""",
    "b7_chunk_ledger": """
        SELECT doc_id, CAST(k AS INTEGER) AS chunk_index,
               CAST(octet_length(chunk) AS INTEGER) AS n_bytes, md5(chunk) AS checksum
        FROM (SELECT doc_id, k, array_slice(encode(text), k * 4096 + 1, k * 4096 + 4096) AS chunk
              FROM (SELECT *, unnest(generate_series(0, greatest(0, (strlen(text) + 4095) // 4096 - 1))) AS k
                    FROM documents))""",
    "b7_payload_checksum": """
        SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n_bytes, md5(text) AS checksum FROM documents""",
    "b8_verify_frames": """
        SELECT * FROM (VALUES ('whole', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE)),
                              ('changed', CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(0 AS DOUBLE)))
          t(state, min_bad_chunks, max_bad_chunks, share_ok)""",
    "b9_stream_to_blocks": """
        SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1""",
    "c1_canonical_url": f"""
        WITH messy AS (
          SELECT page_id, split_part(url, '#', 1)
                 || CASE WHEN contains(split_part(url, '#', 1), '?') THEN '&' ELSE '?' END
                 || 'b=2&a=1&b=&page=' || page_id || '&x=a+b%2Fc&&z#part' AS url
          FROM pages),
        parts AS ({_URL_PARTS} FROM messy),
        pieces AS (
          SELECT page_id, unnest(string_split(query, '&')) AS piece,
                 generate_subscripts(string_split(query, '&'), 1) AS nth FROM parts),
        pairs AS (
          SELECT page_id, nth,
                 url_decode(replace(split_part(piece, '=', 1), '+', ' ')) AS key,
                 CASE WHEN contains(piece, '=')
                      THEN url_decode(replace(substr(piece, instr(piece, '=') + 1), '+', ' ')) ELSE '' END AS value
          FROM pieces WHERE piece <> ''),
        kept AS (SELECT page_id, key, arg_max(value, nth) AS value FROM pairs GROUP BY page_id, key),
        joined AS (
          SELECT page_id, replace(string_agg(CASE WHEN value = '' THEN key ELSE key || '=' || value END,
                                             '&' ORDER BY key), ' ', '%20') AS canonical_query
          FROM kept GROUP BY page_id)
        SELECT p.page_id, p.site, CASE WHEN p.path = '' THEN '/' ELSE p.path END AS path, j.canonical_query,
               CASE WHEN p.path = '' THEN '/' ELSE p.path END || '?' || j.canonical_query AS canonical
        FROM parts p JOIN joined j ON p.page_id = j.page_id""",
    "c1_canonical_url_dedupe": f"""
        WITH parts AS ({_URL_PARTS} FROM (SELECT page_id, regexp_replace(url, '/[0-9]+', '/n') AS url FROM pages)),
        shown AS (SELECT page_id, site,
                         CASE WHEN path = '' THEN '/' ELSE path END
                         || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical FROM parts)
        SELECT min(page_id) AS page_id, site, canonical FROM shown GROUP BY site, canonical""",
    "c2_label_counts": """
        SELECT label, CASE WHEN label IS NULL THEN 0 ELSE count(*) END AS n,
               CASE WHEN label IS NULL THEN count(*) ELSE 0 END AS n_unmatched
        FROM (SELECT nullif(regexp_extract(url, '^https?://(www|blog|m)[.]', 1), '') AS label FROM pages)
        GROUP BY label""",
    "d1_collect_messages": """
        SELECT conv_id, CAST(turn // 4 AS BIGINT) AS part,
               CAST(to_json(list({'content': text, 'role': role} ORDER BY turn)) AS VARCHAR) AS messages
        FROM conversations GROUP BY conv_id, turn // 4""",
    "d2_history_pairs": """
        SELECT conv_id, turn, text AS "user", bot FROM (
          SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS bot
          FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'user' AND next_role = 'assistant'""",
    "d3_build_requests": """
        WITH said AS (
          SELECT conv_id, list({'content': text, 'role': role} ORDER BY turn) AS messages,
                 list({'bot': '', 'user': text} ORDER BY turn) AS history
          FROM conversations GROUP BY conv_id),
        shown AS (
          SELECT conv_id, CASE conv_id % 4
              WHEN 0 THEN CAST(to_json({'prompt': 'p' || conv_id}) AS VARCHAR)
              WHEN 1 THEN CAST(to_json({'messages': messages}) AS VARCHAR)
              WHEN 2 THEN CAST(to_json({'history': history, 'prompt': 'p' || conv_id}) AS VARCHAR)
            END AS input FROM said)
        SELECT conv_id, CAST(0 AS BIGINT) AS part,
               '{"input":' || input || ',"model":"model-a","parameters":{"stream":true,"temperature":0.7}}' AS body,
               CASE WHEN input IS NULL THEN 'json:prompt_and_messages_missing' END AS error
        FROM shown""",
    "d3_conversation_requests": """
        WITH parts AS (
          SELECT conv_id, CAST(turn // 4 AS BIGINT) AS part,
                 CAST(to_json(list({'content': text, 'role': role} ORDER BY turn)) AS VARCHAR) AS listed
          FROM conversations GROUP BY conv_id, turn // 4),
        placed AS (SELECT *, max(part) OVER (PARTITION BY conv_id) AS last FROM parts)
        SELECT conv_id, part,
               CASE WHEN part = 0 THEN '{"input":{"messages":[' ELSE ',' END
               || substr(listed, 2, length(listed) - 2)
               || CASE WHEN part = last THEN ']},"model":"model-a","parameters":{}}' ELSE '' END AS body
        FROM placed""",
    "d3_requests_with_options": """
        WITH said AS (
          SELECT conv_id, min_by(text, turn) AS said, count(*) AS n,
                 CAST(to_json(list(CASE WHEN role = 'assistant'
                   THEN to_json({'content': text, 'role': role, 'tool_call_id': 'c' || turn})
                   ELSE to_json({'content': text, 'role': role}) END ORDER BY turn)) AS VARCHAR) AS listed
          FROM conversations GROUP BY conv_id)
        SELECT conv_id, CAST(0 AS BIGINT) AS part,
               '{"input":{"messages":' || listed
               || CASE WHEN n > 2 THEN ',"prompt":' || CAST(to_json(said) AS VARCHAR) ELSE '' END
               || '},"model":"model-a","parameters":{"max_tokens":' || n || ',"top_k":' || length(said) || '}}' AS body
        FROM said""",
    "d4_parse_parameters": """
        SELECT conv_id, turn,
               CASE WHEN conv_id % 6 = 0 THEN TRUE END AS stream,
               CASE WHEN conv_id % 6 = 0 THEN CAST(0.7 AS DOUBLE) END AS temperature,
               CASE WHEN conv_id % 6 = 2 THEN CAST(1 AS DOUBLE) END AS top_p,
               CASE conv_id % 6 WHEN 0 THEN turn END AS top_k,
               CASE WHEN conv_id % 6 = 5 THEN FALSE END AS enable_search,
               CAST(NULL AS VARCHAR) AS customized_model_id,
               CASE WHEN conv_id % 6 = 5 THEN 'message' END AS result_format,
               CAST(NULL AS BOOLEAN) AS incremental_output,
               CASE WHEN conv_id % 6 = 1 THEN conv_id END AS max_tokens,
               CAST(NULL AS DOUBLE) AS repetition_penalty,
               CASE conv_id % 6 WHEN 0 THEN '["a","b"]' WHEN 2 THEN '[]' END AS stop_strings,
               CASE WHEN conv_id % 6 = 1 THEN '[[1,2],[' || turn || ']]' END AS stop_ids,
               CASE conv_id % 6 WHEN 3 THEN 'json:top_k' WHEN 4 THEN 'json:stream' END AS error
        FROM conversations""",
    "d5_build_tool_specs": """
        WITH last AS (
          SELECT p_brand, p_name, arg_max(p_size, p_partkey) AS size, arg_max(lower(p_type), p_partkey) AS kind
          FROM part GROUP BY p_brand, p_name)
        SELECT p_brand AS tool, CAST(0 AS BIGINT) AS part,
               '{"function":{"description":"tool of ' || p_brand || '","name":"' || p_brand || '","parameters":{'
               || string_agg('"' || p_name || '":{"properties":{"description":"size ' || size
                             || '","type":"' || kind || '"},"type":"object"}', ',' ORDER BY p_name)
               || '}},"type":"function"}' AS spec
        FROM last GROUP BY p_brand""",
    "e1_sse_data_lines": f"""
        SELECT request_id, CAST(k AS BIGINT) AS chunk_seq, CAST(2 AS BIGINT) AS line_no, delta AS content
        FROM ({_DELTAS}) d""",
    "e1_sse_data_lines_reassembled": f"""
        SELECT request_id, CAST(k * 4 + 2 AS BIGINT) AS line_no, delta AS content FROM ({_DELTAS}) d""",
    "e2_parse_responses": f"""
        WITH checked AS (
          SELECT *, CASE WHEN k <> 0 THEN NULL
                         WHEN conv_id % 10 = 7 THEN 'json:usage'
                         WHEN conv_id % 10 = 3 THEN 'json:text'
                         WHEN conv_id % 10 = 5 AND last > 0 THEN 'json:choice'
                         WHEN conv_id % 10 = 9 THEN 'json:choice' END AS error
          FROM ({_DELTAS}) d)
        SELECT request_id, CAST(k AS BIGINT) AS chunk_seq, error,
               CASE WHEN error IS NULL THEN delta END AS content,
               CASE WHEN error IS NULL THEN CAST(turn + k + 11 AS BIGINT) END AS total_tokens
        FROM checked""",
    "e3_assemble_answers": f"""
        SELECT request_id, CAST(0 AS BIGINT) AS part, text AS answer,
               CASE WHEN conv_id % 3 = 0 AND last >= 1 THEN 'thinking ' || turn ELSE '' END AS reasoning
        FROM ({_ANSWERED}) a""",
    "e3_assemble_answers_parts": f"""
        SELECT request_id, CAST(k // 4 AS BIGINT) AS part, string_agg(delta, '' ORDER BY k) AS answer,
               max(CASE WHEN conv_id % 3 = 0 AND k = 1 THEN 'thinking ' || turn ELSE '' END) AS reasoning
        FROM ({_DELTAS}) d GROUP BY request_id, k // 4""",
    "e3_assemble_answers_compat": f"""
        SELECT request_id, CAST(0 AS BIGINT) AS part,
               CASE WHEN conv_id % 3 = 0 AND last >= 1 THEN substr(text, 1, 80) ELSE text END AS answer,
               CASE WHEN conv_id % 3 = 0 AND last >= 1 THEN 'thinking ' || turn ELSE '' END AS reasoning
        FROM ({_ANSWERED}) a""",
    "e4_final_usage": f"""
        SELECT request_id, CAST(turn + 10 AS INTEGER) AS input_tokens, CAST(last + 1 AS INTEGER) AS output_tokens,
               CAST(turn + last + 11 AS INTEGER) AS total_tokens,
               CASE WHEN conv_id % 3 = 0 THEN CAST(last + 1 AS INTEGER) END AS reasoning_tokens,
               CAST(turn AS INTEGER) AS cached_tokens
        FROM ({_ANSWERED}) a""",
    "e5_explode_tool_calls": f"""
        SELECT request_id, CAST(0 AS INTEGER) AS call_index, 'call-' || turn AS call_id, 'function' AS type,
               'lookup' AS name, arg, CASE arg WHEN 'city' THEN 'c' || conv_id ELSE 'd' || turn END AS value
        FROM ({_ANSWERED}) a, (VALUES ('city'), ('day')) t(arg) WHERE conv_id % 4 = 1""",
    "f1_session_commands": """
        WITH cmds AS (
          SELECT conv_id AS session_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS cmd_seq,
                 'input_text_buffer.append' AS type, text FROM conversations
          UNION ALL SELECT conv_id, 0, 'session.update', NULL FROM conversations GROUP BY conv_id
          UNION ALL SELECT conv_id, count(*) + 1, 'session.finish', NULL FROM conversations GROUP BY conv_id),
        named AS (SELECT *, 'event_' || sha256(session_id || ':' || cmd_seq) AS event_id FROM cmds)
        SELECT session_id, cmd_seq, event_id, type,
               CASE type
                 WHEN 'session.update' THEN CAST(to_json({'event_id': event_id, 'session': {
                     'mode': 'server_commit', 'response_format': 'pcm', 'sample_rate': 24000, 'voice': 'voice-a'},
                     'type': type}) AS VARCHAR)
                 WHEN 'session.finish' THEN CAST(to_json({'event_id': event_id, 'type': type}) AS VARCHAR)
                 ELSE CAST(to_json({'event_id': event_id, 'text': text, 'type': type}) AS VARCHAR) END AS payload
        FROM named""",
    "f2_route_events": f"""
        SELECT event_class, count(*) AS n,
               count(CASE WHEN event_class = 'audio' THEN 1 END) AS n_deltas
        FROM ({_MESSAGES}) m GROUP BY event_class""",
    "f3_until_finished": f"""
        SELECT session_id, seq, event_class FROM ({_READ}) r""",
    "f4_assemble_audio": _audio(16),
    "f4_session_audio": _audio(16),
    "f4_audio_sizes": f"""
        SELECT session_id, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
               CAST(sum(n_bytes) AS DOUBLE) / 48000 AS seconds, CAST(sum(n_bad) AS BIGINT) AS n_bad
        FROM ({_audio(16)}) a GROUP BY session_id""",
    "f5_session_lifecycle": _LIFECYCLE,
    "f5_late_events": _LATE,
    "f6_stream_sessions_audio": _audio(32),
    "f6_stream_sessions_belated_audio": _audio(32),
    "f6_stream_sessions_lifecycle": _LIFECYCLE,
    "f6_stream_sessions_late": _LATE,
    "g1_parse_log_lines": """
        SELECT event_id, CASE WHEN good THEN date_trunc('milliseconds', ts) END AS ts,
               CASE WHEN good THEN 'ThreadId(' || (user_id % 8) || ')' END AS thread,
               CASE WHEN good THEN CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END END AS level,
               CASE WHEN good THEN 'app::' || event_type END AS module,
               CASE WHEN good THEN props END AS message,
               CASE WHEN NOT good THEN 'log:format' END AS error
        FROM (SELECT *, event_id % 10 <> 3 AS good FROM events)""",
    "g2_retain_days": """
        SELECT event_id, ts FROM (
          SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) AS day_rank FROM events)
        WHERE day_rank <= 7""",
    "g2_retain_partitions": """
        SELECT event_id, ts FROM (
          SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) AS day_rank FROM events)
        WHERE day_rank <= 7""",
    "g3_classify_errors": """
        SELECT CASE event_id % 12
                 WHEN 0 THEN 'response' WHEN 1 THEN 'network' WHEN 2 THEN 'http_build' WHEN 3 THEN 'url_parse'
                 WHEN 4 THEN 'header_value' WHEN 5 THEN 'json' WHEN 6 THEN 'header_text' WHEN 7 THEN 'hmac_key'
                 WHEN 8 THEN 'region' WHEN 9 THEN 'arrow' ELSE 'other' END AS error_class, count(*) AS n
        FROM events GROUP BY 1""",
    "c1_normal_urls": r"""
        WITH rough AS (
          SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
                 regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || ['', ':443', ':80', ':8080'][page_id % 4 + 1] AS auth,
                 ['', '/x/..', '/./%2e', '/y/%2E%2e/z/.', '/%7e%C3%a9', '/a/../..'][page_id % 6 + 1]
                 || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
                 regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query FROM pages),
        cut AS (
          SELECT *, string_split(path, '/')[2:] AS segs, lower(string_split(path, '/')[-1]) AS tail FROM rough),
        folded AS (
          SELECT page_id, query,
                 regexp_replace(auth, CASE scheme WHEN 'http' THEN ':80$' ELSE ':443$' END, '') AS site,
                 list_reduce(
                   list_transform(segs, lambda s: [s]),
                   lambda a, s: CASE WHEN lower(s[1]) IN ('.', '%2e') THEN a
                     WHEN lower(s[1]) IN ('..', '.%2e', '%2e.', '%2e%2e') THEN a[1:greatest(len(a) - 1, 0)]
                     ELSE list_concat(a, s) END,
                   CAST([] AS VARCHAR[])) AS kept, tail FROM cut),
        shown AS (
          SELECT page_id, site, query AS canonical_query,
                 replace('/' || array_to_string(
                   CASE WHEN tail IN ('.', '%2e', '..', '.%2e', '%2e.', '%2e%2e') THEN list_append(kept, '') ELSE kept END,
                   '/'), '%7e%C3%a9', '%7E%C3%A9') AS path FROM folded)
        SELECT *, path || CASE WHEN canonical_query = '' THEN '' ELSE '?' || canonical_query END AS canonical FROM shown""",
    "d1_turns_without_place": """
        SELECT CASE WHEN (conv_id * 7 + turn) % 11 NOT IN (3, 8) THEN conv_id END AS conv_id,
               CASE WHEN (conv_id * 7 + turn) % 11 NOT IN (5, 8) THEN turn END AS turn, role, text, 'place' AS error
        FROM conversations WHERE (conv_id * 7 + turn) % 11 IN (3, 5, 8)""",
    "d1_turn_places": """
        SELECT CASE (conv_id * 7 + turn) % 11 WHEN 3 THEN 'key' WHEN 5 THEN 'position' WHEN 8 THEN 'both' END AS missing,
               count(*) AS n
        FROM conversations GROUP BY 1""",
    "f3_until_finished_without_place": f"""
        WITH seen AS (SELECT *, (session_id * 7 + seq) % 11 AS kind FROM ({_MESSAGES}) m),
        ends AS (
          SELECT session_id, min(seq) AS ended FROM seen
          WHERE event_class IN ('finished', 'close', 'error') AND kind NOT IN (3, 5, 8) GROUP BY session_id)
        SELECT CASE WHEN kind NOT IN (3, 8) THEN s.session_id END AS session_id,
               CASE WHEN kind NOT IN (5, 8) THEN seq END AS seq, event_class
        FROM seen s LEFT JOIN ends e ON s.session_id = e.session_id
        WHERE kind IN (3, 5, 8) OR ended IS NULL OR seq <= ended""",
    "g1_log_records": """
        WITH lines AS (
          SELECT 'log-' || least(user_id % 9, 5) AS file, event_id AS line_no, event_id % 10 NOT IN (3, 4, 7) AS head,
                 date_trunc('milliseconds', ts) AS ts, 'ThreadId(' || (user_id % 8) || ')' AS thread,
                 CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'app::' || event_type AS module,
                 CASE WHEN event_id % 10 IN (3, 4, 7) THEN repeat(' ', 4) || 'at ' || props ELSE props END AS body FROM events),
        numbered AS (SELECT *, sum(head::INT) OVER (PARTITION BY file ORDER BY line_no) AS nth FROM lines),
        placed AS (
          SELECT *, coalesce(min(line_no) FILTER (head) OVER (PARTITION BY file, nth), 0) AS first FROM numbered)
        SELECT file, CASE WHEN nth = 0 THEN min(line_no) ELSE first END AS line_no,
               CAST((line_no - first) // 4 AS BIGINT) AS part,
               max(CASE WHEN nth > 0 THEN first_value END) AS ts, max(CASE WHEN nth > 0 THEN thread1 END) AS thread,
               max(CASE WHEN nth > 0 THEN level1 END) AS level, max(CASE WHEN nth > 0 THEN module1 END) AS module,
               string_agg(body, chr(10) ORDER BY line_no) AS message, count(*) AS n_lines,
               CASE WHEN nth = 0 THEN 'log:format' END AS error
        FROM (SELECT *, min(ts) FILTER (head) OVER w AS first_value, min(thread) FILTER (head) OVER w AS thread1,
                     min(level) FILTER (head) OVER w AS level1, min(module) FILTER (head) OVER w AS module1
              FROM placed WINDOW w AS (PARTITION BY file, nth)) p
        GROUP BY file, nth, first, (p.line_no - first) // 4""",
    "g2_retain_days_undated": """
        SELECT event_id, ts FROM (
          SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC NULLS LAST) AS day_rank
          FROM (SELECT event_id, CASE WHEN event_id % 7 <> 2 THEN ts END AS ts FROM events))
        WHERE day_rank <= 7 OR ts IS NULL""",
    "g2_day_counts": """
        SELECT CASE WHEN ts IS NULL THEN 'undated' WHEN day_rank <= 7 THEN 'kept' ELSE 'removed' END AS fate, count(*) AS n
        FROM (
          SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC NULLS LAST) AS day_rank
          FROM (SELECT event_id, CASE WHEN event_id % 7 <> 2 THEN ts END AS ts FROM events))
        GROUP BY 1""",
    "b6_oversize_guard_nested": """
        SELECT doc_id, CASE WHEN octet_length(encode(text)) > 4096
                 THEN CASE WHEN doc_id % 2 = 0 THEN 'body.parts[]' ELSE 'tags{}.text' END END AS oversize_field
        FROM documents""",
}
