"""DuckDB SQL twins of `plans.queries`, over the same parquet tables.

Each string derives its input the way `plans.derive` does, then computes
the expected result with DuckDB's own JSON, hash and window functions.
"""

from __future__ import annotations

# Shared SQL fragments (mirror plans.derive).
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_PART = "CAST(user_id % 4 AS INTEGER)"
_USER_FIELDS = f"""
    CAST(user_id AS VARCHAR) AS id, event_type AS first_name,
    CAST(event_id AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS gender,
    props AS address, CAST(user_id AS VARCHAR) AS post_code,
    'u' || CAST(user_id AS VARCHAR) || '@example.com' AS email,
    'u' || CAST(user_id AS VARCHAR) AS username, {_ISO} AS dob,
    {_ISO} AS registered_date, CAST(value AS VARCHAR) AS phone,
    CAST(NULL AS VARCHAR) AS picture"""


def _user_json(drop: str | None = None) -> str:
    keys = ["id", "first_name", "last_name", "gender", "address", "post_code",
            "email", "username", "dob", "registered_date", "phone", "picture"]
    return "json_object(" + ", ".join(f"'{k}', {k}" for k in keys if k != drop) + ")::VARCHAR"


def _coded(x: str) -> str:
    """A coordinate with its length before it; a null as a dash."""
    v = f"CAST({x} AS VARCHAR)"
    return f"coalesce(length({v}) || ':' || {v}, '-')"


ORACLE: dict[str, str] = {
    "json_decode_flatten": f"""
        SELECT {_PART} AS "partition", event_id AS "offset",
               json_extract_string(props, '$.k') AS k
        FROM events""",
    "envelope_roundtrip": f"""
        SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS event_id,
               {_ISO} AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
               CAST(value AS VARCHAR) AS value, props
        FROM events""",
    "decode_reject": f"""
        WITH u AS (SELECT event_id, user_id, event_type, {_USER_FIELDS} FROM events),
        p AS (
          SELECT event_id, user_id,
            CASE event_type
              WHEN 'purchase' THEN {_user_json()}
              WHEN 'signup' THEN {_user_json('dob')}
              WHEN 'view' THEN {_user_json('email')}
              WHEN 'click' THEN left({_user_json()}, length({_user_json()}) - 1)
              ELSE '' END AS payload
          FROM u),
        c AS (
          SELECT *, CASE
              WHEN payload IS NULL OR trim(payload) = '' THEN 'empty'
              WHEN NOT json_valid(payload) THEN 'corrupt'
              WHEN json_extract_string(payload, '$.id') IS NULL
                OR json_extract_string(payload, '$.first_name') IS NULL
                OR json_extract_string(payload, '$.last_name') IS NULL
                OR json_extract_string(payload, '$.email') IS NULL
                OR json_extract_string(payload, '$.username') IS NULL
              THEN 'missing_required' END AS reject_reason
          FROM p)
        SELECT {_PART} AS "partition", event_id AS "offset",
               CASE WHEN reject_reason IN ('empty', 'corrupt') THEN NULL
                    ELSE json_extract_string(payload, '$.id') END AS id,
               CASE WHEN reject_reason IN ('empty', 'corrupt') THEN NULL
                    ELSE json_extract_string(payload, '$.email') END AS email,
               reject_reason
        FROM c""",
    "derived_id": f"""
        WITH h AS (
          SELECT event_id, md5('13:users_created' || {_coded(_PART)} || {_coded("event_id")}) AS x
          FROM events)
        SELECT event_id AS "offset",
               substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4)
               || '-' || substr(x, 17, 4) || '-' || substr(x, 21, 12) AS id
        FROM h""",
    "keyed_latest": f"""
        WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id
                 ORDER BY ts DESC, {_PART} DESC, event_id DESC) AS rn
          FROM events)
        SELECT id, first_name, last_name, gender, address, post_code, email,
               username, registered_date, phone, picture
        FROM (SELECT {_USER_FIELDS} FROM r WHERE rn = 1)""",
    "row_count": "SELECT COUNT(*) AS row_count FROM events",
}


# --- word counts -------------------------------------------------------------
def _word_count(tbl: str) -> str:
    return f"""
        SELECT word, COUNT(*) AS count
        FROM (SELECT unnest(string_split(text, ' ')) AS word FROM {tbl})
        GROUP BY word"""


ORACLE["word_count"] = _word_count("documents")
ORACLE["word_count_conversations"] = _word_count("conversations")


# --- raw profiles built and read with DuckDB's JSON functions ----------------
def _person(postcode: str, with_email: bool) -> str:
    parts = [
        "'gender', gender",
        "'name', json_object('first', first, 'last', last)",
        "'location', json_object('street', json_object('number', c_custkey, 'name', "
        "c_mktsegment || ' St'), 'city', city, 'state', r_name, 'country', n_name, "
        f"'postcode', {postcode})",
    ]
    if with_email:
        parts.append("'email', lower(first) || '.' || last || '@example.com'")
    parts += [
        "'login', json_object('username', 'user' || key)",
        "'dob', json_object('date', CAST(c_nationkey + 1950 AS VARCHAR) || '-01-15T00:00:00.000Z')",
        "'registered', json_object('date', CAST(n_regionkey + 2000 AS VARCHAR) || '-06-30T12:00:00.000Z')",
        "'phone', '+' || CAST(c_nationkey AS VARCHAR) || '-' || key",
        "'picture', json_object('medium', 'https://img.example/' || key || '.jpg')",
    ]
    return "json_object('results', json_array(json_object(" + ", ".join(parts) + ")))::VARCHAR"


_NUM_PC = "to_json(c_custkey * 10 + 7)"
_TXT_PC = "to_json('P' || key)"
_LEAVES = {  # output column -> leaf path under $.results[0]
    "first_name": "name.first", "last_name": "name.last", "gender": "gender",
    "post_code": "location.postcode", "email": "email", "username": "login.username",
    "dob": "dob.date", "registered_date": "registered.date", "phone": "phone",
    "picture": "picture.medium",
}
_ADDR = ["location.street.number", "location.street.name", "location.city",
         "location.state", "location.country"]
_NULLABLE = ["gender", "dob", "registered_date", "phone", "picture"]


def _jt(leaf: str) -> str:
    return f"json_type(raw, '$.results[0].{leaf}')"


def _js(leaf: str) -> str:
    return f"CASE WHEN ok THEN json_extract_string(raw, '$.results[0].{leaf}') END"


_ALL = _ADDR + list(_LEAVES.values())
_REQ = _ADDR + [p for k, p in _LEAVES.items() if k not in _NULLABLE]
_PROFILE_RAW = f"""
    j AS (
      SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey, n_name, n_regionkey, r_name,
             split_part(c_name, '#', 1) AS first, split_part(c_name, '#', 2) AS last,
             CAST(c_custkey AS VARCHAR) AS key,
             CASE WHEN c_acctbal < 0 THEN NULL
                  WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'male'
                  ELSE 'female' END AS gender,
             CASE WHEN c_acctbal > 9000 THEN NULL ELSE n_name END AS city,
             n_regionkey IN (0, 2, 4) AS even, c_mktsegment = 'HOUSEHOLD' AS household
      FROM customer JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey),
    f AS (
      SELECT c_custkey, c_acctbal, CASE
          WHEN even AND household THEN {_person(_NUM_PC, False)}
          WHEN even THEN {_person(_NUM_PC, True)}
          WHEN household THEN {_person(_TXT_PC, False)}
          ELSE {_person(_TXT_PC, True)} END AS body
      FROM j),
    r AS (
      SELECT c_custkey, CASE
          WHEN c_acctbal >= 0 AND c_acctbal < 50 THEN '{{"results": []}}'
          WHEN c_acctbal >= 50 AND c_acctbal < 60 THEN left(body, 40)
          ELSE body END AS raw
      FROM f),
    p AS (SELECT c_custkey, raw, json_valid(raw) AS ok FROM r),
    u AS (
      SELECT md5('8:customer' || {_coded("c_custkey")}) AS x,
        {", ".join(f"{_js(p)} AS {k}" for k, p in _LEAVES.items())},
        {" || ', ' || ".join([_js(_ADDR[0]) + " || ' ' || " + _js(_ADDR[1])] + [_js(a) for a in _ADDR[2:]])} AS address,
        CASE WHEN NOT ok THEN 'bad_json'
             WHEN json_type(raw, '$.results[0]') IS NULL THEN 'no_result'
             WHEN {" OR ".join(f"{_jt(a)} IS NULL" for a in _ALL)} THEN 'missing_field'
             WHEN {" OR ".join(f"{_jt(a)} = 'NULL'" for a in _REQ)} THEN 'null_field'
        END AS reject_reason
      FROM p)"""
_UUID = ("substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4) || '-' "
         "|| substr(x, 17, 4) || '-' || substr(x, 21, 12)")

ORACLE["profile_reshape"] = f"""
    WITH {_PROFILE_RAW}
    SELECT {_UUID} AS id, first_name, last_name, gender, address, post_code, email,
           username, dob, registered_date, phone, picture, reject_reason
    FROM u"""

ORACLE["sample_limit"] = f"""
    WITH {_PROFILE_RAW}
    SELECT {_UUID} AS id, first_name, last_name, email
    FROM u WHERE reject_reason IS NULL
    ORDER BY id LIMIT 10"""


# --- run statistics: the plain per-run window formulation --------------------
def _run_stats(limit: int, duration_s: int | None, events: str = "events") -> str:
    keep = "TRUE" if duration_s is None else (
        f"ts < min(ts) OVER (PARTITION BY user_id) + INTERVAL {duration_s} SECOND")
    return f"""
        WITH a0 AS (
          SELECT user_id AS run_id, event_id AS seq, ts, event_type <> 'error' AS ok,
                 {keep} AS inside
          FROM {events}),
        a AS (SELECT * FROM a0 WHERE inside),
        b AS (
          SELECT *, CASE WHEN ok THEN 0 ELSE 1 END AS err,
                 SUM(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY ts, seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
          FROM a),
        c AS (
          SELECT *, SUM(err) OVER (PARTITION BY run_id, grp ORDER BY ts, seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
          FROM b),
        d AS (
          SELECT *, COALESCE(MAX(streak) OVER (PARTITION BY run_id ORDER BY ts, seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_max
          FROM c)
        SELECT run_id,
               CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS messages_sent,
               CAST(SUM(err) AS BIGINT) AS errors,
               CAST(MAX(streak) AS BIGINT) AS longest_streak,
               MAX(streak) >= {limit} AS stopped
        FROM d WHERE prior_max < {limit}
        GROUP BY run_id"""


ORACLE["run_stats"] = _run_stats(3, None)
ORACLE["run_stats_limited"] = _run_stats(3, 7 * 86_400)
ORACLE["run_duration_cutoff"] = """
    SELECT run_id, seq, ok FROM (
      SELECT user_id AS run_id, event_id AS seq, event_type <> 'error' AS ok, ts,
             min(ts) OVER (PARTITION BY user_id) AS start
      FROM events)
    WHERE ts < start + INTERVAL 86400 SECOND"""


ORACLE["log_latency"] = """
    WITH l AS (
      SELECT json_object(
          'timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'),
          'level', CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END,
          'function_name', event_type,
          'latency', printf('%.3fs', value / 10)) AS line
      FROM events),
    p AS (
      SELECT json_extract_string(line, '$.function_name') AS function_name,
             json_extract_string(line, '$.level') AS level,
             TRY_CAST(regexp_extract(json_extract_string(line, '$.latency'),
                      '^([0-9]+(\\.[0-9]+)?)s$', 1) AS DOUBLE) AS latency_s
      FROM l)
    SELECT function_name, COUNT(*) AS calls,
           CAST(SUM(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
           CAST(round(avg(latency_s), 6) AS DECIMAL(18, 6)) AS avg_latency,
           max(latency_s) AS max_latency,
           CAST(round(quantile_cont(latency_s, 0.5), 6) AS DECIMAL(18, 6)) AS p50_latency
    FROM p WHERE latency_s IS NOT NULL
    GROUP BY function_name"""

ORACLE["enrich_dim"] = """
    SELECT e.event_id, e.event_type, e.user_id, c.c_mktsegment, n.n_name, r.r_name
    FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

ORACLE["daily_anomaly"] = """
    WITH c AS (
      SELECT event_type, CAST(date_trunc('day', ts) AS DATE) AS day, COUNT(*) AS n
      FROM events GROUP BY 1, 2)
    SELECT event_type, day, n,
           CAST(round(CASE WHEN stddev_samp(n) OVER w > 0
                 THEN (n - avg(n) OVER w) / stddev_samp(n) OVER w END, 6) AS DECIMAL(18, 6)) AS z
    FROM c WINDOW w AS (PARTITION BY event_type)"""


ORACLE["keyed_stream_upsert"] = f"""
    WITH r AS (
      SELECT *, row_number() OVER (PARTITION BY user_id
             ORDER BY ts DESC, {_PART} DESC, event_id DESC) AS rn
      FROM events WHERE event_type IN ('purchase', 'signup'))
    SELECT id, first_name, last_name, gender, address, post_code, email,
           username, registered_date, phone, picture
    FROM (SELECT {_USER_FIELDS} FROM r WHERE rn = 1)"""
ORACLE["word_count_stream"] = ORACLE["word_count"]
ORACLE["run_stats_stream"] = ORACLE["run_stats"]

# The from_json form cannot tell a missing key from a null one: it rejects
# an unreadable or empty result list and null required fields only.
ORACLE["profile_reshape_typed"] = f"""
    WITH {_PROFILE_RAW}
    SELECT {_UUID} AS id, first_name, last_name, gender, address, post_code, email,
           username, dob, registered_date, phone, picture,
           CASE WHEN reject_reason IN ('bad_json', 'no_result') THEN 'no_result'
                WHEN first_name IS NULL OR last_name IS NULL OR address IS NULL
                  OR post_code IS NULL OR email IS NULL OR username IS NULL
                THEN 'null_field' END AS reject_reason
    FROM u"""

ORACLE["profile_landing_stream"] = f"""
    WITH {_PROFILE_RAW}
    SELECT first_name, last_name, gender, address, post_code, email,
           username, dob, registered_date, phone, picture, reject_reason
    FROM u"""

# The consumer's plain transform: every message gives a row; a payload that
# is not a JSON object (or is empty) gives an all-null row.
ORACLE["decode_permissive"] = f"""
    WITH u AS (SELECT event_id, user_id, event_type, {_USER_FIELDS} FROM events),
    p AS (
      SELECT CASE event_type
          WHEN 'purchase' THEN {_user_json()}
          WHEN 'signup' THEN {_user_json('dob')}
          WHEN 'view' THEN {_user_json('email')}
          WHEN 'click' THEN left({_user_json()}, length({_user_json()}) - 1)
          ELSE '' END AS payload
      FROM u),
    v AS (SELECT payload, payload <> '' AND json_valid(payload) AS ok FROM p)
    SELECT {", ".join(
        f"CASE WHEN ok THEN json_extract_string(payload, '$.{c}') END AS {c}"
        for c in ["id", "first_name", "last_name", "gender", "address", "post_code",
                  "email", "username", "registered_date", "phone", "picture"])}
    FROM v"""

ORACLE["target_row_count"] = "SELECT COUNT(DISTINCT user_id) AS row_count FROM events"
ORACLE["daily_counts_stream"] = ORACLE["daily_anomaly"]
ORACLE["keyed_two_writers"] = ORACLE["keyed_latest"]
ORACLE["word_count_complete"] = ORACLE["word_count"]
ORACLE["catalog_target"] = f"SELECT id, first_name, last_name, email FROM ({ORACLE['keyed_latest']})"
ORACLE["publish_envelopes"] = f"""
    WITH {_PROFILE_RAW}
    SELECT {_UUID} AS id, first_name, last_name, gender, address, post_code, email,
           username, registered_date, phone, picture
    FROM u WHERE reject_reason IS NULL"""
ORACLE["dead_letters"] = f"""
    WITH u AS (SELECT event_id, user_id, event_type, value, {_USER_FIELDS} FROM events),
    p AS (
      SELECT event_id, user_id, CASE
          WHEN event_type = 'purchase' AND value < 25 THEN {_user_json().replace("'email', email", "'email', username")}
          WHEN event_type = 'signup' AND value < 25 THEN {_user_json().replace("'id', id", "'id', ''")}
          WHEN event_type = 'view' THEN {_user_json('email')}
          WHEN event_type = 'click' THEN left({_user_json()}, length({_user_json()}) - 1)
          WHEN event_type NOT IN ('purchase', 'signup') THEN chr(9) || chr(10) || ' ' END AS raw,
        CASE event_type WHEN 'purchase' THEN 'bad_format' WHEN 'signup' THEN 'bad_format'
          WHEN 'view' THEN 'missing_required' WHEN 'click' THEN 'corrupt' ELSE 'empty' END AS reject_reason
      FROM u)
    SELECT {_PART} AS "partition", event_id AS "offset", raw, reject_reason
    FROM p WHERE raw IS NOT NULL"""


# --- streams that arrive late ------------------------------------------------
ORACLE["run_stats_late"] = ORACLE["run_stats"]
# An attempt is late when, as its slice arrives, the watermark (the newest time of
# the slices before, less 12 hours, in milliseconds) has passed the end of its day.
_SLICED = """
    SELECT *, max(ms) OVER (ORDER BY slice RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 12 * 3600000 AS watermark
    FROM (SELECT *, epoch_us(ts) // 1000 AS ms, (arrival - min(arrival) OVER ()) * 2
                 // (max(arrival) OVER () - min(arrival) OVER () + 1) AS slice
          FROM (SELECT *, epoch_us(ts) + (event_id * 7919 % 259200) * 1000000 AS arrival FROM events))"""
_TIMED = f"SELECT *, coalesce((ms // 86400000 + 1) * 86400000 <= watermark, false) AS is_late FROM ({_SLICED})"
ORACLE["late_attempts"] = f"""
    WITH t AS ({_TIMED}),
    s AS ({_run_stats(3, None, "(SELECT * FROM t WHERE NOT is_late)")})
    SELECT run_id, arrived, late, messages_sent, errors, longest_streak, stopped
    FROM (SELECT user_id AS run_id, COUNT(*) AS arrived, COUNT(*) FILTER (WHERE is_late) AS late FROM t GROUP BY 1)
    LEFT JOIN s USING (run_id)"""
ORACLE["dedup_stream"] = f"""
    SELECT d.id, d."offset", e.event_type FROM ({ORACLE['derived_id']}) d JOIN events e ON d."offset" = e.event_id"""
ORACLE["attempt_sessions"] = """
    WITH a AS (
      SELECT user_id AS run_id, ts, event_type <> 'error' AS ok,
             CASE WHEN ts <= lag(ts) OVER w + INTERVAL 36 HOUR THEN 0 ELSE 1 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, SUM(opens) OVER (PARTITION BY run_id ORDER BY ts) AS session FROM a)
    SELECT run_id, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS last_us, COUNT(*) AS attempts,
           COUNT(*) FILTER (WHERE ok) AS messages_sent, COUNT(*) FILTER (WHERE NOT ok) AS errors
    FROM s GROUP BY run_id, session"""
ORACLE["publish_confirmed"] = """
    SELECT user_id AS run_id, event_id AS seq,
           event_type <> 'error' AND CAST(floor(value * 200000) AS BIGINT) BETWEEN 0 AND 10000000 AS ok
    FROM events"""
ORACLE["word_count_state"] = ORACLE["word_count"]
ORACLE["daily_baseline_stream"] = """
    WITH c AS (
      SELECT event_type, CAST(date_trunc('day', ts) AS DATE) AS day, COUNT(*) AS n
      FROM events GROUP BY 1, 2)
    SELECT event_type, day, n,
           CAST(round(CASE WHEN stddev_samp(n) OVER w > 0
                 THEN (n - avg(n) OVER w) / stddev_samp(n) OVER w END, 6) AS DECIMAL(18, 6)) AS z
    FROM c WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
ORACLE["latency_sketch"] = """
    SELECT event_type AS function_name, COUNT(*) AS calls, COUNT(DISTINCT date_trunc('hour', ts)) AS hours, TRUE AS near
    FROM events GROUP BY 1"""
ORACLE["heavy_words"] = f"SELECT word, count FROM ({ORACLE['word_count']}) ORDER BY count DESC, word LIMIT 100"
ORACLE["enrich_filtered"] = ORACLE["enrich_dim"] + " WHERE e.event_type IN ('purchase', 'signup') AND e.value >= 50"
