"""DuckDB SQL equivalents of the registered queries (driver tables are pre-registered views).

Every computed column carries the same alias as on the Spark side; doubles from sums, ratios or
``exp`` are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

VIEWS = {
    "txn": """SELECT o_orderkey AS txn_id,
        date_diff('second', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) AS txn_dt,
        o_totalprice AS amount, o_custkey AS card, o_orderpriority AS product,
        CAST(o_orderstatus = 'F' AS INTEGER) AS is_fraud FROM orders""",
    "ident": """SELECT c_custkey AS card, c_name, c_mktsegment, CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS addr1,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS D1, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS D4 FROM customer""",
    "joined": """SELECT t.txn_id, t.txn_dt, t.amount, t.card, t.product, t.is_fraud,
        i.c_name, i.c_mktsegment, i.addr1, i.D1, i.D4 FROM txn t LEFT JOIN ident i ON t.card = i.card""",
    "normed": """SELECT txn_id, txn_dt, amount, card, product, is_fraud, c_name, c_mktsegment, addr1, D1,
        D4 - txn_dt / 86400.0 AS D4 FROM joined""",
    "filled": """SELECT txn_id, txn_dt, coalesce(amount, 0) AS amount, card, coalesce(product, 'unknown') AS product,
        is_fraud, coalesce(c_name, 'unknown') AS c_name, coalesce(c_mktsegment, 'unknown') AS c_mktsegment,
        coalesce(addr1, 0) AS addr1, coalesce(D1, 0) AS D1, coalesce(D4, 0) AS D4 FROM normed""",
    "prepared": """SELECT txn_id, amount, CAST(1609498925 AS BIGINT) + txn_dt AS event_timestamp,
        CAST(card AS VARCHAR) || '_' || CAST(addr1 AS VARCHAR) || '_' ||
          CAST(CAST(floor(txn_dt / 86400.0 - D1) AS BIGINT) AS VARCHAR) AS entity_id,
        product, c_name, c_mktsegment, addr1, card, round(D4, 6) AS D4, is_fraud FROM filled""",
    "ev": """SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
        CAST(event_type = 'error' AS INTEGER) AS is_fraud FROM events""",
    "scored": """SELECT *, CASE WHEN margin > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
        1.0 / (1.0 + exp(2.0 * margin)) AS p0, 1.0 / (1.0 + exp(-2.0 * margin)) AS fraud_probability,
        margin > 0 AS predicted_fraud, 1.0 / (1.0 + exp(-2.0 * margin)) > 0.4 AS is_high_risk
        FROM (SELECT *, (k - 50) / 50.0::DOUBLE AS margin FROM ev)""",
}

_ORDER = ["txn", "ident", "joined", "normed", "filled", "prepared", "ev", "scored"]


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and their dependencies, in order)."""
    needed = set(names)
    deps = {"joined": {"txn", "ident"}, "normed": {"joined"}, "filled": {"normed"},
            "prepared": {"filled"}, "scored": {"ev"}}
    changed = True
    while changed:
        changed = False
        for n in list(needed):
            for d in deps.get(n, ()):
                if d not in needed:
                    needed.add(d)
                    changed = True
    ctes = [f"{n} AS ({VIEWS[n]})" for n in _ORDER if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


SQL: dict[str, str] = {}

SQL["scan_transactions"] = with_views("SELECT * FROM txn", "txn")
SQL["scan_features"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
SQL["roundtrip_features"] = with_views("SELECT * FROM prepared", "prepared")
SQL["select_features"] = with_views("SELECT * FROM prepared", "prepared")
SQL["normalize_offsets"] = with_views("SELECT txn_id, D1, round(D4, 6) AS D4 FROM normed", "normed")
SQL["fill_missing"] = with_views(
    "SELECT txn_id, c_name, c_mktsegment, addr1, D1, round(D4, 6) AS D4 FROM filled", "filled")
SQL["event_timestamp"] = with_views(
    """SELECT txn_id, txn_dt, CAST(1609498925 AS BIGINT) + txn_dt AS event_timestamp,
    make_timestamp((1609498925 + txn_dt) * 1000000) AS event_time FROM txn""", "txn")
SQL["entity_key"] = with_views("""SELECT txn_id,
    CAST(card AS VARCHAR) || '_' || CAST(coalesce(addr1, 0) AS VARCHAR) || '_' ||
      CAST(CAST(floor(txn_dt / 86400.0 - coalesce(D1, 0)) AS BIGINT) AS VARCHAR) AS entity_id
    FROM joined""", "joined")
SQL["json_parse_flatten"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
SQL["json_pack"] = with_views("""SELECT event_id, user_id, event_type, k,
    round(fraud_probability, 6) AS fraud_probability, predicted_fraud, is_high_risk FROM scored""", "scored")
SQL["score_flags"] = with_views("""SELECT event_id, prediction, round(fraud_probability, 6) AS fraud_probability,
    predicted_fraud, is_high_risk FROM scored""", "scored")
SQL["score_from_margin"] = with_views("""SELECT event_id, round(margin, 6) AS margin, round(-margin, 6) + 0.0 AS raw0,
    round(margin, 6) AS raw1, round(p0, 6) AS p0, round(fraud_probability, 6) AS p1, prediction
    FROM scored""", "scored")
SQL["filter_known_categories"] = """WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST('0x' || substr(md5(event_id || ':1409'), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM events)
  SELECT event_id, user_id FROM e WHERE user_id IN (SELECT user_id FROM e WHERE u < 0.7)"""
SQL["quarantine_rows"] = """WITH d AS (
    SELECT event_id,
      CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS props,
      CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events)
  SELECT event_id, CASE WHEN json_valid(props) THEN CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DOUBLE) END AS k, value,
    CASE WHEN props IS NULL THEN 'null_message' WHEN NOT json_valid(props) THEN 'malformed_json'
         WHEN value IS NULL THEN 'missing_value' ELSE 'ok' END AS reason
  FROM d"""
SQL["left_join_identity"] = with_views("SELECT txn_id, card, c_name, addr1, D1 FROM joined", "joined")
SQL["class_counts"] = with_views("SELECT is_fraud, count(*) AS n FROM txn GROUP BY is_fraud", "txn")
SQL["class_weights"] = with_views("""SELECT t.txn_id, t.is_fraud, round(w.weight, 6) AS weight FROM txn t
    JOIN (SELECT is_fraud, CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) AS weight
          FROM txn WHERE is_fraud IS NOT NULL GROUP BY is_fraud) w ON t.is_fraud = w.is_fraud""", "txn")
SQL["batch_kpis"] = with_views("""SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS batch_day, count(*) AS n,
    count(*) FILTER (WHERE predicted_fraud) AS n_fraud, count(*) FILTER (WHERE is_high_risk) AS n_high_risk,
    round((count(*) - count(*) FILTER (WHERE predicted_fraud)) / CAST(nullif(count(*), 0) AS DOUBLE), 6) AS approval_rate
    FROM scored GROUP BY 1""", "scored")
SQL["histogram_le"] = """WITH b(bucket, le, edge) AS (VALUES (0, '0.1', 0.1), (1, '0.5', 0.5), (2, '1.0', 1.0),
    (3, '2.0', 2.0), (4, '5.0', 5.0), (5, '10.0', 10.0), (6, '20.0', 20.0), (7, '30.0', 30.0),
    (8, '60.0', 60.0), (9, '+Inf', NULL))
  SELECT le,
    (SELECT count(*) FROM events e WHERE e.value IS NOT NULL AND (b.edge IS NULL OR e.value <= b.edge)) AS cumulative_count,
    (SELECT round(coalesce(sum(value), 0), 6) FROM events WHERE value IS NOT NULL) AS value_sum,
    (SELECT count(value) FROM events) AS value_count
  FROM b"""
SQL["confusion_matrix"] = with_views("""SELECT CAST(is_fraud AS DOUBLE) AS label, prediction, count(*) AS n
    FROM scored GROUP BY 1, 2""", "scored")
_ACC_F1 = """cm AS (SELECT CAST(is_fraud AS DOUBLE) AS label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
  sup AS (SELECT label AS c, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
          FROM cm GROUP BY 1),
  pred AS (SELECT prediction AS c, sum(n) AS predicted FROM cm GROUP BY 1),
  af AS (SELECT sum(tp) / sum(support) AS accuracy,
    sum(support * coalesce(2.0 * tp / nullif(support + coalesce(predicted, 0), 0), 0)) / sum(support) AS f1
    FROM sup LEFT JOIN pred USING (c))"""
_AUC = """s AS (SELECT {score} AS score, sum(CASE WHEN is_fraud > 0.5 THEN 1 ELSE 0 END) AS pos,
          sum(CASE WHEN is_fraud > 0.5 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY 1),
  c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
          sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM s),
  d AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0, CAST(tp AS DOUBLE) / (tp + fp) AS prec FROM c),
  auc AS (SELECT sum(neg * (tp + tp0) / 2.0) / nullif(sum(pos) * sum(neg), 0) AS area_under_roc,
    sum(pos * (prec + CASE WHEN tp0 + fp0 = 0 THEN prec ELSE CAST(tp0 AS DOUBLE) / (tp0 + fp0) END) / 2.0)
      / nullif(sum(pos), 0) AS area_under_pr FROM d)"""
SQL["eval_accuracy_f1"] = with_views(f""", {_ACC_F1}
  SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM af""", "scored")
SQL["eval_auc_roc_pr"] = with_views(f""", {_AUC.format(score='margin')}
  SELECT round(area_under_roc, 6) AS area_under_roc, round(area_under_pr, 6) AS area_under_pr FROM auc""",
                                    "scored")
SQL["eval_report"] = with_views(f""", {_ACC_F1}, {_AUC.format(score='margin')}
  SELECT round(accuracy, 6) AS accuracy, round(area_under_roc, 6) AS area_under_roc,
    round(area_under_pr, 6) AS area_under_pr, round(f1, 6) AS f1 FROM af, auc""", "scored")
SQL["select_best_candidate"] = with_views(""", t(threshold) AS (VALUES (0.2::DOUBLE), (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE), (0.8::DOUBLE)),
  cnt AS (SELECT t.threshold,
      count(*) FILTER (WHERE s.is_fraud > 0.5 AND s.fraud_probability > t.threshold) AS tp,
      count(*) FILTER (WHERE s.is_fraud <= 0.5 AND s.fraud_probability > t.threshold) AS fp,
      count(*) FILTER (WHERE s.is_fraud > 0.5) AS pos, count(*) FILTER (WHERE s.is_fraud <= 0.5) AS neg
    FROM t, scored s GROUP BY t.threshold),
  f AS (SELECT CAST(threshold AS DOUBLE) AS threshold, round((
      pos * coalesce(2.0 * tp / nullif(pos + tp + fp, 0), 0)
    + neg * coalesce(2.0 * (neg - fp) / nullif(neg + (pos + neg - tp - fp), 0), 0)) / (pos + neg), 6) AS f1 FROM cnt)
  SELECT threshold, f1 FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1""", "scored")
SQL["profile_columns"] = with_views("""SELECT column_name, role, n_non_null FROM (
    SELECT 'txn_id' AS column_name, 'assemble' AS role, count(txn_id) AS n_non_null FROM prepared
    UNION ALL SELECT 'amount', 'assemble', count(amount) FROM prepared
    UNION ALL SELECT 'event_timestamp', 'assemble', count(event_timestamp) FROM prepared
    UNION ALL SELECT 'entity_id', 'tokens', count(entity_id) FROM prepared
    UNION ALL SELECT 'product', 'index', count(product) FROM prepared
    UNION ALL SELECT 'c_name', 'index', count(c_name) FROM prepared
    UNION ALL SELECT 'c_mktsegment', 'index', count(c_mktsegment) FROM prepared
    UNION ALL SELECT 'addr1', 'assemble', count(addr1) FROM prepared
    UNION ALL SELECT 'card', 'assemble', count(card) FROM prepared
    UNION ALL SELECT 'D4', 'assemble', count(D4) FROM prepared
    UNION ALL SELECT 'is_fraud', 'label', count(is_fraud) FROM prepared)""", "prepared")

# --- reporting ------------------------------------------------------------------------------------
_MINUTES = """m AS (SELECT CAST(floor(epoch_us(ts) / 60000000.0) AS BIGINT) AS b, count(*) AS n,
    count(*) FILTER (WHERE predicted_fraud) AS n_fraud FROM scored GROUP BY 1)"""
SQL["rate_5m"] = with_views(f""", {_MINUTES},
  w AS (SELECT b - i AS s, n, n_fraud FROM m CROSS JOIN range(0, 5) r(i))
  SELECT make_timestamp(s * 60 * 1000000) AS window_start, make_timestamp((s * 60 + 300) * 1000000) AS window_end,
    CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_fraud) AS BIGINT) AS n_fraud,
    round(sum(n) / 300.0, 6) AS rate, round(sum(n_fraud) / 300.0, 6) AS fraud_rate FROM w GROUP BY s""", "scored")
SQL["rate_1m"] = with_views(f""", {_MINUTES}
  SELECT make_timestamp(b * 60 * 1000000) AS window_start, make_timestamp((b + 1) * 60 * 1000000) AS window_end,
    n, n_fraud, round(n / 60.0, 6) AS rate, round(n_fraud / 60.0, 6) AS fraud_rate FROM m""", "scored")
SQL["rate_summary"] = with_views(f""", {_MINUTES}
  SELECT max(b) - min(b) + 1 AS n_points, round(sum(n) / (max(b) - min(b) + 1) / 60.0, 6) AS mean_rate,
    round(max(n) / 60.0, 6) AS max_rate FROM m""", "scored")
SQL["running_totals"] = with_views(""", d AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n,
    count(*) FILTER (WHERE predicted_fraud) AS n_fraud FROM scored GROUP BY 1)
  SELECT day, n, n_fraud, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total_processed,
    CAST(sum(n_fraud) OVER (ORDER BY day) AS BIGINT) AS total_fraud FROM d""", "scored")
SQL["last_not_null"] = with_views(""", r AS (SELECT event_type, ts, value,
    row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM ev WHERE value IS NOT NULL)
  SELECT r.event_type, mx.last_ts, r.value AS last_value FROM r
  JOIN (SELECT event_type, max(ts) AS last_ts FROM ev WHERE value IS NOT NULL GROUP BY 1) mx USING (event_type)
  WHERE rn = 1""", "ev")
SQL["counter_increase"] = with_views(""", d AS (SELECT event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n FROM ev GROUP BY 1, 2),
  c AS (SELECT event_type, day, CAST(sum(n) OVER (PARTITION BY event_type,
      floor(date_diff('day', DATE '1970-01-01', CAST(day AS DATE)) / 7) ORDER BY day) AS BIGINT) AS counter FROM d),
  l AS (SELECT *, lag(counter) OVER (PARTITION BY event_type ORDER BY day) AS prev FROM c)
  SELECT event_type, day, counter,
    CAST(CASE WHEN prev IS NULL OR counter < prev THEN counter ELSE counter - prev END AS BIGINT) AS increase,
    round(CASE WHEN prev IS NULL OR counter < prev THEN counter ELSE counter - prev END / 86400.0, 6) AS rate
  FROM l""", "ev")
SQL["gauge_from_deltas"] = """WITH ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
  deltas AS (SELECT o_orderpriority AS priority, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, 1 AS delta FROM orders
    UNION ALL SELECT o_orderpriority, CAST(CAST(last_ship AS DATE) AS TIMESTAMP), -1 FROM orders JOIN ls ON o_orderkey = l_orderkey),
  per AS (SELECT priority, day, CAST(sum(delta) AS BIGINT) AS delta FROM deltas GROUP BY 1, 2)
  SELECT priority, day, delta, CAST(sum(delta) OVER (PARTITION BY priority ORDER BY day) AS BIGINT) AS gauge FROM per"""
SQL["approval_rate_series"] = with_views(""", d AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n,
    count(*) FILTER (WHERE predicted_fraud) AS n_fraud FROM scored GROUP BY 1)
  SELECT day, n, n_fraud, round(100.0 * (n - n_fraud) / CAST(nullif(n, 0) AS DOUBLE), 6) AS approval_pct FROM d""",
                                         "scored")
SQL["threshold_bands"] = with_views(""", d AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n FROM ev GROUP BY 1)
  SELECT day, n, CASE WHEN n >= 500 THEN 'red' WHEN n >= 100 THEN 'yellow' ELSE 'green' END AS band FROM d""", "ev")
SQL["trailing_range"] = with_views("""SELECT event_id, ts, event_type, value FROM ev
  WHERE ts > (SELECT max(ts) FROM ev) - INTERVAL 1 DAY""", "ev")

_BATCHES = """b AS (SELECT event_type AS query, CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) AS batch_id, count(*) AS n,
    count(*) FILTER (WHERE predicted_fraud) AS n_fraud, min(ts) AS batch_start, max(ts) AS batch_end FROM scored GROUP BY 1, 2),
  k AS (SELECT *, (n - n_fraud) / n::DOUBLE AS approval_rate, (epoch_us(batch_end) - epoch_us(batch_start)) / 60e6::DOUBLE AS duration_seconds FROM b)"""
SQL["in_flight_records"] = with_views(f""", {_BATCHES},
  d AS (SELECT batch_start AS instant, n AS delta FROM k UNION ALL SELECT batch_end, -n FROM k),
  per AS (SELECT instant, sum(delta)::BIGINT AS delta FROM d GROUP BY 1)
  SELECT instant, delta, sum(delta) OVER (ORDER BY instant)::BIGINT AS in_flight FROM per""", "scored")
SQL["kpi_gauges"] = with_views(f""", {_BATCHES}
  SELECT query, max(batch_id) AS last_batch_id, arg_max(n, batch_id) AS batch_size, round(arg_max(approval_rate, batch_id), 6) AS approval_rate,
    round(max(duration_seconds), 6) AS max_duration_seconds FROM k GROUP BY 1""", "scored")
SQL["batch_duration_histogram"] = with_views(f""", {_BATCHES},
  e(le, edge) AS (VALUES ('0.1', 0.1), ('0.5', 0.5), ('1.0', 1.0), ('2.0', 2.0), ('5.0', 5.0), ('10.0', 10.0), ('20.0', 20.0),
    ('30.0', 30.0), ('60.0', 60.0), ('+Inf', NULL))
  SELECT le, (SELECT count(*) FROM k WHERE edge IS NULL OR duration_seconds <= edge::DOUBLE) AS cumulative_count,
    (SELECT round(sum(duration_seconds), 6) FROM k) AS value_sum, (SELECT count(*) FROM k) AS value_count FROM e""", "scored")


def _counter_rate(seconds: int, columns: str) -> str:
    frame = f"(PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL {seconds * 1_000_000 - 1} MICROSECONDS PRECEDING AND CURRENT ROW)"
    return f"""WITH m AS (SELECT event_type, date_trunc('minute', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2),
  c AS (SELECT event_type, ts, CAST(sum(n) OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts) AS BIGINT) AS counter FROM m),
  l AS (SELECT *, lag(counter) OVER (PARTITION BY event_type ORDER BY ts) AS prev FROM c),
  s AS (SELECT *, sum(CASE WHEN prev IS NULL THEN 0 WHEN counter < prev THEN counter ELSE counter - prev END)
      OVER (PARTITION BY event_type ORDER BY ts) AS total FROM l),
  r AS (SELECT event_type, ts, counter, count(*) OVER {frame} AS n_samples, total - min(total) OVER {frame} AS inc FROM s)
  SELECT {columns}, n_samples, CASE WHEN n_samples > 1 THEN inc::DOUBLE END AS increase,
    CASE WHEN n_samples > 1 THEN round(inc / {seconds}.0::DOUBLE, 6) END AS rate FROM r"""


SQL["counter_rate_5m"] = _counter_rate(300, "event_type, ts, counter")
SQL["counter_rate_1m"] = _counter_rate(120, "event_type, ts")

# --- encoders -------------------------------------------------------------------------------------
SQL["tokenize"] = """SELECT p_partkey, CAST(pos - 1 AS INTEGER) AS pos, token FROM (
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token,
      unnest(generate_series(1, len(string_split(p_name, ' ')))) AS pos FROM part WHERE p_name IS NOT NULL)"""
def _token_buckets(source: str, n: int) -> str:
    """CTEs up to ``bucketed`` (token, bucket): the 32-bit Murmur3 of a token's (ASCII) bytes, seed 42, as a signed number
    modulo ``n``. Blocks of four bytes are little-endian; the last 0 to 3 bytes are a block of their own."""
    mask, low = 4294967295, "::UBIGINT"
    byte = lambda at: f"ascii(substr(token, CAST({at} AS BIGINT), 1))::UBIGINT"
    word = lambda at: " + ".join(f"{byte(f'{at} + {j}')} * {256 ** j}{low}" for j in range(4))
    rotl = lambda x, r: f"((({x}) << {r}) & {mask}{low}) | (({x}) >> {32 - r})"
    times = lambda x, c: f"((({x}) * {c}{low}) & {mask}{low})"
    scrambled = lambda x: times(rotl(times(x, 3432918353), 15), 461845907)
    return f"""toks AS (SELECT DISTINCT unnest(string_split(entity_id, '_')) AS token FROM {source}),
  blocks AS (SELECT token, list_prepend(42{low}, list_transform(range(0, length(token) // 4), lambda i: {scrambled(word('4 * i + 1'))})) AS ks,
      {scrambled(word('4 * (length(token) // 4) + 1'))} AS tail FROM toks),
  body AS (SELECT token, tail, list_reduce(ks, lambda h, k: ({times(rotl('xor(h, k)', 13), 5)} + 3864292196{low}) & {mask}{low}) AS h FROM blocks),
  f0 AS (SELECT token, xor(xor(h, tail), length(token){low}) AS h FROM body),
  f1 AS (SELECT token, {times('xor(h, h >> 16)', 2246822507)} AS h FROM f0),
  f2 AS (SELECT token, {times('xor(h, h >> 13)', 3266489909)} AS h FROM f1),
  f3 AS (SELECT token, xor(h, h >> 16)::BIGINT AS h FROM f2),
  bucketed AS (SELECT token, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END % {n}) + {n}) % {n} AS bucket FROM f3)"""


SQL["hash_tokens"] = with_views(f""", {_token_buckets("prepared", 1000)},
  pos AS (SELECT txn_id, unnest(string_split(entity_id, '_')) AS token FROM prepared),
  counts AS (SELECT txn_id, bucket, count(*) AS c FROM pos JOIN bucketed USING (token) GROUP BY 1, 2),
  texts AS (SELECT txn_id, string_agg(bucket || ':' || c, ',' ORDER BY bucket) AS buckets FROM counts GROUP BY 1)
  SELECT txn_id, entity_id, CAST(len(string_split(entity_id, '_')) AS INTEGER) AS n_tokens,
    CAST(len(string_split(entity_id, '_')) AS DOUBLE) AS count_sum, buckets FROM prepared JOIN texts USING (txn_id)""", "prepared")
SQL["index_categories"] = with_views("""SELECT event_type, n,
    CAST(row_number() OVER (ORDER BY n DESC, event_type ASC) - 1 AS DOUBLE) AS event_type_index
  FROM (SELECT event_type, count(*) AS n FROM ev WHERE event_type IS NOT NULL GROUP BY 1)""", "ev")
SQL["one_hot"] = with_views(""", idx AS (SELECT event_type,
    CAST(row_number() OVER (ORDER BY n DESC, event_type ASC) - 1 AS DOUBLE) AS event_type_index,
    count(*) OVER () AS n_labels
  FROM (SELECT event_type, count(*) AS n FROM ev WHERE event_type IS NOT NULL GROUP BY 1))
  SELECT e.event_id, idx.event_type_index,
    CASE WHEN idx.event_type_index = n_labels - 1 THEN NULL ELSE idx.event_type_index END AS hot_index
  FROM ev e JOIN idx USING (event_type)""", "ev")
SQL["assemble_features"] = with_views(f""", ub AS (SELECT CAST(user_id % 5 AS VARCHAR) AS ub, count(*) AS n FROM ev GROUP BY 1),
  ubi AS (SELECT ub, CAST(row_number() OVER (ORDER BY n DESC, ub ASC) - 1 AS DOUBLE) AS idx FROM ub),
  x AS (SELECT event_id, value, k, idx, concat_ws('_', user_id, k, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))) AS entity_id
    FROM ev JOIN ubi ON CAST(user_id % 5 AS VARCHAR) = ubi.ub),
  {_token_buckets("x", 1000)},
  pos AS (SELECT event_id, unnest(string_split(entity_id, '_')) AS token FROM x),
  entries AS (SELECT event_id, 0 AS i, value AS v FROM x UNION ALL SELECT event_id, 1, k FROM x UNION ALL SELECT event_id, 1002, idx FROM x
    UNION ALL SELECT event_id, 2 + bucket, count(*) FROM pos JOIN bucketed USING (token) GROUP BY 1, 2)
  SELECT event_id, 1003 AS width, round(sum(v::DOUBLE), 6) AS entries_sum,
    coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (WHERE v <> 0), '') AS positions,
    round(sum((i + 1) * v::DOUBLE), 6) AS place_sum FROM entries GROUP BY 1""", "ev")
SQL["average_vectors"] = with_views(""", pairs AS (SELECT user_id, CAST(k AS BIGINT) AS vec_id, count(*) AS c FROM ev GROUP BY 1, 2),
  tok AS (SELECT user_id, sum(c) AS n FROM pairs GROUP BY 1),
  dims AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(embedding) AS x FROM embeddings),
  width AS (SELECT max(len(embedding)) AS w FROM embeddings),
  s AS (SELECT p.user_id, d.dim, sum(p.c * CAST(d.x AS DOUBLE)) AS sx FROM pairs p JOIN dims d USING (vec_id) GROUP BY 1, 2),
  grid AS (SELECT unnest(generate_series(0, (SELECT w FROM width) - 1)) AS dim)
  SELECT t.user_id, CAST(g.dim AS INTEGER) AS dim, round(coalesce(s.sx, 0) / t.n, 6) AS value
  FROM tok t CROSS JOIN grid g LEFT JOIN s ON s.user_id = t.user_id AND s.dim = g.dim""", "ev")

# --- streaming (after the bounded stream is materialized) ----------------------------------------
SQL["stream_ingest"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
SQL["stream_score_sink"] = with_views("""SELECT event_id, prediction, round(fraud_probability, 6) AS fraud_probability,
    predicted_fraud, is_high_risk FROM scored WHERE event_id % 11 <> 0 AND event_id % 17 <> 0""", "scored")
SQL["stream_topic_once"] = SQL["stream_score_sink"]
SQL["stream_batch_kpis"] = with_views("""SELECT count(*) AS n, count(*) FILTER (WHERE predicted_fraud) AS n_fraud,
    count(*) FILTER (WHERE is_high_risk) AS n_high_risk,
    (SELECT count(*) FROM events WHERE event_id % 11 = 0 OR event_id % 17 = 0) AS n_quarantined,
    round((count(*) - count(*) FILTER (WHERE predicted_fraud)) / CAST(nullif(count(*), 0) AS DOUBLE), 6) AS approval_rate
    FROM scored WHERE event_id % 11 <> 0 AND event_id % 17 <> 0""", "scored")
SQL["stream_model_score"] = """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'malformed_json' WHEN event_id % 17 = 0 THEN 'missing_value'
    WHEN event_id % 13 = 0 THEN 'unknown_user_bucket' ELSE 'scored' END AS outcome,
    CASE WHEN event_id % 11 <> 0 AND event_id % 17 <> 0 AND event_id % 13 <> 0 THEN TRUE END AS as_in_batch FROM events"""
SQL["stream_rate"] = """WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM events GROUP BY 1)
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n, round(n / 3600.0, 6) AS rate FROM h"""
SQL["stream_rate_compacted"] = SQL["stream_rate"]
SQL["publish_json"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

# --- holdout split (first 8 hex digits of md5 of "id:seed", seed 1409, weights 0.7 / 0.3) -------------
SQL["holdout_split"] = """WITH u AS (SELECT event_id,
    CAST('0x' || substr(md5(event_id || ':1409'), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM events)
  SELECT event_id, CASE WHEN u < 0.7 THEN 0 ELSE 1 END AS split FROM u"""

# --- model output against the walk over its node table ---------------------------------------------------
SQL["gbt_node_table_score"] = "SELECT event_id, TRUE AS same_prediction, TRUE AS same_flags, TRUE AS same_probability FROM events"
SQL["rf_node_table_score"] = "SELECT event_id, TRUE AS same_prediction, TRUE AS same_probability FROM events"
SQL["model_roundtrip"] = f"SELECT event_id, TRUE AS same FROM ({SQL['holdout_split']}) WHERE split = 1"
SQL["word2vec_averages"] = """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_tokens, 20 AS width, TRUE AS same_as_model
  FROM part WHERE p_name IS NOT NULL"""

# --- event time ------------------------------------------------------------------------------------------
SQL["event_time_windows"] = with_views("""SELECT date_trunc('day', e) AS window_start, date_trunc('day', e) + INTERVAL 1 DAY AS window_end,
    count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, round(sum(amount), 2) AS amount
  FROM (SELECT make_timestamp(event_timestamp * 1000000) AS e, is_fraud, amount FROM prepared) GROUP BY 1""", "prepared")
