"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from plumelake.functions.air import AQI_LABELS, AQI_UNKNOWN, STATE_DANGER, STATE_NORMAL
from plumelake.operators import alerts as al, model as ml, reports as rp
from plumelake.operators.synthetic import DAYS_BACK, HOURS_BACK, RANGES
from plumelake.plans import adapter as ad, queries as q
from plumelake.sources import schemas

RAW = ", ".join(schemas.columns(schemas.RAW))
FEATURES = ", ".join(schemas.columns(schemas.FEATURES))
PREDICTIONS = ", ".join(schemas.columns(schemas.PREDICTIONS))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _dbl(expr: object) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _cases(pairs: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {w} THEN {t}" for w, t in pairs) + f" ELSE {otherwise} END"


CATEGORY = _cases([(f"aqi = {k}", f"'{v}'") for k, v in AQI_LABELS.items()], f"'{AQI_UNKNOWN}'")


def _place(axis: int) -> str:
    return _dbl(_cases([(f"event_type = '{k}'", str(v[axis])) for k, v in ad.PLACES.items()],
                       str(ad.ELSEWHERE[axis])))


def _ctes(station: str = "event_type", timed_only: bool = False,
          order: str = "event_id, ingest_seq", given: str = "true") -> list[str]:
    index = _cases(
        [(f"event_id % {ad.NO_INDEX} = 0", "NULL"), (f"event_id % {ad.ZERO_INDEX} = 0", "0")]
        + [(f"value < {lim}", str(i)) for lim, i in ad.INDEX_LIMITS], "5")
    second = "CAST(floor(epoch(timestamp_parsed)) AS BIGINT)"
    return [
        f"""src AS (
  SELECT event_id, 0 AS ingest_seq, ts, user_id, event_type, value FROM events
  WHERE {given}
  UNION ALL
  SELECT event_id, 1, ts, user_id, event_type, value + 1 FROM events
  WHERE {given} AND event_id % {ad.REPEAT} = 0)""",
        f"""raw AS (
  SELECT event_id, ingest_seq,
    CASE WHEN event_id % {ad.NO_STATION} <> 0 THEN CAST({station} AS VARCHAR) END AS station_id,
    'Station ' || CAST({station} AS VARCHAR) AS station_name,
    {_place(0)} AS latitude, {_place(1)} AS longitude,
    CAST({index} AS INTEGER) AS aqi,
    CAST(200 + user_id % 300 AS DOUBLE) AS co, CAST(event_id % 80 AS DOUBLE) AS no2,
    CAST(user_id % 120 AS DOUBLE) AS o3,
    CASE WHEN event_id % {ad.NO_PM25} <> 0 THEN value END AS pm25,
    value * 2 AS pm10,
    CASE WHEN event_id % {ad.BAD_TIME} = 0 THEN 'bad'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp
  FROM src)""",
        """kept AS (
  SELECT * FROM raw
  WHERE station_id IS NOT NULL AND timestamp IS NOT NULL AND pm25 IS NOT NULL)""",
        f"""firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, timestamp ORDER BY {order}) AS rn
    FROM kept)
  WHERE rn = 1)""",
        f"""clean AS (
  SELECT station_id, station_name, latitude, longitude, aqi, {CATEGORY} AS aqi_category,
    co, no2, o3, pm25, pm10, timestamp_parsed, CAST(timestamp_parsed AS DATE) AS curated_date,
    CAST(year(timestamp_parsed) AS VARCHAR) AS year,
    CAST(month(timestamp_parsed) AS VARCHAR) AS month,
    CAST(day(timestamp_parsed) AS VARCHAR) AS day
  FROM (SELECT *, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp_parsed FROM firsts)
  {'WHERE timestamp_parsed IS NOT NULL' if timed_only else ''})""",
        f"""rolled AS (
  SELECT *, {_mean_units('pm25', 86400)} AS pm25_prom_24h,
    {_mean_units('pm25', 21600)} AS pm25_prom_6h,
    avg(aqi) OVER {_frame(86400)} AS aqi_prom_24h,
    max(aqi) OVER {_frame(86400)} AS aqi_max_24h,
    avg(aqi) OVER {_frame(3600)} AS aqi_prom_1h,
    aqi - lag(aqi) OVER (PARTITION BY station_id ORDER BY timestamp_parsed NULLS FIRST)
      AS tendencia_aqi,
    CAST(hour(timestamp_parsed) AS INTEGER) AS hora_dia,
    CAST(dayofweek(timestamp_parsed) + 1 AS INTEGER) AS dia_semana,
    CAST(dayofweek(timestamp_parsed) + 1 IN (1, 7) AS INTEGER) AS es_fin_semana,
    CAST(aqi >= 3 AS INTEGER) AS contaminacion_alta
  FROM (SELECT *, {second} AS sec FROM clean))""",
        f"""feats AS (
  SELECT {FEATURES} FROM rolled
  WHERE pm25_prom_24h IS NOT NULL AND aqi_prom_24h IS NOT NULL)""",
        f"""frame AS (
  SELECT * REPLACE ({', '.join(f'{_dbl(c)} AS {c}' for c in [*ml.INPUTS, ml.LABEL])}) FROM feats
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*ml.INPUTS, ml.LABEL])})""",
        f"""margins AS (SELECT *, {_margin()} AS score FROM frame)""",
        f"""scored AS (
  SELECT {PREDICTIONS} FROM (
    SELECT *, contaminacion_alta AS contaminacion_alta_real,
      CAST(score > 0 AS DOUBLE) AS contaminacion_alta_pred,
      {_dbl(1)} / ({_dbl(1)} + exp(-score)) AS probabilidad_alerta,
      CASE WHEN score > 0 THEN 'PELIGROSO' ELSE 'NORMAL' END AS estado_predicho,
      '{q.RUN_TS}' AS prediction_timestamp FROM margins))""",
        f"""found AS (
  SELECT * FROM scored
  WHERE contaminacion_alta_pred = 1.0 AND probabilidad_alerta >= {_dbl(al.THRESHOLD)}
    AND timestamp_parsed >= TIMESTAMP '{q.NOW}' - INTERVAL {al.HOURS} HOUR)""",
    ]


def _frame(seconds: int) -> str:
    return (f"(PARTITION BY station_id ORDER BY sec NULLS FIRST "
            f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)")


def _mean_units(col: str, seconds: int) -> str:
    frame = _frame(seconds)
    total = f"sum(CAST(round({col} * 100) AS BIGINT)) OVER {frame}"
    return f"{_dbl(total)} / ({_dbl(f'count({col}) OVER {frame}')} * {_dbl(100)})"


def _margin() -> str:
    expr = _dbl(0)
    for c in ml.INPUTS:
        expr = (f"({expr} + {_dbl(q.WEIGHTS[c])} * "
                f"(({c} - {_dbl(q.MEANS[c])}) / {_dbl(q.STDS[c])}))")
    return f"({expr} + {_dbl(q.BIAS)})"


def _sql(body: str, **variant) -> str:
    return "WITH " + ",\n".join(_ctes(**variant)) + "\n" + body


# Raw files do not tell the order of arrival: the values decide which of several
# readings of one station and time survives.
BY_VALUES = ", ".join(
    f"{c} NULLS FIRST" for c in schemas.columns(schemas.RAW) if c not in ("station_id", "timestamp"))


CLEAN_OUT = "* REPLACE (CAST(curated_date AS VARCHAR) AS curated_date)"
SCORED_OUT = "* REPLACE (round(probabilidad_alerta, 6) AS probabilidad_alerta)"
PLACE = "station_name IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"
CHOSEN = (f"station_name IN ({', '.join(repr(s) for s in q.SELECTED)}) AND timestamp_parsed >= "
          f"TIMESTAMP '{q.SELECTED_DAYS[0]}' AND timestamp_parsed < "
          f"TIMESTAMP '{q.SELECTED_DAYS[1]}' + INTERVAL 1 DAY")
CHOSEN_ROWS = (f"SELECT {CLEAN_OUT}, CAST(curated_date AS VARCHAR) AS fecha, "
               f"CAST(hour(timestamp_parsed) AS INTEGER) AS hora FROM clean WHERE {CHOSEN}")
KPIS = """SELECT * FROM (
  SELECT count(*) AS lecturas, max(aqi) AS aqi_max, round(avg(aqi), 2) AS aqi_prom,
    round(max(pm25), 1) AS pm25_max, count(*) FILTER (aqi >= 4) AS n_alertas,
    round(CAST(100 * count(*) FILTER (aqi >= 4) AS DOUBLE) / count(*), 1) AS pct_alertas
  FROM clean %s) WHERE lecturas > 0"""
HOURLY = """SELECT date_trunc('hour', timestamp_parsed) AS timestamp_parsed, station_name,
  avg(aqi) AS aqi FROM clean WHERE timestamp_parsed IS NOT NULL GROUP BY 1, 2"""
QUARANTINE = f"""SELECT * FROM (SELECT {RAW}, CASE WHEN station_id IS NULL THEN 'no station'
    WHEN timestamp IS NULL THEN 'no timestamp' WHEN pm25 IS NULL THEN 'no pm25'
    WHEN TRY_CAST(timestamp AS TIMESTAMP) IS NULL THEN 'bad timestamp' END AS reason
  FROM raw) WHERE reason IS NOT NULL"""
LATEST = (f"SELECT {', '.join(rp.LATEST_FEATURES)} FROM feats "
          "ORDER BY timestamp_parsed DESC NULLS LAST, station_id LIMIT 10")
SPLIT = ("CAST('0x' || substr(md5(station_id || '|' || CAST(CAST(epoch(timestamp_parsed) AS BIGINT) "
         "AS VARCHAR)), 1, 8) AS BIGINT) % 100")
TOTALS = """SELECT count(*) AS files_processed, CAST(sum(n) AS BIGINT) AS alerts_sent FROM (
  SELECT station_id, (SELECT count(*) FROM found f WHERE f.station_id = s.station_id) AS n
  FROM (SELECT DISTINCT station_id FROM scored) s)"""


def _rolling(*exprs: str) -> str:
    return f"SELECT station_id, timestamp_parsed, pm25, aqi, {', '.join(exprs)} FROM rolled"


def _drawn(name: str, low: int, high: int) -> str:
    head = f"substr(md5('{q.SEED}|{name}|' || CAST(event_id AS VARCHAR)), 1, 12)"
    return f"({low} + CAST('0x' || {head} AS BIGINT) % {high - low + 1})"


def _synthetic() -> str:
    pick = _drawn("station", 1, len(q.STATIONS))

    def station(i: int) -> str:
        return _cases([(f"pick = {n}", repr(s[i])) for n, s in enumerate(q.STATIONS, 1)], "NULL")

    values = ", ".join(
        f"{_dbl(_drawn(c, *RANGES[c]))} / {_dbl(100)} AS {c}" for c in RANGES)
    hours = f"({_drawn('days', 0, DAYS_BACK)} * 24 + {_drawn('hours', 0, HOURS_BACK)})"
    return f"""SELECT {station(0)} AS station_id, {station(1)} AS station_name,
  {_dbl(station(2))} AS latitude, {_dbl(station(3))} AS longitude,
  CAST({_drawn('aqi', 1, 5)} AS INTEGER) AS aqi, {values},
  strftime(TIMESTAMP '{q.NOW}' - to_hours(CAST({hours} AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS timestamp
  FROM (SELECT event_id, {pick} AS pick FROM events)"""


def _digest(size: int = 20) -> str:
    def text(expr: str, missing: str) -> str:
        return f"coalesce(CAST({expr} AS VARCHAR), '{missing}')"

    def fill(template: str, *parts: str) -> str:
        pieces = template.replace("%%", "\0").replace("%d", "%s").split("%s")
        out = [_literal(pieces[0].replace("\0", "%"))]
        for part, piece in zip(parts, pieces[1:]):
            out += [part, _literal(piece.replace("\0", "%"))]
        return " || ".join(out)

    block = fill(al.BLOCK, text("station_name", al.NO_NAME),
                 text("round(probabilidad_alerta * 100, 1)", al.NO_VALUE),
                 text("aqi", al.NO_VALUE), text("pm25", al.NO_VALUE),
                 f"coalesce(strftime(timestamp_parsed, '%Y-%m-%d %H:%M:%S'), '{al.NO_VALUE}')")
    head = fill(al.HEADER, _literal(f"{al.TITLE} {q.REGION}"),
                f"strftime(TIMESTAMP '{q.NOW}', '%Y-%m-%d %H:%M UTC')",
                "CAST(max(size) AS VARCHAR)")
    subject = fill(al.SUBJECT, "CAST(max(size) AS VARCHAR)",
                   "CASE WHEN max(size) > 1 THEN 'es' ELSE '' END")
    return f"""SELECT station_id, part, CAST(ceil(max(size) / {_dbl(size)}) AS INTEGER) AS parts,
  max(size) AS alert_count, CAST(count(DISTINCT station_name) AS INTEGER) AS station_count,
  left({subject}, {al.SUBJECT_LENGTH}) AS subject,
  {head} || string_agg(block, chr(10) ORDER BY nth) || {_literal(al.FOOTER + chr(10) + q.SIGNATURE)}
    AS message
FROM (SELECT *, {block} AS block, CAST(ceil(nth / {_dbl(size)}) AS INTEGER) AS part FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp_parsed, station_name,
      aqi, pm25, probabilidad_alerta) AS nth,
    count(*) OVER (PARTITION BY station_id) AS size FROM found))
GROUP BY station_id, part"""


METRICS = f"""SELECT tn, fp, fn, tp, {_dbl('tn + tp')} / n AS accuracy,
  ({_dbl('2 * tn')} / (2 * tn + fp + fn) * (tn + fp)
   + {_dbl('2 * tp')} / (2 * tp + fp + fn) * (fn + tp)) / n AS f1,
  {_dbl('tp')} / (fn + tp) AS recall
FROM (SELECT {', '.join(f'count(*) FILTER (contaminacion_alta_real = {r} AND contaminacion_alta_pred = {p}) AS {n}'
                        for n, r, p in (('tn', 0, 0), ('fp', 0, 1), ('fn', 1, 0), ('tp', 1, 1)))},
  {_dbl('count(*)')} AS n FROM scored)"""

AUC = f"""SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE)
  / ({_dbl(2)} * (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))) AS auc
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (
    ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT score, count(*) FILTER (contaminacion_alta = 1) AS pos,
    count(*) FILTER (contaminacion_alta = 0) AS neg FROM margins GROUP BY score))"""

AHEAD = f"""SELECT a.station_id, a.timestamp_parsed, a.aqi,
  CAST(b.aqi >= 3 AS INTEGER) AS contaminacion_alta
FROM (SELECT *, sec + 21600 AS due FROM rolled) a
ASOF LEFT JOIN (
  SELECT station_id, sec, arg_min(struct_pack(v := aqi), (timestamp_parsed, coalesce(aqi, -1))).v
    AS aqi FROM rolled WHERE sec IS NOT NULL GROUP BY 1, 2) b
  ON a.station_id = b.station_id AND a.due <= b.sec"""

def _state(body: str, delivery: int, upto: bool = True) -> str:
    """A query over the readings of a delivery and, if ``upto``, of those before it."""
    sign = "<=" if upto else "="
    return "(" + _sql(body, timed_only=True, order=BY_VALUES, given=f"event_id % {q.DELIVERIES} {sign} {delivery}") + ")"


def _changes() -> str:
    """Differences of the alerts after each delivery."""
    key = "SELECT station_id, timestamp_parsed FROM "
    parts = []
    for n in range(q.DELIVERIES):
        after = _state(f"{key}found", n)
        before = _state(f"{key}found", n - 1)
        parts += [f"SELECT *, '{word}' AS change, {n} AS delivery FROM ({a} EXCEPT {b})"
                  for word, a, b in (("raised", after, before), ("withdrawn", before, after))]
    parts.append(f"SELECT *, 'stands' AS change, {q.DELIVERIES} AS delivery FROM {_state(f'{key}found', q.DELIVERIES - 1)}")
    return "\nUNION ALL ".join(parts)


def _stage_counts() -> str:
    """The last delivery comes twice: the second time it is read, but changes nothing."""
    parts = []
    for batch, n in enumerate([*range(q.DELIVERIES), q.DELIVERIES - 1]):
        key = "SELECT station_id, timestamp_parsed FROM found"
        before = n if batch > n else n - 1
        after, old = _state(key, n), _state(key, before)
        counts = {
            "read": f"SELECT count(*) FROM {_state('SELECT * FROM raw', n, False)}",
            "quarantined": f"SELECT count(*) FROM {_state(QUARANTINE, n, False)}",
            "new": f"SELECT count(*) FROM {_state('SELECT * FROM clean', n, False)}",
            "featured": f"SELECT count(*) FROM {_state('SELECT * FROM feats', n)}",
            "scored": f"SELECT count(*) FROM {_state('SELECT * FROM scored', n)}",
            "raised": f"SELECT count(*) FROM ({after} EXCEPT {old})",
            "kept": f"SELECT count(*) FROM ({after} INTERSECT {old})",
            "withdrawn": f"SELECT count(*) FROM ({old} EXCEPT {after})"}
        parts += [f"SELECT {batch} AS batch, '{stage}' AS stage, ({sql}) AS n" for stage, sql in counts.items()]
    return "\nUNION ALL ".join(parts)


STAGES = """SELECT 'read' AS stage, count(*) AS n FROM raw
UNION ALL SELECT 'clean', count(*) FROM clean
UNION ALL SELECT 'featured', count(*) FROM feats
UNION ALL SELECT 'scored', count(*) FROM frame
UNION ALL SELECT 'train', count(*) FROM frame WHERE %(split)s < 80
UNION ALL SELECT 'test', count(*) FROM frame WHERE %(split)s >= 80""" % {"split": SPLIT}


def _descent(body: str, steps: int = 600, penalty: float = 0.01) -> str:
    """Logistic regression by gradient steps of size 1 over the standardised training
    rows: the penalty holds for the weights, not for the bias."""
    n = len(ml.INPUTS)
    stats = ", ".join(f"avg({_dbl(c)}) AS m{i}, stddev_samp({_dbl(c)}) AS s{i}" for i, c in enumerate(ml.INPUTS))
    x = [f"(({_dbl(c)} - m{i}) / s{i})" for i, c in enumerate(ml.INPUTS)]
    margin = " + ".join([f"w{i} * x{i}" for i in range(n)] + ["b"])
    slope = f"(1 / (1 + exp(-({margin}))) - y)"
    steps_sql = ", ".join(f"max(w{i}) - (avg({slope} * x{i}) + {penalty} * max(w{i})) AS w{i}" for i in range(n))
    return "WITH RECURSIVE " + ",\n".join([*_ctes(), f"stats AS (SELECT {stats} FROM frame WHERE {SPLIT} < 80)",
        f"xs AS (SELECT frame.*, {', '.join(f'{e} AS x{i}' for i, e in enumerate(x))}, "
        f"CAST(contaminacion_alta AS DOUBLE) AS y FROM frame, stats)",
        f"tr AS MATERIALIZED (SELECT {', '.join(f'x{i}' for i in range(n))}, y FROM xs WHERE {SPLIT} < 80)",
        f"gd AS (SELECT 0 AS step, {', '.join(f'CAST(0 AS DOUBLE) AS w{i}' for i in range(n))}, CAST(0 AS DOUBLE) AS b "
        f"UNION ALL SELECT max(step) + 1, {steps_sql}, max(b) - avg({slope}) FROM gd, tr "
        f"HAVING max(step) < {steps})",
        f"fitted AS (SELECT * FROM gd WHERE step = {steps})"]) + "\n" + body


def statements() -> dict[str, str]:
    clean_rows = f"SELECT {CLEAN_OUT} FROM clean"
    feature_rows = f"SELECT {CLEAN_OUT} FROM feats"
    found_rows = f"SELECT {SCORED_OUT} FROM found"
    readings = f"SELECT {RAW} FROM raw"
    many = ["pm25_prom_24h", "aqi_max_24h", "aqi_prom_1h"]
    return {
        "curated_readings": _sql(clean_rows),
        "required_fields": _sql("SELECT station_id, timestamp, pm25, aqi FROM kept"),
        "quarantined_readings": _sql(QUARANTINE),
        "dedup_readings": _sql("SELECT * FROM firsts"),
        "aqi_category_map": _sql(
            f"SELECT aqi, {CATEGORY} AS aqi_category, count(*) AS lecturas FROM raw GROUP BY 1, 2"),
        "timestamp_parsing": _sql(
            "SELECT event_id, ingest_seq, TRY_CAST(timestamp AS TIMESTAMP) AS parsed, "
            "TRY_CAST(replace(timestamp || 'Z', 'Z', '') AS TIMESTAMP) AS tolerant FROM raw"),
        "rolling_pm25_24h": _sql(_rolling("pm25_prom_24h")),
        "rolling_pm25_6h": _sql(_rolling("pm25_prom_6h")),
        "rolling_aqi_24h_avg_max": _sql(_rolling("aqi_prom_24h", "aqi_max_24h")),
        "rolling_aqi_1h": _sql(_rolling("aqi_prom_1h")),
        "rolling_bucketed_24h": _sql(_rolling(*many), station="user_id"),
        "aqi_trend": _sql("SELECT station_id, timestamp_parsed, aqi, tendencia_aqi FROM rolled"),
        "aqi_trend_many_stations": _sql(
            "SELECT station_id, timestamp_parsed, aqi, tendencia_aqi FROM rolled",
            station="user_id"),
        "calendar_features": _sql(
            "SELECT station_id, timestamp_parsed, hora_dia, dia_semana, es_fin_semana FROM rolled"),
        "high_pollution_label": _sql(
            "SELECT station_id, timestamp_parsed, aqi, contaminacion_alta FROM rolled"),
        "label_six_hours_ahead": _sql(AHEAD),
        "feature_table": _sql(feature_rows),
        "training_rows": _sql(
            f"SELECT station_id, timestamp_parsed, {', '.join([*ml.INPUTS, ml.LABEL])} FROM frame"),
        "class_balance": _sql(
            'SELECT contaminacion_alta, count(*) AS "count" FROM frame GROUP BY 1'),
        "hash_split_counts": _sql(
            f'SELECT {SPLIT} < 80 AS train, count(*) AS "count" FROM frame GROUP BY 1'),
        "scaler_stats": _sql("\nUNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std "
            f"FROM frame WHERE {SPLIT} < 80" for c in ml.INPUTS)),
        "fixed_weight_scores": _sql(f"SELECT {SCORED_OUT} FROM scored"),
        "confusion_matrix": _sql(
            'SELECT contaminacion_alta_real, contaminacion_alta_pred, count(*) AS "count" '
            "FROM scored GROUP BY 1, 2"),
        "classification_metrics": _sql(METRICS),
        "auc_exact": _sql(AUC),
        "predicted_state": _sql(
            'SELECT estado_predicho, contaminacion_alta_pred, count(*) AS "count" '
            "FROM scored GROUP BY 1, 2"),
        "danger_alerts": _sql(found_rows),
        "alert_counts": _sql("SELECT station_id, count(*) AS alerts_sent FROM found GROUP BY 1"),
        "alert_totals": _sql(TOTALS),
        "alert_totals_json": _sql(
            "SELECT '{\"files_processed\":' || CAST(files_processed AS VARCHAR) || "
            "',\"alerts_sent\":' || CAST(alerts_sent AS VARCHAR) || '}' AS body FROM (" + TOTALS + ")"),
        "alert_digest": _sql(_digest()),
        "url_decode_keys": (
            "SELECT event_id, key, ends_with(key, '.parquet') AS is_parquet FROM (SELECT event_id, "
            "url_decode('curated/predictions/station_id%3D' || event_type || '/part%2D' || "
            "CAST(event_id AS VARCHAR) || '.parquet') AS key FROM events)"),
        "kpi_summary": _sql(KPIS % ""),
        "hourly_aqi": _sql(HOURLY),
        "station_summary": _sql(
            "SELECT station_name, latitude, longitude, avg(aqi) AS aqi_prom, "
            f"{_dbl('sum(CAST(round(pm25 * 100) AS BIGINT))')} / ({_dbl('count(pm25)')} * {_dbl(100)})"
            f" AS pm25_prom, count(aqi) AS lecturas FROM clean WHERE {PLACE} GROUP BY 1, 2, 3"),
        "category_counts": _sql("SELECT aqi_category, count(*) AS lecturas FROM clean GROUP BY 1"),
        "date_span": _sql(
            "SELECT CAST(CAST(min(timestamp_parsed) AS DATE) AS VARCHAR) AS fecha_min, "
            "CAST(CAST(max(timestamp_parsed) AS DATE) AS VARCHAR) AS fecha_max, "
            "max(timestamp_parsed) AS ultima_lectura FROM clean"),
        "station_list": _sql("SELECT DISTINCT station_name FROM clean"),
        "worst_10": _sql(
            "SELECT " + ", ".join(f'{k} AS "{v}"' for k, v in rp.DISPLAY_NAMES.items())
            + " FROM clean ORDER BY aqi DESC NULLS LAST, pm25 DESC NULLS LAST, "
            "timestamp_parsed NULLS LAST, station_name LIMIT 10"),
        "latest_10_features": _sql(LATEST),
        "latest_10_predictions": _sql(
            f"SELECT {SCORED_OUT} FROM (SELECT {', '.join(rp.LATEST_PREDICTIONS)} FROM scored "
            "ORDER BY timestamp_parsed DESC NULLS LAST, station_id LIMIT 10)"),
        "filtered_readings": _sql(CHOSEN_ROWS),
        "filtered_kpis": _sql(KPIS % f"WHERE {CHOSEN}"),
        "last_7_days_export": _sql(
            f"SELECT {', '.join(schemas.columns(schemas.EXTRACT))} FROM clean WHERE timestamp_parsed "
            f"BETWEEN TIMESTAMP '{q.NOW}' - INTERVAL 7 DAY AND TIMESTAMP '{q.NOW}'"),
        "raw_json_scan": _sql(readings),
        "concatenated_json_scan": _sql(readings),
        "nested_json_scan": _sql(f"SELECT {RAW}, false AS malformed FROM raw"),
        "malformed_records": _sql(
            "SELECT CASE event_id % 300 WHEN 0 THEN 'no reading ' || event_id WHEN 100 THEN "
            "'\"station_id\":\"cut ' || event_id ELSE 'behind ' || event_id END AS record "
            "FROM raw WHERE event_id % 100 = 0"),
        "lr_coefficients": _descent(" UNION ALL ".join(
            [f"SELECT '{c}' AS feature, round(w{i}, 3) AS weight FROM fitted" for i, c in enumerate(ml.INPUTS)]
            + ["SELECT 'bias', round(b, 3) FROM fitted"])),
        "lr_predictions": _descent(
            "SELECT station_id, timestamp_parsed, y AS contaminacion_alta_real, "
            "CASE WHEN m > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS contaminacion_alta_pred, "
            "round(1 / (1 + exp(-m)), 4) AS probabilidad_alerta, "
            f"CASE WHEN m > 0 THEN '{STATE_DANGER}' ELSE '{STATE_NORMAL}' END AS estado_predicho FROM (SELECT *, "
            + " + ".join([f"w{i} * x{i}" for i in range(len(ml.INPUTS))] + ["b"]) + " AS m FROM xs, fitted)"),
        "incomplete_alerts": _sql(
            "SELECT station_id, count(*) AS alert_count, count(*) FILTER (s % 2 <> 0 OR station_name IS NULL) AS no_name, "
            "count(*) FILTER (s % 3 <> 0 OR aqi IS NULL) AS no_index, count(*) FILTER (s % 5 <> 0 OR pm25 IS NULL) AS no_pm25 "
            "FROM (SELECT *, CAST(floor(epoch(timestamp_parsed)) AS BIGINT) AS s FROM found) GROUP BY station_id"),
        "clean_table_scan": _sql(clean_rows),
        "clean_table_range": _sql(CHOSEN_ROWS),
        "clean_table_count": _sql("SELECT count(*) AS lecturas FROM clean"),
        "feature_table_scan": _sql(feature_rows),
        "latest_10_sql": _sql(LATEST),
        "prediction_files_scan": _sql(f"SELECT {SCORED_OUT} FROM scored"),
        "csv_export_scan": _sql(
            f"SELECT {', '.join(schemas.columns(schemas.EXTRACT))}, CAST(curated_date AS VARCHAR) AS "
            "fecha, CAST(hour(timestamp_parsed) AS INTEGER) AS hora FROM clean"),
        "touched_days_overwrite": _sql(
            "SELECT CASE WHEN timestamp_parsed >= TIMESTAMP '%s' AND timestamp_parsed < TIMESTAMP '%s' "
            "+ INTERVAL 1 DAY THEN upper(station_name) ELSE station_name END AS station_name, "
            "count(*) AS lecturas FROM clean GROUP BY 1" % q.SELECTED_DAYS),
        "synthetic_readings": _synthetic(),
        "synthetic_csv_scan": _synthetic(),
        "pipeline_stage_counts": _sql(STAGES, order=BY_VALUES),
        "stream_dedup": _sql(f"SELECT {CLEAN_OUT} FROM clean WHERE timestamp_parsed IS NOT NULL", order=BY_VALUES),
        "stream_pipeline_predictions": _sql(f"SELECT {SCORED_OUT} FROM scored", timed_only=True, order=BY_VALUES),
        "incremental_pipeline": _sql(feature_rows, timed_only=True, order=BY_VALUES),
        "register_touched_days": _sql(
            "SELECT CAST(curated_date AS VARCHAR) AS day, count(*) AS lecturas FROM clean "
            f"WHERE curated_date <> DATE '{q.SELECTED_DAYS[0]}' GROUP BY 1"),
        "schema_and_preview": "SELECT * FROM (VALUES " + ", ".join(
            f"({n}, '{f.name}', '{f.dataType.simpleString()}', {f.nullable}, 5)"
            for n, f in enumerate(schemas.CLEAN.fields)) + ") AS t(position, \"column\", type, nullable, shown)",
        "stream_hourly_late": _sql(HOURLY),
        "stream_withdrawn_alerts": _changes(),
        "stream_stage_counts": _stage_counts(),
        "stream_concatenated_intake": _sql(readings),
        "stream_nested_intake": _sql(readings),
        "stream_quarantine": _sql(QUARANTINE),
        "stream_hourly_aqi": _sql(HOURLY),
        # a stream has no place in time for readings without one
        "stream_feature_table": _sql(feature_rows, timed_only=True),
        "stateful_feature_table": _sql(feature_rows, timed_only=True),
        "stream_scores": _sql(f"SELECT {SCORED_OUT} FROM scored"),
        "stream_alerts": _sql(found_rows),
        "stream_alerts_reference": _sql(found_rows),
    }
