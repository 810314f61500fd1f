"""The same results as SQL over the given tables, for an independent engine."""

from __future__ import annotations

from checks.queries import ALERT_DAY, AS_OF, EVENT_RULE, RULE
from checks.tables import TRANSACTION_COLUMNS, events_sql, transactions_sql


def tx(*columns: str, dirty: bool = False) -> str:
    return f"transactions AS ({transactions_sql(columns, 'duckdb', dirty)})"


EV = f"ev AS ({events_sql('duckdb')})"
ALERTS = (
    f"{EV}, alerts AS (SELECT substr(trans_date_trans_time,1,10) AS trans_day,"
    " CAST(trans_date_trans_time AS TIMESTAMP) AS trans_time, trans_num, cc_num, merchant, category, amt,"
    " 1e0 AS is_fraud, 0.95e0 AS prediction_score FROM ev WHERE is_fraud = 1)"
)
TIME_TEXT = "strftime(trans_time,'%Y-%m-%d %H:%M:%S')"
FEED = (
    "coalesce(trans_num,'') AS trans_num, coalesce(right(cc_num,4),'****') AS cc_num,"
    f" coalesce({TIME_TEXT},'') AS time, coalesce(substr({TIME_TEXT},12),'Now') AS clock,"
    " coalesce(merchant,'') AS merchant, substr(coalesce(merchant,''),1,18) AS merchant_short,"
    " coalesce(amt,0e0) AS amount, printf('%.2f',coalesce(amt,0e0)) AS amount_text, coalesce(category,'') AS category"
)
NEWEST = "ORDER BY trans_time DESC NULLS LAST, trans_num ASC"


def with_(select: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


def rounded(value: str, digits: int) -> str:
    return f"floor(({value})*1e{digits}+0.5e0)/1e{digits}"


def pct(part: str, whole: str, digits: int) -> str:
    return rounded(f"CAST({part} AS DOUBLE)*100e0/NULLIF({whole},0)", digits)


CENTS = "CAST(floor(amt*100e0+0.5e0) AS BIGINT)"
MONEY_SUM = f"CAST(SUM({CENTS}) AS DOUBLE)/100e0"
MONEY_MEAN = f"{MONEY_SUM}/NULLIF(COUNT(amt),0)"
TRAFFIC = (
    "COUNT(*) AS total_txn, CAST(SUM(is_fraud) AS BIGINT) AS fraud_txn,"
    f" {pct('SUM(is_fraud)', 'COUNT(*)', 2)} AS fraud_rate_pct, {rounded(MONEY_MEAN, 2)} AS avg_amount"
)
PROFILE = (
    f"SELECT is_fraud, {rounded(MONEY_MEAN, 2)} AS avg_amount,"
    f" {rounded('CAST(SUM(CAST(city_pop AS BIGINT)) AS DOUBLE)/COUNT(city_pop)', 2)} AS avg_city_pop,"
    f""" {rounded(f"CAST(SUM(DATE'{AS_OF}'-CAST(dob AS DATE)) AS DOUBLE)/COUNT(dob)/365.25e0", 1)} AS avg_age"""
    " FROM transactions GROUP BY is_fraud"
)
CHORD = (
    "pow(sin(radians(merch_lat-lat)/2e0),2)"
    "+cos(radians(lat))*cos(radians(merch_lat))*pow(sin(radians(merch_long-long)/2e0),2)"
)
KM = f"coalesce(2e0*6371e0*asin(sqrt(least(1e0,{CHORD}))),0e0)"
DEGREES = "sqrt(pow(lat-merch_lat,2)+pow(long-merch_long,2))"
AGE = f"CAST(year(DATE'{AS_OF}')-year(dob) AS INT)"


def unit_hash(salt: str) -> str:
    return f"CAST(concat('0x',substr(md5(concat('{salt}:',trans_num)),1,8)) AS BIGINT)/4294967296e0"


BALANCED = (
    f"(is_fraud=1 OR {unit_hash('balance-42')} <"
    " (SELECT CAST(count(*) FILTER (is_fraud=1) AS DOUBLE)*3e0/count(*) FILTER (is_fraud=0) FROM transactions))"
)
TEST_SIDE = f"{unit_hash('split-42')} >= 0.8e0"


def long_counts(columns: tuple[str, ...]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM transactions GROUP BY 2" for c in columns]
    return f"counted AS ({' UNION ALL '.join(parts)})"


RULE_CONFUSION = (
    f"scored AS (SELECT CAST(is_fraud AS DOUBLE) AS label, {RULE} AS prediction FROM transactions),"
    ' confusion AS (SELECT label, prediction, count(*) AS "count" FROM scored GROUP BY 1,2)'
)
PROFILE_COLUMNS = ("time_text", "merchant", "category", "amt", "gender", "state", "lat", "is_fraud")
MODE_COLUMNS = ("merchant", "category", "gender", "state", "city")
VALUE_COLUMNS = ("category", "gender", "state", "merchant")
HISTORY = (
    "cc_num", "trans_date_trans_time", "trans_num", "dob", "lat", "long", "merch_lat",
    "merch_long", "category", "merchant", "amt", "is_fraud",
)


def mode_of(column: str) -> str:
    return f"(SELECT {column} FROM transactions GROUP BY 1 ORDER BY count(*) DESC, {column} NULLS LAST LIMIT 1)"


def upserted() -> str:
    def write(number: int, merchant: str, keep: str) -> str:
        return (
            f"SELECT CAST(cc_num AS VARCHAR) AS cc_num, trans_date_trans_time AS trans_time, trans_num, {merchant} AS merchant, {number} AS nth,"
            " row_number() OVER (PARTITION BY cc_num, trans_date_trans_time ORDER BY trans_num DESC) AS r"
            f" FROM transactions WHERE is_fraud=1 AND {keep}"
        )

    both = f"({write(1, chr(39) + 'stale' + chr(39), 'amt <= 60000')}) UNION ALL ({write(2, 'merchant', 'amt > 30000')})"
    return with_(
        "SELECT cc_num, trans_time, trans_num, merchant, strftime(trans_time,'%Y-%m') AS trans_month FROM (SELECT *,"
        f" row_number() OVER (PARTITION BY cc_num, trans_time ORDER BY nth DESC) AS last FROM ({both}) b WHERE r=1) t WHERE last=1",
        tx(*HISTORY),
    )


ORACLE = {
    "kpi_overview": with_(
        "SELECT COUNT(*) AS total_transactions, CAST(SUM(is_fraud) AS BIGINT) AS total_fraud,"
        f" {pct('SUM(is_fraud)', 'COUNT(*)', 3)} AS fraud_rate_pct, {rounded(MONEY_MEAN, 2)} AS avg_amount,"
        f" {rounded('MAX(amt)', 2)} AS max_amount, MIN(trans_date_trans_time) AS first_date,"
        " MAX(trans_date_trans_time) AS last_date FROM transactions",
        tx("trans_date_trans_time", "amt", "is_fraud"),
    ),
    "daily_trend": with_(
        f"SELECT CAST(trans_date_trans_time AS DATE) AS txn_date, {TRAFFIC} FROM transactions GROUP BY 1 ORDER BY 1",
        tx("trans_date_trans_time", "amt", "is_fraud"),
    ),
    "missing_values": with_(
        "SELECT "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in ("cc_num", "merchant", "category", "amt", "city", "state"))
        + " FROM transactions",
        tx("cc_num", "merchant", "category", "amt", "city", "state", dirty=True),
    ),
    "amount_quantiles": with_(
        "SELECT "
        + ", ".join(f"quantile_disc(amt,{p}) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75))
        + ", max(amt) AS max_amt FROM transactions",
        tx("amt"),
    ),
    "high_risk_customers": with_(
        "SELECT * FROM (SELECT cc_num AS customer_id, COUNT(*) AS total_txn, CAST(SUM(is_fraud) AS BIGINT) AS fraud_txn,"
        f" {pct('SUM(is_fraud)', 'COUNT(is_fraud)', 2)} AS fraud_rate_pct, {MONEY_SUM} AS total_spent,"
        " MIN(trans_date_trans_time) AS first_txn_ts, MAX(trans_date_trans_time) AS last_txn_ts"
        " FROM transactions GROUP BY cc_num) c WHERE total_txn >= 50 AND fraud_txn >= 3"
        " ORDER BY fraud_rate_pct DESC, fraud_txn DESC, total_spent DESC, customer_id LIMIT 20",
        tx("cc_num", "trans_date_trans_time", "amt", "is_fraud"),
    ),
    "fraud_profile": with_(PROFILE, tx("is_fraud", "amt", "city_pop", "dob")),
    "fraud_profile_long": with_(
        "SELECT is_fraud, 'Avg Transaction Amount ($)' AS feature, avg_amount AS average FROM p"
        " UNION ALL SELECT is_fraud, 'Avg City Population', avg_city_pop FROM p"
        " UNION ALL SELECT is_fraud, 'Avg Customer Age', avg_age FROM p",
        tx("is_fraud", "amt", "city_pop", "dob"),
        f"p AS ({PROFILE})",
    ),
    "category_fraud": with_(
        f"SELECT category, {TRAFFIC} FROM transactions GROUP BY 1 ORDER BY fraud_rate_pct DESC, fraud_txn DESC, category LIMIT 20",
        tx("category", "amt", "is_fraud"),
    ),
    "state_fraud": with_(
        f"SELECT state, {TRAFFIC} FROM transactions GROUP BY 1 HAVING COUNT(*) > 1000"
        " ORDER BY fraud_rate_pct DESC, fraud_txn DESC, state LIMIT 20",
        tx("state", "amt", "is_fraud"),
    ),
    "fraud_distribution": with_(
        f'SELECT is_fraud, COUNT(*) AS "count", {rounded(MONEY_MEAN, 2)} AS avg_amount, {rounded("MAX(amt)", 2)} AS max_amount'
        " FROM transactions GROUP BY 1 ORDER BY 1",
        tx("amt", "is_fraud"),
    ),
    "category_avg": with_(f"SELECT category, {MONEY_MEAN} AS avg_amt FROM transactions GROUP BY 1", tx("category", "amt")),
    "sql_view": with_(
        "SELECT merchant, count(*) AS total_txn, max(amt) AS max_amount FROM transactions WHERE is_fraud = 1 GROUP BY merchant",
        tx("merchant", "amt", "is_fraud"),
    ),
    "parse_time": with_(
        "SELECT trans_num, try_strptime(time_text,'%Y-%m-%d %H:%M:%S') AS trans_time FROM transactions",
        tx("trans_num", "time_text", dirty=True),
    ),
    "age_years": with_(
        f"SELECT trans_num, {AGE} AS age, {rounded(f'''(DATE'{AS_OF}'-dob)/365.25e0''', 3)} AS age_exact FROM transactions",
        tx("trans_num", "dob"),
    ),
    "haversine": with_(
        f"SELECT trans_num, {rounded(f'CASE WHEN lat IS NULL THEN 0e0 ELSE {KM} END', 6)} AS distance_km FROM transactions",
        tx("trans_num", "lat", "long", "merch_lat", "merch_long", dirty=True),
    ),
    "euclid": with_(
        f"SELECT trans_num, {rounded(f'coalesce({DEGREES},0e0)', 6)} AS distance, {rounded(DEGREES, 6)} AS distance_or_null FROM transactions",
        tx("trans_num", "lat", "long", "merch_lat", "merch_long", dirty=True),
    ),
    "hourly": with_(
        "SELECT trans_num, CAST(hour(trans_date_trans_time) AS DOUBLE) AS trans_hour FROM transactions",
        tx("trans_num", "trans_date_trans_time"),
    ),
    "conform": with_(
        "SELECT trans_num, CAST(cc_num AS VARCHAR) AS cc_num, zip, amt, is_fraud, CAST(0 AS INT) AS city_pop, 0e0 AS lat,"
        " CAST(NULL AS VARCHAR) AS city FROM transactions",
        tx("trans_num", "cc_num", "zip", "amt", "is_fraud"),
    ),
    "model_features": with_(
        "SELECT trans_num, coalesce(amt,0e0) AS amt, CAST(coalesce(year(DATE'" + AS_OF + "')-year(dob),30) AS DOUBLE) AS age,"
        " CAST(hour(trans_date_trans_time) AS DOUBLE) AS trans_hour, CAST(coalesce(city_pop,0) AS DOUBLE) AS city_pop,"
        f" CAST(is_fraud AS DOUBLE) AS label, {rounded(f'coalesce({DEGREES},0e0)', 6)} AS distance FROM transactions",
        tx("trans_num", "trans_date_trans_time", "dob", "is_fraud", "amt", "city_pop", "lat", "long", "merch_lat", "merch_long", dirty=True),
    ),
    "enrich_history": with_(
        "SELECT trans_num, CAST(cc_num AS VARCHAR) AS cc_num, trans_date_trans_time AS trans_time,"
        f" {AGE} AS age, {rounded(KM, 6)} AS distance, CAST(is_fraud AS DOUBLE) AS is_fraud FROM transactions",
        tx(*HISTORY),
    ),
    "fraud_split": with_(
        "SELECT trans_num, CASE WHEN is_fraud=1 THEN 'fraud' ELSE 'non_fraud' END AS side FROM transactions WHERE is_fraud IN (0,1)",
        tx("trans_num", "is_fraud"),
    ),
    "union_all": with_(
        "SELECT trans_num, amt, is_fraud FROM transactions UNION ALL SELECT trans_num, amt, is_fraud FROM ev",
        tx("trans_num", "amt", "is_fraud"),
        EV,
    ),
    "recombine": with_(
        "SELECT count(*) AS total_rows, count(*) FILTER (is_fraud=1) AS fraud_rows, count(*) FILTER (is_fraud=0) AS non_fraud_rows"
        " FROM transactions WHERE is_fraud IN (0,1)",
        tx("trans_num", "amt", "is_fraud"),
    ),
    "customer_dim": with_(
        "SELECT DISTINCT cc_num, first, last, gender, street, city, state, zip, lat, long, job, CAST(dob AS TIMESTAMP) AS dob FROM transactions",
        tx("cc_num", "first", "last", "gender", "street", "city", "state", "zip", "lat", "long", "job", "dob"),
    ),
    "upsert_latest": with_(
        "SELECT trans_num, cc_num, trans_date_trans_time, txn_date FROM (SELECT *, row_number() OVER"
        " (PARTITION BY cc_num, txn_date ORDER BY trans_date_trans_time DESC, trans_num DESC) AS r FROM"
        " (SELECT *, CAST(trans_date_trans_time AS DATE) AS txn_date FROM transactions) d) t WHERE r=1",
        tx("trans_num", "cc_num", "trans_date_trans_time"),
    ),
    "describe": (
        "SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string'"
        " WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type FROM (DESCRIBE "
        f"({transactions_sql(tuple(TRANSACTION_COLUMNS), 'duckdb')}))"
    ),
    "preview": with_(
        "SELECT * FROM transactions ORDER BY trans_date_trans_time, trans_num LIMIT 5",
        tx("trans_num", "trans_date_trans_time", "amt", "is_fraud"),
    ),
    "column_mode": with_(
        'SELECT "column", value, n FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST) AS r'
        " FROM counted) c WHERE r=1 AND value IS NOT NULL",
        tx(*MODE_COLUMNS, dirty=True),
        long_counts(MODE_COLUMNS),
    ),
    "mode_impute": with_(
        f"SELECT trans_num, coalesce(category,{mode_of('category')}) AS category, coalesce(gender,{mode_of('gender')}) AS gender FROM transactions",
        tx("trans_num", "category", "gender", dirty=True),
    ),
    "value_counts": with_(
        'SELECT "column", value, n, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r'
        " FROM counted WHERE value IS NOT NULL) c WHERE r<=10",
        tx(*VALUE_COLUMNS, dirty=True),
        long_counts(VALUE_COLUMNS),
    ),
    "table_counts": with_(
        "SELECT count(*) AS total_rows, count(*) FILTER (is_fraud=1) AS fraud_rows, count(*) FILTER (is_fraud=0) AS non_fraud_rows FROM transactions",
        tx("is_fraud"),
    ),
    "table_profile": with_(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) FILTER ({c} IS NULL) AS nulls FROM transactions" for c in PROFILE_COLUMNS
        ),
        tx(*PROFILE_COLUMNS, dirty=True),
    ),
    "balance": with_(f"SELECT trans_num, is_fraud FROM transactions WHERE {BALANCED}", tx("trans_num", "is_fraud")),
    "split": with_(f"SELECT trans_num, {unit_hash('split-42')} < 0.8e0 AS is_train FROM transactions", tx("trans_num")),
    "live_stats": with_(
        f"SELECT fraud_count, non_fraud_count, customer_count, {pct('fraud_count', '(fraud_count+non_fraud_count)', 2)} AS fraud_rate FROM"
        " (SELECT (SELECT count(*) FROM transactions WHERE is_fraud=1)+(SELECT count(*) FROM alerts) AS fraud_count,"
        " (SELECT count(*) FROM transactions WHERE is_fraud=0) AS non_fraud_count, (SELECT count(*) FROM customer) AS customer_count) s",
        tx("is_fraud"),
        ALERTS,
    ),
    "recent_fraud": with_(f"SELECT {FEED}, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS \"long\" FROM (SELECT * FROM alerts {NEWEST} LIMIT 20) a", ALERTS),
    "recent_fraud_history": with_(
        f"SELECT {FEED}, merch_lat AS lat, merch_long AS \"long\" FROM (SELECT trans_num, CAST(cc_num AS VARCHAR) AS cc_num,"
        f" trans_date_trans_time AS trans_time, merchant, amt, category, merch_lat, merch_long FROM transactions WHERE is_fraud=1 {NEWEST} LIMIT 20) a",
        tx("trans_num", "trans_date_trans_time", "cc_num", "merchant", "amt", "category", "merch_lat", "merch_long", "is_fraud"),
    ),
    "category_top": with_(
        "SELECT substr(upper(substr(category,1,1))||lower(substr(replace(category,'_',' '),2)),1,15) AS label, count(*) AS fraud_count FROM"
        " (SELECT coalesce(category,'Unknown') AS category FROM transactions WHERE is_fraud=1 UNION ALL SELECT coalesce(category,'Unknown') FROM alerts) u"
        " GROUP BY 1 ORDER BY fraud_count DESC, label LIMIT 6",
        tx("category", "is_fraud"),
        ALERTS,
    ),
    "fraud_points": with_(
        "SELECT trans_num, merch_lat AS lat, merch_long AS long, merchant, amt FROM transactions WHERE is_fraud=1 AND merch_lat IS NOT NULL"
        " AND merch_long IS NOT NULL ORDER BY trans_date_trans_time DESC, trans_num LIMIT 1000",
        tx("trans_num", "trans_date_trans_time", "merch_lat", "merch_long", "merchant", "amt", "is_fraud"),
    ),
    "txn_status": with_(
        "SELECT trans_num, strftime(trans_date_trans_time,'%Y-%m-%d %H:%M:%S') AS time, coalesce(right(CAST(cc_num AS VARCHAR),4),'****') AS card,"
        " amt AS amount, substr(coalesce(merchant,'Unknown'),1,20) AS merchant, CASE WHEN is_fraud=1 THEN 'FRAUD' ELSE 'Safe' END AS status"
        " FROM transactions ORDER BY trans_date_trans_time DESC, trans_num LIMIT 15",
        tx("trans_num", "trans_date_trans_time", "cc_num", "amt", "merchant", "is_fraud"),
    ),
    "alerts_by_day": with_("SELECT trans_day, count(*) AS alerts FROM alerts GROUP BY 1 ORDER BY 1", ALERTS),
    "alerts_of_day": with_(f"SELECT {FEED} FROM (SELECT * FROM alerts WHERE trans_day='{ALERT_DAY}' {NEWEST} LIMIT 5) a", ALERTS),
    "alerts_label": with_("SELECT * FROM alerts", ALERTS),
    "running_totals": with_(
        "SELECT count(*) AS total_processed, count(*) FILTER (is_fraud=1) AS fraud_count,"
        " count(*)*1e6/(epoch_us(max(CAST(trans_date_trans_time AS TIMESTAMP)))-epoch_us(min(CAST(trans_date_trans_time AS TIMESTAMP)))) AS per_second FROM ev",
        EV,
    ),
    "alert_rate_5m": with_(
        "SELECT time_bucket(INTERVAL 5 MINUTE, trans_time) AS window_start, time_bucket(INTERVAL 5 MINUTE, trans_time) + INTERVAL 5 MINUTE AS window_end,"
        " count(*) AS new_alerts FROM alerts GROUP BY 1",
        ALERTS,
    ),
    "detection_rate_60": with_(
        "SELECT window_start, count(trans_time) AS new_alerts FROM axis LEFT JOIN alerts ON time_bucket(INTERVAL 5 MINUTE, trans_time)=window_start GROUP BY 1",
        ALERTS,
        "axis AS (SELECT time_bucket(INTERVAL 5 MINUTE, last) - to_minutes(CAST(5*i AS INT)) AS window_start"
        " FROM (SELECT max(trans_time) AS last FROM alerts) m, range(60) r(i))",
    ),
    "score_rule": with_(
        "SELECT strftime(trans_date_trans_time,'%Y-%m-%d') AS trans_day, trans_date_trans_time AS trans_time, trans_num, CAST(cc_num AS VARCHAR) AS cc_num,"
        f" merchant, category, amt, 1e0 AS is_fraud, amt/2e5 AS prediction_score FROM transactions WHERE {RULE} = 1",
        tx("trans_num", "trans_date_trans_time", "cc_num", "merchant", "category", "amt"),
    ),
    "confusion": with_("SELECT * FROM confusion", tx("cc_num", "amt", "is_fraud"), RULE_CONFUSION),
    "class_metrics": with_(
        f"SELECT {rounded('CAST(SUM(hits) AS DOUBLE)/SUM(actual)', 9)} AS accuracy,"
        f" {rounded('SUM(p*actual)/SUM(actual)', 9)} AS weighted_precision, {rounded('SUM(r*actual)/SUM(actual)', 9)} AS weighted_recall,"
        f" {rounded('SUM(coalesce(2e0*p*r/NULLIF(p+r,0),0e0)*actual)/SUM(actual)', 9)} AS f1 FROM m",
        tx("cc_num", "amt", "is_fraud"),
        RULE_CONFUSION,
        'c AS (SELECT k.c AS cls, coalesce(SUM("count") FILTER (label=k.c),0) AS actual, coalesce(SUM("count") FILTER (prediction=k.c),0) AS predicted,'
        ' coalesce(SUM("count") FILTER (label=k.c AND prediction=k.c),0) AS hits FROM confusion, (VALUES (0e0),(1e0)) k(c) GROUP BY 1)',
        "m AS (SELECT *, coalesce(hits/NULLIF(CAST(predicted AS DOUBLE),0),0e0) AS p, coalesce(hits/NULLIF(CAST(actual AS DOUBLE),0),0e0) AS r FROM c)",
    ),
    "exact_auc": with_(
        f"SELECT CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives, {rounded('CAST(SUM(pos*(2*coalesce(below,0)+neg)) AS DOUBLE)/CAST(2*SUM(pos)*SUM(neg) AS DOUBLE)', 12)} AS auc"
        " FROM (SELECT *, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM"
        " (SELECT floor(amt/50) AS score, count(*) FILTER (is_fraud=1) AS pos, count(*) FILTER (is_fraud=0) AS neg FROM transactions GROUP BY 1) c) r",
        tx("amt", "is_fraud"),
    ),
    "string_index": with_(
        "SELECT \"column\", value, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value)-1 AS DOUBLE) AS idx, n FROM"
        " (SELECT 'category' AS \"column\", category AS value, count(*) AS n FROM transactions GROUP BY 2"
        " UNION ALL SELECT 'gender', gender, count(*) FROM transactions GROUP BY 2) c",
        tx("category", "gender"),
    ),
    "standard_scale": with_(
        f"SELECT trans_num, {rounded('(amt-ma)/sa', 4)} AS amt_z, {rounded('(h-mh)/sh', 4)} AS hour_z FROM t,"
        " (SELECT avg(amt) AS ma, stddev_samp(amt) AS sa, avg(h) AS mh, stddev_samp(h) AS sh FROM t) s",
        tx("trans_num", "trans_date_trans_time", "amt"),
        "t AS (SELECT trans_num, amt, CAST(hour(trans_date_trans_time) AS DOUBLE) AS h FROM transactions)",
    ),
    "forest_test_rows": with_(
        f"SELECT 'balanced' AS \"on\", CAST(is_fraud AS DOUBLE) AS label, count(*) AS n FROM transactions WHERE {BALANCED} AND {TEST_SIDE} GROUP BY 2"
        f" UNION ALL SELECT 'true_mix', CAST(is_fraud AS DOUBLE), count(*) FROM transactions WHERE {TEST_SIDE} GROUP BY 2",
        tx("trans_num", "is_fraud"),
    ),
    "decode_json": "SELECT event_id, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events",
    "encode_json": with_(
        "SELECT CAST(to_json({trans_num: trans_num, cc_num: cc_num, category: category, amt: amt, dob: CAST(dob AS VARCHAR), is_fraud: is_fraud}) AS VARCHAR)"
        ' AS "value" FROM ev',
        EV,
    ),
    "decode_messages": with_(
        "SELECT CASE WHEN cut THEN NULL ELSE trans_num END AS trans_num, CASE WHEN cut THEN NULL ELSE amt END AS amt,"
        " CASE WHEN cut THEN NULL ELSE CAST(dob AS VARCHAR) END AS dob, CAST(CASE WHEN cut THEN NULL ELSE is_fraud END AS DOUBLE) AS is_fraud,"
        """ CASE WHEN cut THEN substr(concat('{"trans_num":"',trans_num,'","trans_date_trans_time":"',trans_date_trans_time,'","cc_num":"',cc_num),1,60) END"""
        " AS _malformed FROM (SELECT *, CAST(trans_num AS INT)%10=0 AS cut FROM ev) e",
        EV,
    ),
    "csv_source": with_(
        "SELECT trans_num, strftime(trans_date_trans_time,'%Y-%m-%d %H:%M:%S') AS trans_date_trans_time, zip, amt, city_pop, is_fraud FROM transactions",
        tx("trans_num", "trans_date_trans_time", "zip", "amt", "city_pop", "is_fraud"),
    ),
    "csv_folder": with_(
        "SELECT trans_num, strftime(trans_date_trans_time,'%Y-%m-%d %H:%M:%S') AS trans_date_trans_time, CAST(cc_num AS VARCHAR) AS cc_num, zip, amt, city_pop, job, is_fraud"
        " FROM transactions",
        tx("trans_num", "trans_date_trans_time", "cc_num", "zip", "amt", "city_pop", "job", "is_fraud"),
    ),
    "source_order": with_(
        "SELECT count(*) AS total_rows, count(*) FILTER (is_fraud=1) AS fraud_rows, count(*) FILTER (is_fraud=0) AS non_fraud_rows, 'full' AS source FROM transactions",
        tx("is_fraud"),
    ),
    "snapshot_rows": with_("SELECT * FROM transactions", tx("trans_num", "cc_num", "amt")),
    "keyed_upsert": upserted(),
    "table_samples": with_(
        "SELECT * FROM (SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY md5(k)) AS INT) AS place, cc_num, trans_time, trans_num, merchant FROM s) t WHERE place<=5",
        tx("cc_num", "trans_date_trans_time", "trans_num", "merchant", "amt", "is_fraud"),
        "w AS (SELECT CAST(cc_num AS VARCHAR) AS cc_num, trans_num, trans_date_trans_time AS trans_time, 'stale' AS merchant, amt, is_fraud, 1 AS nth FROM transactions WHERE amt<=60000"
        " UNION ALL SELECT CAST(cc_num AS VARCHAR), trans_num, trans_date_trans_time, merchant, amt, is_fraud, 2 FROM transactions WHERE amt>30000)",
        ALERTS,
        "s AS (SELECT name, concat(cc_num,'|',epoch_us(trans_time)) AS k, cc_num, trans_time, CAST(NULL AS VARCHAR) AS trans_num, merchant FROM"
        " (SELECT *, row_number() OVER (PARTITION BY name, cc_num, trans_time ORDER BY nth DESC, trans_num DESC) AS last"
        " FROM (SELECT CASE WHEN is_fraud=1 THEN 'fraud_transaction' ELSE 'non_fraud_transaction' END AS name, * FROM w) h) t WHERE last=1"
        " UNION ALL SELECT 'customer', cc_num, cc_num, CAST(NULL AS TIMESTAMP), NULL, NULL FROM (SELECT DISTINCT cc_num FROM w) c"
        " UNION ALL SELECT 'fraud_alert', concat(trans_day,'|',epoch_us(trans_time),'|',trans_num), CAST(NULL AS VARCHAR), trans_time, trans_num, merchant FROM alerts)",
    ),
    "import_rows": with_(
        "SELECT name, cc_num, trans_num, trans_time, merchant, amt FROM (SELECT *, row_number() OVER (PARTITION BY name, cc_num, trans_time ORDER BY nth DESC, trans_num DESC) AS last"
        " FROM (SELECT CASE WHEN is_fraud=1 THEN 'fraud_transaction' ELSE 'non_fraud_transaction' END AS name, * FROM w) h) t WHERE last=1"
        " UNION ALL SELECT 'transactions', cc_num, trans_num, trans_time, merchant, amt FROM"
        " (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY nth DESC) AS last FROM w) t WHERE last=1",
        tx("cc_num", "trans_date_trans_time", "trans_num", "merchant", "amt", "is_fraud"),
        "w AS (SELECT CAST(cc_num AS VARCHAR) AS cc_num, trans_num, trans_date_trans_time AS trans_time, 'stale' AS merchant, amt, is_fraud, 1 AS nth FROM transactions WHERE amt<=60000"
        " UNION ALL SELECT CAST(cc_num AS VARCHAR), trans_num, trans_date_trans_time, merchant, amt, is_fraud, 2 FROM transactions WHERE amt>30000)",
    ),
    "resumed_write": with_("SELECT * FROM transactions", tx("trans_num", "cc_num", "amt", "category")),
    "rollup_reports": with_(
        "SELECT 'all' AS report, concat(min(t),'/',max(t)) AS key, COUNT(*) AS total_txn, CAST(SUM(is_fraud) AS BIGINT) AS fraud_txn,"
        f" {pct('SUM(is_fraud)', 'COUNT(*)', 3)} AS fraud_rate_pct, {rounded(MONEY_MEAN, 2)} AS avg_amount, {rounded('max(amt)', 2)} AS max_amount FROM w"
        f" UNION ALL SELECT 'day', substr(t,1,10), {TRAFFIC}, NULL FROM w GROUP BY 2"
        f" UNION ALL SELECT 'category', category, {TRAFFIC}, NULL FROM w GROUP BY 2"
        f" UNION ALL SELECT 'state', state, {TRAFFIC}, NULL FROM w GROUP BY 2",
        tx("trans_date_trans_time", "category", "state", "amt", "is_fraud"),
        "w AS (SELECT strftime(trans_date_trans_time,'%Y-%m-%d %H:%M:%S') AS t, CASE WHEN amt>30000 THEN category ELSE 'stale' END AS category, state,"
        " CASE WHEN amt>30000 THEN amt ELSE amt*2 END AS amt, is_fraud FROM transactions)",
    ),
    "log_structured_upserts": with_(
        "SELECT trans_num, CAST(cc_num AS VARCHAR) AS cc_num, CASE WHEN amt>60000 THEN merchant WHEN amt>30000 THEN 'second' ELSE 'first' END AS merchant, amt, zip, is_fraud FROM transactions",
        tx("trans_num", "cc_num", "merchant", "amt", "zip", "is_fraud"),
    ),
    "log_structured_versions": with_(
        "SELECT 1 AS version, trans_num, 'stale' AS merchant FROM transactions WHERE amt<=60000"
        " UNION ALL SELECT 2, trans_num, CASE WHEN amt>30000 THEN merchant ELSE 'stale' END FROM transactions",
        tx("trans_num", "merchant", "amt"),
    ),
    "keyed_training_features": with_(
        "SELECT trans_num, category, gender, amt, CAST(year(DATE'" + AS_OF + "')-year(dob) AS DOUBLE) AS age,"
        " CAST(hour(trans_date_trans_time) AS DOUBLE) AS trans_hour, CAST(city_pop AS DOUBLE) AS city_pop, lat, long,"
        f" CAST(is_fraud AS DOUBLE) AS label, {rounded(DEGREES, 6)} AS distance FROM (SELECT *,"
        " row_number() OVER (PARTITION BY is_fraud, cc_num, trans_date_trans_time ORDER BY trans_num DESC) AS last FROM transactions) t WHERE last=1",
        tx("trans_num", "cc_num", "trans_date_trans_time", "category", "gender", "dob", "is_fraud", "amt", "city_pop", "lat", "long", "merch_lat", "merch_long"),
    ),
    "import_tables": with_(
        "SELECT 'customer' AS name, count(DISTINCT cc_num) AS n FROM transactions"
        " UNION ALL SELECT 'fraud_transaction', count(*) FROM (SELECT DISTINCT cc_num, trans_date_trans_time FROM transactions WHERE is_fraud=1) f"
        " UNION ALL SELECT 'non_fraud_transaction', count(*) FROM (SELECT DISTINCT cc_num, trans_date_trans_time FROM transactions WHERE is_fraud=0) f"
        " UNION ALL SELECT 'transactions', count(*) FROM transactions UNION ALL SELECT 'observed', count(*) FROM transactions",
        tx("cc_num", "trans_date_trans_time", "is_fraud"),
    ),
    "stream_alerts": with_(
        "SELECT substr(trans_date_trans_time,1,10) AS trans_day, CAST(trans_date_trans_time AS TIMESTAMP) AS trans_time, trans_num, cc_num,"
        f" merchant, category, amt, 1e0 AS is_fraud, amt/2e5 AS prediction_score FROM ev WHERE {EVENT_RULE} = 1",
        EV,
    ),
    "stream_label_alerts": with_("SELECT * FROM alerts", ALERTS),
    "stream_two_checkpoints": with_("SELECT * FROM alerts", ALERTS),
    "stream_folded_alerts": with_("SELECT * FROM alerts", ALERTS),
    "stream_stored_totals": with_(
        "SELECT count(*) AS total_processed, count(*) FILTER (is_fraud=1) AS fraud_count, count(*)*1e6/(epoch_us(max(t))-epoch_us(min(t))) AS per_second,"
        " count(*) FILTER (t>=since) AS recent_processed, count(*) FILTER (t>=since)*1e6/(epoch_us(max(t))-epoch_us(max(since))) AS recent_per_second"
        " FROM timed, (SELECT date_trunc('minute', max(t)) - INTERVAL 4 MINUTE AS since FROM timed) s",
        EV,
        "timed AS (SELECT CAST(trans_date_trans_time AS TIMESTAMP) AS t, is_fraud FROM ev)",
    ),
    "stream_window_counts": with_(
        "SELECT time_bucket(INTERVAL 5 MINUTE, trans_time) AS window_start, time_bucket(INTERVAL 5 MINUTE, trans_time) + INTERVAL 5 MINUTE AS window_end,"
        " count(*) AS new_alerts FROM alerts GROUP BY 1",
        ALERTS,
    ),
    "stream_new_alerts": with_('SELECT count(*) AS "new" FROM alerts', ALERTS),
    "stream_windows": with_(
        "SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, trans_time) AS window_start,"
        " time_bucket(INTERVAL 5 MINUTE, trans_time) + INTERVAL 5 MINUTE AS window_end, count(*) AS new_alerts FROM alerts GROUP BY 1) w"
        " WHERE window_end <= (SELECT max(trans_time) - INTERVAL 10 MINUTE FROM alerts)",
        ALERTS,
    ),
    "stream_notifications": with_(
        'SELECT (SELECT count(*) FROM alerts) AS "new", (SELECT count(*) FROM alerts WHERE trans_day=(SELECT max(trans_day) FROM alerts)) AS "count",'
        f" trans_num, cc_num, time, merchant, amount, category FROM (SELECT {FEED} FROM (SELECT * FROM alerts {NEWEST} LIMIT 5) a) f",
        ALERTS,
    ),
    "stream_totals": with_(
        "SELECT count(*) AS total_processed, count(*) FILTER (is_fraud=1) AS fraud_count,"
        " count(*)*1e6/(epoch_us(max(CAST(trans_date_trans_time AS TIMESTAMP)))-epoch_us(min(CAST(trans_date_trans_time AS TIMESTAMP)))) AS per_second FROM ev",
        EV,
    ),
}
