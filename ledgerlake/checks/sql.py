"""The registered queries as SQL for an independent engine.

Each statement starts from the given tables. Shared steps are named, with the steps they need, and put in front of a
statement as common table expressions.
"""

from __future__ import annotations

AS_OF_YEAR, AS_OF_MONTH = 2024, 6
FIRST_DAY, LAST_DAY = "1995-03-15", "1996-05-20"

MONEY = "concat('$', format('{{:,.2f}}', {}))"


def _money(expression: str) -> str:
    return MONEY.format(expression)


def _clean(column: str, precision: int, scale: int) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[$,]', '', 'g') AS DECIMAL({precision},{scale}))"


def _limit(column: str) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[^0-9.-]', '', 'g') AS DECIMAL(12,2))"


def _part(column: str, group: int, low: int, high: int) -> str:
    number = f"TRY_CAST(regexp_extract({column}, '^([0-9]{{1,2}})/([0-9]{{4}})$', {group}) AS INTEGER)"
    return f"CASE WHEN {number} BETWEEN {low} AND {high} THEN {number} END"


def _expired(column: str) -> str:
    year, month = _part(column, 2, 1900, 2100), _part(column, 1, 1, 12)
    return f"""CASE WHEN ({year}) IS NULL OR ({month}) IS NULL THEN NULL
        WHEN ({year}) < {AS_OF_YEAR} OR (({year}) = {AS_OF_YEAR} AND ({month}) < {AS_OF_MONTH}) THEN true
        ELSE false END"""


def _age_group(age: str) -> str:
    return f"""CASE WHEN {age} < 18 THEN 'Under 18' WHEN {age} < 35 THEN '18-34' WHEN {age} < 50 THEN '35-49'
        WHEN {age} < 65 THEN '50-64' ELSE '65+' END"""


def _income_group(income: str) -> str:
    return f"""CASE WHEN {income} < 30000 THEN 'Low Income' WHEN {income} < 70000 THEN 'Middle Income'
        ELSE 'High Income' END"""


def _average(column: str) -> str:
    """Exact mean of a DECIMAL(18,4), half up to cents."""
    total, n = f"sum({column})", f"count({column})"
    return f"""CAST(CAST(sign({total}) * ((2 * abs(CAST({total} * 10000 AS HUGEINT)) + 100 * {n}) // (200 * {n}))
        AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"""


def _ratio(amount: str, limit: str) -> str:
    """Exact quotient of DECIMAL(18,4) and DECIMAL(12,2), half up to four places."""
    a, b = f"CAST({amount} * 10000 AS HUGEINT)", f"CAST({limit} * 100 AS HUGEINT)"
    return f"""CASE WHEN {limit} > 0 THEN CAST(CAST(sign({amount}) * ((200 * abs({a}) + {b}) // (2 * {b}))
        AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) ELSE CAST(0 AS DECIMAL(10,4)) END"""


def _sum_if(amount: str, condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {amount} ELSE 0 END)"


def _dec(expression: str, precision: int, scale: int) -> str:
    return f"CAST({expression} AS DECIMAL({precision},{scale}))"


def _int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


# name -> (steps it needs, statement)
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "in_users": (
        (),
        f"""
        SELECT {_int('c_custkey')} AS id,
               CASE WHEN c_custkey % 67 <> 9 THEN {_int('2020 + v - (1935 + c_custkey % 80)')} END AS current_age,
               {_int('60 + c_custkey % 10')} AS retirement_age,
               CASE WHEN c_custkey % 41 <> 5 THEN {_int('1935 + c_custkey % 80')} END AS birth_year,
               {_int('1 + c_custkey % 12')} AS birth_month,
               CASE WHEN c_custkey % 101 = 3 THEN 'Unknown' WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
               c_name AS address,
               CAST(c_nationkey * 1.5 AS DECIMAL(9,6)) AS latitude,
               CAST(c_nationkey * -2.5 AS DECIMAL(9,6)) AS longitude,
               {_money('abs(c_acctbal)')} AS per_capita_income,
               CASE WHEN c_custkey % 50 = 8 THEN 'n/a'
                    WHEN c_custkey % 50 <> 7 THEN {_money('abs(c_acctbal) * 10 + v * 1000')} END AS yearly_income,
               {_money('c_acctbal')} AS total_debt,
               {_int('300 + c_custkey % 551')} AS credit_score,
               {_int('1 + c_custkey % 5')} AS num_credit_cards,
               make_timestamp(2020 + v, 1, 1, 0, 0, 0) AS load_at
        FROM customer, (VALUES (0), (1), (2)) versions(v)
        WHERE v <= CASE WHEN c_custkey % 9 = 0 THEN 2 WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END
        """,
    ),
    "in_cards": (
        (),
        f"""
        SELECT {_int('p_partkey')} AS id,
               {_int('p_partkey % ((SELECT count(*) FROM customer) * 11 // 10)')} AS client_id,
               lower(p_brand) AS card_brand, p_type AS card_type,
               lpad(CAST(p_partkey AS VARCHAR), 16, '4') AS card_number,
               CASE WHEN p_partkey % 37 = 5 THEN 'unknown'
                    ELSE concat(p_partkey % 14, '/', 1995 + p_size) END AS expires,
               lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS CVV,
               CASE WHEN p_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip,
               {_int('1 + p_partkey % 3')} AS num_cards_issued,
               CASE WHEN p_partkey % 40 = 3 THEN ''
                    WHEN p_partkey % 40 = 4 THEN concat('USD ', {_money('p_retailprice * (v + 1)')})
                    WHEN p_partkey % 40 = 5 THEN '$0.00'
                    ELSE {_money('p_retailprice * (v + 1)')} END AS credit_limit,
               concat(p_partkey % 12 + 1, '/', 1890 + p_partkey % 130) AS acct_open_date,
               {_int('2000 + p_partkey % 20')} AS year_pin_last_changed,
               CASE WHEN p_partkey % 10 = 0 THEN 'Yes' WHEN p_partkey % 10 <> 1 THEN 'No' END AS card_on_dark_web,
               make_timestamp(2020 + v, 1, 1, 0, 0, 0) AS load_at
        FROM part, (VALUES (0), (1)) versions(v)
        WHERE v <= CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END
        """,
    ),
    "in_transactions": (
        (),
        f"""
        SELECT {_int('o_orderkey')} AS id,
               o_orderdate + to_hours({_int('(o_orderkey * 13 + o_custkey) % 24')}) AS date_time,
               {_int('''CASE WHEN o_orderkey % 97 = 11 THEN NULL WHEN o_orderkey % 25 = 24 THEN -1 - o_custkey
                    ELSE o_custkey END''')} AS client_id,
               {_int('o_orderkey % ((SELECT count(*) FROM part) * 11 // 10)')} AS card_id,
               CASE WHEN o_orderkey % 211 = 7 THEN 'abc' WHEN o_orderkey % 53 = 5 THEN '$0.00'
                    WHEN o_orderkey % 211 <> 8 THEN
                    {_money("CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END")} END AS amount,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' WHEN o_orderpriority = '2-HIGH' THEN 'yes'
                    WHEN o_orderpriority <> '3-MEDIUM' THEN 'No' END AS use_chip,
               {_int('''CASE WHEN o_orderkey % 101 = 13 THEN NULL WHEN o_orderkey % 3 = 0 THEN 7
                    ELSE (o_orderkey * 3 + o_custkey) % (SELECT count(*) FROM supplier) END''')} AS merchant_id,
               CASE WHEN o_orderkey % 31 <> 4 THEN n_name END AS merchant_city,
               r_name AS merchant_state,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 1000 AS VARCHAR) END AS zip,
               CASE WHEN o_orderkey % 89 <> 3 THEN {_int('5000 + (o_orderkey * 7) % 55')} END AS mcc,
               CASE WHEN o_orderkey % 40 = 0 THEN 'Bad PIN' WHEN o_orderkey % 40 = 1 THEN '' END AS errors,
               make_timestamp(2020, 1, 1, 0, 0, 0) AS load_at
        FROM orders
        JOIN nation ON n_nationkey = (o_orderkey + o_custkey) % 25
        JOIN region ON n_regionkey = r_regionkey
        """,
    ),
    "in_mcc": (
        (),
        f"""
        SELECT {_int('5000 + p_size')} AS mcc_code, concat(min(p_name), ', ', max(p_name)) AS description
        FROM part GROUP BY p_size
        """,
    ),
    "in_labels": (
        (),
        f"""
        SELECT {_int('CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_orderkey ELSE o_orderkey END')} AS transaction_id,
               CASE WHEN o_orderkey % 17 = 0 THEN 'YES' WHEN o_orderkey % 17 = 1 THEN 'Yes' ELSE 'No' END AS is_fraud
        FROM orders
        """,
    ),
    "in_cdc": (
        (),
        """
        SELECT CAST(user_id AS VARCHAR) AS kafka_key, event_id AS kafka_offset, ts AS kafka_timestamp,
               CASE WHEN event_id % 97 = 1 THEN concat('broken ', op)
                    ELSE concat('{"op":"', op, '","ts_ms":', 1700000000000 + event_id, ',"after":', props, '}') END
                    AS cdc_payload,
               CASE WHEN event_id % 97 <> 1 THEN op END AS operation,
               CASE WHEN event_id % 97 <> 1 THEN 1700000000000 + event_id END AS cdc_timestamp
        FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'r'
                        ELSE 'u' END AS op FROM events)
        """,
    ),
    "typed_transactions": (
        ("in_transactions",),
        """
        SELECT id, date_time, CAST(date_time AS DATE) AS date, client_id, card_id, amount, use_chip, merchant_id,
               merchant_city, merchant_state, zip, mcc, nullif(errors, '') AS errors
        FROM in_transactions
        """,
    ),
    "s_users": (
        ("in_users",),
        f"""
        SELECT id AS client_id, {AS_OF_YEAR} - birth_year AS current_age, retirement_age, birth_year, birth_month,
               {_age_group(f'({AS_OF_YEAR} - birth_year)')} AS age_group, gender, address, latitude, longitude,
               {_clean('per_capita_income', 15, 2)} AS per_capita_income,
               {_clean('yearly_income', 15, 2)} AS yearly_income,
               {_income_group(_clean('yearly_income', 15, 2))} AS income_group,
               {_clean('total_debt', 15, 2)} AS total_debt, credit_score, num_credit_cards,
               load_at AS valid_from, lead(load_at) OVER versions AS valid_to,
               lead(load_at) OVER versions IS NULL AS is_current
        FROM in_users WINDOW versions AS (PARTITION BY id ORDER BY load_at)
        """,
    ),
    "s_cards": (
        ("in_cards",),
        f"""
        SELECT id AS card_id, client_id, upper(card_brand) AS card_brand, upper(card_type) AS card_type,
               expires AS expires_date, {_part('expires', 2, 1900, 2100)} AS expires_year,
               {_part('expires', 1, 1, 12)} AS expires_month, {_expired('expires')} AS is_expires,
               upper(has_chip) = 'YES' AS has_chip, num_cards_issued, {_limit('credit_limit')} AS credit_limit,
               acct_open_date, {_part('acct_open_date', 2, 1900, 2100)} AS acct_open_year,
               {_part('acct_open_date', 1, 1, 12)} AS acct_open_month, year_pin_last_changed, card_on_dark_web,
               load_at AS valid_from, lead(load_at) OVER versions AS valid_to,
               lead(load_at) OVER versions IS NULL AS is_current
        FROM in_cards WINDOW versions AS (PARTITION BY id ORDER BY load_at)
        """,
    ),
    "s_transactions": (
        ("in_transactions", "s_users", "s_cards"),
        f"""
        SELECT t.id AS transaction_id, t.client_id, u.client_id IS NOT NULL AS has_client_key, t.card_id,
               c.card_id IS NOT NULL AS has_card_key, date_time,
               {_int('day(date_time)')} AS day, {_int('hour(date_time)')} AS hour,
               {_clean('amount', 18, 4)} AS amount, coalesce(use_chip IN ('Yes', 'yes'), false) AS use_chip,
               merchant_id, merchant_city, merchant_state, zip, mcc, errors, errors IS NOT NULL AS is_error,
               {_int('year(date_time)')} AS year, {_int('month(date_time)')} AS month
        FROM in_transactions t
        LEFT JOIN (SELECT client_id FROM s_users WHERE is_current) u ON t.client_id = u.client_id
        LEFT JOIN (SELECT card_id FROM s_cards WHERE is_current) c ON t.card_id = c.card_id
        """,
    ),
    "detail": (
        ("s_transactions", "s_users", "s_cards", "in_mcc", "in_labels"),
        f"""
        SELECT CAST(t.transaction_id AS BIGINT) AS transaction_id, t.client_id, {_int('t.year - u.birth_year')} AS client_age,
               u.latitude AS client_latitude, u.longitude AS client_longitude,
               u.credit_score AS client_credit_score, u.num_credit_cards AS client_num_credit_cards,
               t.card_id, c.card_brand, c.card_type, c.acct_open_year AS card_open_year,
               c.expires_year AS card_expires_year, c.credit_limit AS card_credit_limit,
               coalesce(c.card_on_dark_web = 'Yes', false) AS card_on_dark_web, t.amount AS txn_amount,
               {_ratio('t.amount', 'c.credit_limit')} AS txn_spending_ratio, t.use_chip AS txn_use_chip,
               t.date_time AS txn_date_time, t.hour AS txn_hour, t.merchant_id, t.merchant_city, t.merchant_state,
               t.zip AS merchant_zip, t.mcc, m.description AS mcc_description, t.is_error,
               coalesce(l.is_fraud = 'YES', false) AS is_fraud,
               t.year AS txn_year, t.month AS txn_month, t.day AS txn_day,
               CAST(t.date_time AS DATE) AS txn_date, CAST(date_trunc('month', t.date_time) AS DATE) AS txn_first
        FROM s_transactions t
        LEFT JOIN in_mcc m ON t.mcc = m.mcc_code
        LEFT JOIN in_labels l ON t.transaction_id = l.transaction_id
        LEFT JOIN (SELECT * FROM s_users WHERE is_current) u ON t.client_id = u.client_id
        LEFT JOIN (SELECT * FROM s_cards WHERE is_current) c ON t.card_id = c.card_id
        """,
    ),
    "daily": (
        ("detail",),
        f"""
        SELECT txn_date AS period_date, sum(txn_amount) AS total, {_sum_if('txn_amount', 'txn_amount >= 0')} AS pos,
               {_sum_if('abs(txn_amount)', 'txn_amount < 0')} AS neg, {_average('txn_amount')} AS avg_amt,
               count(transaction_id) AS cnt, count(*) FILTER (txn_amount >= 0) AS pos_cnt,
               count(*) FILTER (txn_amount < 0) AS neg_cnt, count(*) FILTER (is_fraud) AS fraud_cnt,
               count(*) FILTER (is_error) AS error_cnt, count(DISTINCT client_id) AS clients,
               count(DISTINCT merchant_id) AS merchants
        FROM detail GROUP BY txn_date
        """,
    ),
    "peak": (
        ("detail",),
        """
        SELECT period_date, txn_hour AS peak_hour, n AS peak_hour_cnt
        FROM (SELECT txn_date AS period_date, txn_hour, count(transaction_id) AS n FROM detail GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY period_date ORDER BY n DESC, txn_hour NULLS LAST) = 1
        """,
    ),
    "top_mcc": (
        ("detail",),
        """
        SELECT period_date, mcc AS merchant_top_mcc, n AS merchant_top_mcc_cnt
        FROM (SELECT txn_date AS period_date, mcc, count(transaction_id) AS n FROM detail GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY period_date ORDER BY n DESC, mcc NULLS LAST) = 1
        """,
    ),
    "top_merchant": (
        ("detail",),
        """
        SELECT client_id, merchant_id AS merchant_top_id, n AS merchant_top_txn_cnt
        FROM (SELECT client_id, merchant_id, count(*) AS n FROM detail GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY n DESC, merchant_id NULLS LAST) = 1
        """,
    ),
    "newcomers": (
        ("detail",),
        """
        SELECT first_date AS period_date, count(client_id) AS client_new_cnt
        FROM (SELECT client_id, min(txn_date) AS first_date FROM detail GROUP BY client_id) GROUP BY first_date
        """,
    ),
    "monthly": (
        ("detail",),
        f"""
        SELECT merchant_id, txn_first AS period_month, count(DISTINCT merchant_city) AS cities,
               count(DISTINCT merchant_state) AS states, count(DISTINCT mcc) AS codes, sum(txn_amount) AS total,
               {_sum_if('txn_amount', 'txn_amount > 0')} AS pos,
               {_sum_if('abs(txn_amount)', 'txn_amount < 0')} AS neg, sum(abs(txn_amount)) AS volume,
               count(*) AS cnt, count(*) FILTER (txn_amount > 0) AS pos_cnt,
               count(*) FILTER (txn_amount < 0) AS neg_cnt, count(*) FILTER (is_fraud) AS fraud_cnt,
               count(*) FILTER (is_error) AS error_cnt, count(DISTINCT client_id) AS clients
        FROM detail GROUP BY merchant_id, txn_first
        """,
    ),
    "client_split": (
        ("detail",),
        """
        SELECT now.merchant_id, now.period_month,
               count(*) FILTER (past.client_id IS NULL) AS new_client_cnt,
               count(*) FILTER (past.client_id IS NOT NULL) AS returning_client_cnt
        FROM (SELECT DISTINCT merchant_id, client_id, txn_first AS period_month FROM detail) now
        LEFT JOIN (SELECT merchant_id, client_id, min(txn_first) AS first_month FROM detail GROUP BY ALL) past
          ON now.merchant_id = past.merchant_id AND now.client_id = past.client_id
         AND past.first_month < now.period_month
        WHERE now.merchant_id IS NOT NULL
        GROUP BY now.merchant_id, now.period_month
        """,
    ),
    "totals": (
        ("detail",),
        f"""
        SELECT client_id, sum(txn_amount) AS total, {_sum_if('txn_amount', 'txn_amount > 0')} AS pos,
               {_sum_if('abs(txn_amount)', 'txn_amount < 0')} AS neg, count(*) AS cnt,
               count(*) FILTER (txn_amount > 0) AS pos_cnt, count(*) FILTER (txn_amount < 0) AS neg_cnt,
               count(*) FILTER (is_fraud) AS fraud_cnt, count(*) FILTER (is_error) AS error_cnt,
               min(txn_date) AS first_date, max(txn_date) AS last_date,
               count(DISTINCT merchant_id) AS merchants, count(DISTINCT mcc) AS codes,
               count(DISTINCT merchant_city) AS cities, count(DISTINCT merchant_state) AS states
        FROM detail GROUP BY client_id
        """,
    ),
    "bounds": (
        ("in_transactions",),
        """
        SELECT CAST(min(date_time) AS DATE) AS start_date, CAST(max(date_time) AS DATE) AS end_date
        FROM in_transactions
        """,
    ),
}


def _with(statement: str, *steps: str, last_day: str | None = None) -> str:
    """`last_day` leaves out what is later in the fact, but nothing that is earlier."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in STEPS[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for step in steps:
        visit(step)
    if not order:
        return statement.strip()
    bodies = {name: STEPS[name][1].strip() for name in order}
    if last_day is not None:
        bodies["detail"] = f"SELECT * FROM ({bodies['detail']}) WHERE txn_date <= DATE '{last_day}'"
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in bodies.items()) + "\n" + statement.strip()


DAILY_OUT = f"""
    d.period_date, {_dec('d.total', 20, 2)} AS txn_total_amt, {_dec('d.pos', 20, 2)} AS txn_pos_amt,
    {_dec('d.neg', 20, 2)} AS txn_neg_amt, d.avg_amt AS txn_avg_amt, {_int('d.cnt')} AS txn_total_cnt,
    {_int('d.pos_cnt')} AS txn_pos_cnt, {_int('d.neg_cnt')} AS txn_neg_cnt, {_int('d.fraud_cnt')} AS txn_fraud_cnt,
    {_int('d.error_cnt')} AS txn_error_cnt
"""

LAGS_OUT = ", ".join(
    f"{_dec(f'coalesce(p{k}.total, 0)', 20, 2)} AS prev_{k}d_amt, {_int(f'coalesce(p{k}.cnt, 0)')} AS prev_{k}d_cnt"
    for k in (1, 7, 30)
)
LAG_JOINS = " ".join(f"LEFT JOIN daily p{k} ON d.period_date = p{k}.period_date + {k}" for k in (1, 7, 30))

PREVIOUS_OUT = f"""
    {_dec('coalesce(p.total, 0)', 18, 2)} AS prev_rev_total, {_dec('coalesce(p.pos, 0)', 18, 2)} AS prev_rev_positive,
    {_int('coalesce(p.cnt, 0)')} AS prev_txn_total_cnt, {_int('coalesce(p.pos_cnt, 0)')} AS prev_txn_positive_cnt
"""
PREVIOUS_JOIN = """
    LEFT JOIN monthly p ON m.merchant_id = p.merchant_id
     AND p.period_month = CAST(m.period_month - INTERVAL 1 MONTH AS DATE)
"""

MONTH_OUT = f"""
    {_int('m.cities')} AS active_city_cnt, {_int('m.states')} AS active_state_cnt, {_int('m.codes')} AS active_mcc_cnt,
    {_dec('coalesce(m.total, 0)', 18, 2)} AS rev_total, {_dec('m.pos', 18, 2)} AS rev_positive,
    {_dec('m.neg', 18, 2)} AS rev_negative, {_dec('coalesce(m.volume, 0)', 18, 2)} AS txn_total_amt,
    {_int('m.cnt')} AS txn_total_cnt, {_int('m.pos_cnt')} AS txn_positive_cnt,
    {_int('m.neg_cnt')} AS txn_negative_cnt, {_int('m.fraud_cnt')} AS fraud_txn_cnt,
    {_int('m.error_cnt')} AS error_txn_cnt, {_int('m.clients')} AS unique_client_cnt
"""

TOTALS_OUT = f"""
    {_dec('coalesce(t.total, 0)', 18, 2)} AS total_txn_amt, {_dec('coalesce(t.pos, 0)', 18, 2)} AS total_pos_amt,
    {_dec('coalesce(t.neg, 0)', 18, 2)} AS total_neg_amt, {_int('coalesce(t.cnt, 0)')} AS total_txn,
    {_int('coalesce(t.pos_cnt, 0)')} AS total_txn_pos, {_int('coalesce(t.neg_cnt, 0)')} AS total_txn_neg,
    {_int('coalesce(t.fraud_cnt, 0)')} AS total_txn_fraud, {_int('coalesce(t.error_cnt, 0)')} AS total_txn_error,
    t.first_date AS lifetime_first_date, t.last_date AS lifetime_last_date,
    {_int('coalesce(t.merchants, 0)')} AS merchant_unique_cnt
"""

# How often a transaction occurs in the fact that lost some rows and has some twice.
COPIES = "(CASE WHEN transaction_id % 1013 <> 7 THEN 1 ELSE 0 END + CASE WHEN transaction_id % 1009 = 5 THEN 1 ELSE 0 END)"

DETAIL_COLUMNS = "* EXCLUDE (txn_date, txn_first)"

_REPEATED = """
    SELECT '{relation}' AS relation, id AS key, count(*) AS row_count FROM {table}
    GROUP BY id HAVING count(*) > 1 OR id IS NULL
"""
_ORPHANS = """
    SELECT '{relation}' AS relation, {key} AS key, count(*) AS row_count FROM {child}
    WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT id FROM {parent}) GROUP BY {key}
"""
_RULE = "SELECT '{rule}' AS rule, count(*) FILTER (NOT ({condition})) AS violations FROM {table}"


def _union(template: str, *cases: dict[str, str]) -> str:
    return " UNION ALL ".join(template.format(**case) for case in cases)


def statements() -> dict[str, str]:
    cdc = "SELECT kafka_key, kafka_offset, kafka_timestamp, cdc_payload, operation, cdc_timestamp FROM in_cdc"
    labels = "SELECT transaction_id, is_fraud FROM in_labels"
    typed = "SELECT * FROM typed_transactions"
    silver = "SELECT * FROM s_transactions"
    latest = _with(
        f"""SELECT card_brand, card_type, txn_use_chip, txn_date, {_dec('sum(txn_amount)', 28, 4)} AS total_amount,
            count(transaction_id) AS total_txn FROM detail
            WHERE txn_date = (SELECT max(txn_date) FROM detail) GROUP BY ALL""",
        "detail",
    )
    market = f"""SELECT {DAILY_OUT}, {LAGS_OUT}, {_int('d.clients')} AS client_unique_cnt,
            {_int('coalesce(n.client_new_cnt, 0)')} AS client_new_cnt,
            {_int('d.merchants')} AS merchant_active_cnt,
            {_int('coalesce(m.merchant_top_mcc, 0)')} AS merchant_top_mcc,
            {_int('m.merchant_top_mcc_cnt')} AS merchant_top_mcc_cnt, h.peak_hour,
            {_int('h.peak_hour_cnt')} AS peak_hour_cnt, {_int('year(d.period_date)')} AS year,
            {_int('month(d.period_date)')} AS month
            FROM daily d {LAG_JOINS} JOIN peak h ON d.period_date = h.period_date
            JOIN top_mcc m ON d.period_date = m.period_date
            LEFT JOIN newcomers n ON d.period_date = n.period_date"""
    merchants = f"""SELECT coalesce(m.merchant_id, 0) AS merchant_id, m.period_month, {MONTH_OUT}, {PREVIOUS_OUT},
            {_int('coalesce(s.new_client_cnt, 0)')} AS new_client_cnt,
            {_int('coalesce(s.returning_client_cnt, 0)')} AS returning_client_cnt,
            {_int('year(m.period_month)')} AS year, {_int('month(m.period_month)')} AS month
            FROM monthly m {PREVIOUS_JOIN} LEFT JOIN client_split s
            ON m.merchant_id = s.merchant_id AND m.period_month = s.period_month"""
    market_window = _with(f"{market} WHERE d.period_date >= DATE '{FIRST_DAY}'", "daily", "peak", "top_mcc", "newcomers", last_day=LAST_DAY)
    merchant_window = _with(f"{merchants} WHERE m.period_month >= DATE '{FIRST_DAY[:8]}01'", "monthly", "client_split", last_day=LAST_DAY)
    return {
        "q_market_kept_history": market_window,
        "q_merchant_kept_history": merchant_window,
        "q_detail_window": _with(f"SELECT {DETAIL_COLUMNS} FROM detail WHERE txn_date >= DATE '{FIRST_DAY}'", "detail", last_day=LAST_DAY),
        "q_market_window": market_window,
        "q_new_clients_window": _with(f"SELECT * FROM newcomers WHERE period_date >= DATE '{FIRST_DAY}'", "newcomers", last_day=LAST_DAY),
        "q_merchant_window": merchant_window,
        "q_money_parse": _with(
            f"""SELECT id, load_at, {_clean('per_capita_income', 15, 2)} AS per_capita_income,
                {_clean('yearly_income', 15, 2)} AS yearly_income, {_clean('total_debt', 15, 2)} AS total_debt
                FROM in_users""",
            "in_users",
        ),
        "q_amount_parse": _with(
            f"SELECT id, amount AS amount_text, {_clean('amount', 18, 4)} AS amount FROM in_transactions",
            "in_transactions",
        ),
        "q_credit_limit": _with(
            f"""SELECT id, load_at, {_limit("nullif(credit_limit, '')")} AS credit_limit,
                {_clean('credit_limit', 12, 2)} AS strict_limit FROM in_cards""",
            "in_cards",
        ),
        "q_month_year_split": _with(
            f"""SELECT id, load_at, upper(card_brand) AS card_brand, {_part('expires', 1, 1, 12)} AS expires_month,
                {_part('expires', 2, 1900, 2100)} AS expires_year, {_part('acct_open_date', 1, 1, 12)} AS open_month,
                {_part('acct_open_date', 2, 1900, 2100)} AS open_year FROM in_cards""",
            "in_cards",
        ),
        "q_card_expired": _with(
            f"SELECT id, load_at, expires, {_expired('expires')} AS is_expires FROM in_cards", "in_cards"
        ),
        "q_age_income_groups": _with(
            """SELECT client_id, valid_from, current_age, age_group, yearly_income, income_group FROM s_users""",
            "s_users",
        ),
        "q_date_parts": _with(
            f"""SELECT id, {_int('year(date_time)')} AS year, {_int('month(date_time)')} AS month,
                {_int('day(date_time)')} AS day, {_int('hour(date_time)')} AS hour, CAST(date_time AS DATE) AS date,
                CAST(date_trunc('month', date_time) AS DATE) AS month_start,
                strftime(date_time, '%Y-%m') AS date_partition, CAST(date_time AS DATE) + 30 AS in_30_days,
                {_int("date_diff('day', date_trunc('month', date_time), date_time)")} AS days_into_month
                FROM in_transactions""",
            "in_transactions",
        ),
        "q_flags": _with(
            """SELECT t.transaction_id, t.use_chip, t.is_error, coalesce(l.is_fraud = 'YES', false) AS is_fraud
               FROM s_transactions t LEFT JOIN in_labels l ON t.transaction_id = l.transaction_id""",
            "s_transactions",
            "in_labels",
        ),
        "q_spending_ratio": _with(
            "SELECT transaction_id, txn_amount, card_credit_limit, txn_spending_ratio FROM detail", "detail"
        ),
        "q_staged_typing": _with(typed, "typed_transactions"),
        "q_ingest_bronze": _with(
            """SELECT * EXCLUDE (date), make_timestamp(2024, 6, 15, 0, 0, 0) AS load_at,
               strftime(date, '%Y-%m') AS date_partition FROM typed_transactions""",
            "typed_transactions",
        ),
        "q_cdc_envelope": _with(cdc, "in_cdc"),
        "q_cdc_stream": _with(cdc, "in_cdc"),
        "q_mcc_explode": _with("SELECT mcc_code, description, true AS has_file FROM in_mcc", "in_mcc"),
        "q_label_explode": _with(labels, "in_labels"),
        "q_jsonl_roundtrip": _with(labels, "in_labels"),
        "q_csv_roundtrip": _with(typed, "typed_transactions"),
        "q_csv_users": _with("SELECT * EXCLUDE (load_at) FROM in_users", "in_users"),
        "q_csv_cards": _with("SELECT * EXCLUDE (load_at) FROM in_cards", "in_cards"),
        "q_scd2_users": _with("SELECT * FROM s_users", "s_users"),
        "q_scd2_cards": _with("SELECT * FROM s_cards", "s_cards"),
        "q_scd2_key_unique": _with(
            """SELECT 'users' AS dimension, count(*) AS versions, count(DISTINCT (client_id, valid_from)) AS keys,
               count(*) FILTER (is_current) AS open_versions, count(DISTINCT client_id) AS entities FROM s_users
               UNION ALL
               SELECT 'cards', count(*), count(DISTINCT (card_id, valid_from)), count(*) FILTER (is_current),
               count(DISTINCT card_id) FROM s_cards""",
            "s_users",
            "s_cards",
        ),
        "q_silver_transactions": _with(silver, "s_transactions"),
        "q_partition_overwrite": _with(silver, "s_transactions"),
        "q_transaction_detail": _with(f"SELECT {DETAIL_COLUMNS} FROM detail", "detail"),
        "q_daily_totals": _with(
            f"""SELECT {DAILY_OUT}, {_int('d.clients')} AS client_unique_cnt,
                {_int('d.merchants')} AS merchant_active_cnt FROM daily d""",
            "daily",
        ),
        "q_daily_lags": _with(f"SELECT d.period_date, {LAGS_OUT} FROM daily d {LAG_JOINS}", "daily"),
        "q_peak_hour": _with("SELECT * FROM peak", "peak"),
        "q_top_mcc": _with("SELECT * FROM top_mcc", "top_mcc"),
        "q_top_merchant": _with("SELECT * FROM top_merchant", "top_merchant"),
        "q_new_clients_daily": _with("SELECT * FROM newcomers", "newcomers"),
        "q_market_daily_summary": _with(
            market,
            "daily",
            "peak",
            "top_mcc",
            "newcomers",
        ),
        "q_merchant_month": _with(f"SELECT m.merchant_id, m.period_month, {MONTH_OUT} FROM monthly m", "monthly"),
        "q_merchant_prev_month": _with(
            f"SELECT m.merchant_id, m.period_month, {PREVIOUS_OUT} FROM monthly m {PREVIOUS_JOIN}", "monthly"
        ),
        "q_merchant_client_split": _with("SELECT * FROM client_split", "client_split"),
        "q_merchant_monthly_performance": _with(
            merchants,
            "monthly",
            "client_split",
        ),
        "q_user_totals": _with(
            f"SELECT t.client_id, {TOTALS_OUT} FROM totals t",
            "totals",
        ),
        "q_user_detail": _with(
            f"""SELECT u.client_id, u.current_age AS age_current, u.retirement_age AS age_retired, u.birth_year,
                u.birth_month, u.gender, {_int('trunc(u.per_capita_income)')} AS income_per_capita,
                {_int('trunc(u.yearly_income)')} AS income_yearly, {_int('trunc(u.total_debt)')} AS debt_total,
                u.credit_score, {TOTALS_OUT},
                {_int("coalesce(date_diff('day', t.first_date, t.last_date), 0)")} AS lifetime_days,
                coalesce(m.merchant_top_id, 0) AS merchant_top_id,
                {_int('coalesce(m.merchant_top_txn_cnt, 0)')} AS merchant_top_txn_cnt,
                {_int('coalesce(t.codes, 0)')} AS mcc_unique_cnt, {_int('coalesce(t.cities, 0)')} AS city_unique_cnt,
                {_int('coalesce(t.states, 0)')} AS state_unique_cnt
                FROM (SELECT * FROM s_users WHERE is_current) u LEFT JOIN totals t ON u.client_id = t.client_id
                LEFT JOIN top_merchant m ON u.client_id = m.client_id""",
            "s_users",
            "totals",
            "top_merchant",
        ),
        "q_latest_day_summary": latest,
        "q_latest_day_view": latest,
        "q_latest_day_listed": latest,
        "q_active_counts": _with(
            """SELECT txn_first AS period_date, count(DISTINCT client_id) AS client_unique_cnt,
                count(DISTINCT merchant_id) AS merchant_active_cnt FROM detail GROUP BY txn_first
            UNION ALL SELECT NULL, count(DISTINCT client_id), count(DISTINCT merchant_id) FROM detail""",
            "detail",
        ),
        "q_reconciliation": _with(
            f"""SELECT txn_first AS "window", count(*) AS bronze_rows, count(*) AS silver_rows,
                CAST(sum(copies) AS BIGINT) AS gold_rows, 'same' AS silver_state,
                CASE WHEN sum(copies) < count(*) THEN 'lost' WHEN sum(copies) > count(*) THEN 'doubled'
                     WHEN bool_and(copies = 1) THEN 'same' ELSE 'changed' END AS gold_state
            FROM (SELECT txn_first, {COPIES} AS copies FROM detail) GROUP BY txn_first""",
            "detail",
        ),
        "q_differing_transactions": _with(
            f"""SELECT transaction_id, txn_date_time, CAST(1 AS BIGINT) AS rows_before, CAST({COPIES} AS BIGINT) AS rows_after
            FROM detail WHERE {COPIES} <> 1""",
            "detail",
        ),
        "q_run_ledger": _with(
            """SELECT 'count' AS job, window_start, window_end, 'done' AS state, row_count,
                CAST(CASE WHEN year(window_start) % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts
            FROM (
                SELECT window_start, least(window_start + 364, end_date) AS window_end,
                    (SELECT count(*) FROM in_transactions t
                     WHERE CAST(t.date_time AS DATE) BETWEEN w.window_start AND least(w.window_start + 364, w.end_date)) AS row_count
                FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 365 DAY)) AS DATE) AS window_start, end_date
                      FROM bounds) w
            )""",
            "bounds", "in_transactions",
        ),
        "q_window_replacement": _with(
            f"""SELECT {DETAIL_COLUMNS} FROM detail
            WHERE txn_date NOT BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' OR txn_day % 2 = 1""",
            "detail",
        ),
        "q_scd2_merge": _with("SELECT * FROM s_users", "s_users"),
        "q_cdc_replay": _with(cdc, "in_cdc"),
        "q_detail_bucketed": _with(f"SELECT {DETAIL_COLUMNS} FROM detail", "detail"),
        "q_calendar_windows": _with(
            """SELECT CAST(w AS DATE) AS window_start, least(CAST(w AS DATE) + 6, end_date) AS window_end
               FROM (SELECT unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP),
                     INTERVAL 7 DAY)) AS w, end_date FROM bounds)""",
            "bounds",
        ),
        "q_calendar_months": _with(
            """SELECT CAST(w AS DATE) AS window_start, least(last_day(w), end_date) AS window_end
               FROM (SELECT unnest(generate_series(CAST(date_trunc('month', start_date) AS TIMESTAMP),
                     CAST(end_date AS TIMESTAMP), INTERVAL 1 MONTH)) AS w, end_date FROM bounds)""",
            "bounds",
        ),
        "q_window_audit": _with(
            """SELECT window_start, CASE WHEN window_start IS NOT NULL
                  THEN least(window_start + 6, (SELECT end_date FROM bounds)) END AS window_end, row_count
               FROM (SELECT window_start, count(*) AS row_count
                     FROM (SELECT start_date + CAST((CAST(date_time AS DATE) - start_date) // 7 * 7 AS INTEGER)
                           AS window_start FROM in_transactions, bounds)
                     GROUP BY ROLLUP (window_start))""",
            "in_transactions",
            "bounds",
        ),
        "q_row_counts": _with(
            _union(
                "SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}",
                {"name": "users", "table": "in_users"},
                {"name": "cards", "table": "in_cards"},
                {"name": "transactions", "table": "in_transactions"},
            ),
            "in_users",
            "in_cards",
            "in_transactions",
        ),
        "q_pk_violations": _with(
            _union(
                _REPEATED,
                {"relation": "users", "table": "in_users"},
                {"relation": "cards", "table": "in_cards"},
                {"relation": "transactions", "table": "in_transactions"},
            ),
            "in_users",
            "in_cards",
            "in_transactions",
        ),
        "q_pk_lineitem": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
            GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "q_fk_violations": _with(
            _union(
                _ORPHANS,
                {"relation": "cards.client_id", "child": "in_cards", "key": "client_id", "parent": "in_users"},
                {
                    "relation": "transactions.client_id",
                    "child": "in_transactions",
                    "key": "client_id",
                    "parent": "in_users",
                },
                {"relation": "transactions.card_id", "child": "in_transactions", "key": "card_id", "parent": "in_cards"},
            ),
            "in_users",
            "in_cards",
            "in_transactions",
        ),
        "q_rule_violations": _with(
            _union(
                _RULE,
                {"rule": "users_age_present", "condition": "current_age IS NOT NULL", "table": "in_users"},
                {"rule": "users_gender_known", "condition": "gender IN ('Male', 'Female')", "table": "in_users"},
                {"rule": "cards_client_present", "condition": "client_id IS NOT NULL", "table": "in_cards"},
                {"rule": "transactions_time_present", "condition": "date_time IS NOT NULL", "table": "in_transactions"},
                {
                    "rule": "transactions_client_present",
                    "condition": "client_id IS NOT NULL",
                    "table": "in_transactions",
                },
                {"rule": "transactions_card_present", "condition": "card_id IS NOT NULL", "table": "in_transactions"},
            ),
            "in_users",
            "in_cards",
            "in_transactions",
        ),
        "q_history_head": _with(
            f"""SELECT period_date AS hist_date, {_dec('total', 28, 4)} AS hist_amt, cnt AS hist_cnt
                FROM daily ORDER BY period_date LIMIT 10""",
            "daily",
        ),
        "q_distinct_pairs": _with(
            "SELECT DISTINCT merchant_id, client_id FROM in_transactions", "in_transactions"
        ),
        "q_append_then_read": _with(
            """SELECT * FROM in_users UNION ALL
               SELECT * REPLACE (make_timestamp(2024, 6, 15, 0, 0, 0) AS load_at) FROM in_users""",
            "in_users",
        ),
        "q_bucketed_join": _with(
            """SELECT t.id AS transaction_id, t.client_id, t.amount, l.is_fraud FROM in_transactions t
               LEFT JOIN in_labels l ON t.id = l.transaction_id""",
            "in_transactions",
            "in_labels",
        ),
    }
