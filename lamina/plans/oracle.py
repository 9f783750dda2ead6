"""The registered queries as plain SQL, written independently of the Spark plans."""

from __future__ import annotations

from collections.abc import Sequence

from lamina.functions import synth

ACC = """acc AS (
  SELECT c_custkey AS acct_id, c_name AS acct_name, c_acctbal AS balance, 'open' AS acct_status,
         c_mktsegment AS acct_type
  FROM customer)"""

CUS = """cus AS (
  SELECT concat('1000000', CAST(c_custkey AS VARCHAR)) AS customer_id, c_custkey AS acct_id,
         CAST(c_nationkey AS VARCHAR) AS state_cd,
         CAST(25.0 AS DOUBLE) + c_nationkey AS latitude,
         CAST(-120.0 AS DOUBLE) + c_nationkey AS longitude
  FROM customer)"""

TX = """tx AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS transaction_id,
         o_custkey AS acct_id, p_brand AS ticker_symbol, l_quantity AS quantity,
         l_quantity AS total_holdings, l_extendedprice AS total_amt,
         l_shipdate AS transaction_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

CHG = """chg AS (
  SELECT user_id, event_id, CAST(floor(value / 25) AS INTEGER) AS band,
         'accounts' AS source_file,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'
                         WHEN 'error' THEN 'delete' ELSE 'update_postimage' END AS operation_type,
         date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS commit_version,
         date_trunc('hour', ts) AS commit_timestamp
  FROM events)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _history(
    source: str,
    keys: list[str],
    seq: str,
    stored: list[str],
    ties: list[str],
    deleted: str = "FALSE",
    where: str = "TRUE",
    collapse: bool = True,
) -> list[str]:
    """CTEs ending in ``hist``: winners per key and instant, unchanged rows dropped, ends by LEAD."""
    key = ", ".join(keys)
    kept = ", ".join(stored)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ties)
    line = f"PARTITION BY {key} ORDER BY {seq}"
    same = " AND ".join(
        ["gone = lag(gone) OVER w"]
        + [f"(gone OR {c} IS NOT DISTINCT FROM lag({c}) OVER w)" for c in stored]
    )
    unchanged = f"coalesce({same}, FALSE)" if collapse else "FALSE"
    return [
        f"marked AS (SELECT *, ({deleted}) AS gone FROM {source} WHERE {where})",
        f"winners AS (SELECT * FROM marked QUALIFY row_number() OVER "
        f"(PARTITION BY {key}, {seq} ORDER BY gone, {order}) = 1)",
        f"flagged AS (SELECT *, {unchanged} AS unchanged FROM winners WINDOW w AS ({line}))",
        f"ended AS (SELECT *, lead({seq}) OVER ({line}) AS until FROM flagged WHERE NOT unchanged)",
        f'hist AS (SELECT {key}, {kept}, {seq} AS "__START_AT", until AS "__END_AT" '
        "FROM ended WHERE NOT gone)",
    ]


USERS = [
    CHG,
    *_history(
        "chg",
        ["user_id"],
        "commit_timestamp",
        ["band"],
        ["event_id"],
        deleted="operation_type = 'delete'",
        where="operation_type <> 'update_preimage'",
    ),
]
USERS_ALL = [
    CHG,
    *_history(
        "chg",
        ["user_id"],
        "commit_timestamp",
        ["band"],
        ["event_id"],
        deleted="operation_type = 'delete'",
        where="operation_type <> 'update_preimage'",
        collapse=False,
    ),
]
SPARSE = [
    CHG,
    "sparse AS (SELECT user_id, event_id, operation_type, commit_timestamp, "
    "CASE WHEN event_id % 3 > 0 THEN band END AS band, "
    "CASE WHEN event_id % 5 > 1 THEN event_id % 4 END AS grade FROM chg "
    "WHERE operation_type <> 'update_preimage')",
    "firsts AS (SELECT *, operation_type = 'delete' AS dropped FROM sparse QUALIFY row_number() OVER "
    "(PARTITION BY user_id, commit_timestamp ORDER BY operation_type = 'delete', event_id DESC) = 1)",
    "lives AS (SELECT *, count(*) FILTER (dropped) OVER (PARTITION BY user_id ORDER BY commit_timestamp) "
    "AS life FROM firsts)",
    "known AS (SELECT user_id, event_id, commit_timestamp, dropped, "
    "CASE WHEN NOT dropped THEN last_value(CASE WHEN NOT dropped THEN band END IGNORE NULLS) OVER v END "
    "AS band, "
    "CASE WHEN NOT dropped THEN last_value(CASE WHEN NOT dropped THEN grade END IGNORE NULLS) OVER v END "
    "AS grade FROM lives WINDOW v AS (PARTITION BY user_id, life ORDER BY commit_timestamp "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    *_history(
        "known",
        ["user_id"],
        "commit_timestamp",
        ["band", "grade"],
        ["event_id"],
        deleted="dropped",
    ),
]
TX_STORED = ["acct_id", "ticker_symbol", "quantity", "total_holdings", "total_amt"]
TX_HISTORY = [TX, *_history("tx", ["transaction_id"], "transaction_date", TX_STORED, TX_STORED)]
# The date is a stored column too when the history feeds the profile.
TX_DATED = [
    TX,
    "dated AS (SELECT *, transaction_date AS seq FROM tx)",
    *_history(
        "dated",
        ["transaction_id"],
        "seq",
        [*TX_STORED, "transaction_date"],
        [*TX_STORED, "transaction_date"],
    ),
]


def _profile(
    tx: str, accounts: str = "acc", value: str = "CAST(total_amt AS DECIMAL(18,2))"
) -> str:
    return f"""SELECT cus.customer_id, a.acct_id, a.acct_status, a.balance,
       COUNT(*) AS total_transactions, CAST(SUM({value}) AS DOUBLE) AS total_transactions_value,
       MIN(transaction_date) AS first_transaction_date,
       MAX(transaction_date) AS latest_transaction_date,
       COUNT(DISTINCT ticker_symbol) AS count_distinct_tickers_traded
FROM {accounts} a JOIN cus ON a.acct_id = cus.acct_id JOIN {tx} t ON a.acct_id = t.acct_id
GROUP BY cus.customer_id, a.acct_id, a.acct_status, a.balance"""


def _profile_days(tx: str, accounts: str, value: str) -> str:
    """Dates as text."""
    days = ", ".join(
        f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}"
        for c in ("first_transaction_date", "latest_transaction_date")
    )
    return f"SELECT * REPLACE ({days}) FROM ({_profile(tx, accounts, value)})"


LATEST = """latest AS (
  SELECT tx.* FROM tx JOIN (
    SELECT acct_id, ticker_symbol, MAX(transaction_date) AS best FROM tx GROUP BY ALL) b
  ON tx.acct_id = b.acct_id AND tx.ticker_symbol = b.ticker_symbol AND tx.transaction_date = b.best)"""
GEO = """SELECT customer_id, cus.acct_id, ticker_symbol, total_holdings, state_cd, longitude, latitude
FROM latest JOIN cus ON latest.acct_id = cus.acct_id"""


def _expect(source: str, dataset: str, rules: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, COUNT(*) AS total_rows, "
        f"CAST(COALESCE(SUM(CASE WHEN {rule} THEN 0 ELSE 1 END), 0) AS BIGINT) AS failed_rows FROM {source}"
        for name, rule in rules
    )


EXPECT_ACCOUNTS = [
    ("valid_acct_id", "acct_id IS NOT NULL"),
    ("valid_balance", "balance >= 0"),
    ("valid_acct_status", "acct_status IS NOT NULL"),
]
EXPECT_CUSTOMERS = [
    ("valid_customer_id", "customer_id IS NOT NULL"),
    ("valid_acct_id", "acct_id IS NOT NULL"),
    ("valid_state_cd", "length(state_cd) = 2"),
    ("valid_coordinates", "longitude IS NOT NULL AND latitude IS NOT NULL"),
]
EXPECT_TX = [
    ("valid_transaction_id", "transaction_id IS NOT NULL"),
    ("valid_acct_id", "acct_id IS NOT NULL"),
    ("valid_total_amt", "total_amt > 0"),
    ("valid_transaction_date", "transaction_date IS NOT NULL"),
]
EXPECT_TX_APPEND = EXPECT_TX + [
    ("valid_ticker_symbol", "ticker_symbol IS NOT NULL"),
    ("valid_total_holdings", "total_holdings >= 0"),
]
EXPECT_PROFILE = [
    ("valid_customer_id", "customer_id IS NOT NULL"),
    ("valid_acct_id", "acct_id IS NOT NULL"),
    ("positive_transaction_count", "total_transactions > 0"),
    ("positive_transaction_value", "total_transactions_value > 0"),
    ("valid_date_range", "first_transaction_date <= latest_transaction_date"),
]
EXPECT_GEO = [
    ("valid_customer_id", "customer_id IS NOT NULL"),
    ("valid_acct_id", "acct_id IS NOT NULL"),
    ("valid_ticker_symbol", "ticker_symbol IS NOT NULL"),
    ("valid_state_cd", "state_cd IS NOT NULL"),
    ("valid_coordinates", "longitude IS NOT NULL AND latitude IS NOT NULL"),
    ("positive_holdings", "total_holdings >= 0"),
]

DIFF = """WITH after AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
              THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
         o_custkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01'
              THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F'))
SELECT o.*, 'delete' AS _change_type FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM after a WHERE a.o_orderkey = o.o_orderkey)
UNION ALL
SELECT a.*, 'insert' FROM after a
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE a.o_orderkey = o.o_orderkey)
UNION ALL
SELECT o.*, 'update_preimage' FROM orders o JOIN after a ON a.o_orderkey = o.o_orderkey
WHERE a.o_orderstatus <> o.o_orderstatus
UNION ALL
SELECT a.*, 'update_postimage' FROM orders o JOIN after a ON a.o_orderkey = o.o_orderkey
WHERE a.o_orderstatus <> o.o_orderstatus"""


# Synthesis: the same MD5 digits, read as a number below 2^52.
def _unit(name: str, seed: int = 1) -> str:
    digits = f"substr(md5(concat('{seed}:{name}:', CAST(id AS VARCHAR))), 1, 13)"
    return f"(CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE)"


def _below(name: str, n: str) -> str:
    return f"CAST(floor({_unit(name)} * {n}) AS BIGINT)"


def _choice(name: str, values: Sequence[str]) -> str:
    options = ", ".join(f"'{v}'" for v in values)
    return f"([{options}])[{_below(name, str(len(values)))} + 1] AS {name}"


def _acct(number: str) -> str:
    return f"concat('00', CAST({number} AS VARCHAR), 'A000000U5DtWAOV') AS acct_id"


def _numbered(name: str, prefix: str) -> str:
    return f"concat('{prefix}', CAST({_below(name, '1000')} + 1 AS VARCHAR)) AS {name}"


def _real(name: str, low: str, span: str) -> str:
    return f"({low}::DOUBLE + {_unit(name)} * {span}::DOUBLE) AS {name}"


def _instant(name: str, begin: str, end: str) -> str:
    low = f"epoch(TIMESTAMP '{begin}')::BIGINT"
    span = f"(epoch(TIMESTAMP '{end}')::BIGINT - {low} + 1)"
    return f"make_timestamp(({_below(name, span)} + {low}) * 1000000)"


SYNTH_ACCOUNTS = f"""WITH ids AS (SELECT c_custkey AS id FROM customer)
SELECT id, {_acct('id % 1000 + 1')}, {_numbered('acct_name', 'acct_')},
  CAST({_below('acct_number', '1000000001')} + 1000000000 AS INTEGER) AS acct_number,
  {_choice('acct_type', synth.ACCOUNT_TYPES)},
  {_real('balance', '500000.0', '2000000.0')}, 'open' AS acct_status,
  {_instant('open_date', '2020-01-01 00:00:00', '2021-12-31 23:59:59')} AS open_date,
  CAST({_instant('closed_date', '2080-01-01 00:00:00', '2800-12-31 23:59:59')} AS VARCHAR) AS closed_date,
  {_choice('margin_enabled', synth.MARGIN)},
  {_choice('risk_tolerance', synth.RISK)},
  {_instant('created_date', '2022-01-01 00:00:00', '2024-12-31 23:59:59')} AS created_date
FROM ids"""


def _synth_customers() -> str:
    states = synth.STATES
    rows = ", ".join(f"('{code}', {lat}::DOUBLE, {lon}::DOUBLE)" for code, lat, lon in states)
    codes = [code for code, _, _ in states]
    return f"""WITH ids AS (SELECT c_custkey AS id FROM customer),
states(code, lat, lon) AS (VALUES {rows}),
made AS (SELECT id, concat('1000000', CAST(id AS VARCHAR)) AS customer_id,
  {_numbered('first_name', 'customer_')}, {_numbered('last_name', 'custlastname_')},
  concat('user', CAST(id AS VARCHAR), '@demo.com') AS email,
  concat('+1-555-', lpad(CAST(id % 10000 AS VARCHAR), 4, '0')) AS phone_number,
  {_acct('id % 1000 + 1')}, {_choice('state_cd', codes)}, 'US' AS country_cd,
  {_instant('created_at', '2022-01-01 00:00:00', '2024-12-31 23:59:59')} AS created_at FROM ids)
SELECT made.*, lat + ({_unit('latitude')} / 50.0::DOUBLE - 0.01::DOUBLE) AS latitude,
  lon + ({_unit('longitude')} / 50.0::DOUBLE - 0.01::DOUBLE) AS longitude
FROM made JOIN states ON state_cd = code"""


TICKERS = """tickers AS (
  SELECT p_brand AS ticker_symbol, row_number() OVER (ORDER BY p_brand) - 1 AS pick,
         count(*) OVER () AS n
  FROM (SELECT DISTINCT p_brand FROM part))"""
PICK = _below("ticker_symbol", "(SELECT count(DISTINCT p_brand) FROM part)")
YEAR = ("2022-01-01 00:00:00", "2022-12-31 23:59:59")
SYNTH_TRANSACTIONS = f"""WITH {TICKERS}, ids AS (SELECT event_id AS id FROM events),
picked AS (SELECT id, ticker_symbol FROM (SELECT id, {PICK} AS pick FROM ids) picks JOIN tickers USING (pick)),
made AS (SELECT id, concat('1110000', CAST(id AS VARCHAR)) AS transaction_id,
  {_acct(_below('acct_id', '1000') + ' + 1')}, ticker_symbol,
  {_choice('transaction_type', synth.TRANSACTION_TYPES)},
  {_real('quantity', '10.0', '19990.0')}, {_real('price_per_share', '50.0', '950.0')},
  {_instant('transaction_date', *YEAR)} AS transaction_date,
  {_choice('order_type', synth.ORDER_TYPES)},
  {_choice('trade_status', synth.TRADE_STATUS)},
  {_instant('created_date', *YEAR)} AS created_date FROM picked)
SELECT *, quantity * price_per_share AS total_amt, quantity AS total_holdings FROM made"""

SYNTH_DERIVED = f"""WITH ids AS (SELECT o_orderkey AS id FROM orders),
made AS (SELECT id, {_real('amount', '0.0', '1000.0')}, {_choice('order_type', synth.ORDER_TYPES)} FROM ids),
charged AS (SELECT *, amount * CASE WHEN order_type = 'market' THEN 0.25::DOUBLE ELSE 0.125::DOUBLE END AS fee
  FROM made)
SELECT id, fee, order_type || CASE WHEN fee < 100 THEN '-low' ELSE '-high' END AS fee_class, amount, order_type
FROM charged"""

BRONZE_COLUMNS = (
    "user_id, event_id, band, source_file, operation_type, commit_version, commit_timestamp"
)
TX_COLUMNS = "transaction_id, acct_id, ticker_symbol, quantity, total_holdings, total_amt"
HIST_SPARSE = 'SELECT user_id, band, grade, "__START_AT", "__END_AT" FROM hist'
HIST_USERS = 'SELECT user_id, band, "__START_AT", "__END_AT" FROM hist'
OPEN_USERS = 'opened AS (SELECT user_id FROM hist WHERE "__END_AT" IS NULL)'
SILVER_ACCOUNTS = (
    _with(ACC) + 'SELECT acc.*, CAST(NULL AS TIMESTAMP) AS "__END_AT", TRUE AS is_current FROM acc'
)

BRONZE_DAILY = (
    _with(CHG)
    + "SELECT * REPLACE (CAST(floor(commit_version / 24) AS BIGINT) AS commit_version) "
    + f"FROM (SELECT {BRONZE_COLUMNS} FROM chg)"
)
BRONZE_CUSTOMER = (
    _with(CUS)
    + "SELECT cus.*, 'customer' AS source_file, 'insert' AS operation_type,"
    " CAST(0 AS BIGINT) AS commit_version, TIMESTAMP '2024-01-01' AS commit_timestamp FROM cus"
)
BRONZE_TX = (
    _with(TX)
    + f"SELECT {TX_COLUMNS}, transaction_date, 'transactions' AS source_file,"
    " 'insert' AS operation_type, year(transaction_date) AS commit_version,"
    " transaction_date AS commit_timestamp FROM tx"
)
OVERWRITE = DIFF[: DIFF.index("SELECT o.*, 'delete'")] + """
SELECT o.*, 'insert' AS _change_type, TIMESTAMP '2024-01-01' AS _commit_timestamp,
       CAST(0 AS BIGINT) AS _commit_version FROM orders o
UNION ALL SELECT o.*, 'delete', TIMESTAMP '2024-01-02', 1 FROM orders o
UNION ALL SELECT a.*, 'insert', TIMESTAMP '2024-01-02', 1 FROM after a"""
CDC_QUALITY = _with(CHG) + """
SELECT 'users' AS dataset, 'low_band' AS expectation, count(*) AS total_rows,
       count(*) FILTER (NOT coalesce(band < 3, FALSE)) AS failed_rows
FROM chg WHERE operation_type IN ('insert', 'update_postimage')
UNION ALL
SELECT 'users', 'even_event', count(*), count(*) FILTER (event_id % 2 <> 0)
FROM chg WHERE operation_type IN ('insert', 'update_postimage')
UNION ALL
SELECT 'users', 'has_key_and_sequence', count(*), 0 FROM chg WHERE operation_type <> 'update_preimage'"""

ORACLE = {
    "bronze_accounts": _with(CHG) + f"SELECT {BRONZE_COLUMNS} FROM chg",
    "bronze_accounts_sql": _with(CHG) + f"SELECT {BRONZE_COLUMNS} FROM chg",
    "bronze_tx": BRONZE_TX,
    "bronze_tx_sql": BRONZE_TX,
    "bronze_customer": BRONZE_CUSTOMER,
    "bronze_customer_sql": BRONZE_CUSTOMER,
    "diff_column_names": DIFF,
    "overwrite_feed": OVERWRITE,
    "append_silver_customers": _with(CUS)
    + 'SELECT cus.*, CAST(NULL AS TIMESTAMP) AS "__END_AT", TRUE AS is_current FROM cus',
    "cdc_quality": CDC_QUALITY,
    "bronze_from_version": _with(CHG)
    + "SELECT * FROM (SELECT chg.* REPLACE (CAST(floor(commit_version / 24) AS BIGINT) AS commit_version)"
    " FROM chg) WHERE commit_version >= 15",
    "rejected_changes": _with(CHG)
    + "SELECT CAST(NULL AS BIGINT) AS user_id, event_id, band, source_file, operation_type,"
    " commit_version, commit_timestamp FROM chg WHERE operation_type = 'delete'",
    "cdf_diff": DIFF,
    "schema_merge_append": _with(ACC)
    + "SELECT acct_id, acct_name, balance, acct_status, acct_type, NULL::INTEGER AS nation FROM acc"
    " UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, NULL, s_nationkey FROM supplier",
    "append_silver": SILVER_ACCOUNTS,
    "stream_append_silver": SILVER_ACCOUNTS,
    "append_tx": _with(TX)
    + f"SELECT {TX_COLUMNS}, CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS transaction_date FROM tx",
    "scd2_history": _with(*USERS) + HIST_USERS,
    "scd2_out_of_order": _with(*USERS) + HIST_USERS,
    "scd2_hot_keys": _with(*USERS) + HIST_USERS,
    "stream_two_flows": _with(*USERS) + HIST_USERS,
    "bronze_merged": BRONZE_DAILY,
    "stream_scd2": _with(*USERS) + HIST_USERS,
    "scd2_every_change": _with(*USERS_ALL) + HIST_USERS,
    "scd2_current": _with(*USERS)
    + 'SELECT user_id, band, "__START_AT" FROM hist WHERE "__END_AT" IS NULL',
    "scd2_ignore_nulls": _with(*SPARSE) + HIST_SPARSE,
    "scd2_ignore_nulls_hot": _with(*SPARSE) + HIST_SPARSE,
    "scd2_tx": _with(*TX_HISTORY) + f'SELECT {TX_COLUMNS}, "__START_AT", "__END_AT" FROM hist',
    "scd2_composite_key": _with(
        *_history(
            "orders",
            ["o_custkey", "o_orderpriority"],
            "o_orderdate",
            ["o_orderstatus", "o_totalprice"],
            ["o_orderkey"],
            deleted="o_orderstatus = 'F'",
        )
    )
    + 'SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, "__START_AT", "__END_AT" FROM hist',
    "cust_tran_profile": _with(ACC, CUS, TX) + _profile("tx"),
    "cust_tran_profile_sql": _with(ACC, CUS, TX) + _profile("tx"),
    "cust_tran_profile_cdc": _with(ACC, CUS, *TX_DATED) + _profile("hist"),
    "cust_tran_profile_current": _with(ACC, CUS, *TX_DATED)
    + _profile('(SELECT * FROM hist WHERE "__END_AT" IS NULL)'),
    "cust_tran_profile_append": _with(ACC, CUS, TX)
    + _profile_days("tx", "(SELECT * FROM acc UNION ALL SELECT * FROM acc)", "CAST(total_amt AS DECIMAL(18,2)) * 100"),
    "latest_per_group": _with(TX, LATEST)
    + "SELECT transaction_id, acct_id, ticker_symbol, quantity, total_holdings, transaction_date FROM latest",
    "latest_per_group_hot": _with(TX, LATEST)
    + "SELECT transaction_id, acct_id, ticker_symbol, quantity, total_holdings, transaction_date FROM latest",
    "ticker_dist_geo": _with(TX, CUS, LATEST) + GEO,
    "ticker_dist_geo_hot": _with(TX, CUS, LATEST) + GEO,
    "expect_accounts": _with(ACC) + _expect("acc", "accounts", EXPECT_ACCOUNTS),
    "expect_customers": _with(CUS) + _expect("cus", "customers", EXPECT_CUSTOMERS),
    "stream_quality": _with(CUS) + _expect("cus", "customers", EXPECT_CUSTOMERS),
    "expect_tx": _with(TX) + _expect("tx", "transactions", EXPECT_TX),
    "expect_tx_append": _with(TX) + _expect("tx", "transactions", EXPECT_TX_APPEND),
    "expect_profile": _with(ACC, CUS, TX, f"p AS ({_profile('tx')})")
    + _expect("p", "cust_tran_profile", EXPECT_PROFILE),
    "expect_geo": _with(TX, CUS, LATEST, f"g AS ({GEO})")
    + _expect("g", "ticker_dist_geo", EXPECT_GEO),
    "val_accounts_without_customer": _with(ACC)
    + "SELECT acct_id FROM acc EXCEPT SELECT user_id FROM events",
    "val_customers_without_account": _with(CUS, *USERS, OPEN_USERS)
    + "SELECT acct_id FROM cus EXCEPT SELECT user_id FROM opened",
    "val_accounts_without_tx": "SELECT o_orderkey AS acct_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
    "val_orphan_tx": _with(TX, *USERS, OPEN_USERS)
    + "SELECT acct_id FROM tx EXCEPT SELECT user_id FROM opened",
    "val_tx_count_spread": _with(TX)
    + "SELECT min(n) AS min_cnt, max(n) AS max_cnt FROM (SELECT count(*) AS n FROM tx GROUP BY acct_id)",
    "record_hash": _with(CUS)
    + "SELECT customer_id, sha256(concat_ws('|', customer_id, acct_id, state_cd)) AS record_hash FROM cus",
    "synth_accounts": SYNTH_ACCOUNTS,
    "synth_derived": SYNTH_DERIVED,
    "synth_customers": _synth_customers(),
    "synth_transactions": SYNTH_TRANSACTIONS,
    "synth_dim_choice": f"WITH {TICKERS}, ids AS (SELECT o_orderkey AS id FROM orders) "
    f"SELECT id, ticker_symbol FROM (SELECT id, {PICK} AS pick FROM ids) picks JOIN tickers USING (pick)",
}
