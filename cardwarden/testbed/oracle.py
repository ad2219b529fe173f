"""DuckDB SQL for the registered queries, written the way a plain SQL load would be:
outer joins with a NULL test, OR-chains of comparisons, one report after another.
"""

from __future__ import annotations

from cardwarden import schemas

_VIEWS = {
    "tx": """
        SELECT CAST(l_orderkey AS varchar) || '-' || CAST(l_linenumber AS varchar) AS trans_id,
               CAST(l_shipdate AS date) AS trans_date,
               CAST(l_orderkey AS varchar) AS card_num,
               l_returnflag AS oper_type,
               CAST(l_extendedprice AS decimal(18,2)) AS amt,
               l_linestatus AS oper_result,
               'T' || CAST(l_suppkey AS varchar) AS terminal
        FROM lineitem""",
    "loads": """
        SELECT *, CASE WHEN trans_date < DATE '1997-01-01' THEN 1
                       WHEN trans_date < DATE '1999-01-01' THEN 2 ELSE 3 END AS load
        FROM tx""",
    "loaded": """
        SELECT a.* FROM loads a WHERE NOT EXISTS (
            SELECT 1 FROM loads b WHERE b.trans_id = a.trans_id AND b.load < a.load)""",
    "steps": """
        SELECT *, CASE WHEN load < 3 THEN load WHEN amt < 20000 THEN 3 ELSE 4 END AS step
        FROM loads""",
    "dropped": """
        SELECT a.* FROM steps a WHERE NOT EXISTS (
            SELECT 1 FROM steps b WHERE b.trans_id = a.trans_id AND b.step < a.step)""",
    "damaged_lines": """
        SELECT CAST(l_orderkey AS varchar) || '-' || CAST(l_linenumber AS varchar) AS trans_id,
               CASE WHEN l_tax > 0.075 THEN 'someday'
                    ELSE strftime(l_shipdate, '%Y-%-m-%-d') END AS trans_date,
               CASE WHEN l_discount > 0.095 THEN 'n/a'
                    ELSE CAST(CAST(l_extendedprice AS decimal(18,2)) AS varchar) END AS amt,
               CAST(l_orderkey AS varchar) AS card_num, l_returnflag AS oper_type,
               CASE WHEN l_quantity > 45 THEN 'REJECTED' ELSE l_linestatus END AS oper_result,
               'T' || CAST(l_suppkey AS varchar) AS terminal
        FROM lineitem""",
    "all_cards": """
        SELECT CAST(o_orderkey AS varchar) AS card_num, CAST(o_custkey AS varchar) AS account_num,
               CAST(o_orderdate AS date) AS create_dt, CAST(NULL AS date) AS update_dt
        FROM orders""",
    "cards": "SELECT * FROM all_cards WHERE CAST(card_num AS bigint) % 97 <> 0",
    "accounts": """
        SELECT CAST(c_custkey AS varchar) AS account_num,
               CASE WHEN c_custkey % 10 = 0 THEN NULL
                    ELSE DATE '1996-01-01' + CAST((c_custkey * 37) % 2200 AS int) END AS valid_to,
               'C' || CAST(c_custkey AS varchar) AS client,
               DATE '1995-01-01' AS create_dt, CAST(NULL AS date) AS update_dt
        FROM customer""",
    "all_clients": """
        SELECT 'C' || CAST(c_custkey AS varchar) AS client_id,
               c_name AS last_name, c_mktsegment AS first_name,
               CASE WHEN c_custkey % 7 = 0 THEN NULL
                    ELSE 'N' || CAST(c_nationkey AS varchar) END AS patronymic,
               DATE '1950-01-01' + CAST((c_custkey * 13) % 15000 AS int) AS date_of_birth,
               'P' || CAST(c_custkey AS varchar) AS passport_num,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE DATE '1996-06-01' + CAST((c_custkey * 53) % 2500 AS int)
               END AS passport_valid_to,
               '+7' || CAST(c_custkey AS varchar) AS phone,
               DATE '1995-01-01' AS create_dt, CAST(NULL AS date) AS update_dt
        FROM customer""",
    "clients": "SELECT * FROM all_clients WHERE CAST(substr(client_id, 2) AS bigint) % 89 <> 0",
    "listed": """
        SELECT DATE '1997-01-01' + CAST((c_custkey * 29) % 1500 AS int) AS entry_dt,
               'P' || CAST(c_custkey AS varchar) AS passport_num
        FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT DATE '1999-01-01' + CAST((c_custkey * 31) % 700 AS int),
               'P' || CAST(c_custkey AS varchar)
        FROM customer WHERE c_acctbal < 0 AND c_custkey % 2 = 0""",
    "terminals_old": """
        SELECT 'T' || CAST(s_suppkey AS varchar) AS terminal_id,
               CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
               'CITY_' || CAST(s_nationkey AS varchar) AS terminal_city,
               s_name AS terminal_address,
               DATE '2021-02-28' AS create_dt, CAST(NULL AS date) AS update_dt
        FROM supplier WHERE s_suppkey % 11 <> 0""",
    "all_terminals": """
        SELECT 'T' || CAST(s_suppkey AS varchar) AS terminal_id,
               CASE WHEN s_suppkey % 3 = 0 THEN 'POS' WHEN s_suppkey % 2 = 0 THEN 'ATM'
                    ELSE 'POS' END AS terminal_type,
               CASE WHEN s_suppkey % 7 = 0 THEN NULL
                    ELSE 'CITY_' || CAST(s_nationkey AS varchar) END AS terminal_city,
               s_name AS terminal_address,
               DATE '2021-03-01' AS create_dt, CAST(NULL AS date) AS update_dt
        FROM supplier""",
    "terminals_new": "SELECT * FROM all_terminals WHERE CAST(substr(terminal_id, 2) AS bigint) % 13 <> 0",
    "clients_old": "SELECT * FROM clients WHERE CAST(substr(client_id, 2) AS bigint) % 11 <> 0",
    "clients_new": """
        SELECT client_id, last_name, first_name,
               CASE WHEN n % 7 = 0 THEN NULL ELSE patronymic END AS patronymic,
               date_of_birth, passport_num,
               CASE WHEN n % 3 = 0 THEN passport_valid_to + 30 ELSE passport_valid_to
               END AS passport_valid_to,
               phone, DATE '2021-03-01' AS create_dt, update_dt
        FROM (SELECT *, CAST(substr(client_id, 2) AS bigint) AS n FROM clients)
        WHERE n % 13 <> 0""",
    "accounts_old": "SELECT * FROM accounts WHERE CAST(account_num AS bigint) % 11 <> 0",
    "accounts_new": """
        SELECT account_num,
               CASE WHEN n % 3 = 0 THEN valid_to + 30 ELSE valid_to END AS valid_to,
               CASE WHEN n % 7 = 0 THEN NULL ELSE client END AS client,
               DATE '2021-03-01' AS create_dt, update_dt
        FROM (SELECT *, CAST(account_num AS bigint) AS n FROM accounts) WHERE n % 13 <> 0""",
    "cards_old": "SELECT * FROM cards WHERE CAST(card_num AS bigint) % 11 <> 0",
    "cards_new": """
        SELECT card_num,
               CASE WHEN n % 7 = 0 THEN NULL WHEN n % 3 = 0 THEN account_num || 'x'
                    ELSE account_num END AS account_num,
               DATE '2021-03-01' AS create_dt, update_dt
        FROM (SELECT *, CAST(card_num AS bigint) AS n FROM cards) WHERE n % 13 <> 0""",
    "files": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN 'transactions'
                    WHEN o_orderstatus = 'O' THEN 'passport_blacklist'
                    WHEN o_orderpriority = '1-URGENT' THEN 'terminals' ELSE 'readme' END
               || '_' || strftime(o_orderdate, '%d%m%Y') || '.txt' AS file_name
        FROM orders""",
    "damaged": """
        SELECT CAST(l_orderkey AS varchar) || '-' || CAST(l_linenumber AS varchar) AS trans_id,
               CASE WHEN l_tax > 0.075 THEN 'someday'
                    ELSE year(l_shipdate) || '-' || month(l_shipdate) || '-' || day(l_shipdate)
               END AS trans_date,
               CASE WHEN l_discount > 0.095 THEN 'n/a'
                    ELSE CAST(CAST(l_extendedprice AS decimal(18,2)) AS varchar) END AS amt,
               CASE WHEN l_quantity > 45 THEN 'REJECTED' ELSE l_linestatus END AS oper_result
        FROM lineitem""",
}
_ORDER = list(_VIEWS)


def _with(body: str) -> str:
    """The body preceded by the views, in an order in which each knows its own inputs."""
    named = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in _ORDER)
    return f"WITH {named}\n{body}"


_DIMS = {t.name.removeprefix("dim_"): (t.key, t.tracked) for t in schemas.DIMENSIONS}


def _changed(columns: tuple[str, ...]) -> str:
    """The attributes as a whole are not the same; NULL is the same as NULL."""
    old, new = (", ".join(f"{side}.{c}" for c in columns) for side in "on")
    return f"row({new}) IS DISTINCT FROM row({old})"


def _scd1(name: str) -> str:
    key, columns = _DIMS[name]
    new, changed = f"o.{key} IS NULL", f"({_changed(columns)})"
    values = ", ".join(
        f"CASE WHEN {new} OR {changed} THEN n.{c} ELSE o.{c} END AS {c}" for c in columns
    )
    return _with(
        f"""SELECT n.{key} AS {key}, {values},
               CASE WHEN {new} THEN n.create_dt ELSE o.create_dt END AS create_dt,
               CASE WHEN {new} THEN n.update_dt WHEN {changed} THEN DATE '2021-03-01'
                    ELSE o.update_dt END AS update_dt
        FROM {name}_old o FULL JOIN {name}_new n ON o.{key} = n.{key}
        WHERE n.{key} IS NOT NULL"""
    )


def _inserted(name: str) -> str:
    key = _DIMS[name][0]
    return (
        f"SELECT 'dim_{name}' AS dim, n.{key} AS key FROM {name}_new n"
        f" LEFT JOIN {name}_old o ON o.{key} = n.{key} WHERE o.{key} IS NULL"
    )


def _updated(name: str) -> str:
    key, columns = _DIMS[name]
    return (
        f"SELECT 'dim_{name}' AS dim, n.{key} AS key FROM {name}_new n"
        f" JOIN {name}_old o ON o.{key} = n.{key} WHERE {_changed(columns)}"
    )


def _deleted(name: str) -> str:
    key = _DIMS[name][0]
    return (
        f"SELECT 'dim_{name}' AS dim, gone.{key} AS key FROM {name}_old gone"
        f" WHERE NOT EXISTS (SELECT 1 FROM {name}_new n WHERE n.{key} = gone.{key})"
    )


def _all_dims(arm) -> str:
    return _with("\nUNION ALL\n".join(arm(name) for name in _DIMS))


def _diff_clients() -> str:
    key, columns = _DIMS["clients"]
    old, new = (", ".join(f"{side}.{c}" for c in (key, *columns)) for side in "on")
    on = f"ON n.{key} = o.{key}"
    return _with(
        f"""SELECT 'I' AS change, {new} FROM clients_new n LEFT JOIN clients_old o {on}
        WHERE o.{key} IS NULL
        UNION ALL SELECT 'U', {new} FROM clients_new n JOIN clients_old o {on}
        WHERE {_changed(columns)}
        UNION ALL SELECT 'D', {old} FROM clients_old o LEFT JOIN clients_new n {on}
        WHERE n.{key} IS NULL"""
    )


def _people(state: str) -> str:
    """Every card with its holder and the last day of the contract."""
    return f"""(SELECT card_num, valid_to AS contract_end, holder.*,
                   last_name || ' ' || first_name || ' ' || patronymic AS fio
            FROM cards{state}, accounts{state}, clients{state} AS holder
            WHERE cards{state}.account_num = accounts{state}.account_num
              AND client = client_id) AS person"""


_EVENT = "trans_date AS event_dt, person.passport_num AS passport, fio, phone"


def _contract(day: str, facts: str = "tx", state: str = "") -> str:
    """Type 2: the contract ended before the day of the transaction."""
    return f"""
        SELECT {_EVENT}, '2' AS event_type, {day} AS report_dt
        FROM {facts} AS paid, {_people(state)}
        WHERE paid.card_num = person.card_num AND contract_end < trans_date"""


def _passport(day: str, facts: str = "tx", state: str = "", listed: str = "listed") -> str:
    """Type 1: the passport expired before that day, once for each earlier blacklist entry,
    and once if there is none."""
    return f"""
        SELECT event_dt, passport, fio, phone, '1' AS event_type, {day} AS report_dt
        FROM (SELECT {_EVENT},
                     (SELECT count(*) FROM {listed} AS entry
                      WHERE entry.passport_num = person.passport_num
                        AND entry.entry_dt < trans_date) AS entries
              FROM {facts} AS paid, {_people(state)}
              WHERE paid.card_num = person.card_num AND passport_valid_to < trans_date),
             unnest(range(greatest(1, entries))) AS copies(number)"""


def _both(day: str, facts: str = "tx", state: str = "", listed: str = "listed") -> str:
    return f"{_passport(day, facts, state, listed)}\nUNION ALL\n{_contract(day, facts, state)}"


def _three_runs(upto: str) -> str:
    """One report per load, over the loads that the comparison with its number selects."""
    return "\nUNION ALL\n".join(
        _both(f"DATE '2021-03-0{load}'", f"(SELECT * FROM loaded WHERE load {upto} {load})")
        for load in (1, 2, 3)
    )


_EARLY = "(SELECT * FROM listed WHERE entry_dt < DATE '1999-01-01')"
# The first two blacklist loads: passports of the first one take nothing from the second.
_GROWN = f"""(SELECT * FROM {_EARLY} UNION ALL SELECT l.* FROM listed l
    LEFT JOIN {_EARLY} e ON e.passport_num = l.passport_num WHERE e.passport_num IS NULL)"""

_NIGHTLY = "\nUNION ALL\n".join(
    _both(
        f"DATE '2021-03-0{load}'",
        f"(SELECT * FROM loaded WHERE load <= {load})",
        "_old" if load == 1 else "_new",
        _EARLY if load == 1 else _GROWN,
    )
    for load in (1, 2, 3)
)

_DAY = "DATE '2021-03-03'"
_TX_LIMITS = schemas.TRANSACTIONS.limits


def _whole_null_counts(name: str, rows: str, number: str, emptied: str) -> str:
    columns = (_DIMS[name][0], *_DIMS[name][1], "create_dt", "update_dt")
    return "\nUNION ALL\n".join(
        f"SELECT 'dim_{name}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        f"{f' OR CAST({number} AS bigint) % 7 = 0' if c == emptied else ''}) AS n_nulls FROM {rows}"
        for c in columns
    )


def _orphans(reference: str, child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{reference}' AS reference, c.{column} AS missing_key, count(*) AS n_rows"
        f" FROM {child} c LEFT JOIN {parent} p ON p.{key} = c.{column}"
        f" WHERE p.{key} IS NULL AND c.{column} IS NOT NULL GROUP BY c.{column}"
    )


# Columns at fault, in table order.
_PROBLEMS = "concat_ws(',', " + ", ".join(
    "CASE WHEN trans_date = 'someday' THEN 'trans_date' END" if c == "trans_date"
    else "CASE WHEN amt = 'n/a' THEN 'amt' END" if c == "amt"
    else f"CASE WHEN length(rtrim({c})) > {_TX_LIMITS[c]} THEN '{c}' END"
    for c in schemas.TRANSACTIONS.columns
) + ")"

# The irregular drop: first run over two files, a late day over all, and a second run for
# the first day that judges only what it adds.
_DROPPED_REPORT = "\nUNION ALL\n".join(
    _both(f"DATE '{day}'", f"(SELECT * FROM dropped WHERE step {steps})", state, _GROWN)
    for day, steps, state in (
        ("2021-03-02", "<= 2", "_old"), ("2021-03-01", "<= 3", "_new"), ("2021-03-02", "= 4", "_new")
    )
)

_TRANSACTIONS = _with("SELECT * FROM tx")
_LOADED = "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM loaded"

ORACLES: dict[str, str] = {
    "stage_transactions": _TRANSACTIONS,
    "csv_transactions": _TRANSACTIONS,
    "stage_blacklist": _with("SELECT * FROM listed"),
    "stage_terminals": _with("SELECT * FROM all_terminals"),
    "stage_clients": _with("SELECT * FROM all_clients"),
    "stage_accounts": _with("SELECT * FROM accounts"),
    "stage_cards": _with("SELECT * FROM all_cards"),
    "workbook_blacklist": _with("SELECT * FROM listed"),
    "workbook_terminals": _with("SELECT * FROM all_terminals"),
    "route_files": _with(
        """SELECT o_orderkey, file_name,
               CASE WHEN contains(file_name, 'transactions') THEN 'transactions'
                    WHEN contains(file_name, 'passport_blacklist') THEN 'passport_blacklist'
                    WHEN contains(file_name, 'terminals') THEN 'terminals' END AS feed
        FROM files"""
    ),
    "report_date_from_file": _with(
        """SELECT o_orderkey, file_name,
               CAST(strptime(file_name[-12:-5], '%d%m%Y') AS date) AS report_dt
        FROM files"""
    ),
    "compact_days": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact,
               CAST(o_orderdate AS date) AS order_dt
        FROM orders""",
    "new_transactions": _with(
        """SELECT b.* FROM tx b LEFT JOIN (SELECT trans_id FROM loads WHERE load = 1) held
        ON held.trans_id = b.trans_id WHERE held.trans_id IS NULL"""
    ),
    "new_blacklist": _with(
        f"""SELECT b.* FROM listed b LEFT JOIN {_EARLY} held
        ON held.passport_num = b.passport_num WHERE held.passport_num IS NULL"""
    ),
    "transactions_by_load": _with("SELECT * FROM loaded"),
    "scd1_terminals": _scd1("terminals"),
    "scd1_clients": _scd1("clients"),
    "scd1_accounts": _scd1("accounts"),
    "scd1_cards": _scd1("cards"),
    "diff_inserted": _all_dims(_inserted),
    "diff_changed": _all_dims(_updated),
    "diff_deleted": _all_dims(_deleted),
    "diff_clients": _diff_clients(),
    "fraud_expired_contract": _with(_contract(_DAY)),
    "fraud_passport_literal": _with(_passport(_DAY)),
    "fraud_passport_intended": _with(
        f"""SELECT {_EVENT}, '1' AS event_type, {_DAY} AS report_dt
        FROM tx AS paid, {_people("")}
        WHERE paid.card_num = person.card_num AND (passport_valid_to < trans_date
              OR trans_date > (SELECT min(entry_dt) FROM listed AS entry
                               WHERE entry.passport_num = person.passport_num))"""
    ),
    "fraud_report": _with(_both(_DAY)),
    "report_three_runs": _with(_three_runs("<=")),
    "report_three_runs_incremental": _with(_three_runs("=")),
    "report_idempotent": _with(_three_runs("=")),
    "nightly_report": _with(_NIGHTLY),
    "dq_duplicate_keys": _with(
        "SELECT trans_id, count(*) AS n_rows FROM tx GROUP BY trans_id HAVING count(*) > 1"
    ),
    "dq_null_keys": _with(
        "\nUNION ALL\n".join(
            _whole_null_counts(*check)
            for check in (
                ("clients", "all_clients", "substr(client_id, 2)", "patronymic"),
                ("accounts", "accounts", "account_num", "client"),
                ("cards", "all_cards", "card_num", "account_num"),
            )
        )
    ),
    "dq_null_keys_whole": _with(
        "\nUNION ALL\n".join(
            _whole_null_counts(*check)
            for check in (
                ("clients", "all_clients", "substr(client_id, 2)", "patronymic"),
                ("accounts", "accounts", "account_num", "client"),
                ("cards", "all_cards", "card_num", "account_num"),
            )
        )
    ),
    "dq_orphans": _with(
        "\nUNION ALL\n".join(
            _orphans(*check)
            for check in (
                ("transactions.card_num", "tx", "card_num", "cards", "card_num"),
                ("cards.account_num", "cards", "account_num", "accounts", "account_num"),
                ("accounts.client", "accounts", "client", "clients", "client_id"),
            )
        )
    ),
    "dq_overlength": _with(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, {n} AS max_length,"
            f" coalesce(max(length(rtrim({c}))), 0) AS longest,"
            f" count(*) FILTER (WHERE length(rtrim({c})) > {n}) AS n_over FROM tx"
            for c, n in _TX_LIMITS.items()
        )
    ),
    "dq_rejects": _with(
        """SELECT * FROM (SELECT *, concat_ws(',',
                   CASE WHEN trans_date = 'someday' THEN 'trans_date' END,
                   CASE WHEN amt = 'n/a' THEN 'amt' END,
                   CASE WHEN length(oper_result) > 7 THEN 'oper_result' END) AS problems
            FROM damaged) WHERE problems <> ''"""
    ),
    "stream_new_transactions": _with(_LOADED),
    "stream_fraud": _with(_three_runs("=")),
    "stage_accepted": _with(
        f"""SELECT trans_id, CAST(trans_date AS date) AS trans_date, card_num, oper_type,
               CAST(amt AS decimal(18,2)) AS amt, oper_result, terminal
        FROM (SELECT *, {_PROBLEMS} AS problems FROM damaged_lines) WHERE problems = ''"""
    ),
    "stream_and_nightly": _with(_LOADED),
    "stream_rejects": _with(
        f"""SELECT {", ".join(schemas.TRANSACTION_FILE)}, problems
        FROM (SELECT *, {_PROBLEMS} AS problems FROM damaged_lines) WHERE problems <> ''"""
    ),
    "drop_report": _with(_DROPPED_REPORT),
    "drop_transactions": _with(
        "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM dropped"
    ),
}
