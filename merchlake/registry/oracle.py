"""DuckDB SQL giving the same rows as the registered queries, over the same tables."""

from __future__ import annotations

_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

_VIEWS = {
    "c_orders": f"""
        SELECT {_LINE_ID} AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               l_quantity::INTEGER AS quantity, l_extendedprice AS total_price,
               o_orderdate AS order_date,
               CASE WHEN l_returnflag = 'R' THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Completed'
                    WHEN o_orderstatus = 'O' THEN 'Pending' WHEN o_orderstatus = 'P' THEN 'Shipped'
               END AS status
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "c_customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               '  ' || upper(c_name) || '@EXAMPLE.COM ' AS email,
               coalesce(first_order, TIMESTAMP '1995-01-01 00:00:00') AS created_at,
               c_mktsegment AS signup_channel
        FROM customer LEFT JOIN
             (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
             ON c_custkey = f.o_custkey""",
    "c_products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
               p_retailprice AS price, p_size AS stock
        FROM part""",
    "c_payments": f"""
        SELECT {_LINE_ID} AS payment_id, {_LINE_ID} AS order_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS payment_method,
               l_extendedprice AS amount,
               CASE WHEN l_returnflag = 'R' THEN 'Refunded' WHEN o_orderstatus = 'O' THEN 'Pending'
                    ELSE 'Completed' END AS status,
               l_shipdate AS payment_date
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "c_reviews": """
        SELECT event_id AS review_id, user_id AS customer_id,
               json_extract_string(props, '$.k')::BIGINT AS product_id,
               (1 + event_id % 5)::INTEGER AS rating, event_type AS review_text, ts AS review_date
        FROM events""",
    "c_items": f"""
        SELECT 'I-' || {_LINE_ID} AS item_id, {_LINE_ID} AS order_id, l_partkey AS product_id,
               l_quantity::INTEGER AS quantity, l_extendedprice AS unit_price,
               floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100 AS total_price
        FROM lineitem""",
    "r_customers": """
        SELECT CASE WHEN c_acctbal >= 0 THEN '' ELSE 'X-' END || c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name || '@example.com' END AS email,
               CASE WHEN c_nationkey = 24 THEN '31/01/1995 00:00:00'
                    ELSE '1995-01-01 00:00:00' END AS created_at,
               c_mktsegment AS signup_channel
        FROM customer""",
    "r_products": """
        SELECT CASE WHEN p_size >= 6 THEN '' ELSE 'X-' END || p_partkey AS product_id, p_name AS name,
               p_type AS category, CASE WHEN p_type = 'PROMO' THEN '0.0' ELSE p_retailprice::VARCHAR END AS price,
               (p_size - 10)::VARCHAR AS stock
        FROM part""",
    "r_orders": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_id, o_custkey::VARCHAR AS customer_id,
               l_partkey::VARCHAR AS product_id,
               CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || l_quantity::INTEGER AS quantity,
               CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || l_extendedprice AS total_price,
               CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
               CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN o_orderstatus = 'F' THEN 'Completed'
                    WHEN o_orderstatus = 'O' THEN 'Pending' WHEN o_orderstatus = 'P' THEN 'Shipped'
               END AS status
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "r_payments": f"""
        SELECT {_LINE_ID} AS payment_id, concat_ws('-', l_orderkey, l_linenumber) AS order_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS payment_method,
               l_discount::VARCHAR AS amount,
               CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'Open' END AS status,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS payment_date
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "r_reviews": """
        SELECT event_id::VARCHAR AS review_id, user_id::VARCHAR AS customer_id,
               json_extract_string(props, '$.k') AS product_id,
               floor(value / 30)::BIGINT::VARCHAR AS rating,
               CASE WHEN event_type <> 'error' THEN event_type END AS review_text,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS review_date
        FROM events""",
    "earlier": f"""
        SELECT {_LINE_ID} AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               l_quantity::INTEGER AS quantity,
               CASE WHEN o_orderstatus = 'O' THEN floor(l_extendedprice) ELSE l_extendedprice END
                   AS total_price,
               o_orderdate AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending'
                    WHEN 'P' THEN 'Shipped' END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderdate < TIMESTAMP '2000-07-01'""",
    "s_orders": """
        SELECT * FROM c_orders QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY total_price DESC, customer_id DESC, product_id DESC, quantity DESC,
                     order_date DESC, status DESC) = 1""",
    "s_payments": """
        SELECT * FROM c_payments QUALIFY row_number() OVER (PARTITION BY payment_id
            ORDER BY amount DESC, order_id DESC, payment_method DESC, status DESC,
                     payment_date DESC) = 1""",
    "s_earlier": """
        SELECT * FROM earlier QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY total_price DESC, customer_id DESC, product_id DESC, quantity DESC,
                     order_date DESC, status DESC) = 1""",
    "days": """
        SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INTEGER AS date_key, d::DATE AS full_date,
               year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
               strftime(d, '%B') AS month_name, day(d)::INTEGER AS day_of_month,
               (isodow(d) - 1)::INTEGER AS day_of_week, strftime(d, '%A') AS day_name,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT unnest(generate_series(
                  make_timestamp(min(year(o_orderdate)), 1, 1, 0, 0, 0),
                  make_timestamp(max(year(o_orderdate)), 12, 31, 0, 0, 0),
                  INTERVAL 1 DAY)) AS d FROM orders) s""",
    "k_customers": """
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id,
               name, email, signup_channel, created_at FROM c_customers""",
    "k_products": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id,
               name, category, price FROM c_products""",
    "facts": """
        SELECT o.order_id, c.customer_key, p.product_key, d.date_key, o.quantity,
               round((o.total_price / o.quantity)::DECIMAL(38,10), 2)::DOUBLE AS unit_price,
               o.total_price, o.status AS order_status,
               coalesce(y.payment_method, 'Unknown') AS payment_method
        FROM s_orders o
        JOIN k_customers c ON o.customer_id = c.customer_id
        JOIN k_products p ON o.product_id = p.product_id
        JOIN days d ON o.order_date::DATE = d.full_date
        LEFT JOIN (SELECT order_id, arg_max(payment_method, (payment_date, payment_id)) AS payment_method
                   FROM s_payments GROUP BY order_id) y ON o.order_id = y.order_id""",
}

_NEEDS = {
    "k_customers": ("c_customers",),
    "k_products": ("c_products",),
    "s_orders": ("c_orders",),
    "s_payments": ("c_payments",),
    "s_earlier": ("earlier",),
    "facts": ("s_orders", "s_payments", "k_customers", "k_products", "days"),
}


def _exact(column: str) -> str:
    return f"sum({column}::DECIMAL(38,10))"


def _money(column: str) -> str:
    return f"coalesce(round({_exact(column)}, 2), 0)::DOUBLE"


def _cents(expression: str) -> str:
    return f"round(({expression})::DECIMAL(38,10), 2)::DOUBLE"


def _as_double(decimal: str) -> str:
    """The nearest double; a direct cast divides in doubles and may be one digit off."""
    return f"({decimal})::VARCHAR::DOUBLE"


def _average(column: str) -> str:
    return f"coalesce({_cents(f'{_as_double(_exact(column))} / count({column})')}, 0.0)"


def _with(views: str, body: str, more: str = "") -> str:
    wanted: list[str] = []
    for view in views.split():
        for name in (*_needed(view), view):
            if name not in wanted:
                wanted.append(name)
    parts = [f"{name} AS ({_VIEWS[name]})" for name in wanted]
    if more:
        parts.append(more)
    return f"WITH {', '.join(parts)} {body}"


def _needed(view: str) -> list[str]:
    found: list[str] = []
    for name in _NEEDS.get(view, ()):
        found += [*_needed(name), name]
    return found


_PRODUCT_SALES = f"""
    SELECT p.product_id, p.name, p.category, sum(o.quantity)::BIGINT AS total_quantity_sold,
           {_money("o.total_price")} AS total_revenue
    FROM c_products p JOIN c_orders o ON p.product_id = o.product_id
    WHERE o.status = 'Completed'
    GROUP BY p.product_id, p.name, p.category"""

_CATEGORY_SALES = f"""
    SELECT p.category, sum(o.quantity)::BIGINT AS total_items_sold,
           {_money("o.total_price")} AS total_revenue
    FROM c_products p JOIN c_orders o ON p.product_id = o.product_id
    WHERE o.status = 'Completed'
    GROUP BY p.category"""

_KPIS = f"""
    SELECT (SELECT count(*) FROM c_customers) AS total_customers,
           (SELECT count(*) FROM c_products) AS total_products,
           (SELECT count(*) FROM c_orders) AS total_orders,
           (SELECT {_money("total_price")} FROM c_orders) AS total_revenue,
           (SELECT {_average("total_price")} FROM c_orders) AS average_order_value,
           (SELECT coalesce(sum(quantity), 0)::BIGINT FROM c_orders) AS total_quantity_sold,
           (SELECT count(*) FROM c_payments WHERE status = 'Completed') AS successful_payments,
           (SELECT coalesce({_cents("avg(rating)")}, 0.0) FROM c_reviews) AS average_product_rating"""

_BY_CATEGORY = f"""
    SELECT p.category, count(DISTINCT p.product_id) AS product_count,
           coalesce(sum(o.quantity), 0)::BIGINT AS total_quantity_sold,
           {_money("o.total_price")} AS total_revenue
    FROM c_products p LEFT JOIN c_orders o ON p.product_id = o.product_id
    GROUP BY p.category"""

_SENTIMENT = f"""
    SELECT CASE WHEN rating >= 4 THEN 'Positive (4-5 Stars)' WHEN rating = 3 THEN 'Neutral (3 Stars)'
                ELSE 'Negative (1-2 Stars)' END AS sentiment_category,
           count(review_id) AS review_count,
           {_cents("count(review_id) * 100.0 / (SELECT count(*) FROM c_reviews)")} AS percentage
    FROM c_reviews GROUP BY 1"""


def _long(section: str, source: str, item: str, metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, {m}::DOUBLE AS value"
        f" FROM ({source})"
        for m in metrics.split()
    )


_SUMMARY = " UNION ALL ".join(
    (
        _long(
            "kpis", _KPIS, "'all'",
            "total_customers total_products total_orders total_revenue average_order_value"
            " total_quantity_sold successful_payments average_product_rating",
        ),
        _long(
            "category_revenue", _BY_CATEGORY, "category",
            "product_count total_quantity_sold total_revenue",
        ),
        _long("sentiment", _SENTIMENT, "sentiment_category", "review_count percentage"),
    )
)

# --- data quality -----------------------------------------------------------------------

_RAW = "r_customers r_products r_orders r_payments r_reviews"
_RAW_COLUMNS = {
    "customers": "customer_id name email created_at signup_channel",
    "products": "product_id name category price stock",
    "orders": "order_id customer_id product_id quantity total_price order_date status",
    "payments": "payment_id order_id payment_method amount status payment_date",
    "reviews": "review_id customer_id product_id rating review_text review_date",
}
_KEYS = {name: columns.split()[0] for name, columns in _RAW_COLUMNS.items()}
_USES = (
    ("orders", "customer_id", "customers"),
    ("orders", "product_id", "products"),
    ("payments", "order_id", "orders"),
    ("reviews", "customer_id", "customers"),
    ("reviews", "product_id", "products"),
)
_VALUE_RULES = (
    ("products", "invalid_prices", "price", "TRY_CAST(price AS DOUBLE) <= 0"),
    ("products", "invalid_stock", "stock", "TRY_CAST(stock AS DOUBLE) < 0"),
    ("orders", "invalid_quantities", "quantity", "TRY_CAST(quantity AS DOUBLE) <= 0"),
    ("orders", "invalid_total_prices", "total_price", "TRY_CAST(total_price AS DOUBLE) <= 0"),
    ("payments", "invalid_amounts", "amount", "TRY_CAST(amount AS DOUBLE) <= 0"),
    (
        "reviews", "invalid_ratings", "rating",
        "NOT coalesce(TRY_CAST(rating AS DOUBLE) BETWEEN 1 AND 5, false)",
    ),
)
_MOMENTS = {
    "customers": "created_at", "orders": "order_date", "payments": "payment_date",
    "reviews": "review_date",
}
_STATUSES = {
    "orders": "('Completed', 'Pending', 'Cancelled', 'Shipped')",
    "payments": "('Completed', 'Pending', 'Failed', 'Refunded')",
}


def _missing(name: str) -> str:
    return " + ".join(f"({c} IS NULL)::INTEGER" for c in _RAW_COLUMNS[name].split())


def _bad_date(column: str) -> str:
    return (
        f"NOT coalesce(regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} "
        f"[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') AND "
        f"try_strptime({column}, '%Y-%m-%d %H:%M:%S') IS NOT NULL, false)"
    )


def _bad_status(name: str) -> str:
    return f"NOT coalesce(status IN {_STATUSES[name]}, false)"


def _dangling(child: str, column: str, parent: str) -> str:
    key = _KEYS[parent]
    return f"{column} IS NULL OR {column} NOT IN (SELECT {key} FROM r_{parent} WHERE {key} IS NOT NULL)"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


_DUPLICATES = _union(
    f"SELECT '{n}' AS dataset, (count(*) - count(DISTINCT {k}) -"
    f" (count(*) > count({k}))::INTEGER)::BIGINT AS duplicate_id_count FROM r_{n}"
    for n, k in _KEYS.items()
)
_FK_COUNTS = _union(
    f"SELECT '{c}' AS dataset, '{col}' AS column_name,"
    f" count(*) FILTER (WHERE {_dangling(c, col, p)}) AS violations FROM r_{c}"
    for c, col, p in _USES
)


def _audit_row(name: str) -> str:
    invalid = [
        f"count(*) FILTER (WHERE {test})" for n, _, _, test in _VALUE_RULES if n == name
    ] or ["0"]
    dangling = [
        f"count(*) FILTER (WHERE {_dangling(*use)})" for use in _USES if use[0] == name
    ] or ["0"]
    dates = (
        f"count(*) FILTER (WHERE {_bad_date(_MOMENTS[name])})" if name in _MOMENTS else "0"
    )
    statuses = f"count(*) FILTER (WHERE {_bad_status(name)})" if name in _STATUSES else "0"
    key = _KEYS[name]
    return f"""
        SELECT '{name}' AS dataset, count(*) AS rows_checked,
               coalesce(sum({_missing(name)}), 0)::BIGINT AS missing_value_count,
               (count(*) - count(DISTINCT {key}) - (count(*) > count({key}))::INTEGER)::BIGINT
                   AS duplicate_id_count,
               ({" + ".join(invalid)})::BIGINT AS invalid_value_count,
               ({" + ".join(dangling)})::BIGINT AS foreign_key_violations,
               ({dates})::BIGINT AS date_errors, ({statuses})::BIGINT AS status_errors
        FROM r_{name}"""


_ISSUES = (
    "missing_value_count + duplicate_id_count + invalid_value_count + foreign_key_violations"
    " + date_errors + status_errors"
)
_AUDIT = (
    f"SELECT *, ({_ISSUES})::BIGINT AS issues, ({_ISSUES}) = 0 AS passed"
    f" FROM ({_union(_audit_row(n) for n in _RAW_COLUMNS)})"
)

_TYPES = {
    "price": "DOUBLE", "stock": "INTEGER", "quantity": "INTEGER", "total_price": "DOUBLE",
    "amount": "DOUBLE", "rating": "INTEGER", "created_at": "TIMESTAMP", "order_date": "TIMESTAMP",
    "payment_date": "TIMESTAMP", "review_date": "TIMESTAMP",
}


def _typed(name: str) -> str:
    columns = ", ".join(
        f"TRY_CAST({c} AS {_TYPES[c]}) AS {c}" if c in _TYPES else c
        for c in _RAW_COLUMNS[name].split()
    )
    return f"(SELECT {columns} FROM r_{name})"


def _empty_cell(name: str) -> str:
    return " OR ".join(
        f"{c} IS NULL OR {c}::VARCHAR = ''" for c in _RAW_COLUMNS[name].split()
    )


def _typed_break(column: str) -> str:
    return f"{column} NOT BETWEEN 1 AND 5" if column == "rating" else f"{column} <= 0"


_VIOLATION_ROWS = _union(
    [
        f"SELECT '{n}' AS dataset, 'duplicate primary ids' AS error, NULL::VARCHAR AS row_id,"
        f" NULL::VARCHAR AS value WHERE EXISTS"
        f" (SELECT 1 FROM r_{n} GROUP BY {k} HAVING count(*) > 1)"
        for n, k in _KEYS.items()
    ]
    + [
        f"SELECT '{n}', 'missing value', NULL, NULL WHERE EXISTS"
        f" (SELECT 1 FROM {_typed(n)} t WHERE {_empty_cell(n)})"
        for n in _KEYS
    ]
    + [
        f"SELECT '{n}', 'invalid {c}', {_KEYS[n]}, {c}::VARCHAR FROM {_typed(n)} t"
        f" WHERE {_typed_break(c)}"
        for n, _, c, _ in _VALUE_RULES
        if c != "stock"
    ]
    + [
        f"SELECT '{c}', 'Broken FK: {col}', {_KEYS[c]}, {col}"
        f" FROM r_{c} WHERE {_dangling(c, col, p)}"
        for c, col, p in _USES
    ]
)


def _rejects(name: str) -> str:
    rules = [
        f"CASE WHEN {c} IS NULL THEN '{c} is missing' END" for c in _RAW_COLUMNS[name].split()
    ] + [
        f"CASE WHEN {c} < 0 THEN '{rule}' END"
        if c == "stock"
        else f"CASE WHEN {_typed_break(c)} THEN '{rule}' END"
        for n, rule, c, _ in _VALUE_RULES
        if n == name
    ]
    return (
        f"SELECT '{name}' AS dataset, {_KEYS[name]} AS row_id,"
        f" concat_ws(',', {', '.join(rules)}) AS violated_rules FROM {_typed(name)} t"
    )


_REJECTS = (
    f"SELECT * FROM ({_union(_rejects(n) for n in _RAW_COLUMNS)}) WHERE violated_rules <> ''"
)

# --- change data capture and drift ------------------------------------------------------

_COMPARED = ("customer_id", "product_id", "quantity", "total_price", "order_date", "status")
_CLASSIFIED = f"""
    SELECT n.order_id,
           CASE WHEN e.order_id IS NULL THEN 'INSERT'
                WHEN {" OR ".join(f"n.{c} IS DISTINCT FROM e.{c}" for c in _COMPARED)} THEN 'UPDATE'
                ELSE 'NO_CHANGE' END AS cdc_action,
           CASE WHEN e.order_id IS NULL THEN '' ELSE concat_ws(',', {", ".join(
               f"CASE WHEN n.{c} IS DISTINCT FROM e.{c} THEN '{c}' END" for c in _COMPARED
           )}) END AS changed_columns
    FROM s_orders n LEFT JOIN s_earlier e ON n.order_id = e.order_id"""

_MERGED = """
    SELECT * FROM s_orders
    UNION ALL SELECT * FROM s_earlier WHERE order_id NOT IN (SELECT order_id FROM s_orders)"""


def _metrics(view: str) -> str:
    parts = []
    for column in ("customer_id", "product_id", "quantity", "total_price"):
        exact = _as_double(f"sum({column}::DECIMAL(38,8))")
        for metric, figure in (
            ("count", "count(*)"),
            ("nulls", f"count(*) - count({column})"),
            ("mean", f"{exact} / count({column})"),
            ("sum", exact),
            ("min", f"min({column})"),
            ("max", f"max({column})"),
        ):
            parts.append(
                f"SELECT '{column}' AS column_name, '{metric}' AS metric,"
                f" ({figure})::DOUBLE AS value FROM {view}"
            )
    return _union(parts)


def _metric_drift(baseline: str, current: str) -> str:
    return f"""
    SELECT column_name, metric, b.value AS baseline, c.value AS current,
           round(change::DECIMAL(38,10), 4)::DOUBLE AS relative_change, 0.2::DOUBLE AS threshold,
           change > 0.2::DOUBLE AS has_drift
    FROM ({_metrics(baseline)}) b JOIN ({_metrics(current)}) c USING (column_name, metric),
         LATERAL (SELECT CASE WHEN b.value = 0 THEN abs(c.value)
                              ELSE abs(c.value - b.value) / abs(b.value) END AS change) x"""


def _fits(value: str) -> str:
    return f"""
        CASE WHEN count({value}) = 0 THEN 'void'
             WHEN bool_and({value} IS NULL OR regexp_full_match({value}, '[+-]?[0-9]+')) THEN 'bigint'
             WHEN bool_and({value} IS NULL OR TRY_CAST({value} AS DOUBLE) IS NOT NULL) THEN 'double'
             WHEN bool_and({value} IS NULL OR TRY_CAST({value} AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
             ELSE 'string' END"""


def _drift(expected: dict[str, str], found: str) -> str:
    wanted = ", ".join(f"('{c}', '{t}')" for c, t in expected.items())
    return f"""
        SELECT column_name,
               CASE WHEN f.actual IS NULL THEN 'missing' WHEN w.expected IS NULL THEN 'added'
                    ELSE 'type_mismatch' END AS kind,
               coalesce(w.expected, '') AS expected, coalesce(f.actual, '') AS actual
        FROM (VALUES {wanted}) w(column_name, expected) FULL JOIN ({found}) f USING (column_name)
        WHERE w.expected IS DISTINCT FROM f.actual"""


_JSON_KEYS = f"""
    SELECT key AS column_name, {_fits("value")} AS actual
    FROM (SELECT key, json_extract_string(props, '$."' || key || '"') AS value
          FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) k) v
    GROUP BY key"""

_DOCUMENTS = """
    SELECT ('{"kind": "' || event_type || '", "user": {"account": {"id": '
            || CASE WHEN event_type = 'error' THEN '"' || user_id || '"' ELSE user_id::VARCHAR END
            || '}, "props": ' || props || '}, "lines": ['
            || CASE WHEN event_type = 'purchase' THEN '{"amount": ' || value::VARCHAR || '}' ELSE '' END
            || ']}')::JSON AS d
    FROM events"""

_VALUES_BY_PATH = _union(
    f"SELECT '{path}' AS column_name, {value} AS value FROM documents"
    for path, value in {
        "kind": "d -> '$.kind'",
        "user": "d -> '$.user'",
        "user.account": "d -> '$.user.account'",
        "user.account.id": "d -> '$.user.account.id'",
        "user.props": "d -> '$.user.props'",
        "user.props.k": "d -> '$.user.props.k'",
        "user.props.source": "d -> '$.user.props.source'",
        "lines": "d -> '$.lines'",
        "lines[]": "unnest(d -> '$.lines[*]')",
        "lines[].amount": "unnest(d -> '$.lines[*].amount')",
    }.items()
)

_NESTED_TYPES = f"""
    WITH documents AS ({_DOCUMENTS}), kinds AS (
        SELECT column_name, CASE json_type(value) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'bigint'
                   ELSE lower(json_type(value)) END AS kind
        FROM ({_VALUES_BY_PATH}) WHERE value IS NOT NULL)
    SELECT column_name,
           CASE WHEN count(DISTINCT kind) = 1 THEN max(kind)
                WHEN bool_and(kind IN ('bigint', 'double')) THEN 'double' ELSE 'mixed' END AS actual
    FROM kinds GROUP BY column_name"""

_NESTED_DRIFT = _drift(
    {
        "kind": "string", "user": "object", "user.account": "object", "user.account.id": "bigint",
        "user.props": "object", "user.props.k": "double", "user.props.source": "string",
        "lines": "array", "lines[]": "object", "lines[].amount": "double",
    },
    _NESTED_TYPES,
)

_PAYMENT_TYPES = _union(
    f"SELECT '{c}' AS column_name, {_fits(c)} AS actual FROM r_payments"
    for c in _RAW_COLUMNS["payments"].split()
)


def _scan(view: str, ids: str, moment: str, rest: str) -> str:
    columns = [f"{c}::VARCHAR AS {c}" for c in ids.split()]
    if moment:
        columns.append(f"date_trunc('second', {moment})::TIMESTAMP AS {moment}")
    return _with(view, f"SELECT {', '.join(columns + rest.split())} FROM {view}")


_SCAN_ORDERS = _scan(
    "c_orders", "order_id customer_id product_id", "order_date", "quantity total_price status"
)
_SCAN_REVIEWS = _scan(
    "c_reviews", "review_id customer_id product_id", "review_date", "rating review_text"
)
_STATUS_COUNTS = "customers products orders payments reviews"

def _cell(column: str) -> str:
    value = column
    if _TYPES.get(column) == "DOUBLE":
        value = f"round({column} * 100)::BIGINT"
    if _TYPES.get(column) == "TIMESTAMP":
        value = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    return f"coalesce(({value})::VARCHAR, '~')"


_ADHOC = """
    SELECT customer_id, count(*) AS order_count, sum(quantity)::BIGINT AS units
    FROM c_orders GROUP BY customer_id ORDER BY units DESC, customer_id"""

ORACLE: dict[str, str] = {
    "scan_products": _scan("c_products", "product_id", "", "name category price stock"),
    "scan_customers": _scan("c_customers", "customer_id", "created_at", "name email signup_channel"),
    "scan_orders": _SCAN_ORDERS,
    "scan_order_items": _scan(
        "c_items", "item_id order_id product_id", "", "quantity unit_price total_price"
    ),
    "scan_optional_missing": _with("c_products c_orders", _PRODUCT_SALES),
    "scan_payments": _scan(
        "c_payments", "payment_id order_id", "payment_date", "payment_method amount status"
    ),
    "scan_reviews": _SCAN_REVIEWS,
    "scan_json": _SCAN_REVIEWS,
    "scan_json_array": _SCAN_REVIEWS,
    "typed_load": _with(
        "c_customers c_products c_orders c_payments c_reviews",
        _union(
            f"SELECT '{t}' AS dataset, concat_ws('|', {', '.join(_cell(c) for c in columns.split())}) AS cells FROM c_{t}"
            for t, columns in _RAW_COLUMNS.items()
        ),
    ),
    "parquet_roundtrip": _with("c_products c_orders", _PRODUCT_SALES),
    "table_row_counts": _with(
        "c_customers c_products c_orders c_payments c_reviews",
        _union(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM c_{t}"
            for t in _STATUS_COUNTS.split()
        ),
    ),
    "completed_orders": _with(
        "c_orders",
        f"SELECT *, {_cents('total_price')} AS net_price FROM c_orders WHERE status = 'Completed'",
    ),
    "clean_customers": _with(
        "c_customers",
        "SELECT customer_id, trim(name) AS name, lower(trim(email)) AS email,"
        " trim(signup_channel) AS signup_channel FROM c_customers",
    ),
    "standardize_timestamps": _with(
        "c_customers c_orders c_payments c_reviews",
        _union(
            f"SELECT '{t}' AS dataset, {_KEYS[t]}::VARCHAR AS row_id,"
            f" strftime({m}, '%Y-%m-%d %H:%M:%S') AS moment FROM c_{t}"
            for t, m in _MOMENTS.items()
        ),
    ),
    "recalc_revenue": _with(
        "c_orders c_products",
        f"""SELECT o.order_id, o.product_id, o.quantity, calculated AS total_price,
                   calculated AS calculated_total_price,
                   coalesce(o.total_price <> calculated, true) AS has_price_discrepancy
            FROM c_orders o LEFT JOIN c_products p ON o.product_id = p.product_id,
                 LATERAL (SELECT {_cents("o.quantity * p.price")} AS calculated) x""",
    ),
    "order_features": _with(
        "c_orders",
        "SELECT order_id, year(order_date)::INTEGER AS order_year,"
        " month(order_date)::INTEGER AS order_month, dayname(order_date) AS order_dayofweek"
        " FROM c_orders",
    ),
    "customer_tenure": _with(
        "c_customers c_orders",
        """SELECT customer_id, floor((epoch((SELECT max(order_date) FROM c_orders)) - epoch(created_at))
                  / 86400)::INTEGER AS customer_tenure_days
           FROM c_customers""",
    ),
    "rating_category": _with(
        "c_reviews",
        """SELECT review_id, rating, CASE WHEN rating >= 4 THEN 'Positive' WHEN rating = 3 THEN 'Neutral'
                  ELSE 'Negative' END AS rating_category FROM c_reviews""",
    ),
    "executive_kpis": _with("c_customers c_products c_orders c_payments c_reviews", _KPIS),
    "overall_sales_summary": _with(
        "c_orders",
        f"""SELECT count(order_id) AS total_orders, coalesce(sum(quantity), 0)::BIGINT AS total_units_sold,
                   {_money("total_price")} AS total_revenue, {_average("total_price")} AS avg_order_value,
                   {_cents("min(total_price)")} AS min_order_value,
                   {_cents("max(total_price)")} AS max_order_value
            FROM c_orders""",
    ),
    "orders_by_status": _with(
        "c_orders",
        f"""SELECT status AS order_status, count(order_id) AS order_count,
                   {_money("total_price")} AS total_revenue FROM c_orders GROUP BY status""",
    ),
    "reconcile_revenue": _with(
        "c_orders c_products",
        f"""SELECT o.order_id, o.customer_id, o.product_id, o.quantity, p.price AS unit_price,
                   o.total_price AS order_total_price, {_cents("o.quantity * p.price")} AS calculated_revenue,
                   {_cents("o.total_price - (o.quantity * p.price)")} AS discrepancy_amount
            FROM c_orders o JOIN c_products p ON o.product_id = p.product_id
            WHERE {_cents("o.total_price")} <> {_cents("o.quantity * p.price")}""",
    ),
    "top_selling_products": _with(
        "c_orders c_products",
        f"""SELECT p.product_id, p.name AS product_name, p.category, p.price AS unit_price,
                   coalesce(sum(o.quantity), 0)::BIGINT AS total_quantity_sold,
                   {_money("o.total_price")} AS total_revenue
            FROM c_products p LEFT JOIN c_orders o ON p.product_id = o.product_id
            GROUP BY p.product_id, p.name, p.category, p.price
            ORDER BY total_revenue DESC, p.product_id LIMIT 10""",
    ),
    "revenue_by_category": _with("c_orders c_products", _BY_CATEGORY),
    "product_sales_summary": _with("c_products c_orders", _PRODUCT_SALES),
    "product_sales_items": _with(
        "c_products c_orders c_items",
        f"""SELECT p.product_id, p.name, p.category, sum(i.quantity)::BIGINT AS total_quantity_sold,
                   {_money("i.total_price")} AS total_revenue
            FROM c_orders o JOIN c_items i ON o.order_id = i.order_id
            JOIN c_products p ON p.product_id = i.product_id
            WHERE o.status = 'Completed' GROUP BY p.product_id, p.name, p.category""",
    ),
    "category_revenue": _with("c_products c_orders", _CATEGORY_SALES),
    "customer_analytics": _with(
        "c_customers c_orders",
        f"""SELECT c.customer_id, c.name AS customer_name, c.email, c.signup_channel,
                   count(o.order_id) AS total_orders,
                   coalesce(sum(o.quantity), 0)::BIGINT AS total_items_purchased,
                   {_money("o.total_price")} AS total_spend, {_average("o.total_price")} AS avg_order_spend
            FROM c_customers c LEFT JOIN c_orders o ON c.customer_id = o.customer_id
            GROUP BY c.customer_id, c.name, c.email, c.signup_channel""",
    ),
    "payment_method_distribution": _with(
        "c_payments",
        f"""SELECT payment_method, count(payment_id) AS payment_count, {_money("amount")} AS total_amount
            FROM c_payments GROUP BY payment_method""",
    ),
    "payment_status_breakdown": _with(
        "c_payments",
        f"""SELECT status AS payment_status, count(payment_id) AS payment_count,
                   {_money("amount")} AS total_amount FROM c_payments GROUP BY status""",
    ),
    "product_review_ratings": _with(
        "c_reviews c_products",
        f"""SELECT p.product_id, p.name AS product_name, p.category, count(r.review_id) AS review_count,
                   coalesce({_cents("avg(r.rating)")}, 0.0) AS average_rating
            FROM c_products p LEFT JOIN c_reviews r ON p.product_id = r.product_id
            GROUP BY p.product_id, p.name, p.category
            ORDER BY average_rating DESC, review_count DESC, p.product_id LIMIT 10""",
    ),
    "rating_distribution": _with("c_reviews", _SENTIMENT),
    "monthly_trends": _with(
        "c_orders",
        f"""SELECT strftime(order_date, '%Y-%m') AS order_month, count(order_id) AS total_orders,
                   coalesce(sum(quantity), 0)::BIGINT AS total_units_sold,
                   {_money("total_price")} AS monthly_revenue, {_average("total_price")} AS avg_order_value
            FROM c_orders GROUP BY 1""",
    ),
    "analytics_summary": _with("c_customers c_products c_orders c_payments c_reviews", _SUMMARY),
    "adhoc_capped": _with("c_orders", f"{_ADHOC} LIMIT 100"),
    "adhoc_own_limit": _with("c_orders", f"{_ADHOC} LIMIT 500"),
    "dim_date": _with(
        "days", "SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM days"
    ),
    "dim_customer": _with("k_customers", "SELECT * FROM k_customers"),
    "dim_product": _with("k_products", "SELECT * FROM k_products"),
    "dim_customer_reload": _with(
        "c_customers",
        """SELECT coalesce(f.customer_key,
                      (SELECT count(*) FROM first_load)
                      + row_number() OVER (PARTITION BY f.customer_key IS NULL ORDER BY c.customer_id))
                      AS customer_key,
                  c.customer_id, c.name, c.email, c.signup_channel, c.created_at
           FROM c_customers c LEFT JOIN first_load f ON c.customer_id = f.customer_id""",
        """first_load AS (
           SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id
           FROM customer WHERE c_acctbal >= 0)""",
    ),
    "fact_sales": _with("facts", "SELECT * FROM facts"),
    "fact_rejects": _with(
        "c_orders",
        """SELECT order_id, customer_id, product_id, order_date, lacking
           FROM (SELECT *, concat_ws(',',
                        CASE WHEN customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
                             THEN 'customer' END,
                        CASE WHEN product_id NOT IN (SELECT p_partkey FROM part WHERE p_size >= 6)
                             THEN 'product' END,
                        CASE WHEN year(order_date) NOT BETWEEN 1995 AND 1999 THEN 'date' END) AS lacking
                 FROM c_orders) r
           WHERE lacking <> ''""",
    ),
    "warehouse_facts": _with("facts", "SELECT *, true AS ids_are_dense FROM facts"),
    "warehouse_counts": _with(
        "facts",
        """SELECT 'dim_date' AS table_name, count(*) AS row_count FROM days
           UNION ALL SELECT 'dim_customer', count(*) FROM k_customers
           UNION ALL SELECT 'dim_product', count(*) FROM k_products
           UNION ALL SELECT 'fact_sales', count(*) FROM facts""",
    ),
    "dw_category_drilldown": _with(
        "facts",
        f"""SELECT d.year, d.quarter, p.category, count(DISTINCT f.order_id) AS total_orders,
                   sum(f.quantity)::BIGINT AS total_items_sold, {_money("f.total_price")} AS category_revenue
            FROM facts f JOIN k_products p ON f.product_key = p.product_key
            JOIN days d ON f.date_key = d.date_key GROUP BY d.year, d.quarter, p.category""",
    ),
    "dw_weekend_performance": _with(
        "facts",
        f"""SELECT CASE WHEN d.is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
                   count(DISTINCT f.order_id) AS total_orders, sum(f.quantity)::BIGINT AS total_items_sold,
                   {_money("f.total_price")} AS total_revenue, {_average("f.total_price")} AS avg_order_value
            FROM facts f JOIN days d ON f.date_key = d.date_key GROUP BY d.is_weekend""",
    ),
    "dw_top_customers": _with(
        "facts",
        f"""SELECT name, email, total_orders, total_spend
            FROM (SELECT c.customer_key, c.name, c.email, count(DISTINCT f.order_id) AS total_orders,
                         {_money("f.total_price")} AS total_spend
                  FROM facts f JOIN k_customers c ON f.customer_key = c.customer_key
                  GROUP BY c.customer_key, c.name, c.email
                  ORDER BY total_spend DESC, c.customer_key LIMIT 5) t""",
    ),
    "dq_audit": _with(_RAW, _AUDIT),
    "dq_audit_summary": _with(
        _RAW,
        f"""SELECT count(*) AS total_datasets, bool_and(passed) AS overall_passed,
                   sum(issues)::BIGINT AS total_issues_found FROM ({_AUDIT}) a""",
    ),
    "dq_missing": _with(
        _RAW,
        _union(
            f"SELECT '{n}' AS dataset, coalesce(sum({_missing(n)}), 0)::BIGINT AS missing_value_count"
            f" FROM r_{n}"
            for n in _RAW_COLUMNS
        ),
    ),
    "dq_duplicates": _with(_RAW, _DUPLICATES),
    "dq_invalid_values": _with(
        _RAW,
        _union(
            f"SELECT '{n}' AS dataset, '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS invalid_count"
            f" FROM r_{n}"
            for n, rule, _, test in _VALUE_RULES
        ),
    ),
    "dq_date_errors": _with(
        _RAW,
        _union(
            f"SELECT '{n}' AS dataset, count(*) FILTER (WHERE {_bad_date(c)}) AS date_errors FROM r_{n}"
            for n, c in _MOMENTS.items()
        ),
    ),
    "dq_status_errors": _with(
        _RAW,
        _union(
            f"SELECT '{n}' AS dataset, count(*) FILTER (WHERE {_bad_status(n)}) AS status_errors FROM r_{n}"
            for n in _STATUSES
        ),
    ),
    "fk_violations": _with(_RAW, _FK_COUNTS),
    "fk_violation_rows": _with(
        _RAW,
        _union(
            f"SELECT '{c}' AS dataset, {_KEYS[c]} AS row_id, '{col}' AS column_name, {col} AS missing_key"
            f" FROM r_{c} WHERE {col} IS NOT NULL AND ({_dangling(c, col, p)})"
            for c, col, p in _USES
        ),
    ),
    "dq_violation_rows": _with(_RAW, _VIOLATION_ROWS),
    "constraint_rejects": _with(_RAW, _REJECTS),
    "load_verification": _with(
        "c_customers c_products c_orders c_payments c_reviews",
        _union(
            f"SELECT '{t}' AS table_name, count(*) AS source_count,"
            f" count(DISTINCT {k}) AS stored_count, count(*) = count(DISTINCT {k}) AS matched FROM c_{t}"
            for t, k in _KEYS.items()
        ),
    ),
    "cdc_classify": _with("s_orders s_earlier", _CLASSIFIED),
    "cdc_summary": _with(
        "s_orders s_earlier",
        f"""SELECT count(*) FILTER (WHERE cdc_action = 'INSERT') AS "INSERT",
                   count(*) FILTER (WHERE cdc_action = 'UPDATE') AS "UPDATE",
                   count(*) FILTER (WHERE cdc_action = 'NO_CHANGE') AS "NO_CHANGE",
                   0::BIGINT AS "REJECT", count(*) AS total_delta_records
            FROM ({_CLASSIFIED}) c""",
    ),
    "cdc_merge": _with("s_orders s_earlier", _MERGED),
    "cdc_merge_stored": _with("s_orders s_earlier", _MERGED),
    "upsert_orders": _with("s_orders s_earlier", _MERGED),
    "stream_merge": _with("s_orders s_earlier", _MERGED),
    "upsert_rejects": _with(
        "c_orders",
        "SELECT * REPLACE (NULL::VARCHAR AS order_id) FROM c_orders WHERE status = 'Cancelled'",
    ),
    "incremental_run": _with(
        "s_orders s_earlier",
        f"""SELECT *, concat_ws(',',
                       CASE WHEN customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
                            THEN 'customer_id' END,
                       CASE WHEN product_id NOT IN (SELECT p_partkey FROM part WHERE p_size >= 6)
                            THEN 'product_id' END) AS lost,
                   (SELECT count(*) FROM s_orders) AS run_rows
            FROM ({_MERGED}) m""",
    ),
    "run_records": _with(
        "c_payments",
        """SELECT 'write_payments' AS task_name, 'SUCCESS' AS status, count(*) AS row_count,
                  count(*) - count(payment_method) AS missing_methods FROM c_payments""",
    ),
    "json_unreadable": """SELECT count(props) AS cells, count(*) FILTER (WHERE event_type = 'error') AS unreadable
        FROM events""",
    "schema_drift": _drift({"k": "double", "source": "string"}, _JSON_KEYS),
    "schema_drift_text": _with(
        "r_payments",
        _drift(
            {
                "payment_id": "string", "order_id": "string", "payment_method": "string",
                "amount": "double", "payment_date": "timestamp",
            },
            _PAYMENT_TYPES,
        ),
    ),
    "metric_drift": _with("c_orders s_earlier", _metric_drift("s_earlier", "c_orders")),
    "metric_drift_kept": _with(
        "c_orders s_earlier",
        _metric_drift(
            "s_earlier",
            """(SELECT * FROM s_earlier UNION ALL BY NAME
                SELECT * FROM c_orders WHERE order_date >= TIMESTAMP '2000-07-01') u""",
        ),
    ),
    "schema_drift_nested": _NESTED_DRIFT,
    "etl_row_counts": _with(
        "c_customers c_products c_orders c_payments c_reviews",
        _union(
            f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS row_count FROM c_{t}"
            for t, k in _KEYS.items()
        ),
    ),
    "etl_run_records": _with(
        "c_customers c_products c_orders c_payments c_reviews",
        _union(
            f"SELECT 'store_{t}' AS task_name, 'SUCCESS' AS status, count(DISTINCT {k}) AS row_count,"
            f" count(DISTINCT {k}) AS inserted FROM c_{t}"
            for t, k in _KEYS.items()
        ),
    ),
    "etl_stored_orders": _with(
        "s_orders c_products",
        f"""SELECT order_id, o.customer_id::VARCHAR AS customer_id, o.product_id::VARCHAR AS product_id, quantity,
                   {_cents("o.quantity * p.price")} AS total_price,
                   strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, status
            FROM s_orders o LEFT JOIN c_products p ON o.product_id = p.product_id""",
    ),
    "lake_outputs": _with(
        "c_products c_orders",
        f"""SELECT 'product_sales_summary' AS output, product_id::VARCHAR AS item,
                   total_quantity_sold AS units, total_revenue FROM ({_PRODUCT_SALES}) s
            UNION ALL SELECT 'category_revenue', category, total_items_sold, total_revenue
            FROM ({_CATEGORY_SALES}) c""",
    ),
}

ORACLE["report_document"] = ORACLE["analytics_summary"]
ORACLE["analytics_reports"] = _union(
    _long(section, source, item, metrics)
    for section, source, item, metrics in (
        (
            "executive_kpis", ORACLE["executive_kpis"], "'all'",
            "total_customers total_products total_orders total_revenue average_order_value"
            " total_quantity_sold successful_payments average_product_rating",
        ),
        (
            "revenue_reconciliation", ORACLE["reconcile_revenue"], "order_id",
            "quantity unit_price order_total_price calculated_revenue discrepancy_amount",
        ),
        ("orders_by_status", ORACLE["orders_by_status"], "order_status", "order_count total_revenue"),
        (
            "category_revenue", ORACLE["revenue_by_category"], "category",
            "product_count total_quantity_sold total_revenue",
        ),
        (
            "top_selling_products", f"SELECT * FROM ({ORACLE['top_selling_products']}) ORDER BY total_revenue DESC,"
            " product_id LIMIT 5", "product_id::VARCHAR", "unit_price total_quantity_sold total_revenue",
        ),
        (
            "customer_analytics", f"SELECT * FROM ({ORACLE['customer_analytics']}) ORDER BY total_spend DESC,"
            " customer_id LIMIT 5", "customer_id::VARCHAR",
            "total_orders total_items_purchased total_spend avg_order_spend",
        ),
        ("payment_methods", ORACLE["payment_method_distribution"], "payment_method", "payment_count total_amount"),
        ("sentiment", ORACLE["rating_distribution"], "sentiment_category", "review_count percentage"),
        (
            "monthly_trends", ORACLE["monthly_trends"], "order_month",
            "total_orders total_units_sold monthly_revenue avg_order_value",
        ),
    )
)

_RAW_LINES = """
SELECT 'products' AS dataset, p_size >= 49 AS malformed, CASE
    WHEN p_size = 50 THEN concat_ws(',', p_partkey, p_name, p_type, p_retailprice, p_size, 'surplus')
    WHEN p_size = 49 THEN concat_ws(',', p_partkey, '"' || p_name, p_type)
    ELSE '' END AS line
FROM part
UNION ALL
SELECT 'reviews', event_type = 'error', CASE
    WHEN event_type = 'error' THEN concat_ws(',', event_id, user_id, props ->> '$.k', '5', event_type)
    ELSE '' END
FROM events
"""

ORACLE["scan_malformed"] = f"SELECT dataset, line FROM ({_RAW_LINES}) WHERE malformed"

ORACLE["dq_audit_files"] = f"""
WITH lines AS (
    SELECT dataset, count(*) AS rows_checked, count(*) FILTER (WHERE malformed) AS malformed_lines FROM ({_RAW_LINES}) GROUP BY dataset
), others AS (
    SELECT 'customers' AS dataset, count(*) AS rows_checked, 0 AS malformed_lines FROM customer
    UNION ALL SELECT 'orders', count(*), 0 FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'payments', count(*), 0 FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)
SELECT dataset, rows_checked, malformed_lines, false AS passed FROM (SELECT * FROM lines UNION ALL SELECT * FROM others)
"""

ORACLE["dim_customer_stored"] = ORACLE["dim_customer_reload"]
